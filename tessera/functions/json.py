"""JSON in text columns, with lax paths: bad documents and missing paths give null."""

from __future__ import annotations

import json as _json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf


def _part(doc: Column, path: str) -> Column:
    return F.try_variant_get(F.try_parse_json(doc), path, "variant")


def _nested(part: Column) -> Column:
    kind = F.schema_of_variant(part)
    return kind.startswith("OBJECT") | kind.startswith("ARRAY")


def json_value(doc: Column, path: str = "$") -> Column:
    """A scalar as text; null for objects and arrays."""
    part = _part(doc, path)
    return F.when(~_nested(part), F.get_json_object(doc, path))


def json_query(doc: Column, path: str = "$") -> Column:
    """An object or array as text; null for scalars."""
    part = _part(doc, path)
    return F.when(_nested(part), F.get_json_object(doc, path) if path != "$" else F.to_json(part))


def isjson(doc: Column) -> Column:
    """1 for an object or array, else 0; null for null."""
    # the parser stops after a whole value: what follows must be the end, here the marker
    framed = F.try_parse_json(F.concat(F.lit("["), doc, F.lit(",0]")))
    alone = (F.try_variant_get(framed, "$[1]", "int") == 0) & F.try_variant_get(framed, "$[2]", "variant").isNull()
    return F.when(doc.isNotNull(), F.coalesce(alone & _nested(F.try_variant_get(framed, "$[0]", "variant")), F.lit(False)).cast("int"))


def json_path_exists(doc: Column, path: str) -> Column:
    """1 or 0; null for null. The document is taken to be JSON."""
    return F.when(doc.isNotNull(), _part(doc, path).isNotNull().cast("int"))


def json_object(keep_nulls: bool = True, **values: Column) -> Column:
    return F.to_json(F.struct(*[v.alias(k) for k, v in values.items()]), {"ignoreNullFields": str(not keep_nulls).lower()})


def json_array(*values: Column, keep_nulls: bool = False) -> Column:
    """Values of any types; nulls are left out unless kept."""
    items = F.array(*[v.cast("variant") for v in values])
    return F.to_json(items if keep_nulls else F.filter(items, lambda x: x.isNotNull()))


def json_contains(doc: Column, value: str, path: str = "$") -> Column:
    """Whether the array at the path holds the scalar."""
    return F.coalesce(F.array_contains(F.from_json(F.get_json_object(doc, path), "array<string>"), value), F.lit(False))


def _steps(path: str) -> list[str | int]:
    import re

    return [int(m[2]) if m[2] is not None else m[1] or m[3] for m in re.finditer(r'\.(\w+)|\[(\d+)\]|\."([^"]*)"', path)]


def _modified(text: str | None, steps: list, value: object, remove: bool) -> str | None:
    if text is None:
        return None
    try:
        doc = _json.loads(text)
    except ValueError:
        return None
    at = doc
    for s in steps[:-1]:
        if isinstance(at, dict) and isinstance(s, str) and isinstance(at.get(s), (dict, list)) or isinstance(at, list) and isinstance(s, int) and s < len(at):
            at = at[s]
        else:
            return text
    last = steps[-1]
    if isinstance(at, dict):
        at.pop(last, None) if remove else at.__setitem__(last, value)
    elif isinstance(at, list) and isinstance(last, int) and last < len(at):
        at.__setitem__(last, None if remove else value)
    return _json.dumps(doc, separators=(",", ":"), ensure_ascii=False)


def json_modify(doc: Column, path: str, value: object) -> Column:
    """Sets the value at a path; None removes an object's key. Spark has no setter: an Arrow batch function."""
    steps, remove = _steps(path), value is None

    @pandas_udf("string")
    def modify(docs: pd.Series) -> pd.Series:
        return docs.map(lambda t: _modified(t, steps, value, remove), na_action="ignore")

    return modify(doc)


def json_remove(doc: Column, path: str) -> Column:
    return json_modify(doc, path, None)
