"""JSON and full text."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fulltext as X
from ..functions import json as J
from ..sources.tables import openjson as rows_of
from .registry import Tables, query

_BUILT = "(select event_id, '{\"id\":' || event_id || ',\"tags\":[\"a\",\"' || event_type || '\"],\"u\":{\"n\":' || user_id || '}}' as doc from events)"
_ITEMS = "(select event_id, '[{\"k\":' || event_id || ',\"t\":\"' || event_type || '\"},{\"k\":' || user_id || '}]' as doc from events)"


def _built(t: Tables) -> DataFrame:
    e, s = F.lit, lambda c: F.col(c).cast("string")
    return t.events.select("event_id", F.concat(e('{"id":'), s("event_id"), e(',"tags":["a","'), "event_type", e('"],"u":{"n":'), s("user_id"), e("}}")).alias("doc"))


@query(f"select event_id, json_extract_string(doc, '$.u.n') as n, null::varchar as obj, json_extract_string(doc, '$.tags[1]') as tag from {_BUILT}")
def json_value(t: Tables) -> DataFrame:
    d = F.col("doc")
    return _built(t).select("event_id", J.json_value(d, "$.u.n").alias("n"), J.json_value(d, "$.u").alias("obj"), J.json_value(d, "$.tags[1]").alias("tag"))


@query(f"select event_id, json_extract(doc, '$.tags')::varchar as tags, json_extract(doc, '$.u')::varchar as u, null::varchar as id from {_BUILT}")
def json_query(t: Tables) -> DataFrame:
    d = F.col("doc")
    return _built(t).select("event_id", J.json_query(d, "$.tags").alias("tags"), J.json_query(d, "$.u").alias("u"), J.json_query(d, "$.id").alias("id"))


@query("select event_id, case when event_id % 3 = 0 then 0 else 1 end as ok, 1 as has from events")
def isjson(t: Tables) -> DataFrame:
    doc = F.when(F.col("event_id") % 3 == 0, F.concat("props", F.lit("]"))).otherwise(F.col("props"))
    return t.events.select("event_id", J.isjson(doc).alias("ok"), F.coalesce(J.json_path_exists(doc, "$.k"), F.lit(0)).alias("has"))


@query("select o_orderkey, '{\"key\":' || o_orderkey || ',\"state\":\"' || o_orderstatus || '\",\"none\":null}' as obj, '[' || o_orderkey || ',' || o_custkey || ']' as arr from orders")
def json_object(t: Tables) -> DataFrame:
    obj = J.json_object(key=F.col("o_orderkey"), state=F.col("o_orderstatus"), none=F.lit(None).cast("string"))
    return t.orders.select("o_orderkey", obj.alias("obj"), J.json_array(F.col("o_orderkey"), F.col("o_custkey")).alias("arr"))


@query(f"select event_id from {_BUILT} where list_contains(json_extract_string(doc, '$.tags[*]'), 'click')")
def json_contains(t: Tables) -> DataFrame:
    return _built(t).where(J.json_contains(F.col("doc"), "click", "$.tags")).select("event_id")


@query("select event_id, '{\"k\":' || json_extract_string(props, '$.k') || ',\"n\":1}' as added, '{}' as emptied from events")
def json_modify(t: Tables) -> DataFrame:
    return t.events.select("event_id", J.json_modify(F.col("props"), "$.n", 1).alias("added"), J.json_remove(F.col("props"), "$.k").alias("emptied"))


@query("select event_id, event_id as k, event_type as kind from events union all select event_id, user_id, null from events")
def openjson(t: Tables) -> DataFrame:
    s = lambda c: F.col(c).cast("string")
    rows = t.events.select("event_id", F.concat(F.lit('[{"k":'), s("event_id"), F.lit(',"t":"'), "event_type", F.lit('"},{"k":'), s("user_id"), F.lit("}]")).alias("doc"))
    return rows_of(rows, "doc", {"k": ("bigint", "$.k"), "kind": ("string", "$.t")}).drop("doc")


@query("select event_id, 'k' as json_key, json_extract_string(props, '$.k') as json_value from events")
def openjson_pairs(t: Tables) -> DataFrame:
    return rows_of(t.events.select("event_id", "props"), "props").drop("props")


_TOKENS = "list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda x: x <> '')"


@query(f"select doc_id from (select doc_id, {_TOKENS} as w from documents) where list_contains(w, 'the') and len(list_filter(w, lambda x: starts_with(x, 'thing'))) > 0")
def fulltext_contains(t: Tables) -> DataFrame:
    return t.documents.where(X.contains(F.col("text"), 'the AND "thing*"')).select("doc_id")


@query(f"select doc_id from (select doc_id, {_TOKENS} as w from documents) where list_has_any(w, ['und', 'les'])")
def fulltext_freetext(t: Tables) -> DataFrame:
    return t.documents.where(X.freetext(F.col("text"), "Und, les")).select("doc_id")


@query(f"select doc_id as key, n as rank from (select doc_id, len(list_filter({_TOKENS}, lambda x: x = 'of'))::bigint as n from documents) where n > 0 order by n desc, doc_id limit 20")
def containstable(t: Tables) -> DataFrame:
    return X.containstable(t.documents, "doc_id", "text", "of", 20)


@query(f"select doc_id from (select doc_id, ' ' || array_to_string({_TOKENS}, ' ') || ' ' as w from documents) where contains(w, ' of the ')")
def fulltext_phrase(t: Tables) -> DataFrame:
    return t.documents.where(X.contains(F.col("text"), '"of the"')).select("doc_id")
