"""Full-text predicates on word tokens: lower case, letters and digits, no stemming or thesaurus."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda t: t != "")


def _phrase(text: Column, words: list[str]) -> Column:
    return F.concat(F.lit(" "), F.array_join(tokens(text), " "), F.lit(" ")).contains(" " + " ".join(words) + " ")


def _term(text: Column, term: str) -> Column:
    term = term.strip()
    if term.startswith('"') and term.endswith('*"'):
        prefix = term[1:-2].lower()
        return F.exists(tokens(text), lambda t: t.startswith(prefix))
    words = re.findall(r"[a-z0-9]+", term.lower())
    if not words:
        return F.lit(False)
    # the words' characters must be there at all: texts without them aren't split
    maybe = reduce(lambda x, y: x & y, [F.contains(F.lower(text), F.lit(w)) for w in words])
    return maybe & (F.array_contains(tokens(text), words[0]) if len(words) == 1 else _phrase(text, words))


def _parts(search: str, word: str) -> list[str]:
    """The search cut at a word, but not inside quotes."""
    out, quoted = [""], False
    for piece in re.split(rf'("|\s+{word}\s+)', search, flags=re.I):
        if piece.strip().upper() == word and not quoted:
            out.append("")
        else:
            quoted ^= piece == '"'
            out[-1] += piece
    return out


def contains(text: Column, search: str) -> Column:
    """Terms, "phrases" and "prefixes*" joined by AND (first) and OR; NEAR((a, b), k)."""
    near = re.fullmatch(r"\s*NEAR\(\((\w+),\s*(\w+)\),\s*(\d+)\)\s*", search, re.I)
    if near:
        a, b, k = near[1].lower(), near[2].lower(), int(near[3])
        places = lambda w: F.filter(F.transform(tokens(text), lambda t, i: F.when(t == w, i)), lambda i: i.isNotNull())
        return F.exists(places(a), lambda i: F.exists(places(b), lambda j: F.abs(i - j) <= k + 1))
    either = [reduce(lambda x, y: x & y, [_term(text, t) for t in _parts(part, "AND")]) for part in _parts(search, "OR")]
    return reduce(lambda x, y: x | y, either)


def contains_any(texts: Sequence[Column], search: str) -> Column:
    """CONTAINS over several columns: one of them satisfies the search."""
    return reduce(lambda x, y: x | y, [F.coalesce(contains(t, search), F.lit(False)) for t in texts])


def freetext(text: Column, phrase: str) -> Column:
    """Any word of the phrase."""
    words = re.findall(r"[a-z0-9]+", phrase.lower())
    return F.arrays_overlap(tokens(text), F.array(*[F.lit(w) for w in words]))


def containstable(df: DataFrame, key: str, column: str | Sequence[str], words: str | Sequence[str], top: int) -> DataFrame:
    """(key, rank): the rows that hold the words most often, in one or several columns."""
    wanted = [w.lower() for w in ([words] if isinstance(words, str) else words)]
    own = [tokens(F.coalesce(F.col(x), F.lit(""))) for x in ([column] if isinstance(column, str) else column)]
    hits = F.size(F.filter(F.concat(*own), lambda t: t.isin(wanted))).cast("long")
    return df.select(F.col(key).alias("key"), hits.alias("rank")).where("rank > 0").orderBy(F.desc("rank"), "key").limit(top)


def inverted_index(df: DataFrame, key: str, column: str) -> DataFrame:
    """(token, key): the index that a full-text index stands for."""
    return df.select(F.explode(F.array_distinct(tokens(F.col(column)))).alias("token"), F.col(key).alias("key"))
