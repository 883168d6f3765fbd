"""Quality rules with robust multivariate outliers.

Per-document statistics are counted from whole texts; fixed rules reject what is too short or too
repetitive; of the rest, a minimum-covariance-determinant (MCD) estimate per language and source
gives each document a Mahalanobis distance, and documents beyond a chi-square quantile are rejected.

The estimate is distributed: concentration steps (keep the ``H`` share of rows with the smallest
distance, estimate mean and covariance from them again) are plain grouped aggregations over the
slim statistics table, from one deterministic start (medians and interquartile ranges), until no centre
moves any more, or ``STEPS`` times. The covariance takes the consistency factor of a normal law, and no
statistic's deviation is taken for smaller than its floor. A hot group is reduced map-side like any other;
nothing gathers a group's rows.

Defined results: a null text counts as empty (no words, so the fixed rules reject it). Null
languages or sources are groups of their own. Groups with fewer than ``MIN_GROUP`` rows are judged by the
estimate over the rows of all groups, small and large. Extra columns are ignored. Repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import attach, small_batches, stage

SYMBOLS = b"#*$%&|<>"
STATS = "doc_id long, lang string, source string, copy long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"

#: Share of a group's rows that the MCD estimate rests on, and the factor by which the covariance of that share falls
#: short for a normal law in four dimensions.
H = 0.75
CONSISTENCY = 1.4864
#: Concentration steps at most, and how far a centre may move for the estimate to stand still.
STEPS = 8
STILL = 1e-4
MIN_GROUP = 100
#: Squared Mahalanobis distance beyond which a document is an outlier: the chi-square law with 4 degrees of freedom, tail 1e-5.
CUT = 28.4733
FEATURES = ["f0", "f1", "f2", "f3"]
#: Smallest standard deviation of each transformed statistic: most texts have no symbols or repeats at all, and
#: without it those with a single one would be outliers.
FLOOR = [0.06, 0.25, 0.15, 0.15]


def repeated_window_words(codes: np.ndarray, distinct: int) -> int:
    """Words in 3-word windows that are found twice or more. Codes number the text's words."""
    n = len(codes)
    if n < 4:
        return 0
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    if distinct < 1 << 21:
        keys = (a << 42) | (b << 21) | c
    else:
        _, pair = np.unique(a * distinct + b, return_inverse=True)
        keys = pair * np.int64(distinct) + c
    order = np.argsort(keys, kind="stable")
    same = np.diff(keys[order]) == 0
    if not same.any():
        return 0
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= twice
    return int(covered.sum())


def text_statistics(text: bytes) -> tuple[int, int, int, int, int, int]:
    words = text.split()  # bytes split at exactly the blanks of a word
    n = len(words)
    joined = b"".join(words)
    chars = len(joined) if joined.isascii() else len(joined.decode("utf-8", "replace"))
    symbols = len(joined) - len(joined.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    repeats = 0
    if n >= 4:
        number: dict[bytes, int] = {}
        codes = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
        repeats = repeated_window_words(codes, len(number))
    return n, chars, symbols, len(lines) - len(set(lines)), repeats, len(lines)


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [text_statistics(t or b"") for t in batch.column("text").cast(pa.binary()).to_pylist()]
        numbers = np.array(rows, np.int64).reshape(len(rows), 6)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), batch.column(3), *[pa.array(numbers[:, k]) for k in range(6)]],
            ["doc_id", "lang", "source", "copy", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"],
        )


def statistics(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("source").cast("string"), F.xxhash64("text").alias("copy"), F.col("text").cast("string")).mapInArrow(_statistics, STATS)


def features() -> list[Column]:
    """Statistics brought near a symmetric law: length of words, symbols, repeated lines, repeated words."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return [
        F.log1p(F.col("word_chars") / n).alias("f0"),
        F.log1p(F.lit(100.0) * F.col("n_symbols") / n).alias("f1"),
        F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))).alias("f2"),
        F.sqrt(F.col("n_repeat_words") / n).alias("f3"),
    ]


def _invert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Moments of each group -> centre and inverse covariance, with the floor under its spread."""
    for x in batches:
        n = np.maximum(x["n"].to_numpy(float), 1.0)
        mean = np.stack([x[f"s{i}"].to_numpy(float) / n for i in range(4)], 1)
        cov = np.empty((len(x), 4, 4))
        for i in range(4):
            for j in range(i, 4):
                cov[:, i, j] = cov[:, j, i] = CONSISTENCY * (x[f"s{i}{j}"].to_numpy(float) / n - mean[:, i] * mean[:, j])
        cov[:, range(4), range(4)] = np.maximum(cov[:, range(4), range(4)], np.square(FLOOR))
        yield pd.DataFrame({"group": x["group"], "center": list(mean), "inverse": list(np.linalg.inv(cov).reshape(len(x), 16))})


ESTIMATE = "group string, center array<double>, inverse array<double>"


def _estimate(rows: DataFrame, keep: Column) -> DataFrame:
    kept = rows.where(keep)
    sums = [F.sum(f"f{i}").alias(f"s{i}") for i in range(4)] + [F.sum(F.col(f"f{i}") * F.col(f"f{j}")).alias(f"s{i}{j}") for i in range(4) for j in range(i, 4)]
    moments = kept.groupBy("group").agg(F.count("*").alias("n"), *sums)
    return stage(moments.mapInPandas(_invert, ESTIMATE), "mcd-estimate")


def _distance() -> Column:
    d = [F.col(f"f{i}") - F.col("center")[i] for i in range(4)]
    return sum((d[i] * d[j] * F.col("inverse")[4 * i + j] for i in range(4) for j in range(4)), F.lit(0.0))


def _moved(new: DataFrame, old: DataFrame) -> float:
    """How far a centre has moved at most; tables of one row per group."""
    steps = [F.abs(F.col("center")[i] - F.col("before")[i]) for i in range(4)]
    return new.join(old.select("group", F.col("center").alias("before")), "group").agg(F.max(F.greatest(*steps))).first()[0] or 0.0


def outlier_distances(rows: DataFrame) -> DataFrame:
    """Adds ``d2``, the squared robust distance. ``rows``: staged, with lang, source and the features."""
    counts = stage(rows.groupBy("lang", "source").agg(F.count("*").alias("group_rows")), "mcd-groups")
    large = F.col("group_rows") >= MIN_GROUP
    own = F.struct(F.when(large, F.to_json(F.struct("lang", "source"))).alias("group"), large.alias("judged"))
    all_rows = F.struct(F.lit("*").alias("group"), (~large).alias("judged"))
    # every row takes part in the estimate over all, and in its group's if that is large
    rows = attach(rows, counts, ["lang", "source"]).withColumn("g", F.explode(F.filter(F.array(own, all_rows), lambda g: g["group"].isNotNull())))
    rows = stage(rows.drop("group_rows").select("*", "g.group", "g.judged").drop("g"), "mcd-rows")
    quartiles = [F.percentile_approx(f, [0.25, 0.5, 0.75], 2000).alias(f"q_{f}") for f in FEATURES]
    start = stage(rows.groupBy("group").agg(*quartiles), "mcd-start")
    slim = rows.select("group", *FEATURES)
    spread = [F.greatest((F.col(f"q_{f}")[2] - F.col(f"q_{f}")[0]) / 1.35, F.lit(FLOOR[i])) for i, f in enumerate(FEATURES)]
    scaled = [(F.col(f) - F.col(f"q_{f}")[1]) / spread[i] for i, f in enumerate(FEATURES)]
    step = attach(slim, start, ["group"]).withColumn("d2", sum((x * x for x in scaled), F.lit(0.0)))
    center = None
    for _ in range(STEPS):
        limits = stage(step.groupBy("group").agg(F.percentile_approx("d2", H, 2000).alias("limit")), "mcd-limit")
        before, center = center, _estimate(attach(step.select("group", *FEATURES, "d2"), limits, ["group"]), F.col("d2") <= F.col("limit"))
        step = attach(slim, center, ["group"]).withColumn("d2", _distance())
        if before is not None and _moved(center, before) <= STILL:
            break
    judged = attach(rows.where("judged"), center, ["group"]).withColumn("d2", _distance())
    return judged.drop("group", "judged", "center", "inverse")


def quality(docs: DataFrame) -> DataFrame:
    """One row per document with its counts, ``base_failed``, ``d2`` and ``kept``; ``copy``, the hash of its text, tells
    rows of one doc_id apart."""
    failed = (F.col("n_words") < 50) | (F.lit(100) * F.col("n_repeat_words") > F.lit(50) * F.col("n_words"))
    rows = stage(statistics(docs).select("*", *features()).withColumn("base_failed", failed), "quality")
    judged = outlier_distances(rows.where(~F.col("base_failed"))).withColumn("kept", F.col("d2") <= CUT)
    rest = rows.where("base_failed").withColumn("d2", F.lit(None).cast("double")).withColumn("kept", F.lit(False))
    return judged.unionByName(rest).drop("n_lines", *FEATURES)
