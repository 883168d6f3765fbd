"""Corpus pipeline: documents to packed training sequences in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next one's documents. All but the last keep the columns of documents.

Defined results: every row counts, repeated ones too. Rows of one doc_id are judged each by their own text in
quality rules, line dedup (where repeats of a whole row share one fate), mixing and packing; the Jaccard join takes
rows of one doc_id as one document, so that they stay or go together. Null texts and wordless ones fail the
quality rules; null ids, sources and languages are values like others; an empty table passes through; extra columns,
whatever their names, are kept by all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import lines, mixing, packing, quality, sigtree
from tessera.llm.common import fresh, load, settle, stage, word_count


def _only(docs: DataFrame, wanted: DataFrame, **on: Column) -> DataFrame:
    """Rows of ``docs`` whose values (null included) are a row of ``wanted``; the same plan at every size."""
    wanted = wanted.select(*[F.col(k).alias(f"wanted_{k}") for k in on]).hint("merge")
    return docs.join(wanted, [value.eqNullSafe(wanted[f"wanted_{k}"]) for k, value in on.items()], "left_semi")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fixed rules or the outlier test reject go."""
    kept = settle(spark, lambda: quality.quality(docs).where("kept"), "pipeline-kept")
    return _only(docs, kept, doc_id=docs["doc_id"], lang=docs["lang"], source=docs["source"], copy=F.xxhash64(docs["text"]))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs and of passages on one line go, and documents that consisted
    of them; n_chars follows where a text changed."""
    aside = {c: fresh(docs, f"own_{c}") for c in docs.columns if c.lower() in ("lines_removed", "runs_removed")}
    kept = lines.dedup_lines(docs.withColumnsRenamed(aside), min_words=lines.PASSAGE_WORDS)
    kept = kept.where((F.col("lines_removed") == 0) | (word_count(F.col("text")) > 0))
    changed = F.when(F.col("lines_removed") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", changed).drop("lines_removed", "runs_removed").withColumnsRenamed({v: k for k, v in aside.items()}).select(*docs.columns)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, similarity 0.8) the smallest doc_id stays."""
    smallest = F.col("component_id").eqNullSafe(F.col("doc_id"))
    kept = settle(spark, lambda: sigtree.jaccard_groups(docs, words_each=5, percent=80).where(smallest), "pipeline-groups")
    return _only(docs, kept, doc_id=docs["doc_id"])


def curriculum_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each epoch in which the mix takes a row of documents, range-sorted by training position."""
    key, at, row = (fresh(docs, n) for n in ("key", "at", "row"))
    keyed = stage(docs.withColumn(key, F.monotonically_increasing_id()), "pipeline-rows")  # written, so that the numbers stay
    epochs = F.explode(F.array("position", "position2")).alias(at)
    taken = settle(spark, lambda: mixing.mix(keyed, key=key).select(F.col("key").alias(row), epochs).where(F.col(at).isNotNull()), "pipeline-mix")
    return keyed.join(taken.hint("merge"), keyed[key] == taken[row]).orderBy(at, "doc_id", key).select(*docs.columns)


def ordered_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens, in the order in which the mix was written."""
    return packing.pack(docs, order=packing.stored_order())


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", jaccard_join),
    ("mixing", curriculum_mix),
    ("packing", ordered_packing),
]

#: Concentration steps, tokenisation and dynamic programming have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        before = docs
        docs = settle(spark, lambda: step(spark, before, sf_dir), f"pipeline-{name.split()[0]}")
    return STAGES[-1][1](spark, docs, sf_dir)
