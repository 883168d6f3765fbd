"""The training order reaches op6's rows and the packed sequences."""

from collections import defaultdict

from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import mixing, queries

FOLDER = "/root/testdata/sf0.001"


def test_op6_has_a_row_per_document_in_training_order(spark):
    rows = queries.op6_curriculum_mix(spark, FOLDER).collect()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    order = [(r.position is None, r.position or 0.0) for r in rows]
    assert order == sorted(order)
    want = {r.doc_id: (r.size, r.taken) for r in mixing.mix(docs).collect()}
    assert {r.doc_id: (r.size, r.taken) for r in rows} == want and any(r.taken > r.size for r in rows)


def test_epochs_come_in_training_order(spark):
    rows = mixing.curriculum(spark.read.parquet(f"{FOLDER}/documents.parquet")).collect()
    order = [r.position for r in rows]
    assert order == sorted(order) and None not in order
    taken = defaultdict(int)
    for r in rows:
        assert 0 < r.taken <= r.size
        taken[r.doc_id] += r.taken
    mix = mixing.mix(spark.read.parquet(f"{FOLDER}/documents.parquet")).where("taken > 0").collect()
    assert taken == {r.doc_id: r.taken for r in mix}


def test_packing_keeps_the_order_of_the_mix(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").repartition(3)
    path = str(tmp_path / "mix")
    corpus_pipeline.curriculum_mix(spark, docs, "").write.parquet(path)
    m = mixing.mix(docs).select("doc_id", F.explode(F.array("position", "position2")).alias("at")).where("at is not null")
    want = [r.doc_id for r in m.orderBy("at", "doc_id").collect()]
    rows = corpus_pipeline.ordered_packing(spark, spark.read.parquet(path), "").orderBy("sequence_id", "offset").collect()
    assert [r.doc_id for r in rows if r.start == 0] == want != sorted(want)
