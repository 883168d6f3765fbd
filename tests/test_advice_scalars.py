"""Functions on whole tables, and on values that the queries of the same name leave out."""

from pyspark.sql import functions as F

from tessera.functions import strings as S
from tessera.plans import QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_digits_are_never_cut(spark):
    values = [0, 7, 99_999_999, 100_000_000, 1_234_567_890_123, -5, -123_456_789, None]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v long")
    got = [r.p for r in df.select("k", S.format_number(F.col("v"), "D8").alias("p")).orderBy("k").collect()]
    assert got == ["00000000", "00000007", "99999999", "100000000", "1234567890123", "-00000005", "-123456789", None]


def test_parts_of_every_event_make_its_time(spark):
    events = spark.read.parquet(f"{FOLDER}/events.parquet").select("event_id", "ts")
    got = {r.event_id: r.t for r in QUERIES["datetime_parts_columns"](spark, FOLDER).collect()}
    assert got == {r.event_id: r.ts for r in events.collect()}
