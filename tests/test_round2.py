"""Values that the queries on whole tables don't reach."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.functions import datetimes as D
from tessera.functions import fulltext as X
from tessera.functions import json as J
from tessera.functions import spatial as G
from tessera.functions import strings as S
from tessera.operators import catalog, ddl, dml
from tessera.sources import tables as T


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_pictures(spark):
    rows = [(1234567.891, "#,##0.00", "1,234,567.89"), (-0.5, "#.##", "-.5"), (0.0, "#,##0.##", "0"), (7.0, "000", "007"), (-12.3456, "0.0##", "-12.346"), (-0.001, "0.00", "0.00"), (12.5, "P0", "1,250 %"), (-3.5, "C2", "(¤3.50)")]
    for value, pattern, want in rows:
        assert one(spark, S.format_number(F.lit(value).cast("decimal(20,6)"), pattern)) == (want,), pattern
    with pytest.raises(Exception, match="number format"):
        S.format_number(F.lit(1), "Q#x")


def test_weeks_begin_on_sunday(spark):
    day = lambda x: F.lit(dt.date(2024, 1, x))
    assert one(spark, D.datediff("week", day(6), day(7)), D.datediff("week", day(7), day(8)), D.datediff("week", day(8), day(6))) == (1, 0, -1)


def test_parts_with_fractions(spark):
    spark.conf.set("spark.sql.timeType.enabled", "true")
    i = [F.lit(x) for x in (10, 11, 12, 5)]
    assert one(spark, D.timefromparts(*i, 1).cast("string"))[0] == "10:11:12.5"
    assert one(spark, D.timefromparts(*i[:3]).cast("string"))[0] == "10:11:12"


def test_mixed_arrays(spark):
    assert one(spark, J.json_array(F.lit(1), F.lit('a"b'), F.lit(True), F.lit(None)), J.json_array(F.lit(1), F.lit(None), keep_nulls=True)) == ('[1,"a\\"b",true]', "[1,null]")


def test_words_inside_quotes_do_not_join(spark):
    df = spark.createDataFrame([("black and white",), ("white and then black",), ("black or white",), ("red",), (None,)], "t string")
    found = lambda s: [r.t for r in df.where(X.contains(F.col("t"), s)).collect()]
    assert found('"black and white"') == ["black and white"]
    assert found('"black or white" OR red') == ["black or white", "red"]
    assert found("black AND white") == ["black and white", "white and then black", "black or white"]
    assert found('"bla*" AND then') == ["white and then black"]


def test_wkb(spark):
    import struct

    big = struct.pack(">BI2d", 0, 1, 1.5, -2.0)
    df = spark.createDataFrame([(big,), (b"\x01\x07",), (None,), (struct.pack("<BI", 1, 2),)], "w binary")
    assert [r[0] for r in df.select(G.st_geomfromwkb("w")).collect()] == ["POINT (1.5 -2.0)", None, None, None]


def test_bulk_changes(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", None)], "k int, n string, v double")
    with pytest.raises(Exception, match="duplicate key"):
        dml.bulk_create(target, spark.createDataFrame([(2, "x")], "k int, n string"), ["k"])[0].collect()
    assert dml.bulk_create(target, spark.createDataFrame([], "k int, n string"), ["k"])[0].count() == 2
    new, out = dml.bulk_update(target, spark.createDataFrame([(2, 5.0), (9, 1.0)], "k int, v double"), ["k"])
    assert sorted(map(tuple, new.collect())) == [(1, "a", 1.0), (2, "b", 5.0)] and out.count() == 1


def test_batches_may_be_empty(spark):
    assert T.execute_many(spark, [], "k int", "select count(*) as n from batch").first().n == 0


def test_as_of_join_without_a_match(spark):
    left = spark.createDataFrame([(1, 5, "x"), (1, 1, "y"), (2, 9, "z")], "k int, t int, n string")
    right = spark.createDataFrame([(1, 2, 20), (1, 5, 50), (1, 6, 60), (3, 1, 1)], "k int, t int, v int")
    got = dml.as_of_join(left, right.withColumnRenamed("t", "since"), ["k"], "t", "since")
    assert sorted((r.n, r.v, r.since) for r in got.collect()) == [("x", 50, 5), ("y", None, None), ("z", None, None)]


def test_tables_over_jdbc(spark, tmp_path):
    options = {"url": f"jdbc:derby:{tmp_path / 'db'};create=true", "driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    rows = spark.createDataFrame([(k, f"n{k}") for k in range(100)], "k int, n string")
    T.jdbc_write(rows, options | {"createTableColumnTypes": "n varchar(20)"}, "numbers", "overwrite")
    T.jdbc_write(rows.limit(0), options, "numbers")
    read = T.jdbc_read(spark, options, "numbers", key="K", bounds=(0, 100), parts=4)
    assert read.rdd.getNumPartitions() == 4 and sorted(r[0] for r in read.collect()) == list(range(100))


def test_names_are_checked(spark):
    with pytest.raises(ValueError):
        ddl.drop_table(spark, "a; drop schema b")
    with pytest.raises(ValueError):
        ddl.split_range([1, 2], 2)
    assert catalog.diff_tables({}, {}) == []


def test_a_type_that_does_not_fit_raises_and_keeps_the_table(spark):
    ddl.create_schema(spark, "ddl_fit")
    try:
        spark.createDataFrame([("1",), ("x",)], "v string").write.saveAsTable("ddl_fit.t")
        with pytest.raises(Exception):
            ddl.alter_column(spark, "ddl_fit.t", "v", "int")
        assert spark.table("ddl_fit.t").count() == 2
        ddl.create_view(spark, "ddl_fit.w", "select 1 as a")
        ddl.drop_view(spark, "ddl_fit.w")
        assert catalog.tables(spark, "ddl_fit")[0] == ("t", "BASE TABLE")
        assert catalog.show(spark, "columns", "ddl_fit.t").count() == 1
    finally:
        ddl.drop_schema(spark, "ddl_fit", cascade=True)
