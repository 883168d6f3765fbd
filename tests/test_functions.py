"""Edge cases of functions and operators."""

import pytest
from pyspark.sql import functions as F

from tessera.errors import UnsupportedFeatureError
from tessera.functions import conditional, datetimes, fulltext, json, numbers, spatial, strings
from tessera.operators import catalog, dml, relational, relations, routines
from tessera.sources import tables


def one(spark, *columns, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return tuple(df.select(*columns).first())


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


def test_strings(spark):
    assert one(spark, strings.len_(F.lit("ab  ")), strings.trim_chars(F.lit("xxaxx"), "x")) == (2, "a")
    assert one(spark, strings.string_split(F.lit("a|b||c"), "|")) == (["a", "b", "", "c"],)
    assert one(spark, strings.string_split(F.lit("a.b"), ".")) == (["a", "b"],)
    abc = [F.lit(x) for x in "abc"]
    assert one(spark, strings.elt(F.lit(0), *abc), strings.elt(F.lit(2), *abc), strings.elt(F.lit(9), *abc)) == (None, "b", None)
    assert one(spark, strings.field(F.lit("c"), *abc), strings.field(F.lit("z"), *abc)) == (3, 0)
    assert one(spark, strings.set_contains_all(F.lit("x,y"), ["y"]), strings.set_contains_all(F.lit("x,y"), ["z"])) == (True, False)
    assert strings.set_literal(["b", "a", "b"]) == "a,b"
    with pytest.raises(ValueError):
        strings.set_literal(["a,b"])
    assert one(spark, strings.collate(F.lit("Alice"), "Latin1_General_CI_AS") == strings.collate(F.lit("alice"), "Latin1_General_CI_AS")) == (True,)
    assert one(spark, strings.collate(F.lit("Alice"), "Latin1_General_CS_AS") == strings.collate(F.lit("alice"), "Latin1_General_CS_AS")) == (False,)
    with pytest.raises(UnsupportedFeatureError):
        strings.collate(F.lit("a"), "nowhere")
    assert one(spark, strings.format_number(F.lit(1234.5), "N1"), strings.format_number(F.lit(7), "D3")) == ("1,234.5", "007")


def test_dates(spark):
    assert one(spark, datetimes.datediff("year", ts("2023-12-31 23:00:00"), ts("2024-01-01 00:00:00"))) == (1,)
    assert one(spark, datetimes.datediff("month", ts("2024-01-31"), ts("2024-02-01")), datetimes.datediff("day", ts("2024-01-02"), ts("2024-01-01"))) == (1, -1)
    assert str(one(spark, datetimes.dateadd("month", 1, ts("2024-01-31")))[0]) == "2024-02-29 00:00:00"
    assert str(one(spark, datetimes.eomonth(F.lit("2024-01-15"), 1))[0]) == "2024-02-29"
    assert str(one(spark, datetimes.datetrunc("hour", ts("2024-01-01 05:06:07")))[0]) == "2024-01-01 05:00:00"
    with pytest.raises(UnsupportedFeatureError):
        datetimes.datetrunc("eon", ts("2024-01-01"))


def test_numbers(spark):
    assert one(spark, numbers.round_(F.lit(2.5)), numbers.round_(F.lit(-2.5)), numbers.mod(F.lit(-7), F.lit(3))) == (3.0, -3.0, -1)
    assert one(spark, numbers.trunc(F.lit(-2.79), 1), numbers.strict_div(F.lit(7), F.lit(2))) == (-2.7, 3)
    assert one(spark, numbers.bit_xor(F.lit(6), F.lit(3)), numbers.get_bit(F.lit(4), F.lit(2))) == (5, 1)


def test_conditional(spark):
    assert one(spark, conditional.try_cast(F.lit("x1"), "int"), conditional.try_parse(F.lit("1,234"), "int")) == (None, 1234)
    assert str(one(spark, conditional.try_convert(F.lit("31/01/2024"), "date", 103))[0]) == "2024-01-31"
    with pytest.raises(UnsupportedFeatureError):
        conditional.try_parse(F.lit("1"), "int", "fr-FR")


DOC = '{"a":{"b":1},"l":[1,2],"s":"x","n":null}'


def test_json(spark):
    d = F.lit(DOC)
    assert one(spark, json.json_value(d, "$.s"), json.json_value(d, "$.a"), json.json_query(d, "$.a"), json.json_query(d, "$.s")) == ("x", None, '{"b":1}', None)
    assert one(spark, json.json_value(F.lit("{bad"), "$.s"), json.json_value(d, "$.missing")) == (None, None)
    texts = [DOC, "[1]", "3", "{bad", '{"k":1}]', None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(json.isjson(F.col("t"))).collect()
    assert [r[0] for r in got] == [1, 1, 0, 0, 0, None]
    assert one(spark, json.json_contains(F.lit('{"tags":["p","q"]}'), "q", "$.tags")) == (True,)
    assert one(spark, json.json_modify(d, "$.a.b", 5), json.json_remove(F.lit('{"a":1,"b":2}'), "$.a")) == ('{"a":{"b":5},"l":[1,2],"s":"x","n":null}', '{"b":2}')
    assert one(spark, json.json_object(k=F.lit(1), z=F.lit(None).cast("int")), json.json_array(F.lit(1), F.lit(None).cast("int"))) == ('{"k":1,"z":null}', "[1]")
    rows = tables.openjson(spark.createDataFrame([(1, DOC)], "id int, doc string"), "doc", path="$.l").collect()
    assert sorted((r.json_key, r.json_value) for r in rows) == [("0", "1"), ("1", "2")]


def test_fulltext(spark):
    t = F.lit("The quick brown fox jumps")
    got = one(spark, *[fulltext.contains(t, s) for s in ("quick AND fox", "cat OR fox", "cat", '"quick brown"', '"bro*"', "NEAR((quick, jumps), 2)", "NEAR((quick, jumps), 1)")])
    assert got == (True, True, False, True, True, True, False)
    assert one(spark, fulltext.freetext(t, "a fox"), fulltext.freetext(t, "dogs")) == (True, False)


def test_spatial(spark):
    square = "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0))"
    assert one(spark, spatial.st_within(F.lit(1.0), F.lit(1.0), square), spatial.st_within(F.lit(5.0), F.lit(1.0), square)) == (True, False)
    assert one(spark, spatial.st_distance_wkt(F.lit("POINT (0 0)"), F.lit("POINT (3 4)")), spatial.st_x(F.lit("nonsense"))) == (5.0, None)
    assert one(spark, spatial.st_asgeojson(F.lit("POINT (1 2)"))) == ('{"type": "Point", "coordinates": [1.0, 2.0]}',)


def test_merge_rules(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    source = spark.createDataFrame([(2, "B"), (4, "d")], "k int, v string")
    new, out = dml.merge(target, source, ["k"], update_set={"v": F.col("src_v")}, delete_unmatched_when=F.col("v").isNull())
    assert sorted(map(tuple, new.collect())) == [(1, "a"), (2, "B"), (4, "d")]
    assert sorted(r.action for r in out.collect()) == ["DELETE", "INSERT", "UPDATE"]
    twice = source.union(source)
    with pytest.raises(Exception, match="duplicate match"):
        dml.merge(target, twice, ["k"], update_set={"v": F.col("src_v")})[0].collect()


def test_delete_keeps_unknown(spark):
    df = spark.createDataFrame([(1,), (None,)], "v int")
    assert dml.delete(df, F.col("v") > 0)[0].count() == 1


def test_relations(spark):
    owners = spark.createDataFrame([(1, "x"), (2, "y")], "id int, name string")
    posts = spark.createDataFrame([(10, 1), (11, 1), (12, None), (13, 99)], "post int, owner int")
    assert {r.post: r.parent and r.parent.name for r in relations.belongs_to(posts, owners, "owner", "id", "parent").collect()} == {10: "x", 11: "x", 12: None, 13: None}
    assert {r.id: len(r.posts) for r in relations.has_many(owners, posts, "owner", "id", "posts").collect()} == {1: 2, 2: 0}
    assert {r.id: r.first and r.first.post for r in relations.has_one(owners, posts, "owner", "id", "first", "post").collect()} == {1: 10, 2: None}


def test_sources(spark):
    assert tables.split_script("select 1\nGO\nselect 'GO'\n go \n") == ["select 1", "select 'GO'"]
    numbered = tables.next_value(spark.createDataFrame([(c,) for c in "bca"], "c string"), ["c"], 10, 5)
    assert sorted(map(tuple, numbered.collect())) == [("a", 10), ("b", 15), ("c", 20)]
    left, right = one(spark, tables.range_bucket(F.lit(5), [5, 9]), tables.range_bucket(F.lit(5), [5, 9], right=True))
    assert (left, right) == (1, 2)
    assert tables.execute(spark, "select ? as v", ["x'y"]).first()[0] == "x'y"


def test_relational(spark):
    df = spark.range(25)
    assert relational.top_percent(df, 10, "id").count() == 3
    with pytest.raises(ValueError):
        relational.pivot(df, [], "id", [], F.count("id"))
    with pytest.raises(UnsupportedFeatureError):
        relational.set_operation("minus", df, df)


def test_catalog(spark):
    a = spark.createDataFrame([], "x int, y string").schema
    b = spark.createDataFrame([], "y string, x bigint, z date").schema
    assert {(c, n) for c, n, *_ in catalog.schema_diff(a, b)} == {("added", "z"), ("modified", "x"), ("modified", "y")}
    assert [catalog.parse_type(t) for t in ("NVARCHAR(MAX)", "DECIMAL(10,2)", "money", "IMAGE", "DATE")] == ["string", "decimal(10,2)", "decimal(19,4)", "binary", "date"]
    with pytest.raises(ValueError):
        catalog.parse_type("frob")
    assert catalog.plan_summary(spark.range(3).groupBy("id").count())
    assert catalog.capabilities()["merge"] and not catalog.capabilities()["triggers"]


def test_procedures(spark):
    p = routines.Procedures()
    p.add("base")(lambda s: s.range(4))
    p.add("even", "base")(lambda s, base: base.where("id % 2 = 0"))
    assert p.run("even", spark).count() == 2
