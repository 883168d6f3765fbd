"""Schemas, tables and views, introspection, bulk changes, and what round 1 left out of other areas."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import datetimes as D
from ..functions import fulltext as X
from ..functions import json as J
from ..functions import spatial as G
from ..functions import strings as S
from ..operators import catalog, ddl, dml, relational, routines
from ..sources import tables as T
from .registry import Tables, query

c = F.col
SUPPLIERS = {"k": "bigint", "name": "nvarchar(50)", "nation": "int", "balance": "float"}


def _suppliers(t: Tables) -> DataFrame:
    return t.supplier.select(c("s_suppkey").cast("long").alias("k"), c("s_name").alias("name"), c("s_nationkey").cast("int").alias("nation"), c("s_acctbal").alias("balance"))


@query("""with n as (select count(*)::bigint as n from supplier)
select step, columns, case when step = 'truncated' then 0 else n end::bigint as n from n, (values ('created', 'k,name,nation,balance'), ('added', 'k,name,nation,balance,note'), ('retyped', 'k,name,nation,balance,note'), ('dropped', 'k,name,balance'), ('renamed', 'k,label,balance'), ('truncated', 'k,label,balance')) s(step, columns)""")
def ddl_tables(t: Tables) -> DataFrame:
    spark, schema = t.spark, f"ddl_{uuid.uuid4().hex[:12]}"
    name, steps = f"{schema}.supplier", []

    def note(step: str) -> None:
        detail = catalog.table_detail(spark, name)
        assert step in ("dropped",) or detail["keys"] == ["k"]
        steps.append((step, ",".join(x[1] for x in detail["columns"]), detail["rows"]))

    ddl.create_schema(spark, schema)
    try:
        ddl.create_table(spark, name, SUPPLIERS, keys=["k"])
        _suppliers(t).write.insertInto(name)
        note("created")
        ddl.add_columns(spark, name, {"note": "varchar(10)"})
        note("added")
        ddl.alter_column(spark, name, "nation", "bigint")
        note("retyped")
        ddl.drop_columns(spark, name, ["nation", "note"])
        note("dropped")
        ddl.rename_column(spark, name, "name", "label")
        note("renamed")
        ddl.truncate(spark, name)
        note("truncated")
    finally:
        ddl.drop_schema(spark, schema, cascade=True)
    return T.values(spark, steps, "step string, columns string, n long")


@query("""select 'rich' as name, 'VIEW' as kind, count(*) filter (s_acctbal > 5000)::bigint as n from supplier union all
select 'rich_kept', 'BASE TABLE', count(*) filter (s_acctbal > 5000)::bigint from supplier union all select 'supplier', 'BASE TABLE', count(*)::bigint from supplier""")
def ddl_views(t: Tables) -> DataFrame:
    spark, schema = t.spark, f"ddl_{uuid.uuid4().hex[:12]}"
    ddl.create_schema(spark, schema)
    try:
        T.select_into(_suppliers(t), f"{schema}.supplier")
        ddl.create_view(spark, f"{schema}.rich", f"select * from {schema}.supplier where balance > 0")
        ddl.create_view(spark, f"{schema}.rich", f"select * from {schema}.supplier where balance > 5000", replace=True)
        ddl.materialise(spark, f"{schema}.rich", f"{schema}.rich_kept")
        assert catalog.show(spark, "views", schema).where("not isTemporary").count() == 1 and catalog.show(spark, "tables", schema).where("not isTemporary").count() == 3
        rows = [(name, kind, spark.table(f"{schema}.{name}").count()) for name, kind in catalog.tables(spark, schema)]
    finally:
        ddl.drop_schema(spark, schema, cascade=True)
    return T.values(spark, rows, "name string, kind string, n long")


@query("select s_nationkey::int as nation, count(*)::bigint as n, round(sum(case when s_nationkey < 5 then s_acctbal * 2 else s_acctbal end), 2) as balance from supplier where s_nationkey <> 7 group by 1")
def partition_switch(t: Tables) -> DataFrame:
    spark, schema = t.spark, f"ddl_{uuid.uuid4().hex[:12]}"
    target = f"{schema}.supplier"
    ddl.create_schema(spark, schema)
    try:
        ddl.create_table(spark, target, SUPPLIERS, partition_by=["nation"])
        kept = _suppliers(t).select("k", "name", "balance", "nation")
        kept.write.insertInto(target)
        ddl.switch_partition(spark, kept.where("nation < 5").withColumn("balance", c("balance") * 2), target)
        spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION (nation = 7)")
        # a row for each nation
        rows = spark.table(target).groupBy("nation").agg(F.count("*").alias("n"), F.round(F.sum("balance"), 2).alias("balance")).collect()
    finally:
        ddl.drop_schema(spark, schema, cascade=True)
    return T.values(spark, rows, "nation int, n long, balance double")


@query("select bucket, count(*)::bigint as n from (select case when o_totalprice <= 50000 then 1 when o_totalprice <= 100000 then 2 else 3 end as bucket from orders) group by 1")
def partition_bounds(t: Tables) -> DataFrame:
    bounds = ddl.merge_range(ddl.split_range([50000, 150000], 100000), 150000)
    return t.orders.groupBy(T.range_bucket(c("o_totalprice"), bounds).alias("bucket")).agg(F.count("*").alias("n"))


@query("select * from (values ('removed', 'gone', '', null, null), ('added', 'come', '', null, null), ('removed', 'nation', 'n_name', '1 string null', null), ('added', 'nation', 'n_note', null, '1 string not null')) v(change, table_name, column_name, old, new)")
def schema_diff_tables(t: Tables) -> DataFrame:
    old, new = t.nation.select("n_regionkey", "n_name"), t.nation.select("n_regionkey", F.lit("x").alias("n_note"))
    rows = catalog.diff_tables({"gone": old.schema, "nation": old.schema}, {"come": old.schema, "nation": new.schema})
    return T.values(t.spark, rows, "change string, table_name string, column_name string, old string, new string")


@query("select least(100, count(*))::bigint as n, true as subset from orders")
def tablesample_rows(t: Tables) -> DataFrame:
    sample = T.tablesample_rows(t.orders.select("o_orderkey", "o_custkey"), 100, seed=7)
    known = t.orders.select("o_orderkey", F.lit(True).alias("known"))
    return sample.join(known, "o_orderkey", "left").agg(F.count_distinct("o_orderkey").alias("n"), F.coalesce(F.every(F.coalesce("known", F.lit(False))), F.lit(True)).alias("subset"))


@query("select true as share, true as subset")
def tablesample_percent(t: Tables) -> DataFrame:
    sample = T.tablesample(t.lineitem.select("l_orderkey", "l_linenumber"), 10, seed=42)
    known = t.lineitem.select("l_orderkey", "l_linenumber", F.lit(True).alias("known")).distinct()
    sizes = t.lineitem.agg(F.count("*").alias("all"))
    found = sample.join(known, ["l_orderkey", "l_linenumber"], "left").agg(F.count("*").alias("n"), F.every(F.coalesce("known", F.lit(False))).alias("subset"))
    return found.join(F.broadcast(sizes)).select((c("n") / c("all")).between(0.07, 0.13).alias("share"), "subset")


@query("select o_orderstatus, true as near from orders group by 1")
def approx_distinct_error(t: Tables) -> DataFrame:
    counted = t.orders.groupBy("o_orderstatus").agg(F.approx_count_distinct("o_custkey").alias("a"), F.count_distinct("o_custkey").alias("n"))
    return counted.select("o_orderstatus", (F.abs(c("a") / c("n") - 1) < 0.2).alias("near"))


@query("select r_regionkey, true as now_is_today, 15::bigint as digits from region")
def clock(t: Tables) -> DataFrame:
    return t.region.select("r_regionkey", (F.abs(F.datediff(D.now().cast("date"), F.current_date())) <= 1).alias("now_is_today"), F.length(D.current_time()).cast("long").alias("digits"))


@query("""select o_orderkey, format('{:,}', floor(o_totalprice)::bigint) || printf('.%02d', (round(o_totalprice * 100)::bigint % 100)) as n,
case when o_orderkey % 2 = 0 and o_custkey > 0 then '(¤' || format('{:,}', o_custkey) || '.00)' else '¤' || format('{:,}', o_custkey) || '.00' end as c,
format('{:,}', o_custkey * 100) || '.0 %' as p, lpad(o_custkey::varchar, greatest(6, length(o_custkey::varchar))::int, '0') as z from orders""")
def format_pictures(t: Tables) -> DataFrame:
    price, key = c("o_totalprice").cast("decimal(18,2)"), c("o_custkey").cast("decimal(18,2)")
    sign = F.when(c("o_orderkey") % 2 == 0, -1).otherwise(1)
    return t.orders.select("o_orderkey", S.format_number(price, "#,##0.00").alias("n"), S.format_number(key * sign, "C2").alias("c"), S.format_number(key, "P1").alias("p"), S.format_number(key, "000000.##").alias("z"))


@query("select event_id, strftime(ts, '%H:%M:%S.') || '123456' as t, epoch_us(date_trunc('second', ts)) - 7200000000 + 123456 as o from events")
def time_and_offset_parts(t: Tables) -> DataFrame:
    ts = c("ts")
    parts = [F.hour(ts), F.minute(ts), F.second(ts)]
    day = [F.year(ts), F.month(ts), F.day(ts)]
    t.spark.conf.set("spark.sql.timeType.enabled", "true")  # as the library's own sessions have it
    time = D.timefromparts(*parts, F.lit(1234560), 7)
    return t.events.select("event_id", time.cast("string").alias("t"), F.unix_micros(D.datetimeoffsetfromparts(*day, *parts, "+02:00", F.lit(123456), 6)).alias("o"))


@query("select o_orderkey, (date_diff('day', date '1899-12-31', b) // 7 - date_diff('day', date '1899-12-31', a) // 7)::int as weeks from (select o_orderkey, o_orderdate::date as a, (o_orderdate + to_days((o_orderkey % 40)::int))::date as b from orders)")
def datediff_week(t: Tables) -> DataFrame:
    later = D.dateadd("day", (c("o_orderkey") % 40).cast("int"), c("o_orderdate"))
    return t.orders.select("o_orderkey", D.datediff("week", c("o_orderdate"), later).alias("weeks"))


@query("select c_custkey, '[' || c_custkey || ',\"' || c_mktsegment || '\",' || (c_acctbal > 0) || case when c_custkey % 3 = 0 then '' else ',' || c_nationkey end || ']' as j from customer")
def json_array_mixed(t: Tables) -> DataFrame:
    sometimes = F.when(c("c_custkey") % 3 != 0, c("c_nationkey"))
    return t.customer.select("c_custkey", J.json_array(c("c_custkey"), c("c_mktsegment"), c("c_acctbal") > 0, sometimes).alias("j"))


@query("select c_custkey, '{\"k\":' || c_custkey || '}' as whole, c_nationkey::int as nation from customer")
def openjson_as_json(t: Tables) -> DataFrame:
    item = J.json_object(whole=F.struct(c("c_custkey").alias("k")), nation=c("c_nationkey"))
    docs = t.customer.select("c_custkey", F.concat(F.lit("["), item, F.lit("]")).alias("doc"))
    return T.openjson(docs, "doc", {"whole": ("string", "$.whole"), "nation": ("int", "$.nation")}).drop("doc")


_TOKENS = "list_filter(string_split_regex(lower({}), '[^a-z0-9]+'), lambda x: x <> '')"


@query(f"select doc_id from (select doc_id, ' ' || array_to_string({_TOKENS.format('text')}, ' ') || ' ' as t, {_TOKENS.format('source')} as s from documents where text is not null) where contains(t, ' the and of ') or (contains(t, ' on ') and contains(t, ' er ')) or list_contains(s, 'src3')")
def fulltext_quoted(t: Tables) -> DataFrame:
    either = X.contains_any([c("text")], '"the and of" OR on AND er') | X.contains_any([c("source"), c("lang")], "src3")
    return t.documents.where(c("text").isNotNull() & either).select("doc_id")


@query(f"select doc_id as key, n as rank from (select doc_id, len(list_filter(list_concat({_TOKENS.format('coalesce(text, $$$$)')}, {_TOKENS.format('coalesce(source, $$$$)')}), lambda x: x in ('the', 'src1')))::bigint as n from documents) where n > 0 order by n desc, doc_id limit 20")
def fulltext_ranked_terms(t: Tables) -> DataFrame:
    return X.containstable(t.documents, "doc_id", ["text", "source"], ["the", "SRC1"], 20)


@query("select p_partkey, 'POINT (' || p_size || '.0 ' || -p_size || '.0)' as point, 'POLYGON ((0.0 0.0, ' || p_size || '.0 0.0, 0.0 1.0, 0.0 0.0))' as ring from part")
def wkb_round_trip(t: Tables) -> DataFrame:
    size = c("p_size").cast("string")
    point = F.concat(F.lit("POINT ("), size, F.lit(" -"), size, F.lit(")"))
    ring = F.concat(F.lit("POLYGON ((0 0, "), size, F.lit(" 0, 0 1, 0 0))"))
    return t.part.select("p_partkey", G.st_geomfromwkb(G.st_asbinary(point)).alias("point"), G.st_geomfromwkb(G.st_asbinary(ring)).alias("ring"))


@query("select r_regionkey, p_partkey from part join region on p_size between r_regionkey * 10 and r_regionkey * 10 + 12 and p_partkey % 100 between r_regionkey * 20 and r_regionkey * 20 + 30")
def spatial_join(t: Tables) -> DataFrame:
    points = t.part.select("p_partkey", c("p_size").cast("double").alias("x"), (c("p_partkey") % 100).cast("double").alias("y"))
    r = c("r_regionkey")
    boxes = t.region.select(r, (r * 10).alias("x0"), (r * 20).alias("y0"), (r * 10 + 12).alias("x1"), (r * 20 + 30).alias("y1"))
    return G.spatial_join(points, boxes, "x", "y", ("x0", "y0", "x1", "y1"), 12.0).select("r_regionkey", "p_partkey")


@query("select count(*)::bigint + count(*) filter (s_suppkey % 4 = 0)::bigint as n, round(sum(s_acctbal), 2) as balance, count(*) filter (s_suppkey % 4 = 0)::bigint as created from supplier")
def bulk_create(t: Tables) -> DataFrame:
    new = _suppliers(t).where("k % 4 = 0").select((c("k") + 1000000).alias("k"), "name")
    all_rows, output = dml.bulk_create(_suppliers(t), new, ["k"])
    created = output.agg(F.count("*").alias("created"))
    return all_rows.agg(F.count("*").alias("n"), F.round(F.sum("balance"), 2).alias("balance")).join(F.broadcast(created))


@query("select s_suppkey as k, case when s_suppkey % 3 = 0 then -1.0 else s_acctbal end as balance from supplier")
def bulk_update(t: Tables) -> DataFrame:
    known = _suppliers(t).where("k % 3 = 0").select("k", F.lit(-1.0).alias("balance"))
    unknown = known.select((c("k") + 1000000).alias("k"), "balance")
    return dml.bulk_update(_suppliers(t), known.unionByName(unknown), ["k"])[0].select("k", "balance")


@query("select o_orderkey, o_totalprice * 0.19 as tax, o_totalprice + o_totalprice * 0.19 as gross, year(o_orderdate)::int as y from orders")
def derived_fields(t: Tables) -> DataFrame:
    with_fields = dml.derived(t.orders, {"tax": c("o_totalprice") * 0.19, "gross": c("o_totalprice") + c("tax")})
    return ddl.generated(with_fields.withColumn("y", F.lit(0)), {"y": F.year("o_orderdate")}).select("o_orderkey", "tax", "gross", "y")


@query("select n_nationkey, n_name, n_regionkey from nation where n_regionkey = 1")
def column_mapping(t: Tables) -> DataFrame:
    mapping = {"n_nationkey": "id", "n_name": "label", "n_regionkey": "region"}
    return T.stored(T.renamed(t.nation, mapping).where("region = 1").select("id", "label", "region"), mapping)


@query("select a.o_orderkey, b.o_orderkey as last_key from (select * from orders where o_orderstatus = 'O') a left join lateral (select o_orderkey from orders b where b.o_orderstatus = 'F' and b.o_custkey = a.o_custkey and b.o_orderdate <= a.o_orderdate order by o_orderdate desc, o_orderkey desc limit 1) b on true")
def asof_join(t: Tables) -> DataFrame:
    asks = t.orders.where("o_orderstatus = 'O'").select("o_orderkey", "o_custkey", "o_orderdate")
    last = t.orders.where("o_orderstatus = 'F'").select("o_custkey", c("o_orderdate").alias("since"), c("o_orderkey").alias("last_key"))
    return dml.as_of_join(asks, last, ["o_custkey"], "o_orderdate", "since", "last_key").select("o_orderkey", "last_key")


@query("select s_suppkey, (5 + ((row_number() over (order by s_suppkey) - 1) * 2) % 7)::bigint as v from supplier")
def sequence_cycle(t: Tables) -> DataFrame:
    numbered = T.next_value(t.supplier.select("s_suppkey"), ["s_suppkey"], start=0, name="n")
    return numbered.select("s_suppkey", T.cycled(c("n"), 5, 11, 2).cast("long").alias("v"))


@query("select 3::bigint as n, null::int as a, 'x' as b union all select count(*)::bigint, min(r_regionkey)::int, 'batch' from region where r_regionkey in (1, 3)")
def batch_execute(t: Tables) -> DataFrame:
    t.region.createOrReplaceTempView("batch_regions")
    rows = T.default_values(t.spark, "a int, b string", {"b": "x"}, 3).groupBy("a", "b").agg(F.count("*").alias("n")).select("n", "a", "b")
    found = T.execute_many(t.spark, [(1,), (3,)], "k int", "select count(*) as n, cast(min(r_regionkey) as int) as a, 'batch' as b from batch join batch_regions on r_regionkey = k")
    return rows.unionByName(found)


@query("select c_nationkey, count(*)::bigint as n from customer group by 1")
def hint_parallelism(t: Tables) -> DataFrame:
    return relational.max_parallel(t.customer, 2).groupBy("c_nationkey").agg(F.count("*").alias("n"))


@query("select r_regionkey, r_regionkey::bigint + 1 as v from region")
def function_lifetime(t: Tables) -> DataFrame:
    name = f"plus_one_{uuid.uuid4().hex[:8]}"
    routines.sql_function(t.spark, name, "k bigint", "bigint", "k + 1")
    out = t.region.select("r_regionkey", F.expr(f"{name}(r_regionkey)").alias("v"))
    ddl.drop_function(t.spark, name)
    return out
