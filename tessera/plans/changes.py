"""Snapshot changes, history, routines and introspection."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import catalog, dml, routines
from .registry import Tables, query

c = F.col


@query("select s_suppkey + 1000000 as s_suppkey, s_name, s_nationkey, s_acctbal from supplier where s_nationkey = 1")
def insert_output(t: Tables) -> DataFrame:
    new = t.supplier.where("s_nationkey = 1").withColumn("s_suppkey", c("s_suppkey") + 1000000)
    return dml.insert(t.supplier, new)[1]


@query("select c_custkey, case when c_acctbal < 0 then 0.0 else c_acctbal end as c_acctbal from customer")
def update(t: Tables) -> DataFrame:
    return dml.update(t.customer, {"c_acctbal": F.lit(0.0)}, c("c_acctbal") < 0)[0].select("c_custkey", "c_acctbal")


@query("select c_custkey as deleted_c_custkey, c_acctbal as deleted_c_acctbal, round(c_acctbal + 10, 2) as inserted_c_acctbal from customer where c_nationkey = 5")
def update_output(t: Tables) -> DataFrame:
    out = dml.update(t.customer, {"c_acctbal": F.round(c("c_acctbal") + 10, 2)}, c("c_nationkey") == 5)[1]
    return out.select("deleted_c_custkey", "deleted_c_acctbal", "inserted_c_acctbal")


@query("select p_partkey from part where not coalesce(nullif(p_size, 7) > 40, false)")
def delete(t: Tables) -> DataFrame:
    return dml.delete(t.part, F.nullif(c("p_size"), F.lit(7)) > 40)[0].select("p_partkey")


_SOURCE = "(select s_suppkey as k, round(s_acctbal * 2, 2) as b from supplier where s_suppkey % 2 = 0 union all select s_suppkey + 500000, 1.0 from supplier where s_suppkey % 5 = 0)"


def _source(t: Tables) -> DataFrame:
    old = t.supplier.where("s_suppkey % 2 = 0").select(c("s_suppkey").alias("k"), F.round(c("s_acctbal") * 2, 2).alias("b"))
    return old.unionByName(t.supplier.where("s_suppkey % 5 = 0").select((c("s_suppkey") + 500000).alias("k"), F.lit(1.0).alias("b")))


@query(f"""select coalesce(t.k, s.k) as k, coalesce(s.b, t.b) as b from (select s_suppkey as k, s_acctbal as b from supplier) t full join {_SOURCE} s on t.k = s.k where not (t.k is not null and s.k is not null and s.b < 0)""")
def merge(t: Tables) -> DataFrame:
    target = t.supplier.select(c("s_suppkey").alias("k"), c("s_acctbal").alias("b"))
    return dml.merge(target, _source(t), ["k"], update_set={"b": c("src_b")}, delete_when=c("src_b") < 0)[0]


@query(f"""select case when t.k is null then 'INSERT' when s.b < 0 then 'DELETE' else 'UPDATE' end as action, count(*)::bigint as n from (select s_suppkey as k from supplier) t right join {_SOURCE} s on t.k = s.k group by 1""")
def merge_output(t: Tables) -> DataFrame:
    target = t.supplier.select(c("s_suppkey").alias("k"), c("s_acctbal").alias("b"))
    return dml.merge(target, _source(t), ["k"], update_set={"b": c("src_b")}, delete_when=c("src_b") < 0)[1].groupBy("action").agg(F.count("*").alias("n"))


@query(f"select coalesce(t.k, s.k) as k, coalesce(s.b, t.b) as b from (select s_suppkey as k, s_acctbal as b from supplier) t full join {_SOURCE} s on t.k = s.k")
def upsert(t: Tables) -> DataFrame:
    return dml.upsert(t.supplier.select(c("s_suppkey").alias("k"), c("s_acctbal").alias("b")), _source(t), ["k"])


@query("select o_orderkey from orders where o_orderkey % 10 <> 3")
def soft_delete(t: Tables) -> DataFrame:
    marked = t.orders.withColumn("deleted_at", F.when(c("o_orderkey") % 10 == 3, c("o_orderdate")))
    return dml.alive(marked).select("o_orderkey")


@query("select count(*)::bigint as rows, count(*) filter (version = 2)::bigint as applied from (select p_partkey, case when p_partkey % 2 = 0 then 2 else 1 end as version from part)")
def optimistic_lock(t: Tables) -> DataFrame:
    stored = t.part.select("p_partkey", "p_size", F.lit(1).alias("version"))
    wanted = t.part.select("p_partkey", (c("p_size") + 1).alias("p_size"), F.when(c("p_partkey") % 2 == 0, 1).otherwise(0).alias("version"))
    return dml.optimistic_update(stored, wanted, ["p_partkey"])[0].agg(F.count("*").alias("rows"), F.count_if(c("version") == 2).alias("applied"))


@query("select o_custkey, o_orderkey, o_totalprice from (select *, lead(o_orderdate) over (partition by o_custkey order by o_orderdate, o_orderkey) as valid_to from orders) where o_orderdate <= timestamp '1996-01-01' and (valid_to is null or timestamp '1996-01-01' < valid_to)")
def asof_temporal(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    history = t.orders.withColumn("valid_from", c("o_orderdate")).withColumn("valid_to", F.lead("o_orderdate").over(w))
    return dml.as_of(history, F.lit("1996-01-01").cast("timestamp_ntz")).select("o_custkey", "o_orderkey", "o_totalprice")


@query("select 'unpriced' as rule, count(*) filter (p_retailprice <= 0)::bigint as broken from part union all select 'oversize', count(*) filter (p_size > 45)::bigint from part")
def check_constraints(t: Tables) -> DataFrame:
    return dml.check_rules(t.part, {"unpriced": c("p_retailprice") > 0, "oversize": c("p_size") <= 45})


@query("select o_orderkey, round(o_totalprice * 1.19, 6) as gross, round(o_totalprice * 0.9, 4) as net from orders")
def scalar_udf(t: Tables) -> DataFrame:
    routines.sql_function(t.spark, "gross_price", "price DOUBLE", "DOUBLE", "round(price * 1.19, 6)")
    net = routines.vector_function("double")(lambda price: (price * 0.9).round(6))
    return t.orders.select("o_orderkey", F.expr("gross_price(o_totalprice)").alias("gross"), F.round(net("o_totalprice"), 4).alias("net"))


@query("select p_brand, round(exp(avg(ln(p_retailprice))), 4) as middle from part where p_retailprice > 0 group by 1")
def aggregate_udf(t: Tables) -> DataFrame:
    return t.part.groupBy("p_brand").agg(F.round(routines.geometric_mean(c("p_retailprice")), 4).alias("middle"))


@query("select r_regionkey, r_regionkey * 10 + i as v from region, (values (1), (2)) x(i)")
def table_udf(t: Tables) -> DataFrame:
    t.region.createOrReplaceTempView("udf_regions")
    t.spark.sql("create or replace temporary function tens(k int) returns table (v int) return select k * 10 + i from values (1), (2) as x(i)")
    return t.spark.sql("select r_regionkey, v from udf_regions, lateral tens(r_regionkey)")


_SPARK_TYPES = "map {'BIGINT': 'bigint', 'INTEGER': 'int', 'DOUBLE': 'double', 'VARCHAR': 'string', 'TIMESTAMP': 'timestamp_ntz'}"


@query(f"select table_name, column_index::int as ordinal, column_name, {_SPARK_TYPES}[data_type] as data_type, true as nullable from duckdb_columns() where table_name in ('region', 'nation', 'orders') and schema_name = 'main'")
def introspect_columns(t: Tables) -> DataFrame:
    return catalog.columns_table(t.spark, {n: getattr(t, n) for n in ("region", "nation", "orders")})


@query()
def schema_diff(t: Tables) -> DataFrame:
    rows = catalog.schema_diff(t.nation.schema, t.nation.drop("n_name").withColumn("n_note", F.lit("x")).schema)
    return t.spark.createDataFrame(rows, "change string, column_name string, old string, new string")


@query()
def explain(t: Tables) -> DataFrame:
    plan = catalog.plan_summary(t.orders.join(t.customer, c("o_custkey") == c("c_custkey")).groupBy("c_nationkey").count())
    return t.spark.createDataFrame(list(plan.items()), "operator string, n int")
