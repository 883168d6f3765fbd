"""Projection, predicates, paging, set operations and common table expressions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import relational as R
from ..sources import tables as S
from .registry import Tables, query


@query("select c_custkey as id, upper(c_name) as name, c_acctbal * 2 as doubled from customer where c_acctbal between 0 and 5000 and c_mktsegment in ('BUILDING', 'MACHINERY') and c_name like '%1%' and not c_nationkey = 3")
def predicates(t: Tables) -> DataFrame:
    c = F.col
    rows = t.customer.where(c("c_acctbal").between(0, 5000) & c("c_mktsegment").isin("BUILDING", "MACHINERY") & c("c_name").like("%1%") & ~(c("c_nationkey") == 3))
    return rows.select(c("c_custkey").alias("id"), F.upper("c_name").alias("name"), (c("c_acctbal") * 2).alias("doubled"))


@query("select * from nation")
def wildcard(t: Tables) -> DataFrame:
    return t.nation.select("*")


@query("select distinct o_orderstatus, o_orderpriority from orders")
def distinct_(t: Tables) -> DataFrame:
    return t.orders.select("o_orderstatus", "o_orderpriority").distinct()


@query("select p_partkey, case when p_size < 15 then 'small' when p_size < 35 then 'middle' else 'large' end as class from part")
def case_when(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.when(F.col("p_size") < 15, "small").when(F.col("p_size") < 35, "middle").otherwise("large").alias("class"))


@query("select c_custkey from customer where c_acctbal > (select avg(c_acctbal) from customer)")
def scalar_subquery(t: Tables) -> DataFrame:
    return t.customer.where(F.col("c_acctbal") > t.customer.select(F.avg("c_acctbal")).scalar()).select("c_custkey")


@query("select o_orderkey from orders where o_custkey = 7 or o_orderstatus is null or o_orderpriority ilike '1-URGENT'")
def bound_parameters(t: Tables) -> DataFrame:
    t.orders.createOrReplaceTempView("bound_orders")
    return S.execute(t.spark, "select o_orderkey from bound_orders where o_custkey = ? or o_orderstatus is null or o_orderpriority ilike ?", [7, "1-urgent"])


@query("select * from (values (1, 'a'), (2, 'b'), (3, null)) v(id, name)")
def values_source(t: Tables) -> DataFrame:
    return S.values(t.spark, [(1, "a"), (2, "b"), (3, None)], "id int, name string")


@query("select o_orderkey, o_totalprice from orders order by o_totalprice desc nulls last, o_orderkey limit 10 offset 20")
def offset_fetch(t: Tables) -> DataFrame:
    return R.page(t.orders.orderBy(F.desc_nulls_last("o_totalprice"), "o_orderkey"), 20, 10).select("o_orderkey", "o_totalprice")


@query("select n_name from nation order by n_name offset 20")
def offset_only(t: Tables) -> DataFrame:
    return R.page(t.nation.select("n_name").orderBy("n_name"), 20)


@query("select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 15")
def top_n(t: Tables) -> DataFrame:
    return R.top(t.orders.select("o_orderkey", "o_totalprice"), 15, F.desc("o_totalprice"), F.col("o_orderkey"))


@query("select s_suppkey from (select s_suppkey, row_number() over (order by s_acctbal desc, s_suppkey desc) as n, count(*) over () as c from supplier) where n <= ceil(c * 0.1)")
def top_percent(t: Tables) -> DataFrame:
    return R.top_percent(t.supplier, 10, "s_acctbal", "s_suppkey").select("s_suppkey")


@query("select c_nationkey as k from customer union select s_nationkey from supplier")
def union(t: Tables) -> DataFrame:
    return R.set_operation("union", t.customer.select(F.col("c_nationkey").alias("k")), t.supplier.select("s_nationkey"))


@query("select c_nationkey as k from customer union all select s_nationkey from supplier")
def union_all(t: Tables) -> DataFrame:
    return R.set_operation("union", t.customer.select(F.col("c_nationkey").alias("k")), t.supplier.select("s_nationkey"), True)


@query("select c_nationkey as k from customer where c_acctbal > 9000 intersect select s_nationkey from supplier where s_acctbal > 5000")
def intersect(t: Tables) -> DataFrame:
    return R.set_operation("intersect", t.customer.where("c_acctbal > 9000").select(F.col("c_nationkey").alias("k")), t.supplier.where("s_acctbal > 5000").select("s_nationkey"))


@query("select c_nationkey as k from customer except select s_nationkey from supplier where s_acctbal > 5000")
def except_(t: Tables) -> DataFrame:
    return R.set_operation("except", t.customer.select(F.col("c_nationkey").alias("k")), t.supplier.where("s_acctbal > 5000").select("s_nationkey"))


@query("select c_nationkey as k from customer except all select s_nationkey from supplier")
def except_all(t: Tables) -> DataFrame:
    return R.set_operation("except", t.customer.select(F.col("c_nationkey").alias("k")), t.supplier.select("s_nationkey"), True)


@query("select c_nationkey as k from customer intersect all select s_nationkey from supplier")
def intersect_all(t: Tables) -> DataFrame:
    return R.set_operation("intersect", t.customer.select(F.col("c_nationkey").alias("k")), t.supplier.select("s_nationkey"), True)


@query("select name from (select n_name as name from nation union select r_name from region) order by name limit 7 offset 2")
def union_ordered(t: Tables) -> DataFrame:
    both = R.set_operation("union", t.nation.select(F.col("n_name").alias("name")), t.region.select("r_name"))
    return R.page(both.orderBy("name"), 2, 7)


@query("with big as (select o_custkey, sum(o_totalprice) as total from orders group by 1), named as (select c_mktsegment, total from big join customer on c_custkey = o_custkey) select c_mktsegment, round(max(total), 2) as most from named group by 1")
def cte(t: Tables) -> DataFrame:
    big = t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total"))
    named = big.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).select("c_mktsegment", "total")
    return named.groupBy("c_mktsegment").agg(F.round(F.max("total"), 2).alias("most"))


@query("with recursive tree as (select n_nationkey as id, 0 as depth, n_name as path from nation where n_nationkey = 1 union all select n_nationkey, depth + 1, path || '/' || n_name from nation join tree on n_nationkey // 2 = id where n_nationkey > 1) select id, depth, path from tree")
def recursive_cte(t: Tables) -> DataFrame:
    t.nation.createOrReplaceTempView("tree_nodes")
    return t.spark.sql("with recursive tree as (select n_nationkey as id, 0 as depth, n_name as path from tree_nodes where n_nationkey = 1 union all select n_nationkey, depth + 1, path || '/' || n_name from tree_nodes join tree on n_nationkey div 2 = id where n_nationkey > 1) select id, depth, path from tree")


@query("select s_suppkey, (99 + row_number() over (order by s_suppkey))::bigint as next_value from supplier")
def sequence(t: Tables) -> DataFrame:
    return S.next_value(t.supplier, ["s_suppkey"], start=100).select("s_suppkey", "next_value")


@query()
def tablesample(t: Tables) -> DataFrame:
    return S.tablesample(t.orders, 10, seed=42)


@query("select bucket, count(*)::bigint as n from (select case when o_totalprice <= 50000 then 1 when o_totalprice <= 150000 then 2 else 3 end as bucket from orders) group by 1")
def range_partition(t: Tables) -> DataFrame:
    return t.orders.groupBy(S.range_bucket(F.col("o_totalprice"), [50000, 150000]).alias("bucket")).agg(F.count("*").alias("n"))
