"""Grouping, pivots and windows."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import relational as R
from .registry import Tables, query


@query("select l_returnflag, l_linestatus, round(sum(l_quantity), 2) as sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue, count(*)::bigint as n from lineitem where l_shipdate <= timestamp '1998-09-02' group by 1, 2")
def group_by(t: Tables) -> DataFrame:
    rows = t.lineitem.where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count("*").alias("n"))


@query("select o_custkey, count(*)::bigint as n from orders group by 1 having count(*) > 12")
def having(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.count("*").alias("n")).where("n > 12")


@query("select p_brand, min(p_size)::bigint as low, max(p_size)::bigint as high, round(avg(p_retailprice), 2) as mean from part group by 1")
def min_max_avg(t: Tables) -> DataFrame:
    return t.part.groupBy("p_brand").agg(F.min("p_size").cast("long").alias("low"), F.max("p_size").cast("long").alias("high"), F.round(F.avg("p_retailprice"), 2).alias("mean"))


@query("select o_orderpriority, count(distinct o_custkey)::bigint as customers, count(distinct o_orderstatus)::bigint as states from orders group by 1")
def count_distinct(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderpriority").agg(F.count_distinct("o_custkey").alias("customers"), F.count_distinct("o_orderstatus").alias("states"))


@query("select r_name, string_agg(n_name, ';' order by n_name) as nations from nation join region on n_regionkey = r_regionkey group by 1")
def string_agg(t: Tables) -> DataFrame:
    joined = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.groupBy("r_name").agg(F.array_join(F.array_sort(F.collect_list("n_name")), ";").alias("nations"))


@query("select o_orderpriority, count(*) filter (o_orderstatus = 'F')::bigint as finished, round(coalesce(sum(o_totalprice) filter (o_totalprice > 100000), 0), 2) as large from orders group by 1")
def conditional_agg(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderpriority").agg(F.count_if(F.col("o_orderstatus") == "F").alias("finished"), F.round(F.coalesce(F.sum(F.when(F.col("o_totalprice") > 100000, F.col("o_totalprice"))), F.lit(0.0)), 2).alias("large"))


_SALES = "count(*)::bigint as n, round(sum(l_quantity), 2) as qty from lineitem group by"


@query(f"select l_returnflag, l_linestatus, {_SALES} rollup (l_returnflag, l_linestatus)")
def rollup(t: Tables) -> DataFrame:
    return t.lineitem.rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"))


@query(f"select l_returnflag, l_linestatus, {_SALES} cube (l_returnflag, l_linestatus)")
def cube(t: Tables) -> DataFrame:
    return t.lineitem.cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"))


@query("select l_returnflag, l_linestatus, grouping(l_returnflag)::bigint as whole, count(*)::bigint as n, round(sum(l_quantity), 2) as qty from lineitem group by grouping sets ((l_returnflag), (l_linestatus), ())")
def grouping_sets(t: Tables) -> DataFrame:
    return R.grouping_sets(t.lineitem, [["l_returnflag"], ["l_linestatus"], []], F.grouping("l_returnflag").cast("long").alias("whole"), F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"))


@query("select o_orderstatus, bit_and(o_orderkey)::bigint as a, bit_or(o_orderkey)::bigint as o, bit_xor(o_orderkey)::bigint as x from orders group by 1")
def bit_agg(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderstatus").agg(F.bit_and("o_orderkey").alias("a"), F.bit_or("o_orderkey").alias("o"), F.bit_xor("o_orderkey").alias("x"))


@query("""select o_orderpriority, count(*) filter (o_orderstatus = 'F')::bigint as "F", count(*) filter (o_orderstatus = 'O')::bigint as "O", count(*) filter (o_orderstatus = 'P')::bigint as "P" from orders group by 1""")
def pivot(t: Tables) -> DataFrame:
    out = R.pivot(t.orders, ["o_orderpriority"], "o_orderstatus", ["F", "O", "P"], F.count(F.lit(1)))
    return out.na.fill(0)


@query("select p_partkey, name, value from (select p_partkey, 'size' as name, case when p_size > 10 then p_size::double end as value from part union all select p_partkey, 'price', p_retailprice from part) where value is not null")
def unpivot(t: Tables) -> DataFrame:
    wide = t.part.select("p_partkey", F.when(F.col("p_size") > 10, F.col("p_size").cast("double")).alias("size"), F.col("p_retailprice").alias("price"))
    return R.unpivot(wide, ["p_partkey"], ["size", "price"], "name", "value")


@query("select l_returnflag, round(percentile_cont(0.5) within group (order by l_extendedprice), 4) as middle from lineitem group by 1")
def ordered_set_agg(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(F.round(F.percentile("l_extendedprice", 0.5), 4).alias("middle"))


@query()
def approx_distinct(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderstatus").agg(F.approx_count_distinct("o_custkey").alias("customers"))


_W = "over (partition by o_custkey order by o_orderdate, o_orderkey"


def _w() -> Window:
    return Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")


@query("select c_custkey, row_number() over w::bigint as rn, rank() over v::bigint as rk, dense_rank() over v::bigint as dr, round(percent_rank() over v, 6) as pr, round(cume_dist() over v, 6) as cd from customer window w as (partition by c_nationkey order by c_acctbal, c_custkey), v as (partition by c_nationkey order by round(c_acctbal / 1000))")
def ranking(t: Tables) -> DataFrame:
    w, v = Window.partitionBy("c_nationkey").orderBy("c_acctbal", "c_custkey"), Window.partitionBy("c_nationkey").orderBy(F.round(F.col("c_acctbal") / 1000))
    return t.customer.select("c_custkey", F.row_number().over(w).cast("long").alias("rn"), F.rank().over(v).cast("long").alias("rk"), F.dense_rank().over(v).cast("long").alias("dr"), F.round(F.percent_rank().over(v), 6).alias("pr"), F.round(F.cume_dist().over(v), 6).alias("cd"))


@query("select c_custkey, ntile(4) over (partition by c_mktsegment order by c_acctbal, c_custkey)::bigint as quarter from customer")
def ntile(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", F.ntile(4).over(Window.partitionBy("c_mktsegment").orderBy("c_acctbal", "c_custkey")).cast("long").alias("quarter"))


@query(f"select o_orderkey, lag(o_totalprice) {_W}) as before, lead(o_totalprice, 2, -1.0) {_W}) as later from orders")
def lag_lead(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.lag("o_totalprice").over(_w()).alias("before"), F.lead("o_totalprice", 2, -1.0).over(_w()).alias("later"))


@query(f"select o_orderkey, first_value(o_orderkey) {_W} {{0}}) as first, last_value(o_orderkey) {_W} {{0}}) as last, nth_value(o_orderkey, 2) {_W} {{0}}) as second from orders".format("rows between unbounded preceding and unbounded following"))
def first_last(t: Tables) -> DataFrame:
    w = _w().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return t.orders.select("o_orderkey", F.first("o_orderkey").over(w).alias("first"), F.last("o_orderkey").over(w).alias("last"), F.nth_value("o_orderkey", 2).over(w).alias("second"))


@query(f"select o_orderkey, round(sum(o_totalprice) {_W} rows unbounded preceding), 2) as total from orders")
def running_sum(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.round(F.sum("o_totalprice").over(_w().rowsBetween(Window.unboundedPreceding, 0)), 2).alias("total"))


@query(f"select o_orderkey, round(avg(o_totalprice) {_W} rows between 2 preceding and current row), 4) as mean from orders")
def moving_avg(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.round(F.avg("o_totalprice").over(_w().rowsBetween(-2, 0)), 4).alias("mean"))


@query("select l_orderkey, l_linenumber, count(*) over (partition by l_returnflag, l_partkey order by l_quantity range between 5 preceding and 5 following)::bigint as near from lineitem")
def range_frame(t: Tables) -> DataFrame:
    w = Window.partitionBy("l_returnflag", "l_partkey").orderBy("l_quantity").rangeBetween(-5, 5)
    return t.lineitem.select("l_orderkey", "l_linenumber", F.count("*").over(w).alias("near"))


@query("select o_orderkey, round(o_totalprice / sum(o_totalprice) over (partition by o_custkey), 6) as share from orders")
def window_aggregate(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.round(F.col("o_totalprice") / F.sum("o_totalprice").over(Window.partitionBy("o_custkey")), 6).alias("share"))


@query("select c_custkey, c_nationkey, c_acctbal from customer qualify row_number() over (partition by c_nationkey order by c_acctbal desc, c_custkey) <= 3")
def top_n_per_group(t: Tables) -> DataFrame:
    return R.top_per_group(t.customer, ["c_nationkey"], 3, F.desc("c_acctbal"), F.col("c_custkey")).select("c_custkey", "c_nationkey", "c_acctbal")
