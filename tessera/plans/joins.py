"""Joins, apply and relations."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import relational as R
from ..operators.relations import belongs_to, has_many, has_one
from .registry import Tables, query


@query("""select n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue, rank() over (order by round(sum(l_extendedprice * (1 - l_discount)), 2) desc)::bigint as place
from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
where r_name = 'ASIA' group by n_name order by revenue desc, n_name limit 10""")
def flagship(t: Tables) -> DataFrame:
    nations = t.nation.join(t.region.where("r_name = 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"))
    sales = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    revenue = sales.groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))
    return revenue.withColumn("place", F.rank().over(Window.orderBy(F.desc("revenue"))).cast("long")).orderBy(F.desc("revenue"), "n_name").limit(10)


@query("select o_orderkey, c_name from orders join customer on o_custkey = c_custkey where o_totalprice > 200000")
def inner_join(t: Tables) -> DataFrame:
    return R.join(t.orders.where("o_totalprice > 200000"), t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")


@query("select c_custkey, count(o_orderkey)::bigint as n_orders from customer left join orders on o_custkey = c_custkey group by c_custkey")
def left_join(t: Tables) -> DataFrame:
    return R.join(t.customer, t.orders, F.col("o_custkey") == F.col("c_custkey"), "left").groupBy("c_custkey").agg(F.count("o_orderkey").alias("n_orders"))


@query("select n_name, s_suppkey from (select * from supplier where s_acctbal < 1000) s right join nation on s_nationkey = n_nationkey")
def right_join(t: Tables) -> DataFrame:
    return R.join(t.supplier.where("s_acctbal < 1000"), t.nation, F.col("s_nationkey") == F.col("n_nationkey"), "right").select("n_name", "s_suppkey")


@query("select c_custkey, s_suppkey from (select * from customer where c_acctbal < 500) c full join (select * from supplier where s_acctbal < 2000) s on c_custkey = s_suppkey")
def full_join(t: Tables) -> DataFrame:
    return R.join(t.customer.where("c_acctbal < 500"), t.supplier.where("s_acctbal < 2000"), F.col("c_custkey") == F.col("s_suppkey"), "full").select("c_custkey", "s_suppkey")


@query("select r_name, n_name from region cross join nation")
def cross_join(t: Tables) -> DataFrame:
    return t.region.select("r_name").crossJoin(t.nation.select("n_name"))


@query("select a.n_name as n1, b.n_name as n2 from nation a join nation b on a.n_regionkey = b.n_regionkey and a.n_nationkey < b.n_nationkey")
def self_join(t: Tables) -> DataFrame:
    a, b = t.nation.alias("a"), t.nation.alias("b")
    return a.join(b, (F.col("a.n_regionkey") == F.col("b.n_regionkey")) & (F.col("a.n_nationkey") < F.col("b.n_nationkey"))).select(F.col("a.n_name").alias("n1"), F.col("b.n_name").alias("n2"))


@query("select c_custkey from customer where exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'F')")
def semi_join(t: Tables) -> DataFrame:
    return t.customer.join(t.orders.where("o_orderstatus = 'F'"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("c_custkey")


@query("select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey)")
def anti_join(t: Tables) -> DataFrame:
    return t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey")


@query("select c_custkey, o_orderkey, o_totalprice from (select c_custkey, o_orderkey, o_totalprice, row_number() over (partition by c_custkey order by o_totalprice desc, o_orderkey) as n from customer join orders on o_custkey = c_custkey) where n <= 2")
def cross_apply(t: Tables) -> DataFrame:
    best = t.orders.where(F.col("o_custkey") == F.col("c_custkey").outer()).orderBy(F.desc("o_totalprice"), "o_orderkey").limit(2).select("o_orderkey", "o_totalprice")
    return R.cross_apply(t.customer.select("c_custkey"), best)


@query("select c_custkey, o_orderkey from (select c_custkey, o_orderkey, row_number() over (partition by c_custkey order by o_orderdate desc, o_orderkey) as n from customer left join orders on o_custkey = c_custkey) where n = 1")
def outer_apply(t: Tables) -> DataFrame:
    last = t.orders.where(F.col("o_custkey") == F.col("c_custkey").outer()).orderBy(F.desc("o_orderdate"), "o_orderkey").limit(1).select("o_orderkey")
    return R.outer_apply(t.customer.select("c_custkey"), last)


@query("select l_returnflag, count(*)::bigint as n from lineitem join orders on l_orderkey = o_orderkey group by 1")
def join_hints(t: Tables) -> DataFrame:
    return R.join(t.lineitem, t.orders, F.col("l_orderkey") == F.col("o_orderkey"), hint="merge").groupBy("l_returnflag").agg(F.count("*").alias("n"))


_CHILD = "(select o_orderkey, case when o_orderkey % 7 = 0 then null when o_orderkey % 11 = 0 then 999999999 else o_custkey end as owner from orders)"


@query(f"select o_orderkey, c_name as owner_name from {_CHILD} left join customer on owner = c_custkey")
def relation_belongs_to(t: Tables) -> DataFrame:
    owner = F.when(F.col("o_orderkey") % 7 == 0, F.lit(None)).when(F.col("o_orderkey") % 11 == 0, 999999999).otherwise(F.col("o_custkey")).alias("owner")
    return belongs_to(t.orders.select("o_orderkey", owner), t.customer, "owner", "c_custkey", "parent").select("o_orderkey", F.col("parent.c_name").alias("owner_name"))


@query("select c_custkey, min(o_orderkey) as first_order from customer left join orders on o_custkey = c_custkey group by 1")
def relation_has_one(t: Tables) -> DataFrame:
    return has_one(t.customer, t.orders, "o_custkey", "c_custkey", "child", "o_orderkey").select("c_custkey", F.col("child.o_orderkey").alias("first_order"))


@query("select conv_id, count(*)::bigint as n_turns, string_agg(role || ':' || strlen(text), ',' order by turn) as turns from conversations group by 1")
def relation_conversations(t: Tables) -> DataFrame:
    ids = t.conversations.select("conv_id").distinct()
    child = t.conversations.select(F.col("turn"), F.col("conv_id").alias("owner"), "role", F.octet_length("text").alias("bytes"))
    loaded = has_many(ids, child, "owner", "conv_id", "all")
    return loaded.select("conv_id", F.size("all").cast("long").alias("n_turns"), F.array_join(F.transform("all", lambda x: F.concat(x["role"], F.lit(":"), x["bytes"].cast("string"))), ",").alias("turns"))


@query("""select n_name, count(distinct c_custkey)::bigint as customers, coalesce(string_agg(o_orderkey::varchar, ',' order by c_custkey, o_orderkey) filter (o_orderkey is not null), '') as orders
from nation left join customer on c_nationkey = n_nationkey left join orders on o_custkey = c_custkey and o_totalprice > 300000 group by n_name""")
def eager_load(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    loaded = has_many(t.customer.select("c_custkey", "c_nationkey"), orders, "o_custkey", "c_custkey", "orders", F.col("o_totalprice") > 300000)
    nested = has_many(t.nation, loaded, "c_nationkey", "n_nationkey", "customers")
    keys = F.flatten(F.transform("customers", lambda c: F.transform(c["orders"], lambda o: o["o_orderkey"].cast("string"))))
    return nested.select("n_name", F.size("customers").cast("long").alias("customers"), F.array_join(keys, ",").alias("orders"))
