"""Scalar functions over the supplied tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import conditional as K
from ..functions import datetimes as D
from ..functions import numbers as N
from ..functions import spatial as G
from ..functions import strings as S
from ..sources.tables import split_rows
from .registry import Tables, query

c = F.col


@query("select c_custkey, length(rtrim(c_name || '  '))::bigint as n, trim(c_name, 'Cr0') as t, upper(c_mktsegment) as u, substring(c_name, 1, 4) as s, replace(c_name, '#', '-') as r, case c_custkey % 4 when 1 then 'a' when 2 then 'b' when 3 then 'c' end as e, coalesce(list_position(['BUILDING', 'MACHINERY'], c_mktsegment), 0)::bigint as f from customer")
def string_funcs(t: Tables) -> DataFrame:
    abc = [F.lit(x) for x in "abc"]
    return t.customer.select("c_custkey", S.len_(F.concat(c("c_name"), F.lit("  "))).cast("long").alias("n"), S.trim_chars(c("c_name"), "Cr0").alias("t"), F.upper("c_mktsegment").alias("u"), F.substring("c_name", 1, 4).alias("s"), F.replace("c_name", F.lit("#"), F.lit("-")).alias("r"), S.elt((c("c_custkey") % 4).cast("int"), *abc).alias("e"), S.field(c("c_mktsegment"), F.lit("BUILDING"), F.lit("MACHINERY")).alias("f"))


@query("select p_partkey, concat_ws('-', p_brand, case when p_size > 25 then p_type end, p_size::varchar) as joined from part")
def concat_ws(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", S.concat_ws("-", c("p_brand"), F.when(c("p_size") > 25, c("p_type")), c("p_size").cast("string")).alias("joined"))


@query("select p_partkey, coalesce(list_position(string_split(tags, ','), 'x2'), 0)::bigint as place, list_has_all(string_split(tags, ','), ['x1', 'x2']) as both from (select p_partkey, 'x' || p_size % 3 || ',x' || p_partkey % 4 as tags from part)")
def find_in_set(t: Tables) -> DataFrame:
    tags = F.concat(F.lit("x"), (c("p_size") % 3).cast("string"), F.lit(",x"), (c("p_partkey") % 4).cast("string"))
    return t.part.select("p_partkey", S.find_in_set(F.lit("x2"), tags).cast("long").alias("place"), S.set_contains_all(tags, ["x1", "x2"]).alias("both"))


@query("select n_nationkey, value, ordinal from (select n_nationkey, unnest(string_split(s, '|')) as value, generate_subscripts(string_split(s, '|'), 1) as ordinal from (select n_nationkey, n_name || '||' || n_regionkey as s from nation))")
def string_split(t: Tables) -> DataFrame:
    rows = t.nation.select("n_nationkey", F.concat("n_name", F.lit("||"), c("n_regionkey").cast("string")).alias("s"))
    return split_rows(rows, "s", "|").select("n_nationkey", "value", "ordinal")


@query("select o_orderkey, strftime(o_orderdate, '%Y/%m/%d') as d, printf('%.2f', o_totalprice) as f, lpad(o_custkey::varchar, greatest(8, length(o_custkey::varchar))::int, '0') as p from orders")
def format_(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", S.format_date(c("o_orderdate"), "yyyy/MM/dd").alias("d"), S.format_number(c("o_totalprice"), "F2").alias("f"), S.format_number(c("o_custkey"), "D8").alias("p"))


@query("select o_orderkey, case when k < 0 then '-' else '' end || repeat('0', greatest(0, 8 - length(abs(k)::varchar))::integer) || abs(k)::varchar as p from (select o_orderkey, o_custkey * 7919 * (case when o_orderkey % 2 = 0 then 1 else -1 end) * (case when o_orderkey % 3 = 0 then 1000 else 1 end) as k from orders)")
def format_digits(t: Tables) -> DataFrame:
    sign, far = F.when(c("o_orderkey") % 2 == 0, 1).otherwise(-1), F.when(c("o_orderkey") % 3 == 0, 1000).otherwise(1)
    return t.orders.select("o_orderkey", S.format_number(c("o_custkey") * 7919 * sign * far, "D8").alias("p"))


@query("select l_orderkey, l_linenumber, round(l_extendedprice, -2) as h, round(power(l_quantity, 1.5), 4) as p, round(sqrt(l_extendedprice), 6) as s, l_orderkey % 7 as m, ceil(l_extendedprice)::bigint as c, floor(l_discount * 10)::bigint as f, round(trunc(l_extendedprice * 10) / 10, 4) as t from lineitem")
def math_funcs(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", N.round_(c("l_extendedprice"), -2).alias("h"), F.round(N.power(c("l_quantity"), F.lit(1.5)), 4).alias("p"), F.round(F.sqrt("l_extendedprice"), 6).alias("s"), N.mod(c("l_orderkey"), F.lit(7)).alias("m"), F.ceil("l_extendedprice").cast("long").alias("c"), F.floor(c("l_discount") * 10).cast("long").alias("f"), F.round(N.trunc(c("l_extendedprice"), 1), 4).alias("t"))


@query("select o_orderkey, bit_count(o_orderkey)::bigint as n, (o_orderkey >> 2) & 1 as b, o_orderkey << 3 as l, o_orderkey >> 1 as r, o_orderkey & o_custkey as a, o_orderkey | o_custkey as o, xor(o_orderkey, o_custkey) as x from orders")
def bit_funcs(t: Tables) -> DataFrame:
    k, u = c("o_orderkey"), c("o_custkey")
    return t.orders.select("o_orderkey", N.bit_count(k).cast("long").alias("n"), N.get_bit(k, F.lit(2)).cast("long").alias("b"), N.left_shift(k, 3).alias("l"), N.right_shift(k, 1).alias("r"), N.bit_and(k, u).alias("a"), N.bit_or(k, u).alias("o"), N.bit_xor(k, u).alias("x"))


@query("select c_custkey, coalesce(nullif(c_nationkey, 3), -1) as k, case when c_acctbal < 0 then c_acctbal end is null as positive from customer")
def null_funcs(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", K.coalesce(K.nullif(c("c_nationkey"), F.lit(3)), F.lit(-1)).alias("k"), F.when(c("c_acctbal") < 0, c("c_acctbal")).isNull().alias("positive"))


@query("select p_partkey, if(p_size > 25, 'big', 'small') as size, case p_size % 5 when 1 then 'a' when 2 then 'b' when 3 then 'c' end as pick from part")
def iif_choose(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", K.iif(c("p_size") > 25, F.lit("big"), F.lit("small")).alias("size"), K.choose(c("p_size") % 5, F.lit("a"), F.lit("b"), F.lit("c")).alias("pick"))


@query("select p_partkey, try_cast(s as integer) as i, try_strptime(d, '%d/%m/%Y')::date as d from (select p_partkey, case when p_partkey % 3 = 0 then 'x' || p_size else p_size::varchar end as s, case when p_partkey % 4 = 0 then '31/02/2024' else (1 + p_size % 28) || '/03/2024' end as d from part)")
def try_cast(t: Tables) -> DataFrame:
    size = c("p_size").cast("string")
    text = F.when(c("p_partkey") % 3 == 0, F.concat(F.lit("x"), size)).otherwise(size)
    day = F.when(c("p_partkey") % 4 == 0, "31/02/2024").otherwise(F.concat(F.lpad((1 + c("p_size") % 28).cast("string"), 2, "0"), F.lit("/03/2024")))
    return t.part.select("p_partkey", K.try_cast(text, "int").alias("i"), K.try_convert(day, "date", 103).alias("d"))


@query("select o_orderkey, last_day(o_orderdate::date) as same, last_day((o_orderdate::date + interval 2 month)::date) as later, make_date(year(o_orderdate), 1, 1) as first from orders")
def eomonth(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", D.eomonth(c("o_orderdate")).alias("same"), D.eomonth(c("o_orderdate"), 2).alias("later"), D.datefromparts(F.year("o_orderdate"), F.lit(1), F.lit(1)).alias("first"))


@query("select l_orderkey, l_linenumber, date_diff('year', o_orderdate, l_shipdate)::integer as y, date_diff('month', o_orderdate, l_shipdate)::integer as m, date_diff('day', o_orderdate, l_shipdate) as d from lineitem join orders on l_orderkey = o_orderkey")
def datediff(t: Tables) -> DataFrame:
    a, b = c("o_orderdate"), c("l_shipdate")
    rows = t.lineitem.join(t.orders, c("l_orderkey") == c("o_orderkey"))
    return rows.select("l_orderkey", "l_linenumber", D.datediff("year", a, b).alias("y"), D.datediff("month", a, b).alias("m"), D.datediff_big("day", a, b).alias("d"))


@query("select o_orderkey, o_orderdate + interval 1 month as m, o_orderdate - interval 36 hour as h from orders")
def dateadd(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", D.dateadd("month", 1, c("o_orderdate")).alias("m"), D.dateadd("hour", -36, c("o_orderdate")).alias("h"))


@query("select event_id, date_trunc('hour', ts)::timestamp as h, date_trunc('month', ts)::timestamp as m from events")
def date_trunc(t: Tables) -> DataFrame:
    return t.events.select("event_id", D.datetrunc("hour", c("ts")).alias("h"), D.datetrunc("month", c("ts")).alias("m"))


@query("select event_id, make_timestamp(2024, 2, 29, 13, 5, 7.25) as t from events")
def datetime_parts(t: Tables) -> DataFrame:
    parts = [F.lit(x) for x in (2024, 2, 29, 13, 5, 7, 2500000)]
    return t.events.select("event_id", D.datetime2fromparts(*parts).alias("t"))


@query("select event_id, make_timestamp(year(ts), month(ts), day(ts), hour(ts), minute(ts), second(ts) + microsecond(ts) % 1000000 / 1e6) as t from events")
def datetime_parts_columns(t: Tables) -> DataFrame:
    ts = c("ts")
    micros = (F.date_format(ts, "SSSSSS").cast("int") * 10).cast("int")
    return t.events.select("event_id", D.datetime2fromparts(F.year(ts), F.month(ts), F.day(ts), F.hour(ts), F.minute(ts), F.second(ts), micros).alias("t"))


@query()
def now_functions(t: Tables) -> DataFrame:
    return t.region.select("r_regionkey", D.now().alias("now"), F.current_date().alias("today"))


@query("select c_custkey from customer where lower(c_mktsegment) = 'building'")
def collate_ci(t: Tables) -> DataFrame:
    return t.customer.where(S.collate(c("c_mktsegment"), "Latin1_General_CI_AS") == S.collate(F.lit("bUILDing"), "Latin1_General_CI_AS")).select("c_custkey")


@query("select p_partkey, round(sqrt(power(p_size - 10, 2) + power(p_retailprice / 100 - 5, 2)), 6) as d from part")
def st_distance(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.round(G.st_distance(c("p_size"), c("p_retailprice") / 100, F.lit(10.0), F.lit(5.0)), 6).alias("d"))


@query("select p_partkey from part where p_size > 5.5 and p_size < 40.5 and p_retailprice / 100 > 9.0537 and p_retailprice / 100 < p_size / 4.0 + 9.0537")
def st_within(t: Tables) -> DataFrame:
    wkt = "POLYGON ((5.5 9.0537, 40.5 9.0537, 40.5 19.1787, 5.5 10.4287, 5.5 9.0537))"
    return t.part.where(G.st_within(c("p_size").cast("double"), c("p_retailprice") / 100, wkt)).select("p_partkey")
