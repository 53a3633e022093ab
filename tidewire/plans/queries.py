"""Registered queries and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules
from ..operators import qexpr, relational, tables
from ..streaming import windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    spark.conf.set("spark.sql.timeType.enabled", "true")
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# -- the wire format: encode, then decode -----------------------------------------------------

for _t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
    query(f"roundtrip_{_t}", f"SELECT * FROM {_t}")(lambda s, d, t=_t: tables.roundtrip(read(s, d, t)))


@query("nested_prices", "SELECT vec_id, embedding[1] AS first, embedding[64] AS last, len(embedding) AS n, label FROM embeddings")
def nested_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = tables.roundtrip(read(spark, sf_dir, "embeddings"))
    return back.select("vec_id", F.element_at("embedding", 1).alias("first"), F.element_at("embedding", 64).alias("last"), F.size("embedding").cast("long").alias("n"), "label")


@query("compressed_roundtrip", "SELECT n_nationkey, n_name, n_regionkey, c_custkey FROM nation JOIN customer ON n_nationkey = c_nationkey")
def compressed_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "customer"), F.col("n_nationkey") == F.col("c_nationkey")).select("n_nationkey", "n_name", "n_regionkey", "c_custkey")
    return tables.roundtrip(both, compressed=True, symbols=("n_name",))


@query("message_sizes", "SELECT count(*) AS n_rows, CAST(sum(length(l_returnflag) + 1 + 8) AS BIGINT) AS n_bytes FROM lineitem")
def message_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of update messages beyond the 80 that each has without rows: a symbol with its end, and a float."""
    rows = read(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity")
    sent = tables.encode_messages(rows, "async", target="lineitem", symbols=("l_returnflag",))
    return sent.agg(F.sum("n_rows").alias("n_rows"), F.sum(F.length("payload") - 80).alias("n_bytes"))


@query("update_rows", "SELECT l_returnflag, count(*) AS n_rows FROM lineitem GROUP BY 1")
def update_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of update messages by a symbol column, counted after decoding."""
    rows = read(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity")
    sent = tables.encode_messages(rows, "async", target="lineitem", symbols=("l_returnflag",))
    return tables.decode_messages(sent, rows.schema).groupBy("l_returnflag").agg(F.count("*").alias("n_rows"))


@query("symbol_string", "SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN '' ELSE c_name END AS name FROM customer")
def symbol_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("c_custkey") % 7 != 0, F.col("c_name")).alias("name")
    return tables.roundtrip(read(spark, sf_dir, "customer").select("c_custkey", name), symbols=("name",))


@query("guid_hex", "SELECT o_orderkey, substring(h, 1, 8) || '-' || substring(h, 9, 4) || '-' || substring(h, 13, 4) || '-' || substring(h, 17, 4) || '-' || substring(h, 21, 12) AS guid FROM (SELECT o_orderkey, md5(CAST(o_orderkey AS VARCHAR)) AS h FROM orders)")
def guid_hex(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = read(spark, sf_dir, "orders").select("o_orderkey", F.unhex(F.md5(F.col("o_orderkey").cast("string"))).alias("g"))
    return tables.roundtrip(raw).select("o_orderkey", rules.guid_text(F.col("g")).alias("guid"))


# -- nulls, infinities and epochs -------------------------------------------------------------

_MARK = {"short": ("smallint", -(1 << 15), (1 << 15) - 1), "int": ("int", -(1 << 31), (1 << 31) - 1), "long": ("bigint", -(1 << 63), (1 << 63) - 1)}


def _marked(kind: str, key: str):
    low, high = _MARK[kind][1:]
    at = F.col(key) % 5
    return F.when(at == 0, F.lit(low)).when(at == 1, F.lit(low + 1)).when(at == 2, F.lit(high)).otherwise(F.col(key) % 1000).cast(_MARK[kind][0])


for _k in _MARK:
    query(f"null_{_k}", f"SELECT p_partkey, CAST(CASE WHEN p_partkey % 5 < 3 THEN NULL ELSE p_partkey % 1000 END AS {_MARK[_k][0]}) AS v FROM part")(
        lambda s, d, k=_k: tables.roundtrip(read(s, d, "part").select("p_partkey", _marked(k, "p_partkey").alias("v")))
    )
    query(f"rule_null_{_k}", SQL[f"null_{_k}"])(lambda s, d, k=_k: read(s, d, "part").select("p_partkey", rules.integer(_marked(k, "p_partkey"), k).alias("v")))


@query("nested_long_keeps_inf", "SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 5 = 1 THEN -9223372036854775807 WHEN p_partkey % 5 = 2 THEN 9223372036854775807 ELSE p_partkey % 1000 END AS inner_v, p_partkey AS second FROM part")
def nested_long_keeps_inf(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "part").select("p_partkey", F.array(_marked("long", "p_partkey"), "p_partkey").alias("v"))
    back = tables.roundtrip(rows)
    return back.select("p_partkey", F.element_at("v", 1).alias("inner_v"), F.element_at("v", 2).alias("second"))


@query("null_float", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN NULL WHEN p_partkey % 3 = 1 THEN 'Infinity'::DOUBLE ELSE p_retailprice END AS v FROM part")
def null_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("p_partkey") % 3
    v = F.when(at == 0, F.lit(float("nan"))).when(at == 1, F.lit(float("inf"))).otherwise(F.col("p_retailprice"))
    return tables.roundtrip(read(spark, sf_dir, "part").select("p_partkey", v.alias("v")))


@query("epoch_date", "SELECT p_partkey, DATE '2000-01-01' + CAST(p_partkey AS INTEGER) AS day FROM part")
def epoch_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_partkey", rules.epoch_date(F.col("p_partkey").cast("int")).alias("day"))


@query("wire_dates", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")
def wire_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.roundtrip(read(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day")))


@query("wire_times", "SELECT event_id, CAST(epoch_us(ts) % 86400000000 // 1000 AS BIGINT) AS ms FROM events")
def wire_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times of day, which the format keeps to the millisecond."""
    back = tables.roundtrip(read(spark, sf_dir, "events").select("event_id", F.date_format("ts", "HH:mm:ss.SSSSSS").cast("time(6)").alias("t")))
    part = lambda n, unit: F.date_part(F.lit(n), "t").cast("decimal(20,6)") * unit
    return back.select("event_id", (part("HOUR", 3_600_000) + part("MINUTE", 60_000) + part("SECOND", 1000)).cast("long").alias("ms"))


@query("epoch_timestamp", "SELECT event_id, epoch_us(ts) AS us FROM events")
def epoch_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = tables.roundtrip(read(spark, sf_dir, "events").select("event_id", "ts"))
    return back.select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))


@query("datetime_round_ms", "SELECT p_partkey, CAST(floor((p_partkey / 7.0::DOUBLE) * 86400000 + 0.5) AS BIGINT) * 1000 + 946684800000000 AS us FROM part")
def datetime_round_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_partkey", rules.datetime_us(F.col("p_partkey") / F.lit(7.0)).alias("us"))


@query("time_clamp", "SELECT p_partkey, least(greatest((p_partkey * 100003 - 1000000) * 1000, 0), 86399999999) AS us FROM part")
def time_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_partkey", rules.clock_us(F.col("p_partkey") * 100003 - 1000000, "time").alias("us"))


_NS_SQL = "(p_partkey * 1234567891 - 500000000000)"
_US_SQL = f"CAST(({_NS_SQL} - (({_NS_SQL} % 1000) + 1000) % 1000) // 1000 AS BIGINT)"


@query("rule_timestamp", f"SELECT p_partkey, {_US_SQL} + 946684800000000 AS at_us, {_US_SQL} AS span_us FROM part")
def rule_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nanoseconds to microseconds, floored, also before the epoch."""
    ns = F.col("p_partkey") * 1_234_567_891 - 500_000_000_000
    return read(spark, sf_dir, "part").select("p_partkey", rules.timestamp_us(ns).alias("at_us"), rules.timespan_us(ns).alias("span_us"))


@query(
    "rule_values",
    "SELECT p_partkey, CASE WHEN p_partkey % 3 <> 0 THEN CAST(p_retailprice AS DOUBLE) END AS real, CASE WHEN p_partkey % 7 = 0 THEN '' ELSE p_name END AS symbol, upper(md5(CAST(p_partkey AS VARCHAR))) AS guid, CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 5 = 1 THEN -9223372036854775807 WHEN p_partkey % 5 = 2 THEN 9223372036854775807 ELSE p_partkey % 1000 END AS item FROM part",
)
def rule_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.unhex(F.md5(F.col("p_partkey").cast("string")))
    real = F.when(F.col("p_partkey") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("p_retailprice").cast("double"))
    name = F.when(F.col("p_partkey") % 7 != 0, F.col("p_name"))
    item = F.element_at(rules.nested_integers(F.array(_marked("long", "p_partkey")), "long"), 1)
    return read(spark, sf_dir, "part").select("p_partkey", rules.real(real).alias("real"), rules.symbol(name).alias("symbol"), F.hex(rules.guid_bytes(rules.guid_text(raw))).alias("guid"), item.alias("item"))


@query("timespan", "SELECT p_partkey, CAST(p_partkey * 1234567 AS BIGINT) AS us FROM part")
def timespan(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = F.make_dt_interval(secs=(F.col("p_partkey") * 1234567 / 1000000).cast("decimal(18,6)"))
    back = tables.roundtrip(read(spark, sf_dir, "part").select("p_partkey", span.alias("d")))
    whole = [F.extract(F.lit(part), "d").cast("decimal(20,6)") * n for part, n in (("DAY", 86_400_000_000), ("HOUR", 3_600_000_000), ("MINUTE", 60_000_000), ("SECOND", 1_000_000))]
    return back.select("p_partkey", (whole[0] + whole[1] + whole[2] + whole[3]).cast("long").alias("us"))


# -- remote expressions -----------------------------------------------------------------------


@query("last_date", "SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem WHERE l_shipdate = (SELECT arg_max(l_shipdate, l_orderkey * 10 + l_linenumber) FROM lineitem)")
def last_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("at"))
    return qexpr.last_by(rows, "l_shipdate", "at").drop("at")


@query("gw_query", "SELECT event_id, event_type, ts FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-05' AND event_type IN ('click', 'view') AND ts BETWEEN TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-05 18:00:00'")
def gw_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import datetime as dt

    rows = read(spark, sf_dir, "events").withColumn("date", F.to_date("ts"))
    out = qexpr.gateway_query(rows, dt.date(2024, 1, 5), ["click", "view"], F.lit("2024-01-05 06:00:00").cast("timestamp_ntz"), F.lit("2024-01-05 18:00:00").cast("timestamp_ntz"), sym_column="event_type", time_column="ts")
    return out.select("event_id", "event_type", "ts")


@query("upsert_union", "SELECT s_suppkey, s_acctbal FROM supplier UNION ALL SELECT s_suppkey + 1000000, s_acctbal FROM supplier")
def upsert_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    return qexpr.upsert(s, s.withColumn("s_suppkey", F.col("s_suppkey") + 1000000))


@query("upsert_keyed", "SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 0.0::DOUBLE ELSE s_acctbal END AS s_acctbal FROM supplier")
def upsert_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    return qexpr.upsert(s, s.filter("s_suppkey % 2 = 0").withColumn("s_acctbal", F.lit(0.0)), ["s_suppkey"])


@query("functional_update", "SELECT p_partkey, p_size, p_size * 2 AS twice, p_retailprice + 1 AS more FROM part")
def functional_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qexpr.functional_update(read(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice"), {"twice": F.col("p_size") * 2, "more": F.col("p_retailprice") + 1}).drop("p_retailprice")


@query("sub_filter", "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'signup')")
def sub_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qexpr.subscribed(read(spark, sf_dir, "events").select("event_id", "event_type"), ["click", "signup"], "event_type")


@query("empty_take", "SELECT * FROM part LIMIT 0")
def empty_take(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qexpr.take_none(read(spark, sf_dir, "part"))


@query("keyed_concat", "SELECT n_nationkey, n_name, c_acctbal FROM (SELECT n_nationkey, n_name FROM nation) JOIN (SELECT c_nationkey AS n_nationkey, max(c_acctbal) AS c_acctbal FROM customer GROUP BY 1) USING (n_nationkey)")
def keyed_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = read(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.max("c_acctbal").alias("c_acctbal"))
    return qexpr.keyed_concat(read(spark, sf_dir, "nation").select("n_nationkey", "n_name"), values, "n_nationkey")


@query("til", "SELECT range AS x, 2 * range + 1 AS odd FROM range(1000)")
def til(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qexpr.functional_update(qexpr.til(spark, 1000), {"odd": 2 * F.col("x") + 1})


@query("random_below", "SELECT count(*) AS n, TRUE AS within, TRUE AS spread FROM range(10000)")
def random_below(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``10000?5.0``: all below 5, and of about the mean that they should have."""
    rows = qexpr.random_floats(qexpr.til(spark, 10000), 5.0, "v", 7)
    return rows.agg(F.count("*").alias("n"), F.min((F.col("v") >= 0) & (F.col("v") < 5)).alias("within"), (F.abs(F.avg("v") - 2.5) < 0.1).alias("spread"))


@query("vector_column", "SELECT range AS x, CAST(5 AS BIGINT) AS n, TRUE AS within FROM range(1000)")
def vector_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column of five random floats a row, through the wire format."""
    back = tables.roundtrip(qexpr.vectors(qexpr.til(spark, 1000), 5, "v", 3))
    return back.select("x", F.size("v").cast("long").alias("n"), F.forall("v", lambda y: (y >= 0) & (y < 1)).alias("within"))


@query("enlist", "SELECT 'a' AS sym, CAST(3 AS BIGINT) AS n, 2.5::DOUBLE AS price")
def enlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.roundtrip(qexpr.enlist(spark, {"sym": "a", "n": 3, "price": 2.5}, "sym string, n long, price double"), symbols=("sym",))


@query("table_literal", "SELECT * FROM (VALUES ('a', CAST(1 AS BIGINT), TRUE), ('b', NULL, FALSE), ('', CAST(3 AS BIGINT), TRUE)) t(sym, n, flag)")
def table_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.roundtrip(spark.createDataFrame([("a", 1, True), ("b", None, False), (None, 3, True)], "sym string, n long, flag boolean"), symbols=("sym",))


@query("cross_names", "SELECT s || n AS name FROM (VALUES ('ask'), ('bid')) a(s), (SELECT CAST(range AS VARCHAR) AS n FROM range(5))")
def cross_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of columns: each side with each number."""
    sides = spark.createDataFrame([("ask",), ("bid",)], "s string")
    return sides.crossJoin(F.broadcast(qexpr.til(spark, 5, "n"))).select(F.concat("s", F.col("n").cast("string")).alias("name"))


@query("typed_empty", "SELECT CAST(0 AS BIGINT) AS n_rows, CAST(3 AS BIGINT) AS n_columns")
def typed_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of typed columns without rows keeps its columns."""
    empty = tables.roundtrip(spark.createDataFrame([], "sym string, n long, v array<double>"), symbols=("sym",))
    return empty.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(empty.columns)).cast("long"))


# -- relational work, which is Spark's own ----------------------------------------------------


def sql_query(name: str, text: str, names: str, oracle: str | None = None) -> None:
    """A query that is the same text for Spark and for the check."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.sql(text, **{t: read(spark, sf_dir, t) for t in names.split()})

    plain = text
    for t in names.split():
        plain = plain.replace("{" + t + "}", t)
    query(name, oracle or plain)(run)


sql_query("join_inner", "SELECT o_orderkey, c_name, c_mktsegment FROM {orders} JOIN {customer} ON o_custkey = c_custkey", "orders customer")
sql_query("join_left", "SELECT c_custkey, o_orderkey FROM {customer} LEFT JOIN {orders} ON c_custkey = o_custkey AND o_totalprice > 400000", "customer orders")
sql_query("join_semi", "SELECT c_custkey, c_name FROM {customer} WHERE EXISTS (SELECT 1 FROM {orders} WHERE o_custkey = c_custkey AND o_orderstatus = 'F')", "customer orders")
sql_query("join_anti", "SELECT c_custkey, c_name FROM {customer} WHERE NOT EXISTS (SELECT 1 FROM {orders} WHERE o_custkey = c_custkey AND o_totalprice > 400000)", "customer orders")
sql_query("agg_distinct", "SELECT l_returnflag, count(*) AS n, count(DISTINCT l_suppkey) AS suppliers, max(l_quantity) AS most, min(l_shipdate) AS first_ship FROM {lineitem} GROUP BY l_returnflag", "lineitem")
sql_query("rollup_flags", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM {lineitem} GROUP BY ROLLUP (l_returnflag, l_linestatus)", "lineitem")
sql_query("cube_flags", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM {lineitem} GROUP BY CUBE (l_returnflag, l_linestatus)", "lineitem")
sql_query("window_rank", "SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nth, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS previous FROM {orders}", "orders", "SELECT o_orderkey, o_custkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS INTEGER) AS nth, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS previous FROM orders")
sql_query("topk", "SELECT o_orderkey, o_totalprice FROM {orders} ORDER BY o_totalprice DESC, o_orderkey LIMIT 10", "orders")
sql_query("setop_intersect", "SELECT c_nationkey AS k FROM {customer} INTERSECT SELECT s_nationkey AS k FROM {supplier}", "customer supplier")
sql_query("setop_except", "SELECT c_custkey AS k FROM {customer} EXCEPT SELECT o_custkey AS k FROM {orders} WHERE o_totalprice > 400000", "customer orders")
sql_query("setop_union", "SELECT c_nationkey AS k FROM {customer} UNION SELECT s_nationkey AS k FROM {supplier}", "customer supplier")
sql_query("subquery_cte", "WITH t AS (SELECT o_custkey, max(o_totalprice) AS top FROM {orders} GROUP BY o_custkey) SELECT c_custkey, top FROM {customer} JOIN t ON c_custkey = o_custkey WHERE top > (SELECT avg(o_totalprice) FROM {orders})", "customer orders")
sql_query("string_functions", "SELECT p_partkey, upper(p_name) AS up, substring(p_brand, 1, 5) AS head, length(p_type) AS n FROM {part}", "part", "SELECT p_partkey, upper(p_name) AS up, substring(p_brand, 1, 5) AS head, CAST(length(p_type) AS INTEGER) AS n FROM part")
sql_query("json_field", "SELECT event_id, CAST(get_json_object(props, '$.k') AS INT) AS k FROM {events}", "events", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")

sql_query("join_cross", "SELECT n_name, r_name FROM {nation} CROSS JOIN {region}", "nation region")
sql_query("agg_approx", "SELECT l_returnflag, abs(approx_count_distinct(l_partkey) - count(DISTINCT l_partkey)) <= 0.15 * count(DISTINCT l_partkey) AS near FROM {lineitem} GROUP BY l_returnflag", "lineitem", "SELECT DISTINCT l_returnflag, TRUE AS near FROM lineitem")
sql_query("powers_and_logs", "SELECT p_partkey, round(pow(p_size, 1.5), 6) AS raised, round(ln(p_size + 1), 9) AS natural_log, round(log10(p_retailprice), 9) AS decimal_log FROM {part}", "part")
sql_query(
    "text_parts",
    "SELECT p_partkey, regexp_replace(p_type, '[AEIOU]', '*') AS masked, split(p_type, ' ')[0] AS head, concat_ws('/', p_brand, p_type, NULL) AS path FROM {part}",
    "part",
    "SELECT p_partkey, regexp_replace(p_type, '[AEIOU]', '*', 'g') AS masked, string_split(p_type, ' ')[1] AS head, concat_ws('/', p_brand, p_type, NULL) AS path FROM part",
)
sql_query("json_struct", "SELECT event_id, j.k AS k, to_json(named_struct('k', j.k)) AS again FROM (SELECT event_id, from_json(props, 'k INT') AS j FROM {events})", "events", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, '{\"k\":' || json_extract_string(props, '$.k') || '}' AS again FROM events")
sql_query("join_full", "SELECT c_custkey, o_orderkey FROM {customer} FULL JOIN (SELECT * FROM {orders} WHERE o_totalprice > 300000) o ON c_custkey = o_custkey", "customer orders")
sql_query("join_theta", "SELECT s_suppkey, n_nationkey FROM {supplier} JOIN {nation} ON n_nationkey < s_nationkey AND s_acctbal > 1000", "supplier nation")
sql_query("grouping_sets", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM {lineitem} GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), ())", "lineitem")
sql_query("window_frame", "SELECT o_orderkey, max(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS recent_most FROM {orders}", "orders")
sql_query("setop_intersect_all", "SELECT c_nationkey AS k FROM {customer} INTERSECT ALL SELECT s_nationkey AS k FROM {supplier}", "customer supplier")
sql_query("setop_except_all", "SELECT c_nationkey AS k FROM {customer} EXCEPT ALL SELECT s_nationkey AS k FROM {supplier}", "customer supplier")
sql_query("subquery_scalar", "SELECT c_custkey, (SELECT max(o_totalprice) FROM {orders} WHERE o_custkey = c_custkey) AS most FROM {customer}", "customer orders")
sql_query(
    "date_functions",
    "SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, last_day(o_orderdate) AS month_end, date_add(CAST(o_orderdate AS DATE), 30) AS due, datediff(DATE '2002-01-01', CAST(o_orderdate AS DATE)) AS age FROM {orders}",
    "orders",
    "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, last_day(o_orderdate) AS month_end, CAST(o_orderdate AS DATE) + 30 AS due, CAST(DATE '2002-01-01' - CAST(o_orderdate AS DATE) AS INTEGER) AS age FROM orders",
)
sql_query("math_functions", "SELECT p_partkey, CAST(floor(p_retailprice) AS BIGINT) AS low, CAST(ceil(p_retailprice) AS BIGINT) AS high, abs(p_size - 25) AS off, p_size % 7 AS rest, CAST(floor(sqrt(p_size)) AS BIGINT) AS root, greatest(p_size, 10) AS least_ten FROM {part}", "part")
sql_query(
    "array_functions",
    "SELECT p_partkey, aggregate(v, 0L, (a, x) -> a + x) AS total, array_join(array_sort(transform(v, x -> x % 10)), ',') AS digits, size(filter(v, x -> x > 20)) AS n_big, element_at(v, -1) AS last_item FROM (SELECT p_partkey, array(p_partkey, CAST(p_size AS BIGINT), 3L) AS v FROM {part})",
    "part",
    "SELECT p_partkey, CAST(list_sum(v) AS BIGINT) AS total, array_to_string(list_sort(list_transform(v, lambda x: x % 10)), ',') AS digits, CAST(len(list_filter(v, lambda x: x > 20)) AS INTEGER) AS n_big, v[-1] AS last_item FROM (SELECT p_partkey, [p_partkey, CAST(p_size AS BIGINT), CAST(3 AS BIGINT)] AS v FROM part)",
)
sql_query("array_explode", "SELECT vec_id, nth, x FROM {embeddings} LATERAL VIEW posexplode(embedding) e AS nth, x WHERE x > 0", "embeddings", "SELECT vec_id, CAST(nth - 1 AS INTEGER) AS nth, x FROM (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS nth FROM embeddings) WHERE x > 0")
sql_query(
    "map_functions",
    "SELECT p_partkey, element_at(m, 'size') AS size, element_at(transform_values(m, (k, v) -> v * 2), 'key') AS twice, element_at(m, 'none') AS none, cardinality(m) AS n FROM (SELECT p_partkey, map('size', CAST(p_size AS BIGINT), 'key', p_partkey) AS m FROM {part})",
    "part",
    "SELECT p_partkey, m['size'] AS size, m['key'] * 2 AS twice, m['none'] AS none, CAST(cardinality(m) AS INTEGER) AS n FROM (SELECT p_partkey, MAP {'size': CAST(p_size AS BIGINT), 'key': p_partkey} AS m FROM part)",
)


@query("udf_arrow", "SELECT c_custkey, reverse(c_name) AS back FROM customer")
def udf_arrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A function of the caller's over Arrow batches."""

    @F.arrow_udf("string")
    def back(names: pa.Array) -> pa.Array:
        return pc.utf8_reverse(names)

    return read(spark, sf_dir, "customer").select("c_custkey", back("c_name").alias("back"))


@query("udaf_arrow", "SELECT p_brand, CAST(max(p_size) - min(p_size) AS BIGINT) AS width FROM part GROUP BY p_brand")
def udaf_arrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An aggregate of the caller's over the Arrow arrays of a group."""

    @F.arrow_udf("long")
    def width(sizes: pa.Array) -> int:
        least, most = pc.min_max(sizes).as_py().values()
        return most - least

    return read(spark, sf_dir, "part").groupBy("p_brand").agg(width("p_size").alias("width"))


@query("udtf_words", "SELECT p_partkey, CAST(nth AS INTEGER) AS nth, w[nth] AS word FROM (SELECT p_partkey, w, unnest(range(1, len(w) + 1)) AS nth FROM (SELECT p_partkey, string_split(p_type, ' ') AS w FROM part))")
def udtf_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table function of the caller's, a row a word."""

    class Words:
        def eval(self, text: str):
            for i, w in enumerate(text.split(" "), 1):
                yield i, w

    spark.udtf.register("split_words", F.udtf(Words, returnType="nth int, word string"))
    return spark.sql("SELECT p_partkey, nth, word FROM {part}, LATERAL split_words(p_type)", part=read(spark, sf_dir, "part"))


# -- windows in event time: the same frames serve a stream, with a watermark -------------------


@query("tumbling_counts", "SELECT event_type, epoch_us(date_trunc('hour', ts)) AS start_us, count(*) AS n FROM events GROUP BY ALL")
def tumbling_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.counts(read(spark, sf_dir, "events"), F.window("ts", "1 hour"), "event_type").select("event_type", "start_us", "n")


@query("sliding_counts", "SELECT event_type, start_us, count(*) AS n FROM (SELECT event_type, unnest([h, h - 43200000000]) AS start_us FROM (SELECT event_type, epoch_us(ts) - epoch_us(ts) % 43200000000 AS h FROM events)) GROUP BY ALL")
def sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.counts(read(spark, sf_dir, "events"), F.window("ts", "1 day", "12 hours"), "event_type").select("event_type", "start_us", "n")


@query(
    "session_counts",
    "SELECT user_id, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) + 86400000000 AS end_us, count(*) AS n FROM (SELECT *, sum(cut) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 1 DAY THEN 0 ELSE 1 END AS cut FROM events)) GROUP BY user_id, s",
)
def session_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.counts(read(spark, sf_dir, "events"), F.session_window("ts", "1 day"), "user_id")


@query("asof_orders", "SELECT e.event_id, o.event_id AS click_id FROM events e ASOF LEFT JOIN (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'click' GROUP BY 1, 2) o ON e.user_id = o.user_id AND e.ts >= o.ts WHERE e.event_type = 'purchase'")
def asof_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    clicks = e.filter("event_type = 'click'").groupBy("user_id", "ts").agg(F.max("event_id").alias("click_id"))
    return relational.asof_join(e.filter("event_type = 'purchase'").select("event_id", "user_id", "ts"), clicks, "ts", ["user_id"], ["click_id"], salt_seconds=86400).select("event_id", "click_id")


@query("range_sizes", "SELECT p_partkey, lo FROM part JOIN (SELECT CAST(r_regionkey * 10 AS BIGINT) AS lo, CAST(r_regionkey * 10 + 15 AS BIGINT) AS hi FROM region) ON p_size >= lo AND p_size < hi")
def range_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read(spark, sf_dir, "region").select((F.col("r_regionkey") * 10).cast("long").alias("lo"), (F.col("r_regionkey") * 10 + 15).cast("long").alias("hi"))
    return relational.range_join(read(spark, sf_dir, "part").select("p_partkey", "p_size"), r, "p_size", "lo", "hi", 15).select("p_partkey", "lo")


# -- flagship ---------------------------------------------------------------------------------


@query("flagship", "SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01' GROUP BY 1, 2")
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines encoded to messages, decoded again, and summed by flag from a ship date on."""
    rows = read(spark, sf_dir, "lineitem").filter(F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).select("l_returnflag", "l_linestatus", "l_quantity")
    back = tables.roundtrip(rows, symbols=("l_returnflag", "l_linestatus"))
    return back.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"))

