"""Reads, rows, merges, coverage and catalog queries."""

from __future__ import annotations


from pyspark.sql import functions as F

from tickloom.functions.scalars import same_within
from tickloom.model import Dataset, Field
from tickloom.operators import catalog, coverage, merge, rows
from tickloom.plans.base import BARS, bars, r, rounded, table
from tickloom.sources import readers, tables

QUERIES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = (f, sql)
        return f

    return add


ORDERS = Dataset("orders", (Field("o_orderkey", "bigint", required=True), Field("o_custkey", "bigint"), Field("o_orderstatus", "string", sentinels=("",)), Field("o_totalprice", "double"), Field("o_orderdate", "timestamp"), Field("o_orderpriority", "string")), ("o_orderkey",), "o_orderdate", tags=("trade", "daily"), depends_on=("customer",))
EVENTS = Dataset("events", (Field("event_id", "bigint", required=True), Field("ts", "timestamp"), Field("user_id", "bigint"), Field("event_type", "string"), Field("value", "double"), Field("props", "string")), ("event_id",), "ts", tags=("stream",))


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1998-01-01' AND o_orderkey > 100")
def read_dataset(spark, d):
    return tables.read_dataset(table(spark, d, "orders"), ORDERS, ["o_orderkey", "o_custkey", "o_totalprice"], {"o_orderstatus": "F"}, ("o_orderdate", "1996-01-01", "1998-01-01"), (100,))


@query("SELECT 'orders' AS dataset, count(*) AS n FROM orders WHERE o_orderstatus = 'O' UNION ALL SELECT 'events', count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'")
def read_group(spark, d):
    found = tables.read_group({"orders": (table(spark, d, "orders"), ORDERS, ["o_orderkey"], {"equal": {"o_orderstatus": "O"}}), "events": (table(spark, d, "events"), EVENTS, ["event_id"], {"within": ("ts", "2024-01-10", "2024-01-20")})})
    return readers.union_sources(*(df.agg(F.lit(k).alias("dataset"), F.count("*").alias("n")) for k, df in found.items()))


@query("SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, value FROM events WHERE event_type <> 'error'")
def read_contract_source(spark, d):
    ds = Dataset("event_rows", (Field("event_id", "bigint", "id"), Field("user_id", "bigint", "user", True), Field("k", "bigint", required=True), Field("value", "double", sentinels=("NA",))), ("event_id",))
    e = table(spark, d, "events")
    raw = e.select(F.when(F.col("event_type") != "error", F.col("event_id")).cast("string").alias("id"), F.concat(F.lit(" "), F.col("user_id").cast("string")).alias("user"), F.get_json_object("props", "$.k").alias("k"), F.col("value").cast("string").alias("value"))
    return readers.contract_rows(raw, ds)[0]


@query("SELECT reason, count(*) AS n FROM (SELECT CASE WHEN event_type = 'error' THEN 'missing event_id' END AS reason FROM events) WHERE reason IS NOT NULL GROUP BY reason")
def read_contract_rejects(spark, d):
    ds = Dataset("event_rows", (Field("event_id", "bigint", "id"), Field("value", "double")), ("event_id",))
    raw = table(spark, d, "events").select(F.when(F.col("event_type") != "error", F.col("event_id")).cast("string").alias("id"), F.col("value").cast("string").alias("value"))
    return readers.contract_rows(raw, ds)[1].select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query("SELECT user_id AS symbol, event_id AS k, ROUND(value, 6) AS close FROM events WHERE event_type <> 'view'")
def read_chart_json(spark, d):
    e = table(spark, d, "events").where("event_type <> 'view'")
    one = F.array("value")
    doc = F.to_json(F.struct(F.col("user_id").cast("string").alias("symbol"), F.array("event_id").alias("timestamp"), one.alias("open"), one.alias("high"), one.alias("low"), one.alias("close"), one.alias("volume"), one.alias("adjclose")))
    return readers.chart_rows(e.select(doc.alias("value"))).select(F.col("symbol").cast("long").alias("symbol"), F.unix_seconds("ts").alias("k"), r("close").alias("close"))


@query("SELECT CASE WHEN p_type = 'ECONOMY' THEN 'ETF' WHEN p_size > 40 THEN 'TEST' WHEN p_name LIKE '%ring%' THEN 'NOT_COMMON' ELSE 'IN_SCOPE' END AS scope_reason, count(*) AS n FROM part GROUP BY 1")
def listing_scope(spark, d):
    reason = readers.scope_reason([(F.col("p_type") == "ECONOMY", "ETF"), (F.col("p_size") > 40, "TEST"), (F.col("p_name").contains("ring"), "NOT_COMMON")])
    return table(spark, d, "part").groupBy(reason.alias("scope_reason")).agg(F.count("*").alias("n"))


@query("SELECT o_custkey, max(o_orderkey) FILTER (k = 1) AS o_orderkey, ROUND(max(o_totalprice) FILTER (k = 1), 6) AS o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders) GROUP BY o_custkey")
def latest_view(spark, d):
    return rounded(rows.latest_view(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice"), "o_totalprice")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'new' ELSE 'old' END AS origin, CASE WHEN o_orderkey % 2 = 0 THEN ROUND(o_totalprice * 2, 6) ELSE ROUND(o_totalprice, 6) END AS price FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 2 = 0")
def upsert_dataset(spark, d):
    o = table(spark, d, "orders")
    old = o.where("o_orderkey % 3 <> 0").select("o_orderkey", F.lit("old").alias("origin"), F.col("o_totalprice").alias("price"), F.lit(1).alias("version"))
    new = o.where("o_orderkey % 2 = 0").select("o_orderkey", F.lit("new").alias("origin"), (F.col("o_totalprice") * 2).alias("price"), F.lit(2).alias("version"))
    return rounded(tables.upserted(old, new, ["o_orderkey"], "version").drop("version"), "price")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def publish_missing(spark, d):
    target = table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return tables.missing_rows(table(spark, d, "orders").select("o_orderkey", "o_custkey"), target, ["o_orderkey"])


@query("SELECT l_suppkey AS symbol, count(*) AS n FROM lineitem JOIN (SELECT l_suppkey AS s, max(l_linenumber) AS b FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1) ON s = l_suppkey AND b = l_linenumber GROUP BY 1")
def select_latest_part(spark, d):
    x = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("symbol"), F.col("l_linenumber").alias("batch_id"), "l_linestatus")
    manifest = x.select("symbol", "batch_id", (F.col("l_linestatus") == "O").alias("daily_feature_ok")).distinct()
    return tables.latest_part(x, manifest, ["symbol"]).groupBy("symbol").agg(F.count("*").alias("n"))


@query("SELECT user_id AS ts_code, CAST(ts AS DATE) AS trade_date, 1 AS is_suspended FROM events WHERE event_type = 'error' GROUP BY 1, 2")
def normalize_suspensions(spark, d):
    kind = F.when(F.col("event_type") == "error", "S").when(F.col("event_type") == "view", "R").otherwise("X")
    e = table(spark, d, "events").select(F.col("user_id").alias("ts_code"), F.to_date("ts").alias("trade_date"), kind.alias("suspend_type"))
    return rows.normalize_suspensions(e)[0]


@query("SELECT p_partkey, tenor, value FROM (SELECT p_partkey, unnest(['size', 'price']) AS tenor, unnest([CAST(p_size AS DOUBLE), p_retailprice]) AS value FROM part) WHERE value > 0")
def unpivot_yield_curve(spark, d):
    return rows.unpivot_wide(table(spark, d, "part"), ["p_partkey"], {"p_size": "size", "p_retailprice": "price"}, "tenor", "value").where("value > 0")


@query("SELECT o_custkey AS code, trade_date, 1 AS is_st FROM (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) + 20 AS b FROM orders WHERE o_orderpriority LIKE '1%') JOIN (SELECT DISTINCT CAST(l_shipdate AS DATE) AS trade_date FROM lineitem) ON trade_date BETWEEN a AND b GROUP BY 1, 2")
def st_interval_to_daily(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("code"), F.to_date("o_orderdate").alias("a"), F.date_add(F.to_date("o_orderdate"), 20).alias("b"), "o_orderpriority")
    cal = table(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("trade_date")).distinct()
    return rows.interval_to_daily(o, cal, "code", "a", "b", "trade_date", F.col("o_orderpriority").startswith("1"), "is_st")


@query("""SELECT 'lineitem' AS dataset, rule, (SELECT count(*) FROM lineitem) AS rows, bad, bad > 0 AS failed FROM (
  SELECT 'quantity' AS rule, count(*) FILTER (l_quantity > 45) AS bad FROM lineitem UNION ALL SELECT 'discount', count(*) FILTER (l_discount > 1) FROM lineitem UNION ALL SELECT 'null:l_tax', count(*) FILTER (l_tax IS NULL) FROM lineitem)""")
def quality_failures(spark, d):
    return rows.quality_failures(table(spark, d, "lineitem"), "lineitem", ["l_tax"], {"quantity": F.col("l_quantity") > 45, "discount": F.col("l_discount") > 1})


@query(f"""WITH {BARS}, x AS (SELECT symbol, trade_date, open * (CASE WHEN symbol % 7 = 0 THEN -1 ELSE 1 END) AS open, high * (CASE WHEN symbol % 5 = 0 THEN 0.5 ELSE 1 END) AS high, low, close, volume - 20 AS volume FROM bars)
SELECT symbol, trade_date, 'invalid_price' AS issue FROM x WHERE NOT (open > 0 AND high > 0 AND low > 0 AND close > 0)
UNION ALL SELECT symbol, trade_date, 'ohlc_boundary' FROM x WHERE open > 0 AND high > 0 AND low > 0 AND close > 0 AND NOT (low <= least(open, close) AND high >= greatest(open, close))
UNION ALL SELECT symbol, trade_date, 'invalid_volume' FROM x WHERE volume < 0""")
def candle_issues(spark, d):
    b = bars(spark, d).withColumn("open", F.col("open") * F.when(F.col("symbol") % 7 == 0, -1).otherwise(1)).withColumn("high", F.col("high") * F.when(F.col("symbol") % 5 == 0, 0.5).otherwise(1)).withColumn("volume", F.col("volume") - 20)
    return rows.candle_issues(b, ["symbol", "trade_date"])


@query("SELECT p_partkey, CASE WHEN regexp_matches(lower(p_name), 'ring|bolt') THEN 'hardware' WHEN regexp_matches(lower(p_name), '^red') THEN 'red' WHEN regexp_matches(lower(p_name), 'widget') THEN 'widget' ELSE '其他' END AS style FROM part")
def classify_style(spark, d):
    return rows.classify_style(table(spark, d, "part").select("p_partkey", "p_name"), "p_name", [("ring|bolt", "hardware"), ("^red", "red"), ("widget", "widget")]).drop("p_name")


@query(f"""WITH {BARS}, x AS (SELECT CASE WHEN symbol % 10 = 3 THEN symbol + 1 ELSE symbol END AS code, trade_date, close, symbol % 10 = 3 AS legacy FROM bars),
k AS (SELECT *, row_number() OVER (PARTITION BY code, trade_date ORDER BY CASE WHEN code % 10 = 4 THEN legacy = (trade_date < DATE '1998-01-01') END DESC NULLS LAST, legacy DESC) AS k FROM x)
SELECT code, trade_date, ROUND(close, 8) + 0.0 AS close FROM k WHERE k = 1""")
def canonical_code(spark, d):
    b = bars(spark, d).select(F.col("symbol").alias("code"), "trade_date", "close")
    alias = b.select("code").distinct().where("code % 10 = 3").select(F.col("code").alias("legacy"), (F.col("code") + 1).alias("canonical"), F.lit("1998-01-01").cast("date").alias("switch_date"))
    return rounded(rows.canonical_codes(b, alias, "code", "trade_date", ["close"])[0], "close", n=8)


@query(f"""WITH {BARS}, twin AS (SELECT symbol, trade_date, CASE WHEN trade_date < DATE '1998-01-01' THEN close ELSE close + 1 END AS close FROM bars WHERE symbol % 10 = 3)
SELECT symbol, trade_date, ROUND(close, 8) + 0.0 AS close FROM bars o WHERE NOT EXISTS (SELECT 1 FROM twin t WHERE t.symbol = o.symbol AND t.trade_date = o.trade_date AND t.close = o.close AND o.symbol % 20 = 3)""")
def drop_proven_alias_rows(spark, d):
    """All bars, less those of a legacy code whose rows its canonical code holds just the same; most codes have no alias."""
    old = bars(spark, d).select("symbol", "trade_date", "close")
    coded = old.where("symbol % 10 = 3")
    twin = coded.select((F.col("symbol") + 1).alias("symbol"), "trade_date", F.when(F.col("trade_date") < "1998-01-01", F.col("close")).otherwise(F.col("close") + 1).alias("close"))
    alias = coded.select("symbol").distinct().select(F.col("symbol").alias("legacy"), (F.col("symbol") + 1).alias("canonical"))
    return rounded(rows.drop_proven_alias_rows(old, alias, twin, twin.where("symbol % 20 = 4").select("symbol", "trade_date"), "symbol", "trade_date", ["close"]), "close", n=8)


@query("SELECT l_orderkey, l_linenumber, ROUND(min(l_extendedprice), 6) + 0.0 AS l_extendedprice FROM (SELECT *, rank() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC) AS k FROM lineitem) WHERE k = 1 GROUP BY 1, 2")
def latest_financial_revision(spark, d):
    x = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return rounded(rows.latest_revision(x, ["l_orderkey"], "l_linenumber", ["l_extendedprice"])[0], "l_extendedprice")


@query("SELECT event_id, CAST(ts - INTERVAL 5 HOUR AS DATE) AS trade_date FROM events WHERE hour(ts - INTERVAL 5 HOUR) * 60 + minute(ts - INTERVAL 5 HOUR) BETWEEN 570 AND 959 AND dayofweek(ts - INTERVAL 5 HOUR) BETWEEN 1 AND 5")
def session_filter(spark, d):
    days = rows.calendar_days("2023-12-30", "2024-02-05", spark).where(F.dayofweek("cal_date").between(2, 6))
    cal = days.select(F.col("cal_date").alias("trade_date"), F.lit(570).alias("open_minute"), F.lit(960).alias("close_minute"))
    return rows.session_filter(table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts")), cal, "America/New_York").select("event_id", "trade_date")


@query("SELECT a AS signal_date, b AS maturity_date FROM (SELECT a, lead(a) OVER (ORDER BY a) AS b FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS a FROM lineitem)) WHERE b IS NOT NULL")
def session_pairs(spark, d):
    return rows.session_pairs(table(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("trade_date")).distinct())


@query("SELECT CAST(g AS DATE) AS cal_date FROM generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY) t(g) WHERE CAST(g AS DATE) NOT IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem)")
def trading_sessions(spark, d):
    cal = table(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("cal_date"), F.lit(1).alias("is_open")).distinct()
    return rows.trading_sessions(cal, "1995-01-01", "2001-12-31")[1]


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'A' THEN l_quantity WHEN l_returnflag = 'R' THEN -l_quantity END AS change, count(*) AS n FROM lineitem GROUP BY 1, 2, 3")
def holder_change_sign(spark, d):
    x = table(spark, d, "lineitem").withColumn("in_de", F.when(F.col("l_returnflag") == "A", "IN").when(F.col("l_returnflag") == "R", "DE"))
    return x.groupBy("l_orderkey", "l_linenumber", rows.holder_change_sign("in_de", "l_quantity").alias("change")).agg(F.count("*").alias("n"))


@query("SELECT p_brand AS symbol, count(*) AS n, count(DISTINCT p_type) > 1 AS type_conflict, max(CASE WHEN a <= m THEN 1 ELSE 0 END) = 1 AS window_overlap FROM (SELECT *, max(b) OVER (PARTITION BY p_brand ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM (SELECT *, DATE '2000-01-01' + CAST(p_partkey AS INTEGER) AS a, DATE '2000-01-01' + CAST(p_partkey AS INTEGER) + p_size AS b FROM part)) GROUP BY 1 HAVING count(*) > 1")
def security_identity_review(spark, d):
    p = table(spark, d, "part").select(F.col("p_brand").alias("symbol"), "p_type", F.date_add(F.lit("2000-01-01").cast("date"), F.col("p_partkey").cast("int")).alias("a"), "p_size")
    return rows.identity_review(p.withColumn("b", F.expr("date_add(a, p_size)")), "symbol", "p_type", "a", "b")


@query("SELECT p_partkey, row_number() OVER (PARTITION BY p_name ORDER BY p_size, p_partkey) = 1 AS owns_alias FROM part")
def alias_ownership(spark, d):
    return rows.alias_ownership(table(spark, d, "part").select("p_partkey", "p_name", "p_size"), "p_name", ["p_size", "p_partkey"]).select("p_partkey", "owns_alias")


@query("SELECT p_partkey, CASE WHEN p_size % 9 = 0 AND p_retailprice > 1000 THEN 0.5 ELSE p_retailprice END AS dividend FROM part")
def cash_dividend_overrides(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_size", F.col("p_retailprice").alias("dividend"))
    fix = p.where("p_size % 9 = 0").select("p_partkey", F.when(F.col("dividend") > 1000, F.col("dividend")).otherwise(F.col("dividend") + 1).alias("source_value"), F.lit(0.5).alias("corrected_value"))
    return rows.dividend_overrides(p, fix, ["p_partkey"])[0].select("p_partkey", "dividend")


@query("""SELECT k AS o_orderkey, CASE WHEN b IS NULL THEN 'missing' WHEN a IS NULL THEN 'unexpected' WHEN a <> b THEN 'value_mismatch' ELSE 'matched' END AS status, CASE WHEN a <> b THEN 'o_totalprice' ELSE '' END AS columns
FROM (SELECT coalesce(x.k, y.k) AS k, x.v AS a, y.v AS b FROM (SELECT o_orderkey AS k, o_totalprice AS v FROM orders WHERE o_orderkey % 5 <> 0) x FULL JOIN (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 11 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS v FROM orders WHERE o_orderkey % 7 <> 0) y ON x.k = y.k)""")
def compare_datasets(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    changed = o.where("o_orderkey % 7 <> 0").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 11 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return merge.compare_datasets(o.where("o_orderkey % 5 <> 0"), changed, ["o_orderkey"], ["o_totalprice"])


@query("SELECT o_orderkey, abs(o_totalprice - (o_totalprice + CASE WHEN o_orderkey % 3 = 0 THEN 1e-9 ELSE 1e-3 END)) <= 1e-8 + 1e-10 * abs(o_totalprice) AS same FROM orders")
def tolerant_compare(spark, d):
    o = table(spark, d, "orders")
    other = F.col("o_totalprice") + F.when(F.col("o_orderkey") % 3 == 0, 1e-9).otherwise(1e-3)
    return o.select("o_orderkey", same_within("o_totalprice", other).alias("same"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'unrelated' WHEN o_orderkey % 4 = 0 THEN 'inserted' WHEN o_orderkey % 3 <> 0 THEN 'same' WHEN o_orderkey % 2 = 0 THEN 'newer_in_target' ELSE 'changed' END AS status FROM orders WHERE NOT (o_orderkey % 5 = 0 AND o_orderkey % 4 = 0)")
def metric_delta(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("v"), F.lit(5).alias("version"))
    new = o.where("o_orderkey % 5 <> 0")
    old = o.where("o_orderkey % 4 <> 0").withColumn("v", F.when(F.col("o_orderkey") % 3 == 0, F.col("v") + 1).otherwise(F.col("v"))).withColumn("version", F.when(F.col("o_orderkey") % 2 == 0, 6).otherwise(4))
    return merge.metric_delta(new, old, ["o_orderkey"], ["v"], "version")


@query("SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal, CASE WHEN c_custkey % 4 = 0 THEN 'inserted' WHEN c_custkey % 3 = 0 THEN 'revised' WHEN c_custkey % 5 = 0 THEN 'retained' ELSE 'unchanged' END AS change FROM customer WHERE c_custkey % 5 <> 0 OR (c_custkey % 4 <> 0 AND c_custkey % 3 <> 0)")
def merge_retain_absent(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    new = c.where("c_custkey % 5 <> 0 or c_custkey % 3 = 0 and c_custkey % 4 <> 0 and false").withColumn("c_acctbal", F.when(F.col("c_custkey") % 3 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))).withColumn("c_name", F.concat("c_name", F.lit("")))
    return merge.merge_retain_absent(c.where("c_custkey % 4 <> 0 and not (c_custkey % 5 = 0 and c_custkey % 3 = 0)"), new, ["c_custkey"], ["c_name", "c_acctbal"], ("c_name",))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'unexpected' WHEN o_orderkey % 4 = 0 OR o_orderkey % 3 = 0 THEN 'write' ELSE 'matching' END AS status FROM orders WHERE NOT (o_orderkey % 5 = 0 AND o_orderkey % 4 = 0)")
def observation_delta(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("v"))
    old = o.where("o_orderkey % 4 <> 0").withColumn("v", F.when(F.col("o_orderkey") % 3 == 0, F.lit(None)).otherwise(F.col("v")))
    return merge.observation_delta(o.where("o_orderkey % 5 <> 0"), old, ["o_orderkey"], ["v"])


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'append' WHEN o_orderkey % 3 = 0 THEN 'changed' ELSE 'same' END AS status FROM orders")
def missing_series_rows(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("v"))
    old = o.where("o_orderkey % 4 <> 0").withColumn("v", F.when(F.col("o_orderkey") % 3 == 0, F.col("v") + 1).otherwise(F.col("v")))
    return merge.missing_series_rows(o, old, ["o_orderkey"], "v").drop("v")


@query("SELECT l_orderkey, count(*) AS copies, max(l_tax) - min(l_tax) <= 1e-8 * abs(min(l_tax)) AND max(l_linenumber) = min(l_linenumber) AS agree FROM lineitem GROUP BY 1")
def source_agreement(spark, d):
    return merge.source_agreement(table(spark, d, "lineitem"), ["l_orderkey"], ["l_tax", "l_linenumber"])


@query("""SELECT pool, d AS trade_date, CASE WHEN n IS NULL THEN 'missing' WHEN n < 3 THEN 'physical_gap' WHEN s < 10 THEN 'partial_source' ELSE 'input_revised' END AS reason FROM (
SELECT *, dense_rank() OVER (ORDER BY d) AS k FROM (SELECT pool, d, n, s FROM (SELECT DISTINCT o_orderpriority AS pool, CAST(o_orderdate AS DATE) AS d FROM orders) LEFT JOIN (SELECT o_orderpriority AS pool, CAST(o_orderdate AS DATE) AS d, count(*) AS n, CAST(sum(o_orderkey) % 20 AS BIGINT) AS s FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1, 2) USING (pool, d) WHERE n IS NULL OR n < 3 OR s < 10 OR s % 2 = 1)) WHERE k <= 50""")
def pending_sections(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderpriority").alias("pool"), F.to_date("o_orderdate").alias("trade_date"), "o_orderkey", "o_orderstatus")
    plan = o.select("pool", "trade_date").distinct().withColumn("expected", F.lit(3)).withColumn("source_expected", F.lit(10)).withColumn("planned_fingerprint", F.lit(0))
    have = o.where("o_orderstatus <> 'P'").groupBy("pool", "trade_date").agg(F.count("*").alias("stored"), (F.sum("o_orderkey") % 20).alias("source_rows")).withColumn("fingerprint", F.col("source_rows") % 2)
    return merge.pending_sections(plan, have, ["pool"], "trade_date", 50)


@query(f"""WITH {BARS}, k AS (SELECT symbol, trade_date, symbol % 10 AS ticker, open, high, low, close FROM bars), m AS (SELECT *, count(*) OVER (PARTITION BY symbol, trade_date) AS i, count(*) OVER (PARTITION BY ticker, trade_date) AS t FROM k)
SELECT symbol, count(*) AS n, min(trade_date) AS first_date, max(trade_date) AS last_date, count(*) FILTER (i > 1) AS duplicate_ids, count(*) FILTER (t > 1) AS duplicate_tickers, count(*) FILTER (NOT (low <= least(open, close) AND high >= greatest(open, close))) AS broken_bars FROM m GROUP BY 1""")
def panel_key_audit(spark, d):
    return merge.panel_key_audit(bars(spark, d).withColumn("ticker", F.col("symbol") % 10), "symbol", "ticker", "trade_date")


@query("""WITH e AS (SELECT user_id AS symbol, date_trunc('day', ts) AS ts, count(*) AS n FROM events GROUP BY 1, 2), span AS (SELECT user_id AS symbol, unnest(generate_series(date_trunc('day', min(ts)), date_trunc('day', max(ts)), INTERVAL 1 DAY)) AS ts FROM events GROUP BY 1)
SELECT symbol, CAST(ts AS DATE) AS day, CASE WHEN n IS NULL THEN 'missing' ELSE 'duplicate' END AS issue FROM span LEFT JOIN e USING (symbol, ts) WHERE n IS NULL OR n > 1""")
def gap_grid(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").alias("symbol"), F.date_trunc("day", F.col("ts").cast("timestamp")).alias("ts"))
    span = e.groupBy("symbol").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return coverage.gap_grid(e, coverage.time_grid(span, ["symbol"], "a", "b", "1 day"), ["symbol"], "ts").select("symbol", F.to_date("ts").alias("day"), "issue")


ISLANDS = """days AS (SELECT DISTINCT user_id AS symbol, CAST(ts AS DATE) AS day FROM events), span AS (SELECT symbol, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM days GROUP BY 1),
gap AS (SELECT symbol, day, day - CAST(row_number() OVER (PARTITION BY symbol ORDER BY day) AS INTEGER) AS g FROM (SELECT * FROM span EXCEPT SELECT * FROM days)), cut AS (SELECT *, (row_number() OVER (PARTITION BY symbol, g ORDER BY day) - 1) // 3 AS p FROM gap)"""


@query(f"WITH {ISLANDS} SELECT symbol, min(day) AS start_date, max(day) AS end_date, count(*) AS days FROM cut GROUP BY symbol, g, p")
def missing_ranges(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").alias("symbol"), F.to_date("ts").alias("day")).distinct()
    cal = e.groupBy("symbol").agg(F.explode(F.sequence(F.min("day"), F.max("day"))).alias("day"))
    return coverage.missing_ranges(cal, e.select("symbol", F.col("day").alias("start_date"), F.col("day").alias("end_date")), ["symbol"], "day", 3)


@query("""SELECT o_custkey, min(a) AS a, max(b) AS b, count(*) AS merged FROM (SELECT *, sum(CASE WHEN m IS NULL OR a > m + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY a, b, k) AS i FROM (
SELECT *, max(b) OVER (PARTITION BY o_custkey ORDER BY a, b, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM (SELECT o_custkey, o_orderkey AS k, CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 90 AS INTEGER) AS b FROM orders))) GROUP BY o_custkey, i""")
def continuous_coverage(spark, d):
    o = table(spark, d, "orders").select("o_custkey", F.to_date("o_orderdate").alias("a"), F.expr("date_add(to_date(o_orderdate), cast(o_orderkey % 90 as int))").alias("b"))
    return coverage.continuous_coverage(o, ["o_custkey"], "a", "b")


@query("""WITH n AS (SELECT l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS day, count(*) AS n FROM lineitem GROUP BY 1, 2), ref AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderkey % 3 = 0), s AS (SELECT symbol, min(day) AS a, max(day) AS b FROM n GROUP BY 1),
x AS (SELECT symbol, count(*) AS e FROM s JOIN ref ON day BETWEEN a AND b GROUP BY 1)
SELECT n.symbol, count(*) AS dates, min(n.day) AS first_date, max(n.day) AS last_date, count(*) FILTER (ref.day IS NULL) AS extra, coalesce(any_value(e), 0) - count(ref.day) AS missing, count(*) FILTER (n.n > 1) AS duplicates FROM n LEFT JOIN ref ON ref.day = n.day LEFT JOIN x ON x.symbol = n.symbol GROUP BY n.symbol""")
def date_set_audit(spark, d):
    x = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("symbol"), F.to_date("l_shipdate").alias("day"))
    return coverage.date_set_audit(x, table(spark, d, "orders").where("o_orderkey % 3 = 0").select(F.to_date("o_orderdate").alias("day")), "symbol", "day")


@query("""WITH b AS (SELECT user_id AS symbol, date_trunc('hour', ts) + INTERVAL 1 MINUTE * CASE WHEN event_id % 10 = 0 THEN 7 ELSE 0 END AS ts FROM events), s AS (SELECT CAST(g AS DATE) AS d, g + INTERVAL 9 HOUR AS a, g + INTERVAL 16 HOUR AS z FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY) t(g)), span AS (SELECT symbol, min(CAST(ts AS DATE)) AS f, max(CAST(ts AS DATE)) AS l FROM b GROUP BY 1),
x AS (SELECT span.symbol, d AS trade_date, 7 AS expected, count(DISTINCT CASE WHEN ts >= a AND ts < z AND minute(ts) = 0 THEN ts END) AS present, count(CASE WHEN ts IS NOT NULL AND NOT (ts >= a AND ts < z AND minute(ts) = 0) THEN 1 END) AS off_grid FROM span JOIN s ON d BETWEEN f AND l LEFT JOIN b ON b.symbol = span.symbol AND CAST(ts AS DATE) = d GROUP BY 1, 2)
SELECT *, CASE WHEN present = 0 THEN 'missing' WHEN present < expected THEN 'sparse' ELSE 'complete' END AS status FROM x""")
def intraday_session_audit(spark, d):
    off = F.make_interval(mins=F.when(F.col("event_id") % 10 == 0, 7).otherwise(0))
    b = table(spark, d, "events").select(F.col("user_id").alias("symbol"), (F.date_trunc("hour", F.col("ts").cast("timestamp")) + off).alias("ts"))
    s = rows.calendar_days("2024-01-01", "2024-01-31", spark).select(F.col("cal_date").alias("trade_date"), (F.col("cal_date").cast("timestamp") + F.expr("interval 9 hours")).alias("open_ts"), (F.col("cal_date").cast("timestamp") + F.expr("interval 16 hours")).alias("close_ts"))
    return coverage.intraday_session_audit(b, s, "symbol", 60)


@query("SELECT l_returnflag AS dataset, count(DISTINCT CASE WHEN o THEN k END) AS observed, count(DISTINCT CASE WHEN e THEN k END) AS expected, count(CASE WHEN NOT o THEN 1 END) AS missing, count(CASE WHEN NOT e THEN 1 END) AS unexpected, count(CASE WHEN o AND NOT regexp_matches(CAST(k AS VARCHAR), '^[1-9][0-9]$') THEN 1 END) AS malformed FROM (SELECT l_returnflag, l_suppkey AS k, bool_or(l_quantity > 48) AS o, bool_or(l_quantity < 2) AS e FROM lineitem GROUP BY 1, 2) WHERE o OR e GROUP BY 1")
def code_coverage(spark, d):
    x = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("dataset"), F.col("l_suppkey").alias("code"), "l_quantity")
    return coverage.code_coverage(x.where("l_quantity > 48"), x.where("l_quantity < 2"), "dataset", "code", "^[1-9][0-9]$")


@query("SELECT dataset, coalesce(n, 0) AS n, coalesce(n >= 1, false) AS ready FROM (SELECT unnest(['1-URGENT', '2-HIGH', '9-NONE']) AS dataset) LEFT JOIN (SELECT o_orderpriority AS dataset, count(*) AS n FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1997-05-28' GROUP BY 1) USING (dataset)")
def data_readiness(spark, d):
    c = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("dataset"), F.to_date("o_orderdate").alias("date")).agg(F.count("*").alias("n")).withColumn("expected", F.lit(1))
    return coverage.data_readiness(c, ["1-URGENT", "2-HIGH", "9-NONE"], "1997-05-28")


@query("""WITH s AS (SELECT d, row_number() OVER (ORDER BY d) AS i FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)), m AS (SELECT l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS d, count(*) AS n FROM lineitem GROUP BY 1, 2), last AS (SELECT symbol, max(d) AS d, arg_max(n, d) AS n FROM m GROUP BY 1)
SELECT s_suppkey AS symbol, last.d AS last_date, CASE WHEN last.d IS NULL THEN 'missing' WHEN n > 1 THEN 'duplicate' ELSE 'ready' END AS status, (SELECT max(i) FROM s) - i AS lag, coalesce((SELECT max(i) FROM s) - i <= 2, false) AS fresh FROM supplier LEFT JOIN last ON last.symbol = s_suppkey LEFT JOIN s ON s.d = last.d""")
def metric_freshness(spark, d):
    x = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("symbol"), F.to_date("l_shipdate").alias("trade_date"), F.lit("ok").alias("quality"))
    return coverage.metric_freshness(x, table(spark, d, "supplier").select(F.col("s_suppkey").alias("symbol")), x, ["symbol"], "trade_date")


@query("SELECT month, age, CASE WHEN age < 2 THEN 'recent' ELSE 'rotating' END AS reason FROM (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(date_diff('month', date_trunc('month', o_orderdate), TIMESTAMP '2001-08-01') AS INTEGER) AS age FROM orders) WHERE age >= 0 AND (age < 2 OR age = 2 + dayofyear(DATE '2001-08-15') % 12)")
def revision_ranges(spark, d):
    return coverage.revision_ranges(table(spark, d, "orders"), "o_orderdate", "2001-08-15")


@query("""WITH g AS (SELECT l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS start_date, CAST(l_shipdate AS DATE) + CAST(l_linenumber AS INTEGER) AS end_date FROM lineitem)
SELECT symbol, start_date, end_date, CASE WHEN start_date >= DATE '1997-01-01' AND end_date <= DATE '1997-01-31' THEN 'winter' WHEN start_date >= DATE '1998-07-01' AND end_date <= DATE '1998-07-20' THEN 'summer' END AS reason, coalesce((start_date >= DATE '1997-01-01' AND end_date <= DATE '1997-01-31') OR (start_date >= DATE '1998-07-01' AND end_date <= DATE '1998-07-20'), false) AS explained FROM g""")
def closure_explained_gaps(spark, d):
    g = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("symbol"), F.to_date("l_shipdate").alias("start_date"), F.expr("date_add(to_date(l_shipdate), l_linenumber)").alias("end_date"))
    c = spark.createDataFrame([("1997-01-01", "1997-01-31", "winter"), ("1998-07-01", "1998-07-20", "summer")], "a string, b string, reason string").select(F.col("a").cast("date").alias("start_date"), F.col("b").cast("date").alias("end_date"), "reason")
    return coverage.explained_gaps(g, c)


@query(f"""WITH {BARS}, c AS (SELECT symbol, date_trunc('month', trade_date) AS ts, CASE WHEN symbol % 6 = 0 THEN max(high) + 1 ELSE max(high) END AS high, CASE WHEN symbol % 4 = 0 THEN sum(volume) + 1 ELSE sum(volume) END AS volume FROM bars GROUP BY symbol, date_trunc('month', trade_date))
SELECT symbol, CAST(ts AS DATE) AS month, CASE WHEN symbol % 6 = 0 THEN 'price' WHEN symbol % 4 = 0 THEN 'volume' ELSE 'equal' END AS status FROM c""")
def bar_reconcile(spark, d):
    from tickloom.operators.aggregates import bars_resample

    b, month = bars(spark, d).withColumnRenamed("trade_date", "ts"), F.date_trunc("month", "ts")
    c = bars_resample(b, ["symbol"], "ts", month, "ts").drop("n").withColumn("high", F.col("high") + F.when(F.col("symbol") % 6 == 0, 1).otherwise(0)).withColumn("volume", F.col("volume") + F.when(F.col("symbol") % 4 == 0, 1).otherwise(0))
    return coverage.bar_reconcile(c, b, ["symbol"], month).select("symbol", F.to_date("ts").alias("month"), "status")


@query(f"""WITH {BARS}, x AS (SELECT symbol, CASE WHEN symbol % 7 = 0 THEN -open ELSE open END AS open, high, low, close, volume - 30 AS volume FROM bars)
SELECT symbol, 'invalid' AS issue, count(*) AS n FROM x WHERE open <= 0 GROUP BY 1 UNION ALL SELECT symbol, 'negative', count(*) FROM x WHERE volume < 0 GROUP BY 1""")
def quality_report(spark, d):
    b = bars(spark, d).withColumn("open", F.col("open") * F.when(F.col("symbol") % 7 == 0, -1).otherwise(1)).withColumn("volume", F.col("volume") - 30)
    return coverage.quality_report(b, ["symbol"], "trade_date", 1440)


@query("""WITH h AS (SELECT date_trunc('hour', ts) AS ts FROM events WHERE event_type IN ('click', 'view') GROUP BY 1 HAVING count(DISTINCT event_type) = 2), g AS (SELECT ts, CAST(epoch(ts) AS BIGINT) // 3600 - row_number() OVER (ORDER BY ts) AS g FROM h)
SELECT min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS hours FROM g GROUP BY g""")
def common_ranges(spark, d):
    e = table(spark, d, "events").select("event_type", F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("ts"))
    out = coverage.common_ranges([e.where("event_type = 'click'"), e.where("event_type = 'view'")])
    return out.select(F.col("start_ts").cast("timestamp_ntz"), F.col("end_ts").cast("timestamp_ntz"), "hours")


@query("SELECT o_orderkey, n_missing FROM (SELECT o_orderkey, CASE WHEN l.k IS NULL THEN 1 ELSE 0 END AS n_missing FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_linestatus = 'F') l ON l.k = o_orderkey) WHERE n_missing = 1")
def anti_coverage(spark, d):
    from tickloom.operators.joins import coverage_gaps

    expected = table(spark, d, "orders").select("o_orderkey")
    actual = table(spark, d, "lineitem").where("l_linestatus = 'F'").select(F.col("l_orderkey").alias("o_orderkey"))
    return coverage_gaps(expected, actual, ["o_orderkey"]).where("issue = 'missing'").select("o_orderkey", F.lit(1).alias("n_missing"))


@query("SELECT 'customer' AS name, 'described' AS presence, 'TABLE' AS kind, CAST(NULL AS BIGINT) AS n, CAST(NULL AS VARCHAR) AS first_time, CAST(NULL AS VARCHAR) AS last_time, '' AS upstream, 'dim' AS tags UNION ALL SELECT 'events', 'both', 'TABLE', count(*), strftime(min(ts), '%Y-%m-%d'), strftime(max(ts), '%Y-%m-%d'), '', 'stream' FROM events UNION ALL SELECT 'orders', 'both', 'TABLE', count(*), strftime(min(o_orderdate), '%Y-%m-%d'), strftime(max(o_orderdate), '%Y-%m-%d'), 'customer', 'trade,daily' FROM orders UNION ALL SELECT 'part', 'physical', 'TABLE', count(*), NULL, NULL, '', '' FROM part")
def catalog_list(spark, d):
    return _catalog(spark, d)


def _catalog(spark, d):
    customer = Dataset("customer", (Field("c_custkey", "bigint"),), ("c_custkey",), tags=("dim",))
    return catalog.catalog_list(spark, [ORDERS, EVENTS, customer], {n: table(spark, d, n) for n in ("orders", "events", "part")})


@query("SELECT 'orders' AS name, count(*) AS n FROM orders")
def catalog_filter(spark, d):
    return catalog.catalog_filter(_catalog(spark, d), presence="both", tag="daily", text="ORD").select("name", "n")


@query("SELECT 'part' AS name, count(*) AS n FROM part UNION ALL SELECT 'orders', count(*) FROM orders")
def catalog_page(spark, d):
    return catalog.catalog_page(_catalog(spark, d), 1, 2).select("name", "n")


@query("WITH t AS (SELECT 'trade' AS tag UNION ALL SELECT 'daily' UNION ALL SELECT lower(event_type) FROM (SELECT DISTINCT event_type FROM events)) SELECT tag, count(*) AS n FROM t GROUP BY 1")
def catalog_tags(spark, d):
    """Tags of the described orders, and of one dataset for each kind of event that the table holds."""
    kinds = table(spark, d, "events").select(F.lower("event_type").alias("tags")).distinct()
    return catalog.catalog_tags(_catalog(spark, d).where("name = 'orders'").select("tags").unionByName(kinds))


@query("SELECT count(*) AS n, sum(o_totalprice) > 0 AS positive FROM orders")
def export_manifest(spark, d):
    from tickloom.sources.tables import content

    o = table(spark, d, "orders")
    return content(o).select("n").crossJoin(F.broadcast(o.agg((F.sum("o_totalprice") > 0).alias("positive"))))  # two single rows


@query("""SELECT 'orders' AS dataset, rule, (SELECT count(*) FROM orders) AS rows, bad, bad > 0 AS failed FROM (SELECT 'cheap' AS rule, count(*) FILTER (o_totalprice < 5000) AS bad FROM orders UNION ALL SELECT 'late', count(*) FILTER (o_orderdate >= TIMESTAMP '2100-01-01') FROM orders)""")
def register_quality_rule(spark, d):
    rules = rows.register_quality_rule({}, "orders", "cheap", "o_totalprice < 5000")
    rules = rows.register_quality_rule(rules, "orders", "late", F.col("o_orderdate") >= F.lit("2100-01-01").cast("timestamp"))
    return rows.quality_failures(table(spark, d, "orders"), "orders", [], rules["orders"])


@query("""WITH c AS (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN '600' WHEN 1 THEN '688' WHEN 2 THEN '000' WHEN 3 THEN '300' WHEN 4 THEN '920' ELSE '510' END || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') || CASE o_orderkey % 6 WHEN 2 THEN '.SZ' WHEN 3 THEN '.SZ' WHEN 4 THEN '.BJ' ELSE '.SH' END AS code FROM orders) SELECT o_orderkey, code, o_orderkey % 6 <> 5 AS ordinary FROM c""")
def ordinary_share(spark, d):
    from tickloom.functions.scalars import ordinary_share as ordinary

    k = F.col("o_orderkey")
    pick = lambda *values: F.element_at(F.array(*map(F.lit, values)), (k % 6 + 1).cast("int"))
    code = F.concat(pick("600", "688", "000", "300", "920", "510"), F.lpad((k % 1000).cast("string"), 3, "0"), pick(".SH", ".SH", ".SZ", ".SZ", ".BJ", ".SH"))
    return table(spark, d, "orders").select("o_orderkey", code.alias("code")).withColumn("ordinary", ordinary("code"))


@query("SELECT event_id, CASE WHEN hour(ts + INTERVAL 8 HOUR) * 60 + minute(ts + INTERVAL 8 HOUR) >= 1230 THEN (ts + INTERVAL 8 HOUR)::DATE ELSE (ts + INTERVAL 8 HOUR)::DATE - 1 END AS last_day FROM events")
def completion_ceiling(spark, d):
    from tickloom.functions.scalars import completion_ceiling as ceiling

    return table(spark, d, "events").select("event_id", ceiling(F.col("ts").cast("timestamp")).alias("last_day"))


@query("SELECT o_orderkey, ROUND((coalesce(a, b) + coalesce(b, a)) / 2, 6) + 0.0 AS mid FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS a, CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice * 2 END AS b FROM orders)")
def forecast_mid(spark, d):
    k = F.col("o_orderkey")
    o = table(spark, d, "orders").select("o_orderkey", F.when(k % 3 != 0, F.col("o_totalprice")).alias("a"), F.when(k % 4 != 0, F.col("o_totalprice") * 2).alias("b"))
    return o.select("o_orderkey", r(rows.forecast_mid("a", "b")).alias("mid"))


@query("SELECT x.*, n FROM (SELECT unnest([0, 1, 2, 3, 4, 5]) AS position, unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate', 'o_orderpriority']) AS \"column\", unnest([true, false, false, false, false, false]) AS is_key) x CROSS JOIN (SELECT count(*) AS n FROM orders)")
def catalog_detail(spark, d):
    """The described columns, with the rows of the table that has them."""
    n = table(spark, d, "orders").agg(F.count("*").alias("n"))
    return catalog.catalog_detail(spark, ORDERS).select("position", "column", "is_key").crossJoin(F.broadcast(n))  # one row
