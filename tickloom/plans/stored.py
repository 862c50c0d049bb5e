"""Sources and sinks: tables written to the shared folder in some layout or text form, and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.model import Dataset, Field
from tickloom.operators import merge, rows
from tickloom.operators.crosssection import score_mean_rank as mean_rank
from tickloom.plans.base import BARS, RET, bars, folder, r, returns, rounded, table, tasks
from tickloom.plans.series import rnd
from tickloom.sources import readers, tables

QUERIES: dict = {}
PRICES = Dataset("order_prices", (Field("o_orderkey", "bigint", required=True), Field("price", "double"), Field("year", "int")), ("o_orderkey", "year"), "year", ("year",))


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = (f, sql)
        return f

    return add


def _prices(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"), F.year("o_orderdate").alias("year")).repartition("year")


@query(f"SELECT o_orderkey, {rnd('o_totalprice')} AS price, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders")
def write_dataset(spark, d):
    to = folder(spark)
    tables.write_dataset(_prices(spark, d), PRICES, to)
    return rounded(spark.read.parquet(to), "price")


@query(f"SELECT o_orderkey, {rnd('CASE WHEN year(o_orderdate) IN (1996, 1997) THEN o_totalprice * 2 ELSE o_totalprice END')} AS price, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders")
def replace_window(spark, d):
    to = folder(spark)
    tables.write_dataset(_prices(spark, d), PRICES, to)
    new = _prices(spark, d).where("year between 1996 and 1997").withColumn("price", F.col("price") * 2)
    tables.replace_window(new, PRICES, to, "year", 1996, 1998)
    return rounded(spark.read.parquet(to), "price")


@query(f"SELECT event_id, event_type, {rnd('value')} AS value, version FROM events CROSS JOIN (SELECT unnest([1, 2]) AS version)")
def compact_day(spark, d):
    """A day's rows before and after compaction: versions 1 and 2 of its manifest."""
    day = tables.VersionedDay(spark, folder(spark))
    day.publish(table(spark, d, "events").repartition(16))
    before = day.rows()
    day.compact(["ts", "event_id"])
    both = before.withColumn("version", F.lit(1)).unionByName(day.rows().withColumn("version", F.lit(2)))
    return rounded(both.select("event_id", "event_type", "value", "version"), "value")


@query(f"SELECT event_id, event_type, {rnd('value')} AS value, 1::BIGINT AS version, true AS refused FROM events")
def compact_day_refused(spark, d):
    """A compaction that loses rows is refused, and readers go on with the old version."""
    day = tables.VersionedDay(spark, folder(spark))
    day.publish(table(spark, d, "events").repartition(16))
    try:
        day.compact(["ts", "event_id"], prepare=lambda rows: rows.where("event_id % 50 <> 7"))
        refused = False
    except RuntimeError:
        refused = True
    out = day.rows().select("event_id", "event_type", "value", F.lit(day.entry().version).cast("long").alias("version"), F.lit(refused).alias("refused"))
    return rounded(out, "value")


@query(f"SELECT o_orderkey, o_orderpriority, {rnd('o_totalprice')} AS o_totalprice FROM orders")
def export_csv(spark, d):
    to = f"{folder(spark)}/csv"
    out = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    tables.export_table(out, to, "csv")
    return rounded(spark.read.schema(out.schema).option("header", True).csv(to), "o_totalprice")


@query(f"SELECT o_orderkey, o_orderpriority, {rnd('o_totalprice')} AS o_totalprice, count(*) OVER () AS n, 'o_orderkey,o_orderpriority,o_totalprice' AS columns FROM orders")
def export_parquet(spark, d):
    """The exported rows, read back, with the manifest's count and names."""
    to = f"{folder(spark)}/parquet"
    out = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    manifest = tables.export_table(out, to).select("n", "columns")  # one row
    return rounded(spark.read.parquet(to).crossJoin(F.broadcast(manifest)), "o_totalprice")


@query(f"WITH {BARS} SELECT trade_date, {rnd('max(close)', 8)} AS close FROM bars WHERE trade_date >= DATE '1990-01-01' GROUP BY 1")
def read_index_close_csv(spark, d):
    to = folder(spark)
    day = bars(spark, d).groupBy("trade_date").agg(F.max("open").alias("OPEN"), F.max("high").alias("HIGH"), F.min("low").alias("LOW"), F.max("close").alias("CLOSE"))
    day.select(F.date_format("trade_date", "MM/dd/yyyy").alias("DATE"), "OPEN", "HIGH", "LOW", "CLOSE").write.option("header", True).csv(to)
    return rounded(readers.read_index_close_csv(spark, to, "1990-01-01", "2100-01-01"), "close", n=8)


@query(f"SELECT event_id AS trades, date_trunc('second', ts) AS ts, {rnd('value')} AS close FROM events WHERE event_type <> 'error'")
def read_exchange_bar_csv(spark, d):
    """Archive rows in milliseconds or microseconds; errors are bars of no volume that close before they open."""
    to = folder(spark)
    e = table(spark, d, "events").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    unit = F.when(F.col("event_id") % 2 == 0, 1000).otherwise(1)
    bad = F.col("event_type") == "error"
    begin = F.floor(F.col("us") / unit)
    end = F.when(bad, begin - 1).otherwise(begin + 59_999_999 / unit).cast("long")
    e.select(begin, *(F.col("value") for _ in range(4)), F.when(bad, 0.0).otherwise(1.0), end, F.lit(0.0), "event_id", F.lit(0.0), F.lit(0.0), F.lit("0")).toDF(*(c.split()[0] for c in readers.BAR_CSV.split(", "))).write.csv(to)
    kept = readers.read_exchange_bar_csv(spark, to)[0]
    return rounded(kept.select("trades", F.date_trunc("second", "ts").cast("timestamp_ntz").alias("ts"), "close"), "close")


@query("SELECT CAST(l_shipdate AS DATE) AS date, CASE WHEN day(l_shipdate) <> 1 THEN sum(l_quantity) END AS value FROM lineitem GROUP BY 1, day(l_shipdate)")
def read_fred_csv(spark, d):
    to = folder(spark)
    day = table(spark, d, "lineitem").groupBy(F.to_date("l_shipdate").alias("date")).agg(F.sum("l_quantity").alias("value"))
    day.select("date", F.when(F.dayofmonth("date") == 1, ".").otherwise(F.col("value").cast("string")).alias("value")).write.option("header", True).csv(to)
    return readers.read_fred_csv(spark, to)


@query("SELECT CAST(l_shipdate AS DATE) AS time, CAST(count(*) AS DOUBLE) AS n, sum(l_quantity) AS volume FROM lineitem GROUP BY 1")
def read_onchain_csv(spark, d):
    to = folder(spark)
    table(spark, d, "lineitem").groupBy(F.to_date("l_shipdate").alias("time")).agg(F.count("*").alias("n"), F.sum("l_quantity").alias("volume")).write.option("header", True).csv(to)
    return readers.read_onchain_csv(spark, to, ["n", "volume"])


@query("SELECT CAST(l_shipdate AS DATE) AS date, sum(l_quantity) AS total_usd FROM lineitem GROUP BY 1")
def read_stablecoin_json(spark, d):
    """One document for each day, with a total for each return flag as its peg."""
    pegs = table(spark, d, "lineitem").groupBy(F.to_date("l_shipdate").alias("day"), "l_returnflag").agg(F.sum("l_quantity").alias("v"))
    day = pegs.groupBy("day").agg(F.map_from_entries(F.collect_list(F.struct("l_returnflag", "v"))).alias("totalCirculatingUSD"))
    at = F.unix_seconds(F.col("day").cast("timestamp")).cast("string").alias("date")
    return readers.stablecoin_totals(day.select(F.to_json(F.array(F.struct(at, "totalCirculatingUSD"))).alias("value")))


@query("SELECT translate(CAST(p_partkey AS VARCHAR), '0123456789', 'ABCDEFGHIJ') AS symbol, CASE WHEN p_size > 40 THEN 'TEST_ISSUE' WHEN p_type = 'ECONOMY' THEN 'ETF' WHEN length(CAST(p_partkey AS VARCHAR)) > 5 THEN 'SYMBOL_MAPPING' ELSE 'IN_SCOPE' END AS scope_reason FROM part")
def read_listing_snapshot(spark, d):
    to = folder(spark)
    flag = lambda c: F.when(c, "Y").otherwise("N")
    p = table(spark, d, "part").withColumn("symbol", F.translate(F.col("p_partkey").cast("string"), "0123456789", "ABCDEFGHIJ")).withColumn("ETF", flag(F.col("p_type") == "ECONOMY")).withColumn("Test Issue", flag(F.col("p_size") > 40)).withColumnRenamed("p_name", "Security Name")
    text = lambda df, name: df.write.option("header", True).option("sep", "|").csv(f"{to}/{name}")
    text(p.where("p_partkey % 2 = 0").select(F.col("symbol").alias("Symbol"), "Security Name", "ETF", "Test Issue"), "main")
    text(p.where("p_partkey % 2 = 1").select(F.col("symbol").alias("ACT Symbol"), "Security Name", F.col("p_brand").alias("Exchange"), "ETF", "Test Issue"), "other")
    return readers.read_listing_snapshot(spark, f"{to}/main", f"{to}/other").select("symbol", "scope_reason")


@query("SELECT o_orderkey AS ticker, CASE WHEN o_orderpriority LIKE '5%' THEN 'EXCHANGE' WHEN o_orderstatus <> 'F' THEN 'ASSET_TYPE' WHEN CAST(o_orderdate AS DATE) + 90 < DATE '1996-01-01' OR CAST(o_orderdate AS DATE) >= DATE '1998-01-01' THEN 'WINDOW' ELSE 'IN_SCOPE' END AS scope_reason FROM orders")
def read_security_history(spark, d):
    to = folder(spark)
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("ticker"), F.substring("o_orderpriority", 1, 1).alias("exchange"), F.col("o_orderstatus").alias("asset_type"), F.lit("USD").alias("currency"), F.to_date("o_orderdate").alias("start_date"), F.date_add(F.to_date("o_orderdate"), 90).alias("end_date"))
    o.write.option("header", True).csv(to)
    found = readers.read_security_history(spark, to, ["1", "2", "3", "4"], "F", "1996-01-01", "1998-01-01")
    return found.select(F.col("ticker").cast("long").alias("ticker"), "scope_reason")


@query(f"WITH {BARS} SELECT symbol, trade_date, NULL::DOUBLE AS pre_close, ROUND(close / open - 1, 6) + 0.0 AS pct_chg FROM bars")
def rename_index_fields(spark, d):
    return rounded(rows.rename_index_fields(bars(spark, d).select("symbol", "trade_date", (F.col("close") / F.col("open") - 1).alias("pct_change"))), "pct_chg")


@query(f"WITH {BARS} SELECT symbol, trade_date FROM bars WHERE low <= least(open, volume * 30) AND greatest(open, volume * 30) <= high")
def require_ohlc_inside(spark, d):
    """Thirty times the volume stands for the close, so that some bars break."""
    b = bars(spark, d).withColumn("close", F.col("volume") * 30)
    return b.where(rows.ohlc_inside()).select("symbol", "trade_date")


@query(f"""WITH {RET}, x AS (SELECT *, CASE WHEN volume > 25 THEN volume END AS v FROM ret),
k AS (SELECT *, CASE WHEN v IS NOT NULL THEN (rank() OVER (PARTITION BY trade_date ORDER BY v NULLS LAST) + (count(v) OVER (PARTITION BY trade_date, v) - 1) / 2.0) / count(v) OVER (PARTITION BY trade_date) END AS a, CASE WHEN ret_1 IS NOT NULL THEN (rank() OVER (PARTITION BY trade_date ORDER BY ret_1 NULLS LAST) + (count(ret_1) OVER (PARTITION BY trade_date, ret_1) - 1) / 2.0) / count(ret_1) OVER (PARTITION BY trade_date) END AS b FROM x)
SELECT symbol, trade_date, {rnd("coalesce((coalesce(a, 0) + coalesce(b, 0)) / nullif((a IS NOT NULL)::INTEGER + (b IS NOT NULL)::INTEGER, 0), 0.5)")} AS score FROM k""")
def score_mean_rank(spark, d):
    x = returns(spark, d).withColumn("v", F.when(F.col("volume") > 25, F.col("volume"))).select("symbol", "trade_date", "v", "ret_1").repartition(tasks(spark, d), "trade_date")
    return x.select("symbol", "trade_date", r(mean_rank(["v", "ret_1"], ["trade_date"])).alias("score"))


@query(f"WITH {BARS} SELECT CAST(date_trunc('month', trade_date) AS DATE) AS month, count(*) AS n, count(*) FILTER (volume <= 49) AS matched, count(*) FILTER (volume > 49) = 0 AS verified FROM bars GROUP BY 1")
def bundle_verify(spark, d):
    """Bars of more than 49 pieces are stored with another volume."""
    b = bars(spark, d)
    to = folder(spark)
    b.withColumn("volume", F.when(F.col("volume") > 49, F.col("volume") + 1).otherwise(F.col("volume"))).write.parquet(to)
    return merge.bundle_verify(b, spark.read.parquet(to), ["symbol", "trade_date"], ["close", "volume"], "trade_date")


#: Hadoop settings for very many small files: a local disk gets no checksum file beside each, which costs as much as the
#: file itself. Other file systems have none, and aren't named here.
SMALL_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def _l2_folders(spark, d, what: str) -> str:
    """events as level-2 files in GB18030, a folder for each day and symbol."""
    to = folder(spark)
    e = table(spark, d, "events")
    k, ts = F.col("event_id"), F.col("ts").cast("timestamp")
    clock = F.date_format(ts, "HHmmssSSS")
    cents, volume, ident = F.round((F.col("value") + 10) * 10_000).cast("long"), (k % 50 + 1) * 100, F.concat((k % 97).cast("string"), F.when(k % 5 == 0, ".0").otherwise(""))
    kind = F.col("event_type")
    if what == "deal":
        code = F.when(kind == "click", "B").when(kind == "signup", " s").when(kind == "error", F.when(k % 2 == 0, "BC").otherwise("SC")).otherwise("X")
        cells = {"序号": k, "时间": clock, "价格": cents, "数量": volume, "方向": code, "成交号": k, "买号": ident, "卖号": ident}
    else:
        cells = {"序号": k, "时间": clock, "价格": cents, "数量": volume, "方向": F.when(k % 2 == 0, "B").otherwise("S"), "类型": F.when(kind == "error", "D").when(kind == "view", "?").otherwise((k % 2).cast("string")), "委托号": ident}
    rows = e.select(*(c.alias(name.encode("gb18030").decode("latin-1")) for name, c in cells.items()), F.date_format(ts, "yyyyMMdd").alias("trade_date"), F.floor(F.col("user_id") / 75).alias("symbol"))
    rows.repartition("trade_date", "symbol").write.partitionBy("trade_date", "symbol").options(**SMALL_FILES).option("header", True).option("encoding", "ISO-8859-1").csv(to)
    return to


_L2 = "event_id AS seq, (epoch_us(ts) - epoch_us(ts::DATE::TIMESTAMP)) // 1000 AS time, ROUND(round((value + 10) * 10000) / 10000, 6) + 0.0 AS price, (event_id % 50 + 1) * 100.0::DOUBLE AS volume"
_PLACE = "(user_id // 75)::VARCHAR AS symbol, ts::DATE AS trade_date FROM events"


@query(f"SELECT {_L2}, CASE event_type WHEN 'click' THEN 0 WHEN 'signup' THEN 1 ELSE CASE WHEN event_id % 2 = 0 THEN -1 ELSE -11 END END AS side, event_id::VARCHAR AS deal_id, (event_id % 97)::VARCHAR AS buy_id, (event_id % 97)::VARCHAR AS sell_id, {_PLACE} WHERE event_type IN ('click', 'signup', 'error')")
def read_l2_csv_day(spark, d):
    """Trades of all days and symbols from level-2 text folders."""
    return rounded(readers.read_l2_csv_day(spark, _l2_folders(spark, d, "deal"), "deal", files="part-*.csv"), "price")


@query(f"SELECT {_L2}, CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN -1 ELSE -11 END ELSE event_id % 2 + CASE WHEN event_id % 2 = 1 THEN 10 ELSE 0 END END AS type, (event_id % 97)::VARCHAR AS id, {_PLACE} WHERE event_type <> 'view'")
def read_l2_csv_orders(spark, d):
    """Orders of all days and symbols from level-2 text folders."""
    return rounded(readers.read_l2_csv_day(spark, _l2_folders(spark, d, "order"), "order", files="part-*.csv"), "price")
