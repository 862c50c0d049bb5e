"""The driver's tables in the roles that operators expect, and the same as SQL.

lineitem is the bar feed: supplier is the symbol, ship date the session, extended price over quantity the price.
events is the tick stream: user is the symbol; click and signup buy, the others sell.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.sources.tables import stored_bytes


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def folder(spark: SparkSession) -> str:
    """A new folder in the one that the cluster shares; only a session on one machine may go without."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="tickloom-")
    return f"{shared.rstrip('/')}/tables-{uuid.uuid4().hex}"


def staged(spark: SparkSession, parts: Iterable[DataFrame], path: str) -> DataFrame:
    """Parts of one schema as a stream, one a micro-batch: each is written as the same number of files, with empty ones where rows don't fill them."""
    files = spark.sparkContext.defaultParallelism
    to = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = to.getFileSystem(spark._jsc.hadoopConfiguration())
    count = lambda: sum(f.getPath().getName().startswith("part-") for f in fs.listStatus(to))
    for part in parts:
        schema = part.schema
        had = count() if fs.exists(to) else 0
        part.repartition(files).write.mode("append").parquet(path)
        for _ in range(had + files - count()):
            spark.createDataFrame([], schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def r(c: Column | str, n: int = 6) -> Column:
    """Rounded for comparison, without a negative zero."""
    return F.round(F.col(c) if isinstance(c, str) else c, n) + F.lit(0.0)


def rounded(df: DataFrame, *columns: str, n: int = 6) -> DataFrame:
    return df.withColumns({c: r(c, n) for c in columns})


#: Stored bytes of lineitem, some 18 a row, whose bars one task makes.
TASK_BYTES = 4 << 20


def tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks for bars, so that each has some TASK_BYTES of lineitem and its memory stays the same at any size."""
    return max(spark.sparkContext.defaultParallelism, -(-stored_bytes(spark, f"{sf_dir}/lineitem.parquet") // TASK_BYTES))


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars by symbol and day. Rows meet by symbol before they are added up: some nine of ten bars have one row, so sums
    wouldn't make the shuffle smaller, and windows of a symbol need no second one."""
    t = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity").repartition(tasks(spark, sf_dir), "l_suppkey")
    px = F.col("l_extendedprice") / F.col("l_quantity")
    o = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * (1 << 20) + F.col("l_partkey") % (1 << 20)  # one number, so that the aggregate hashes and doesn't sort
    day = F.to_date("l_shipdate")
    return t.groupBy(F.col("l_suppkey").alias("symbol"), day.alias("trade_date")).agg(F.min_by(px, o).alias("open"), F.max(px).alias("high"), F.min(px).alias("low"), F.max_by(px, o).alias("close"), F.sum("l_quantity").alias("volume"), F.sum("l_extendedprice").alias("amount"))


BARS = """bars AS (
  SELECT symbol, trade_date, first(px ORDER BY a, b, c, d) AS open, max(px) AS high, min(px) AS low, last(px ORDER BY a, b, c, d) AS close, sum(q) AS volume, sum(d) AS amount
  FROM (SELECT l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS trade_date, l_extendedprice / l_quantity AS px, l_orderkey AS a, l_linenumber AS b, l_partkey AS c, l_extendedprice AS d, l_quantity AS q FROM lineitem)
  GROUP BY symbol, trade_date)"""

RET = f"""{BARS}, ret AS (
  SELECT *, CASE WHEN abs(prev) > 1e-12 THEN close / prev END - 1 AS ret_1 FROM (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY trade_date) AS prev FROM bars))"""


def returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickloom.functions.rolling import ordered, pct_change

    return bars(spark, sf_dir).withColumn("ret_1", pct_change("close", 1, ordered("symbol", "trade_date")))


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier as security master: industry is its nation's region, size its balance."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_regionkey").alias("industry"))
    return s.join(n, "s_nationkey", "left").select(F.col("s_suppkey").alias("symbol"), F.col("s_name").alias("name"), "industry", F.col("s_acctbal").alias("size"))


MASTER = "master AS (SELECT s_suppkey AS symbol, s_name AS name, n_regionkey AS industry, s_acctbal AS size FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey)"


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as trades of symbol-days; time in milliseconds of the day."""
    e = table(spark, sf_dir, "events")
    day = F.to_date("ts")
    micros = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(day.cast("timestamp"))
    side = F.when(F.col("event_type").isin("click", "signup"), 0).otherwise(1)
    volume = (F.col("event_id") % 50 + 1) * 100.0
    return e.select(F.col("user_id").alias("symbol"), day.alias("trade_date"), F.col("event_id").alias("seq"), (micros / 1000).cast("long").alias("time"), (F.col("value") + 10).alias("price"), volume.alias("volume"), side.alias("side"), F.col("event_id").cast("string").alias("deal_id"), (F.col("event_id") % 97).cast("string").alias("buy_id"), (F.col("event_id") % 89).cast("string").alias("sell_id"), "event_type")


TICKS = """ticks AS (
  SELECT user_id AS symbol, CAST(ts AS DATE) AS trade_date, event_id AS seq, (epoch_us(ts) - epoch_us(CAST(CAST(ts AS DATE) AS TIMESTAMP))) // 1000 AS time, value + 10 AS price, (event_id % 50 + 1) * 100.0::DOUBLE AS volume,
  CASE WHEN event_type IN ('click', 'signup') THEN 0 ELSE 1 END AS side, CAST(event_id AS VARCHAR) AS deal_id, CAST(event_id % 97 AS VARCHAR) AS buy_id, CAST(event_id % 89 AS VARCHAR) AS sell_id, event_type FROM events)"""


def book_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as orders: errors are cancels, ids repeat so that trades find them."""
    t = ticks(spark, sf_dir)
    sell = F.col("side") == 1
    kind = F.when(F.col("event_type") == "error", F.when(F.col("seq") % 2 == 0, -1).otherwise(-11)).when(sell, 10).otherwise(0)
    return t.select("symbol", "trade_date", "seq", "time", (F.col("price") - 0.01).alias("price"), "volume", kind.alias("type"), (F.col("seq") % 97).cast("string").alias("id"))


def book_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as ten-level snapshots around each event's price."""
    t = ticks(spark, sf_dir)
    level = lambda sign: F.transform(F.sequence(F.lit(1), F.lit(10)), lambda k: F.col("price") + sign * k * 0.01)
    size = lambda m: F.transform(F.sequence(F.lit(1), F.lit(10)), lambda k: ((F.col("seq") * m + k) % 20 + 1) * 100.0)
    return t.select("symbol", "trade_date", "seq", "time", level(-1).alias("bid_price"), level(1).alias("ask_price"), size(3).alias("bid_volume"), size(7).alias("ask_volume"))


def level2(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """events as one month's deals, orders and quotes of symbols made of 75 users each, so days are as dense at any size.

    Times of the day are pressed into 9:15 to 15:00. Prices move within a few ticks; every thirteenth deal is a large
    one; errors are cancels; some quotes are locked, crossed or empty, some ids end in .0, some are missing.
    """
    e = table(spark, sf_dir, "events")
    day = F.to_date("ts")
    millis = F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(day.cast("timestamp"))) / 1000)
    k = F.col("event_id")
    bought, failed = F.col("event_type").isin("click", "signup"), F.col("event_type") == "error"
    x = e.select(F.floor(F.col("user_id") / 75).alias("symbol"), F.to_date(F.date_trunc("month", "ts")).alias("trade_date"), k.alias("seq"), (F.lit(33_300_000) + F.floor(millis * 20_700_000 / 86_400_000)).alias("time"), (10 + k % 7 * 0.01).alias("price"), bought.alias("bought"), failed.alias("failed"))
    k = F.col("seq")
    base = ["symbol", "trade_date", "seq", "time"]
    text = lambda c: c.cast("string")
    volume = ((k % 50 + 1) * F.when(k % 13 == 0, 10_000.0).otherwise(100.0)).alias("volume")
    side = F.when(F.col("failed"), F.when(k % 2 == 0, -1).otherwise(-11)).when(F.col("bought"), 0).otherwise(1)
    deals = x.select(*base, "price", volume, side.alias("side"), F.concat(text(k % 997), F.when(k % 5 == 0, ".0").otherwise("")).alias("buy_id"), F.when(k % 11 != 0, text(k * 3 % 997)).alias("sell_id"))
    kind = F.when(F.col("failed"), F.when(F.floor(k / 2) % 2 == 0, -1).otherwise(-11)).when(F.col("bought"), 0).otherwise(10)
    orders = x.select(*base, (F.col("price") + (k % 3 - 1) * 0.01).alias("price"), volume, kind.alias("type"), text(k % 997).alias("id"))
    bid = F.when(k % 53 == 0, 0.0).otherwise(10 + k % 5 * 0.01)
    ask = 10 + k % 5 * 0.01 + F.when(k % 41 == 0, -1).otherwise(k % 4) * 0.01
    levels = F.sequence(F.lit(0), F.lit(9))
    size = lambda m: F.transform(levels, lambda j: ((k * m + j) % 20 + 1) * 100.0)
    quotes = x.select(*base, "price", (k % 200 * 100.0).alias("total_bid_volume"), (k * 3 % 200 * 100.0).alias("total_ask_volume"), F.transform(levels, lambda j: F.when(bid > 0, bid - j * 0.01).otherwise(0.0)).alias("bid_price"), F.transform(levels, lambda j: ask + j * 0.01).alias("ask_price"), size(3).alias("bid_volume"), size(7).alias("ask_volume"))
    return deals, orders, quotes


_BV, _AV = ([f"((k * {m} + {j}) % 20 + 1) * 100::DOUBLE" for j in range(10)] for m in (3, 7))
LEVEL2 = f"""x AS (
  SELECT user_id // 75 AS symbol, date_trunc('month', ts)::DATE AS trade_date, event_id AS seq, event_id AS k, event_type IN ('click', 'signup') AS bought, event_type = 'error' AS failed,
    33300000 + ((epoch_us(ts) - epoch_us(CAST(CAST(ts AS DATE) AS TIMESTAMP))) // 1000) * 20700000 // 86400000 AS time, 10 + event_id % 7 * 0.01::DOUBLE AS price, (event_id % 50 + 1) * CASE WHEN event_id % 13 = 0 THEN 10000 ELSE 100 END::DOUBLE AS volume FROM events),
deals AS (SELECT symbol, trade_date, seq, time, price, volume, price * volume AS amount, CASE WHEN failed THEN CASE WHEN k % 2 = 0 THEN -1 ELSE -11 END WHEN bought THEN 0 ELSE 1 END AS side, CASE WHEN NOT failed AND bought THEN 1 ELSE -1 END AS sign, (k % 997)::VARCHAR AS buy_id, CASE WHEN k % 5 = 0 THEN '.0' ELSE '' END AS tail, CASE WHEN k % 11 <> 0 THEN (k * 3 % 997)::VARCHAR END AS sell_id FROM x),
e AS (SELECT * FROM deals WHERE side IN (0, 1)),
orders2 AS (SELECT symbol, trade_date, seq, time, price + (k % 3 - 1) * 0.01::DOUBLE AS price, volume, CASE WHEN failed THEN CASE WHEN k // 2 % 2 = 0 THEN -1 ELSE -11 END WHEN bought THEN 0 ELSE 10 END AS type, CASE WHEN failed THEN k // 2 % 2 = 0 ELSE bought END AS buy, (k % 997)::VARCHAR AS id FROM x),
q0 AS (SELECT symbol, trade_date, seq, time, price AS last, k % 200 * 100::DOUBLE AS tb, k * 3 % 200 * 100::DOUBLE AS ta, CASE WHEN k % 53 = 0 THEN 0 ELSE 10 + k % 5 * 0.01::DOUBLE END AS bid, 10 + k % 5 * 0.01::DOUBLE + CASE WHEN k % 41 = 0 THEN -1 ELSE k % 4 END * 0.01::DOUBLE AS ask, {_BV[0]} AS bid1, {_AV[0]} AS ask1, {' + '.join(_BV[:3])} AS bid3, {' + '.join(_BV[:5])} AS bid5, {' + '.join(_AV[:5])} AS ask5, {', '.join(f'({_BV[j]} + {_AV[j]}) / 2 AS l{j}' for j in range(5))} FROM x),
q AS (SELECT *, bid > 0 AND ask > bid AS valid, CASE WHEN bid > 0 AND ask > bid THEN (bid + ask) / 2 END AS mid, bid1 + ask1 AS depth1, bid5 + ask5 AS depth5 FROM q0),
qb AS (SELECT symbol, trade_date, time, arg_max(bid, seq) AS bid, arg_max(ask, seq) AS ask, arg_max(valid, seq) AS valid FROM q GROUP BY ALL),
vb AS (SELECT symbol, trade_date, time, arg_max(mid, seq) AS mid FROM q WHERE valid GROUP BY ALL),
vf AS (SELECT symbol, trade_date, time, arg_min(mid, seq) AS mid FROM q WHERE valid GROUP BY ALL),
near AS (SELECT o.*, abs(o.price - CASE WHEN o.buy THEN qb.bid ELSE qb.ask END) <= 0.01 + 1e-9 AS near_touch FROM orders2 o ASOF LEFT JOIN qb ON o.symbol = qb.symbol AND o.trade_date = qb.trade_date AND o.time >= qb.time)"""
