"""Readers of provider files: raw strings first, then typed columns, and rejects in a DataFrame of their own."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.model import Dataset, Field


def typed(f: Field) -> Column:
    """A field's column out of raw strings: blanks and sentinels are null, dates by the first format that reads."""
    raw = F.trim(F.col(f.source or f.name).cast("string"))
    raw = F.when((raw != "") & ~raw.isin(*map(str, f.sentinels)) if f.sentinels else raw != "", raw)
    if f.formats:
        return F.coalesce(*(F.try_to_timestamp(raw, F.lit(x)) for x in f.formats)).cast(f.kind)
    return raw.try_cast(f.kind)


def contract_rows(raw: DataFrame, ds: Dataset) -> tuple[DataFrame, DataFrame]:
    """(typed rows, rejects). A reject lacks a required or key value, or holds text that its type can't read.

    Missing optional source columns read as null; a footer whose first key is blank is a reject like any other.
    """
    have = set(raw.columns)
    fields = [f if (f.source or f.name) in have else Field(f.name, f.kind, "_absent") for f in ds.fields]
    raw = raw.withColumn("_absent", F.lit(None).cast("string"))
    made = raw.select(F.struct(*raw.columns).alias("_raw"), *(typed(f).alias(f.name) for f in fields))
    must = [f.name for f in ds.fields if f.required or f.name in ds.key]
    held = lambda f: F.trim(F.col("_raw")[f.source or f.name].cast("string"))
    unread = [(held(f) != "") & ~held(f).isin(*map(str, f.sentinels or ("",))) & F.col(f.name).isNull() for f in fields]
    reasons = F.array_compact(F.array(*(F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in must), *(F.when(F.coalesce(u, F.lit(False)), F.lit(f"unread {f.name}")) for f, u in zip(fields, unread, strict=True))))
    made = made.withColumn("reasons", reasons)
    return made.where(F.size("reasons") == 0).select(*(f.name for f in ds.fields)), made.where(F.size("reasons") > 0).select("_raw.*", "reasons").drop("_absent")


def read_contract_source(spark: SparkSession, path: str, ds: Dataset, form: str = "csv", **options) -> tuple[DataFrame, DataFrame]:
    schema = ", ".join(f"`{f.source or f.name}` string" for f in ds.fields)
    reader = spark.read.schema(schema).options(**options)
    return contract_rows(reader.json(path) if form == "json" else reader.option("header", True).csv(path), ds)


BAR_CSV = "open_time long, open double, high double, low double, close double, volume double, close_time long, quote_volume double, trades long, taker_base double, taker_quote double, ignored string"


def exchange_bars(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bars, set aside) of 12-column archive rows. Times are milliseconds, or microseconds from 2025 on.

    A bar of no volume that closes before it opens is set aside.
    """
    instant = lambda c: F.when(F.col(c) >= 10**15, F.timestamp_micros(c)).otherwise(F.timestamp_millis(c))
    rows = raw.where(F.col("open_time").isNotNull()).select(instant("open_time").alias("ts"), instant("close_time").alias("close_ts"), "open", "high", "low", "close", "volume", "quote_volume", "trades")
    odd = (F.col("volume") == 0) & (F.col("close_ts") < F.col("ts"))
    return rows.where(~odd), rows.where(odd)


def read_exchange_bar_csv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return exchange_bars(spark.read.schema(BAR_CSV).csv(path))


def contiguous(bars: DataFrame, minutes: int) -> DataFrame:
    """Bars that don't follow the one before at the given distance."""
    from pyspark.sql import Window

    before = F.lag("ts").over(Window.partitionBy(*[c for c in ("symbol",) if c in bars.columns]).orderBy("ts"))
    return bars.withColumn("before", before).where(F.col("ts") != F.col("before") + F.make_interval(mins=F.lit(minutes)))


CHART = "struct<symbol:string,timestamp:array<long>,open:array<double>,high:array<double>,low:array<double>,close:array<double>,volume:array<double>,adjclose:array<double>>"


def chart_rows(documents: DataFrame, text: str = "value") -> DataFrame:
    """One JSON document of parallel arrays for each symbol as one row for each time; rows without close go."""
    doc = documents.select(F.from_json(text, CHART).alias("d"))
    zipped = F.arrays_zip(*(F.col(f"d.{c}").alias(c) for c in ("timestamp", "open", "high", "low", "close", "volume", "adjclose")))
    rows = doc.select("d.symbol", F.explode(zipped).alias("x"))
    return rows.select("symbol", F.timestamp_seconds("x.timestamp").alias("ts"), "x.open", "x.high", "x.low", "x.close", "x.volume", "x.adjclose").where("close is not null")


def read_chart_json(spark: SparkSession, path: str) -> DataFrame:
    return chart_rows(spark.read.text(path, wholetext=True))


def read_fred_csv(spark: SparkSession, path: str) -> DataFrame:
    """date, value; a single point stands for a missing value."""
    return spark.read.schema("date date, value double").option("header", True).option("nullValue", ".").csv(path)


def read_onchain_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    schema = ", ".join(["time date", *(f"{c} double" for c in columns)])
    return spark.read.schema(schema).option("header", True).csv(path)


def stablecoin_totals(documents: DataFrame, text: str = "value") -> DataFrame:
    """date and the sum over all pegs of a JSON list of daily circulating totals."""
    day = F.explode(F.from_json(text, "array<struct<date:string,totalCirculatingUSD:map<string,double>>>")).alias("x")
    sums = F.aggregate(F.map_values("x.totalCirculatingUSD"), F.lit(0.0), lambda a, b: a + F.coalesce(b, F.lit(0.0)))
    return documents.select(day).select(F.to_date(F.timestamp_seconds(F.col("x.date").cast("long"))).alias("date"), sums.alias("total_usd"))


def read_stablecoin_json(spark: SparkSession, path: str) -> DataFrame:
    return stablecoin_totals(spark.read.text(path, wholetext=True))


def read_index_close_csv(spark: SparkSession, path: str, low: str, high: str) -> DataFrame:
    """Closes in index points within [low, high) of a DATE,OPEN,HIGH,LOW,CLOSE history that may begin with a BOM."""
    raw = spark.read.schema("date string, open double, high double, low double, close double").option("header", True).csv(path)
    date = F.coalesce(*(F.to_date(F.try_to_timestamp(F.regexp_replace("date", "^﻿", ""), F.lit(x))) for x in ("MM/dd/yyyy", "yyyy-MM-dd")))
    return raw.select(date.alias("trade_date"), "close").where((F.col("trade_date") >= F.lit(low)) & (F.col("trade_date") < F.lit(high)) & F.col("close").isNotNull())


def scope_reason(checks: list[tuple[Column, str]], default: str = "IN_SCOPE") -> Column:
    """The name of the first check that holds."""
    out = F.lit(default)
    for check, name in reversed(checks):
        out = F.when(F.coalesce(check, F.lit(False)), name).otherwise(out)
    return out


#: Names that mark securities other than common shares.
NOT_COMMON = r"(?i)\b(warrants?|rights?|units?|preferred|preference|notes?|debentures?|bonds?|depositary)\b"


def listing_rows(main: DataFrame, other: DataFrame) -> DataFrame:
    """Both layouts of official symbol files as one, trailer rows gone, with the reason for the scope."""
    one = main.select(F.col("Symbol").alias("symbol"), F.col("Security Name").alias("name"), F.lit("Q").alias("exchange"), F.col("ETF").alias("etf"), F.col("Test Issue").alias("test"))
    two = other.select(F.col("ACT Symbol").alias("symbol"), F.col("Security Name").alias("name"), F.col("Exchange").alias("exchange"), F.col("ETF").alias("etf"), F.col("Test Issue").alias("test"))
    rows = one.unionByName(two).where(F.col("symbol").isNotNull() & ~F.col("symbol").startswith("File Creation Time"))
    reason = scope_reason([(F.col("test") == "Y", "TEST_ISSUE"), (F.col("etf") == "Y", "ETF"), (F.col("name").rlike(NOT_COMMON), "NOT_COMMON"), (~F.col("symbol").rlike(r"^[A-Z]{1,5}(\.[A-Z])?$"), "SYMBOL_MAPPING")])
    return rows.withColumn("scope_reason", reason)


def read_listing_snapshot(spark: SparkSession, main: str, other: str) -> DataFrame:
    read = lambda path: spark.read.option("header", True).option("sep", "|").csv(path)
    return listing_rows(read(main), read(other))


def security_history(raw: DataFrame, exchanges: list[str], kind: str, low: str, high: str) -> DataFrame:
    """A vendor's catalog with the reason for which a security is out of scope: exchange, type or window."""
    start, end = F.col("start_date").try_cast("date"), F.coalesce(F.col("end_date").try_cast("date"), F.lit(high).cast("date"))
    checks = [(~F.col("exchange").isin(*exchanges), "EXCHANGE"), (F.col("asset_type") != kind, "ASSET_TYPE"), (start.isNull(), "NO_HISTORY"), ((end < F.lit(low).cast("date")) | (start >= F.lit(high).cast("date")), "WINDOW")]
    return raw.withColumn("scope_reason", scope_reason(checks))


def read_security_history(spark: SparkSession, path: str, exchanges: list[str], kind: str, low: str, high: str) -> DataFrame:
    schema = "ticker string, exchange string, asset_type string, currency string, start_date string, end_date string"
    return security_history(spark.read.schema(schema).option("header", True).csv(path), exchanges, kind, low, high)


#: Sides and order types of the level-2 files.
TRADE_SIDES = {"B": 0, "S": 1, "BC": -1, "SC": -11}
ORDER_TYPES = {"0": 0, "1": 1, "U": 2, "A": 3, "D": -1}
L2_FILES = {
    "deal": "seq long, time string, price double, volume double, side string, deal_id string, buy_id string, sell_id string",
    "order": "seq long, time string, price double, volume double, side string, kind string, id string",
}


#: A folder for each symbol and day makes many small files, and the parser gets its buffers anew for each: some 4,000
#: characters and 512 columns instead of 1 million and 20,480.
SMALL_FILES = {"inputBufferSize": 4096, "maxColumns": 512}


def code_of(c: str, codes: dict[str, int]) -> Column:
    table = F.create_map(*(F.lit(x) for pair in codes.items() for x in pair))
    return F.try_element_at(table, F.upper(F.trim(F.col(c))))


def _l2_place(rows: DataFrame, *columns: Column | str) -> DataFrame:
    """symbol and trade_date from the two folders above each file, named plainly or as name=value."""
    place = F.split(F.col("_metadata.file_path"), "/")
    named = lambda k: F.regexp_replace(F.element_at(place, k), "^[^=]*=", "")
    return rows.select(*columns, named(-2).alias("symbol"), F.to_date(named(-3), "yyyyMMdd").alias("trade_date"))


def read_l2_csv_day(spark: SparkSession, path: str, what: str, scale: float = 1e4, files: str | None = None) -> DataFrame:
    """Level-2 trades or orders of all symbols and days under path/<date>/<symbol>/, typed, by time and sequence.

    Files are in GB18030, which Spark doesn't decode, but only their headers leave ASCII, and no byte of a Chinese letter
    is one of a delimiter, quote or line end: so bytes are read one by one. The folder names give symbol and date; prices are divided by `scale`; rows of no known code go. `files` is the name or
    pattern of the files in a folder, <what>.csv if none is given.
    """
    from tickloom.functions.scalars import day_millis, plain_id

    raw = spark.read.schema(L2_FILES[what]).options(**SMALL_FILES).option("header", True).option("encoding", "ISO-8859-1").csv(f"{path}/*/*/{files or f'{what}.csv'}")
    rows = _l2_place(raw, "*")
    rows = rows.withColumn("time", day_millis("time")).withColumn("price", F.col("price") / scale)
    if what == "deal":
        rows = rows.withColumn("side", code_of("side", TRADE_SIDES))
        for c in ("buy_id", "sell_id", "deal_id"):
            rows = rows.withColumn(c, plain_id(c))
        return rows.where("side is not null")
    base = code_of("kind", ORDER_TYPES)
    sell = F.upper(F.trim(F.col("side"))) == "S"
    code = F.when(sell, F.when(base < 0, -11).otherwise(base + 10)).otherwise(base)
    return rows.withColumn("type", code).withColumn("id", plain_id("id")).drop("side", "kind").where("type is not null")


def read_l2_quotes(spark: SparkSession, path: str, scale: float = 1e4, levels: int = 10, files: str = "quote.csv") -> DataFrame:
    """Ten-level snapshots as arrays of prices and volumes."""
    from tickloom.functions.scalars import day_millis

    sides = [f"{side}_{what}{k}" for side in ("bid", "ask") for what in ("price", "volume") for k in range(1, levels + 1)]
    raw = spark.read.schema("time string, price double, volume double, turnover double, " + ", ".join(f"{c} double" for c in sides)).options(**SMALL_FILES).option("header", True).option("encoding", "ISO-8859-1").csv(f"{path}/*/*/{files}")
    row = lambda side, what, by: F.array(*(F.coalesce(F.col(f"{side}_{what}{k}"), F.lit(0.0)) / by for k in range(1, levels + 1))).alias(f"{side}_{what}")
    return _l2_place(raw, day_millis("time").alias("time"), (F.col("price") / scale).alias("price"), "volume", "turnover", row("bid", "price", scale), row("ask", "price", scale), row("bid", "volume", 1.0), row("ask", "volume", 1.0))


def union_sources(*frames: DataFrame) -> DataFrame:
    """Rows of several sources; columns that one lacks are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
