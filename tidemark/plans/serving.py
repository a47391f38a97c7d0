"""Read models over the marts."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import schemas
from tidemark.functions import indicators
from tidemark.operators import candles as c
from tidemark.operators import lake, marts, serving as s
from tidemark.plans import jobs, oracle as o
from tidemark.plans.detection import anomaly_ctes, hourly_anomalies
from tidemark.plans.registry import query, settle, settle_sql
from tidemark.session import scratch_dir
from tidemark.sources import market, seed
from tidemark.streaming import candles as sc

_M1 = f"WITH {o.TRADES}, {o.candles('M1', name='m1')}"
_API = f"""symbol, "interval", window_start, window_end, "open", high, low, "close", volume,
       {settle_sql('vwap')} AS vwap, trade_count,
       CASE WHEN "close" >= "open" THEN 'BULLISH' ELSE 'BEARISH' END AS direction,
       {settle_sql('CASE WHEN "open" > 0 THEN ("close" - "open") / "open" ELSE 0.0 END')} AS return_pct"""


def _fct(spark: SparkSession, sf_dir: str, interval: str = "M1") -> DataFrame:
    return marts.fct_candle(c.candles(market.trades(spark, sf_dir), interval))


_MARTS: dict[tuple[str, str, str], str] = {}


def _fct_mart(spark: SparkSession, sf_dir: str, interval: str = "M1") -> DataFrame:
    """The candle mart as a table with a folder for each day, as the hourly chain keeps it; built once per session."""
    rows, key = _fct(spark, sf_dir, interval), (spark.sparkContext.applicationId, sf_dir, interval)
    if key not in _MARTS:
        path = scratch_dir(spark, "fct-candle")
        lake.overwrite_days(rows, path, jobs.DAY_OF_MART["fct_candle"])
        _MARTS[key] = path
    return spark.read.schema(rows.schema).parquet(_MARTS[key])


def _api_settled(df: DataFrame) -> DataFrame:
    return df.withColumns({n: settle(F.col(n)) for n in ("vwap", "return_pct") if n in df.columns})


@query("latest_candles", f"""{_M1} SELECT {_API} FROM m1
WHERE symbol = 'BTC-USD' ORDER BY window_start DESC LIMIT 200""")
def latest_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _api_settled(s.latest_candles(_fct(spark, sf_dir), "BTC-USD", "M1", 200))


@query("latest_daily", f"""{_M1}, {o.DAILY}
SELECT symbol, trade_date, open_price AS "open", high_price AS high, low_price AS low,
       close_price AS "close", volume, {settle_sql('vwap')} AS vwap, trade_count, candle_count
FROM daily WHERE symbol = 'ETH-USD' ORDER BY trade_date DESC LIMIT 90""")
def latest_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = marts.fct_symbol_daily(_fct(spark, sf_dir))
    return _api_settled(s.latest_daily(daily, "ETH-USD", 90))


@query("live_candle", f"""WITH {o.TRADES}, {o.candles('H1')}
SELECT symbol, "interval", window_start, window_end, "open", high, low, "close", volume,
       {settle_sql('vwap')} AS vwap, trade_count, false AS is_final
FROM candles WHERE window_end > (SELECT max(event_time) FROM trades) - INTERVAL {o.GRACE['H1']}
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY window_start DESC) = 1""")
def live_candle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open hourly windows: only trades young enough to belong to one are read."""
    edge = market.newest_time(spark, sf_dir) - timedelta(seconds=60)
    young = market.trades_since(spark, sf_dir, edge.replace(minute=0, second=0, microsecond=0))
    after = F.col("window_end") > F.lit(edge.isoformat(" ")).cast("timestamp")
    still_open = c.candles(young, "H1", final=False).filter(after)
    return s.live_candles(still_open).withColumn("vwap", settle(F.col("vwap")))


_TODAY = """today AS (
  SELECT * FROM daily QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY trade_date DESC) = 1),
last60 AS (
  SELECT symbol, "close", window_start, window_end,
         row_number() OVER (PARTITION BY symbol ORDER BY window_start DESC) AS rn
  FROM m1 QUALIFY rn <= 60)"""


@query("market_rows", f"""{_M1}, {o.SYMBOLS}, {o.DAILY}, {_TODAY},
spark AS (
  SELECT symbol, count(*) AS closes, max(window_end) AS updated_at,
         max("close") FILTER (rn = 1) AS last, CAST(floor(min("close") * 100 + 0.5) AS BIGINT) AS low_cents,
         CAST(sum(CAST(floor("close" * 100 + 0.5) AS BIGINT) * (closes_total + 1 - rn)) AS BIGINT) AS weighted
  FROM (SELECT *, count(*) OVER (PARTITION BY symbol) AS closes_total FROM last60) GROUP BY symbol)
SELECT s.canonical AS symbol, s.base AS base_asset, coalesce(k.last, t.close_price) AS last,
       {settle_sql('(t.close_price - t.open_price) / nullif(t.open_price, 0) * 100')} AS change_pct,
       t.volume AS volume_24h, t.trade_count AS trades_24h, CAST(coalesce(k.closes, 0) AS INT) AS spark_size,
       k.weighted AS spark_weighted_cents, k.low_cents AS spark_low_cents, k.updated_at
FROM symbols s LEFT JOIN spark k ON k.symbol = s.canonical LEFT JOIN today t ON t.symbol = s.canonical
WHERE s.active""")
def market_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market overview; the array of closes is compared by size, minimum and position-weighted sum."""
    fct = _fct_mart(spark, sf_dir)
    dim = marts.dim_symbol(seed.read_symbol_seed(spark))
    cents = F.transform("spark", lambda x: F.floor(x * 100 + 0.5))
    weighted = F.aggregate(
        F.transform(cents, lambda x, i: x * (i + 1)), F.lit(0).cast("bigint"), lambda acc, x: acc + x
    )
    return s.market_rows(dim, fct, marts.fct_symbol_daily(fct)).select(
        "symbol", "base_asset", "last", settle(F.col("change_pct")).alias("change_pct"),
        "volume_24h", "trades_24h",
        F.size("spark").alias("spark_size"),
        weighted.alias("spark_weighted_cents"),
        F.array_min(cents).alias("spark_low_cents"),
        "updated_at",
    )


@query("stats_grid", f"""{_M1}, {o.DAILY}, {_TODAY}
SELECT t.symbol, t.trade_date, l."close" AS price,
       {settle_sql('''CASE WHEN t.high_price > t.low_price THEN
         greatest(0.0, least(1.0, (l."close" - t.low_price) / (t.high_price - t.low_price))) END''')} AS range_position,
       {settle_sql('(l."close" - t.vwap) / nullif(t.vwap, 0) * 100')} AS vwap_premium_pct
FROM today t JOIN last60 l ON l.symbol = t.symbol AND l.rn = 1""")
def stats_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    fct = _fct_mart(spark, sf_dir)
    grid = s.stats_grid(fct, marts.fct_symbol_daily(fct))
    return grid.withColumns({n: settle(F.col(n)) for n in ("range_position", "vwap_premium_pct")})


@query("sparklines", f"""{_M1}, {o.DAILY}, {_TODAY},
scaled AS (
  SELECT symbol, count(*) OVER w - rn AS pos,
         ("close" - min("close") OVER w) /
           CASE WHEN max("close") OVER w > min("close") OVER w
                THEN max("close") OVER w - min("close") OVER w ELSE 1.0 END AS point,
         first("close") OVER (PARTITION BY symbol ORDER BY rn) AS newest,
         first("close") OVER (PARTITION BY symbol ORDER BY rn DESC) AS oldest, count(*) OVER w AS n
  FROM last60 WINDOW w AS (PARTITION BY symbol))
SELECT symbol, CAST(pos AS INT) AS pos, {settle_sql('point')} AS point,
       CASE WHEN newest >= oldest THEN 'up' ELSE 'down' END AS direction
FROM scaled WHERE n >= 2""")
def sparklines(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = s.recent_closes(_fct(spark, sf_dir)).select("symbol", indicators.sparkline(F.col("spark")).alias("line"))
    return line.filter("line IS NOT NULL").select(
        "symbol", "line.direction", F.posexplode("line.points").alias("pos", "point")
    ).withColumn("point", settle(F.col("point")))


@query("merged_candle_feed", f"""WITH {o.TRADES}, {o.candles('H1')},
edge AS (SELECT max(event_time) - INTERVAL {o.GRACE['H1']} AS edge_at FROM trades)
SELECT symbol, "interval", window_start, window_end, "open", high, low, "close", volume,
       {settle_sql('vwap')} AS vwap, trade_count,
       CASE WHEN "close" >= "open" THEN 'BULLISH' ELSE 'BEARISH' END AS direction,
       CASE WHEN window_end > edge_at THEN 0.0
            ELSE {settle_sql('CASE WHEN "open" > 0 THEN ("close" - "open") / "open" ELSE 0.0 END')} END AS return_pct
FROM candles, edge""")
def merged_candle_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History up to a day before the end, the sealed candles pushed since, and the open windows."""
    trades = market.trades(spark, sf_dir)
    newest = trades.select(F.max("event_time")).scalar()
    edge = newest - F.expr("INTERVAL 60 SECONDS")
    day_before = newest - F.expr("INTERVAL 1 DAY")
    end, hour = F.col("window_end"), c.candles(trades, "H1")
    # A window has one role for each feed that holds it; all come from one aggregation.
    sealed = end <= edge
    roles = F.array_compact(F.array(
        F.when(sealed & (end > day_before), 1), F.when(sealed & (end <= day_before + F.expr("INTERVAL 6 HOURS")), 2),
        F.when(~sealed, 3),
    ))
    feed = s.api_candles(marts.fct_candle(hour)).withColumn("return_pct", F.when(sealed, F.col("return_pct")).otherwise(0.0))
    merged = s.first_of_each_window(feed.withColumn("_priority", F.explode(roles)))
    return merged.withColumns({
        "vwap": settle(F.col("vwap")),
        "return_pct": F.when(F.col("window_end") > edge, F.lit(0.0)).otherwise(settle(F.col("return_pct"))),
    })


@query("recent_anomalies", f"""WITH {anomaly_ctes()}
SELECT anomaly_id, symbol, anomaly_type, candle_window_start FROM anomalies
WHERE symbol = 'SOL-USD' ORDER BY candle_window_start DESC, anomaly_id LIMIT 20""")
def recent_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest anomalies of a symbol, taking the candle's start as the time of detection."""
    found = hourly_anomalies(spark, sf_dir).withColumn("detected_at", F.col("candle_window_start"))
    return s.recent_anomalies(found, "SOL-USD", 20).select(
        "anomaly_id", "symbol", "anomaly_type", "candle_window_start"
    )


@query("symbol_list", f"""WITH {o.TRADES}, {o.SYMBOLS}
SELECT canonical AS symbol, base AS base_asset, quote AS quote_asset, active AS is_active, count(t.symbol) AS trades
FROM symbols LEFT JOIN trades t ON t.symbol = canonical GROUP BY ALL""")
def symbol_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The symbols offered, with how many trades the tables hold of each."""
    counts = market.trades(spark, sf_dir).groupBy("symbol").agg(F.count(F.lit(1)).alias("trades"))
    return s.symbol_list(seed.read_symbol_seed(spark)).join(counts, "symbol", "left").withColumn(
        "trades", F.coalesce("trades", F.lit(0))
    )


@query("granted_limits", f"""{_M1}, asked("limit") AS (VALUES (-3), (0), (7), (5000), (9000)),
n AS (SELECT count(*) AS n FROM m1 WHERE symbol = 'BTC-USD')
SELECT CAST("limit" AS INT) AS asked, CAST(greatest(1, least("limit", 5000)) AS INT) AS granted,
       least(n, greatest(1, least("limit", 5000)))::BIGINT AS n_rows FROM asked, n""")
def granted_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many candles an interface returns for what is asked of it."""
    fct = _fct_mart(spark, sf_dir)
    out = None
    for asked in (-3, 0, 7, 5000, 9000):
        granted = s.clamp_limit(asked)
        rows = s.latest_candles(fct, "BTC-USD", "M1", granted).agg(F.count(F.lit(1)).alias("n_rows"))
        rows = rows.select(F.lit(asked).alias("asked"), F.lit(granted).alias("granted"), "n_rows")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("pushed_candles", f"""WITH {o.TRADES}, {o.candles('H1')},
wanted(subscriber, symbol) AS (
  SELECT 'only-' || symbol, symbol FROM (SELECT DISTINCT symbol FROM trades) UNION ALL SELECT 'all', symbol FROM (SELECT DISTINCT symbol FROM trades))
SELECT subscriber, symbol, count(*) AS candles, max(window_end) AS newest FROM candles JOIN wanted USING (symbol) GROUP BY ALL""")
def pushed_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sealed candles per subscriber: one of each symbol, and one that takes all."""
    trades = market.trades(spark, sf_dir)
    names = trades.select("symbol").distinct()
    own = names.select(F.concat(F.lit("only-"), "symbol").alias("subscriber"), "symbol")
    every = spark.createDataFrame([("all", None)], "subscriber string, symbol string")
    known = sorted(r[0] for r in names.collect())  # the traded universe, a handful
    feed = sc.push_feed(c.candles(trades, "H1"), own.unionByName(every), known)
    return feed.groupBy("subscriber", "symbol").agg(F.count("*").alias("candles"), F.max("window_end").alias("newest"))


@query("guards", f"""WITH {o.TRADES}, {o.SYMBOLS},
asked(kind, value) AS (
  SELECT 'symbol', symbol FROM trades UNION SELECT 'symbol', lower(symbol) FROM trades UNION SELECT 'interval', "interval"
  FROM (VALUES ('M1'), ('M5'), ('H1'), ('D1'), ('m1')) t("interval"))
SELECT kind, value, CASE kind WHEN 'symbol' THEN value IN (SELECT canonical FROM symbols) ELSE value IN ('M1', 'M5', 'H1') END AS accepted
FROM asked""")
def guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the guards let through of symbols that trade, the same in lower case, and intervals."""
    def passes(guard, *args) -> bool:
        try:
            guard(*args)
            return True
        except ValueError:
            return False

    known = seed.read_symbol_seed(spark)
    names = [r[0] for r in market.trades(spark, sf_dir).select("symbol").distinct().collect()]
    rows = [("symbol", n, passes(s.require_symbol, known, n)) for n in (*names, *map(str.lower, names))]
    rows += [("interval", i, passes(schemas.check_interval, i)) for i in ("M1", "M5", "H1", "D1", "m1")]
    return spark.createDataFrame(rows, "kind string, value string, accepted boolean")
