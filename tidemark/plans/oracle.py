"""DuckDB SQL that computes the same result as each catalogue query.

Written independently of the Spark plans: the as-of is a dedupe followed by
``last_value(... IGNORE NULLS)`` over the tagged union, not the running struct
max the Spark side uses. Pre-registered views: the driver's tables.
"""

from __future__ import annotations

# Fixture derivation (FIXTURES.md section 2); epoch ms are floored, as Spark's unix_millis.
FIXTURE_CTE = """
ev AS (
  SELECT event_id, user_id, event_type, value, epoch_us(ts) // 1000 AS ms,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events),
trades AS (
  SELECT 'U' || CAST(user_id AS VARCHAR) AS symbol, CAST(value AS DECIMAL(18,2)) AS price,
         k AS volume, ms AS trade_timestamp, event_id AS seq
  FROM ev WHERE event_type <> 'signup'),
info AS (
  SELECT 'U' || CAST(user_id AS VARCHAR) AS symbol, 'C' || CAST(user_id AS VARCHAR) AS company,
         'S' || CAST((user_id + k) % 5 AS VARCHAR) AS sector,
         CAST((user_id + 1) * 1000000 + k * 1000 AS BIGINT) AS market_cap,
         ms AS info_timestamp, event_id AS seq
  FROM ev WHERE event_type = 'signup')"""

TIES_CTE = """
nsup AS (SELECT count(*) AS n FROM supplier),
trades AS (
  SELECT 'U' || CAST(l_suppkey AS VARCHAR) AS symbol,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
         CAST(l_quantity AS INTEGER) AS volume, epoch_us(l_shipdate) // 1000 AS trade_timestamp,
         l_orderkey * 8 + l_linenumber AS seq
  FROM lineitem),
info AS (
  SELECT 'U' || CAST(o_custkey % (SELECT n FROM nsup) AS VARCHAR) AS symbol,
         'C' || CAST(o_custkey AS VARCHAR) AS company,
         'S' || CAST((o_custkey + o_orderkey) % 5 AS VARCHAR) AS sector,
         CAST(floor(o_totalprice) AS BIGINT) AS market_cap, epoch_us(o_orderdate) // 1000 AS info_timestamp,
         o_orderkey * 8 AS seq
  FROM orders)"""

_INFO_T = "STRUCT(company VARCHAR, sector VARCHAR, market_cap BIGINT, info_timestamp BIGINT)"


def asof_ctes(trades: str = "trades", info: str = "info", ttl_ms: int | None = None) -> str:
    """CTEs ending in ``enriched_raw`` (cur = carried info struct or NULL)."""
    ttl_part = ""
    cur = "cur"
    if ttl_ms is not None:
        ttl_part = f""",
g AS (
  SELECT *, lag(ms) OVER (PARTITION BY symbol ORDER BY ms, ord, seq) AS prev_ms FROM u),
s AS (
  SELECT *, max(CASE WHEN prev_ms IS NULL OR ms - prev_ms > {ttl_ms} THEN ms END)
         OVER (PARTITION BY symbol ORDER BY ms, ord, seq
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sess FROM g)"""
        cur = "CASE WHEN cur.info_timestamp >= sess THEN cur END"
    src = "s" if ttl_ms is not None else "u"
    return f"""
info_d AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY symbol, info_timestamp ORDER BY seq) AS rn
    FROM {info} WHERE info_timestamp > 0) WHERE rn = 1),
u AS (
  SELECT symbol, trade_timestamp AS ms, 1 AS ord, seq, price, volume,
         CAST(NULL AS {_INFO_T}) AS inf FROM {trades}
  UNION ALL
  SELECT symbol, info_timestamp, 0, seq, NULL, NULL,
         {{'company': company, 'sector': sector, 'market_cap': market_cap,
          'info_timestamp': info_timestamp}} FROM info_d){ttl_part},
f AS (
  SELECT *, last_value(inf IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY ms, ord, seq
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cur FROM {src}),
enriched_raw AS (
  SELECT symbol, price, volume, ms AS trade_timestamp, seq, {cur} AS cur FROM f WHERE ord = 1)"""


ENRICHED_SENTINEL = """
enriched AS (
  SELECT symbol, price, volume, trade_timestamp, seq,
         coalesce(cur.company, 'UNKNOWN') AS company, coalesce(cur.sector, 'UNKNOWN') AS sector,
         coalesce(cur.market_cap, 0) AS market_cap, coalesce(cur.info_timestamp, 0) AS info_timestamp,
         CAST(price * volume AS DECIMAL(28,8)) AS trade_value
  FROM enriched_raw)"""

ENRICHED_NULL = """
enriched AS (
  SELECT symbol, price, volume, trade_timestamp, seq,
         cur.company AS company, cur.sector AS sector, cur.market_cap AS market_cap,
         cur.info_timestamp AS info_timestamp, CAST(price * volume AS DECIMAL(28,8)) AS trade_value
  FROM enriched_raw)"""


def with_ctes(*parts: str) -> str:
    return "WITH " + ",".join(p.strip("\n") for p in parts)


def enriched_sql(fixture: str = FIXTURE_CTE, missing: str = "sentinel", ttl_ms: int | None = None) -> str:
    tail = ENRICHED_SENTINEL if missing == "sentinel" else ENRICHED_NULL
    return with_ctes(fixture, asof_ctes(ttl_ms=ttl_ms), tail)


def metrics_select(width_ms: int, src: str = "enriched") -> str:
    return f"""
SELECT epoch_ms((trade_timestamp // {width_ms}) * {width_ms}) AS window_start,
       epoch_ms((trade_timestamp // {width_ms}) * {width_ms} + {width_ms}) AS window_end,
       sector,
       count(*) AS trade_count,
       CAST(sum(trade_value) AS DECIMAL(28,8)) AS total_value,
       CAST(round(CAST(sum(price) AS DECIMAL(28,12)) / count(*), 8) AS DECIMAL(28,8)) AS avg_price,
       CAST(sum(volume) AS BIGINT) AS total_volume
FROM {src}
GROUP BY 1, 2, 3"""


ENRICHED_SENTINEL_SQL = enriched_sql()

SINK_PROJECTION = """
SELECT symbol, CAST(price AS DECIMAL(28,8)) AS price, CAST(volume AS INTEGER) AS volume,
       epoch_ms(trade_timestamp) AS trade_timestamp, company, sector, market_cap,
       CASE WHEN info_timestamp > 0 THEN epoch_ms(info_timestamp) END AS info_timestamp,
       CAST(trade_value AS DECIMAL(28,8)) AS trade_value
FROM enriched"""

UNION_EVENTS = """
SELECT symbol, price, volume, trade_timestamp, seq,
       CAST(NULL AS VARCHAR) AS company, CAST(NULL AS VARCHAR) AS sector, CAST(NULL AS BIGINT) AS market_cap,
       CAST(NULL AS BIGINT) AS info_timestamp, 'trade' AS record_type, trade_timestamp AS event_ms,
       epoch_ms(trade_timestamp) AS event_timestamp
FROM trades
UNION ALL
SELECT symbol, NULL, NULL, NULL, seq, company, sector, market_cap, info_timestamp, 'info',
       info_timestamp, epoch_ms(info_timestamp)
FROM info"""

LATEST_INFO = """
SELECT symbol, company, sector, market_cap, info_timestamp, seq FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY info_timestamp DESC, seq) AS rn
  FROM info WHERE info_timestamp > 0) WHERE rn = 1"""

FORWARD_FILL = """,
fu AS (
  SELECT symbol, price, volume, trade_timestamp, seq, CAST(NULL AS VARCHAR) AS company,
         CAST(NULL AS VARCHAR) AS sector, CAST(NULL AS BIGINT) AS market_cap,
         CAST(NULL AS BIGINT) AS info_timestamp, 1 AS ord, trade_timestamp AS ms FROM trades
  UNION ALL
  SELECT symbol, NULL, NULL, NULL, seq, company, sector, market_cap, info_timestamp, 0, info_timestamp
  FROM info),
ff AS (
  SELECT *,
    last_value(company IGNORE NULLS) OVER w AS f_company,
    last_value(sector IGNORE NULLS) OVER w AS f_sector,
    last_value(market_cap IGNORE NULLS) OVER w AS f_market_cap,
    last_value(info_timestamp IGNORE NULLS) OVER w AS f_info_timestamp
  FROM fu
  WINDOW w AS (PARTITION BY symbol ORDER BY ms, ord, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT symbol, price, volume, trade_timestamp, seq, f_company AS company, f_sector AS sector,
       f_market_cap AS market_cap, f_info_timestamp AS info_timestamp
FROM ff WHERE ord = 1"""


#: Trades whose value does not fit DECIMAL(28,8): every 997th has the largest price and volume.
OVERFLOW_CTE = TIES_CTE.replace(
    "CAST(l_extendedprice AS DECIMAL(18,2)) AS price",
    "CASE WHEN (l_orderkey * 8 + l_linenumber) % 997 = 0 THEN CAST(9999999999999999.99 AS DECIMAL(18,2))"
    " ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS price").replace(
    "CAST(l_quantity AS INTEGER) AS volume",
    "CASE WHEN (l_orderkey * 8 + l_linenumber) % 997 = 0 THEN 2147483647 ELSE CAST(l_quantity AS INTEGER) END AS volume")
ENRICHED_TRY = ENRICHED_SENTINEL.replace(
    "CAST(price * volume", "TRY_CAST(CAST(price AS DECIMAL(28,2)) * volume")


def constraint_rejects_sql() -> str:
    return """,
chk AS (
  SELECT *, concat_ws('; ',
      CASE WHEN symbol IS NULL THEN 'symbol is null' END,
      CASE WHEN price IS NULL THEN 'price is null' END,
      CASE WHEN volume IS NULL THEN 'volume is null' END,
      CASE WHEN trade_timestamp IS NULL THEN 'trade_timestamp is null' END,
      CASE WHEN length(symbol) > 8 THEN 'symbol longer than 8' END,
      CASE WHEN length(company) > 20 THEN 'company longer than 20' END,
      CASE WHEN length(sector) > 20 THEN 'sector longer than 20' END,
      CASE WHEN trade_value IS NULL AND price IS NOT NULL AND volume IS NOT NULL
           THEN 'trade_value out of decimal(28,8)' END) AS reason
  FROM enriched),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY symbol, trade_timestamp, volume, reason = ''
                               ORDER BY seq, price, company, sector, market_cap, info_timestamp, trade_value) AS rn
  FROM chk)
SELECT * EXCLUDE (rn) REPLACE (CASE WHEN reason = '' THEN 'duplicate key' ELSE reason END AS reason)
FROM numbered WHERE reason <> '' OR rn > 1"""


def metrics_cte(width_ms: int) -> str:
    """``,metrics AS (...)`` to append after the enriched CTEs."""
    return f""",
metrics AS ({metrics_select(width_ms)})"""


DEDUP_TRADES = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, trade_timestamp, volume
                               ORDER BY seq, price, company, sector, market_cap, info_timestamp, trade_value) AS rn
  FROM enriched) WHERE rn = 1"""

RECENT_TRADES = """
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY symbol ORDER BY trade_timestamp DESC, seq DESC) AS INTEGER) AS rank
  FROM enriched) WHERE rank <= 5"""

RETENTION_KEPT = """
SELECT *, window_end AS ingestion_time FROM metrics
WHERE window_end >= (SELECT max(window_end) FROM metrics) - INTERVAL 2 DAYS"""


def commit_history_sql(k: int) -> str:
    """Versions 0..k-1 are the k time-slice appends, version k the compaction; newest 5 first."""
    return f""",
b AS (SELECT min(trade_timestamp) AS lo, max(trade_timestamp) AS hi FROM enriched),
sl AS (
  SELECT CAST(coalesce((SELECT max(i) FROM range(1, {k}) r(i)
                        WHERE e.trade_timestamp >= b.lo + (b.hi - b.lo) * i // {k}), 0) AS BIGINT) AS s
  FROM enriched e, b),
h AS (
  SELECT s AS version, 'append' AS operation, count(*) AS rows FROM sl GROUP BY s
  UNION ALL
  SELECT {k}, 'compact', count(*) FROM enriched)
SELECT version, operation, CAST(rows AS BIGINT) AS rows FROM h ORDER BY version DESC LIMIT 5"""


APPEND_CLOSED = """
SELECT * FROM metrics
WHERE window_end <= epoch_ms((SELECT max(trade_timestamp) FROM enriched) - 300000)"""


def emissions_sql(width_ms: int, k: int) -> str:
    """Update-mode output of a stream fed in k equal-width time slices: for every
    slice, the cumulative totals of each (window, sector) the slice touched."""
    return f""",
b AS (SELECT min(trade_timestamp) AS lo, max(trade_timestamp) AS hi FROM enriched),
cuts AS (SELECT lo + (hi - lo) * i // {k} AS c FROM b, range(1, {k}) r(i)),
sl AS (SELECT e.*, (SELECT count(*) FROM cuts WHERE e.trade_timestamp >= c) AS s,
              e.trade_timestamp // {width_ms} AS wk FROM enriched e),
touched AS (SELECT DISTINCT s, wk, sector FROM sl)
SELECT epoch_ms(t.wk * {width_ms}) AS window_start, epoch_ms(t.wk * {width_ms} + {width_ms}) AS window_end,
       t.sector,
       count(*) AS trade_count,
       CAST(sum(x.trade_value) AS DECIMAL(28,8)) AS total_value,
       CAST(round(CAST(sum(x.price) AS DECIMAL(28,12)) / count(*), 8) AS DECIMAL(28,8)) AS avg_price,
       CAST(sum(x.volume) AS BIGINT) AS total_volume
FROM touched t JOIN sl x ON x.s <= t.s AND x.wk = t.wk AND x.sector = t.sector
GROUP BY t.s, t.wk, t.sector"""


HOT_CTE = TIES_CTE.replace(
    "'U' || CAST(l_suppkey AS VARCHAR) AS symbol",
    "'H' || CAST(l_suppkey * 3 // (SELECT n FROM nsup) AS VARCHAR) AS symbol").replace(
    "'U' || CAST(o_custkey % (SELECT n FROM nsup) AS VARCHAR) AS symbol",
    "'H' || CAST((o_custkey % (SELECT n FROM nsup)) * 3 // (SELECT n FROM nsup) AS VARCHAR) AS symbol")


#: Times divided by 200, and when each trade is delivered (sources/fixtures.py).
DENSE_CTE = FIXTURE_CTE.replace("epoch_us(ts) // 1000", "epoch_us(ts) // 200000")
LATE_ARRIVAL = """trade_timestamp + CASE seq % 10 WHEN 0 THEN 90000 WHEN 1 THEN 200000 WHEN 2 THEN 700000 ELSE 0 END"""


def firing_sql(k: int, arrival: str = "trade_timestamp", width: int = 60_000, every: int = 30_000, delay: int = 5_000,
               lateness: int = 300_000) -> str:
    """Emissions of firing windows fed in k slices of equal width in arrival time. ``old`` and
    ``clock`` are the closing clock before a slice and after it."""
    return f""",
arrived AS (SELECT *, {arrival} AS arrival, (trade_timestamp // {width} + 1) * {width} AS w_end FROM enriched),
b AS (SELECT min(arrival) AS lo, max(arrival) AS hi FROM arrived),
cuts AS (SELECT lo + (hi - lo) * i // {k} AS c FROM b, range(1, {k}) r(i)),
sl AS (SELECT a.*, (SELECT count(*) FROM cuts WHERE a.arrival >= c) AS s FROM arrived a),
newest AS (SELECT s, max(max(trade_timestamp)) OVER (ORDER BY s) - {delay} AS clock FROM sl GROUP BY s),
clocks AS (SELECT s, clock, coalesce(lag(clock) OVER (ORDER BY s), 0) AS old FROM newest),
kept AS (SELECT sl.*, c.old FROM sl JOIN clocks c ON sl.s = c.s WHERE sl.w_end + {lateness} > c.old),
parts AS (SELECT sector, w_end, s, old, min(trade_timestamp) AS first_ms FROM kept GROUP BY sector, w_end, s, old),
begun AS (SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY sector, w_end ORDER BY s) = 1),
marks AS (
  SELECT g.sector, g.w_end, c.s, c.clock,
         least(g.w_end, greatest((g.first_ms // {every} + 1) * {every}, (c.old // {every} + 1) * {every})) AS mark
  FROM begun g JOIN clocks c ON c.s >= g.s AND c.old < g.w_end),
fired AS (
  SELECT m.sector, m.w_end, m.s, CASE WHEN m.w_end <= m.clock THEN 'final' ELSE 'early' END AS kind, count(*) AS n
  FROM marks m JOIN kept x ON x.sector = m.sector AND x.w_end = m.w_end AND x.s <= m.s
  WHERE m.mark <= m.clock GROUP BY m.sector, m.w_end, m.s, m.clock),
changed AS (SELECT *, lag(n) OVER (PARTITION BY sector, w_end ORDER BY s) AS had FROM fired),
emissions AS (
  SELECT sector, w_end, s, kind FROM changed WHERE kind = 'final' OR had IS NULL OR had <> n
  UNION ALL
  SELECT sector, w_end, s, 'correction' FROM parts WHERE w_end <= old)
SELECT epoch_ms(e.w_end - {width}) AS window_start, epoch_ms(e.w_end) AS window_end, e.sector,
       count(*) AS trade_count,
       CAST(sum(x.trade_value) AS DECIMAL(28,8)) AS total_value,
       CAST(round(CAST(sum(x.price) AS DECIMAL(28,12)) / count(*), 8) AS DECIMAL(28,8)) AS avg_price,
       CAST(sum(x.volume) AS BIGINT) AS total_volume, e.kind
FROM emissions e JOIN kept x ON x.sector = e.sector AND x.w_end = e.w_end AND x.s <= e.s
GROUP BY e.sector, e.w_end, e.s, e.kind"""


def watermarked_sql(k: int, arrival: str, width: int = 60_000, delay: int = 300_000) -> str:
    """Window metrics of the rows that are not too late: their window ends after the newest time of
    all earlier slices less the delay."""
    return f""",
arrived AS (SELECT *, {arrival} AS arrival, (trade_timestamp // {width} + 1) * {width} AS w_end FROM enriched),
b AS (SELECT min(arrival) AS lo, max(arrival) AS hi FROM arrived),
cuts AS (SELECT lo + (hi - lo) * i // {k} AS c FROM b, range(1, {k}) r(i)),
sl AS (SELECT a.*, (SELECT count(*) FROM cuts WHERE a.arrival >= c) AS s FROM arrived a),
newest AS (SELECT s, max(max(trade_timestamp)) OVER (ORDER BY s) AS t FROM sl GROUP BY s),
kept AS (SELECT sl.* FROM sl LEFT JOIN newest n ON n.s = sl.s - 1 WHERE n.t IS NULL OR sl.w_end > n.t - {delay})
""" + metrics_select(width, "kept")


def batch_counters_sql(k: int) -> str:
    """Enriched and unknown trades of each of k slices of equal width."""
    return f""",
b AS (SELECT min(trade_timestamp) AS lo, max(trade_timestamp) AS hi FROM enriched),
cuts AS (SELECT lo + (hi - lo) * i // {k} AS c FROM b, range(1, {k}) r(i)),
sl AS (SELECT e.*, (SELECT count(*) FROM cuts WHERE e.trade_timestamp >= c) AS batch_id FROM enriched e)
SELECT batch_id, count(*) AS enriched_count,
       CAST(sum(CASE WHEN info_timestamp = 0 THEN 1 ELSE 0 END) AS BIGINT) AS unknown_count
FROM sl GROUP BY batch_id"""


#: Some trades without symbol or time and infos without symbol (sources/fixtures.py); t_ok and i_ok are the others.
NULLS_CTE = (FIXTURE_CTE
             .replace("SELECT 'U' ||", "SELECT CASE WHEN event_id % 50 <> 0 THEN 'U' ||", 1)
             .replace("AS VARCHAR) AS symbol", "AS VARCHAR) END AS symbol", 1)
             .replace("ms AS trade_timestamp", "CASE WHEN event_id % 50 <> 1 THEN ms END AS trade_timestamp")
             .replace("SELECT 'U' ||", "SELECT CASE WHEN event_id % 40 <> 0 THEN 'U' ||", 1)
             .replace("AS VARCHAR) AS symbol", "AS VARCHAR) END AS symbol", 1)) + """,
t_ok AS (SELECT * FROM trades WHERE symbol IS NOT NULL AND trade_timestamp IS NOT NULL),
i_ok AS (SELECT * FROM info WHERE symbol IS NOT NULL)"""
WITHOUT_KEY = "FROM trades WHERE symbol IS NULL OR trade_timestamp IS NULL"

ENRICHED_NULLS = with_ctes(NULLS_CTE, asof_ctes("t_ok", "i_ok"), ENRICHED_SENTINEL) + f"""
SELECT * FROM enriched
UNION ALL
SELECT symbol, price, volume, trade_timestamp, seq, 'UNKNOWN', 'UNKNOWN', 0, 0, CAST(price * volume AS DECIMAL(28,8))
{WITHOUT_KEY}"""

FORWARD_FILL_NULLS = with_ctes(NULLS_CTE) + FORWARD_FILL.replace("FROM trades", "FROM t_ok").replace(
    "FROM info", "FROM i_ok") + f"""
UNION ALL
SELECT symbol, price, volume, trade_timestamp, seq, NULL, NULL, NULL, NULL {WITHOUT_KEY}"""

#: Every 20th event cut off after ten characters, the next ones without a symbol.
STREAM_REJECTS = """
SELECT topic, reason, count(*) AS n FROM (
  SELECT 'trades' AS topic, CASE seq % 20 WHEN 0 THEN 'malformed' WHEN 1 THEN 'null symbol' END AS reason FROM trades
  UNION ALL
  SELECT 'info', CASE seq % 20 WHEN 0 THEN 'malformed' WHEN 1 THEN 'null symbol' END FROM info)
WHERE reason IS NOT NULL GROUP BY topic, reason"""
