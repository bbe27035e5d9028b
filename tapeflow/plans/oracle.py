"""SQL with the expected result of the catalog's queries, written independently of the operators
and runnable on another engine over the same tables."""

ORACLE: dict[str, str] = {}

# Rounding as in `catalog.present`: to n digits after a shift by 10^-(n+3).
_TIME = "'%Y-%m-%d %H:%M:%S.%g'"
_ISO = "strftime(epoch_ms(timestamp_ms), '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'"

EVENTS = """ev AS (
  SELECT upper(event_type) AS symbol, value AS price, CAST(1 + user_id % 10 AS DOUBLE) AS quantity,
         round(value * (1 + user_id % 10), 6) AS trade_value_usdt, epoch_us(ts) // 1000 AS timestamp_ms,
         user_id % 2 = 0 AS is_buyer_maker, event_id AS trade_id
  FROM events)"""

LINEITEM = """li AS (
  SELECT l_returnflag AS symbol, l_extendedprice / l_quantity AS price, l_quantity AS quantity,
         round(l_extendedprice, 6) AS trade_value_usdt, epoch_ms(l_shipdate) AS timestamp_ms,
         l_linestatus = 'O' AS is_buyer_maker, l_orderkey * 10 + l_linenumber AS trade_id
  FROM lineitem)"""

MARKED = LINEITEM + """,
marked AS (
  SELECT *, row_number() OVER (PARTITION BY symbol, trade_id ORDER BY timestamp_ms, price, quantity,
         trade_value_usdt, is_buyer_maker) > 1 AS is_duplicate FROM li),
kept AS (SELECT * FROM marked WHERE NOT is_duplicate)"""

FLAGGED = MARKED + """,
flagged AS (
  SELECT *, coalesce(abs(price - previous) / previous * 100 > 2.0, false) AS is_price_spike
  FROM (SELECT *, lag(price) OVER (PARTITION BY symbol ORDER BY timestamp_ms, trade_id) AS previous
        FROM kept))"""

MESSAGES = """msgs AS (
  SELECT *, CASE
      WHEN event_id % 67 = 0 THEN 'bad_json'
      WHEN event_id % 103 = 0 OR event_id % 97 = 0 THEN 'missing_field'
      WHEN event_id % 89 = 0 OR event_id % 61 = 0 THEN 'bad_type'
      WHEN event_id % 79 = 0 THEN 'empty_symbol'
      WHEN event_id % 71 = 0 THEN 'non_finite'
      WHEN event_id % 83 = 0 OR value <= 0 THEN 'non_positive' END AS reject_reason
  FROM (SELECT *, 0 AS copy FROM events UNION ALL SELECT *, 1 FROM events WHERE event_id % 59 = 0)),
accepted AS (
  SELECT event_id, copy, upper(event_type) AS symbol, value AS price,
         CAST(1 + user_id % 10 AS DOUBLE) AS quantity, epoch_us(ts) // 1000 AS timestamp_ms,
         event_id AS trade_id, user_id % 2 = 0 AS is_buyer_maker
  FROM msgs WHERE reject_reason IS NULL)"""

ORACLE["unwrap_messages"] = f"""
SELECT event_id, copy, event_id % 67 <> 0 AS parse_ok, gone AS is_empty,
       CASE WHEN gone THEN '?' WHEN event_id % 79 = 0 THEN '' ELSE event_type END AS symbol,
       CASE WHEN gone THEN '?' ELSE CAST(epoch_us(ts) // 1000 AS VARCHAR) END AS time_text
FROM (SELECT *, event_id % 67 = 0 OR event_id % 103 = 0 AS gone FROM (
  SELECT *, 0 AS copy FROM events UNION ALL SELECT *, 1 FROM events WHERE event_id % 59 = 0))"""

ORACLE["validate_trades"] = f"WITH {MESSAGES} SELECT * FROM accepted"

ORACLE["split_rejects"] = f"""
WITH {MESSAGES}
SELECT event_id, copy, reject_reason,
       CASE WHEN event_id % 67 = 0 OR event_id % 103 = 0 THEN 'e,s,p,q,T,m,t'
            WHEN event_id % 97 = 0 THEN 'm' ELSE '' END AS missing_keys
FROM msgs WHERE reject_reason IS NOT NULL"""

ORACLE["reject_report"] = f"""
WITH {MESSAGES}
SELECT reject_reason, count(*) AS rejected FROM msgs WHERE reject_reason IS NOT NULL GROUP BY 1
UNION ALL
SELECT 'duplicate', count(*) FROM accepted WHERE copy = 1"""

_CLEAN_FROM_MESSAGES = f"""
WITH {MESSAGES},
once AS (
  SELECT *, lag(price) OVER (PARTITION BY symbol ORDER BY timestamp_ms, trade_id) AS previous
  FROM (SELECT DISTINCT symbol, price, quantity, timestamp_ms, is_buyer_maker, trade_id FROM accepted))
SELECT symbol, price, quantity, round(price * quantity, 6) AS trade_value_usdt, {_ISO} AS trade_time,
       timestamp_ms, is_buyer_maker,
       coalesce(abs(price - previous) / previous * 100 > 2.0, false) AS is_price_spike, trade_id,
       'binance' AS source
FROM once"""
ORACLE["ingest_messages"] = _CLEAN_FROM_MESSAGES

ORACLE["stream_raw_layer"] = f"""
SELECT parse_ok, is_empty, time_text FROM ({ORACLE["unwrap_messages"]})"""

ORACLE["enrich_trades"] = f"""
WITH {LINEITEM}
SELECT symbol, round(price + 1e-9, 6) AS price, quantity, round(price * quantity, 6) AS trade_value_usdt,
       {_ISO} AS trade_time, timestamp_ms, is_buyer_maker, false AS is_price_spike, trade_id,
       'binance' AS source
FROM li"""

ORACLE["duplicate_count"] = f"""
WITH {LINEITEM}
SELECT symbol, count(*) - count(DISTINCT trade_id) AS duplicates FROM li GROUP BY symbol"""

_DEDUP_COLUMNS = """symbol, round(price + 1e-9, 6) AS price, quantity, trade_value_usdt, timestamp_ms,
       is_buyer_maker, false AS is_price_spike, trade_id, 'synthetic' AS source"""
ORACLE["dedup_recent"] = f"WITH {MARKED} SELECT {_DEDUP_COLUMNS} FROM kept"
ORACLE["mark_duplicates"] = f"WITH {MARKED} SELECT {_DEDUP_COLUMNS}, is_duplicate FROM marked"

# The bounded memory as a fold over the trades of a symbol in order.
ORACLE["dedup_recent_2000"] = f"""
WITH {LINEITEM},
ordered AS (
  SELECT list(li ORDER BY timestamp_ms, trade_id, price, quantity, trade_value_usdt, is_buyer_maker)
         AS trades FROM li GROUP BY symbol),
folded AS (
  SELECT trades, list_reduce(
      list_transform(trades, lambda t: {{'memory': [t.trade_id], 'flags': [false]}}),
      lambda a, x: CASE WHEN list_contains(a.memory, x.memory[1])
        THEN {{'memory': a.memory, 'flags': list_append(a.flags, true)}}
        ELSE {{'memory': list_append(a.memory[-1999:], x.memory[1]),
               'flags': list_append(a.flags, false)}} END).flags AS flags
  FROM ordered)
SELECT t.symbol AS symbol, round(t.price + 1e-9, 6) AS price, t.quantity AS quantity,
       t.trade_value_usdt AS trade_value_usdt, t.timestamp_ms AS timestamp_ms,
       t.is_buyer_maker AS is_buyer_maker, false AS is_price_spike, t.trade_id AS trade_id,
       'synthetic' AS source, is_duplicate
FROM (SELECT unnest(trades) AS t, unnest(flags) AS is_duplicate FROM folded)"""

ORACLE["flag_spikes_by_time"] = f"""
WITH {EVENTS}
SELECT symbol, price, quantity, trade_value_usdt, timestamp_ms, is_buyer_maker, trade_id,
       'synthetic' AS source,
       coalesce(abs(price - previous) / previous * 100 > 2.0, false) AS is_price_spike
FROM (SELECT *, lag(price) OVER (PARTITION BY symbol ORDER BY timestamp_ms, trade_id) AS previous
      FROM ev WHERE price > 0)"""

ORACLE["flag_spikes_by_range"] = f"""
WITH {FLAGGED}
SELECT symbol, round(price + 1e-9, 6) AS price, quantity, trade_value_usdt, timestamp_ms, is_buyer_maker,
       trade_id, 'synthetic' AS source,
       coalesce(abs(price - previous) / previous * 100 > 50.0, false) AS is_price_spike
FROM flagged"""

ORACLE["symbol_stats"] = f"""
WITH {FLAGGED}
SELECT symbol, count(*) AS trades, round(avg(price) + 1e-5, 2) AS avg_price, round(min(price) + 1e-5, 2) AS min_price,
       round(max(price) + 1e-5, 2) AS max_price, round(sum(trade_value_usdt) + 1e-5, 2) AS total_value,
       any_value(d.duplicates) AS duplicates, count(*) FILTER (WHERE is_price_spike) AS spikes,
       CAST(0 AS BIGINT) AS dropped
FROM flagged JOIN (SELECT symbol, count(*) FILTER (WHERE is_duplicate) AS duplicates FROM marked
                   GROUP BY symbol) d USING (symbol)
GROUP BY symbol"""

_COUNTED = """counted AS (
  SELECT m.*, coalesce(f.is_price_spike, false) AS spike, sum(CASE WHEN m.is_duplicate THEN 0 ELSE 1 END)
         OVER (ORDER BY m.timestamp_ms, m.trade_id, m.symbol, m.is_duplicate, m.price, m.quantity,
               m.trade_value_usdt, m.is_buyer_maker ROWS UNBOUNDED PRECEDING) AS n
  FROM marked m LEFT JOIN flagged f
    ON NOT m.is_duplicate AND f.symbol = m.symbol AND f.trade_id = m.trade_id)"""
_STEPS = """numbered AS (
  SELECT *, CAST((n - CASE WHEN is_duplicate THEN 0 ELSE 1 END) // 100 AS BIGINT) AS step FROM counted),
steps AS (
  SELECT symbol, step, count(*) FILTER (WHERE NOT is_duplicate) AS trades,
         count(*) FILTER (WHERE is_duplicate) AS duplicates, count(*) FILTER (WHERE spike) AS spikes,
         sum(price) FILTER (WHERE NOT is_duplicate) AS price_sum,
         sum(round(price * quantity, 6)) FILTER (WHERE NOT is_duplicate) AS total_value,
         min(price) FILTER (WHERE NOT is_duplicate) AS min_price,
         max(price) FILTER (WHERE NOT is_duplicate) AS max_price
  FROM numbered GROUP BY symbol, step)"""
_SHOWN_STATS = """trades, round(CASE WHEN trades = 0 THEN 0.0 ELSE price_sum / trades END + 1e-5, 2) AS avg_price,
       round(min_price + 1e-5, 2) AS min_price, round(max_price + 1e-5, 2) AS max_price,
       round(total_value + 1e-5, 2) AS total_value, duplicates, spikes"""


def _snapshots(counted: str) -> str:
    """All symbols after every 100th accepted trade; ``counted`` has the trades with the number n accepted so far."""
    return f"""
WITH {counted}, {_STEPS},
grid AS (
  SELECT s.symbol, g.step FROM (SELECT DISTINCT symbol FROM steps) s,
  (SELECT unnest(range(CAST((SELECT max(n) FROM counted) // 100 AS BIGINT))) AS step) g),
running AS (
  SELECT g.symbol, g.step,
         CAST(sum(coalesce(trades, 0)) OVER w AS BIGINT) AS trades,
         CAST(sum(coalesce(duplicates, 0)) OVER w AS BIGINT) AS duplicates,
         CAST(sum(coalesce(spikes, 0)) OVER w AS BIGINT) AS spikes,
         sum(coalesce(price_sum, 0)) OVER w AS price_sum,
         sum(coalesce(total_value, 0)) OVER w AS total_value,
         min(min_price) OVER w AS min_price, max(max_price) OVER w AS max_price
  FROM grid g LEFT JOIN steps s ON s.symbol = g.symbol AND s.step = g.step
  WINDOW w AS (PARTITION BY g.symbol ORDER BY g.step ROWS UNBOUNDED PRECEDING))
SELECT (step + 1) * 100 AS after_trades, symbol, {_SHOWN_STATS}
FROM running WHERE trades + duplicates > 0"""


ORACLE["stats_snapshots"] = _snapshots(f"{FLAGGED}, {_COUNTED}")
ORACLE["stats_as_of"] = f"""
SELECT 3750 AS after_trades, * EXCLUDE (after_trades) FROM ({ORACLE["stats_snapshots"]}) WHERE after_trades = 3700"""

ORACLE["stats_intervals"] = f"""
WITH {FLAGGED}, {_COUNTED}, {_STEPS},
running AS (
  SELECT symbol, step, coalesce(lead(step) OVER (PARTITION BY symbol ORDER BY step) * 100, -1) AS to_trades,
         CAST(sum(trades) OVER w AS BIGINT) AS trades, CAST(sum(duplicates) OVER w AS BIGINT) AS duplicates,
         CAST(sum(spikes) OVER w AS BIGINT) AS spikes, sum(coalesce(price_sum, 0)) OVER w AS price_sum,
         sum(coalesce(total_value, 0)) OVER w AS total_value, min(min_price) OVER w AS min_price,
         max(max_price) OVER w AS max_price
  FROM steps WINDOW w AS (PARTITION BY symbol ORDER BY step ROWS UNBOUNDED PRECEDING))
SELECT symbol, (step + 1) * 100 AS from_trades, to_trades, {_SHOWN_STATS}
FROM running WHERE step < (SELECT max(n) FROM counted) // 100"""

# Messages in their order of arrival, with a memory of 600 ids.
_ARRIVED = MESSAGES + """,
placed AS (SELECT *, (event_id + copy) % 3 AS wave, event_id * 31 % 1009 AS k FROM accepted),
ordered AS (SELECT list(placed ORDER BY wave, k, event_id, copy) AS trades FROM placed GROUP BY symbol),
folded AS (
  SELECT trades, list_reduce(
      list_transform(trades, lambda t: {'memory': [t.trade_id], 'flags': [false]}),
      lambda a, x: CASE WHEN list_contains(a.memory, x.memory[1])
        THEN {'memory': a.memory, 'flags': list_append(a.flags, true)}
        ELSE {'memory': list_append(a.memory[-599:], x.memory[1]),
              'flags': list_append(a.flags, false)} END).flags AS flags
  FROM ordered),
arrived AS (SELECT t.*, is_duplicate FROM (SELECT unnest(trades) AS t, unnest(flags) AS is_duplicate FROM folded)),
arrived_kept AS (
  SELECT *, coalesce(abs(price - previous) / previous * 100 > 2.0, false) AS is_price_spike
  FROM (SELECT *, lag(price) OVER (PARTITION BY symbol ORDER BY wave, k, event_id, copy) AS previous
        FROM arrived WHERE NOT is_duplicate))"""

ORACLE["ingest_by_arrival"] = f"""
WITH {_ARRIVED}
SELECT symbol, price, quantity, round(price * quantity, 6) AS trade_value_usdt, {_ISO} AS trade_time,
       timestamp_ms, is_buyer_maker, is_price_spike, trade_id, 'binance' AS source
FROM arrived_kept"""
ORACLE["stream_clean_layer"] = ORACLE["ingest_by_arrival"]

ORACLE["stream_rejects"] = f"""
WITH {_ARRIVED}
SELECT reject_reason, CASE WHEN event_id % 67 = 0 OR event_id % 103 = 0 THEN -1 ELSE event_id END AS trade_id
FROM msgs WHERE reject_reason IS NOT NULL
UNION ALL SELECT 'duplicate', trade_id FROM arrived WHERE is_duplicate"""
ORACLE["stream_reject_counts"] = f"""
SELECT reject_reason, count(*) AS rejected FROM ({ORACLE["stream_rejects"]}) GROUP BY reject_reason"""

ORACLE["stream_stats_snapshots"] = _snapshots(_ARRIVED + """,
counted AS (
  SELECT a.*, coalesce(f.is_price_spike, false) AS spike, sum(CASE WHEN a.is_duplicate THEN 0 ELSE 1 END)
         OVER (ORDER BY a.wave, a.k, a.event_id, a.copy ROWS UNBOUNDED PRECEDING) AS n
  FROM arrived a LEFT JOIN arrived_kept f ON f.event_id = a.event_id AND f.copy = a.copy)""")

_CLEAN_EVENTS = """symbol, price, quantity, trade_value_usdt, {iso} AS trade_time, timestamp_ms,
       is_buyer_maker, false AS is_price_spike, trade_id, 'synthetic' AS source""".format(iso=_ISO)
ORACLE["parse_clean_trades"] = f"""
WITH {EVENTS}
SELECT {_CLEAN_EVENTS}, strftime(epoch_ms(timestamp_ms), {_TIME}) AS event_time FROM ev"""
ORACLE["read_messages"] = f"WITH {EVENTS} SELECT {_CLEAN_EVENTS} FROM ev WHERE price > 0"

ORACLE["clean_trades"] = f"""
WITH {MARKED}
SELECT {_DEDUP_COLUMNS}, strftime(epoch_ms(timestamp_ms), {_TIME}) AS event_time FROM kept"""


def _tumbling(source: str, width: str, spikes: str = "0", digits: int = 6, where: str = "true") -> str:
    return f"""
SELECT start AS window_start, start + INTERVAL '{width}' AS window_end, symbol,
       count(*) AS trade_count, avg(price) AS avg_price, sum(quantity) AS sum_qty,
       sum(trade_value_usdt) AS sum_value, CAST(sum({spikes}) AS BIGINT) AS spike_count
FROM (SELECT *, time_bucket(INTERVAL '{width}', epoch_ms(timestamp_ms)) AS start FROM {source})
WHERE price > 0 AND {where} GROUP BY start, symbol"""


def _times(end: str = "window_end") -> str:
    return f"""strftime(window_start, {_TIME}) AS window_start, strftime({end}, {_TIME}) AS window_end,
       strftime(window_start, '%Y-%m-%d') AS event_date"""


def _shown(digits: int = 6) -> str:
    return f"""{_times()}, symbol, trade_count, round(avg_price + 1e-{digits + 3}, {digits}) AS avg_price,
       round(sum_qty + 1e-{digits + 3}, {digits}) AS sum_qty, round(sum_value + 1e-{digits + 3}, {digits}) AS sum_value, spike_count"""


_MINUTES = f"WITH {EVENTS}, w AS ({_tumbling('ev', '1 minute')})"
_HOURS = f"WITH {EVENTS}, w AS ({_tumbling('ev', '1 hour')})"
_CLOSED = """(SELECT epoch_ms(max(timestamp_ms)) - INTERVAL '2 minutes' FROM ev WHERE price > 0)"""

ORACLE["tumbling_1m"] = f"{_MINUTES} SELECT {_shown()} FROM w"
ORACLE["read_window_table_files"] = ORACLE["tumbling_1m"]
ORACLE["read_window_table_mixed"] = f"""
{_MINUTES} SELECT * REPLACE (CASE WHEN minute(window_start::TIMESTAMP) % 3 = 1 THEN -1 ELSE spike_count END AS spike_count)
FROM (SELECT {_shown()} FROM w)"""
ORACLE["stream_tumbling_1m"] = f"{_MINUTES} SELECT {_shown()} FROM w WHERE window_end <= {_CLOSED}"
ORACLE["backfill_tumbling_1m"] = ORACLE["tumbling_1m"]
ORACLE["stream_pipeline_tumbling"] = ORACLE["stream_tumbling_1m"]
ORACLE["preview_window_table"] = f"""
{_MINUTES} SELECT {_shown()} FROM (SELECT * FROM w ORDER BY window_start, symbol LIMIT 10)"""
ORACLE["dedup_windows"] = f"{_HOURS} SELECT {_shown()} FROM w"
ORACLE["tumbling_1m_lineitem"] = f"""
WITH {FLAGGED}, w AS ({_tumbling('flagged', '1 minute', 'CASE WHEN is_price_spike THEN 1 ELSE 0 END')})
SELECT {_shown(2)} FROM w"""

_SLIDING = f"""
WITH {EVENTS},
copies AS (
  SELECT *, time_bucket(INTERVAL '1 minute', epoch_ms(timestamp_ms)) - step * INTERVAL '1 minute'
         AS window_start
  FROM ev, (SELECT unnest(range(5)) AS step) WHERE price > 0),
w AS (
  SELECT window_start, window_start + INTERVAL '5 minutes' AS window_end, symbol,
         count(*) AS trade_count, avg(price) AS avg_price, min(price) AS min_price,
         max(price) AS max_price, sum(trade_value_usdt) AS sum_value
  FROM copies GROUP BY window_start, symbol)"""
_SLIDING_SHOWN = f"""{_times()}, symbol, trade_count, round(avg_price + 1e-9, 6) AS avg_price, min_price,
       max_price, round(sum_value + 1e-9, 6) AS sum_value"""
ORACLE["sliding_5m_1m"] = f"{_SLIDING} SELECT {_SLIDING_SHOWN} FROM w"
ORACLE["sliding_5m_1m_expanded"] = ORACLE["sliding_5m_1m"]
ORACLE["stream_sliding_5m_1m"] = f"{_SLIDING} SELECT {_SLIDING_SHOWN} FROM w WHERE window_end <= {_CLOSED}"
ORACLE["backfill_sliding_5m_1m"] = ORACLE["sliding_5m_1m"]
ORACLE["stream_pipeline_updates"] = ORACLE["sliding_5m_1m"]
ORACLE["range_band"] = f"""
{_SLIDING} SELECT symbol, strftime(window_start, {_TIME}) AS window_start, max_price, min_price,
       round(avg_price + 1e-9, 6) AS avg_price FROM w"""
ORACLE["concat_window_tables"] = f"""
SELECT *, -1.0 AS min_price, -1.0 AS max_price FROM ({ORACLE["tumbling_1m"]})
UNION ALL BY NAME
SELECT *, -1.0 AS sum_qty, -1 AS spike_count FROM ({ORACLE["sliding_5m_1m"]})"""

_FEATURES = f"""{_HOURS},
f AS (
  SELECT *, coalesce((avg_price - lag(avg_price) OVER o) / lag(avg_price) OVER o, 0) * 100
              AS price_change_pct,
         sum_value / trade_count AS value_per_trade,
         CAST(spike_count AS DOUBLE) / trade_count AS spike_rate,
         coalesce(avg_price - lag(avg_price) OVER o, 0) AS price_change,
         avg(avg_price) OVER (o ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS rolling_mean_5,
         avg(avg_price) OVER (o ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS rolling_mean_10,
         coalesce(stddev_samp(avg_price) OVER (o ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 0)
              AS rolling_std_5,
         lead(avg_price) OVER o AS next_price,
         coalesce((sum_value - avg(sum_value) OVER s) / nullif(stddev_samp(sum_value) OVER s, 0), 0)
              AS volume_zscore
  FROM w WINDOW o AS (PARTITION BY symbol ORDER BY window_start), s AS (PARTITION BY symbol))"""

ORACLE["window_features"] = f"""
{_FEATURES} SELECT {_shown()}, round(price_change_pct + 1e-9, 6) AS price_change_pct,
  round(value_per_trade + 1e-9, 6) AS value_per_trade, round(spike_rate + 1e-9, 6) AS spike_rate FROM f"""

_SCALED = ("avg_price", "trade_count", "sum_value", "price_change_pct", "value_per_trade", "spike_rate")
ORACLE["standardize"] = f"""
{_FEATURES} SELECT symbol, strftime(window_start, {_TIME}) AS window_start, """ + ", ".join(
    f"""round(coalesce(({c} - avg({c}) OVER ()) / nullif(stddev_pop({c}) OVER (), 0), 0) + 1e-9, 6)
        AS {c}_scaled"""
    for c in _SCALED
) + " FROM f"

_X = (
    "rolling_mean_5",
    "rolling_mean_10",
    "rolling_std_5",
    "price_change",
    "price_change_pct",
    "volume_zscore",
)
ORACLE["price_features"] = f"""
{_FEATURES} SELECT {_shown()}, round(coalesce(next_price, -1) + 1e-9, 6) AS next_price, """ + ", ".join(
    f"round({c} + 1e-9, 6) AS {c}" for c in _X
) + " FROM f"


def _regression() -> str:
    """Least squares by orthogonalisation: each feature less its projection on those before it."""

    def mean(c: str) -> str:
        return f"avg(CASE WHEN next_price IS NOT NULL THEN {c} END) OVER (PARTITION BY symbol)"

    def dot(a: str, b: str) -> str:
        return f"sum(CASE WHEN next_price IS NOT NULL THEN {a} * {b} END) OVER (PARTITION BY symbol)"

    centred = ", ".join(f"{c} - {mean(c)} AS x{k}" for k, c in enumerate(_X))
    steps = [f"c AS (SELECT *, {centred}, {mean('next_price')} AS y_mean FROM f)"]
    source = "c"
    for k in range(len(_X)):
        off = "".join(f" - {dot(f'x{k}', f'z{j}')} / {dot(f'z{j}', f'z{j}')} * z{j}" for j in range(k))
        steps.append(f"g{k} AS (SELECT *, x{k}{off} AS z{k} FROM {source})")
        source = f"g{k}"
    fitted = " + ".join(
        f"{dot('next_price', f'z{k}')} / {dot(f'z{k}', f'z{k}')} * z{k}" for k in range(len(_X))
    )
    steps.append(f"p AS (SELECT *, y_mean + {fitted} AS predicted_price FROM {source})")
    return f"{_FEATURES}, " + ",\n".join(steps)


ORACLE["predict_prices"] = f"""
{_regression()}
SELECT symbol, strftime(window_start, {_TIME}) AS window_start,
       round(predicted_price + 1e-7, 4) AS predicted_price FROM p"""

ORACLE["predict_prices_merged"] = ORACLE["predict_prices"]

ORACLE["prediction_error"] = f"""
{_regression()}
SELECT symbol, strftime(window_start, {_TIME}) AS window_start,
       round(predicted_price - avg_price + 1e-7, 4) AS pred_error,
       round(coalesce(predicted_price - next_price, -1) + 1e-7, 4) AS aligned FROM p"""

ORACLE["kpi_summary"] = f"""
{_regression()}
SELECT symbol AS latest_symbol, round(avg_price + 1e-5, 2) AS latest_price,
       round(predicted_price + 1e-5, 2) AS predicted_price,
       CASE WHEN predicted_price >= avg_price THEN 'up' ELSE 'down' END AS direction,
       CAST((SELECT sum(trade_count) FROM p) AS BIGINT) AS total_trades,
       round((SELECT sum(sum_value) FROM p) + 1e-5, 2) AS total_volume,
       CAST(0 AS BIGINT) AS anomaly_count, 'normal' AS status
FROM p ORDER BY window_start DESC, symbol DESC LIMIT 1"""

ORACLE["list_symbols"] = "SELECT DISTINCT upper(event_type) AS symbol FROM events"
ORACLE["filter_symbols"] = f"""
{_HOURS} SELECT {_shown()} FROM w
WHERE symbol IN (SELECT DISTINCT symbol FROM ev ORDER BY symbol LIMIT 2)"""
ORACLE["latest_window"] = f"""
{_HOURS} SELECT {_shown()} FROM (SELECT * FROM w ORDER BY window_start DESC, symbol DESC LIMIT 1)"""
ORACLE["series_long"] = f"""
{_HOURS} SELECT symbol, strftime(window_start, {_TIME}) AS window_start, measure,
       round(value + 1e-9, 6) AS value
FROM (UNPIVOT (SELECT symbol, window_start, avg_price, CAST(trade_count AS DOUBLE) AS trade_count,
                      sum_value, CAST(spike_count AS DOUBLE) AS spike_count FROM w)
      ON avg_price, trade_count, sum_value, spike_count INTO NAME measure VALUE value)"""

ORACLE["peek_trades"] = f"""
WITH {EVENTS}
SELECT symbol, CASE WHEN trade_id % 7 > 0 THEN price ELSE 0 END AS price, quantity,
       trade_value_usdt AS value, {_ISO} AS time,
       CASE WHEN trade_id % 5 = 0 THEN 'SPIKE' ELSE '' END AS marker FROM ev"""
ORACLE["message_count"] = "SELECT count(*) AS messages FROM lineitem"

ORACLE["quality_report"] = f"""
WITH {EVENTS},
t AS (
  SELECT *, coalesce(abs(price - previous) / previous * 100 > 2.0, false) AS is_price_spike
  FROM (SELECT *, lag(price) OVER (PARTITION BY symbol ORDER BY timestamp_ms, trade_id) AS previous
        FROM ev WHERE price > 0)),
w AS ({_tumbling('t', '1 minute', 'CASE WHEN is_price_spike THEN 1 ELSE 0 END')})
SELECT check_name, CASE check_name WHEN 'non_positive_rows' THEN value = 0
                   WHEN 'missing_symbols' THEN value = 0 ELSE value > 0 END AS ok, value
FROM (
  SELECT 'non_positive_rows' AS check_name, count(*) FILTER (WHERE price <= 0 OR quantity <= 0) AS value
  FROM t
  UNION ALL SELECT 'spikes_flagged', count(*) FILTER (WHERE is_price_spike) FROM t
  UNION ALL SELECT 'missing_symbols', 3 - count(DISTINCT symbol) FROM w
            WHERE symbol IN ('CLICK', 'VIEW', 'NONE')
  UNION ALL SELECT 'window_span_seconds',
            CAST(epoch(max(window_start)) - epoch(min(window_start)) AS BIGINT) FROM w
  UNION ALL SELECT 'trades_counted', CAST(sum(trade_count) AS BIGINT) FROM w
  UNION ALL SELECT 'windows_priced', count(*) FILTER (WHERE avg_price > 0) FROM w
  UNION ALL SELECT 'spikes_in_windows', CAST(sum(spike_count) AS BIGINT) FROM w)"""


# The isolation forest: the same draws (digests as whole numbers below 2^52), cuts level by level, then a walk down every tree.
_RING = 4503599627370496
_FOREST_X = ("avg_price", "trade_count", "sum_value", "price_change_pct", "value_per_trade", "spike_rate")


def _drawn(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 13))::BIGINT"


def _path(n: str) -> str:
    return f"""CASE WHEN {n} > 2 THEN 2 * (ln({n} - 1) + 0.5772156649015329) - 2 * ({n} - 1)::DOUBLE / {n}
       WHEN {n} = 2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"""


def _split(rows: str) -> str:
    """Rows with the size, feature and cut of their node."""
    numbers = range(1, len(_FOREST_X) + 1)
    lows = ", ".join(f"min(x[{k}]) OVER node" for k in numbers)
    highs = ", ".join(f"max(x[{k}]) OVER node" for k in numbers)
    return f"""
  SELECT tree, x, node, level, n, feature, CASE WHEN cut < high THEN cut ELSE low END AS place
  FROM (SELECT *, low + {_drawn("'42:' || tree || ':' || node || ':cut'")} / {_RING}::DOUBLE * (high - low) AS cut
    FROM (SELECT *, lows[feature] AS low, highs[feature] AS high
      FROM (SELECT *, varying[1 + {_drawn("'42:' || tree || ':' || node || ':feature'")} % greatest(len(varying), 1)] AS feature
        FROM (SELECT *, list_filter(range(1, {len(_FOREST_X) + 1}), lambda k: highs[k] > lows[k]) AS varying
          FROM (SELECT tree, x, node, level, count(*) OVER node AS n, [{lows}] AS lows, [{highs}] AS highs
                FROM {rows} WINDOW node AS (PARTITION BY tree, node))))))"""


def _forest(base: str) -> str:
    """``base`` continued to ``scored``: its rows ``f`` with anomaly_score and anomaly."""
    return f"""{base.replace("WITH ", "WITH RECURSIVE ", 1)},
pts AS (
  SELECT symbol, window_start, [{", ".join(f"coalesce({c}, 0)::DOUBLE" for c in _FOREST_X)}] AS x,
         {_drawn("'42:' || symbol || ':' || epoch_us(window_start)")} AS u FROM f),
drawn AS (
  SELECT tree, x FROM (
    SELECT tree, x, row_number() OVER (PARTITION BY tree ORDER BY (u - s + {_RING}) % {_RING}, symbol, window_start) AS r
    FROM pts, (SELECT t AS tree, t * {_RING} // 100 AS s FROM range(100) AS r(t))) WHERE r <= 256),
grow AS (
  SELECT tree, x, 0::BIGINT AS node, 0 AS level FROM drawn
  UNION ALL
  SELECT tree, x, 2 * node + CASE WHEN x[feature] <= place THEN 1 ELSE 2 END, level + 1
  FROM ({_split("grow")}) WHERE level < 8 AND feature IS NOT NULL),
nodes AS (
  SELECT tree, node, any_value(n) AS n, any_value(level) AS level, any_value(CASE WHEN level < 8 THEN feature END) AS feature,
         any_value(place) AS place FROM ({_split("grow")}) GROUP BY tree, node),
walk AS (
  SELECT symbol, window_start, x, t AS tree, 0::BIGINT AS node FROM pts, range(100) AS r(t)
  UNION ALL
  SELECT w.symbol, w.window_start, w.x, w.tree, 2 * w.node + CASE WHEN w.x[n.feature] <= n.place THEN 1 ELSE 2 END
  FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node WHERE n.feature IS NOT NULL),
raws AS (
  SELECT w.symbol, w.window_start,
         -pow(2.0::DOUBLE, -sum(n.level + {_path("n.n")}) / 100 / (SELECT {_path("least(256, count(*))")} FROM pts)) AS raw
  FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node WHERE n.feature IS NULL GROUP BY 1, 2),
scored AS (
  SELECT f.*, raw - (SELECT quantile_cont(raw, 0.05) FROM raws) AS anomaly_score FROM f JOIN raws USING (symbol, window_start))"""


_AT = f"strftime(window_start, {_TIME}) AS window_start"
ORACLE["isolation_forest"] = f"""
{_forest(_FEATURES)}
SELECT symbol, {_AT}, anomaly_score < 0 AS anomaly, round(anomaly_score + 1e-9, 6) + 0.0 AS anomaly_score FROM scored"""

ORACLE["anomaly_report"] = f"""
{_forest(_FEATURES)}
SELECT symbol, {_AT}, round(avg_price + 1e-9, 6) AS avg_price, trade_count, round(sum_value + 1e-9, 6) AS sum_value, spike_count,
       round(anomaly_score + 1e-9, 6) AS anomaly_score FROM scored WHERE anomaly_score < 0"""

_ALL_SCORES = f"""{_forest(_regression())},
every AS (SELECT p.*, s.anomaly_score FROM p JOIN scored s USING (symbol, window_start))"""
_MODEL_COLUMNS = (*_X, "value_per_trade", "spike_rate", "anomaly_score")
ORACLE["score_windows"] = f"""
{_ALL_SCORES}
SELECT {_shown(4)}, anomaly_score < 0 AS anomaly, {", ".join(f"round({c} + 1e-7, 4) + 0.0 AS {c}" for c in _MODEL_COLUMNS)},
       round(predicted_price + 1e-7, 4) AS predicted_price, round(predicted_price - avg_price + 1e-7, 4) AS pred_error,
       round(coalesce(predicted_price - next_price, -1) + 1e-7, 4) AS pred_error_aligned FROM every"""

ORACLE["kpi_summary_scored"] = f"""
{_ALL_SCORES}
SELECT symbol AS latest_symbol, round(avg_price + 1e-5, 2) AS latest_price,
       round(predicted_price + 1e-5, 2) AS predicted_price,
       CASE WHEN predicted_price >= avg_price THEN 'up' ELSE 'down' END AS direction,
       CAST((SELECT sum(trade_count) FROM every) AS BIGINT) AS total_trades,
       round((SELECT sum(sum_value) FROM every) + 1e-5, 2) AS total_volume,
       (SELECT count(*) FROM every WHERE anomaly_score < 0) AS anomaly_count, 'anomalies' AS status
FROM every ORDER BY window_start DESC, symbol DESC LIMIT 1"""

ORACLE["series_long_scored"] = f"""
{_ALL_SCORES}
SELECT symbol, {_AT}, measure, round(value + 1e-7, 4) + 0.0 AS value
FROM (UNPIVOT (SELECT symbol, window_start, avg_price, CAST(trade_count AS DOUBLE) AS trade_count,
                      sum_value, CAST(spike_count AS DOUBLE) AS spike_count, predicted_price - avg_price AS pred_error,
                      anomaly_score FROM every)
      ON avg_price, trade_count, sum_value, spike_count, pred_error, anomaly_score INTO NAME measure VALUE value)"""
