"""SQL that says what each query must return, over the same tables."""

from __future__ import annotations

from ..functions.calendar import HOLIDAYS
from ..operators.metrics import LATENCY_BOUNDS, bucket_label
from ..operators.split import TRAIN_RATIO

ORACLES: dict[str, str] = {}

SALES = """
sales AS (
  SELECT CAST(l_shipdate AS DATE) AS date, CAST(s_nationkey AS BIGINT) AS store_nbr, p_type AS family,
         CAST(count(*) FILTER (WHERE l_discount > 0.05) AS BIGINT) AS onpromotion, sum(l_quantity) AS sales
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
  GROUP BY 1, 2, 3)
"""
DAY = "strftime(date, '%Y-%m-%d') AS date"
SERIES = "PARTITION BY store_nbr, family ORDER BY date"
_holidays = ", ".join(f"({m}, {d})" for m, d in HOLIDAYS)


def to_holiday(dates: str) -> str:
    """CTE holiday_gap(d, gap) for a query that lists distinct dates as d."""
    return f"""
holiday_gap AS (
  SELECT d, min(date_diff('day', d, make_date(CAST(year(d) + y AS BIGINT), CAST(m AS BIGINT), CAST(dd AS BIGINT)))) AS gap
  FROM ({dates}), (VALUES {_holidays}) h(m, dd), (VALUES (0), (1)) s(y)
  WHERE make_date(CAST(year(d) + y AS BIGINT), CAST(m AS BIGINT), CAST(dd AS BIGINT)) >= d
  GROUP BY d)
"""


SALES_GAP = to_holiday("SELECT DISTINCT date AS d FROM sales")

# Scans and sources

ORACLES["scan_table"] = "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier"
ORACLES["daily_sales"] = f"WITH {SALES} SELECT {DAY}, store_nbr, family, onpromotion, sales FROM sales"
ORACLES["scan_sales_csv"] = ORACLES["daily_sales"]
ORACLES["scan_eval_jsonl"] = """
SELECT conv_id, turn,
       CASE (conv_id * 7 + turn) % 9 WHEN 1 THEN 'missing: context' WHEN 2 THEN 'not a non-empty string: question'
            WHEN 3 THEN 'bad_json' WHEN 5 THEN 'not a non-empty string: question' ELSE 'ok' END AS reason,
       CASE WHEN (conv_id * 7 + turn) % 9 IN (1, 2, 3, 5) THEN '' ELSE text END AS context
FROM conversations WHERE (conv_id * 7 + turn) % 9 <> 4
"""
ORACLES["scan_event_props"] = """
SELECT 'not a non-empty string: k' AS reason, count(*) AS n FROM events
WHERE json_type(props::JSON, '$.k') <> 'VARCHAR' GROUP BY 1
"""
RAW_REQUESTS = """
raw AS (
  SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS request_id, c_nationkey, c_mktsegment,
         CASE WHEN o_orderpriority LIKE '1%' THEN 1 ELSE 0 END AS promo
  FROM orders JOIN customer ON o_custkey = c_custkey)
"""
ORACLES["validate_requests"] = f"""
WITH {RAW_REQUESTS}
SELECT request_id, CAST(CASE WHEN k % 13 = 0 THEN 1 ELSE c_nationkey END AS BIGINT) AS store_nbr,
       CASE WHEN k % 7 = 0 THEN 'GROCERY I' ELSE c_mktsegment END AS family, CAST(promo AS BIGINT) AS onpromotion,
       '2017-08-16' AS base_date, CAST(CASE WHEN k % 5 = 0 THEN 30 ELSE 1 + k % 30 END AS INTEGER) AS days_ahead
FROM raw WHERE k % 11 <> 0 AND k % 17 <> 0
"""
ORACLES["quarantined_requests"] = f"""
WITH {RAW_REQUESTS}
SELECT 'requests' AS source,
       CASE WHEN k % 11 = 0 AND k % 17 = 0 THEN 'invalid: store_nbr, onpromotion'
            WHEN k % 11 = 0 THEN 'invalid: store_nbr' ELSE 'invalid: onpromotion' END AS reason, count(*) AS n
FROM raw WHERE k % 11 = 0 OR k % 17 = 0 GROUP BY 1, 2
"""

# Features

ORACLES["calendar_features"] = f"""
WITH {SALES}, {SALES_GAP}
SELECT {DAY}, store_nbr, family, CAST(isodow(date) - 1 AS BIGINT) AS day_of_week, CAST(month(date) AS BIGINT) AS month,
       CAST(year(date) AS BIGINT) AS year, CAST(gap AS BIGINT) AS days_to_holiday
FROM sales JOIN holiday_gap ON date = d
"""
ORACLES["days_to_holiday"] = f"""
WITH {to_holiday("SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders")}
SELECT o_orderkey, CAST(gap AS BIGINT) AS days_to_holiday FROM orders JOIN holiday_gap ON CAST(o_orderdate AS DATE) = d
"""
LAGS = f"""coalesce(lag(sales, 7) OVER ({SERIES}), 0) AS lag_7, coalesce(lag(sales, 14) OVER ({SERIES}), 0) AS lag_14"""
MEAN_7 = f"coalesce(avg(sales) OVER ({SERIES} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 0)"
MEAN_BEFORE = f"coalesce(avg(sales) OVER ({SERIES} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 0)"
ORACLES["lag_features"] = f"WITH {SALES} SELECT {DAY}, store_nbr, family, sales, {LAGS} FROM sales"
ORACLES["rolling_mean"] = f"""
WITH {SALES} SELECT {DAY}, store_nbr, family, sales, round({MEAN_7}, 6) AS rolling_mean_7 FROM sales
"""
ORACLES["rolling_mean_before"] = f"""
WITH {SALES} SELECT {DAY}, store_nbr, family, sales, round({MEAN_BEFORE}, 6) AS rolling_mean_7 FROM sales
"""
_day_lags = ", ".join(
    f"""coalesce(sum(sales) OVER (PARTITION BY store_nbr, family ORDER BY date
       RANGE BETWEEN INTERVAL {k} DAY PRECEDING AND INTERVAL {k} DAY PRECEDING), 0) AS day_lag_{k}"""
    for k in (7, 14)
)
ORACLES["calendar_lag"] = f"""
WITH {SALES}
SELECT strftime(date, '%Y-%m-%d') AS date, store_nbr, family, sales, {_day_lags} FROM sales
"""
_families = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
_flags = ", ".join(f"CAST(family = '{f}' AS DOUBLE) AS family_{f}" for f in _families)
ORACLES["one_hot_family"] = f"WITH {SALES} SELECT {DAY}, store_nbr, sales, {_flags} FROM sales"
ORACLES["feature_table"] = f"""
WITH {SALES}, {SALES_GAP}, f AS (SELECT *, {LAGS}, round({MEAN_7}, 6) AS rolling_mean_7 FROM sales)
SELECT store_nbr, strftime(date, '%Y-%m-%d 00:00:00') AS event_timestamp, family, onpromotion,
       CAST(isodow(date) - 1 AS BIGINT) AS day_of_week, CAST(month(date) AS BIGINT) AS month,
       CAST(year(date) AS BIGINT) AS year, CAST(gap AS BIGINT) AS days_to_holiday, lag_7, lag_14, rolling_mean_7, sales
FROM f JOIN holiday_gap ON date = d
"""

# As-of join, split, sample

_family_list = ", ".join(f"'{f}'" for f in _families)
ORACLES["pit_join"] = f"""
WITH {SALES}, asked AS (
  SELECT o_orderkey, CAST(c_nationkey AS BIGINT) AS store_nbr, ([{_family_list}])[o_orderkey % 6 + 1] AS family,
         CAST(o_orderdate AS DATE) AS asked_on
  FROM orders JOIN customer ON o_custkey = c_custkey),
found AS (
  SELECT a.*, s.date, s.onpromotion, s.sales FROM asked a ASOF LEFT JOIN sales s
  ON a.store_nbr = s.store_nbr AND a.family = s.family AND a.asked_on >= s.date)
SELECT o_orderkey, store_nbr, family, strftime(asked_on, '%Y-%m-%d 00:00:00') AS event_timestamp,
       CAST(CASE WHEN asked_on - date <= 10 THEN onpromotion ELSE -1 END AS BIGINT) AS onpromotion,
       CASE WHEN asked_on - date <= 10 THEN sales ELSE -1 END AS sales
FROM found
"""
ORACLES["latest_per_key"] = """
SELECT user_id, event_type, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
"""
ORACLES["chrono_split"] = f"""
WITH {SALES}
SELECT {DAY}, store_nbr, family,
       CASE WHEN row_number() OVER (ORDER BY date, store_nbr, family) <= floor((SELECT count(*) FROM sales) * 0.8::DOUBLE)
            THEN 'train' ELSE 'valid' END AS split
FROM sales
"""
ORACLES["sample_exact"] = f"""
WITH {SALES}
SELECT strftime(date, '%Y-%m-%d') AS day, store_nbr, family, sales FROM sales
ORDER BY md5(concat_ws('|', strftime(date, '%Y-%m-%d'), CAST(store_nbr AS VARCHAR), family, '42')), 1, 2, 3 LIMIT 5000
"""

# Drift

NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_suppkey")
LINE_LONG = "numbers AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v, l_shipdate < DATE '1998-01-01' AS ref FROM lineitem"
    for c in NUMBERS
) + ")"
LINE_TEXT = "texts AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {c} AS v, l_shipdate < DATE '1998-01-01' AS ref FROM lineitem"
    for c in ("l_returnflag", "l_linestatus")
) + ")"
_window_numbers = {
    "store_nbr": "store_nbr",
    "onpromotion": "onpromotion",
    "day_of_week": "isodow(date) - 1",
    "month": "month(date)",
    "year": "year(date)",
}
WINDOW_LONG = "numbers AS (" + " UNION ALL ".join(
    f"SELECT '{name}' AS feature, CAST({e} AS DOUBLE) AS v, date < DATE '1998-01-01' AS ref FROM sales"
    for name, e in _window_numbers.items()
) + "), texts AS (SELECT 'family' AS feature, family AS v, date < DATE '1998-01-01' AS ref FROM sales)"

EDGES = """
ranks AS (
  SELECT feature, v, row_number() OVER (PARTITION BY feature ORDER BY v) - 1 AS rk,
         count(*) OVER (PARTITION BY feature) AS n
  FROM numbers WHERE ref),
positions AS (
  SELECT feature, n, CAST(n - 1 AS DOUBLE) * (CASE WHEN i = 10 THEN 1.0::DOUBLE ELSE i * 0.1::DOUBLE END) AS p
  FROM (SELECT DISTINCT feature, n FROM ranks), range(11) t(i)),
ends AS (
  SELECT p.feature, a.v AS a, b.v AS b, p - floor(p) AS t
  FROM positions p
  JOIN ranks a ON a.feature = p.feature AND a.rk = CAST(floor(p.p) AS BIGINT)
  JOIN ranks b ON b.feature = p.feature AND b.rk = least(CAST(floor(p.p) AS BIGINT) + 1, p.n - 1)),
edges AS (
  SELECT feature, edge, row_number() OVER (PARTITION BY feature ORDER BY edge) - 1 AS edge_no,
         count(*) OVER (PARTITION BY feature) AS n_edges
  FROM (SELECT DISTINCT feature, CASE WHEN t < 0.5 THEN a + (b - a) * t ELSE b - (b - a) * (1 - t) END AS edge FROM ends)),
bins AS (
  SELECT x.feature, x.edge_no AS bin, x.edge AS low, y.edge AS high, x.edge_no = x.n_edges - 2 AS closed
  FROM edges x JOIN edges y ON x.feature = y.feature AND y.edge_no = x.edge_no + 1),
binned AS (
  SELECT b.feature, b.bin, count(*) FILTER (WHERE ref) AS ref_n, count(*) FILTER (WHERE NOT ref) AS cur_n
  FROM numbers v JOIN bins b ON b.feature = v.feature AND v.v >= b.low AND (v.v < b.high OR (b.closed AND v.v = b.high))
  GROUP BY 1, 2)
"""
NUMERIC = """
numeric_psi AS (
  SELECT feature, CASE WHEN max(cr) = 0 THEN NULL ELSE round(sum((c - r) * ln(c / r)), 6) END AS psi
  FROM (SELECT feature, cr, ref_n / rr + 1e-6 AS r, CASE WHEN cr = 0 THEN 1e-6 ELSE cur_n / cr + 1e-6 END AS c
        FROM (SELECT *, sum(ref_n) OVER (PARTITION BY feature) AS rr, sum(cur_n) OVER (PARTITION BY feature) AS cr
              FROM binned))
  GROUP BY 1)
"""
CATEGORICAL = """
counted AS (
  SELECT feature, v, count(*) FILTER (WHERE ref) AS ref_n, count(*) FILTER (WHERE NOT ref) AS cur_n
  FROM texts GROUP BY 1, 2),
categorical_psi AS (
  SELECT feature, round(sum((c - r) * ln(c / r)), 6) AS psi
  FROM (SELECT feature, ref_n, ref_n / sum(ref_n) OVER (PARTITION BY feature) + 1e-6 AS r,
               cur_n / sum(cur_n) OVER (PARTITION BY feature) + 1e-6 AS c FROM counted)
  WHERE ref_n > 0 GROUP BY 1)
"""
REPORT = f"""
{SALES}, {WINDOW_LONG}, {EDGES}, {NUMERIC}, {CATEGORICAL},
report AS (SELECT * FROM numeric_psi UNION ALL SELECT * FROM categorical_psi)
"""
BAND = """CASE WHEN psi < 0.1 THEN 'stable' WHEN psi <= 0.2 THEN 'moderate' WHEN psi > 0.2 THEN 'significant' ELSE '' END"""
STATUS = "CASE WHEN psi IS NULL THEN 'no_data' ELSE 'ok' END AS status"

ORACLES["value_share"] = """
WITH long AS (
  SELECT 'l_returnflag' AS feature, l_returnflag AS value FROM lineitem
  UNION ALL SELECT 'l_linestatus', l_linestatus FROM lineitem
  UNION ALL SELECT 'l_linenumber', CAST(l_linenumber AS VARCHAR) FROM lineitem)
SELECT feature, value, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY feature), 6) AS share
FROM long GROUP BY 1, 2
"""
ORACLES["quantile_edges"] = f"""
WITH {LINE_LONG}, {EDGES} SELECT feature, CAST(edge_no AS INTEGER) AS edge_no, round(edge, 6) AS edge FROM edges
"""
ORACLES["histogram_counts"] = f"""
WITH {LINE_LONG}, {EDGES} SELECT feature, CAST(bin AS INTEGER) AS bin, cur_n AS n FROM binned WHERE cur_n > 0
"""
ORACLES["psi_numeric"] = f"WITH {LINE_LONG}, {EDGES}, {NUMERIC} SELECT feature, psi, {STATUS} FROM numeric_psi"
ORACLES["psi_categorical"] = f"WITH {LINE_TEXT}, {CATEGORICAL} SELECT feature, psi, {STATUS} FROM categorical_psi"
ORACLES["psi_report"] = f"WITH {REPORT} SELECT feature, psi, {BAND} AS band, {STATUS} FROM report"
ORACLES["drift_band"] = f"""
SELECT {BAND} AS band, count(*) AS n FROM (SELECT (o_orderkey % 31) / 100.0::DOUBLE AS psi FROM orders) GROUP BY 1
"""
ORACLES["retrain_decision"] = f"""
WITH {REPORT}
SELECT coalesce(bool_or(psi > 0.2), false) AS retrain, max(psi) AS max_psi, arg_max(feature, psi) AS max_feature FROM report
"""
ORACLES["window_sizes"] = f"""
WITH {SALES}
SELECT count(*) FILTER (WHERE date < DATE '1998-01-01') AS ref_rows,
       count(*) FILTER (WHERE date >= DATE '1998-01-01') AS cur_rows FROM sales
"""
ORACLES["format_gauge_lines"] = f"""
WITH {REPORT}, shown AS (
  SELECT row_number() OVER (ORDER BY feature) + 1 AS line_no, printf('psi_score{{feature="%s"}} %.6f', feature, psi) AS line
  FROM report WHERE psi IS NOT NULL)
SELECT CAST(line_no AS INTEGER) AS line_no, line FROM shown
UNION ALL SELECT 0, '# HELP psi_score Population Stability Index per feature'
UNION ALL SELECT 1, '# TYPE psi_score gauge'
"""
ORACLES["psi_json"] = f"WITH {REPORT} SELECT feature, psi FROM report WHERE psi IS NOT NULL"
ORACLES["ks_statistic"] = f"""
WITH {LINE_LONG}, counts AS (
  SELECT feature, v, count(*) FILTER (WHERE ref) AS r, count(*) FILTER (WHERE NOT ref) AS c FROM numbers GROUP BY 1, 2),
running AS (
  SELECT feature, sum(r) OVER w / sum(r) OVER a AS fr, sum(c) OVER w / sum(c) OVER a AS fc FROM counts
  WINDOW w AS (PARTITION BY feature ORDER BY v), a AS (PARTITION BY feature))
SELECT feature, round(max(abs(fr - fc)), 6) AS ks FROM running GROUP BY 1
"""
ORACLES["chi2_test"] = f"""
WITH {LINE_TEXT}, counts AS (
  SELECT feature, v, count(*) FILTER (WHERE ref)::DOUBLE AS r, count(*) FILTER (WHERE NOT ref)::DOUBLE AS c
  FROM texts GROUP BY 1, 2),
totals AS (SELECT *, sum(r) OVER a AS rr, sum(c) OVER a AS cc FROM counts WINDOW a AS (PARTITION BY feature)),
expected AS (SELECT *, (r + c) * rr / (rr + cc) AS er, (r + c) * cc / (rr + cc) AS ec FROM totals)
SELECT feature, round(sum((r - er) ** 2 / er + (c - ec) ** 2 / ec), 6) AS chi2, count(*) - 1 AS degrees
FROM expected GROUP BY 1
"""

# Answer quality

ANSWERS = """
answers AS (
  SELECT u.conv_id * 1000 + u.turn AS id, u.text AS question, d.text AS context, a.text AS answer
  FROM conversations u
  JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  JOIN documents d ON d.doc_id = u.conv_id
  WHERE u.role = 'user')
"""
_words = "list_distinct(regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}_]+'))"
PRECISION = f"""
tokens AS (SELECT *, {_words.format('answer')} AS words, {_words.format('context')} AS known FROM answers),
precisions AS (
  SELECT *, CASE WHEN len(words) = 0 THEN 0.0 ELSE len(list_intersect(words, known)) / len(words) END AS precision FROM tokens)
"""
ORACLES["tokenize"] = f"""
SELECT word, count(*) AS documents FROM (SELECT unnest({_words.format('text')}) AS word FROM documents) GROUP BY 1
"""
ORACLES["token_precision"] = f"WITH {ANSWERS}, {PRECISION} SELECT id, round(precision, 6) AS precision FROM precisions"
ORACLES["cosine_clip"] = """
SELECT a.vec_id, round(greatest(0, least(1,
  list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])))), 6) AS relevance
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1
"""
ORACLES["nli_score"] = """
SELECT doc_id, round(CASE WHEN toxic = 1 THEN 1 - (doc_id % 100) / 100.0::DOUBLE
                          WHEN quality = 1 THEN (doc_id % 100) / 100.0::DOUBLE ELSE 0.5 END, 6) AS faithfulness
FROM labels
"""
ORACLES["score_faithfulness"] = f"""
WITH {ANSWERS}, sized AS (SELECT id, length(context) + 7 + length(answer) AS n FROM answers)
SELECT id, round(CASE n % 3 WHEN 0 THEN (n % 101) / 100.0::DOUBLE WHEN 1 THEN 1 - (n % 101) / 100.0::DOUBLE ELSE 0.5 END, 6)
       AS faithfulness
FROM sized
"""


def _letters(text: str) -> str:
    return "[" + ", ".join(f"CAST(length({text}) - length(replace({text}, '{x}', '')) AS DOUBLE)" for x in "aeinst ") + "]"


ORACLES["embed_text"] = f"""
WITH {ANSWERS}, vectors AS (SELECT id, {_letters('question')} AS q, {_letters('answer')} AS a FROM answers),
products AS (SELECT id, list_dot_product(q, a) AS qa, list_dot_product(q, q) * list_dot_product(a, a) AS norms FROM vectors)
SELECT id, round(CASE WHEN norms = 0 THEN 0 ELSE greatest(0, least(1, qa / sqrt(norms))) END, 4) AS relevance FROM products
"""
ORACLES["eval_gate"] = f"""
WITH {ANSWERS}, {PRECISION}, means AS (
  SELECT count(*) AS n, avg(CASE WHEN length(answer) % 2 = 0 THEN 0.9::DOUBLE ELSE 0.5 END) AS f,
         avg(length(question) % 100 / 100.0::DOUBLE) AS r, avg(precision) AS p FROM precisions)
SELECT n, round(f, 6) AS mean_faithfulness, round(r, 6) AS mean_relevance, round(p, 6) AS mean_precision,
       f >= 0.6 AS pass_faithfulness, r >= 0.6 AS pass_relevance, p >= 0.6 AS pass_precision,
       f >= 0.6 AND r >= 0.6 AND p >= 0.6 AS overall
FROM means
"""

# Request metrics

LOG = """
log AS (SELECT ts, CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status, value / 100 AS latency_s FROM events),
slides AS (SELECT *, date_trunc('minute', ts) - to_minutes(CAST(k AS BIGINT)) AS w FROM log, range(5) t(k))
"""
WINDOW_NAMES = """
strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(w + INTERVAL 5 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end
"""
CLOSED = "w + INTERVAL 5 MINUTE <= (SELECT max(ts) FROM log) - INTERVAL 10 MINUTE"
ORACLES["request_counts"] = f"WITH {LOG} SELECT status, count(*) AS requests FROM log GROUP BY 1"
_bounds = ", ".join(f"('{bucket_label(b)}', {b}::DOUBLE)" for b in LATENCY_BOUNDS) + ", ('+Inf', 'infinity'::DOUBLE)"
ORACLES["latency_buckets"] = f"""
WITH {LOG}
SELECT status, le, count(*) FILTER (WHERE latency_s <= bound) AS requests
FROM log, (VALUES {_bounds}) b(le, bound) GROUP BY 1, 2
"""


def _rates(where: str = "true") -> str:
    return f"""
WITH {LOG}
SELECT {WINDOW_NAMES}, status, count(*) AS requests, round(count(*) / 300, 6) AS per_second
FROM slides WHERE {where} GROUP BY w, status
"""


def _quantile(q: float) -> str:
    """Over the buckets of a window, in order: the first whose cumulative count reaches the rank."""
    return f"""
max(CASE WHEN cum >= {q}::DOUBLE * total AND before < {q}::DOUBLE * total THEN
      CASE WHEN isinf(bound) THEN low ELSE low + (bound - low) * (({q}::DOUBLE * total - before) / (cum - before)) END END)
"""


def _quantiles(where: str = "true") -> str:
    return f"""
WITH {LOG}, cumulative AS (
  SELECT w, bound, count(*) FILTER (WHERE latency_s <= bound) AS cum, count(*) AS total
  FROM slides, (VALUES {_bounds}) b(le, bound) WHERE {where} GROUP BY 1, 2),
steps AS (
  SELECT *, coalesce(lag(cum) OVER (PARTITION BY w ORDER BY bound), 0) AS before,
         coalesce(lag(bound) OVER (PARTITION BY w ORDER BY bound), 0) AS low FROM cumulative)
SELECT {WINDOW_NAMES}, max(total) AS requests, round({_quantile(0.5)}, 6) AS p50, round({_quantile(0.95)}, 6) AS p95
FROM steps GROUP BY w
"""


ORACLES["request_rate_5m"] = _rates()
ORACLES["latency_quantiles_5m"] = _quantiles()
ORACLES["stream_request_rate_5m"] = _rates(CLOSED)
ORACLES["stream_latency_quantiles_5m"] = _quantiles(CLOSED)


def _window_drift(where: str) -> str:
    """Daily windows against the first ten days: quantile bins of value, categories of event_type."""
    return f"""
WITH numbers AS (SELECT 'value' AS feature, value AS v, ts < TIMESTAMP '2024-01-11' AS ref, ts FROM events), {EDGES},
placed AS (
  SELECT v.feature, CAST(b.bin AS VARCHAR) AS bin, ref, date_trunc('day', ts) AS w
  FROM numbers v JOIN bins b ON v.v >= b.low AND (v.v < b.high OR (b.closed AND v.v = b.high))
  UNION ALL SELECT 'event_type', event_type, ts < TIMESTAMP '2024-01-11', date_trunc('day', ts) FROM events),
wanted AS (SELECT feature, bin, count(*) AS ref_n FROM placed WHERE ref GROUP BY 1, 2),
shares AS (SELECT *, ref_n / sum(ref_n) OVER (PARTITION BY feature) + 1e-6 AS r FROM wanted),
seen AS (SELECT w, feature, bin, count(*) AS n FROM placed WHERE NOT ref GROUP BY 1, 2, 3),
totals AS (SELECT w, feature, sum(n) AS total FROM seen GROUP BY 1, 2),
scored AS (
  SELECT t.w, t.feature, round(sum((coalesce(n, 0) / total + 1e-6 - r) * ln((coalesce(n, 0) / total + 1e-6) / r)), 6) AS psi
  FROM totals t JOIN shares s ON s.feature = t.feature
  LEFT JOIN seen c ON c.w = t.w AND c.feature = t.feature AND c.bin = s.bin
  GROUP BY 1, 2)
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, feature, psi, {BAND} AS band FROM scored WHERE {where}
"""


ORACLES["psi_windows"] = _window_drift("true")
ORACLES["stream_psi"] = _window_drift(
    "w + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE"
)
ORACLES["stream_validate_requests"] = """
SELECT CASE WHEN o_orderkey % 11 = 0 THEN 'invalid: store_nbr'
            WHEN o_orderkey % 5 = 0 THEN 'horizon 30' ELSE concat('horizon ', o_orderkey % 30 + 1) END AS outcome, count(*) AS n
FROM orders GROUP BY 1
"""

# Forecasts

REQUESTS = """
requests AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS request_id, CAST(c_nationkey AS BIGINT) AS store_nbr, c_mktsegment AS family,
         CAST(1 + o_orderkey % 30 AS INTEGER) AS days_ahead, DATE '2017-08-16' AS base_date
  FROM orders JOIN customer ON o_custkey = c_custkey)
"""
ORACLES["clip_forecast"] = "SELECT c_custkey, greatest(c_acctbal, 0) AS yhat FROM customer"
ORACLES["align_columns"] = "SELECT 0.0::DOUBLE AS lag_7, c_acctbal, c_custkey FROM customer"
ORACLES["expand_horizon"] = f"""
WITH {REQUESTS}, steps AS (
  SELECT *, CAST(unnest(range(days_ahead)) AS INTEGER) AS step FROM requests),
dated AS (SELECT *, base_date + step AS date FROM steps),
{to_holiday("SELECT DISTINCT date AS d FROM dated")}
SELECT request_id, step, {DAY}, store_nbr, CASE WHEN step >= 7 THEN store_nbr + 0.5::DOUBLE ELSE 0 END AS lag_7,
       CASE WHEN step >= 14 THEN store_nbr + 0.5::DOUBLE ELSE 0 END AS lag_14, store_nbr + 0.5::DOUBLE AS rolling_mean_7,
       CAST(isodow(date) - 1 AS BIGINT) AS day_of_week, CAST(gap AS BIGINT) AS days_to_holiday
FROM dated JOIN holiday_gap ON date = d
"""
ORACLES["forecast_requests_no_model"] = f"""
WITH {REQUESTS}
SELECT request_id, '1.0.0' AS model_version, sha256(request_id || '|1.0.0') AS prediction_id, 'no_model' AS status,
       days_ahead AS steps, 0.0::DOUBLE AS total FROM requests
"""
ORACLES["forecast_requests_baseline"] = f"""
WITH {REQUESTS}
SELECT request_id, 'baseline' AS model_version, sha256(request_id || '|baseline') AS prediction_id, 'ok' AS status,
       days_ahead AS steps, least(days_ahead, 7) * 20.0::DOUBLE + greatest(days_ahead - 7, 0) * 40.0::DOUBLE AS total
FROM requests
"""
BASELINE = f"""
{SALES}, baseline AS (
  SELECT *, coalesce(lag(sales, 7) OVER ({SERIES}), 0) AS lag_7,
         (coalesce(lag(sales, 7) OVER ({SERIES}), 0) + {MEAN_BEFORE}) / 2 AS yhat FROM sales)
"""
ORACLES["baseline_forecast"] = f"WITH {BASELINE} SELECT {DAY}, store_nbr, family, round(yhat, 6) AS yhat FROM baseline"
ORACLES["rmse"] = f"""
WITH {BASELINE}
SELECT store_nbr, count(*) AS n, round(sqrt(avg((sales - yhat) ** 2)), 6) AS rmse FROM baseline GROUP BY 1
"""
ORACLES["rmsle"] = f"""
WITH {BASELINE}
SELECT family, count(*) AS n, round(sqrt(avg((ln(1 + sales) - ln(1 + yhat)) ** 2)), 6) AS rmsle FROM baseline GROUP BY 1
"""
ORACLES["compare_models"] = f"""
WITH {BASELINE}, errors AS (
  SELECT store_nbr, family, sqrt(avg((sales - yhat) ** 2)) AS a, sqrt(avg((sales - lag_7) ** 2)) AS b FROM baseline GROUP BY 1, 2)
SELECT store_nbr, family, round(a, 6) AS candidate_rmse, round(b, 6) AS production_rmse, round(a - b, 6) AS delta FROM errors
"""
ORACLES["must_beat_production"] = f"""
WITH {BASELINE}
SELECT family, avg((sales - yhat) ** 2) < avg((sales - lag_7) ** 2) AS promote FROM baseline GROUP BY 1
"""
ORACLES["ground_truth_join"] = f"""
WITH {BASELINE}
SELECT strftime(date, '%Y-%m') AS month, count(*) AS n, round(sqrt(avg((sales - yhat) ** 2)), 6) AS rmse FROM baseline GROUP BY 1
"""
ORACLES["prediction_drift"] = f"""
WITH {BASELINE}, numbers AS (SELECT 'yhat' AS feature, yhat AS v, date < DATE '1998-01-01' AS ref FROM baseline), {EDGES}, {NUMERIC}
SELECT feature, psi, {STATUS} FROM numeric_psi
"""
ORACLES["quality_checks"] = f"""
WITH {SALES}, counts AS (
  SELECT 'null_date' AS rule, count(*) FILTER (WHERE date IS NULL) AS violations FROM sales
  UNION ALL SELECT 'null_store', count(*) FILTER (WHERE store_nbr IS NULL) FROM sales
  UNION ALL SELECT 'null_family', count(*) FILTER (WHERE family IS NULL) FROM sales
  UNION ALL SELECT 'null_sales', count(*) FILTER (WHERE sales IS NULL OR isnan(sales)) FROM sales
  UNION ALL SELECT 'negative_sales', count(*) FILTER (WHERE sales < 0) FROM sales
  UNION ALL SELECT 'negative_onpromotion', count(*) FILTER (WHERE onpromotion < 0) FROM sales
  UNION ALL SELECT 'many_promotions', count(*) FILTER (WHERE onpromotion > 2) FROM sales
  UNION ALL SELECT 'small_sales', count(*) FILTER (WHERE sales <= 5) FROM sales)
SELECT rule, violations, violations = 0 AS passed FROM counts
"""
ORACLES["store_attributes"] = f"""
WITH {SALES}
SELECT {DAY}, store_nbr, family, n_name AS store, n_regionkey AS region, sales FROM sales LEFT JOIN nation ON store_nbr = n_nationkey
"""
ORACLES["best_trial"] = """
SELECT p_size AS trial, min(p_retailprice) AS val_rmse FROM part GROUP BY p_brand, p_size ORDER BY val_rmse, trial LIMIT 1
"""

ORACLES["write_feature_table"] = ORACLES["feature_table"]
ORACLES["stored_features"] = f"""
WITH {SALES}
SELECT {DAY}, store_nbr, family, sales, {LAGS}, round({MEAN_7}, 6) AS rolling_mean_7 FROM sales
"""
ORACLES["forecast_requests_history"] = f"""
WITH {SALES}, known AS (SELECT *, {MEAN_7} AS hint FROM sales),
asked AS (
  SELECT strftime(date, '%Y-%m-%d') || '|' || store_nbr || '|' || family AS request_id, store_nbr, family,
         date + 3 AS base_date, CAST(1 + day(date) % 10 AS INTEGER) AS steps FROM sales),
found AS (
  SELECT a.request_id, a.steps, k.hint FROM asked a ASOF JOIN known k
  ON a.store_nbr = k.store_nbr AND a.family = k.family AND a.base_date >= k.date)
SELECT request_id, 'history' AS model_version, sha256(request_id || '|history') AS prediction_id, 'ok' AS status, steps,
       round(least(steps, 7) * hint / 2 + greatest(steps - 7, 0) * hint, 4) AS total
FROM found
"""
_SPLIT = f"""
{SALES}, placed AS (
  SELECT *, row_number() OVER (ORDER BY date, store_nbr, family) <= floor((SELECT count(*) FROM sales) * {TRAIN_RATIO}) AS first
  FROM sales)
"""
ORACLES["load_model"] = f"""
WITH {_SPLIT} SELECT CASE WHEN first THEN 'train' ELSE 'valid' END AS split, count(*) AS n, count(*) AS same FROM placed GROUP BY 1
"""

def _stumps(rounds: int = 8, step: float = 0.6, patience: int = 2, more_cells: str = "") -> str:
    """CTEs cells(store_nbr, month, day_of_week, f), losses(round, loss), kept_round(kept): boosted trees of one split.

    All rows of a store, month and day of the week are alike to the trees, so sums over these
    cells say where each tree splits: where the squared sums of both sides over their rows are greatest.
    """
    names = ("store_nbr", "month", "day_of_week")
    ctes = [
        _SPLIT,
        f"""c0 AS (
  SELECT store_nbr, month, day_of_week, count(*) FILTER (WHERE part = 1) AS n, coalesce(sum(sales) FILTER (WHERE part = 1), 0) AS s,
         count(*) FILTER (WHERE part = 2) AS vn, coalesce(sum(sales) FILTER (WHERE part = 2), 0) AS vs,
         coalesce(sum(sales * sales) FILTER (WHERE part = 2), 0) AS vss
  FROM (SELECT store_nbr, month(date) AS month, isodow(date) - 1 AS day_of_week, sales, CASE WHEN first THEN 1 ELSE 2 END AS part FROM placed
        {more_cells}) GROUP BY ALL)""",
    ]
    for k in range(1, rounds + 1):
        target, weight = ("s", 1.0) if k == 1 else (f"2 * (s - n * f{k - 1})", step)
        before = "0" if k == 1 else f"f{k - 1}"
        counted = " UNION ALL ".join(
            f"SELECT '{x}' AS feature, {i} AS place, {x} AS v, sum(n) AS n, sum(t) AS t FROM t{k} GROUP BY {x} HAVING sum(n) > 0"
            for i, x in enumerate(names)
        )
        side = "CASE feature WHEN 'store_nbr' THEN store_nbr WHEN 'month' THEN month ELSE day_of_week END"
        ctes += [
            f"t{k} AS MATERIALIZED (SELECT *, CAST({target} AS DOUBLE) AS t FROM c{k - 1})",
            f"""b{k} AS MATERIALIZED (
  SELECT feature, v, tl / nl AS below, (tt - tl) / (nt - nl) AS above FROM (
    SELECT feature, place, v, sum(n) OVER upto AS nl, sum(t) OVER upto AS tl, sum(n) OVER whole AS nt, sum(t) OVER whole AS tt
    FROM ({counted})
    WINDOW upto AS (PARTITION BY feature ORDER BY v), whole AS (PARTITION BY feature))
  WHERE nl < nt ORDER BY tl * tl / nl + (tt - tl) * (tt - tl) / (nt - nl) DESC, place, v LIMIT 1)""",
            f"c{k} AS MATERIALIZED (SELECT t{k}.* EXCLUDE (t), {before} + {weight}::DOUBLE * CASE WHEN {side} <= v THEN below ELSE above END AS f{k} FROM t{k}, b{k})",
        ]
    losses = " UNION ALL ".join(
        f"SELECT {k} AS round, sum(vss - 2 * f{k} * vs + vn * f{k} * f{k}) / sum(vn) AS loss FROM c{rounds}" for k in range(1, rounds + 1)
    )
    choice = " ".join(f"WHEN {k} THEN f{k}" for k in range(1, rounds + 1))
    ctes += [
        f"losses AS MATERIALIZED ({losses})",
        "gains AS (SELECT * FROM (SELECT *, min(loss) OVER (ORDER BY round ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS least FROM losses) WHERE least IS NULL OR loss < least)",
        f"kept_round AS (SELECT min(round) AS kept FROM (SELECT round, lead(round) OVER (ORDER BY round) AS following FROM gains) WHERE following IS NULL OR following > round + {patience})",
        f"cells AS (SELECT store_nbr, month, day_of_week, greatest(0, CASE kept {choice} END) AS f FROM c{rounds}, kept_round)",
    ]
    return ",\n".join(c.strip() for c in ctes)


_CELL = "c.store_nbr = r.store_nbr AND c.month = month(r.date) AND c.day_of_week = isodow(r.date) - 1"
ORACLES["train_stumps"] = f"""
WITH {_stumps()}
SELECT CASE WHEN first THEN 'train' ELSE 'valid' END AS split, count(*) AS n, round(sqrt(avg((sales - f) * (sales - f))), 6) AS rmse,
       CAST(any_value(kept) AS BIGINT) AS rounds
FROM placed r JOIN cells c ON {_CELL}, kept_round GROUP BY 1
"""
ORACLES["boosting_losses"] = f"""
WITH {_stumps()}
SELECT CAST(round AS BIGINT) AS round, round(loss, 6) AS loss, round <= kept AS kept FROM losses, kept_round WHERE round <= kept + 2
"""
ORACLES["score_table"] = f"""
WITH {_stumps()}
SELECT strftime(r.date, '%Y-%m-%d') AS date, r.store_nbr, family, sales, round(f, 6) AS yhat FROM placed r JOIN cells c ON {_CELL} WHERE NOT first
"""
_asked_cells = """UNION ALL
        SELECT DISTINCT store_nbr, month(date), isodow(date) - 1, 0, 0 FROM dated"""
ORACLES["forecast_requests"] = f"""
WITH {REQUESTS}, dated AS (
  SELECT *, base_date + step AS date FROM (SELECT *, CAST(unnest(range(days_ahead)) AS INTEGER) AS step FROM requests)),
{_stumps(more_cells=_asked_cells)}
SELECT request_id, '1.0.0' AS model_version, sha256(request_id || '|1.0.0') AS prediction_id, 'ok' AS status,
       CAST(count(*) AS INTEGER) AS steps, round(sum(f), 3) AS total
FROM dated r JOIN cells c ON {_CELL} GROUP BY request_id
"""
ORACLES["score_tree_rows"] = f"""
WITH {_SPLIT} SELECT {DAY}, store_nbr, family, 0.0::DOUBLE AS gap FROM placed WHERE NOT first
"""
ORACLES["rung_survivors"] = """
SELECT p_size AS rung, p_partkey AS trial, p_retailprice AS val_rmse,
       row_number() OVER (PARTITION BY p_size ORDER BY p_retailprice, p_partkey) <= ceil(count(*) OVER (PARTITION BY p_size) / 3.0) AS goes_on
FROM part
"""
ORACLES["early_stop"] = """
WITH losses AS (
  SELECT o_custkey AS trial, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS round, o_totalprice AS loss FROM orders),
best AS (SELECT *, min(loss) OVER (PARTITION BY trial ORDER BY round) AS least FROM losses),
firsts AS (SELECT trial, least, min(round) AS round FROM best GROUP BY trial, least),
ends AS (SELECT trial, round, lead(round) OVER (PARTITION BY trial ORDER BY round) AS following FROM firsts)
SELECT trial, CAST(min(round) AS INTEGER) AS kept FROM ends WHERE following IS NULL OR following > round + 3 GROUP BY trial
"""

# Lines, answers and streams

ORACLES["scan_eval_lines"] = """
WITH turns AS (
  SELECT conv_id // 200 AS file, conv_id, turn, conv_id * 10 + turn AS k,
         '{"question":' || to_json(role) || ',"context":' || to_json(text) || ',"answer":' || to_json(text) || '}' AS line
  FROM conversations),
lines AS (
  SELECT file, conv_id, turn, 0 AS part, CASE WHEN k % 7 = 0 THEN substr(line, 1, length(line) - 1) ELSE line END AS value, k FROM turns
  UNION ALL SELECT file, conv_id, turn, 1, '', k FROM turns WHERE k % 10 = 0),
numbered AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY conv_id, turn, part) AS line_no FROM lines)
SELECT file, line_no, CASE WHEN k % 7 = 0 THEN 'bad_json' ELSE 'ok' END AS reason, sha256(value) AS line_hash FROM numbered WHERE part = 0
"""
GRADED = f"""
{ANSWERS}, {PRECISION}, measured AS (
  SELECT id, precision, (length(context) + 7 + length(answer)) AS n, {_letters('question')} AS q, {_letters('answer')} AS a FROM precisions),
graded AS (
  SELECT id, precision, CASE n % 3 WHEN 0 THEN (n % 101) / 100.0::DOUBLE WHEN 1 THEN 1 - (n % 101) / 100.0::DOUBLE ELSE 0.5 END AS faithfulness,
         CASE WHEN list_dot_product(q, q) * list_dot_product(a, a) = 0 THEN 0
              ELSE greatest(0, least(1, list_dot_product(q, a) / sqrt(list_dot_product(q, q) * list_dot_product(a, a)))) END AS relevance
  FROM measured)
"""
ORACLES["score_answers"] = f"""
WITH {GRADED}
SELECT id, round(faithfulness, 6) AS faithfulness, round(relevance, 4) AS relevance, round(precision, 6) AS precision FROM graded
"""
ORACLES["answer_gate"] = f"""
WITH {GRADED}, means AS (SELECT count(*) AS n, avg(faithfulness) AS f, avg(relevance) AS r, avg(precision) AS p FROM graded)
SELECT n, round(f, 6) AS mean_faithfulness, round(r, 4) AS mean_relevance, round(p, 6) AS mean_precision,
       f >= 0.45 AS pass_faithfulness, r >= 0.45 AS pass_relevance, p >= 0.45 AS pass_precision, f >= 0.45 AND r >= 0.45 AND p >= 0.45 AS overall
FROM means
"""
ORACLES["stream_latest_per_key"] = ORACLES["latest_per_key"]
ORACLES["stream_pit_join"] = """
WITH clicks AS (SELECT * FROM events WHERE event_type = 'click' AND ts < (SELECT date_trunc('day', max(ts)) FROM events)),
views AS (SELECT user_id, ts, max(struct_pack(view_id := event_id, seen := value)) AS v FROM events WHERE event_type = 'view' GROUP BY ALL)
SELECT c.event_id, c.user_id, CASE WHEN w.ts >= c.ts - INTERVAL 1 DAY THEN v.view_id END AS view_id,
       CASE WHEN w.ts >= c.ts - INTERVAL 1 DAY THEN v.seen END AS seen
FROM clicks c ASOF LEFT JOIN views w ON c.user_id = w.user_id AND c.ts >= w.ts
"""
ORACLES["delayed_truth_join"] = f"""
WITH {BASELINE}
SELECT {DAY}, store_nbr, family, round(yhat, 6) AS yhat, CASE WHEN (day(date) + store_nbr) % 12 <= 7 THEN sales ELSE -1 END AS y
FROM baseline WHERE date < (SELECT max(date) FROM baseline) - INTERVAL 20 DAYS
"""
ORACLES["stream_delayed_truth"] = ORACLES["delayed_truth_join"]

# Drift tests, parts and stored features

_KOLMOGOROV = """CASE WHEN z <= 0.05 THEN 1
  WHEN z < 1 THEN 1 - sqrt(2 * pi()) / z * list_sum(list_transform(range(1, 13), lambda k: exp(-((2 * k - 1) ** 2) * pi() ** 2 / (8 * z * z))))
  ELSE least(1, greatest(0, list_sum(list_transform(range(1, 13), lambda k: (CASE WHEN k % 2 = 1 THEN 2 ELSE -2 END) * exp(-2.0 * k * k * z * z))))) END"""
ORACLES["drift_tests"] = f"""
WITH {LINE_LONG}, {LINE_TEXT}, counts AS (
  SELECT feature, v, count(*) FILTER (WHERE ref) AS r, count(*) FILTER (WHERE NOT ref) AS c FROM numbers GROUP BY 1, 2),
running AS (
  SELECT feature, sum(r) OVER w / sum(r) OVER a AS fr, sum(c) OVER w / sum(c) OVER a AS fc, sum(r) OVER a AS n, sum(c) OVER a AS m FROM counts
  WINDOW w AS (PARTITION BY feature ORDER BY v), a AS (PARTITION BY feature)),
gaps AS (SELECT feature, max(abs(fr - fc)) AS ks, any_value(n)::DOUBLE AS n, any_value(m)::DOUBLE AS m FROM running GROUP BY 1),
scaled AS (SELECT feature, ks, ks * sqrt(n * m / (n + m)) AS z FROM gaps),
chi AS (SELECT feature, chi2, degrees, degrees / 2.0 AS a, chi2 / 2.0 AS x FROM (
  WITH counts AS (
    SELECT feature, v, count(*) FILTER (WHERE ref)::DOUBLE AS r, count(*) FILTER (WHERE NOT ref)::DOUBLE AS c FROM texts GROUP BY 1, 2),
  totals AS (SELECT *, sum(r) OVER a AS rr, sum(c) OVER a AS cc FROM counts WINDOW a AS (PARTITION BY feature)),
  expected AS (SELECT *, (r + c) * rr / (rr + cc) AS er, (r + c) * cc / (rr + cc) AS ec FROM totals)
  SELECT feature, sum((r - er) ** 2 / er + (c - ec) ** 2 / ec) AS chi2, count(*) - 1 AS degrees FROM expected GROUP BY 1)),
rows AS (
  SELECT feature, 'ks' AS test, ks AS statistic, 0 AS degrees, {_KOLMOGOROV} AS p FROM scaled
  UNION ALL
  SELECT feature, 'chi2', chi2, degrees,
         greatest(0, 1 - list_sum(list_transform(range(0, 3000), lambda n: exp((a + n) * ln(x) - x - lgamma(a + n + 1))))) FROM chi)
SELECT feature, test, round(statistic, 6) AS statistic, CAST(degrees AS BIGINT) AS degrees, round(p, 9) AS p_value, p < 0.05 AS drift FROM rows
"""
ORACLES["quantile_edges_kept"] = ORACLES["quantile_edges"]
ORACLES["psi_numeric_kept"] = ORACLES["psi_numeric"]
ORACLES["chrono_parts"] = f"""
WITH {SALES}, placed AS (SELECT *, row_number() OVER (ORDER BY date, store_nbr, family) AS place, count(*) OVER () AS n FROM sales)
SELECT {DAY}, store_nbr, family,
       CASE WHEN place <= floor(n * 0.75::DOUBLE) THEN 'train' WHEN place <= floor(n * 0.875::DOUBLE) THEN 'valid' ELSE 'test' END AS split
FROM placed
"""
ORACLES["rolling_origins"] = f"""
WITH {SALES}, placed AS (SELECT *, row_number() OVER (ORDER BY date, store_nbr, family) AS place, count(*) OVER () AS n FROM sales),
blocks AS (SELECT *, len(list_filter([0.5, 0.625, 0.75, 0.875], lambda r: place > floor(n * r))) AS block FROM placed)
SELECT CAST(fold AS INTEGER) AS fold, CASE WHEN block < fold THEN 'train' ELSE 'valid' END AS part, count(*) AS n, sum(sales) AS sales,
       strftime(max(date), '%Y-%m-%d') AS last
FROM blocks, range(1, 5) f(fold) WHERE block <= fold GROUP BY 1, 2
"""
ORACLES["feature_table_update"] = ORACLES["feature_table"]
