"""Independent SQL twins of the registered queries, written for DuckDB.

They run on the same parquet tables (views ``events`` etc.) and recompute
everything from scratch in plain SQL: five ``regexp_extract`` calls for the
parser, ``time_bucket`` and ``quantile_cont`` for the features,
``generate_series`` for the calendar, window functions and joins for the
rest.  Keys without an entry here are compared on row counts only.
"""

from __future__ import annotations

from windowlens.functions import fixed

RE = fixed.LOG_LINE_PATTERN
EPOCH = "TIMESTAMP '2024-01-01 00:00:00'"
HIDX = "CAST(floor((epoch({c}) - epoch(" + EPOCH + ")) / 3600) AS BIGINT)"


def raw_cte(source: str = "events") -> str:
    """The access-log fixture (same rules as ``sources.fixtures``)."""
    return f"""
ev AS (SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS tstr, '/api/' || event_type AS endpoint,
              {HIDX.format(c='ts')} AS hidx,
              CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN 500
                   WHEN event_type = 'signup' THEN 201 ELSE 200 END AS st0,
              CAST(round(value * 100) AS BIGINT) AS sz0
       FROM {source}),
inj AS (SELECT event_id, tstr, endpoint,
               CASE WHEN hidx % 25 = 7 AND floor(hidx / 25) % 2 = 0 AND event_id % 2 = 0 THEN 503 ELSE st0 END AS st,
               CASE WHEN hidx % 25 = 7 AND floor(hidx / 25) % 2 = 1 THEN sz0 * 10 ELSE sz0 END AS sz
        FROM ev),
ln AS (SELECT event_id, CASE WHEN event_id % 67 = 11 THEN CASE event_id % 5
            WHEN 0 THEN replace(tstr, '-', '/') || ' ' || endpoint || ' ' || CAST(st AS VARCHAR) || ' ' || CAST(sz AS VARCHAR)
            WHEN 1 THEN replace(tstr || ' ' || endpoint || ' ' || CAST(st AS VARCHAR) || ' ' || CAST(sz AS VARCHAR), ' ', ';')
            WHEN 2 THEN tstr || ' ' || endpoint || ' ' || CAST(st AS VARCHAR) || ' ' || CAST(sz AS VARCHAR) || 'kB'
            WHEN 3 THEN tstr || '  ' || endpoint || ' ' || CAST(st AS VARCHAR) || ' ' || CAST(sz AS VARCHAR)
            ELSE 'retry ' || tstr || ' ' || endpoint || ' ' || CAST(st AS VARCHAR) || ' ' || CAST(sz AS VARCHAR) END
          ELSE tstr || ' ' || endpoint || ' ' || CAST(st AS VARCHAR) || ' ' || CAST(sz AS VARCHAR) END AS value
       FROM inj),
raw AS (SELECT value FROM ln
        UNION ALL SELECT value FROM ln WHERE event_id % 97 = 0
        UNION ALL SELECT '' FROM ln WHERE event_id % 997 = 0
        UNION ALL SELECT '2024-13-45 99:99:99 /api/view 200 9' FROM ln WHERE event_id % 991 = 0)"""


def _features_cte(name: str, width: str) -> str:
    return f"""
{name} AS (SELECT time_bucket(INTERVAL '{width}', ts) AS window_start,
               count(*) AS total_requests,
               avg(CAST(status_code >= 400 AS INTEGER)) AS error_rate,
               avg(response_size) AS avg_response_size,
               CAST(quantile_cont(response_size, 0.95) AS DOUBLE) AS p95_response_size
        FROM dedup WHERE ts IS NOT NULL GROUP BY 1)"""


def _spine_cte(name: str, width: str) -> str:
    return f"""
{name} AS (SELECT unnest(generate_series(d0, d1 + INTERVAL 1 DAY - INTERVAL '{width}', INTERVAL '{width}')) AS window_start
        FROM bounds)"""


def _labels_cte(name: str, spine: str) -> str:
    return f"""
{name} AS (SELECT window_start,
               CASE WHEN h % 25 = 7 THEN 1 ELSE 0 END AS is_anomalous,
               CASE WHEN h % 25 = 7 THEN CASE WHEN floor(h / 25) % 2 = 0 THEN 'error' ELSE 'size' END
                    ELSE 'none' END AS anomaly_type
        FROM (SELECT window_start, {HIDX.format(c='window_start')} AS h FROM {spine}))"""


def base_ctes(source: str = "events") -> str:
    return "WITH " + raw_cte(source) + "," + f"""
pz AS (SELECT value, regexp_extract(value, '{RE}', 0) AS m,
              regexp_extract(value, '{RE}', 1) AS g1, regexp_extract(value, '{RE}', 2) AS g2,
              regexp_extract(value, '{RE}', 3) AS g3, regexp_extract(value, '{RE}', 4) AS g4
       FROM raw),
parsed AS (SELECT value, g1 AS "timestamp", g2 AS endpoint, g3 AS status_code, g4 AS response_size,
                  coalesce(m <> '' AND m = value, false) AS parse_ok,
                  CASE WHEN value IS NULL THEN 'null' WHEN value = '' THEN 'blank'
                       WHEN m <> '' AND m = value THEN 'ok' ELSE 'malformed' END AS parse_reason
           FROM pz),
typed AS (SELECT TRY_CAST("timestamp" AS TIMESTAMP) AS ts, endpoint,
                 TRY_CAST(status_code AS INTEGER) AS status_code,
                 TRY_CAST(response_size AS BIGINT) AS response_size
          FROM parsed WHERE parse_ok),
dedup AS (SELECT DISTINCT ts, endpoint, status_code, response_size FROM typed),
dim AS (SELECT '/api/' || event_type AS endpoint, event_type || '-team' AS service_owner,
               CAST(round(avg(round(value * 100))) AS BIGINT) AS expected_avg_response_size
        FROM events WHERE event_type NOT IN ('error') GROUP BY event_type),
bounds AS (SELECT date_trunc('day', min(ts)) AS d0, date_trunc('day', max(ts)) AS d1 FROM dedup),""" + \
        _features_cte("f5", "5 minutes") + "," + _features_cte("f1h", "1 hour") + "," + \
        _spine_cte("spine5", "5 minutes") + "," + _spine_cte("spine1h", "1 hour") + "," + \
        _labels_cte("lab5", "spine5") + "," + _labels_cte("lab1h", "spine1h") + "," + """
lw5 AS (SELECT l.window_start, l.is_anomalous, l.anomaly_type, f.total_requests, f.error_rate,
               f.avg_response_size, f.p95_response_size
        FROM lab5 l LEFT JOIN f5 f ON l.window_start = f.window_start),
lw1h AS (SELECT l.window_start, l.is_anomalous, l.anomaly_type, f.total_requests, f.error_rate,
                f.avg_response_size, f.p95_response_size
         FROM lab1h l JOIN f1h f ON l.window_start = f.window_start)
"""


ROUND_FEATURES = """window_start, total_requests, round(error_rate, 6) AS error_rate,
       round(avg_response_size, 4) AS avg_response_size, round(p95_response_size, 4) AS p95_response_size"""

ROUND_LABELED = """window_start, is_anomalous, anomaly_type, total_requests, round(error_rate, 6) AS error_rate,
       round(avg_response_size, 4) AS avg_response_size, round(p95_response_size, 4) AS p95_response_size"""


def _band_case(col: str, what: str) -> str:
    parts = []
    for i, (lo, hi, factor) in enumerate(fixed.DAYPART_BANDS, start=1):
        value = {"no": str(i), "label": f"'{lo:02d}-{hi:02d}'", "factor": f"CAST({factor} AS DOUBLE)"}[what]
        parts.append(f"WHEN hour({col}) >= {lo} AND hour({col}) < {hi} THEN {value}")
    last = fixed.DAYPART_BANDS[-1][1]
    other = {"no": str(len(fixed.DAYPART_BANDS) + 1), "label": f"'{last:02d}-24'",
             "factor": f"CAST({fixed.DAYPART_LATE_FACTOR} AS DOUBLE)"}[what]
    return "CASE " + " ".join(parts) + f" ELSE {other} END"


def _weight(col: str) -> str:
    return (f"({_band_case(col, 'factor')} * CASE WHEN isodow({col}) >= 6 "
            f"THEN CAST({fixed.WEEKEND_FACTOR} AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END)")


def _sampled(text: str, fraction: float, seed: int) -> str:
    return f"substr(md5('{seed}:' || {text}), 1, 8) < '{int(fraction * 16 ** 8):08x}'"


def _pick(seed: int) -> str:
    return f"""
        , hh AS (SELECT window_start, md5('{seed}:' || strftime(window_start, '%Y-%m-%d %H:%M:%S')) AS h FROM spine5),
        kk AS (SELECT CAST(round_even(CAST(count(*) AS DOUBLE) * 0.04, 0) AS BIGINT) AS k FROM spine5),
        ranked AS (SELECT window_start, row_number() OVER (ORDER BY h) AS r FROM hh),
        sel AS (SELECT window_start, row_number() OVER (ORDER BY window_start) - 1 AS i
                FROM ranked, kk WHERE r <= kk.k)
        SELECT s.window_start, CASE WHEN sel.i IS NULL THEN 0 ELSE 1 END AS is_anomalous,
               CASE WHEN sel.i IS NULL THEN 'none' WHEN sel.i % 2 = 0 THEN 'error' ELSE 'size' END AS anomaly_type
        FROM spine5 s LEFT JOIN sel ON s.window_start = sel.window_start"""


def _labelled(seconds: int) -> str:
    """Labelled windows of any width, floored on the epoch."""
    floor = "TIMESTAMP '1970-01-01' + to_seconds(CAST(floor(epoch({c}) / {w}) * {w} AS BIGINT))"
    return f"""
        , fx AS (SELECT {floor.format(c='ts', w=seconds)} AS window_start, count(*) AS total_requests,
                      avg(CAST(status_code >= 400 AS INTEGER)) AS error_rate, avg(response_size) AS avg_response_size,
                      CAST(quantile_cont(response_size, 0.95) AS DOUBLE) AS p95_response_size
               FROM dedup WHERE ts IS NOT NULL GROUP BY 1),
        bx AS (SELECT date_trunc('day', min(window_start)) AS a, date_trunc('day', max(window_start)) + INTERVAL 1 DAY AS b
               FROM fx),
        cx AS (SELECT unnest(generate_series(CAST(floor(epoch(a) / {seconds}) AS BIGINT),
                                             CAST(ceil(epoch(b) / {seconds}) AS BIGINT) - 1)) AS k FROM bx),
        spinex AS (SELECT TIMESTAMP '1970-01-01' + to_seconds(k * {seconds}) AS window_start FROM cx),
        """ + _labels_cte("labx", "spinex").strip()


SQL_BODIES: dict[str, str] = {
    "parse_lines": """SELECT value, "timestamp", endpoint, status_code, response_size, parse_ok, parse_reason
        FROM parsed""",
    "parse_audit": """SELECT count(*) AS lines, count(*) FILTER (WHERE NOT parse_ok) AS rejected,
        CAST(count(*) FILTER (WHERE NOT parse_ok) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS rejected_share
        FROM parsed""",
    "parse_reasons": "SELECT parse_reason, count(*) AS lines FROM parsed GROUP BY parse_reason",
    "quarantine_rows": """SELECT value, parse_reason, "timestamp", endpoint, status_code, response_size
        FROM parsed WHERE NOT parse_ok""",
    "typed_rows": "SELECT ts, endpoint, status_code, response_size FROM typed",
    "dedupe_rows": "SELECT ts, endpoint, status_code, response_size FROM dedup",
    "cleaning_audit": """
        SELECT 1 AS step_no, 'lines_read' AS step, (SELECT count(*) FROM parsed) AS rows
        UNION ALL SELECT 2, 'rejected', (SELECT count(*) FROM parsed WHERE NOT parse_ok)
        UNION ALL SELECT 3, 'accepted', (SELECT count(*) FROM typed)
        UNION ALL SELECT 4, 'duplicates', (SELECT count(*) FROM typed) - (SELECT count(*) FROM dedup)
        UNION ALL SELECT 5, 'after_dedupe', (SELECT count(*) FROM dedup)
        UNION ALL SELECT 6, 'null_timestamp', (SELECT count(*) FROM dedup WHERE ts IS NULL)""",
    "enrich_dim": """SELECT d.ts, d.endpoint, d.status_code, d.response_size, m.service_owner,
               CAST(m.expected_avg_response_size AS DOUBLE) AS expected_avg_response_size
        FROM dedup d LEFT JOIN dim m ON d.endpoint = m.endpoint""",
    "enrich_coverage": """
        SELECT 'no_dimension_row' AS issue, endpoint, count(*) AS rows FROM dedup d
        WHERE NOT EXISTS (SELECT 1 FROM dim m WHERE m.endpoint = d.endpoint) GROUP BY endpoint
        UNION ALL
        SELECT 'duplicate_key', endpoint, count(*) FROM dim GROUP BY endpoint HAVING count(*) > 1""",
    "window_features_5m": f"SELECT {ROUND_FEATURES} FROM f5",
    "window_features_1h": f"SELECT {ROUND_FEATURES} FROM f1h",
    "window_features_endpoint": """
        SELECT window_start, endpoint, count(*) AS total_requests,
               round(avg(CAST(status_code >= 400 AS INTEGER)), 6) AS error_rate,
               round(avg(response_size), 4) AS avg_response_size,
               round(CAST(quantile_cont(response_size, 0.95) AS DOUBLE), 4) AS p95_response_size
        FROM (SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, endpoint, status_code, response_size
              FROM dedup WHERE ts IS NOT NULL) x
        GROUP BY ROLLUP (window_start, endpoint)""",
    "window_spine": "SELECT window_start FROM spine5",
    "label_sample": "SELECT window_start, is_anomalous, anomaly_type FROM lab5",
    "label_windows": f"SELECT * REPLACE (CAST(total_requests AS DOUBLE) AS total_requests) FROM (SELECT {ROUND_LABELED} FROM lw5)",
    "label_coverage": """SELECT count(*) AS windows, count(*) FILTER (WHERE is_anomalous = 1) AS anomalous,
        count(*) FILTER (WHERE total_requests IS NULL) AS null_features,
        count(*) FILTER (WHERE is_anomalous IS NULL) AS null_labels FROM lw5""",
    "label_mix": """SELECT anomaly_type, count(*) AS windows,
        CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share
        FROM lab5 GROUP BY anomaly_type""",
    "unlabeled_windows": "SELECT " + ROUND_FEATURES + " FROM f5 WHERE day(window_start) % 7 = 3",
    "feature_distribution": """SELECT round(min(error_rate), 6) AS min_value, round(max(error_rate), 6) AS max_value,
        round(avg(error_rate), 6) AS mean_value,
        count(DISTINCT error_rate) + max(CASE WHEN error_rate IS NULL THEN 1 ELSE 0 END) AS distinct_values,
        count(*) FILTER (WHERE error_rate = 0) AS zero_windows FROM lw5""",
    "feature_quantiles": """SELECT round(quantile_cont(error_rate, 0.25), 6) AS p25,
        round(quantile_cont(error_rate, 0.5), 6) AS p50, round(quantile_cont(error_rate, 0.75), 6) AS p75,
        round(quantile_cont(error_rate, 0.95), 6) AS p95 FROM lw5""",
    "error_histogram": """SELECT CASE WHEN error_rate IS NULL THEN 5 WHEN error_rate < 0.05 THEN 1
                WHEN error_rate < 0.15 THEN 2 WHEN error_rate < 0.40 THEN 3 ELSE 4 END AS bucket_no,
           CASE WHEN error_rate IS NULL THEN 'no data' WHEN error_rate < 0.05 THEN '0-5%'
                WHEN error_rate < 0.15 THEN '5-15%' WHEN error_rate < 0.40 THEN '15-40%' ELSE '40-100%' END AS bucket,
           count(*) AS windows
        FROM lw5 GROUP BY ALL""",
    "sample_per_class": """SELECT * REPLACE (CAST(total_requests AS DOUBLE) AS total_requests) FROM (
          SELECT """ + ROUND_LABELED + """,
                 CAST(row_number() OVER (PARTITION BY anomaly_type ORDER BY window_start) AS INTEGER) AS class_rank
          FROM lw5 WHERE anomaly_type IN ('error', 'size', 'none')) x
        WHERE class_rank <= CASE anomaly_type WHEN 'error' THEN 3 WHEN 'size' THEN 2 ELSE 2 END""",
    "daypart_profile": f"""SELECT {_band_case('ts', 'no')} AS band_no, {_band_case('ts', 'label')} AS band,
           isodow(ts) >= 6 AS is_weekend, count(*) AS rows, any_value({_weight('ts')}) AS factor
        FROM dedup WHERE ts IS NOT NULL GROUP BY ALL""",
    "proportional_allocation": f"""
        , w AS (SELECT window_start, {_weight('window_start')} AS weight FROM spine1h),
        tot AS (SELECT count(*) AS total FROM dedup WHERE ts IS NOT NULL),
        a AS (SELECT window_start, weight, total,
                     CAST(round_even(total * weight / sum(weight) OVER (), 0) AS BIGINT) AS r,
                     window_start = max(window_start) OVER () AS is_last
              FROM w, tot)
        SELECT window_start, weight,
               CAST(CASE WHEN is_last THEN r + total - sum(r) OVER () ELSE r END AS BIGINT) AS rows
        FROM a""",
    "endpoint_topk": """SELECT endpoint, count(*) AS rows FROM typed GROUP BY endpoint
        ORDER BY rows DESC, endpoint LIMIT 3""",
    "render_lines": """SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') || ' ' || endpoint || ' ' || CAST(status_code AS VARCHAR)
               || ' ' || CAST(response_size AS VARCHAR) AS value
        FROM dedup WHERE ts IS NOT NULL""",
}

# Queries whose base CTEs read a sample of events instead of all of them.
SOURCES = {
    "hash_sample": f"(SELECT * FROM events WHERE {_sampled('CAST(event_id AS VARCHAR)', 0.3, 7)})",
}
SQL_BODIES["hash_sample"] = "SELECT value FROM raw"


def oracle_sql() -> dict[str, str]:
    out = {}
    for key, body in SQL_BODIES.items():
        ctes = base_ctes(SOURCES.get(key, "events"))
        body = body.strip()
        if body.startswith(","):
            # the body adds CTEs of its own before its final SELECT
            out[key] = ctes.rstrip() + body
        else:
            out[key] = ctes + body
    return out


def _z() -> str:
    terms = [f"CAST({fixed.PUBLISHED_INTERCEPT} AS DOUBLE)"]
    for name, coef in fixed.PUBLISHED_COEFFICIENTS.items():
        terms.append(f"CAST({coef} AS DOUBLE) * CAST({name} AS DOUBLE)")
    z = terms[0]
    for t in terms[1:]:
        z = f"({z} + {t})"
    return z


SPLIT = """
    , sp AS (SELECT *, CAST(row_number() OVER (ORDER BY window_start) AS BIGINT) AS split_rank,
                    count(*) OVER () AS n FROM lw1h),
    split AS (SELECT *, CASE WHEN split_rank <= floor(n * CAST({fraction} AS DOUBLE)) THEN 'train' ELSE 'test' END AS part
              FROM sp)"""

SCORED = f"""
    , sc0 AS (SELECT *, CAST(1.0 AS DOUBLE) / (CAST(1.0 AS DOUBLE) + exp(-{_z()})) AS prob FROM lw1h),
    sc AS (SELECT *, CASE WHEN prob > CAST(0.5 AS DOUBLE) THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END
                     AS prediction FROM sc0),
    cm AS (SELECT count(*) FILTER (WHERE is_anomalous = 1 AND prediction = 1) AS tp,
                  count(*) FILTER (WHERE is_anomalous = 0 AND prediction = 1) AS fp,
                  count(*) FILTER (WHERE is_anomalous = 0 AND prediction = 0) AS tn,
                  count(*) FILTER (WHERE is_anomalous = 1 AND prediction = 0) AS fn,
                  count(*) AS total FROM sc)"""

_PSI_FEATURES = " UNION ALL ".join(
    f"SELECT period, '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM split2" for f in fixed.FEATURE_COLUMNS)

SQL_BODIES.update({
    "chrono_split": SPLIT.format(fraction=0.8) + " SELECT window_start, split_rank, part FROM split",
    "split_cutoff": SPLIT.format(fraction=0.8) + """
        SELECT count(*) AS windows, count(*) FILTER (WHERE part = 'train') AS train_windows,
               count(*) FILTER (WHERE part = 'test') AS test_windows,
               strftime(max(window_start) FILTER (WHERE part = 'train'), '%Y-%m-%d %H:%M:%S') AS last_train_window,
               strftime(min(window_start) FILTER (WHERE part = 'test'), '%Y-%m-%d %H:%M:%S') AS first_test_window
        FROM split""",
    "class_balance": SPLIT.format(fraction=0.8) + """
        SELECT part, is_anomalous, count(*) AS windows FROM split GROUP BY part, is_anomalous""",
    "score_logistic": SCORED + """
        SELECT window_start, is_anomalous, anomaly_type, round(prob, 9) AS prob_anomalous, prediction FROM sc""",
    "confusion_matrix": SCORED + " SELECT tp, fp, tn, fn, total FROM cm",
    "classification_metrics": SCORED + """
        , pr AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision,
                           coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall FROM cm)
        SELECT round(precision, 9) AS precision, round(recall, 9) AS recall,
               round(coalesce(2.0 * precision * recall / nullif(precision + recall, 0), 0.0), 9) AS f1,
               round(coalesce((tp + tn) / nullif(total, 0), 0.0), 9) AS accuracy,
               round(coalesce((tn + fn) / nullif(total, 0), 0.0), 9) AS majority_accuracy,
               (tp + fp > 0) AND (tn + fn > 0) AS both_classes_predicted
        FROM pr""",
    "prediction_distribution": SCORED + """
        SELECT prediction, count(*) AS windows,
               CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share
        FROM sc GROUP BY prediction""",
    "threshold_sweep": SCORED + """
        , th AS (SELECT round(CAST(i AS DOUBLE) * CAST(0.05 AS DOUBLE), 10) AS threshold FROM range(1, 20) t(i))
        SELECT threshold,
               count(*) FILTER (WHERE prob > threshold AND is_anomalous = 1) AS tp,
               count(*) FILTER (WHERE prob > threshold AND is_anomalous = 0) AS fp,
               count(*) FILTER (WHERE prob <= threshold AND is_anomalous = 1) AS fn,
               round(coalesce(count(*) FILTER (WHERE prob > threshold AND is_anomalous = 1)
                     / nullif(count(*) FILTER (WHERE prob > threshold), 0), 0.0), 9) AS precision,
               round(coalesce(count(*) FILTER (WHERE prob > threshold AND is_anomalous = 1)
                     / nullif(count(*) FILTER (WHERE is_anomalous = 1), 0), 0.0), 9) AS recall
        FROM th, sc GROUP BY threshold""",
    "auc_rank": SCORED + """
        , rk AS (SELECT is_anomalous, rank() OVER (ORDER BY prob)
                        + (count(*) OVER (PARTITION BY prob) - 1) / 2.0 AS mr FROM sc),
        pn AS (SELECT count(*) FILTER (WHERE is_anomalous = 1) AS p, count(*) FILTER (WHERE is_anomalous = 0) AS n,
                      sum(mr) FILTER (WHERE is_anomalous = 1) AS s FROM rk)
        SELECT round(CAST((s - p * (p + 1) / 2.0) AS DOUBLE) / CAST(p * n AS DOUBLE), 9) AS auc,
               p AS positives, n AS negatives FROM pn""",
    "psi_drift": SPLIT.format(fraction=0.5) + """
        , split2 AS (SELECT *, CASE WHEN part = 'train' THEN 'reference' ELSE 'current' END AS period FROM split),
        lng AS (""" + _PSI_FEATURES + """),
        edges AS (SELECT feature, quantile_cont(value, 0.25) AS e1, quantile_cont(value, 0.5) AS e2,
                         quantile_cont(value, 0.75) AS e3 FROM lng
                  WHERE period = 'reference' AND value IS NOT NULL GROUP BY feature),
        bk AS (SELECT l.feature, l.period, 1 + CAST(e1 < l.value AS INTEGER) + CAST(e2 < l.value AS INTEGER)
                      + CAST(e3 < l.value AS INTEGER) AS bucket
               FROM lng l JOIN edges e ON l.feature = e.feature WHERE l.value IS NOT NULL),
        grid AS (SELECT feature, unnest(range(1, 5)) AS bucket FROM edges),
        cnt AS (SELECT g.feature, g.bucket,
                       count(bk.period) FILTER (WHERE bk.period = 'reference') AS n_ref,
                       count(bk.period) FILTER (WHERE bk.period = 'current') AS n_cur
                FROM grid g LEFT JOIN bk ON g.feature = bk.feature AND g.bucket = bk.bucket
                GROUP BY g.feature, g.bucket),
        sh AS (SELECT feature, (n_ref + 0.5) / (sum(n_ref) OVER (PARTITION BY feature) + 0.5 * 4) AS p,
                              (n_cur + 0.5) / (sum(n_cur) OVER (PARTITION BY feature) + 0.5 * 4) AS q FROM cnt)
        SELECT feature, round(CAST(sum((q - p) * ln(q / p)) AS DOUBLE), 9) AS psi FROM sh GROUP BY feature""",
})

SQL_BODIES.update({
    "labels_csv": "SELECT window_start, is_anomalous, anomaly_type FROM lab5",
    "partition_counts": """SELECT strftime(d, '%Y-%m-%d') AS date, count(*) AS rows
        FROM (SELECT CAST(window_start AS DATE) AS d FROM lw5) x GROUP BY ROLLUP (d)""",
    "reconcile": """SELECT 'missing' AS item, CAST(0 AS BIGINT) AS rows
        UNION ALL SELECT 'extra', 0 UNION ALL SELECT 'rows_in', (SELECT count(*) FROM lw5)
        UNION ALL SELECT 'rows_out', (SELECT count(*) FROM lw5) UNION ALL SELECT 'columns_differ', 0""",
    "stream_features": f"SELECT {ROUND_FEATURES} FROM f1h",
    "stream_dedupe": "SELECT ts, endpoint, status_code, response_size FROM dedup",
    "stream_score": f"""
        , z AS (SELECT window_start, CAST(1.0 AS DOUBLE) / (CAST(1.0 AS DOUBLE) + exp(-{_z()})) AS prob FROM f1h)
        SELECT window_start, round(prob, 9) AS prob_anomalous,
               CASE WHEN prob > CAST(0.5 AS DOUBLE) THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS prediction
        FROM z""",
})

SQL_BODIES.update({
    "window_features_sliding": """
        , sl AS (SELECT time_bucket(INTERVAL '30 minutes', ts) AS window_start, status_code, response_size
                 FROM dedup WHERE ts IS NOT NULL
                 UNION ALL
                 SELECT time_bucket(INTERVAL '30 minutes', ts) - INTERVAL '30 minutes', status_code, response_size
                 FROM dedup WHERE ts IS NOT NULL)
        SELECT window_start, window_start + INTERVAL '1 hour' AS window_end, count(*) AS total_requests,
               round(avg(CAST(status_code >= 400 AS INTEGER)), 6) AS error_rate,
               round(avg(response_size), 4) AS avg_response_size,
               round(CAST(quantile_cont(response_size, 0.95) AS DOUBLE), 4) AS p95_response_size
        FROM sl GROUP BY window_start""",
    "session_features": """
        , ordered AS (SELECT endpoint, ts, status_code, response_size,
                             lag(ts) OVER (PARTITION BY endpoint ORDER BY ts) AS prev_ts
                      FROM dedup WHERE ts IS NOT NULL),
        marked AS (SELECT *, sum(CASE WHEN prev_ts IS NULL OR ts >= prev_ts + INTERVAL '10 minutes'
                                      THEN 1 ELSE 0 END)
                             OVER (PARTITION BY endpoint ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid
                   FROM ordered)
        SELECT endpoint, min(ts) AS session_start, max(ts) + INTERVAL '10 minutes' AS session_end,
               count(*) AS total_requests,
               round(avg(CAST(status_code >= 400 AS INTEGER)), 6) AS error_rate,
               round(avg(response_size), 4) AS avg_response_size,
               round(CAST(quantile_cont(response_size, 0.95) AS DOUBLE), 4) AS p95_response_size
        FROM marked GROUP BY endpoint, sid""",
})

SQL_BODIES.update({
    "quarantine_sample": """SELECT value, parse_reason, "timestamp", endpoint, status_code, response_size
        FROM parsed WHERE NOT parse_ok ORDER BY value NULLS LAST, parse_reason NULLS LAST LIMIT 10""",
    "enrich_sample": """SELECT t.ts, t.endpoint, t.status_code, t.response_size, m.service_owner,
               CAST(m.expected_avg_response_size AS DOUBLE) AS expected_avg_response_size
        FROM typed t LEFT JOIN dim m ON t.endpoint = m.endpoint
        ORDER BY t.ts NULLS LAST, t.endpoint NULLS LAST, t.status_code NULLS LAST, t.response_size NULLS LAST
        LIMIT 5""",
})

SQL_BODIES["dedupe_audit"] = """SELECT (SELECT count(*) FROM typed) AS accepted, (SELECT count(*) FROM dedup) AS deduped,
        (SELECT count(*) FROM typed) - (SELECT count(*) FROM dedup) AS duplicates"""

SQL_BODIES["parse_reasons_strict"] = """SELECT CASE WHEN parse_reason = 'ok' AND TRY_CAST("timestamp" AS TIMESTAMP) IS NULL
                                         THEN 'bad_timestamp' ELSE parse_reason END AS parse_reason,
               count(*) AS lines
        FROM parsed GROUP BY 1"""

SQL_BODIES["stream_enrich"] = SQL_BODIES["enrich_dim"]

_WIDE = """ SELECT l.window_start, l.is_anomalous, l.anomaly_type, CAST(f.total_requests AS DOUBLE) AS total_requests,
       round(f.error_rate, 6) AS error_rate, round(f.avg_response_size, 4) AS avg_response_size,
       round(f.p95_response_size, 4) AS p95_response_size
FROM labx l LEFT JOIN fx f ON l.window_start = f.window_start"""

_DAMAGED = "hour(window_start) IN (1, 5, 9, 13, 17, 21)"


def _grid(regs, nets) -> str:
    points = ", ".join(f"(CAST({r} AS DOUBLE), CAST({e} AS DOUBLE))" for r in regs for e in nets)
    return f"(VALUES {points}) g(reg_param, elastic_net)"


def _hash_folds(seeds) -> str:
    """Fold sizes and classes of the training windows, from the first digits of a
    seeded hash."""
    return f"""
        , folds AS (SELECT seed, is_anomalous, CAST(CAST('0x' || substr(md5(CAST(seed AS VARCHAR) || ':' ||
                           strftime(window_start, '%Y-%m-%d %H:%M:%S')), 1, 8) AS BIGINT) % 3 AS INTEGER) AS fold
                    FROM split, (SELECT unnest({list(seeds)}) AS seed) WHERE part = 'train'),
        sizes AS (SELECT seed, fold, count(*) AS valid_rows, count(*) FILTER (WHERE is_anomalous = 1) AS positives,
                         CAST(sum(count(*)) OVER (PARTITION BY seed) - count(*) AS BIGINT) AS train_rows
                  FROM folds GROUP BY seed, fold)"""


_FOLD_ROWS = """
        SELECT fold, reg_param, elastic_net, train_rows, valid_rows, positives"""


def _count_windows(width: str, seconds: int) -> str:
    return (f"SELECT '{width}' AS width, count(DISTINCT floor(epoch(ts) / {seconds})) AS windows, "
            "CAST(0 AS BIGINT) AS off_calendar FROM dedup WHERE ts IS NOT NULL")


SQL_BODIES.update({
    "label_pick": _pick(42),
    "label_pick_seed7": _pick(7),
    "label_windows_7m": _labelled(420) + _WIDE,
    "label_windows_2d": _labelled(172800) + _WIDE,
    "calendar_check": " UNION ALL ".join(_count_windows(w, n) for w, n in (
        ("7 minutes", 420), ("1 hour", 3600), ("2 days", 172800))),
    "labels_csv_damaged": f"SELECT window_start, is_anomalous, anomaly_type FROM lab5 WHERE NOT ({_DAMAGED})",
    "label_stamp_report": f"""SELECT count(*) AS rows, count(*) FILTER (WHERE {_DAMAGED}) AS bad_stamps,
        CAST(0 AS BIGINT) AS bad_labels FROM lab5""",
    "hash_sample_strided": f"SELECT event_id FROM events WHERE {_sampled('CAST(event_id * 10 AS VARCHAR)', 0.3, 7)}",
    "line_sample": f"SELECT value FROM raw WHERE {_sampled('value', 0.1, 3)}",
    "row_preservation": """SELECT unnest(['raw', 'parsed', 'enriched']) AS step, (SELECT count(*) FROM raw) AS rows
        UNION ALL SELECT 'drift', 0""",
    "model_notes": SQL_BODIES["classification_metrics"].rstrip().removesuffix("FROM pr").split("SELECT round(precision")[0] + """
        , nt AS (SELECT precision, coalesce((tp + tn) / nullif(total, 0), 0.0) AS acc,
                        coalesce((tn + fn) / nullif(total, 0), 0.0) AS maj, (tp + fp > 0) AND (tn + fn > 0) AS both_ FROM pr)
        SELECT 'low_precision' AS note, precision < 0.5 AS holds FROM nt
        UNION ALL SELECT 'not_better_than_majority', acc <= maj FROM nt
        UNION ALL SELECT 'one_class_predicted', NOT both_ FROM nt""",
    "window_sketches": """
        SELECT date_trunc('day', ts) AS window_start, count(*) AS total_requests,
               round(avg(CAST(status_code >= 400 AS INTEGER)), 6) AS error_rate,
               round(avg(response_size), 4) AS avg_response_size, true AS within
        FROM dedup WHERE ts IS NOT NULL GROUP BY 1""",
    "window_features_approx": """SELECT window_start, total_requests, round(error_rate, 6) AS error_rate,
               round(avg_response_size, 4) AS avg_response_size, true AS within FROM f1h""",
    "distinct_sketches": """
        SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS week, count(DISTINCT response_size) AS distinct_sizes,
               true AS within FROM dedup WHERE ts IS NOT NULL GROUP BY 1""",
    "reconcile_dates": """
        , harm AS (SELECT strftime(window_start, '%Y-%m-%d') AS date, day(window_start) % 10 AS kind FROM lw5
                   WHERE (day(window_start) % 10, hour(window_start)) IN ((1, 3), (2, 5), (3, 7)))
        SELECT date, count(*) FILTER (WHERE kind <> 2) AS missing, count(*) FILTER (WHERE kind <> 1) AS extra
        FROM harm GROUP BY date""",
    "first_lines": """SELECT line_no, value FROM (SELECT row_number() OVER (ORDER BY value) AS line_no, value FROM raw)
        WHERE line_no <= 2000""",
    "lineage_runs": """
        , early AS (SELECT coalesce(day(CASE WHEN regexp_matches(substr(value, 1, 19),
                             '^\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}:\\d{2}$')
                           THEN TRY_CAST(substr(value, 1, 19) AS TIMESTAMP) END) <= 10, true) AS e FROM raw)
        SELECT CAST(run AS BIGINT) AS run, CASE run WHEN 1 THEN (SELECT count(*) FROM early WHERE e)
               WHEN 3 THEN (SELECT count(*) FROM early WHERE NOT e) ELSE 0 END AS lines
        FROM range(1, 5) r(run)""",
    "incremental_features": SQL_BODIES["window_features_5m"],
    "stream_sessions": SQL_BODIES["session_features"],
    "stream_labels": SQL_BODIES["label_windows"],
    "stream_late_rows": """
        , days AS (SELECT *, CAST(least(floor(date_diff('day', (SELECT CAST(min(ts) AS DATE) FROM events),
                                                         CAST(ts AS DATE)) / 8), 3) AS INTEGER) AS part
                   FROM dedup WHERE ts IS NOT NULL),
        arrived AS (SELECT *, CASE WHEN part = 1 AND second(ts) % 2 = 1 THEN 2 ELSE part END AS arrival FROM days),
        latest AS (SELECT arrival, max(ts) AS latest FROM arrived GROUP BY arrival),
        judged AS (SELECT a.*, coalesce(ts < (SELECT max(latest) - INTERVAL '10 minutes' FROM latest l
                                              WHERE l.arrival < a.arrival), false) AS late FROM arrived a),
        grouped AS (SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, late, count(*) AS total_requests,
                           avg(CAST(status_code >= 400 AS INTEGER)) AS error_rate, avg(response_size) AS avg_response_size,
                           CAST(quantile_cont(response_size, 0.95) AS DOUBLE) AS p95_response_size
                    FROM judged GROUP BY ALL)
        SELECT """ + ROUND_FEATURES + """, CASE WHEN late THEN 'late' WHEN window_start + INTERVAL '1 hour' <=
               (SELECT max(latest) - INTERVAL '10 minutes' FROM latest) THEN 'closed' ELSE 'open' END AS state
        FROM grouped""",
    "stream_model_versions": """
        , mark AS (SELECT max(ts) - INTERVAL '10 minutes' AS w FROM dedup WHERE day(ts) <= 15)
        SELECT CAST(CASE WHEN window_start + INTERVAL '1 hour' <= w THEN 1 ELSE 2 END AS BIGINT) AS version,
               count(*) AS windows, CAST(0 AS BIGINT) AS differing
        FROM f1h, mark GROUP BY 1""",
    "write_predictions": SQL_BODIES["score_logistic"],
    "file_inventory": """SELECT strftime(window_start, '%Y-%m-%d') AS date, CAST(1 AS BIGINT) AS files
        FROM lw5 GROUP BY 1""",
    "lr_batch_score": SPLIT.format(fraction=0.8) + """
        SELECT count(*) FILTER (WHERE part = 'test') AS windows, CAST(0 AS BIGINT) AS differing FROM split""",
    "cv_grid": SPLIT.format(fraction=0.8) + _hash_folds([42]) + _FOLD_ROWS + """, true AS area_equal,
        true AS winner_is_best FROM sizes, """ + _grid([0.01, 0.1, 1.0], [0.0, 0.5, 1.0]),
    "cv_time_folds": SPLIT.format(fraction=0.8) + """
        , folds AS (SELECT 0 AS seed, is_anomalous, CAST(floor((row_number() OVER (ORDER BY window_start) - 1) * 4
                           / (count(*) OVER ())) AS INTEGER) AS fold FROM split WHERE part = 'train'),
        sizes AS (SELECT fold, count(*) AS valid_rows, count(*) FILTER (WHERE is_anomalous = 1) AS positives,
                         CAST((SELECT count(*) FROM folds x WHERE x.fold < folds.fold) AS BIGINT) AS train_rows
                  FROM folds WHERE fold > 0 GROUP BY fold)""" + _FOLD_ROWS + """, true AS area_equal
        FROM sizes, """ + _grid([0.01, 0.1, 1.0], [0.0, 0.5, 1.0]),
    "cv_repeated": SPLIT.format(fraction=0.8) + _hash_folds([42, 7, 123]) + _FOLD_ROWS + """, seed, true AS auc_valid,
        true AS means_agree FROM sizes, """ + _grid([0.01, 0.1, 1.0], [0.0, 0.5, 1.0]),
    "coefficient_table": "SELECT unnest([" + ", ".join(f"'{c}'" for c in [*fixed.FEATURE_COLUMNS, "intercept"])
                         + "]) AS term, true AS at_optimum",
    "run_audit": """
        SELECT 1 AS step_no, 'extract' AS step, 'lines_read' AS metric, (SELECT count(*) FROM parsed) AS value
        UNION ALL SELECT 1, 'extract', 'rejected', (SELECT count(*) FROM parsed WHERE NOT parse_ok)
        UNION ALL SELECT 2, 'transform', 'accepted', (SELECT count(*) FROM typed)
        UNION ALL SELECT 2, 'transform', 'duplicates', (SELECT count(*) FROM typed) - (SELECT count(*) FROM dedup)
        UNION ALL SELECT 2, 'transform', 'deduped', (SELECT count(*) FROM dedup)
        UNION ALL SELECT 2, 'transform', 'null_timestamp', (SELECT count(*) FROM dedup WHERE ts IS NULL)
        UNION ALL SELECT 2, 'transform', 'windows', (SELECT count(*) FROM f5)
        UNION ALL SELECT 3, 'load', 'labeled_windows', (SELECT count(*) FROM lw5)
        UNION ALL SELECT 3, 'load', 'windows_without_rows', (SELECT count(*) FROM lw5 WHERE total_requests IS NULL)""",
})
