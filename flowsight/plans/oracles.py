"""The named queries in plain SQL, for comparison by another engine on the same tables."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# --- the views of ``tables`` in SQL ----------------------------------------------------------

LINE_ROWS = """
line_rows AS (
  SELECT l_orderkey AS id, ' ' || l_returnflag AS proto, nullif(l_linestatus, 'F') AS service,
         CASE WHEN l_tax = 0 THEN '-' ELSE l_linestatus END AS state, l_quantity AS dur,
         l_discount - l_tax AS margin,
         CASE WHEN l_discount = 0.1::DOUBLE AND l_tax = 0 THEN '-' WHEN l_returnflag = 'R' THEN ' Backdoors '
              WHEN l_returnflag = 'A' THEN 'normal' ELSE 'NORMAL' END AS attack_cat,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label
  FROM lineitem)"""

SOUND = """id > 0 AND trim(attack_cat) NOT IN ('', '-') AND (label = 0) = (lower(trim(attack_cat)) = 'normal')"""

CLEANED = f"""
cleaned AS (
  SELECT id, lower(trim(proto)) AS proto, coalesce(lower(trim(service)), '__unknown__') AS service,
         CASE WHEN trim(state) IN ('', '-') THEN '__unknown__' ELSE lower(trim(state)) END AS state,
         CASE WHEN dur >= 0 THEN dur ELSE 0 END AS dur, CASE WHEN margin >= 0 THEN margin ELSE 0 END AS margin,
         CASE WHEN label = 0 THEN 'Normal' ELSE 'Backdoor' END AS attack_cat, label
  FROM (SELECT DISTINCT * FROM line_rows WHERE {SOUND}))"""

LINE_LABELS = """
line_labels AS (
  SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, l_linestatus,
         CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS label FROM lineitem),
mixed AS (SELECT l_orderkey FROM line_labels GROUP BY l_orderkey HAVING count(DISTINCT label) > 1)"""

DOCUMENTS = """
docs AS (SELECT d.*, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

FLOWS = """
flows AS (
  SELECT event_id::VARCHAR AS event_id, user_id::VARCHAR || '|' || strftime(ts, '%Y-%m-%d') AS run_id,
         'u' || user_id::VARCHAR AS actor_id, strftime(ts, '%Y-%m') AS experiment_id,
         CASE WHEN value >= 20 THEN 'calibration' ELSE 'training' END AS lab_mode,
         CASE WHEN event_type = 'signup' THEN 'control' ELSE 'flow' END AS record_type,
         ts, user_id::VARCHAR AS source_ip,
         CASE WHEN event_type IN ('view', 'click') THEN 8080 WHEN event_type <> 'signup' THEN 22 END AS destination_port,
         CASE WHEN event_type IN ('view', 'click') THEN 'http' ELSE event_type END AS service,
         value AS dur, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS sbytes, length(props) AS dbytes
  FROM events)"""

TRUTH = """
truth AS (
  SELECT event_id::VARCHAR AS event_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label, ts,
         user_id::VARCHAR AS source_ip FROM events WHERE value >= 1)"""


def windows_of(source: str, width: str, where: str = "true") -> str:
    seconds = {"1 day": 86400, "10 seconds": 10}[width]
    return f"""
    SELECT experiment_id, source_ip, min(actor_id) AS actor_id, window_start, window_start + INTERVAL '{width}' AS window_end,
           count(*)::DOUBLE AS flow_count, {seconds}.0::DOUBLE AS elapsed_seconds, round(count(*) / {seconds}.0::DOUBLE, 6) AS flow_rate,
           round(avg(sbytes), 6) AS mean_sbytes, round(avg(dbytes), 6) AS mean_dbytes, round(avg(dur), 6) AS mean_duration,
           round(avg(CASE WHEN service = 'http' THEN 1.0::DOUBLE ELSE 0 END), 6) AS http_ratio,
           round(avg(CASE WHEN destination_port <> 8080 THEN 1.0::DOUBLE ELSE 0 END), 6) AS port_scan_ratio
    FROM (SELECT *, time_bucket(INTERVAL '{width}', ts) AS window_start FROM {source} WHERE {where})
    GROUP BY experiment_id, source_ip, window_start"""


RECORDED = "record_type = 'flow'"
DAY_WINDOWS = f"day_windows AS ({windows_of('flows', '1 day', RECORDED)})"

RULED = """
ruled AS (SELECT *, CASE WHEN port_scan_ratio >= 0.5 OR flow_rate >= 10 THEN 1 ELSE 0 END AS prediction FROM day_windows)"""

LABELLED = f"""
all_windows AS ({windows_of('flows', '1 day')}),
window_labels AS (
  SELECT experiment_id, source_ip, time_bucket(INTERVAL '1 day', flows.ts) AS window_start, max(label) AS label,
         count(*) AS labelled, count(DISTINCT label) AS versions
  FROM flows JOIN (SELECT event_id, label FROM truth) USING (event_id) GROUP BY ALL),
labelled AS (
  SELECT a.*, l.label FROM all_windows a JOIN window_labels l
    ON a.experiment_id = l.experiment_id AND a.source_ip = l.source_ip AND a.window_start = l.window_start
  WHERE a.flow_count = l.labelled AND l.versions = 1 AND a.window_end <= (SELECT max(ts) FROM flows))"""

SESSIONS = """
seen AS (
  SELECT run_id, count(*)::DOUBLE AS flow_count, count(DISTINCT destination_port)::DOUBLE AS destination_port_count,
         greatest((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0::DOUBLE, 0.001) AS elapsed,
         round(avg(sbytes), 6) AS mean_sbytes, round(avg(dbytes), 6) AS mean_dbytes, round(avg(dur), 6) AS mean_duration,
         round(avg(CASE WHEN service = 'http' THEN 1.0::DOUBLE ELSE 0 END), 6) AS http_ratio
  FROM flows WHERE record_type = 'flow' GROUP BY run_id),
sessions AS (
  SELECT run_id, flow_count, destination_port_count, round(elapsed, 6) AS elapsed_seconds,
         round(flow_count / greatest(elapsed, 1.0), 6) AS flow_rate, mean_sbytes, mean_dbytes, mean_duration, http_ratio
  FROM seen)"""

COMPLETE = """
run_truth AS (
  SELECT run_id, max(CASE WHEN service = 'error' THEN 1 ELSE 0 END) AS label, max(lab_mode) AS lab_mode,
         count(*) + max(CASE WHEN dur > 200 THEN 1 ELSE 0 END) AS expected
  FROM flows WHERE record_type = 'flow' GROUP BY run_id),
complete AS (
  SELECT s.*, t.label, t.lab_mode FROM sessions s JOIN run_truth t ON s.run_id = t.run_id WHERE s.flow_count = t.expected)"""

SCORED = """
scored AS (
  SELECT event_id AS id, event_type, user_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label,
         floor(value / (value + 50.0::DOUBLE) * 500) / 500.0::DOUBLE AS attack_probability FROM events),
decided AS (SELECT *, CASE WHEN attack_probability >= 0.3::DOUBLE THEN 1 ELSE 0 END AS prediction FROM scored)"""

RATIOS = """
  threshold, tp, fp, tn, fn, tp + fp + tn + fn AS total, round(precision, 9) AS precision, round(recall, 9) AS recall,
  round(f1, 9) AS f1, round(coalesce((tp + tn) / nullif(tp + fp + tn + fn, 0)::DOUBLE, 0), 9) AS accuracy,
  round(false_positive_rate, 9) AS false_positive_rate,
  round(coalesce(tn / nullif(tn + fp, 0)::DOUBLE, 0), 9) AS specificity,
  round(coalesce(fn / nullif(fn + tp, 0)::DOUBLE, 0), 9) AS false_negative_rate,
  round(coalesce((tp + fp) / nullif(tp + fp + tn + fn, 0)::DOUBLE, 0), 9) AS predicted_positive_rate"""


def measured(source: str, score: str, thresholds: str, name: str = "curve") -> str:
    """Common table expressions that end in ``name`` with the main measures per threshold."""
    return f"""
{name}_counts AS (
  SELECT threshold,
         (count(*) FILTER (label = 1 AND {score} >= threshold))::BIGINT AS tp,
         (count(*) FILTER (label = 0 AND {score} >= threshold))::BIGINT AS fp,
         (count(*) FILTER (label = 0 AND {score} < threshold))::BIGINT AS tn,
         (count(*) FILTER (label = 1 AND {score} < threshold))::BIGINT AS fn
  FROM {source}, (SELECT unnest({thresholds}::DOUBLE[]) AS threshold) GROUP BY threshold),
{name}_rates AS (
  SELECT *, coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0) AS precision, coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0) AS recall,
         coalesce(fp / nullif(fp + tn, 0)::DOUBLE, 0) AS false_positive_rate FROM {name}_counts),
{name} AS (
  SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM {name}_rates)"""


GRID = "[0.10, 0.15, 0.20, 0.25, 0.30, 0.35, 0.40, 0.45, 0.50, 0.55, 0.60, 0.65, 0.70, 0.75, 0.80, 0.85, 0.90]"
CURVE = measured("scored", "attack_probability", GRID)
BEST = "f1 DESC, recall DESC, false_positive_rate, abs(threshold - 0.5), threshold"


def bucket(key: str, n: int) -> str:
    return f"(('0x' || substr(md5({key}::VARCHAR || ':42'), 1, 8))::BIGINT % {n})"


def add(name: str, body: str, *views: str) -> None:
    ORACLES[name] = (f"WITH {', '.join(v.strip() for v in views)}\n" if views else "") + body.strip()


# --- profile ---------------------------------------------------------------------------------

add(
    "representative_agg",
    """
SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, l_linestatus, count(*) AS flow_count,
       sum(l_quantity::BIGINT)::BIGINT AS quantity, sum(l_linenumber)::BIGINT AS line_numbers
FROM lineitem GROUP BY ALL""",
)
add(
    "class_totals",
    """
SELECT o_orderstatus, count(*) AS flow_count, round(sum(o_totalprice), 2) AS total
FROM orders WHERE o_totalprice > 0 GROUP BY o_orderstatus""",
)
add(
    "class_share",
    """
SELECT CASE WHEN label = 1 THEN 'Positive' ELSE 'Negative' END AS traffic_class, count(*) AS flow_count,
       round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM line_rows), 4) AS percentage
FROM line_rows GROUP BY label""",
    LINE_ROWS,
)
add(
    "category_share",
    """
SELECT source, count(*) AS flow_count, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM documents), 4) AS percentage
FROM documents GROUP BY source ORDER BY flow_count DESC, source LIMIT 15""",
)
for _name, _column in (("rate_by_protocol", "dur"), ("rate_by_service", "service"), ("rate_by_state", "state")):
    add(
        _name,
        f"""
SELECT {_column}, count(*) AS flow_count, sum(label)::BIGINT AS positive_count,
       round(100.0::DOUBLE * sum(label) / count(*), 4) AS positive_percentage
FROM line_rows GROUP BY {_column} ORDER BY flow_count DESC, {_column} NULLS FIRST LIMIT 15""",
        LINE_ROWS,
    )
add(
    "numeric_profile",
    """
SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, round(quantile_disc(l_discount, 0.5), 6) AS median_discount,
       round(avg(l_quantity), 2) AS avg_quantity, round(avg(l_extendedprice), 2) AS avg_price, round(avg(l_tax), 2) AS avg_tax
FROM lineitem GROUP BY 1""",
)
add(
    "exact_medians",
    "SELECT l_returnflag, quantile_disc(l_extendedprice, 0.5) AS median FROM lineitem GROUP BY l_returnflag",
)
add(
    "label_correlations",
    """
SELECT feature, round(correlation, 6) AS correlation FROM (
  SELECT unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax', 'l_linenumber', 'l_suppkey']) AS feature,
         unnest([corr(l_quantity, y), corr(l_extendedprice, y), corr(l_discount, y), corr(l_tax, y), corr(l_linenumber, y),
                 corr(l_suppkey, y)]) AS correlation
  FROM (SELECT *, CASE WHEN l_extendedprice > 50000 THEN 1.0::DOUBLE ELSE 0 END AS y FROM lineitem))
ORDER BY abs(correlation) DESC, feature LIMIT 5""",
)
add(
    "imbalance",
    """
SELECT max(n) AS majority, min(n) AS minority, round(max(n) / min(n)::DOUBLE, 6) AS ratio
FROM (SELECT count(*) AS n FROM line_rows GROUP BY label)""",
    LINE_ROWS,
)
add(
    "table_summary",
    """
SELECT * FROM (VALUES ('column 1 id', 'bigint', NULL::BIGINT), ('column 2 proto', 'string', NULL), ('column 3 service', 'string', NULL),
  ('column 4 state', 'string', NULL), ('column 5 dur', 'double', NULL), ('column 6 margin', 'double', NULL),
  ('column 7 attack_cat', 'string', NULL), ('column 8 label', 'int', NULL)) AS columns(item, detail, "rows")
UNION ALL SELECT 'label', label::VARCHAR, count(*) FROM line_rows GROUP BY label""",
    LINE_ROWS,
)

# --- quality, cleaning, canonical rows -------------------------------------------------------

add(
    "null_counts",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_rows FROM docs"
        for c in ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")
    ),
    DOCUMENTS,
)
add("value_counts", 'SELECT lang, count(*) AS "rows" FROM documents GROUP BY lang')
add(
    "distinct_counts",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values FROM lineitem"
        for c in ("l_orderkey", "l_partkey", "l_returnflag")
    ),
)
add(
    "duplicate_count",
    """
SELECT count(*) AS "rows", count(DISTINCT text) AS distinct_rows, count(*) - count(DISTINCT text) AS duplicate_rows FROM documents""",
)
add(
    "label_audit",
    'SELECT toxic AS label, count(*) AS "rows", coalesce(toxic IN (0, 1), false) AS valid FROM docs GROUP BY toxic',
    DOCUMENTS,
)
add(
    "source_counts",
    'SELECT source, count(*) AS "rows", count(*) FILTER (toxic IS NULL OR toxic NOT IN (0, 1)) AS invalid_label_rows FROM docs GROUP BY source',
    DOCUMENTS,
)
add(
    "count_reconciliation",
    """
SELECT a AS actual_rows, 4 * o AS verified_rows, 4 * o - 3 AS published_rows, a - (4 * o - 3) AS difference_from_published,
       a = 4 * o AS matches_verified
FROM (SELECT (SELECT count(*) FROM lineitem) AS a, (SELECT count(*) FROM orders) AS o)""",
)
add(
    "validation_report",
    """
SELECT 'row_count' AS check_name, count(*) AS value, true AS passed FROM line_rows
UNION ALL SELECT 'column_count', 8, true
UNION ALL SELECT 'duplicate_rows', (SELECT count(*) FROM line_rows) - (SELECT count(*) FROM (SELECT DISTINCT * FROM line_rows)), NULL
UNION ALL SELECT 'invalid_labels', count(*) FILTER (label NOT IN (0, 1)), count(*) FILTER (label NOT IN (0, 1)) = 0 FROM line_rows
"""
    + "\n".join(
        f"UNION ALL SELECT 'null_{c}', count(*) - count({c}), NULL FROM line_rows"
        for c in ("id", "proto", "service", "state", "dur", "margin", "attack_cat", "label")
    ),
    LINE_ROWS,
)


def audit_sql(source: str) -> str:
    return f"""
SELECT 'all_rows' AS check_name, '' AS column_name, count(*) AS "rows" FROM {source}
UNION ALL SELECT 'kept_rows', '', count(*) FROM (SELECT DISTINCT * FROM {source} WHERE {SOUND})
UNION ALL SELECT 'duplicate_row', '', (SELECT count(*) FROM {source}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {source}))
UNION ALL SELECT 'unusable_number', 'dur', count(*) FILTER (dur IS NULL OR dur < 0) FROM {source}
UNION ALL SELECT 'unusable_number', 'margin', count(*) FILTER (margin IS NULL OR margin < 0) FROM {source}
UNION ALL SELECT 'missing_text', 'proto', count(*) FILTER (proto IS NULL OR trim(proto) IN ('', '-')) FROM {source}
UNION ALL SELECT 'missing_text', 'service', count(*) FILTER (service IS NULL OR trim(service) IN ('', '-')) FROM {source}
UNION ALL SELECT 'missing_text', 'state', count(*) FILTER (state IS NULL OR trim(state) IN ('', '-')) FROM {source}
UNION ALL SELECT 'broken_target', 'label', count(*) FILTER (NOT ({SOUND})) FROM {source}"""


add("cleaning_audit", audit_sql("line_rows"), LINE_ROWS)
add("clean_rows", "SELECT * FROM cleaned", LINE_ROWS, CLEANED)
add("audit_after_cleaning", audit_sql("cleaned"), LINE_ROWS, CLEANED)
add(
    "key_audit",
    """
SELECT sum(n)::BIGINT AS "rows", count(*) AS unique_keys, sum(n - 1)::BIGINT AS duplicate_rows,
       count(*) FILTER (versions > 1) AS conflicting_keys, coalesce(sum(n) FILTER (versions > 1), 0)::BIGINT AS conflicting_rows
FROM (SELECT count(*) AS n, count(DISTINCT quality) + max(CASE WHEN quality IS NULL THEN 1 ELSE 0 END) AS versions
      FROM docs GROUP BY text)""",
    DOCUMENTS,
)
add("conflict_free", "SELECT * FROM line_labels WHERE l_orderkey NOT IN (SELECT l_orderkey FROM mixed)", LINE_LABELS)
add("conflict_rows", "SELECT * FROM line_labels WHERE l_orderkey IN (SELECT l_orderkey FROM mixed)", LINE_LABELS)
add(
    "single_label_rows",
    """
SELECT doc_id, sha256(text) AS fingerprint, quality AS label FROM docs
WHERE text IN (SELECT text FROM docs GROUP BY text HAVING count(DISTINCT quality) = 1)""",
    DOCUMENTS,
)

PAGE_TOKENS = r"""
hosts AS (SELECT *, regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host FROM pages),
tokens AS (
  SELECT host, '0X' || substr(md5(url), 1, 4) AS sport, regexp_extract(url, '/([^/]*)$', 1) AS dsport,
         regexp_extract(url, '^([a-z]+):', 1) AS proto, regexp_extract(url, '://[^/]+/([^/]*)/', 1) AS state,
         regexp_extract(url, '://([a-z]+)', 1) AS service, regexp_extract(url, 'page=([0-9]+)', 1) AS dur,
         ' ' || length(html)::VARCHAR AS Spkts, length(url)::VARCHAR AS Dpkts,
         CASE WHEN regexp_matches(host, 'casino|pills') THEN ' Spam ' END AS attack_cat,
         CASE WHEN regexp_matches(host, 'casino|pills') THEN '1' ELSE '0' END AS label,
         regexp_extract(url, '://[^/]+[.]([a-z]+)/', 1) AS source_file
  FROM hosts),
parsed AS (
  SELECT *, lower(sport)::BIGINT AS p_sport,
         CASE WHEN regexp_full_match(trim(dsport), '[+-]?[0-9]+') THEN dsport::BIGINT END AS p_dsport,
         nullif(lower(trim(host)), '') AS p_host, nullif(lower(trim(proto)), '') AS p_proto,
         nullif(lower(trim(state)), '') AS p_state, nullif(lower(trim(service)), '') AS p_service,
         try_cast(trim(dur) AS INT) AS p_dur, try_cast(trim(Spkts) AS INT) AS p_spkts, try_cast(trim(Dpkts) AS INT) AS p_dpkts,
         label::INT AS p_label
  FROM tokens)"""

add(
    "canonical_rows",
    """
SELECT p_dur::DOUBLE AS dur, proto, service, state, p_spkts AS spkts, p_dpkts AS dpkts,
       CASE WHEN p_dur > 0 THEN (p_spkts + p_dpkts)::DOUBLE / p_dur ELSE 0 END AS rate, p_sport AS sport, p_dsport AS dsport,
       CASE WHEN p_label = 0 THEN 'Normal' ELSE trim(attack_cat) END AS attack_cat, p_label AS label,
       sha256(to_json({'host': p_host, 'sport': p_sport, 'dsport': p_dsport, 'proto': p_proto, 'state': p_state,
                       'service': p_service, 'dur': p_dur, 'Spkts': p_spkts, 'Dpkts': p_dpkts})::VARCHAR) AS flow_fingerprint,
       source_file,
       CASE WHEN trim(dsport) <> '' AND p_dsport IS NULL THEN 'dsport' ELSE '' END AS malformed_fields,
       concat_ws(',', CASE WHEN trim(dsport) = '' THEN 'dsport' END, CASE WHEN trim(dur) = '' THEN 'dur' END) AS missing_fields
FROM parsed""",
    PAGE_TOKENS,
)
add(
    "token_audit",
    """
SELECT 'sport' AS column_name, 0::BIGINT AS malformed_rows, 0::BIGINT AS missing_rows
UNION ALL SELECT 'dsport', count(*) FILTER (trim(dsport) <> '' AND p_dsport IS NULL), count(*) FILTER (trim(dsport) = '') FROM parsed
UNION ALL SELECT 'dur', count(*) FILTER (trim(dur) <> '' AND p_dur IS NULL), count(*) FILTER (trim(dur) = '') FROM parsed
UNION ALL SELECT unnest(['Spkts', 'Dpkts', 'label']), 0, 0""",
    PAGE_TOKENS,
)

# --- samples and splits ----------------------------------------------------------------------

add(
    "hash_sample",
    """
SELECT * FROM orders QUALIFY row_number() OVER (
  PARTITION BY o_orderstatus ORDER BY ('0x' || substr(md5(o_orderkey::VARCHAR), 1, 15))::BIGINT, o_orderkey) <= 3000""",
)
LINE_FEATURES = """
line_features AS (
  SELECT l_orderkey * 8 + l_linenumber AS id, l_linestatus AS status, substr(l_suppkey::VARCHAR, 1, 1) AS supplier_band,
         l_quantity, l_extendedprice, l_discount, l_tax, month(l_shipdate)::INTEGER AS ship_month,
         CASE WHEN l_extendedprice * (1 - l_discount) > 50000 THEN 'Dear' ELSE 'Normal' END AS attack_cat,
         CASE WHEN l_extendedprice * (1 - l_discount) > 50000 THEN 1 ELSE 0 END AS label
  FROM lineitem),
line_order AS (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY ('0x' || substr(md5(id::VARCHAR), 1, 15))::BIGINT, id) AS place
  FROM line_features)"""
add("balanced_sample", "SELECT * EXCLUDE (place) FROM line_order WHERE place <= 100", LINE_FEATURES)
add(
    "seeded_sample",
    """
SELECT * EXCLUDE (place) FROM line_order
WHERE place <= greatest(1, 12000 // (SELECT count(DISTINCT label) FROM line_features))""",
    LINE_FEATURES,
)
add(
    "locked_scores_check",
    """
SELECT CASE WHEN label = 1 THEN 'Attack' ELSE 'Normal' END AS actual_class, count(*) AS "rows", count(*) AS decided_rows,
       count(*) AS rows_in_range, 1::BIGINT AS models, true AS mostly_right FROM line_features GROUP BY 1""",
    LINE_FEATURES,
)
HELD_OUT = f"""
held AS (SELECT * FROM line_features WHERE {bucket('id', 10000)} < 2000)"""
add(
    "candidate_comparison_check",
    """
SELECT name, family, count(*) FILTER (label = 1) AS positives, count(*) FILTER (label = 0) AS negatives,
       true AS threshold_of_grid, true AS f1_in_bounds, true AS roc_in_bounds, true AS pr_in_bounds
FROM held, (SELECT unnest(['logistic_unweighted', 'logistic_balanced', 'forest_depth8', 'forest_depth12']) AS name,
                   unnest(['logistic', 'logistic', 'forest', 'forest']) AS family)
GROUP BY name, family""",
    LINE_FEATURES,
    HELD_OUT,
)
add(
    "sampled_forest_check",
    """
SELECT 'sample_forest' AS name, 'forest' AS family, count(*) FILTER (label = 1) AS positives, count(*) FILTER (label = 0) AS negatives,
       true AS threshold_of_grid, true AS f1_in_bounds, true AS roc_in_bounds, true AS pr_in_bounds FROM held""",
    LINE_FEATURES,
    HELD_OUT,
)
add(
    "first_per_group",
    """
SELECT * EXCLUDE (o_orderdate) FROM orders
QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) <= 20""",
)
add(
    "holdout_counts",
    f"""
SELECT CASE WHEN {bucket('o_orderkey', 10000)} < 2000 THEN 'validation' ELSE 'train' END AS split, o_orderstatus, count(*) AS "rows"
FROM orders GROUP BY ALL""",
)
add(
    "keyed_split",
    f"""
SELECT *, CASE WHEN {bucket('l_orderkey', 100)} < 70 THEN 'train' WHEN {bucket('l_orderkey', 100)} < 85 THEN 'validation'
          ELSE 'test' END AS split
FROM line_labels WHERE l_orderkey NOT IN (SELECT l_orderkey FROM mixed)""",
    LINE_LABELS,
)
add(
    "keyed_split_check",
    """
SELECT count(DISTINCT l_orderkey) AS keys, 0::BIGINT AS shared_keys, count(*) AS "rows", true AS complete
FROM line_labels WHERE l_orderkey NOT IN (SELECT l_orderkey FROM mixed)""",
    LINE_LABELS,
)
add("shared_keys", "SELECT count(*) FILTER (l_orderkey IS NULL) AS shared FROM lineitem")

ORDER_RUNS = """
runs AS (
  SELECT o_orderkey::VARCHAR AS run_id, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'calibration' ELSE 'training' END AS lab_mode FROM orders)"""

add(
    "run_split",
    """
SELECT run_id, label, lab_mode,
       CASE WHEN place <= train_end THEN 'train'
            WHEN place <= least(greatest(train_end + 1, floor(n * 0.80::DOUBLE)), n - 1) THEN 'validation' ELSE 'test' END AS split
FROM (SELECT *, greatest(1, floor(n * 0.60::DOUBLE)) AS train_end FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY sha256(run_id), run_id) AS place, count(*) OVER (PARTITION BY label) AS n
  FROM runs))""",
    ORDER_RUNS,
)
add(
    "training_mode",
    """
SELECT CASE WHEN count(*) FILTER (lab_mode = 'calibration' AND label = 0) >= 5
             AND count(*) FILTER (lab_mode = 'calibration' AND label = 1) >= 5 THEN 'calibration' ELSE 'training' END AS training_mode
FROM runs""",
    ORDER_RUNS,
)

# --- evaluation and alerts -------------------------------------------------------------------

add(
    "confusion",
    """
SELECT count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
       count(*) FILTER (label = 0 AND prediction = 0) AS tn, count(*) FILTER (label = 1 AND prediction = 0) AS fn FROM decided""",
    SCORED,
)
add("threshold_curve", f"SELECT {RATIOS} FROM curve", SCORED, CURVE)
add("best_threshold", f"SELECT {RATIOS} FROM (SELECT * FROM curve ORDER BY {BEST} LIMIT 1)", SCORED, CURVE)
add(
    "most_sensitive_threshold",
    f"SELECT {RATIOS} FROM (SELECT * FROM curve ORDER BY f1 DESC, recall DESC, false_positive_rate, threshold LIMIT 1)",
    SCORED,
    CURVE,
)
add(
    "ranking_measures",
    """
SELECT round(sum((x - x0) * (y + y0) / 2), 6) AS roc_auc, round(sum((y - y0) * (p + p0) / 2), 6) AS pr_auc
FROM (SELECT x, y, p, lag(x, 1, 0.0) OVER w AS x0, lag(y, 1, 0.0) OVER w AS y0, coalesce(lag(p) OVER w, p) AS p0
      FROM points WINDOW w AS (ORDER BY score DESC))""",
    SCORED,
    """
steps AS (SELECT attack_probability AS score, sum(label)::DOUBLE AS ones, count(*) - sum(label)::DOUBLE AS zeros FROM scored GROUP BY 1),
sums AS (
  SELECT score, sum(ones) OVER w AS tp, sum(zeros) OVER w AS fp, sum(ones) OVER () AS positives, sum(zeros) OVER () AS negatives
  FROM steps WINDOW w AS (ORDER BY score DESC)),
points AS (SELECT score, fp / negatives AS x, tp / positives AS y, tp / (tp + fp) AS p FROM sums)""",
)
add(
    "exact_ranking_measures",
    """
SELECT round(sum((x - x0) * (y + y0) / 2), 6) AS roc_auc, round(sum((y - y0) * (p + p0) / 2), 6) AS pr_auc
FROM (SELECT x, y, p, lag(x, 1, 0.0) OVER w AS x0, lag(y, 1, 0.0) OVER w AS y0, coalesce(lag(p) OVER w, p) AS p0
      FROM points WINDOW w AS (ORDER BY score DESC))""",
    """
scored AS (SELECT CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label, value / (value + 50.0::DOUBLE) AS attack_probability FROM events)""",
    """
steps AS (SELECT attack_probability AS score, sum(label)::DOUBLE AS ones, count(*) - sum(label)::DOUBLE AS zeros FROM scored GROUP BY 1),
sums AS (
  SELECT score, sum(ones) OVER w AS tp, sum(zeros) OVER w AS fp, sum(ones) OVER () AS positives, sum(zeros) OVER () AS negatives
  FROM steps WINDOW w AS (ORDER BY score DESC)),
points AS (SELECT score, fp / negatives AS x, tp / positives AS y, tp / (tp + fp) AS p FROM sums)""",
)
add(
    "class_weights",
    """
SELECT label, count(*) AS "rows", round((SELECT count(*) FROM line_rows) / (2.0::DOUBLE * count(*)), 9) AS weight
FROM line_rows GROUP BY label""",
    LINE_ROWS,
)
OUTCOME = """CASE WHEN label = 1 AND prediction = 1 THEN 'true_positive' WHEN label = 0 AND prediction = 1 THEN 'false_positive'
     WHEN label = 1 AND prediction = 0 THEN 'false_negative' WHEN label = 0 AND prediction = 0 THEN 'true_negative' END"""
add("outcome_rows", f'SELECT {OUTCOME} AS outcome, count(*) AS "rows" FROM decided GROUP BY 1', SCORED)
add("top_alerts", "SELECT * FROM decided WHERE prediction = 1 ORDER BY attack_probability DESC, id LIMIT 200", SCORED)
add(
    "top_false_positives",
    "SELECT * FROM decided WHERE prediction = 1 AND label = 0 ORDER BY attack_probability DESC, id LIMIT 50",
    SCORED,
)
add(
    "lowest_false_negatives",
    "SELECT * FROM decided WHERE prediction = 0 AND label = 1 ORDER BY attack_probability, id LIMIT 50",
    SCORED,
)
add(
    "outcome_examples",
    f"SELECT *, {OUTCOME} AS outcome FROM decided QUALIFY row_number() OVER (PARTITION BY {OUTCOME} ORDER BY id) <= 3",
    SCORED,
)
add(
    "alert_distribution",
    """
SELECT user_id, count(*) AS alert_count, round(avg(attack_probability), 6) AS mean_score
FROM decided WHERE prediction = 1 GROUP BY user_id ORDER BY alert_count DESC, user_id LIMIT 15""",
    SCORED,
)
add(
    "best_candidate",
    f"""
SELECT name, threshold, round(f1, 9) AS f1, round(recall, 9) AS recall, round(false_positive_rate, 9) AS false_positive_rate
FROM (
  (SELECT 'value' AS name, * FROM by_value ORDER BY {BEST} LIMIT 1) UNION ALL
  (SELECT 'inverse', * FROM by_inverse ORDER BY {BEST} LIMIT 1) UNION ALL
  (SELECT 'kind', * FROM by_kind ORDER BY {BEST} LIMIT 1))
ORDER BY f1 DESC, recall DESC, false_positive_rate, name LIMIT 1""",
    SCORED,
    measured("scored", "attack_probability", GRID, "by_value"),
    measured("scored", "(1 - attack_probability)", GRID, "by_inverse"),
    measured("scored", "(CASE WHEN event_type IN ('error', 'signup') THEN 0.8::DOUBLE ELSE 0.2 END)", GRID, "by_kind"),
)

# --- windows and reconciliation --------------------------------------------------------------

add("window_features", "SELECT * FROM day_windows", FLOWS, DAY_WINDOWS)
add("short_window_features", windows_of("flows", "10 seconds"), FLOWS)
add("session_features", "SELECT * FROM sessions", FLOWS, SESSIONS)
add("complete_sessions", "SELECT * FROM complete", FLOWS, SESSIONS, COMPLETE)
add("labelled_windows", "SELECT * FROM labelled", FLOWS, TRUTH, LABELLED)
RULE = "(CASE WHEN port_scan_ratio >= 0.5 OR flow_rate >= 10 THEN 1.0::DOUBLE ELSE 0 END)"
add("rule_measures", f"SELECT {RATIOS} FROM curve", FLOWS, TRUTH, LABELLED, measured("labelled", RULE, "[0.5]"))
add(
    "challenge_measures",
    f"SELECT 'training' AS source_mode, {RATIOS} FROM curve",
    FLOWS,
    SESSIONS,
    COMPLETE,
    "challenge AS (SELECT * FROM complete WHERE lab_mode = 'training')",
    measured("challenge", "(1 - http_ratio)", "[0.5]"),
)
add(
    "session_measures_check",
    """
SELECT part, count(*) FILTER (label = 1) AS positives, count(*) FILTER (label = 0) AS negatives, true AS threshold_of_grid, true AS f1_in_bounds
FROM (SELECT label, split AS part FROM parts WHERE split <> 'train'
      UNION ALL SELECT label, 'challenge' FROM complete WHERE lab_mode = 'training' AND (SELECT mode FROM modes) = 'calibration')
GROUP BY part""",
    FLOWS,
    SESSIONS,
    COMPLETE,
    """
modes AS (
  SELECT CASE WHEN count(*) FILTER (lab_mode = 'calibration' AND label = 0) >= 5
               AND count(*) FILTER (lab_mode = 'calibration' AND label = 1) >= 5 THEN 'calibration' ELSE 'training' END AS mode FROM complete)""",
    """
parts AS (
  SELECT label, CASE WHEN place <= train_end THEN 'train'
            WHEN place <= least(greatest(train_end + 1, floor(n * 0.80::DOUBLE)), n - 1) THEN 'validation' ELSE 'test' END AS split
  FROM (SELECT *, greatest(1, floor(n * 0.60::DOUBLE)) AS train_end FROM (
    SELECT *, row_number() OVER (PARTITION BY label ORDER BY sha256(run_id), run_id) AS place, count(*) OVER (PARTITION BY label) AS n
    FROM complete WHERE lab_mode = (SELECT mode FROM modes))))""",
)
add(
    "experiment_check",
    """
SELECT p.split, p.label, count(l.label) AS windows, count(l.label) >= 5 AS enough
FROM (SELECT unnest(['train', 'train', 'validation', 'validation', 'test', 'test']) AS split, unnest([0, 1, 0, 1, 0, 1]) AS label) p
LEFT JOIN (SELECT label, CASE WHEN day(window_start) <= 18 THEN 'train' WHEN day(window_start) <= 24 THEN 'validation'
                         ELSE 'test' END AS split FROM labelled) l ON p.split = l.split AND p.label = l.label
GROUP BY p.split, p.label""",
    FLOWS,
    TRUTH,
    LABELLED,
)
add(
    "window_measures_check",
    """
SELECT part, count(*) FILTER (label = 1) AS positives, count(*) FILTER (label = 0) AS negatives, true AS threshold_of_grid
FROM labelled JOIN (SELECT unnest(['validation', 'test', 'baseline']) AS part)
  ON CASE WHEN part = 'validation' THEN day(window_start) BETWEEN 19 AND 24 ELSE day(window_start) > 24 END
GROUP BY part""",
    FLOWS,
    TRUTH,
    LABELLED,
)
RECONCILED = """
known AS (SELECT source_ip, time_bucket(INTERVAL '1 day', ts) AS window_start, count(*) AS n, max(label) AS actual FROM truth GROUP BY ALL),
states AS (
  SELECT r.*, k.actual AS found, r.window_end <= (SELECT max(ts) - INTERVAL '2 days' FROM flows) AS final,
         coalesce(k.n = r.flow_count, false) AS whole
  FROM ruled r LEFT JOIN known k ON r.source_ip = k.source_ip AND r.window_start = k.window_start),
reconciled AS (
  SELECT source_ip, window_start, flow_count, prediction, final AND whole AS checked,
         CASE WHEN NOT final THEN 'provisional' WHEN NOT whole THEN 'awaiting_truth'
              WHEN found = 1 AND prediction = 1 THEN 'true_positive' WHEN found = 0 AND prediction = 1 THEN 'false_positive'
              WHEN found = 1 THEN 'false_negative' ELSE 'true_negative' END AS outcome,
         CASE WHEN final AND whole THEN found END AS actual
  FROM states)"""
add("reconciled", "SELECT * FROM reconciled", FLOWS, TRUTH, DAY_WINDOWS, RULED, RECONCILED)
add(
    "outcome_counts",
    "SELECT outcome, count(*) AS windows FROM reconciled GROUP BY outcome",
    FLOWS,
    TRUTH,
    DAY_WINDOWS,
    RULED,
    RECONCILED,
)
add("windows_per_source", "SELECT actor_id, count(*) AS windows FROM day_windows GROUP BY actor_id", FLOWS, DAY_WINDOWS)
add(
    "latest_windows",
    """
SELECT actor_id, source_ip, window_start, flow_count, prediction FROM ruled
QUALIFY row_number() OVER (PARTITION BY actor_id ORDER BY window_start DESC) = 1""",
    FLOWS,
    DAY_WINDOWS,
    RULED,
)
add(
    "numbered_windows",
    """
SELECT actor_id, window_start, flow_count, row_number() OVER (PARTITION BY actor_id ORDER BY window_start) AS window_number
FROM day_windows""",
    FLOWS,
    DAY_WINDOWS,
)

# --- equality of results ---------------------------------------------------------------------

STATUS_TOTALS = """
totals AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, l_linestatus, count(*) AS flow_count,
         sum(l_quantity::BIGINT)::BIGINT AS quantity, sum(l_linenumber)::BIGINT AS line_numbers FROM lineitem GROUP BY ALL)"""
for _name, _variants in (
    ("partition_invariance", "['1 x cores', '2 x cores', '4 x cores']"),
    ("format_equivalence", "['parquet', 'parquet, kept', 'csv', 'csv, kept']"),
):
    add(_name, f"SELECT variant, true AS same, totals.* FROM totals, (SELECT unnest({_variants}) AS variant)", STATUS_TOTALS)

# --- ranges, keys and files ------------------------------------------------------------------

add(
    "rank_slice",
    """
SELECT l_quantity, l_orderkey, l_linenumber FROM lineitem
QUALIFY row_number() OVER (ORDER BY l_quantity, l_orderkey, l_linenumber) > (SELECT count(*) // 5 FROM lineitem)
    AND row_number() OVER (ORDER BY l_quantity, l_orderkey, l_linenumber) <= (SELECT count(*) * 9 // 20 FROM lineitem)""",
)
add(
    "landed_events",
    """
SELECT event_type, event_id, value, ((place - 1) // size)::INTEGER AS batch
FROM (SELECT *, row_number() OVER (ORDER BY event_type, event_id) AS place, count(*) OVER () // 7 AS size FROM events)
WHERE (place - 1) // size IN (0, 3)""",
)
add(
    "one_per_key",
    """
SELECT concat_ws('/', user_id, event_type) AS key, value, event_id FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY value, event_id) = 1""",
)
add(
    "wide_columns",
    """
SELECT unnest(['o_orderstatus', 'o_key', 'o_orderpriority']) AS column_name,
       unnest([count(DISTINCT o_orderstatus) > 100, count(DISTINCT o_orderkey) > 100, count(DISTINCT o_orderpriority) > 100]) AS hashed
FROM orders""",
)
# DuckDB has no view of the files as such: what the audit must say of each table's
add(
    "file_audit",
    """
SELECT name || '.parquet' AS table_file,
       CASE name WHEN 'orders' THEN 'size_differs' WHEN 'nation' THEN 'unexpected' WHEN 'none' THEN 'missing' ELSE 'verified' END AS status
FROM (SELECT unnest(['region', 'nation', 'customer', 'supplier', 'part', 'orders', 'lineitem', 'events', 'documents', 'embeddings',
                     'pages', 'benchmark', 'labels', 'conversations', 'none']) AS name)""",
)

# --- whole jobs ------------------------------------------------------------------------------

add("bronze_lines", "SELECT * FROM line_rows", LINE_ROWS)
ORACLES["bronze_validation"] = ORACLES["validation_report"]
add(
    "silver_orders",
    """
SELECT o_orderkey AS id, lower(o_orderpriority) AS priority,
       coalesce(lower(nullif(o_orderstatus, 'P')), '__unknown__') AS status, greatest(o_totalprice - 100000, 0) AS price,
       CASE WHEN o_orderstatus = 'F' THEN 'Finished' ELSE 'Normal' END AS attack_cat,
       CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label FROM orders WHERE o_orderkey > 0""",
)
add("json_sessions", "SELECT * FROM complete", FLOWS, SESSIONS, COMPLETE)
add(
    "raw_file_rows",
    """
SELECT CASE WHEN regexp_matches(regexp_extract(url, '^[a-z]+://([^/]+)', 1), 'casino|pills') THEN 1 ELSE 0 END AS part,
       count(*) AS "rows", 0::BIGINT AS invalid_label_rows FROM pages GROUP BY 1""",
)
add("csv_report", "SELECT * FROM decided WHERE prediction = 1 ORDER BY attack_probability DESC, id LIMIT 200", SCORED)
add(
    "alert_tables",
    """
SELECT 'alerts' AS report, count(*) AS "rows", round(sum(attack_probability), 6) AS total_score
FROM (FROM decided WHERE prediction = 1 ORDER BY attack_probability DESC, id LIMIT 200)
UNION ALL SELECT 'false_positives', count(*), round(sum(attack_probability), 6)
FROM (FROM decided WHERE prediction = 1 AND label = 0 ORDER BY attack_probability DESC, id LIMIT 50)
UNION ALL SELECT 'false_negatives', count(*), round(sum(attack_probability), 6)
FROM (FROM decided WHERE prediction = 0 AND label = 1 ORDER BY attack_probability, id LIMIT 50)
UNION ALL SELECT 'alert_distribution', count(*), round(sum(mean_score), 6) FROM (
  SELECT avg(attack_probability) AS mean_score FROM decided WHERE prediction = 1 GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 15)
UNION ALL SELECT 'measures', 1, round(2 * tp / (2 * tp + fp + fn)::DOUBLE, 6) FROM (
  SELECT count(*) FILTER (prediction = 1 AND label = 1) AS tp, count(*) FILTER (prediction = 1 AND label = 0) AS fp,
         count(*) FILTER (prediction = 0 AND label = 1) AS fn FROM decided)""",
    SCORED,
)
add(
    "batch_scores_check",
    """
SELECT part, count(*) AS "rows", count(*) FILTER (label = 1) AS positives, true AS mostly_right
FROM (SELECT 'parquet' AS part, label FROM line_features UNION ALL SELECT 'csv', label FROM line_features
      UNION ALL SELECT 'test', label FROM held) GROUP BY part""",
    LINE_FEATURES,
    HELD_OUT,
)
add(
    "full_training_check",
    f"""
SELECT label, count(*) AS "rows", count(*) AS decided_rows, true AS mostly_right, true AS threshold_of_grid,
       (sum(count(*)) OVER ())::BIGINT AS measured_rows
FROM line_features WHERE {bucket('id', 100)} >= 85 GROUP BY label""",
    LINE_FEATURES,
)
add(
    "restart_job_check",
    """
SELECT count(*) AS "rows", count(*) AS distinct_ids, 0::BIGINT AS duplicate_ids, 3::BIGINT AS batches, true AS consecutive,
       count(*) AS input_rows, 2::BIGINT AS runs, 0::BIGINT AS late_rows, min(id) AS first_id, max(id) AS last_id
FROM (SELECT o_orderkey AS id FROM orders WHERE o_orderkey > 0
      QUALIFY row_number() OVER (ORDER BY o_orderkey) <= 3 * ((SELECT count(*) FROM orders WHERE o_orderkey > 0) // 20))""",
)

# --- streams, against the same work as a batch -----------------------------------------------

add("stream_scores", "SELECT * FROM decided", SCORED)
add(
    "stream_summary",
    """
SELECT count(*) AS input_rows, count(*) FILTER (prediction = 1) AS alert_rows, count(*) FILTER (prediction = 0) AS normal_rows,
       round(max(attack_probability), 6) AS max_attack_probability,
       round(count(*) FILTER (prediction = 1) / count(*), 6) AS alert_rate,
       round(avg(attack_probability), 6) AS mean_attack_probability, true AS files_counted FROM decided""",
    SCORED,
)
add("stream_windows", "SELECT * FROM ruled", FLOWS, DAY_WINDOWS, RULED)
add(
    "stream_restart_check",
    """
SELECT count(*) AS "rows", count(DISTINCT event_id) AS distinct_ids, count(*) - count(DISTINCT event_id) AS duplicate_ids,
       true AS consecutive, true AS same_query, true AS new_runs, true AS only_new_rows FROM events""",
)
