"""DuckDB SQL that answers the same questions as ``checks.queries``, written independently."""

V = [f"V{i}" for i in range(1, 29)]
RAW = ["Time", *V, "Amount", "Class"]
FEATURES29 = [*V, "Amount"]
SQL: dict[str, str] = {}


def fx(expr: str, digits: int) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(38,8)), {digits}) AS DOUBLE)"


def dsum(expr: str) -> str:
    return f"sum(CAST({expr} AS DECIMAL(20,6)))"


def money(expr: str) -> str:
    return f"CAST(round({dsum(expr)}, 2) AS DOUBLE)"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


# Common table expressions


def tx_ctes(events: str = "events", prefix: str = "") -> str:
    return f"""
{prefix}u1 AS (SELECT *, ((event_id*7919 + 104729) % 997) / 997.0E0 AS u FROM {events}),
{prefix}u2 AS (SELECT *, (u*u)*(u*u) AS u4 FROM {prefix}u1),
{prefix}u3 AS (SELECT *, (u4*u4)*(u4*u4) AS p FROM {prefix}u2),
{prefix}tx AS (
  SELECT event_id AS id, 'TX_' || CAST(event_id AS VARCHAR) AS transaction_id,
    CAST(date_diff('second', TIMESTAMP '2024-01-01 00:00:00', date_trunc('second', ts)) AS DOUBLE) AS transaction_time,
    value AS amount,
    CAST(CASE WHEN event_type = 'view' THEN NULL
      WHEN (u > 0.95 AND event_id % 5 <> 0) OR event_id % 211 = 0 THEN 1 ELSE 0 END AS INTEGER) AS actual_class,
    CASE WHEN p >= 0.35 THEN 'FRAUD' ELSE 'LEGITIMATE' END AS predicted_class,
    round(p, 4) AS fraud_probability, round(p*100, 2) AS risk_score,
    CASE WHEN round(p*100, 2) <= 30.0 THEN 'LOW' WHEN round(p*100, 2) <= 70.0 THEN 'MEDIUM' ELSE 'HIGH' END AS risk_level,
    ts AS created_at, event_type, p
  FROM {prefix}u3)"""


TX = "WITH " + tx_ctes()
AUDIT = (
    "id, transaction_id, transaction_time, amount, actual_class, predicted_class,"
    " fraud_probability, risk_score, risk_level"
)
ISO = (
    "CASE WHEN microsecond(created_at) % 1000000 = 0 THEN strftime(created_at, '%Y-%m-%dT%H:%M:%S')"
    " ELSE strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') END AS created_at"
)
RECORD = f"{AUDIT}, {ISO}"
LABELLED = TX + ",\nlab AS (SELECT actual_class AS y, fraud_probability AS p, predicted_class FROM tx WHERE actual_class IS NOT NULL)"

RAW_CTE = (
    "raw0 AS (SELECT vec_id AS row_id, label, CAST((vec_id*347) % 172800 AS DOUBLE) AS \"Time\", "
    + ", ".join(f"CAST(embedding[{i}] AS DOUBLE) AS {v}" for i, v in enumerate(V, 1))
    + ", ((vec_id*7919 + 13) % 50000) / 100.0E0 AS \"Amount\", CASE WHEN label = 9 THEN 1 ELSE 0 END AS \"Class\" FROM embeddings)"
)
WITH_RAW = "WITH " + RAW_CTE
COLS = ", ".join(f'"{c}"' for c in RAW)
_dirty = ", ".join(
    "CASE WHEN label <> 5 THEN V1 END AS V1" if c == "V1"
    else "CASE WHEN label = 6 THEN CAST('NaN' AS DOUBLE) ELSE V2 END AS V2" if c == "V2"
    else "CASE WHEN label = 7 THEN CAST('Infinity' AS DOUBLE) ELSE \"Amount\" END AS \"Amount\"" if c == "Amount"
    else f'"{c}"'
    for c in RAW
)
WITH_DIRTY = WITH_RAW + f""",
dirty AS (SELECT {_dirty} FROM raw0 UNION ALL SELECT {_dirty} FROM raw0 WHERE label = 3),
finite AS (SELECT {', '.join(f'"{c}"' if c == 'Class' else f'CASE WHEN isfinite("{c}") THEN "{c}" END AS "{c}"' for c in RAW)} FROM dirty),
med AS (SELECT {', '.join(f'quantile_cont("{c}", 0.5) AS "m_{c}"' for c in RAW[:-1])} FROM finite),
imputed AS (SELECT {', '.join(f'coalesce("{c}", "m_{c}") AS "{c}"' for c in RAW[:-1])}, "Class" FROM finite, med),
cleaned AS (SELECT DISTINCT * FROM imputed)"""
_rounded8 = ", ".join(f'{fx(chr(34) + c + chr(34), 8)} AS "{c}"' for c in RAW[:-1]) + ', "Class"'

# Sources and sinks

SQL["s01_load_raw_csv"] = f"{WITH_RAW} SELECT {COLS} FROM raw0"
SQL["s02_s03_cleaned_table"] = f"{WITH_RAW} SELECT DISTINCT {COLS} FROM raw0"
SQL["s08_audit_table"] = f"{TX} SELECT {RECORD} FROM tx"

# Profiling, validation, cleaning

SQL["c01_null_profile"] = WITH_DIRTY + ", n AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{'int' if c == 'Class' else 'double'}' AS data_type, count(*) AS n,"
    f" count(*) FILTER (WHERE \"{c}\" IS NULL OR isnan(CAST(\"{c}\" AS DOUBLE))) AS missing_count FROM dirty"
    for c in RAW
) + f""")
SELECT column_name, data_type, missing_count, {fx('100.0E0 * missing_count / n', 6)} AS missing_percent,
  {big('sum(missing_count) OVER ()')} AS total_missing_cells FROM n"""
SQL["c02_shape_profile"] = WITH_DIRTY + f"""
SELECT (SELECT count(*) FROM dirty) AS total_rows, CAST(31 AS BIGINT) AS total_columns,
  (SELECT count(*) FROM dirty) - count(*) AS duplicate_rows,
  {fx('100.0E0 * ((SELECT count(*) FROM dirty) - count(*)) / (SELECT count(*) FROM dirty)', 4)} AS duplicate_percentage
FROM (SELECT DISTINCT * FROM dirty)"""
SQL["c02b_numeric_summary"] = WITH_RAW + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(\"{c}\") AS count, {fx(f'avg(CAST(x AS DOUBLE))', 6)} AS mean,"
    f" {fx('stddev_samp(x)', 6)} AS std, {fx('min(x)', 6)} AS min,"
    f" {fx('quantile_cont(x, 0.25)', 6)} AS q25, {fx('quantile_cont(x, 0.5)', 6)} AS q50,"
    f" {fx('quantile_cont(x, 0.75)', 6)} AS q75, {fx('max(x)', 6)} AS max"
    f" FROM (SELECT \"{c}\", CAST(\"{c}\" AS DOUBLE) AS x FROM raw0)"
    for c in RAW
)
SQL["c02c_target_distribution"] = f"""{WITH_RAW}
SELECT "Class", count(*) AS transactions, {fx('100.0E0 * count(*) / sum(count(*)) OVER ()', 6)} AS percentage
FROM raw0 GROUP BY "Class" """
SQL["c02c_target_summary"] = f"""{WITH_RAW}
SELECT {big('sum("Class")')} AS fraud_count, {big('sum(1 - "Class")')} AS legitimate_count,
  {fx('100.0E0 * sum("Class") / count(*)', 6)} AS fraud_percentage,
  {big('floor(sum(1 - "Class") / greatest(1, sum("Class")))')} AS imbalance_ratio FROM raw0"""
SQL["c03_impute"] = f"{WITH_DIRTY} SELECT {_rounded8} FROM imputed"
SQL["c04_drop_repeats"] = f"{WITH_DIRTY} SELECT {_rounded8} FROM cleaned"
SQL["c06_clean_dataset"] = SQL["c04_drop_repeats"]
SQL["c05_outliers"] = f"""{WITH_DIRTY},
q AS (SELECT quantile_cont("Amount", 0.25) AS q1, quantile_cont("Amount", 0.75) AS q3 FROM cleaned),
f AS (SELECT q1, q3, q3 - q1 AS iqr, q3 + 1.5*(q3 - q1) AS upper_bound FROM q),
c AS (SELECT count(*) AS n, count(*) FILTER (WHERE "Amount" > upper_bound) AS o,
        coalesce(sum("Class") FILTER (WHERE "Amount" > upper_bound), 0) AS fr FROM cleaned, f)
SELECT {fx('q1', 6)} AS q1, {fx('q3', 6)} AS q3, {fx('iqr', 6)} AS iqr, {fx('upper_bound', 6)} AS upper_bound,
  o AS total_outliers, {fx('100.0E0*o/n', 2)} AS outlier_percentage, {big('fr')} AS fraud_count_in_outliers,
  {fx('100.0E0*fr/greatest(1, o)', 2)} AS fraud_rate_in_outliers FROM f, c"""
SQL["vd1_validated_schema"] = SQL["s01_load_raw_csv"]
SQL["vd1_schema_faults"] = """
SELECT 'good' AS "case", '' AS said
UNION ALL SELECT 'wrong label', 'labels other than 0 and 1 (label, rows): [(99, ' || count(*) || ')]'
FROM embeddings WHERE (vec_id * 347) % 172800 < 40000
UNION ALL SELECT 'no V14', 'columns not found: [''V14'']'
"""
SQL["m07_logistic_factors"] = "SELECT vec_id AS row_id, 4::BIGINT AS factors, 4::BIGINT AS features FROM embeddings"
_payload_v = "".join(
    f", CASE WHEN {'label = 5' if v == 'V1' else 'label = 6' if v == 'V2' else 'false'} THEN '{v}' END" for v in V
)
SQL["vd2_payload_reasons"] = f"""{WITH_RAW},
r AS (SELECT 'T' || CAST(row_id AS VARCHAR) AS transaction_id, concat_ws(',',
  CASE WHEN length(CAST(row_id AS VARCHAR)) NOT BETWEEN 2 AND 63 THEN 'transaction_id' END,
  CASE WHEN label IN (4, 7) THEN 'Amount' END,
  CASE WHEN label = 8 THEN 'actual_class' END{_payload_v}) AS reasons FROM raw0)
SELECT transaction_id, reasons, CASE WHEN reasons = '' THEN 1 ELSE 0 END AS accepted FROM r"""
SQL["vd3_audit_violations"] = f"""{TX},
b AS (SELECT CASE WHEN event_type = 'error' THEN 'U_' || CAST(CAST(trunc(amount) AS INTEGER) AS VARCHAR) ELSE transaction_id END AS transaction_id,
  event_type, fraud_probability FROM tx)
SELECT 'risk_level' AS rule, count(*) FILTER (WHERE event_type = 'error') AS violations FROM b
UNION ALL SELECT 'predicted_class', count(*) FILTER (WHERE event_type = 'click') FROM b
UNION ALL SELECT 'fraud_probability', count(*) FILTER (WHERE event_type = 'view' AND fraud_probability > 0) FROM b
UNION ALL SELECT 'risk_score', count(*) FILTER (WHERE event_type = 'purchase' AND s < 1) FROM (SELECT event_type, risk_score AS s FROM tx)
UNION ALL SELECT 'required', count(*) FILTER (WHERE event_type = 'signup') FROM b
UNION ALL SELECT 'unique_transaction_id', count(*) FROM (SELECT transaction_id FROM b GROUP BY 1 HAVING count(*) > 1)"""

# Projections and scalar functions

_hour = '(("Time" / 3600.0E0) % 24)'
SQL["f01_hour_of_day"] = f"{WITH_RAW} SELECT row_id, {fx(_hour, 8)} AS hour_of_day FROM raw0"
SQL["f02_cyclic_hour"] = f"""{WITH_RAW} SELECT row_id, {fx(f'sin(2*pi()*{_hour}/24.0)', 8)} AS sin_hour,
  {fx(f'cos(2*pi()*{_hour}/24.0)', 8)} AS cos_hour FROM raw0"""
SQL["f03_log_amount"] = f"""{WITH_RAW} SELECT row_id, {fx('ln(1 + greatest(0, "Amount"))', 8)} AS log_amount FROM raw0"""
SQL["f04_amount_ratio"] = f"""{WITH_RAW}, m AS (SELECT quantile_cont("Amount", 0.5) AS med FROM raw0)
SELECT row_id, {fx('"Amount" / greatest(1.0, med)', 8)} AS amount_ratio FROM raw0, m"""
SQL["f05_feature_selection"] = f"{WITH_RAW} SELECT row_id, {', '.join(FEATURES29)} FROM raw0"
SQL["f06_risk_score"] = f"{TX} SELECT id AS event_id, risk_score, fraud_probability FROM tx"
SQL["f07_risk_level"] = f"{TX} SELECT id AS event_id, risk_level FROM tx"
SQL["f08_prediction"] = f"{TX} SELECT id AS event_id, predicted_class AS prediction FROM tx"
SQL["f09_audit_record"] = f"{TX} SELECT {RECORD} FROM tx"
SQL["f10_filters"] = f"{TX} SELECT transaction_id, amount, risk_level FROM tx WHERE risk_level = upper('high') AND amount > 100"
RANGE = "CASE WHEN amount < 50 THEN '$0-$50' WHEN amount < 200 THEN '$50-$200' WHEN amount < 500 THEN '$200-$500' ELSE '$500+' END"
DECILE = (
    "CASE "
    + " ".join(f"WHEN fraud_probability < {i / 10} THEN '{(i - 1) / 10:.2f} - {i / 10:.2f}'" for i in range(1, 10))
    + " ELSE '0.90 - 1.00' END"
)
LABEL_TEXT = "CASE actual_class WHEN 1 THEN 'FRAUD' WHEN 0 THEN 'LEGITIMATE' END"
SQL["f11_amount_range"] = f"{TX} SELECT transaction_id, {RANGE} AS amount_range FROM tx"
SQL["f12_probability_decile"] = f"{TX} SELECT transaction_id, {DECILE} AS probability_bin FROM tx"
SQL["f14_actual_label"] = f"{TX} SELECT transaction_id, {LABEL_TEXT} AS actual_label FROM tx"

# Joins

SQL["j03_minority_neighbours"] = f"""{WITH_RAW},
m AS (SELECT row_id, {', '.join(V)} FROM raw0 WHERE "Class" = 1),
d AS (SELECT a.row_id, b.row_id AS neighbour, sqrt({' + '.join(f'(a.{v}-b.{v})*(a.{v}-b.{v})' for v in V)}) AS distance
      FROM m a JOIN m b ON a.row_id <> b.row_id),
r AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY distance, neighbour) - 1 AS place FROM d)
SELECT row_id, CAST(place AS INTEGER) AS place, neighbour, {fx('distance', 6)} AS distance FROM r WHERE place < 5"""
SQL["j05_late_labels"] = f"""{TX} SELECT transaction_id,
  CASE WHEN actual_class IS NULL THEN CASE WHEN amount > 100 THEN 1 ELSE 0 END ELSE actual_class END AS actual_class,
  predicted_class FROM tx"""

# Split, scale, rebalance

_sizes = f"""{WITH_RAW},
c AS (SELECT "Class" AS class, count(*) AS n FROM raw0 GROUP BY 1),
t AS (SELECT sum(n) AS total, sum(n) - ceil(sum(n) * 0.2) AS train_total FROM c),
e AS (SELECT class, n, n * train_total / total AS x, floor(n * train_total / total) AS f, train_total FROM c, t),
r AS (SELECT *, row_number() OVER (ORDER BY f - x, class) AS place, train_total - sum(f) OVER () AS missing FROM e),
s AS (SELECT class, n, CAST(f + CASE WHEN place <= missing THEN 1 ELSE 0 END AS BIGINT) AS train FROM r)"""
SQL["p01_split_counts"] = f"""{_sizes} SELECT 'train' AS part, class, train AS transactions FROM s
UNION ALL SELECT 'test', class, {big('n - train')} FROM s"""
_quart = ", ".join(
    f"quantile_cont({c}, 0.5) AS m_{c}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS r_{c}" for c in FEATURES29
)
SQL["p03_robust_scaling"] = f"""{WITH_RAW}, q AS (SELECT {_quart} FROM raw0)
SELECT row_id, {', '.join(f'{fx(f"({c} - m_{c}) / CASE WHEN r_{c} = 0 THEN 1 ELSE r_{c} END", 6)} AS "{c}"' for c in FEATURES29)} FROM raw0, q"""
_made = f"""{WITH_RAW},
m AS (SELECT greatest(1.0, quantile_cont("Amount", 0.5)) AS med, quantile_cont("Amount", 0.5) AS raw_med FROM raw0 WHERE row_id % 5 <> 0),
f AS (SELECT row_id, {", ".join(FEATURES29)}, {_hour} AS hour_of_day, sin(2*pi()*{_hour}/24.0) AS sin_hour, cos(2*pi()*{_hour}/24.0) AS cos_hour,
  ln(1 + greatest(0, "Amount")) AS log_amount, "Amount" / med AS amount_ratio FROM raw0, m)"""
_made34 = [*FEATURES29, "hour_of_day", "sin_hour", "cos_hour", "log_amount", "amount_ratio"]
_fit = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, quantile_cont({c}, 0.5) AS center, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS r FROM f WHERE row_id % 5 <> 0"
    for c in _made34
)
SQL["p02_fitted_parameters"] = f"""{_made}, q AS ({_fit})
SELECT feature, {fx('center', 6)} AS center, {fx('CASE WHEN r = 0 THEN 1 ELSE r END', 6)} AS scale, {fx('raw_med', 6)} AS median_amount FROM q, m"""
_fit34 = ", ".join(
    f"quantile_cont({c}, 0.5) AS m_{c}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS r_{c}" for c in _made34
)
SQL["p04_fitted_pipeline"] = f"""{_made}, q AS (SELECT {_fit34} FROM f WHERE row_id % 5 <> 0)
SELECT row_id, {', '.join(f'{fx(f"({c} - m_{c}) / CASE WHEN r_{c} = 0 THEN 1 ELSE r_{c} END", 6)} AS "{c}"' for c in _made34)} FROM f, q"""
SQL["p05_smote_counts"] = f"""{WITH_RAW},
c AS (SELECT sum("Class") AS minority, sum(1 - "Class") AS majority FROM raw0)
SELECT 0 AS class, 0 AS synthetic, {big('majority')} AS transactions FROM c
UNION ALL SELECT 1, 0, {big('minority')} FROM c
UNION ALL SELECT 1, 1, {big('floor(majority * 0.5) - minority')} FROM c"""
SQL["p06_class_weights"] = f"""{WITH_RAW}, c AS (SELECT "Class" AS class, count(*) AS n FROM raw0 GROUP BY 1)
SELECT class, {fx('sum(n) OVER () / (2.0E0 * n)', 8)} AS weight, n AS transactions FROM c"""

# Explanation

_lin = f"""{WITH_RAW},
s AS (SELECT {', '.join(f'avg({v}) AS m_{v}, avg({v}) FILTER (WHERE "Class" = 1) - avg({v}) FILTER (WHERE "Class" = 0) AS w_{v}' for v in V)} FROM raw0),
l AS ({' UNION ALL '.join(f"SELECT row_id, {i} AS i, '{v}' AS feature, w_{v} * ({v} - m_{v}) AS c FROM raw0, s" for i, v in enumerate(V))})"""
SQL["x01_linear_factors"] = f"""{_lin},
r AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY c DESC, i) - 1 AS place FROM l)
SELECT row_id, CAST(place AS INTEGER) AS place, feature,
  CASE WHEN c > 0 THEN 'Increases Fraud Risk' ELSE 'Reduces Fraud Risk' END AS impact, {fx('abs(c)', 4)} AS weight
FROM r WHERE place < 4"""
SQL["x03_global_importance"] = f"""{_lin} SELECT feature, {fx('avg(abs(c))', 6)} AS mean_abs_contribution FROM l
GROUP BY feature ORDER BY avg(abs(c)) DESC, feature LIMIT 15"""

# Evaluation


def cells(t: float) -> str:
    return (
        f"count(*) FILTER (WHERE y = 1 AND p >= {t}) AS tp, count(*) FILTER (WHERE y = 0 AND p >= {t}) AS fp,"
        f" count(*) FILTER (WHERE y = 1 AND p < {t}) AS fn, count(*) FILTER (WHERE y = 0 AND p < {t}) AS tn"
    )


P_, R_ = "coalesce(tp / nullif(tp + fp, 0), 0)", "coalesce(tp / nullif(tp + fn, 0), 0)"
F1_ = f"coalesce(2 * {P_} * {R_} / nullif({P_} + {R_}, 0), 0)"
METRICS = (
    f"{fx('coalesce((tp + tn) / nullif(tp + fp + fn + tn, 0), 0)', 4)} AS accuracy,"
    f" {fx(P_, 4)} AS precision, {fx(R_, 4)} AS recall, {fx(F1_, 4)} AS f1"
)
SQL["e01_classification_metrics"] = f"{LABELLED}, c AS (SELECT {cells(0.35)} FROM lab) SELECT {METRICS} FROM c"
CURVE = f"""{LABELLED},
g AS (SELECT p, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg FROM lab GROUP BY p),
k AS (SELECT *, sum(pos) OVER (ORDER BY p DESC) AS tp, sum(neg) OVER (ORDER BY p DESC) AS fp,
        sum(pos) OVER () AS ap, sum(neg) OVER () AS an FROM g)"""
SQL["e02_roc_auc"] = f"{CURVE} SELECT {fx('sum(neg * (tp - pos / 2.0E0)) / max(CAST(ap AS DOUBLE) * an)', 8)} AS roc_auc FROM k"
SQL["e03_average_precision"] = f"{CURVE} SELECT {fx('sum(CAST(pos AS DOUBLE) * tp / (tp + fp)) / max(ap)', 8)} AS pr_auc FROM k"
SQL["e04_confusion_matrix"] = f"""{LABELLED},
a AS (SELECT y, CASE WHEN p >= 0.35 THEN 1 ELSE 0 END AS z FROM lab),
g AS (SELECT * FROM (VALUES (0), (1)) AS s(y), (VALUES (0), (1)) AS t(z)),
n AS (SELECT g.y, g.z, count(a.y) AS n FROM g LEFT JOIN a ON a.y = g.y AND a.z = g.z GROUP BY 1, 2)
SELECT y AS actual, z AS predicted, n AS transactions, {fx('100.0E0 * n / nullif(sum(n) OVER (PARTITION BY y), 0)', 6)} AS row_percent FROM n"""
_pt, _rt = "tp / greatest(1, tp + fp)", "tp / greatest(1, tp + fn)"
SQL["e05_threshold_tradeoffs"] = f"""{LABELLED},
c AS ({' UNION ALL '.join(f'SELECT CAST({t} AS DOUBLE) AS threshold, {cells(t)} FROM lab' for t in (0.2, 0.3, 0.35, 0.4, 0.5, 0.6, 0.7))})
SELECT threshold, {fx(_pt, 4)} AS precision, {fx(_rt, 4)} AS recall,
  {fx(f'2 * (({_pt}) * ({_rt})) / greatest(1e-6, ({_pt}) + ({_rt}))', 4)} AS f1, tp, fp, fn, tn FROM c"""
SQL["s04_report_table"] = SQL["e05_threshold_tradeoffs"]
SQL["e06_classification_report"] = f"""{LABELLED}, c AS (SELECT {cells(0.35)} FROM lab),
h AS (SELECT 'Legitimate' AS line, coalesce(tn / nullif(tn + fn, 0), 0) AS pr, coalesce(tn / nullif(tn + fp, 0), 0) AS re, tn + fp AS n FROM c
  UNION ALL SELECT 'Fraudulent', coalesce(tp / nullif(tp + fp, 0), 0), coalesce(tp / nullif(tp + fn, 0), 0), tp + fn FROM c),
f AS (SELECT *, coalesce(2 * pr * re / nullif(pr + re, 0), 0) AS f1 FROM h)
SELECT line, {fx('pr', 4)} AS precision, {fx('re', 4)} AS recall, {fx('f1', 4)} AS f1_score, n AS support FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, {fx('(tp + tn) / (tp + fp + fn + tn)', 4)}, tp + fp + fn + tn FROM c
UNION ALL SELECT 'macro avg', {fx('avg(pr)', 4)}, {fx('avg(re)', 4)}, {fx('avg(f1)', 4)}, {big('sum(n)')} FROM f
UNION ALL SELECT 'weighted avg', {fx('sum(pr*n)/sum(n)', 4)}, {fx('sum(re*n)/sum(n)', 4)}, {fx('sum(f1*n)/sum(n)', 4)}, {big('sum(n)')} FROM f"""
SQL["s05_classification_report_file"] = SQL["e06_classification_report"]
SQL["e07_roc_points"] = f"""{CURVE} SELECT p AS threshold, {fx('fp / an', 8)} AS fpr, {fx('tp / ap', 8)} AS tpr FROM k
UNION ALL SELECT CAST('Infinity' AS DOUBLE), 0.0E0, 0.0E0"""
SQL["e08_pr_points"] = f"""{CURVE} SELECT p AS threshold, {fx('tp / (tp + fp)', 8)} AS precision, {fx('tp / ap', 8)} AS recall,
  {fx('ap / (ap + an)', 8)} AS baseline FROM k
UNION ALL SELECT NULL, 1.0E0, 0.0E0, {fx('sum(pos) / sum(pos + neg)', 8)} FROM g"""
SQL["e10_full_metrics_by_band"] = f"""{LABELLED}, c AS (SELECT predicted_class, {cells(0.5)} FROM lab GROUP BY 1),
g AS (SELECT predicted_class AS b, p, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg FROM lab GROUP BY 1, 2),
k AS (SELECT *, sum(pos) OVER (PARTITION BY b ORDER BY p DESC) AS tp, sum(neg) OVER (PARTITION BY b ORDER BY p DESC) AS fp FROM g),
z AS (SELECT b, sum(neg * (tp - pos / 2.0E0)) / nullif(sum(pos) * sum(neg), 0) AS roc,
        sum(CAST(pos AS DOUBLE) * tp / (tp + fp)) / nullif(sum(pos), 0) AS pr FROM k GROUP BY b)
SELECT predicted_class, {METRICS}, {fx('roc', 4)} AS roc_auc, {fx('pr', 4)} AS pr_auc FROM c JOIN z ON b = predicted_class"""

# Reports

FRAUD = "predicted_class = 'FRAUD'"
NF = f"count(*) FILTER (WHERE {FRAUD})"
FA = f"CAST(round(coalesce(sum(CAST(CASE WHEN {FRAUD} THEN amount ELSE 0 END AS DECIMAL(20,6))), 0), 2) AS DOUBLE)"
SQL["q01_total_transactions"] = f"{TX} SELECT count(*) AS total_transactions FROM tx"
SQL["q02_fraud_transactions"] = f"{TX} SELECT count(*) AS total_fraud_transactions FROM tx WHERE {FRAUD}"
SQL["q03_legitimate_transactions"] = f"{TX} SELECT count(*) AS total_legitimate_transactions FROM tx WHERE predicted_class = 'LEGITIMATE'"
SQL["q04_fraud_rate"] = f"""{TX} SELECT count(*) AS total_transactions, {NF} AS fraud_transactions,
  {fx(f'100.0E0 * {NF} / nullif(count(*), 0)', 4)} AS fraud_rate_percentage FROM tx"""
SQL["q05_fraud_exposure"] = f"{TX} SELECT {money('amount')} AS total_fraud_exposure_amount FROM tx WHERE {FRAUD}"
SQL["q06_amounts_by_class"] = f"""{TX} SELECT predicted_class, count(*) AS transaction_count,
  {fx(f'CAST({dsum("amount")} AS DOUBLE) / count(amount)', 2)} AS avg_amount, {fx('min(amount)', 2)} AS min_amount,
  {fx('max(amount)', 2)} AS max_amount, {fx('stddev_samp(amount)', 2)} AS std_amount FROM tx GROUP BY 1"""
SQL["q07_risk_tiers"] = f"""{TX} SELECT risk_level, count(*) AS volume,
  {fx('100.0E0 * count(*) / sum(count(*)) OVER ()', 2)} AS pct_of_total_volume, {money('amount')} AS total_amount,
  {fx(f'CAST({dsum("fraud_probability")} AS DOUBLE) / count(*)', 4)} AS avg_fraud_probability, {NF} AS fraud_count
FROM tx GROUP BY 1 ORDER BY CASE risk_level WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'LOW' THEN 3 ELSE 4 END"""
SQL["q08_fraud_by_hour"] = f"""{TX} SELECT CAST(floor((transaction_time / 3600) % 24) AS INTEGER) AS hour_of_day,
  count(*) AS total_hourly_volume, {NF} AS fraud_count, {fx(f'100.0E0 * {NF} / count(*)', 3)} AS hourly_fraud_rate_pct,
  {FA} AS fraud_amount FROM tx GROUP BY 1 ORDER BY 1"""
_shown = f"transaction_id, amount, fraud_probability, risk_score, risk_level, {ISO}"
SQL["q09_triage_queue"] = f"""{TX}, t AS (SELECT * FROM tx WHERE risk_level = 'HIGH' AND amount > 100
  ORDER BY fraud_probability DESC, amount DESC, transaction_id LIMIT 50) SELECT {_shown} FROM t"""
SQL["q10_daily_trend"] = f"""{TX}, d AS (SELECT CAST(created_at AS DATE) AS tx_date, count(*) AS daily_volume,
  {NF} AS daily_fraud_count, {FA} AS daily_fraud_amount FROM tx GROUP BY 1)
SELECT *, lag(daily_fraud_count) OVER (ORDER BY tx_date) AS prev_day_fraud,
  daily_fraud_count - coalesce(lag(daily_fraud_count) OVER (ORDER BY tx_date), 0) AS dod_fraud_change FROM d ORDER BY tx_date DESC"""


def monthly(ctes: str) -> str:
    return f"""{ctes} SELECT strftime(created_at, '%Y-%m') AS report_month, count(*) AS total_transactions,
  {NF} AS fraud_count, {fx(f'100.0E0 * {NF} / count(*)', 4)} AS fraud_incidence_rate, {FA} AS total_fraud_amount
FROM tx GROUP BY 1 ORDER BY 1 DESC"""


SQL["q11_monthly_trend"] = monthly(TX)
SQL["q11_monthly_trend_of_orders"] = monthly(
    "WITH o AS (SELECT o_orderkey AS event_id, o_totalprice AS value, o_orderdate AS ts, o_orderstatus AS event_type FROM orders), "
    + tx_ctes("o")
)
SQL["q12_top_suspicious"] = f"""{TX}, r AS (SELECT *, dense_rank() OVER (PARTITION BY risk_level
  ORDER BY fraud_probability DESC, amount DESC) AS tier_rank FROM tx)
SELECT CAST(tier_rank AS INTEGER) AS tier_rank, {_shown} FROM r WHERE tier_rank <= 10"""
SQL["q13_probability_deciles"] = f"""{TX} SELECT {DECILE} AS probability_bin, count(*) AS transaction_count,
  {fx('100.0E0 * count(*) / sum(count(*)) OVER ()', 2)} AS pct_of_total, {NF} AS confirmed_fraud_count,
  {fx(f'CAST({dsum("amount")} AS DOUBLE) / count(amount)', 2)} AS avg_amount FROM tx GROUP BY 1 ORDER BY 1"""
SQL["e09_calibration"] = SQL["q13_probability_deciles"]

# Reads and writes

SQL["k02_get_by_id"] = f"{TX} SELECT {RECORD} FROM tx WHERE transaction_id = 'TX_211'"
SQL["k03_list_newest"] = f"{TX}, t AS (SELECT * FROM tx ORDER BY created_at DESC, id LIMIT 500) SELECT {RECORD} FROM t"
SQL["k03_list_band_page"] = f"""{TX}, t AS (SELECT * FROM tx WHERE risk_level = 'MEDIUM'
  ORDER BY created_at DESC, id LIMIT 50 OFFSET 20) SELECT {RECORD} FROM t"""
SQL["k04_high_risk"] = f"""{TX}, t AS (SELECT * FROM tx WHERE risk_level = 'HIGH'
  ORDER BY fraud_probability DESC, id LIMIT 200) SELECT {RECORD} FROM t"""


def summary(select: str, tail: str) -> str:
    return f"""SELECT {select} count(*) AS total_transactions, {NF} AS fraud_transactions,
  count(*) - {NF} AS legitimate_transactions, {fx(f'coalesce(100.0E0 * {NF} / nullif(count(*), 0), 0)', 2)} AS fraud_rate_pct,
  {FA} AS total_fraud_exposure_amount,
  {fx(f'coalesce(CAST({dsum("amount")} AS DOUBLE) / nullif(count(amount), 0), 0)', 2)} AS avg_transaction_amount,
  count(*) FILTER (WHERE risk_level = 'LOW') AS risk_low, count(*) FILTER (WHERE risk_level = 'MEDIUM') AS risk_medium,
  count(*) FILTER (WHERE risk_level = 'HIGH') AS risk_high FROM tx {tail}"""


SQL["k05_fraud_summary"] = f"{TX} {summary('', '')}"
_again = "again AS (SELECT event_id, ts, user_id, event_type, value + 1 AS value, props FROM events WHERE event_type = 'error')"


def upserted(label: str) -> str:
    return f"""WITH {_again}, {tx_ctes()}, {tx_ctes('again', 'r_')}
SELECT tx.id, tx.transaction_id, tx.transaction_time, coalesce(r.amount, tx.amount) AS amount,
  {label} AS actual_class, tx.predicted_class, tx.fraud_probability, tx.risk_score, tx.risk_level,
  {ISO.replace('created_at', 'tx.created_at', 3).replace('AS tx.created_at', 'AS created_at')}
FROM tx LEFT JOIN r_tx r ON r.id = tx.id"""


SQL["k01_upsert"] = upserted("CASE WHEN r.id IS NULL THEN tx.actual_class END")
SQL["k01_upsert_keep_label"] = upserted("tx.actual_class")
SQL["k01_snapshot_reader"] = f"""WITH kept AS (SELECT * FROM events WHERE event_type <> 'purchase'), {tx_ctes('kept', 'k_')}
SELECT {RECORD} FROM k_tx"""
SQL["k02_point_lookup"] = SQL["k02_get_by_id"]

# Measures and charts

_tp = f"count(*) FILTER (WHERE {FRAUD} AND actual_class = 1)"
_fp = f"count(*) FILTER (WHERE {FRAUD} AND actual_class = 0)"
_act = "count(*) FILTER (WHERE actual_class = 1)"
_high = "count(*) FILTER (WHERE risk_level = 'HIGH')"
_famt = f"CASE WHEN {FRAUD} THEN amount END"


def safe(a: str, b: str) -> str:
    return fx(f"coalesce(({a}) / nullif({b}, 0), 0)", 8)


MEASURES = f"""count(*) AS total_transactions, {NF} AS fraud_transactions,
  count(*) FILTER (WHERE predicted_class = 'LEGITIMATE') AS legitimate_transactions, {safe(NF, 'count(*)')} AS fraud_rate,
  {money(_famt)} AS fraud_amount, {money('amount')} AS total_transaction_value,
  {fx(f'CAST({dsum("amount")} AS DOUBLE) / nullif(count(amount), 0)', 6)} AS average_transaction_amount,
  {fx(f'CAST({dsum(_famt)} AS DOUBLE) / nullif(count({_famt}), 0)', 6)} AS average_fraud_amount,
  {_high} AS high_risk_transactions, count(*) FILTER (WHERE risk_level = 'MEDIUM') AS medium_risk_transactions,
  count(*) FILTER (WHERE risk_level = 'LOW') AS low_risk_transactions, {safe(_high, 'count(*)')} AS high_risk_rate,
  {_tp} AS true_positives, {_fp} AS false_positives, {safe(_tp, f'{_tp} + {_fp}')} AS operational_precision,
  {_act} AS actual_fraud_count, {safe(_tp, _act)} AS operational_recall"""
HOUR = "CAST(floor((transaction_time / 3600) % 24) AS INTEGER)"
SQL["d01_d17_measures"] = f"{TX} SELECT {MEASURES} FROM tx"
SQL["d01_d17_measures_by_risk_level"] = f"{TX} SELECT risk_level, {MEASURES} FROM tx GROUP BY risk_level"
SQL["d01_d17_measures_sliced_by_hour"] = f"""{TX} SELECT {HOUR} AS hour_of_day, {MEASURES} FROM tx
WHERE risk_level IN ('HIGH', 'MEDIUM') GROUP BY 1"""
_ds = f"""{TX}, ds AS (SELECT transaction_id AS "Transaction_ID", transaction_time AS "Transaction_Time_Seconds",
  {HOUR} AS "Hour_of_Day", CAST(CAST(amount AS DECIMAL(18,2)) AS DOUBLE) AS "Amount", actual_class AS "Actual_Class",
  {LABEL_TEXT} AS "Actual_Label", predicted_class AS "Prediction", fraud_probability AS "Fraud_Probability",
  risk_score AS "Risk_Score", risk_level AS "Risk_Level" FROM tx)"""
SQL["d18_reporting_dataset"] = f"{_ds} SELECT * FROM ds"
SQL["d19_hourly_fraud"] = f"{TX} SELECT {HOUR} AS hour_of_day, {NF} AS fraud_transactions, {safe(NF, 'count(*)')} AS fraud_rate FROM tx GROUP BY 1"
SQL["d20_volume_by_prediction"] = f"{TX} SELECT predicted_class, count(*) AS total_transactions FROM tx GROUP BY 1"
SQL["d21_amount_by_risk_level"] = f"{TX} SELECT risk_level, {money('amount')} AS total_amount FROM tx GROUP BY 1"
SQL["d22_amount_range_by_risk_level"] = f"{TX} SELECT {RANGE} AS amount_range, risk_level, count(*) AS transactions FROM tx GROUP BY 1, 2"
SQL["d23_fraud_by_amount_range"] = f"{TX} SELECT {RANGE} AS amount_range, count(*) AS fraud_transactions FROM tx WHERE {FRAUD} GROUP BY 1"
SQL["d24_probability_scatter"] = f"{TX} SELECT amount, fraud_probability, risk_level FROM tx"
SQL["d25_triage_table"] = f"""{_ds} SELECT "Transaction_ID", "Amount", "Fraud_Probability", "Risk_Score" FROM ds WHERE "Risk_Level" = 'HIGH'
ORDER BY "Fraud_Probability" DESC, "Transaction_ID" """
SQL["d26_surveillance_table"] = f'{_ds} SELECT * EXCLUDE ("Actual_Class", "Actual_Label") FROM ds'

# Exploration over raw transactions

SQL["a01_hourly_labels"] = f"""{WITH_RAW} SELECT CAST(floor(("Time" / 3600) % 24) AS INTEGER) AS hour, count(*) AS total,
  {big('sum("Class")')} AS fraud, {fx('100.0E0 * sum("Class") / count(*)', 6)} AS fraud_rate_pct FROM raw0 GROUP BY 1"""
SQL["a02_amount_histogram"] = f"""{WITH_RAW},
e AS (SELECT "Class" AS c, log10(min("Amount")) AS lo, (log10(max("Amount")) - log10(min("Amount"))) / 50 AS w FROM raw0 WHERE "Amount" > 0 GROUP BY 1),
b AS (SELECT c AS "Class", lo, w, CAST(least(floor((log10("Amount") - lo) / w), 49) AS INTEGER) AS bin FROM raw0 JOIN e ON c = "Class" WHERE "Amount" > 0)
SELECT "Class", bin, {fx('pow(10, lo + bin * w)', 6)} AS bin_start, {fx('pow(10, lo + (bin + 1) * w)', 6)} AS bin_end, count(*) AS transactions
FROM b GROUP BY "Class", bin, lo, w"""
SQL["a03_class_densities"] = f"""{WITH_RAW},
l AS ({' UNION ALL '.join(f"SELECT '{f}' AS feature, Class AS c, {f} AS x FROM raw0" for f in ('V14', 'V17', 'V12', 'V4'))}),
s AS (SELECT feature, c, count(*) AS n, stddev_samp(x) * pow(count(*), -0.2) AS h, min(x) AS lo, max(x) AS hi FROM l GROUP BY 1, 2),
g AS (SELECT feature, c, n, h, CAST(i AS INTEGER) AS point, lo - 3*h + i * ((hi + 3*h) - (lo - 3*h)) / 199 AS gx FROM s, range(200) AS r(i))
SELECT feature, c AS "Class", point, {fx('gx', 6)} AS x, {fx('sum(exp(-0.5*((gx - x)/h)*((gx - x)/h))) / (n * h * sqrt(2*pi()))', 6)} AS density
FROM g JOIN l USING (feature, c) GROUP BY feature, c, point, gx, n, h"""
SQL["a04_amount_facts"] = f"""{WITH_RAW} SELECT "Class", count(*) AS transactions, {fx('quantile_cont("Amount", 0.5)', 6)} AS median_amount,
  {fx('100.0E0 * count(*) FILTER (WHERE "Amount" < 2) / count(*)', 6)} AS pct_under_2,
  {fx('100.0E0 * count(*) FILTER (WHERE "Amount" > 1000) / count(*)', 6)} AS pct_over_1000 FROM raw0 GROUP BY 1"""

# Streams

SQL["t02_ingest_last_wins"] = f"""WITH {_again}, {tx_ctes()}, {tx_ctes('again', 'r_')},
m AS (SELECT tx.* REPLACE (coalesce(r.amount, tx.amount) AS amount) FROM tx LEFT JOIN r_tx r ON r.id = tx.id)
SELECT {RECORD} FROM m"""
SQL["t02_ingest_first_wins"] = f"{TX} SELECT id, transaction_id, amount, risk_level FROM tx"
SQL["t03_daily_summary"] = f"{TX} {summary('CAST(created_at AS DATE) AS window_start,', 'GROUP BY 1')}"
SQL["t04_high_risk_alerts"] = f"{TX} SELECT {RECORD} FROM tx WHERE risk_level = 'HIGH'"
_psi = " UNION ALL ".join(
    f"""SELECT '{f}' AS feature, old, len(list_filter(edges, lambda e: x > e)) AS bin FROM
  (SELECT "Time" < 86400 AS old, {f} AS x FROM raw0),
  (SELECT [{', '.join(f'quantile_cont({f}, {i / 10})' for i in range(1, 10))}] AS edges FROM raw0 WHERE "Time" < 86400)"""
    for f in FEATURES29
)
SQL["t05_feature_drift"] = f"""{WITH_RAW}, b AS ({_psi}),
k AS (SELECT feature, bin, count(*) FILTER (WHERE old) AS e, count(*) FILTER (WHERE NOT old) AS a FROM b GROUP BY 1, 2),
s AS (SELECT feature, greatest(e / sum(e) OVER w, 0.0001) AS e, greatest(a / sum(a) OVER w, 0.0001) AS a FROM k WINDOW w AS (PARTITION BY feature)),
z AS (SELECT feature, sum((a - e) * ln(a / e)) AS psi FROM s GROUP BY 1)
SELECT feature, {fx('psi', 6)} AS psi, CASE WHEN psi > 0.25 THEN 1 ELSE 0 END AS alert FROM z"""

# Invariants of fitted models, whose values SQL cannot state

SQL["s06_s07_saved_model"] = "SELECT vec_id AS row_id, 1::INTEGER AS same_as_saved FROM embeddings"
SQL["m07_scored_transactions"] = """SELECT vec_id AS row_id, 0.35::DOUBLE AS threshold_applied, 1::INTEGER AS label_follows,
  1::INTEGER AS band_follows, 1::INTEGER AS score_follows, 4::BIGINT AS factors FROM embeddings"""
SQL["x01_tree_factors"] = """SELECT m.model, vec_id AS row_id, 1::INTEGER AS adds_up
FROM embeddings, (VALUES ('Decision Tree'), ('Random Forest'), ('Gradient Boosted Trees')) m(model)"""
SQL["x02_importance_factors"] = "SELECT vec_id AS row_id, 1::INTEGER AS largest_first, 4::BIGINT AS factors FROM embeddings"
SQL["m05_metrics_agree"] = """SELECT model, 1::INTEGER AS accuracy, 1::INTEGER AS "precision", 1::INTEGER AS recall, 1::INTEGER AS f1,
  1::INTEGER AS roc_auc FROM (VALUES ('Logistic Regression'), ('Decision Tree')) m(model)"""
_metrics = f"""{LABELLED}, c AS (SELECT {cells(0.35)} FROM lab) SELECT {METRICS} FROM c"""
SQL["e10_evaluation_run"] = f"""SELECT 'metrics' AS section, name, value FROM (
  UNPIVOT (SELECT m.*, round(r.roc_auc, 4) AS roc_auc, round(a.pr_auc, 4) AS pr_auc FROM ({SQL['e01_classification_metrics']}) m,
    ({SQL['e02_roc_auc']}) r, ({SQL['e03_average_precision']}) a) ON COLUMNS(*) INTO NAME name VALUE value)
UNION ALL SELECT 'confusion_matrix', actual || '/' || predicted, CAST(transactions AS DOUBLE) FROM ({SQL['e04_confusion_matrix']})
UNION ALL SELECT 'threshold_tradeoffs', printf('%.2f', threshold), f1 FROM ({SQL['e05_threshold_tradeoffs']})
UNION ALL SELECT 'points', 'roc_points', CAST(count(*) AS DOUBLE) FROM ({SQL['e07_roc_points']})
UNION ALL SELECT 'points', 'pr_points', CAST(count(*) AS DOUBLE) FROM ({SQL['e08_pr_points']})"""
_arrival = """arrived AS (SELECT *, event_id % 50 = 0 AND ts < TIMESTAMP '2024-01-11' AS held,
  CASE WHEN ts < TIMESTAMP '2024-01-11' AND event_id % 50 <> 0 THEN 1 WHEN ts < TIMESTAMP '2024-01-21' THEN 2 ELSE 3 END AS batch FROM events),
reached AS (SELECT max(ts) - INTERVAL 1 DAY AS last, max(ts) FILTER (WHERE batch = 1) - INTERVAL 1 DAY AS first FROM arrived),
timed AS (SELECT arrived.*, batch > 1 AND date_trunc('day', ts) + INTERVAL 1 DAY <= first AS late FROM arrived, reached),
kept AS (SELECT event_id, ts, user_id, event_type, value, props FROM timed WHERE NOT late),
lost AS (SELECT CAST(ts AS DATE) AS window_start, count(*) AS late_rows FROM timed WHERE late GROUP BY 1)"""
_days = summary("CAST(created_at AS DATE) AS window_start,", "GROUP BY 1").replace("FROM tx", "FROM k_tx")
SQL["t03_closed_windows"] = f"""WITH {_arrival}, {tx_ctes('kept', 'k_')}, days AS ({_days})
SELECT days.*, coalesce(late_rows, 0) AS late_rows FROM days LEFT JOIN lost USING (window_start), reached
WHERE window_start + INTERVAL 1 DAY <= last"""
_week = " UNION ALL ".join(
    f"""SELECT '{f}' AS feature, week, len(list_filter(edges, lambda e: x > e)) AS bin FROM
  (SELECT CAST(date_trunc('week', created_at) AS DATE) AS week, {f} AS x FROM tx),
  (SELECT [{', '.join(f'quantile_cont({f}, {i / 10})' for i in range(1, 10))}] AS edges FROM tx WHERE created_at < TIMESTAMP '2024-01-08')"""
    for f in ("amount", "fraud_probability")
)
SQL["t05_weekly_drift"] = f"""{TX}, b AS ({_week}),
k AS (SELECT week, feature, bin, count(*) AS n FROM b GROUP BY ALL),
base AS (SELECT feature, bin, n / sum(n) OVER (PARTITION BY feature) AS e FROM k WHERE week = DATE '2024-01-01'),
w AS (SELECT DISTINCT week, feature FROM k),
g AS (SELECT w.week, w.feature, bins.bin, coalesce(e, 0) AS e, coalesce(n, 0) AS n FROM w JOIN (SELECT DISTINCT feature, bin FROM k) bins USING (feature)
  LEFT JOIN base ON base.feature = w.feature AND base.bin = bins.bin LEFT JOIN k ON k.week = w.week AND k.feature = w.feature AND k.bin = bins.bin),
s AS (SELECT week, feature, n, greatest(e, 0.0001) AS e, greatest(n / sum(n) OVER (PARTITION BY week, feature), 0.0001) AS a FROM g),
z AS (SELECT week, feature, sum(n) AS transactions, sum((a - e) * ln(a / e)) AS psi FROM s GROUP BY 1, 2)
SELECT week, feature, {big('transactions')} AS transactions, {fx('psi', 6)} AS psi, CASE WHEN psi > 0.25 THEN 1 ELSE 0 END AS alert FROM z"""
