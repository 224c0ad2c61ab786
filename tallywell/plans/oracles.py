"""DuckDB SQL stating what each registered query must return.

Written from the definitions, over the plain base tables; shared definitions
are CTEs put in front.
"""

from __future__ import annotations

# Stated here on their own, so that a wrong name or word in the library shows.
NUMERIC = ["c_acctbal", "tenure", "contract_duration", "revenue", "cost", "late_payments",
           "usage_frequency", "support_calls", "service_click", "service_view",
           "service_purchase", "service_signup"]
CATEGORICAL = ["region", "contract_type", "last_event_type"]
STOP_WORDS = [
    "what", "when", "where", "which", "who", "whom", "whose", "why", "how", "a", "an", "the", "is", "are",
    "was", "were", "be", "been", "being", "in", "on", "at", "by", "for", "with", "about", "against",
    "between", "into", "through", "during", "before", "after", "above", "below", "to", "from", "up", "down",
    "of", "off", "over", "under", "again", "further", "then", "once", "here", "there", "all", "any", "both",
    "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not", "only", "own", "same", "so",
    "than", "too", "very", "can", "will", "just", "should", "now",
]

CF = """
line_cost AS (
  SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount)) AS line_cost FROM lineitem GROUP BY 1),
past AS (
  SELECT o_custkey, count(*) AS n_past,
         date_diff('day', min(o_orderdate), max(o_orderdate)) // 30 AS tenure,
         count(DISTINCT strftime(o_orderdate, '%Y-%m')) AS contract_duration,
         round(sum(o_totalprice), 2) AS revenue, round(sum(line_cost), 4) AS cost,
         least(5, count(*) FILTER (WHERE o_orderstatus = 'P')) AS late_payments
  FROM orders LEFT JOIN line_cost ON o_orderkey = l_orderkey
  WHERE o_orderdate < TIMESTAMP '2000-08-01' GROUP BY 1),
later AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2000-08-01'),
ev AS (
  SELECT user_id, count(*) AS usage_frequency, count(*) FILTER (WHERE event_type = 'error') AS support_calls,
         max(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS service_click,
         max(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS service_view,
         max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS service_purchase,
         max(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS service_signup
  FROM events GROUP BY 1),
ev_last AS (
  SELECT user_id, event_type AS last_event_type FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
cf AS MATERIALIZED (
  SELECT c_custkey AS customer_id, r_name AS region,
         CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'Annual' WHEN 'MACHINERY' THEN 'Two-year'
              WHEN 'AUTOMOBILE' THEN 'Monthly' WHEN 'BUILDING' THEN 'Monthly'
              WHEN 'FURNITURE' THEN 'Monthly' END AS contract_type,
         c_acctbal, tenure, contract_duration, revenue, cost, late_payments,
         usage_frequency, support_calls, service_click, service_view, service_purchase, service_signup,
         last_event_type,
         CASE WHEN later.o_custkey IS NULL THEN 1 ELSE 0 END AS "Churn"
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN past ON c_custkey = past.o_custkey LEFT JOIN later ON c_custkey = later.o_custkey
  LEFT JOIN ev ON c_custkey = ev.user_id LEFT JOIN ev_last ON c_custkey = ev_last.user_id)"""

# Rule terms, then score, prediction and the learnable label.
SC = CF + """,
terms AS MATERIALIZED (
  SELECT *,
    CASE contract_type WHEN 'Monthly' THEN 0.15::DOUBLE WHEN 'Annual' THEN 0.05::DOUBLE
         WHEN 'Two-year' THEN 0.02::DOUBLE ELSE 0::DOUBLE END AS t_contract,
    0.05::DOUBLE * coalesce(coalesce(support_calls, 0)::DOUBLE / nullif(coalesce(tenure, 0), 0), 0) AS t_calls,
    0.05::DOUBLE * (4 - coalesce(service_click, 0) - coalesce(service_view, 0)
                      - coalesce(service_purchase, 0) - coalesce(service_signup, 0)) AS t_services,
    0.08::DOUBLE * coalesce(late_payments, 0) AS t_late,
    CASE WHEN coalesce(tenure, 0) <= 6 THEN 0.1::DOUBLE WHEN tenure <= 12 THEN 0.05::DOUBLE
         ELSE 0.02::DOUBLE END AS t_tenure
  FROM cf),
sc AS MATERIALIZED (
  SELECT *, CASE WHEN rule_score >= 0.5 THEN 1 ELSE 0 END AS pred,
         CASE WHEN rule_score >= 0.6 THEN 1 ELSE 0 END AS label_sig,
         CASE WHEN rule_score > 0 AND rule_score <= 0.3 THEN 'Low Risk'
              WHEN rule_score > 0.3 AND rule_score <= 0.7 THEN 'Medium Risk'
              WHEN rule_score > 0.7 AND rule_score <= 1 THEN 'High Risk' END AS risk_category
  FROM (SELECT *, round(greatest(0.01, least(0.9, 0.1 + t_contract + t_calls + t_services + t_late + t_tenure)), 6)
               AS rule_score FROM terms))"""

ENGINEERED = {
    "usage_per_month": "usage_frequency::DOUBLE / nullif(contract_duration, 0)",
    "margin": "revenue - cost",
    "margin_percentage": "(revenue - cost) / nullif(revenue, 0) * 100",
    "tenure_group": """CASE WHEN tenure > 36 THEN '3+ years' WHEN tenure > 24 THEN '2-3 years'
        WHEN tenure > 12 THEN '1-2 years' WHEN tenure > 6 THEN '6-12 months'
        WHEN tenure > 0 THEN '0-6 months' END""",
    "total_services": """(coalesce(service_click, 0) + coalesce(service_view, 0)
        + coalesce(service_purchase, 0) + coalesce(service_signup, 0))::BIGINT""",
    "support_calls_per_month": "support_calls::DOUBLE / nullif(tenure, 0)",
}

CF_COLUMNS = ["customer_id", "region", "contract_type", "c_acctbal", "tenure", "contract_duration",
              "revenue", "cost", "late_payments", "usage_frequency", "support_calls", "service_click",
              "service_view", "service_purchase", "service_signup", "last_event_type", "Churn"]
LINE_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def q(c: str) -> str:
    return f'"{c}"'


def each(columns, template: str) -> str:
    """``template`` once per column, stacked; ``{c}`` is the quoted name."""
    return "\nUNION ALL\n".join(template.format(c=q(c), name=c) for c in columns)


def cf(body: str) -> str:
    return f"WITH {CF}\n{body}"


def sc(body: str) -> str:
    return f"WITH {SC}\n{body}"


def feature(name: str) -> str:
    return cf(f"SELECT customer_id, {ENGINEERED[name]} AS {name} FROM cf")


MISSING = """SELECT '{name}' AS column_name, count(*) - count({c}) AS missing,
  round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 6) AS missing_pct FROM cf"""

NUMERIC_PROFILE = """SELECT '{name}' AS column_name, count({c}) AS n, round(avg({c}), 4) AS mean,
  round(stddev_samp({c}), 4) AS std, min({c})::DOUBLE AS "min",
  round(quantile_cont({c}::DOUBLE, 0.25), 6) AS p25, round(quantile_cont({c}::DOUBLE, 0.5), 6) AS p50,
  round(quantile_cont({c}::DOUBLE, 0.75), 6) AS p75, max({c})::DOUBLE AS "max" FROM {table}"""

OUTLIERS = """SELECT '{name}' AS column_name, count(*) FILTER (WHERE x < lo OR x > hi) AS outliers,
  round(count(*) FILTER (WHERE x < lo OR x > hi) * 100.0::DOUBLE / count(*), 6) AS outlier_pct,
  round(any_value(lo), 6) AS lower_bound, round(any_value(hi), 6) AS upper_bound
 FROM (SELECT {c}::DOUBLE AS x FROM {table}),
      (SELECT a - 1.5 * (b - a) AS lo, b + 1.5 * (b - a) AS hi
       FROM (SELECT quantile_cont({c}::DOUBLE, 0.25) AS a, quantile_cont({c}::DOUBLE, 0.75) AS b FROM {table}))"""

SKEW = """SELECT '{name}' AS column_name, round(avg(power(x - m, 3)) / nullif(power(avg(power(x - m, 2)), 1.5), 0), 6) AS skewness
 FROM (SELECT {c}::DOUBLE AS x, avg({c}::DOUBLE) OVER () AS m FROM {table} WHERE {c} IS NOT NULL)"""

CONSTANT = """SELECT '{name}' AS column_name, count(DISTINCT {c}) AS n_distinct,
  round(count(DISTINCT {c}) * 100.0::DOUBLE / count(*), 6) AS distinct_pct FROM {table}
  HAVING count(DISTINCT {c}) * 100.0::DOUBLE / count(*) < 0.1"""

IMBALANCED = """SELECT * FROM (SELECT '{name}' AS column_name, arg_max(v, (k, -rk)) AS dominant_value,
   round(max(k) * 100.0::DOUBLE / sum(k), 6) AS dominant_pct
 FROM (SELECT {c}::VARCHAR AS v, count(*) AS k, row_number() OVER (ORDER BY {c}::VARCHAR) AS rk
       FROM {table} WHERE {c} IS NOT NULL GROUP BY {c}) HAVING count(*) > 0) WHERE dominant_pct > 90"""


def bind(template: str, table: str) -> str:
    return template.replace("{table}", table)


def pair_corr(a: str, b: str, table: str) -> str:
    return f"""SELECT '{a}' AS col_a, '{b}' AS col_b, round(
  (sum(x * y) - sum(x) * sum(y) / count(*))
  / nullif(sqrt(sum(x * x) - sum(x) * sum(x) / count(*)) * sqrt(sum(y * y) - sum(y) * sum(y) / count(*)), 0), 6) AS corr
 FROM (SELECT {q(a)}::DOUBLE - (SELECT avg({q(a)}) FROM {table}) AS x,
              {q(b)}::DOUBLE - (SELECT avg({q(b)}) FROM {table}) AS y
       FROM {table} WHERE {q(a)} IS NOT NULL AND {q(b)} IS NOT NULL)"""


def target_corr(table: str = "cf") -> str:
    return "\nUNION ALL\n".join(
        f"SELECT col_a AS column_name, corr FROM ({pair_corr(c, 'Churn', table)})" for c in NUMERIC)


def dq_parts() -> str:
    parts = [f"SELECT 'missing' AS issue, column_name, 'missing_pct' AS metric, missing_pct AS value "
             f"FROM ({each(CF_COLUMNS, MISSING)}) WHERE missing > 0",
             f"SELECT 'constant', column_name, 'distinct_pct', distinct_pct FROM ({each(CF_COLUMNS, bind(CONSTANT, 'cf'))})"]
    outliers = f"({each(NUMERIC + ['Churn'], bind(OUTLIERS, 'cf'))})"
    for m in ("outliers", "outlier_pct", "lower_bound", "upper_bound"):
        parts.append(f"SELECT 'outliers', column_name, '{m}', {m}::DOUBLE FROM {outliers} WHERE outliers > 0")
    parts.append(f"SELECT 'skewed', column_name, 'skewness', skewness FROM ({each(NUMERIC + ['Churn'], bind(SKEW, 'cf'))}) WHERE abs(skewness) > 1")
    parts.append(f"SELECT 'imbalanced', column_name, 'dominant_pct', dominant_pct FROM ({each(CATEGORICAL, bind(IMBALANCED, 'cf'))})")
    return "\nUNION ALL\n".join(parts)


HIST = """SELECT '{name}' AS column_name, bin, round(lo + bin * width, 4) AS bin_low,
  round(lo + (bin + 1) * width, 4) AS bin_high, "Churn" AS target, count(*) AS n
 FROM (SELECT "Churn", lo, width, CASE WHEN width = 0 THEN 0 ELSE least(19, floor(({c}::DOUBLE - lo) / width))::BIGINT END AS bin
       FROM cf, (SELECT min({c})::DOUBLE AS lo, (max({c})::DOUBLE - min({c})::DOUBLE) / 20 AS width FROM cf)
       WHERE {c} IS NOT NULL) GROUP BY ALL"""

DENSITY = """SELECT '{name}' AS column_name, point, round(lo + point * (hi - lo) / 50, 4) AS x,
  round(sum(k * exp(-0.5 * power((lo + point * (hi - lo) / 50 - (lo + (bin + 0.5) * (hi - lo) / 100)) / h, 2))
       / (n * h * sqrt(2 * pi()))), 9) AS density
 FROM (SELECT lo, hi, n, h, least(99, floor(({c}::DOUBLE - lo) / ((hi - lo) / 100)))::BIGINT AS bin, count(*) AS k
       FROM cf, (SELECT min({c})::DOUBLE AS lo, max({c})::DOUBLE AS hi, count({c}) AS n,
                        stddev_samp({c}) * power(count({c}), -0.2) AS h FROM cf)
       WHERE {c} IS NOT NULL GROUP BY ALL), range(51) AS g(point) GROUP BY lo, hi, n, h, point"""

BOX = """SELECT '{name}' AS column_name, "Churn" AS target, round(p25, 6) AS p25, round(p50, 6) AS p50,
  round(p75, 6) AS p75, min(x) FILTER (WHERE x >= lo AND x <= hi) AS whisker_low,
  max(x) FILTER (WHERE x >= lo AND x <= hi) AS whisker_high,
  count(*) FILTER (WHERE x < lo OR x > hi) AS outliers
 FROM (SELECT "Churn", {c}::DOUBLE AS x FROM cf) JOIN
      (SELECT *, p25 - 1.5 * (p75 - p25) AS lo, p75 + 1.5 * (p75 - p25) AS hi FROM
        (SELECT "Churn", quantile_cont({c}::DOUBLE, 0.25) AS p25, quantile_cont({c}::DOUBLE, 0.5) AS p50,
                quantile_cont({c}::DOUBLE, 0.75) AS p75 FROM cf GROUP BY 1)) USING ("Churn")
 GROUP BY "Churn", p25, p50, p75"""


def tables_and_profile() -> dict[str, str]:
    pairs = [(b, a) for i, a in enumerate(NUMERIC) for b in NUMERIC[i + 1:]]
    freq_top = """SELECT column_name, value, n, rank, n_distinct FROM (
      SELECT column_name, value, n, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS rank,
             count(*) OVER (PARTITION BY column_name) AS n_distinct
      FROM ({freq})) WHERE rank <= 5"""
    freq = ("SELECT '{name}' AS column_name, {c}::VARCHAR AS value, count(*) AS n "
            "FROM {table} WHERE {c} IS NOT NULL GROUP BY 2")
    return {
        "scan_table": cf("SELECT * FROM cf"),
        "scan_corpus": "SELECT doc_id, length(text)::BIGINT AS text_length, md5(text) AS text_md5 FROM documents WHERE text <> ''",
        "scan_pages_raw": "SELECT page_id, length(html)::BIGINT AS text_length, md5(html) AS text_md5 FROM pages WHERE html <> ''",
        "split_features_target": cf('SELECT customer_id, "Churn" AS target FROM cf'),
        **{f"feat_{k}": feature(v) for k, v in {
            "usage_per_month": "usage_per_month", "tenure_group": "tenure_group",
            "total_services": "total_services", "support_per_month": "support_calls_per_month"}.items()},
        "feat_margin": cf(f"SELECT customer_id, {ENGINEERED['margin']} AS margin, "
                          f"{ENGINEERED['margin_percentage']} AS margin_percentage FROM cf"),
        "engineer_features": cf("SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in ENGINEERED.items()) + " FROM cf"),
        "rule_score": sc("SELECT customer_id, rule_score FROM sc"),
        "risk_category": sc("SELECT customer_id, rule_score, risk_category FROM sc"),
        "high_risk_filter": sc("SELECT customer_id, rule_score FROM sc WHERE risk_category = 'High Risk'"),
        "missing_only_filter": cf(f"SELECT * FROM ({each(CF_COLUMNS, MISSING)}) WHERE missing > 0"),
        "bool_target_to_int": cf(f"SELECT * FROM ({target_corr()})"),
        "lump_other": """SELECT p_partkey, CASE WHEN p_name IN (SELECT p_name FROM part WHERE p_name IS NOT NULL
             GROUP BY 1 ORDER BY count(*) DESC, p_name LIMIT 15) THEN p_name ELSE 'Other' END AS p_name_lumped FROM part""",
        "join_topcat_semi": """SELECT p_partkey, p_name FROM part WHERE p_name IN (SELECT p_name FROM part
             GROUP BY 1 ORDER BY count(*) DESC, p_name LIMIT 15)""",
        "concat_columns": cf('SELECT customer_id, ' + ", ".join(f"{ENGINEERED[n]} AS {n}" for n in ENGINEERED)
                             + ', "Churn" FROM cf'),
        "profile_shape": cf("SELECT (SELECT count(*) FROM cf) AS n_rows, count(*) OVER () AS n_columns, * FROM ("
                            + "\nUNION ALL\n".join(
                                f"SELECT '{c}' AS column_name, {i}::BIGINT AS position, '{t}' AS dtype"
                                for i, (c, t) in enumerate(zip(CF_COLUMNS, [
                                    "bigint", "string", "string", "double", "bigint", "bigint", "double", "double",
                                    "bigint", "bigint", "bigint", "int", "int", "int", "int", "string", "int"]))) + ")"),
        "profile_missing": cf(each(CF_COLUMNS, MISSING)),
        "profile_target": cf('SELECT "Churn", count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS pct FROM cf GROUP BY 1'),
        "profile_numeric": cf(each(NUMERIC, bind(NUMERIC_PROFILE, "cf"))),
        "profile_numeric_lineitem": each(LINE_NUMERIC, bind(NUMERIC_PROFILE, "lineitem")),
        "profile_categorical": cf(freq_top.format(freq=each(CATEGORICAL, bind(freq, "cf")))),
        "profile_categorical_orders": freq_top.format(freq=each(
            ["o_orderstatus", "o_orderpriority"], bind(freq, "orders"))),
        "dq_constant_columns": each(["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                                     "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                                     "l_shipdate"], bind(CONSTANT, "lineitem")),
        "dq_outliers_iqr": cf(f"SELECT * FROM ({each(NUMERIC, bind(OUTLIERS, 'cf'))}) WHERE outliers > 0"),
        "dq_outliers_iqr_lineitem": f"SELECT * FROM ({each(LINE_NUMERIC, bind(OUTLIERS, 'lineitem'))}) WHERE outliers > 0",
        "dq_skewness": cf(f"SELECT * FROM ({each(NUMERIC, bind(SKEW, 'cf'))}) WHERE abs(skewness) > 1"),
        "dq_imbalanced": cf(each(CATEGORICAL + ["service_view", "service_signup"], bind(IMBALANCED, "cf"))),
        "dq_report": cf(dq_parts()),
        "correlation_matrix": cf("\nUNION ALL\n".join(pair_corr(a, b, "cf") for a, b in pairs)),
        "target_correlation": cf(target_corr()),
        "crosstab_pct": cf("""SELECT contract_type, round(count(*) FILTER (WHERE "Churn" = 0) * 100.0::DOUBLE / count(*), 6) AS pct_0,
             round(count(*) FILTER (WHERE "Churn" = 1) * 100.0::DOUBLE / count(*), 6) AS pct_1 FROM cf GROUP BY 1"""),
        "category_counts": cf("SELECT region, count(*) AS n FROM cf GROUP BY 1"),
        "histogram_by_class": cf(each(NUMERIC, HIST)),
        "density_curve": cf(f"SELECT * FROM ({each(NUMERIC, DENSITY)}) WHERE density IS NOT NULL AND NOT isnan(density)"),
        "boxplot_stats": cf(each(NUMERIC, BOX)),
        "risk_distribution": sc("""SELECT b.risk_category, count(s.customer_id) AS customers,
             round(count(s.customer_id) * 100.0::DOUBLE / (SELECT count(*) FROM sc), 6) AS pct
             FROM (VALUES ('Low Risk'), ('Medium Risk'), ('High Risk')) b(risk_category)
             LEFT JOIN sc s ON s.risk_category = b.risk_category GROUP BY 1"""),
        "label_rate": cf('SELECT round(avg("Churn") * 100, 6) AS rate_pct FROM cf'),
        "topk_risk": sc("SELECT customer_id, rule_score, risk_category FROM sc WHERE risk_category = 'High Risk' ORDER BY rule_score DESC, customer_id LIMIT 5"),
        "topk_numeric_by_corr": cf(f"SELECT column_name, abs(corr) AS abs_corr FROM ({target_corr()}) ORDER BY 2 DESC NULLS LAST, 1 LIMIT 10"),
        "topk_categorical_by_cardinality": cf("SELECT * FROM (" + each(
            CATEGORICAL, "SELECT '{name}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM cf") + ") ORDER BY 2, 1 LIMIT 10"),
        "sink_csv": sc("SELECT customer_id, contract_type, tenure, revenue, rule_score, risk_category FROM sc"),
        "sink_json_report": cf(each(CF_COLUMNS, MISSING)),
    }


CURVE = """, pts AS (SELECT rule_score AS threshold, count(*) FILTER (WHERE "Churn" = 1) AS tp,
    count(*) FILTER (WHERE "Churn" = 0) AS fp FROM sc GROUP BY 1),
curve AS (SELECT threshold, sum(tp) OVER w AS ctp, sum(fp) OVER w AS cfp,
    sum(tp) OVER () AS p, sum(fp) OVER () AS n FROM pts WINDOW w AS (ORDER BY threshold DESC)),
roc AS (SELECT threshold, cfp::DOUBLE / n AS fpr, ctp::DOUBLE / p AS tpr FROM curve
        UNION ALL SELECT NULL, 0, 0),
pr AS (SELECT threshold, ctp::DOUBLE / p AS recall, ctp::DOUBLE / (ctp + cfp) AS precision FROM curve
       UNION ALL SELECT NULL, 0, 1)"""


def curve(body: str) -> str:
    return f"WITH {SC}{CURVE}\n{body}"


def rank_auc(score: str) -> str:
    """Rank-sum form of the ROC area, independent of any curve."""
    return f"""(SELECT round((sum(r) FILTER (WHERE y = 1) - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / 2.0::DOUBLE)
      / (count(*) FILTER (WHERE y = 1) * count(*) FILTER (WHERE y = 0)), 9)
     FROM (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0::DOUBLE AS r
           FROM (SELECT "Churn" AS y, round({score}, 6) AS s FROM sc)))"""


def evaluation() -> dict[str, str]:
    ranked = """SELECT customer_id, "Churn", row_number() OVER (PARTITION BY "Churn" ORDER BY md5(customer_id::VARCHAR || '|42')) AS r,
        count(*) OVER (PARTITION BY "Churn") AS n FROM cf"""
    return {
        "stratified_split": cf(f'SELECT customer_id, "Churn", (r <= round(0.2::DOUBLE * n))::INT AS is_test FROM ({ranked})'),
        "stratified_kfold": cf(f'SELECT customer_id, "Churn", ((r - 1) * 5 // n)::INT AS fold FROM ({ranked})'),
        "class_weights": cf("""SELECT "Churn", count(*) AS n, round((SELECT count(*) FROM cf)::DOUBLE
             / ((SELECT count(DISTINCT "Churn") FROM cf) * count(*)), 9) AS weight FROM cf GROUP BY 1"""),
        "confusion_matrix": sc("""SELECT l AS label, p AS prediction, count(customer_id) AS n
             FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) g(l, p) LEFT JOIN sc ON "Churn" = l AND pred = p GROUP BY 1, 2"""),
        "classification_metrics": sc("""SELECT round(a, 9) AS accuracy, round(coalesce(pr, 0), 9) AS precision,
             round(coalesce(re, 0), 9) AS recall, round(coalesce(2 * pr * re / nullif(pr + re, 0), 0), 9) AS f1_score
             FROM (SELECT avg(("Churn" = pred)::INT) AS a,
               sum("Churn" * pred)::DOUBLE / nullif(sum(pred), 0) AS pr,
               sum("Churn" * pred)::DOUBLE / nullif(sum("Churn"), 0) AS re FROM sc)"""),
        "roc_curve": curve("SELECT threshold, round(fpr, 9) AS fpr, round(tpr, 9) AS tpr FROM roc"),
        "roc_auc": sc(f"SELECT {rank_auc('rule_score')} AS roc_auc"),
        "pr_curve": curve("SELECT threshold, round(recall, 9) AS recall, round(precision, 9) AS precision FROM pr"),
        "pr_auc": curve("""SELECT round(sum((recall - r0) * (precision + p0) / 2), 9) AS pr_auc FROM (
             SELECT recall, precision, lag(recall) OVER w AS r0, lag(precision) OVER w AS p0 FROM pr
             WINDOW w AS (ORDER BY threshold DESC NULLS FIRST))"""),
        "best_model": sc(f"""SELECT * FROM (
             SELECT 'rule' AS model, 0 AS ordinal, {rank_auc('rule_score')} AS roc_auc
             UNION ALL SELECT 'late_payments', 1, {rank_auc('coalesce(late_payments, 0) / 5.0::DOUBLE')}
             UNION ALL SELECT 'short_tenure', 2, {rank_auc('1.0::DOUBLE / (1 + coalesce(tenure, 0))')})
             ORDER BY roc_auc DESC, ordinal LIMIT 1"""),
    }


QUESTIONS = """q AS (SELECT conv_id || ':' || turn AS query_id, text AS question
    FROM conversations WHERE role = 'user')"""


def chunk_ctes(source: str = "SELECT doc_id, text FROM documents", p: str = "") -> str:
    """Sentence walk per document: each row is the chunk state after a sentence."""
    return f"""{p}pieces AS (SELECT doc_id, list_filter(string_split(regexp_replace(regexp_replace(text, '\\s+$', ''),
    '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: x <> '') AS ss FROM ({source})),
{p}sent AS MATERIALIZED (SELECT doc_id, i, s, length(s) AS len, sum(length(s)) OVER (PARTITION BY doc_id ORDER BY i) AS upto
  FROM (SELECT doc_id, unnest(ss) AS s, generate_subscripts(ss, 1) AS i FROM {p}pieces)),
{p}walk AS (
  SELECT doc_id, i, i AS first, len::BIGINT AS size, NULL::BIGINT AS done_first, NULL::BIGINT AS done_last
  FROM {p}sent WHERE i = 1
  UNION ALL
  SELECT s.doc_id, s.i,
    CASE WHEN w.size + s.len <= 1000 THEN w.first WHEN w.i - w.first >= 3 THEN w.i - 2 ELSE w.first END,
    CASE WHEN w.size + s.len <= 1000 THEN w.size + s.len
         ELSE s.upto - b.upto + b.len + s.i - b.i END::BIGINT,
    CASE WHEN w.size + s.len > 1000 THEN w.first END, CASE WHEN w.size + s.len > 1000 THEN w.i END
  FROM {p}walk w JOIN {p}sent s ON s.doc_id = w.doc_id AND s.i = w.i + 1
  JOIN {p}sent b ON b.doc_id = w.doc_id AND b.i = CASE WHEN w.i - w.first >= 3 THEN w.i - 2 ELSE w.first END),
{p}span AS (
  SELECT doc_id, done_first AS a, done_last AS z FROM {p}walk WHERE done_last IS NOT NULL
  UNION ALL SELECT doc_id, first, i FROM {p}walk QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY i DESC) = 1),
{p}chunk AS MATERIALIZED (
  SELECT doc_id || ':' || pos AS chunk_id, doc_id, pos, text, start_idx, length(text) AS end_idx FROM (
    SELECT span.doc_id, (row_number() OVER (PARTITION BY span.doc_id ORDER BY z)) - 1 AS pos,
           string_agg(s, ' ' ORDER BY i) AS text,
           coalesce(sum(len) FILTER (WHERE i <= z - 200), 0)::BIGINT AS start_idx
    FROM {p}span AS span JOIN {p}sent AS sent ON sent.doc_id = span.doc_id AND i BETWEEN a AND z
    GROUP BY span.doc_id, a, z))"""


CHUNKS = chunk_ctes()

# Token counts, document frequencies and BM25 top five.
BM25 = CHUNKS + "," + QUESTIONS + """,
tok AS MATERIALIZED (SELECT doc_id, pos, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS term FROM chunk),
tf AS MATERIALIZED (SELECT doc_id, pos, term, count(*) AS tf FROM tok GROUP BY ALL),
len AS (SELECT chunk.doc_id, chunk.pos, count(term) AS dl FROM chunk LEFT JOIN tok USING (doc_id, pos) GROUP BY ALL),
corpus AS MATERIALIZED (SELECT count(*) AS n, avg(dl) AS avgdl FROM len),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
raw AS (SELECT term, df, ln(n - df + 0.5::DOUBLE) - ln(df + 0.5::DOUBLE) AS idf FROM df, corpus),
idf AS MATERIALIZED (SELECT term, df, CASE WHEN idf < 0 THEN 0.25::DOUBLE * (SELECT avg(idf) FROM raw) ELSE idf END AS idf FROM raw),
qtok AS (SELECT query_id, unnest(regexp_extract_all(lower(question), '[\\p{L}\\p{N}]+')) AS term FROM q),
qtf AS MATERIALIZED (SELECT query_id, term, count(*) AS qtf FROM qtok GROUP BY ALL),
match AS (SELECT query_id, doc_id, pos,
    sum(qtf * idf * tf * 2.5::DOUBLE / (tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avgdl))) AS score
  FROM qtf JOIN idf USING (term) JOIN tf USING (term) JOIN len USING (doc_id, pos), corpus GROUP BY ALL),
hits AS MATERIALIZED (
  SELECT query_id, doc_id, pos, round(coalesce(score, 0), 6) AS score,
         row_number() OVER (PARTITION BY query_id ORDER BY round(coalesce(score, 0), 10) DESC, doc_id, pos) AS rank
  FROM q CROSS JOIN chunk LEFT JOIN match USING (query_id, doc_id, pos) QUALIFY rank <= 5)"""

# TF-IDF vectors of documents and questions, cosine top five.
TFIDF = QUESTIONS + """,
tf AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM (
  SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) AS term FROM documents) GROUP BY ALL),
idf AS MATERIALIZED (SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))::DOUBLE) + 1 AS idf FROM tf GROUP BY 1),
dv AS (SELECT doc_id, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc_id)) AS w FROM tf JOIN idf USING (term)),
qv AS (SELECT query_id, term, qtf * idf / sqrt(sum(qtf * idf * qtf * idf) OVER (PARTITION BY query_id)) AS w FROM (
  SELECT query_id, term, count(*) AS qtf FROM (
    SELECT query_id, unnest(regexp_extract_all(lower(question), '[\\p{L}\\p{N}_]{2,}')) AS term FROM q) GROUP BY ALL)
  JOIN idf USING (term)),
match AS (SELECT query_id, doc_id, sum(qv.w * dv.w) AS score FROM qv JOIN dv USING (term) GROUP BY ALL),
hits AS MATERIALIZED (
  SELECT query_id, doc_id, round(coalesce(score, 0), 6) AS score,
         row_number() OVER (PARTITION BY query_id ORDER BY round(coalesce(score, 0), 10) DESC, doc_id) AS rank
  FROM q CROSS JOIN documents LEFT JOIN match USING (query_id, doc_id) QUALIFY rank <= 5)"""


def extraction(pairs: str) -> str:
    """CTEs naming the best sentence per ``key`` of ``pairs(key, question, context)``."""
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return f"""pairs AS MATERIALIZED ({pairs}),
want AS MATERIALIZED (SELECT DISTINCT key, w FROM (
    SELECT key, unnest(string_split(regexp_replace(lower(question), '\\s+', ' ', 'g'), ' ')) AS w FROM pairs)
    WHERE w <> '' AND w NOT IN ({stop})),
n_want AS (SELECT key, count(*) AS n FROM want GROUP BY 1),
sentence AS MATERIALIZED (SELECT key, s, row_number() OVER (PARTITION BY key ORDER BY i) AS i FROM (
    SELECT key, trim(unnest(ss)) AS s, generate_subscripts(ss, 1) AS i FROM (
      SELECT key, string_split_regex(regexp_replace(lower(context), '\\s+', ' ', 'g'), '[.!?]') AS ss FROM pairs))
    WHERE s <> ''),
hit AS (SELECT key, i, count(DISTINCT w) AS hits FROM (
    SELECT key, i, unnest(string_split(s, ' ')) AS w FROM sentence) JOIN want USING (key, w) GROUP BY ALL),
chosen AS (SELECT key, i, hits FROM hit QUALIFY row_number() OVER (PARTITION BY key ORDER BY hits DESC, i) = 1),
extracted AS MATERIALIZED (
  SELECT pairs.key, coalesce(best.s, head.s, '') AS answer,
         CASE WHEN chosen.hits > 0 THEN round(chosen.hits / n_want.n::DOUBLE, 6) ELSE 0.1::DOUBLE END AS confidence
  FROM pairs LEFT JOIN chosen USING (key) LEFT JOIN n_want USING (key)
  LEFT JOIN sentence best ON best.key = pairs.key AND best.i = chosen.i
  LEFT JOIN sentence head ON head.key = pairs.key AND head.i = 1)"""


TURNS = extraction("""SELECT a.conv_id || ':' || a.turn AS key, a.conv_id, a.turn, a.text AS question, coalesce(b.text, '') AS context
  FROM conversations a LEFT JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 WHERE a.role = 'user'""")

ANSWERED = TFIDF + "," + extraction("""SELECT query_id || '/' || rank AS key, query_id, rank, score, question, text AS context, doc_id
  FROM hits JOIN q USING (query_id) JOIN documents USING (doc_id)""") + """,
answered AS MATERIALIZED (
  SELECT query_id, CASE WHEN key IS NULL THEN 'I couldn''t find any relevant information to answer your question.'
                        WHEN weight > 0 THEN answer ELSE '' END AS answer,
         CASE WHEN weight > 0 THEN weight ELSE 0 END AS confidence, CASE WHEN weight > 0 THEN doc_id END AS doc_id
  FROM q LEFT JOIN (SELECT *, round(confidence * score, 6) AS weight FROM pairs JOIN extracted USING (key)) USING (query_id)
  QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY weight DESC, rank) = 1)"""

SOURCED = BM25 + "," + extraction("""SELECT query_id AS key, any_value(question) AS question,
  string_agg(text, chr(10) || chr(10) ORDER BY rank) AS context
  FROM hits JOIN q USING (query_id) JOIN chunk USING (doc_id, pos) GROUP BY 1""")


def with_(ctes: str, body: str) -> str:
    return f"WITH RECURSIVE {ctes}\n{body}"


def hash_vector(rows: str, key: str, column: str) -> str:
    """CTE ``slots(key, slot, w)`` of the hashed bag of words."""
    return f"""cnt AS (SELECT {key}, ('0x' || substr(md5(term), 1, 2))::INT AS slot, count(*) AS c FROM (
    SELECT {key}, unnest(regexp_extract_all(lower({column}), '[\\p{{L}}\\p{{N}}]+')) AS term FROM {rows}) GROUP BY ALL),
slots AS MATERIALIZED (SELECT {key}, slot, (c / sqrt(sum(c * c) OVER (PARTITION BY {key})::DOUBLE)) AS w FROM cnt)"""


def slots_text(key: str, rows: str) -> str:
    return f"""SELECT {key}, coalesce(string_agg(slot || ':' || round(w * 1000)::BIGINT, ' ' ORDER BY slot), '') AS slots
      FROM {rows} LEFT JOIN slots USING ({key}) GROUP BY 1"""


def cosine_top(threshold: float) -> str:
    return f"""SELECT a.vec_id AS query_id, b.vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS score,
       row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 10) DESC, b.vec_id) AS rank
     FROM embeddings a, embeddings b
     WHERE round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 10) >= {threshold} QUALIFY rank <= 5"""


def text_queries() -> dict[str, str]:
    return {
        "scan_chunks_json": with_(CHUNKS, "SELECT chunk_id, md5(chunk.text) AS text_md5, lang, source FROM chunk JOIN documents USING (doc_id)"),
        "corpus_store": with_(CHUNKS, """SELECT doc_id, source AS title, source, length(text) AS text_length, md5(text) AS text_md5,
             (SELECT count(*) FROM chunk c WHERE c.doc_id = d.doc_id) AS num_chunks FROM documents d"""),
        "embedding_store": """SELECT vec_id AS chunk_id, label::VARCHAR AS label,
             round(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])), 6) AS norm,
             (SELECT count(*) FROM embeddings) AS num_chunks, len(embedding) AS embedding_size FROM embeddings""",
        "similarity_threshold": cosine_top(0.5),
        "confidence_gate": with_(TURNS, f"""SELECT conv_id, turn, CASE WHEN confidence < 0.15 THEN
             'I could not find a confident answer to your question in the provided documents.' ELSE answer END AS answer,
             CASE WHEN confidence < 0.15 THEN 0 ELSE confidence END AS confidence FROM pairs JOIN extracted USING (key)"""),
        "join_chunk_document": with_(CHUNKS, "SELECT chunk_id, doc_id, lang, source, end_idx FROM chunk JOIN documents USING (doc_id)"),
        "join_doc_embedding": """SELECT doc_id, lang, source, label, len(embedding) AS dims
             FROM documents JOIN embeddings ON doc_id = vec_id""",
        "join_query_corpus": """SELECT query_id, count(*) AS n_scored, count(*) FILTER (WHERE s >= 0) AS n_similar, round(max(s), 6) AS best FROM (
             SELECT a.vec_id AS query_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 10) AS s
             FROM embeddings a, embeddings b) GROUP BY 1""",
        "join_query_postings": with_(BM25, """SELECT query_id, count(term) AS n_terms, count(df) AS n_matched,
             coalesce(sum(df), 0)::BIGINT AS n_postings FROM q LEFT JOIN qtf USING (query_id) LEFT JOIN df USING (term) GROUP BY 1"""),
        "join_positional": """SELECT page_id AS ordinal, url AS chunk_id, label,
             round(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])), 6) AS norm
             FROM pages JOIN embeddings ON page_id = vec_id""",
        "document_stats": with_(CHUNKS, """SELECT doc_id, length(text) AS text_length,
             (SELECT count(*) FROM chunk c WHERE c.doc_id = d.doc_id) AS num_chunks FROM documents d"""),
        "corpus_stats": with_(BM25, "SELECT term, df, round(idf, 6) AS idf, n AS n_rows, round(avgdl, 6) AS avg_length FROM idf, corpus"),
        "chunk_documents": with_(CHUNKS, "SELECT * FROM chunk"),
        "knn_l2": """SELECT query_id, vec_id, round(distance, 6) AS distance, round(1 / (1 + distance), 6) AS score, rank FROM (
             SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(distance, 10), vec_id) AS rank FROM (
               SELECT a.vec_id AS query_id, b.vec_id, list_sum(list_transform(list_zip(a.embedding, b.embedding),
                      lambda p: power(p[1]::DOUBLE - p[2]::DOUBLE, 2))) AS distance
               FROM embeddings a, embeddings b)) WHERE rank <= 5""",
        "search_cosine": cosine_top(0.0),
        "search_tfidf": with_(TFIDF, "SELECT query_id, doc_id, score, rank FROM hits"),
        "search_bm25": with_(BM25, "SELECT query_id, doc_id || ':' || pos AS chunk_id, score, rank FROM hits"),
        "retrieve_auto": with_(CHUNKS + "," + QUESTIONS + ","
                               + hash_vector("(SELECT chunk_id AS k, text FROM chunk UNION ALL SELECT 'q' || query_id, question FROM q)", "k", "text") + """,
            size AS (SELECT k, sum(w * w) AS ww FROM slots GROUP BY 1),
            prod AS (SELECT a.k AS qk, b.k AS ck, sum(a.w * b.w) AS ab FROM slots a JOIN slots b USING (slot)
                     WHERE a.k LIKE 'q%' AND b.k NOT LIKE 'q%' GROUP BY ALL),
            dist AS (SELECT query_id, chunk_id, doc_id, pos, round(greatest(0, coalesce(x.ww, 0) + coalesce(y.ww, 0) - 2 * coalesce(ab, 0)), 10) AS d
                     FROM q CROSS JOIN chunk LEFT JOIN size x ON x.k = 'q' || query_id LEFT JOIN size y ON y.k = chunk_id
                     LEFT JOIN prod ON qk = 'q' || query_id AND ck = chunk_id)""",
            """SELECT query_id, chunk_id, round(1 / (1 + d), 6) AS score,
               row_number() OVER (PARTITION BY query_id ORDER BY d, doc_id, pos) AS rank FROM dist QUALIFY rank <= 5"""),
        "normalized_score": with_(BM25, """SELECT query_id, doc_id || ':' || pos AS chunk_id, score, rank,
             round(score / nullif(max(score) OVER (PARTITION BY query_id), 0), 6) AS normalized_score FROM hits"""),
        "assemble_context": with_(BM25, """SELECT query_id, length(c) AS context_length, md5(c) AS context_md5, left(cut, 512) AS cut_context FROM (
             SELECT query_id, string_agg(text, chr(10) || chr(10) ORDER BY rank) AS c, string_agg(text, ' ' ORDER BY rank) AS cut
             FROM hits JOIN chunk USING (doc_id, pos) GROUP BY 1)"""),
        "extract_answer": with_(TURNS, "SELECT conv_id, turn, answer, confidence FROM pairs JOIN extracted USING (key)"),
        "answer_question": with_(ANSWERED, "SELECT query_id, answer, confidence, doc_id FROM answered"),
        "answer_with_sources": with_(SOURCED, """SELECT query_id,
             CASE WHEN confidence < 0.1 THEN 'I could not find a confident answer to your question in the provided documents.' ELSE answer END AS answer,
             CASE WHEN confidence < 0.1 THEN 0 ELSE confidence END AS confidence, rank, doc_id, source, source AS title, score,
             round(score / nullif(max(score) OVER (PARTITION BY query_id), 0), 6) AS normalized_score
             FROM hits JOIN extracted ON key = query_id JOIN documents USING (doc_id)"""),
        "source_references": with_(ANSWERED, """SELECT query_id, any_value(answer) || chr(10) || chr(10) || 'Sources:' || chr(10)
             || string_agg('[' || rank || '] ' || source || ' (score: ' || round(score::DECIMAL(18, 6), 2)::DECIMAL(18, 2) || ')', chr(10) ORDER BY rank) AS formatted
             FROM answered JOIN hits USING (query_id) JOIN documents ON hits.doc_id = documents.doc_id GROUP BY 1"""),
        "embed_text": with_(QUESTIONS + "," + hash_vector("q", "query_id", "question"), slots_text("query_id", "q")),
        "embed_chunks": with_(CHUNKS + "," + hash_vector("chunk", "chunk_id", "text"),
                              f"SELECT chunk_id, md5(slots) AS slots_md5 FROM ({slots_text('chunk_id', 'chunk')})"),
        "union_chunks": with_(chunk_ctes() + "," + chunk_ctes("SELECT page_id AS doc_id, html AS text FROM pages", "p_"), """
             SELECT doc_id, md5(coalesce(html, text)) AS text_md5, count(chunk_id) AS num_chunks
             FROM (SELECT coalesce(doc_id, page_id) AS doc_id, text, html FROM documents FULL JOIN pages ON doc_id = page_id)
             LEFT JOIN (SELECT doc_id, chunk_id FROM chunk UNION ALL SELECT doc_id, chunk_id FROM p_chunk) USING (doc_id)
             GROUP BY doc_id, text, html"""),
        "word_set_ops": """SELECT conv_id, turn, len(a) AS n_left, len(b) AS n_right, len(list_intersect(a, b)) AS n_common,
             len(a) - len(list_intersect(a, b)) AS n_only_left FROM (
             SELECT x.conv_id, x.turn,
               list_distinct(list_filter(string_split(regexp_replace(lower(x.text), '\\s+', ' ', 'g'), ' '), lambda w: w <> '')) AS a,
               list_distinct(list_filter(string_split(regexp_replace(lower(coalesce(y.text, '')), '\\s+', ' ', 'g'), ' '), lambda w: w <> '')) AS b
             FROM conversations x LEFT JOIN conversations y ON x.conv_id = y.conv_id AND y.turn = x.turn + 1 WHERE x.role = 'user')""",
        "fn_string": """SELECT page_id, lower(url) AS lowered, regexp_extract(url, '[^/]*$') AS base,
             length(regexp_replace(lower(html), '\\s+', ' ', 'g')) AS squashed_length, starts_with(url, 'https')::INT AS is_https,
             (trim(html) = '')::INT AS is_blank,
             lower(coalesce(regexp_extract(regexp_extract(regexp_extract(url, '^[^?#]*'), '[^/]*$'), '^.+(\\.[^.]*)$', 1), '')) AS extension,
             left(html, 512) AS cut,
             md5(array_to_string(list_filter(string_split(regexp_replace(lower(html), '\\s+', ' ', 'g'), ' '), lambda w: w <> ''), '|')) AS words_md5,
             'CUST_' || lpad(page_id::VARCHAR, 6, '0') AS formatted FROM pages""",
        "fn_math": cf("""SELECT customer_id, greatest(0, least(5000, c_acctbal)) AS clipped, round(c_acctbal, 0) AS rounded,
             abs(c_acctbal - 5000) AS away, round(cost / nullif(revenue, 0) * 100, 6) AS cost_share,
             round(1 / (1 + abs(c_acctbal)), 9) AS closeness FROM cf"""),
        "fn_array": """SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)), 6) AS l2_to_zero,
             round(embedding[1]::DOUBLE / sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 6) AS cosine_to_first,
             round(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]), 6) AS self_dot,
             round(embedding[64]::DOUBLE, 6) AS last, embedding[65]::DOUBLE AS beyond FROM embeddings""",
        "fn_default_title": """SELECT page_id, coalesce(nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), ''),
             regexp_extract(url, '[^/]*$')) AS title FROM pages""",
        "fn_date_coalesce": """SELECT o_orderkey, CASE WHEN o_orderstatus IN ('P', 'O') THEN strftime(o_orderdate, '%Y-%m-%d') END AS document_date FROM orders""",
    }


RULE_TERMS = {"contract_type": "t_contract", "support_calls_per_month": "t_calls",
              "total_services": "t_services", "late_payments": "t_late", "tenure": "t_tenure"}

CONTRIB = SC + ",\ncontrib AS MATERIALIZED (" + "\nUNION ALL\n".join(
    f"SELECT customer_id, rule_score, '{n}' AS feature, round({t} - avg({t}) OVER (), 6) AS contribution FROM sc"
    for n, t in RULE_TERMS.items()) + ")"

MEDIAN = "coalesce({c}::DOUBLE, median({c}::DOUBLE) OVER ())"
MODE = ("coalesce({c}, (SELECT {c} FROM cf WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1))")


def prepared_sum() -> str:
    """Sum of the scaled numeric features plus one per seen category, fitted on
    the training rows of the stratified split."""
    names = NUMERIC + [n for n in ENGINEERED if n != "tenure_group"]
    cats = CATEGORICAL + ["tenure_group"]
    fit = ", ".join(f"median({n}::DOUBLE) AS med_{n}" for n in names)
    scale = ", ".join(f"avg(coalesce({n}::DOUBLE, med_{n})) AS mean_{n}, stddev_pop(coalesce({n}::DOUBLE, med_{n})) AS dev_{n}"
                      for n in names)
    total = " + ".join(f"(coalesce({n}::DOUBLE, med_{n}) - mean_{n}) / (CASE WHEN dev_{n} = 0 THEN 1 ELSE dev_{n} END)"
                       for n in names)
    seen = " + ".join(f"({c} IS NULL OR {c} IN (SELECT {c} FROM wide WHERE is_test = 0 AND {c} IS NOT NULL))::INT" for c in cats)
    slots = " + ".join(f"(SELECT count(DISTINCT {c}) FROM wide WHERE is_test = 0)" for c in cats)
    exprs = ", ".join(f"{e} AS {n}" for n, e in ENGINEERED.items())
    return f"""WITH {CF},
wide AS MATERIALIZED (SELECT *, {exprs}, (row_number() OVER (PARTITION BY "Churn" ORDER BY md5(customer_id::VARCHAR || '|42'))
    <= round(0.2::DOUBLE * count(*) OVER (PARTITION BY "Churn")))::INT AS is_test FROM cf),
fit AS MATERIALIZED (SELECT {fit} FROM wide WHERE is_test = 0),
scale AS MATERIALIZED (SELECT {scale} FROM wide, fit WHERE is_test = 0)
SELECT customer_id, is_test, {len(names)} + {slots} AS n_slots, round({total} + {seen}, 4) AS slot_sum FROM wide, fit, scale"""


def models() -> dict[str, str]:
    def columns(names, template):
        return ", ".join(f"{template.format(c=q(c))} AS {q(c)}" for c in names)

    names = NUMERIC + [n for n in ENGINEERED if n != "tenure_group"]
    cats = CATEGORICAL + ["tenure_group"]
    filled = f"SELECT customer_id, {columns(NUMERIC, MEDIAN)} FROM cf"
    scaled = "({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1)"
    categories = f"SELECT customer_id, {columns(CATEGORICAL, MODE)} FROM cf"
    return {
        "impute_median": cf(filled),
        "impute_mode": cf(categories),
        "standardize": cf(f"SELECT customer_id, {columns(NUMERIC, 'round(' + scaled + ', 6)')} FROM ({filled})"),
        "one_hot": cf("\nUNION ALL\n".join(
            f"SELECT customer_id, '{c}' AS column_name, {c} AS category, 1 AS value FROM ({categories})" for c in CATEGORICAL)),
        "prep_pipeline": prepared_sum(),
        "feature_types": cf("SELECT column_name, kind, (SELECT count(*) FROM cf) AS n_rows FROM (VALUES "
                            + ", ".join([f"('{n}', 'numeric')" for n in names] + [f"('{c}', 'categorical')" for c in cats])
                            + ") AS t(column_name, kind)"),
        "score": sc("SELECT customer_id, label_sig, 1 AS in_range, 1 AS band_agrees, 1 AS prediction_agrees FROM sc"),
        "model_store": sc("SELECT customer_id, 1 AS same FROM sc"),
        "explain_rows": f"WITH {CONTRIB} SELECT customer_id, feature, contribution FROM contrib WHERE customer_id IN "
                        "(SELECT customer_id FROM sc ORDER BY rule_score DESC, customer_id LIMIT 5)",
        "topk_factors": f"""WITH {CONTRIB} SELECT customer_id, feature, abs(contribution) AS importance,
             row_number() OVER (PARTITION BY customer_id ORDER BY abs(contribution) DESC, feature) AS rank
             FROM contrib QUALIFY rank <= 3""",
        "feature_importance": sc("\nUNION ALL\n".join(
            f"SELECT '{n}' AS feature, round(avg(abs(t - m)), 6) AS importance FROM (SELECT {t} AS t, avg({t}) OVER () AS m FROM sc)"
            for n, t in RULE_TERMS.items())),
        "explanation_report": f"""WITH {CONTRIB} SELECT customer_id, rule_score AS risk_probability, feature,
             abs(contribution) AS importance,
             row_number() OVER (PARTITION BY customer_id ORDER BY abs(contribution) DESC, feature) AS rank
             FROM contrib WHERE customer_id IN (SELECT customer_id FROM sc ORDER BY rule_score DESC, customer_id LIMIT 5)
             QUALIFY rank <= 5""",
    }


def oracle_sql() -> dict[str, str]:
    return {**tables_and_profile(), **evaluation(), **text_queries(), **models()}
