"""The SQL each query is checked against.

The flat values ``f`` are written without any array function, so they check the nested
lookup independently.
"""

from catalogue.inputs import APART
from centigram.schemas import FEATURES, RUN_MESSAGE

ORACLES = {}

# Raw feature values, NULLs kept.
F_CTE = """
f AS (
  SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS code,
    CASE WHEN l_linenumber NOT IN (6, 7) THEN p_name END AS product_name,
    CASE WHEN ok THEN CAST(CAST(l_extendedprice / 100 AS FLOAT) AS DOUBLE) END AS "energy-kcal",
    CASE WHEN ok AND l_linenumber <> 5 THEN CAST(CAST(l_quantity AS FLOAT) AS DOUBLE) END AS fat,
    CASE WHEN ok AND l_linenumber <> 4 THEN CAST(p_size AS DOUBLE) END AS carbohydrates,
    CASE WHEN ok THEN CAST(CAST(l_discount * 100 AS FLOAT) AS DOUBLE) END AS proteins,
    CASE WHEN ok THEN CAST(CAST(l_tax * 100 AS FLOAT) AS DOUBLE) END AS sugars,
    l_returnflag
  FROM (SELECT *, NOT (l_linenumber = 3 AND l_returnflag = 'A') AS ok
        FROM lineitem JOIN part ON l_partkey = p_partkey)
)"""

# Prepared products, and the same with a cluster.
P_CTE = (
    F_CTE
    + """,
p AS (
  SELECT code, product_name, coalesce("energy-kcal", 0) AS "energy-kcal",
    coalesce(fat, 0) AS fat, coalesce(carbohydrates, 0) AS carbohydrates,
    coalesce(proteins, 0) AS proteins, coalesce(sugars, 0) AS sugars
  FROM f
)"""
)
K_CTE = (
    F_CTE
    + """,
k AS (
  SELECT code, product_name, coalesce("energy-kcal", 0) AS "energy-kcal",
    coalesce(fat, 0) AS fat, coalesce(carbohydrates, 0) AS carbohydrates,
    coalesce(proteins, 0) AS proteins, coalesce(sugars, 0) AS sugars,
    CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS INTEGER) AS cluster
  FROM f
)"""
)

COLUMNS = 'code, product_name, "energy-kcal", fat, carbohydrates, proteins, sugars'
QUOTED = [f'"{f}"' for f in FEATURES]


def each(template: str, separator: str = ", ") -> str:
    """The template for every feature: {f} is the name, {q} the quoted name, {i} the index."""
    parts = (template.format(f=f, q=q, i=i) for i, (f, q) in enumerate(zip(FEATURES, QUOTED)))
    return separator.join(parts)


def r6(expression: str) -> str:
    return f"round({expression}, 6) + 0.0"


def from_f(body: str) -> str:
    return f"WITH {F_CTE} {body}"


def from_p(body: str, *more: str) -> str:
    return f"WITH {', '.join([P_CTE, *more])} {body}"


def from_k(body: str, *more: str) -> str:
    return f"WITH {', '.join([K_CTE, *more])} {body}"


BUCKET = "CAST('0x' || substr(md5(code), 1, 8) AS BIGINT) % 100"
PREPARED = from_p(f"SELECT {COLUMNS} FROM p")
POSITIVE = from_p(f"SELECT {COLUMNS} FROM p WHERE {each('{q} > 0', ' OR ')}")

ORACLES["scan_projection"] = "SELECT p_partkey, p_name, p_size FROM part"
for name in (
    "parquet_scan",
    "csv_scan",
    "json_scan",
    "table_scan",
    "prepare_features_rows",
    "product_load_rows",
    "append_products",
):
    ORACLES[name] = PREPARED

ORACLES["head_rows"] = from_f(f"SELECT {COLUMNS} FROM f ORDER BY code LIMIT 1000")
ORACLES["head_rows_large"] = from_f(f"SELECT {COLUMNS} FROM f ORDER BY code LIMIT 5000")
ORACLES["hash_sample_rows"] = from_f(f"SELECT {COLUMNS} FROM f WHERE {BUCKET} < 10")
ORACLES["hash_sample_limit"] = from_f(
    f"SELECT {COLUMNS} FROM f WHERE {BUCKET} < 10 ORDER BY code LIMIT 500"
)
ORACLES["random_sample"] = (
    "SELECT count(*) > 0 AS near, CAST(0 AS BIGINT) AS strays, CAST(0 AS BIGINT) AS differs "
    "FROM lineitem"
)
ORACLES["insert_batch"] = from_p(f"SELECT {COLUMNS} FROM p ORDER BY code LIMIT 10")
ORACLES["bounded_extract"] = from_f(f"SELECT {COLUMNS} FROM f ORDER BY code LIMIT 5000")

ORACLES["extract_by_name"] = from_f(f"SELECT code, {each('{q}')} FROM f")
ORACLES["first_text"] = from_f("SELECT code, product_name FROM f")
ORACLES["flat_or_nested"] = from_f("""
SELECT code, fat,
  CASE l_returnflag WHEN 'N' THEN CAST(7.5 AS DOUBLE) END AS sugars_flat,
  sugars AS sugars_nested,
  CASE l_returnflag WHEN 'N' THEN CAST(7.5 AS DOUBLE) ELSE sugars END AS sugars_row
FROM f""")
ORACLES["cast_flat_columns"] = r"""
SELECT event_id, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS DOUBLE) AS k,
  CAST(NULL AS DOUBLE) AS raw,
  CASE WHEN event_type <> 'error' THEN value END AS mixed
FROM events"""
ORACLES["list_text_rows"] = """
SELECT p_partkey, '[' || CAST(CAST(p_partkey AS DOUBLE) AS VARCHAR) || ','
  || CAST(CAST(p_size AS DOUBLE) AS VARCHAR) || ']' AS pair
FROM part"""

MOMENTS = "m AS (SELECT {} FROM {{}})".format(
    each("avg({q}) AS mean{i}, stddev_samp({q}) AS sd{i}")
)


def within(threshold: str) -> str:
    """Z-score condition over p and m."""
    template = f"(sd{{i}} IS NULL OR sd{{i}} = 0 OR abs(({{q}} - mean{{i}}) / sd{{i}}) < {threshold})"
    return each(template, " AND ")


ORACLES["prepare_without_outliers"] = from_p(
    f"SELECT {COLUMNS} FROM p, m WHERE {within('1.7')}", MOMENTS.format("p")
)
ORACLES["any_positive"] = POSITIVE
ORACLES["validated_read"] = POSITIVE
ORACLES["prepare_well_filled"] = from_p(
    'SELECT code, product_name, "energy-kcal", proteins, sugars FROM p'
)
ORACLES["json_row_exchange"] = POSITIVE.replace("FROM p WHERE", ", false AS unreadable FROM p WHERE")
ORACLES["json_responses"] = PREPARED
ORACLES["complete_cases"] = from_f(
    f"SELECT {COLUMNS} FROM f WHERE {each('{q} IS NOT NULL', ' AND ')}"
)
ORACLES["zscore_filter"] = from_p(
    f"SELECT {COLUMNS} FROM p, m WHERE {within('1.5')}", MOMENTS.format("p")
)
ORACLES["fill_rate"] = from_f(
    each(
        "SELECT '{f}' AS feature, count({q}) AS filled, "
        "round(count({q}) / count(*), 6) + 0.0 AS rate, count({q}) / count(*) >= 0.9 AS keep "
        "FROM f",
        " UNION ALL ",
    )
)
ORACLES["null_profile"] = from_f(
    each(
        "SELECT '{f}' AS feature, count(*) AS total, count(*) - count({q}) AS nulls, "
        "round((count(*) - count({q})) / count(*) * 100, 6) + 0.0 AS pct FROM f",
        " UNION ALL ",
    )
)
RULES = {
    "any_positive": each("{q} > 0", " OR "),
    "complete": each("{q} IS NOT NULL", " AND "),
    "within_1.5_sd": within("1.5"),
}
ORACLES["kept_report"] = (
    f"WITH {F_CTE}, {MOMENTS.format('f')} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) AS total, "
        f"CAST(count(*) FILTER ({rule}) AS BIGINT) AS kept, "
        f"CAST(count(*) - count(*) FILTER ({rule}) AS BIGINT) AS removed, "
        f"{r6(f'(count(*) - count(*) FILTER ({rule})) / count(*) * 100')} AS removed_pct FROM f, m"
        for name, rule in RULES.items()
    )
)
ORACLES["feature_stats"] = from_f(
    each(
        "SELECT '{f}' AS feature, round(avg({q}), 6) + 0.0 AS mean, "
        "round(stddev_samp({q}), 6) + 0.0 AS stddev FROM f",
        " UNION ALL ",
    )
)
ORACLES["row_count"] = from_f('SELECT count(*) AS "rows" FROM f')

# --- scaling: centre, width and the value of a column without width ---
SCALES = {
    "standard": ("avg({q})", "stddev_samp({q})", "0.0"),
    "minmax": ("min({q})", "max({q}) - min({q})", "0.5"),
    "maxabs": ("0.0", "max(abs({q}))", "0.0"),
    "robust": ("quantile_cont({q}, 0.5)", "quantile_cont({q}, 0.75) - quantile_cont({q}, 0.25)", "0.0"),
}
for name, (center, width, flat) in SCALES.items():
    scale = f"s AS (SELECT {each(center + ' AS c{i}, ' + width + ' AS w{i}')} FROM p)"
    value = f"CASE WHEN w{{i}} <> 0 THEN ({{q}} - c{{i}}) / w{{i}} ELSE {flat} END"
    columns = each(f'round({value}, 6) + 0.0 AS "scaled_{{f}}"')
    ORACLES[f"scale_{name}"] = from_p(f"SELECT code, {columns} FROM p, s", scale)
ORACLES["scaled_vector_columns"] = ORACLES["scale_standard"]

# --- clusters ---
MEANS = f"means AS (SELECT cluster, {each('avg({q}) AS {q}')} FROM k GROUP BY cluster)"
SQUARED = each("(r.{q} - means.{q}) * (r.{q} - means.{q})", " + ")
NUMBERED = "r AS (SELECT *, row_number() OVER () AS rid FROM k)"
ORACLES["assign_to_centers"] = from_k(
    f"""SELECT code, cluster, {r6('sqrt(d)')} AS distance
    FROM (SELECT rid, r.code, means.cluster, {SQUARED} AS d FROM r, means)
    QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, cluster) = 1""",
    MEANS,
    NUMBERED,
)
NORM = each("{q} * {q}", " + ")
SILHOUETTE = [
    NUMBERED,
    f"""c AS (SELECT cluster, count(*) AS n, avg({NORM}) AS spread,
      {each('avg({q}) AS m{i}')} FROM k GROUP BY cluster)""",
    f"""d AS (SELECT rid, r.cluster AS own, c.cluster AS other, c.n,
      {NORM} + c.spread - 2 * ({each('{q} * m{i}', ' + ')}) AS d FROM r, c)""",
    """ab AS (SELECT rid, own, max(n) FILTER (own = other) AS n,
      max(d * n / (n - 1)) FILTER (own = other AND n > 1) AS a, min(d) FILTER (own <> other) AS b
      FROM d GROUP BY rid, own)""",
    """s AS (SELECT own AS cluster, CASE WHEN b IS NULL THEN NULL WHEN n = 1 OR a = b THEN 0.0
      WHEN a < b THEN 1 - a / b ELSE b / a - 1 END AS s FROM ab)""",
]
ORACLES["silhouette_by_cluster"] = from_k(
    f"SELECT cluster, count(*) AS size, {r6('avg(s)')} AS silhouette FROM s GROUP BY cluster",
    *SILHOUETTE,
)
BY_FLAG = "CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END"
ORACLES["silhouette_many_clusters"] = ORACLES["silhouette_by_cluster"].replace(
    BY_FLAG, "coalesce(carbohydrates, 0)"
)
ORACLES["silhouette_overall"] = from_k(f"SELECT {r6('avg(s)')} AS silhouette FROM s", *SILHOUETTE)
ORACLES["kmeans_invariants"] = from_p(
    """SELECT count(*) AS "rows", CAST(0 AS BIGINT) AS not_nearest, true AS centred,
      count(*) AS sized_rows, CAST(5 AS BIGINT) AS clusters FROM p"""
)
ORACLES["score_batch"] = from_p(
    """SELECT code AS product_id, CAST(2 * count(*) AS BIGINT) AS results, true AS repeats
    FROM p GROUP BY code"""
)

SIZES = """sizes AS (
  SELECT CAST(id AS INTEGER) AS cluster, count(k.cluster) AS size
  FROM range(4) r(id) LEFT JOIN k ON k.cluster = id GROUP BY id)"""
SHARES = """shares AS (
  SELECT cluster, size, round(size / sum(size) OVER () * 100, 2) AS share FROM sizes)"""
ORACLES["cluster_sizes"] = from_k("SELECT cluster, size FROM sizes", SIZES)
ORACLES["cluster_share"] = from_k("SELECT cluster, size, share FROM shares", SIZES, SHARES)
ORACLES["cluster_distinct"] = from_k("SELECT count(DISTINCT cluster) AS clusters FROM k")
RANKED = """ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY cluster ORDER BY code, product_name, "energy-kcal",
    fat, carbohydrates, proteins, sugars) AS INTEGER) AS rank FROM k)"""
ORACLES["cluster_samples"] = from_k(
    f"SELECT {COLUMNS}, cluster, rank FROM ranked WHERE rank <= 5", RANKED
)
ORACLES["cluster_samples_large"] = from_k(
    f"SELECT {COLUMNS}, cluster, rank FROM ranked WHERE rank <= 1500", RANKED
)
LONG = "long AS (" + each(
    "SELECT cluster, '{f}' AS feature, {q} AS value FROM k", " UNION ALL "
) + ")"
BOX = """box AS (
  SELECT cluster, feature, count(*) AS n, min(value) AS min, max(value) AS max,
    quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
    quantile_cont(value, 0.75) AS q3
  FROM long GROUP BY cluster, feature)"""
BOX_ROWS = (
    f"""SELECT cluster, feature, any_value(n) AS n, any_value(box.min) AS min,
      {r6('any_value(q1)')} AS q1, {r6('any_value(median)')} AS median,
      {r6('any_value(q3)')} AS q3, any_value(box.max) AS max,
      {r6('least(min(value) FILTER (value >= q1 - (q3 - q1) * 1.5), any_value(q1))')}
        AS whisker_low,
      {r6('greatest(max(value) FILTER (value <= q3 + (q3 - q1) * 1.5), any_value(q3))')}
        AS whisker_high,
      CAST(count(*) FILTER (value < q1 - (q3 - q1) * 1.5 OR value > q3 + (q3 - q1) * 1.5)
        AS BIGINT) AS outliers
    FROM long JOIN box USING (cluster, feature) GROUP BY cluster, feature"""
)
ORACLES["distribution_by_cluster"] = from_k(BOX_ROWS, LONG, BOX)
ORACLES["density_2d_by_cluster"] = from_k(
    """SELECT cluster, CAST(least(floor(("energy-kcal" - x0) / wx), 49) AS BIGINT) AS bx,
      CAST(least(floor((fat - y0) / wy), 49) AS BIGINT) AS "by", count(*) AS count
    FROM k, e GROUP BY 1, 2, 3""",
    """e AS (SELECT min("energy-kcal") AS x0, (max("energy-kcal") - min("energy-kcal")) / 50 AS wx,
      min(fat) AS y0, (max(fat) - min(fat)) / 50 AS wy FROM k)""",
)
ORACLES["cluster_means"] = from_k(
    f"SELECT cluster, {each('round({q}, 6) + 0.0 AS {q}')} FROM means", MEANS
)
MEANS_LONG = "centers AS (" + each(
    "SELECT cluster, '{f}' AS feature, {q} AS value FROM means", " UNION ALL "
) + ")"
ORACLES["centers_long"] = from_k(
    f"SELECT cluster, feature, {r6('value')} AS value FROM centers", MEANS, MEANS_LONG
)
ORACLES["centers_json_round_trip"] = ORACLES["centers_long"]
ORACLES["centers_wide"] = from_k(
    f"SELECT cluster, {each('round({q}, 2) AS {q}')} FROM means", MEANS
)
ORACLES["cluster_detail"] = from_k(
    f"""SELECT cluster, size, share, {each('round(means.{q}, 4) AS "center_{f}"')},
      coalesce(rank, 0) AS sample, coalesce(ranked.code, 'N/A') AS code,
      coalesce(ranked.product_name, 'N/A') AS product_name,
      {each("coalesce(CAST(ranked.{q} AS VARCHAR), 'N/A') AS {q}")}
    FROM shares LEFT JOIN means USING (cluster)
    LEFT JOIN (SELECT * FROM ranked WHERE rank <= 5) ranked USING (cluster)""",
    SIZES,
    SHARES,
    MEANS,
    RANKED,
)
ORACLES["run_metrics"] = from_k(
    f"""SELECT true AS success, CAST(4 AS BIGINT) AS cluster_count,
      (SELECT {r6('avg(s)')} FROM s) AS silhouette_score,
      {', '.join(f'(SELECT size FROM sizes WHERE cluster = {i}) AS size_{i}' for i in range(4))}""",
    SIZES,
    *SILHOUETTE,
)
ORACLES["result_rows"] = from_k("SELECT code AS product_id, cluster AS cluster_id FROM k")
ORACLES["product_id_styles"] = from_f("""
SELECT count(DISTINCT code) AS ids, count(DISTINCT code) AS long_ids, CAST(0 AS BIGINT) AS outside
FROM f""")
ORACLES["json_file_exchange"] = from_k(f"SELECT {COLUMNS}, cluster FROM k")
ORACLES["json_typed_values"] = r"""
SELECT event_type = 'error' AS corrupt,
  CASE WHEN event_type <> 'error'
    THEN CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS DOUBLE) END AS k,
  CAST(NULL AS BOOLEAN) AS missing, count(*) AS count,
  count(*) AS tags
FROM events GROUP BY ALL"""
ORACLES["write_results"] = from_k("""
SELECT code AS product_id, cluster AS cluster_id, 'a' AS run_id FROM k
UNION ALL SELECT code, cluster, 'b' FROM k WHERE cluster = 1""")
ORACLES["write_centers"] = from_k(
    f"""SELECT cluster AS cluster_id, feature AS feature_name, {r6('value')} AS feature_value,
      run_id FROM centers, (VALUES ('a'), ('b')) runs(run_id)""",
    MEANS,
    MEANS_LONG,
)
ORACLES["etl"] = from_p(
    f"SELECT {COLUMNS} FROM p WHERE {BUCKET} < 30 ORDER BY code LIMIT 4000"
)
ORACLES["word_count_documents"] = r"""
SELECT word, count(*) AS count FROM (
  SELECT unnest(string_split(line, ' ')) AS word FROM (
    SELECT unnest(string_split(regexp_replace(text, '\n$', ''), chr(10))) AS line
    FROM documents WHERE text <> ''))
GROUP BY word"""
ORACLES["word_count_job"] = ORACLES["word_count_documents"]
ORACLES["word_count_blank_lines"] = r"""
WITH lines AS (
  SELECT unnest(string_split(regexp_replace(text, '\n$', ''), chr(10))) AS line
  FROM documents WHERE text <> '')
SELECT word, count(*) AS count FROM (
  SELECT unnest(string_split(line, ' ')) AS word FROM lines UNION ALL SELECT '' FROM lines)
GROUP BY word"""
ORACLES["etl_full"] = PREPARED
ORACLES["load_batch_twice"] = ORACLES["insert_batch"]
ORACLES["write_results_empty_rerun"] = from_k(
    "SELECT code AS product_id, cluster AS cluster_id, 'a' AS run_id FROM k WHERE cluster <> 0"
)
ORACLES["result_rows_int"] = from_k("""
SELECT run AS run_id, cluster AS cluster_id, count(*) AS results,
  CASE WHEN run = 'number' THEN count(*) ELSE 0 END AS numbers
FROM k, (VALUES ('text'), ('number')) runs(run) GROUP BY run, cluster""")

# --- three groups far apart, numbered by their first code ---
APART_CTE = [
    f"""g AS (SELECT code, product_name, {each(f'{{q}} + cluster * {APART} AS {{q}}')}, cluster AS flag
      FROM k)""",
    """numbers AS (SELECT flag, CAST(row_number() OVER (ORDER BY min(code)) - 1 AS INTEGER) AS cluster
      FROM g GROUP BY flag)""",
    "a AS (SELECT g.* EXCLUDE (flag), cluster FROM g JOIN numbers USING (flag))",
]
APART_SCALED = [
    f"m AS (SELECT {each('avg({q}) AS mean{i}, stddev_samp({q}) AS sd{i}')} FROM a)",
    f"""z AS (SELECT code, cluster, {each('({q} - mean{i}) / sd{i} AS {q}')} FROM a, m)""",
]
ORACLES["kmeans_fit_score"] = from_k("SELECT code, cluster FROM a", *APART_CTE)
ORACLES["train_report"] = from_k(
    f"""SELECT cluster, size, share, {each('"center_{f}"')}, rank AS sample, code, product_name,
      {each('CAST({q} AS VARCHAR) AS {q}')}
    FROM (SELECT cluster, count(*) AS size, round(count(*) / (SELECT count(*) FROM z) * 100, 2) AS share,
        {each('round(avg({q}), 4) AS "center_{f}"')} FROM z GROUP BY cluster)
    JOIN (SELECT code, coalesce(product_name, 'N/A') AS product_name, {each('{q}')}, cluster,
        CAST(row_number() OVER (PARTITION BY cluster ORDER BY code, product_name) AS INTEGER) AS rank
      FROM a) USING (cluster)
    WHERE rank <= 5""",
    *APART_CTE,
    *APART_SCALED,
)
ORACLES["train_report_metrics"] = from_k(
    f"""SELECT true AS success, '{RUN_MESSAGE}' AS message, CAST(3 AS BIGINT) AS cluster_count,
      (SELECT {r6('avg(s)')} FROM s) AS silhouette_score""",
    *APART_CTE,
    *APART_SCALED,
    *(part.replace("FROM k", "FROM z") for part in SILHOUETTE),
)
ORACLES["saved_report"] = from_k(BOX_ROWS, *APART_CTE, LONG.replace("FROM k", "FROM a"), BOX)
ORACLES["score_reduced_model"] = from_k(
    "SELECT code, cluster, 'energy-kcal,proteins,sugars' AS features FROM a", *APART_CTE
)
ORACLES["score_permuted_features"] = from_k(
    f"SELECT cluster, feature, {r6('avg(value)')} AS value FROM long GROUP BY cluster, feature",
    *APART_CTE,
    *APART_SCALED,
    LONG.replace("FROM k", "FROM z"),
)
