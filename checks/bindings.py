"""Canonical tables derived from the given test tables.

The SQL is plain enough for Spark and DuckDB alike: `{name}` stands for a base
table or another binding, so both engines read the same inputs.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsight.operators.running import spread_keys

BASE = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()

SITE_OF_LINE = "CASE l_linestatus WHEN 'O' THEN 'US' ELSE 'UK' END"

BINDINGS = {
    # Text deliveries: several per product and day, some invalid, some undated.
    "raw": """
        SELECT 'A' || CAST(user_id AS STRING) AS asin,
               CASE user_id % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'UK' ELSE 'DE' END AS site,
               substr(CAST(ts AS STRING), 1, 10) AS dt,
               CASE event_type WHEN 'error' THEN 'n/a'
                    WHEN 'signup' THEN '-' || CAST(value AS STRING)
                    ELSE CAST(value AS STRING) END AS price,
               CASE event_type WHEN 'error' THEN 'not-a-number' ELSE CAST(k * 60000 AS STRING) END AS bsr,
               CAST(k % 6 AS STRING) AS rating,
               CAST(k * 3 AS BIGINT) AS reviews_count,
               CAST(k AS BIGINT) AS stock_est,
               'seller-' || event_type AS buybox_seller,
               CASE WHEN k = 50 THEN NULL ELSE ts END AS _ingested_at,
               event_id, event_type
        FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM {events}) e
    """,
    # One row per supplier, site and ship day.
    "mart": f"""
        SELECT 'S' || CAST(l_suppkey AS STRING) AS asin, {SITE_OF_LINE} AS site,
               CAST(l_shipdate AS DATE) AS dt,
               sum(l_quantity) AS sales, sum(l_quantity) AS est_sales,
               max(l_extendedprice) AS price,
               CASE WHEN max(l_discount) > 0.095 THEN NULL ELSE CAST(min(l_partkey) AS DOUBLE) END AS bsr,
               1 + max(l_tax) * 40 AS rating,
               CAST(sum(l_linenumber) AS BIGINT) AS reviews_count,
               CASE WHEN max(l_discount) < 0.015 THEN NULL ELSE max(l_discount) * 10 END AS bsr_percentile,
               CAST(min(l_partkey) AS DOUBLE) AS bsr_rank,
               CASE WHEN max(l_tax) = 0 THEN NULL ELSE max(l_quantity) * 2 END AS title_length,
               CAST(max(l_linenumber) AS DOUBLE) AS bullet_count,
               CAST(min(l_linenumber) + 2 AS DOUBLE) AS image_count,
               max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) = 1 AS has_material_attr,
               max(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) = 1 AS has_size_attr,
               max(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) = 1 AS has_use_case_attr,
               max(l_tax) > 0.05 AS has_a_plus
        FROM {{lineitem}} l
        GROUP BY 'S' || CAST(l_suppkey AS STRING), {SITE_OF_LINE}, CAST(l_shipdate AS DATE)
    """,
    # One row per supplier and site.
    "dim": """
        SELECT 'S' || CAST(s_suppkey AS STRING) AS asin, v.site, s_name AS title, n_name AS brand,
               CASE WHEN s_nationkey = 7 THEN NULL ELSE n_name END AS category,
               CASE WHEN s_nationkey = 7 THEN NULL ELSE n_name END AS category_id,
               CASE WHEN s_acctbal < 0 THEN NULL WHEN s_acctbal < 3000 THEN 'low'
                    WHEN s_acctbal < 7000 THEN 'mid' ELSE 'premium' END AS price_band
        FROM (SELECT *, 'US' AS site FROM {supplier} a UNION ALL SELECT *, 'UK' AS site FROM {supplier} b) v
        JOIN {nation} n ON n.n_nationkey = v.s_nationkey
    """,
    "predictions": f"""
        SELECT CAST(l_shipdate AS DATE) AS snapshot_date, 'P' || CAST(l_partkey AS STRING) AS asin,
               {SITE_OF_LINE} AS site, p_type AS category,
               sum(l_extendedprice * (1 - l_discount)) * 0.14285917 AS predicted_revenue,
               sum(l_quantity) AS predicted_units,
               1 - max(l_discount) AS confidence_score
        FROM {{lineitem}} l JOIN {{part}} p ON p.p_partkey = l.l_partkey
        GROUP BY CAST(l_shipdate AS DATE), 'P' || CAST(l_partkey AS STRING), {SITE_OF_LINE}, p_type
    """,
    "actuals": f"""
        SELECT CAST(l_shipdate AS DATE) AS snapshot_date, 'P' || CAST(l_partkey AS STRING) AS asin,
               {SITE_OF_LINE} AS site,
               sum(CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_extendedprice END) * 0.14285917 AS actual_revenue
        FROM {{lineitem}} l
        GROUP BY CAST(l_shipdate AS DATE), 'P' || CAST(l_partkey AS STRING), {SITE_OF_LINE}
    """,
    "category_snapshot": """
        SELECT snapshot_date, category, avg(predicted_revenue) AS avg_category_revenue,
               avg(predicted_units) AS avg_category_units
        FROM {predictions} p GROUP BY snapshot_date, category
    """,
    "summaries": f"""
        SELECT CAST(l_shipdate AS DATE) AS snapshot_date, 'P' || CAST(l_partkey AS STRING) AS asin,
               {SITE_OF_LINE} AS site, 'returned ' || CAST(count(*) AS STRING) AS summary_text
        FROM {{lineitem}} l WHERE l_returnflag = 'R'
        GROUP BY CAST(l_shipdate AS DATE), 'P' || CAST(l_partkey AS STRING), {SITE_OF_LINE}
    """,
    "clusters": f"""
        SELECT CAST(l_shipdate AS DATE) AS snapshot_date, 'P' || CAST(l_partkey AS STRING) AS asin,
               {SITE_OF_LINE} AS site, 'line ' || CAST(max(l_linenumber) AS STRING) AS cluster_label
        FROM {{lineitem}} l WHERE l_returnflag = 'A'
        GROUP BY CAST(l_shipdate AS DATE), 'P' || CAST(l_partkey AS STRING), {SITE_OF_LINE}
    """,
    "history": """
        SELECT 'A' || CAST(user_id AS STRING) AS asin,
               CASE user_id % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'UK' ELSE 'DE' END AS site,
               event_type AS feature_name, value AS feature_value, ts AS snapshot_ts
        FROM {events} e
    """,
    # One row per event; a view is an impression, a purchase a conversion.
    "ab_log": """
        SELECT 'A' || CAST(user_id AS STRING) AS asin,
               CASE user_id % 3 WHEN 0 THEN 'books' WHEN 1 THEN 'toys' ELSE '' END AS category,
               CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 1 ELSE 0 END AS impressions,
               CASE WHEN event_type IN ('click', 'purchase') THEN 1 ELSE 0 END AS clicks,
               CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS conversions,
               CASE WHEN event_type = 'purchase' THEN value ELSE 0 END AS gmv,
               CASE WHEN event_type = 'purchase' THEN value * value ELSE 0 END AS gmv_sq,
               CASE WHEN event_type = 'signup' THEN value ELSE 0 END AS spend,
               CASE WHEN event_type = 'purchase' THEN value / 10 ELSE 0 END AS roas,
               CASE WHEN event_type = 'purchase' THEN value * value / 100 ELSE 0 END AS roas_sq
        FROM {events} e
    """,
    "rank_eval": """
        SELECT l.doc_id, d.source AS query, l.quality + l.toxic AS relevance,
               CAST(d.n_chars AS DOUBLE) AS score, CAST((l.doc_id * 7919) % 1009 AS DOUBLE) AS baseline,
               l.quality, d.n_chars / (d.n_chars + 1500.0) AS probability
        FROM {labels} l JOIN {documents} d ON d.doc_id = l.doc_id
    """,
    "price_eval": """
        SELECT l_extendedprice / 1000 AS y, l_quantity * p_retailprice / 1000 AS prediction
        FROM {lineitem} l JOIN {part} p ON p.p_partkey = l.l_partkey
    """,
    "runs": """
        SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS pipeline,
               o_orderdate AS scheduled_at, l_shipdate AS completed_at
        FROM {lineitem} l JOIN {orders} o ON o.o_orderkey = l.l_orderkey
    """,
    "comments": """
        SELECT conv_id, turn, text FROM {conversations} c
    """,
}

# The key by which a binding's base table is dealt out once, by the expressions of its SQL:
# the binding's own groups and all that works per key on top of it then need no other shuffle.
KEYED = {"mart": ("lineitem", ("'S' || CAST(l_suppkey AS STRING)", SITE_OF_LINE))}

_NAME = re.compile(r"\{(\w+)\}")


def bind(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table or binding as a lazy frame."""
    if name in BASE:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    needed = set(_NAME.findall(BINDINGS[name]))
    frames = {n: bind(spark, sf_dir, n) for n in needed}
    if name in KEYED:
        base, key = KEYED[name]
        # Counting rows reads only the footers of the files.
        frames[base] = spread_keys(frames[base], [F.expr(k) for k in key], frames[base].count())
    return spark.sql(BINDINGS[name], **frames)


def spread(df: DataFrame) -> DataFrame:
    """Even out a table that has fewer splits than there are cores.

    The test tables are files of one row group, so text and JSON work on them
    would run in one task. Tables with enough splits are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def with_bindings(sql: str) -> str:
    """DuckDB text: the bindings a query names as `{name}`, as leading CTEs."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in _NAME.findall(text):
            if name in BINDINGS and name not in order:
                need(BINDINGS[name])
                order.append(name)

    need(sql)
    plain = lambda text: _NAME.sub(r"\1", text)
    ctes = ",\n".join(f"{n} AS ({plain(BINDINGS[n])})" for n in order)
    body = plain(sql).strip()
    if not order:
        return body
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
