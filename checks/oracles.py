"""DuckDB twins of the registered queries, written from the definitions.

They take other routes than the Spark operators on purpose: self joins for
calendar windows, correlated lookups for as-of joins, window ranks for counts.
"""

from __future__ import annotations

from checks.bindings import with_bindings

ORACLES: dict[str, str] = {}


def r(expression: str, name: str, digits: int = 6) -> str:
    return f"round(CAST({expression} AS DOUBLE), {digits}) + 0.0 AS {name}"


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = with_bindings(sql)


DAY = "CAST({0} AS VARCHAR) AS {0}"

# --- standardise and quality -------------------------------------------------

KEPT = """
    SELECT * EXCLUDE (pick) FROM (
        SELECT *, row_number() OVER (PARTITION BY asin, site, {key}
                   ORDER BY (_ingested_at IS NULL) DESC, _ingested_at DESC, event_id DESC) AS pick
        FROM {source} raw_rows) WHERE pick = 1
"""
CLEAN = """
    SELECT asin, site, CAST(dt AS DATE) AS dt, reviews_count, stock_est, buybox_seller, _ingested_at,
           event_id, event_type,
           CASE WHEN p > 0 THEN p END AS price, CASE WHEN b > 0 AND b < 5000000 THEN b END AS bsr,
           TRY_CAST(rating AS DOUBLE) AS rating,
           coalesce(p > 0, false) AS price_valid, coalesce(b > 0 AND b < 5000000, false) AS bsr_valid
    FROM (SELECT *, TRY_CAST(price AS DOUBLE) AS p, TRY_CAST(bsr AS DOUBLE) AS b FROM kept)
"""
STANDARD_COLUMNS = f"""
    asin, site, CAST(dt AS VARCHAR) AS dt, {r('price', 'price')}, {r('bsr', 'bsr')}, {r('rating', 'rating')},
    reviews_count, stock_est, buybox_seller, CAST(_ingested_at AS VARCHAR) AS _ingested_at, event_id,
    CAST(price_valid AS BIGINT) AS price_valid, CAST(bsr_valid AS BIGINT) AS bsr_valid
"""


def standardized(select: str, source: str = "{raw}") -> str:
    kept = KEPT.replace("{key}", "dt").replace("{source}", source)
    return f"WITH kept AS ({kept}), clean AS ({CLEAN}) {select}"


oracle("standardize_keep_last", standardized(f"SELECT {STANDARD_COLUMNS} FROM clean"))
oracle("stream_standardize", standardized(f"SELECT {STANDARD_COLUMNS} FROM clean"))
oracle(
    "standardize_union",
    standardized(
        f"SELECT {STANDARD_COLUMNS} FROM clean",
        "(SELECT * REPLACE (CASE WHEN event_type = 'error' THEN NULL ELSE buybox_seller END AS buybox_seller) FROM {raw})",
    ),
)
oracle(
    "tolerant_numbers",
    f"""SELECT event_type, count(*) AS rows, count(TRY_CAST(price AS DOUBLE)) AS prices,
               {r('sum(TRY_CAST(bsr AS DOUBLE))', 'bsr_sum')} FROM {{raw}} GROUP BY event_type""",
)
oracle(
    "coverage_report",
    f"""WITH gaps AS (
          SELECT date_diff('day', lag(dt) OVER (ORDER BY dt), dt) AS gap FROM {{mart}}),
        c AS (SELECT avg(CASE WHEN coalesce(gap, 1) = 1 THEN 1.0 ELSE 0.0 END) AS v FROM gaps)
        SELECT {r('v', 'coverage')}, CASE WHEN v >= 0.95 THEN 'passed' ELSE 'warning' END AS status FROM c""",
)
oracle(
    "anomaly_counts",
    """SELECT count(*) FILTER (TRY_CAST(price AS DOUBLE) <= 0) AS invalid_price,
              count(*) FILTER (TRY_CAST(bsr AS DOUBLE) <= 0 OR TRY_CAST(bsr AS DOUBLE) >= 5000000) AS invalid_bsr
       FROM {raw}""",
)
oracle(
    "row_reconcile",
    standardized(
        """SELECT * FROM (
             SELECT event_type AS dataset, count(*) AS raw,
                    (SELECT count(*) FROM clean c WHERE c.event_type = w.event_type) AS processed
             FROM {raw} w GROUP BY event_type) WHERE abs(raw - processed) / raw > 0.01"""
    ),
)

# --- features and scores -----------------------------------------------------


def _rolling(n: int) -> str:
    need = -(-7 * n // 10)
    w = f"OVER (PARTITION BY asin, site ORDER BY dt ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"""
        CASE WHEN count(inv) {w} = count(*) {w} AND count(inv) {w} >= {need}
             THEN regr_slope(inv, rn) {w} END AS bsr_trend_{n},
        CASE WHEN count(price) {w} >= {need} THEN stddev_samp(price) {w} / avg(price) {w} END AS price_vol_{n},
        CASE WHEN count(rating) {w} >= {need} THEN avg(rating) {w} END AS rating_mean_{n}"""


QUALITY = """0.25 * (CASE WHEN title_length / 80 < 1 THEN title_length / 80 WHEN title_length IS NOT NULL THEN 1 END)
    + 0.25 * (CASE WHEN bullet_count / 6 < 1 THEN bullet_count / 6 ELSE 1 END)
    + 0.25 * (CASE WHEN image_count >= 7 THEN 1 ELSE image_count / 7 END)
    + 0.25 * (((CASE WHEN has_material_attr THEN 1 ELSE 0 END + CASE WHEN has_size_attr THEN 1 ELSE 0 END
               + CASE WHEN has_use_case_attr THEN 1 ELSE 0 END) / 3.0
              + CASE WHEN has_a_plus THEN 1 ELSE 0 END) / 2.0)"""
FEATURES = f"""
    SELECT asin, site, dt, {_rolling(7)}, {_rolling(14)}, {_rolling(30)},
           reviews_count - lag(reviews_count, 14) OVER (PARTITION BY asin, site ORDER BY dt) AS review_vel_14,
           CASE WHEN count(est_sales) OVER w30 >= 21 THEN avg(est_sales) OVER w30 END AS est_sales_30,
           {QUALITY} AS listing_quality
    FROM (SELECT *, CASE WHEN bsr <> 0 THEN 1 / bsr END AS inv,
                 row_number() OVER (PARTITION BY asin, site ORDER BY dt) AS rn FROM {{mart}}) m
    WINDOW w30 AS (PARTITION BY asin, site ORDER BY dt ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)
"""
FEATURE_COLUMNS = [
    f"{kind}_{n}" for n in (7, 14, 30) for kind in ("bsr_trend", "price_vol", "rating_mean")
] + ["est_sales_30"]
ROLLING_SQL = f"""WITH f AS ({FEATURES}) SELECT asin, site, CAST(dt AS VARCHAR) AS dt,
    {', '.join(r(c, c) for c in FEATURE_COLUMNS)}, review_vel_14::DOUBLE AS review_vel_14 FROM f"""
oracle("features_rolling", ROLLING_SQL)
oracle("features_rolling_blocks", ROLLING_SQL)
oracle(
    "listing_quality",
    f"SELECT asin, site, CAST(dt AS VARCHAR) AS dt, {r(QUALITY, 'listing_quality')} FROM {{mart}}",
)

WEIGHTS = {"bsr_trend_30": 0.35, "est_sales_30": 0.25, "review_vel_14": 0.20, "price_vol_30": -0.10, "listing_quality": 0.30}


def _score_ctes(features: str, category: str) -> str:
    med = ", ".join(f"median({m}) AS {m}" for m in WEIGHTS)
    mad = ", ".join(f"median(abs(CAST(f.{m} AS DOUBLE) - g.{m})) AS {m}" for m in WEIGHTS)
    z = ", ".join(
        f"{'-' if m == 'price_vol_30' else ''}((f.{m} - g.{m}) / CASE WHEN d.{m} = 0 THEN 1e-9 ELSE d.{m} END) AS z_{m}"
        for m in WEIGHTS
    )
    total = " + ".join(f"({w}) * z_{m}" for m, w in WEIGHTS.items())
    same = "{0}.site IS NOT DISTINCT FROM f.site AND {0}.category IS NOT DISTINCT FROM f.category"
    return f"""WITH fw AS ({features}),
      f AS (SELECT fw.*, c.category FROM fw LEFT JOIN ({category}) c ON c.asin = fw.asin AND c.site = fw.site),
      g AS (SELECT site, category, {med} FROM f GROUP BY site, category),
      d AS (SELECT f.site, f.category, {mad} FROM f JOIN g ON {same.format('g')} GROUP BY f.site, f.category),
      zs AS (SELECT f.asin, f.site, f.dt, f.category, {z} FROM f
             JOIN g ON {same.format('g')} JOIN d ON {same.format('d')}),
      scored AS (SELECT *, {total} AS explosive_score FROM zs),
      ranked AS (SELECT *, CASE WHEN explosive_score IS NOT NULL THEN rank() OVER (
                   PARTITION BY site, category ORDER BY explosive_score DESC NULLS LAST) END AS rk FROM scored)"""


DIM_CATEGORY = "SELECT asin, site, category FROM {dim}"
SCORED = _score_ctes(FEATURES, DIM_CATEGORY)
oracle(
    "robust_score",
    f"""{SCORED} SELECT asin, site, CAST(dt AS VARCHAR) AS dt, category, {r('explosive_score', 'explosive_score')},
        {', '.join(r(f'z_{m}', f'z_{m}') for m in WEIGHTS)} FROM scored""",
)
oracle(
    "rank_in_category",
    f"""{SCORED} SELECT asin, site, CAST(dt AS VARCHAR) AS dt, category,
        {r('explosive_score', 'explosive_score')}, rk::DOUBLE AS rank_in_cat FROM ranked WHERE rk <= 20""",
)
oracle(
    "score_reason",
    f"""{SCORED} SELECT asin, site, CAST(dt AS VARCHAR) AS dt, {r('0.3', 'weight')},
        {r('z_listing_quality', 'z')} FROM scored""",
)

EVENT_FEATURES = (
    FEATURES.replace("{mart}", "clean")
    .replace("CASE WHEN count(est_sales) OVER w30 >= 21 THEN avg(est_sales) OVER w30 END", "CAST(NULL AS DOUBLE)")
    .replace(QUALITY, "CAST(NULL AS DOUBLE)")
    .replace("    WINDOW w30 AS (PARTITION BY asin, site ORDER BY dt ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)\n", "")
)
oracle(
    "daily_scores",
    f"""{SCORED} SELECT asin, site, CAST(dt AS VARCHAR) AS dt, category, {r('explosive_score', 'explosive_score')},
        CASE WHEN rk <= 20 THEN rk::DOUBLE END AS rank_in_cat FROM ranked""",
)
oracle(
    "daily_scores_events",
    f"""WITH kept AS ({KEPT.replace('{key}', 'dt').replace('{source}', '{raw}')}), clean AS ({CLEAN}), """
    + _score_ctes(EVENT_FEATURES, "SELECT asin, site, min(event_type) AS category FROM {raw} GROUP BY asin, site")[5:]
    + f""" SELECT asin, site, CAST(dt AS VARCHAR) AS dt, category, {r('explosive_score', 'explosive_score')},
           CASE WHEN rk <= 20 THEN rk::DOUBLE END AS rank_in_cat FROM ranked""",
)

# --- labels ------------------------------------------------------------------

SAMPLES = """
    span AS (SELECT asin, site, min(dt) + 27 AS lo, max(dt) - 30 AS hi FROM {mart} GROUP BY asin, site),
    refs AS (SELECT DISTINCT m.asin, m.site, m.dt AS t_ref FROM {mart} m JOIN span s
             ON s.asin = m.asin AND s.site = m.site AND m.dt BETWEEN s.lo AND s.hi),
    past AS (SELECT t.asin, t.site, t.t_ref, coalesce(sum(m.sales), 0) AS past_sales,
                count(DISTINCT m.dt) / 28.0 AS past_coverage, avg(m.bsr_percentile) AS past_bsr_percentile,
                avg(m.bsr_rank) AS past_bsr_rank, avg(m.sales) AS past_mean_sales,
                stddev_pop(m.sales) AS past_std_sales
             FROM refs t JOIN {mart} m ON m.asin = t.asin AND m.site = t.site
                  AND m.dt BETWEEN t.t_ref - 27 AND t.t_ref
             GROUP BY t.asin, t.site, t.t_ref),
    future AS (SELECT t.asin, t.site, t.t_ref, coalesce(sum(m.sales), 0) AS future_sales,
                count(DISTINCT m.dt) / 30.0 AS future_coverage, avg(m.bsr_percentile) AS future_bsr_percentile,
                avg(m.bsr_rank) AS future_bsr_rank, avg(m.sales) AS future_mean_sales
             FROM refs t LEFT JOIN {mart} m ON m.asin = t.asin AND m.site = t.site
                  AND m.dt BETWEEN t.t_ref + 1 AND t.t_ref + 30
             GROUP BY t.asin, t.site, t.t_ref),
    samples AS (SELECT * FROM past JOIN future USING (asin, site, t_ref))"""
SAMPLE_COLUMNS = (
    "past_sales future_sales past_coverage future_coverage past_bsr_percentile future_bsr_percentile"
    " past_bsr_rank future_bsr_rank past_mean_sales past_std_sales future_mean_sales"
).split()
oracle(
    "label_windows",
    f"""WITH {SAMPLES} SELECT asin, site, CAST(t_ref AS VARCHAR) AS t_ref,
        {', '.join(r(c, c) for c in SAMPLE_COLUMNS)} FROM samples""",
)
TARGETS = f"""{SAMPLES},
    faced AS (SELECT s.*, d.category_id, d.price_band,
                coalesce(s.site, 'unknown_site') || '|' || coalesce(d.category_id, 'unknown_category') || '|' ||
                coalesce(d.price_band, 'unknown_price_band') AS group_id
              FROM samples s LEFT JOIN {{dim}} d ON d.asin = s.asin AND d.site = s.site),
    targets AS (SELECT *, future_sales AS y_reg,
          (rank() OVER (PARTITION BY group_id, t_ref ORDER BY future_sales DESC)
            + (count(*) OVER (PARTITION BY group_id, t_ref, future_sales) - 1) / 2.0)
            / count(*) OVER (PARTITION BY group_id, t_ref) AS y_rank,
          CASE WHEN past_sales > 0 THEN future_sales / past_sales WHEN future_sales > 0 THEN 'inf'::DOUBLE END AS sales_ratio,
          past_bsr_percentile - future_bsr_percentile AS bsr_percentile_drop,
          past_bsr_rank - future_bsr_rank AS bsr_rank_improvement FROM faced),
    labelled AS (SELECT *, CASE WHEN (sales_ratio IS NULL OR sales_ratio >= 1.2) AND
          (coalesce(bsr_percentile_drop >= 0.0513, false) OR coalesce(bsr_rank_improvement > 20, false))
          THEN 1 ELSE 0 END AS y_bin FROM targets),
    days AS (SELECT t_ref, row_number() OVER (ORDER BY t_ref) AS i, count(*) OVER () AS n
             FROM (SELECT DISTINCT t_ref FROM samples)),
    sizes AS (SELECT max(n) AS n, floor(0.7 * max(n)) AS a, floor(0.15 * max(n)) AS b FROM days),
    rest AS (SELECT *, n - a - 2 * b AS rem FROM sizes),
    cuts AS (SELECT a + CASE WHEN rem > 0 THEN 1 ELSE 0 END AS train_n,
                    a + CASE WHEN rem > 0 THEN 1 ELSE 0 END + b + CASE WHEN rem > 1 THEN 1 ELSE 0 END AS valid_n FROM rest),
    placed AS (SELECT t_ref, CASE WHEN i <= (SELECT train_n FROM cuts) THEN 'train'
                      WHEN i <= (SELECT valid_n FROM cuts) THEN 'valid' ELSE 'test' END AS split FROM days),
    split_rows AS (SELECT l.*, p.split FROM labelled l JOIN placed p ON p.t_ref = l.t_ref)"""
oracle(
    "label_targets",
    f"""WITH {TARGETS} SELECT asin, site, CAST(t_ref AS VARCHAR) AS t_ref, group_id, {r('y_reg', 'y_reg')},
        {r('y_rank', 'y_rank')}, {r("CASE WHEN sales_ratio = 'inf'::DOUBLE THEN -1 ELSE sales_ratio END", 'sales_ratio')},
        {r('bsr_percentile_drop', 'bsr_percentile_drop')}, {r('bsr_rank_improvement', 'bsr_rank_improvement')},
        CAST(y_bin AS BIGINT) AS y_bin FROM targets JOIN (SELECT asin AS a, site AS s, t_ref AS t, y_bin FROM labelled)
        ON a = asin AND s = site AND t = t_ref""",
)
oracle(
    "asof_features",
    f"""SELECT u.asin, CAST(u.dt AS VARCHAR) AS t_ref, {r('u.sales', 'sales')}, {r('k.price', 'price')}, {r('k.bsr', 'bsr')}
        FROM (SELECT * FROM {{mart}} WHERE site = 'UK') u
        ASOF LEFT JOIN (SELECT * FROM {{mart}} m2 WHERE site = 'US') k ON k.asin = u.asin AND u.dt >= k.dt""",
)
oracle(
    "feature_vectors",
    f"""WITH {SAMPLES}, f AS ({FEATURES})
        SELECT s.asin, s.site, CAST(s.t_ref AS VARCHAR) AS t_ref,
          (f.est_sales_30 IS NOT NULL)::BIGINT + (f.review_vel_14 IS NOT NULL)::BIGINT
            + (f.listing_quality IS NOT NULL)::BIGINT AS n_features,
          {r('f.est_sales_30', 'est_sales_30')}, {r('f.listing_quality', 'listing_quality')}
        FROM samples s JOIN f ON f.asin = s.asin AND f.site = s.site
          AND f.dt = (SELECT max(x.dt) FROM f x WHERE x.asin = s.asin AND x.site = s.site AND x.dt <= s.t_ref)""",
)
oracle(
    "time_split",
    f"""WITH {TARGETS} SELECT split, count(*) AS n, CAST(min(t_ref) AS VARCHAR) AS first_day,
        CAST(max(t_ref) AS VARCHAR) AS last_day FROM split_rows GROUP BY split""",
)


def _measure(report: str, part: str, group: str, measure: str, value: str) -> str:
    return f"""SELECT '{report}' AS report, split, {part} AS part, '{measure}' AS measure, {r(value, 'value')}
        FROM split_rows GROUP BY {group}"""


BSR = ("past_bsr_percentile", "future_bsr_percentile", "past_bsr_rank", "future_bsr_rank")
REPORTS = [
    _measure("balance", "CAST(y_bin AS VARCHAR)", "split, y_bin", "count", "count(*)"),
    _measure("coverage", "''", "split", "past_coverage", "avg(past_coverage)"),
    _measure("coverage", "''", "split", "future_coverage", "avg(future_coverage)"),
    _measure("mean_encoders", "site", "split, site", "site_mean_y_reg", "avg(y_reg)"),
    _measure("global_stats", "''", "split", "y_reg_mean", "avg(y_reg)"),
    _measure("global_stats", "''", "split", "y_reg_std", "stddev_samp(y_reg)"),
    _measure("global_stats", "''", "split", "n", "count(y_reg)"),
    *[_measure("bsr_availability", "''", "split", c, f"avg(({c} IS NOT NULL)::INT)") for c in BSR],
]
oracle("label_reports", f"WITH {TARGETS} " + " UNION ALL ".join(REPORTS))
MISSING = ["asin", "site", "t_ref", *SAMPLE_COLUMNS, "category_id", "price_band", "metadata", "y_reg", "group_id",
           "y_rank", "sales_ratio", "bsr_percentile_drop", "bsr_rank_improvement", "y_bin", "split"]
oracle(
    "label_missingness",
    f"WITH {TARGETS} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {r("avg(0)" if c == "metadata" else f"avg(({c} IS NULL)::INT)", "missing_fraction")} FROM split_rows"""
        for c in MISSING
    ),
)
oracle(
    "train_tables",
    f"""WITH {TARGETS}, plain AS (SELECT *, (rank() OVER (PARTITION BY site, t_ref ORDER BY future_sales DESC)
            + (count(*) OVER (PARTITION BY site, t_ref, future_sales) - 1) / 2.0)
            / count(*) OVER (PARTITION BY site, t_ref) AS site_rank FROM split_rows)
        SELECT asin, site, CAST(t_ref AS VARCHAR) AS t_ref, split, {r('site_rank', 'y_rank')}, CAST(y_bin AS BIGINT) AS y_bin
        FROM plain WHERE split = 'train'""",
)

# --- metrics -----------------------------------------------------------------

KS = (1, 5, 10, 20)
RANKED = """
    o AS (SELECT query, relevance,
            row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id) AS p,
            row_number() OVER (PARTITION BY query ORDER BY baseline DESC, doc_id) AS bp,
            row_number() OVER (PARTITION BY query ORDER BY relevance DESC, doc_id) AS ip FROM {rank_eval}),
    h AS (SELECT *, sum((relevance > 0)::INT) OVER (PARTITION BY query ORDER BY p) AS ph,
                 sum((relevance > 0)::INT) OVER (PARTITION BY query ORDER BY bp) AS bph FROM o),
    q AS (SELECT query, """ + ", ".join(
    f"""coalesce(sum((pow(2, relevance) - 1) / log2(p + 1)) FILTER (p <= {k})
          / nullif(sum((pow(2, relevance) - 1) / log2(ip + 1)) FILTER (ip <= {k}), 0), 0) AS n{k},
        coalesce(count(*) FILTER (p <= {k} AND relevance > 0) / nullif(count(*) FILTER (relevance > 0), 0), 0) AS r{k},
        coalesce(count(*) FILTER (bp <= {k} AND relevance > 0) / nullif(count(*) FILTER (relevance > 0), 0), 0) AS b{k}"""
    for k in KS
) + """, coalesce(sum(ph / p) FILTER (relevance > 0) / nullif(count(*) FILTER (relevance > 0), 0), 0) AS ap,
         coalesce(sum(bph / bp) FILTER (relevance > 0) / nullif(count(*) FILTER (relevance > 0), 0), 0) AS bap
         FROM h GROUP BY query)"""
METRIC_ROWS = [
    row
    for k in KS
    for row in (
        (f"ndcg@{k}", f"avg(n{k})"),
        (f"recall@{k}", f"avg(r{k})"),
        (f"baseline_recall@{k}", f"avg(b{k})"),
        (f"lift@{k}", f"avg(r{k} - b{k})"),
    )
] + [("map", "avg(ap)"), ("baseline_map", "avg(bap)")]


def metric_rows(pairs, table: str) -> str:
    return " UNION ALL ".join(f"SELECT '{m}' AS metric, {r(v, 'value')} FROM {table}" for m, v in pairs)


oracle("rank_metrics", f"WITH {RANKED} " + metric_rows(METRIC_ROWS, "q"))
oracle(
    "lift_curve",
    f"WITH {RANKED} "
    + " UNION ALL ".join(
        f"""SELECT CAST({k} AS BIGINT) AS k, {r(f'avg(r{k})', 'recall')}, {r(f'avg(b{k})', 'baseline_recall')},
            {r(f'avg(r{k} - b{k})', 'lift')} FROM q"""
        for k in KS
    ),
)
AUC = """(SELECT (sum(rk) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2.0)
            / (count(*) FILTER (y = 1) * count(*) FILTER (y = 0))
          FROM (SELECT y, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS rk FROM e))"""
oracle(
    "binary_metrics",
    f"""WITH e AS (SELECT quality AS y, probability AS p FROM {{rank_eval}}),
        c AS (SELECT count(*) FILTER (y = 1 AND p >= 0.5)::DOUBLE AS tp, count(*) FILTER (y = 0 AND p < 0.5)::DOUBLE AS tn,
                 count(*) FILTER (y = 0 AND p >= 0.5)::DOUBLE AS fp, count(*) FILTER (y = 1 AND p < 0.5)::DOUBLE AS fn,
                 -avg(CASE WHEN y = 1 THEN ln(p) ELSE ln(1 - p) END) AS ll FROM e) """
    + metric_rows(
        [
            ("accuracy", "(tp + tn) / (tp + tn + fp + fn)"),
            ("precision", "tp / (tp + fp)"),
            ("recall", "tp / (tp + fn)"),
            ("f1", "2 * tp / (2 * tp + fp + fn)"),
            ("balanced_accuracy", "(tp / (tp + fn) + tn / (tn + fp)) / 2"),
            ("roc_auc", AUC),
            ("log_loss", "ll"),
        ],
        "c",
    ),
)
oracle(
    "auc_large",
    f"""WITH e AS (SELECT (l_returnflag = 'R')::INT AS y, l_extendedprice AS p FROM lineitem)
        SELECT {r(AUC, 'roc_auc')}""",
)
oracle(
    "regression_metrics",
    "WITH d AS (SELECT * FROM {price_eval}) "
    + metric_rows(
        [
            ("rmse", "sqrt(avg((y - prediction) ** 2))"),
            ("mae", "avg(abs(y - prediction))"),
            ("mse", "avg((y - prediction) ** 2)"),
            ("r2", "1 - sum((y - prediction) ** 2) / sum((y - (SELECT avg(y) FROM d)) ** 2)"),
        ],
        "d",
    ),
)

# --- experiments -------------------------------------------------------------

ASSIGN = """
    SELECT *, CASE WHEN score < CASE WHEN category = 'books' THEN 0.2 ELSE 0.4 END THEN 'control' ELSE 'treatment' END AS variant
    FROM (SELECT *, ('0x' || substr(digest, 1, 13))::BIGINT / 4503599627370496.0::DOUBLE
                  + ('0x' || substr(digest, 14, 13))::BIGINT / 4503599627370496.0::DOUBLE / 4503599627370496.0::DOUBLE AS score
          FROM (SELECT *, sha256('exp-1|' || CASE WHEN category = '' THEN '' ELSE category || '|' END || asin || '|v1') AS digest
                FROM {source}))"""
UNITS = "(SELECT DISTINCT asin, category FROM {ab_log})"
oracle(
    "ab_assign",
    f"SELECT asin, category, variant, {r('score', 'score')} FROM ({ASSIGN.replace('{source}', UNITS)})",
)
oracle(
    "ab_audit",
    f"""SELECT 'exp-1' AS experiment, asin, variant, {r("CASE WHEN category = 'books' THEN 0.8 ELSE 0.6 END", 'treatment_weight')}
        FROM ({ASSIGN.replace('{source}', UNITS)})""",
)


def _uplift(roas: str, roas_z: str, z_digits: int = 6) -> str:
    sums = ", ".join(
        f"sum({c})::DOUBLE AS {c}"
        for c in ("impressions", "clicks", "conversions", "gmv", "gmv_sq", "spend", "roas", "roas_sq")
    )

    def prop(s, n):
        pool = f"((c.{s} + t.{s}) / (c.{n} + t.{n}))"
        return f"(t.{s} / t.{n} - c.{s} / c.{n}) / sqrt({pool} * (1 - {pool}) * (1 / c.{n} + 1 / t.{n}))"

    def mean(s, q):
        var = lambda x: f"({x}.{q} / {x}.impressions - ({x}.{s} / {x}.impressions) ** 2)"
        return f"(t.{s} / t.impressions - c.{s} / c.impressions) / sqrt({var('c')} / c.impressions + {var('t')} / t.impressions)"

    rows = [
        ("CTR", "{0}.clicks / {0}.impressions", prop("clicks", "impressions")),
        ("CR", "{0}.conversions / {0}.clicks", prop("conversions", "clicks")),
        ("GMV per impression", "{0}.gmv / {0}.impressions", mean("gmv", "gmv_sq")),
        ("ROAS", roas, mean("roas", "roas_sq") if roas_z else "NULL"),
    ]
    return f"""WITH a AS ({ASSIGN.replace('{source}', '{ab_log}')}),
        s AS (SELECT variant, {sums} FROM a GROUP BY variant), c AS (SELECT * FROM s WHERE variant = 'control') """ + " UNION ALL ".join(
        f"""SELECT t.variant, '{m}' AS metric, {r(v.format('t'), 'value')},
            {r(f"({v.format('t')} - {v.format('c')}) / ({v.format('c')})", 'lift_vs_control')}, {r(z, 'z', z_digits)}
            FROM s t, c"""
        for m, v, z in rows
    )


oracle("ab_uplift", _uplift("{0}.roas / {0}.impressions", "yes"))
oracle("ab_uplift_spend", _uplift("{0}.gmv / {0}.spend", ""))


def _p_values() -> str:
    """Normal tails of the unrounded z: a fine midpoint sum of the bell curve from 0 to |z|."""
    steps = 20000
    area = f"""list_sum(list_transform(range({steps}), lambda i: exp(-power(least(abs(z), 12.0) * (i + 0.5) / {steps}, 2) / 2)))
        * least(abs(z), 12.0) / {steps} / sqrt(2 * pi())"""
    return f"""SELECT variant, metric, round(greatest(1 - 2 * {area}, 0.0), 6) AS p_value
        FROM ({_uplift("{0}.roas / {0}.impressions", "yes", 15)})"""


oracle("ab_p_values", _p_values())

# --- views -------------------------------------------------------------------

oracle(
    "top_candidates_scored",
    f"""{SCORED} SELECT x.asin, x.site, CAST(x.dt AS VARCHAR) AS dt, {r('x.explosive_score', 'explosive_score')},
        CASE WHEN x.rk <= 20 THEN x.rk::DOUBLE END AS rank_in_cat, d.title, d.brand, d.brand || '>' || d.title AS category_path,
        {r('m.bsr', 'bsr')}, {r('m.price', 'price')}, m.reviews_count
        FROM ranked x JOIN {{dim}} d ON d.asin = x.asin AND d.site = x.site
        JOIN {{mart}} m ON m.asin = x.asin AND m.site = x.site AND m.dt = x.dt""",
)
TOP_VIEW = """
    SELECT p.snapshot_date, p.asin, p.site, p.category, p.predicted_revenue, p.predicted_units, p.confidence_score,
           p.revenue_rank, p.quality_rank, c.avg_category_revenue, c.avg_category_units,
           p.predicted_revenue - c.avg_category_revenue AS revenue_vs_category,
           p.predicted_units - c.avg_category_units AS units_vs_category,
           s.summary_text AS ai_comment_summary, k.cluster_label AS ai_keyword_cluster
    FROM (SELECT *, row_number() OVER (PARTITION BY snapshot_date, site
                      ORDER BY predicted_revenue DESC, confidence_score DESC, asin) AS revenue_rank,
                 row_number() OVER (PARTITION BY snapshot_date, site ORDER BY confidence_score DESC, asin) AS quality_rank
          FROM {predictions}) p
    LEFT JOIN {category_snapshot} c ON c.snapshot_date = p.snapshot_date AND c.category = p.category
    LEFT JOIN {summaries} s ON s.snapshot_date = p.snapshot_date AND s.asin = p.asin AND s.site = p.site
    LEFT JOIN {clusters} k ON k.snapshot_date = p.snapshot_date AND k.asin = p.asin AND k.site = p.site
    WHERE p.revenue_rank <= 500"""
TOP_COLUMNS = f"""CAST(snapshot_date AS VARCHAR) AS snapshot_date, asin, site, category,
    {', '.join(r(c, c, 4) for c in ('predicted_revenue', 'predicted_units', 'confidence_score'))}, revenue_rank, quality_rank,
    {', '.join(r(c, c, 4) for c in ('avg_category_revenue', 'avg_category_units', 'revenue_vs_category', 'units_vs_category'))},
    ai_comment_summary, ai_keyword_cluster"""
oracle("top_candidates_daily", f"SELECT {TOP_COLUMNS} FROM ({TOP_VIEW})")
oracle("top_candidates_top5", f"SELECT {TOP_COLUMNS} FROM ({TOP_VIEW}) WHERE revenue_rank <= 5")
oracle(
    "features_latest_wide",
    f"""WITH f AS ({FEATURES}) SELECT DISTINCT ON (asin, site) asin, site, CAST(dt AS VARCHAR) AS dt,
        {', '.join(r(c, c) for c in ('bsr_trend_7', 'bsr_trend_30', 'price_vol_30'))}, review_vel_14::DOUBLE AS review_vel_14,
        {', '.join(r(c, c) for c in ('rating_mean_30', 'est_sales_30', 'listing_quality'))}
        FROM f ORDER BY asin, site, f.dt DESC""",
)
oracle(
    "features_latest_long",
    f"""SELECT asin, site, feature_name, {r('feature_value', 'feature_value')}, CAST(snapshot_ts AS VARCHAR) AS snapshot_ts
        FROM {{history}} h WHERE NOT EXISTS (SELECT 1 FROM {{history}} x WHERE x.asin = h.asin AND x.site = h.site
          AND x.feature_name = h.feature_name AND x.snapshot_ts > h.snapshot_ts)""",
)


def _pred_rank(source: str) -> str:
    def w(column, direction="", tie=""):
        return f"OVER (PARTITION BY snapshot_date, site ORDER BY {column} {direction}{tie})"

    return f"""SELECT CAST(snapshot_date AS VARCHAR) AS snapshot_date, asin, site, category,
        {r('predicted_revenue', 'predicted_revenue', 4)}, {r('predicted_units', 'predicted_units', 4)},
        {r(f"percent_rank() {w('predicted_revenue')}", 'revenue_percentile', 4)},
        {r(f"percent_rank() {w('predicted_units')}", 'units_percentile', 4)},
        ntile(100) {w('predicted_revenue', 'DESC', ', asin')} AS revenue_ntile,
        ntile(100) {w('predicted_units', 'DESC', ', asin')} AS units_ntile FROM {source}"""


oracle("pred_rank_daily", _pred_rank("{predictions}"))
oracle(
    "pred_rank_monthly",
    _pred_rank(
        """(SELECT CAST(date_trunc('month', snapshot_date) AS DATE) AS snapshot_date, asin, site, category,
              sum(round(predicted_revenue, 2)) AS predicted_revenue, sum(predicted_units) AS predicted_units
            FROM {predictions} GROUP BY ALL)"""
    ),
)

# --- weekly report -----------------------------------------------------------

LAST = "(SELECT max(snapshot_date) FROM {predictions})"
WEEK = f"snapshot_date BETWEEN {LAST} - 6 AND {LAST}"
WEEK_TOP = f"SELECT * FROM ({TOP_VIEW}) WHERE {WEEK} ORDER BY snapshot_date DESC, quality_rank, site, asin LIMIT 100"
oracle("weekly_top", f"SELECT {TOP_COLUMNS} FROM ({WEEK_TOP})")
oracle(
    "category_deltas",
    f"""WITH d AS (SELECT snapshot_date, category, sum(predicted_revenue) AS v FROM ({TOP_VIEW})
                   WHERE snapshot_date BETWEEN {LAST} - 13 AND {LAST} GROUP BY ALL),
        n AS (SELECT *, dense_rank() OVER (ORDER BY snapshot_date DESC) AS k FROM d)
        SELECT category, {r('max(v) FILTER (k = 1) - max(v) FILTER (k = 2)', 'delta', 4)},
          {r('(max(v) FILTER (k = 1) - max(v) FILTER (k = 2)) / nullif(max(v) FILTER (k = 2), 0)', 'delta_pct', 4)}
        FROM n GROUP BY category""",
)
oracle(
    "revenue_anomalies",
    f"""WITH w AS (SELECT * FROM {{predictions}} WHERE {WEEK}),
        z AS (SELECT *, (predicted_revenue - avg(predicted_revenue) OVER g) / nullif(stddev_pop(predicted_revenue) OVER g, 0) AS z
              FROM w WINDOW g AS (PARTITION BY site, category))
        SELECT CAST(snapshot_date AS VARCHAR) AS snapshot_date, {r('predicted_revenue', 'predicted_revenue', 4)}, site, category,
          {r('z', 'z_score', 3)} FROM z WHERE abs(z) >= 2.0""",
)
oracle(
    "ai_sections",
    f"""SELECT DISTINCT CAST(snapshot_date AS VARCHAR) AS snapshot_date, asin, site,
        coalesce(ai_comment_summary, '待运营审核') AS ai_text FROM ({WEEK_TOP})""",
)

# --- alerts ------------------------------------------------------------------

MART_COLUMNS = (
    "asin site dt sales est_sales price bsr rating reviews_count bsr_percentile bsr_rank title_length bullet_count"
    " image_count has_material_attr has_size_attr has_use_case_attr has_a_plus"
).split()
RATIO = "(" + " + ".join(f"avg(({c} IS NULL)::INT)" for c in MART_COLUMNS) + f") / {len(MART_COLUMNS)}"
oracle(
    "alert_quality",
    f"""SELECT 'data_quality' AS category, 'high' AS severity, {r('m', 'missing_ratio')}
        FROM (SELECT {RATIO} AS m FROM {{mart}}) WHERE m > 1 - 0.999""",
)
ACCURACY = """SELECT 1 - avg(abs(p.predicted_revenue - a.actual_revenue) / abs(a.actual_revenue)) FILTER (a.actual_revenue <> 0) AS v
    FROM {predictions} p JOIN {actuals} a ON a.asin = p.asin AND a.site = p.site AND a.snapshot_date = p.snapshot_date"""
oracle(
    "alert_accuracy",
    f"""WITH v AS ({ACCURACY}) SELECT 'all' AS category, '' AS severity, {r('v', 'accuracy')} FROM v
        UNION ALL SELECT 'performance', 'high', {r('v', 'accuracy')} FROM v WHERE v < 0.75""",
)
DRIFT = " UNION ALL ".join(
    f"""SELECT 'drift' AS category, '{c}' AS feature, {r(f"abs(n.{c} - b.{c}) / CASE WHEN b.{c} = 0 THEN 1 ELSE abs(b.{c}) END", 'drift_score')}
        FROM n, b"""
    for c in ("sales", "price", "bsr", "rating", "bsr_rank")
)
MEANS = ", ".join(f"avg({c}) AS {c}" for c in ("sales", "price", "bsr", "rating", "bsr_rank"))
oracle(
    "alert_drift",
    f"""WITH n AS (SELECT {MEANS} FROM {{mart}} WHERE dt >= DATE '1999-01-01'),
        b AS (SELECT {MEANS} FROM {{mart}} WHERE dt < DATE '1999-01-01') {DRIFT}""",
)
LATE = "date_diff('microsecond', scheduled_at, completed_at) / 60000000.0"
oracle(
    "alert_sla",
    f"""SELECT 'sla' AS category, 'high' AS severity, pipeline AS run, {r(LATE, 'delay_minutes')}
        FROM {{runs}} WHERE {LATE} > 90""",
)
oracle(
    "alert_run",
    f"""SELECT category, severity, sum(n)::BIGINT AS n FROM (
          SELECT 'data_quality' AS category, 'high' AS severity, count(*) AS n FROM (SELECT {RATIO} AS m FROM {{mart}}) WHERE m > 1 - 0.999
          UNION ALL SELECT 'performance', 'high', count(*) FROM ({ACCURACY}) WHERE v < 1.0
          UNION ALL SELECT 'drift', 'medium', 5
          UNION ALL SELECT 'sla', 'high', count(*) FROM {{runs}} WHERE {LATE} > 90)
        GROUP BY ALL HAVING sum(n) > 0""",
)

# --- payloads and vendor feeds -----------------------------------------------

oracle(
    "payload_timeseries",
    f"""SELECT asin, site, CAST(dt AS VARCHAR) AS dt, {r('price', 'price')}, {r('bsr', 'bsr')}, {r('rating', 'rating')},
        {r('reviews_count', 'reviews_count')}, {r('bullet_count', 'stock_est')},
        'seller-' || CAST(CAST(bullet_count AS INT) AS VARCHAR) AS buybox_seller, 'keepa' AS _source FROM {{mart}}""",
)
SITE_OF_SIZE = """CASE p_size WHEN 2 THEN 'UK' WHEN 3 THEN 'DE' WHEN 4 THEN 'FR' WHEN 5 THEN 'JP' WHEN 6 THEN 'CA'
    WHEN 8 THEN 'IT' WHEN 9 THEN 'ES' WHEN 10 THEN 'IN' WHEN 11 THEN 'MX' WHEN 12 THEN 'AU' ELSE 'US' END"""
oracle(
    "payload_dim",
    f"""SELECT 'P' || p_partkey AS asin, {SITE_OF_SIZE} AS site, p_name AS title, p_brand AS brand,
        p_type || '>' || p_brand AS category_path, p_name || '.jpg>' || p_brand || '.jpg' AS images FROM part""",
)
oracle(
    "payload_keywords",
    f"""SELECT 'P' || p_partkey AS asin, {SITE_OF_SIZE} AS site, p_name AS keyword, p_size::DOUBLE AS est_search_volume,
          {r('p_retailprice', 'cpc')}, NULL::DOUBLE AS difficulty, 'keepa' AS _source FROM part
        UNION ALL SELECT 'P' || p_partkey, {SITE_OF_SIZE}, p_type, NULL, NULL, {r('p_size / 50.0', 'difficulty')}, 'keepa' FROM part""",
)
REVIEW_NAME = "concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity)"
oracle(
    "payload_reviews",
    " UNION ALL ".join(
        f"""SELECT 'O' || l_orderkey AS asin, 'DE' AS site, {REVIEW_NAME} || '{tail}' AS review_id,
            CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS dt, l_linenumber::BIGINT AS rating, l_returnflag AS title,
            l_linestatus AS text, (l_tax > 0.04)::BIGINT AS verified, 'keepa' AS _source FROM lineitem"""
        for tail in ("", "-b")
    ),
)
oracle(
    "dead_letter",
    """SELECT DISTINCT p.asin, p.site, CASE WHEN p.site = 'US' AND p.category IN ('PROMO', 'SMALL')
         THEN 'keepa_fetch_failed' ELSE '' END AS reason FROM {predictions} p""",
)
oracle(
    "order_items",
    " UNION ALL ".join(
        f"""SELECT 'P' || l_partkey AS asin, o_orderstatus AS site, o_orderkey::VARCHAR AS order_id,
            (l_quantity + {extra})::BIGINT AS ordered_units, l_linenumber::BIGINT AS shipped_units, 'USD' AS currency,
            {r('o_totalprice', 'gross_sales')}, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS purchase_date
            FROM lineitem JOIN orders ON o_orderkey = l_orderkey"""
        for extra in (0, 1)
    ),
)
oracle(
    "inventory_rows",
    """SELECT 'P' || p_partkey AS asin, 'US' AS site, p_size::BIGINT AS fulfillable_quantity,
       NULL::DOUBLE AS inbound_working, p_type AS last_updated FROM part""",
)
oracle(
    "ads_metrics",
    f"""SELECT 'profile-1' AS profile_id, category AS site, asin AS date, sum(impressions)::BIGINT AS impressions,
        sum(clicks)::BIGINT AS clicks, {r('sum(spend)', 'spend')}, {r('sum(gmv)', 'sales')}, 0::BIGINT AS acos_known,
        {r('sum(roas)', 'cvr')} FROM {{ab_log}} GROUP BY category, asin""",
)
oracle(
    "vendor_keywords",
    " UNION ALL ".join(
        f"""SELECT {word} AS keyword, 'US' AS site, p_size::DOUBLE AS est_search_volume, NULL::DOUBLE AS difficulty,
            {r('p_retailprice', 'cpc')}, '{source}' AS _source FROM part"""
        for word, source in (("p_name", "junglescout"), ("p_brand", "helium10"))
    ),
)
oracle(
    "catalogue_items",
    """SELECT 'P' || p_partkey AS asin, 'US' AS site, p_name AS title, p_brand AS brand, p_type AS category_path,
       p_name || '-s>' || p_name || '-l' AS images FROM part""",
)
oracle(
    "landed_payloads",
    f"""SELECT {SITE_OF_SIZE} AS site, count(*) AS documents, max(p_name) AS last_title FROM part
        WHERE p_type <> 'PROMO' GROUP BY 1""",
)
oracle(
    "snapshot_asof",
    f"""WITH n AS (SELECT max(CAST(snapshot_ts AS DATE)) - 7 AS d FROM {{history}})
        SELECT site, feature_name, count(*) AS n, {r('sum(feature_value)', 'total')}, CAST((SELECT d FROM n) AS VARCHAR) AS snapshot_date
        FROM {{history}} WHERE CAST(snapshot_ts AS DATE) = (SELECT d FROM n) GROUP BY site, feature_name""",
)
oracle(
    "dataset_scan",
    "SELECT p_brand, count(*) AS n, sum(p_size)::BIGINT AS size FROM part GROUP BY p_brand",
)
oracle(
    "ingest_increments",
    """WITH m AS (SELECT *, max(dt) OVER () AS last FROM {mart})
       SELECT site, count(*) AS n, 'series' AS "table" FROM m WHERE dt >= last - 2 GROUP BY site
       UNION ALL SELECT site, count(*), 'reviews' FROM m WHERE dt >= last - 7 GROUP BY site""",
)

# --- text --------------------------------------------------------------------

STRIP = r"regexp_replace({0}, '^[\s\x{{85}}\p{{Z}}\x1c-\x1f\x0b]+|[\s\x{{85}}\p{{Z}}\x1c-\x1f\x0b]+$', '', 'g')"
TOKENS = f"""
    SELECT doc_id, lang, pos - 1 AS pos, {STRIP.format('word')} AS w FROM (
      SELECT doc_id, lang, unnest(string_split(text, ' ')) AS word, generate_subscripts(string_split(text, ' '), 1) AS pos
      FROM documents)"""
FIRST_WORDS = f"""
    SELECT *, row_number() OVER (PARTITION BY {{scope}}lower(w) ORDER BY doc_id, pos) AS k FROM ({TOKENS})
    WHERE w <> '' AND lower(w) NOT IN ('a', 'an', 'and', 'or', 'the', 'to', 'with', 'for')"""
ORACLES["keyword_clean"] = f"""SELECT lower(w) AS keyword_key, w AS keyword, doc_id AS first_doc_id, pos::BIGINT AS first_pos
    FROM ({FIRST_WORDS.replace('{scope}', '')}) WHERE k = 1"""
ORACLES["keyword_clean_by_language"] = f"""SELECT lang, count(*) AS keywords, sum(pos)::BIGINT AS places
    FROM ({FIRST_WORDS.replace('{scope}', 'lang, ')}) WHERE k = 1 GROUP BY lang"""
PROMPT = """'You are preparing concise summaries for the customer feedback review.' || chr(10)
    || 'Summarise the key themes and actionable points from the following comments:' || chr(10)
    || string_agg('- ' || text, chr(10) ORDER BY i) || chr(10) || chr(10) || 'Format the answer as bullet points grouped by theme.'"""
NUMBERED = "SELECT *, row_number() OVER (ORDER BY conv_id, turn) - 1 AS i FROM {comments}"
oracle(
    "comment_batches",
    f"SELECT (i // 10)::BIGINT AS batch_index, count(*) AS n, {PROMPT} AS prompt FROM ({NUMBERED}) GROUP BY 1",
)
oracle(
    "label_centroids",
    f"""SELECT label::BIGINT AS cluster_id, count(*) AS keyword_count, (dim - 1)::BIGINT AS dim, {r('avg(x)', 'x', 5)} FROM (
          SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS dim FROM embeddings)
        GROUP BY label, dim""",
)

# --- scoring -----------------------------------------------------------------

COEFFICIENTS = {
    "price": (0.002, 50000.0),
    "bsr": (-0.5, 500.0),
    "rating": (3.0, 2.5),
    "reviews_count": (4.0, 6.0),
    "bullet_count": (-2.0, 4.0),
    "image_count": (1.5, 5.0),
}
INTERCEPT = 10 + sum(c * m for c, m in COEFFICIENTS.values())
PARTS = ", ".join(f"({c}) * (coalesce({n}, {m}) - {m}) AS c_{n}" for n, (c, m) in COEFFICIENTS.items())
SCORES = f"""
    SELECT *, {INTERCEPT} + ({' + '.join('c_' + n for n in COEFFICIENTS)}) AS lgbm_score,
           coalesce(site, 'UNKNOWN') || '|' || coalesce(category, 'UNKNOWN') || '|' || coalesce(price_band, 'UNKNOWN') AS group_id
    FROM (SELECT m.*, d.category, d.price_band, {PARTS} FROM {{mart}} m JOIN {{dim}} d ON d.asin = m.asin AND d.site = m.site)"""
oracle(
    "batch_score_ranks",
    f"""WITH s AS ({SCORES}),
        k AS (SELECT *, dense_rank() OVER (PARTITION BY group_id ORDER BY lgbm_score DESC) AS g,
                dense_rank() OVER (PARTITION BY site, category ORDER BY lgbm_score DESC) AS c FROM s)
        SELECT asin, site, CAST(dt AS VARCHAR) AS dt, {r('lgbm_score', 'lgbm_score')}, group_id, g::DOUBLE AS rank_in_group,
          CASE WHEN c <= 20 THEN c::DOUBLE END AS rank_in_cat, 'rank-linear' AS model_version FROM k""",
)
LONG = " UNION ALL ".join(f"SELECT asin, site, dt, '{n}' AS name, c_{n} AS v FROM s" for n in COEFFICIENTS)
oracle(
    "top_contributors",
    f"""WITH s AS MATERIALIZED ({SCORES}), l AS ({LONG}),
        k AS (SELECT *, row_number() OVER (PARTITION BY asin, site, dt ORDER BY abs(v) DESC, name) AS i FROM l)
        SELECT asin, site, CAST(dt AS VARCHAR) AS dt, 5::BIGINT AS n, max(name) FILTER (i = 1) AS first,
          max(name) FILTER (i = 5) AS fifth, {r('max(v) FILTER (i = 1)', 'first_value')}
        FROM k GROUP BY asin, site, dt""",
)
oracle(
    "request_records",
    f"""SELECT asin, site, CAST(dt AS VARCHAR) AS dt, {r('sales', 'est_sales_30')}, NULL::DOUBLE AS bsr_trend_30,
        {r('rating', 'rating')} FROM {{mart}}""",
)
oracle(
    "batch_job",
    f"""WITH s AS ({SCORES}),
        k AS (SELECT *, dense_rank() OVER (PARTITION BY group_id ORDER BY lgbm_score DESC) AS g,
                dense_rank() OVER (PARTITION BY site, category ORDER BY lgbm_score DESC) AS c FROM s)
        SELECT asin, site, CAST(dt AS VARCHAR) AS dt, category, {r('lgbm_score', 'explosive_score')},
          CASE WHEN c <= 20 THEN c::DOUBLE END AS rank_in_cat, g::DOUBLE AS rank_in_group, 5::BIGINT AS n FROM k""",
)

# --- splits ------------------------------------------------------------------


def _drawn(source: str, by: str, seed: int, key: str) -> str:
    over = f"PARTITION BY {by} " if by else ""
    return f"""SELECT *, row_number() OVER ({over}ORDER BY sha256('{seed}|' || {key}), {key}) AS i,
        count(*) OVER ({over}) AS size FROM {source}"""


CUSTOMERS = "(SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)"
ORACLES["group_split"] = f"""SELECT o_custkey, (i <= ceil(size * 0.2))::BIGINT AS is_validation, n
    FROM ({_drawn(CUSTOMERS, '', 42, 'o_custkey')})"""
ORACLES["group_kfold"] = f"""SELECT o_custkey, ntile(3) OVER (ORDER BY i) - 1 AS fold, n
    FROM ({_drawn(CUSTOMERS, '', 42, 'o_custkey')})"""
ORACLES["stratified_split"] = f"""SELECT o_orderkey, o_orderpriority, (i <= ceil(size * 0.15))::BIGINT AS is_validation
    FROM ({_drawn('orders', 'o_orderpriority', 7, 'o_orderkey')})"""
ORACLES["random_split"] = f"""SELECT o_orderkey, (i <= ceil(size * 0.1))::BIGINT AS is_validation
    FROM ({_drawn('orders', '', 7, 'o_orderkey')})"""
oracle(
    "class_weight",
    f"""SELECT {r('count(*) FILTER (quality = 0) / count(*) FILTER (quality = 1)', 'weight')} FROM {{rank_eval}}""",
)

# --- calendar ----------------------------------------------------------------

ORDER_DAYS = "(SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)"
ORACLES["rolling_dates"] = f"""SELECT CAST(CAST(day AS DATE) AS VARCHAR) AS day, count(*) AS windows FROM (
    SELECT unnest(generate_series(d - 6, d, INTERVAL 1 DAY)) AS day FROM {ORDER_DAYS}) GROUP BY 1"""
ORACLES["window_pairs"] = f"""SELECT CAST(d AS VARCHAR) AS start, CAST(d + 27 AS VARCHAR) AS "end" FROM {ORDER_DAYS}
    WHERE d + 27 <= (SELECT max(d) FROM {ORDER_DAYS})"""
