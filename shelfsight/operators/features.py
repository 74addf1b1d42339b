"""Rolling daily features per product and site."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfsight.functions.columns import capped_share, flag, number
from shelfsight.operators.running import group_sizes, running_sums
from shelfsight.schemas import ensure_columns
from shelfsight.settings import HOT_ROWS, MIN_PERIOD_SHARE, ROLLING_WINDOWS
from shelfsight.sources.scratch import materialize

LISTING_COLUMNS = {
    "title_length": "double",
    "bullet_count": "double",
    "image_count": "double",
    "has_material_attr": "boolean",
    "has_size_attr": "boolean",
    "has_use_case_attr": "boolean",
    "has_a_plus": "boolean",
}
# Rows of one key per block when a panel is cut (several times the longest window).
BLOCK_ROWS = 4096


def listing_quality() -> Column:
    """Average of title, bullet, media and attribute scores, each at most 1.

    A missing length or count leaves the score missing; a missing flag is false.
    """
    title = capped_share(F.col("title_length"), 80)
    bullets = capped_share(F.col("bullet_count"), 6)
    media = F.when(F.col("image_count") >= 7, 1.0).otherwise(F.col("image_count") / 7)
    attributes = sum(
        flag(c).cast("int") for c in ("has_material_attr", "has_size_attr", "has_use_case_attr")
    )
    extras = (attributes / 3 + flag("has_a_plus").cast("int")) / 2
    return 0.25 * title + 0.25 * bullets + 0.25 * media + 0.25 * extras


def add_listing_quality(df: DataFrame) -> DataFrame:
    """Add `listing_quality`, treating absent listing columns as missing."""
    return ensure_columns(df, LISTING_COLUMNS).withColumn("listing_quality", listing_quality())


def _known(window, column: str, rows: int) -> Column:
    """How many of the last `rows` values are present, from the running count."""
    running = F.col(f"_n{column}")
    return running - F.lag(running, rows, 0).over(window)


def _rolling(window, rows: int, minimum: int) -> dict[str, Column]:
    """Trend, volatility and mean over the last `rows` rows of `window`.

    A sliding frame is summed anew for each row, so only what needs it is: counts
    come from running counts, and the least-squares slope of n consecutive rows is
    (sum(x·y) − mean(x)·sum(y)) / (n·(n² − 1)/12).
    """
    frame = window.rowsBetween(-(rows - 1), 0)
    place, inverse, price = F.col("_place"), F.col("_inverse"), F.col("_price")
    seen = F.least(place, F.lit(rows))
    # A gap anywhere in the window voids the trend.
    complete = (_known(window, "_inverse", rows) == seen) & (seen >= minimum)
    middle = place - (seen - 1) / 2
    moment = F.sum(place * inverse).over(frame) - middle * F.sum(inverse).over(frame)
    slope = moment / F.nullif(seen * (seen * seen - 1) / 12.0, F.lit(0.0))
    spread = F.try_divide(F.stddev_samp(price).over(frame), F.avg(price).over(frame))
    return {
        f"bsr_trend_{rows}": F.when(complete & (seen == 1), F.lit(0.0)).when(complete, slope),
        f"price_vol_{rows}": F.when(_known(window, "_price", rows) >= minimum, spread),
        f"rating_mean_{rows}": F.when(
            _known(window, "_rating", rows) >= minimum, F.avg("_rating").over(frame)
        ),
    }


def build_features(
    mart: DataFrame,
    rolling: Sequence[int] = ROLLING_WINDOWS,
    tie_break: Sequence[str] = (),
    daily: bool = False,
    block_rows: int = BLOCK_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Rolling trends, volatility, means and listing quality per (asin, site, dt).

    Windows count rows, not days. Set `daily` for one row per product, site and
    day (as `standardize(dedup_on="date")` leaves them): a key is then no longer
    than the calendar, and one shuffle and sort per key serves all windows. Else
    the keys are measured, and with a hot one rows are numbered in range slices
    and cut into blocks that overlap by the longest window. Rows of one day are
    ordered by `tie_break`, then by their values.
    """
    panel = ensure_columns(
        mart, {"bsr": "double", "price": "double", "rating": "double", "reviews_count": "double"}
    )
    panel = add_listing_quality(panel).where(F.col("asin").isNotNull() & F.col("site").isNotNull())
    sales = number("est_sales") if "est_sales" in mart.columns else F.lit(None).cast("double")
    bsr = number("bsr")
    key = ["asin", "site"]
    rows = panel.select(
        *key,
        "dt",
        *[c for c in tie_break if c not in ("asin", "site", "dt")],
        F.when(bsr != 0, 1 / bsr).alias("_inverse"),
        number("price").alias("_price"),
        number("rating").alias("_rating"),
        F.col("reviews_count").alias("_reviews"),
        sales.alias("_sales"),
        "listing_quality",
    )
    reach = max([*rolling, 30, 15])
    order = [F.col("dt").asc_nulls_first()]
    if not daily:
        order += [F.col(c).asc_nulls_first() for c in rows.columns if c not in (*key, "dt")]
    if not daily:
        # Measuring, cutting and numbering each pass over these few columns: write them once.
        rows = materialize(rows, "panel")
    sizes = None if daily else group_sizes(rows, key)
    blocked = sizes is not None and sizes.largest > hot_rows
    if not blocked:
        window = Window.partitionBy(*key).orderBy(*order)
        rows = rows.withColumn("_place", F.row_number().over(window))
    else:
        rows = running_sums(rows, key, order, {"_row": F.lit(1).cast("bigint")}, hot_rows, sizes)
        block_rows = max(block_rows, reach)
        home = F.floor((F.col("_row") - 1) / block_rows)
        # The last `reach` rows of a block are repeated as lead-in of the next one.
        leads_in = F.col("_row") % block_rows > block_rows - reach
        edge = leads_in | (F.col("_row") % block_rows == 0)
        blocks = F.when(edge, F.array(home, home + 1)).otherwise(F.array(home))
        rows = rows.withColumn("_home", home).withColumn("_block", F.explode(blocks))
        window = Window.partitionBy(*key, "_block").orderBy("_row")
        # Places restart in each block, which keeps the sums of the slope small.
        rows = rows.withColumn("_place", F.row_number().over(window))

    so_far = window.rowsBetween(Window.unboundedPreceding, 0)
    counted = ("_inverse", "_price", "_rating", "_sales")
    rows = rows.withColumns({f"_n{c}": F.count(c).over(so_far) for c in counted})
    features: dict[str, Column] = {}
    for size in rolling:
        features |= _rolling(window, size, math.ceil(size * MIN_PERIOD_SHARE))
    month = window.rowsBetween(-29, 0)
    features["review_vel_14"] = F.col("_reviews") - F.lag("_reviews", 14).over(window)
    features["est_sales_30"] = F.when(
        _known(window, "_sales", 30) >= math.ceil(30 * MIN_PERIOD_SHARE), F.avg("_sales").over(month)
    )
    out = rows.withColumns(features)
    if blocked:
        out = out.where(F.col("_block") == F.col("_home"))
    return out.select("asin", "site", "dt", *features, "listing_quality")
