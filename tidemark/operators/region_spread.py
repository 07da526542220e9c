"""Regional price against the national series (C4 - C4d)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import guarded_pct_change, label_by_thresholds, round_half_away

# ---- fixed values -----------------------------------------------------------
CATEGORY_LABELS = (
    "Significantly Above Average",
    "Above Average",
    "Near National Average",
    "Below Average",
    "Significantly Below Average",
)
# -----------------------------------------------------------------------------


def region_spread(regional: DataFrame, national: DataFrame, *, region_col: str = "region",
                  time_col: str = "week_date", regional_price: str = "price",
                  national_price: str = "regular", fuel_type: str | None = "REGULAR_GASOLINE",
                  fuel_type_col: str = "fuel_type", national_region: str | None = "US_NATIONAL",
                  window: int = 4,
                  bands: tuple[float, float, float, float] = (-0.30, -0.10, 0.10, 0.30),
                  places: int = 4, pct_places: int = 2,
                  null_label: str | None = None) -> DataFrame:
    """Spread of every regional series against the national one.

    Regional rows (fuel type, price not NULL) left-join the national series
    (rows of ``national_region`` when the national table has a region column)
    on week; spread rounded, percent only when national > 0; then per region
    a trailing ``window``-row mean and the running maximum spread (NULLs
    ignored); five-way category on the rounded spread with strict ``>``,
    NULL (no national week) falls to the last label.

    The national side is one row per week: AQE broadcasts it from its
    measured size. Both regional windows share one Exchange + Sort.
    """
    reg = regional
    if fuel_type is not None:
        reg = reg.filter(F.col(fuel_type_col) == F.lit(fuel_type))
    reg = (reg.filter(F.col(regional_price).isNotNull())
              .select(time_col, region_col, F.col(regional_price).alias("regional_price")))
    if national_region is not None and region_col in national.columns:
        national = national.filter(F.col(region_col) == F.lit(national_region))
    nat = (national.filter(F.col(national_price).isNotNull())
                   .select(time_col, F.col(national_price).alias("national_price")))
    joined = reg.join(nat, on=time_col, how="left").select(
        time_col, region_col, "regional_price", "national_price",
        round_half_away(F.col("regional_price") - F.col("national_price"), places)
        .alias("price_spread"),
        guarded_pct_change("regional_price", "national_price", pct_places)
        .alias("price_spread_pct"))
    w = Window.partitionBy(region_col).orderBy(time_col)
    b1, b2, b3, b4 = sorted(bands)
    category = label_by_thresholds(
        "price_spread",
        [(b4, CATEGORY_LABELS[0]), (b3, CATEGORY_LABELS[1]),
         (b2, CATEGORY_LABELS[2]), (b1, CATEGORY_LABELS[3])],
        CATEGORY_LABELS[4], null_label=null_label)
    return joined.select(
        time_col, region_col, "regional_price", "national_price", "price_spread",
        "price_spread_pct",
        round_half_away(F.avg("regional_price").over(
            w.rowsBetween(-(window - 1), Window.currentRow)), places)
        .alias(f"regional_{window}wk_avg"),
        round_half_away(F.max("price_spread").over(
            w.rowsBetween(Window.unboundedPreceding, Window.currentRow)), places)
        .alias("max_spread_seen"),
        category.alias("price_category"))
