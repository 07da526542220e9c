"""The fixture tables and model labels reproduce the counts listed for sf0.01."""

import pytest

from tidemark import catalog
from tidemark.operators.region_spread import region_spread
from tidemark.sources import fixtures as fx

SF01 = "/root/testdata/sf0.01"


def _counts(df, col):
    return {r[0]: r[1] for r in df.groupBy(col).count().collect()}


def test_table_sizes(spark):
    fuel = fx.fuel_weekly(spark, SF01)
    assert fuel.count() == 345 and fuel.filter("regular is not null").count() == 344
    assert fx.regional_weekly(spark, SF01).count() == 1721
    assert _counts(fx.market_weekly(spark, SF01), "ticker") == {"A": 357, "N": 357, "R": 357}
    small = fx.fuel_weekly(spark, "/root/testdata/sf0.001")
    assert (small.count(), small.filter("regular is not null").count()) == (343, 202)
    assert fx.regional_weekly(spark, "/root/testdata/sf0.001").count() == 1005


@pytest.mark.parametrize("price,direction,vol,margin,category", [
    ("regular", (161, 166, 17), (338, 5, 1), (109, 148, 87), (572, 203, 225, 196, 525)),
    ("all_grades", (149, 146, 50), (25, 284, 36), (76, 228, 41), (440, 265, 304, 273, 439)),
])
def test_label_counts(spark, price, direction, vol, margin, category):
    v = catalog.vol_model(spark, SF01, price)
    d = _counts(v, "price_direction")
    assert (d["Rising"], d["Falling"], d["Stable"]) == direction
    vl = _counts(v, "volatility_label")
    assert (vl["High Volatility"], vl["Moderate Volatility"], vl["Low Volatility"]) == vol
    m = _counts(catalog.crude_model(spark, SF01, price), "margin_category")
    assert (m["Wide Margin"], m["Normal Margin"], m["Tight Margin"]) == margin
    rc = region_spread(fx.regional_weekly(spark, SF01), fx.fuel_weekly(spark, SF01),
                       national_price=price)
    c = _counts(rc, "price_category")
    assert tuple(c[k] for k in ("Significantly Above Average", "Above Average",
                                "Near National Average", "Below Average",
                                "Significantly Below Average")) == category
