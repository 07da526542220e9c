"""User-level analytic operators: DataFrame in, DataFrame out."""

from tidemark.operators.margin import lagged_margin  # noqa: F401
from tidemark.operators.moving_avg import price_moving_avg  # noqa: F401
from tidemark.operators.region_spread import region_spread  # noqa: F401
from tidemark.operators.volatility import price_volatility  # noqa: F401
