"""Column-level helpers shared by every operator (all JVM-side expressions)."""

from tidemark.functions.numeric import (  # noqa: F401
    guarded_pct_change,
    label_by_thresholds,
    nan_to_null,
    round_half_away,
)
from tidemark.functions.time import week_start  # noqa: F401
