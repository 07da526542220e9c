"""Join strategy policy.

Catalyst decides broadcast vs shuffle from statistics: a side is broadcast
only when its estimated size is under ``spark.sql.autoBroadcastJoinThreshold``
(file sizes scaled by the projected columns), and AQE re-decides from the
measured size of each shuffle stage, splitting skewed partitions of
sort-merge joins. Our part is to keep those statistics accurate and cheap:

* join a fact table to the dimension *scan* (customer, supplier), so the
  estimate is the dimension's own size, not a product of join inputs;
* write small derived tables and staged batches as files
  (:func:`tidemark.session.staged`) before they are joined;
* hint ``broadcast`` by hand only for dimensions whose size is fixed by the
  schema, listed below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---- fixed values -----------------------------------------------------------
# Dimensions with a schema-fixed row count (TPC-H: 25 nations, 5 regions).
FIXED_DIMENSIONS = {"nation": 25, "region": 5}
# -----------------------------------------------------------------------------


def dimension(df: DataFrame, name: str) -> DataFrame:
    """Broadcast hint for a fixed-size dimension (refuses anything else)."""
    if name not in FIXED_DIMENSIONS:
        raise ValueError(f"{name!r} has no fixed size; let Catalyst / AQE size the join")
    return F.broadcast(df)
