"""Landed API payloads (A1) and the per-series failure policy (A10).

A payload is one JSON document ``{"response": {"data": [{"period", "value"}]}}``
per series and page. Payloads are read with a fixed schema (no inference), so
a missing ``response`` or ``data`` level is simply NULL and yields no rows,
which matches the "missing level gives an empty list" rule.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.schemas import PAYLOAD

_MODES = {"fail": "FAILFAST", "skip": "PERMISSIVE"}


def _mode(on_error: str) -> str:
    try:
        return _MODES[on_error]
    except KeyError:
        raise ValueError(f"on_error must be one of {sorted(_MODES)}") from None


def read_payload_files(spark: SparkSession, path, *, on_error: str = "fail",
                       extra_fields: Sequence[StructField] = ()) -> DataFrame:
    """Read landed payload files (one JSON document per line).

    ``on_error="fail"`` (national series) aborts on a malformed document;
    ``on_error="skip"`` (regional series, tickers) keeps going and leaves the
    bad text in ``_corrupt_record`` so :func:`payload_rejects` can report it.
    Series labels usually come from the file layout (``series=<id>/``
    directories are discovered as a partition column).
    """
    fields = list(PAYLOAD.fields) + list(extra_fields)
    if on_error == "skip":
        fields.append(StructField("_corrupt_record", StringType()))
    reader = (spark.read.schema(StructType(fields))
              .option("mode", _mode(on_error))
              .option("columnNameOfCorruptRecord", "_corrupt_record"))
    return reader.json(path)


def parse_payload_text(df: DataFrame, body_col: str, *, on_error: str = "fail") -> DataFrame:
    """Parse a JSON text column into the payload struct (``response``)."""
    opts = {"mode": _mode(on_error)}
    schema = PAYLOAD
    if on_error == "skip":
        schema = StructType([*PAYLOAD.fields, StructField("_corrupt_record", StringType())])
        opts["columnNameOfCorruptRecord"] = "_corrupt_record"
    out = df.withColumn("_parsed", F.from_json(F.col(body_col), schema, opts))
    out = out.withColumn("response", F.col("_parsed.response"))
    if on_error == "skip":
        out = out.withColumn("_corrupt_record", F.col("_parsed._corrupt_record"))
    return out.drop(body_col, "_parsed")


def explode_payload(df: DataFrame, keep_cols: Sequence[str] = ()) -> DataFrame:
    """``response.data[]`` -> one row per point: keep_cols, pos, period, value.

    ``pos`` is the point's position in its document; with a page number it
    gives the document order that "later duplicate wins" refers to. Empty or
    missing arrays produce no rows. Purely a per-row operation (no shuffle).
    """
    point = F.posexplode(F.col("response.data")).alias("pos", "point")
    return (df.select(*keep_cols, point)
              .select(*keep_cols, "pos",
                      F.col("point.period").alias("period"),
                      F.col("point.value").alias("value")))


def payload_rejects(df: DataFrame, keep_cols: Sequence[str] = ()) -> DataFrame:
    """Documents that could not be parsed, or not wholly, under ``on_error="skip"``.

    A missing level is no error. A document with one mistyped point is reported
    here even where its other points could be read.
    """
    if "_corrupt_record" not in df.columns:
        return df.limit(0).select(*keep_cols)
    # Spark rejects a query that reads only the corrupt-record column of raw JSON:
    # name a parsed column too, in a condition that always holds.
    parsed = F.col("response").isNull() | F.col("response").isNotNull()
    return df.filter(F.col("_corrupt_record").isNotNull() & parsed).select(
        *keep_cols, "_corrupt_record")


def parse_points(df: DataFrame, body_col: str, keep_cols: Sequence[str] = ()) -> DataFrame:
    """Points of JSON documents, each judged by itself: keep_cols, pos, period, value, reject.

    A document is read as it is (VARIANT), so one bad point takes no other with it. ``reject``
    is NULL for a point that can be used, else the reason:

    * ``document``: the text is no JSON (one row, ``pos`` NULL);
    * ``list``: ``response.data`` is there but no list (one row, ``pos`` NULL);
    * ``point``: the entry is no object;
    * ``period``: its period is missing, NULL or no string;
    * ``value``: its value is a list or an object.

    A missing level, an empty list or a NULL text gives no rows; a missing or NULL value is no
    error, as in :func:`explode_payload`. Values that are no numbers are left to the shaping
    steps. Purely a per-row operation (no shuffle).
    """
    docs = df.select(*keep_cols, F.col(body_col).alias("_body"),
                     F.try_parse_json(body_col).alias("_doc"))
    data = F.try_variant_get("_doc", "$.response.data", "variant")
    listed = F.try_variant_get("_doc", "$.response.data", "array<variant>")
    empty = F.array().cast("array<struct<pos:int,p:variant,whole:string>>")
    entries = F.transform(listed, lambda p, i: F.struct(
        i.alias("pos"), p.alias("p"), F.lit(None).cast("string").alias("whole")))

    def whole(reason):
        return F.array(F.struct(F.lit(None).cast("int").alias("pos"),
                                F.lit(None).cast("variant").alias("p"), F.lit(reason).alias("whole")))

    rows = (F.when(F.col("_body").isNotNull() & F.col("_doc").isNull(), whole("document"))
            .when(listed.isNotNull(), entries)
            .when(data.isNotNull() & ~F.is_variant_null(data), whole("list")).otherwise(empty))
    points = docs.select(*keep_cols, F.inline(rows))
    kind = F.schema_of_variant("p")
    period, value = (F.try_variant_get("p", f"$.{k}", "variant") for k in ("period", "value"))
    reject = (F.when(F.col("whole").isNotNull(), F.col("whole"))
              .when(~F.coalesce(kind.startswith("OBJECT"), F.lit(False)), F.lit("point"))
              .when(F.coalesce(F.schema_of_variant(period), F.lit("VOID")) != "STRING", F.lit("period"))
              .when(F.schema_of_variant(value).rlike("^(OBJECT|ARRAY)"), F.lit("value")))
    return points.select(
        *keep_cols, "pos", F.try_variant_get("p", "$.period", "string").alias("period"),
        F.try_variant_get("p", "$.value", "string").alias("value"), reject.alias("reject"))


def build_payload_pages(points: DataFrame, *, series_col: str, page_col: str,
                        order_col: str) -> DataFrame:
    """Nest (series, page, period, value) rows into payload documents.

    Used to land fixture payloads from the driver's tables. A page groups
    rows by a key whose size is bounded by construction (an id range over
    unique ids), so ``collect_list`` never gathers an unbounded group.
    """
    entry = F.struct(F.col(order_col).alias("o"), F.col("period"), F.col("value"))
    data = F.transform(F.array_sort(F.collect_list(entry)),
                       lambda e: F.struct(e["period"].alias("period"), e["value"].alias("value")))
    body = F.to_json(F.struct(F.struct(data.alias("data")).alias("response")))
    return points.groupBy(series_col, page_col).agg(body.alias("body"))
