"""Declared-source scans (A11) with column pruning at the Parquet reader."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.schemas import SOURCE_TABLES


def table_path(base_dir: str, name: str) -> str:
    return os.path.join(base_dir, f"{name}.parquet")


def read_table(spark: SparkSession, base_dir: str, name: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    """Scan ``<base_dir>/<name>.parquet``; selecting columns prunes the read.

    Known tables are read with their declared schema (no footer inference on
    the driver per scan); others fall back to the file schema.
    """
    schema = SOURCE_TABLES.get(name)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(table_path(base_dir, name))
    return df.select(*columns) if columns else df
