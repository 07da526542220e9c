"""Helpers shared by the operators: intermediate tables, word splitting, components."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir

#: ASCII white space, the separators of every word definition in this package.
WS = " \t\n\r\x0b\x0c"
WORD_RE = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/llm/{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"


def save(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends here,
    so a lost executor costs its running tasks only, and nothing upstream runs twice."""
    spark = df.sparkSession
    path = shared_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(saved: DataFrame) -> None:
    """Delete the files of a :func:`save` table that no later step reads."""
    spark = saved.sparkSession
    for f in {f.rsplit("/", 1)[0] for f in saved.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps whose results are written
    (its cleaner acts when the driver has collected the plans that own them)."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, label)`` for every node of an undirected edge list; label is the
    least node of its component.

    Minimum labels move along the edges and then jump (a label is replaced by
    its own label), so chains shorten by doubling. Every round is written to
    the shared folder; only the count of changed labels reaches the driver.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    e = save(e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(),
             "edges")
    lab = save(e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m"))
               .select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        seen = (e.join(lab.select(F.col("node").alias("v"), F.col("label").alias("l")), "v")
                .groupBy(F.col("u").alias("node")).agg(F.min("l").alias("m")))
        moved = lab.join(seen, "node").select("node", F.col("label").alias("old"),
                                              F.least("label", "m").alias("label"))
        moved = save(moved, "moved")
        up = moved.select(F.col("node").alias("label"), F.col("label").alias("up"))
        new = save(moved.join(up, "label").select("node", "old", F.col("up").alias("label")),
                   "labels")
        if new.where("old <> label").isEmpty():
            return new.select("node", "label")
        lab = new.select("node", "label")
