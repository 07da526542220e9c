"""Publishing tables as immutable versions.

A table is a folder with data folders and one small file per committed version:

    <table>/data/<unique>/      what one attempt wrote
    <table>/_versions/<n>       names the data folder of version n

The version file is written under another name and renamed when it is whole. So

* a load that fails before commit leaves no visible change (rollback), wherever it
  dies: a half-written file never has a version's name;
* readers always see one complete version (the highest);
* of two writers that start from one version only one commits; the other's
  attempt raises :class:`ConcurrentWrite` and nothing of it is visible;
* a retried load writes a folder of its own.

The guard between writers is the file system's rename, which does not replace a file: that
is atomic on HDFS. On a local disk the test and the rename are two steps, and most object
stores have no such rename: there, let one writer at a time load a table.

Only folder listing happens on the driver (Hadoop file API, so the same code works on
HDFS, object stores and local disk).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark.plans.ordering import in_order


class ConcurrentWrite(RuntimeError):
    """Another writer has committed this version."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hpath.getFileSystem(conf), hpath, jvm


def read_text(spark: SparkSession, path: str) -> str:
    fs, hpath, jvm = _fs(spark, path)
    stream = fs.open(hpath)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file with ``text``; False if there is one already.

    It gets its name when it is whole. An empty file under that name is none of ours
    (a writer of another kind died on it) and makes way.
    """
    fs, hpath, jvm = _fs(spark, path)
    if fs.exists(hpath):
        if fs.getFileStatus(hpath).getLen() > 0:
            return False
        fs.delete(hpath, False)
    part = jvm.org.apache.hadoop.fs.Path(hpath.getParent(), f".{uuid.uuid4().hex}")
    stream = fs.create(part, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    plain = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        part, hpath = fs.makeQualified(part), fs.makeQualified(hpath)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            part.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
        context.rename(part, hpath, plain)  # fails where the target exists
    except Exception as e:  # the file system's own exception arrives through py4j
        fs.delete(part, False)
        if fs.exists(hpath):
            return False
        raise e
    return True


def committed_versions(spark: SparkSession, table_dir: str) -> list[int]:
    fs, root, _ = _fs(spark, f"{table_dir.rstrip('/')}/_versions")
    if not fs.exists(root):
        return []
    # A file without content belongs to a writer that died while committing.
    found = [(st.getPath().getName(), st.getLen()) for st in fs.listStatus(root)]
    return sorted(int(name) for name, size in found if name.isdigit() and size > 0)


def version_path(spark: SparkSession, table_dir: str, version: int) -> str:
    root = table_dir.rstrip("/")
    return f"{root}/data/{read_text(spark, f'{root}/_versions/{version}')}"


def publish(df: DataFrame, table_dir: str, *, version: int | None = None,
            partition_by=None, order_by: Sequence[str] = ()) -> int:
    """Write ``df`` as the next version (or as ``version``, which must not exist)
    and return its number. With ``order_by`` its files follow each other in that order."""
    spark = df.sparkSession
    root = table_dir.rstrip("/")
    folder = uuid.uuid4().hex
    if order_by:
        df = in_order(df, order_by)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str)
                                      else partition_by))
    writer.parquet(f"{root}/data/{folder}")
    while True:
        done = committed_versions(spark, table_dir)
        n = version if version is not None else (done[-1] + 1 if done else 0)
        if create_once(spark, f"{root}/_versions/{n}", folder):
            return n
        if version is not None or n not in committed_versions(spark, table_dir):
            fs, path, _ = _fs(spark, f"{root}/data/{folder}")
            fs.delete(path, True)
            raise ConcurrentWrite(f"version {n} of {table_dir} has another writer")


def read_version(spark: SparkSession, table_dir: str, version: int | None = None,
                 schema=None) -> DataFrame | None:
    """Read a committed version (default: the newest); None if there is none."""
    done = committed_versions(spark, table_dir)
    if version is None:
        if not done:
            return None
        version = done[-1]
    elif version not in done:
        return None
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(version_path(spark, table_dir, version))


def drop_old_versions(spark: SparkSession, table_dir: str, keep: int = 2) -> list[int]:
    """Delete the data of all but the newest ``keep`` versions and return their numbers.
    Readers of a version that goes fail, so keep as many as reads may be behind."""
    if keep < 1:
        raise ValueError("the newest version stays")
    old = committed_versions(spark, table_dir)[:-keep]
    for n in old:
        path = version_path(spark, table_dir, n)
        fs, marker, _ = _fs(spark, f"{table_dir.rstrip('/')}/_versions/{n}")
        fs.delete(marker, False)  # first, so that no reader starts on it
        fs.delete(_fs(spark, path)[1], True)
    return old


def append_run(df: DataFrame, table_dir: str, run: str | None = None,
               schema: StructType | None = None) -> None:
    """Append-only log table (B5), typed like the table (its typed clone).

    Rows are brought to ``schema``, or else to that of the rows already there: columns are put
    in its order and cast; a missing or unknown column raises, so one frame cannot make the
    table a mixed one. With ``run`` the rows go to a folder of that run, and a repeated run
    replaces them instead of adding them twice.
    """
    spark, root = df.sparkSession, table_dir.rstrip("/")
    if schema is None:
        schema = _log_schema(spark, root)
    if schema is not None:
        odd = {f.name for f in schema.fields} ^ set(df.columns)
        if odd:
            raise ValueError(f"columns {sorted(odd)} are in the rows or in {table_dir}, not in both")
        df = df.select(*(df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields))
    if run is None:
        df.write.mode("append").parquet(f"{root}/run=__HIVE_DEFAULT_PARTITION__")  # run is NULL
    else:  # escaped as Spark reads partition values, so no two names share a folder
        name = "".join(c if ord(c) > 127 or c.isalnum() or c in "-_" else f"%{ord(c):02X}" for c in run)
        df.write.mode("overwrite").parquet(f"{root}/run={name}")


def _log_schema(spark: SparkSession, root: str) -> StructType | None:
    fs, path, _ = _fs(spark, root)
    if not fs.exists(path) or not any(st.getPath().getName().startswith("run=")
                                      for st in fs.listStatus(path)):
        return None
    return StructType([f for f in spark.read.parquet(root).schema.fields if f.name != "run"])


def replace_view(df: DataFrame, name: str) -> DataFrame:
    """Replaceable view."""
    df.createOrReplaceTempView(name)
    return df


def load(table_dir: str, batch: DataFrame, keys, *, run_ts=None,
         on_duplicate: str = "error", order_col: str | None = None,
         initial: DataFrame | None = None) -> int | None:
    """One all-or-nothing keyed load (B2 + B3) into a versioned table.

    An empty batch is a no-op: no new version is written and the current
    version number is returned (None if the table does not exist yet). A
    failure anywhere before the commit leaves the current version in place. The
    merge counts only if it is still the next version: if another writer was
    faster, :class:`ConcurrentWrite` is raised and the load can be run again.
    """
    from tidemark.plans.upsert import keyed_upsert
    from tidemark.session import staged

    spark = batch.sparkSession
    done = committed_versions(spark, table_dir)
    base = done[-1] if done else None
    # Typed stage as files (B1): evaluated once, and the merge plans from its real size.
    batch, discard = staged(batch, "stage")
    try:
        if batch.isEmpty():
            return base
        current = initial if base is None else read_version(spark, table_dir, base)
        if current is None:
            raise ValueError("table does not exist; pass an empty `initial` frame with its schema")
        merged = keyed_upsert(current, batch, keys, run_ts=run_ts, on_duplicate=on_duplicate,
                              order_col=order_col)
        return publish(merged, table_dir, version=0 if base is None else base + 1)
    finally:
        discard()
