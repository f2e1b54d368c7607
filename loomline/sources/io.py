"""Readers and sinks: JSON lines in, Parquet between stages, JSON out."""

from __future__ import annotations

import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.storage import cut, shared_dir
from .catalog import Source

#: The longest life of a signed address, in seconds: seven days (fixed value).
MAX_SIGNED = 604_800


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Rows of JSON-lines files with ``path`` and ``idx``, the number of the physical line.

    Blank lines are skipped but counted.  Files are read in splits, however
    large they are: a line's number is its place in its split plus the lines of
    the splits before, of which there is one small row each.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_split"), F.monotonically_increasing_id().alias("_at"), F.col("value").alias("line"))
    splits = lines.groupBy("path", "_split").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy("path").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.select("path", "_split", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"))
    rows = lines.join(splits, ["path", "_split"]).filter(F.trim("line") != "").withColumn("idx", F.col("_at") + F.col("_shift"))
    return rows.select("path", "idx", F.from_json("line", schema).alias("row")).select("path", "idx", "row.*")


#: Rows of a group up to which Spark drops the others before the shuffle.
PRUNED_ROWS = 1000


def first_rows(df: DataFrame, cap: int | None, group: str, order: str) -> DataFrame:
    """The first ``cap`` rows of each group; 0 or None is no cap.

    A small cap is a window whose rows are limited before they are shuffled.  A
    large one is counted in ranges of (group, order), so no task sorts a group.
    """
    if not cap:
        return df
    if cap < PRUNED_ROWS:
        return df.withColumn("_n", F.row_number().over(Window.partitionBy(group).orderBy(order))).filter(F.col("_n") <= cap).drop("_n")
    return numbered(df, group, order, "_n").filter(F.col("_n") <= cap).drop("_n")


def numbered(df: DataFrame, group: str, order: str, out: str) -> DataFrame:
    """``df`` with the number of each row in its group, from 1, by ranges and a prefix sum over their sizes."""
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = cut(df.repartitionByRange(parts, group, order).withColumn("_range", F.spark_partition_id()))
    sizes = ranged.groupBy(group, "_range").agg(F.count("*").alias("_rows"))
    before = F.sum("_rows").over(Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(group, "_range", F.coalesce(before, F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(group, "_range").orderBy(order))
    return ranged.withColumn("_inside", inside).join(sizes, [group, "_range"]).withColumn(out, F.col("_before") + F.col("_inside")).drop("_range", "_before", "_inside")


def row_cap(max_rows: int | None, environment: dict | None = None) -> int | None:
    """The source's cap, lowered by LOOMLINE_SMOKE_ROWS where that is set."""
    smoke = int((environment if environment is not None else os.environ).get("LOOMLINE_SMOKE_ROWS", "0") or 0)
    caps = [c for c in (max_rows, smoke) if c]
    return min(caps) if caps else None


def first_setting(names: tuple[str, ...], environment: dict | None = None) -> str | None:
    env = os.environ if environment is None else environment
    return next((env[n] for n in names if env.get(n)), None)


def mirror_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def read_mirror(spark: SparkSession, root: str, source: Source | str, schema: T.StructType | str | None = None) -> DataFrame:
    """A source's raw rows, with ``idx``, from the mirrored folder ``root/name``, of
    which the name holds id, config and split: JSON lines, else Parquet.  A
    source's row cap, or LOOMLINE_SMOKE_ROWS where that is less, limits the scan."""
    name, cap = (source, row_cap(None)) if isinstance(source, str) else (source.name, row_cap(source.max_rows))
    path = mirror_path(root, name)
    if exists(spark, f"{path}/data.jsonl"):
        if schema is None:
            schema = spark.read.json(f"{path}/data.jsonl").schema
        rows = read_json_lines(spark, f"{path}/data.jsonl", schema).drop("path")
    else:
        rows = spark.read.parquet(path)
    if not cap:
        return rows
    if "idx" not in rows.columns:
        return rows.limit(cap)
    return rows.filter(F.col("idx") < cap) if exists(spark, f"{path}/data.jsonl") else first_rows(rows.withColumn("_g", F.lit(0)), cap, "_g", "idx").drop("_g")


def read_benchmarks(spark: SparkSession, root: str, wanted: list[str], known: dict[str, tuple]) -> tuple[DataFrame | None, dict]:
    """(bench, question) of the wanted benchmarks below ``root``, and for each the
    number of questions or why there are none.  One that fails doesn't stop the others."""
    out, status = None, {}
    for name in wanted:
        if name not in known:
            status[name] = "no-loader"
            continue
        column = known[name][3]
        try:
            rows = read_mirror(spark, root, name).select(F.lit(name).alias("bench"), F.col(column).cast("string").alias("question")).filter("question <> ''")
            status[name] = rows.count()
            out = rows if out is None else out.unionByName(rows)
        except Exception as error:  # noqa: BLE001  whatever a source raises goes to its status
            status[name] = f"ERR:{type(error).__name__}"
    return out, status


def write_chunks(df: DataFrame, path: str, by: tuple[str, ...] = ("stage", "chunk", "side")) -> None:
    """A folder per stage, chunk and side, as JSON lines."""
    df.repartition(*by).write.mode("overwrite").option("ignoreNullFields", "false").partitionBy(*by).json(path)


def acquire(read: Callable[[], DataFrame], path: str, tries: int = 3, wait: float = 1.0) -> tuple[DataFrame | None, dict]:
    """A source's rows written to ``path`` and read back, or None after ``tries``
    failures; and its manifest entry: status, rows kept, columns, a checksum of
    the content, or the error.  Reading and writing are both tried again."""
    problem = ""
    for n in range(tries):
        try:
            rows = read()
            rows.write.mode("overwrite").parquet(path)
            kept = rows.sparkSession.read.schema(rows.schema).parquet(path)
            row = kept.agg(F.count("*").alias("n"), F.sum(F.crc32(F.to_json(F.struct("*")).cast("binary"))).alias("sum")).first()
            return kept, {"status": "ok", "retained": row["n"], "columns": sorted(kept.columns), "checksum": f"{(row['sum'] or 0) & (2**64 - 1):016x}", "error": None}
        except Exception as error:  # noqa: BLE001  the manifest records whatever the source raised
            problem = f"{type(error).__name__}: {error}"
            if n + 1 < tries:
                time.sleep(wait * 2**n)
    return None, {"status": "unavailable", "retained": 0, "columns": [], "checksum": None, "error": problem[:500]}


def write_stage(df: DataFrame, path: str, by: str = "name") -> None:
    """A stage's rows, one folder per source; the commit protocol makes it whole or absent."""
    df.write.mode("overwrite").partitionBy(by).parquet(path)


def done(spark: SparkSession, path: str) -> bool:
    """Whether a stage was written to the end."""
    return exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def write_json_lines(df: DataFrame, path: str, order: list | None = None) -> None:
    (df.orderBy(*order) if order else df).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_json_array(df: DataFrame, path: str) -> int:
    """One JSON array in one file.  Tasks write the rows; the driver only joins
    their files, as streams of bytes that never become rows."""
    spark = df.sparkSession
    parts = shared_dir(spark, "json-array")
    df.select(F.concat(F.lit(","), F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})).alias("value")).write.text(parts)
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    source, target = hadoop.fs.Path(parts), hadoop.fs.Path(path)
    files = source.getFileSystem(conf)
    names = sorted(str(f.getPath()) for f in files.listStatus(source) if f.getPath().getName().startswith("part-") and f.getLen())
    out = target.getFileSystem(conf).create(target, True)
    try:
        out.write(bytearray(b"["))
        for n, name in enumerate(names):
            part = files.open(hadoop.fs.Path(name))
            if not n:
                part.seek(1)  # the first row has no comma before it
            hadoop.io.IOUtils.copyBytes(part, out, conf, False)
            part.close()
        out.write(bytearray(b"]"))
    finally:
        out.close()
    n = spark.read.text(parts).count()
    files.delete(source, True)
    return n


# Object stores, by Hadoop's file systems ---------------------------------------


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def ensure_folder(spark: SparkSession, path: str) -> str:
    """A bucket's or folder's path, made if it isn't there."""
    files, target = _files(spark, path)
    files.mkdirs(target)
    return path


def put_file(spark: SparkSession, local: str, path: str) -> None:
    files, target = _files(spark, path)
    files.copyFromLocalFile(False, True, spark._jvm.org.apache.hadoop.fs.Path(local), target)


def download_file(spark: SparkSession, path: str, local: str) -> None:
    files, target = _files(spark, path)
    files.copyToLocalFile(False, target, spark._jvm.org.apache.hadoop.fs.Path(local), True)


def list_keys(spark: SparkSession, path: str) -> list[str]:
    """Keys of all objects below ``path``, relative to it, in order."""
    files, target = _files(spark, path)
    if not files.exists(target):
        return []
    base, found, out = files.makeQualified(target).toString().rstrip("/") + "/", files.listFiles(target, True), []
    while found.hasNext():
        out.append(found.next().getPath().toString().removeprefix(base))
    return sorted(out)


def sync_up(spark: SparkSession, folder: str, path: str) -> list[str]:
    """Put the files of a local folder that are missing below ``path`` or have another size; returns their keys."""
    files, _ = _files(spark, path)
    put = []
    for where, _, names in os.walk(folder):
        for name in names:
            local = os.path.join(where, name)
            key = os.path.relpath(local, folder).replace(os.sep, "/")
            there = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{key}")
            if not files.exists(there) or files.getFileStatus(there).getLen() != os.path.getsize(local):
                put_file(spark, local, f"{path.rstrip('/')}/{key}")
                put.append(key)
    return sorted(put)


def object_key(prefix: str, *parts: str) -> str:
    return "/".join([prefix, *parts])


def signed_seconds(seconds: int | None, default: int = MAX_SIGNED) -> int:
    return min(default if seconds is None else seconds, MAX_SIGNED)


def public_url(endpoint: str, bucket: str, key: str) -> str:
    return f"https://{endpoint}/{bucket}/{key}"
