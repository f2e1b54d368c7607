"""Token counts of documents in flat unindexed token files, by a separator scan.

A token file is a run of unsigned little-endian 16- or 32-bit ids in which an
end-of-document id closes each document; nothing says where documents lie.
Files are cut into blocks; one numpy comparison per block finds the
separators.  A prefix scan over one small row per block then stitches
documents that cross blocks: the sum of the separators of earlier blocks
numbers the documents, and the largest separator position of earlier blocks is
where the first document of a block began, however many blocks back.

Defined results: two separators in a row bound an empty document (0 tokens);
tokens after the last separator are one more document, ``closed`` false; an
empty file has no document; bytes after the last whole id are ignored.  Null
and empty texts have no token; repeated rows are documents of their own; a null
id stays null; an id that does not fit the width raises.  Only the named
columns are read, so further columns never clash.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import as_id, small_batches, tidy, written
from .tokens import default_path, tokenizer

END_OF_TEXT = 49407


def write_token_files(
    docs: DataFrame, folder: str, text: str = "text", key: str = "doc_id", tokenizer_path: str | None = None, end_id: int = END_OF_TEXT, width: int = 2
) -> DataFrame:
    """Tokenise ``docs`` into one flat file per partition below ``folder`` (a
    URI of storage that all executors share).

    Returns, materialised, a row per document: path, ordinal in the file, the
    id, and the file's part number.  A lost task that runs again writes
    another file; only files named in the result count.  A null text has no
    token; strings of special tokens are ordinary text.
    """
    if width not in (2, 4) or end_id >> (8 * width):
        raise ValueError(f"width {width} is not 2 or 4, or end id {end_id} does not fit it")
    small_batches(docs.sparkSession)
    path = tokenizer_path or default_path()
    schema = pa.schema([("path", pa.string()), ("part", pa.int32()), ("ordinal", pa.int64()), ("doc_id", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tokenizer(path, specials_as_text=True)
        part = TaskContext.get().partitionId()
        target = f"{folder}/tokens-{part:06d}-{uuid.uuid4().hex}.bin"
        fs, local = pyarrow.fs.FileSystem.from_uri(target)
        fs.create_dir(local.rpartition("/")[0], recursive=True)
        n = 0
        with fs.open_output_stream(local) as out:
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    rows = batch.slice(at, 256)
                    for ids in known.encode(rows.column(1).to_pylist()):
                        if len(ids) and int(ids.max()) >> (8 * width):
                            raise ValueError(f"token id {ids.max()} does not fit {width} bytes")
                        out.write(np.append(ids, np.uint32(end_id)).astype(f"<u{width}").tobytes())
                    k = rows.num_rows
                    yield pa.RecordBatch.from_arrays([pa.array([target] * k), pa.array([part] * k, pa.int32()), pa.array(np.arange(n, n + k)), rows.column(0)], schema=schema)
                    n += k

    rows = docs.select(as_id(key), docs[text].cast("string"))
    return written(rows.mapInArrow(tidy(run), "path string, part int, ordinal long, doc_id long"), "token-manifest")


def file_sizes(spark: SparkSession, paths: DataFrame) -> DataFrame:
    """(path, size) of the files named in the column ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            sizes = [fs.get_file_info(local).size for fs, local in map(pyarrow.fs.FileSystem.from_uri, names)]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64())], ["path", "size"])

    return paths.select("path").distinct().mapInArrow(tidy(run), "path string, size long")


def scan_blocks(files: DataFrame, end_id: int = END_OF_TEXT, width: int = 2, block_bytes: int = 4 << 20) -> DataFrame:
    """Per block of each file (path, size): its first token's position, its
    number of tokens, and the positions of its separators."""
    step = block_bytes // width * width
    blocks = files.filter(F.col("size") >= width).select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - width, F.lit(step).cast("long"))).alias("at"), "size")
    spread = max(1, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, at, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fs, local = pyarrow.fs.FileSystem.from_uri(path)
                with fs.open_input_file(local) as f:
                    raw = f.read_at(min(step, (size - at) // width * width), at)
                ids = np.frombuffer(raw, f"<u{width}")
                ends = np.flatnonzero(ids == end_id) + at // width
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path]), pa.array([at // width], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([ends], pa.list_(pa.int64()))],
                    ["path", "first", "n", "ends"],
                )

    return blocks.repartition(spread, "path", "at").mapInArrow(tidy(run), "path string, first long, n long, ends array<long>")


def count_documents(files: DataFrame, end_id: int = END_OF_TEXT, width: int = 2, block_bytes: int = 4 << 20) -> DataFrame:
    """Per document of the token files (path, size): path, ordinal in its file,
    start (position of its first token), n_tokens without the separator, closed."""
    scanned = written(scan_blocks(files, end_id, width, block_bytes), "token-blocks")
    earlier = Window.partitionBy("path").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    last = F.expr("ends[size(ends) - 1]")
    stitched = scanned.select("path", "first", "n", F.size("ends").cast("long").alias("found"), F.when(F.size("ends") > 0, last).alias("last")).select(
        "path",
        "first",
        F.coalesce(F.sum("found").over(earlier), F.lit(0)).alias("before"),
        F.coalesce(F.max("last").over(earlier), F.lit(-1)).alias("opened"),
    )
    rows = scanned.join(stitched, ["path", "first"])
    closed = rows.select("path", "before", "opened", "ends", F.posexplode("ends").alias("k", "end")).select(
        "path",
        (F.col("before") + F.col("k")).alias("ordinal"),
        (F.when(F.col("k") == 0, F.col("opened")).otherwise(F.expr("ends[greatest(k - 1, 0)]")) + 1).alias("start"),
        "end",
    )
    closed = closed.select("path", "ordinal", "start", (F.col("end") - F.col("start")).alias("n_tokens"), F.lit(True).alias("closed"))
    tail = scanned.groupBy("path").agg(F.max(F.col("first") + F.col("n")).alias("size"), F.sum(F.size("ends").cast("long")).alias("ordinal"), F.coalesce(F.max(F.when(F.size("ends") > 0, last)), F.lit(-1)).alias("last"))
    tail = tail.filter(F.col("size") > F.col("last") + 1).select("path", "ordinal", (F.col("last") + 1).alias("start"), (F.col("size") - F.col("last") - 1).alias("n_tokens"), F.lit(False).alias("closed"))
    return closed.unionByName(tail)
