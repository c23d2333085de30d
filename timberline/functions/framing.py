"""Byte framing: lines of a buffer with the byte offset of each."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from timberline.staging import written

MAX_LINE = 65_536
_INVALID = re.compile("[\udc80-\udcff]+")


def to_valid_utf8(data: bytes) -> str:
    """Every run of bytes that isn't UTF-8 becomes one replacement character."""
    return _INVALID.sub("\ufffd", data.decode("utf-8", "surrogateescape"))


def lines_of(data: bytes, start: int = 0, max_line: int = MAX_LINE, final: bool = False) -> tuple[list[tuple[int, bytes]], int]:
    """Lines (offset, bytes) of what stands at ``start`` of a file, and how many bytes they take.

    A line is cut every ``max_line`` bytes; one carriage return at a piece's end
    and empty pieces are left out. What lacks its line feed is a line if ``final``,
    else only as far as it fills whole pieces.
    """
    feeds = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
    begins = np.concatenate([[0], feeds + 1])
    ends = np.append(feeds, len(data))
    tail = int(begins[-1])
    used = len(data) if final else tail + (len(data) - tail) // max_line * max_line
    ends[-1] = used
    out = []
    for a, b in zip(begins.tolist(), ends.tolist()):
        for at in range(a, b, max_line):
            text = data[at : min(at + max_line, b)].removesuffix(b"\r")
            if text:
                out.append((start + at, text))
    return out, used


def frame(df: DataFrame, key: str, content: str, max_line: int = MAX_LINE, raw: bool = False) -> DataFrame:
    """key, offset, n_bytes and line of every line in column ``content`` (text or bytes), without a shuffle; with ``raw``, lines are bytes."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rows: tuple[list, list, list, list] = ([], [], [], [])
            for k, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for offset, text in lines_of(data or b"", 0, max_line, True)[0]:
                    for column, x in zip(rows, (k, offset, len(text), text if raw else to_valid_utf8(text))):
                        column.append(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[0], batch.column(0).type), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.int64()), pa.array(rows[3], pa.binary() if raw else pa.string())],
                names=[key, "offset", "n_bytes", "line"],
            )

    return df.select(key, F.col(content).cast("binary")).mapInArrow(run, f"{key} {kind}, offset long, n_bytes long, line {'binary' if raw else 'string'}")


def frame_files(spark: SparkSession, path: str | list[str], max_line: int = MAX_LINE) -> DataFrame:
    """source, offset and line of all files under ``path``, a folder, a file or some of them, of any size: Spark splits them into blocks.

    A line's offset is the length of all lines before it: those of its block, which
    are read in order, and the sums of the blocks before. Lines are written once,
    so that offsets and lines are of one reading.
    """
    rows = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text([path] if isinstance(path, str) else path).select(
        F.col("_metadata.file_path").alias("source"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("_at"),
        F.col("value").cast("binary").alias("data"),
    )
    rows = written(rows, "lines")
    size = F.octet_length("data") + 1
    blocks = rows.groupBy("source", "block").agg(F.sum(size).alias("n"))
    before = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = blocks.select("source", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum(size).over(Window.partitionBy("source", "block").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = rows.withColumn("inside", inside).join(bases, ["source", "block"])
    pieces = placed.where("octet_length(data) > 0").withColumn("k", F.explode(F.expr(f"sequence(0, (octet_length(data) - 1) div {max_line})")))
    cut = pieces.withColumn("data", F.expr(f"substring(data, CAST(k * {max_line} + 1 AS INT), {max_line})"))
    trimmed = F.when(F.expr("substring(data, -1, 1) = X'0D'"), F.expr("substring(data, 1, octet_length(data) - 1)")).otherwise(F.col("data"))
    out = cut.select("source", (F.col("base") + F.col("inside") + F.col("k") * max_line).cast("bigint").alias("offset"), trimmed.alias("data"))
    text = F.col("data").cast("string")
    line = F.when(F.is_valid_utf8(text), text).otherwise(F.regexp_replace(F.make_valid_utf8(text), "\ufffd+", "\ufffd"))
    return out.where("octet_length(data) > 0").select("source", "offset", line.alias("line"))
