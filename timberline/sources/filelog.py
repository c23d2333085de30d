"""A partitioned, append-only log in a shared folder, with the contract of a topic: keys to partitions, offsets, start and lag.

It stands in where the Kafka connector is absent. A file holds a run of one
partition's records, a JSON line each, and is named after its first offset; files
appear by renaming, so that a reader never sees half of one.
"""

from __future__ import annotations

import base64
import json
import os
import threading
import uuid
import zlib
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "offset bigint, key string, value string"


def _ends(folder: str) -> int:
    names = [x for x in os.listdir(folder) if x.endswith(".json")] if os.path.isdir(folder) else []
    return max((int(x.split("-")[0]) + int(x.split("-")[1].split(".")[0]) for x in names), default=0)


class Producer:
    """Writes to the log; one producer a folder."""

    def __init__(self, folder: str, partitions: int = 6):
        self.folder, self.partitions, self.lock = folder, partitions, threading.Lock()
        self.next = [_ends(self._path(p)) for p in range(partitions)]
        for p in range(partitions):
            os.makedirs(self._path(p), exist_ok=True)

    def _path(self, partition: int) -> str:
        return f"{self.folder}/partition={partition}"

    def send(self, records: Iterable[tuple[str, bytes]]) -> dict[int, int]:
        """Append (key, value) records, those of one key in order; the last offset of each partition that got some. They are on disk then."""
        per: dict[int, list[tuple[str, bytes]]] = {}
        for key, value in records:
            per.setdefault(zlib.crc32(key.encode()) % self.partitions, []).append((key, value))
        out = {}
        with self.lock:
            for p, rows in per.items():
                first, held = self.next[p], f"{self._path(p)}/.{uuid.uuid4().hex}"
                with open(held, "w") as f:
                    for i, (key, value) in enumerate(rows):
                        f.write(json.dumps({"offset": first + i, "key": key, "value": base64.b64encode(value).decode()}) + "\n")
                    f.flush()
                    os.fsync(f.fileno())
                os.replace(held, f"{self._path(p)}/{first:020d}-{len(rows)}.json")
                self.next[p] += len(rows)
                out[p] = self.next[p] - 1
        return out


def ends(folder: str) -> dict[int, int]:
    """The next offset of every partition."""
    names = os.listdir(folder) if os.path.isdir(folder) else []
    return {int(x.partition("=")[2]): _ends(f"{folder}/{x}") for x in names if x.startswith("partition=")}


def records(spark: SparkSession, folder: str, topic: str = "logs", start: str = "earliest", files_per_trigger: int | None = None) -> DataFrame:
    """A stream of value, topic, partition and source_offset: all records, or with ``latest`` those that come after this call."""
    reader = spark.readStream.schema(SCHEMA + ", partition int")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    rows = reader.json(folder).select(F.unbase64("value").alias("value"), F.lit(topic).alias("topic"), "partition", F.col("offset").alias("source_offset"))
    if start == "latest" and (old := ends(folder)):
        begin = F.create_map(*(F.lit(x) for kv in old.items() for x in kv))
        rows = rows.where(F.col("source_offset") >= F.coalesce(F.try_element_at(begin, F.col("partition")), F.lit(0)))
    return rows


def lag(folder: str, done: dict[int, int]) -> dict[int, int]:
    """Records behind per partition, for the next offsets ``done`` that a consumer has come to."""
    return {p: n - done.get(p, 0) for p, n in ends(folder).items()}
