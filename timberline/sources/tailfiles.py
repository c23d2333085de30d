"""A streaming source that tails files by glob in parallel: the driver plans ranges of bytes, executors read and frame them.

Executors have to see the files under the driver's paths, as on a shared mount
or on one machine. A position holds for every path its epochs that aren't
finished: number, inode and offset, each offset at the end of a line (or of a
whole piece of one that is too long). A file that is truncated or replaced
begins its next epoch; what the replaced one still has, its last line too if
that lacks a line feed, is read under the name beside it to which it was moved.
A file that is deleted before it was read to its end loses the rest.
"""

from __future__ import annotations

import glob
import json
import os
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from timberline.functions.framing import MAX_LINE, lines_of, to_valid_utf8
from timberline.sources.tailfile import READ_BYTES, SCHEMA

#: Bytes of a range that one task reads, about.
SPLIT_BYTES = 4 << 20
#: Bytes that are looked through at once for a line feed.
LOOK = 1 << 16


@dataclass
class Range(InputPartition):
    path: str
    epoch: int
    inode: int
    start: int
    end: int

    def __post_init__(self):
        InputPartition.__init__(self, (self.path, self.epoch, self.inode, self.start, self.end))


def opened(path: str, inode: int):
    """The open file with this inode at the path, or beside it; None if there is none."""
    beside = sorted(glob.glob(glob.escape(path) + "*")) + sorted(glob.glob(os.path.join(glob.escape(os.path.dirname(path)), "*")))
    for x in [path, *beside]:
        try:
            f = open(x, "rb")  # noqa: SIM115  the caller closes it
        except OSError:
            continue
        if os.fstat(f.fileno()).st_ino == inode:
            return f
        f.close()
    return None


def line_end(f, start: int, end: int, max_line: int) -> int:
    """The last place up to ``end`` at which a line, or a whole piece of a long one, that begins at ``start`` or later ends."""
    at = end
    while at > start:
        low = max(start, at - LOOK)
        feed = os.pread(f.fileno(), at - low, low).rfind(b"\n")
        if feed >= 0:
            start = low + feed + 1
            break
        at = low
    return start + (end - start) // max_line * max_line


def cuts(f, start: int, end: int, split: int) -> list[int]:
    """Places behind line feeds that cut a range into parts of about ``split`` bytes."""
    out, at = [start], start + split
    while at < end:
        feed = os.pread(f.fileno(), min(LOOK, end - at), at).find(b"\n")
        if feed >= 0 and at + feed + 1 < end:
            out.append(at + feed + 1)
            at += feed + 1
        at += split if feed >= 0 else LOOK
    return [*out, end]


class TailFilesReader(DataSourceStreamReader):
    def __init__(self, pattern: str, progress: str, max_line: int = MAX_LINE, read_bytes: int = READ_BYTES, split_bytes: int = SPLIT_BYTES):
        self.pattern, self.progress, self.max_line = pattern, progress, max_line
        self.read_bytes, self.split_bytes = max(read_bytes, max_line + 1), split_bytes
        self.position: dict | None = None
        self.done: dict = {}

    def initialOffset(self) -> dict:
        return {}

    def _restored(self) -> dict:
        """The last position that was given out, from the file that outlives this reader."""
        if self.position is None:
            fs, path = _filesystem(self.progress)
            try:
                with fs.open_input_stream(path) as f:
                    self.position = json.loads(f.read())
            except FileNotFoundError:
                self.position = {}
        return self.position

    def latestOffset(self) -> dict:
        out = {}
        before = self._restored()
        for path in sorted({*glob.glob(self.pattern), *before}):
            epochs = [list(x) for x in before.get(path, ())]
            finished = {tuple(x) for x in self.done.get(path, ())}
            epochs = [x for x in epochs[:-1] if tuple(x) not in finished] + epochs[-1:]  # read to their ends, and committed
            try:
                stat = os.stat(path)
            except FileNotFoundError:
                stat = None
            if stat is None:
                if epochs:
                    self._advance(path, epochs[-1], False)
                    out[path] = epochs
                continue
            if not epochs:
                epochs = [[0, stat.st_ino, 0]]
            elif epochs[-1][1] != stat.st_ino:
                self._advance(path, epochs[-1], True)
                epochs.append([epochs[-1][0] + 1, stat.st_ino, 0])
            elif stat.st_size < epochs[-1][2]:
                epochs.append([epochs[-1][0] + 1, stat.st_ino, 0])
            self._advance(path, epochs[-1], False)
            out[path] = epochs
        if out != before:
            fs, name = _filesystem(self.progress)
            fs.create_dir(name.rsplit("/", 1)[0], recursive=True)
            with fs.open_output_stream(name + ".new") as f:
                f.write(json.dumps(out).encode())
            fs.move(name + ".new", name)
            self.position = out
        return out

    def _advance(self, path: str, epoch: list[int], final: bool) -> None:
        """Move an epoch's offset on: to the last whole line, at most ``read_bytes`` away, or to the file's end if it is ``final``."""
        f = opened(path, epoch[1])
        if f is None:
            return
        with f:
            size = os.fstat(f.fileno()).st_size
            if final:
                epoch[2] = max(epoch[2], size)
            elif size > epoch[2]:
                epoch[2] = line_end(f, epoch[2], min(size, epoch[2] + self.read_bytes), self.max_line)

    def partitions(self, start: dict, end: dict) -> list[Range]:
        out = []
        for path, epochs in sorted(end.items()):
            known = {(e, i): at for e, i, at in start.get(path, ())}
            newest = max((e for e, _ in known), default=-1)
            for epoch, inode, to in epochs:
                at = known.get((epoch, inode), 0)
                if to <= at or (epoch, inode) not in known and epoch <= newest:
                    continue
                f = opened(path, inode)
                if f is None:
                    continue
                with f:
                    places = cuts(f, at, to, self.split_bytes)
                out += [Range(path, epoch, inode, a, b) for a, b in zip(places, places[1:])]
        return out

    def read(self, partition: Range):
        import pyarrow as pa

        f = opened(partition.path, partition.inode)
        if f is None:
            return
        with f:
            data = os.pread(f.fileno(), partition.end - partition.start, partition.start)
        found, _ = lines_of(data, partition.start, self.max_line, True)
        for i in range(0, len(found), 10_000):
            part = found[i : i + 10_000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([partition.path] * len(part), pa.string()), pa.array([partition.epoch] * len(part), pa.int64()),
                    pa.array([at for at, _ in part], pa.int64()), pa.array([to_valid_utf8(text) for _, text in part], pa.string()),
                ],
                names=["source", "epoch", "offset", "line"],
            )

    def commit(self, end: dict) -> None:
        self.done = end


def _filesystem(uri: str):
    from pyarrow.fs import FileSystem, LocalFileSystem

    return (LocalFileSystem(), uri) if uri.startswith("/") else FileSystem.from_uri(uri)


class TailFilesSource(DataSource):
    """``spark.readStream.format("tailfiles").option("path", glob).option("progress", file)``; register it with the session first.

    ``progress`` names a file that keeps the position for a restart, as beside the query's checkpoint.
    """

    @classmethod
    def name(cls) -> str:
        return "tailfiles"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> TailFilesReader:
        o = self.options
        return TailFilesReader(o["path"], o["progress"], int(o.get("max_line", MAX_LINE)), int(o.get("read_bytes", READ_BYTES)), int(o.get("split_bytes", SPLIT_BYTES)))
