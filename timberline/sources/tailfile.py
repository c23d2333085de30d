"""A streaming source that tails files by glob: offsets, and an epoch for every truncation or replacement."""

from __future__ import annotations

import glob
import os

from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from timberline.functions.framing import MAX_LINE, lines_of, to_valid_utf8

SCHEMA = "source string, epoch bigint, offset bigint, line string"
#: Bytes that one read takes of a file at most; the next one goes on there.
READ_BYTES = 8 << 20


class TailReader(SimpleDataSourceStreamReader):
    """Reads on the driver, as a tail does on its machine; positions are {path: [offset, epoch, inode]}.

    A replaced file is read to its end first, its last line too if that lacks a
    line feed: through the handle that was open when it was replaced, or else
    under the name beside it to which it was moved. A deleted one likewise.
    """

    def __init__(self, pattern: str, max_line: int = MAX_LINE, read_bytes: int = READ_BYTES):
        self.pattern, self.max_line = pattern, max_line
        self.read_bytes = max(read_bytes, max_line + 1)  # a read has a line's end or a whole piece
        self.handles: dict[str, tuple[int, object]] = {}

    def initialOffset(self) -> dict:
        return {}

    def _file(self, path: str, inode: int):
        """An open file with this inode that is, or was, at the path; None if there is none any more."""
        own = self.handles.get(path)
        if own and own[0] == inode:
            return own[1]
        beside = sorted(glob.glob(glob.escape(path) + "*")) + sorted(glob.glob(os.path.join(glob.escape(os.path.dirname(path)), "*")))
        for x in [path, *beside]:
            try:
                f = open(x, "rb")  # noqa: SIM115  kept open, so that a replaced file can be read to its end
            except OSError:
                continue
            if os.fstat(f.fileno()).st_ino == inode:
                if own:
                    own[1].close()
                self.handles[path] = inode, f
                return f
            f.close()
        return None

    def _lines(self, path: str, epoch: int, inode: int, start: int, end: int | None, final: bool) -> tuple[list[tuple], int]:
        f = self._file(path, inode)
        if f is None:
            return [], start
        f.seek(start)
        found, used = lines_of(f.read(self.read_bytes if end is None else end - start), start, self.max_line, final)
        return [(path, epoch, at, to_valid_utf8(text)) for at, text in found], start + used

    def _rest(self, path: str, position: list[int]) -> list[tuple]:
        """All that a replaced or deleted file has after its position."""
        offset, epoch, inode = position
        f = self._file(path, inode)
        return self._lines(path, epoch, inode, offset, max(offset, os.fstat(f.fileno()).st_size), True)[0] if f else []

    def read(self, start: dict):
        rows, end = [], dict(start)
        for path in sorted({*glob.glob(self.pattern), *start}):
            before = start.get(path)
            try:
                stat = os.stat(path)
            except FileNotFoundError:
                if before and path in self.handles and self.handles[path][0] == before[2]:
                    size = os.fstat(self.handles[path][1].fileno()).st_size
                    if size > before[0]:
                        rows += self._rest(path, before)
                        end[path] = [size, *before[1:]]
                continue
            offset, epoch, inode = before or (0, 0, stat.st_ino)
            if stat.st_ino != inode:
                rows += self._rest(path, before)
                offset, epoch = 0, epoch + 1
            elif stat.st_size < offset:
                offset, epoch = 0, epoch + 1
            got, at = self._lines(path, epoch, stat.st_ino, offset, None, False)
            rows += got
            end[path] = [at, epoch, stat.st_ino]
        return iter(rows), end

    def readBetweenOffsets(self, start: dict, end: dict):
        rows = []
        for path, (offset, epoch, inode) in sorted(end.items()):
            before = start.get(path)
            if before == [offset, epoch, inode]:
                continue
            same = before and before[1:] == [epoch, inode]
            if before and before[2] != inode:
                rows += self._rest(path, before)
            final = not os.path.exists(path)
            rows += self._lines(path, epoch, inode, before[0] if same else 0, offset, final)[0]
        return iter(rows)


class TailFileSource(DataSource):
    """``spark.readStream.format("tailfile").option("path", glob)``; register it with the session first."""

    @classmethod
    def name(cls) -> str:
        return "tailfile"

    def schema(self) -> str:
        return SCHEMA

    def simpleStreamReader(self, schema) -> TailReader:
        return TailReader(self.options["path"], int(self.options.get("max_line", MAX_LINE)), int(self.options.get("read_bytes", READ_BYTES)))
