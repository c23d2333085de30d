"""Several tables of one batch that appear together or not at all.

The batch's folders are written beside the store, by Spark, into a folder that no
reader looks into. A manifest, which is renamed into place, decides: before it
exists nothing has happened; from then on its moves are carried out, by this run
or by the next one that finds it. Moves and removals can be repeated.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _matching(spark: SparkSession, pattern: str) -> list[str]:
    """Folders that a pattern names."""
    fs, p = _fs(spark, pattern)
    return sorted(x.getPath().toString() for x in fs.globStatus(p) or ())


class Transaction:
    """A batch of a store: write tables into ``staged(name)``, then ``commit``."""

    def __init__(self, spark: SparkSession, store: str, batch: str):
        self.spark, self.store, self.batch = spark, store, batch
        self.folder = f"{store}/_staging/{batch}-{uuid.uuid4().hex}"

    def staged(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def commit(self, targets: dict[str, tuple[str, str]], replaced: list[str] = ()) -> None:
        """Move what was staged under each name into place: name: (target folder, pattern of the folders under both that move as a whole).

        A folder that is there already is replaced, as are those that match the
        patterns ``replaced`` and don't come again.
        """
        moves = []
        for name, (target, pattern) in targets.items():
            fs, root = _fs(self.spark, self.staged(name))
            base = fs.makeQualified(root).toString()
            moves += [[x, target + x[len(base) :]] for x in _matching(self.spark, f"{base}/{pattern}" if pattern else base)]
        fs, final = _fs(self.spark, f"{self.store}/_commits/{self.batch}.json")
        if fs.exists(final):  # an earlier try of the same batch ends first
            apply(self.spark, final.toString())
        new = {fs.makeQualified(_fs(self.spark, b)[1]).toString() for _, b in moves}
        old = [x for pattern in replaced for x in _matching(self.spark, pattern) if x not in new]
        _, temporary = _fs(self.spark, f"{self.store}/_commits/.{uuid.uuid4().hex}")
        out = fs.create(temporary)
        out.write(bytearray(json.dumps({"moves": moves, "removes": old, "staging": self.folder}).encode()))
        out.close()
        if not fs.rename(temporary, final):
            raise OSError(f"the manifest of batch {self.batch} could not be put in place")
        apply(self.spark, final.toString())

    def abort(self) -> None:
        fs, p = _fs(self.spark, self.folder)
        fs.delete(p, True)


def move(spark: SparkSession, a: str, b: str) -> None:
    """Put a folder in another one's place; done before if it is no longer there."""
    from_fs, x = _fs(spark, a)
    to_fs, y = _fs(spark, b)
    if not from_fs.exists(x):
        return
    to_fs.delete(y, True)
    if not from_fs.getUri().equals(to_fs.getUri()):
        spark._jvm.org.apache.hadoop.fs.FileUtil.copy(from_fs, x, to_fs, y, True, True, spark._jsc.hadoopConfiguration())
        return
    to_fs.mkdirs(y.getParent())
    if not from_fs.rename(x, y):
        raise OSError(f"{a} could not be moved")


def apply(spark: SparkSession, manifest: str) -> None:
    """Carry out a manifest's moves, then its removals, and delete it."""
    fs, p = _fs(spark, manifest)
    source = fs.open(p)
    todo = json.loads(bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(source)))
    source.close()
    for a, b in todo["moves"]:
        move(spark, a, b)
    for a in todo["removes"]:
        its, x = _fs(spark, a)
        its.delete(x, True)
    its, x = _fs(spark, todo["staging"])
    its.delete(x, True)
    fs.delete(p, False)


def recover(spark: SparkSession, store: str, batch: str = "*") -> int:
    """Carry out the manifests that a run which ended early has left; returns how many there were."""
    fs, p = _fs(spark, f"{store}/_commits/{batch}.json")
    found = [x.getPath().toString() for x in fs.globStatus(p) or ()]
    for x in found:
        apply(spark, x)
    return len(found)
