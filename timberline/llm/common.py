"""What the operators of this subpackage share: the shared folder, labelled samples and token ids."""

from __future__ import annotations

import tempfile
import uuid
from array import array
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which driver and executors share.

    Where the setting is unset, as in local tests, a temporary folder of this
    machine takes its place; a cluster has to name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="timberline-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back, which cuts its lineage."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    for made in _MADE.get():
        made.append(path)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Paths written within each of the blocks of ``scratch`` that are open where this runs; jobs of other threads have their own.
_MADE: ContextVar[tuple[list[str], ...]] = ContextVar("made", default=())


@contextmanager
def scratch(spark: SparkSession):
    """A block at whose end its written tables are deleted, but for those that frames given to the yielded function read; all of them if it raises."""
    made: list[str] = []
    kept: set[str] = set()

    def keep(*frames: DataFrame) -> None:
        for df in frames:
            kept.update(x.rsplit("/", 2)[-2] for x in df.inputFiles())

    token = _MADE.set((*_MADE.get(), made))
    try:
        yield keep
    except BaseException:
        kept.clear()
        raise
    finally:
        _MADE.reset(token)
        for path in made:
            if path.rsplit("/", 1)[1] not in kept:
                remove(spark, path)


#: Rows of a few short columns that are broadcast at most.
BROADCAST_ROWS = 1_000_000


#: Bytes of rows that Python gets at once within ``small_batches``; a longer row comes alone.
BATCH_BYTES = 4 << 20


@contextmanager
def small_batches(spark: SparkSession):
    """A block whose jobs hand Python ``BATCH_BYTES`` at once: texts of a batch, and what is made of them, lie several times in a worker and its executor."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, f"{BATCH_BYTES}b")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def small_side(df: DataFrame, name: str) -> DataFrame:
    """``df`` written, counted, and marked for broadcasting if it has ``BROADCAST_ROWS`` rows at most; else Spark joins by shuffling."""
    df = written(df, name)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of jobs that have ended and whose tables are written.

    They go when the driver collects its garbage, which it may not do for long.
    """
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that an operator has written and no longer reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def held_out(doc_id) -> "F.Column":
    """True for the evaluation fold: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(doc_id.cast("string")) % 5 == 0


def training_sample(labels: DataFrame, label: str, bound: int) -> DataFrame:
    """At most ``bound`` labelled ids outside the evaluation fold, by a hash order.

    Repeated ids count once, with their largest label; null ids and null labels
    are left out. The result has columns doc_id and label.
    """
    rows = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where("doc_id is not null and label is not null")
        .where(~held_out(F.col("doc_id")))
    )
    return (
        rows.groupBy("doc_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    )


_TOKENIZERS: dict = {}
_CACHES: dict = {}


def sole_cache(name: str, clear) -> None:
    """Keep one operator's tables in a worker: those of others, which ran there before, are cleared."""
    if name in _CACHES:
        return
    for forget in _CACHES.values():
        forget()
    if _CACHES:
        _CACHES.clear()
        trim()
    _CACHES[name] = clear


def trim() -> None:
    """Give freed memory back to the system: a worker's next operator has its own peak."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


#: Pre-tokenizers and normalizers under which a text's ids are those of its chunks between ASCII white space.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_BY_WORDS = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": _SPLIT}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


class IdEncoder:
    """Token ids of texts.

    Where the vocabulary's file says that words, digits and runs of marks are
    encoded each for itself (``_BY_WORDS``), a text's ids are those of its chunks
    between white space, and a chunk's are those of its letters and of the marks
    behind them. Each different chunk of a batch is looked up once; tables keep at
    most twice ``capacity`` chunks: when the younger one is full it becomes the
    older one, and chunks that are met again move to the younger. New words in
    Latin letters are lower-cased and encoded together as one text, which is split
    where ids end a word; all other chunks go to the library as they are.

    Any other vocabulary gets whole texts.
    """

    def __init__(self, path: str, capacity: int = 700_000):
        import json

        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.capacity = capacity
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        says = json.loads(self.tokenizer.to_str())
        self.by_words = (
            all(says[k] == v for k, v in _BY_WORDS.items()) and says["model"]["type"] == "BPE" and says["model"]["end_of_word_suffix"] == "</w>"
            and all(x["content"].startswith("<|") and " " not in x["content"] for x in says["added_tokens"])
        )
        if self.by_words:
            # the same model for words that are normalized already
            self.words = Tokenizer.from_file(path)
            self.words.normalizer = normalizers.Sequence([])
            self.words.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            vocabulary = self.tokenizer.get_vocab()
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for x, i in vocabulary.items() if x.endswith("</w>")]] = True

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of an Arrow array of strings, one after the other, and where each text's begin; the last bound is their number.

        Nulls have no ids.
        """
        import pyarrow as pa
        import pyarrow.compute as pc

        texts = pc.fill_null(texts.cast(pa.string()), "")
        if not self.by_words:
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in found], dtype=np.int64)]).astype(np.int64)
            return np.array([i for x in found for i in x], "<u4"), bounds
        low = pc.ascii_lower(texts)
        marked = pc.match_substring(texts, "<|")  # a special token is one as it is written only
        if pc.any(marked).as_py():
            low = pc.if_else(marked, texts, low)
        lists = pc.ascii_split_whitespace(low)
        found = lists.flatten().dictionary_encode()
        known = pa.array(self._ids(found.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(found.indices)
        _, ends, data = known.buffers()
        ends = np.frombuffer(ends, np.int64)[: len(known) + 1] >> 2 if len(known) else np.zeros(1, np.int64)
        ids = np.frombuffer(data, "<u4")[: ends[-1]] if ends[-1] else np.zeros(0, "<u4")
        offsets = lists.offsets.to_numpy()
        return ids, ends[offsets - offsets[0]]

    def _ids(self, chunks: list[str]) -> list[bytes]:
        if len(self.young) > self.capacity:
            self.old, self.young = self.young, {}
        table, old = self.young, self.old
        missing = [x for x in chunks if x not in table]
        if old:
            table.update((x, old[x]) for x in missing if x in old)
            missing = [x for x in missing if x not in table]
        parts, words, rest = {}, set(), []
        for x in missing:
            core = x.rstrip(_MARKS)
            if _latin(core):
                low, marks = core.lower(), x[len(core) :]
                words.add(low)
                if marks or low != x:
                    parts[x] = low, marks
                if marks:
                    rest.append(marks)
            else:
                rest.append(x)
        new = [x for x in words if x not in table]
        for i in range(0, len(new), 10_000):
            self._add_words(table, new[i : i + 10_000])
        rest += [x for x in new if x not in table]
        rest = [x for x in set(rest) if x not in table]
        for i in range(0, len(rest), 10_000):
            part = rest[i : i + 10_000]
            for x, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                table[x] = array("I", e.ids).tobytes()
        for x, (low, marks) in parts.items():
            table[x] = table[low] + table[marks] if marks else table[low]
        return [table[x] for x in chunks]

    def _add_words(self, table: dict[str, bytes], words: list[str]) -> None:
        """Encode words of letters together; none if their number of word ends is another than expected."""
        (e,) = self.words.encode_batch_fast([" ".join(words)], add_special_tokens=False)
        ids = np.array(e.ids, "<u4")
        ends = 4 * (np.flatnonzero(self.ends[ids]) + 1)
        if len(ends) != len(words) or (len(ends) and ends[-1] != 4 * len(ids)):
            return
        data, at = ids.tobytes(), 0
        for word, to in zip(words, ends.tolist()):
            table[word] = data[at:to]
            at = to


def _latin(word: str) -> bool:
    """Letters up to U+00FF only: lower-casing them is one to one, and they are composed already."""
    return word.isalpha() and (word.isascii() or max(word) <= "\u00ff")


def id_encoder(path: str, capacity: int = 700_000) -> IdEncoder:
    """This worker's encoder for a vocabulary file."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    sole_cache("ids", _TOKENIZERS.clear)
    if (path, capacity) not in _TOKENIZERS:
        _TOKENIZERS.clear()
        _TOKENIZERS[path, capacity] = IdEncoder(path, capacity)
    return _TOKENIZERS[path, capacity]


def batches_by_size(texts: list[str | None], limit: int = 4_000_000):
    """Slices (start, end) of a batch whose texts have together about ``limit`` characters."""
    start = size = 0
    for i, x in enumerate(texts):
        size += len(x or "")
        if size > limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def slices_by_size(texts, limit: int = 6_000_000):
    """Slices (start, end) of an Arrow array of strings that have together about ``limit`` bytes."""
    import pyarrow.compute as pc

    total = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(total):
        base = total[start - 1] if start else 0
        end = min(len(total), int(np.searchsorted(total, base + limit)) + 1)
        yield start, end
        start = end
