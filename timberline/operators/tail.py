"""Live tail as data: filters, fan-out to subscriptions, bounded buffers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timberline.functions.levels import LEVELS


def _items(text: str) -> tuple[str, ...]:
    return tuple(x.strip() for x in text.split(",") if x.strip())


@dataclass(frozen=True)
class TailFilter:
    """Sets of services, hosts and levels, and a part of the message in any case; what is empty lets all pass."""

    services: tuple[str, ...] = ()
    hosts: tuple[str, ...] = ()
    levels: tuple[str, ...] = ()
    text: str = ""

    @classmethod
    def parse(cls, service: str = "", host: str = "", level: str = "", q: str = "") -> TailFilter:
        levels = tuple(x.lower() for x in _items(level))
        if bad := [x for x in levels if x not in LEVELS]:
            raise ValueError(f"level {bad[0]!r} is unknown")
        return cls(_items(service), _items(host), levels, q.strip().lower())

    def column(self) -> Column:
        out = F.lit(True)
        for name, values in (("service", self.services), ("host", self.hosts), ("level", self.levels)):
            if values:
                out = out & F.col(name).isin(*values)
        return out & F.contains(F.lower("message"), F.lit(self.text)) if self.text else out

    def __call__(self, event: dict) -> bool:
        return (
            (not self.services or event["service"] in self.services)
            and (not self.hosts or event.get("host") in self.hosts)
            and (not self.levels or event["level"] in self.levels)
            and self.text in (event["message"] or "").lower()
        )


def events(logs: DataFrame) -> DataFrame:
    """The columns of a tail event."""
    return logs.select("id", "service", "timestamp", "level", "message", "host", "source", "offset")


#: Clients whose filters are one expression for each row; more are looked up in an index.
FEW_CLIENTS = 100
#: Different filters of one index, which every worker holds; more are several indexes and scans.
INDEXED = 200_000


def fan_out(logs: DataFrame, subscriptions: dict[str, TailFilter]) -> DataFrame:
    """client and row of every match, without a join: a few filters are tested in one scan, any number of them by an index."""
    if len(subscriptions) > FEW_CLIENTS:
        return indexed_fan_out(logs, subscriptions)
    hits = F.array_compact(F.array(*(F.when(f.column(), F.lit(c)) for c, f in subscriptions.items()))).cast("array<string>")
    return logs.withColumn("client", F.explode(hits))


class FilterIndex:
    """Which of many filters an event passes.

    Equal filters are one. All their texts are looked for at once by an automaton;
    under each text, filters lie by one of their fields (service, host or level,
    the first that they name), and the other fields are sets.
    """

    def __init__(self, filters: list[TailFilter]):
        import ahocorasick

        self.texts = ahocorasick.Automaton()
        self.by: dict[str, tuple[dict, dict, dict, list]] = {}
        for i, f in enumerate(filters):
            if f.text not in self.by:
                self.by[f.text] = {}, {}, {}, []
                if f.text:
                    self.texts.add_word(f.text, f.text)
            services, hosts, levels, rest = self.by[f.text]
            entry = i, frozenset(f.hosts), frozenset(f.levels)
            for table, values in ((services, f.services), (hosts, f.hosts), (levels, f.levels)):
                if values:
                    for v in set(values):
                        table.setdefault(v, []).append(entry)
                    break
            else:
                rest.append(entry)
        if len(self.texts):
            self.texts.make_automaton()

    def passed(self, service: str | None, host: str | None, level: str | None, message: str | None) -> list[int]:
        """Numbers of the filters that an event with this message, in small letters, passes."""
        found = {x for _, x in self.texts.iter(message)} if message and len(self.texts) else set()
        found.add("")
        out = []
        for text in found:
            if tables := self.by.get(text):
                services, hosts, levels, rest = tables
                for entries in (services.get(service, ()), hosts.get(host, ()), levels.get(level, ()), rest):
                    out += [i for i, h, lv in entries if (not h or host in h) and (not lv or level in lv)]
        return out


def indexed_fan_out(logs: DataFrame, subscriptions: dict[str, TailFilter], indexed: int = INDEXED) -> DataFrame:
    """``fan_out`` by indexes of so many different filters each; every index is one scan of the rows."""
    clients: dict[TailFilter, list[str]] = {}
    for c, f in subscriptions.items():
        clients.setdefault(TailFilter(tuple(sorted(set(f.services))), tuple(sorted(set(f.hosts))), tuple(sorted(set(f.levels))), f.text), []).append(c)
    schema = T.StructType([*logs.schema.fields, T.StructField("client", T.StringType())])
    filters, out = list(clients), None
    for at in range(0, max(len(filters), 1), indexed):
        part = filters[at : at + indexed]
        shared = logs.sparkSession.sparkContext.broadcast((part, [clients[f] for f in part]))

        def run(batches, shared=shared):
            import pyarrow as pa

            own, names = shared.value
            index = FilterIndex(own)
            for batch in batches:
                *columns, service, host, level, message = batch.columns
                rows, to = [], []
                for i, event in enumerate(zip(*(c.to_pylist() for c in (service, host, level, message)))):
                    for f in index.passed(*event):
                        rows += [i] * len(names[f])
                        to += names[f]
                    if len(to) > 100_000:
                        yield pa.RecordBatch.from_arrays([*(c.take(pa.array(rows, pa.int64())) for c in columns), pa.array(to, pa.string())], names=schema.names)
                        rows, to = [], []
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(rows, pa.int64())) for c in columns), pa.array(to, pa.string())], names=schema.names)

        asked = logs.select("*", F.col("service").alias("__service"), F.col("host").alias("__host"), F.col("level").alias("__level"), F.lower("message").alias("__message"))
        found = asked.mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return out


def _size(buffers: dict[str, int]) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for kv in buffers.items() for x in kv)), F.col("client"))


def kept(matches: DataFrame, buffers: dict[str, int], order: list[str]) -> DataFrame:
    """The rows that each client's buffer takes of a burst: the first ones in ``order``.

    A client's rows are cut in hashed parts first, so that a filter that lets all
    pass doesn't bring all rows to one task.
    """
    parts = matches.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(64))).withColumn("_size", _size(buffers))
    for keys in (["client", "_part"], ["client"]):
        parts = parts.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_r <= _size")
    return parts.drop("_part", "_size", "_r")


def buffered(matches: DataFrame, buffers: dict[str, int]) -> DataFrame:
    """client, delivered and dropped when each client's buffer takes only the first rows of a burst."""
    counts = matches.groupBy("client").agg(F.count(F.lit(1)).alias("n"))
    size = _size(buffers)
    return counts.select("client", F.least("n", size).cast("bigint").alias("delivered"), (F.col("n") - F.least("n", size)).cast("bigint").alias("dropped"))
