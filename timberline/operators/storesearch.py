"""Pages of a written store without aggregating it: candidates first, then their later writes.

Days are taken from the latest on, twice as many each time, until the page is
full. Of a window's rows that match, the first ones in order are candidates; a
text's terms first narrow the window down to files that may hold them. A
candidate may have been written again, in another batch of its day or, if it
has no time of its own, on another day. Only candidates for which that is
possible are verified: their ids are looked up in the files that may hold them,
and an id's last write counts. Then the scan goes on behind the last candidate.
"""

from __future__ import annotations

import datetime as dt
import threading
import time
from dataclasses import replace
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from timberline.operators import store, storeindex
from timberline.operators.search import Query, SortKey, conditions, matching, ms

#: A window or a lookup of so many files at most reads them without asking the index.
FEW_FILES = 8
#: Writes of one id, on average, that a lookup brings to the driver at most; more are aggregated.
FEW_WRITES = 8
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


class StoreSearch:
    """Searches of one store. What it has is listed anew after ``refresh`` seconds, from when on later batches are found."""

    def __init__(self, spark: SparkSession, path: str, refresh: float = 1.0):
        self.sparkSession, self.path, self.refresh = spark, path, refresh
        self.opened = self.listed = 0
        self.lock, self.listings, self.since = threading.Lock(), {}, 0.0

    def _listed(self, what: tuple, make):
        """The result of ``make``, kept until the next refresh."""
        with self.lock:
            if time.monotonic() - self.since > self.refresh:
                self.listings, self.since = {}, time.monotonic()
            listings = self.listings
        if what not in listings:
            listings[what] = make()
        return listings[what]

    def _all_days(self) -> list[str]:
        return self._listed(("days",), lambda: store.day_folders(self.sparkSession, self.path))

    def _rows(self, days: list[str]) -> DataFrame:
        """All rows of some days."""
        return self._listed(("rows", *days), lambda: store.rows_of(self.sparkSession, self.path, [f"{self.path}/event_date={x}" for x in days]))

    def _files(self, days: list[str]) -> list[str]:
        return self._listed(("files", *days), lambda: self._rows(days).inputFiles())

    def _batches(self, day: str) -> int:
        return self._listed(("batches", day), lambda: len(store.batch_folders(self.sparkSession, self.path, day)))

    def days(self, query: Query) -> list[str]:
        """The store's days that a query may touch, the latest first."""
        date = lambda t: str(t.astimezone(dt.timezone.utc).date())
        days = self._all_days()
        if query.start is not None or query.end is not None or query.after is not None:
            days = [x for x in days if not x.startswith("__")]  # what has no time is in no range, and behind no cursor
        if query.start is not None:
            days = [x for x in days if x >= date(query.start)]
        if query.end is not None:
            days = [x for x in days if x <= date(query.end)]
        if query.after is not None:
            days = [x for x in days if x <= date(dt.datetime.fromtimestamp(query.after.ms / 1000, dt.timezone.utc))]
        return days

    def scan(self, days: list[str], query: Query) -> DataFrame | None:
        """Rows of some days, of files only that may hold the query's terms; None if there are none."""
        if not query.text:
            return self._rows(days)
        files = self._files(days)
        self.listed += len(files)
        found = files
        if len(files) > FEW_FILES:
            found = storeindex.narrowed(self.sparkSession, self.path, files, "term", storeindex.term_hashes(query.text), every=True)
        self.opened += len(found)
        if len(found) == len(files):
            return self._rows(days)
        return store.rows_of(self.sparkSession, self.path, found) if found else None

    def candidates(self, days: list[str], query: Query) -> DataFrame | None:
        """The first rows of some days behind the query's cursor, in order; earlier writes of an id among them."""
        rows = self.scan(days, query)
        if rows is None:
            return None
        if all_ := conditions(query, dated=True):
            rows = rows.where(reduce(Column.__and__, all_))
        return rows.orderBy(ms().desc(), F.col("id").desc()).limit(query.limit)

    def last_writes(self, rows: list) -> dict | None:
        """The last write of every id that may have been written again (id: row); None if none of the rows can have been."""
        day = lambda r: r.event_date.isoformat() if r.event_date else NO_DAY
        several = {d for d in {day(r) for r in rows} if self._batches(d) > 1}
        open_time = {r.id for r in rows if r.timestamp is None or r.timestamp == r.observed_at}
        doubtful = [r for r in rows if day(r) in several or r.id in open_time]
        if not doubtful:
            return None
        names = self._all_days()
        if not open_time:
            own = {day(r) for r in doubtful}
            names = [x for x in names if x in own]
        ids, files = sorted({r.id for r in doubtful}), self._files(names)
        self.listed += len(files)
        found = files
        if len(files) > FEW_FILES:
            known = [r.indexed_at for r in doubtful if r.indexed_at is not None]
            found = storeindex.narrowed(self.sparkSession, self.path, files, "id", storeindex.id_hashes(ids), every=False, since=min(known) if len(known) == len(doubtful) else None)
        self.opened += len(found)
        scan = self._rows(names) if len(found) == len(files) else store.rows_of(self.sparkSession, self.path, found)
        scan = scan.where(F.col("id").isin(ids))
        most = FEW_WRITES * len(ids)
        writes = scan.limit(most + 1).collect()
        if len(writes) > most:
            writes = store.last_write(scan).collect()
        names = [n for n in scan.columns if n not in ("id", "indexed_at")]
        order = lambda r: [(r[n] is not None, r[n]) for n in ("indexed_at", *names)]
        out: dict = {}
        for r in writes:
            if r.id not in out or order(r) > order(out[r.id]):
                out[r.id] = r
        return out

    def verified(self, rows: list, query: Query) -> list:
        """Those candidates that are an id's last write, or share its place with a last write that matches too; in order, one for each id."""
        first = {}
        for r in rows:
            first.setdefault((r.id, key_of(r).ms), r)
        last = self.last_writes(rows)
        if last is None:
            return list(first.values())
        out = []
        for (id_, at), r in first.items():
            w = last.get(id_, r)
            if id_ in last and key_of(w).ms != at:
                continue
            same = all(w[n] == r[n] for n in ("service", "host", "level", "message", "timestamp"))
            if same or self._matches(w, query):
                out.append(w)
        return out

    def _matches(self, row, query: Query) -> bool:
        if any(getattr(query, n) and row[n] != getattr(query, n) for n in ("service", "host", "level")):
            return False
        if not query.text and query.start is None and query.end is None:
            return True
        one = self.sparkSession.createDataFrame([row], store.rows_schema())
        return not matching(one, replace(query, after=None)).isEmpty()

    def rows(self, query: Query, more: int = 0) -> list:
        """A page's rows in falling order of time and id, ``more`` of them beyond the limit."""
        try:
            return self._page(query, more)
        except PySparkException:
            self.since = 0.0  # files that were listed may have been merged since
            return self._page(query, more)

    def _page(self, query: Query, more: int) -> list:
        want, out = query.limit + more, []
        days, at, size = self.days(query), 0, 1
        while at < len(days) and len(out) < want:
            window, here = days[at : at + size], query
            while len(out) < want:
                take = want - len(out)
                df = self.candidates(window, replace(here, limit=take))
                rows = df.collect() if df is not None else []
                out += self.verified(rows, query)
                if len(rows) < take:
                    break
                here = replace(here, after=key_of(rows[-1]))
            at, size = at + size, 2 * size
        return out[:want]

    def fetch(self, query: Query) -> tuple[list, SortKey | None]:
        """A page's rows, and the key to go on after if there are more."""
        rows = self.rows(query, 1)
        rest = len(rows) > query.limit
        rows = rows[: query.limit]
        return rows, key_of(rows[-1]) if rest else None


_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


def key_of(row) -> SortKey:
    """A stored row's place in the order; times come from Spark in the driver's zone."""
    if row.timestamp is None:
        return SortKey(None, row.id)
    return SortKey((row.timestamp.astimezone(dt.timezone.utc) - _EPOCH) // dt.timedelta(milliseconds=1), row.id)
