"""The spike detector on a stream: keyed state per service, evaluated as time goes on."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timberline.operators.alerts import ALERT_LEVELS, Rule

STATE = "counts map<bigint,bigint>, firing boolean, last bigint"
ALERTS = "service string, bucket bigint, kind string, errors bigint, usual double, samples array<string>"
#: Characters of a sample message that the state keeps.
SAMPLE = 200


class Detector:
    """State machine of one service over bucket numbers.

    Counts older than window and baseline are dropped; an evaluation makes one
    transition at most.
    """

    def __init__(self, rule: Rule, counts: dict[int, int] | None = None, firing: bool = False, last: int | None = None):
        self.rule, self.counts, self.firing, self.last = rule, dict(counts or {}), firing, last

    def observe(self, bucket: int, n: int = 1, now: int | None = None) -> None:
        if now is not None:
            bucket = min(bucket, now)
            if bucket <= now - self.rule.window - self.rule.baseline:
                return
        self.counts[bucket] = self.counts.get(bucket, 0) + n

    def evaluate(self, now: int) -> tuple[str, int, float] | None:
        r = self.rule
        edge = now - r.window
        self.counts = {b: n for b, n in self.counts.items() if b > edge - r.baseline}
        win = sum(n for b, n in self.counts.items() if edge < b <= now)
        usual = sum(n for b, n in self.counts.items() if b <= edge) * r.window / r.baseline
        spike = win >= r.min_errors and win >= r.ratio * max(usual, 1.0)
        if not self.firing and spike and (self.last is None or now - self.last >= r.cooldown):
            self.firing, self.last = True, now
            return "firing", win, usual
        if self.firing and 2 * win < r.min_errors:
            self.firing = False
            return "resolved", win, usual
        return None

    def advance(self, first: int, to: int, fresh: dict[int, int] | None = None) -> list[tuple[int, str, int, float]]:
        """Transitions (bucket, kind, errors, usual) of the buckets ``first`` to ``to``, in which ``fresh`` errors are observed."""
        out, b, left = [], first, sorted((x for x in fresh or () if x >= first), reverse=True)
        while b <= to:
            if left and left[-1] == b:
                self.observe(b, fresh[left.pop()])
            elif self.idle:  # nothing happens until the next errors
                b = left[-1] if left else to + 1
                continue
            if (got := self.evaluate(b)) is not None:
                out.append((b, *got))
            b += 1
        return out

    @property
    def idle(self) -> bool:
        return not self.counts and not self.firing


def processor(rule: Rule):
    import json

    from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

    def present(timers) -> int:
        return timers.getCurrentWatermarkInMs() * 1000 // rule.bucket

    def table(key, out: list[tuple], recent: list[str]) -> pd.DataFrame:
        rows = [(key[0], *x, recent if x[1] == "firing" else []) for x in out]
        return pd.DataFrame(rows, columns=["service", "bucket", "kind", "errors", "usual", "samples"]).astype({"bucket": "int64", "errors": "int64", "usual": "float64"})

    class SpikeProcessor(StatefulProcessor):
        """Counts of a batch are added, then every bucket up to the newest one is evaluated in order; a timer evaluates those that begin later.

        Time goes on with the clock: to the present bucket, or, where rows are older
        than window and baseline as in a replay, by as many buckets as have passed since
        they came. An idle service is forgotten. The last messages go along with a firing.
        """

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.state = handle.getValueState("detector", "counts string, firing boolean, last bigint, done bigint, seen bigint, recent string")

        def load(self) -> tuple[Detector, int | None, int | None, list[str]]:
            if not self.state.exists():
                return Detector(rule), None, None, []
            counts, firing, last, done, seen, recent = self.state.get()
            return Detector(rule, {int(k): v for k, v in json.loads(counts).items()}, firing, last), done, seen, json.loads(recent)

        def keep(self, detector: Detector, done: int, clock: int, recent: list[str]) -> None:
            for at in list(self.handle.listTimers()):
                self.handle.deleteTimer(at)
            self.state.update((json.dumps(detector.counts), detector.firing, detector.last, done, clock, json.dumps(recent)))
            self.handle.registerTimer(-(-(clock + 1) * rule.bucket // 1000))

        def handleInputRows(self, key, rows, timerValues):
            detector, done, _, recent = self.load()
            fresh: dict[int, int] = {}
            clock = 0
            for pdf in rows:
                clock = max(clock, int(pdf["clock"].max()))
                recent = [*recent, *(x[:SAMPLE] for x in pdf["message"].dropna().tail(rule.samples).tolist())][-rule.samples :]
                for b, n in pdf["bucket"].value_counts().items():
                    fresh[int(b)] = fresh.get(int(b), 0) + int(n)
            out = []
            if fresh:
                newest = max(fresh)
                first = min(fresh) if done is None else done + 1
                for b in sorted(x for x in fresh if x < first):
                    detector.observe(b, fresh[b], max(newest, first - 1))
                out = detector.advance(first, newest, fresh)
                self.keep(detector, newest if done is None else max(newest, done), clock, recent)
            yield table(key, out, recent[::-1])

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            detector, done, seen, recent = self.load()
            out = []
            if done is not None:
                clock = present(timerValues)
                to = clock if seen - done <= rule.window + rule.baseline else done + clock - seen
                out = detector.advance(done + 1, to)
                if detector.idle:
                    self.state.clear()
                else:
                    self.keep(detector, max(to, done), clock, recent)
            yield table(key, out, recent[::-1])

        def close(self) -> None:
            pass

    return SpikeProcessor()


def alerts(logs: DataFrame, rule: Rule) -> DataFrame:
    """Transitions of a stream of logs; its session needs the RocksDB state store.

    A row a second from Spark's rate source drives the clock, which is the watermark
    of the rows' processing time: services are evaluated in silence, too, and a
    query over the available rows ends, which it wouldn't with timers in processing time.
    """
    now = F.current_timestamp()
    bucket = F.floor(F.unix_micros(F.least(F.coalesce("observed_at", now), now)) / F.lit(rule.bucket)).cast("bigint")
    message = F.col("message") if "message" in logs.columns else F.lit(None).cast("string")
    errors = logs.where(F.col("level").isin(*ALERT_LEVELS)).select("service", bucket.alias("bucket"), message.alias("message"))
    ticks = logs.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load().select(F.lit(None).cast("string").alias("service"), F.lit(None).cast("bigint").alias("bucket"), F.lit(None).cast("string").alias("message"))
    clock = F.floor(F.unix_micros(now) / F.lit(rule.bucket)).cast("bigint")
    rows = errors.unionByName(ticks).withColumns({"at": now, "clock": clock}).withWatermark("at", "0 seconds")
    return rows.groupBy("service").transformWithStateInPandas(statefulProcessor=processor(rule), outputStructType=ALERTS, outputMode="update", timeMode="EventTime")
