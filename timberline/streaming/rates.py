"""Counter rates on a stream: each series' last sample is kept as state, and its increases go into windows that a watermark closes."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def processor(keys: list[str], ties: list[str]):
    from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

    class Increases(StatefulProcessor):
        """Growth of a counter since its last sample; a drop is a restart from 0, the first sample counts 0.

        Samples of a batch are put in order. One that is older than the last sample
        of an earlier batch comes too late to tell what it adds and counts 0.
        """

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.last = handle.getValueState("last", "at bigint, value double")

        def handleInputRows(self, key, rows, timers):  # noqa: N802
            data = pd.concat(list(rows)).sort_values(["at", *ties], kind="stable")
            at, value = self.last.get() if self.last.exists() else (None, None)
            grown = []
            for t, v in zip(data["at"].astype("int64") // 1000, data["value"].astype(float)):
                if at is not None and t < at:
                    grown.append(0.0)
                    continue
                grown.append(0.0 if value is None else v if v < value else v - value)
                at, value = t, v
            self.last.update((int(at), float(value)))
            out = {k: [x] * len(grown) for k, x in zip(keys, key)}
            yield pd.DataFrame(out | {"at": data["at"].to_list(), "up": grown})

        def close(self) -> None:
            pass

    return Increases()


def increases(samples: DataFrame, keys: list[str], delay: str, ties: list[str] = []) -> DataFrame:  # noqa: B006
    """keys, at and up, the counter's growth, of every sample (keys, at, value and what orders samples of one time) of a stream."""
    fields = [samples.schema[k] for k in keys]
    schema = T.StructType([*fields, T.StructField("at", T.TimestampType()), T.StructField("up", T.DoubleType())])
    rows = samples.withWatermark("at", delay).select(*keys, "at", *ties, F.col("value").cast("double").alias("value"))
    return rows.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor(keys, ties), outputStructType=schema, outputMode="append", timeMode="EventTime", eventTimeColumnName="at"
    )


def counter_rates(samples: DataFrame, keys: list[str], width: int, step: int, delay: str, ties: list[str] = []) -> DataFrame:  # noqa: B006
    """keys, tick and the counter's increase a second over the last ``width`` seconds, every ``step`` seconds, once the watermark has passed a tick.

    Times are whole seconds. A tick sees what is later than ``width`` seconds before it, and its own second.
    """
    window = F.window("at", f"{width} seconds", f"{step} seconds", "1 second")
    sums = increases(samples, keys, delay, ties).groupBy(window.alias("w"), *keys).agg((F.sum("up") / float(width)).alias("rate"))
    return sums.select(*keys, (F.unix_seconds("w.end") - 1).alias("tick"), "rate")


def rate_quantiles(rates: DataFrame, keys: list[str], q: float) -> DataFrame:
    """For a batch of a stream's rates of histogram buckets (keys, bound, tick, rate): the quantile of every tick, as ``metrics.histogram_quantile`` gives it."""
    from timberline.operators.metrics import histogram_quantile

    return histogram_quantile(rates.withColumnRenamed("rate", "count"), [*keys, "tick"], q)
