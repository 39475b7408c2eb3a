"""Rates and history of progress samples while they arrive.

The last samples of each pipeline are keyed state: a new sample is compared with the one
before it, which may have come in an earlier batch or before a restart, and joins the
history, which keeps the newest ``HISTORY_SAMPLES``. A pipeline whose last sample is
``FORGET_HOURS`` older than the newest of all is forgotten by a timer on the samples' own
time; samples older than that are late and left out. The history can be read from the
checkpoint at any time.
"""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from evlake.fixed_values import HISTORY_SAMPLES

_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Hours of samples' time after which a silent pipeline is forgotten.
FORGET_HOURS = 24 * 30


class SampleHistory(StatefulProcessor):
    """Rows (pipeline, t, <column>_rate) for every sample, in order of t.

    The samples of one batch and pipeline are sorted together; one that is older than
    what an earlier batch brought has no rate and is not kept.
    """

    def __init__(self, columns: list[str], keep: int = HISTORY_SAMPLES):
        self.columns, self.keep = columns, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        fields = ", ".join(f"{c} bigint" for c in self.columns)
        self.samples = handle.getListState("samples", f"t double, {fields}")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        kept = [tuple(s) for s in self.samples.get()] if self.samples.exists() else []
        fresh = [tuple(r) for pdf in rows for r in pdf[["t", *self.columns]].astype(object).itertuples(index=False)]
        out = []
        for sample in sorted(fresh, key=lambda s: s[0]):
            t, values = float(sample[0]), [None if pd.isna(v) else int(v) for v in sample[1:]]
            before = kept[-1] if kept else None
            out.append((key[0], t, *self._rates(before, t, values)))
            if before is None or t > before[0]:
                kept = [*kept[-(self.keep - 1) :], (t, *values)] if self.keep > 1 else [(t, *values)]
        self.samples.put(kept)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        # Due when the watermark passes the last sample.
        self.handle.registerTimer(int(kept[-1][0] * 1000))
        rates = {f"{c}_rate": [r[i + 2] for r in out] for i, c in enumerate(self.columns)}
        frame = pd.DataFrame({"pipeline": [r[0] for r in out], "t": [r[1] for r in out], **rates})
        yield frame.astype({c: "Float64" for c in rates})

    def _rates(self, before, t: float, values: list) -> list:
        if before is None or t <= before[0]:
            return [None] * len(values)
        return [None if v is None or b is None else (v - b) / (t - before[0]) for b, v in zip(before[1:], values, strict=True)]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.samples.clear()
        return iter([])

    def close(self) -> None:
        pass


def live_rates(
    samples: DataFrame, columns: list[str], keep: int = HISTORY_SAMPLES, forget_hours: int = FORGET_HOURS
) -> DataFrame:
    """The rates of a stream of samples, one row per sample."""
    samples.sparkSession.conf.set(_STATE_STORE, _ROCKSDB)
    at = F.timestamp_seconds("t").alias("at")
    wanted = samples.select("pipeline", "t", at, *[F.col(c).cast("long").alias(c) for c in columns])
    wanted = wanted.withWatermark("at", f"{forget_hours} hours")
    shape = "pipeline string, t double, " + ", ".join(f"{c}_rate double" for c in columns)
    return wanted.groupBy("pipeline").transformWithStateInPandas(
        SampleHistory(columns, keep), shape, "Append", "EventTime"
    )


def kept_history(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The samples the state holds as of the last batch."""
    state = spark.read.format("statestore").option("stateVarName", "samples").load(checkpoint)
    return state.select("key.pipeline", "list_element.*")
