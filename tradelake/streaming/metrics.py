"""Counts and time ranges measured while a query runs, without extra jobs."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tradelake.schemas import TableSpec
from tradelake.sinks import tables


def observed(df: DataFrame, name: str, *extra: Column, at: str | None = None) -> DataFrame:
    """Attach a row count (and the range of the time column ``at``) to a plan."""
    metrics = [F.count(F.lit(1)).alias("row_count"), *extra]
    if at is not None:
        metrics += [F.min(at).alias("min_ts"), F.max(at).alias("max_ts")]
    return df.observe(name, *metrics)


class RunMetrics:
    """Counts of the steps of one batch job, taken while its rows pass and stored when it is done.

    A step is counted where its rows are first computed; no step is run again for it.
    """

    def __init__(self, spark: SparkSession, spec: TableSpec, job: str, run: str | None = None) -> None:
        self.spark, self.spec, self.job = spark, spec, job
        self.run = run or uuid.uuid4().hex
        self._steps: dict[str, Observation] = {}

    def step(self, df: DataFrame, name: str, at: str | None = None) -> DataFrame:
        """``df``, counted under ``name`` with the range of the time column ``at``."""
        seen = self._steps[name] = Observation(f"{name}-{self.run}")
        none = F.lit(None).cast("timestamp")
        first, last = (F.min(at), F.max(at)) if at else (F.max(none), F.max(none))
        micros = [F.unix_micros(c) for c in (first, last)]
        return df.observe(seen, F.count(F.lit(1)).alias("row_count"), micros[0].alias("min_us"), micros[1].alias("max_us"))

    def store(self) -> None:
        """Append one row per step; call it when the job's writes are done."""
        rows = [
            (self.job, self.run, name, seen.get["row_count"], seen.get["min_us"], seen.get["max_us"])
            for name, seen in self._steps.items()
        ]
        df = self.spark.createDataFrame(rows, "job string, run string, step string, row_count long, min_us long, max_us long")
        times = {c: F.timestamp_micros(f"{c[:3]}_us") for c in ("min_ts", "max_ts")}
        tables.ensure_table(self.spark, self.spec)
        tables.append(df.withColumns({**times, "recorded_at": F.current_timestamp()}).coalesce(1), self.spec)


class BatchMetrics(StreamingQueryListener):
    """Keeps the newest observed metrics and row counts of each query.

    Only the last progress per query is held, whatever the stream's length.
    """

    def __init__(self) -> None:
        self.latest: dict[str, dict] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = self.latest.setdefault(progress.name or str(progress.id), {"input_rows": 0})
        seen["batch_id"] = progress.batchId
        seen["input_rows"] += progress.numInputRows
        for name, row in progress.observedMetrics.items():
            seen[name] = row.asDict()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def watch(spark: SparkSession) -> BatchMetrics:
    """Register and return a listener."""
    listener = BatchMetrics()
    spark.streams.addListener(listener)
    return listener
