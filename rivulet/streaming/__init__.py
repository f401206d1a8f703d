"""Streaming forms of the run ledger and of resumable surveys."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attempt_stream(events: DataFrame, key: str = "job", limit: int = 2) -> DataFrame:
    """Decisions of ``operators.ledger.attempts`` on a stream of ``key, event_id, kind, recipe``, in order of arrival.

    The state of a job is its epoch, its number of runs, its last event and the recipes that succeeded.
    """

    def decide(keys, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        epoch, ran, last_kind, last_recipe, won = state.get if state.exists else (0, 0, "", -1, "")
        done = set(filter(None, won.split(",")))
        out = []
        for pdf in frames:
            for r in pdf.sort_values("event_id").itertuples():
                if r.kind == "reset":
                    epoch, ran, last_kind, last_recipe, done = epoch + 1, 0, "reset", int(r.recipe), set()
                    continue
                if r.kind == "run":
                    what = "REUSED" if str(r.recipe) in done else "UNCHANGED_FAILURE" if last_kind == "fail" and last_recipe == r.recipe else "RETRY_LIMIT" if ran >= limit else "RUN"
                    out.append((keys[0], r.event_id, r.recipe, epoch, ran + 1, what))
                    ran += 1
                elif r.kind == "success":
                    done.add(str(r.recipe))
                last_kind, last_recipe = r.kind, int(r.recipe)
        state.update((epoch, ran, last_kind, last_recipe, ",".join(sorted(done))))
        yield pd.DataFrame(out, columns=[key, "event_id", "recipe", "epoch", "attempt", "decision"])

    return events.select(key, "event_id", "kind", "recipe").groupBy(key).applyInPandasWithState(
        decide, f"{key} long, event_id long, recipe long, epoch long, attempt long, decision string", "epoch long, ran long, last_kind string, last_recipe long, won string", "append", "NoTimeout"
    )


def resume_into(stream: DataFrame, path: str, key: str, checkpoint: str):
    """Writes each key once: a batch leaves out keys that the output has, so a replayed batch adds nothing."""

    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        try:
            done = spark.read.schema(batch.select(key).schema).parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":  # an output that cannot be read must not be written twice
                raise
            done = spark.createDataFrame([], batch.select(key).schema)
        batch.dropDuplicates([key]).join(done, key, "left_anti").write.mode("append").parquet(path)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, ts: str, kind: str, width: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """Event-time counts with a watermark (an extra beyond the reference's own operators)."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, width), kind).agg(F.count(F.lit(1)).alias("n")).select("window.start", "window.end", kind, "n")
