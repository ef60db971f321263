"""Incremental ingestion: files as they come, each row once, restart without repeats, states with a time to live."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from lodestrata.lineage import shared_dir


def checkpoint_for(spark: SparkSession, name: str, config: dict) -> str:
    """A checkpoint folder keyed by the configuration: a changed configuration starts afresh."""
    digest = hashlib.sha256(json.dumps(config, sort_keys=True).encode()).hexdigest()[:16]
    return f"{shared_dir(spark)}/streams/{name}-{digest}"


def ingest(spark: SparkSession, source: str, schema: StructType, target: str, name: str, config: dict, key: list[str] | None = None, time: str | None = None, late: str = "7 days", files_per_trigger: int = 200) -> StreamingQuery:
    """Reads new Parquet files, drops rows whose key was seen within ``late`` of event time, appends, and stops when done."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source)
    if key and time:
        rows = rows.withWatermark(time, late).dropDuplicatesWithinWatermark(key)
    return rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint_for(spark, name, config)).trigger(availableNow=True).start()


def upsert_batches(stream: DataFrame, apply: callable, checkpoint: str) -> StreamingQuery:
    """Hands every micro-batch to ``apply(frame, batch id)``; the id makes a repeated batch recognisable."""
    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def replace_batch(target: str) -> callable:
    """An ``apply`` that writes each batch to a folder of its own by the batch's id, so that a batch which comes again
    after a failure replaces itself."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return apply


def host_cooldown(stream: DataFrame, host: str, seq: str, result: str, after_errors: int = 3, after_dead: int = 8, retries: int = 3, pause: int = 50, forgive_after: int = 20) -> DataFrame:
    """The state of each host after each attempt: ``host``, ``seq``, ``outcome``, ``errors`` in a row, ``retries`` used, and the
    number until which it is paused.

    ``result`` is ok, error or dead (a link that is gone). From ``after_errors`` errors in a row on (``after_dead`` for dead
    links) the host is paused for ``pause`` numbers, ``retries`` times; then attempts are given up. ``forgive_after``
    successes in a row give one retry back. One small state per host; within a batch attempts go by ``seq``, and batches
    are expected in its order.
    """

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        errors, streak, used, until = state.get if state.exists else (0, 0, 0, 0)
        rows = pd.concat(list(batches)).sort_values(seq)
        out = []
        for n, how in zip(rows[seq], rows[result], strict=True):
            if how == "ok":
                errors, streak = 0, streak + 1
                if streak >= forgive_after and used:
                    used, streak = used - 1, 0
                outcome = "ok"
            else:
                errors, streak = errors + 1, 0
                if errors >= (after_dead if how == "dead" else after_errors) and used < retries:
                    used, until, outcome = used + 1, int(n) + pause, "paused"
                else:
                    outcome = "dead" if how == "dead" else "given_up"
            out.append((k[0], int(n), outcome, errors, used, until))
        state.update((errors, streak, used, until))
        yield pd.DataFrame(out, columns=["host", "seq", "outcome", "errors", "retries", "until"])

    rows = stream.select(F.col(host).cast("string").alias(host), F.col(seq).cast("bigint").alias(seq), F.col(result).alias(result)).filter(F.col(host).isNotNull())
    return rows.groupBy(host).applyInPandasWithState(step, "host string, seq bigint, outcome string, errors int, retries int, until bigint", "errors int, streak int, used int, until bigint", "append", GroupStateTimeout.NoTimeout)


def daily_counts(stream: DataFrame, time: str, late: str = "1 day") -> DataFrame:
    """Rows per day of event time, with a watermark."""
    return stream.withWatermark(time, late).groupBy(F.window(time, "1 day")).agg(F.count(F.lit(1)).alias("n")).select(F.to_date("window.start").alias("day"), "n")


def latest_with_ttl(stream: DataFrame, key: str, time: str, value: str, ttl: str) -> DataFrame:
    """The last value per key, forgotten when nothing newer came within ``ttl`` of event time.

    One small state per key; emits ``key``, ``value``, ``at``, ``live`` on every change and on expiry.
    """
    span = pd.Timedelta(ttl)

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            value_, at = state.get
            state.remove()
            yield pd.DataFrame({"key": [k[0]], "value": [value_], "at": [pd.Timestamp(at, unit="ms")], "live": [False]})
            return
        best = state.get if state.exists else None
        for b in batches:
            for v, t in zip(b[value], b[time], strict=True):
                if pd.isna(t):
                    continue
                ms = pd.Timestamp(t).value // 1_000_000
                if best is None or ms >= best[1]:
                    best = (v, ms)
        if best is None:
            return
        state.update(best)
        state.setTimeoutTimestamp(max(best[1] + int(span.total_seconds() * 1000), state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"key": [k[0]], "value": [best[0]], "at": [pd.Timestamp(best[1], unit="ms")], "live": [True]})

    rows = stream.withWatermark(time, ttl).select(F.col(key).cast("string").alias(key), F.col(time).alias(time), F.col(value).cast("string").alias(value))
    return rows.groupBy(key).applyInPandasWithState(step, "key string, value string, at timestamp, live boolean", "value string, at bigint", "update", GroupStateTimeout.EventTimeTimeout)


def windowed(stream: DataFrame, time: str, width: str, slide: str | None, by: list[str], late: str = "1 hour") -> DataFrame:
    """Counts per tumbling or sliding window of event time: an engine capability, with late rows up to ``late``."""
    w = F.window(time, width, slide) if slide else F.window(time, width)
    return stream.withWatermark(time, late).groupBy(w, *by).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), *by, "n")
