"""Streaming operators: shaping as rollouts land (X01), watermarked metric
windows (X02), per-closed-batch whitening (X03), per-run episode state (X04),
duplicate suppression (X05), run sessions (X06)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def path_exists(spark, path: str) -> bool:
    """Whether ``path`` is there, on any file system Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def utc_instant(ts_ntz: Column | str) -> Column:
    """TIMESTAMP_NTZ wall clock read as UTC, independent of the session zone."""
    c = F.col(ts_ntz) if isinstance(ts_ntz, str) else ts_ntz
    return F.concat(c.cast("string"), F.lit("+00:00")).cast("timestamp")


def metric_windows(
    events: DataFrame, ts: str, keys: list[str], value: str, size: str, watermark: str, slide: str | None = None
) -> DataFrame:
    """Tumbling windows per key with late rows dropped by the watermark;
    ``slide`` gives the sliding variant used for smoothing."""
    e = events.withColumn("_ts", utc_instant(ts)).withWatermark("_ts", watermark)
    w = F.window("_ts", size, slide) if slide else F.window("_ts", size)
    g = e.groupBy(w.alias("w"), *keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.avg(value).alias("mean")
    )
    return g.select(F.unix_seconds(F.col("w.start")).alias("window_start"), *keys, "n", "total", "mean")


def running_episodes(events: DataFrame, run: str) -> DataFrame:
    """One counter per run kept in state across micro-batches (update mode).  A
    micro-batch's rows are counted before the shuffle, so a hot run moves one row per
    task."""
    return events.groupBy(F.col(run).alias("run")).agg(F.count(F.lit(1)).alias("episode"))


def dedupe_rollouts(stream: DataFrame, key: str, ts: str, watermark: str) -> DataFrame:
    """Drop replayed rollouts (same key) within the watermark."""
    return stream.withWatermark(ts, watermark).dropDuplicatesWithinWatermark([key])


def sessions(events: DataFrame, ts: str, key: str, gap: str, value: str, watermark: str | None = None) -> DataFrame:
    """Activity sessions per run; a gap of ``gap`` or more starts a new one.  With
    ``watermark`` later rows are dropped and closed sessions leave the state."""
    e = events.withColumn("_ts", utc_instant(ts))
    e = e.withWatermark("_ts", watermark) if watermark else e
    g = e.groupBy(key, F.session_window("_ts", gap).alias("s")).agg(
        F.count(F.lit(1)).alias("n_events"), F.sum(value).alias("total")
    )
    return g.select(
        key,
        F.unix_micros(F.col("s.start")).alias("session_start_us"),
        F.unix_micros(F.col("s.end")).alias("session_end_us"),
        "n_events",
        "total",
    )


def sessions_preaggregated(events: DataFrame, ts: str, key: str, gap_seconds: int, value: str) -> DataFrame:
    """X06 for batch tables, skew-proof: rows are first aggregated per
    ``(key, minute)`` (partial aggregation absorbs a hot run; a minute never
    contains a gap of ``gap_seconds`` >= 60), then sessions are cut on the
    minute rows where the next minute's first event is ``gap`` or more after
    the previous minute's last one.  Window groups are bounded by elapsed
    minutes, not by the number of events.  Same output as :func:`sessions`."""
    from pyspark.sql import Window

    if gap_seconds < 60:
        raise ValueError("minute pre-aggregation needs a gap of at least one minute")
    e = events.withColumn("_ts", utc_instant(ts)).withColumn("_us", F.unix_micros("_ts"))
    m = e.groupBy(key, F.floor(F.col("_us") / F.lit(60_000_000)).alias("_min")).agg(
        F.min("_us").alias("_first"), F.max("_us").alias("_last"), F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_s")
    )
    w = Window.partitionBy(key).orderBy("_min")
    new = F.when(
        F.lag("_last").over(w).isNull() | (F.col("_first") - F.lag("_last").over(w) >= F.lit(gap_seconds * 1_000_000)), 1
    ).otherwise(0)
    m = m.withColumn("_sid", F.sum(new).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return m.groupBy(key, "_sid").agg(
        F.min("_first").alias("session_start_us"),
        (F.max("_last") + F.lit(gap_seconds * 1_000_000)).alias("session_end_us"),
        F.sum("_n").alias("n_events"),
        F.sum("_s").alias("total"),
    ).drop("_sid")


def whiten_closed_batches(batch_size: int, value: str, batch: str, out_path: str, staging_path: str):
    """``foreachBatch`` handler that whitens only complete batches
    (``count >= batch_size``); rows of incomplete batches wait in a staging
    table versioned by micro-batch id (``staging_path/<id>``) and are merged
    into the next micro-batch.  G03 semantics apply inside a closed batch."""

    def handle(df: DataFrame, epoch_id: int) -> None:
        spark = df.sparkSession
        before = f"{staging_path}/{epoch_id - 1}"
        # every micro-batch stages its version, so only the first has none before it; a
        # version that cannot be read is an error
        if path_exists(spark, before):
            df = spark.read.parquet(before).unionByName(df)
        sizes = df.groupBy(batch).agg(F.count(F.lit(1)).alias("_n"))
        closed = sizes.where(F.col("_n") >= batch_size).select(batch)
        done = df.join(closed, batch, "left_semi")
        wait = df.join(closed, batch, "left_anti")
        stats = done.groupBy(batch).agg(F.avg(value).alias("_mu"), F.var_samp(value).alias("_var"))
        w = done.join(stats, batch).withColumn(
            f"{value}_w", (F.col(value) - F.col("_mu")) / F.sqrt(F.col("_var") + F.lit(1e-8))
        ).drop("_mu", "_var")
        # one folder a micro-batch: handled again, it is overwritten, not repeated
        w.write.mode("overwrite").parquet(f"{out_path}/_batch={epoch_id}")
        wait.write.mode("overwrite").parquet(f"{staging_path}/{epoch_id}")

    return handle
