"""Run logs as a metric stream (binding 7, events) and streaming forms:
J05, W07, X01, X02, X04, X06."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..sources import tables as TB
from ..streaming import ops as X
from ..streaming.runner import latest, read_stream, run_available, run_handler, stream_paths
from ..streaming.timers import closed_sessions, rocksdb_state
from .bindings import rollouts_of_documents, shaped_scores
from .q_docs import SHAPED_SQL
from .registry import query

DAY = "CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS BIGINT)"


def day_index(ts: str = "ts"):
    return F.datediff(F.col(ts).cast("date"), F.lit("2024-01-01").cast("date")).cast("long")


@query(
    "run_compare",
    f"""WITH g AS (SELECT {DAY} AS day, event_type, CASE WHEN user_id % 2 = 0 THEN 'a' ELSE 'b' END AS run, avg(value) AS v
               FROM events GROUP BY ALL),
         a AS (SELECT * FROM g WHERE run = 'a'), b AS (SELECT * FROM g WHERE run = 'b')
    SELECT coalesce(a.day, b.day) AS day, coalesce(a.event_type, b.event_type) AS event_type,
           a.v AS value_a, b.v AS value_b, b.v - a.v AS delta
    FROM a FULL OUTER JOIN b ON a.day = b.day AND a.event_type = b.event_type""",
    ["value_a", "value_b", "delta"],
    "J05",
)
def run_compare(spark, sf):
    """Two runs on the same step (day) and metric: one aggregate over the
    whole table labelled by run, then a full outer join of the two runs'
    rows with the delta (runs: even / odd run ids)."""
    e = TB.table(spark, sf, "events").withColumn("day", day_index())
    e = e.withColumn("run", F.when(F.col("user_id") % 2 == 0, F.lit("a")).otherwise(F.lit("b")))
    g = e.groupBy("day", "event_type", "run").agg(F.avg("value").alias("v"))
    return compare_runs(g, "run", "a", "b", ["day", "event_type"], "v")


def compare_runs(long_metrics, run_col: str, run_a: str, run_b: str, keys: list[str], value: str):
    """Full outer join of two runs' metrics on the step keys, plus the delta."""
    a = long_metrics.where(F.col(run_col) == run_a).select(*keys, F.col(value).alias("value_a"))
    b = long_metrics.where(F.col(run_col) == run_b).select(*keys, F.col(value).alias("value_b"))
    return a.join(b, keys, "full_outer").withColumn("delta", F.col("value_b") - F.col("value_a"))


@query(
    "metric_smooth",
    f"""WITH d AS (SELECT user_id, event_type, {DAY} AS day, count(*) AS n, sum(value) AS s FROM events GROUP BY ALL)
    SELECT user_id, event_type, day, n, s / n AS mean_value,
           sum(s) OVER w3 / sum(n) OVER w3 AS smooth_3d,
           s / n - lag(s / n) OVER (PARTITION BY user_id, event_type ORDER BY day) AS delta_prev
    FROM d WINDOW w3 AS (PARTITION BY user_id, event_type ORDER BY day RANGE BETWEEN 2 PRECEDING AND CURRENT ROW)""",
    ["mean_value", "smooth_3d", "delta_prev"],
    "W07",
)
def metric_smooth(spark, sf):
    """Daily metric per run with a trailing 3-day smoothing and change from
    the previous step.  Rows are pre-aggregated per day (partial aggregation
    absorbs a hot run) before the window, whose groups are bounded by the
    number of days, not by the data volume."""
    e = TB.table(spark, sf, "events").withColumn("day", day_index())
    d = e.groupBy("user_id", "event_type", "day").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("s"))
    w = Window.partitionBy("user_id", "event_type").orderBy("day")
    w3 = w.rangeBetween(-2, 0)
    mean = F.col("s") / F.col("n")
    return d.select(
        "user_id", "event_type", "day", "n", mean.alias("mean_value"),
        (F.sum("s").over(w3) / F.sum("n").over(w3)).alias("smooth_3d"),
        (mean - F.lag(mean).over(w)).alias("delta_prev"),
    )


SESSIONS_SQL = """WITH o AS (SELECT user_id, ts, value, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events),
         f AS (SELECT *, sum(CASE WHEN prev IS NULL OR ts >= prev + INTERVAL 6 HOUR THEN 1 ELSE 0 END)
                          OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM o)
    SELECT user_id, epoch_us(min(ts)) AS session_start_us, epoch_us(max(ts) + INTERVAL 6 HOUR) AS session_end_us,
           count(*) AS n_events, sum(value) AS total FROM f GROUP BY user_id, sid"""


@query(
    "run_sessions",
    SESSIONS_SQL,
    ["total"],
    "X06",
)
def run_sessions(spark, sf):
    """Activity sessions per run with a 6 hour gap; minute pre-aggregation
    first, so a hot run is not one large sort (``session_window`` form:
    ``streaming.ops.sessions``, equal results, tested)."""
    return X.sessions_preaggregated(TB.table(spark, sf, "events"), "ts", "user_id", 6 * 3600, "value")


@query(
    "stream_metrics",
    """SELECT CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS window_start, event_type, count(*) AS n,
              sum(value) AS total, avg(value) AS mean FROM events GROUP BY ALL""",
    ["total", "mean"],
    "X02",
)
def stream_metrics(spark, sf):
    """Streaming daily metrics per event type with a 1-day watermark, update mode:
    a row later than that is dropped, closed windows leave the state, and the last
    emitted row of each window is its result (the last day included)."""
    s = read_stream(spark, f"{sf}/events.parquet")
    agg = X.metric_windows(s, "ts", ["event_type"], "value", "1 day", "1 day")
    return latest(run_available(agg, "stream_metrics", "update"), ["window_start", "event_type"])


@query(
    "stream_episode",
    "SELECT user_id AS run, count(*) AS episode FROM events GROUP BY user_id",
    [],
    "X04",
)
def stream_episode(spark, sf):
    """Running episode count per run kept in streaming state; the last
    emitted value per run is its total."""
    s = read_stream(spark, f"{sf}/events.parquet")
    return latest(run_available(X.running_episodes(s, "user_id"), "stream_episode", "update"), ["run"])


@query(
    "stream_shaping",
    f"{SHAPED_SQL} SELECT rollout_id, score_raw - eos_penalty - length_penalty - repetition_penalty AS score_shaped FROM sh",
    ["score_shaped"],
    "X01",
)
def stream_shaping(spark, sf):
    """Rollouts shaped as they land: the batch column functions on a stream."""
    s = read_stream(spark, f"{sf}/documents.parquet")
    sh = shaped_scores(rollouts_of_documents(s)).select("rollout_id", "score_shaped")
    return run_available(sh, "stream_shaping", "append").drop("_batch")


@query("stream_sessions", SESSIONS_SQL, ["total"], "X06")
def stream_sessions(spark, sf):
    """The sessions of ``run_sessions`` on a stream (complete mode: open sessions too)."""
    s = read_stream(spark, f"{sf}/events.parquet")
    return run_available(X.sessions(s, "ts", "user_id", "6 hours", "value"), "stream_sessions", "complete").drop("_batch")


@query(
    "stream_sessions_closed",
    f"""SELECT * FROM ({SESSIONS_SQL}) WHERE session_end_us <= (SELECT epoch_us(max(ts) - INTERVAL 1 HOUR) FROM events)""",
    ["total"],
    "X06",
)
def stream_sessions_closed(spark, sf):
    """Sessions emitted once, by an event-time timer when the watermark (1 hour behind) passes
    their end; the state holds open sessions only."""
    s = read_stream(spark, f"{sf}/events.parquet")
    with rocksdb_state(spark):
        out = closed_sessions(s, "ts", "user_id", 6 * 3600, "value", "1 hour")
        return run_available(out, "stream_sessions_closed", "append").drop("_batch")


@query("stream_dedupe", "SELECT event_id, user_id, value FROM events", ["value"], "X05")
def stream_dedupe(spark, sf):
    """Every event arrives twice; the replay is dropped within the watermark."""
    s = read_stream(spark, f"{sf}/events.parquet").withColumn("ts", X.utc_instant("ts"))
    out = X.dedupe_rollouts(s.unionByName(s), "event_id", "ts", "1 hour")
    return run_available(out.select("event_id", "user_id", "value"), "stream_dedupe", "append").drop("_batch")


CLOSED = 20


@query(
    "stream_whiten",
    f"""WITH s AS (SELECT user_id, avg(value) AS mu, var_samp(value) AS var FROM events GROUP BY user_id HAVING count(*) >= {CLOSED})
        SELECT event_id, user_id, (value - mu) / sqrt(var + 1e-8) AS value_w FROM events JOIN s USING (user_id)""",
    ["value_w"],
    "X03 G03",
)
def stream_whiten(spark, sf):
    """Whitening of each run once it has ``CLOSED`` rows; smaller runs keep waiting in the
    staging table."""
    out, stage = (f"{x}/whiten" for x in stream_paths(spark, "stream_whiten"))
    s = read_stream(spark, f"{sf}/events.parquet").select("event_id", "user_id", "value")
    run_handler(s, X.whiten_closed_batches(CLOSED, "value", "user_id", out, stage), "stream_whiten")
    empty = spark.createDataFrame([], "event_id long, user_id long, value_w double")
    return spark.read.parquet(out).select(empty.columns) if X.path_exists(spark, out) else empty
