"""Long rollouts, run logs and co-located tables: GAE by blocks (G05 W01), the idempotent
metric log (S10), change points (W07)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.changepoint import cusum_shift
from ..operators.ranking import bucketed_row_number, span_bucket
from ..operators.scans import gae_scan
from ..session import stored
from ..sources import metric_log as ML
from ..sources import tables as TB
from ..streaming import ops as X
from ..streaming.runner import read_stream, run_handler, stream_paths
from .bindings import ppo_rewards, token_long, token_rollouts
from .q_events import DAY, day_index
from .q_ppo import UPDATE_DOUBLES, UPDATE_SQL, rewards_cte, update_metrics_df
from .registry import query

GAMMA, LAM = 0.99, 0.95


#: Not a finite decimal: sums in another order then differ in the last bits only, never at the
#: rounding boundary that exact products of short decimals sit on.
TOKEN_LAM = 1 / 1.05


@query(
    "gae_blocks",
    f"""WITH RECURSIVE {rewards_cte()},
    dl AS (SELECT *, reward + {GAMMA} * coalesce(lead(value) OVER (PARTITION BY rollout_id ORDER BY t), 0.0) - value AS delta FROM rw),
    mx AS (SELECT rollout_id, max(t) AS tmax FROM dl GROUP BY rollout_id),
    ga(rollout_id, t, adv) AS (
      SELECT dl.rollout_id, dl.t, dl.delta FROM dl JOIN mx ON dl.rollout_id = mx.rollout_id AND dl.t = mx.tmax
      UNION ALL
      SELECT dl.rollout_id, dl.t, dl.delta + {GAMMA * TOKEN_LAM} * ga.adv FROM dl JOIN ga ON dl.rollout_id = ga.rollout_id AND dl.t = ga.t - 1)
    SELECT rollout_id, t, adv AS advantage FROM ga""",
    ["advantage"],
    "G05 W01",
)
def gae_blocks(spark, sf):
    """GAE of the token rollouts from rows (rollout, t) by the block scan, in blocks of 4."""
    lt = stored(token_long(ppo_rewards(token_rollouts(spark, sf)), ["rewards", "value"], ["rollout_id"]), "tokens")
    return gae_scan(lt, ["rollout_id"], "t", "rewards", "value", GAMMA, TOKEN_LAM, block=4).select("rollout_id", "t", "advantage")


EPISODE_CTE = """e AS (SELECT event_type AS run, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS t,
              value / 100 AS reward, (value - 50) / 25 AS critic FROM events)"""


@query(
    "gae_long",
    f"""WITH RECURSIVE {EPISODE_CTE},
    d AS (SELECT *, reward + {GAMMA} * coalesce(lead(critic) OVER (PARTITION BY run ORDER BY t), 0.0) - critic AS delta FROM e),
    -- 512 positions of a run at a time, from its end: a list of each piece, folded with what the piece to the right left
    c AS (SELECT run, t // 512 AS b, list(event_id ORDER BY t DESC) AS ids, list(delta ORDER BY t DESC) AS ds FROM d GROUP BY run, t // 512),
    m AS (SELECT run, max(b) AS last FROM c GROUP BY run),
    s(run, b, ids, adv) AS (
      SELECT c.run, c.b, ids, list_reduce(ds, lambda acc, x: list_append(acc, x + {GAMMA * LAM} * acc[-1]), [0.0])
      FROM c JOIN m ON c.run = m.run AND c.b = m.last
      UNION ALL SELECT c.run, c.b, c.ids, list_reduce(c.ds, lambda acc, x: list_append(acc, x + {GAMMA * LAM} * acc[-1]), [s.adv[-1]])
      FROM s JOIN c ON c.run = s.run AND c.b = s.b - 1)
    SELECT run, unnest(ids) AS event_id, unnest(adv[2:]) AS advantage FROM s""",
    ["advantage"],
    "G05 W01",
)
def gae_long(spark, sf):
    """Each event type as one rollout over all its events (a fifth of the table each): the scan
    spreads it over tasks.  Positions are two-level ranks."""
    e = TB.table(spark, sf, "events").select(
        F.col("event_type").alias("run"), "event_id", (F.col("value") / 100).alias("reward"), ((F.col("value") - 50) / 25).alias("critic"))
    e = stored(e, "episodes")
    r = stored(bucketed_row_number(e, ["run"], ["event_id"], span_bucket(e, "event_id"), "t"), "episodes")
    return gae_scan(r, ["run"], "t", "reward", "critic", GAMMA, LAM).select("run", "event_id", "advantage")


@query("metric_log", f"{UPDATE_SQL} SELECT * FROM m", UPDATE_DOUBLES, "S10 M01")
def metric_log(spark, sf):
    """Update records written to a log, then half the updates written again, as a job that is
    repeated does: the log holds each record once."""
    records = stored(update_metrics_df(spark, sf), "updates")
    path = f"{stream_paths(spark, 'metric_log')[0]}"
    keys = ("run_id", "batch_id")
    ML.write_records(records, path, keys)
    ML.write_records(records.where(F.col("batch_id") % 2 == 0), path, keys)
    return ML.read_records(spark, path, records.schema)


@query(
    "stream_metric_log",
    f"""SELECT event_type AS run_id, CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS update, count(*) AS n,
               sum(value) AS total, avg(value) AS mean FROM events GROUP BY ALL""",
    ["total", "mean"],
    "S10 X02",
)
def stream_metric_log(spark, sf):
    """Daily records of an update-mode stream in the same log: each micro-batch replaces the
    records it has news of, and its replay changes nothing."""
    s = read_stream(spark, f"{sf}/events.parquet")
    w = X.metric_windows(s, "ts", ["event_type"], "value", "1 day", "1 day")
    w = w.select(F.col("event_type").alias("run_id"), F.col("window_start").alias("update"), "n", "total", "mean")
    path = f"{stream_paths(spark, 'stream_metric_log')[0]}"
    sink = ML.log_sink(path)

    def twice(batch, epoch_id):  # a micro-batch that is handled again after a failure
        sink(batch, epoch_id)
        sink(batch, epoch_id)

    run_handler(w, twice, "stream_metric_log", output_mode="update")
    return ML.read_records(spark, path, w.schema)


@query(
    "metric_shift",
    f"""WITH g AS (SELECT user_id, event_type, {DAY} AS day, avg(value) AS v FROM events GROUP BY ALL),
    c AS (SELECT *, sum(v) OVER w AS s, row_number() OVER w AS k, sum(v) OVER (PARTITION BY user_id, event_type) AS total,
                 count(*) OVER (PARTITION BY user_id, event_type) AS n FROM g WINDOW w AS (PARTITION BY user_id, event_type ORDER BY day)),
    x AS (SELECT *, s - k * total / n AS e FROM c),
    p AS (SELECT * FROM x WHERE k < n AND round(abs(e), 9) > 0
          QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY round(abs(e), 9) DESC, k) = 1),
    a AS (SELECT user_id, event_type, count(*) AS n_steps FROM g GROUP BY ALL)
    SELECT a.*, p.day AS shift_after, p.e AS excursion, p.s / p.k AS mean_before, (p.total - p.s) / (p.n - p.k) AS mean_after,
           (p.total - p.s) / (p.n - p.k) - p.s / p.k AS shift
    FROM a LEFT JOIN p ON a.user_id = p.user_id AND a.event_type = p.event_type""",
    ["excursion", "mean_before", "mean_after", "shift"],
    "W07",
)
def metric_shift(spark, sf):
    """Change point of each run's daily metric: the day after which its mean shifts most."""
    e = TB.table(spark, sf, "events").withColumn("day", day_index())
    d = stored(e.groupBy("user_id", "event_type", "day").agg(F.avg("value").alias("v")), "daily")
    return cusum_shift(d, ["user_id", "event_type"], "day", "v")
