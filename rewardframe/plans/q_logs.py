"""Run logs as files: written from the event table into the shared folder and read back
(S06-S08, M05, JSON functions)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.ranking import bucketed_running_sum, span_bucket
from ..session import stored
from ..sources import logs as LG
from ..sources import tables as TB
from ..streaming.runner import stream_paths
from .q_events import DAY, day_index
from .registry import query


def log_folder(spark, name: str) -> str:
    return stream_paths(spark, name)[0]


@query(
    "log_history",
    f"""SELECT user_id AS run, {DAY} AS checkpoint, max(event_id) OVER (PARTITION BY user_id, {DAY}) AS global_step,
               row_number() OVER (PARTITION BY user_id, {DAY} ORDER BY event_id) - 1 AS record_no,
               event_id AS step, event_type AS metric, value FROM events""",
    ["value"],
    "S06",
)
def log_history(spark, sf):
    """Trainer states, a JSON document for each run and checkpoint (day) whose ``log_history`` lists
    records of unlike keys: read as VARIANT, the list and each record's keys exploded."""
    e = TB.table(spark, sf, "events").withColumn("day", day_index())
    docs = e.groupBy("user_id", "day").agg(F.max("event_id").alias("global_step"), F.sort_array(F.collect_list(F.struct("event_id", "event_type", "value"))).alias("h"))
    record = lambda x: F.struct(x["event_id"].alias("step"), F.map_from_arrays(F.array(x["event_type"]), F.array(x["value"])).alias("metrics"))
    docs = docs.select(F.to_json(F.struct(F.col("user_id").alias("run"), F.col("day").alias("checkpoint"), "global_step",
                                          F.transform("h", record).alias("log_history"))).alias("value"))
    path = log_folder(spark, "log_history")
    LG.write_documents(docs, path)
    get = lambda c, p, t: F.variant_get(c, p, t)
    d = LG.read_documents(spark, path).select(
        *[get("doc", f"$.{k}", "long").alias(k) for k in ("run", "checkpoint", "global_step")], get("doc", "$.log_history", "variant").alias("list"))
    r = LG.explode_items(d, F.col("list"), "rec", "record_no").withColumn("step", get("rec", "$.step", "long"))
    r = LG.explode_keys(r.select("run", "checkpoint", "global_step", "record_no", "step", get("rec", "$.metrics", "variant").alias("m")), F.col("m"), "metric", "value")
    return r.drop("m")


@query(
    "console_records",
    """SELECT event_type AS run, event_id AS step, value AS loss,
              CAST(sum(1 + event_id % 7) OVER (PARTITION BY event_type ORDER BY event_id) AS DOUBLE) AS num_tokens,
              CAST(1 + event_id % 7 AS DOUBLE) AS interval_tokens FROM events""",
    ["loss", "num_tokens", "interval_tokens"],
    "S07 M05",
)
def console_records(spark, sf):
    """Console logs, a folder for each run: lines of single-quoted dictionaries between progress
    bars; the token counter is cumulative, its steps are taken back out of it."""
    e = TB.table(spark, sf, "events").select(F.col("event_type").alias("run"), "event_id", "value", (1 + F.col("event_id") % 7).alias("tokens"))
    e = stored(e, "console-events")
    e = bucketed_running_sum(e, ["run"], ["event_id"], "tokens", span_bucket(e, "event_id", 1024), "num_tokens")
    quoted = F.translate(F.to_json(F.struct(F.col("value").alias("loss"), "num_tokens", F.col("event_id").alias("step"))), '"', "'")
    noise = F.concat(F.lit(" 50%|#####     | "), F.col("event_id").cast("string"), F.lit("it"))
    lines = e.select("run", F.explode(F.array(noise, quoted)).alias("value"))
    path = log_folder(spark, "console_records")
    lines.write.mode("overwrite").partitionBy("run").text(path)
    back = LG.read_console_log(spark, path).withColumn("run", F.url_decode(F.regexp_extract("run", "/run=([^/]*)/", 1)))
    return LG.sft_records(stored(back, "console-records")).select("run", "step", "loss", "num_tokens", "interval_tokens")


@query(
    "run_summary",
    """SELECT user_id AS run, event_type AS metric, arg_max(value, event_id) AS last_value FROM events GROUP BY ALL""",
    ["last_value"],
    "S08",
)
def run_summary(spark, sf):
    """Run summaries: the last value of each metric, nested under ``summary``; every run has its own
    keys, so the objects are exploded as VARIANT."""
    e = TB.table(spark, sf, "events")
    last = e.groupBy("user_id", "event_type").agg(F.max_by("value", "event_id").alias("v"))
    m = F.map_from_entries(F.collect_list(F.struct("event_type", "v")))
    docs = last.groupBy("user_id").agg(m.alias("summary"))
    path = log_folder(spark, "run_summary")
    LG.write_documents(docs.select(F.to_json(F.struct(F.col("user_id").alias("_run"), "summary")).alias("value")), path)
    d = LG.read_documents(spark, path).select(F.variant_get("doc", "$._run", "long").alias("run"), F.variant_get("doc", "$.summary", "variant").alias("s"))
    return LG.explode_keys(d, F.col("s"), "metric", "last_value").select("run", "metric", "last_value")


_SPECIAL = ", ".join(f"('{t}', {i})" for t, i in LG.SPECIAL_TOKENS)


@query(
    "special_labels",
    f"""SELECT l_orderkey AS rollout_id, l_linenumber AS t, 151640 + l_partkey % 30 AS token_id, token AS special_token
        FROM lineitem LEFT JOIN (VALUES {_SPECIAL}) AS s(token, id) ON 151640 + l_partkey % 30 = id""",
    [],
    "J04",
)
def special_labels(spark, sf):
    """Token ids with the name of the special token they stand for, NULL for ordinary tokens."""
    t = TB.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("rollout_id"), F.col("l_linenumber").alias("t"), (151640 + F.col("l_partkey") % 30).alias("token_id"))
    return LG.label_special(t, "token_id").select("rollout_id", "t", "token_id", "special_token")
