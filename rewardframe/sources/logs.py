"""Run-log artifacts as tables.

* trainer state: one JSON document with ``log_history``, an array of
  records whose keys differ per record -> superset schema, missing = NULL;
* console log: single-quoted Python dict lines mixed with progress output
  -> ``from_json(allowSingleQuotes)``, noise parses to NULL and is dropped;
* run summary / metadata: JSON objects, nested structs flattened.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

D = T.DoubleType()
# superset of the per-step and closing records
LOG_RECORD = T.StructType(
    [T.StructField(n, D) for n in (
        "loss", "grad_norm", "learning_rate", "entropy", "num_tokens", "mean_token_accuracy", "epoch",
        "train_runtime", "train_samples_per_second", "train_steps_per_second", "train_loss", "total_flos",
    )]
    + [T.StructField("step", T.LongType())]
)

# Added special tokens of the tokenizer (token -> id).
SPECIAL_TOKENS = [
    ("</tool_call>", 151658), ("<tool_call>", 151657), ("<|box_end|>", 151649), ("<|box_start|>", 151648),
    ("<|endoftext|>", 151643), ("<|file_sep|>", 151664), ("<|fim_middle|>", 151660), ("<|fim_pad|>", 151662),
    ("<|fim_prefix|>", 151659), ("<|fim_suffix|>", 151661), ("<|im_end|>", 151645), ("<|im_start|>", 151644),
    ("<|image_pad|>", 151655), ("<|object_ref_end|>", 151647), ("<|object_ref_start|>", 151646),
    ("<|quad_end|>", 151651), ("<|quad_start|>", 151650), ("<|repo_name|>", 151663), ("<|video_pad|>", 151656),
    ("<|vision_end|>", 151653), ("<|vision_pad|>", 151654), ("<|vision_start|>", 151652),
]
EOS_ID = 151645  # <|im_end|>
PAD_ID = 151643  # <|endoftext|>


def read_trainer_state(spark: SparkSession, path: str) -> DataFrame:
    """``log_history`` exploded to one row per record."""
    schema = T.StructType(
        [
            T.StructField("global_step", T.LongType()),
            T.StructField("epoch", D),
            T.StructField("log_history", T.ArrayType(LOG_RECORD)),
        ]
    )
    doc = spark.read.schema(schema).option("multiLine", True).json(path)
    return doc.select(F.col("_metadata.file_path").alias("run"), F.posexplode("log_history").alias("record_no", "r")).select(
        "run", "record_no", "r.*"
    )


def read_console_log(spark: SparkSession, path: str) -> DataFrame:
    """Metric dict lines of a console log; progress bars and warnings
    parse to NULL and are filtered out."""
    lines = spark.read.text(path)
    parsed = lines.select(
        F.col("_metadata.file_path").alias("run"),
        F.from_json(F.trim("value"), LOG_RECORD, {"allowSingleQuotes": "true", "mode": "PERMISSIVE"}).alias("r"),
        F.trim("value").alias("raw"),
    )
    return parsed.where(F.col("raw").startswith("{") & F.col("r").isNotNull()).select("run", "r.*")


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """Last value per key of a run summary, nested keys flattened with '.'."""
    df = spark.read.option("multiLine", True).json(path)
    return flatten(df)


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Flatten nested structs into top-level columns ``a.b.c``."""
    cols: list[Column] = []

    def walk(prefix: list[str], dtype: T.DataType) -> None:
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                walk(prefix + [f.name], f.dataType)
        else:
            path = ".".join(f"`{p}`" for p in prefix)
            cols.append(F.col(path).alias(sep.join(prefix)))

    walk([], df.schema)
    return df.select(*cols)


def sft_records(history: DataFrame) -> DataFrame:
    """Per-step SFT fields; ``num_tokens`` is cumulative, so the tokens of each logging
    interval are its difference from the previous record.  A run of any length is cut into
    ranges of its steps, so it is not one task.  ``history`` is read several times: pass a
    stored table."""
    from ..operators.ranking import bucketed_lag, span_bucket

    steps = history.where(F.col("step").isNotNull() & F.col("loss").isNotNull())
    steps = bucketed_lag(steps, ["run"], ["step"], "num_tokens", span_bucket(steps, "step", 1024), "_before")
    return steps.select(
        "run", "step", "loss", "entropy", "mean_token_accuracy", "num_tokens", "learning_rate",
        (F.col("num_tokens") - F.coalesce("_before", F.lit(0.0))).alias("interval_tokens"),
    )


# --- records of unlike keys: VARIANT columns ---------------------------------------------

def write_documents(docs: DataFrame, path: str) -> None:
    """JSON documents, one a line, from a single string column."""
    docs.write.mode("overwrite").text(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One VARIANT ``doc`` for each line that is JSON; other lines (progress bars, warnings) go."""
    lines = spark.read.text(path)
    return lines.select(F.try_parse_json("value").alias("doc")).where(F.col("doc").isNotNull())


def explode_items(df: DataFrame, variant: Column, out: str, pos: str = "pos") -> DataFrame:
    """A row for each element of an array in a VARIANT: its place and the element."""
    spark = df.sparkSession
    v = df.withColumn("_v", variant)
    each = spark.tvf.variant_explode(F.col("_v").outer()).select(F.col("pos").alias(pos), F.col("value").alias(out))
    return v.lateralJoin(each).drop("_v")


def explode_keys(df: DataFrame, variant: Column, key: str = "key", value: str = "value") -> DataFrame:
    """A row for each key of an object in a VARIANT, whatever keys it has; values as doubles
    (NULL where they are no numbers)."""
    spark = df.sparkSession
    v = df.withColumn("_v", variant)
    each = spark.tvf.variant_explode(F.col("_v").outer()).select(
        F.col("key").alias(key), F.try_variant_get("value", "$", "double").alias(value))
    return v.lateralJoin(each).drop("_v")


def interval_steps(value: float, max_steps: int) -> int:
    """A logging/eval/save interval below 1 is a ratio of ``max_steps``."""
    return math.ceil(max_steps * value) if value < 1 else int(value)


def linear_lr(step: Column, lr0: float, max_steps: int) -> Column:
    """Linear decay logged after step ``s``: ``lr0 * (1 - (s - 1) / max_steps)``."""
    return F.lit(lr0) * (1 - (step - 1) / F.lit(float(max_steps)))


def special_tokens(spark: SparkSession) -> DataFrame:
    """J04 dimension: 22 rows, a proven size bound, so it is broadcast."""
    return spark.createDataFrame(SPECIAL_TOKENS, "token string, id long")


def label_special(df: DataFrame, id_col: str, spark: SparkSession | None = None) -> DataFrame:
    """Attach the special-token name to token ids (broadcast left join)."""
    spark = spark or df.sparkSession
    dim = F.broadcast(special_tokens(spark).withColumnRenamed("id", id_col).withColumnRenamed("token", "special_token"))
    return df.join(dim, id_col, "left")
