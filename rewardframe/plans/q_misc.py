"""Logits on embeddings (L01-L05), conversations
and preference pairs (S04, J02, R13, R14, Q01, K01)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import logits as LG
from ..functions import rewards as R
from ..functions import sequences as S
from ..functions.chat import DEFAULT_SYSTEM, IM_END, IM_START, render
from ..functions.sequences import pad_left, pad_right
from ..functions.text import split_ws
from ..operators import preferences as P
from ..session import stored
from ..sources import tables as TB
from . import sqltext as Q
from .bindings import conv_pairs, doc_rollouts, shaped_scores
from .q_docs import SHAPED_SQL
from .registry import query

T = 0.7
W0 = LG.weight_vector(64, 0)
W1 = LG.weight_vector(64, 1)
EMB_CTE = "e AS (SELECT vec_id, label, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS z FROM embeddings)"


def _lse_sql(z: str) -> str:
    return f"(list_max({z}) + ln(list_sum(list_transform({z}, lambda v: exp(v - list_max({z}))))))"


def emb(spark, sf):
    return TB.table(spark, sf, "embeddings").select("vec_id", "label", LG.as_double("embedding").alias("z"))


@query(
    "selective_logprob",
    f"WITH {EMB_CTE} SELECT vec_id, z[label + 1] - {_lse_sql('z')} AS logprob FROM e",
    ["logprob"],
    "L01",
)
def selective_logprob(spark, sf):
    """Log-softmax of the logit vector gathered at the token id (label)."""
    return emb(spark, sf).select("vec_id", LG.selective_log_softmax(F.col("z"), F.col("label")).alias("logprob"))


@query(
    "logprob_temp",
    f"""WITH {EMB_CTE}, s AS (SELECT vec_id, label, list_transform(z, lambda v: v / {T + 1e-7!r}) AS z FROM e)
        SELECT vec_id, z[label + 1] - {_lse_sql('z')} AS logprob FROM s""",
    ["logprob"],
    "L02",
)
def logprob_temp(spark, sf):
    """Logprob after temperature scaling ``logits / (T + 1e-7)``, T = 0.7."""
    e = emb(spark, sf).withColumn("z", LG.temperature("z", T))
    return e.select("vec_id", LG.selective_log_softmax(F.col("z"), F.col("label")).alias("logprob"))


ENT_SQL = (
    "(list_max(z) + ln(list_sum(list_transform(z, lambda v: exp(v - list_max(z))))))"
    " - list_sum(list_transform(z, lambda v: exp(v - list_max(z)) * v)) / list_sum(list_transform(z, lambda v: exp(v - list_max(z))))"
)


@query(
    "token_entropy",
    f"WITH {EMB_CTE} SELECT CAST(label AS BIGINT) AS label, count(*) AS n, avg({ENT_SQL}) AS mean_entropy, max({ENT_SQL}) AS max_entropy FROM e GROUP BY label",
    ["mean_entropy", "max_entropy"],
    "L03",
)
def token_entropy(spark, sf):
    """Entropy of each logit vector, mean and max per label."""
    e = emb(spark, sf).withColumn("h", LG.entropy(F.col("z")))
    return e.groupBy(F.col("label").cast("long").alias("label")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("h").alias("mean_entropy"), F.max("h").alias("max_entropy")
    )


def _dot_sql(w: list[float]) -> str:
    lit = "[" + ", ".join(repr(x) for x in w) + "]"
    return f"list_sum(list_transform(list_zip(z, {lit}), lambda p: p[1] * p[2]))"


@query("linear_score", f"WITH {EMB_CTE} SELECT vec_id, {_dot_sql(W0)} AS score FROM e", ["score"], "L04")
def linear_score(spark, sf):
    """Linear score head ``h . w`` without bias (weights are a literal parameter vector)."""
    w = F.array(*[F.lit(x) for x in W0])
    return emb(spark, sf).select("vec_id", LG.dot(F.col("z"), w).alias("score"))


@query(
    "score_component",
    f"WITH {EMB_CTE}, s AS (SELECT vec_id, [{_dot_sql(W0)}, {_dot_sql(W1)}] AS scores FROM e) "
    "SELECT vec_id, scores[1] AS score, scores[1] - scores[2] AS margin FROM s",
    ["score", "margin"],
    "L05",
)
def score_component(spark, sf):
    """Two-label head: component 0 is the score; the chosen-minus-rejected
    margin is the commented alternative."""
    w0, w1 = F.array(*[F.lit(x) for x in W0]), F.array(*[F.lit(x) for x in W1])
    s = emb(spark, sf).select("vec_id", F.array(LG.dot(F.col("z"), w0), LG.dot(F.col("z"), w1)).alias("scores"))
    return s.select(
        "vec_id", F.element_at("scores", 1).alias("score"), (F.element_at("scores", 1) - F.element_at("scores", 2)).alias("margin")
    )


# ----------------------------------------------------------------- conversations
def _render_sql() -> str:
    hdr_default = f"'{IM_START}system\n{DEFAULT_SYSTEM}{IM_END}\n'"
    one = (
        f"CASE WHEN m.role = 'system' AND i = 1 THEN '' "
        f"WHEN m.role = 'tool' THEN (CASE WHEN i = 1 OR msgs[i - 1].role <> 'tool' THEN '{IM_START}user' ELSE '' END) "
        f"|| '\n<tool_response>\n' || m.text || '\n</tool_response>' "
        f"|| (CASE WHEN i = len(msgs) OR msgs[i + 1].role <> 'tool' THEN '{IM_END}\n' ELSE '' END) "
        f"WHEN m.role IN ('user', 'assistant', 'system') THEN '{IM_START}' || m.role || '\n' || m.text || '{IM_END}\n' ELSE '' END"
    )
    return f"""WITH c AS (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn) AS msgs FROM conversations GROUP BY conv_id),
      r AS (SELECT conv_id, len(msgs) AS n_turns,
                   (CASE WHEN msgs[1].role = 'system' THEN '{IM_START}system\n' || msgs[1].text || '{IM_END}\n' ELSE {hdr_default} END)
                   || array_to_string(list_transform(msgs, lambda m, i: {one}), '') AS rendered FROM c)
    SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, CAST(length(rendered) AS BIGINT) AS rendered_chars, md5(rendered) AS rendered_md5 FROM r"""


@query("chat_render", _render_sql(), [], "P07 P08 F04")
def chat_render(spark, sf):
    """Render each conversation with the chat template (per-conversation
    ``collect_list`` + ``array_sort`` by turn, native string functions)."""
    c = TB.table(spark, sf, "conversations")
    g = c.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("msgs"))
    r = g.select("conv_id", F.size("msgs").alias("n_turns"), render(F.col("msgs")).alias("rendered"))
    return r.select("conv_id", "n_turns", F.length("rendered").alias("rendered_chars"), F.md5("rendered").alias("rendered_md5"))


PAIRS_CTE = """cp AS (SELECT conv_id, turn, role, text, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS nr,
                         lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS nt FROM conversations),
pr AS (SELECT conv_id, turn, text AS query, nt AS response FROM cp WHERE role = 'user' AND nr = 'assistant')"""


@query(
    "query_response",
    f"""WITH {PAIRS_CTE}, t AS (SELECT conv_id, turn, {Q.split_ws('query')} AS q, {Q.split_ws('response')} AS r FROM pr),
         qr AS (SELECT conv_id, turn, q, r, list_concat(q, r) AS x FROM t)
    SELECT conv_id, turn, CAST(len(q) AS BIGINT) AS context_length, CAST(len(x) AS BIGINT) AS n_total,
           x[len(q) + 1:] = r AS roundtrip_ok, md5(array_to_string(x, ' ')) AS qr_md5 FROM qr""",
    [],
    "A04 A12",
)
def query_response(spark, sf):
    """Query + response concatenation and the response slice from the context end."""
    p = conv_pairs(spark, sf).select("conv_id", "turn", split_ws("query").alias("q"), split_ws("response").alias("r"))
    p = p.withColumn("x", F.concat("q", "r"))
    ctx = F.size("q")
    back = F.slice("x", ctx + 1, F.greatest(F.size("x") - ctx, F.lit(0)))
    return p.select(
        "conv_id", "turn", ctx.alias("context_length"), F.size("x").alias("n_total"),
        (back == F.col("r")).alias("roundtrip_ok"), F.md5(F.array_join("x", " ")).alias("qr_md5"),
    )


@query(
    "response_logits",
    f"""WITH {PAIRS_CTE}, t AS (SELECT conv_id, turn, {Q.split_ws('query')} AS q, {Q.split_ws('response')} AS r FROM pr),
         s AS (SELECT conv_id, turn, r, list_concat(q, r)[len(q):len(q) + len(r) - 1] AS steps FROM t WHERE len(q) > 0 AND len(r) > 0)
    SELECT conv_id, turn, unnest(range(len(r))) AS t, unnest(steps) AS read_token, unnest(r) AS predicted_token FROM s""",
    [],
    "A12",
)
def response_logits(spark, sf):
    """Each response token with the step whose logits predict it: the logits slice is shifted by one
    against the response slice (a step is named by the token it has read)."""
    p = conv_pairs(spark, sf).select("conv_id", "turn", split_ws("query").alias("q"), split_ws("response").alias("r"))
    steps = S.response_logits(F.concat("q", "r"), F.size("q"))
    z = F.arrays_zip(steps.alias("read_token"), F.when(F.size("q") > 0, F.col("r")).otherwise(F.slice("r", 1, 0)).alias("predicted_token"))
    out = p.select("conv_id", "turn", F.posexplode_outer(z).alias("t", "z")).where(F.col("t").isNotNull())
    return out.select("conv_id", "turn", F.col("t").cast("long").alias("t"), F.col("z.read_token").alias("read_token"), F.col("z.predicted_token").alias("predicted_token"))


PAD = "<|endoftext|>"


@query(
    "pad_batch",
    f"""WITH {PAIRS_CTE}, t AS (SELECT conv_id, turn, conv_id % 8 AS batch_id, {Q.split_ws('query')} AS q, {Q.split_ws('response')} AS r FROM pr),
         m AS (SELECT batch_id, max(len(q)) AS qw, max(len(r)) AS rw FROM t GROUP BY batch_id),
         p AS (SELECT t.conv_id, t.turn, t.batch_id, m.qw, m.rw,
                      list_concat(list_transform(range(m.qw - len(q)), lambda i: '{PAD}'), q) AS qp,
                      list_concat(r, list_transform(range(m.rw - len(r)), lambda i: '{PAD}')) AS rp
               FROM t JOIN m ON t.batch_id = m.batch_id)
    SELECT conv_id, turn, batch_id, CAST(qw AS BIGINT) AS q_width, CAST(rw AS BIGINT) AS r_width,
           md5(array_to_string(list_concat(qp, rp), ' ')) AS padded_md5 FROM p""",
    [],
    "A08",
)
def pad_batch(spark, sf):
    """Left-pad queries and right-pad responses to the batch maximum (export
    form); the widths come from a per-batch aggregate joined back."""
    p = conv_pairs(spark, sf).select(
        "conv_id", "turn", (F.col("conv_id") % 8).alias("batch_id"), split_ws("query").alias("q"), split_ws("response").alias("r")
    )
    m = p.groupBy("batch_id").agg(F.max(F.size("q")).alias("q_width"), F.max(F.size("r")).alias("r_width"))
    j = p.join(m, "batch_id")
    padded = F.concat(pad_left("q", F.col("q_width"), PAD), pad_right("r", F.col("r_width"), PAD))
    return j.select("conv_id", "turn", "batch_id", "q_width", "r_width", F.md5(F.array_join(padded, " ")).alias("padded_md5"))


def completions_df(spark, sf):
    p = conv_pairs(spark, sf)
    return p.select(
        "conv_id", "turn", "query", F.col("response").alias("model_response"), R.verifiable_reward("response", None).alias("score")
    )


COMPLETIONS_SQL = f"""WITH {PAIRS_CTE}
    SELECT conv_id, turn, query, response AS model_response, {Q.verifiable_reward('response', None)} AS score FROM pr"""


@query("completions", COMPLETIONS_SQL, ["score"], "S09")
def completions(spark, sf):
    """Completions table (query, model_response, score) of every pair."""
    return completions_df(spark, sf)


@query("completions_preview", f"SELECT * FROM ({COMPLETIONS_SQL}) ORDER BY conv_id, turn LIMIT 5", ["score"], "S09 T01")
def completions_preview(spark, sf):
    """First 5 rows of the completions table (the reference prints 5)."""
    return completions_df(spark, sf).orderBy("conv_id", "turn").limit(5)


# ----------------------------------------------------------------- preferences
PREF_CTE = """dl AS (SELECT d.doc_id, d.lang, l.quality, CASE WHEN d.n_chars > 0 THEN ln(d.n_chars) END AS score
              FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
rk AS (SELECT *, row_number() OVER (PARTITION BY lang, quality ORDER BY doc_id) - 1 AS pair_rank FROM dl),
pp AS (SELECT coalesce(c.lang, x.lang) AS lang, coalesce(c.pair_rank, x.pair_rank) AS pair_rank, c.doc_id AS chosen_id,
              x.doc_id AS rejected_id, c.score AS score_chosen, x.score AS score_rejected
       FROM (SELECT * FROM rk WHERE quality = 1) c FULL JOIN (SELECT * FROM rk WHERE quality = 0) x
         ON c.lang = x.lang AND c.pair_rank = x.pair_rank)"""


def pairs_df(spark, sf):
    d = TB.table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    l = TB.table(spark, sf, "labels").select("doc_id", "quality")
    dl = d.join(l, "doc_id").withColumn("score", F.when(F.col("n_chars") > 0, F.log(F.col("n_chars").cast("double"))))
    dl = stored(dl.select("doc_id", "lang", "quality", "score"), "labelled-scores")
    return P.rank_pairs(dl.where("quality = 1"), dl.where("quality = 0"), "lang", "doc_id", "score")


@query("pref_pairs", f"WITH {PREF_CTE} SELECT * FROM pp", ["score_chosen", "score_rejected"], "S04 J02")
def pref_pairs(spark, sf):
    """Chosen (quality 1) and rejected (quality 0) documents of the same
    language zipped by rank on doc_id (linear, never all pairs); the longer
    side's surplus has no partner."""
    return pairs_df(spark, sf)


@query(
    "preference_loss",
    f"""WITH {PREF_CTE}, d AS (SELECT lang, score_chosen - score_rejected AS d FROM pp)
        SELECT lang, count(d) AS n_pairs, count(*) - count(d) AS n_unpaired,
               avg(CASE WHEN d IS NOT NULL THEN greatest(-d, 0) + ln(1 + exp(-abs(d))) END) AS loss,
               avg(CASE WHEN d > 0 THEN 1.0 WHEN d <= 0 THEN 0.0 END) AS accuracy, avg(d) AS margin FROM d GROUP BY lang""",
    ["loss", "accuracy", "margin"],
    "R13",
)
def preference_loss(spark, sf):
    """Pairwise loss ``-log sigmoid(r_c - r_r)``, accuracy and margin per language."""
    return P.preference_metrics(pairs_df(spark, sf), ["lang"])


MULTI_W = {"r_length": 0.2, "r_quality": 1.0, "r_toxic": -2.0, "r_verifiable": 0.5}


@query(
    "multi_reward",
    f"""WITH r AS (SELECT d.doc_id, ln(1 + CAST(d.n_chars AS DOUBLE)) AS r_length, CAST(l.quality AS DOUBLE) AS r_quality,
                         CAST(l.toxic AS DOUBLE) AS r_toxic, {Q.verifiable_reward('d.text', None)} AS r_verifiable
                  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
         s AS (SELECT avg(r_length) AS m1, stddev_samp(r_length) AS s1, avg(r_quality) AS m2, stddev_samp(r_quality) AS s2,
                      avg(r_toxic) AS m3, stddev_samp(r_toxic) AS s3, avg(r_verifiable) AS m4, stddev_samp(r_verifiable) AS s4 FROM r)
    SELECT doc_id,
           {MULTI_W['r_length']} * r_length + {MULTI_W['r_quality']} * coalesce(r_quality, 0.0) + {MULTI_W['r_toxic']} * coalesce(r_toxic, 0.0)
             + {MULTI_W['r_verifiable']} * r_verifiable AS reward,
           {MULTI_W['r_length']} * coalesce((r_length - m1) / nullif(s1, 0), 0.0) + {MULTI_W['r_quality']} * coalesce((r_quality - m2) / nullif(s2, 0), 0.0)
             + {MULTI_W['r_toxic']} * coalesce((r_toxic - m3) / nullif(s3, 0), 0.0)
             + {MULTI_W['r_verifiable']} * coalesce((r_verifiable - m4) / nullif(s4, 0), 0.0) AS reward_z
    FROM r, s""",
    ["reward", "reward_z"],
    "R14",
)
def multi_reward(spark, sf):
    """Weighted sum of several rewards, raw and z-normalised per reward
    (normalisation statistics are one aggregate row, used as scalars); a reward
    that a document lacks adds 0."""
    d = TB.table(spark, sf, "documents").select("doc_id", "n_chars", "text")
    l = TB.table(spark, sf, "labels")
    r = d.join(l, "doc_id", "left").select(
        "doc_id",
        F.log1p(F.col("n_chars").cast("double")).alias("r_length"),
        F.col("quality").cast("double").alias("r_quality"),
        F.col("toxic").cast("double").alias("r_toxic"),
        R.verifiable_reward("text", None).alias("r_verifiable"),
    )
    # one aggregate row, used as a single struct-valued scalar subquery
    stats = r.agg(F.struct(*[x for c in MULTI_W for x in (F.avg(c).alias(f"m_{c}"), F.stddev_samp(c).alias(f"s_{c}"))]))
    st = stats.scalar()
    z = {}
    for c in MULTI_W:
        m, s = st[f"m_{c}"], st[f"s_{c}"]
        z[f"z_{c}"] = F.coalesce(F.try_divide(F.col(c) - m, F.when(s != 0, s)), F.lit(0.0))
    r = r.withColumns(z)
    return r.select(
        "doc_id",
        P.weighted_reward(MULTI_W).alias("reward"),
        P.weighted_reward({f"z_{c}": w for c, w in MULTI_W.items()}).alias("reward_z"),
    )


@query(
    "reward_rollup",
    f"""{SHAPED_SQL}
    SELECT sh.lang, CAST(l.quality AS BIGINT) AS quality, CAST(GROUPING(sh.lang, l.quality) AS BIGINT) AS grouping_id, count(*) AS n,
           avg(score_shaped) AS mean_shaped, avg(score_raw) AS mean_raw
    FROM (SELECT *, score_raw - eos_penalty - length_penalty - repetition_penalty AS score_shaped FROM sh) sh
    LEFT JOIN labels l ON l.doc_id = sh.rollout_id GROUP BY ROLLUP (sh.lang, l.quality)""",
    ["mean_shaped", "mean_raw"],
    "Q01 M03",
)
def reward_rollup(spark, sf):
    """Per (language, quality), per language and total report of shaped and raw scores (ROLLUP); documents
    without a label are a group of NULL quality."""
    sh = shaped_scores(doc_rollouts(spark, sf))
    l = TB.table(spark, sf, "labels").select(F.col("doc_id").alias("rollout_id"), F.col("quality").cast("long").alias("quality"))
    j = sh.join(l, "rollout_id", "left")
    return j.rollup("lang", "quality").agg(
        F.grouping_id().cast("long").alias("grouping_id"),
        F.count(F.lit(1)).alias("n"),
        F.avg("score_shaped").alias("mean_shaped"),
        F.avg("score_raw").alias("mean_raw"),
    )


@query(
    "run_rollup",
    f"""{SHAPED_SQL}, r AS (SELECT *, CASE WHEN rollout_id % 2 = 0 THEN 'baseline' ELSE 'shaped' END AS run_id,
                                  score_raw - eos_penalty - length_penalty - repetition_penalty AS score_shaped FROM sh)
    SELECT run_id, lang, CAST(GROUPING(run_id, lang) AS BIGINT) AS grouping_id, count(*) AS n, avg(score_raw) AS mean_raw,
           avg(CASE WHEN run_id = 'shaped' THEN score_shaped ELSE score_raw END) AS mean_logged, avg(score_shaped) AS mean_shaped
    FROM r GROUP BY ROLLUP (run_id, lang)""",
    ["mean_raw", "mean_logged", "mean_shaped"],
    "Q01",
)
def run_rollup(spark, sf):
    """Per (run, language), per run and total report: raw score, shaped score, and the score the
    run logs (the shaped run overwrites it)."""
    sh = shaped_scores(doc_rollouts(spark, sf)).select("rollout_id", "lang", "score_raw", "score_shaped")
    run = F.when(F.col("rollout_id") % 2 == 0, F.lit("baseline")).otherwise(F.lit("shaped"))
    r = sh.withColumn("run_id", run)
    r = r.withColumn("logged", F.when(F.col("run_id") == "shaped", F.col("score_shaped")).otherwise(F.col("score_raw")))
    return r.rollup("run_id", "lang").agg(
        F.grouping_id().cast("long").alias("grouping_id"),
        F.count(F.lit(1)).alias("n"),
        F.avg("score_raw").alias("mean_raw"),
        F.avg("logged").alias("mean_logged"),
        F.avg("score_shaped").alias("mean_shaped"),
    )


@query("fit_preference", None, [], "K01")
def fit_preference(spark, sf):
    """Bradley-Terry reward head fitted with pyspark.ml on embedding pairs
    (neighbouring ids, higher label chosen); returns for every pair the fitted
    probability that the chosen side wins, NULL for ties and ids without a neighbour."""
    e = TB.table(spark, sf, "embeddings").withColumn("pair_id", F.expr("vec_id div 2"))
    key = F.struct(F.col("label"), (-F.col("vec_id")).alias("neg"))
    row = F.struct("vec_id", "label", "embedding")
    p = e.groupBy("pair_id").agg(F.count(F.lit(1)).alias("n"), F.max_by(row, key).alias("c"), F.min_by(row, key).alias("r"))
    ranked = (F.col("n") == 2) & (F.col("c.label") > F.col("r.label"))
    side = lambda c: F.when(ranked, F.col(c))
    p = stored(p.select("pair_id", side("c.embedding").alias("ce"), side("r.embedding").alias("re")), "preference-pairs")
    model = P.fit_bradley_terry(p.where("ce is not null and re is not null"), "ce", "re")
    w = F.array(*[F.lit(float(x)) for x in model.coefficients.toArray()])
    diff = F.zip_with("ce", "re", lambda a, b: a.cast("double") - b.cast("double"))
    return p.select("pair_id", (1.0 / (1.0 + F.exp(-LG.dot(diff, w)))).alias("p_chosen"))
