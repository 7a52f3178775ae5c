"""Document rollouts (binding 2): prompt preparation, sequence functions,
shaping, n-gram statistics, batching (P01-P04, A01-A13, R01-R04, R16, R17,
G13, Q02, T02, B01-B06, W04, W06, U03, J06, S01-S03)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import rewards as R
from ..functions import sequences as S
from ..functions.text import sentences, split_ws
from ..operators import batching as B
from ..operators import heavy
from ..operators.ranking import bucketed_running_sum, span_bucket
from ..session import stored
from ..sources import tables as TB
from . import sqltext as Q
from .bindings import doc_rollouts, rlvr_completions, shaped_scores
from .registry import query

D = f"WITH {Q.DOC_CTE}"
MAX_PROMPT_TOKENS = 512
PLAN = B.BatchPlan()
EPOCHS = 2
SEED = 42


def prompts(spark, sf):
    """Tokens and lengths of each prompt; source columns dropped."""
    d = S.compute_once(TB.table(spark, sf, "documents").select("doc_id", "text"), input_ids=split_ws("text"))
    return d.select("doc_id", "input_ids", F.size("input_ids").alias("lengths"))


def prompt_lengths(spark, sf):
    """P01 as a narrow stored table (doc_id, lengths): ranks, counts and set operations
    on it do not tokenise the texts again."""
    return stored(prompts(spark, sf).select("doc_id", "lengths"), "prompt-lengths")


def train_ids(spark, sf):
    """Ids that pass the length filter (P02), from the stored table."""
    return prompt_lengths(spark, sf).where(F.col("lengths") <= MAX_PROMPT_TOKENS).select("doc_id")


@query("head_n", "SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 1000", [], "S01 T01")
def head_n(spark, sf):
    """``train[:1000]`` by doc_id."""
    return TB.head_n(TB.table(spark, sf, "documents").select("doc_id", "lang", "n_chars"), "doc_id", 1000)


LENGTHS_SQL = f"SELECT doc_id, CAST(len({Q.split_ws('text')}) AS BIGINT) AS lengths FROM documents"


@query("tokenize_len", LENGTHS_SQL, [], "P01")
def tokenize_len(spark, sf):
    """Whitespace tokens per prompt (tokeniser is a parameter; BPE not built)."""
    return prompts(spark, sf).select("doc_id", "lengths")


@query("len_filter", f"SELECT * FROM ({LENGTHS_SQL}) WHERE lengths <= {MAX_PROMPT_TOKENS}", [], "P02 F02")
def len_filter(spark, sf):
    """Keep prompts with at most 512 tokens."""
    return prompts(spark, sf).where(F.col("lengths") <= MAX_PROMPT_TOKENS).select("doc_id", "lengths")


@query(
    "eval_head",
    f"SELECT * FROM ({LENGTHS_SQL}) WHERE lengths <= {MAX_PROMPT_TOKENS} ORDER BY doc_id LIMIT 10",
    [],
    "S02 T01",
)
def eval_head(spark, sf):
    """First 10 rows of the filtered train set."""
    f = prompts(spark, sf).where(F.col("lengths") <= MAX_PROMPT_TOKENS).select("doc_id", "lengths")
    return TB.eval_head(f, "doc_id", 10)


@query(
    "split_filter",
    """SELECT CASE WHEN substr(md5('split|' || CAST(doc_id AS VARCHAR)), 1, 1) <= '1' THEN 'test' ELSE 'train' END AS split,
              count(*) AS n_docs, CAST(sum(n_chars) AS BIGINT) AS n_chars
       FROM documents GROUP BY 1""",
    [],
    "S03",
)
def split_filter(spark, sf):
    """Train and test splits by hash; test read only when evaluation is on."""
    d = TB.table(spark, sf, "documents").select("doc_id", "n_chars")
    train, test = TB.load_splits(d, "doc_id", eval_on=True)
    both = train.unionByName(test)
    return both.groupBy("split").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_chars").alias("n_chars"))


@query(
    "prompt_label",
    """SELECT d.doc_id, CAST(length(d.text) AS BIGINT) AS prompt_chars, coalesce(b.text, '') AS label
       FROM documents d LEFT JOIN benchmark b ON b.item_id = d.doc_id // 4""",
    [],
    "P03",
)
def prompt_label(spark, sf):
    """Project prompt and label, label defaults to ''."""
    rc = rlvr_completions(spark, sf)
    return rc.select("doc_id", F.length("completion").alias("prompt_chars"), F.coalesce("label", F.lit("")).alias("label"))


@query(
    "dq_eos_tail",
    f"""{D}, z AS (SELECT rollout_id, tokens[-1] = 'and' AS bad FROM ro)
        SELECT count(*) AS n_rows, count(*) FILTER (WHERE bad) AS n_violations,
               bool_and(NOT coalesce(bad, false)) FILTER (WHERE rollout_id = (SELECT min(rollout_id) FROM ro)) AS row0_ok
        FROM z""",
    [],
    "P04",
)
def dq_eos_tail(spark, sf):
    """Last prompt token must not be EOS: violations over all rows plus the
    reference's row-0 check."""
    ro = doc_rollouts(spark, sf).select("rollout_id", (F.element_at("tokens", -1) == F.lit("and")).alias("bad"))
    first = TB.table(spark, sf, "documents").agg(F.min("doc_id")).scalar()
    return ro.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(F.col("bad"), 1)).alias("n_violations"),
        F.bool_and(F.when(F.col("rollout_id") == first, ~F.coalesce(F.col("bad"), F.lit(False)))).alias("row0_ok"),
    )


@query(
    "first_stop",
    f"{D} SELECT rollout_id, CAST({Q.first_index('tokens', chr(39) + 'and' + chr(39))} AS BIGINT) AS first_stop FROM ro",
    [],
    "A01",
)
def first_stop(spark, sf):
    """Index of the first stop word, L (= token count) when absent."""
    return doc_rollouts(spark, sf).select("rollout_id", S.first_index("tokens", "and").alias("first_stop"))


@query(
    "truncate_at_stop",
    f"{D} SELECT rollout_id, CAST(len(post) AS BIGINT) AS n_kept, md5(array_to_string(post, ' ')) AS post_md5 FROM ro",
    [],
    "A02",
)
def truncate_at_stop(spark, sf):
    """Tokens up to and including the first stop word."""
    ro = doc_rollouts(spark, sf)
    return ro.select("rollout_id", F.size("post").alias("n_kept"), F.md5(F.array_join("post", " ")).alias("post_md5"))


@query("seq_len", f"{D} SELECT rollout_id, CAST(seq_len AS BIGINT) AS seq_len FROM ro", [], "A03 A06")
def seq_len(spark, sf):
    """Index of the last kept token (-1 for an empty response)."""
    return doc_rollouts(spark, sf).select("rollout_id", "seq_len")


@query("contains_eos", f"{D} SELECT rollout_id, has_eos FROM ro", [], "A10")
def contains_eos(spark, sf):
    """Whether the truncated response holds the stop word."""
    return doc_rollouts(spark, sf).select("rollout_id", "has_eos")


@query(
    "num_eos",
    f"{D} SELECT batch_id, count(*) AS n_rollouts, CAST(sum(len(list_filter(tokens, lambda v: v = 'and'))) AS BIGINT) AS num_eos FROM ro GROUP BY batch_id",
    [],
    "A13",
)
def num_eos(spark, sf):
    """EOS count over the raw (untruncated) responses per batch."""
    ro = doc_rollouts(spark, sf)
    return ro.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_rollouts"), F.sum(S.count_token("tokens", "and")).cast("long").alias("num_eos")
    )


@query(
    "ngrams",
    f"{D} SELECT rollout_id, CAST(len({Q.ngram_keys('tokens', 3)}) AS BIGINT) AS n_ngrams, "
    f"CAST(len(list_distinct({Q.ngram_keys('tokens', 3)})) AS BIGINT) AS n_distinct FROM ro",
    [],
    "A11",
)
def ngrams(spark, sf):
    """Sliding 3-grams over the whole response: count and distinct count."""
    ro = doc_rollouts(spark, sf).withColumn("g", S.ngram_keys("tokens", 3))
    return ro.select("rollout_id", F.size("g").alias("n_ngrams"), F.size(F.array_distinct("g")).alias("n_distinct"))


@query(
    "position_ids",
    f"""{D},
      lt AS (SELECT rollout_id, unnest(tokens) AS tok, generate_subscripts(tokens, 1) - 1 AS t FROM ro),
      pm AS (SELECT rollout_id, t, tok <> 'and' AS m FROM lt),
      pp AS (SELECT rollout_id, m, coalesce(sum(CAST(m AS BIGINT)) OVER (PARTITION BY rollout_id ORDER BY t
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM pm)
      SELECT ro.rollout_id, count(*) FILTER (WHERE NOT m) AS n_pad, CAST(sum(pos) AS BIGINT) AS sum_pos, CAST(max(pos) AS BIGINT) AS max_pos
      FROM ro LEFT JOIN pp ON pp.rollout_id = ro.rollout_id GROUP BY ro.rollout_id""",
    [],
    "A05 W02",
)
def position_ids(spark, sf):
    """Attention mask ``token != pad`` with pad = eos (the scripts' fallback) and
    position ids as the exclusive running count of the mask, summed up inside the row:
    no token is shuffled; an empty text has no positions (NULL)."""
    zero = F.lit(0).cast("long")
    start = F.struct(zero.alias("n_pad"), zero.alias("pos"), zero.alias("sum_pos"), F.lit(None).cast("long").alias("max_pos"))

    def step(acc, tok):
        pad = F.when(tok == F.lit("and"), F.lit(1)).otherwise(F.lit(0))
        return F.struct(
            (acc["n_pad"] + pad).alias("n_pad"), (acc["pos"] + 1 - pad).alias("pos"),
            (acc["sum_pos"] + acc["pos"]).alias("sum_pos"), acc["pos"].alias("max_pos"),
        )

    a = doc_rollouts(spark, sf).select("rollout_id", F.aggregate("tokens", start, step).alias("a"))
    some = F.col("a.max_pos").isNotNull()
    return a.select("rollout_id", "a.n_pad", F.when(some, F.col("a.sum_pos")).alias("sum_pos"), "a.max_pos")


@query(
    "length_penalty",
    f"{D} SELECT rollout_id, CAST(seq_len AS BIGINT) AS seq_len, 0.01 * seq_len AS length_penalty FROM ro",
    ["length_penalty"],
    "R01",
)
def length_penalty(spark, sf):
    """``0.01 * seq_len``; an empty response earns 0.01."""
    ro = doc_rollouts(spark, sf)
    return ro.select("rollout_id", "seq_len", R.length_penalty("seq_len").alias("length_penalty"))


REP_SQL = f"""{D}, {Q.repetition_ctes('ro')}
    SELECT ro.rollout_id, {Q.repetition_penalty('rp', 'ro.seq_len')} AS repetition_penalty
    FROM ro LEFT JOIN rp ON ro.rollout_id = rp.rollout_id"""


@query("repetition_penalty", REP_SQL, ["repetition_penalty"], "R02 T2")
def repetition_penalty(spark, sf):
    """Distinct repeated 3-grams over all 3-grams of ``post[:seq_len]``, times 0.1
    (in-row sort, no shuffle)."""
    ro = R.with_repetition_penalty(doc_rollouts(spark, sf))
    return ro.select("rollout_id", "repetition_penalty")


@query(
    "missing_eos",
    f"{D} SELECT rollout_id, has_eos, score_raw - CASE WHEN has_eos THEN 0.0 ELSE 1.0 END AS score FROM ro",
    ["score"],
    "R03",
)
def missing_eos(spark, sf):
    """Score minus 1.0 when the truncated response has no EOS."""
    ro = doc_rollouts(spark, sf)
    return ro.select("rollout_id", "has_eos", (F.col("score_raw") - R.missing_eos_penalty("has_eos", 1.0)).alias("score"))


SHAPED_SQL = f"""{D}, {Q.repetition_ctes('ro')},
    sh AS (SELECT ro.rollout_id, ro.batch_id, ro.lang, ro.score_raw, CASE WHEN has_eos THEN 0.0 ELSE 1.0 END AS eos_penalty,
                  0.01 * seq_len AS length_penalty, {Q.repetition_penalty('rp', 'ro.seq_len')} AS repetition_penalty
           FROM ro LEFT JOIN rp ON ro.rollout_id = rp.rollout_id)"""


@query(
    "shaped_score",
    f"{SHAPED_SQL} SELECT rollout_id, score_raw, eos_penalty, length_penalty, repetition_penalty, "
    "score_raw - eos_penalty - length_penalty - repetition_penalty AS score_shaped FROM sh",
    ["score_raw", "eos_penalty", "length_penalty", "repetition_penalty", "score_shaped"],
    "R04 X01",
)
def shaped_score(spark, sf):
    """Raw score, each penalty, and the shaped score (EOS, length, repetition)."""
    sh = shaped_scores(doc_rollouts(spark, sf))
    return sh.select("rollout_id", "score_raw", "eos_penalty", "length_penalty", "repetition_penalty", "score_shaped")


@query(
    "penalty_shares",
    f"""{SHAPED_SQL}
    SELECT lang, count(*) AS n, avg(length_penalty) AS mean_length_penalty, avg(repetition_penalty) AS mean_repetition_penalty,
           avg(eos_penalty) AS mean_eos_penalty, max(repetition_penalty) AS max_repetition_penalty
    FROM sh GROUP BY lang""",
    ["mean_length_penalty", "mean_repetition_penalty", "mean_eos_penalty", "max_repetition_penalty"],
    "T13 M03",
)
def penalty_shares(spark, sf):
    """Scale of each penalty per language (repetition is bounded by coef/2)."""
    sh = shaped_scores(doc_rollouts(spark, sf))
    return sh.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("length_penalty").alias("mean_length_penalty"),
        F.avg("repetition_penalty").alias("mean_repetition_penalty"),
        F.avg("eos_penalty").alias("mean_eos_penalty"),
        F.max("repetition_penalty").alias("max_repetition_penalty"),
    )


def _rep_multi_sql() -> str:
    ctes, cols, joins = [], [], []
    for n in (1, 2, 3, 4):
        ctes.append(Q.repetition_ctes("ro", n, f"r{n}"))
        cols.append(f"{Q.repetition_penalty(f'r{n}', 'ro.seq_len', n)} AS rep_n{n}")
        joins.append(f"LEFT JOIN r{n} ON ro.rollout_id = r{n}.rollout_id")
    return f"{D}, " + ",\n".join(ctes) + f" SELECT ro.rollout_id, {', '.join(cols)} FROM ro " + " ".join(joins)


@query("repetition_multi", _rep_multi_sql(), ["rep_n1", "rep_n2", "rep_n3", "rep_n4"], "R16")
def repetition_multi(spark, sf):
    """R02 at n = 1..4 as columns of one pass (no cross join with an n table)."""
    ro = R.with_repetition_penalties(doc_rollouts(spark, sf), {f"rep_n{n}": n for n in (1, 2, 3, 4)})
    return ro.select("rollout_id", "rep_n1", "rep_n2", "rep_n3", "rep_n4")


SENT_SQL = (
    f"list_filter(list_transform(string_split_regex(coalesce(text, ''), '[.!?\\n]+'), "
    f"lambda s: regexp_replace(s, '^{Q.WS_RUN}|{Q.WS_RUN}$', '', 'g')), lambda s: s <> '')"
)


@query(
    "sentence_repetition",
    f"""WITH s AS (SELECT doc_id, unnest({SENT_SQL}) AS sent FROM documents),
         c AS (SELECT doc_id, sent, count(*) AS c FROM s GROUP BY doc_id, sent),
         a AS (SELECT doc_id, CAST(sum(c) AS BIGINT) AS n_sentences, count(*) FILTER (WHERE c > 1) AS n_repeated FROM c GROUP BY doc_id)
    SELECT d.doc_id, coalesce(a.n_sentences, 0) AS n_sentences, coalesce(a.n_repeated, 0) AS n_repeated,
           CASE WHEN coalesce(a.n_sentences, 0) = 0 THEN 0.0 ELSE 0.1 * a.n_repeated / a.n_sentences END AS penalty
    FROM documents d LEFT JOIN a ON d.doc_id = a.doc_id""",
    ["penalty"],
    "R16",
)
def sentence_repetition(spark, sf):
    """Sentence-level repetition: distinct repeated sentences over sentences, times 0.1."""
    from ..functions.sequences import repeated_in_sorted

    d = S.compute_once(TB.table(spark, sf, "documents").select("doc_id", "text"), ss=F.sort_array(sentences("text")))
    m = F.size("ss")
    return d.select(
        "doc_id",
        m.cast("long").alias("n_sentences"),
        repeated_in_sorted("ss").cast("long").alias("n_repeated"),
        F.when(m == 0, F.lit(0.0)).otherwise(0.1 * repeated_in_sorted("ss") / m).alias("penalty"),
    )


@query(
    "ngram_counts",
    f"""{D}, g AS (SELECT rollout_id, unnest({Q.ngram_keys('tokens', 3)}) AS gram FROM ro)
        SELECT rollout_id, gram, count(*) AS n FROM g GROUP BY rollout_id, gram""",
    [],
    "G13",
)
def ngram_counts(spark, sf):
    """Count per 3-gram inside each rollout: counted in the row, no exchange."""
    return S.with_gram_counts(doc_rollouts(spark, sf).select("rollout_id", "tokens"), "tokens", 3)


def gram_rows(spark, sf):
    """One row (g0, g1, g2) for each 3-gram of each rollout: no string is built."""
    g = doc_rollouts(spark, sf).select(S.explode_rows(S.ngram_rows("tokens", 3)).alias("g"))
    return g.where(F.col("g").isNotNull()).select("g.*")


@query(
    "top_ngrams",
    f"""{D}, g AS (SELECT unnest({Q.ngram_keys('tokens', 3)}) AS gram FROM ro)
        SELECT gram, count(*) AS n FROM g GROUP BY gram ORDER BY n DESC, gram LIMIT 20""",
    [],
    "T02",
)
def top_ngrams(spark, sf):
    """Top 20 corpus 3-grams (a top-k report; total order by count then gram)."""
    return heavy.top_k_exact(gram_rows(spark, sf), "gram", 20, F.concat_ws(" ", "g0", "g1", "g2"))


@query(
    "top_ngrams_sketch",
    f"""{D}, g AS (SELECT unnest({Q.ngram_keys('tokens', 3)}) AS gram FROM ro)
        SELECT gram, count(*) AS n FROM g GROUP BY gram ORDER BY n DESC, gram LIMIT 20""",
    [],
    "T02 Q02",
)
def top_ngrams_sketch(spark, sf):
    """``top_ngrams`` without shuffling every n-gram: sketch, then exact counts of the candidates."""
    return heavy.top_k(gram_rows(spark, sf), "gram", 20, value=F.concat_ws(" ", "g0", "g1", "g2"))


@query(
    "worst_rollouts",
    f"""{SHAPED_SQL} SELECT rollout_id, repetition_penalty, length_penalty, eos_penalty,
        score_raw - eos_penalty - length_penalty - repetition_penalty AS score_shaped FROM sh
        ORDER BY round(repetition_penalty * 1e9) DESC, rollout_id LIMIT 20""",
    ["repetition_penalty", "length_penalty", "eos_penalty", "score_shaped"],
    "T02",
)
def worst_rollouts(spark, sf):
    """The 20 rollouts that repeat themselves most (a top-k report), with their penalties."""
    sh = shaped_scores(doc_rollouts(spark, sf))
    cols = ["rollout_id", "repetition_penalty", "length_penalty", "eos_penalty", "score_shaped"]
    return sh.select(*cols).orderBy(F.desc(F.round(F.col("repetition_penalty") * 1e9)), "rollout_id").limit(20)


@query(
    "distinct_n",
    f"""{D}, g AS (SELECT lang, unnest({Q.ngram_keys('tokens', 2)}) AS gram FROM ro)
        SELECT lang, count(*) AS n_grams, count(DISTINCT gram) AS n_distinct,
               CAST(count(DISTINCT gram) AS DOUBLE) / count(*) AS distinct_2
        FROM g GROUP BY lang""",
    ["distinct_2"],
    "Q02",
)
def distinct_n(spark, sf):
    """Distinct-2 diversity per language (exact)."""
    return distinct_n_of(doc_rollouts(spark, sf), "lang", 2)


def distinct_n_of(rollouts, key: str, n: int, approx_rsd: float | None = None):
    """Q02: distinct-n per ``key``.  Exact distinct shuffles every (key, gram);
    ``approx_rsd`` switches to HyperLogLog++ (``approx_count_distinct``),
    whose partial sketches keep the shuffle at one small buffer per key and
    task -- the option for very large corpora."""
    g = rollouts.select(key, S.explode_rows(S.ngram_keys("tokens", n)).alias("gram")).where(F.col("gram").isNotNull())
    d = F.approx_count_distinct("gram", approx_rsd) if approx_rsd else F.count_distinct("gram")
    return g.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_grams"), d.alias("n_distinct"), (d / F.count(F.lit(1))).alias(f"distinct_{n}")
    )


@query(
    "ending_templates",
    f"""{D}, e AS (SELECT ro.rollout_id, ro.lang, ro.score_raw, lower(array_to_string(tokens[-3:], ' ')) AS ending, l.quality
                  FROM ro LEFT JOIN labels l ON l.doc_id = ro.rollout_id)
        SELECT ending, count(*) AS n, count(DISTINCT lang) AS n_langs, count(DISTINCT rollout_id // 4) AS n_prompts,
               avg(quality) AS mean_quality, avg(score_raw) AS mean_score
        FROM e GROUP BY ending ORDER BY n DESC, ending LIMIT 20""",
    ["mean_quality", "mean_score"],
    "R17",
)
def ending_templates(spark, sf):
    """Most frequent 3-token endings with their spread and mean quality label (top 20)."""
    ro = doc_rollouts(spark, sf)
    lab = TB.table(spark, sf, "labels").select(F.col("doc_id").alias("rollout_id"), "quality")
    e = ro.select("rollout_id", "lang", "score_raw", F.lower(F.array_join(F.slice("tokens", F.greatest(F.size("tokens") - 2, F.lit(1)), F.lit(3)), " ")).alias("ending"))
    e = e.join(lab, "rollout_id", "left")
    return (
        e.groupBy("ending")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_distinct("lang").alias("n_langs"),
            F.count_distinct(F.expr("rollout_id div 4")).alias("n_prompts"),
            F.avg(F.col("quality").cast("double")).alias("mean_quality"),
            F.avg("score_raw").alias("mean_score"),
        )
        .orderBy(F.desc("n"), "ending")
        .limit(20)
    )


@query(
    "running_tokens",
    f"""SELECT doc_id, CAST(len({Q.split_ws('text')}) AS BIGINT) AS n_tokens,
               CAST(sum(len({Q.split_ws('text')})) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS num_tokens
        FROM documents""",
    [],
    "W04 M05",
)
def running_tokens(spark, sf):
    """Cumulative token count in doc_id order (``num_tokens`` of the SFT log),
    built per id bucket plus bucket offsets (no one-task window)."""
    p = prompt_lengths(spark, sf).select("doc_id", F.col("lengths").cast("long").alias("n_tokens"))
    return bucketed_running_sum(p, [], ["doc_id"], "n_tokens", span_bucket(p, "doc_id"), "num_tokens")


@query(
    "best_of_n",
    f"""WITH {Q.RLVR_CTE}, rw AS (SELECT doc_id, group_id, {Q.verifiable_reward('completion', 'label')} AS reward FROM rc),
         rk AS (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY reward DESC, doc_id) AS r FROM rw)
        SELECT group_id, doc_id AS best_doc_id, reward AS best_reward FROM rk WHERE r = 1""",
    ["best_reward"],
    "W06",
)
def best_of_n(spark, sf):
    """Highest-reward completion per group (ties to the smaller doc_id);
    ``max_by`` aggregates partially, no window."""
    rc = rlvr_completions(spark, sf).withColumn("reward", R.verifiable_reward("completion", "label"))
    key = F.struct(F.col("reward"), (-F.col("doc_id")).alias("neg_id"))
    return rc.groupBy("group_id").agg(
        F.max_by("doc_id", key).alias("best_doc_id"), F.max(key)["reward"].alias("best_reward")
    )


@query(
    "split_overlap",
    f"""WITH p AS ({LENGTHS_SQL}), tr AS (SELECT doc_id FROM p WHERE lengths <= {MAX_PROMPT_TOKENS}),
         ev AS (SELECT doc_id FROM tr ORDER BY doc_id LIMIT 10)
        SELECT (SELECT count(*) FROM tr) AS n_train, (SELECT count(*) FROM ev) AS n_eval,
               (SELECT count(*) FROM (SELECT doc_id FROM ev INTERSECT SELECT doc_id FROM tr)) AS n_overlap,
               (SELECT count(*) FROM (SELECT doc_id FROM ev EXCEPT ALL SELECT doc_id FROM tr)) AS n_eval_only""",
    [],
    "U03",
)
def split_overlap(spark, sf):
    """Leakage report: the eval head is a subset of train by construction."""
    tr = train_ids(spark, sf)
    ev = TB.eval_head(tr, "doc_id", 10)
    spark_ = tr.sparkSession
    return spark_.range(1).select(
        tr.agg(F.count(F.lit(1))).scalar().alias("n_train"),
        ev.agg(F.count(F.lit(1))).scalar().alias("n_eval"),
        ev.intersect(tr).agg(F.count(F.lit(1))).scalar().alias("n_overlap"),
        ev.exceptAll(tr).agg(F.count(F.lit(1))).scalar().alias("n_eval_only"),
    )


@query(
    "missing_eos_anti",
    f"""{D}, g AS (SELECT DISTINCT rollout_id // 4 AS group_id FROM ro),
         e AS (SELECT rollout_id // 4 AS group_id FROM ro WHERE has_eos)
        SELECT group_id, 'no_eos' AS kind FROM g WHERE group_id NOT IN (SELECT group_id FROM e)
        UNION ALL SELECT group_id, 'has_eos' FROM g WHERE group_id IN (SELECT group_id FROM e)""",
    [],
    "J06",
)
def missing_eos_anti(spark, sf):
    """Prompt groups without any EOS completion (left anti) and with one (left semi)."""
    groups = TB.table(spark, sf, "documents").select(F.expr("doc_id div 4").alias("group_id")).distinct()
    ro = doc_rollouts(spark, sf).withColumn("group_id", F.expr("rollout_id div 4"))
    eos = ro.where("has_eos").select("group_id")
    anti = groups.join(eos, "group_id", "left_anti").withColumn("kind", F.lit("no_eos"))
    semi = groups.join(eos, "group_id", "left_semi").withColumn("kind", F.lit("has_eos"))
    return anti.unionByName(semi)


RANK_SQL = f"""WITH p AS ({LENGTHS_SQL}), tr AS (SELECT doc_id FROM p WHERE lengths <= {MAX_PROMPT_TOKENS}),
     ep AS (SELECT doc_id, e.epoch FROM tr CROSS JOIN range({EPOCHS}) AS e(epoch)),
     rk AS (SELECT doc_id, epoch, row_number() OVER (PARTITION BY epoch
                 ORDER BY md5('{SEED}|' || CAST(epoch AS VARCHAR) || '|' || CAST(doc_id AS VARCHAR))) - 1 AS rank FROM ep)"""


def ranked(ids):
    return B.epoch_rank(B.repeat_epochs(ids, EPOCHS), "doc_id", SEED)


@query(
    "batch_plan",
    f"""WITH p AS ({LENGTHS_SQL}), c AS (SELECT count(*) AS n FROM p WHERE lengths <= {MAX_PROMPT_TOKENS})
        SELECT n AS n_rows, CAST({PLAN.local_batch_size} AS BIGINT) AS local_batch_size, CAST({PLAN.batch_size} AS BIGINT) AS batch_size,
               CAST({PLAN.mini_batch_size} AS BIGINT) AS mini_batch_size,
               CAST({PLAN.per_device_train_batch_size * PLAN.world_size} AS BIGINT) AS micro_batch_size,
               CAST({PLAN.local_batch_size} // {PLAN.num_mini_batches} AS BIGINT) AS local_mini_batch_size,
               {PLAN.local_batch_size} // {PLAN.num_mini_batches} >= 8 AS can_whiten, CAST(floor({PLAN.num_train_epochs} * n) AS BIGINT) AS total_episodes,
               CAST(ceil(floor({PLAN.num_train_epochs} * n) / {PLAN.batch_size}) AS BIGINT) AS num_total_batches,
               n % {PLAN.batch_size} AS dropped_per_epoch FROM c""",
    [],
    "B01",
)
def batch_plan(spark, sf):
    """Batch sizes and the number of updates for the filtered prompt set."""
    tr = prompts(spark, sf).where(F.col("lengths") <= MAX_PROMPT_TOKENS)
    return tr.agg(*B.batch_plan_columns(F.count(F.lit(1)), PLAN))


@query("epoch_shuffle", f"{RANK_SQL} SELECT doc_id, epoch, rank, rank // {PLAN.batch_size} AS batch_no FROM rk", [], "B02 B05")
def epoch_shuffle(spark, sf):
    """Per-epoch md5 permutation and batch number (global rank in two levels)."""
    r = ranked(train_ids(spark, sf))
    return r.select("doc_id", F.col("epoch").cast("long"), "rank", F.floor(F.col("rank") / PLAN.batch_size).cast("long").alias("batch_no"))


@query(
    "minibatch_assign",
    f"""{RANK_SQL} SELECT doc_id, epoch, rank // {PLAN.batch_size} AS batch_no,
        (rank % {PLAN.batch_size}) // {PLAN.mini_batch_size} AS mini,
        ((rank % {PLAN.batch_size}) % {PLAN.mini_batch_size}) // {PLAN.per_device_train_batch_size} AS micro FROM rk""",
    [],
    "B03 W03",
)
def minibatch_assign(spark, sf):
    """Batch, mini-batch and micro-batch of every prompt in every epoch."""
    r = B.assign_batches(ranked(train_ids(spark, sf)), PLAN.batch_size, PLAN.mini_batch_size, PLAN.per_device_train_batch_size)
    return r.select("doc_id", F.col("epoch").cast("long"), "batch_no", "mini", "micro")


@query(
    "drop_last",
    f"""{RANK_SQL}, c AS (SELECT count(*) AS n FROM tr)
        SELECT doc_id, epoch, rank // {PLAN.batch_size} AS batch_no FROM rk, c
        WHERE rank // {PLAN.batch_size} < n // {PLAN.batch_size}""",
    [],
    "B04",
)
def drop_last(spark, sf):
    """Rows of complete batches only (the ragged last batch is dropped)."""
    tr = train_ids(spark, sf)
    n = tr.agg(F.count(F.lit(1))).scalar()
    b = B.assign_batches(ranked(tr), PLAN.batch_size, PLAN.mini_batch_size, PLAN.per_device_train_batch_size)
    return B.drop_last(b, n, PLAN.batch_size).select("doc_id", F.col("epoch").cast("long"), "batch_no")


@query(
    "repeat_epochs",
    f"{RANK_SQL} SELECT epoch, count(*) AS n_rows, count(DISTINCT doc_id) AS n_docs FROM ep GROUP BY epoch",
    [],
    "B05",
)
def repeat_epochs(spark, sf):
    """The endless loader as epoch copies."""
    tr = prompts(spark, sf).where(F.col("lengths") <= MAX_PROMPT_TOKENS).select("doc_id")
    e = B.repeat_epochs(tr, EPOCHS)
    return e.groupBy(F.col("epoch").cast("long").alias("epoch")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("doc_id").alias("n_docs")
    )


@query(
    "generation_groups",
    "SELECT doc_id, g.generation, doc_id * 4 + g.generation AS rollout_key FROM documents CROSS JOIN range(4) AS g(generation)",
    [],
    "B06",
)
def generation_groups(spark, sf):
    """Four generations per prompt, keyed by group."""
    d = TB.table(spark, sf, "documents").select("doc_id")
    g = B.generation_groups(d, 4)
    return g.select("doc_id", F.col("generation").cast("long"), (F.col("doc_id") * 4 + F.col("generation")).alias("rollout_key"))


@query(
    "rollout_union",
    f"""SELECT 'documents' AS source, doc_id AS rollout_id, CAST(len({Q.split_ws('text')}) AS BIGINT) AS n_tokens, NULL::BIGINT AS turn
          FROM documents
        UNION ALL
        SELECT 'conversations', conv_id, CAST(len({Q.split_ws('text')}) AS BIGINT), turn FROM conversations WHERE role = 'assistant'""",
    [],
    "S05 U01",
)
def rollout_union(spark, sf):
    """Rollout chunks from two sources concatenated by column name."""
    d = TB.table(spark, sf, "documents").select(
        F.lit("documents").alias("source"), F.col("doc_id").alias("rollout_id"), F.size(split_ws("text")).alias("n_tokens")
    )
    c = TB.table(spark, sf, "conversations").where(F.col("role") == "assistant").select(
        F.lit("conversations").alias("source"), F.col("conv_id").alias("rollout_id"), F.size(split_ws("text")).alias("n_tokens"), "turn"
    )
    return TB.union_chunks([d, c])
