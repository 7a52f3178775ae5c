"""DuckDB text for the oracle statements (same semantics as the Column builders)."""

from __future__ import annotations

from ..functions.text import NON_WS, WS_RUN


def split_ws(e: str) -> str:
    return f"list_filter(string_split_regex(coalesce({e}, ''), '{WS_RUN}'), lambda w: w <> '')"


def word_set(e: str) -> str:
    return f"list_distinct({split_ws(f'lower({e})')})"


def has_content(e: str) -> str:
    return f"coalesce(regexp_matches({e}, '{NON_WS}'), false)"


def truthy(e: str) -> str:
    return f"({e} IS NOT NULL AND {e} <> '')"


def n_chars(e: str) -> str:
    return f"CAST(coalesce(length({e}), 0) AS DOUBLE)"


def first_index(x: str, v: str, none: str | None = None) -> str:
    return f"coalesce(list_position({x}, {v}) - 1, {none if none is not None else f'len({x})'})"


def truncate_at_stop(x: str, stop: str) -> str:
    return f"{x}[1:{first_index(x, stop)} + 1]"


def ngram_keys(x: str, n: int) -> str:
    return f"list_transform(range(1, len({x}) - {n} + 2), lambda i: array_to_string({x}[i:i + {n - 1}], ' '))"


def rouge_tokens(e: str) -> str:
    return (
        f"list_filter(string_split(regexp_replace(lower(coalesce({e}, '')), '[^a-z0-9]+', ' ', 'g'), ' '), "
        "lambda w: w <> '')"
    )


def overlap(c: str, g: str) -> str:
    return f"CAST(len(list_intersect({word_set(c)}, {word_set(g)})) AS DOUBLE) / nullif(len({word_set(g)}), 0)"


def verifiable_reward(c: str, label: str | None) -> str:
    n = n_chars(c)
    base = f"(CASE WHEN {has_content(c)} THEN 0.1 ELSE -0.5 END)"
    long_ = f"-0.1 * ({n} - 200.0) / 100.0"
    nogt = f"{base} + CASE WHEN {n} BETWEEN 50 AND 200 THEN 0.3 WHEN {n} > 200 THEN {long_} ELSE 0.0 END"
    if label is None:
        return nogt
    gt = (
        f"{base} + CASE WHEN {n} BETWEEN 50 AND 200 THEN 0.2 WHEN {n} > 200 THEN {long_} "
        f"ELSE -0.1 * (50.0 - {n}) / 50.0 END + coalesce(0.7 * ({overlap(c, label)}), 0.0)"
    )
    return f"CASE WHEN {truthy(label)} THEN {gt} ELSE {nogt} END"


# Binding 1: completions in groups of 4, optional label
RLVR_CTE = """rc AS (
  SELECT d.doc_id, d.lang, d.text AS completion, d.doc_id // 4 AS group_id, (d.doc_id // 4) % 8 AS batch_id,
         b.text AS label
  FROM documents d LEFT JOIN benchmark b ON b.item_id = d.doc_id // 4)"""

# Binding 2: whole-document token rollouts, truncated at the stop word
DOC_CTE = (
    "dt AS (SELECT doc_id AS rollout_id, doc_id % 8 AS batch_id, lang, n_chars, "
    + split_ws("text")
    + " AS tokens FROM documents),\n"
    "dr AS (SELECT *, "
    + truncate_at_stop("tokens", "'and'")
    + " AS post FROM dt),\n"
    "ro AS (SELECT *, CAST(len(post) - 1 AS INTEGER) AS seq_len, coalesce(list_contains(post, 'and'), false) AS has_eos, "
    "ln(1 + CAST(n_chars AS DOUBLE)) AS score_raw FROM dr)"
)


def repetition_ctes(src: str, n: int = 3, prefix: str = "rp") -> str:
    """Distinct repeated n-grams per rollout over ``post[:seq_len]`` via
    unnest + GROUP BY: CTEs ``{prefix}g``, ``{prefix}c``, ``{prefix}``
    (rollout_id, n_rep, n_grams)."""
    keys = ngram_keys("post[1:greatest(seq_len, 0)]", n)
    return (
        f"{prefix}g AS (SELECT rollout_id, unnest({keys}) AS k FROM {src} WHERE seq_len >= {n}),\n"
        f"{prefix}c AS (SELECT rollout_id, k, count(*) AS c FROM {prefix}g GROUP BY rollout_id, k),\n"
        f"{prefix} AS (SELECT rollout_id, count(*) FILTER (WHERE c > 1) AS n_rep, sum(c) AS n_grams "
        f"FROM {prefix}c GROUP BY rollout_id)"
    )


def repetition_penalty(alias: str, seq_len: str, n: int = 3, coef: float = 0.1) -> str:
    return (
        f"CASE WHEN {seq_len} < {n} THEN 0.0 "
        f"ELSE {coef} * CAST(coalesce({alias}.n_rep, 0) AS DOUBLE) / {alias}.n_grams END"
    )
