"""Sequence (array) functions on ragged token arrays.

Positions are 0-based like the tensors they replace; Spark's
``element_at``/``slice`` are 1-based, ``array_position`` returns 0 when
the value is absent.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def first_index(x: Column | str, value, none_value: Column | int | None = None) -> Column:
    """First 0-based index where ``x == value``; ``none_value`` (default
    ``size(x)``, the padded width L) when absent."""
    x = col_(x)
    p = F.array_position(x, _lit(value))
    return F.when(p == 0, F.size(x) if none_value is None else _lit(none_value)).otherwise(p - 1).cast("int")


def truncate_at_stop(x: Column | str, stop) -> Column:
    """A02 (ragged): keep tokens up to and including the first stop.
    ``stop=None`` disables truncation (0 is a valid id, so test for None)."""
    x = col_(x)
    if stop is None:
        return x
    return F.slice(x, 1, first_index(x, stop) + 1)


def truncate_padded(x: Column | str, stop, pad) -> Column:
    """A02 (padded): positions after the first stop are replaced by ``pad``."""
    x = col_(x)
    if stop is None:
        return x
    idx = first_index(x, stop)
    return F.transform(x, lambda v, i: F.when(i > idx, _lit(pad)).otherwise(v))


def seq_len_padded(post: Column | str, pad) -> Column:
    """Index of the last kept token = first pad - 1 (no pad -> L-1, all pad -> -1)."""
    return first_index(post, pad) - 1


def seq_len_ragged(post: Column | str, pad=None) -> Column:
    """A03 for ragged arrays.  When ``pad`` is given (pad == eos setups) the
    first pad-valued token ends the sequence and is not counted."""
    post = col_(post)
    if pad is None:
        return (F.size(post) - 1).cast("int")
    return first_index(post, pad) - 1


def pad_right(x: Column | str, width: Column | int, pad) -> Column:
    """Right-pad to ``width`` (responses)."""
    x = col_(x)
    n = F.greatest(_lit(width) - F.size(x), F.lit(0))
    return F.concat(x, F.array_repeat(_lit(pad), n))


def pad_left(x: Column | str, width: Column | int, pad) -> Column:
    """Left-pad to ``width`` (queries)."""
    x = col_(x)
    n = F.greatest(_lit(width) - F.size(x), F.lit(0))
    return F.concat(F.array_repeat(_lit(pad), n), x)


def attention_mask(x: Column | str, pad) -> Column:
    """``x != pad`` per position."""
    return F.transform(col_(x), lambda v: v != _lit(pad))


def masked_input_ids(x: Column | str, pad, fill=0) -> Column:
    """Pad ids replaced by ``fill`` (0) before the model sees them."""
    return F.transform(col_(x), lambda v: F.when(v == _lit(pad), _lit(fill)).otherwise(v))


def position_ids(x: Column | str, pad) -> Column:
    """A05 wide form: exclusive running count of non-pad positions.  In-row
    ``aggregate`` is O(L^2) in copies; long form uses a window instead."""
    start = F.struct(F.lit(0).alias("n"), F.array().cast("array<int>").alias("out"))

    def step(acc, v):
        nxt = acc["n"] + F.when(v != _lit(pad), F.lit(1)).otherwise(F.lit(0))
        return F.struct(nxt.alias("n"), F.concat(acc["out"], F.array(acc["n"])).alias("out"))

    return F.aggregate(col_(x), start, step, lambda acc: acc["out"])


def response_logits(steps: Column | str, context_length: Column) -> Column:
    """Of the steps over ``query + response`` those that predict the response, ``[ctx - 1 : -1]``:
    a step's logits are for the token after it.  Without a context the first response token has no
    step before it, and the slice is empty."""
    x = col_(steps)
    n = F.when(context_length > 0, F.size(x) - context_length).otherwise(F.lit(0))
    return F.slice(x, F.greatest(context_length, F.lit(1)), F.greatest(n, F.lit(0)))


def reward_index(response: Column | str, pad, context_length: Column | int) -> Column:
    """A09(a): index in ``query + response`` of the last response token:
    ``first_pad(response) - 1 + context_length``."""
    return first_index(response, pad) - 1 + _lit(context_length)


def contains_token(x: Column | str, token) -> Column:
    """A10: any occurrence of ``token``."""
    return F.coalesce(F.array_contains(col_(x), _lit(token)), F.lit(False))


def count_token(x: Column | str, token) -> Column:
    """Number of occurrences of ``token``."""
    return F.size(F.filter(col_(x), lambda v: v == _lit(token)))


def ngrams(x: Column | str, n: int) -> Column:
    """Sliding n-grams as arrays; empty when ``size(x) < n`` (guards the
    count-down behaviour of ``sequence`` for a negative bound)."""
    x = col_(x)
    m = F.size(x) - n + 1
    return F.when(
        m >= 1, F.transform(F.sequence(F.lit(1), m), lambda i: F.slice(x, i, n))
    ).otherwise(F.array_repeat(F.slice(x, 1, n), 0))


def ngram_keys(x: Column | str, n: int, sep: str = " ") -> Column:
    """Sliding n-grams joined into strings (A11 keyed form).  With
    whitespace-split tokens a space separator is injective; ids are cast to
    string.  Built from n shifted slices zipped together, so no lambda body
    refers back to the input array (that would re-evaluate it per element)."""
    x = col_(x)
    if n == 1:
        return F.transform(x, lambda v: v.cast("string"))
    m = F.greatest(F.size(x) - n + 1, F.lit(0))
    parts = [F.slice(x, j + 1, m).alias(f"g{j}") for j in range(n)]
    return F.transform(
        F.arrays_zip(*parts), lambda s: F.concat_ws(sep, *[s[f"g{j}"].cast("string") for j in range(n)])
    )


def ngram_rows(x: Column | str, n: int, m: Column | None = None) -> Column:
    """The first ``m`` (default: all) sliding n-grams as structs ``g0 .. g(n-1)`` zipped from shifted
    slices: compared and sorted as they are, without a string being built for each.  ``x``
    should be a column that is already computed, as every slice reads it."""
    x = col_(x)
    m = F.greatest(F.size(x) - n + 1 if m is None else m, F.lit(0))
    return F.arrays_zip(*[F.slice(x, j + 1, m).alias(f"g{j}") for j in range(n)])


def repeated_in_sorted(sorted_keys: Column | str) -> Column:
    """Number of distinct values occurring more than once in a sorted array: positions that
    equal their left neighbour but not the one before it (one pass).  ``sorted_keys`` should be
    a column that is already computed (``compute_once``), as the neighbours are read from it."""
    s = col_(sorted_keys)
    second = lambda v, i: (v == F.get(s, i - 1)) & ~v.eqNullSafe(F.get(s, i - 2))
    return F.size(F.filter(s, second))


def repeated_distinct(keys: Column) -> Column:
    """Distinct elements occurring more than once, as one expression (in-row sort): equal
    neighbours of the sorted array, deduplicated."""
    s = F.sort_array(keys)
    k = F.greatest(F.size(s) - 1, F.lit(0))
    pairs = F.arrays_zip(F.slice(s, 1, k).alias("a"), F.slice(s, 2, k).alias("b"))
    return F.size(F.array_distinct(F.transform(F.filter(pairs, lambda p: p["a"] == p["b"]), lambda p: p["a"])))


def with_gram_counts(df, x: str, n: int, sep: str = " ", gram: str = "gram", count: str = "n"):
    """One row for each distinct n-gram of each row's array ``x``, with its count, in place of
    the column ``x``.  A group never leaves its row: the grams are sorted there, runs of equal ones are
    counted, and only the distinct ones become strings.  No exchange."""
    keep = [c for c in df.columns if c != x]
    s = compute_once(df, _s=F.sort_array(ngram_rows(x, n))).drop(x)
    marks = F.transform("_s", lambda v, i: F.when(v.eqNullSafe(F.get("_s", i - 1)), F.lit(None)).otherwise(i))
    s = compute_once(s, _at=F.filter(marks, lambda i: i.isNotNull()))
    each = F.transform("_at", lambda p, i: F.struct(
        F.concat_ws(sep, *[F.get("_s", p)[f"g{j}"].cast("string") for j in range(n)]).alias(gram),
        (F.coalesce(F.get("_at", i + 1), F.size("_s")) - p).cast("long").alias(count)))
    return s.select(*keep, F.inline_outer(each)).where(F.col(count).isNotNull())


def last_valid(values: Column | str, tokens: Column | str, pad) -> Column:
    """A09(b): value at the rightmost non-pad token; NULL when none."""
    pairs = F.arrays_zip(col_(tokens).alias("tok"), col_(values).alias("val"))
    kept = F.filter(pairs, lambda p: p["tok"] != _lit(pad))
    return F.element_at(kept, -1)["val"]


def explode_rows(x: Column | str) -> Column:
    """``explode_outer``: like ``explode`` but Catalyst does not infer a
    ``size(x) > 0`` filter from it, which would evaluate an expensive array
    expression twice.  Empty/NULL arrays give one NULL row: filter it out."""
    return F.explode_outer(col_(x))


def compute_once(df, **exprs: Column):
    """Add expensive columns so that they are evaluated once, above any
    repartition: they come out of a one-row ``inline_outer`` generator, and
    Catalyst cannot push a filter on generator output below the generator
    (a filter on a plain alias is rewritten onto the scan, evaluating the
    expression twice and before the rows are spread over the cores)."""
    packed = F.array(F.struct(*[e.alias(n) for n, e in exprs.items()]))
    return df.select("*", F.inline_outer(packed))
