"""The bucket sort of op9 against byte-wise brute force: long periods, ties, other lengths."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from rewardframe.llm import op9_suffix_dedup as o9


def _brute(bodies, back, group, length):
    keys = [(g, i - b, body[i:i + length]) for body, b, g in zip(bodies, back, group) for i in range(len(body) - length + 1)]
    n = Counter(keys)
    return [n[k] > 1 for k in keys]


@pytest.mark.parametrize("length", [8, 20, 45, 100, 306, 400])
@pytest.mark.parametrize("period", [1, 2, 31, 62, 97])
def test_repeated_suffixes_with_long_periods(length, period):
    r = np.random.default_rng(length * 100 + period)
    unit = r.integers(0, 3, period).astype(np.uint8).tobytes()
    long = unit * (3 * length // period + 2)
    bodies = [long[:length + 60], long[:length + 35], long[5:length + 50], bytes(r.integers(0, 2, length + 10).astype(np.uint8)), long[:length]]
    flip = bytearray(long[:length + 40])
    flip[length // 2] ^= 1  # differs in one byte deep inside
    bodies += [bytes(flip), long[:length + 40], b"\0" * (length + 3), b"\0" * (length + 2) + b"\1"]
    back = np.array([3, 3, 8, 0, 3, 3, 3, 1, 1])
    group = np.array([0, 0, 0, 0, 0, 1, 1, 1, 1])
    row, at, dup = o9.repeated_suffixes(pa.array(bodies, pa.binary()), back, group, length)
    assert dup.tolist() == _brute(bodies, back, group, length)
    assert [len(b) - length + 1 for b in bodies] == np.bincount(row).tolist()


def test_cover_ranks_order_by_bytes():
    r = np.random.default_rng(0)
    data = r.integers(0, 2, 3000).astype(np.uint8)
    data[1000:2000] = data[:1000]
    for blocks in (1, 2, 3, 7, 12):
        first = np.sort(r.choice(3000 - 31 * 13, 300, replace=False))
        first = first[first < 3000 - 31 * blocks]
        got = o9.cover_ranks(o9._numbers(data), first, blocks)
        want = [data[f:f + 31 * blocks].tobytes() for f in first]
        assert [(a < b, a == b) for a, b in zip(got, got[1:])] == [(a < b, a == b) for a, b in zip(want, want[1:])]
        assert len(set(got.tolist())) == len(set(want))
