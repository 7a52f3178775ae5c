"""Packing token sequences: shortest-pack-first over the length histogram (Krell et al. 2021).

1. A document's ids (byte-level BPE of ``tokenizers``) and a closing id 1 are cut every
   ``room`` ids; full pieces fill sequences alone.
2. Spark counts the piece lengths: at most ``room`` rows reach the driver, whatever the
   input.  There lengths are placed longest first, each into the pack with the most room
   left, a whole count of equal packs at a time; packs of one filling order are a pattern.
3. Every piece is ranked within its length (distributed prefix counts, so a length that
   most rows share is no bottleneck), and its rank names pattern, sequence and offset.

Defined cases: null and empty texts have the closing id only; repeated rows are
documents of their own; null ids stay null; long texts are encoded whole; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import os
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

ROOM = 2048
END_ID = 1


class Encoder:
    """Ids of texts, as little-endian bytes, for a byte-level BPE file of ``tokenizers``.
    Its vocabulary's ids are its merge ranks, so ``tiktoken`` can run the merges on it
    (twice as fast); texts that hold an added token go to ``tokenizers`` itself."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        vocab = self.tok.get_vocab(with_added_tokens=False)
        for t in self.added:
            vocab.pop(t, None)
        # byte-level alphabet: printable Latin-1 stands for itself, the other bytes follow from 256
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        code = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))}
        ranks = {bytes(code[c] for c in w): i for w, i in vocab.items()}
        self.bpe = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        if any(t in text for t in self.added):
            return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.bpe.encode_to_numpy(text).astype("<u4", copy=False).tobytes()


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _pieces_fn(path: str, room: int, end_id: int):
    def fn(batches):
        enc, close = encoder(path), struct.pack("<I", end_id)
        for b in batches:
            ids = b.column("id")
            _, off = C.text_buffer(b.column("text"))
            for i, j in C.doc_chunks(off):
                rows: tuple[list, ...] = ([], [], [], [], [])
                for r, text in zip(range(i, j), b.column("text").slice(i, j - i).to_pylist()):
                    raw = enc.encode(text or "") + close
                    n = len(raw) // 4
                    for s in range(0, n, room):
                        m = min(room, n - s)
                        for c, v in zip(rows, (r, s, m, zlib.crc32(raw[4 * s: 4 * (s + m)]), n)):
                            c.append(v)
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows[0])), *(pa.array(c, pa.int64()) for c in rows[1:])],
                                                 names=["id", "start", "length", "ids_crc32", "doc_tokens"])
    return fn


def pack_histogram(counts: dict[int, int], room: int) -> list[tuple[int, list[int]]]:
    """Patterns (number of sequences, lengths) by shortest-pack-first."""
    heap: list[tuple[int, int]] = []  # (filled, pattern)
    packs: list[list] = []  # [count, lengths]
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if heap and heap[0][0] + length <= room:
                filled, k = heapq.heappop(heap)
                n, lengths = packs[k]
                if n > left:  # only some of these packs take one more
                    packs[k][0] = n - left
                    heapq.heappush(heap, (filled, k))
                    packs.append([left, lengths + [length]])
                    k, n = len(packs) - 1, left
                else:
                    packs[k][1] = lengths + [length]
                left -= n
                if filled + length < room:
                    heapq.heappush(heap, (filled + length, k))
            else:
                packs.append([left, [length]])
                if length < room:
                    heapq.heappush(heap, (length, len(packs) - 1))
                left = 0
    return [(n, lengths) for n, lengths in packs]


def slots(patterns: list[tuple[int, list[int]]]) -> dict[str, np.ndarray]:
    """For each length, which ranks go to which sequences at which offset."""
    rows, used, seq = [], {}, 0
    for n, lengths in patterns:
        at = 0
        for length in lengths:
            rank = used.get(length, 0)
            rows.append((length, rank, seq, at))
            used[length] = rank + n
            at += length
        seq += n
    a = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return {"key": (a[:, 0] << 44) + a[:, 1], "rank": a[:, 1], "seq": a[:, 2], "at": a[:, 3]}


def _place_fn(table: dict[str, np.ndarray]):
    def fn(batches):
        for b in batches:
            length, rank = np.asarray(b.column("length")), np.asarray(b.column("rank"))
            k = np.searchsorted(table["key"], (length << 44) + rank, "right") - 1
            names = [n for n in b.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays([b.column(n) for n in names] + [pa.array(table["seq"][k] + rank - table["rank"][k]), pa.array(table["at"][k])],
                                             names=[*names, "sequence_id", "offset"])
    return fn


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, room: int = ROOM, end_id: int = END_ID,
         rows: int = 20_000) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = "id long, start long, length long, ids_crc32 long, doc_tokens long"
    pieces = C.stored(src.mapInArrow(_pieces_fn(tokenizer or default_tokenizer(), room, end_id), schema), "op7-pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most ``room`` rows
    u = F.shiftrightunsigned(F.xxhash64("id", "start", "ids_crc32"), 12).cast("double") / F.lit(float(1 << 52))
    ranked = C.rank_within(pieces, ["length"], u, [F.col("id"), F.col("start"), F.col("ids_crc32")], rows)
    return ranked.select("id", "start", "length", "ids_crc32", "doc_tokens", "rank").mapInArrow(
        _place_fn(slots(pack_histogram(counts, room))), schema + ", sequence_id long, offset long")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: all documents packed into sequences of 2048 ids."""
    return pack(C.read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
