"""Merkle manifest of a dataset by checkpoint and recompute.

Leaves are SHA-256 digests of a row's encoded fields.  Per group (source) the leaves in id
order are the bottom of a tree of arity 3, whose top is the group's subroot; the subroots in
group order are the bottom of one more such tree, whose top is the root.

1. *Numbering.*  Rows are range-partitioned by (group, id, leaf) and numbered inside each
   range; counts of the ranges shift the numbers.  A group of any size spreads over ranges.
2. *Build.*  ``STEP`` levels at a time: an aligned subtree of 3**STEP nodes (81) is one small
   group, hashed upwards in its task, and only its top node is written.  Of the interior
   nodes only every ``STEP``-th level is ever stored.
3. *Proofs.*  From the top down, a subtree's stored bottom nodes come together with the one
   path from its top to the root; the missing levels are hashed again, each bottom node's
   siblings are emitted in front of that path, and the interior is discarded.  Paths are
   stored for the stored levels only (one for 81 leaves); those of leaves stream out.

A path is text: for each level two digits (siblings to the left, to the right) and their
hexadecimal digests.  ``fold`` recomputes the root from a leaf and its path.

Defined cases: a null field is ``-``; a null text is a null field, an empty one ``0:``; null
ids come first; rows of one id follow each other by leaf, so repeated rows get neighbouring
places; the null group comes first; a group of one row is its own subroot, a table of one
row its own root with an empty path; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from binascii import hexlify, unhexlify
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from . import common as C

ARITY = 3
STEP = 4
SPAN = ARITY**STEP
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _h(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


def encoded(fields: list[F.Column]) -> F.Column:
    """The rows' fields as one string that no other fields give."""
    parts = []
    for f in fields:
        s = f.cast("string")
        parts.append(F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s)))
    return F.concat(*parts)


def leaf_digest(fields: list[F.Column]) -> F.Column:
    return F.unhex(F.sha2(encoded(fields), 256))


def _steps(n: int) -> int:
    """Levels a subtree climbs in a tree that has ``n`` nodes on the stored level."""
    k = 0
    while n > 1 and k < STEP:
        n, k = -(-n // ARITY), k + 1
    return k


def _tower(nodes: list[bytes], levels: int) -> list[list[bytes]]:
    """The nodes and the ``levels`` levels above them."""
    out = [nodes]
    for _ in range(levels):
        row = out[-1]
        out.append([_h(b"".join(row[i: i + ARITY])) for i in range(0, len(row), ARITY)])
    return out


def _siblings(tower: list[list[bytes]], at: int) -> bytes:
    """Path of bottom node ``at`` to the top of its tower."""
    out = []
    for row in tower[:-1]:
        lo = at - at % ARITY
        left, right = row[lo:at], row[at + 1: lo + ARITY]
        out += [b"%d%d" % (len(left), len(right)), *left, *right]
        at //= ARITY
    return b"".join(out)


def fold(leaf: bytes, path: bytes) -> tuple[bytes, bytes]:
    """(root recomputed from a leaf's digest, digest of the path's siblings), hexadecimal."""
    at, seen = 0, []
    while at < len(path):
        a, b = path[at] - 48, path[at + 1] - 48
        mid, end = at + 2 + 64 * a, at + 2 + 64 * (a + b)
        left, right = path[at + 2: mid], path[mid:end]
        leaf = _h(left + leaf + right)
        seen.append(path[at + 2: end])
        at = end
    return leaf, _h(b"".join(seen))


def _number_fn(batches):
    """``pos``: place of a row among its key's rows of this partition."""
    last, seen = None, 0
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        at = C.starts_of(t, ["key"])
        pos = np.arange(b.num_rows) - np.repeat(at[:-1], np.diff(at))
        key = b.column("key")
        if key[0].as_py() == last:
            pos[: at[1]] += seen
        last, seen = key[b.num_rows - 1].as_py(), int(pos[-1]) + 1
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pos, pa.int64())], names=[*b.schema.names, "pos"])


def numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` with idx (place of the row in its key, in ``order``) and n (rows of the key).
    ``nodes`` is read twice (ranges are sampled): pass a stored table."""
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = nodes.columns
    ranges = nodes.repartitionByRange(parts, "key", *order).sortWithinPartitions("key", *order).withColumn("part", F.spark_partition_id())
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranges.schema.fields) + ", pos long"
    ranges = C.stored(ranges.mapInArrow(_number_fn, schema), "op11-ranges")
    count = ranges.groupBy("key", "part").agg(F.count(F.lit(1)).alias("c"))
    own = W.partitionBy("key")
    before = F.coalesce(F.sum("c").over(own.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    shift = C.stored(count.select("key", "part", before.alias("before"), F.sum("c").over(own).alias("n")), "op11-shift")
    return ranges.join(shift, ["key", "part"]).select(*names, (F.col("before") + F.col("pos")).alias("idx"), "n")


def _by_block(df: DataFrame) -> DataFrame:
    """Aligned subtrees dealt to tasks, each in order."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, "key", "block").sortWithinPartitions("key", "block", "idx")


def _climb_fn(batches):
    """A subtree's bottom nodes become its top node."""
    for t in C.groups_of(batches, ["key", "block"], 16 * SPAN):
        at = C.starts_of(t, ["key", "block"])
        key, block, n, h = (t.column(c).to_pylist() for c in ("key", "block", "n", "h"))
        top = [unhexlify(_tower([hexlify(x) for x in h[a:b]], _steps(n[a]))[-1][0]) for a, b in zip(at, at[1:])]
        first = at[:-1]
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[a] for a in first], pa.string()), pa.array([block[a] for a in first], pa.int64()),
             pa.array([-(-n[a] // SPAN) for a in first], pa.int64()), pa.array(top, pa.binary())], names=["key", "idx", "n", "h"])


@dataclass
class Tree:
    """Stored levels of the trees of all keys; ``levels[k]`` has the nodes of level k * STEP
    of the keys that have more than one there (``levels[0]``: of all)."""

    levels: list[DataFrame]
    roots: DataFrame  # key, h


def build_tree(bottom: DataFrame) -> Tree:
    """Trees over a stored table of (key, idx, n, h, ...), ``n`` rows a key."""
    levels, roots = [bottom], []
    most = bottom.agg(F.max("n")).first()[0] or 0
    todo = bottom
    while True:
        up = todo.select("key", "idx", "n", "h").withColumn("block", F.floor(F.col("idx") / SPAN))
        nodes = C.stored(_by_block(up).mapInArrow(_climb_fn, "key string, idx long, n long, h binary"), "op11-level")
        roots.append(nodes.where("n = 1").select("key", "h"))
        most = -(-most // SPAN)
        if most <= 1:
            break
        todo = nodes.where("n > 1")
        levels.append(todo)
    out = roots[0]
    for r in roots[1:]:
        out = out.unionByName(r)
    return Tree(levels, out)


def _path_fn(carry: list[str]):
    """Per subtree: one row with the path of its top (idx -1), then its bottom nodes; a row
    for each bottom node with its own path."""
    def fn(batches):
        for t in C.groups_of(batches, ["key", "block"], 16 * SPAN):
            at = C.starts_of(t, ["key", "block"])
            n, h, up = (t.column(c).to_pylist() for c in ("n", "h", "up"))
            paths = []
            for a, b in zip(at, at[1:]):
                nodes = [hexlify(x) for x in h[a + 1: b]]
                tower = _tower(nodes, _steps(n[a + 1]))
                rest = up[a].encode()
                paths += [_siblings(tower, i) + rest for i in range(len(nodes))]
            bottom = np.ones(t.num_rows, bool)
            bottom[at[:-1]] = False
            top = pa.array(np.repeat(at[:-1], np.diff(at) - 1))
            keep = t.filter(pa.array(bottom))
            cols = [keep.column(c).combine_chunks() for c in ("key", "idx", *carry)]
            cols += [t.column(c).combine_chunks().take(top) for c in ("subroot", "root")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(paths, pa.binary()).cast(pa.string())],
                                             names=["key", "idx", *carry, "subroot", "root", "up"])
    return fn


def paths(tree: Tree, tops: DataFrame, carry: list[str]) -> DataFrame:
    """Path of every bottom node: (key, idx, *carry, subroot, root, up).  ``tops`` is a stored
    table of (key, up, subroot, root): the path above each key's tree."""
    above = None
    schema = "key string, idx long, subroot string, root string, up string"
    for k in reversed(range(len(tree.levels))):
        nodes = tree.levels[k].withColumn("block", F.floor(F.col("idx") / SPAN))
        whole = nodes.where((F.col("n") <= SPAN) & (F.col("idx") == 0)).select("key")
        parent = tops.join(whole, "key").select("key", F.lit(0).cast("long").alias("block"), "up", "subroot", "root")
        if above is not None:
            parent = parent.unionByName(above.select("key", F.col("idx").alias("block"), "up", "subroot", "root"))
        extra = carry if k == 0 else []
        rows = nodes.select("key", "block", "idx", "n", "h", *[c for c in extra if c != "h"]).unionByName(
            parent.withColumn("idx", F.lit(-1).cast("long")), allowMissingColumns=True)
        types = "".join(f", `{c}` {nodes.schema[c].dataType.simpleString()}" for c in extra)
        out = _by_block(rows).mapInArrow(_path_fn(extra), schema.replace("idx long", "idx long" + types))
        if k:
            above = C.stored(out, "op11-paths")
    return out


@dataclass
class Manifest:
    """Trees of the groups (bottom: key, id, h and carried columns) and the tree of subroots."""

    groups: Tree
    top: Tree
    carry: list[str]

    def root(self) -> str | None:
        """The dataset's digest; None of an empty table."""
        row = self.top.roots.select(F.lower(F.hex("h"))).first()
        return row[0] if row else None


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", fields: tuple[str, ...] = FIELDS,
             extra: dict[str, F.Column] | None = None) -> Manifest:
    """Build and store the manifest of ``docs``; ``extra`` columns are carried to the proofs."""
    g = F.col(f"`{group_col}`").cast("string")
    key = F.when(g.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), g))
    leaves = C.stored(docs.select(key.alias("key"), F.col(f"`{id_col}`").cast("long").alias("id"),
                                  leaf_digest([F.col(f"`{c}`") for c in fields]).alias("h"),
                                  *[c.alias(n) for n, c in (extra or {}).items()]), "op11-leaves")
    groups = build_tree(C.stored(numbered(leaves, ["id", "h"]), "op11-numbered"))
    tops = C.stored(groups.roots.select(F.lit("").alias("key"), F.col("key").alias("part_key"), "h"), "op11-subroots")
    top = build_tree(C.stored(numbered(tops, ["part_key"]), "op11-top"))
    return Manifest(groups, top, ["id", "h", *(extra or {})])


def proofs(m: Manifest) -> DataFrame:
    """One row per leaf: id, leaf, the carried columns, subroot, root and path."""
    digest = F.lower(F.hex("h"))
    crown = m.top.roots.select("key", F.lit("").alias("up"), F.lit(None).cast("string").alias("subroot"), digest.alias("root"))
    top = paths(m.top, C.stored(crown, "op11-root"), ["part_key", "h"])
    tops = C.stored(top.select(F.col("part_key").alias("key"), "up", digest.alias("subroot"), "root"), "op11-tops")
    out = paths(m.groups, tops, m.carry)
    return out.select("id", digest.alias("leaf"), *[c for c in m.carry if c not in ("id", "h")], "subroot", "root", F.col("up").alias("path"))


def _verify_fn(batches):
    for b in batches:
        shown = [x.encode() for x in b.column("shown").to_pylist()]
        got = [fold(x, p.encode()) for x, p in zip(shown, b.column("path").to_pylist())]
        names = [n for n in b.schema.names if n not in ("path", "shown")]
        yield pa.RecordBatch.from_arrays(
            [*[b.column(n) for n in names], pa.array([s.decode() for _, s in got], pa.string()), pa.array([r.decode() for r, _ in got], pa.string())],
            names=[*names, "proof_sha256", "folded_root"])


def verify(proved: DataFrame, shown: F.Column) -> DataFrame:
    """Fold the leaf digests ``shown`` (hexadecimal) along the proofs' paths."""
    df = proved.withColumn("shown", shown)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in ("path", "shown"))
    out = df.mapInArrow(_verify_fn, schema + ", proof_sha256 string, folded_root string")
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: manifest of all documents, every row proved, half the texts tampered with."""
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    cut = [F.replace(F.col("text"), F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in FIELDS]
    bad = F.when(tampered & F.contains("text", F.lit("\n")), leaf_digest(cut))
    out = verify(proofs(manifest(C.read(spark, sf_dir, "documents"), extra={"bad": bad})), F.lower(F.hex(F.coalesce("bad", F.unhex("leaf")))))
    return out.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _sql_digest(text: str) -> str:
    def enc(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END"
    return "sha256(" + " || ".join(enc(text if c == "text" else c) for c in FIELDS) + ")"


#: CRC-32 bit by bit (reflected, polynomial 0xEDB88320), as DuckDB has no such function.
_SQL_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, strlen(x) + 1), lambda i: ord(x[i])::BIGINT)), lambda c, v:
    list_reduce(list_prepend(xor(c, v), range(8)), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END)), 4294967295::BIGINT)"""


def _sql_tree(name: str, bottom: str, part: str) -> str:
    return f"""{name}({part}, lv, i, h) AS (SELECT {part}, 0, CAST(i AS BIGINT), h FROM {bottom}
      UNION ALL SELECT {part}, lv + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)) FROM
        (SELECT *, count(*) OVER (PARTITION BY {part}) AS n FROM {name}) WHERE n > 1 GROUP BY {part}, lv, i // 3)"""


SQL = f"""
WITH RECURSIVE d AS (SELECT *, {_sql_digest('text')} AS leaf, CAST(doc_id AS VARCHAR) AS x FROM documents),
s AS (SELECT *, coalesce('1' || source, '0') AS k, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
             CASE WHEN coalesce({_SQL_CRC} % 2 = 0, false) THEN {_sql_digest("replace(text, chr(10), '')")} ELSE leaf END AS shown FROM d),
bottom AS (SELECT k, i, leaf AS h FROM s),
{_sql_tree('tree', 'bottom', 'k')},
sub AS (SELECT k, max_by(h, lv) AS h, max(lv) AS height FROM tree GROUP BY k),
crown AS (SELECT 0 AS one, row_number() OVER (ORDER BY k) - 1 AS i, h FROM sub),
{_sql_tree('top', 'crown', 'one')},
rt AS (SELECT max_by(h, lv) AS h, max(lv) AS height FROM top),
place AS (SELECT k, row_number() OVER (ORDER BY k) - 1 AS i, height FROM sub),
nodes AS (SELECT k, lv, i, h FROM tree UNION ALL SELECT '', lv, i, h FROM top),
walk AS (SELECT s.k AS ky, s.i AS row_no, g.lv AS step, s.k, g.lv, s.i // CAST(pow(3, g.lv) AS BIGINT) AS i FROM s JOIN place p ON s.k = p.k, range(40) AS g(lv) WHERE g.lv < p.height
         UNION ALL SELECT s.k, s.i, 1000 + g.lv, '', g.lv, p.i // CAST(pow(3, g.lv) AS BIGINT) FROM s JOIN place p ON s.k = p.k, rt, range(40) AS g(lv) WHERE g.lv < rt.height),
sib AS (SELECT w.ky, w.row_no, w.step, coalesce(string_agg(n.h, '' ORDER BY n.i) FILTER (WHERE n.i < w.i), '') AS l,
               coalesce(string_agg(n.h, '' ORDER BY n.i) FILTER (WHERE n.i > w.i), '') AS r
        FROM walk w JOIN nodes n ON n.k = w.k AND n.lv = w.lv AND n.i // 3 = w.i // 3 GROUP BY w.ky, w.row_no, w.step),
steps AS (SELECT ky, row_no, step, l, r, row_number() OVER (PARTITION BY ky, row_no ORDER BY step) AS no FROM sib),
proof AS (SELECT ky, row_no, string_agg(l || r, '' ORDER BY no) AS p FROM steps GROUP BY ky, row_no),
folded(ky, row_no, no, h) AS (SELECT k, i, CAST(0 AS BIGINT), shown FROM s
      UNION ALL SELECT f.ky, f.row_no, f.no + 1, sha256(t.l || f.h || t.r) FROM folded f JOIN steps t ON t.ky = f.ky AND t.row_no = f.row_no AND t.no = f.no + 1),
fin AS (SELECT ky, row_no, max_by(h, no) AS h FROM folded GROUP BY ky, row_no)
SELECT s.doc_id, s.leaf, sub.h AS subroot, rt.h AS root, sha256(coalesce(p.p, '')) AS proof_sha256, fin.h AS folded_root, fin.h = rt.h AS verified
FROM s JOIN sub ON s.k = sub.k JOIN rt ON true LEFT JOIN proof p ON p.ky = s.k AND p.row_no = s.i JOIN fin ON fin.ky = s.k AND fin.row_no = s.i"""
