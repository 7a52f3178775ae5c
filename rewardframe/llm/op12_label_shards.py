"""Sharding by balanced label propagation.

Rows are nodes, a shard is a label, and rows of one group (equal texts, or any given
column) are each other's neighbours.  Rows start dealt out one by one, so shards are even
and groups are cut; then, round after round, linked rows move towards the shard that holds
most of their neighbours, under quotas that keep every shard within its capacity.

1. Linked rows of one group and shard are exchangeable, so the state is a table of cells
   (group, shard, rows): at most one cell for a group and shard, however large the group.
   No edge is ever written out.
2. A round: each group picks its target, the shard with most of its rows among those with
   room; cells no larger than the target's wish to move (their rows gain neighbours), and if
   the whole group finds space there, all do.  The wishes are summed to flows between shards
   (shards x shards numbers).
3. Quotas: flows into a shard may exceed the flows out of it by its free rows only;
   the most wishes for which that holds everywhere are granted (a small flow problem between
   shards), so swaps and longer cycles pass even when all shards are full.
   Where a flow was cut, wishes are granted in hash order up to it by a distributed prefix sum.
4. Rows without neighbours cost nothing anywhere: they are dealt last, into the space left.

With no free row anywhere (every row linked) groups can only swap, and those that find no
partner stay cut; the rows without neighbours are what lets the others gather.

A group larger than a shard is first divided into as few parts as fit.  The law held is
``rows``: row counts of any two shards differ by at most one, exactly, at every round.

Defined cases: null and empty texts are equal (no bytes) and form one group; repeated rows
and null ids are rows like others; fewer rows than shards leave shards empty; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from . import common as C

SHARDS = 16
ROUNDS = 12
#: A group looks for a shard with room for its missing rows, or for this share of a shard.
ROOM = 0.05


def _unit(*cols: F.Column) -> F.Column:
    """A hash in [0, 1)."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 52)).cast("double") / F.lit(float(1 << 52))


def _pick(values: list[int], at: F.Column) -> F.Column:
    """One of a few numbers by position; there are as many as shards."""
    return F.element_at(F.array(*[F.lit(int(v)).cast("long") for v in values]), at.cast("int") + 1)


def first_cells(groups: DataFrame, shards: int, most: int) -> DataFrame:
    """(g, part, shard, n): the rows of each (g, rows, before) dealt one by one, ``before``
    being the rows of earlier groups; parts of at most ``most`` rows."""
    parts = F.ceil(F.col("rows") / F.lit(most)).cast("long")
    p = groups.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    lo = F.floor(F.col("part") * F.col("rows") / parts)
    hi = F.floor((F.col("part") + 1) * F.col("rows") / parts)
    p = p.withColumn("lo", F.col("before") + lo).withColumn("n_part", hi - lo)
    p = p.withColumn("_j", F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.col("n_part"), F.lit(shards)) - 1)))
    n = F.floor((F.col("n_part") - F.col("_j") + shards - 1) / F.lit(shards))
    return p.select("g", "part", ((F.col("lo") + F.col("_j")) % shards).alias("shard"), n.cast("long").alias("n"))


def wishes(cells: DataFrame, room: list[int], cap: int, turn: int) -> DataFrame:
    """Cells with ``target``: the shard they wish to move to (null: stay)."""
    own = W.partitionBy("g", "part")  # at most one row for each shard
    size = F.sum("n").over(own)
    # ties between shards fall apart by hash, another one each round: groups that found their
    # shard overrun choose again
    tie = F.xxhash64("g", "part", "shard", F.lit(turn))
    c = cells.withColumn("size", size).withColumn("tie", tie)
    space = _pick(room, F.col("shard"))
    fits = space >= F.least(F.col("size") - F.col("n"), F.lit(max(1, int(ROOM * cap))))
    best = F.max(F.when(fits, F.struct("n", "tie", "shard", space.alias("space")))).over(own)
    c = c.withColumn("best", best)
    # a larger cell follows only where the whole group finds space
    gain = (F.struct("n", "tie") < F.struct("best.n", "best.tie")) | (F.col("best.space") >= F.col("size") - F.col("best.n"))
    gain = gain & (F.col("shard") != F.col("best.shard"))
    return c.select("g", "part", "shard", "n", F.when(gain, F.col("best.shard")).alias("target"))


def quotas(demand: np.ndarray, free: np.ndarray) -> np.ndarray:
    """The largest part of the flows ``demand[s, t]`` between shards for which what flows into
    a shard exceeds what leaves it by its ``free`` rows at most.  Starting from all wishes, the
    surplus of a shard is passed back along the shortest chain of flows (each link gives up as
    many wishes) to a shard with space: successive shortest paths of a least-cost flow over as many
    nodes as there are shards."""
    x = demand.astype(np.int64).copy()
    n = len(free)
    while True:
        over = x.sum(0) - x.sum(1) - free
        if not (over > 0).any():
            return x
        dist = np.where(over > 0, 0.0, np.inf)
        back = np.full(n, -1)
        # t -> s: give up part of x[s, t], one lost wish a row; s -> t: grant it again
        cost = np.where(x.T > 0, 1.0, np.where(x < demand, -1.0, np.inf))
        cost = np.where((x.T > 0) & (x < demand), -1.0, cost)
        for _ in range(n):
            step = dist[:, None] + cost
            near = step.argmin(0)
            better = step.min(0) < dist
            if not better.any():
                break
            dist = np.where(better, step.min(0), dist)
            back = np.where(better, near, back)
        end = int(np.where(over < 0, dist, np.inf).argmin())
        chain = [end]
        while back[chain[-1]] >= 0:
            chain.append(int(back[chain[-1]]))
        chain.reverse()
        links = list(zip(chain, chain[1:]))
        most = min(int(over[chain[0]]), int(-over[end]), *[int(x[s, t]) if cost[t, s] > 0 else int(demand[t, s] - x[t, s]) for t, s in links])
        for t, s in links:
            if cost[t, s] > 0:
                x[s, t] -= most
            else:
                x[t, s] += most


def propagate(cells: DataFrame, caps: list[int], rounds: int = ROUNDS, rows: int = 20_000) -> tuple[DataFrame, list[int]]:
    """Move rows between the stored ``cells`` until no wish is granted: (cells, rows of the
    linked documents in each shard)."""
    shards = len(caps)
    cap = np.array(caps, np.int64)
    held = np.zeros(shards, np.int64)
    for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect():  # one row for each shard
        held[r["shard"]] = r["n"]
    left = cap  # every shard counts as open before the first round
    for turn in range(rounds):
        asked = C.stored(wishes(cells, (cap - held + left).tolist(), int(cap.max()), turn), "op12-wishes")
        demand = np.zeros((shards, shards), np.int64)
        for r in asked.where("target is not null").groupBy("shard", "target").agg(F.sum("n").alias("n")).collect():  # shards x shards numbers
            demand[r["shard"], r["target"]] = r["n"]
        flow = quotas(demand, cap - held)
        if not flow.any():
            if not left.any():
                break
            left = np.zeros(shards, np.int64)  # nothing leaves any more: only free rows are room
            continue
        quota = _pick(flow.ravel().tolist(), F.col("shard") * shards + F.col("target"))
        moving = asked.where("target is not null").withColumn("quota", quota)
        tight = F.expr("false")
        cut = np.argwhere((flow < demand) & (flow > 0))
        for s, t in cut:  # at most shards x shards pairs
            tight = tight | ((F.col("shard") == int(s)) & (F.col("target") == int(t)))
        all_of = moving.where(~tight).withColumn("got", F.when(F.col("quota") > 0, F.col("n")).otherwise(F.lit(0)))
        if len(cut):
            queue = C.rank_within(C.stored(moving.where(tight), "op12-queue"), ["shard", "target"], _unit("g", "part", F.lit(turn)),
                                  [F.col("g"), F.col("part")], rows, "n", "ahead")
            got = F.greatest(F.lit(0), F.least(F.col("quota") - F.col("ahead"), F.col("n")))
            all_of = all_of.unionByName(queue.withColumn("got", got).drop("ahead"))
        stay = all_of.select("g", "part", "shard", (F.col("n") - F.col("got")).alias("n"))
        moved = all_of.select("g", "part", F.col("target").alias("shard"), F.col("got").alias("n"))
        rest = asked.where("target is null").select("g", "part", "shard", "n")
        cells = rest.unionByName(stay).unionByName(moved).where("n > 0").groupBy("g", "part", "shard").agg(F.sum("n").alias("n"))
        cells = C.stored(cells, "op12-cells")
        held = held + flow.sum(0) - flow.sum(1)
        left = flow.sum(1)
    return cells, held.tolist()


def shard(docs: DataFrame, group: F.Column, carry: dict[str, F.Column], shards: int = SHARDS, rounds: int = ROUNDS, rows: int = 20_000) -> DataFrame:
    """Every row of ``docs`` with its ``shard`` and ``slot`` (0, 1, ... in the shard), and the
    ``carry`` columns; rows of equal ``group`` (no nulls) are linked."""
    base = docs.select(group.alias("g"), *[c.alias(n) for n, c in carry.items()])
    base = C.stored(base.withColumn("u", _unit(F.struct("*"), F.lit(1))), "op12-rows")
    names = list(carry)
    total = base.count()
    caps = [total // shards + (s < total % shards) for s in range(shards)]
    groups = C.stored(base.groupBy("g").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").withColumn("all", F.lit(0)), "op12-groups")
    groups = C.rank_within(groups, ["all"], _unit("g"), [F.col("g")], rows, "rows", "before")
    cells, held = propagate(C.stored(first_cells(groups, shards, max(1, total // shards)), "op12-cells"), caps, rounds, rows)
    # places of a group's rows in its cells, whose number is bounded by the shards and parts
    own = W.partitionBy("g").orderBy("part", F.desc("n"), "shard")
    cells = cells.withColumn("lo", F.sum("n").over(own.rowsBetween(W.unboundedPreceding, 0)) - F.col("n"))
    spans = C.stored(cells.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("lo", "shard"))).alias("spans")), "op12-spans")
    rows_ = base.join(spans, "g", "left")
    whole = rows_.where("size(spans) = 1").withColumn("shard", F.col("spans")[0]["shard"])
    parted = C.stored(rows_.where("size(spans) > 1"), "op12-parted")
    parted = C.rank_within(parted, ["g"], F.col("u"), [F.col(n) for n in names], rows, out="r")
    last = F.element_at(F.filter("spans", lambda s: s["lo"] <= F.col("r")), -1)
    parted = parted.withColumn("shard", last["shard"])
    single = C.stored(rows_.where("spans is null").withColumn("all", F.lit(0)), "op12-single")
    single = C.rank_within(single, ["all"], F.col("u"), [F.col("g"), *[F.col(n) for n in names]], rows, out="r")
    ends = np.cumsum(np.array(caps) - np.array(held)).tolist()
    at = F.size(F.filter(F.array(*[F.lit(int(e)).cast("long") for e in ends]), lambda e: e <= F.col("r")))
    single = single.withColumn("shard", at)
    out = [x.select(*names, "u", F.col("shard").cast("int").alias("shard")) for x in (whole, parted, single)]
    placed = C.stored(out[0].unionByName(out[1]).unionByName(out[2]), "op12-placed")
    # the order inside a shard is another hash: the first one dealt out the single rows
    return C.rank_within(placed, ["shard"], _unit(F.col("u"), F.lit(2)), [F.col(n) for n in names], rows, out="slot").select(*names, "shard", "slot")


def text_group(text: F.Column) -> F.Column:
    """128 bits that name a text."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def op12_label_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: all documents in 16 shards, equal texts together."""
    text = F.coalesce(F.col("text"), F.lit(""))
    out = shard(C.read(spark, sf_dir, "documents"), text_group(F.col("text")), {
        "doc_id": F.col("doc_id"), "size": (F.octet_length(text) + 1).cast("long"), "text_crc32": F.crc32(text).cast("long")})
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
