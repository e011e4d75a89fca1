"""Sharding: minimax contiguous partition of ordered atomic groups.

Method.  Documents with equal texts form a group that is never split.  The
groups, ordered by the SHA-256 of their text, are cut into contiguous shards
so that the largest shard is as small as possible: binary search over the
capacity, a greedy sweep tells whether a capacity needs too many shards, and
the groups are cut where the sweep at the smallest feasible capacity cuts.

A group larger than an equal share of the bytes would alone set the capacity
and leave shards empty, so such a group first gets a shard of its own (there
are fewer of them than shards) and the rest is divided among the others.

Scale.  The running sums of group sizes stay distributed (4096 hash chunks,
pre-aggregated, one window per chunk).  The driver holds only *marks*: at
most a few thousand known running sums.  A sweep over the marks alone gives
a feasible capacity; a sweep that may also cut anywhere inside a stretch
whose sums are not known gives a lower bound.  While the two differ, only the
stretches that a cut can fall into are read for finer marks.  Each round is
one aggregate over those stretches and shrinks them by a factor of about a
thousand, so the exact optimum takes a few rounds at any size.

Slots are numbered through 1024 hash buckets per shard, so neither a shard nor
a hot group is ever sorted in one task.

Defined cases: a null text has 0 bytes (size 1) and is a group of its own,
apart from empty texts; repeated rows are separate members of one group;
null ids order first; an empty table gives an empty result; with fewer groups
than shards some shards stay empty; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitwall.llm.common import query, table, write_table

CHUNK_HEX = 3            # 16 ** 3 chunks of the hash order
MARKS = 4096             # running sums fetched in one round, at most
SLOT_BUCKETS = 1024


@dataclass
class Marks:
    """Known running sums ``at`` (ascending, from 0 to the total) and, for each
    stretch between neighbours, whether no other running sum lies inside it."""
    at: list[int]
    whole: list[bool] = field(default_factory=list)

    def refine(self, ends: list[tuple[int, bool]]) -> None:
        """``ends``: further sums, each with whether it is the only one of the
        stretch that it closes (relative to the sum before it in ``ends``)."""
        known = dict(zip(self.at[1:], self.whole))
        for at, alone in ends:
            known[at] = known.get(at, False) or alone
        self.at = [0, *sorted(known)]
        self.whole = [known[x] for x in self.at[1:]]


def _sweep(m: Marks, shards: int, capacity: int, anywhere: bool) -> list[int] | None:
    """Greedy cuts at ``capacity``; None if more than ``shards`` are needed.
    ``anywhere``: a cut may fall inside a stretch that is not known whole."""
    cuts, cur, total = [], 0, m.at[-1]
    for _ in range(shards):
        x = cur + capacity
        if x >= total:
            return [*cuts, total]
        i = bisect_right(m.at, x) - 1
        nxt = x if anywhere and not m.whole[i] else m.at[i]
        if nxt <= cur:
            return None
        cuts.append(nxt)
        cur = nxt
    return None


def _smallest(m: Marks, shards: int, low: int, high: int, anywhere: bool) -> int:
    while low < high:
        mid = (low + high) // 2
        if _sweep(m, shards, mid, anywhere) is None:
            low = mid + 1
        else:
            high = mid
    return low


def minimax_cuts(sums: DataFrame, marks: Marks, shards: int, largest: int) -> list[int]:
    """Running sums at which to cut; ``sums`` has one row per group (``end``)."""
    total, budget, width = marks.at[-1], MARKS, None
    while total:
        low = max(-(-total // shards), largest)
        high = _smallest(marks, shards, low, total, False)
        low = _smallest(marks, shards, low, high, True)
        if low == high:
            return _sweep(marks, shards, high, False)
        # where the k-th cut can fall for any capacity in low..high
        ranges, first, last = [], 0, 0
        for _ in range(shards):
            first_x, last_x = first + low, min(last + high, total - 1)
            if first_x >= total:
                break
            a, b = bisect_right(marks.at, first_x) - 1, bisect_right(marks.at, last_x) - 1
            open_ = [i for i in range(a, b + 1) if not marks.whole[i]]
            if open_:
                start, end = marks.at[open_[0]], marks.at[open_[-1] + 1]
                if ranges and start <= ranges[-1][1]:
                    ranges[-1][1] = max(end, ranges[-1][1])
                else:
                    ranges.append([start, end])
            first, last = marks.at[a], last_x
        # many small groups beside few large ones: equal parts may not thin
        # them out, so parts get finer until they do
        now = sum(b - a for a, b in ranges)
        budget = budget * 4 if width is not None and now * 2 > width else budget
        width = now
        marks.refine(_finer(sums, ranges, budget))
    return []


def _finer(sums: DataFrame, ranges: list[list[int]], budget: int) -> list[tuple[int, bool]]:
    """About ``2 * budget`` further sums at most inside the given ranges (one
    per cut): the first and the last sum of each of ``budget`` equal parts."""
    parts = max(2, budget // len(ranges))
    inside, part = F.lit(False), F.lit(None).cast("long")
    for k, (a, b) in enumerate(ranges):
        here = (F.col("end") > a) & (F.col("end") <= b)
        inside = inside | here
        wide = -(-(b - a) // parts)
        part = F.when(here, F.lit(k * parts) + F.floor((F.col("end") - a - 1) / F.lit(wide))).otherwise(part)
    rows = (sums.where(inside).groupBy(part.alias("part"))
            .agg(F.min("end").alias("lo"), F.max("end").alias("hi"), F.count(F.lit(1)).alias("n")).collect())
    # nothing lies between a part's first sum and the last one before the part
    return [(r["lo"], True) for r in rows] + [(r["hi"], r["n"] <= 2) for r in rows]


def _chunk_totals(groups: DataFrame) -> list:
    """Per chunk of the hash order: bytes, groups and largest group, sorted."""
    return sorted(groups.groupBy(F.substring("g", 1, CHUNK_HEX).alias("chunk")).agg(
        F.sum("bytes").alias("bytes"), F.max("bytes").alias("largest"),
        F.count(F.lit(1)).alias("n")).collect())


def _running(groups: DataFrame, chunks: list, alone: dict[str, int]) -> tuple[DataFrame, Marks, int]:
    """(g, end) with the running sum of bytes over the groups not ``alone``,
    the marks at the chunk ends, and a lower bound of the largest group."""
    spark, at, rows, marks, largest = groups.sparkSession, 0, [], Marks([0]), 0
    for c in chunks:
        out = [b for g, b in alone.items() if g[:CHUNK_HEX] == c["chunk"]]
        if len(out) == c["n"]:
            continue
        rows.append((c["chunk"], at))
        at += c["bytes"] - sum(out)
        marks.at.append(at)
        marks.whole.append(c["n"] - len(out) == 1)
        largest = max(largest, 0 if out else c["largest"])
    starts = spark.createDataFrame(rows, "chunk string, start long")
    inside = Window.partitionBy("chunk").orderBy("g").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    rest = groups.where(~F.col("g").isin(list(alone))) if alone else groups
    # ``starts`` has at most 16 ** CHUNK_HEX rows by construction
    sums = rest.withColumn("chunk", F.substring("g", 1, CHUNK_HEX)).withColumn(
        "run", F.sum("bytes").over(inside)).join(F.broadcast(starts), "chunk").select(
        "g", (F.col("start") + F.col("run")).alias("end"))
    return write_table(sums, "shard-sums"), marks, largest


def digest(docs: DataFrame, *keep: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id", *keep, (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        # a null text is a group of its own, last in the order
        F.coalesce(F.sha2(F.col("text"), 256), F.lit("g")).alias("g"))


def shard_of(digests: DataFrame, shards: int) -> Column:
    """Expression over ``g`` that gives each group's shard."""
    groups = write_table(digests.groupBy("g").agg(F.sum("size").alias("bytes")), "shard-groups")
    chunks = _chunk_totals(groups)
    total = sum(c["bytes"] for c in chunks)
    alone, left = {}, total
    if any(c["largest"] * shards > total for c in chunks):
        # groups above an equal share: fewer than ``shards`` of them
        for r in sorted(groups.where(F.col("bytes") * shards > total).collect(),
                        key=lambda r: (-r["bytes"], r["g"])):
            if shards - len(alone) > 1 and r["bytes"] * (shards - len(alone)) > left:
                alone[r["g"]] = r["bytes"]
                left -= r["bytes"]
    sums, marks, largest = _running(groups, chunks, alone)
    cuts = minimax_cuts(sums, marks, shards - len(alone), largest)
    # the last group of every shard but the last one
    ends = sorted(r["g"] for r in sums.where(F.col("end").isin(cuts[:-1])).collect()) if cuts[:-1] else []
    shard = F.lit(len(alone))
    for g in ends:
        shard = shard + (F.col("g") > g).cast("int")
    for k, g in enumerate(alone):
        shard = F.when(F.col("g") == g, F.lit(k)).otherwise(shard)
    return shard.cast("int")


def shard(docs: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (law ``bytes``)."""
    d = write_table(digest(docs), "shard-digests")
    d = d.withColumn("shard", shard_of(d, shards)).withColumn(
        "b", F.pmod(F.xxhash64("doc_id", "g"), F.lit(SLOT_BUCKETS)).cast("int"))
    cells = d.groupBy("shard", "b").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("shard", "b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "b").orderBy("doc_id", "g")
    return (d.withColumn("at", F.row_number().over(inside)).join(cells, ["shard", "b"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("start") + F.col("at") - 1).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))


@query("op2_sharding")
def op2(spark, sf_dir):
    """All ``documents`` in shards 0 to 15 of near-equal bytes."""
    return shard(table(spark, sf_dir, "documents"), 16)
