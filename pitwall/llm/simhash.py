"""SimHash near-dedup by covering locality-sensitive hashing.

Method.  A document's 64-bit fingerprint holds, bit by bit, the majority of
its word shingles' XXH64 hashes.  Fingerprints link at ``radius`` or fewer
differing bits; linked documents form components.

Covering.  Give every bit position a non-zero vector of ``radius + 1`` bits.
For each non-zero vector v, the mask of v has the positions whose vector has
an odd inner product with v.  Any ``radius`` positions leave a v orthogonal to
all of their vectors, so the mask of v skips all of them: every pair within
the radius agrees under at least one of the ``2 ** (radius + 1) - 1`` masks.
No pair is lost, whatever the data.

Scale.  Documents collapse to distinct fingerprints first, so a group of exact
copies is one row.  Under each mask equal values meet in one bucket.  A bucket
of more than ``BUCKET`` fingerprints is split: of the bits outside its mask,
``radius + 1`` blocks are made, one of which must agree too for any linked
pair, so each block joins the mask in turn (repeated while needed; a full mask
holds one fingerprint).  Inside a bucket only a spanning forest of the links
leaves the task, not the pairs.  Components come from alternating star
contraction over the links, written to the shared folder after every round.
The nodes are fingerprints, not ids, which may be null or repeated.

Defined cases: a null or empty text, or one without a word, has fingerprint
zero and links like any other; fewer words than a shingle make one shingle of
all of them; repeated rows share a component; a null id never is a component's
smallest while another id is there, and a component of null ids only has a null
``component_id``; unlike texts under one id, or without one, are documents of
their own; an empty table gives an empty result;
extra columns are ignored by ``near_duplicates`` and kept by ``dedup``.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.llm.common import ensure_python_package, keep_row, query, table, unpack, write_table

SHINGLE = 3
RADIUS = 3
SEED = 42
BUCKET = 1024                     # fingerprints compared pair by pair at most
_PLACE = np.arange(8, dtype=np.uint16) * 256
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.float64)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority bits of the hashes of all word shingles of a UTF-8 text."""
    w = text.lower().split()      # bytes: ASCII letters and white space only
    if not w:
        return 0
    parts = map(b" ".join, zip(*(w[k:] for k in range(shingle)))) if len(w) >= shingle else [b" ".join(w)]
    n = max(1, len(w) - shingle + 1)
    h = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), parts), "<u8", n)
    seen = np.bincount((h.view(np.uint8).reshape(-1, 8) + _PLACE).ravel(), minlength=2048)
    ones = seen.reshape(8, 256).astype(np.float64) @ _BITS
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, payload: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long), and the ``payload`` columns (longs)."""
    names = ["doc_id", "fp", *payload]

    def run(batches):
        for b in batches:
            out = np.fromiter((fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle)
                               for t in b.column("text").cast(pa.binary())), "<u8", b.num_rows)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(out.view("<i8")), *(b.column(c) for c in payload)], names=names)

    ensure_python_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       *payload).mapInArrow(run, ", ".join(f"{c} long" for c in names))


def covering_masks(radius: int = RADIUS, bits: int = 64) -> list[int]:
    """One mask per non-zero vector of ``radius + 1`` bits."""
    top = 1 << (radius + 1)
    vector = [i % (top - 1) + 1 for i in range(bits)]
    return [sum(1 << i for i in range(bits) if (vector[i] & v).bit_count() & 1) for v in range(1, top)]


def finer_masks(mask: int, radius: int = RADIUS, bits: int = 64) -> list[int]:
    """``mask`` with one block of the other bits more; a pair that agrees on
    ``mask`` and differs in ``radius`` bits agrees on one of these."""
    rest = [i for i in range(bits) if not mask >> i & 1]
    return [mask | sum(1 << i for i in rest[k::radius + 1]) for k in range(radius + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _links(radius: int):
    """Spanning forest of the links inside each bucket; rows sorted by key."""
    def forest(key, fp, rep):
        at, other, n = [], [], len(key)
        live = np.arange(n)
        for d in range(1, n):
            live = live[live + d < n]
            live = live[key[live] == key[live + d]]
            if not len(live):
                break
            hit = live[np.bitwise_count(fp[live] ^ fp[live + d]) <= radius]
            at.append(hit)
            other.append(hit + d)
        a, b = (np.concatenate(x) if x else np.empty(0, int) for x in (at, other))
        root = np.arange(n)
        while True:  # smallest index of each connected set
            low = np.minimum(root[a], root[b])
            new = root.copy()
            np.minimum.at(new, a, low)
            np.minimum.at(new, b, low)
            np.minimum.at(new, root[a], low)
            np.minimum.at(new, root[b], low)
            new = new[new]
            if (new == root).all():
                break
            root = new
        own = np.flatnonzero(root != np.arange(n))
        return rep[own], rep[root[own]]

    def run(batches):
        held = None
        for b in batches:
            cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            if held is not None:
                cols = [np.concatenate(p) for p in zip(held, cols)]
            # the last bucket may go on in the next batch
            cut = int(np.searchsorted(cols[0], cols[0][-1])) if len(cols[0]) else 0
            done, held = [c[:cut] for c in cols], [c[cut:] for c in cols]
            if cut:
                yield batch(*forest(done[0], done[1].view("<u8"), done[2]))
        if held is not None and len(held[0]):
            yield batch(*forest(held[0], held[1].view("<u8"), held[2]))

    def batch(a, b):
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def links(fps: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """a, b: links between representatives that connect what is within
    ``radius``.  ``fps``: fp (distinct), rep."""
    spark = fps.sparkSession
    ensure_python_package(spark)
    masks = covering_masks(radius)
    rows = fps.select("fp", "rep", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"))
    out = None
    while True:
        rows = rows.withColumn("k", F.xxhash64("mask", F.col("fp").bitwiseAND(F.col("mask"))))
        size = write_table(rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "simhash-buckets")
        met = rows.join(size, "k")
        few = met.where(F.col("n") <= bucket)
        few = (few.select("k", "fp", "rep").repartition("k").sortWithinPartitions("k")
               .mapInArrow(_links(radius), "a long, b long"))
        out = few if out is None else out.union(few)
        if size.where(F.col("n") > bucket).isEmpty():
            return out
        crowded = met.where(F.col("n") > bucket)
        # masks with a crowded bucket: 15 at first, at most four times as many a level
        hot = [r["mask"] for r in crowded.select("mask").distinct().collect()]
        more = spark.createDataFrame(
            [(m, [_signed(x) for x in finer_masks(m % (1 << 64), radius)]) for m in hot],
            "mask long, finer array<long>")
        rows = (crowded.select("fp", "rep", "mask").join(F.broadcast(more), "mask")
                .select("fp", "rep", F.explode("finer").alias("mask")))


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node that each linked node reaches.

    Large star, then small star, until nothing changes: every node ends up
    pointing at the smallest one.  The rounds grow with the logarithm of the
    longest chain."""
    e = write_table(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .where("u != v").distinct(), "links")
    before = None
    while True:
        state = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before or not state[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        e = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        e = e.join(low, "u")
        e = (e.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .union(low.select("u", F.col("m").alias("v"))).distinct())
        e = write_table(e, "links")


def grouped(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, bucket: int = BUCKET,
            payload: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fp, ``payload``, root (a fingerprint that names the component),
    component_id (the component's smallest id; null if it has none)."""
    fps = write_table(fingerprints(docs, shingle, payload), "fingerprints")
    least = write_table(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-ids")
    roots = components(links(least.select("fp", F.col("fp").alias("rep")), radius, bucket))
    rooted = least.join(roots, least["fp"] == roots["node"], "left").select(
        F.col("fp").alias("of"), F.coalesce("root", "fp").alias("root"), "least")
    ids = write_table(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "component-ids")
    return fps.join(rooted.drop("least").join(ids, "root"), F.col("fp") == F.col("of")).select(
        "doc_id", "fp", *payload, "root", "component_id")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE,
                    bucket: int = BUCKET) -> DataFrame:
    """doc_id, fp, component_id (the smallest id reachable by links)."""
    return grouped(docs, radius, shingle, bucket).drop("root")


def dedup(docs: DataFrame, **options) -> DataFrame:
    """One document of each component, that of the smallest id, then of the
    smallest text hash; rows that repeat id and text count as one document."""
    keys = ("__k1", "__k2")    # 96 bits of id and text
    bits = [x for c in (F.col("doc_id").cast("long"), F.col("text").cast("string")) for x in (c, c.isNull())]
    key = [F.xxhash64(*bits).alias("__k1"), F.hash(*bits).cast("long").alias("__k2")]
    found = write_table(grouped(docs.select("doc_id", "text", *key), payload=keys, **options), "components")
    first = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    keep = first.groupBy("root").agg(F.min("__k1").alias("__k1"), F.min_by("__k2", "__k1").alias("__k2")).drop("root")
    kept = docs.select(keep_row(docs), *key).join(keep, [*keys], "left_semi")
    if not first.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        kept = kept.dropDuplicates([*keys])
    return unpack(kept, docs)


@query("op5_simhash")
def op5(spark, sf_dir):
    """Fingerprint and component of all ``documents``."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
