"""Document fingerprints by locally consistent parsing.

Method.  A text is a sequence of symbols, at first its code points.  A level
turns it into a shorter one: runs of one symbol become one symbol; then
deterministic coin tossing gives every symbol a label below 6 that depends
only on it and the four symbols before it (each toss: the lowest bit in which
a symbol differs from its left neighbour, and that bit's value); label maxima
start phrases; a phrase's name is a hash of its symbols.  Cuts depend on near
symbols alone, so equal substrings get equal names inside, wherever they
stand.  No dictionary of names is needed.

A fingerprint samples the set of phrase names of the levels ``LEVELS``:
64 bins by name, the smallest name of each bin, 16 bits of it in hexadecimal
(0000: empty bin).  Likeness is the share of equal bins among those that are
not empty in both, an estimate of the sets' Jaccard similarity.

Scale.  Texts are range-partitioned by id once and streamed in order, so each
row meets the next document; only the last row of a partition needs the first
of another, and these pairs (one per partition) are joined apart.

Defined cases: a null text is empty; an empty text has an empty fingerprint,
like only to empty ones; the document after the last is the first, so a sole
document follows itself; rows that share an id are ordered by text hash; null
ids come first; any length is processed in blocks of whole documents.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitwall.llm.common import ensure_python_package, query, table, write_table

LEVELS = (3, 4)
BINS = 64
TOSSES = 4              # 64 bits -> 7 bits -> 14 -> 8 -> 6 labels
BLOCK = 400_000         # characters parsed at once, or one document
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ONE = np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: equal in, equal out; near in, far out."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _labels(s: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Deterministic coin tossing; ``first``: where documents begin."""
    x = s
    for _ in range(TOSSES):
        d = np.empty_like(x)
        np.bitwise_xor(x[1:], x[:-1], out=d[1:])
        d[first] = _ONE                       # no left neighbour: toss bit 0
        low = d & (~d + _ONE)
        x = (np.bitwise_count(low - _ONE).astype(np.uint64) << _ONE) | ((x & low) != 0)
    return x.astype(np.int16)


def next_level(s: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phrase names and where documents begin among them.

    ``s``: symbols of some documents, each not empty, one after another."""
    start = np.empty(len(s), bool)
    start[1:] = s[1:] != s[:-1]
    start[first] = True
    at = np.flatnonzero(start)
    run = np.diff(np.append(at, len(s))).astype(np.uint64)
    s, first = s[at], np.searchsorted(at, first)
    long = run > _ONE
    s[long] = _mix(s[long] + run[long] * _ODD)

    label = _labels(s, first)
    cut = np.zeros(len(s), bool)
    cut[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
    last = np.append(first[1:], len(s)) - 1   # neither a document's first nor its last
    cut[last] = False                         # symbol looks at another document
    cut[first] = True
    at = np.flatnonzero(cut)
    place = np.arange(len(s)) - np.repeat(at, np.diff(np.append(at, len(s))))
    name = np.add.reduceat(_mix(s + (place + 1).astype(np.uint64) * _ODD), at)
    return _mix(name), np.searchsorted(at, first)


def fingerprints(texts: list[np.ndarray]) -> np.ndarray:
    """One row of BINS 16-bit values per text (arrays of code points)."""
    out = np.zeros((len(texts), BINS), np.uint16)
    full = np.array([i for i, t in enumerate(texts) if len(t)], np.int64)
    if not len(full):
        return out
    s = np.concatenate([texts[i] for i in full]).astype(np.uint64)
    first = np.concatenate([[0], np.cumsum([len(texts[i]) for i in full])[:-1]]).astype(np.int64)
    least = np.full((len(full), BINS), np.iinfo(np.uint64).max, np.uint64)
    for level in range(1, max(LEVELS) + 1):
        s, first = next_level(s, first)
        if level in LEVELS:
            doc = np.repeat(np.arange(len(full)), np.diff(np.append(first, len(s))))
            name = _mix(s + np.uint64(level))
            np.minimum.at(least, (doc, (name >> np.uint64(58)).astype(np.int64)), name << np.uint64(6))
    some = least != np.iinfo(np.uint64).max
    out[full] = np.where(some, 1 + _mix(least) % np.uint64(65535), 0)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row: share of equal bins among those not empty in both."""
    some = (a != 0) | (b != 0)
    n = some.sum(axis=1)
    return np.where(n == 0, 1.0, ((a == b) & some).sum(axis=1) / np.maximum(n, 1))


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def edited(text: str, following: str) -> str:
    """The last half (rounded down) replaced by the following text's start."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _hex(prints: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in prints.astype(">u2")]


ROW = pa.schema([("kind", pa.string()), ("pid", pa.int32()), ("doc_id", pa.int64()), ("n_chars", pa.int64()),
                 ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                 ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
                 ("near_next", pa.float64()), ("text", pa.string())])
ROW_SQL = ("kind string, pid int, doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
           "edited_fingerprint string, near_edited double, near_next double, text string")


def _rows(pid: int, ids: list, texts: list[str]) -> pa.RecordBatch:
    """Result rows of all texts but the last, which only follows."""
    new = [edited(a, b) for a, b in zip(texts, texts[1:])]
    prints = fingerprints([_points(t) for t in texts + new])
    own, follow, edit = prints[:len(new)], prints[1:len(texts)], prints[len(texts):]
    n = len(new)
    return pa.RecordBatch.from_arrays([
        pa.array(["row"] * n), pa.array([pid] * n, pa.int32()), pa.array(ids[:n], pa.int64()),
        pa.array([len(t) for t in texts[:n]], pa.int64()),
        pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in new], pa.string()),
        pa.array(_hex(own), pa.string()), pa.array(_hex(edit), pa.string()),
        pa.array(likeness(own, edit)), pa.array(likeness(own, follow)), pa.nulls(n, pa.string())], schema=ROW)


def _edge(kind: str, pid: int, doc_id, text: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"kind": kind, "pid": pid, "doc_id": doc_id, "text": text}], schema=ROW)


def _stream(batches):
    """Rows in id order; also emits the first and the last row of the partition."""
    pid, ids, texts, size = TaskContext.get().partitionId(), [], [], 0
    begun = False
    for b in batches:
        for doc_id, text in zip(b.column("doc_id"), b.column("text")):
            ids.append(doc_id.as_py())
            texts.append(text.as_py() or "")
            size += len(texts[-1])
            if not begun:
                begun = True
                yield _edge("first", pid, ids[0], texts[0])
            if size >= BLOCK and len(texts) > 1:
                yield _rows(pid, ids, texts)
                ids, texts, size = ids[-1:], texts[-1:], len(texts[-1])
    if begun:
        if len(texts) > 1:
            yield _rows(pid, ids, texts)
        yield _edge("last", pid, ids[-1], texts[-1])


def _pairs(batches):
    for b in batches:
        for doc_id, text, following in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "following"))):
            yield _rows(0, [doc_id, None], [text, following])


def document_fingerprints(docs: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next: one row per document."""
    spark = docs.sparkSession
    ensure_python_package(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    d = d.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    found = write_table(d.mapInArrow(_stream, ROW_SQL), "phrase-rows")
    edges = found.where("kind != 'row'").select("kind", "pid", "doc_id", "text")
    pids = edges.where("kind = 'first'").select("pid")   # one row per partition
    order = Window.orderBy("pid")
    follow = pids.select("pid", F.coalesce(F.lead("pid").over(order), F.min("pid").over(Window.partitionBy())).alias("next"))
    firsts = edges.where("kind = 'first'").select(F.col("pid").alias("next"), F.col("text").alias("following"))
    ends = (edges.where("kind = 'last'").join(follow, "pid").join(firsts, "next")
            .select("doc_id", "text", "following").mapInArrow(_pairs, ROW_SQL))
    return found.where("kind = 'row'").unionByName(ends).drop("kind", "pid", "text")


@query("op6_document_fingerprints")
def op6(spark, sf_dir):
    """Fingerprints of all ``documents`` and of their edited texts."""
    return document_fingerprints(table(spark, sf_dir, "documents"))
