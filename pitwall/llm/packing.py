"""Best-fit packing: bound-certified repacking.

Method.  Documents become pieces of at most ``capacity`` tokens.  Pieces are
dealt into groups of bounded size; each group is packed best-fit decreasing.
Dual-feasible functions give a lower bound of the sequences that any packing
of the group needs, so a group that reaches its bound is certified and done.
The others exchange documents: each releases its emptiest sequences, eight
groups' releases form a new group, and best-fit decreasing runs again over
them (kept only if it needs fewer sequences).  A few rounds end it.

Tokens.  ``tokenizers`` encodes words, not texts: for this tokenizer a text's
ids are those of its white-space separated parts, one after another, so each
worker encodes the distinct parts of a slice of texts, from the ids of the
words it has met.  These lie in flat arrays, bounded in words and in bytes;
Arrow splits a slice's parts into words, and the library encodes many new words
as one text, in which each word's last token is marked.

Scale.  Token ids never leave the worker that made them, only lengths and
checksums do; groups hold ``GROUP`` pieces at most on average whatever the
input, and repeated rows or one hot source are dealt like any others.

Defined cases: a null or empty text is a document of the end id alone;
repeated rows are packed one by one; an empty table gives an empty result;
extra columns are ignored; any text length is cut into pieces.
"""

from __future__ import annotations

import os
import zlib
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pitwall.llm.common import ensure_python_package, query, table, write_table

CAPACITY = 4096
END_ID = 1
GROUP = 16384             # pieces of a group, on average
RELEASE = GROUP // 8      # pieces that a group releases at most
ROUNDS = 3                # exchanges
SLICE = 6 << 20           # bytes of text encoded at once in a worker
KNOWN = 1_000_000         # words whose ids a worker keeps, and one slice's beyond
KNOWN_BYTES = 64 << 20    # the same in bytes
AT_ONCE = 8192            # strings handled as Python objects or wide numbers at once
JOINED = 64               # words that the library encodes as one text
ROWS = 500                # rows that Spark sends to a worker at once
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

# Parts of only these characters are split here as the tokenizer's own rule
# does (its pattern follows); all others are encoded whole by the tokenizer.
_PLAIN = r"^[\x21-\x7EÀ-ÖØ-öø-įı-ňŊ-ž]+$"
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"


def take(start: np.ndarray, ids: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """ids of the strings at all places, one after another; where each starts
    (and the end of the last)."""
    end = np.zeros(len(place) + 1, np.int64)
    np.cumsum(start[place + 1] - start[place], out=end[1:])
    out = np.empty(end[-1], np.uint32)
    for a in range(0, len(place), AT_ONCE):  # so that only the ids are as long as a slice
        some, here = start[place[a:a + AT_ONCE]], end[a:a + AT_ONCE + 1]
        at = np.repeat(some - here[:-1], np.diff(here))
        at += np.arange(here[0], here[-1])
        out[here[0]:here[-1]] = ids[at]
    return out, end


class Known:
    """Distinct strings and their token ids in flat arrays, some 40 bytes a
    string; ``make`` gives sizes and ids of strings that are not known yet."""

    def __init__(self, make):
        self.make = make
        self.forget()

    def forget(self) -> None:
        self.strings = pa.array([], pa.string())
        self.start, self.ids = np.zeros(1, np.int64), np.empty(0, np.uint32)

    def trim(self, known: int) -> None:
        if len(self.strings) > known or self.strings.nbytes + self.ids.nbytes > KNOWN_BYTES:
            self.forget()

    def places(self, distinct: pa.Array) -> np.ndarray:
        at = pc.index_in(distinct, value_set=self.strings)
        new = pc.is_null(at)
        out = pc.fill_null(at, 0).to_numpy().astype(np.int64)
        if at.null_count:
            strings = distinct.filter(new)
            size, ids = self.make(strings)
            out[new.to_numpy(zero_copy_only=False)] = len(self.strings) + np.arange(len(strings))
            self.ids = np.concatenate([self.ids, ids])
            self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(size)])
            self.strings = pa.concat_arrays([self.strings, strings])
        return out


class Encoder:
    """Token ids of texts; keeps the ids of words (what the tokenizer's pattern
    splits a part between white space into)."""

    def __init__(self, path: str, known: int = KNOWN):
        self.tokenizer, self.known = Tokenizer.from_file(path), known
        # ids that end a word: their tokens carry the suffix, all others do not
        vocab, suffix = self.tokenizer.get_vocab(), self.tokenizer.model.end_of_word_suffix
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        self.last[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        self.words = Known(self._words)

    def _encode(self, texts: list[str]) -> tuple[list[int], np.ndarray]:
        some = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        size = list(map(len, some))
        return size, np.fromiter(chain.from_iterable(some), np.uint32, sum(size))

    def _whole(self, strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        size, ids = [], [np.empty(0, np.uint32)]
        for a in range(0, len(strings), AT_ONCE):
            some, got = self._encode(strings.slice(a, AT_ONCE).to_pylist())
            size.extend(some)
            ids.append(got)
        return np.array(size, np.int64), np.concatenate(ids)

    def _words(self, strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As ``_whole``, of words alone: many of them are one text of the library."""
        size, ids = [np.empty(0, np.int64)], [np.empty(0, np.uint32)]
        for a in range(0, len(strings), AT_ONCE):
            some = strings.slice(a, AT_ONCE).to_pylist()
            _, got = self._encode([" ".join(some[k:k + JOINED]) for k in range(0, len(some), JOINED)])
            ends = np.flatnonzero(self.last[got])
            if len(ends) != len(some):
                raise ValueError("the tokenizer splits words otherwise than this module")
            size.append(np.diff(ends, prepend=-1))
            ids.append(got)
        return np.concatenate(size), np.concatenate(ids)

    def _parts(self, strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        plain = pc.and_not(pc.match_substring_regex(strings, _PLAIN), pc.match_substring(strings, "<|"))
        marked = pc.replace_substring_regex(pc.utf8_lower(strings.filter(plain)), _SPLIT, r"\0 ")
        split = pc.split_pattern(pc.ascii_rtrim(marked, " "), " ")
        coded = split.flatten().dictionary_encode()
        self.words.trim(self.known)
        place = self.words.places(coded.dictionary)[coded.indices.to_numpy()]
        got, end = take(self.words.start, self.words.ids, place)
        whole_size, whole = self._whole(strings.filter(pc.invert(plain)))
        offsets, plain = split.offsets.to_numpy(), plain.to_numpy(zero_copy_only=False)
        size = np.empty(len(plain), np.int64)
        size[plain], size[~plain] = np.diff(end[offsets - offsets[0]]), whole_size
        ids, split_up = np.empty(size.sum(), np.uint32), np.repeat(plain, size)
        ids[split_up], ids[~split_up] = got, whole
        return size, ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """ids of all texts, one after another; where each text starts (and
        the end of the last)."""
        split = pc.ascii_split_whitespace(texts)
        # leading and trailing white space leave empty parts, which have no ids
        coded = split.flatten().dictionary_encode()
        size, ids = self._parts(coded.dictionary)
        ids, end = take(np.concatenate([[0], np.cumsum(size)]), ids, coded.indices.to_numpy())
        offsets = split.offsets.to_numpy().astype(np.int64)
        return ids, end[offsets - offsets[0]]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    # Spark runs a worker per core; the library's own threads would only cost memory
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _gathered(batches):
    """Batches of SLICE bytes at most (or one that is larger), of smaller ones."""
    held, size = [], 0
    for b in batches:
        if held and size + b.nbytes > SLICE:
            held, size = pa.concat_batches(held), 0
            yield held
            held = []
        held.append(b)
        size += b.nbytes
    if held:
        yield pa.concat_batches(held)


def _slices(texts: pa.Array):
    """Slices of about SLICE bytes each."""
    size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(size, (size[a - 1] if a else 0) + SLICE, "right")))
        yield a, texts.slice(a, b - a)
        a = b


PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY,
           with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids)."""
    def run(batches):
        enc = encoder(tokenizer)
        for b in _gathered(batches):
            doc_ids = b.column("doc_id").to_numpy(zero_copy_only=False)
            null = np.isnan(doc_ids) if doc_ids.dtype.kind == "f" else None
            if null is not None:  # some id is null: keep exact values
                doc_ids = b.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
            for a, texts in _slices(pc.fill_null(b.column("text"), "")):
                ids, at = enc.encode(texts)
                rows = []
                for k in range(len(texts)):
                    d = np.append(ids[at[k]:at[k + 1]], np.uint32(END_ID)).astype("<u4")
                    for p in range(0, len(d), capacity):
                        x = d[p:p + capacity]
                        rows.append((a + k, p // capacity, p, len(x), zlib.crc32(x), x if with_ids else None))
                who, piece, start, length, crc, got = zip(*rows)
                who = np.array(who)
                cols = [pa.array(doc_ids[who], pa.int64(), mask=None if null is None else null[who]),
                        pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array([x.astype(np.int32) for x in got], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)
                pa.default_memory_pool().release_unused()  # what the slice took goes back

    ensure_python_package(docs.sparkSession)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(run, PIECE + (", ids array<int>" if with_ids else ""))


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs, by dual-feasible functions.

    For each threshold t up to half the capacity: sizes above capacity - t
    count as whole sequences, sizes below t as nothing, the rest as they are."""
    s = np.sort(sizes)
    total = np.concatenate([[0], np.cumsum(s)])
    t = np.unique(np.concatenate([[0], s[s <= capacity // 2]]))
    low, high = np.searchsorted(s, t, "left"), np.searchsorted(s, capacity - t, "right")
    need = (len(s) - high) * capacity + total[high] - total[low]
    return int(-(-need.max() // capacity)) if len(s) else 0


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Sequence and offset of each size; how many sequences."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # open sequences by free room
    some = 0                                                   # bit r: room[r] is not empty
    where, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    n = 0
    for i in np.argsort(-sizes, kind="stable"):
        x = int(sizes[i])
        fits = some >> x
        if fits:
            r = x + ((fits & -fits).bit_length() - 1)
            k = room[r].pop()
            if not room[r]:
                some ^= 1 << r
        else:
            k, r = n, capacity
            n += 1
        where[i], offset[i] = k, capacity - r
        r -= x
        if r:
            if not room[r]:
                some |= 1 << r
            room[r].append(k)
    return where, offset, n


def _pack(capacity: int, first: bool, release: int):
    """Pack one group.  In ``seq``: the sequence before (or null); rows whose
    sequence stays closed get ``open`` false."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        # the same rows in any order give the same packing
        group = group.sort_values(["length", "doc_id", "piece", "ids_crc32"], kind="stable",
                                  ignore_index=True)
        sizes = group["length"].to_numpy()
        where, offset, n = best_fit_decreasing(sizes, capacity)
        before = group["seq"].nunique() if not first else n
        if first or n < before:
            group["bin"], group["offset"] = where, offset
        else:  # no gain: the sequences stay as they were
            group["bin"] = pd.factorize(group["seq"])[0]
            n = before
        gap = n - lower_bound(sizes, capacity)
        group["open"] = False
        if gap > 0:
            used = np.bincount(group["bin"], weights=sizes, minlength=n)
            count = np.bincount(group["bin"], minlength=n)
            order = np.argsort(used, kind="stable")
            free = order[(np.cumsum(count[order]) <= release) & (used[order] < capacity)]
            group["open"] = np.isin(group["bin"], free)
        return group

    return run


PACKED = PIECE + ", grp long, seq string, bin long, offset long, open boolean"


def pack(rows: DataFrame, capacity: int = CAPACITY, group: int = GROUP, rounds: int = ROUNDS) -> DataFrame:
    """Adds sequence_id and offset to pieces (a table already written)."""
    whole = rows.where(F.col("length") == capacity).select(
        "*", F.concat(F.lit("w"), F.monotonically_increasing_id()).alias("seq"), F.lit(0).cast("long").alias("offset"))
    part = rows.where(F.col("length") < capacity)
    n = max(1, -(-part.count() // group))
    part = part.select("*", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)).alias("grp"),
                       F.lit("").alias("seq"), F.lit(-1).cast("long").alias("bin"),
                       F.lit(0).cast("long").alias("offset"), F.lit(True).alias("open"))
    done = whole.drop("grp")
    for k in range(rounds + 1):
        packed = part.groupBy("grp").applyInPandas(_pack(capacity, k == 0, max(1, group // 8)), PACKED)
        packed = write_table(packed.withColumn("seq", F.concat(
            F.lit(f"{k}-"), "grp", F.lit("-"), "bin")), "packed")
        if k == rounds or n == 1:
            done = done.unionByName(packed.select(*done.columns))
            break
        done = done.unionByName(packed.where("NOT open").select(*done.columns))
        part, n = packed.where("open").withColumn("grp", F.floor(F.col("grp") / 8)), -(-n // 8)
    # round, group and sequence in the group as one number; a group has at
    # most as many sequences as pieces, which stay far below twice the average
    parts = F.split("seq", "-")
    number = F.when(F.startswith("seq", F.lit("w")), F.substring("seq", 2, 20).cast("long") * 8 + 7).otherwise(
        (F.try_element_at(parts, F.lit(2)).cast("long") * (group * 2) + F.try_element_at(parts, F.lit(3)).cast("long")) * 8
        + F.try_element_at(parts, F.lit(1)).cast("long"))
    return done.select(*rows.columns, number.alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    conf, key = docs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(key)
    conf.set(key, str(ROWS))  # an executor holds each task's batches twice, outside its heap
    try:
        rows = write_table(pieces(docs, tokenizer, capacity), "pieces")
    finally:
        conf.set(key, before)
    return pack(rows, capacity)


def sequences(packed: DataFrame, with_ids: DataFrame) -> DataFrame:
    """sequence_id and its token ids, from packed pieces and ``pieces(...,
    with_ids=True)``; ids of repeated documents are equal, so any serves."""
    key = ["doc_id", "piece", "ids_crc32"]
    ids = with_ids.select(*key, "ids").dropDuplicates(key)
    return (packed.join(ids, key).groupBy("sequence_id")
            .agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
            .select("sequence_id", F.flatten("p.ids").alias("ids")))


@query("op4_best_fit_packing")
def op4(spark, sf_dir):
    """All ``documents`` packed into sequences of 4096 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"))
