"""Token-id files: documents as zstandard frames under one shared dictionary.

Method.  A zstandard dictionary is trained on serialized id arrays; every
document is then compressed by itself, so a short one costs little and can be
read without its neighbours.  A folder of token files holds

* ``dictionary``: the dictionary's bytes;
* ``data/*.tok``: a header (magic, bytes of an id, SHA-256 of the dictionary)
  and the frames, one a document, in ascending doc_id order.  A frame is the
  document's ids and the end id as little-endian integers, with a checksum;
* ``index`` (Parquet): part, doc_id, file, offset, size, n_tokens, before (ids
  of the documents before it in its part);
* ``parts`` (Parquet): part, start (ids of all parts before it), bytes.

A reader looks documents up in the index, reads their ranges and refuses
files that were written with another dictionary than the folder's.

Tasks write files of their own name (part and attempt) straight to the shared
folder through ``pyarrow.fs``; the index goes through Spark's committer.  Only
files that the index names count, so lost executors and second attempts leave
unread files behind, never wrong ones.

Tokens.  The library encodes pieces, not texts: a space that follows no white
space always starts a pre-token and a letter before another kind of character
always ends one, so a text may be cut there, and each worker keeps the ids of
the pieces it has met.  Texts in which a cut would part white
space, or that spell a special token, are encoded whole.

Scale.  Rows are range-partitioned by (doc_id, text hash, row): one hot or
null id spreads over many parts.  The dictionary's sample is ``SAMPLE_ROWS``
rows by the hash of their place, then ``SAMPLE_CHUNKS`` chunks of
``CHUNK`` bytes of their ids: 16 MB at most at any size.  The driver gets that
sample and one row per part.

Defined cases: a null or empty text is the end id alone; null ids come first;
rows of one id are ordered by the hash of their texts; repeated rows are each
written; an empty table gives a folder without parts; extra columns are
ignored; with too few samples to train on, the sample itself is the
dictionary (raw content), and without any there is none.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import uuid
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pitwall.llm.common import ensure_python_package, query, table
from pitwall.session import ensure_checkpoint_dir

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2
LEVEL = 3                 # zstandard's
DICTIONARY_BYTES = 112_640
SAMPLE_ROWS = 4096        # rows whose ids the dictionary may be trained on
SAMPLE_CHUNKS = 4096      # chunks of their ids that it is trained on
CHUNK = 4096              # bytes of a chunk
FILE_BYTES = 256 << 20    # a file is closed beyond this
READ_BYTES = 8 << 20      # read at once, or one document if that is longer
TASK_BYTES = 32 << 20     # of frames a reading task
SLICE = 6 << 20           # bytes of text encoded at once in a worker
KNOWN = 500_000           # pieces whose ids a worker keeps at most
JOINED = 64               # pieces that the library encodes as one text
AT_ONCE = 8192            # pieces of one library call
MAGIC = b"PWTOK1\0"
SPECIAL = "<|endoftext|>"

_BLANK = r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
# A space inside white space, or white space that ends in a space at the end:
# cut there, the parts would be other pre-tokens than the whole.
_UNCUT = rf"{_BLANK} (?:{_BLANK}|\z)|\x00|<\|endoftext\|>"
# Other places where a pre-token always ends: between a letter and what is no
# letter, around a line end before a letter.
_LETTER = "[A-Za-zÀ-ÖØ-öø-ž]"
_CUTS = ((rf"({_LETTER})([!-@\[-`{{-~\n])", "\\1\x00\\2"), (rf"\n({_LETTER})", "\x00\n\x00\\1"))


class PieceEncoder:
    """Token ids of texts; keeps the ids of the pieces it has met."""

    def __init__(self, path: str, known: int = KNOWN):
        self.tokenizer, self.known = Tokenizer.from_file(path), known
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.special = self.tokenizer.token_to_id(SPECIAL)
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.start, self.ids = np.zeros(1, np.int64), np.empty(0, f"<u{self.width}")

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[str]) -> None:
        new_ids, new_start, before = [self.ids], [self.start], self.start[-1]
        for a in range(0, len(pieces), AT_ONCE):
            some = pieces[a:a + AT_ONCE]
            # many pieces a text, parted by the special token, which none of them holds
            texts = [SPECIAL.join(some[k:k + JOINED]) + SPECIAL for k in range(0, len(some), JOINED)]
            got = np.concatenate([np.array(ids, np.uint32) for ids in self._encode(texts)])
            ends = np.flatnonzero(got == self.special)
            n = len(self.number)
            self.number.update(zip(some, range(n, n + len(some))))
            new_start.append(before + ends - np.arange(len(some)))
            new_ids.append(got[got != self.special].astype(self.ids.dtype))
            before += len(new_ids[-1])
        self.ids, self.start = np.concatenate(new_ids), np.concatenate(new_start)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text."""
        uncut = pc.match_substring_regex(texts, _UNCUT)
        marked = pc.replace_substring(pc.if_else(uncut, "", texts), " ", "\x00 ")
        for place, mark in _CUTS:
            marked = pc.replace_substring_regex(marked, place, mark)
        split = pc.split_pattern(marked, "\x00")
        coded = split.flatten().dictionary_encode()
        pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.number) > self.known:
            self._forget()
        missing = [p for p in pieces if p not in self.number]
        if missing:
            self._learn(missing)
        place = np.array([self.number[p] for p in pieces], np.int64)[coded.indices.to_numpy()]
        start, size = self.start[place], self.start[place + 1] - self.start[place]
        end = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.repeat(start - end[:-1], size) + np.arange(end[-1])]
        offsets = split.offsets.to_numpy().astype(np.int64)
        at = end[offsets - offsets[0]]
        out = [ids[a:b] for a, b in zip(at[:-1], at[1:])]
        whole = np.flatnonzero(uncut.to_numpy(zero_copy_only=False))
        for k in whole:  # one at a time: such a text may be long
            out[k] = np.array(self._encode([texts[int(k)].as_py()])[0], self.ids.dtype)
        return out


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    # Spark runs a worker per core; the library's own threads would only cost memory
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def _slices(texts: pa.Array):
    size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(size, (size[a - 1] if a else 0) + SLICE, "right")))
        yield a, texts.slice(a, b - a)
        a = b


def serialized(batches, tokenizer: str, end_id: int):
    """(row of the batch, batch, ids as bytes) of every document."""
    enc = encoder(tokenizer)
    end = np.array([end_id], f"<u{enc.width}").tobytes()
    for b in batches:
        for a, texts in _slices(pc.fill_null(b.column("text"), "")):
            for k, ids in enumerate(enc.encode(texts)):
                yield a + k, b, ids.tobytes() + end


def files_at(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(folder)


def as_uri(spark: SparkSession, folder: str) -> str:
    """``folder`` with the scheme that Spark would read it by."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(sc._jsc.hadoopConfiguration()).makeQualified(path).toUri().toString()
    return "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri


def train(chunks: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary trained on serialized ids (raw content if they are few)."""
    total = sum(map(len, chunks))
    if not total:
        return b""
    try:
        return zstandard.train_dictionary(min(size, max(1024, total // 8)), chunks, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(chunks)[-size:]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def sample_chunks(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID,
                  rows: int = SAMPLE_ROWS, chunks: int = SAMPLE_CHUNKS) -> list[bytes]:
    """The bounded sample that the dictionary is trained on."""
    lot = docs.select(F.xxhash64(F.monotonically_increasing_id()).alias("lot"), F.col("text").cast("string").alias("text"))
    last = lot.select("lot").orderBy("lot").limit(rows).agg(F.max("lot")).first()[0]
    if last is None:
        return []

    def run(batches):
        best: list[tuple[int, bytes]] = []
        for k, b, data in serialized(batches, tokenizer, end_id):
            row = b.column("lot")[k].as_py()
            for p in range(0, len(data), CHUNK):
                h = zlib.crc32(f"{row}:{p}".encode())
                if len(best) < chunks:
                    heapq.heappush(best, (-h, data[p:p + CHUNK]))
                elif -h > best[0][0]:
                    heapq.heapreplace(best, (-h, data[p:p + CHUNK]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([-h for h, _ in best], pa.int64()), pa.array([x for _, x in best], pa.binary())],
            names=["h", "data"])

    ensure_python_package(docs.sparkSession)
    got = lot.where(F.col("lot") <= last).mapInArrow(run, "h long, data binary").orderBy("h", "data").limit(chunks)
    return [bytes(r.data) for r in got.collect()]


INDEX = "part int, doc_id long, file string, offset long, size long, n_tokens long, before long"


def _writer(folder: str, tokenizer: str, end_id: int, level: int, data: bytes, file_bytes: int):
    def run(batches):
        context = TaskContext.get()
        part, fs, root = context.partitionId(), *files_at(folder)
        width = encoder(tokenizer).width
        book = _dictionary(data)
        if book is not None:
            book.precompute_compress(level=level)
        pack = zstandard.ZstdCompressor(level=level, dict_data=book, write_checksum=True)
        header = MAGIC + bytes([width]) + hashlib.sha256(data).digest()
        out, name, at, before, n_files, rows, last = None, "", 0, 0, 0, [], None

        def index():
            where, ids, files, offsets, sizes, counts, befores = zip(*rows)
            ids = pa.array(ids, pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(where, pa.int32()), ids, pa.array(files, pa.string()),
                 *[pa.array(x, pa.int64()) for x in (offsets, sizes, counts, befores)]],
                names=[c.split()[0] for c in INDEX.split(", ")])

        for k, b, raw in serialized(batches, tokenizer, end_id):
            if out is None or at >= file_bytes:
                if out is not None:
                    out.close()
                name = f"{part:06d}-{n_files:04d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}.tok"
                out = fs.open_output_stream(f"{root}/data/{name}")
                out.write(header)
                at, n_files = len(header), n_files + 1
            if b is not last:
                doc_ids, last = b.column("doc_id").to_pylist(), b
            frame, n = pack.compress(raw), len(raw) // width
            out.write(frame)
            rows.append((part, doc_ids[k], name, at, len(frame), n, before))
            at, before = at + len(frame), before + n
            if len(rows) >= 10_000:
                yield index()
                rows.clear()
        if out is not None:
            out.close()
        if rows:
            yield index()

    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer: str = TOKENIZER, end_id: int = END_ID,
                      level: int = LEVEL, file_bytes: int = FILE_BYTES) -> str:
    """Writes ``docs`` (doc_id, text) as token files; returns the folder's URI."""
    spark = docs.sparkSession
    ensure_python_package(spark)
    folder = as_uri(spark, folder)
    fs, root = files_at(folder)
    fs.create_dir(f"{root}/data", recursive=True)
    data = train(sample_chunks(docs, tokenizer, end_id))
    with fs.open_output_stream(f"{root}/dictionary") as f:
        f.write(data)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                    F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("row"))
    order = ["doc_id", "h", "row"]
    (d.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
     .mapInArrow(_writer(folder, tokenizer, end_id, level, data, file_bytes), INDEX)
     .write.parquet(f"{folder}/index"))
    parts, start = [], 0
    for r in (spark.read.parquet(f"{folder}/index").groupBy("part")
              .agg(F.sum("n_tokens").alias("n"), F.sum("size").alias("b")).orderBy("part").collect()):
        parts.append((r.part, start, r.b))
        start += r.n
    spark.createDataFrame(parts, "part int, start long, bytes long").coalesce(1).write.parquet(f"{folder}/parts")
    return folder


def read_token_files(spark: SparkSession, folder: str, doc_ids: list[int] | None = None,
                     ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (of the ids as little-endian 32-bit
    integers) and, if asked for, the ids; of some documents only if ``doc_ids``
    names them (the index finds their ranges)."""
    ensure_python_package(spark)
    folder = as_uri(spark, folder)
    fs, root = files_at(folder)
    with fs.open_input_file(f"{root}/dictionary") as f:
        data = f.read()

    def run(batches):
        fs, root = files_at(folder)
        book = zstandard.ZstdDecompressor(dict_data=_dictionary(data))
        digest, opened = hashlib.sha256(data).digest(), {}

        def source(name: str):
            if name not in opened:
                for f, _ in opened.values():
                    f.close()
                opened.clear()
                f = fs.open_input_file(f"{root}/data/{name}")
                head = f.read(len(MAGIC) + 33)
                if head[:len(MAGIC)] != MAGIC:
                    raise ValueError(f"{name} is no token file")
                if head[len(MAGIC) + 1:] != digest:
                    raise ValueError(f"{name} was written with another dictionary")
                opened[name] = f, head[len(MAGIC)]
            return opened[name]

        for b in batches:
            r = {c: b.column(c).to_pylist() for c in b.schema.names}
            a = 0
            while a < b.num_rows:
                name, begin, z = r["file"][a], r["offset"][a], a + 1
                while z < b.num_rows and r["file"][z] == name and r["offset"][z] + r["size"][z] - begin <= READ_BYTES:
                    z += 1
                f, width = source(name)
                window = f.read_at(r["offset"][z - 1] + r["size"][z - 1] - begin, begin)
                crcs, got = [], []
                for k in range(a, z):
                    at = r["offset"][k] - begin
                    x = np.frombuffer(book.decompress(window[at:at + r["size"][k]]), f"<u{width}").astype("<u4")
                    if len(x) != r["n_tokens"][k]:
                        raise ValueError(f"{name} at {r['offset'][k]}: {len(x)} ids, {r['n_tokens'][k]} in the index")
                    crcs.append(zlib.crc32(x))
                    if ids:
                        got.append(x.astype(np.int32))
                cols = [b.column(c).slice(a, z - a) for c in ("doc_id", "start", "n_tokens")]
                cols.append(pa.array(crcs, pa.int64()))
                if ids:
                    cols.append(pa.array(got, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(
                    cols, names=["doc_id", "start", "n_tokens", "ids_crc32"] + (["ids"] if ids else []))
                a = z

    index, parts = spark.read.parquet(f"{folder}/index"), spark.read.parquet(f"{folder}/parts")
    if doc_ids is not None:
        index = index.where(F.col("doc_id").isin(doc_ids))
    tasks = max(1, -(-(parts.agg(F.sum("bytes")).first()[0] or 0) // TASK_BYTES))
    rows = (index.join(F.broadcast(parts.select("part", "start")), "part")   # a row per writing task
            .select("part", "file", "offset", "size", "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens")
            .repartitionByRange(tasks, "part", "file", "offset").sortWithinPartitions("part", "file", "offset"))
    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long"
                           + (", ids array<int>" if ids else ""))


@query("op13_token_files")
def op13(spark, sf_dir):
    """All ``documents`` written as token files and read back."""
    folder = f"{ensure_checkpoint_dir(spark)}/token-files-{uuid.uuid4().hex[:12]}"
    return read_token_files(spark, write_token_files(table(spark, sf_dir, "documents"), folder))
