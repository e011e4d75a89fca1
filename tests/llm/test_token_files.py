"""Token files: exact round trips against the tokenizers library."""
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pitwall.llm import token_files as tf
from pitwall.session import ensure_checkpoint_dir

PLAIN = Tokenizer.from_file(tf.TOKENIZER)


def whole(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


def want(rows):
    """(doc_id, start, n, crc) in ascending doc_id; ids unique or texts equal."""
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(whole(t) + [tf.END_ID], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids)))
        start += len(ids)
    return out


@pytest.fixture
def folder(spark, request):
    return f"{ensure_checkpoint_dir(spark)}/tok-{random.getrandbits(60):x}"


def test_pieces_equal_whole_texts():
    rnd = random.Random(5)
    bits = [" ", " ", "  ", "\n", "\n\n", "\t", " ", "　", "\x1f", "\x00", "a", "the", "don't", "İé", "日本", "12", "...",
            "<|endoftext|>", "'s", "x" * 50]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 9))) for _ in range(20_000)]
    enc = tf.PieceEncoder(tf.TOKENIZER, known=500)
    for a in range(0, len(texts), 1000):
        part = texts[a:a + 1000]
        for t, ids in zip(part, enc.encode(pa.array(part))):
            assert ids.tolist() == whole(t), repr(t)


def test_round_trip_of_documents(spark, sample, folder):
    tf.write_token_files(sample.repartition(7), folder, file_bytes=20_000)
    back = tf.read_token_files(spark, folder, ids=True).orderBy("start").collect()
    rows = [(r.doc_id, r.text) for r in sample.collect()]
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in back] == want(rows)
    text = dict(rows)
    assert all(r.ids == whole(text[r.doc_id]) + [tf.END_ID] for r in back)
    index = spark.read.parquet(f"{folder}/index")
    assert index.select("file").distinct().count() > 8  # files are closed beyond their size
    raw = sum(r.n_tokens for r in back) * 2
    assert index.agg(F.sum("size")).first()[0] < 0.8 * raw


def test_short_documents_by_the_index(spark, sample, folder):
    tf.write_token_files(sample, folder)
    some = tf.read_token_files(spark, folder, doc_ids=[3, 77, 10**9], ids=True).collect()
    text = {r.doc_id: r.text for r in sample.collect()}
    assert {r.doc_id for r in some} == {3, 77} & set(text)
    assert all(r.ids == whole(text[r.doc_id]) + [tf.END_ID] for r in some)


def test_edge_rows(spark, edge, empty, folder):
    tf.write_token_files(edge, folder)
    back = tf.read_token_files(spark, folder).orderBy("start").collect()
    assert [tuple(r) for r in back] == want([(r.doc_id, r.text) for r in edge.collect()])
    tf.write_token_files(empty, folder + "e")
    assert tf.read_token_files(spark, folder + "e").count() == 0


def test_hot_null_id_spreads(spark, folder):
    docs = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.col("id")).alias("doc_id"), F.lit("one text").alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the table is tiny
    try:
        tf.write_token_files(docs.repartition(6), folder)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    index = spark.read.parquet(f"{folder}/index")
    assert index.where("doc_id IS NULL").select("part").distinct().count() > 2
    back = tf.read_token_files(spark, folder).orderBy("start").collect()
    assert [r.start for r in back] == [3 * k for k in range(3000)]
    assert [r.doc_id for r in back] == [None] * 2000 + list(range(0, 3000, 3))


def test_other_dictionary_is_refused(spark, sample, folder):
    uri = tf.write_token_files(sample, folder)
    fs, root = tf.files_at(uri)
    with fs.open_output_stream(f"{root}/dictionary") as f:
        f.write(tf.train([bytes([k % 7, 0]) * 500 for k in range(200)]))
    with pytest.raises(Exception, match="another dictionary"):
        tf.read_token_files(spark, folder).count()


def test_files_of_lost_attempts_do_not_count(spark, folder):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    fs, root = tf.files_at(tf.write_token_files(docs, folder))
    with fs.open_output_stream(f"{root}/data/000000-0000-99-lost.tok") as f:
        f.write(b"half a fil")
    assert [tuple(r) for r in tf.read_token_files(spark, folder).orderBy("start").collect()] == want([(1, "a b"), (2, "c")])
