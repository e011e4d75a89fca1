"""Spelling variant grouping against brute force."""
import collections
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from pitwall.llm import spelling

RUN = re.compile(r"[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute_words(rows, damage=97, min_chars=5, min_count=3):
    n = collections.Counter()
    for doc_id, text in rows:
        for w in RUN.findall(text or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if damage and h % damage == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return {w: k for w, k in n.items() if len(w) >= min_chars and k >= min_count}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(n, ratio=2):
    out, form = {}, {}
    for w in n:
        mates = [v for v in n if near(w, v)]
        best = min(mates, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
        out[w] = len(mates)
    rows = set()
    for w in n:
        r = w
        while form[r]:
            r = form[r]
        rows.add((w, form[w], r, n[w], out[w], n[form[w]] if form[w] else None))
    return rows


def got(df):
    rows = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def texts(seed):
    rnd = random.Random(seed)
    letters = "aabé"
    return [(None if i % 7 == 0 else i // 2, " ".join(
        "".join(rnd.choice(letters) for _ in range(rnd.choice([4, 5, 6, 7]))) for _ in range(60))) for i in range(60)]


@pytest.mark.parametrize("seed,partitions", [(1, 1), (2, 3), (3, 13)])
def test_equals_brute_force(spark, seed, partitions):
    rows = texts(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)  # ranges: nodes across their borders
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got(spelling.group_variants(docs, damage=5)) == brute(brute_words(rows, 5))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_sample_of_documents(spark, sample):
    n = brute_words([(r.doc_id, r.text) for r in sample.collect()])
    # words by their one-deletion variants: a plain dictionary for the larger vocabulary
    rows = got(spelling.group_variants(sample, damage=spelling.DAMAGE))
    assert {r[0]: r[3] for r in rows} == n
    slot = collections.defaultdict(set)
    for w in n:
        slot[w].add(w)
        for i in range(len(w)):
            slot[w[:i] + w[i + 1:]].add(w)
    mates = collections.defaultdict(set)
    for ws in slot.values():
        for a in ws:
            mates[a].update(b for b in ws if near(a, b))
    assert {r[0]: r[4] for r in rows} == {w: len(mates[w]) for w in n}
    assert any(r[1] for r in rows)


def test_edge_rows(spark, edge, empty):
    want = brute(brute_words([(r.doc_id, r.text) for r in edge.collect()], None, 1, 1))
    assert got(spelling.group_variants(edge, 1, 1)) == want
    assert spelling.group_variants(empty).count() == 0


def test_other_letters_part_words(spark):
    # Kelvin and dotted capital I lower to ASCII letters elsewhere; here they part words
    rows = [(1, "\u0130stanbul \u212aelvins \u212bngstr\u00f6m ÉCLAIR éclair ÉCLAIR " * 3), (2, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(spelling.group_variants(docs)) == brute(brute_words(rows, None))
    assert {r[0] for r in got(spelling.group_variants(docs))} >= {"stanbul", "elvins", "Éclair", "éclair"}


def test_chain_of_forms(spark):
    rows = [(1, " ".join(["abcde"] * 3 + ["abcdef"] * 6 + ["abcdefg"] * 12 + ["abcdefgh"] * 24 + ["zzzzz"] * 3))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r[0]: r for r in got(spelling.group_variants(docs))}
    assert out["abcde"][1:3] == ("abcdef", "abcdefgh")
    assert out["zzzzz"] == ("zzzzz", None, "zzzzz", 3, 0, None)


def test_long_words_stay_whole(spark):
    word = "ab" * 20_000
    docs = spark.createDataFrame([(1, f"{word} {word}c {word} {word} {word}c {word}c")], "doc_id long, text string")
    out = got(spelling.group_variants(docs))
    assert {(len(r[0]), r[4]) for r in out} == {(40_000, 1), (40_001, 1)}


def test_hot_text(spark):
    docs = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("abcde abcdf").alias("text"))
    assert got(spelling.group_variants(docs)) == {("abcde", None, "abcde", 3000, 1, None),
                                                  ("abcdf", None, "abcdf", 3000, 1, None)}
