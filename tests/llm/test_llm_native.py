"""Quality rules, sharding, line dedup and mixing against brute force."""
import collections
import hashlib
import re
import zlib

import pytest
from pyspark.sql import functions as F

from pitwall.llm import lines, mixing, quality, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(t):
    return WORD.findall(t or "")


def counts(t):
    w = words(t)
    grams = list(zip(w, w[1:], w[2:]))
    seen = collections.Counter(grams)
    cover = {i + d for i, g in enumerate(grams) if seen[g] > 1 for d in range(3)}
    ls = [x for x in (t or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(ls) - len(set(ls)), len(cover))


@pytest.mark.parametrize("which", ["edge", "sample"])
def test_quality_counts(which, request):
    docs = request.getfixturevalue(which)
    rows = quality.score(docs).collect()
    want = collections.Counter((r.doc_id, *counts(r.text)) for r in docs.collect())
    got = collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
                              for r in rows)
    assert got == want
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert 0.0 <= r.quality <= 1.0 and r.kept == (not r.base_failed and r.quality >= 0.5)


def test_quality_em_matches_plain_python(spark):
    import math
    import random
    rnd = random.Random(4)
    rows = []
    for _ in range(3000):
        good = rnd.random() < 0.85
        vote = {r: 0 for r in quality.RULES}
        vote["plain_words"] = (1 if good else -1) if rnd.random() < 0.9 else 0
        for r in ("symbols", "capitals", "repeats"):
            vote[r] = -1 if rnd.random() < (0.05 if good else 0.6) else 0
        rows.append(tuple(vote.values()))
    votes = spark.createDataFrame(rows, ", ".join(f"{r} int" for r in quality.RULES))
    accuracy, prior = quality.estimate(votes)
    rates, p0 = dict.fromkeys(quality.RULES, quality.ACCURACY), quality.PRIOR_GOOD
    for _ in range(quality.ITERATIONS):
        post = []
        for r in rows:
            z = math.log(p0 / (1 - p0)) + sum(v * math.log(rates[n] / (1 - rates[n])) for n, v in zip(quality.RULES, r))
            post.append(1 / (1 + math.exp(-z)))
        p0 = min(max(sum(post) / len(post), 0.5), 0.999)
        new = {}
        for k, n in enumerate(quality.RULES):
            right = sum(p if r[k] == 1 else 1 - p if r[k] == -1 else 0 for r, p in zip(rows, post))
            cast = sum(r[k] != 0 for r in rows)
            new[n] = min(max((right + quality.SMOOTHING * quality.ACCURACY) / (cast + quality.SMOOTHING), 0.5), 0.99)
        moved, rates = max(abs(new[n] - rates[n]) for n in rates), new
        if moved <= quality.TOLERANCE:
            break
    assert abs(prior - p0) < 1e-6
    assert all(abs(accuracy[n] - rates[n]) < 1e-6 for n in rates)
    assert accuracy["plain_words"] > 0.9


def test_quality_finds_labelled_junk(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    label = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = [r for r in quality.score(docs).collect() if r.doc_id in label and not r.base_failed]
    clean = [r.kept for r in rows if label[r.doc_id] == 1]
    junk = [r.kept for r in rows if label[r.doc_id] == 0]
    assert sum(clean) >= 0.99 * len(clean) and sum(junk) <= 0.05 * len(junk)


def brute_capacity(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        mid, n, cur = (low + high) // 2, 1, 0
        for x in sizes:
            if cur + x > mid:
                n, cur = n + 1, 0
            cur += x
        low, high = (low, mid) if n <= shards else (mid + 1, high)
    return low


def check_shards(docs, rows, shards):
    text = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = collections.Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in text)
    assert collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
    per = collections.defaultdict(list)
    for r in rows:
        assert r.law == "bytes" and 0 <= r.shard < shards and r.grown_shard is None
        per[r.shard].append(r)
    for v in per.values():
        assert sorted(r.slot for r in v) == list(range(len(v)))
    groups = collections.Counter()
    for _, t in text:
        groups["g" if t is None else hashlib.sha256(t.encode()).hexdigest()] += len((t or "").encode()) + 1
    left, alone = sum(groups.values()), []
    for g, b in sorted(groups.items(), key=lambda x: (-x[1], x[0])):
        if b * shards > sum(groups.values()) and shards - len(alone) > 1 and b * (shards - len(alone)) > left:
            alone.append(g)
            left -= b
    rest = [groups[g] for g in sorted(groups) if g not in alone]
    size = {k: sum(r["size"] for r in v) for k, v in per.items()}
    if rest:
        assert max(size.get(k, 0) for k in range(len(alone), shards)) == brute_capacity(rest, shards - len(alone))
    where = collections.defaultdict(set)
    for r in rows:
        where[r["size"], r.text_crc32].add(r.shard)
    assert all(len(s) == 1 for (n, _), s in where.items() if n > 1)


@pytest.mark.parametrize("which,shards", [("edge", 4), ("sample", 16), ("sample", 3)])
def test_sharding(which, shards, request):
    docs = request.getfixturevalue(which)
    check_shards(docs, sharding.shard(docs, shards).collect(), shards)


def test_sharding_many_small_groups(spark, monkeypatch):
    """Few marks: the optimum is still exact, over several rounds."""
    monkeypatch.setattr(sharding, "MARKS", 8)
    monkeypatch.setattr(sharding, "CHUNK_HEX", 1)
    docs = spark.range(3000).selectExpr("id AS doc_id", "repeat(string(id % 2500), int(1 + id % 13)) AS text")
    check_shards(docs, sharding.shard(docs, 16).collect(), 16)


def near(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    s, t = sorted((a, b), key=len)
    return any(t[:i] + t[i + 1:] == s for i in range(len(t)))


def brute_lines(rows, min_words=5):
    """doc index -> lines that go."""
    key = lambda i: (i is not None, i)
    all_lines = [((key(i), k), tuple(words(x)), n) for n, (i, t) in enumerate(rows)
                 for k, x in enumerate((t or "").split("\n")) if t is not None and words(x)]
    first = {}
    for pos, w, _ in all_lines:
        first[w] = min(first.get(w, pos), pos)
    long = [w for w in first if len(w) >= min_words]
    drop = {w for w in long for v in long if first[v] < first[w] and near(w, v)}
    gone = collections.defaultdict(set)
    for pos, w, n in all_lines:
        if w in drop or pos != first[w]:
            gone[n].add(pos[1])
    return gone


def check_lines(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    gone = brute_lines(rows)
    want = collections.Counter(
        (i, t if t is None or not gone[n] else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[n]))
        for n, (i, t) in enumerate(rows))
    got = lines.strip(docs)
    assert got.columns == docs.columns
    assert collections.Counter((r.doc_id, r.text) for r in got.collect()) == want
    return got


def test_lines_edge(edge):
    got = check_lines(edge)
    left = collections.Counter((r["__row"], r["size"], r["c"], r["__id"], r["at"]) for r in got.collect())
    assert left == collections.Counter((r["__row"], r["size"], r["c"], r["__id"], r["at"]) for r in edge.collect())
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got.collect())


def test_lines_of_null_and_repeated_ids(spark):
    common, near_by = "a line that stands in many texts", "a line that stands in several texts"
    rows = [(None, f"first alone\n{common}\nthird alone"), (None, f"unlike first\n{near_by}\n{common}"),
            (None, "quite other\nsecond of its own here now\nand a third line"), (None, f"{common}\nnothing else"),
            (None, f"{common}\nnothing else"), (None, None), (None, ""),
            (4, f"{near_by}\nfour stays here"), (4, "four stays here\nand four has another text"),
            (4, "four stays here\nand four has another text"), (7, f"seven\n{common}\nfour stays here")]
    got = check_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert (None, rows[2][1]) in {(r.doc_id, r.text) for r in got.collect()}


def test_lines_edits(spark):
    import random
    rnd = random.Random(3)
    base = [[rnd.choice("abcdefg") for _ in range(rnd.randint(3, 9))] for _ in range(60)]
    rows = []
    for i in range(150):
        part = []
        for _ in range(rnd.randint(0, 4)):
            w = list(rnd.choice(base))
            for _ in range(rnd.choice([0, 1, 1, 2])):
                k, what = rnd.randrange(len(w) + 1), rnd.random()
                w[k:k + (what < 0.66)] = [rnd.choice("abxyz")] if what > 0.33 else []
            part.append(rnd.choice([" ", " ", "\t", "  "]).join(w))
        rows.append((i, "\n".join(part)))
    check_lines(spark.createDataFrame(rows, "doc_id long, text string"))


def brute_mix(rows):
    total = collections.defaultdict(int)
    for _, s, n in rows:
        total[s] += n
    order = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: float((k % 3) + 1) for k, s in enumerate(order)}
    target, left, free = {}, float(sum(total.values())), set(order)
    while free:
        each = left / sum(weight[s] for s in free)
        over = {s for s in free if each * weight[s] > 3 * total[s]}
        if not over:
            target |= {s: each * weight[s] for s in free}
            break
        for s in over:
            target[s] = 3.0 * total[s]
            left -= target[s]
        free -= over
    return total, target


@pytest.mark.parametrize("which", ["edge", "sample"])
def test_mixing(which, request):
    docs = request.getfixturevalue(which)
    rows = [(r.doc_id, r.source, len(words(r.text))) for r in docs.collect()]
    total, target = brute_mix(rows)
    got = mixing.plan_mix(docs).collect()
    assert len(got) == len(rows)
    by_size = collections.defaultdict(list)
    for r in got:
        assert 0 <= r.taken <= 3 * r["size"] and r.taken == r["size"] * r.copies
        by_size[r.source_size, round(r.target, 6)].append(r)
    for s in total:
        mine = by_size[total[s], round(target[s], 6)]
        assert mine
        if len([t for t in total if total[t] == total[s]]) == 1:
            largest = max(r["size"] for r in mine)
            assert abs(sum(r.taken for r in mine) - target[s]) <= largest / 2 + 1e-6


def test_mix_rows(edge):
    plan = mixing.plan_mix(edge).collect()
    got = mixing.mix(edge, num_partitions=4)
    assert got.columns == edge.columns
    want = collections.Counter()
    for r in plan:
        want[r.doc_id] += r.copies
    have = collections.Counter(r.doc_id for r in got.collect())
    assert have == +want
    again = mixing.mix(edge.repartition(5), num_partitions=4)
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in again.collect()]


def test_mix_positions(spark):
    rows = [(i, s, "w " * n) for s, n in (("a", 3), ("b", 1), ("c", 2), ("d", 1)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    total, target = brute_mix([(i, s, len(words(t))) for i, s, t in rows])
    whole = sum(target.values())

    def area(knots, t):  # trapezoids up to t, of all of them
        def upto(t):
            parts = [(t0, min(t1, t), w0, w0 + (w1 - w0) * (min(t1, t) - t0) / (t1 - t0))
                     for (t0, w0), (t1, w1) in zip(knots, knots[1:]) if t > t0]
            return sum((b - a) * (x + y) / 2 for a, b, x, y in parts)
        return upto(t) / upto(1.0)

    got = mixing.plan_mix(docs).where("copies > 0").collect()
    assert got
    for r in got:
        due = sum(target[s] * area(mixing.SCHEDULES[i % 3], r.first_time) for i, s in enumerate(sorted(target)))
        assert abs(r.first_position - due) < 1e-5 * whole
    # equal spans of positions hold equal numbers of words
    parts = mixing.mix(docs, num_partitions=4).select(F.spark_partition_id().alias("p"), F.size(F.split(F.trim("text"), " ")).alias("n"))
    taken = [r.n for r in parts.groupBy("p").agg(F.sum("n").alias("n")).collect()]
    assert len(taken) == 4 and max(taken) - min(taken) <= 0.02 * sum(taken)


def test_schedules(spark):
    row = spark.range(1001).select((F.col("id") / 1000).alias("t"))
    for knots in (*mixing.SCHEDULES, ((0.0, 0.0), (0.4, 0.0), (1.0, 3.0))):
        r = row.withColumn("y", mixing.integral(knots, F.col("t"))).withColumn("b", mixing.inverse(knots, F.col("y")))
        r = r.withColumn("z", mixing.integral(knots, F.col("b")))
        assert r.agg(F.max(F.abs(F.col("z") - F.col("y")))).first()[0] < 1e-9
        assert abs(r.where("t = 1").first().y - 1.0) < 1e-9
    with pytest.raises(ValueError):
        mixing._segments(((0.0, 0.0), (1.0, 0.0)))


def test_empty_tables(empty):
    assert quality.score(empty).count() == 0
    assert sharding.shard(empty).count() == 0
    assert lines.strip(empty).count() == 0
    assert mixing.plan_mix(empty).count() == 0 and mixing.mix(empty).count() == 0
