"""The language stage cannot lose a language; its posterior against plain Python."""
import collections
import math
import random

import pytest
from pyspark.sql import functions as F

from pitwall.llm import language


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet").cache()


def test_share_at_any_size():
    for n in (1, 1500, 1501, 10**7, 10**10, 10**13, 10**16):
        drawn = (language.share(1500, n) + 1) / (language.DRAWN + 1) * n
        assert abs(drawn - min(n, 1500)) < 1e-3 * min(n, 1500) + n / language.DRAWN
        assert language.share(1500, n) > 0


@pytest.mark.parametrize("doc_id", [None, 7])
def test_null_and_repeated_ids_are_drawn_like_others(spark, docs, doc_id):
    some = docs.withColumn("doc_id", F.when(F.col("lang") == "en", F.lit(doc_id).cast("long")).otherwise(F.col("doc_id")))
    rows = language.document_rows(some, F.col("lang"))
    counts = {r.declared: r.n for r in rows.groupBy("declared").agg(F.count(F.lit(1)).alias("n")).collect()}
    got = {r.declared: r["count"] for r in language.drawn(rows, counts, 40).groupBy("declared").count().collect()}
    assert all(15 <= got[lang] <= 80 for lang in counts)
    found = language.identify(rows, language.fit(rows, 40)).collect()
    for lang in counts:
        own = [r for r in found if r.declared == lang]
        assert sum(r.language == lang and r.kept for r in own) >= 0.97 * len(own), lang
    assert all(r.kept for r in language.identify(rows).collect())


def test_copies_are_drawn_once(spark, docs):
    one = docs.where("lang = 'en' AND length(text) > 500").limit(1)
    many = one.crossJoin(spark.range(2000).select(F.lit(0).alias("z"))).drop("z").unionByName(docs)
    rows = language.document_rows(many, F.col("lang"))
    drawn = language.drawn(rows, {"en": 3000, "de": 100}, 3000)
    assert drawn.where("declared = 'en'").count() <= docs.where("lang = 'en'").count()


def test_tags_that_are_no_codes_make_no_class(spark, docs):
    junk = docs.withColumn("lang", F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("x"), F.chr(97 + F.col("doc_id") % 26),
                                                                          F.lit("q-"), F.col("doc_id"))).otherwise(F.col("lang")))
    rows = language.document_rows(junk, F.col("lang"))
    model = language.fit(rows)
    assert set(model.languages) == {r.lang for r in docs.select("lang").distinct().collect()}
    assert {r.declared for r in rows.select("declared").distinct().collect()} == {None, *model.languages}
    assert all(r.kept for r in language.identify(rows, model).collect())
    assert len(set(language.CODES)) == len(language.CODES) < 200


def plain(rows, model):
    """(language, posterior) of every row, as the docstring has it."""
    k, out = len(model.classes), []
    lls, votes = [], []
    for _, text, _, _ in rows:
        grams = language.trigrams(text.encode()) if text else ()
        ll = [0.0] * k
        if len(grams):
            ll = [sum(float(model.log_p[c][g]) for g in grams) / len(grams) * min(len(grams), language.EVIDENCE) for c in range(k)]
        lls.append(ll)
        votes.append(max(range(k), key=lambda c: ll[c]) if any(ll) else -1)
    tag = [k + 1 if d is None else model.languages.index(d) if d in model.languages else k for _, _, d, _ in rows]
    seen = collections.Counter((t, v) for t, v in zip(tag, votes) if v >= 0)
    total = sum(seen.values())
    of_class = [sum(n for (_, v), n in seen.items() if v == c) for c in range(k)]
    corpus = [(n + 1) / (total + k) for n in of_class]

    def said(t):
        if t == k + 1:
            return [1.0] * k
        share = (sum(n for (x, _), n in seen.items() if x == t) + 1) / (total + k + 2)
        return [(seen[t, c] + language.SMOOTH * share) / (of_class[c] + language.SMOOTH) for c in range(k)]

    def parts(host):
        bits = host.lower().split(".")
        return host.lower(), ".".join(bits[-2:]), bits[-1] if len(bits) > 1 else None

    level = [collections.defaultdict(lambda: [0.0] * k) for _ in range(3)]
    for (_, _, _, host), v in zip(rows, votes):
        if host is not None and v >= 0:
            for table, key in zip(level, parts(host)):
                table[key][v] += 1

    def smooth(own, above):
        return [(n + language.SMOOTH * p) / (sum(own) + language.SMOOTH) for n, p in zip(own, above)]

    for (_, _, _, host), v, ll, t in zip(rows, votes, lls, tag):
        prior = corpus
        if host is not None and parts(host)[0] in level[0]:
            h, d, s = parts(host)
            above = smooth(level[1][d], smooth(level[2][s], corpus))
            prior = smooth([n - (c == v) for c, n in enumerate(level[0][h])], above)
        odds = [x + math.log(p) + math.log(q) for x, p, q in zip(ll, prior, said(t))]
        best = max(odds)
        out.append((model.classes[odds.index(best)], 1 / sum(math.exp(x - best) for x in odds)))
    return out


def test_posterior_equals_plain_python(spark, docs):
    model = language.fit(language.document_rows(docs, F.col("doc_id")), 100)
    rnd = random.Random(8)
    rows = [(k, r.text[:rnd.choice([0, 8, 40, 400])] if rnd.random() < 0.95 else None, rnd.choice([r.lang, "en", "de", None]),
             rnd.choice([None, "a.example.de", "b.example.de", "x.y.org", "Shop.fr", "localhost"]))
            for k, r in enumerate(docs.orderBy("doc_id").limit(250).collect())]
    df = spark.createDataFrame(rows, "key long, text string, declared string, host string").repartition(4)
    got = {r.key: (r.language, r.posterior) for r in language.identify(df, model).collect()}
    for (key, *_), (lang, p) in zip(rows, plain(rows, model)):
        assert got[key][1] == pytest.approx(p, rel=1e-6), key
        assert got[key][0] == lang or p < 0.5 + 1e-6
