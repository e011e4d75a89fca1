"""Language ID by Bayesian evidence fusion.

Method.  Posterior of a language = text likelihood x declared language x host
prior, normalised.

* Text: trigrams of letters (UTF-8 bytes, lower case, hashed into ``BUCKETS``)
  under one model per declared language (a two-letter code of ``CODES``),
  however few rows declare it, fitted on a bounded sample of them: about
  ``SAMPLE`` distinct rows, drawn by a 63-bit hash of key, text and host.  A model is smoothed by ``POOLED`` trigrams of
  the pooled distribution (all languages alike), so a thin one leans on it.
  One text gives a model ``ONE_TEXT`` trigrams at most.  Trigrams overlap, so
  a judged text counts as ``EVIDENCE`` trigrams at most.  The class ``und``
  (no known language) spreads evenly.
* Declared language (markup): how often texts that read as language l declare
  d, by grouped aggregation over all rows, smoothed by d's overall share.
* Host: how often the host's other texts read as l, smoothed by the host's
  domain, that by the address suffix, that by the corpus: a chain of grouped
  aggregations.

A row is rejected (``kept`` false) if ``und`` wins, if no language reaches
``CONFIDENCE``, or if the winner is not among the accepted languages.

Scale.  One scan of the texts writes a few numbers per row; counts are
pre-aggregated; host priors join by key (never broadcast by hand): rows
without a host skip the join, and of a hot host only the rows' side is large,
which adaptive execution splits.  The driver holds only the model: at most
``len(CODES)`` languages x buckets.

Defined cases: a null or empty text has no text evidence, the rest decides; a
null declared language or host gives no evidence, nor does a declared tag that
is no code of the list; without any labelled row
there is no model and nothing is rejected (language null); repeated rows are
rows; an empty table gives an empty result; other columns are carried along
whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.llm.common import ROW, ensure_python_package, keep_row, query, table, write_table

BUCKETS = 1 << 14
SAMPLE = 1500            # labelled rows per language that the text model is fitted on, about
POOLED = 8192            # trigrams of the pooled distribution that smooth each language's own
ONE_TEXT = 1000          # trigrams that a text gives a model at most
EVIDENCE = 60.0          # trigrams that a text counts as at most
CONFIDENCE = 0.5
SMOOTH = 5.0             # rows by which a level of the host chain trusts the one above
UND = "und"
# The two-letter language codes of ISO 639-1.
CODES = ("aa ab ae af ak am an ar as av ay az ba be bg bh bi bm bn bo br bs ca ce ch co cr cs cu cv cy da de dv dz ee el "
         "en eo es et eu fa ff fi fj fo fr fy ga gd gl gn gu gv ha he hi ho hr ht hu hy hz ia id ie ig ii ik io is it iu "
         "ja jv ka kg ki kj kk kl km kn ko kr ks ku kv kw ky la lb lg li ln lo lt lu lv mg mh mi mk ml mn mr ms mt my na "
         "nb nd ne ng nl nn no nr nv ny oc oj om or os pa pi pl ps pt qu rm rn ro ru rw sa sc sd se sg si sk sl sm sn so "
         "sq sr ss st su sv sw ta te tg th ti tk tl tn to tr ts tt tw ty ug uk ur uz ve vi vo wa wo xh yi yo za zh zu").split()
RARE = 0.1               # share of a model that spreads evenly, for what it never met
# letters lower-cased, other ASCII blank: digits and signs tell no language
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


@dataclass(frozen=True)
class TextModel:
    languages: tuple[str, ...]      # without ``und``
    log_p: np.ndarray               # (languages + und, BUCKETS), float32

    @property
    def classes(self) -> tuple[str, ...]:
        return (*self.languages, UND)


def trigrams(text: bytes) -> np.ndarray:
    """Bucket of every trigram of the words of a UTF-8 text."""
    words = text.translate(_LETTERS).split()
    b = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    if not words or len(b) < 3:
        return np.empty(0, np.uint32)
    x = b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)
    return (x * np.uint32(0x9E3779B1)) >> np.uint32(18)


def primary(tag: Column) -> Column:
    """``en`` of ``en-GB``; null if there is none, or none of ``CODES``."""
    tag = F.lower(F.regexp_extract(F.coalesce(tag, F.lit("")), r"^\s*([A-Za-z]{2,8})", 1))
    return F.when(tag.isin(CODES), tag)


DRAWN = (1 << 63) - 1


def share(sample: int, n: int) -> int:
    """Hashes up to this one of 0 to ``DRAWN`` are drawn: ``sample`` of ``n`` rows."""
    return DRAWN if n <= sample else DRAWN * sample // n


def drawn(rows: DataFrame, counts: dict[str, int], sample: int) -> DataFrame:
    """declared, text: about ``sample`` distinct rows of each language.  Rows
    of one key, or of none, differ by their texts."""
    most = F.element_at(F.create_map(*[F.lit(x) for lang, n in sorted(counts.items()) for x in (
        lang, share(sample, n))]), F.col("declared"))
    lot = F.xxhash64("key", "text", "host").bitwiseAND(F.lit(DRAWN))
    return (rows.where("text IS NOT NULL").withColumn("lot", lot).where(F.col("lot") <= most)
            .groupBy("declared", "lot").agg(F.first("text").alias("text")).select("declared", "text"))


def fit(rows: DataFrame, sample: int = SAMPLE) -> TextModel | None:
    """Text model from rows (key, text, declared, host); about ``sample`` rows
    per language, chosen by hash, are read."""
    ensure_python_package(rows.sparkSession)
    counts = {r["declared"]: r["n"] for r in rows.where("declared IS NOT NULL AND text IS NOT NULL")
              .groupBy("declared").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = tuple(sorted(set(counts) - {UND}))
    if not languages:
        return None
    chosen = drawn(rows, {lang: counts[lang] for lang in languages}, sample)
    place = {lang: k for k, lang in enumerate(languages)}

    def count(batches):
        total = np.zeros((len(languages), BUCKETS), np.int64)
        for b in batches:
            for lang, text in zip(b.column("declared").to_pylist(), b.column("text").cast(pa.binary())):
                grams = trigrams(text.as_buffer().to_pybytes())
                # in 1024ths: whole numbers add up alike in any order
                total[place[lang]] += np.bincount(grams, minlength=BUCKETS) * (
                    1024 * min(len(grams), ONE_TEXT) // max(1, len(grams)) or 1)
        at = np.argwhere(total)
        yield pa.RecordBatch.from_arrays([pa.array(at[:, 0], pa.int32()), pa.array(at[:, 1], pa.int32()),
                                          pa.array(total[total > 0], pa.int64())], names=["lang", "bucket", "n"])

    found = (chosen.mapInArrow(count, "lang int, bucket int, n long").groupBy("lang", "bucket")
             .agg(F.sum("n").alias("n")).collect())  # languages x BUCKETS at most
    n = np.zeros((len(languages), BUCKETS))
    for lang, bucket, k in found:
        n[lang, bucket] = k / 1024
    own = n.sum(axis=1, keepdims=True)
    if not own.any():
        return None     # labelled texts without a trigram
    n += POOLED * (n / np.maximum(own, 1.0)).sum(axis=0) / np.count_nonzero(own)
    log_p = np.log((1 - RARE) * n / n.sum(axis=1, keepdims=True) + RARE / BUCKETS)
    und = np.full((1, BUCKETS), -np.log(BUCKETS))
    return TextModel(languages, np.concatenate([log_p, und]).astype(np.float32))


def text_evidence(rows: DataFrame, model: TextModel) -> DataFrame:
    """Adds ``ll`` (tempered log likelihood per class) and ``vote`` (the best
    class by text alone) to rows (payload, text); the text itself goes."""
    log_p = model.log_p
    schema = rows.drop("text").schema

    def run(batches):
        for b in batches:
            ll = np.zeros((b.num_rows, len(log_p)))
            for k, text in enumerate(b.column("text").cast(pa.binary())):
                grams = trigrams(text.as_buffer().to_pybytes()) if text.is_valid else ()
                if len(grams):
                    ll[k] = log_p[:, grams].mean(axis=1, dtype=np.float64) * min(len(grams), EVIDENCE)
            best = np.where((ll == 0).all(axis=1), -1, ll.argmax(axis=1))
            keep = [c for c in b.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in keep), pa.array(list(ll), pa.list_(pa.float64())), pa.array(best, pa.int32())],
                names=[*keep, "ll", "vote"])

    from pyspark.sql import types as T
    out = T.StructType([*schema.fields, T.StructField("ll", T.ArrayType(T.DoubleType())),
                        T.StructField("vote", T.IntegerType())])
    return rows.mapInArrow(run, out)


def _counts(k: int) -> list[Column]:
    return [F.sum(F.when(F.col("vote") == i, 1.0).otherwise(0.0)).alias(f"n{i}") for i in range(k)]


def _array(k: int) -> Column:
    return F.array(*[F.col(f"n{i}") for i in range(k)])


def _smoothed(own: Column, above: Column) -> Column:
    """(own counts + SMOOTH x the distribution above), as a distribution."""
    total = F.aggregate(own, F.lit(0.0), lambda a, x: a + x) + SMOOTH
    return F.zip_with(own, above, lambda n, p: (n + SMOOTH * p) / total)


def host_priors(votes: DataFrame, k: int, corpus: list[float]) -> DataFrame:
    """host_key, counts, above: the host's votes and its domain's distribution."""
    v = votes.where("host_key IS NOT NULL AND vote >= 0")
    hosts = v.groupBy("host_key", "domain", "suffix").agg(*_counts(k))
    sums = [F.sum(f"n{i}").alias(f"n{i}") for i in range(k)]
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums)
    top = F.array(*[F.lit(p) for p in corpus])
    suffixes = suffixes.select(F.col("suffix").alias("of"), _smoothed(_array(k), top).alias("p"))
    domains = (domains.join(suffixes, domains["suffix"].eqNullSafe(suffixes["of"]))
               .select(F.col("domain").alias("of"), _smoothed(_array(k), F.col("p")).alias("above")))
    return (hosts.join(domains, hosts["domain"].eqNullSafe(domains["of"]))
            .select(F.col("host_key").alias("of"), _array(k).alias("counts"), "above"))


def identify(rows: DataFrame, model: TextModel | None = None, accepted: tuple[str, ...] | None = None,
             confidence: float = CONFIDENCE) -> DataFrame:
    """``rows``: key, text, declared (primary tag), host, and any payload
    column named ``ROW`` or ``key``.  Adds language, posterior, kept."""
    model = model or fit(rows)
    if model is None:
        return rows.drop("text", "host").withColumn("language", F.lit(None).cast("string")).withColumn(
            "posterior", F.lit(None).cast("double")).withColumn("kept", F.lit(True))
    classes, k = model.classes, len(model.classes)
    known = F.array_position(F.array(*[F.lit(c) for c in model.languages]), F.col("declared")).cast("int")
    labels = F.split("host_key", r"\.")
    rows = (rows.withColumn("tag", F.coalesce(F.when(known > 0, known - 1), F.when(
                F.col("declared").isNotNull(), F.lit(k)), F.lit(k + 1)))
            .withColumn("host_key", F.lower("host")).drop("host")
            # a host without a dot is its own domain and has no suffix
            .withColumn("suffix", F.when(F.size(labels) > 1, F.element_at(labels, -1)))
            .withColumn("domain", F.when(F.size(labels) > 2, F.array_join(F.slice(labels, -2, 2), "."))
                        .otherwise(F.col("host_key"))))
    ensure_python_package(rows.sparkSession)
    votes = write_table(text_evidence(rows, model), "language-votes")
    seen = {(r["tag"], r["vote"]): r["n"] for r in votes.where("vote >= 0").groupBy("tag", "vote").agg(
        F.count(F.lit(1)).alias("n")).collect()}  # (classes + 2) x classes at most
    total = sum(seen.values())
    per_class = [sum(n for (_, v), n in seen.items() if v == i) for i in range(k)]
    corpus = [(n + 1.0) / (total + k) for n in per_class]
    tags = []
    for tag in range(k + 2):
        share = (sum(n for (t, _), n in seen.items() if t == tag) + 1.0) / (total + k + 2)
        # no declaration says nothing
        tags.append([1.0] * k if tag == k + 1 else
                    [(seen.get((tag, i), 0) + SMOOTH * share) / (per_class[i] + SMOOTH) for i in range(k)])
    declared = F.get(F.array(*[F.array(*[F.lit(p) for p in t]) for t in tags]), F.col("tag"))
    hosts = host_priors(votes, k, corpus)
    empty = F.lit(None).cast("array<double>")
    v = votes.where("host_key IS NOT NULL").join(hosts, F.col("host_key") == F.col("of"), "left").drop("of").unionByName(
        votes.where("host_key IS NULL").withColumns({"counts": empty, "above": empty}))
    # the row's own vote is no evidence about itself
    others = F.transform("counts", lambda n, i: n - F.when(i == F.col("vote"), 1.0).otherwise(0.0))
    prior = F.when(F.col("counts").isNull(), F.array(*[F.lit(p) for p in corpus])).otherwise(
        _smoothed(others, F.col("above")))
    v = v.withColumn("prior", prior).withColumn("said", declared)
    log_odds = F.transform("ll", lambda x, i: x + F.log(F.get("prior", i)) + F.log(F.get("said", i)))
    v = v.withColumn("lo", log_odds).withColumn("best", F.array_max("lo"))
    weight = F.aggregate("lo", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("best")))
    at = F.array_position("lo", F.col("best")).cast("int")
    v = (v.withColumn("language", F.element_at(F.array(*[F.lit(c) for c in classes]), at))
         .withColumn("posterior", F.lit(1.0) / weight))
    fine = (F.col("language") != UND) & (F.col("posterior") >= confidence)
    if accepted is not None:
        fine = fine & F.col("language").isin(*accepted)
    nothing = (F.col("vote") < 0) & (F.col("tag") == k + 1) & F.col("host_key").isNull()
    return v.withColumn("kept", fine | nothing).drop("lo", "best", "prior", "said", "counts", "above", "ll",
                                           "vote", "tag", "host_key", "domain", "suffix")


def document_rows(docs: DataFrame, *payload: Column) -> DataFrame:
    """Rows for ``identify``: ``lang`` is the declared language, ``source`` the host."""
    return docs.select(*payload, F.xxhash64("doc_id").alias("key"), F.col("text").cast("string").alias("text"),
                       primary(F.col("lang")).alias("declared"), F.col("source").alias("host"))


def reject(docs: DataFrame, **options) -> DataFrame:
    """The documents whose language is accepted, columns as before.

    Only narrow rows are judged; the rejected ones, usually few, are then
    taken out by key (96 bits of what the verdict depends on, and the id)."""
    read = [F.col(c) for c in ("doc_id", "text", "lang", "source")]
    bits = [x for c in read for x in (c, c.isNull())]
    key = [F.xxhash64(*bits).alias("__k1"), F.hash(*bits).alias("__k2")]
    found = identify(document_rows(docs, *key), **options)
    gone = write_table(found.where("NOT kept").select("__k1", "__k2").distinct(), "language-rejected")
    whole = docs.select(keep_row(docs), *key).join(gone, ["__k1", "__k2"], "left_anti")
    return whole.select(*[F.col(ROW).getField(c).alias(c) for c in docs.columns])


@query("op7_language_id")
def op7(spark, sf_dir):
    """Language of all ``documents``; those not kept are rejected."""
    docs = table(spark, sf_dir, "documents")
    found = identify(document_rows(docs, F.col("doc_id")))
    return found.select("doc_id", "declared", "language", F.round("posterior", 9).alias("posterior"), "kept")


@query("language_id_pages")
def pages(spark, sf_dir):
    """Language of all ``pages``: markup language, address and host are the
    page's own."""
    p = table(spark, sf_dir, "pages")
    # script and style bodies, then tags
    text = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", " "), r"(?s)<[^>]*>", " ")
    rows = p.select("page_id", F.xxhash64("page_id").alias("key"), text.alias("text"),
                    primary(F.regexp_extract("html", r"(?is)<html\b[^>]*?\blang=[\"']?([A-Za-z-]+)", 1)).alias("declared"),
                    F.try_parse_url("url", F.lit("HOST")).alias("host"))
    return identify(rows).select("page_id", "declared", "language", F.round("posterior", 9).alias("posterior"), "kept")
