"""Line dedup: a deletion-neighbourhood join on words.

Method.  A line is a ``\\n``-separated part of a text with at least one word;
two lines are near if one word inserted, deleted or replaced turns the word
sequence of one into that of the other.  Both then share a variant: the
sequence without the inserted word, or without the replaced one at the same
place.  Every line emits its one-word deletions as hashed keys, equal keys
join, the word sequences of the joined lines are compared, and only the
earliest line, in order of (doc_id, line number), stays.

* Equal lines (same word sequence) collapse to one class first.
* Only classes that can have a partner emit variants: two lines within one
  edit agree in their first or in their last half, so a class whose half keys
  no other class shares is left out.  This loses no pair.
* Keys are aggregated, never expanded to pairs: all lines with one key (the
  sequence without word i) are pairwise near, so the earliest of the key is
  the only partner its other lines need.  A template line with a third of all
  lines costs as much as any other.

A line goes if an earlier near line exists, be that line kept or not.  Lines
of fewer than ``min_words`` words match only exactly.

Defined cases: a null text stays null, an empty one empty; lines without a
word always stay; lines that tie on (doc_id, line number), as repeated rows
have, do not remove each other; null ids come first; every row loses its own
lines only, also where ids are null or repeated (a row's key is its id and a
hash of its text); extra columns are kept;
a document that loses every line stays with what is left ('' or blank lines).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.llm.common import ROW, keep_row, query, table, unpack, words, write_table

MIN_WORDS = 5
PRIME = (1 << 61) - 1      # sums of word codes are kept modulo this


def normal(line: Column) -> Column:
    """The words joined by single blanks; most lines already are."""
    odd = F.lit(False)
    for c in "\t\x0b\x0c\r":
        odd = odd | F.contains(line, F.lit(c))
    odd = odd | F.contains(line, F.lit("  ")) | F.startswith(line, F.lit(" ")) | F.endswith(line, F.lit(" "))
    return F.when(odd, F.array_join(words(line), " ")).otherwise(line)


def text_lines(docs: DataFrame, *payload: Column) -> DataFrame:
    """doc_id, payload, at (line number from 0), line (normal): the lines with a word."""
    own = docs.select("doc_id", *payload, "text")
    names = own.columns[:-1]
    return (own.select(*names, F.posexplode(F.split("text", "\n")).alias("at", "line"))
            .where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
            .select(*names, "at", normal(F.col("line")).alias("line")))


def _class(line: Column) -> Column:
    return F.xxhash64(line)


def half_keys(line: Column) -> Column:
    """Hashes of the first and the last half; both roundings for odd lengths."""
    n = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1
    down, up = F.floor(n / 2).cast("int"), F.ceil(n / 2).cast("int")
    def key(side: str, k: Column) -> Column:
        return F.xxhash64(F.lit(side), k, F.call_function(
            "substring_index", line, F.lit(" "), k if side == "first" else -k))

    return F.when(down == up, F.array(key("first", up), key("last", up))).otherwise(
        F.array(*[key(side, k) for side in ("first", "last") for k in (down, up)]))


def _long_enough(line: Column, min_words: int) -> Column:
    return (F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit("")))
            >= min_words - 1)


def _follow(a: Column, b: Column) -> Column:
    """Code of two neighbours; null stands for the line's edge."""
    return F.pmod(F.xxhash64(a, F.lit("|"), b), F.lit(PRIME))


def _pairs(w: Column) -> Column:
    """Codes of the neighbours before each word, then of the last and the edge."""
    n = F.size(w)
    return F.transform(F.sequence(F.lit(0), n), lambda i: _follow(F.get(w, i - 1), F.get(w, i)))


def _total(codes: Column) -> Column:
    return F.aggregate(codes, F.lit(0).cast("long"), lambda s, x: (s + x) % F.lit(PRIME))


def _variants(line: Column) -> Column:
    """Array of (i, kept, follows), one per word i that may be left out.

    ``kept`` codes the words at their places, all but word i; ``follows`` the
    neighbours that are left (equal sequences have equal sums; the few other
    sequences with equal sums fail the comparison of the words)."""
    def coded(w: Column) -> Column:
        return F.struct(w.alias("w"), F.transform(w, lambda x, i: F.xxhash64(x, i)).alias("g"),
                        _pairs(w).alias("f"))

    def summed(c: Column) -> Column:
        return F.struct(c.alias("c"), _total(c["f"]).alias("all"), F.aggregate(
            c["g"], F.lit(0).cast("long"), lambda s, x: s.bitwiseXOR(x)).alias("places"))

    def of(t: Column) -> Column:
        w, f = t["c"]["w"], t["c"]["f"]
        return F.transform(t["c"]["g"], lambda g, i: F.struct(
            i.alias("i"), t["places"].bitwiseXOR(g).alias("kept"),
            ((t["all"] + 2 * F.lit(PRIME) - F.get(f, i) - F.get(f, i + 1)
              + _follow(F.get(w, i - 1), F.get(w, i + 1))) % F.lit(PRIME)).alias("follows")))

    step = F.array(F.split(line, " "))
    for body in (coded, summed, of):    # each value is computed once
        step = F.transform(step, body)
    return F.element_at(step, 1)


def within_one_edit(a: Column, b: Column) -> Column:
    """Whether the word arrays are one insertion, deletion or replacement apart."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x.eqNullSafe(y), 0).otherwise(1)),
                       F.lit(0), lambda s, x: s + x)
    short, long = F.when(F.size(a) < F.size(b), a).otherwise(b), F.when(F.size(a) < F.size(b), b).otherwise(a)
    differs = F.zip_with(short, long, lambda x, y: ~x.eqNullSafe(y))
    cut = F.coalesce(F.array_position(differs, True).cast("int"), F.size(long))  # 1-based
    inserted = F.concat(F.slice(long, F.lit(1), cut - 1), F.slice(long, cut + 1, F.size(long)))
    return F.when(F.size(a) == F.size(b), same <= 1).when(
        F.size(long) == F.size(short) + 1, inserted == short).otherwise(False)


def line_classes(docs: DataFrame, min_words: int) -> tuple[DataFrame, DataFrame]:
    """(c, doc_id, of, at) of every line (``of``: hash of its row's text), and
    (c, pos, n, ks) of every class: its earliest line, its size, and its half
    keys if it is long enough."""
    lines = text_lines(docs, F.xxhash64("text").alias("of"))
    tags = write_table(lines.select(_class(F.col("line")).alias("c"), "doc_id", "of", "at", F.when(
        _long_enough(F.col("line"), min_words), half_keys(F.col("line"))).alias("ks")), "line-tags")
    classes = tags.groupBy("c").agg(F.min(F.struct("doc_id", "at")).alias("pos"),
                                    F.count(F.lit(1)).alias("n"), F.first("ks").alias("ks"))
    return tags.drop("ks"), write_table(classes, "line-classes")


def candidates(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """c, pos, line: the classes that share a half key with another class."""
    keys = classes.select("c", F.explode("ks").alias("k"))
    shared = (keys.groupBy("k").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
              .where("lo != hi").select("k"))
    can = keys.join(shared, "k", "left_semi").select("c").distinct()
    places = classes.join(can, "c", "left_semi").select("c", "pos")
    lines = text_lines(docs).select(_class(F.col("line")).alias("c"),
                                    F.struct("doc_id", "at").alias("pos"), "line")
    return write_table(lines.join(places, ["c", "pos"], "left_semi").distinct(), "line-candidates")


def near_classes(some: DataFrame) -> DataFrame:
    """c, keeper: classes with an earlier near class, and one such class."""
    n = F.size(F.split("line", " "))
    v = some.select("c", n.alias("n"), F.explode(_variants(F.col("line"))).alias("x"))
    v = write_table(v.select("c", F.xxhash64("x.follows", F.col("n") - 1).alias("without"),
                             F.xxhash64("x.kept", "n", "x.i").alias("at_place")), "line-variants")
    place = some.select("c", "pos")
    # replaced: same sequence without the word at the same place; the earliest
    # class of such a key is near to all its others
    shared = (v.groupBy("at_place").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
              .where("lo != hi").select("at_place"))
    swapped = write_table(v.select("c", "at_place").join(shared, "at_place", "left_semi")
                          .join(place, "c"), "line-swaps")
    least = swapped.groupBy("at_place").agg(F.min(F.struct("pos", "c")).alias("m"))
    swapped = swapped.join(least, "at_place").select("c", "pos", F.col("m.c").alias("c2"),
                                                     F.col("m.pos").alias("pos2"))
    # inserted or deleted: the sequence without a word is the other line
    follows = _total(F.element_at(F.transform(F.array(F.split("line", " ")), _pairs), 1))
    full = some.select(F.col("c").alias("c2"), F.col("pos").alias("pos2"),
                       F.xxhash64(follows, n).alias("without"))
    grown = (v.select("c", "without").join(full, "without").distinct().join(place, "c")
             .select("c", "pos", "c2", "pos2"))
    later = F.when(F.col("pos") > F.col("pos2"), F.struct("c", F.col("c2").alias("keeper"))).otherwise(
        F.struct(F.col("c2").alias("c"), F.col("c").alias("keeper")))
    pairs = swapped.union(grown).where("pos != pos2").select(later.alias("p")).select("p.*").distinct()
    text = some.select("c", F.split("line", " ").alias("w"))
    checked = (pairs.join(text, "c").join(text.select(F.col("c").alias("keeper"), F.col("w").alias("w2")), "keeper")
               .where(within_one_edit(F.col("w"), F.col("w2"))))
    return checked.groupBy("c").agg(F.min("keeper").alias("keeper"))


def dropped_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, of, at, near: the lines that go; ``near`` if no equal line is earlier."""
    tags, classes = line_classes(docs, min_words)
    near = near_classes(candidates(docs, classes))
    verdict = (classes.select("c", "pos", "n").join(near, "c", "left")
               .where("n > 1 OR keeper IS NOT NULL")
               .select("c", "pos", F.col("keeper").isNotNull().alias("near")))
    pos = F.struct("doc_id", "at")
    return (tags.join(verdict, "c").where(F.col("near") | (pos != F.col("pos")))
            .select("doc_id", "of", "at", (pos == F.col("pos")).alias("near")))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents without their repeated lines (``text`` and, if there is
    one, ``n_chars`` change), plus ``__dropped`` and ``__near`` counts."""
    gone = (dropped_lines(docs.select("doc_id", "text"), min_words)
            .groupBy("doc_id", "of").agg(F.collect_set("at").alias("ats"), F.size(F.collect_set(
                F.when(F.col("near"), F.col("at")))).cast("long").alias("near")))
    gone = gone.select(F.col("doc_id").alias("__id"), F.col("of").alias("__of"), "ats", "near")
    d = docs.select(keep_row(docs), F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__of"),
                    F.col("text").alias("__text"))
    d = d.join(gone, d["__id"].eqNullSafe(gone["__id"]) & (d["__of"] == gone["__of"]), "left")
    left = F.array_join(F.filter(F.split("__text", "\n"), lambda x, i: ~F.array_contains(
        F.col("ats"), i)), "\n")
    d = d.withColumn("__new", F.when(F.col("ats").isNull(), F.col("__text")).otherwise(left))
    new = {"text": F.col("__new")} | (
        {"n_chars": F.length("__new").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return d.select(F.struct(*[(new[c] if c in new else F.col(ROW).getField(c)).alias(c)
                               for c in docs.columns]).alias(ROW),
                    F.coalesce(F.size("ats"), F.lit(0)).alias("__dropped"),
                    F.coalesce("near", F.lit(0)).alias("__near"))


def strip(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents without their repeated lines, columns as before."""
    return unpack(dedup_lines(docs, min_words), docs)


OP3_SQL = r"""
WITH l AS (
  SELECT doc_id, ln - 1 AS ln, line, list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents), LATERAL (
    SELECT unnest(ls) AS line, generate_subscripts(ls, 1) AS ln)),
k AS (SELECT * FROM l WHERE len(w) > 0),
c AS (SELECT w, min((doc_id, ln)) AS pos, count(*) AS n FROM k GROUP BY w),
b AS (SELECT w, pos FROM c WHERE len(w) >= 5),
v AS (SELECT w, pos, i, w[:i - 1] || w[i + 1:] AS x FROM b, LATERAL (SELECT unnest(range(1, len(w) + 1)) AS i)),
e AS (
  SELECT p.w FROM v p JOIN v q ON p.x = q.x AND p.i = q.i WHERE q.pos < p.pos
  UNION SELECT p.w FROM v p JOIN b q ON p.x = q.w WHERE q.pos < p.pos
  UNION SELECT q.w FROM v p JOIN b q ON p.x = q.w WHERE p.pos < q.pos),
g AS (SELECT k.doc_id, k.ln, (k.doc_id, k.ln) = c.pos AS near FROM k JOIN c ON k.w = c.w
      LEFT JOIN (SELECT DISTINCT w FROM e) e ON e.w = k.w WHERE e.w IS NOT NULL OR (k.doc_id, k.ln) <> c.pos)
SELECT d.doc_id, coalesce(m.n, 0)::BIGINT AS n_lines, coalesce(h.n, 0)::BIGINT AS n_dropped, coalesce(h.near, 0)::BIGINT AS n_near,
  sha256(coalesce(t.text, '')) AS text_sha256
FROM documents d
LEFT JOIN (SELECT doc_id, count(*) AS n FROM k GROUP BY 1) m USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n, count(*) FILTER (near) AS near FROM g GROUP BY 1) h USING (doc_id)
LEFT JOIN (SELECT doc_id, string_agg(line, chr(10) ORDER BY ln) AS text FROM l ANTI JOIN g USING (doc_id, ln) GROUP BY 1) t USING (doc_id)
"""


@query("op3_line_dedup", OP3_SQL)
def op3(spark, sf_dir):
    """Per document: its lines, those that go (in all, near), what stays."""
    d = dedup_lines(table(spark, sf_dir, "documents"))
    text = F.coalesce(F.col(ROW)["text"], F.lit(""))
    kept = F.size(F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    return d.select(F.col(ROW)["doc_id"].alias("doc_id"),
                    (kept + F.col("__dropped")).cast("long").alias("n_lines"),
                    F.col("__dropped").cast("long").alias("n_dropped"), F.col("__near").alias("n_near"),
                    F.sha2(text, 256).alias("text_sha256"))
