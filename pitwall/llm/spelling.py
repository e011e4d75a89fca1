"""Spelling variant grouping: a trie-node pair dictionary.

Method.  The distinct words, sorted, are a trie whose nodes (prefixes) get
integer numbers; the reversed words, sorted, number the suffixes likewise.
Leaving out the code point at place i of a word gives the integer pair
(node of the prefix before i, node of the suffix after i).  Two words that
share such a pair differ by one replaced code point; a word whose own split
(prefix node, suffix node) at some place equals such a pair of a longer word
differs from it by one inserted code point.  Equal pairs are found by
grouping, so neighbours are exact and no string is compared.

Numbering.  Words are range-sorted; a task numbers the nodes of its range
along the sorted words by their common prefix with the word before.  Only the
prefixes that a range's first word shares with the word before it belong to
an earlier range: their numbers are replaced by those of the owner, found
from the first and last word of every range (all that the driver gets).

Scale.  Words are counted in each task before they are shuffled.  A pair's
words are pairwise near and differ in one code point of the alphabet
``[A-Za-z\\u00C0-\\u00FF]``, so a group has at most 91 words whatever the input;
each word gets its number of others and the best other, never pairs.  A pair
whose inserted code point stands in a run of equal ones occurs at every place
of the run; only the run's first place counts.

A word's form is its near word of largest n (ties: smallest in code-point
order) if that n is ``ratio`` times the word's own at least, so following
forms ends after log(largest n) steps; roots are found by pointer doubling.

Defined cases: a null or empty text has no words; ids are used for
``damage`` only, a null id as an empty string; repeated rows count each;
an empty table gives an empty result; extra columns are ignored; words and
texts of any length are whole.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.llm.common import ensure_python_package, query, table, write_table

MIN_CHARS = 5
MIN_COUNT = 3
RATIO = 2
DAMAGE = 97               # one in so many (document, word) loses a code point
HELD = 400_000            # distinct words that a task counts before it emits them
RANGE_BITS = 36           # nodes of one range: 2^36 at most

# Latin-1 bytes: A-Z become a-z, other letters stay, all else is a blank.
_LETTERS = bytes((b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0xC0 else 0x20)
                 for b in range(256))


def runs_of(text: str) -> list[bytes]:
    """The lower-cased runs of letters of a text, as Latin-1 bytes."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def damaged(run: bytes, seed: int, every: int) -> bytes:
    """``seed``: crc32 of what comes before the run."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
    if h % every:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def counted_words(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT,
                  damage: int | None = None) -> DataFrame:
    """word, n: the words of at least ``min_chars`` code points that occur
    ``min_count`` times or more.  ``damage``: see the module's constant."""
    def run(batches):
        seen: dict[bytes, int] = {}

        def emit():
            return pa.RecordBatch.from_arrays(
                [pa.array([w.decode("latin-1") for w in seen], pa.string()),
                 pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

        for b in batches:
            for doc_id, text in zip(b.column("doc_id"), b.column("text")):
                text = text.as_py()
                if not text:
                    continue
                doc_id = doc_id.as_py()
                seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for w, n in Counter(runs_of(text)).items():
                    if len(w) < min_chars:
                        continue
                    if damage:
                        w = damaged(w, seed, damage)
                        if len(w) < min_chars:
                            continue
                    seen[w] = seen.get(w, 0) + n
                if len(seen) >= HELD:
                    yield emit()
                    seen.clear()
        yield emit()

    ensure_python_package(docs.sparkSession)
    d = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return (d.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= min_count))


def common_prefix(a: str, b: str) -> int:
    k, n = 0, min(len(a), len(b))
    while k < n and a[k] == b[k]:
        k += 1
    return k


def _number(backwards: bool):
    """Adds to sorted words: ``nodes`` (numbers of the prefixes, or suffixes,
    of length 0, 1, ...; the empty one is 0), ``part`` and ``edge`` (1: first
    word of the range, 2: last, 3: both)."""
    def run(batches):
        part = TaskContext.get().partitionId()
        used, last, stack, held = part << RANGE_BITS, "", [0], None
        for b in batches:
            if not b.num_rows:
                continue
            flat, ends = [], [0]
            for w in b.column("word").to_pylist():
                if backwards:
                    w = w[::-1]
                k = common_prefix(last, w)
                stack = stack[:k + 1] + list(range(used + 1, used + 1 + len(w) - k))
                used, last = used + len(w) - k, w
                flat += stack
                ends.append(len(flat))
            edge = np.zeros(b.num_rows, np.int32)
            if held is None:
                edge[0] = 1
            else:
                yield out(*held)
            held = (b, part, flat, ends, edge)
        if held is not None:
            held[-1][-1] |= 2
            yield out(*held)

    def out(b, part, flat, ends, edge):
        nodes = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))
        return pa.RecordBatch.from_arrays(
            [*b.columns, nodes, pa.array(np.full(b.num_rows, part), pa.int32()), pa.array(edge)],
            names=[*b.schema.names, "nodes", "part", "edge"])

    return run


def owners(edges) -> list[tuple[int, list[int]]]:
    """For each range whose first nodes belong to earlier ranges: their
    numbers there, from depth 1 on.  ``edges``: (part, edge, word, nodes)."""
    first = {part: word for part, edge, word, _ in edges if edge & 1}
    final = {part: (word, nodes) for part, edge, word, nodes in edges if edge & 2}
    out, before, chain = [], "", [0]
    for part in sorted(first):
        shared = chain[1:common_prefix(before, first[part]) + 1]
        base = part << RANGE_BITS
        before, nodes = final[part]
        chain = [shared[x - base - 1] if base < x <= base + len(shared) else x for x in nodes]
        if shared:
            out.append((part, shared))
    return out


def numbered(words: DataFrame, name: str, backwards: bool = False) -> DataFrame:
    """``words`` with a column ``name``: the nodes of all prefixes (or, from
    the end, of all suffixes) by length."""
    spark = words.sparkSession
    ensure_python_package(spark)
    key = F.reverse("word") if backwards else F.col("word")
    kinds = ", ".join(f"{c} {t}" for c, t in words.dtypes)
    rows = write_table(
        words.withColumn("key", key).repartitionByRange("key").sortWithinPartitions("key").drop("key")
        .mapInArrow(_number(backwards), f"{kinds}, nodes array<long>, part int, edge int"), f"spelling-{name}")
    edges = [(r.part, r.edge, r.word[::-1] if backwards else r.word, r.nodes)
             for r in rows.where("edge > 0").select("part", "edge", "word", "nodes").collect()]
    own = spark.createDataFrame(owners(edges), "part int, own array<long>")
    base = F.shiftleft(F.col("part").cast("long"), RANGE_BITS)
    owned = F.transform("nodes", lambda x: F.when(
        (x > base) & (x <= base + F.size("own")), F.get("own", (x - base - 1).cast("int"))).otherwise(x))
    return rows.join(own, "part", "left").select(
        *words.columns, F.when(F.col("own").isNull(), F.col("nodes")).otherwise(owned).alias(name))


# what a word is in a pair's group
SPLIT, SKIP, SKIP_FIRST = 0, 1, 2


def node_pairs(words: DataFrame) -> DataFrame:
    """p, s, kind, id, n: the pairs of every word, whole and with one code
    point left out (SKIP_FIRST: the first of a run of equal ones)."""
    def number(kind: int) -> Column:
        return F.lit(kind).cast("byte")

    n = F.size("prefix") - 1

    def kind(char: Column, i: Column) -> Column:
        return F.when((i > 0) & (F.get(char, i) == F.get(char, i - 1)), number(SKIP)).otherwise(number(SKIP_FIRST))

    def skips(char: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(
            F.get("prefix", i).alias("p"), F.get("suffix", n - i - 1).alias("s"), kind(char, i).alias("kind")))

    skip = F.element_at(F.transform(F.array(F.split("word", "")), skips), 1)  # split once a word
    split = F.transform(F.sequence(F.lit(0), n), lambda i: F.struct(
        F.get("prefix", i).alias("p"), F.get("suffix", n - i).alias("s"), number(SPLIT).alias("kind")))
    return words.select("id", "n", F.explode(F.concat(skip, split)).alias("x")).select(
        "x.p", "x.s", "x.kind", "id", "n")


def neighbours(pairs: DataFrame) -> DataFrame:
    """id, n_near, best_n, best_id: how many near words each word has, and
    the one of largest n (then smallest id)."""
    member = F.struct("n", (-F.col("id")).alias("neg"), "kind")
    groups = (pairs.groupBy("p", "s").agg(F.collect_list(member).alias("m"))
              .where(F.size("m") > 1).select(F.sort_array("m", asc=False).alias("m")))

    def many(test) -> Column:
        return F.size(F.filter("m", test))

    groups = groups.select(
        F.explode("m").alias("x"), F.get("m", 0).alias("top"), F.get("m", 1).alias("second"),
        many(lambda x: x["kind"] != SPLIT).alias("skips"), many(lambda x: x["kind"] == SKIP_FIRST).alias("firsts"),
        many(lambda x: x["kind"] == SPLIT).alias("splits"))
    other = F.when(F.col("x.neg") == F.col("top.neg"), F.col("second")).otherwise(F.col("top"))
    near = F.when(F.col("x.kind") == SPLIT, F.col("firsts")).otherwise(
        F.col("skips") - 1 + F.when(F.col("x.kind") == SKIP_FIRST, F.col("splits")).otherwise(0))
    return (groups.select((-F.col("x.neg")).alias("id"), near.alias("near"),
                          F.struct(other["n"].alias("n"), other["neg"].alias("neg")).alias("other"))
            .groupBy("id").agg(F.sum("near").cast("long").alias("n_near"), F.max("other").alias("best"))
            .select("id", "n_near", F.col("best.n").alias("best_n"), (-F.col("best.neg")).alias("best_id")))


def roots(links: DataFrame) -> DataFrame:
    """id, root: the end of every chain id -> to (no cycles), by pointer
    doubling; ``links`` is a written table."""
    at = links.select("id", F.col("to").alias("root"))
    while True:
        ahead = at.select(F.col("id").alias("root"), F.col("root").alias("next"))
        at = write_table(at.join(ahead, "root", "left")
                         .select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
                         "spelling-roots")
        if at.where("moved").isEmpty():
            return at.drop("moved")
        at = at.drop("moved")


def group_variants(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT,
                   ratio: int = RATIO, damage: int | None = None) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the documents."""
    words = write_table(counted_words(docs, min_chars, min_count, damage)
                        .repartitionByRange("word").sortWithinPartitions("word")
                        .withColumn("id", F.monotonically_increasing_id()), "spelling-words")  # in word order
    near = neighbours(node_pairs(numbered(numbered(words, "prefix"), "suffix", backwards=True)))
    form = F.col("best_n") >= ratio * F.col("n")
    judged = write_table(words.join(near, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(form, F.col("best_id")).alias("to"), F.when(form, F.col("best_n")).alias("form_n")), "spelling-forms")
    links = judged.where("to IS NOT NULL").select("id", "to")
    named = roots(links).join(links, "id")
    text = words.select(F.col("id").alias("key"), F.col("word").alias("text"))
    named = (named.join(text.withColumnRenamed("text", "form"), F.col("to") == F.col("key")).drop("key")
             .join(text.withColumnRenamed("text", "root_word"), F.col("root") == F.col("key"))
             .select("id", "form", "root_word"))
    return judged.join(named, "id", "left").select(
        "word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")


@query("op12_spelling_variants")
def op12(spark, sf_dir):
    """Every word of the damaged ``documents`` with its form and root."""
    return group_variants(table(spark, sf_dir, "documents"), damage=DAMAGE)
