"""Conversation repair against a plain search over all edit sequences."""
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from pitwall.llm import conversations as cv

BLANK = " \t\n\x0b\x0c\r"
STEP = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
SCHEMA = "conv_id long, turn long, role string, text string"


def damaged(rows):
    for c, t, r, x in rows:
        code = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        if code == 0:
            continue
        if code == 1:
            x = ""
        if code == 2:
            x = "".join(ch for ch in x if ch not in ".!?")
        if code == 4:
            r = "user"
        yield from [(c, t, r, x)] * (2 if code == 3 else 1)


def cheapest(rows, faults):
    """(cost, letters, repaired rows) for each state, from the last row on."""
    def inserted(best):
        for _ in range(4):
            for q in STEP:
                to = "a" if q == "u" else "u"
                c, s, out = best[to]
                way = (c + 2, "I" + s, [({"u": "user", "a": "assistant"}[to], "")] + out)
                best[q] = min(best[q], way, key=lambda w: w[:2])
        return best

    best = inserted({q: (0, "", []) if q in ("", "a") else (10**9, "~", []) for q in STEP})
    for (_, _, role, text), fault in reversed(list(zip(rows, faults))):
        now = {}
        for q in STEP:
            ways = [(best[q][0] + 3, "D" + best[q][1], best[q][2])]
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                if role[:1] in STEP[q]:
                    c, s, out = best[STEP[q][role[:1]]]
                    ways.append((c + more, "K" + s, [(role, text)] + out))
                to = "a" if q == "u" else "u"
                c, s, out = best[to]
                ways.append((c + 2 + more, "R" + s, [({"u": "user", "a": "assistant"}[to], text)] + out))
            now[q] = min(ways, key=lambda w: w[:2])
        best = inserted(now)
    return best[""]


def brute(rows):
    convs = {}
    for r in rows:
        convs.setdefault(r[0], [])
    for r in damaged(rows):
        convs[r[0]].append(r)
    out = {}
    for c, rs in convs.items():
        key = lambda r: hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).hexdigest()
        rs.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), key(r)))
        faults, seen = [], set()
        for _, _, role, text in rs:
            body = text.strip(BLANK)
            faults.append("blank" if not body else "duplicate" if (role, text) in seen
                          else "truncated" if body[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [r[1] for r in rs if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rs, rs[1:]))
        cost, letters, fixed = cheapest(rs, faults)
        text = "\n".join(f"{r}:{x}" for r, x in fixed)
        out[c] = (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, letters,
                  hashlib.sha256(text.encode()).hexdigest())
    return out


def got(spark, df):
    rows = cv.audit(df, cv.damage(df)).collect()
    out = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows}
    assert len(out) == len(rows)
    return out


def made(seed, n_conv, turns):
    rnd = random.Random(seed)
    rows = []
    for c in range(n_conv):
        for t in range(rnd.randint(1, turns)):
            if rnd.random() < 0.05:
                continue
            rows.append((c, t + rnd.choice([0, 0, 0, 3]), rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", ""]),
                         rnd.choice(["Yes.", "No!", "well", " \n", "", "Why? ", f"w {rnd.random()}."])))
    return rows


def test_tables_equal_rows_one_by_one():
    t, rnd = cv.tables(), random.Random(2)
    assert len(t.vectors) < 1000
    for _ in range(300):
        s = [rnd.randrange(1, cv.SYMBOLS) for _ in range(rnd.randint(0, 30))]
        v = list(cv.END)
        for x in reversed(s):
            v = cv.before(v, x)
        n, c = t.back(t.blocks(s), t.end)[0]
        assert [x + c for x in t.vectors[n]] == v
    # any cost vector that rows can make is tabled, also from a single end state
    for unit in t.units:
        for _ in range(50):
            s = [rnd.randrange(1, cv.SYMBOLS) for _ in range(9)]
            v = list(t.vectors[unit])
            for x in reversed(s):
                v = cv.before(v, x)
            assert t.find(v)[0] == t.back(t.blocks(s), unit)[0][0]


def test_random_conversations(spark):
    rows = made(1, 150, 12)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(spark, df) == brute(rows)


@pytest.mark.parametrize("size,fan", [(3, 2), (7, 1), (64, 10)])
def test_long_conversations_in_segments(spark, monkeypatch, size, fan):
    rows = made(2, 3, 400) + [(r[0] + 50, *r[1:]) for r in made(3, 40, 5)] + [(None, *r[1:]) for r in made(4, 1, 90)]
    monkeypatch.setattr(cv, "FAN", fan)
    monkeypatch.setattr(cv, "SEGMENT_ROWS", size)     # goes to the workers with the function
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert cv.segments(cv.damage(df)).count() > 400 / size
    assert got(spark, df) == brute(rows)


def test_hot_conversation_of_equal_rows(spark):
    rows = [(7, t % 5, "user", "Again and again.") for t in range(3000)] + [(8, 0, "user", "Hi."), (8, 1, "assistant", "Ho.")]
    assert got(spark, spark.createDataFrame(rows, SCHEMA).repartition(4)) == brute(rows)


def test_edge_rows(spark):
    rows = [(None, None, None, None), (None, 1, "user", "a."), (1, None, "user", "x."), (1, None, None, ""), (1, 2, "assistant", None),
            (2, -5, "user", "Long. " * 50_000), (2, 9, "assistant", "No stop"), (2, 9, "assistant", "No stop"), (3, 0, "system", "s.")]
    rows += [(40 + k, k, "user", "one.") for k in range(40)]      # some lose their only row
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], SCHEMA + ", `__row` int, seg string")
    want = brute(rows)
    assert got(spark, df) == want
    assert (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) in want.values()
    assert cv.audit(df.limit(0), cv.damage(df.limit(0))).count() == 0
    far = spark.createDataFrame([(1, -(1 << 63), "user", "a."), (1, (1 << 63) - 1, "assistant", "b.")], SCHEMA)
    assert cv.audit(far, far).first().gaps == (1 << 63) - 1


def test_repaired_rows_read_by_the_grammar(spark):
    import re
    rows = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    broken = rows.withColumn("role", F.when(F.col("turn") % 3 == 1, "tool").otherwise(F.col("role")))
    fixed = {}
    for r in cv.repaired_rows(broken).orderBy("conv_id", "at").collect():
        fixed.setdefault(r.conv_id, []).append(r)
    for rs in fixed.values():
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in rs))
    kept = {r.text for rs in fixed.values() for r in rs if r.text}
    assert kept <= {r.text for r in rows.collect()} and kept


def test_documents_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert got(spark, df) == brute(rows)
