"""Conversation structure repair: Four-Russians block tables.

A conversation's rows, in order, are repaired into roles that read
``(s?(ua)+)?`` at least cost.  A row is kept (0; 1 more if its text is
truncated), given the role user or assistant (2), or deleted (3; a must for
blank rows and duplicates); empty user or assistant rows are inserted (2).
Of the cheapest edit sequences the one whose initials D, I, K, R, in order,
are least in ASCII is taken.

Method.  The grammar has four states (nothing yet, after s, after u, after a).
Read from the end, a row turns the vector of costs still to come, one per
state, into the vector before it.  Less its least cost, such a vector is one
of a few dozen; all of them, and what each of the 10^4 blocks of four row
symbols makes of them (next vector, cost added), are tabled once a worker.
Rows are then processed four at a time by lookup, from the end to the start.
For the trace each block is expanded backward into the vectors between its
rows; forward, the least letter that stays on a cheapest path is taken, so
ties are decided right.

Scale.  Rows are range-partitioned by (conv_id, turn, role, text hash) and cut
into segments of bounded rows and bytes: a conversation with a third of all
rows spreads over many tasks.  What a segment does to any cost vector is a
4 x 4 table (its blocks looked up for four end vectors); tables of one
conversation are composed in a tree with ``FAN`` children a node, up and down
again, which gives every segment the costs to come at its end.  The states at
segment starts are found likewise.  Duplicates across segments go by the first
segment of each (conversation, role and text).  Conversations of one segment
skip all this.  Only the digest of a long conversation's repaired text runs
through one task, as a stream, for SHA-256 is sequential.

Defined cases: null texts, roles and ids count as one blank in ``damage`` and
in faults; rows come in order of turn (nulls first), then role and the text's
hash (equal rows: any order, they are the same); a null conv_id is a
conversation; roles count by their first character; repeated rows are
duplicates; an empty table gives an empty result; extra columns are ignored;
texts of any length are whole.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.llm.common import ensure_python_package, query, table, write_table

KEEP, TRUNCATED, REROLE, DELETE, INSERT = 0, 1, 2, 3, 2   # costs
BLOCK = 4
SEGMENT_ROWS = 4096
SEGMENT_BYTES = 4 << 20    # of text, or one row if that is longer
BATCH_BYTES = 8 << 20      # of text in one Arrow batch that a task returns
FAN = 10                   # 2^FAN segments a tree node
INF = 1 << 50

START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}   # by an inserted or rerolled row
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
CLASSES = "sua?"           # role initials; ? is any other
# symbols: 0 no row (fills a block), 1 a row that must go, then class x truncated
SYMBOLS = 2 + 2 * len(CLASSES)
END = (0, 4, 2, 0)         # costs to come after the last row
BLANK = " \t\n\x0b\x0c\r"
PAIRS = {"su", "ua", "au"}


def symbol(fault: str, initial: str) -> int:
    """fault: '-' none, b blank, d duplicate, t truncated."""
    if fault in "bd":
        return 1
    return 2 + 2 * (CLASSES.find(initial) if initial and initial in "sua" else 3) + (fault == "t")


def edits(x: int, q: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of what may be done with a row in state q."""
    if x == 0:
        return [("", 0, q)]
    out = [("D", DELETE, q)]
    if x > 1:
        more = TRUNCATED * (x % 2)
        kept = KEPT.get((q, CLASSES[(x - 2) // 2]))
        if kept is not None:
            out.append(("K", KEEP + more, kept))
        out.append(("R", REROLE + more, NEXT[q]))
    return out


def _inserted(v: list[int]) -> list[int]:
    """Costs to come if rows may be inserted first."""
    v = list(v)
    for _ in range(4):
        v = [min(v[q], v[NEXT[q]] + INSERT) for q in range(4)]
    return [min(x, INF) for x in v]


def before(v, x: int) -> list[int]:
    """Costs to come before a row of symbol x, from those behind it."""
    if x == 0:
        return list(v)
    return _inserted([min(c + v[to] for _, c, to in edits(x, q)) for q in range(4)])


class Tables:
    """All normalised cost vectors and what rows and blocks make of them."""

    def __init__(self):
        self.number: dict[tuple, int] = {}
        self.vectors: list[tuple] = []
        units = [_inserted([0 if p == q else INF for p in range(4)]) for q in range(4)]
        self.end, *self.units = [self._add(v)[0] for v in (list(END), *units)]
        row, cost, k = [], [], 0
        while k < len(self.vectors):      # the closure of these under rows
            step = [self._add(before(self.vectors[k], x)) for x in range(SYMBOLS)]
            row.append([n for n, _ in step])
            cost.append([c for _, c in step])
            k += 1
        self.row, self.cost = np.array(row, np.int32), np.array(cost, np.int64)
        block, total = self.row, self.cost
        for _ in range(BLOCK - 1):        # a row before the rows so far
            total = (total[:, None, :] + self.cost[block].transpose(0, 2, 1)).reshape(len(row), -1)
            block = self.row[block].transpose(0, 2, 1).reshape(len(row), -1)
        self.block, self.total = block, total

    def _add(self, v) -> tuple[int, int]:
        low = min(v)
        key = tuple(min(x - low, INF) if x < INF else INF for x in v)
        if key not in self.number:
            self.number[key] = len(self.vectors)
            self.vectors.append(key)
        return self.number[key], low

    def find(self, v) -> tuple[int, int]:
        """The number of a vector that rows have made, and its least cost."""
        low = min(v)
        return self.number[tuple(x - low if x < INF else INF for x in v)], low

    def blocks(self, symbols: list[int]) -> list[int]:
        """Block numbers of the symbols, filled up at the end."""
        s = symbols + [0] * (-len(symbols) % BLOCK)
        return [int("".join(map(str, s[k:k + BLOCK]))) for k in range(0, len(s), BLOCK)]

    def back(self, blocks: list[int], v: int) -> list[tuple[int, int]]:
        """(vector, cost so far) before each block and, last, behind all."""
        out, c = [(v, 0)], 0
        for b in reversed(blocks):
            v, c = int(self.block[v, b]), c + int(self.total[v, b])
            out.append((v, c))
        return out[::-1]

    def trace(self, symbols: list[int], v: int, q: int, last: bool) -> tuple[str, int]:
        """Letters from state q on (least in ASCII), and the state at the end;
        ``last``: rows may be inserted behind the last row, too."""
        blocks, letters = self.blocks(symbols), []
        at = self.back(blocks, v)
        for k in range(len(blocks)):
            part = symbols[k * BLOCK:(k + 1) * BLOCK]
            inner = [at[k + 1]]           # the block, expanded backward
            for x in reversed(part):
                n, c = inner[-1]
                inner.append((int(self.row[n, x]), c + int(self.cost[n, x])))
            inner.reverse()
            for j, x in enumerate(part):
                while True:
                    here, c0 = self.vectors[inner[j][0]], inner[j][1]
                    then, c1 = self.vectors[inner[j + 1][0]], inner[j + 1][1]
                    ways = sorted((letter, to) for letter, c, to in edits(x, q) if c + then[to] + c1 == here[q] + c0)
                    if here[NEXT[q]] + INSERT == here[q]:
                        ways = sorted([*ways, ("I", NEXT[q])])
                    letter, q = ways[0]
                    letters.append(letter)
                    if letter != "I":
                        break
        while last and q not in (START, ASSISTANT):
            letters.append("I")
            q = NEXT[q]
        return "".join(letters), q


@functools.cache
def tables() -> Tables:
    return Tables()


def damage(rows: DataFrame) -> DataFrame:
    """Conversations with faults: by crc32(``conv_id:turn``) % 20 a row goes
    (0), loses its text (1) or its ``.!?`` (2), is repeated (3) or becomes the
    user's (4)."""
    def text(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    code = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    return (rows.select("conv_id", F.col("turn").cast("long").alias("turn"), text("role").alias("role"),
                        text("text").alias("text"), code.alias("code")).where("code != 0")
            .select("conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", ""))
                    .otherwise(F.col("text")).alias("text"),
                    F.explode(F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
            .drop("copy"))


SEGMENT = ("part int, seg long, edge int, roles array<string>, texts array<string>, keys array<string>, faults string, "
           "first_turn long, last_turn long, lo long, hi long, turns long, illegal long")


def _cut(id_type: pa.DataType):
    """Sorted rows (conv_id, turn, role, text, key) into segments."""
    schema = pa.schema([("conv_id", id_type), ("part", pa.int32()), ("seg", pa.int64()), ("edge", pa.int32()),
                        ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
                        ("keys", pa.list_(pa.string())), ("faults", pa.string()),
                        *[(c, pa.int64()) for c in ("first_turn", "last_turn", "lo", "hi", "turns", "illegal")]])

    def run(batches):
        part = TaskContext.get().partitionId()
        done: list[dict] = []
        now, held, size, n = None, 0, 0, 0   # open segment; bytes in done; its bytes; segments

        def emit():
            return pa.RecordBatch.from_pylist(done, schema)

        for b in batches:
            for conv, turn, role, text, key in zip(*[b.column(c).to_pylist() for c in
                                                     ("conv_id", "turn", "role", "text", "key")]):
                same = now is not None and now["conv_id"] == conv
                if not same or len(now["roles"]) >= SEGMENT_ROWS or size >= SEGMENT_BYTES:
                    if held + size >= BATCH_BYTES or len(done) >= 10_000:
                        yield emit()
                        done.clear()
                        held, size = 0, 0
                    past = now if same else None
                    now = {"conv_id": conv, "part": part, "seg": n, "edge": 1 if n == 0 else 0, "roles": [], "texts": [],
                           "keys": [], "faults": "", "first_turn": turn, "last_turn": past and past["last_turn"],
                           "lo": None, "hi": None, "turns": 0, "illegal": 0}
                    role_before = past["roles"][-1] if past else None
                    done.append(now)
                    seen: set[str] = set()
                    held, size, n = held + size, 0, n + 1
                body = text.rstrip(BLANK)
                now["faults"] += "b" if not body else "d" if key in seen else "-" if body[-1] in ".!?" else "t"
                seen.add(key)
                if role_before is not None and role_before[:1] + role[:1] not in PAIRS:
                    now["illegal"] += 1
                if turn is not None:
                    now["turns"] += turn != now["last_turn"]
                    now["lo"] = turn if now["lo"] is None else now["lo"]
                    now["hi"] = turn
                now["last_turn"], role_before = turn, role
                now["roles"].append(role)
                now["texts"].append(text)
                now["keys"].append(key)
                size += len(text)
        if done:
            done[-1]["edge"] |= 2
            yield emit()

    return run


def segments(rows: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text) of every conversation in order, as
    written segments."""
    spark, kind = rows.sparkSession, rows.schema["conv_id"].dataType
    ensure_python_package(spark)
    from pyspark.sql.pandas.types import to_arrow_type
    key = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    order = ["conv_id", "turn", "role", "key"]
    return write_table(
        rows.withColumn("key", key).repartitionByRange(*order).sortWithinPartitions(*order)
        .mapInArrow(_cut(to_arrow_type(kind)), f"conv_id {kind.simpleString()}, {SEGMENT}"), "segments")


def borders(segs: DataFrame) -> DataFrame:
    """conv_id, turns, illegal: what a conversation that goes on in the next
    part adds there.  The driver gets two segments a part at most."""
    rows = (segs.where("edge > 0").select("part", "seg", "edge", "conv_id", "first_turn", "last_turn", "lo",
                                          F.substring(F.get("roles", 0), 1, 1).alias("a"),
                                          F.substring(F.element_at("roles", -1), 1, 1).alias("z"))
            .orderBy("part", "seg").collect())
    out = []
    heads = [r for r in rows if r.edge & 1]
    tails = [r for r in rows if r.edge & 2]
    for tail, head in zip(tails, heads[1:]):
        if tail.conv_id == head.conv_id:
            same = head.first_turn is not None and head.first_turn == tail.last_turn
            out.append((head.conv_id, -int(same), int(tail.z + head.a not in PAIRS)))
    return segs.sparkSession.createDataFrame(
        out, f"conv_id {segs.schema['conv_id'].dataType.simpleString()}, turns long, illegal long")


def _nulls_too(a: DataFrame, b: DataFrame, *keys: str):
    test = a[keys[0]].eqNullSafe(b[keys[0]])
    for k in keys[1:]:
        test = test & a[k].eqNullSafe(b[k])
    return test


def _compose(maps: np.ndarray) -> np.ndarray:
    """One 4 x 4 (min, +) table of several, in order."""
    out = maps[0]
    for m in maps[1:]:
        out = np.minimum((out[:, :, None] + m[None, :, :]).min(axis=1), INF)
    return out


def _outside(maps: np.ndarray, v: np.ndarray, backwards: bool) -> list[np.ndarray]:
    """The vector at the outer side of each table: costs to come at its end
    (``backwards``), or the states reached at its start."""
    out = []
    for m in (maps[::-1] if backwards else maps):
        out.append(v)
        v = np.minimum((m + v[None, :] if backwards else (m + v[:, None]).T).min(axis=1), INF)
    return out[::-1] if backwards else out


def scan(maps: DataFrame, last: int, seed, backwards: bool) -> DataFrame:
    """conv_id, at, v from (conv_id, at, m): up and down a tree of the tables
    of each conversation.  ``last``: the largest place ``at``."""
    kind = maps.schema["conv_id"].dataType.simpleString()
    ensure_python_package(maps.sparkSession)

    def up(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("at")
        m = _compose(np.array(g["m"].tolist()).reshape(-1, 4, 4))
        return pd.DataFrame({"conv_id": g["conv_id"].iloc[:1], "at": g["node"].iloc[:1], "m": [m.reshape(-1).tolist()]})

    def down(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("at")
        v = _outside(np.array(g["m"].tolist()).reshape(-1, 4, 4), np.array(g["v"].iloc[0]), backwards)
        return pd.DataFrame({"conv_id": g["conv_id"], "at": g["at"], "v": [x.tolist() for x in v]})

    node = F.shiftright("at", FAN).alias("node")
    levels = [maps.select("conv_id", "at", "m")]
    while last > 0:
        last >>= FAN
        levels.append(write_table(levels[-1].select("*", node).groupBy("conv_id", "node").applyInPandas(
            up, f"conv_id {kind}, at long, m array<long>"), "tables"))
    v = levels.pop().select("conv_id", F.col("at").alias("node"), F.lit(list(seed)).cast("array<long>").alias("v"))
    for level in reversed(levels):
        level = level.select("*", node)
        both = level.join(v, _nulls_too(level, v, "conv_id", "node")).select(
            level["conv_id"], level["node"], "at", "m", "v")
        v = write_table(both.groupBy("conv_id", "node").applyInPandas(
            down, f"conv_id {kind}, at long, v array<long>"), "vectors").withColumnRenamed("at", "node")
    return v.withColumnRenamed("node", "at")


def _marked(keys: list[str], faults: str, later: list[str] | None) -> str:
    """Faults with the duplicates of earlier segments."""
    if not later:
        return faults
    gone = set(later)
    return "".join("d" if f != "b" and k in gone else f for f, k in zip(faults, keys))


def _symbols(faults: str, initials: list[str]) -> list[int]:
    return [symbol(f, i) for f, i in zip(faults, initials)]


def _costs(batches):
    """m: for every segment, costs from each start state to each end state."""
    t = tables()
    for b in batches:
        p = b.to_pydict()
        faults = [_marked(k, f, x) for k, f, x in zip(p["keys"], p["faults"], p["later"])]
        out = []
        for f, initials in zip(faults, p["initials"]):
            blocks, m = t.blocks(_symbols(f, initials)), np.empty((4, 4), np.int64)
            for q, unit in enumerate(t.units):
                v, c = t.back(blocks, unit)[0]
                m[:, q] = [min(x + c, INF) for x in t.vectors[v]]
            out.append(m.reshape(-1).tolist())
        yield pa.RecordBatch.from_arrays(
            [b.column("conv_id"), b.column("at"), b.column("part"), b.column("seg"), b.column("initials"),
             pa.array(faults, pa.string()), pa.array(out, pa.list_(pa.int64()))],
            names=["conv_id", "at", "part", "seg", "initials", "faults", "m"])


def _exits(last_of: str):
    """m: for every segment, the state at its end for each at its start."""
    def run(batches):
        t = tables()
        for b in batches:
            p, out = b.to_pydict(), []
            for f, initials, v, last in zip(p["faults"], p["initials"], p["v"], p[last_of]):
                s, m = _symbols(f, initials), np.full((4, 4), INF, np.int64)
                for q in range(4):
                    m[q, t.trace(s, t.find(v)[0], q, last)[1]] = 0
                out.append(m.reshape(-1).tolist())
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("at"), pa.array(out, pa.list_(pa.int64()))],
                                             names=["conv_id", "at", "m"])

    return run


def long_conversations(segs: DataFrame) -> DataFrame | None:
    """part, seg, marked, after, enter, final: for the segments of all
    conversations that have several."""
    spark, kind = segs.sparkSession, segs.schema["conv_id"].dataType.simpleString()
    several = segs.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("conv_id")
    narrow = segs.select("conv_id", "part", "seg", "keys", "faults",
                         F.transform("roles", lambda x: F.substring(x, 1, 1)).alias("initials"))
    many = write_table(narrow.join(several, _nulls_too(narrow, several, "conv_id"), "left_semi"), "long")
    if many.isEmpty():
        return None
    # one number over all parts, in order (a row per part reaches the driver)
    size, starts, total = segs.groupBy("part").agg(F.max("seg").alias("n")).orderBy("part").collect(), [], 0
    for r in size:
        starts.append((r.part, total))
        total += r.n + 1
    many = many.join(spark.createDataFrame(starts, "part int, start long"), "part").withColumn("at", F.col("start") + F.col("seg"))
    each = many.select("conv_id", "at", F.explode(F.array_distinct("keys")).alias("key"))
    first = each.groupBy("conv_id", "key").agg(F.min("at").alias("at")).select("at", "key")
    later = (each.join(first, ["at", "key"], "left_anti").groupBy("at")
             .agg(F.collect_list("key").alias("later")))           # a segment's rows at most
    costs = write_table(many.join(later, "at", "left").select("conv_id", "at", "part", "seg", "keys", "faults", "initials", "later")
                        .mapInArrow(_costs, f"conv_id {kind}, at long, part int, seg long, initials array<string>, "
                                            "faults string, m array<long>"), "costs")
    after = scan(costs, total, END, backwards=True)
    final = costs.groupBy("conv_id").agg(F.max("at").alias("at")).select("at", F.lit(True).alias("final"))
    known = write_table(costs.join(after.select("at", "v"), "at").join(final, "at", "left").select(
        "conv_id", "at", "part", "seg", "initials", "faults", "v", F.coalesce("final", F.lit(False)).alias("final")), "after")
    exits = known.mapInArrow(_exits("final"), f"conv_id {kind}, at long, m array<long>")
    enter = scan(write_table(exits, "exits"), total, [0, INF, INF, INF], backwards=False)
    return known.join(enter.select("at", (F.array_position("v", 0) - 1).cast("int").alias("enter")), "at").select(
        "part", "seg", F.col("faults").alias("marked"), F.col("v").alias("after"), "enter", "final")


REPAIRED = ("part int, seg long, several boolean, blank long, duplicate long, truncated long, cost long, audit string, "
            "rows array<struct<role:string,text:string>>")


def _repair(batches):
    t = tables()
    for b in batches:
        p = b.to_pydict()
        out = {k: [] for k in ("blank", "duplicate", "truncated", "cost", "audit", "rows")}
        several = []
        for k, faults in enumerate(p["faults"]):
            alone = p["marked"][k] is None
            several.append(not alone)
            faults = faults if alone else p["marked"][k]
            after, q, last = ((END, START, True) if alone else (p["after"][k], p["enter"][k], p["final"][k]))
            roles, texts = p["roles"][k], p["texts"][k]
            s = _symbols(faults, [r[:1] for r in roles])
            v, low = t.find(after)
            start, c = t.back(t.blocks(s), v)[0]
            cost = t.vectors[start][q] + c + low
            audit, end = t.trace(s, v, q, last)
            out["cost"].append(cost if last else cost - after[end])
            rows, i = [], 0
            for letter in audit:
                if letter == "K":
                    q = KEPT[q, roles[i][:1]]
                    rows.append({"role": roles[i], "text": texts[i]})
                elif letter != "D":
                    q = NEXT[q]
                    rows.append({"role": ROLE[q], "text": "" if letter == "I" else texts[i]})
                i += letter != "I"
            out["audit"].append(audit)
            out["rows"].append(rows)
            for name, f in (("blank", "b"), ("duplicate", "d"), ("truncated", "t")):
                out[name].append(faults.count(f))
        yield pa.RecordBatch.from_arrays(
            [b.column("conv_id"), b.column("part"), b.column("seg"), pa.array(several),
             *[pa.array(out[c], pa.int64()) for c in ("blank", "duplicate", "truncated", "cost")],
             pa.array(out["audit"], pa.string()),
             pa.array(out["rows"], pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))],
            names=["conv_id", *[c.split()[0] for c in REPAIRED.split(", ") if " " in c]])


def repair(segs: DataFrame) -> DataFrame:
    """The written segments, repaired: faults, cost, audit letters and rows;
    ``several``: the conversation has more segments, in order of (part, seg)."""
    spark, kind = segs.sparkSession, segs.schema["conv_id"].dataType.simpleString()
    extra = long_conversations(segs)
    if extra is None:
        extra = spark.createDataFrame([], "part int, seg long, marked string, after array<long>, enter int, final boolean")
    return write_table(
        segs.select("conv_id", "part", "seg", "roles", "texts", "faults").join(extra, ["part", "seg"], "left")
        .select("conv_id", "part", "seg", "roles", "texts", "faults", "marked", "after", "enter", "final")
        .mapInArrow(_repair, f"conv_id {kind}, {REPAIRED}"), "repaired")


def repaired_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, at, role, text: the repaired conversations; ``at`` orders the
    rows of one (part, segment and place in it)."""
    rows = (conversations.select("conv_id", F.col("turn").cast("long").alias("turn"),
                                 *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]))
    return repair(segments(rows)).select("conv_id", "part", "seg", F.posexplode("rows").alias("k", "row")).select(
        "conv_id", F.struct("part", "seg", "k").alias("at"), "row.role", "row.text")


def _stream(batches):
    """audit and digest of conversations whose segments come in order."""
    now, audit, digest, empty = None, [], None, True

    def result():
        return pa.RecordBatch.from_arrays(
            [now[1], pa.array(["".join(audit)], pa.string()), pa.array([digest.hexdigest()], pa.string())],
            names=["conv_id", "audit", "repaired_sha256"])

    for b in batches:
        ids = b.column("conv_id").to_pylist()
        for k, (conv, letters, body) in enumerate(zip(ids, b.column("audit").to_pylist(), b.column("body").to_pylist())):
            if now is None or now[0] != conv:
                if now is not None:
                    yield result()
                now, audit, digest, empty = (conv, b.column("conv_id").slice(k, 1)), [], hashlib.sha256(), True
            audit.append(letters)
            if body is not None:
                digest.update(body.encode() if empty else b"\n" + body.encode())
                empty = False
    if now is not None:
        yield result()


def audit(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """One row for every conv_id of ``conversations``: gaps, faults, cost,
    audit and digest of the repair of ``rows`` (conv_id, turn, role, text)."""
    kind = conversations.schema["conv_id"].dataType.simpleString()
    segs = segments(rows)
    done = repair(segs)
    body = F.array_join(F.transform("rows", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")
    digest = F.sha2(body, 256)
    none = F.lit(None).cast("string")
    zero = F.lit(0).cast("long")
    sums = ["turns", "illegal", "blank", "duplicate", "truncated", "cost"]

    def part(df: DataFrame, *have: str) -> DataFrame:
        return df.select("conv_id", *[F.col(c) if c in have else zero.alias(c) for c in sums],
                         *[F.col(c) if c in have else F.lit(None).cast("long").alias(c) for c in ("lo", "hi")],
                         *[F.col(c) if c in have else none.alias(c) for c in ("audit", "repaired_sha256")])

    long = (done.where("several").select("conv_id", "part", "seg", "audit",
                                         F.when(F.size("rows") > 0, body).alias("body"))
            .repartition("conv_id").sortWithinPartitions("conv_id", "part", "seg").select("conv_id", "audit", "body")
            .mapInArrow(_stream, f"conv_id {kind}, audit string, repaired_sha256 string"))
    alone = ~F.col("several")
    each = (part(conversations.select("conv_id").distinct())
            .unionAll(part(segs, "turns", "illegal", "lo", "hi"))
            .unionAll(part(borders(segs), "turns", "illegal"))
            .unionAll(part(done.withColumns({"audit": F.when(alone, F.col("audit")), "repaired_sha256": F.when(alone, digest)}),
                           "blank", "duplicate", "truncated", "cost", "audit", "repaired_sha256"))
            .unionAll(part(long, "audit", "repaired_sha256")))
    one = each.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in sums], F.min("lo").alias("lo"), F.max("hi").alias("hi"),
                                      F.max("audit").alias("audit"), F.max("repaired_sha256").alias("repaired_sha256"))
    gaps = F.coalesce(F.try_add(F.try_subtract("hi", "lo"), 1 - F.col("turns")),
                      F.when(F.col("lo").isNull(), 0).otherwise((1 << 63) - 1))   # beyond a long: its largest
    return one.select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost",
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


@query("op11_conversation_repair")
def op11(spark, sf_dir):
    """Every conversation of the damaged ``conversations``: faults and repair."""
    c = table(spark, sf_dir, "conversations")
    return audit(c, damage(c))
