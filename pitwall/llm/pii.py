"""Personal data: expressions propose, validators confirm, context scores.

Method.  Per kind a regular expression proposes spans.  A validator confirms
them: address parts up to 255, digit counts, the Luhn sum of card numbers, the
mod-97 remainder of bank account numbers (at a word boundary that gives a
listed country's length), the entropy of secrets (values behind a word like
token or password).  The words around a span move its score up or down.  The
four base kinds are reported whenever they are valid; ``iban``, ``ssn`` and
``secret``, which the method adds, need a score of ``THRESHOLD``.

All proposals run in time linear in the text, however long its runs of digits
or letters are: e-mail addresses are found from their ``@``, number chains are
matched possessively.

Offsets are code points, ends exclusive.  Defined cases: a null or empty text
has no spans; repeated rows give repeated results; an empty table gives an
empty result; extra columns are ignored by ``scan``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.llm.common import ensure_python_package, query, table

THRESHOLD = 0.5
NEAR = 40                                     # characters of context on each side

# Kinds in report order, their score without context, the words
# that raise it and the words that lower it.
KINDS = {
    "email": (0.9, ("mail", "contact", "e-mail", "write"), ("example", "noreply")),
    "ip": (0.6, ("ip", "address", "host", "server"), ("version", "release")),
    "card": (0.8, ("card", "visa", "credit", "payment"), ("order", "invoice", "isbn")),
    "phone": (0.7, ("phone", "call", "tel", "mobile", "fax"), ("version", "price")),
    "iban": (0.6, ("iban", "account", "bank", "transfer"), ("serial", "part")),
    "ssn": (0.3, ("ssn", "social", "security", "taxpayer"), ("phone", "part", "order")),
    "secret": (0.8, ("token", "secret", "password", "key"), ("example", "sample", "placeholder")),
}
BASE = ("email", "ip", "card", "phone")
STEP = 0.3                                    # what one context word moves

# Characters of a country's account numbers.
LENGTHS = {x[:2]: int(x[2:]) for x in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 "
    "ES24 FI18 FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 "
    "LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 "
    "PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 "
    "YE30").split()}

_ALNUM = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)++")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
# a value behind = or :, and the word of a secret before that
_VALUE = re.compile(r"[=:][\x20\"']{0,3}([A-Za-z0-9+/_.=-]{16,})")
_SECRET = re.compile(r"(?:token|secret|passw(?:or)?d|api[_ -]?key|access[_ -]?key|private[_ -]?key|credential)s?[\"']?\x20{0,3}$",
                     re.IGNORECASE)
ENTROPY = 3.0                                 # bits a character that a secret has at least
_ANY = re.compile(r"[0-9@=:]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) << (k & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod97(account: str) -> bool:
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    for chain in _DOTTED.finditer(text):
        parts, start = chain[0].split("."), chain.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k:k + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield start, end
            start = end + 1


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
            yield m.span()


def _accounts(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    while m := _IBAN.search(text, at):
        start, at = m.start(), m.start() + 4
        # the words behind an account may look like more of it: the end at a
        # word boundary that gives a listed country's length counts
        ends = [(account, end) for end in range(m.end(), start + 14, -1)
                if text[end - 1] != " " and text[end:end + 1] not in _ALNUM
                and len(account := text[start:end].replace(" ", "")) == LENGTHS.get(account[:2])]
        for account, end in ends:
            if mod97(account):
                yield start, end
                at = end
                break


def _numbers(text: str) -> Iterator[tuple[int, int]]:
    for m in _SSN.finditer(text):
        area, group, serial = m[0].split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield m.span()


def entropy(value: str) -> float:
    """Bits a character by the value's own frequencies."""
    counts = [value.count(c) / len(value) for c in set(value)]
    return -sum(p * math.log2(p) for p in counts)


def _secrets(text: str) -> Iterator[tuple[int, int]]:
    for m in _VALUE.finditer(text):
        if _SECRET.search(text, max(0, m.start() - NEAR), m.start()) and entropy(m[1]) >= ENTROPY:
            yield m.span(1)


FINDERS = {"email": _emails, "ip": _addresses, "card": _cards, "phone": _phones,
           "iban": _accounts, "ssn": _numbers, "secret": _secrets}


def context_score(text: str, kind: str, start: int, end: int) -> float:
    """The kind's score, moved by the words within ``NEAR`` characters."""
    score, up, down = KINDS[kind]
    around = set(re.findall(r"[a-z-]+", (text[max(0, start - NEAR):start] + " " + text[end:end + NEAR]).lower()))
    score += STEP * (any(w in around for w in up) - any(w in around for w in down))
    return min(1.0, max(0.0, score))


def find(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) in report order."""
    if not _ANY.search(text):
        return []
    out = []
    for kind, finder in FINDERS.items():
        for start, end in finder(text):
            score = context_score(text, kind, start, end)
            if kind in BASE or score >= THRESHOLD:
                out.append((kind, start, end, round(score, 6)))
    return out


SPANS = "doc_id long, spans array<struct<kind: string, start: int, end: int, score: double, value: string>>"


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, spans: one row per document, each span with kind, place, score
    and text."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                               ("score", pa.float64()), ("value", pa.string())]))

    def run(batches):
        for b in batches:
            spans = []
            for t in b.column("text"):
                text = t.as_py() or ""
                spans.append([{"kind": k, "start": s, "end": e, "score": x, "value": text[s:e]}
                              for k, s, e, x in find(text)])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(spans, kind)],
                                             names=["doc_id", "spans"])

    ensure_python_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
                       ).mapInArrow(run, SPANS)


def redact(docs: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id and the text with each span replaced by its kind in brackets."""
    joined = docs.select("doc_id", "text").join(found, "doc_id")
    starts = F.sort_array(F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    built = F.aggregate(starts, F.struct(F.lit("").alias("t"), F.lit(0).alias("at")), lambda acc, s: F.when(
        s["start"] < acc["at"], acc).otherwise(F.struct(F.concat(
            acc["t"], F.substring("text", acc["at"] + 1, s["start"] - acc["at"]),
            F.lit("["), s["kind"], F.lit("]")).alias("t"), s["end"].alias("at"))),
        lambda acc: F.concat(acc["t"], F.substring("text", acc["at"] + 1, F.length("text"))))
    return joined.select("doc_id", built.alias("text"))


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query("op8_pii")
def op8(spark, sf_dir):
    """Personal data in all ``documents``."""
    found = scan(table(spark, sf_dir, "documents"))
    count = {k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}") for k in BASE}
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    scores = F.array_join(F.transform("spans", lambda s: F.round(s["score"], 6).cast("string")), ",")
    return found.select("doc_id", *count.values(), F.sha2(_joined(base), 256).alias("base_sha256"),
                        _joined(F.col("spans")).alias("spans"), scores.alias("scores"))
