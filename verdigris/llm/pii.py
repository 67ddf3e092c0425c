"""Op 5, personal data: patterns propose spans, checksums confirm them, context adjusts the score.

Every proposed span has a kind, code-point offsets (end exclusive) and a score
from 0 to 1.  The base kinds (email, ip, card, phone) are reported whatever
their score; the added kinds (iban, ssn, birthdate) need at least
``min_score``, which words nearby can give or take.

Defined cases: a null text counts as empty and has no spans; a null id is kept;
repeated rows give repeated results; further columns of the input are ignored;
an empty table gives an empty result.  Each pattern is scanned in time linear
in the text, also for runs of many thousand characters without a break.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_batches, texts

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "ssn", "birthdate")
CONTEXT_CHARS = 40
MIN_SCORE = 0.6

SPANS = "array<struct<kind:string,start:long,end:long,score:double>>"

_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9][0-9.]*")
_GROUPS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_DATE = re.compile(r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4})(?![0-9./-])")

#: Words that make a kind likelier within CONTEXT_CHARS code points of a span, and words that make it less likely.
_FOR = {
    "email": ("mail", "contact", "write to", "kontakt", "correo", "courriel"),
    "ip": ("ip", "server", "host", "address", "client", "login"),
    "card": ("card", "visa", "mastercard", "amex", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "telefon", "téléphone", "teléfono"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta", "transfer"),
    "ssn": ("ssn", "social security", "tax id", "taxpayer"),
    "birthdate": ("born", "birth", "dob", "geboren", "geburt", "né le", "née le", "naissance", "nacido", "nacida", "nacimiento"),
}
_AGAINST = ("version", "isbn", "example", "order no", "invoice", "serial", "sample")
#: Score before context: what the pattern alone says, and with its check passed.
_PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.35, "birthdate": 0.3}


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """The ISO 13616 check: moved to the end and read as digits, it leaves 1."""
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(t: str) -> Iterator[tuple[int, int]]:
    last, at = 0, t.find("@")
    while at >= 0:
        start = at
        while start > last and _LOCAL_END.match(t, start - 1):
            start -= 1
        if start < at and (m := _DOMAIN.match(t, at + 1)):
            yield start, m.end()
            last = m.end()
        at = t.find("@", max(at + 1, last))


def _ips(t: str) -> Iterator[tuple[int, int]]:
    for token in _DOTTED.finditer(t):
        if token[0].count(".") < 3:
            continue
        for run in _GROUPS.finditer(t, *token.span()):
            parts, at = run[0].split("."), run.start()
            for k in range(0, len(parts) - 3, 4):
                four = parts[k : k + 4]
                end = at + sum(map(len, four)) + 3
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
                    yield at, end
                at = end + 1


def _cards(t: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(t):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(t: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(t):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            yield m.span()


def _ibans(t: str) -> Iterator[tuple[int, int]]:
    for m in _IBAN.finditer(t):
        plain = m[0].replace(" ", "")
        if 15 <= len(plain) <= 34 and mod97(plain):
            yield m.span()


def _ssns(t: str) -> Iterator[tuple[int, int]]:
    for m in _SSN.finditer(t):
        area, group, serial = m[0].split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield m.span()


def _dates(t: str) -> Iterator[tuple[int, int]]:
    yield from (m.span() for m in _DATE.finditer(t))


_FINDERS = {"email": _emails, "ip": _ips, "card": _cards, "phone": _phones, "iban": _ibans, "ssn": _ssns, "birthdate": _dates}


def _score(t: str, kind: str, start: int, end: int) -> float:
    around = f"{t[max(0, start - CONTEXT_CHARS) : start]} {t[end : end + CONTEXT_CHARS]}".lower()
    words = lambda some: any(re.search(rf"(?<!\w){re.escape(w)}", around) for w in some)
    return round(min(1.0, max(0.0, _PRIOR[kind] + 0.35 * words(_FOR[kind]) - 0.2 * words(_AGAINST))), 2)


def spans_of(text: str | None, min_score: float = MIN_SCORE) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by kind as listed, then start."""
    t, found = text or "", []
    base: list[tuple[int, int]] = []
    for kind in BASE_KINDS:
        mine = list(_FINDERS[kind](t))
        base += mine
        found += [(kind, a, b, _score(t, kind, a, b)) for a, b in mine]
    base.sort()
    for kind in ADDED_KINDS:
        for a, b in _FINDERS[kind](t):
            k = bisect.bisect_left(base, (b, b))
            if any(x < b and y > a for x, y in base[max(0, k - len(BASE_KINDS)) : k]):
                continue  # a base span has it
            if (s := _score(t, kind, a, b)) >= min_score:
                found.append((kind, a, b, s))
    return found


def find_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """id, spans (array of kind, start, end, score) for each row of df."""
    kind = df.schema[id_col].dataType

    def scan(batches):
        for b in batches:
            rows = [[{"kind": k, "start": a, "end": e, "score": s} for k, a, e, s in spans_of(t, min_score)] for t in texts(b)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])))], names=["id", "spans"])

    return text_batches(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))).mapInArrow(scan, f"id {kind.simpleString()}, spans {SPANS}").withColumnRenamed("id", id_col)


def redact(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """df with every span of text_col replaced by <KIND>; overlapping spans become one."""
    def cover(batches):
        for b in batches:
            out = []
            for t in texts(b, text_col):
                parts, last = [], 0
                for k, a, e, _ in sorted(spans_of(t, min_score), key=lambda x: (x[1], -x[2])):
                    if a >= last:
                        parts += [t[last:a], f"<{k.upper()}>"]
                    last = max(last, e)
                out.append("".join([*parts, t[last:]]))
            k = b.schema.get_field_index(text_col)
            yield b.set_column(k, b.schema.field(k), pa.array(out, b.schema.field(k).type))

    return text_batches(df).mapInArrow(cover, df.schema)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))
    named = lambda kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    joined = lambda a: F.concat_ws(",", F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    return found.select(
        "doc_id",
        *[F.size(named([k])).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(joined(named(BASE_KINDS)), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        F.concat_ws(",", F.transform("spans", lambda s: F.format_number(s["score"], 2))).alias("scores"),
    )
