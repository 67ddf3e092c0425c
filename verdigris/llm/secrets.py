"""Op 10, secret scans: multipart credentials are linked within a scope.

A scope is a block of text between blank lines.  Parts of a credential are
access identifiers, secrets and endpoints, each with code-point offsets.  The
strong patterns (assign, access, hex) are always reported.  Weak candidates
(short assigned values, opaque tokens, account names, endpoints) are reported
only when a complementary part stands elsewhere in the same scope, however far:
parts that overlap are one thing written once, and do not complement each other,
and what lies within an endpoint belongs to it.  Each part's partner is the
nearest one; parts are sorted by where they start and end and joined as
intervals by bisection, so a text with many parts costs n log n and no pair is
emitted.

Defined cases: a null text counts as empty and has no spans; a null id is kept;
repeated rows give repeated results; further columns of the input are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_batches, texts

BASE_KINDS = ("assign", "access", "hex")
WEAK_KINDS = ("weak_assign", "weak_token", "weak_account", "endpoint")

_RANK = {k: i for i, k in enumerate((*BASE_KINDS, *WEAK_KINDS))}

SPANS = "array<struct<kind:string,start:long,end:long,partner:string>>"

_SEPARATOR = re.compile(r"[:=]")
_KEYWORD = re.compile(r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])\Z")
_LONGEST = 8
_VALUE = re.compile(r"\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")
_ACCOUNT = re.compile(r"(?:[uU]ser(?:name)?|[lL]ogin|[aA]ccount|[cC]lient_?[iI][dD])[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9@._-]{3,}")
_ENDPOINT = re.compile(r"(?:https?|ftp|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\s\"'<>]+")
_BLANK = re.compile(r"\n[\x20\t\r]*\n")

#: What each kind is part of a credential as, and what it must meet.
_ROLE = {"assign": "secret", "hex": "secret", "weak_assign": "secret", "weak_token": "secret", "access": "identifier", "weak_account": "identifier", "endpoint": "endpoint"}


def _assigned(t: str, least: int, most: float) -> Iterator[tuple[int, int]]:
    """Assignments to a keyword whose value has so many characters.

    The keyword stands just before the separator, so each [:=] is looked at
    once; what lies within an earlier match, failed or not, is passed over.
    """
    last = 0
    for m in _SEPARATOR.finditer(t):
        at = m.start()
        if at < last:
            continue
        back = at
        while back > last and t[back - 1] == " ":
            back -= 1
        if back > last and t[back - 1] in "\"'":
            back -= 1
        low = max(last, back - _LONGEST)
        if (word := _KEYWORD.search(t[low:back])) and (value := _VALUE.match(t, at + 1)):
            last = value.end()
            if least <= value.end(1) - value.start(1) <= most:
                yield low + word.start(), last


def _entropy(s: str) -> float:
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())


def _opaque(s: str) -> bool:
    return any(map(str.isdigit, s)) and any(map(str.islower, s)) and any(map(str.isupper, s)) and _entropy(s) >= 3.5


class _Disjoint:
    """Intervals, some of which may overlap, merged to disjoint ones."""

    def __init__(self, parts: list[tuple[int, int]]):
        self.starts, self.ends = [], []
        for a, b in sorted(parts):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def free(self, a: int, b: int) -> bool:
        """True if nothing of a to b is in any of them."""
        k = bisect.bisect_left(self.starts, b)
        return k == 0 or self.ends[k - 1] <= a


def spans_of(text: str | None) -> list[tuple[str, int, int, str | None]]:
    """(kind, start, end, kind of the part it is linked with or None) by start, then kind as listed."""
    t = text or ""
    strong = [("assign", a, b) for a, b in _assigned(t, 12, math.inf)]
    if "AKIA" in t:
        strong += [("access", *m.span()) for m in _ACCESS.finditer(t) if m.end() - m.start() >= 18]
    strong += [("hex", *m.span()) for m in _HEX.finditer(t)]
    taken = _Disjoint([x[1:] for x in strong])
    endpoints = [("endpoint", *m.span()) for m in _ENDPOINT.finditer(t)] if "://" in t else []
    endpoints = [x for x in endpoints if taken.free(*x[1:])]
    weak = [("weak_assign", a, b) for a, b in _assigned(t, 6, 11)]
    weak += [("weak_token", *m.span()) for m in _TOKEN.finditer(t) if _opaque(m[0])]
    weak += [("weak_account", *m.span()) for m in _ACCOUNT.finditer(t)] if "=" in t or ":" in t else []
    taken = _Disjoint([x[1:] for x in (*strong, *endpoints)])
    weak = [*endpoints, *(x for x in weak if taken.free(*x[1:]))]
    if len(strong) + len(weak) < 2:
        return [(*x, None) for x in strong]
    breaks = [m.start() for m in _BLANK.finditer(t)]
    scope = lambda at: bisect.bisect_right(breaks, at)
    by_role = {role: ([], []) for role in ("identifier", "secret", "endpoint")}
    for k, a, b in [*strong, *weak]:
        by_role[_ROLE[k]][0].append((a, _RANK[k], a, k))
        by_role[_ROLE[k]][1].append((b, -_RANK[k], a, k))
    for parts in by_role.values():
        for way in parts:
            way.sort()

    def partner(kind: str, a: int, b: int) -> str | None:
        """The nearest complementary part of the scope: the last to end before a, or the first to start after b; of equally near ones the kind listed first.  Two endpoints or two secrets make no credential."""
        best: tuple[int, int, str] | None = None
        for role, (by_start, by_end) in by_role.items():
            if role == _ROLE[kind]:
                continue
            k, n = bisect.bisect_right(by_end, (a, math.inf)), bisect.bisect_left(by_start, (b,))
            near = [(a - y, -nth, other, x) for y, nth, x, other in by_end[max(0, k - 1) : k]]
            near += [(x - b, nth, other, x) for _, nth, x, other in by_start[n : n + 1]]
            for gap, nth, other, x in near:
                if scope(x) == scope(a) and (best is None or (gap, nth) < best[:2]):
                    best = gap, nth, other
        return best and best[2]

    linked = [(k, a, b, partner(k, a, b)) for k, a, b in weak]
    return sorted([*((k, a, b, partner(k, a, b)) for k, a, b in strong), *(x for x in linked if x[3])], key=lambda x: (x[1], _RANK[x[0]]))


def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, spans (array of kind, start, end, partner) for each row of df."""
    kind = df.schema[id_col].dataType

    def scan(batches):
        for b in batches:
            rows = [[{"kind": k, "start": a, "end": e, "partner": p} for k, a, e, p in spans_of(t)] for t in texts(b)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("partner", pa.string())])))], names=["id", "spans"])

    return text_batches(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))).mapInArrow(scan, f"id {kind.simpleString()}, spans {SPANS}").withColumnRenamed("id", id_col)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    named = lambda kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    joined = lambda a: F.concat_ws(",", F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    return found.select(
        "doc_id",
        *[F.size(named([k])).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(joined(named(BASE_KINDS)), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
