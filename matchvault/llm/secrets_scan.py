"""Secrets in texts, in DataFrame operations only.

Three fixed patterns give the base spans. Added to them are high-entropy strings: over each candidate string of a
character class a window slides, keeping the count of every character of the class; entering and leaving
characters change the sum of ``n log2 n`` over the counts, and with it the window's Shannon entropy. Sums are whole
numbers (in units of 2^-20), so that no rounding adds up. A candidate that an allow-list pattern matches gives none.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchvault.llm.store import set_aside

# The base patterns, in the order in which kinds are listed.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST = 6
UNIT = 1 << 20


@dataclass(frozen=True)
class CharacterClass:
    """Candidates are runs of ``alphabet`` at least ``window`` long; a window counts from ``bits`` of entropy on."""

    name: str
    alphabet: str
    window: int
    bits: float


CLASSES = (
    CharacterClass("entropy64", string.ascii_letters + string.digits + "+/_-=", 24, 4.1),
    CharacterClass("entropy16", string.digits + "ABCDEFabcdef", 24, 3.0),
)
ALLOWED = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"(?i)example|placeholder|changeme|dummy|0123456789|abcdefghij",
    r"^/?([A-Za-z_]+/)+[A-Za-z_]*$",
)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _located(text: str, pattern: str) -> str:
    """SQL array of ``(start, end, string)`` of a pattern's matches: lengths of what lies between and of matches."""
    p = _literal(pattern)
    return (
        f"aggregate(zip_with(split({text}, {p}, -1), regexp_extract_all({text}, {p}, 0), (g, h) -> struct(g AS gap, h AS hit)), "
        "struct(0 AS at, cast(array() AS array<struct<start:int,end:int,hit:string>>) AS found), "
        "(a, x) -> struct(a.at + char_length(x.gap) + coalesce(char_length(x.hit), 0) AS at, "
        "CASE WHEN x.hit IS NULL THEN a.found ELSE array_append(a.found, struct(a.at + char_length(x.gap) AS start, "
        "a.at + char_length(x.gap) + char_length(x.hit) AS end, x.hit AS hit)) END AS found), a -> a.found)"
    )


def _windows(kind: CharacterClass, hit: str) -> str:
    """SQL struct of the first start and last end of the candidate's windows with enough entropy (nulls if none)."""
    w = kind.window
    table = "array(" + ", ".join(f"{round(n * math.log2(n) * UNIT) if n else 0}L" for n in range(w + 1)) + ")"
    limit = math.floor(w * (math.log2(w) - kind.bits) * UNIT)
    alphabet, size = _literal(kind.alphabet), len(kind.alphabet)
    entering = f"instr({alphabet}, substr({hit}, i, 1))"
    leaving = f"CASE WHEN i > {w} THEN instr({alphabet}, substr({hit}, i - {w}, 1)) ELSE 0 END"
    # Leave first, then enter: counts are those of the window that ends at i.
    return (
        f"aggregate(sequence(1, char_length({hit})), "
        f"struct(array_repeat(0, {size}) AS counts, 0L AS total, cast(NULL AS int) AS low, cast(NULL AS int) AS high), "
        f"(a, i) -> transform(array(struct({entering} AS enter, {leaving} AS leave)), m -> "
        "transform(array(transform(a.counts, (n, k) -> n - CASE WHEN k + 1 = m.leave THEN 1 ELSE 0 END)), c -> "
        "transform(array(a.total"
        f" + CASE WHEN m.leave > 0 THEN {table}[c[m.leave - 1]] - {table}[c[m.leave - 1] + 1] ELSE 0L END"
        f" + {table}[c[m.enter - 1] + 1] - {table}[c[m.enter - 1]]), t -> "
        "struct(transform(c, (n, k) -> n + CASE WHEN k + 1 = m.enter THEN 1 ELSE 0 END) AS counts, t AS total, "
        f"CASE WHEN i >= {w} AND t <= {limit}L THEN coalesce(a.low, i - {w}) ELSE a.low END AS low, "
        f"CASE WHEN i >= {w} AND t <= {limit}L THEN i ELSE a.high END AS high))[0])[0])[0], "
        "a -> struct(a.low AS low, a.high AS high))"
    )


def secret_spans(docs: DataFrame, text_col: str = "text", classes=CLASSES, allowed=ALLOWED) -> DataFrame:
    """``docs`` with a column ``found``: the spans of each text, sorted by start, then kind.

    A span is ``struct(start, rank, end, kind)`` in code points, the end exclusive; kinds are assign, access, hex,
    then the character classes, by rank. Base matches are leftmost and do not overlap within a kind; those too
    short are dropped after matching. An added span never overlaps a base span of the same text. Null texts are
    empty. A column of ``docs`` named ``found`` is replaced.
    """
    empty = "cast(array() AS array<struct<start:int,end:int,hit:string>>)"
    text = F.coalesce(F.col(text_col), F.lit(""))
    lower = F.lower(text)
    named = F.contains(lower, F.lit("passw")) | F.contains(lower, F.lit("secret"))
    named = named | F.contains(lower, F.lit("token")) | F.contains(lower, F.lit("api"))
    names = ["scan__text", "scan__named", "scan__long", "scan__assign", "scan__tails", "scan__access", "scan__hex", "scan__base", *(f"scan__c{i}" for i in range(len(classes)))]
    out = docs.withColumns({"scan__text": text, "scan__named": named, "scan__long": text.rlike("[A-Za-z0-9+/=_-]{20,}")})

    def when(flag, sql, other=empty):
        return F.expr(f"CASE WHEN {flag} THEN {sql} ELSE {other} END")

    out = out.withColumns(
        {
            "scan__assign": when("scan__named", _located("scan__text", ASSIGN)),
            "scan__tails": when("scan__named", f"regexp_extract_all(scan__text, {_literal(ASSIGN)}, 2)", "cast(array() AS array<string>)"),
            "scan__access": when("scan__long AND contains(scan__text, 'AKIA')", _located("scan__text", ACCESS)),
            "scan__hex": when(f"scan__long AND scan__text RLIKE {_literal(HEX)}", _located("scan__text", HEX)),
            **{
                f"scan__c{i}": when("scan__long", _located("scan__text", f"[{_escaped(c.alphabet)}]{{{c.window},}}"))
                for i, c in enumerate(classes)
            },
        }
    )

    def spans(source, rank, kind):
        return f"transform({source}, x -> struct(x.start AS start, {rank} AS rank, x.end AS end, '{kind}' AS kind))"

    long_enough = f"filter(scan__assign, (x, i) -> char_length(scan__tails[i]) >= {ASSIGN_LEAST})"
    base = f"concat({spans(long_enough, 0, 'assign')}, {spans('scan__access', 1, 'access')}, {spans('scan__hex', 2, 'hex')})"
    out = out.withColumn("scan__base", F.expr(base))
    suppressed = " OR ".join(f"x.hit RLIKE {_literal(p)}" for p in allowed) or "false"
    added = []
    for i, c in enumerate(classes):
        measured = f"transform(filter(scan__c{i}, x -> NOT ({suppressed})), x -> struct(x.start AS start, {_windows(c, 'x.hit')} AS w))"
        kept = f"filter({measured}, y -> y.w.low IS NOT NULL)"
        made = f"transform({kept}, y -> struct(y.start + y.w.low AS start, {3 + i} AS rank, y.start + y.w.high AS end, '{c.name}' AS kind))"
        added.append(f"filter({made}, z -> NOT exists(scan__base, b -> b.start < z.end AND z.start < b.end))")
    return out.withColumn("found", F.expr(f"array_sort(concat({', '.join(['scan__base', *added])}))")).drop(*names)


def _escaped(alphabet: str) -> str:
    return "".join("\\" + c if c in "-]\\^[" else c for c in alphabet)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def redacted(docs: DataFrame, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span (overlapping ones as one) replaced by ``mark``; a null text stays null.

    All other columns come back as they are, one named ``found`` too.
    """
    joined = (
        "aggregate(found, cast(array() AS array<struct<start:int,end:int>>), (a, x) -> "
        "CASE WHEN size(a) > 0 AND element_at(a, -1).end >= x.start THEN concat(slice(a, 1, size(a) - 1), array(struct("
        "element_at(a, -1).start AS start, greatest(element_at(a, -1).end, x.end) AS end))) "
        "ELSE array_append(a, struct(x.start AS start, x.end AS end)) END)"
    )
    text = f"`{text_col}`"
    clean = (
        f"aggregate(scan__joined, struct(0 AS at, '' AS kept), (a, x) -> struct(x.end AS at, "
        f"concat(a.kept, substr({text}, a.at + 1, x.start - a.at), {_literal(mark)}) AS kept), "
        f"a -> concat(a.kept, substr({text}, a.at + 1)))"
    )
    docs, restored = set_aside(docs, "found", *(c for c in docs.columns if c.lower().startswith("scan__")))
    out = secret_spans(docs, text_col).withColumn("scan__joined", F.expr(joined))
    return restored(out.withColumn(text_col, F.expr(f"CASE WHEN size(scan__joined) > 0 THEN {clean} ELSE {text} END")))
