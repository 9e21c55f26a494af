"""Secrets by linking the parts of a credential.

A credential is an identifier or an endpoint together with a secret.  Patterns
find *parts*: some are sure by themselves (base kinds), others are weak (a user
name, a host, a short password, a random-looking string).  A *scope* is a
stretch of a text without a blank line, section header or document mark.  The
parts of a batch are joined as intervals: each reaches ``reach`` characters to
either side, inside its scope, and the nearest complementary part there is its
partner.  Weak parts without a partner are not reported.

Scopes never cross documents, so the join runs where the text is read: nothing
is shuffled, and a hot source or a lost executor costs nothing extra.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import ready

IDENTIFIER, SECRET, ENDPOINT = range(3)

#: Roles that make a part of the role complete.
COMPLEMENTS = {IDENTIFIER: (SECRET,), ENDPOINT: (SECRET,), SECRET: (IDENTIFIER, ENDPOINT)}


@dataclass(frozen=True)
class Kind:
    """A pattern for one kind of part.  A match counts if ``group`` has at
    least ``least`` characters and ``classes`` of the four character classes.
    ``gate`` is a cheap test that every text with a match passes."""

    name: str
    role: int
    pattern: re.Pattern
    weak: bool = True
    group: int = 0
    least: int = 1
    classes: int = 0
    gate: Callable[[str], bool] = bool

    def find(self, text: str):
        if not self.gate(text):
            return
        for m in self.pattern.finditer(text):
            body = m[self.group]
            if len(body) >= self.least and (not self.classes or sum(c.search(body) is not None for c in _CLASSES) >= self.classes):
                yield m.span()


_CLASSES = [re.compile(c) for c in ("[a-z]", "[A-Z]", "[0-9]", "[+/_=-]")]
_ANY_CASE = re.ASCII | re.IGNORECASE
_GIVEN = r"""["']?\x20*[:=]\x20*["']?"""

_HEX = bytes(0x78 if chr(b) in "0123456789abcdef" else 0x20 for b in range(256))


def _has_sign(text: str) -> bool:
    return ":" in text or "=" in text


def _has_hex_run(text: str) -> bool:
    return b"x" * 32 in text.encode("latin-1", "replace").translate(_HEX)


#: Base kinds: fixed patterns and lengths.  ``hex`` finds whole runs.
BASE = (
    Kind("assign", SECRET, re.compile(rf"(password|passwd|secret|token|api_?key){_GIVEN}([A-Za-z0-9+/_.=-]+)", _ANY_CASE), False, 2, 8, gate=_has_sign),
    Kind("access", IDENTIFIER, re.compile(r"AKIA[A-Z0-9]+"), False, 0, 16),
    Kind("hex", SECRET, re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}"), False, gate=_has_hex_run),
)

#: Weak kinds, strongest first: one that overlaps a part before it is left out.
WEAK = (
    Kind("host", ENDPOINT, re.compile(rf"""\b[a-z][a-z0-9+.-]*://[^\s"'<>()]+|\b(?:host|hostname|server|endpoint|url){_GIVEN}[a-z0-9._:/-]{{3,}}""", _ANY_CASE), gate=_has_sign),
    Kind("user", IDENTIFIER, re.compile(rf"\b(?:user|username|login|client_?id|account|access_?key_?id){_GIVEN}[a-z0-9+/_.=@-]{{2,}}", _ANY_CASE), gate=_has_sign),
    Kind("short", SECRET, re.compile(rf"""\b(?:pass|passphrase|password|passwd|pwd|secret|token|api_?key|auth|credential){_GIVEN}[^\s"',;]{{4,}}""", _ANY_CASE), gate=_has_sign),
    Kind("key", SECRET, re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"), classes=3),
)

KINDS = BASE + WEAK

#: Where a scope ends: a blank line, a section header or a document mark.
SCOPE_EDGE = re.compile(r"\n[\x20\t\r]*(?=\n)|^(?=\[[^\]\n]+\]\s*$)|^---", re.MULTILINE)


def find_parts(text: str, kinds=KINDS) -> list[tuple[int, int, int]]:
    """(kind number, start, end) in code points; base kinds may overlap each
    other, a weak part overlaps nothing."""
    parts = [(k, *span) for k, kind in enumerate(kinds) if not kind.weak for span in kind.find(text)]
    for k, kind in enumerate(kinds):
        if kind.weak and (found := list(kind.find(text))):
            taken = sorted(p[1:] for p in parts)
            reach = list(accumulate((e for _, e in taken), max))
            starts = np.array([s for s, _ in taken], np.int64)
            last = np.searchsorted(starts, [e for _, e in found], side="left") - 1
            parts += [(k, s, e) for (s, e), i in zip(found, last.tolist()) if i < 0 or reach[i] <= s]
    return sorted(parts, key=lambda p: (p[1], p[0]))


def scope_of(text: str, starts: list[int]) -> np.ndarray:
    """Number of the scope of each position."""
    edges = np.array([m.end() for m in SCOPE_EDGE.finditer(text)], np.int64)
    return np.searchsorted(edges, np.array(starts, np.int64), side="right")


def partners(scope: np.ndarray, start: np.ndarray, end: np.ndarray, role: np.ndarray, reach: int) -> np.ndarray:
    """Interval join: for every part the nearest part of a complementary role
    whose interval meets its own, widened by ``reach`` and cut to the scope, or
    -1.  Parts are sorted by (scope, start); on equal gaps the earlier wins."""
    n = len(start)
    # Scopes one after the other on one line, farther apart than any reach.
    width = int(end.max(initial=0)) + reach + 2
    lo, hi = scope * width + start, scope * width + end
    best, gap_to = np.full(n, -1), np.full(n, reach + 1)
    for mine, others in COMPLEMENTS.items():
        x, y = np.flatnonzero(role == mine), np.flatnonzero(np.isin(role, others))
        if not len(x) or not len(y):
            continue
        # The part on the left that ends last, and the next on the right.
        top = np.maximum.accumulate(hi[y])
        holder = y[np.maximum.accumulate(np.where(hi[y] == top, np.arange(len(y)), 0))]
        at = np.searchsorted(lo[y], lo[x], side="right")
        for found, ok in ((holder[np.maximum(at - 1, 0)], at > 0), (y[np.minimum(at, len(y) - 1)], at < len(y))):
            gap = np.maximum(np.maximum(lo[found] - hi[x], lo[x] - hi[found]), 0)
            better = ok & (scope[found] == scope[x]) & (gap < gap_to[x])
            best[x[better]], gap_to[x[better]] = found[better], gap[better]
    return best


_PARTS = "array<struct<kind:string,start:long,end:long,base:boolean,partner:string>>"
_PART = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("partner", pa.string())])


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = 200, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``id, parts``: the parts found in every text, by start, then kind in the
    order of ``kinds``; ``partner`` is ``kind:start:end`` of the nearest
    complementary part, null for base parts that stand alone.

    One row per row of ``df``: null and empty texts have no parts, repeated
    rows and ids (null ids too) stand for themselves, texts are read whole,
    other columns are ignored; an empty table gives no rows."""
    ready(df.sparkSession)
    source = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))

    def run(batches):
        names = [k.name for k in kinds]
        for batch in batches:
            rows, parts, scopes, base = [], [], [], 0
            for n, raw in enumerate(batch.column(1).to_pylist()):
                if not raw:
                    continue
                text = raw.decode("utf-8", "replace")
                found = find_parts(text, kinds)
                if found:
                    scope = scope_of(text, [p[1] for p in found]) + base
                    base = int(scope[-1]) + 1
                    rows += [n] * len(found)
                    parts += found
                    scopes.append(scope)
            out = [[] for _ in range(batch.num_rows)]
            if parts:
                kind, start, end = np.array(parts, np.int64).T
                role = np.array([k.role for k in kinds])[kind]
                partner = partners(np.concatenate(scopes), start, end, role, reach)
                for n, (k, s, e), p in zip(rows, parts, partner.tolist()):
                    if p >= 0 or not kinds[k].weak:
                        with_ = None if p < 0 else f"{names[parts[p][0]]}:{parts[p][1]}:{parts[p][2]}"
                        out[n].append({"kind": names[k], "start": s, "end": e, "base": not kinds[k].weak, "partner": with_})
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(_PART))], names=["id", "parts"])

    return source.mapInArrow(run, f"id long, parts {_PARTS}")


def listed(parts: Column) -> Column:
    """Parts as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(parts, lambda p: F.concat_ws(":", p["kind"], p["start"].cast("string"), p["end"].cast("string"))), ",")


def digests(found: DataFrame) -> DataFrame:
    """``id, n_assign, n_access, n_hex, base_sha256, spans`` of ``scan``'s rows."""

    def count(name: str) -> Column:
        return F.size(F.filter("parts", lambda p: p["kind"] == name)).cast("long").alias(f"n_{name}")

    counts = [count(k.name) for k in BASE]
    base = listed(F.filter("parts", lambda p: p["base"]))
    return found.select("id", *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"), listed(F.col("parts")).alias("spans"))
