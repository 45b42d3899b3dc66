"""Secret scans: fixed patterns, and sliding-window entropy over candidate strings.

Candidates are runs of key characters. Over each, a window of ``WINDOW`` characters
slides; the Shannon entropy of the characters in it is kept by incremental counts (one
character in, one out). A window is judged by its character class (hexadecimal, or the
larger key alphabet), and only if it mixes letters and digits as keys do. Windows over the
threshold are joined to spans. An allow-list suppresses what is known to be
harmless: of the parts between slashes, UUIDs and words of a path, and known example keys (an
example word beside a key frees nothing). A window counts unless all of it lies in such parts, so a key after a path
stays. The patterns have one way to match a string, so long strings take linear time. Spans of the fixed patterns always stay; the
entropy adds spans only where none of those lies. If a joined span meets one of those, what is left of it
on either side with a hot window of its own is a span of kind ``beside``.

Whole texts are scanned; nulls and empty texts have no spans. A text is one task's row,
read in one pass with bounded memory besides it.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: the kinds and patterns of the base scan, in the order of listing
KINDS = ("assign", "access", "hex", "entropy", "beside")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")       # greedy: of [0-9a-f]+ those of 24 or more
_WORDS = ("passw", "secret", "token", "api")

WINDOW = 20
#: Bits a character, over a window of 20 (at most 4.32): random hexadecimal has 3.4
#: on average, random key characters 4.1.
THRESHOLD = {"hex": 2.9, "key": 3.6}
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % WINDOW)
# a word (or words in camel case; up to four digits after three letters), capitals, a letter, a number or version
_TOKEN = r"(?:(?:[A-Z]?[a-z]{2,}+)++(?:(?<=[a-z]{3})[0-9]{1,4}+)?|[A-Z]{2,}+|[A-Za-z]|[vV]?[0-9]{1,8}+)"
_PART = rf"{_TOKEN}(?:[_-]++{_TOKEN})*+"
ALLOW = (
    re.compile(r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"),   # UUID
    re.compile(rf"{_PART}(?:/{_PART})++/?"),                                                       # path of words
    re.compile("wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY|sk_test_4eC39HqLyjWDarjtT1zdp7dc"),       # known examples
)
_PATH_PART = re.compile(_PART)
_HEX_CHARS = frozenset("0123456789abcdefABCDEF")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns."""
    out = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return out


def hot_windows(s: str, width: int = WINDOW, threshold: dict[str, float] = THRESHOLD):
    """Starts of the windows of ``s`` that look like key material.

    Keeps sum(c * log2 c) over the counts c of the window's characters; one character
    enters and one leaves at each step. Entropy is log2(width) minus that over width.
    """
    part = [0.0] + [c * math.log2(c) for c in range(1, width + 1)]
    count: dict[str, int] = {}
    total, digits, letters, upper, not_hex, most = 0.0, 0, 0, 0, 0, math.log2(width)
    for i, c in enumerate(s):
        for x, step in ((c, 1), (s[i - width], -1)) if i >= width else ((c, 1),):
            n = count.get(x, 0)
            total += part[n + step] - part[n]
            count[x] = n + step
            digits += step * x.isdigit()
            letters += step * x.isalpha()
            upper += step * x.isupper()
            not_hex += step * (x not in _HEX_CHARS)
        if i >= width - 1 and digits >= 2 and letters >= 3:
            kind = "key" if not_hex else "hex"
            mixed = kind == "hex" or (upper and upper < letters) or digits >= width // 4
            if mixed and most - total / width >= threshold[kind]:
                yield i - width + 1


def allowed(s: str) -> list[tuple[int, int]]:
    """Stretches of a candidate that are harmless: its allowed parts, with the slashes between neighbours."""
    uuid, path, known = ALLOW
    if uuid.fullmatch(s) or path.fullmatch(s):
        return [(0, len(s))]
    parts, at = s.split("/"), 0
    out: list[tuple[int, int]] = []
    for part in parts:
        if uuid.fullmatch(part) or (len(parts) > 1 and _PATH_PART.fullmatch(part)):
            if out and out[-1][1] == at - 1:
                out[-1] = (out[-1][0], at + len(part))
            else:
                out.append((at, at + len(part)))
        at += len(part) + 1
    return sorted(out + [m.span() for m in known.finditer(s)]) if known.search(s) else out


def entropy_spans(text: str, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Spans of joined hot windows, but for those all in allowed stretches, less ``taken``:
    entropy if they touch none of those, beside for each rest that holds a hot window."""
    out = []
    starts, ends = [], []                   # the taken spans, overlapping ones joined
    for a, b, _ in sorted(taken):
        if starts and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)

    def rests(a: int, b: int) -> list[tuple[int, int]]:
        """What of a span lies between the taken ones."""
        left, i = [], bisect_right(ends, a)
        while i < len(starts) and starts[i] < b:
            if a < starts[i]:
                left.append((a, starts[i]))
            a = ends[i]
            i += 1
        return left + [(a, b)] if a < b else left

    for m in CANDIDATE.finditer(text):
        s = m.group()
        if not any(c.isdigit() for c in s):
            continue
        harmless = allowed(s)

        def counts(at: int) -> bool:
            near = harmless[max(0, bisect_right(harmless, (at, len(s))) - 2):][:2]
            return not any(x <= at and at + WINDOW <= y for x, y in near)
        spans: list[list[int]] = []
        for at in hot_windows(s):
            if not counts(at):
                continue
            a, b = m.start() + at, m.start() + at + WINDOW
            if spans and a <= spans[-1][1]:
                spans[-1][1] = b
            else:
                spans.append([a, b])
        for a, b in spans:
            for x, y in rests(a, b):
                if (x, y) == (a, b):
                    out.append((a, b, "entropy"))
                elif any(counts(x - m.start() + at) for at in hot_windows(text[x:y])):
                    out.append((x, y, "beside"))
    return out


def scan(text: str | None) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(base spans, all spans), by start and then kind as listed."""
    base = base_spans(text or "")
    key = lambda x: (x[0], KINDS.index(x[2]))
    return sorted(base, key=key), sorted(base + entropy_spans(text or "", base), key=key)


def spell(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def redact(text: str | None) -> str | None:
    """The text with each span, overlapping ones joined, replaced by its first kind's mark."""
    if text is None:
        return None
    out, end = [], 0
    for a, b, kind in scan(text)[1]:
        if a >= end:
            out += [text[end:a], f"<{kind}>"]
        end = max(end, b)
    return "".join(out) + text[end:]


def scan_documents(docs: DataFrame) -> DataFrame:
    """A row for each row of ``docs`` (doc_id, text): counts by kind, base_sha256, spans."""

    def run(batches):
        for batch in batches:
            rows = []
            for t in batch.column(1):
                base, every = scan(t.as_py())
                n = [sum(k == kind for _, _, k in every) for kind in KINDS]
                rows.append((*n, hashlib.sha256(spell(base).encode()).hexdigest(), spell(every)))
            cols = list(zip(*rows, strict=True)) if rows else [()] * (len(KINDS) + 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:len(KINDS)]), *(pa.array(c, pa.string()) for c in cols[len(KINDS):])],
                names=["doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, n_entropy long, n_beside long, base_sha256 string, spans string")


def redact_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets replaced in text (and n_chars, if there, set anew where it was set)."""
    names = docs.columns

    def run(batches):
        at = names.index("text")
        for batch in batches:
            old = batch.column(at)
            new = pa.array([redact(t.as_py()) for t in old], pa.string())
            yield pa.RecordBatch.from_arrays([new if i == at else c for i, c in enumerate(batch.columns)], names=names)

    done = docs.mapInArrow(run, docs.schema)
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        done = done.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast(kind)))
    return done
