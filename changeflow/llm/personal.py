"""Personal data: regular expressions propose, checksums confirm, context words adjust the score.

The fixed patterns (email, ip, card, phone) give spans that always stay. Beside them the scan
proposes account numbers (``iban``, confirmed by mod-97), social security numbers (``ssn``), cards of 12 to 15
digits (``short_card``, confirmed by Luhn) and national telephone numbers (``tel``). Every span has
a score: what its kind starts with, more if a checksum confirms it, more if a word that goes
with the kind stands near, less if one does that speaks against it. Spans beside the fixed
ones need ``LEAST`` and may not touch one of those; of two that touch, the one with the higher score stays.

Texts are scanned whole, a row at a time, in linear time: runs of one character class are
entered only at their beginning, and e-mail addresses are found from their ``@`` backwards.

Defined cases: null and empty texts have no spans; repeated rows are scanned each; offsets are
in code points, ends exclusive; a span is of one kind, but spans of different fixed kinds may overlap.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: the kinds in the order of listing, and the patterns of the base scan
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "short_card", "tel")
EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_HOST = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")     # a run is entered at its first digit
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![a-z])")
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
TEL = re.compile(r"(?<![0-9+().-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])")

#: What a kind's pattern is worth by itself, and after its checksum.
START = {"email": 0.9, "ip": 0.6, "card": 0.4, "phone": 0.6, "iban": 0.4, "ssn": 0.3, "short_card": 0.1, "tel": 0.3}
CONFIRMED = 0.5
NEAR, AGAINST, LEAST, REACH = 0.3, 0.3, 0.5, 48

WORDS = {
    "email": ("email", "e-mail", "mail", "contact"),
    "ip": ("ip", "address", "host", "server", "client"),
    "card": ("card", "credit", "debit", "visa", "mastercard", "payment"),
    "phone": ("phone", "tel", "telephone", "call", "mobile", "cell", "fax"),
    "iban": ("iban", "account", "bank", "transfer"),
    "ssn": ("ssn", "social", "security", "taxpayer"),
}
WORDS |= {"short_card": WORDS["card"], "tel": WORDS["phone"]}
CONTRARY = ("version", "order", "invoice", "isbn", "issn", "serial", "sku", "part", "example", "checksum")
_WORD = re.compile(r"[a-z]+(?:-[a-z]+)?")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod97(code: str) -> bool:
    """Whether an account number's letters (as 10 to 35) and digits, its first four moved behind, leave 1."""
    left = 0
    for c in code[4:] + code[:4]:
        n = int(c, 36)
        left = (left * (100 if n > 9 else 10) + n) % 97
    return left == 1


def emails(text: str) -> list[tuple[int, int]]:
    """Found from the ``@`` backwards: a long run without one is never entered."""
    out, end = [], 0
    for m in EMAIL_HOST.finditer(text):
        at = m.start()
        while at > end and text[at - 1] in EMAIL_LOCAL:
            at -= 1
        if at < m.start():
            out.append((at, m.end()))
            end = m.end()
    return out


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """The spans of the fixed patterns by kind as listed, then start."""
    out = [(a, b, "email") for a, b in emails(text)] if "@" in text else []
    out += [(*m.span(), "ip") for m in IP.finditer(text) if all(_small(g) for g in m.groups())]
    cards = ((m.span(), _digits(m.group())) for m in CARD.finditer(text))
    out += [(*span, "card") for span, d in cards if 16 <= len(d) <= 19 and luhn(d)]
    if "+" in text:
        out += [(*m.span(), "phone") for m in PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15]
    return out


def _small(part: str) -> bool:
    """A number of at most 255, leading zeros allowed; long ones are not converted."""
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def more_spans(text: str) -> list[tuple[int, int, str]]:
    """Proposals of the other kinds, those with a checksum confirmed."""
    out = []
    for m in IBAN.finditer(text):
        # the run may go on into words in capitals: the longest stretch up to a space that confirms
        s = m.group()
        ends = [i for i in range(len(s), 14, -1) if i == len(s) or s[i] == " "]
        stop = next((i for i in ends if 15 <= len(s[:i].replace(" ", "")) <= 34 and mod97(s[:i].replace(" ", ""))), None)
        if stop:
            out.append((m.start(), m.start() + stop, "iban"))
    if "-" in text:
        out += [(*m.span(), "ssn") for m in SSN.finditer(text)]
    for m in CARD.finditer(text):
        if 12 <= m.end() - m.start():
            d = _digits(m.group())
            if 12 <= len(d) <= 15 and luhn(d):
                out.append((*m.span(), "short_card"))
    return out + [(*m.span(), "tel") for m in TEL.finditer(text)]


def score(text: str, a: int, b: int, kind: str) -> float:
    """What a span is worth: kind, checksum, and the words within ``REACH`` characters of it."""
    near = set(_WORD.findall(text[max(0, a - REACH):a].lower())) | set(_WORD.findall(text[b:b + REACH].lower()))
    s = START[kind] + (CONFIRMED if kind in ("card", "iban", "short_card") else 0)
    s += NEAR if near & set(WORDS[kind]) else 0
    s -= AGAINST if near & set(CONTRARY) else 0
    return round(min(1.0, max(0.0, s)), 2)


def scan(text: str | None) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str, float]]]:
    """(base spans, all spans with scores), by kind as listed and then start."""
    text = text or ""
    base = base_spans(text)
    rated = [(*x, score(text, *x)) for x in more_spans(text)]
    taken: list[tuple[int, int]] = []
    for a, b, _ in sorted(base):
        if taken and a < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(b, taken[-1][1]))
        else:
            taken.append((a, b))
    more = [x for x in rated if x[3] >= LEAST and _free(taken, x[0], x[1])]
    kept: list[tuple[int, int, str, float]] = []
    for x in sorted(more, key=lambda x: (x[0], x[1])):                       # neighbours that touch: the better one
        if kept and x[0] < kept[-1][1]:
            if x[3] > kept[-1][3]:
                kept[-1] = x
        else:
            kept.append(x)
    return base, sorted([(*x, score(text, *x)) for x in base] + kept, key=lambda x: (KINDS.index(x[2]), x[0]))


def _free(taken: list[tuple[int, int]], a: int, b: int) -> bool:
    i = bisect_right(taken, (a, b))
    return not (i and taken[i - 1][1] > a) and not (i < len(taken) and taken[i][0] < b)


def spell(spans) -> str:
    return ",".join(f"{x[2]}:{x[0]}:{x[1]}" for x in spans)


def mask(text: str | None) -> str | None:
    """The text with each span, overlapping ones joined, replaced by its first kind's mark."""
    if text is None:
        return None
    out, end = [], 0
    for a, b, kind, _ in sorted(scan(text)[1]):
        if a >= end:
            out += [text[end:a], f"<{kind}>"]
        end = max(end, b)
    return "".join(out) + text[end:]


def scan_documents(docs: DataFrame) -> DataFrame:
    """A row for each row of ``docs`` (doc_id, text): counts by kind, base_sha256, spans and their scores."""
    numbers = [f"n_{k}" for k in KINDS]

    def run(batches):
        for batch in batches:
            rows = []
            for t in batch.column(1):
                base, every = scan(t.as_py())
                n = [sum(x[2] == kind for x in every) for kind in KINDS]
                rows.append((*n, hashlib.sha256(spell(base).encode()).hexdigest(), spell(every), ",".join(f"{x[3]:.2f}" for x in every)))
            cols = list(zip(*rows, strict=True)) if rows else [()] * (len(KINDS) + 3)
            kinds = [pa.int64()] * len(KINDS) + [pa.string()] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))],
                                             names=["doc_id", *numbers, "base_sha256", "spans", "scores"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, ", ".join(["doc_id long", *(f"{n} long" for n in numbers), "base_sha256 string, spans string, scores string"]))


def mask_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced in text; all other columns stay as they are."""
    names = docs.columns

    def run(batches):
        at = names.index("text")
        for batch in batches:
            new = pa.array([mask(t.as_py()) for t in batch.column(at)], pa.string())
            yield pa.RecordBatch.from_arrays([new if i == at else c for i, c in enumerate(batch.columns)], names=names)

    return docs.mapInArrow(run, docs.schema)
