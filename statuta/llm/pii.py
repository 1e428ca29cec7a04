"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust their score.

The base kinds (email, ip, card, phone) are leftmost, non-overlapping matches per kind that
pass their check; a match that fails is dropped and never retried from inside.  They are kept
whatever their context.  Beyond them, a run of digits that failed as a card, or a phone number
that ran on into what follows it, is searched for a part that holds by itself, and further kinds
(iban, ssn) are looked for; these are kept only if checksum or structure and the words before them
bring the score to KEEP.

Null text counts as empty and has no spans; other columns, nulls in them and repeated rows pass
through untouched, as each row is treated alone.  All scans are linear in the text's length.
"""

from __future__ import annotations

import re
from hashlib import sha256
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuta.llm.common import give_back, map_slices, slices, texts

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")
KEEP = 0.5
WINDOW = 48

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A match can begin only where a run of digits begins, so the lookbehind loses none.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_DIGIT = re.compile(r"[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}+|(?: [A-Z0-9]{4}){2,7}+(?: [A-Z0-9]{1,3})?+)(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")

#: Words that raise or lower the score of a kind when they stand just before it.
CONTEXT = {
    "email": (r"mail|contact|write|correo|courriel|kontakt", r"example|noreply"),
    "ip": (r"ip|host|server|address|login|adresse", r"version|section|chapter|release"),
    "card": (r"card|credit|visa|master|pay|karte|carte|tarjeta", r"order|invoice|isbn|serial|tracking"),
    "phone": (r"phone|tel|call|mobile|fax|cell|telefon", r"score|total|sum"),
    "iban": (r"iban|bank|account|konto|compte|cuenta", r"part|model"),
    "ssn": (r"ssn|social|security|tax", r"part|order|serial|phone"),
}
_CONTEXT = {k: tuple(re.compile(rf"\b(?:{w})", re.IGNORECASE) for w in v) for k, v in CONTEXT.items()}
_START = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.3}


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])) % 10 == 0


def mod97(code: str) -> bool:
    """The check of international bank account numbers."""
    moved = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> list[tuple[int, int]]:
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((start, m.end()))
            free = m.end()
            at = text.find("@", free)
        else:
            free = at + 1
            at = text.find("@", at + 1)
    return found


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and int(part) <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The base kinds as listed, each by start; code points, end exclusive."""
    out = [("email", a, b) for a, b in _emails(text)]
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(map(_octet, m.groups()))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def _cards_within(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Groups of digits in a failed run that are a card number by themselves: in one piece, by fours, or 4-6-5."""
    found, groups, i = [], list(_DIGITS.finditer(text, start, end)), 0
    while i < len(groups):
        for shape in ((len(groups[i][0]),), (4, 4, 4, 4), (4, 6, 5)):
            part = groups[i : i + len(shape)]
            digits = "".join(m[0] for m in part)
            if tuple(len(m[0]) for m in part) == shape and 13 <= len(digits) <= 19 and digits[0] in "3456" and luhn(digits):
                found.append((part[0].start(), part[-1].end()))
                i += len(shape) - 1
                break
        i += 1
    return found


def _phone_within(text: str, start: int, end: int) -> tuple[int, int] | None:
    """The longest beginning of a failed phone match that ends before a blank and has 8 to 15 digits."""
    best, digits, at = None, 0, start
    while at < end and digits <= 15:
        stop = text.find(" ", at, end)
        stop = end if stop < 0 else stop
        digits += len(_DIGIT.findall(text, at, stop))
        if 8 <= digits <= 15 and text[stop - 1].isdigit():
            best = (start, stop)
        at = stop + 1
    return best


def added_spans(text: str) -> list[tuple[str, int, int]]:
    """Candidates besides the base spans."""
    out = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() > 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if not (16 <= len(digits) <= 19 and luhn(digits)):
                out += [("card", a, b) for a, b in _cards_within(text, m.start(), m.end())]
    if "+" in text:
        for m in _PHONE.finditer(text):
            if not 8 <= len(_DIGIT.findall(m[0])) <= 15 and (found := _phone_within(text, m.start(), m.end())):
                out.append(("phone", *found))
    for m in _IBAN.finditer(text):
        code = m[0].replace(" ", "")
        if 15 <= len(code) <= 34 and mod97(code):
            out.append(("iban", m.start(), m.end()))
    if "-" in text:
        out += [("ssn", m.start(), m.end()) for m in _SSN.finditer(text)]
    return out


def score(text: str, kind: str, start: int) -> float:
    before = text[max(0, start - WINDOW) : start]
    more, less = _CONTEXT[kind]
    return min(1.0, max(0.0, _START[kind] + 0.3 * bool(more.search(before)) - 0.3 * bool(less.search(before))))


def spans(text: str | None) -> list[Span]:
    """All spans by kind as listed, then start."""
    text = text or ""
    base = [Span(k, a, b, score(text, k, a)) for k, a, b in base_spans(text)]
    added = [s for s in (Span(k, a, b, score(text, k, a)) for k, a, b in added_spans(text)) if s.score >= KEEP]
    return sorted(base + added, key=lambda s: (KINDS.index(s.kind), s.start)) if added else base


def redact(text: str | None) -> str | None:
    """The text with every span, overlapping ones joined, replaced by its first kind in brackets."""
    found = sorted(spans(text), key=lambda s: (s.start, -s.end))
    if not found:
        return text
    out, at, i = [], 0, 0
    while i < len(found):
        kind, start, end, _ = found[i]
        while i < len(found) and found[i].start < end:
            end = max(end, found[i].end)
            i += 1
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join(out) + text[at:]


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with its spans as structs of kind, start, end and score."""

    def step(batch):
        found = [spans(t) for t in texts(batch.column("text"))]
        return {"doc_id": batch.column("doc_id"), "spans": [[s._asdict() for s in x] for x in found]}

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_slices(source, "doc_id long, spans array<struct<kind string, start long, end long, score double>>", step)


def report(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, and all spans as text."""

    def step(batch):
        out = {k: [] for k in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")}
        said = lambda found: ",".join(f"{k}:{a}:{b}" for k, a, b in found)
        for text in texts(batch.column("text")):
            base = base_spans(text)
            for k in BASE:
                out[f"n_{k}"].append(sum(x[0] == k for x in base))
            out["base_sha256"].append(sha256(said(base).encode()).hexdigest())
            out["spans"].append(said(x[:3] for x in spans(text)))
        return {"doc_id": batch.column("doc_id"), **out}

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return map_slices(docs.select(F.col("doc_id").cast("long"), "text"), schema, step)


def clean(docs: DataFrame) -> DataFrame:
    """Documents with personal data redacted and n_chars brought up to date; all columns stay."""
    schema = docs.schema

    def run(batches):
        import pyarrow as pa

        for batch in (part for whole in batches for part in slices(whole)):
            new = [redact(t) for t in batch.column("text").to_pylist()]
            columns = {n: batch.column(n) for n in batch.schema.names}
            columns["text"] = pa.array(new, type=batch.schema.field("text").type)
            yield pa.RecordBatch.from_arrays([columns[n] for n in batch.schema.names], names=batch.schema.names)
        give_back()

    out = docs.mapInArrow(run, schema)
    return out.withColumn("n_chars", F.length("text").cast(schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
