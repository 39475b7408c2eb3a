"""Personal data in texts.

Regular expressions propose spans, checksums confirm them (Luhn for card numbers,
mod 97 for IBANs), and context words nearby move a span's score: a card next to "card"
is likelier one than a long number in a table. Every span that passes its kind's check
is kept whatever its score, also the IBANs, which the method adds.

Every expression is run so that its time is linear in the text: e-mail addresses are
found by their @ and extended to the left, and runs of digits are tried once only.

Texts are read where they are, in batches; nothing is shuffled and a text is never
cut. Defined results: a null text counts as empty and has no spans; positions are code
points, the end exclusive; repeated rows are reported each.
"""

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds in the order of the report; the first four are the base.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban")

#: Points of a confirmed span by kind, and what a context word within CONTEXT
#: characters adds to it.
START = {"email": 0.9, "ip": 0.5, "card": 0.7, "phone": 0.6, "iban": 0.8}
BONUS = 0.3
CONTEXT = 40
WORDS = {
    "email": re.compile(r"(?i)mail|contact|write to"),
    "ip": re.compile(r"(?i)\bip\b|address|host|server"),
    "card": re.compile(r"(?i)card|visa|credit|payment"),
    "phone": re.compile(r"(?i)phone|call|tel\b|mobile|fax"),
    "iban": re.compile(r"(?i)iban|account|bank|transfer"),
}

_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: What an IBAN begins with, and what it goes on with; where it ends is tried.
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?:\x20?[A-Z0-9]){11})")
_REST = re.compile(r"(?:\x20?[A-Z0-9]){11,30}")


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int
    score: float

    def __str__(self) -> str:
        return f"{self.kind}:{self.start}:{self.end}"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else sum(divmod(2 * d, 10))
    return total % 10 == 0


def mod97(text: str) -> bool:
    moved = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end = 0
    for found in _DOMAIN.finditer(text):
        at = start = found.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            end = found.end()
            yield start, end


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Confirmed IBANs: of the ends before a space or sign that leave mod 97 right, the
    longest. What follows an IBAN may look like more of it."""
    end = 0
    for found in _IBAN.finditer(text):
        if found.start() < end:
            continue
        upto = _REST.match(text, found.end()).end()
        while upto > found.end():
            if not text[upto : upto + 1].isascii() or not text[upto : upto + 1].isalnum():
                if _fits("iban", text[found.start() : upto]):
                    end = upto
                    yield found.start(), end
                    break
            upto = text.rfind(" ", found.end(), upto)


def _fits(kind: str, text: str) -> bool:
    """Whether a proposed span passes its kind's check."""
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))
    digits = _digits(text)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "iban":
        return 15 <= len(text.replace(" ", "")) <= 34 and mod97(text.replace(" ", ""))
    return True


def _score(kind: str, text: str, start: int, end: int) -> float:
    near = text[max(0, start - CONTEXT) : start] + "\n" + text[end : end + CONTEXT]
    return min(1.0, START[kind] + (BONUS if WORDS[kind].search(near) else 0.0))


def spans(text: str) -> list[Span]:
    """All confirmed spans, by kind and then by start."""
    out = []
    for kind in KINDS:
        if kind == "email":
            proposed = _emails(text) if "@" in text else ()
        elif kind == "phone" and "+" not in text:
            proposed = ()
        elif kind == "iban":
            proposed = _ibans(text)
        else:
            pattern = {"ip": _IP, "card": _CARD, "phone": _PHONE}[kind]
            proposed = (m.span() for m in pattern.finditer(text))
        for start, end in proposed:
            if _fits(kind, text[start:end]):
                out.append(Span(kind, start, end, _score(kind, text, start, end)))
    return out


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column("text"):
            found = spans(text.as_py() or "")
            base = ",".join(str(s) for s in found if s.kind in BASE)
            rows.append(
                {f"n_{k}": sum(s.kind == k for s in found) for k in KINDS}
                | {
                    "base_sha256": hashlib.sha256(base.encode()).hexdigest(),
                    "spans": ",".join(map(str, found)),
                    "scores": [s.score for s in found],
                }
            )
        made = pa.RecordBatch.from_pylist(rows, _SHAPE)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made.columns], ["doc_id", *made.schema.names])


_SHAPE = pa.schema(
    [
        *[(f"n_{k}", pa.int64()) for k in KINDS],
        ("base_sha256", pa.string()),
        ("spans", pa.string()),
        ("scores", pa.list_(pa.float64())),
    ]
)


def personal_data(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """A row per row of ``docs``: the number of spans of each kind, the hash of the base
    spans, all spans as kind:start:end, and their scores."""
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return texts.mapInArrow(_report, f"doc_id long, {counts}, base_sha256 string, spans string, scores array<double>")


def masked(text: str) -> str:
    """The text with every span replaced by its kind in brackets."""
    out, at = [], 0
    for s in sorted(spans(text), key=lambda s: (s.start, -s.end)):
        if s.start >= at:
            out += [text[at : s.start], f"[{s.kind.upper()}]"]
            at = s.end
    return "".join([*out, text[at:]])
