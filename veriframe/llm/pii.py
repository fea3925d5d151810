"""Personal data in text: patterns propose, checksums confirm, nearby words adjust the score."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from veriframe.llm.shared import slices, with_columns

#: The kinds, those of the base first, in the order that breaks ties.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "secret")
#: Score of a confirmed span before its context is read, and what a context word nearby adds or takes.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.7, "ssn": 0.3, "secret": 0.3}
HELPS, HURTS = 0.3, 0.3
#: Spans of the further kinds count from this score on; base spans always do.
LEAST = 0.5
#: Characters on either side that are read as context.
REACH = 40
CONTEXT = {
    "email": r"e-?mail|mail|contact|write|schreiben|correo|courriel",
    "ip": r"ip|host|server|address|adresse|login",
    "card": r"card|visa|mastercard|amex|credit|payment|karte|tarjeta|carte",
    "phone": r"phone|tel|call|mobile|fax|telefon|tel[eé]fono|t[eé]l[eé]phone",
    "iban": r"iban|bank|account|konto|cuenta|compte",
    "ssn": r"ssn|social|security|sozialversicherung",
    "secret": r"token|secret|password|passwd|api[ _-]?key|access[ _-]?key|bearer|credentials?",
}
AGAINST = {
    "email": r"example",
    "ip": r"version|release|section|chapter",
    "card": r"order|isbn|serial|hash|id",
    "phone": r"order|serial|version|id",
    "iban": r"hash|token|key",
    "ssn": r"order|serial|part|invoice",
    "secret": r"commit|checksum|digest|sha-?1|sha-?256|md5",
}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}\b")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_SECRET = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}")
#: Bits a character that the characters of a key have at least.
LEAST_BITS = 3.0
_DIGITS = re.compile(r"[0-9]+")
#: Every card, address, account and security number has two digits as close as this.
_ANY = re.compile(r"[0-9][ .-]?[0-9]")
_NEAR = {k: re.compile(rf"\b(?:{v})\b", re.IGNORECASE) for k, v in CONTEXT.items()}
_FAR = {k: re.compile(rf"\b(?:{v})\b", re.IGNORECASE) for k, v in AGAINST.items()}


def luhn(digits: str) -> bool:
    """Whether every second digit from the right, doubled, and the others add up to tens."""
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) << (k & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def mod97(code: str) -> bool:
    """Whether an account number, turned by four places and with letters from 10 on, leaves 1."""
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def drawn(code: str) -> bool:
    """Whether a word has letters and digits as mixed as those of a drawn key."""
    if not any(c.isdigit() for c in code) or not any(c.isalpha() for c in code):
        return False
    return -sum(n / len(code) * log2(n / len(code)) for n in Counter(code).values()) >= LEAST_BITS


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @, left over the local part as far as the last match ended, right over the domain."""
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            yield start, domain.end()
            end = domain.end()
        at = text.find("@", max(at + 1, end))


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _addresses_and_cards(text: str) -> Iterator[tuple[str, int, int]]:
    """A match of either kind begins at the first digit of a run, or it would reach further left."""
    for found in _CARD.finditer(text):
        if 12 <= found.end() - found.start() and 12 <= len(digits := _digits(found[0])) <= 19 and luhn(digits):
            yield "card", found.start(), found.end()
    if text.count(".") < 3:
        return
    end = 0
    for run in _DIGITS.finditer(text):
        if run.start() >= end and text.startswith(".", run.end()) and (found := _IP.match(text, run.start())):
            end = found.end()
            parts = [p.lstrip("0") or "0" for p in found[0].split(".")]
            if all(len(p) <= 3 and int(p) <= 255 for p in parts):
                yield "ip", found.start(), end


def _proposed(text: str) -> Iterator[tuple[str, int, int]]:
    """Spans that their validators confirm."""
    if "@" in text:
        for start, end in _emails(text):
            yield "email", start, end
    if "+" in text:
        for found in _PHONE.finditer(text):
            if 9 <= len(_digits(found[0])) <= 15:
                yield "phone", found.start(), found.end()
    for found in _SECRET.finditer(text):
        if drawn(found[0]):
            yield "secret", found.start(), found.end()
    if not _ANY.search(text):
        return
    yield from _addresses_and_cards(text)
    for found in _IBAN.finditer(text):
        if 15 <= len(code := found[0].replace(" ", "")) <= 34 and mod97(code):
            yield "iban", found.start(), found.end()
    if "-" in text:
        for found in _SSN.finditer(text):
            if found[0][:3] not in ("000", "666") and found[0][0] != "9" and found[0][4:6] != "00" and found[0][7:] != "0000":
                yield "ssn", found.start(), found.end()


def spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """``kind, start, end, score`` of the personal data in a text, by start and kind.

    Places count code points, the end is exclusive. Spans of the four base kinds
    always stay, with their score. Those of the further kinds need ``LEAST``, which
    context gives or takes; one that overlaps a span with a higher score, or a base span
    with the same score, goes (ties to the earlier start, then to the kind listed first).
    """
    text = text or ""
    base, more = [], []
    for kind, start, end in _proposed(text):
        around = text[max(0, start - REACH):start] + "\n" + text[end:end + REACH]
        score = PRIOR[kind] + HELPS * bool(_NEAR[kind].search(around)) - HURTS * bool(_FAR[kind].search(around))
        score = round(min(1.0, max(0.0, score)), 3)
        if kind in BASE:
            base.append((kind, start, end, score))
        elif score >= LEAST:
            more.append((kind, start, end, score))
    return sorted([*base, *_not_beaten(more, base)], key=lambda s: (s[1], KINDS.index(s[0])))


def _not_beaten(more: list[tuple[str, int, int, float]], base: list[tuple[str, int, int, float]]) -> Iterator[tuple[str, int, int, float]]:
    """Spans of further kinds without a better one over the same characters, in one sweep by start."""
    rows = sorted([(s, True) for s in base] + [(s, False) for s in more], key=lambda r: (r[0][1], KINDS.index(r[0][0])))
    open_, beaten = [], set()
    for span, sure in rows:
        open_ = [o for o in open_ if o[0][2] > span[1]]
        for other, other_sure in open_:
            if other[3] > span[3] or other[3] == span[3] and (other_sure or not sure):
                beaten.add(span)
            else:
                beaten.add(other)
        open_.append((span, sure))
    return (span for span in more if span not in beaten)


SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType()),
]))


def find_pii(docs: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """The rows with an array of the spans found in their text.

    Null and empty texts have an empty array. Rows are independent, so repeated
    rows, ties and an empty table need no rule. A column of the result's name is
    replaced.
    """
    kept = docs.drop(out)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches):
        for batch, texts in slices(batches, text):
            found = [[dict(zip(("kind", "start", "end", "score"), s)) for s in spans(t)] for t in texts]
            yield with_columns(batch, {out: pa.array(found, kind)})

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(out, SPANS)]))
