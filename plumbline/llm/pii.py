"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

Kinds ``email``, ``ip``, ``card`` and ``phone`` are found wherever their pattern and check hold. Further kinds need a
score of at least ``threshold``: ``iban`` (mod 97), ``ssn`` (United States, number ranges) and ``local_phone`` (no
country code). A pattern and its passed check give the start score of the kind; a word of the kind within ``CONTEXT``
characters adds to it, a word that speaks against it (order, version, page ...) takes away. The four basic kinds carry a
score too, but stay whatever it is.

Every pattern is matched in linear time, so very long texts are searched whole. Null and empty texts have no spans; each
of several equal rows gets its own row; an empty table gives an empty table. Spans of different kinds may overlap; spans
with equal starts are ordered by kind as in ``KINDS``. Other columns of the input, whatever their names, are not read.
Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "local_phone")
CONTEXT = 48
THRESHOLD = 0.7
#: Start score of a kind whose pattern and check hold.
START = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.7, "iban": 0.8, "ssn": 0.5, "local_phone": 0.4}
SUPPORT = {
    "email": r"mail|contact|write|courriel|correo|adresse",
    "ip": r"\bip\b|address|host|server|login|client",
    "card": r"card|visa|master|amex|credit|debit|karte|carte|tarjeta|\bcvv\b",
    "phone": r"phone|call|\btel\b|mobile|fax|cell|telefon|t.l.phone|tel.fono|anruf",
    "iban": r"\biban\b|bank|account|konto|compte|cuenta|\bbic\b|swift",
    "ssn": r"\bssn\b|social|security|taxpayer",
}
AGAINST = r"version|order|invoice|page|isbn|issue|part no|article no|bestell|commande|pedido"
SPAN = "array<struct<kind:string,start:int,end:int,score:double>>"

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: Runs of digits are never entered in their middle: what fails at their first digit fails at the others too.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
#: Characters of an account number by country; other countries are tried at every end of a group.
IBAN_LENGTH = {c: int(part[:2]) for part in (
    "15NO 16BE 18DKFOFIGLNLSD 19MKSI 20ATBABOEEKZLTLUXK 21CHHRLILV 22BGBHCRDEGBGEIEMERSVA 23AEGIILIQOMTLMN 24ADCZESMDPKSASESKTNVG "
    "25LYPTST 26ISTR 27BIDJFRGRITMCMRSM 28ALAZBYCYDOGTHULBNIPLSV 29BREGPSQAUA 30JOKWMU 31MTSC 32LC 33RU").split()
    for c in re.findall("..", part[2:])}
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
LOCAL_PHONE = re.compile(r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9-])")


def luhn(digits: str) -> bool:
    """The last digit makes the sum, every second digit from the right doubled, a multiple of ten."""
    total = sum(map(int, digits[::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def mod97(account: str) -> bool:
    """ISO 7064: country and check digits moved to the end, letters as 10 to 35, remainder 1."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def digits_of(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Around each @: the whole run of name characters before it, and a domain with a dot after it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1)
        if start < at and domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Accounts that end at a space or at the end of the match: the country's length first, then from the longest end on.

    The match may have swallowed the words behind an account, or begun before one: the search goes on at the end that
    passed, or behind the first group of a match without any. A match has at most 43 characters, so this stays linear.
    """
    m = IBAN.search(text)
    while m:
        ends = [m.end(), *(k for k in range(m.end() - 1, m.start(), -1) if text[k] == " ")]
        accounts = [(text[m.start():end].replace(" ", ""), end) for end in ends]
        accounts.sort(key=lambda a: len(a[0]) != IBAN_LENGTH.get(a[0][:2]))
        found = next((end for account, end in accounts if 15 <= len(account) <= 34 and mod97(account)), None)
        if found:
            yield m.start(), found
        m = IBAN.search(text, found or m.start() + 4)


def proposals(text: str) -> Iterator[tuple[str, int, int]]:
    """Spans whose pattern and check hold."""
    for start, end in emails(text):
        yield "email", start, end
    for m in IP.finditer(text):
        # a part of many digits is compared by length, so that no huge number is made
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            yield "ip", m.start(), m.end()
    for m in CARD.finditer(text):
        number = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(number) <= 19 and luhn(number):
            yield "card", m.start(), m.end()
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(digits_of(m[0])) <= 15:
                yield "phone", m.start(), m.end()
    for start, end in ibans(text):
        yield "iban", start, end
    for m in SSN.finditer(text):
        area, group, serial = m[0].split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield "ssn", m.start(), m.end()
    for m in LOCAL_PHONE.finditer(text):
        yield "local_phone", m.start(), m.end()


def score(text: str, kind: str, start: int, end: int) -> float:
    around = f"{text[max(0, start - CONTEXT):start]} {text[end:end + CONTEXT]}".lower()
    value = START[kind]
    if re.search(SUPPORT.get(kind, SUPPORT["phone"]), around):
        value += 0.3
    if re.search(AGAINST, around):
        value -= 0.3
    return round(min(1.0, max(0.0, value)), 3)


def spans_of(text: str, threshold: float = THRESHOLD) -> list[tuple[str, int, int, float]]:
    """All spans of one text by start and kind; a further kind gives way to a basic one that it overlaps."""
    found = [(kind, start, end, score(text, kind, start, end)) for kind, start, end in proposals(text)]
    base = [s for s in found if s[0] in BASE]
    more = [s for s in found if s[0] not in BASE and s[3] >= threshold
            and not any(b[1] < s[2] and s[1] < b[2] for b in base)]
    return sorted(base + more, key=lambda s: (s[1], KINDS.index(s[0])))


def pii_spans(text: Column, threshold: float = THRESHOLD) -> Column:
    """The spans of a text as an array of kind, start, end and score."""

    @F.pandas_udf(SPAN)
    def find(texts: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(("kind", "start", "end", "score"), s)) for s in spans_of(t, threshold)] if t else []
                          for t in texts], dtype=object)

    return find(text)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: the id and ``spans``."""
    return docs.select(F.col(f"`{id_col}`").alias(id_col), pii_spans(F.col(f"`{text_col}`"), threshold).alias("spans"))


def masked(text: str, threshold: float) -> str:
    """Overlapping spans become one mark that names the first kind."""
    pieces, done = [], 0
    for kind, start, end, _ in spans_of(text, threshold):
        if start >= done:
            pieces += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*pieces, text[done:]])


def redact_pii(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents with every span replaced by its kind in brackets; all rows and other columns stay. Null stays null."""

    @F.pandas_udf("string")
    def mask(texts: pd.Series) -> pd.Series:
        return pd.Series([masked(t, threshold) if t else t for t in texts], dtype=object)

    return docs.select(*[mask(F.col(f"`{c}`")).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
