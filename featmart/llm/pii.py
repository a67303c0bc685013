"""Personal data: expressions propose spans, checksums confirm them, words nearby raise or lower their score.

Kinds with a pattern that is telling enough are always reported (email, ip, card, phone). Others are reported when checksum and
context carry them over `MIN_SCORE`: bank accounts (iban) by their country's length and mod 97, social security numbers (ssn) by their valid ranges and a word that
names them, phone numbers without a country (local_phone) by a word that names a phone. Context words are whole words outside the span; such as speak
for a kind raise its score, such as speak against it (examples, version and order numbers) lower it. Positions are code points, ends exclusive.

A null text counts as empty and gives no spans. Repeated rows get the same spans. An empty table gives no rows. All patterns
take time in proportion to the text, whatever it holds.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import text_of

BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("iban", "ssn", "local_phone")
KINDS = BASE_KINDS + MORE_KINDS
MIN_SCORE = 0.5
NEARBY = 48
SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"
Span = tuple[str, int, int, float]

# Words that speak for a kind when they stand near it, in lower case.
CONTEXT = {
    "email": ("mail", "contact", "correo", "courriel"),
    "ip": ("ip", "address", "host", "server", "adresse"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social security", "social-security"),
    "local_phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"),
}
# Words that speak against a kind when they stand near it.
_PRETENDED = ("example", "sample", "dummy", "beispiel", "exemple", "ejemplo")
CONTRARY = {
    "email": _PRETENDED,
    "ip": (*_PRETENDED, "version", "release", "section", "chapter"),
    "card": (*_PRETENDED, "isbn", "serial", "tracking", "order"),
    "phone": (*_PRETENDED, "isbn", "serial", "order"),
    "iban": (*_PRETENDED, "serial", "part"),
    "ssn": (*_PRETENDED, "serial", "part", "order"),
    "local_phone": (*_PRETENDED, "isbn", "serial", "part", "order", "invoice"),
}
# Characters of a bank account number by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28,
    "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18,
    "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32,
    "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24,
    "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28,
    "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}
# What a pattern alone is worth, and what its checksum or range check adds.
PRIOR = {"email": 0.8, "ip": 0.5, "card": 0.4, "phone": 0.6, "iban": 0.3, "ssn": 0.2, "local_phone": 0.3}
CONFIRMED = {"email": 0.0, "ip": 0.1, "card": 0.4, "phone": 0.1, "iban": 0.4, "ssn": 0.2, "local_phone": 0.0}
NAMED, DENIED = 0.2, 0.2

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])")
_ANY_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    """The checksum of card numbers."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def mod97(account: str) -> bool:
    """The checksum of bank account numbers: country and check digits go last, letters count from 10 on."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int, bool]]:
    """From each @ as far left as its characters go, so that long runs without one cost nothing."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done, True
        at = text.find("@", max(done, at + 1))


def ips(text: str) -> Iterator[tuple[int, int, bool]]:
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            yield m.start(), m.end(), True


def cards(text: str) -> Iterator[tuple[int, int, bool]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NOT_DIGIT.sub("", m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.start(), m.end(), True


def phones(text: str) -> Iterator[tuple[int, int, bool]]:
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            yield m.start(), m.end(), True


def ibans(text: str) -> Iterator[tuple[int, int, bool]]:
    """As many characters as the country's accounts have, if no letter or digit follows and the checksum is right: words in capitals may follow a number."""
    for m in _IBAN.finditer(text):
        length = IBAN_LENGTHS.get(m.group()[:2])
        if length is None:
            continue
        end = m.start()
        for _ in range(length):
            end += end < len(text) and text[end] == " "
            end += 1
        account = text[m.start() : end].replace(" ", "")
        if end <= m.end() and len(account) == length and not text[end : end + 1].isalnum() and mod97(account):
            yield m.start(), end, True


def ssns(text: str) -> Iterator[tuple[int, int, bool]]:
    for m in _SSN.finditer(text):
        area, group, serial = m.groups()
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield m.start(), m.end(), True


def local_phones(text: str) -> Iterator[tuple[int, int, bool]]:
    for m in _LOCAL_PHONE.finditer(text):
        yield m.start(), m.end(), False


FINDERS = {"email": emails, "ip": ips, "card": cards, "phone": phones, "iban": ibans, "ssn": ssns, "local_phone": local_phones}


def _whole_words(words: tuple[str, ...]) -> re.Pattern:
    return re.compile(rf"(?<!\w)(?:{'|'.join(map(re.escape, words))})(?!\w)", re.IGNORECASE)


_SPEAKS_FOR = {kind: _whole_words(words) for kind, words in CONTEXT.items()}
_SPEAKS_AGAINST = {kind: _whole_words(words) for kind, words in CONTRARY.items()}


def _is_near(words: re.Pattern, text: str, start: int, end: int) -> bool:
    """Whether one of the words is among the characters before or behind the span; a word that the edge cuts is none."""
    for first, last in ((max(0, start - NEARBY), start), (end, min(len(text), end + NEARBY))):
        m = words.search(text, first, last)
        if m and (m.end() < last or last in (start, len(text)) or not (text[last].isalnum() or text[last] == "_")):
            return True
    return False


def scored(text: str, kind: str, start: int, end: int, confirmed: bool) -> float:
    score = PRIOR[kind] + CONFIRMED[kind] * confirmed
    score += NAMED * _is_near(_SPEAKS_FOR[kind], text, start, end) - DENIED * _is_near(_SPEAKS_AGAINST[kind], text, start, end)
    return round(min(1.0, max(0.0, score)), 2)


class Covered:
    """The characters of some spans, as stretches in order that do not touch."""

    def __init__(self, spans: list[Span]) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []
        for _, start, end, _ in sorted(spans, key=lambda s: s[1]):
            if self.ends and start <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def overlaps(self, start: int, end: int) -> bool:
        i = bisect_right(self.ends, start)
        return i < len(self.starts) and self.starts[i] < end


def find(text: str | None) -> list[Span]:
    """All spans of one text, by kind as listed, then by start. Further kinds leave out what a span of another kind before them covers."""
    spans: list[Span] = []
    if not text:
        return spans
    digits = _ANY_DIGIT.search(text) is not None
    for kind, finder in FINDERS.items():
        if kind != "email" and not digits:
            continue
        covered = Covered(spans if kind in MORE_KINDS else [])
        for start, end, confirmed in finder(text):
            if covered.overlaps(start, end):
                continue
            score = scored(text, kind, start, end, confirmed)
            if kind in BASE_KINDS or score >= MIN_SCORE:
                spans.append((kind, start, end, score))
    return spans


def pii_spans(text: str) -> Column:
    """An array of (kind, start, end, score) of the text column."""

    @F.pandas_udf(SPANS)
    def spans(texts: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(("kind", "start", "end", "score"), s)) for s in find(t)] for t in texts], dtype=object)

    return spans(text_of(text))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id and spans."""
    return docs.select(F.col(id_col), pii_spans(text).alias("spans"))
