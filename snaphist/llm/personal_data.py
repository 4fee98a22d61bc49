"""Personal data by anchor expansion.

One pass of an Aho-Corasick automaton over each text finds at-signs, schemes, plus signs, digits and
identifier cues. From each anchor a local parser widens to the boundaries of an address, number or
account and validates it. Nothing else of the text is looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaphist.llm import words as W

# Order of kinds among spans that start alike; the first four are the base.
KINDS = ("email", "ip", "card", "phone", "account", "login")
BASE = 4

CUES = ("iban", "account", "konto", "compte", "cuenta")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"[^A-Za-z0-9]{1,8}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
_LOGIN = re.compile(r"[^\s/?#@:]+:[^\s/?#@]+@[A-Za-z0-9.-]+")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")

Span = tuple[int, int, int]


@lru_cache(maxsize=1)
def automaton():
    """Anchors by the parser they start."""
    import ahocorasick

    made = ahocorasick.Automaton()
    made.add_word("@", "@")
    made.add_word("://", ":")
    made.add_word("+", "+")
    for digit in "0123456789":
        made.add_word(digit, "0")
    for cue in CUES:
        for form in {cue, cue.upper(), cue.capitalize()}:
            made.add_word(form, "c")
    made.make_automaton()
    return made


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def _email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    begin = at
    while begin > floor and text[begin - 1] in _LOCAL:
        begin -= 1
    if begin == at:
        return None
    domain = _DOMAIN.match(text, at + 1)
    return (begin, domain.end()) if domain else None


def _addresses(text: str, at: int) -> tuple[int, list[tuple[int, int]]]:
    """The end of the dotted run that begins at ``at``, and the addresses in it, four parts each."""
    run = _DOTTED.match(text, at)
    found, parts = [], run.group().split(".")
    begin = at
    for i in range(0, len(parts), 4):
        four = parts[i : i + 4]
        end = begin + sum(map(len, four)) + len(four) - 1
        small = all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or "0") <= 255 for p in four)
        if len(four) == 4 and small:
            found.append((begin, end))
        begin = end + 1
    return run.end(), found


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _account(text: str, end: int) -> tuple[int, int] | None:
    """An international account number after a cue, by its check digits."""
    found = _IBAN.match(text, end)
    if not found:
        return None
    raw = found.group(1).replace(" ", "")
    number = int("".join(str(int(c, 36)) for c in raw[4:] + raw[:4]))
    return found.span(1) if number % 97 == 1 else None


def _login(text: str, mark: int) -> tuple[int, int] | None:
    """A url with name and password, from its scheme to its host."""
    begin = mark
    while begin > 0 and mark - begin < 16 and text[begin - 1] in _SCHEME:
        begin -= 1
    found = _LOGIN.match(text, mark + 3) if begin < mark else None
    return (begin, found.end()) if found else None


def spans(text: str) -> list[Span]:
    """(start, kind, end) of all personal data in a text, by code points, in order."""
    found: list[Span] = []
    # Where the search of each kind goes on; matches of a kind do not overlap.
    free = [0] * len(KINDS)
    for last, anchor in automaton().iter(text):
        if anchor == "0":
            if last >= free[1]:
                free[1], hits = _addresses(text, last)
                found += [(a, 1, b) for a, b in hits]
            if last >= free[2] and (card := _CARD.match(text, last)):
                free[2] = card.end()
                number = _digits(card.group())
                if 12 <= len(number) <= 19 and luhn(number):
                    found.append((last, 2, card.end()))
        elif anchor == "@":
            if last >= free[0] and (hit := _email(text, last, free[0])):
                free[0] = hit[1]
                found.append((hit[0], 0, hit[1]))
        elif anchor == "+":
            if last >= free[3] and (phone := _PHONE.match(text, last)):
                free[3] = phone.end()
                if 9 <= len(_digits(phone.group())) <= 15:
                    found.append((last, 3, phone.end()))
        elif anchor == "c":
            if last >= free[4] and (hit := _account(text, last + 1)):
                free[4] = hit[1]
                found.append((hit[0], 4, hit[1]))
        elif last - 2 >= free[5] and (hit := _login(text, last - 2)):
            free[5] = hit[1]
            found.append((hit[0], 5, hit[1]))
    return sorted(found)


def written(found: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in found)


_RESULT = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
)


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of each row.

    ``spans`` is every span as kind:start:end in code points, end exclusive, by start and then kind, joined
    by commas; ``base_sha256`` is the hash of the same for the first four kinds, which the counts count. Null
    or empty text has none. A null doc_id is kept; repeated rows are scanned each. Other columns,
    whatever their names, are ignored. An empty table gives no rows.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                out = []
                for text in part.column(1).to_pylist():
                    found = spans(text) if text else []
                    base = [s for s in found if s[1] < BASE]
                    counts = [sum(s[1] == k for s in base) for k in range(BASE)]
                    out.append((*counts, hashlib.sha256(written(base).encode()).hexdigest(), written(found)))
                columns = [part.column(0)]
                columns += [pa.array(c, pa.int64() if i < BASE else pa.string()) for i, c in enumerate(zip(*out))]
                yield pa.RecordBatch.from_arrays(
                    columns, names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(read, _RESULT)
