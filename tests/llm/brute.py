"""Plain versions of what SQL cannot express, one document or pair at a time."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, k):
    w = WORD.findall(lower(text))
    if len(w) < k:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def components(docs, k, num, den):
    """doc_id to (size of the set, smallest doc_id of the component), for docs with distinct ids."""
    sets = {d: shingles(t, k) for d, t in docs}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and den * len(x & y) >= num * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {d: (len(s), find(d)) for d, s in sets.items()}


def kept_words(docs, length):
    """doc_id to the words left when those in windows of a smaller document go."""
    words = {d: WORD.findall(t or "") for d, t in docs}
    lowest = {}
    for d, w in words.items():
        for i in range(len(w) - length + 1):
            key = tuple(w[i : i + length])
            lowest[key] = min(d, lowest.get(key, d))
    out = {}
    for d, w in words.items():
        gone = set()
        for i in range(len(w) - length + 1):
            if lowest[tuple(w[i : i + length])] < d:
                gone.update(range(i, i + length))
        out[d] = [x for i, x in enumerate(w) if i not in gone]
    return out


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(digits):
    total = 0
    for i, c in enumerate(digits[::-1]):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text):
    """(start, kind number, end) by the regular expressions themselves."""
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    found += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m)) <= 19 and _luhn(digits(m))]
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return sorted(found)


def base_row(text):
    found = base_spans(text)
    names = ("email", "ip", "card", "phone")
    written = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in found)
    return (*[sum(s[1] == k for s in found) for k in range(4)], hashlib.sha256(written.encode()).hexdigest())


PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def base_licenses(text):
    """(n_words, n_base, first_word, last_word, base_labels)."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    found = [
        (i, label)
        for phrase, label in PHRASES.items()
        for p in [phrase.split()]
        for i in range(len(w) - len(p) + 1)
        if w[i : i + len(p)] == p
    ]
    at = [i for i, _ in found]
    labels = ",".join(sorted({x for _, x in found}))
    return len(w), len(found), min(at, default=None), max(at, default=None), labels
