"""Plain, slow versions of the operators, written from their definitions."""

from __future__ import annotations

import hashlib
import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, pattern=SPACED, lower=False):
    text = text or ""
    return pattern.findall(text.translate(TO_LOWER) if lower else text)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def op1(docs, length=50):
    seen, out = {}, {}
    for doc, text in sorted(docs):
        w = words(text)
        gone = set()
        for k in range(len(w) - length + 1):
            run = tuple(w[k: k + length])
            if seen.setdefault(run, doc) < doc:
                gone.update(range(k, k + length))
        out[doc] = (len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def shingles(text, width=5):
    w = words(text, lower=True)
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[k: k + width]) for k in range(len(w) - width + 1)}


def op3(docs):
    sets = {doc: shingles(text) for doc, text in docs}
    holders = {}
    for doc, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(doc)
    root = {doc: doc for doc in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for doc, s in sets.items():
        common = {}
        for x in s:
            for other in holders[x]:
                if other < doc:
                    common[other] = common.get(other, 0) + 1
        for other, both in common.items():
            if 100 * both >= 75 * (len(s) + len(sets[other]) - both):
                a, b = find(doc), find(other)
                root[max(a, b)] = min(a, b)
    return {doc: (len(s), find(doc), find(doc) == doc) for doc, s in sets.items()}


def op7(docs, items, size=10):
    runs = {}
    for item, text in items:
        w = words(text, PLAIN, True)
        for k in range(max(1, len(w) - size + 1)) if w else ():
            runs.setdefault(tuple(w[k: k + size]), set()).add(item)
    lengths = {len(r) for r in runs}
    out = {}
    for doc, text in docs:
        w = words(text, PLAIN, True)
        hit, found = set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if tuple(w[k: k + n]) in runs:
                    hit.update(range(k, k + n))
                    found |= runs[tuple(w[k: k + n])]
        out[doc] = (len(w), len(hit), len(found), sha(",".join(sorted(map(str, found)))), bool(hit))
    return out
