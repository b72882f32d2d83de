"""Plain Python versions of the operators' contracts."""

import hashlib
import re
from collections import Counter

BLANKS = re.compile("[^\x20\x09-\x0D]+")
LETTERS = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, n):
    words = BLANKS.findall(lower(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1)))


def near_duplicates(rows, n, percent):
    sets = {i: shingles(t, n) for i, t in rows}
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def sha(data):
    return hashlib.sha256(data).hexdigest()


def remove_recurring(rows, length):
    words = [(i, BLANKS.findall(t or "")) for i, t in rows]
    count = Counter(tuple(w[k:k + length]) for _, w in words for k in range(len(w) - length + 1))
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - length + 1):
            if count[tuple(w[k:k + length])] > 1:
                gone[k:k + length] = [True] * length
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((i, len(w), sum(gone), sha(" ".join(kept).encode())))
    return sorted(out)


def remove_repeated(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, b in texts:
        for k in range(len(b) - length + 1):
            w = b[k:k + length]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, b in texts:
        gone = [False] * len(b)
        for k in range(len(b) - length + 1):
            if first[b[k:k + length]] < i:
                gone[k:k + length] = [True] * length
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), runs, sha(bytes(c for c, g in zip(b, gone, strict=True) if not g))))
    return sorted(out)


def contamination(rows, items, window):
    known = {}
    for item, text in items:
        w = LETTERS.findall(lower(text))
        for k in range(max(1, len(w) - window + 1)):
            if w and item is not None:
                known.setdefault(tuple(w[k:k + window]), set()).add(str(item))
    out = []
    for i, text in rows:
        w = LETTERS.findall(lower(text))
        hit, found = [False] * len(w), set()
        for n in {len(k) for k in known}:
            for k in range(len(w) - n + 1):
                if here := known.get(tuple(w[k:k + n])):
                    found |= here
                    hit[k:k + n] = [True] * n
        n = sum(hit)
        out.append((i, len(w), n, sorted(found), n > 0 and 20 * n >= len(w)))
    return sorted(out)
