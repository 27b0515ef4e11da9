"""Brute-force versions of the operators, for small tables."""

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text, lower=False):
    text = text or ""
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text) if lower else text)


def shingles(text):
    w = words(text, lower=True)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def linked(sets, percent=80):
    """Root of each set under links of the similarity."""
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    lists = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            lists[x].append(i)
    for i, s in enumerate(sets):
        for j, k in collections.Counter(j for x in s for j in lists[x] if j > i).items():
            if 100 * k >= percent * (len(s) + len(sets[j]) - k):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(sets))]


def components(rows):
    """Sorted (doc_id, shingles, smallest linked doc_id) of (doc_id, text) rows."""
    sets = [shingles(t) for _, t in rows]
    roots = linked(sets)
    least = {}
    for (d, _), r in zip(rows, roots):
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return [(d, len(s), least.get(r) if s else d) for (d, _), s, r in zip(rows, sets, roots)]


def without_repeats(rows, width=200):
    """(doc_id, bytes, removed, spans, digest of the rest) of (doc_id, text) rows."""
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = collections.Counter(b[i : i + width] for _, b in texts for i in range(len(b) - width + 1))
    out = []
    for d, b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if seen[b[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        rest = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), len(b) - len(rest), spans, hashlib.sha256(rest).hexdigest()))
    return out


def base_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    windows = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    again = {j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again)
