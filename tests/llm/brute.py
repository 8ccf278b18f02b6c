"""Plain versions of the training-data operators, for small tables."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def shingles(text):
    w = words(lowered(text))
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def near_groups(texts):
    """``doc_id`` to its component, for a dict of texts."""
    sets = {i: shingles(t) for i, t in texts.items()}
    label = {i: i for i in texts}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(texts)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {i: root(i) for i in ids}


def without_repeated_words(texts, width=35):
    """(``n_words``, ``n_removed``, kept text) of each of a list of texts."""
    split = [words(t) for t in texts]
    places = Counter(tuple(w[i : i + width]) for w in split for i in range(len(w) - width + 1))
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - width + 1):
            if places[tuple(w[i : i + width])] > 1:
                gone.update(range(i, i + width))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((len(w), len(gone), " ".join(kept)))
    return out


def without_repeated_lines(texts, run=3, long=10):
    """(text, lines removed) of texts given in order."""
    lines = [(t or "").split("\n") for t in texts]
    full = [[k for k, x in enumerate(x) if words(x)] for x in lines]
    seen: dict[tuple, tuple] = {}
    gone = defaultdict(set)
    for d, own in enumerate(full):
        for s in range(len(own)):
            for h in range(1, run + 1):
                if s + h > len(own):
                    break
                window = tuple(lines[d][own[s + j]] for j in range(h))
                if (h, window) not in seen:
                    seen[h, window] = (d, s)
                elif h == run or any(len(words(x)) >= long for x in window):
                    gone[d].update(own[s : s + h])
    return [
        (t if not gone[d] else "\n".join(x for k, x in enumerate(lines[d]) if k not in gone[d]),
         len(gone[d]))
        for d, t in enumerate(texts)
    ]


def repeat_measures(text):
    """Words, their characters, symbols, repeated lines, and words in repeated three-word windows."""
    w = words(text)
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = set()
    for i in range(len(w) - 2):
        if windows[tuple(w[i : i + 3])] > 1:
            covered.update((i, i + 1, i + 2))
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            again += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(w), sum(map(len, w)), symbols, again, len(covered)


def fold(doc_id, folds=5):
    return zlib.crc32(str(doc_id).encode()) % folds
