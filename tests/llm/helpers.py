"""Brute-force versions, on whole fixtures in plain Python."""

import math
import re
from collections import Counter, defaultdict

import regex
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_sets(rows, size):
    """(position, id) to the set of word shingles."""
    out = {}
    for at, (doc_id, text) in enumerate(rows):
        w = WORD.findall((text or "").translate(LOWER))
        out[at, doc_id] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
    return out


def components(rows, size, percent):
    """Sorted (doc_id, set size, smallest id of the component)."""
    sets, holders = shingle_sets(rows, size), defaultdict(list)
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for key, tokens in sets.items():
        shared = Counter(other for t in tokens for other in holders[t])
        for other, n in shared.items():
            if 100 * n >= percent * (len(tokens) + len(sets[other]) - n):
                parent[root(key)] = root(other)
        for t in tokens:
            holders[t].append(key)
    members = defaultdict(list)
    for key in sets:
        members[root(key)].append(key)
    out = []
    for group in members.values():
        known = [d for _, d in group if d is not None]
        out += [(d, len(sets[at, d]), min(known) if known else None) for at, d in group]
    return sorted(out, key=repr)


def cut_repeats(rows, window=20):
    """(doc_id, words, removed words, words left) for rows of distinct ids in order."""
    seen = set()
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        w, gone = WORD.findall(text or ""), set()
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            if key in seen:
                gone.update(range(i, i + window))
            seen.add(key)
        yield doc_id, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)


def base_figures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    w = WORD.findall(text)
    counts = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if counts[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
        len(w) < 20 or 100 * len(covered) > 30 * len(w),
    )


def quality_scores(rows, labels, bins):
    """Mean log ratio of each row (doc_id, text); ``labels`` are (doc_id, quality, toxic)."""
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    part = lambda x: x.to_bytes(8, "little", signed=True)

    def grams(text):
        h = [signed(xxhash.xxh64_intdigest(p.encode(), 42)) for p in regex.findall(r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+", text or "")]
        pairs = [signed(xxhash.xxh64_intdigest(part(b), xxhash.xxh64_intdigest(part(a), 42))) for a, b in zip(h, h[1:])]
        return [x % bins for x in h + pairs]

    trusted = {i for i, q, t in labels if q == 1 and not t and i is not None}
    every = [(i, grams(text)) for i, text in rows]
    raw, good = Counter(), Counter()
    for i, g in every:
        raw.update(g)
        good.update(g if i in trusted else ())
    n_raw, n_good = sum(raw.values()), sum(good.values())
    ratio = lambda g: math.log((good[g] + 1) / (n_good + bins)) - math.log((raw[g] + 1) / (n_raw + bins))
    return [sum(map(ratio, g)) / len(g) if g and n_good else 0.0 for _, g in every]
