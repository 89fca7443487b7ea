"""Plain single-process versions of what the operators compute, for small tables."""

import hashlib
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def shingles(text, k=5):
    w = words(text)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_classes(texts, least=0.8):
    """doc_id -> least doc_id of its class; texts: {doc_id: text}."""
    sets = {i: shingles(t) for i, t in texts.items()}
    ids = sorted(texts)
    links = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1:]
             if sets[a] and sets[b] and len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b])]
    return components(ids, links)


def without_repeats(texts, size=20):
    """doc_id -> (words, kept words)."""
    seen, out = set(), {}
    for i in sorted(texts):
        w = words(texts[i])
        gone = [False] * len(w)
        for s in range(len(w) - size + 1):
            key = tuple(w[s:s + size])
            if key in seen:
                gone[s:s + size] = [True] * size
            seen.add(key)
        out[i] = (w, [x for x, g in zip(w, gone) if not g])
    return out


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode("utf-8")).hexdigest()


def mix(rows, weights=(3, 1, 2), share=1.5, cap=2.0):
    """rows: (doc_id, source, size) -> (per source target, per row copies in row order)."""
    size = defaultdict(int)
    for _, s, n in rows:
        size[s] += n
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, target, open_sources = share * sum(size.values()), {}, set(order)
    while open_sources:
        level = budget / sum(weight[s] for s in open_sources)
        over = {s for s in open_sources if level * weight[s] >= cap * size[s]}
        if not over:
            target |= {s: level * weight[s] for s in open_sources}
            break
        for s in over:
            target[s] = cap * size[s]
            budget -= target[s]
        open_sources -= over
    return target, dict(size)
