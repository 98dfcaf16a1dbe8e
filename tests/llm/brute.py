"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import xxhash

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def rows(folder: str, table: str) -> list[dict]:
    return pq.read_table(f"{folder}/{table}.parquet").to_pylist()


def least_reachable(nodes: list, edges: list[tuple]) -> dict:
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in edges:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def fingerprint(text: str | None, size: int = 4) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    shingles = [" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_components(docs: list[tuple[int, str | None]], size: int = 4) -> dict[int, int]:
    marks = np.array([fingerprint(t, size) for _, t in docs], dtype=np.uint64)
    edges = [(docs[i][0], docs[j][0]) for i in range(len(docs))
             for j in np.flatnonzero(np.bitwise_count(marks ^ marks[i]) <= 4)]
    return least_reachable([d for d, _ in docs], edges)


def jaccard_components(docs: list[tuple[int, str | None]], size: int = 5, similarity: int = 80) -> dict[int, int]:
    sets = []
    for _, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
        sets.append({tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set())
    edges = [(docs[i][0], docs[j][0]) for i, a in enumerate(sets) for j, b in enumerate(sets[:i])
             if 100 * len(a & b) >= similarity * len(a | b)]
    return least_reachable([d for d, _ in docs], edges)


def lines_gone(docs: list[tuple[int, str | None]], similarity: int = 80) -> set[tuple[int, int]]:
    seen, by_word, gone = [], defaultdict(list), set()
    for doc, text in sorted(docs):
        for i, line in enumerate((text or "").split("\n")):
            words = frozenset(line.encode().lower().split())
            if not words:
                continue
            common = Counter(j for w in words for j in by_word[w])
            if any(100 * n >= similarity * (len(words) + len(seen[j]) - n) for j, n in common.items()):
                gone.add((doc, i))
            for w in words:
                by_word[w].append(len(seen))
            seen.append(words)
    return gone


def without_lines(doc: int, text: str, gone: set[tuple[int, int]]) -> str:
    return "\n".join(x for i, x in enumerate(text.split("\n")) if (doc, i) not in gone)


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def phrases(items: list[tuple[int, str | None]], window: int = 10) -> dict[tuple, set[str]]:
    out: dict[tuple, set[str]] = {}
    for item, text in items:
        words = WORD.findall((text or "").translate(LOW))
        size = min(window, len(words))
        for at in range(len(words) - size + 1 if words else 0):
            out.setdefault(tuple(words[at:at + size]), set()).add(str(item))
    return out


def benchmark_hits(text: str | None, found: dict[tuple, set[str]]) -> tuple[int, set[int], set[str]]:
    words = WORD.findall((text or "").translate(LOW))
    hit, items = set(), set()
    for size in {len(p) for p in found}:
        for at in range(len(words) - size + 1):
            if owners := found.get(tuple(words[at:at + size])):
                hit.update(range(at, at + size))
                items |= owners
    return len(words), hit, items


def cut_hits(text: str, hit: set[int]) -> str:
    places = [m.span() for m in WORD.finditer(text.translate(LOW))]
    out, at, i = [], 0, 0
    while i < len(places):
        if i in hit:
            first = i
            while i + 1 in hit:
                i += 1
            out.append(text[at:places[first][0]])
            at = places[i][1]
        i += 1
    return "".join([*out, text[at:]])


def lexical_best(docs: list[tuple[int | None, str | None]], text: str | None, k: int = 10) -> list[tuple[int | None, int]]:
    """(document, score) of the best documents for one item."""
    term = re.compile("[0-9a-z\x80-\U0010ffff]+")
    found = [(d, Counter(term.findall((t or "").translate(LOW)))) for d, t in docs]
    found = [(d, c) for d, c in found if c]
    n_docs, n_terms = len(found), sum(sum(c.values()) for _, c in found)
    wanted = Counter(term.findall((text or "").translate(LOW)))
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(t in c for _, c in found) + 1))) for t in wanted}
    out = []
    for d, c in found:
        m = 25 + 75 * sum(c.values()) * n_docs // n_terms
        score = sum(times * weight[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t, times in wanted.items())
        if score > 0:
            out.append((d, score))
    return sorted(out, key=lambda x: (-x[1], x[0] is None, x[0] or 0))[:k]


def one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def spelling_words(docs: list[tuple[int | None, str | None]], letters: int = 6, least: int = 5) -> dict[str, int]:
    out: Counter = Counter()
    for d, text in docs:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            out[run[:h % len(run)] + run[h % len(run) + 1:] if h % 199 == 0 else run] += 1
    return {w: n for w, n in out.items() if len(w) >= letters and n >= least}


def spelling_variants(count: dict[str, int], times: int = 5) -> set[tuple]:
    near = {w: [v for v in count if v != w and abs(len(v) - len(w)) < 2 and one_edit(v, w)] for w in count}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-count[v], v), default=None)
        form[w] = best if best and count[best] >= times * count[w] else None
    out = set()
    for w in count:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, count[w], len(near[w]), count[form[w]] if form[w] else None))
    return out


def without_repeats(docs: list[tuple[int | None, str | None]], window: int) -> list[tuple]:
    """(document, words, removed words, kept text) by plain windows."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in docs]
    last = float("inf")
    first: dict[tuple, float] = {}
    for (d, _), w in zip(docs, words):
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            first[key] = min(first.get(key, last), last if d is None else d)
    out = []
    for (d, _), w in zip(docs, words):
        gone = {j for i in range(len(w) - window + 1) if first[tuple(w[i:i + window])] < (last if d is None else d) for j in range(i, i + window)}
        out.append((d, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return out
