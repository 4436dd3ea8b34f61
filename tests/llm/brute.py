"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def groups(nodes, links):
    """node -> smallest node of its component."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def contamination(docs, items, window=13, share=20):
    """(doc_id, text) and (item_id, text) rows -> doc_id: (n_words, n_hit, n_items, sha, flag)."""
    words = {i: ITEM_WORD.findall((t or "").translate(LOWER)) for i, t in docs}
    windows = defaultdict(set)
    for item, text in items:
        w = ITEM_WORD.findall((text or "").translate(LOWER))
        n = min(window, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[s : s + n])].add(None if item is None else str(item))
    out = {}
    for doc, w in words.items():
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for s in range(len(w) - n + 1):
                ids = windows.get(tuple(w[s : s + n]))
                if ids:
                    hit.update(range(s, s + n))
                    found |= ids
        flag = bool(hit) and share * len(hit) >= len(w)
        # items without an id count as one that the list lacks
        out[doc] = (len(w), len(hit), len(found), sha(",".join(sorted(found - {None}))), flag)
    return out


def targets(sizes, weights=(5, 2, 1), repeats=3):
    """source -> words, source -> target."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full: dict = {}
    while True:
        rest = [s for s in order if s not in full]
        left = sum(sizes.values()) - sum(full.values())
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        above = [s for s in rest if share[s] > repeats * sizes[s]]
        if not above:
            return {**full, **share}
        full |= {s: repeats * sizes[s] for s in above}


def substrings(docs, window=50):
    """(doc_id, text) rows -> doc_id: (n_words, n_removed, sha of the kept words)."""
    words = {i: WORD.findall(t or "") for i, t in docs}
    first: dict = {}
    for i in sorted(words):
        w = words[i]
        for s in range(len(w) - window + 1):
            first.setdefault(tuple(w[s : s + window]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] < i:
                gone.update(range(s, s + window))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out[i] = (len(w), len(gone), sha(" ".join(kept)))
    return out


def fingerprint(text):
    w = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash(docs, radius=3):
    """(doc_id, text) rows -> doc_id: (hexadecimal fingerprint, smallest doc_id)."""
    prints = {i: fingerprint(t) for i, t in docs}
    ids = sorted(prints)
    p = np.array([prints[i] for i in ids], np.uint64)
    links = []
    for k in range(len(ids)):
        near = np.flatnonzero(np.bitwise_count(p[k:] ^ p[k]) <= radius) + k
        links += [(ids[k], ids[j]) for j in near.tolist()]
    least = groups(ids, links)
    return {i: (f"{prints[i]:016x}", least[i]) for i in ids}


def tokens(docs, path, end=1):
    """(doc_id, text) rows -> rows of (doc_id, start, n_tokens, crc), by doc_id."""
    from tokenizers import Tokenizer

    t, at, out = Tokenizer.from_file(path), 0, []
    for i, text in sorted(docs, key=lambda r: r[0]):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, end]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def vectors(rows, least=0.9):
    """(vec_id, list) rows -> vec_id: (n_links, smallest vec_id)."""
    fine = {
        i: np.array(v, np.float64) for i, v in rows
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    }
    ids, links = sorted(fine), []
    for a in ids:
        for b in ids:
            if a < b and len(fine[a]) == len(fine[b]):
                x, y = fine[a], fine[b]
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= least:
                    links.append((a, b))
    n = defaultdict(int)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    least_of = groups([i for i, _ in rows], links)
    return {i: (n[i], least_of[i]) for i, _ in rows}


def conversations(rows):
    """(conv_id, turn, role, text) rows -> conv_id: (n_turns, n_logged, text)."""
    by = defaultdict(set)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].add((turn is not None, turn or 0, role or "", text or ""))
    seqs = {c: tuple((r, t) for _, _, r, t in sorted(x)) for c, x in by.items()}
    out = {}
    for c, s in sorted(seqs.items()):
        if any(len(o) > len(s) and o[: len(s)] == s for o in seqs.values()):
            continue
        same = [k for k, o in seqs.items() if o == s]
        if c == min(same):
            out[c] = (len(s), len(same), "".join(f"<|{r}|>\n{t}\n<|end|>\n" for r, t in s))
    return out
