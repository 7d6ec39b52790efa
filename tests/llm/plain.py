"""Plain versions of the operators' results, for small fixtures."""

from __future__ import annotations

import base64
import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def groups_of(n: int, pairs) -> list[int]:
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def links(vectors, threshold=0.93):
    """``(vec_id, label, embedding)`` rows to (n_links, component_id, kept), in order."""
    usable = []
    for _, label, v in vectors:
        good = label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        usable.append(np.array(v, float) / np.linalg.norm(np.array(v, float)) if good else None)
    pairs, count = [], [0] * len(vectors)
    for i, a in enumerate(usable):
        for j in range(i + 1, len(vectors)):
            b = usable[j]
            if a is None or b is None or vectors[i][1] != vectors[j][1] or len(a) != len(b):
                continue
            if a @ b >= threshold:
                pairs.append((i, j))
                count[i] += 1
                count[j] += 1
    root = groups_of(len(vectors), pairs)
    ids = defaultdict(list)
    for r, (vec_id, _, _) in zip(root, vectors):
        if vec_id is not None:
            ids[r].append(vec_id)
    first = [min(ids[r]) if ids[r] else None for r in root]
    return [(n, c, c == v[0]) for n, c, v in zip(count, first, vectors)]


def revisits(pages):
    """``(page_id, html)`` rows to (payload_bytes, digest, type, refers_to)."""
    digest = [base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode() for _, h in pages]
    same = defaultdict(list)
    for d, (i, _) in zip(digest, pages):
        same[d].append(i)
    out = []
    for d, (i, h) in zip(digest, pages):
        top = max(same[d])
        out.append((len((h or "").encode()), d, "response" if i == top else "revisit", None if i == top else top))
    return out


def base_rules(text):
    words = WORD.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            repeated |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    failed = n < 50 or 100 * len(repeated) > 50 * n
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(repeated), failed


def removed(docs, units, window):
    """``(doc_id, text)`` rows (ids unique) to masks of removed units."""
    seen, out = set(), {}
    for i, t in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0)):
        u = units(t)
        mask = [False] * len(u)
        for s in range(len(u) - window + 1):
            key = bytes(u[s : s + window]) if isinstance(u, bytes) else tuple(u[s : s + window])
            if key in seen:
                mask[s : s + window] = [True] * window
            seen.add(key)
        out[i] = (u, mask)
    return out


def fingerprint(text):
    import xxhash

    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(len(words) - 2, 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_groups(docs):
    """``(doc_id, text)`` rows to (fingerprint, component id)."""
    prints = [fingerprint(t) for _, t in docs]
    pairs = [(i, j) for i in range(len(docs)) for j in range(i + 1, len(docs)) if (prints[i] ^ prints[j]).bit_count() <= 2]
    root = groups_of(len(docs), pairs)
    ids = defaultdict(list)
    for r, (i, _) in zip(root, docs):
        if i is not None:
            ids[r].append(i)
    return [(f"{p:016x}", min(ids[r]) if ids[r] else None) for p, r in zip(prints, root)]


def budgets(tokens, mix, tree, wanted):
    """Tokens by leaf path to budgets, by repeated sharing."""

    def fill(paths, depth, budget):
        if depth == len(tree):
            return {paths[0]: budget}
        children = defaultdict(list)
        for p in paths:
            children[p[depth]].append(p)
        supply = {c: sum(tokens[p] for p in ps) * mix.epochs for c, ps in children.items()}
        weight = {c: getattr(mix, tree[depth]).get(c, 1.0) for c in children}
        given, active, rest = dict.fromkeys(children, 0.0), {c for c in children if weight[c] > 0}, budget
        while active and rest > 1e-9:
            level = rest / sum(weight[c] for c in active)
            full = [c for c in active if supply[c] <= level * weight[c]]
            if not full:
                given |= {c: level * weight[c] for c in active}
                break
            for c in full:
                given[c] = supply[c]
                rest -= supply[c]
                active.discard(c)
        return {k: v for c, ps in children.items() for k, v in fill(ps, depth + 1, given[c]).items()}

    return fill(list(tokens), 0, wanted)


TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def trie(rows):
    """``(conv_id, turn, role, text)`` rows to node rows, from dictionaries of prefixes."""
    import zlib

    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, 20))
        path = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(WORD.findall(node[-1][1])) if node else 0
        saved[node] = (len(members[node]) - 1) * words + sum(saved[c] for c in children[node])
        leaves[node] = sum(leaves[c] for c in children[node]) or 1
    digest = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    return [
        (m[0], len(n), members[n[:-1]][0] if n else None, len(m), len(children[n]), leaves[n], saved[n], digest(ends[n]))
        for n, m in members.items()
    ]


def ranked(docs, items, top=50):
    """Every item's best documents: ``(item_id, rank, doc_id, score)``."""
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    whole, held = sum(c.total() for _, c in counts), Counter(t for _, c in counts for t in c)
    out = []
    for item, text in set(items):
        asked = {t: math.floor(1000 * math.log((2 * len(counts) + 2) / (2 * held[t] + 1))) for t in terms(text) if held[t]}
        scores = []
        for i, c in counts:
            m = 50 + 50 * c.total() * len(counts) // whole
            scores.append((-sum(w * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t, w in asked.items()), i is None, i or 0, i))
        best = sorted((s for s in scores if s[0]), key=lambda s: s[:3])[:top]
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(best, 1)]
    return out


def hit_words(docs, items, width=10):
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)`` of every document."""
    windows = defaultdict(set)
    for item, text in items:
        own = terms(text)
        for k in range(max(len(own) - width + 1, min(len(own), 1))):
            windows[tuple(own[k : k + width])].add(item)
    out = []
    for i, text in docs:
        own, hit, found = terms(text), set(), set()
        for size in {len(w) for w in windows}:
            for k in range(len(own) - size + 1):
                if named := windows.get(tuple(own[k : k + size])):
                    hit |= {*range(k, k + size)}
                    found |= named
        names = sorted(str(x) for x in found if x is not None)
        out.append((i, len(own), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return out
