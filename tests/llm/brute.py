"""Plain Python versions of what the operators compute, for small tables."""

import collections
import hashlib
import math
import re
import zlib

LOWER = {i: i + 32 for i in range(65, 91)}
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def measures(text):
    text = text or ""
    w = SPACED.findall(text)
    runs = list(zip(w, w[1:], w[2:]))  # noqa: B905
    counts = collections.Counter(runs)
    covered = {j for i, r in enumerate(runs) if counts[r] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
        len(w) < 50 or 100 * len(covered) > 50 * len(w),
    )


def passages(docs, benchmark):
    windows, sizes = collections.defaultdict(set), set()
    for item, text in benchmark:
        w = ALNUM.findall((text or "").translate(LOWER))
        n = min(10, len(w))
        if n:
            sizes.add(n)
            for i in range(len(w) - n + 1):
                windows[tuple(w[i : i + n])].add(item)
    out = []
    for key, text in docs:
        w = ALNUM.findall((text or "").translate(LOWER))
        hit, items = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                found = windows.get(tuple(w[i : i + n]))
                if found is not None:
                    hit.update(range(i, i + n))
                    items |= {str(x) for x in found if x is not None}
        out.append((key, len(w), len(hit), len(items), sha(",".join(sorted(items))), bool(hit)))
    return out


def shingles(text):
    w = SPACED.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, min(len(w), 1))))


def components(docs):
    sets = {k: shingles(t) for k, t in docs}
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {k: (len(s), find(k)) for k, s in sets.items()}


def ranked(docs, items, top=10):
    """(item_id, rank, doc_id, score) of rows (doc_id, text) and (item_id, text)."""
    counts = [(k, collections.Counter(ALNUM.findall((t or "").translate(LOWER)))) for k, t in docs]
    counts = [(k, c, c.total()) for k, c in counts if c]
    total, length = len(counts), sum(n for _, _, n in counts)
    df = collections.Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        wanted = ALNUM.findall((text or "").translate(LOWER))
        scores = []
        for k, c, n in counts:
            m = 100 - 75 + 75 * n * total // length
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m))
                for t in wanted if t in c
            )
            if score > 0:
                scores.append((-score, k is None, k))
        scores.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, i, k, -s) for i, (s, _, k) in enumerate(scores[:top], 1)]
    return out


def leaf(r, text):
    fields = [r["doc_id"], r["source"], r["lang"], r["n_chars"], text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def merkle(docs):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of rows of documents."""

    def levels(digests):
        out = [digests]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][i : i + 16])) for i in range(0, len(out[-1]), 16)])
        return out

    sources = collections.defaultdict(list)
    for r in docs:
        sources[r["source"]].append(r)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for group in sources.values():
        group.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
    trees = {s: levels([leaf(r, r["text"]) for r in sources[s]]) for s in order}
    top = levels([trees[s][-1][0] for s in order])
    out = []
    for place, s in enumerate(order):
        for i, r in enumerate(sources[s]):
            path = []
            for tree, at in ((trees[s], i), (top, place)):
                for level in tree[:-1]:
                    first = at // 16 * 16
                    path.append(("".join(level[first:at]), "".join(level[at + 1 : first + 16])))
                    at //= 16
            digest = trees[s][0][i]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0:
                digest = leaf(r, r["text"] and r["text"].translate(LOWER))
            for before, after in path:
                digest = sha(before + digest + after)
            root = top[-1][0]
            proof = sha("".join(a + b for a, b in path))
            out.append((r["doc_id"], trees[s][0][i], trees[s][-1][0], root, proof, digest, digest == root))
    return out


def copies(docs):
    """(doc_id, keep_id, group_size, kept, text_sha256) of rows (doc_id, text) in order of arrival."""
    groups = collections.defaultdict(list)
    for at, (k, text) in enumerate(docs):
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), k is None, k, at))
    out = []
    for text, group in groups.items():
        best = min(group, key=lambda g: (g[0], g[1], g[2] or 0, g[3]))
        out += [(g[2], best[2], len(group), g is best, sha(text)) for g in group]
    return out
