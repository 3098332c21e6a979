"""Plain Python versions of the operators, written from their contracts."""

import hashlib
import math
import re
import struct
import zlib
from collections import Counter, defaultdict

import xxhash


def words_space(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))


def words_alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def shingles(text, n):
    w = words_space(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1)))


def groups(rows, n, percent=80):
    """{doc_id: (set size, component)} of (doc_id, text), by a prefix filter over exact sets."""
    classes = defaultdict(list)
    for doc, text in rows:
        classes[shingles(text, n)].append(doc)
    sets = [s for s in classes if s]
    count = defaultdict(int)
    for s in sets:
        for x in s:
            count[x] += 1
    parent = {s: s for s in classes}

    def root(s):
        while parent[s] is not s:
            s = parent[s]
        return s

    lists = defaultdict(list)
    for s in sets:
        need = -(-percent * len(s) // 100)
        seen = set()
        for x in sorted(s, key=lambda x: (count[x], x))[: len(s) - need + 1]:
            for t in lists[x]:
                if id(t) in seen:
                    continue
                seen.add(id(t))
                same = len(s & t)
                if 100 * same >= percent * (len(s) + len(t) - same):
                    a, b = root(s), root(t)
                    if a is not b:
                        parent[a] = b
            lists[x].append(s)
    least = {}
    for s, docs in classes.items():
        r = id(root(s))
        least[r] = min([least.get(r, docs[0]), *docs])
    return {d: (len(s), least[id(root(s))] if s else d) for s, docs in classes.items() for d in docs}


def contamination(docs, bench, n=10):
    items = [(str(i), words_alnum(t)) for i, t in bench]
    windows = defaultdict(set)
    for i, w in items:
        if w:
            m = min(n, len(w))
            for k in range(len(w) - m + 1):
                windows[tuple(w[k : k + m])].add(i)
    sizes = {len(w) for w in windows}
    out = {}
    for doc, text in docs:
        w, hit, found = words_alnum(text), set(), set()
        for m in sizes:
            for k in range(len(w) - m + 1):
                own = windows.get(tuple(w[k : k + m]))
                if own:
                    hit.update(range(k, k + m))
                    found |= own
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[doc] = (len(w), len(hit), len(found), sha, bool(hit))
    return out


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def lines_left(docs, min_words):
    """{doc_id: lines left} of (doc_id, text) without later copies of runs, by comparing all positions."""
    docs = sorted(docs)
    lines = {d: t.split("\n") for d, t in docs}
    at = [(d, k) for d, _ in docs for k in range(len(lines[d]))]
    gone = set()
    for n, (d, k) in enumerate(at):
        best = 0
        for e, j in at[:n]:
            size = 0
            while k + size < len(lines[d]) and j + size < len(lines[e]) and lines[d][k + size] == lines[e][j + size]:
                size += 1
            best = max(best, size)
        if sum(len(x.split()) for x in lines[d][k : k + best]) >= min_words:
            gone.update((d, x) for x in range(k, k + best))
    return {d: [x for k, x in enumerate(own) if (d, k) not in gone] for d, own in lines.items()}


def segmentations(text, score, unknown):
    """All (score, parts) of a text into pieces of ``score``, single characters without one costing ``unknown``."""
    if not text:
        return [(0.0, ())]
    out = []
    for n in range(1, len(text) + 1):
        own = score.get(text[-n:], unknown if n == 1 else None)
        if own is not None:
            out += [(s + own, parts + (text[-n:],)) for s, parts in segmentations(text[:-n], score, unknown)]
    return out


def quality(docs, verdict, features, odds, temperature, seed):
    """(weights, floor, keys) of (doc_id, text), one by one; ``verdict`` {doc_id: good}, ``features`` the slots of a text."""
    own = [features(t) for _, t in docs]
    inside = [verdict.get(d) == 1 for d, _ in docs]
    raw, target = Counter(), Counter()
    for slots, good in zip(own, inside):
        raw.update(slots)
        target.update(slots if good else ())
    held = [bool(slots) for slots in own]
    share = sum(h and g for h, g in zip(held, inside)) / sum(held)
    ratios = sorted((math.log(n / ((raw[s] - 1) * share + 1)), s) for s, n in target.items())
    half, passed = sum(target.values()) / 2, 0
    for ratio, s in ratios:
        passed += target[s]
        if passed >= half:
            break
    share = min(share * math.exp(ratio), 1 - 1e-6)

    def log_ratio(s, good):
        n, expected = max(target[s] - good, 0), (raw[s] - 1) * share
        rest, others = raw[s] - good - n, (raw[s] - 1) * (1 - share)
        gain = sum(x * math.log(max(x, 1) / max(y, 1e-9)) for x, y in ((n, expected), (rest, others)))
        return math.log((n + 1) / (expected + 1)) / (1 + odds * math.exp(-min(max(gain, 0), 600)))

    weights = [sum(log_ratio(s, g) for s in slots) / math.sqrt(max(len(slots), 1)) for slots, g in zip(own, inside)]
    bins = [(math.floor(min(5, max(-5, w)) * 10_000), verdict[d]) for (d, _), w, h in zip(docs, weights, held) if h and d in verdict]
    least, floor, values = sum(not g for _, g in bins), -math.inf, sorted({b for b, _ in bins})
    for b, after in zip(values, values[1:]):
        wrong = sum(g if x <= b else not g for x, g in bins)
        if wrong < least:
            least, floor = wrong, (b + 1 + after) / 20_000
    unit, keys = max(abs(floor), 1e-4) if math.isfinite(floor) else 1.0, []
    for (d, t), w in zip(docs, weights):
        h = xxhash.xxh64_intdigest(struct.pack("<q", d), 42)
        h = xxhash.xxh64_intdigest(struct.pack("<Q", xxhash.xxh64_intdigest(t.encode(), 42)), h)
        h = xxhash.xxh64_intdigest(struct.pack("<i", seed), h)
        keys.append(round((w / (temperature * unit) - math.log(-math.log(((h >> 12) + 0.5) / 2**52))) * 2**20))
    return weights, floor, keys
