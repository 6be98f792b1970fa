"""Plain versions of the operators, one text or pair at a time."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return SPACE.findall(text or "")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def shingle_set(text, k):
    w = words((text or "").translate(UPPER))
    if len(w) < k:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def components(docs, k, percent=80):
    """{doc_id: (n_shingles, component)} of [(doc_id, text)], by an index of shingles."""
    sets = {d: shingle_set(t, k) for d, t in docs}
    of = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            of[g].append(d)
    union = Union()
    for d, s in sets.items():
        common = Counter(e for g in s for e in of[g] if e < d)
        for e, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[e]) - n):
                union.join(d, e)
    return {d: (len(s), union.find(d)) for d, s in sets.items()}


def repeated_bytes(raws, depth):
    """For each byte string: the maximal stretches covered by strings of ``depth`` bytes that
    start elsewhere too."""
    seen = Counter(r[i : i + depth] for r in raws for i in range(len(r) - depth + 1))
    out = []
    for r in raws:
        spans = []
        for i in range(len(r) - depth + 1):
            if seen[r[i : i + depth]] > 1:
                if spans and spans[-1][1] >= i:
                    spans[-1][1] = i + depth
                else:
                    spans.append([i, i + depth])
        out.append(spans)
    return out


def without(raw, spans):
    at, kept = 0, b""
    for a, b in spans:
        kept += raw[at:a]
        at = b
    return kept + raw[at:]


def base_spans(text):
    kinds = ("assign", "access", "hex")
    found = []
    assign = r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    for m in re.finditer(assign, text, re.I | re.A):
        if len(m[2]) >= 8:
            found.append((m.start(), 0, m.end()))
    for m in re.finditer(r"AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 16:
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9a-f]+", text):
        if len(m[0]) >= 32:
            found.append((m.start(), 2, m.end()))
    return [(a, kinds[k], b) for a, k, b in sorted(found)]


def entropy(window):
    return -sum(c / len(window) * math.log2(c / len(window)) for c in Counter(window).values())


def all_spans(text, rules, allowed, harmless, kinds):
    """Candidates are looked for in what fixed patterns and harmless words leave."""
    base = base_spans(text)
    found = [(a, kinds.index(k), b) for a, k, b in base]
    rest = list(text)
    for a, b in [(a, b) for a, _, b in base] + [m.span() for m in re.finditer(harmless, text, re.A)]:
        rest[a:b] = " " * (b - a)
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", "".join(rest)):
        if re.search(allowed, m[0]):
            continue
        name = "hex" if re.fullmatch("[0-9a-f]+|[0-9A-F]+", m[0]) else "base64"
        rule = rules[name]
        hot = [
            i
            for i in range(len(m[0]) - rule.window + 1)
            if entropy(m[0][i : i + rule.window]) >= rule.bits - 1e-9
        ]
        if hot:
            found.append((m.start() + hot[0], kinds.index("entropy_" + name), m.start() + hot[-1] + rule.window))
    return [(a, kinds[k], b) for a, k, b in sorted(found)]


def least_cost(lengths, capacities, sequence_cost):
    """Cost of the best packing, by trying every bin for every length."""
    best = [float("inf")]

    def go(i, bins):
        if i == len(lengths):
            cost = sum(min(c for c in capacities if c >= u) + sequence_cost for u in bins)
            best[0] = min(best[0], cost)
            return
        for b in range(len(bins)):
            if bins[b] + lengths[i] <= max(capacities):
                go(i + 1, bins[:b] + [bins[b] + lengths[i]] + bins[b + 1 :])
        go(i + 1, bins + [lengths[i]])

    go(0, [])
    return best[0]


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for a, k, b in spans)


def quality_counts(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    count = Counter(grams)
    hit = {i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(5)}
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(hit),
    }


def crc(text):
    return zlib.crc32((text or "").encode())
