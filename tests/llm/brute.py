"""Plain Python versions of the operators' contracts, for small tables."""

from __future__ import annotations

import collections
import math
import re
import unicodedata
import zlib

import numpy as np

from lumenloom.llm import textvec

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LETTERED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, lower=False):
    return WORDS.findall((text or "").translate(LOW) if lower else text or "")


def shingles(text, n):
    w = words(text, True)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))


def components(rows, n, percent):
    """doc_id -> (size of the set, smallest id reachable)."""
    sets = {d: shingles(t, n) for d, t in rows}
    inverted, parent = collections.defaultdict(list), {d: d for d in sets}
    for d, s in sets.items():
        for x in s:
            inverted[x].append(d)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for d, s in sets.items():
        shared = collections.Counter(o for x in s for o in inverted[x] if o < d)
        for o, k in shared.items():
            if 100 * k >= percent * (len(s) + len(sets[o]) - k):
                a, b = find(d), find(o)
                parent[max(a, b)] = min(a, b)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def language_model(rows, order, prior):
    """doc_id -> (tokens, known tokens, training tokens, base score, score)."""
    tokens = {d: words(t, True) + ["\n"] for d, t in rows}
    count = collections.Counter()
    for d, w in tokens.items():
        if zlib.crc32(str(d).encode()) % 7 != 2:
            for m in range(1, order + 1):
                count.update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    n = sum(c for k, c in count.items() if len(k) == 1)
    v = sum(len(k) == 1 for k in count)

    def p(context, w):
        if not context:
            return (count[(w,)] + 1) / (n + v + 1)
        if not count[context]:
            return p(context[1:], w)
        return (count[(*context, w)] + prior * p(context[1:], w)) / (count[context] + prior)

    def score(w, m):
        return sum(math.log10(p(tuple(w[max(0, i - m + 1) : i]), x)) for i, x in enumerate(w))

    return {d: (len(w), sum(count[(x,)] > 0 for x in w), n, score(w, 1), score(w, order)) for d, w in tokens.items()}


def repeated(rows, length):
    """doc_id -> stretches of words in windows that occur at two places or more."""
    where = collections.defaultdict(list)
    for k, (_, t) in enumerate(rows):
        w = words(t)
        for i in range(len(w) - length + 1):
            where[tuple(w[i : i + length])].append((k, i))
    hit = collections.defaultdict(set)
    for places in where.values():
        if len(places) > 1:
            for k, i in places:
                hit[k].update(range(i, i + length))
    out = {}
    for k, (d, _) in enumerate(rows):
        spans = []
        for p in sorted(hit[k]):
            if spans and spans[-1][1] == p:
                spans[-1][1] = p + 1
            else:
                spans.append([p, p + 1])
        out[d] = ",".join(f"{a}:{b}" for a, b in spans)
    return out


def quality(text):
    """words, characters in words, symbols, repeated lines, repeated words."""
    w = words(text)
    count = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    cover = {j for i in range(len(w) - 7) if count[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(cover)


def contamination(rows, items, window=13):
    """doc_id -> (words, hit words, sorted item ids as text)."""
    of = lambda t: LETTERED.findall((t or "").translate(LOW))
    parts = collections.defaultdict(set)
    for i, t in items:
        w = of(t)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            parts[tuple(w[k : k + n])].add(i)
    sizes = {len(k) for k in parts}
    out = {}
    for d, t in rows:
        w, hit, found = of(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in parts:
                    hit.update(range(k, k + n))
                    found |= parts[tuple(w[k : k + n])]
        out[d] = (len(w), len(hit), sorted(str(i) for i in found if i is not None))
    return out


def targets(sizes, weights=(5, 2, 1), most=3):
    """source -> target, by handing the excess on until none is above its limit."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, total = {}, sum(sizes.values())
    while True:
        rest = [s for s in order if s not in full]
        left, by = total - sum(full.values()), sum(weight[s] for s in rest)
        got = {s: left * weight[s] / by for s in rest}
        over = [s for s in rest if got[s] > most * sizes[s]]
        if not over:
            return {**full, **got}
        full.update({s: most * sizes[s] for s in over})


def base_secrets(text):
    """(kind, start, end) of the fixed patterns, character by character, without regular expressions."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    value = set(letters + letters.upper() + "0123456789+/_.=-")
    low = text.translate(LOW)
    out = []

    def run(at, allowed):
        end = at
        while end < len(text) and text[end] in allowed:
            end += 1
        return end

    def assign(at):
        """The end of a match that starts here and where its value starts, or nothing."""
        for name in ("password", "passwd", "secret", "token", "api_key", "apikey"):
            if not low.startswith(name, at):
                continue
            i = at + len(name)
            i += text[i : i + 1] in ('"', "'") and i < len(text)
            i = run(i, " ")
            if text[i : i + 1] not in (":", "=") or i >= len(text):
                continue
            # an optional quote after optional blanks; the value must follow
            i = run(i + 1, " ")
            i += text[i : i + 1] in ('"', "'") and i < len(text)
            end = run(i, value)
            if end > i:
                return end, i
        return None

    i = 0
    while i < len(text):
        found = assign(i)
        if found:
            if found[0] - found[1] >= 6:
                out.append(("assign", i, found[0]))
            i = found[0]
        else:
            i += 1
    i = 0
    while i < len(text):
        end = run(i + 4, set(letters.upper() + "0123456789")) if text.startswith("AKIA", i) else i
        if end > i + 4:
            if end - i >= 20:
                out.append(("access", i, end))
            i = end
        else:
            i += 1
    i = 0
    while i < len(text):
        end = run(i, "0123456789abcdef")
        if end - i >= 24:
            out.append(("hex", i, end))
        i = max(end, i + 1)
    kinds = ("assign", "access", "hex")
    return sorted(out, key=lambda x: (x[1], kinds.index(x[0])))


def language(rows, buckets=1 << 16):
    """doc_id -> (language, posterior, posterior of the next) by Bayes' rule over counted n-grams of 1 to 3 characters."""
    factors = [int(x) for x in textvec.salts(3, 51)]

    def grams(text):
        symbols = [ord(c) if unicodedata.category(c)[0] == "L" else 32 for c in (text or "").lower()]
        padded, out = symbols + [32, 32], []
        for n in (1, 2, 3):
            for i in range(len(symbols)):
                part = padded[i : i + n]
                if any(s != 32 for s in part):
                    key = (sum(s * f for s, f in zip(part, factors)) + n - 1) % (1 << 64)
                    out.append(int(textvec.mix(np.array([key], dtype=np.uint64))[0]) >> 48)
        return out

    count = collections.defaultdict(collections.Counter)
    for d, t, lang in rows:
        if lang is not None and d is not None and zlib.crc32(str(d).encode()) % 4 != 2:
            count[lang].update(grams(t))
    out = {}
    for d, t, _ in rows:
        logs = {x: sum(math.log((c[g] + 1) / (sum(c.values()) + buckets)) for g in grams(t)) for x, c in count.items()}
        top = max(logs.values())
        odds = sorted(((math.exp(v - top), x) for x, v in logs.items()), reverse=True)
        total = sum(o for o, _ in odds)
        out[d] = (odds[0][1], odds[0][0] / total, odds[1][0] / total)
    return out
