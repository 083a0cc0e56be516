"""Plain versions of the operators, for small inputs."""

import functools
import hashlib
import math
import re
import zlib

GAP = r"[\x20\x09-\x0D]+"


def words(text):
    return [w for w in re.split(GAP, text or "") if w]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def base(text):
    t, w = text or "", words(text)
    grams = {}
    for i in range(len(w) - 4):
        grams.setdefault(tuple(w[i:i + 5]), []).append(i)
    hit = {i + k for at in grams.values() if len(at) > 1 for i in at for k in range(5)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 10 or 100 * len(hit) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(hit), failed


def quality(docs, min_docs=20, share=0.1, limit=0.5):
    """docs: (id, text, host) -> {id: kept}"""
    lines, hosts = {}, {}
    norm = lambda x: re.sub(GAP, " ", x.lower()).strip(" ")
    for i, (_, t, h) in enumerate(docs):
        hosts[h] = hosts.get(h, 0) + 1
        for x in (t or "").split("\n"):
            if norm(x):
                lines.setdefault((h, norm(x)), set()).add(i)
    out = {}
    for d, t, h in docs:
        gone = sum(len(words(x)) for x in (t or "").split("\n") if norm(x)
                   and len(lines[h, norm(x)]) > max(min_docs, share * hosts[h]))
        n, *_, failed = base(t)
        out[d] = not failed and gone <= limit * n
    return out


def shingles(text):
    w = words(lower(text))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def components(docs):
    """docs: (id, text) -> {id: (size, component)}"""
    s = [(i, shingles(t)) for i, t in docs]
    parent = {i: i for i, _ in s}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(s):
        for j, b in s[:k]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: (len(a), find(i)) for i, a in s}


def covered(docs, length=50):
    """docs: (id, text) -> {id: mask of removed bytes}"""
    first = {}
    raw = {i: (t or "").encode() for i, t in docs}
    for i, b in raw.items():
        for k in range(len(b) - length + 1):
            x = b[k:k + length]
            first[x] = min(first.get(x, i), i)
    out = {}
    for i, b in raw.items():
        m = [False] * len(b)
        for k in range(len(b) - length + 1):
            if first[b[k:k + length]] < i:
                m[k:k + length] = [True] * length
        out[i] = m
    return out


def suffix_digest(docs, length=50):
    out = {}
    masks = covered(docs, length)
    for i, t in docs:
        b, m = (t or "").encode(), masks[i]
        spans = sum(m[k] and not (k and m[k - 1]) for k in range(len(b)))
        out[i] = (len(b), sum(m), spans, hashlib.sha256(bytes(x for x, g in zip(b, m) if not g)).hexdigest())
    return out


def cut(docs, length=50):
    """Texts without the removed characters (all of whose bytes are covered, run by run)."""
    masks, out = covered(docs, length), {}
    for i, t in docs:
        at, keep = 0, []
        for c in t or "":
            n = len(c.encode())
            if not all(masks[i][at:at + n]):
                keep.append(c)
            at += n
        out[i] = None if t is None else "".join(keep)
    return out


def tree_scores(docs, depth):
    """docs: (id, text) -> {id: log10 probability}, learning from ids whose checksum does not leave 2 modulo 7."""
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs}
    count, kids = {}, {}

    def bits(b):
        for i in range(8):
            yield (256 | b) >> (8 - i), (b >> (7 - i)) & 1

    def walk(t):
        s = b"\xff" * depth + lower(t).encode() + b"\xff"
        for j in range(depth, len(s)):
            yield s[j - depth:j], s[j]

    for i, t in docs:
        for c, b in walk(t) if not held[i] else ():
            for k, bit in bits(b):
                for d in range(depth + 1):
                    count.setdefault((c[depth - d:], k), [0, 0])[bit] += 1
    for c, k in count:
        if c:
            kids.setdefault((c[1:], k), []).append((c, k))

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    @functools.cache
    def weighted(s):
        e = kt(*count[s])
        if len(s[0]) == depth:
            return e
        below = sum(weighted(x) for x in kids.get(s, []))
        m = max(e, below)
        return m + math.log(0.5 * (math.exp(e - m) + math.exp(below - m)))

    def one(c, k, d=0):
        s = (c[depth - d:], k)
        if s not in count:
            return 0.5
        a, b = count[s]
        q = (b + 0.5) / (a + b + 1)
        if d == depth:
            return q
        below = sum(weighted(x) for x in kids.get(s, []))
        w = 1 / (1 + math.exp(min(700, below - kt(a, b))))
        return w * q + (1 - w) * one(c, k, d + 1)

    return {i: sum(math.log10(one(c, k) if bit else 1 - one(c, k)) for c, b in walk(t) for k, bit in bits(b)) for i, t in docs}


def base_scores(docs):
    """docs: (id, text) -> {id: (tokens, known tokens, training tokens, base score)}; None stands for the end."""
    count = {}
    for i, t in docs:
        if i is None or zlib.crc32(str(i).encode()) % 7 != 2:
            for w in [*words(lower(t)), None]:
                count[w] = count.get(w, 0) + 1
    n, v, out = sum(count.values()), len(count), {}
    for i, t in docs:
        tokens = [*words(lower(t)), None]
        out[i] = (len(tokens), sum(w in count for w in tokens), n, sum(math.log10((count.get(w, 0) + 1) / (n + v + 1)) for w in tokens))
    return out


def planted(i, w):
    """A document's words after the query's rewriting."""
    h = zlib.crc32(str(i).encode()) if i is not None else 1
    if h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (k - a) % p] for k in range(a, n)]


def runs(w, least=6, times=4):
    """(start, period, end) of all runs."""
    n, out = len(w), set()
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            e = i + q
            if e - s >= max(least, times * q) and not any(all(w[k] == w[k + p] for k in range(s, e - p)) for p in range(1, q)):
                out.add((s, q, e))
    return sorted(out)


def run_digest(i, text):
    w = planted(i, words(text))
    found = [(s, e - s, q) for s, q, e in runs(w)]
    kept = [x for k, x in enumerate(w) if not any(s + q <= k < s + n for s, n, q in found)]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    start, length, period = max(found, key=lambda r: (r[1], -r[0], -r[2])) if found else (None,) * 3
    return (len(found), start, length, period, 1000 * length // period if found else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(kept)))


def phrases(rows, least, most=5, inside=100, top=2000):
    """rows: (lang, text) -> sorted (lang, rank, phrase, a, l, r, n, score)"""
    f, n = {}, {}
    for lang, t in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(t)):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang] = n.get(lang, 0) + len(w)
            for m in range(1, most + 1):
                for i in range(len(w) - m + 1):
                    f[lang, tuple(w[i:i + m])] = f.get((lang, tuple(w[i:i + m])), 0) + 1
    cand = [k for k, a in f.items() if a >= least and len(k[1]) > 1]
    drop = {(lg, p[i:i + m]) for lg, p in cand for m in range(2, len(p)) for i in range(len(p) - m + 1)
            if 100 * f[lg, p] >= inside * f[lg, p[i:i + m]]}
    out = {}
    for lg, p in cand:
        if (lg, p) not in drop:
            a = f[lg, p]
            s, k = min((1000 * a * n[lg] // (f[lg, p[:k]] * f[lg, p[k:]]), k) for k in range(1, len(p)))
            out.setdefault(lg, []).append((-s, -a, " ".join(p).encode(), f[lg, p[:k]], f[lg, p[k:]]))
    return sorted((lg, r + 1, x[2].decode(), -x[1], x[3], x[4], n[lg], -x[0]) for lg, v in out.items() for r, x in enumerate(sorted(v)[:top]))
