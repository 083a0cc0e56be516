"""Operators over several documents: 2, 3, 5, 7, 9 and the pipeline."""

import itertools
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pytest
import zstandard

from tessera.llm import op2_chains, op3_mix, op5_topk, op7_suffixes, op8_pieces, op9_jaccard
from tessera.llm.common import connected, skew_join

from . import brute
from .helpers import near, prose, vocabulary

ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (6, "é" * 3000 + " end"), (7, "x " * 30000), (None, "no id at all")]


# ---- helpers

def test_skew_join_equals_a_join(spark):
    left = spark.createDataFrame([(i % 7 if i % 3 else 0, i) for i in range(3000)], "k int, v int")
    right = left.groupBy("k").count().withColumnRenamed("count", "rows").where("k < 5")
    for how in ("inner", "left"):
        got = skew_join(left, right, ["k"], "rows", how)
        want = left.join(right, "k", how).select(*got.columns)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_connected_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 140)] + [(500, 500 + i) for i in range(1, 60)] + [tuple(rng.sample(range(1000, 1100), 2)) for _ in range(60)]
    parent = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(parent[a], parent[b])
            changed |= parent[a] != m or parent[b] != m
            parent[a] = parent[b] = m
    got = {r[0]: r[1] for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == parent
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- 2

def test_chains_against_all_subsets():
    rng = np.random.default_rng(0)

    def score(seg, c):
        s = seg[c[0]][4]
        for p, q in zip(c, c[1:]):
            if not (seg[p][1] <= seg[q][0] and seg[p][3] <= seg[q][2]):
                return -1
            s += seg[q][4] - 0.25 * (seg[q][0] - seg[p][1] + seg[q][2] - seg[p][3])
        return s

    for _ in range(100):
        seg = []
        for _ in range(rng.integers(1, 8)):
            a, b, n = (int(x) for x in (*rng.integers(0, 40, 2), rng.integers(1, 6)))
            seg.append((a, a + n, b, b + n, n + 4))
        seg.sort()
        best = max(score(seg, c) for r in range(1, len(seg) + 1) for c in itertools.combinations(range(len(seg)), r))
        assert abs(score(seg, op2_chains.chain(seg)[0]) - best) < 1e-9


def test_banded_alignment_against_the_full_table():
    rng = np.random.default_rng(1)

    def full(x, y):
        h = np.zeros((len(x) + 1, len(y) + 1), int)
        for i, j in itertools.product(range(len(x)), range(len(y))):
            h[i + 1, j + 1] = max(0, h[i, j] + (1 if x[i] == y[j] else -1), h[i + 1, j] - 1, h[i, j + 1] - 1)
        return h.max()

    pairs = []
    for t in range(60):
        x = rng.integers(0, 4 if t % 2 else 50, rng.integers(1, 40)).astype("<u4")
        y = np.delete(x, rng.integers(0, len(x), 3)) if len(x) > 6 else rng.integers(0, 4, 20).astype("<u4")
        pairs.append((x, y, -60, 60) if t % 3 else (x, np.append(rng.integers(60, 90, 9), y).astype("<u4"), -75, 40))
    pairs.append((np.arange(3, dtype="<u4"), np.arange(10, 14, dtype="<u4"), -5, 5))
    for (x, y, _, _), (i, j, k, m, n) in zip(pairs, op2_chains.banded(pairs)):
        assert full(x[i:j], y[k:m]) == full(x, y) and n <= min(j - i, m - k)
        assert not n or (x[i] == y[k] and x[j - 1] == y[m - 1])


def test_fuzzy_passages_are_found_and_clean_texts_left(documents):
    rng = random.Random(7)
    w = vocabulary(rng, 5000)
    passages = [prose(rng, w, n) for n in (55, 80, 200)]
    data, planted = [], {}
    for i in range(60):
        a, b = prose(rng, w, rng.randint(20, 120)), prose(rng, w, rng.randint(20, 120))
        if i % 4 == 0:
            p = (i // 4) % 3
            edited = near(rng, passages[p], w, 0.06).split(" ")
            if i % 8 == 0 and p == 2:  # an insertion and a deletion
                edited[100:100] = ["extra", "words"]
                del edited[40:43]
            data.append((i, f"{a} {' '.join(edited)} {b}"))
            planted.setdefault(p, []).append((i, len(a.split(" ")), len(edited)))
        else:
            data.append((i, f"{a} {b}"))
    data += [(900, data[1][1]), (901, data[1][1]), (902, None), (903, ""), (None, data[0][1]), (904, " ".join([passages[0]] * 3))]
    got = op2_chains.passages(documents(data, extra=True)).collect()
    hits = {}
    for r in got:
        hits.setdefault(r.doc_id, []).append(r)
        assert r.n_words >= op2_chains.MIN_WORDS and r.identity >= 0.8 and r.source_id != r.doc_id
    for group in planted.values():
        for i, start, n in group[1:]:
            over = max(min(r.end_word, start + n) - max(r.start_word, start) for r in hits[i])
            assert over >= 0.75 * n, (i, start, n, hits[i])
            assert all(r.start_word >= start - 5 and r.end_word <= start + n + 5 for r in hits[i])
    assert {(r.source_id, r.kind) for i in (900, 901) for r in hits[i]} == {(1, "copy")}
    allowed = {i for g in planted.values() for i, _, _ in g} | {900, 901, 904}
    assert set(hits) <= allowed and 904 in hits
    assert op2_chains.passages(documents([])).count() == 0


def test_hot_seeds_take_the_same_matches(documents, monkeypatch):
    rng = random.Random(8)
    w = vocabulary(rng, 3000)
    p = prose(rng, w, 70)
    data = [(i, f"{prose(rng, w, 30)} {p} {prose(rng, w, 30)}") for i in range(40)]
    df = documents(data)
    cold = sorted(op2_chains.passages(df).collect())
    monkeypatch.setattr(op2_chains, "HOT_SEEDS", 5)
    assert sorted(op2_chains.passages(df).collect()) == cold
    assert {r.doc_id for r in cold} == set(range(1, 40)) and {r.source_id for r in cold} == {0}


def _decoded(df):
    out = set()
    for r in df.collect():
        raw = zstandard.ZstdDecompressor().decompress(r["load"])
        n = len(raw) // 24
        cols = [np.frombuffer(raw, t, n, at * n) for t, at in (("<i8", 0), ("<i8", 8), ("<i4", 16), ("<i4", 20))]
        out |= {(r["kind"], *x) for x in zip(*(c.tolist() for c in cols))}
    return out


def _all_hot(monkeypatch, keys):
    """Every seed that occurs again is hot, and hot seeds are dealt over many ranges of ids."""
    monkeypatch.setattr(op2_chains, "HOT_SEEDS", 1)
    monkeypatch.setattr(op2_chains, "HOT", 1 << 40)
    monkeypatch.setattr(op2_chains, "RANGE_BUCKETS", 1)
    monkeypatch.setattr(op2_chains, "RANGES", keys)


@pytest.mark.parametrize("ranges", [4, 64])
def test_hot_seeds_meet_the_document_before(documents, monkeypatch, ranges):
    rng = random.Random(31)
    w = vocabulary(rng, 5)  # 4-word seeds come many times, also within a text
    ids = rng.sample(range(-5000, 5000), 150)
    df = documents([(i, prose(rng, w, rng.randint(0, 60))) for i in ids]).selectExpr("doc_id as id", "text").repartition(5)
    monkeypatch.setattr(op2_chains, "BUCKET_BYTES", (512, 1 << 20))
    cold = _decoded(op2_chains.matches(df))
    assert {m[0] for m in cold} == {0, 1}
    _all_hot(monkeypatch, ranges)
    assert len(op2_chains.hot_keys(df)) > 200
    assert _decoded(op2_chains.matches(df)) == cold


def test_passage_of_hot_seeds_that_stood_elsewhere_before(documents, monkeypatch):
    rng = random.Random(32)
    w, other = vocabulary(rng, 4000), vocabulary(rng, 4000)
    passage = rng.sample(w, 60)
    data = [(i, " ".join(rng.sample(other, 20) + passage[3 * i:3 * i + 6] + rng.sample(other, 20))) for i in range(19)]
    data += [(100 + i, " ".join(rng.sample(other, 30) + passage + rng.sample(other, 30))) for i in range(3)]
    _all_hot(monkeypatch, 4)
    got = {(r.doc_id, r.source_id): (r.start_word, r.end_word) for r in op2_chains.passages(documents(data)).collect()}
    assert set(got) == {(101, 100), (102, 101)} and all(a <= 30 and b >= 90 for a, b in got.values())


def test_all_passages_of_a_chain_are_found(documents):
    rng = random.Random(9)
    word = lambda n: [f"w{rng.randrange(10 ** 9)}" for _ in range(n)]
    data, want = [], {}
    for t, (size, gap, bent) in enumerate(itertools.product((50, 100), (10, 26, 49, 60, 100, 150, 200), (0, 3))):
        p, q = word(size), word(size)
        data.append((t, " ".join(word(30) + p + word(gap) + q + word(30))))
        data.append((1000 + t, " ".join(word(40) + p + word(gap + bent) + q + word(20))))
        want[1000 + t] = [(40, 40 + size), (40 + size + gap + bent, 40 + 2 * size + gap + bent)]
    got = {}
    for r in op2_chains.passages(documents(data)).collect():
        assert r.identity >= 0.8 and r.n_words >= 40 and r.source_id == r.doc_id - 1000
        got.setdefault(r.doc_id, []).append((r.start_word, r.end_word))
    for i, (p, q) in want.items():
        one = [(p[0], q[1])]  # near passages are one while together they reach the identity
        size = q[1] - p[0]
        assert sorted(got[i]) == (one if 2 * (p[1] - p[0]) >= 0.8 * size else [p, q]), (i, size)


def test_parts_of_an_alignment_leave_none_out():
    rng = np.random.default_rng(2)
    for t in range(300):
        n, least = int(rng.integers(1, 60)), 12
        eq = rng.random(n) < rng.choice([0.5, 0.75, 0.9])
        dx, dy = np.ones(n, int), np.ones(n, int)
        if t % 2:
            dx[~eq & (rng.random(n) < 0.4)] = 0
            dy[~eq & (dx == 1) & (rng.random(n) < 0.4)] = 0
        got = op2_chains.parts(eq, dx, dy, least, 0.8)
        size = lambda i, j: max(dx[i:j].sum(), dy[i:j].sum())
        assert all(size(i, j) >= least and eq[i:j].sum() >= 0.8 * size(i, j) for i, j in got)
        used = sorted(got)
        assert all(a[1] <= b[0] for a, b in zip(used, used[1:]))
        # a run of equal words is never left out whole
        for i in range(n - least + 1):
            assert not eq[i:i + least].all() or any(a < i + least and b > i for a, b in got)


def test_passage_whose_seeds_stood_elsewhere_before(documents):
    rng = random.Random(10)
    word = lambda n: [f"w{rng.randrange(10 ** 9)}" for _ in range(n)]
    p = word(60)
    # earlier documents hold the passage's phrases, each another one
    data = [(i, " ".join(word(20) + p[6 * i - 3:6 * i + 8] + word(20))) for i in range(1, 10)] + [(0, " ".join(p[:8] + word(30)))]
    data += [(50, " ".join(word(30) + p + word(10))), (51, " ".join(word(5) + p + word(30))), (52, " ".join(word(9) + p + word(9)))]
    data += [(60, data[-1][1]), (61, " ".join(word(7) + p + word(9)))]
    got = {(r.doc_id, r.source_id): (r.start_word, r.end_word) for r in op2_chains.passages(documents(data)).collect()}
    assert got == {(51, 50): (5, 65), (52, 51): (9, 69), (60, 52): (0, 78), (61, 52): (7, 67)}


@pytest.mark.parametrize("size,share", [(40, 0.2), (50, 0.2), (50, 0.16), (60, 0.2), (60, 0.15), (100, 0.2), (100, 0.15)])
def test_passages_at_the_identity_are_found(size, share):
    """Each edited passage against its source: seeds, chains and alignment find it."""
    rng = np.random.default_rng(size)
    edits = int(size * share + 1e-9)
    found, trials = 0, 200
    for t in range(trials):
        new = lambda n: rng.integers(0, 1 << 62, n).astype(np.uint64)
        p = new(size)
        q = p.copy()
        # evenly spaced or anywhere inside (an edited end is not part of a passage)
        at = np.arange(1, edits + 1) * size // (edits + 1) if t % 4 == 0 else 1 + rng.choice(size - 2, edits, replace=False)
        q[at] = new(edits)
        x, y = np.concatenate([new(80), p, new(80)]), np.concatenate([new(90), q, new(70)])
        row, h = np.repeat([0, 1], 160 + size), np.concatenate([x, y])
        r, pos, key = op2_chains.seeds(row, h, np.array([0, 160 + size]))
        first = dict(zip(key[r == 0].tolist(), pos[r == 0].tolist()))
        m = np.array([(b, first[k]) for k, b in zip(key[r == 1].tolist(), pos[r == 1].tolist()) if k in first], np.int64).reshape(-1, 2)
        c = op2_chains.chains_in_bucket(np.ones(len(m), np.int64), np.zeros(len(m), np.int64), m[:, 0], m[:, 1])
        spans = [(y.astype("<u4"), x.astype("<u4"), int(d), int(a - b), int(a), int(z) + 3) for d, a, z, b in zip(c["drift"], c["d0"], c["d1"], c["s0"])]
        found += any(min(j, 90 + size) - max(i, 90) >= 0.75 * size for one in op2_chains.align(spans) for i, j, _, _, _ in one)
    assert found == trials


@pytest.mark.parametrize("size", [40, 50, 60, 100, 200])
@pytest.mark.parametrize("kind", ["replaced", "left out", "put in", "one out one in", "mixed"])
def test_edited_passages_are_found_end_to_end(documents, size, kind):
    """Random passages with 4 % to 12 % of their words edited, each kind of edit for itself and all together."""
    rng = random.Random(f"{size}{kind}")
    word = lambda n: [f"w{rng.randrange(10 ** 9)}" for _ in range(n)]
    data, trials = [], 60
    for t in range(trials):
        p = word(size)
        q, n = list(p), max(2, int(size * rng.choice([0.04, 0.08, 0.12])))
        if kind == "one out one in":
            a, b = sorted(rng.sample(range(3, size - 3), 2))
            q = p[:a] + p[a + 1:b] + word(1) + p[b:] if t % 2 else p[:a] + word(1) + p[a:b] + p[b + 1:]
        else:
            for at in sorted(rng.sample(range(1, size - 1), n), reverse=True):
                what = rng.choice(["replaced", "left out", "put in"]) if kind == "mixed" else kind
                q[at:at + (what != "put in")] = [] if what == "left out" else word(1)
        data += [(t, " ".join(word(30) + p + word(30))), (1000 + t, " ".join(word(20) + q + word(20)))]
    # a passage that edits cut under MIN_WORDS words is none
    sure = {1000 + t for t in range(trials) if len(data[2 * t + 1][1].split()) - 40 >= op2_chains.MIN_WORDS + 2}
    got = {r.doc_id for r in op2_chains.passages(documents(data)).collect()}
    assert len(got & sure) >= 0.95 * len(sure), (len(got & sure), len(sure))


# ---- 3

def test_targets_fill_to_the_cap():
    assert op3_mix.targets([100, 100, 100], [5, 2, 1]) == pytest.approx([187.5, 75, 37.5])
    t = op3_mix.targets([10, 500, 500, 0], [5, 2, 1, 5])
    assert t[0] == 30 and t[3] == 0 and sum(t) == pytest.approx(1010) and t[1] == pytest.approx(2 * t[2])
    assert op3_mix.targets([], []) == []


def test_fit_reaches_the_best_sum():
    rng = random.Random(4)
    for _ in range(200):
        n = rng.randint(1, 6)
        lengths, counts = rng.sample(range(1, 30), n), [rng.randint(1, 3) for _ in range(n)]
        budget = rng.randint(0, sum(a * b for a, b in zip(lengths, counts)))
        take = op3_mix.fit(lengths, counts, budget)
        best = max(s for c in itertools.product(*(range(k + 1) for k in counts)) if (s := sum(a * b for a, b in zip(c, lengths))) <= budget)
        assert all(0 <= a <= b for a, b in zip(take, counts)) and sum(a * b for a, b in zip(take, lengths)) == best
    lengths, counts = list(range(1, 900)), [700] * 899
    take = op3_mix.fit(lengths, counts, 123_456_789)
    assert sum(a * b for a, b in zip(take, lengths)) == 123_456_789 and all(a <= b for a, b in zip(take, counts))


def test_mix_hits_targets_and_reruns_agree(documents):
    rng = random.Random(9)
    w = vocabulary(rng, 50)
    data = [(i, prose(rng, w, rng.choice([3, 7, 20, 41])), ["b", "a", None, "z", ""][i % 5 if i % 3 else 0]) for i in range(700)]
    data += [(r[0] + 5000 if r[0] is not None else None, r[1], "a") for r in ODD] + [(699, data[699][1], data[699][2])]
    df = documents(data, extra=True)
    got = op3_mix.mix(df).collect()
    assert len(got) == len(data)
    sizes = {}
    for _, t, s in data:
        sizes[s] = sizes.get(s, 0) + len(brute.words(t))
    order = sorted((s for s in sizes if s is not None)) + [None]
    want = dict(zip(order, op3_mix.targets([sizes[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))])))
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == r.copies * r.size <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - want[s]) <= 2 for s in order if s != "a")  # "a" holds one text of 30,000 words
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(op3_mix.mix(df.repartition(5)).collect(), key=key) == sorted(got, key=key)
    assert op3_mix.mix(documents([])).count() == 0


# ---- 5

def test_top_k_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(2)
    data = [(i, [float(x) for x in rng.integers(-3, 4, 4) / 256 + 0.001]) for i in range(260)]
    data += [(300, None), (350, [0.1, None, 0.2, 0.3]), (400, [float("nan")] * 4), (450, [float("inf"), 0.0, 0.0, 0.0]), (500, []), (550, [0.5]),
             (None, [0.1] * 4), (600, [1e12, 1.0, 1.0, 1.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in data], "vec_id long, embedding array<float>, label string")
    q = {i: [int(np.floor(256 * float(np.float32(x)))) for x in v] for i, v in data if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for i in sorted(q):
        if i % 50 == 0:
            best = sorted(((-sum(a * b for a, b in zip(q[i], q[j])), j) for j in q if j != i))[:5]
            want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    assert sorted(map(tuple, op5_topk.search(df).collect())) == sorted(want)
    v = df.select("vec_id", op5_topk.quantise(df.embedding).alias("v"))
    monkeypatch.setattr(op5_topk, "FAN", 3)
    small = op5_topk.top_k(v.where("vec_id % 50 = 0"), v, 5, query_tile=2, shard_tile=11)
    assert sorted(map(tuple, small.collect())) == sorted(want)
    assert op5_topk.search(df.limit(0)).count() == 0


# ---- 7

def suffix_rows(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op7_suffixes.digest(df).collect()}


def copies_and_passages(seed, n=40):
    rng = random.Random(seed)
    w = vocabulary(rng, 300) + ["é" * 5, "日本語" * 3]
    p = [prose(rng, w, 25) for _ in range(4)]
    out = []
    for i in range(n):
        t = prose(rng, w, rng.randint(0, 60))
        if i % 3 == 0:
            t += " " + rng.choice(p) + " " + prose(rng, w, 5)
        if i % 5 == 0 and out:
            t = near(rng, rng.choice(out)[1], w, 0.05)
        if i % 7 == 0 and out:
            t = rng.choice(out)[1]
        out.append(((i * 7) % n, t))
    return out


def test_multikey_order():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 500):
        t = rng.integers(0, 3, (n, 5)).astype(np.uint64)
        got = op7_suffixes.multikey_order(t)
        assert sorted(got.tolist()) == list(range(n)) and t[got].tolist() == sorted(t.tolist())


def test_suffix_dedup_against_brute_force(documents, monkeypatch):
    data = list({i: (i, t) for i, t in copies_and_passages(11)}.values()) + [(1000, "a" * 500), (1001, "b" + "a" * 300), (1002, None), (1003, "")]
    want = brute.suffix_digest(data)
    df = documents(data, extra=True).repartition(5)
    assert suffix_rows(df) == want
    # split leading bytes give the same
    monkeypatch.setattr(op7_suffixes, "HOT", 10 ** 9)
    monkeypatch.setattr(op7_suffixes, "HOT_ROWS", 1)
    assert suffix_rows(df) == want
    cut = {r.doc_id: r for r in op7_suffixes.clean(df).collect()}
    plain = brute.cut(data)
    assert {i: r.text for i, r in cut.items()} == plain and all(r.rest == "x" and r.lang == "en" for r in cut.values())


def test_suffix_dedup_odd_rows(documents):
    got = op7_suffixes.digest(documents([*ODD, (8, "z" * 60), (8, "z" * 60)])).collect()
    assert len(got) == len(ODD) + 2 and all(r.n_removed == 0 for r in got)
    assert op7_suffixes.digest(documents([])).count() == 0


# ---- 9

@pytest.mark.parametrize("settings", [{}, {"HOT_DOCS": 2, "SMALL": 2, "TILE": 3}])
def test_jaccard_components_against_brute_force(documents, monkeypatch, settings):
    for k, v in settings.items():
        monkeypatch.setattr(op9_jaccard, k, v)
    rng = random.Random(13)
    w = vocabulary(rng, 400)
    hot = prose(rng, w, 40)
    data = []
    for i in range(150):
        t = prose(rng, w, rng.choice([0, 1, 3, 4, 5, 6, 9, 30, 60, 120]))
        if i % 4 == 0:
            t = f"{t} {hot} {prose(rng, w, 4)}".strip()
        if i % 2 and data:
            t = near(rng, rng.choice(data)[1] or "", w, rng.choice([0, 0.01, 0.02, 0.04]))
        data.append(((i * 37) % 150, t if i % 50 else t.upper()))
    data += [(500, None), (501, " \n"), (502, "A b C d"), (503, "a B c d"), (504, "a b c d e"), (505, "a b c d")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op9_jaccard.components(documents(data, extra=True).repartition(3)).collect()}
    assert got == brute.components(data)


@pytest.mark.parametrize("settings", [{}, {"CHUNK": 1}, {"CHUNK": 7}, {"SMALL": 2, "CHUNK": 3}])
def test_jaccard_groups_cut_by_batches(spark, documents, monkeypatch, settings):
    for k, v in settings.items():
        if hasattr(op9_jaccard, k):
            monkeypatch.setattr(op9_jaccard, k, v)
    rng = random.Random(19)
    w = vocabulary(rng, 3000)
    data = []
    for _ in range(40):
        t = prose(rng, w, 9)
        data += [(len(data) + i, t + x) for i, x in enumerate([""] + [f" {rng.choice(w)}" for _ in range(rng.randint(1, 4))])]
    df = documents(data)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in op9_jaccard.components(df).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got == brute.components(data)


def test_jaccard_odd_rows(documents):
    got = op9_jaccard.components(documents([*ODD, (8, "same words right here now"), (8, "same words right here now"), (9, "same words right here NOW")])).collect()
    assert len(got) == len(ODD) + 3
    assert sorted(r.component_id for r in got if r.doc_id in (8, 9)) == [8, 8, 8]
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    assert op9_jaccard.components(documents([])).count() == 0


def test_token_sets_hold_a_piece_at_a_time(monkeypatch):
    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randrange(500)}" for _ in range(rng.choice((0, 3, 40, 600)))).encode() for _ in range(1500)]
    texts[7] = b"long text " * 4000
    data, off = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in texts])])
    tracemalloc.start()
    row, tok = op9_jaccard.token_sets(data, off)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20 * len(data)  # one cut of everything takes 38 bytes a byte
    for size in (1, 1 << 10, 1 << 30):
        monkeypatch.setattr(op9_jaccard, "PIECE", size)
        r, t = op9_jaccard.token_sets(data, off)
        assert (r == row).all() and (t == tok).all()
    for i in (0, 7, 8, len(texts) - 1):
        assert (tok[row == i] == op9_jaccard.token_sets(data[off[i]:off[i + 1]], np.array([0, len(texts[i])]))[1]).all()


def test_sketches_never_drop_a_link():
    rng = np.random.default_rng(6)
    for _ in range(200):
        n = int(rng.integers(2, 400))
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        b = np.concatenate([a[int(n * rng.uniform(0, 0.25)):], rng.integers(0, 1 << 63, int(n * rng.uniform(0, 0.2))).astype(np.uint64)])
        x, y = len(np.intersect1d(a, b)), len(np.union1d(a, b))
        if 100 * x >= 80 * y:
            assert op9_jaccard.may_link(np.array([len(a)]), np.array([len(b)]), [op9_jaccard.sketch(a)], [op9_jaccard.sketch(b)])[0]


# ---- pipeline

def test_the_mix_is_not_broadcast(spark, documents):
    import corpus_pipeline
    rng = random.Random(10)
    w = vocabulary(rng, 50)
    df = documents([(i, prose(rng, w, rng.choice([3, 7, 20])), ["b", "a", None, ""][i % 4]) for i in range(300)] + [(1000, None, "a"), (1001, " ", "a")])
    copies = {r.doc_id: r.copies for r in op3_mix.mix(df).where("taken > 0").collect()}
    out = corpus_pipeline.take_mix(spark, df, "")
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, out.collect()), key=str) == sorted((tuple(r) for r in df.collect() for _ in range(copies.get(r.doc_id, 0))), key=str)


def test_pipeline_against_brute_force(spark, documents, tmp_path):
    import corpus_pipeline
    rng = random.Random(17)
    w = vocabulary(rng, 800)
    p = prose(rng, w, 30)
    data = []
    for i in range(60):
        t = "\n".join(prose(rng, w, rng.randint(6, 30)) for _ in range(3))
        if i % 6 == 1:
            t = data[-1][1] + " tail"
        if i % 5 == 2:
            t += "\n" + p
        data.append((i, t, "s1" if i % 3 else "s2"))
    data += [(70, None, "s1"), (71, "", None), (72, "a b c", "s1"), (73, "w x y z v " * 9, "s2")]
    documents(data).write.parquet(f"{tmp_path}/documents.parquet")
    kept = brute.quality(data)
    docs = [r for r in data if kept[r[0]]]
    first = brute.components([r[:2] for r in docs])
    docs = [r for r in docs if first[r[0]][1] == r[0]]
    texts = brute.cut([r[:2] for r in docs])
    voc = op8_pieces.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    copies, words = {}, {}
    for r in got:
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
        best, ids = voc.n_best(("▁" + texts[r.doc_id]).replace(" ", "▁"), 1)[0]
        assert r.score == best and r.n_pieces == len(ids) and r.round_trip
    source, size = {r[0]: r[2] for r in docs}, {i: len(brute.words(t)) for i, t in texts.items()}
    assert set(copies) <= set(texts) and max(copies.values()) <= 3
    order = sorted({*source.values()})
    totals = [sum(size[i] for i in size if source[i] == s) for s in order]
    for s, t in zip(order, op3_mix.targets(totals, [5, 2][:len(order)])):
        words[s] = sum(n * size[i] for i, n in copies.items() if source[i] == s)
        assert abs(words[s] - t) <= 3
