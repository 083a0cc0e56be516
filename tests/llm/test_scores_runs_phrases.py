"""Operators 11, 12 and 13 against plain versions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import blocks, op11_trees, op12_runs, op13_phrases, queries

from . import brute
from .helpers import prose, vocabulary

ODD = [(1001, None), (1002, ""), (1003, " \n\t "), (1004, "A"), (1005, "é" * 300 + " end"), (None, "no id at all"), (1006, "x " * 3000)]


# ---- 11

@pytest.mark.parametrize("depth", [1, 2, 4])
def test_tree_scores_equal_the_plain_recursion(documents, depth):
    rng = random.Random(depth)
    w = ["the", "Cat", "dög", "ran off\n", "xyz,"]
    data = [(i, prose(rng, w, rng.randint(0, 40)) + (rng.choice("qQ€") if i % 6 == 0 else "")) for i in range(40)] + ODD
    got = {r.doc_id: r for r in op11_trees.score(documents(data, extra=True).repartition(3), depth=depth).collect()}
    want, base = brute.tree_scores(data, depth), brute.base_scores(data)
    assert len(got) == len(data)
    for i, _ in data:
        r = got[i]
        assert r.score == pytest.approx(want[i], rel=1e-9)
        assert (r.n_tokens, r.n_known, r.train_tokens) == base[i][:3] and r.base_score == pytest.approx(base[i][3], rel=1e-9)
        assert r.bits_per_byte == pytest.approx(-want[i] / math.log10(2) / (len(brute.lower(dict(data)[i]).encode()) + 1))


def test_small_blocks_give_the_same_scores(documents, monkeypatch):
    """Strings and words are answered across blocks; every text a block of its own."""
    rng = random.Random(3)
    data = [(i, prose(rng, vocabulary(rng, 60), 80)) for i in range(30)]
    whole = {r.doc_id: r for r in op11_trees.score(documents(data)).collect()}
    real = op11_trees._blocks

    def tiny(depth):
        task = real(depth)
        return lambda batches: (setattr(op11_trees, "BLOCK_BYTES", 1), setattr(op11_trees, "STEP_BYTES", 1), task(batches))[2]

    monkeypatch.setattr(op11_trees, "_blocks", tiny)
    for r in op11_trees.score(documents(data).repartition(7)).collect():
        w = whole[r.doc_id]
        assert r.score == pytest.approx(w.score, rel=1e-9) and r.base_score == pytest.approx(w.base_score, rel=1e-9) and r.n_known == w.n_known


def test_scores_without_training_rows_or_any(documents):
    got = op11_trees.score(documents([(1, "ab"), (2, None)]), held=F.lit(True)).collect()
    assert {r.doc_id: (r.train_tokens, r.n_known, r.base_score) for r in got} == {1: (0, 0, 0.0), 2: (0, 0, 0.0)}
    assert {r.doc_id: r.score for r in got} == {1: pytest.approx(24 * math.log10(0.5)), 2: pytest.approx(8 * math.log10(0.5))}
    assert op11_trees.score(documents([])).count() == 0


def test_repeated_rows_are_scored_each(documents):
    rows = op11_trees.score(documents([(5, "a b a"), (5, "a b a"), (6, "b")])).collect()
    assert sorted(r.doc_id for r in rows) == [5, 5, 6] and len({(r.doc_id, round(r.score, 9)) for r in rows}) == 2


def test_held_out_texts_cost_less_than_their_bytes(spark):
    """On held-out documents deeper contexts give shorter codes."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bits = [op11_trees.score(docs, depth=d).where("held_out").agg(F.avg("bits_per_byte")).first()[0] for d in (1, 4)]
    assert bits[1] < bits[0] < 8 and bits[1] < 3


# ---- 12

def test_transforms_are_exact():
    rng = np.random.default_rng(4)
    for size in (2, 8, 64):
        a, b = (rng.integers(0, 1000, (size, 3)).astype(np.uint64) for _ in range(2))
        got = op12_runs.inverse(op12_runs.transform(a.copy()) * op12_runs.transform(b.copy()) % np.uint64(op12_runs.PRIME))
        for k in range(3):
            assert got[:2 * size - 1, k].tolist() == np.convolve(a[:, k].astype(int), b[:, k].astype(int)).tolist()


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_texts_side_by_side(seed):
    rng = random.Random(seed)
    docs = []
    for _ in range(6):
        v, n = rng.choice([2, 3, 50, 1000]), rng.randint(0, 900)
        w = [rng.randrange(v) for _ in range(n)]
        for _ in range(rng.randint(0, 4) if n > 10 else 0):  # stretches of a period, some just too short
            p, a = rng.randint(1, n // 4), rng.randrange(n)
            base = [rng.randrange(v) for _ in range(p)]
            for i in range(min(n - a, int(p * (3.5 + rng.random() * 4)))):
                w[a + i] = base[i % p]
        docs.append(w)
    off = np.cumsum([0] + [len(d) for d in docs])
    a, z, q = op12_runs.find(np.array(sum(docs, []), np.int64), off)
    assert list(zip(a.tolist(), q.tolist(), z.tolist())) == [(s + off[k], p, e + off[k]) for k, d in enumerate(docs) for s, p, e in brute.runs(d)]


def test_long_periods_and_colliding_hashes(monkeypatch):
    w = list(range(3000)) * 5 + [7] * 400
    a, z, q = op12_runs.find(np.array(w), np.array([0, len(w)]))
    assert list(zip(a.tolist(), z.tolist(), q.tolist())) == [(0, 15000, 3000), (15000, 15400, 1)]
    with monkeypatch.context() as m:  # equal hashes prove nothing
        m.setattr(op12_runs, "Rolling", lambda x: lambda s, e: np.zeros(len(s), np.uint64))
        w = [1, 2, 3, 1, 2, 3, 1, 2, 3, 1, 2, 3, 9, 9, 4, 5, 5, 5, 5, 5, 5]
        a, z, q = op12_runs.find(np.array(w), np.array([0, len(w)]))
        assert sorted(zip(a.tolist(), q.tolist(), z.tolist())) == brute.runs(w)


def test_run_digests_equal_the_plain_version(documents):
    rng = random.Random(11)
    w = vocabulary(rng, 400)
    data = [(i, prose(rng, w, rng.randint(1, 300)) + rng.choice(["", " ha" * rng.randint(3, 9), "\nso it so it so it so it so it"])) for i in range(250)]
    data += ODD + [(7, data[3][1]), (7, data[3][1])]
    got = op12_runs.digest(op12_runs.runs(documents(data, extra=True).repartition(5), rewrite=op12_runs.planted)).collect()
    mine = lambda r: (r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)
    key = lambda x: tuple(str(v) for v in x)
    assert sorted(map(mine, got), key=key) == sorted(((i, *brute.run_digest(i, t)) for i, t in data), key=key)
    assert op12_runs.runs(documents([])).count() == 0
    plain = {r.doc_id: r for r in op12_runs.runs(documents([(1, "a a a a a a b"), (2, None)])).collect()}
    assert plain[1].collapsed == "a b" and [tuple(x) for x in plain[1].runs] == [(0, 6, 1)] and plain[2].collapsed == "" and plain[2].runs == []


def test_run_query_on_whole_tables(spark):
    base = "/root/testdata/sf0.001"
    want = {r.doc_id: brute.run_digest(r.doc_id, r.text) for r in spark.read.parquet(f"{base}/documents.parquet").collect()}
    for r in queries.op12_convolved_runs(spark, base).collect():
        assert tuple(r[1:8]) == want[r.doc_id]


# ---- 13

@pytest.mark.parametrize("least,most,inside", [(3, 5, 100), (10, 5, 70), (4, 4, 100), (4, 3, 100), (4, 2, 100)])
def test_phrases_equal_the_plain_version(spark, documents, least, most, inside):
    rng = random.Random(least)
    v = ["a", "B", "é", "the", "x\x01", "x", "Zz"]
    rows = [(rng.choice(["en", "de", None]), "".join(rng.choice(v) + rng.choice([" ", " ", " ", " \t", ".", ", ", "\n"]) for _ in range(rng.randint(0, 80))))
            for _ in range(60)] + [("en", None), ("fr", ""), ("fr", "x " * 500)]
    df = spark.createDataFrame(rows, "lang string, text string").withColumns({c: F.lit(9) for c in ("word", "n", "block", "g1", "a", "rank")})
    got = sorted(tuple(r) for r in op13_phrases.collocations(df.repartition(5), least=least, most=most, inside=inside, top=40).collect())
    assert got == brute.phrases(rows, least, most, inside, 40)


def _made(monkeypatch):
    """Rows of the steps that send words three and more at a time, step by step, once counted."""
    made, meet = [], op13_phrases.meet

    def counted(blocks_, answers, f, schema):
        out = meet(blocks_, answers, f, schema).localCheckpoint()
        if "g3" in schema:
            made.append(out.count())
        return out

    monkeypatch.setattr(op13_phrases, "meet", counted)
    return made


def test_rare_triples_of_frequent_pairs_are_not_sent(documents, monkeypatch):
    """a0 m c0, a0 m c1, ...: 900 triples that occur once, of 60 pairs that occur 30 times."""
    rows = [(i * 30 + j, f"a{i} m c{j}.") for i in range(30) for j in range(30)] + [(1000 + i, "x y z w. x y z") for i in range(20)]
    made = _made(monkeypatch)
    got = [tuple(r) for r in op13_phrases.collocations(documents(rows).repartition(2), least=20).collect()]
    assert sorted(got) == brute.phrases([("en", t) for _, t in rows], 20)
    assert sum(made) < 200


@pytest.mark.parametrize("slots", [1, 2, 50])
def test_phrases_that_share_slots_are_told_apart(spark, monkeypatch, slots):
    """Whatever falls together in the sketch: counts are those of the phrases."""
    monkeypatch.setattr(op13_phrases, "_slots", lambda occurrences, least: slots)
    rng = random.Random(slots)
    rows = [(rng.choice(["en", "de"]), " ".join(rng.choice(["a", "b", "c", "d."]) for _ in range(rng.randint(0, 60)))) for _ in range(60)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    assert sorted(tuple(r) for r in op13_phrases.collocations(df, least=9, top=None).collect()) == brute.phrases(rows, 9, top=10**6)


def test_phrases_of_an_empty_table(documents):
    assert op13_phrases.collocations(documents([])).count() == 0
    assert op13_phrases.collocations(documents([(1, "few words"), (2, None)])).count() == 0


def test_scores_beyond_64_bits(spark):
    phrases = spark.createDataFrame([("en", 1, 2, 2, 2 * 10**12, 3 * 10**12, 10**12)], "lang string, g1 long, g2 long, size int, first long, last long, a long")
    totals = spark.createDataFrame([("en", 10**14)], "lang string, n long")
    r = op13_phrases.scored(phrases, totals, most=2).first()
    assert r.score == 1000 * 10**12 * 10**14 // (6 * 10**24)


def test_sorted_streams_are_read_in_any_batches(spark):
    """Counts of prefixes and open rows go on from one batch to the next."""
    import pyarrow as pa
    rng = random.Random(6)
    rows = sorted({tuple(rng.randrange(3) if i < n else -1 for i in range(5)) for n in (4, 5) for _ in range(200)})
    n = [rng.randint(1, 9) for _ in rows]
    whole = {}
    for r, c in zip(rows, n):
        for m in (4, 5):
            if r[m - 1] >= 0:
                k = r[:m] + (-1,) * (5 - m)
                whole[k] = whole.get(k, 0) + c
    for size in (1, 3, 1000):
        batches = [pa.RecordBatch.from_arrays([*(pa.array([r[i] for r in rows[lo:lo + size]]) for i in range(5)), pa.array(n[lo:lo + size])],
                                              [*(f"g{i + 1}" for i in range(5)), "n"]) for lo in range(0, len(rows), size)]
        got = {tuple(r[f"g{i + 1}"] for i in range(5)): r["a"] for b in op13_phrases.prefix_counts(batches, 5, 4) for r in b.to_pylist()}
        assert got == {k: a for k, a in whole.items() if a >= 4}


# ---- blocks

def test_packed_arrays_come_back():
    a = np.arange(1000, dtype=np.int32)
    assert blocks.unsqueeze(blocks.squeeze(a), np.int32).tolist() == a.tolist()
    assert blocks.unsqueeze(blocks.squeeze(a[:0]), np.int32).tolist() == []
