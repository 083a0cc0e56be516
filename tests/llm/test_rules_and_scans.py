"""Operators that judge documents one by one: 1, 6, 8, 10 and the shard files of 4."""

import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from tessera.llm import op1_quality, op4_planes, op6_licenses, op8_pieces, op10_html

from . import brute
from .helpers import prose, vocabulary

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "same text here\nsame text here"), (5, "same text here\nsame text here"),
       (6, "é" * 3000 + " end"), (7, "x " * 40000), (None, "no id at all")]


# ---- 1

def test_quality_counts_and_verdict_against_brute_force(documents):
    rng = random.Random(1)
    w = vocabulary(rng, 60)
    common = "Subscribe to  our NEWSLETTER today"
    data = []
    for i in range(120):
        body = "\n".join(prose(rng, w, rng.randint(1, 12)) for _ in range(rng.randint(1, 5)))
        if i % 3 == 0:
            body += "\n" + (common if i % 2 else common.lower().replace("  ", " "))
        if i % 4 == 0:
            body = common + "\n" + prose(rng, w, 4) + "\nread all the terms and conditions that apply on this page"
        data.append((i, body, "h1" if i % 7 else None))
    data += [(1000, "a b c d e " * 6, "h2"), (1001, None, "h1"), (1002, "", "h1"), (1003, "# * $ x|y <z> " * 3, None)]
    got = {r.doc_id: r for r in op1_quality.quality(documents(data, extra=True)).collect()}
    want = brute.quality(data)
    assert len(got) == len(data)
    for d, t, _ in data:
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.base(t), d
        assert r.kept == want[d], d
    assert 0 < sum(not r.kept and not r.base_failed for r in got.values()) < len(data)


def test_counted_texts_and_words_leave_the_row(documents):
    node = op1_quality.base_rules(documents([(1, "a b"), (2, None)]).select("doc_id", "text"))._jdf.queryExecution().optimizedPlan()
    outputs = []
    while True:
        outputs.append(node.output().mkString(" "))
        if not node.children().size():
            break
        node = node.children().head()
    for name in ("__t#", "__w#", "__l#", "__h#", "__g#", "__s#"):
        assert sum(name in x for x in outputs) <= 2, name


def test_quality_odd_rows_and_empty_table(documents):
    got = op1_quality.quality(documents(ODD)).collect()
    assert len(got) == len(ODD) and sum(r.doc_id == 5 for r in got) == 2
    assert op1_quality.quality(documents([])).count() == 0


def test_removed_lines_leave_the_texts(spark, documents):
    import corpus_pipeline
    common = "Read  our NEWSLETTER each day"
    body = lambda i: f"first {i} of its own kind stands here alone\n\n  second {i} line has more words than that one"
    full = lambda i: f"{common}\n{body(i)}\n read our newsletter each DAY \nlast line {i}\nlast line {i}"
    data = [(i, full(i), "h") for i in range(50)] + [(None, full(90), "h"), (7, full(91), "h")]
    data += [(100, full(100), "other"), (101, None, "h"), (102, "", "h"), (103, body(103) + "\n", None)]
    want = [(i, t if h != "h" or not t else f"{body(t.split()[6])}\nlast line {t.split()[6]}\nlast line {t.split()[6]}") for i, t, h in data]
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    df = documents(data)
    got = op1_quality.clean(df)
    assert got.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=key) == sorted(want, key=key)
    kept = corpus_pipeline.keep_quality(spark, df, "").collect()
    assert len(kept) >= 50 and all("newsletter" not in r.text.lower() for r in kept if r.source == "h")
    assert all(r.n_chars == len(r.text) for r in kept if r.text is not None)
    assert op1_quality.clean(documents([])).count() == 0


def test_hot_line_is_found_on_both_join_paths(documents):
    data = [(i, f"common line number one\nunique {i} words stand right here for you all", "h") for i in range(60)]
    got = op1_quality.quality(documents(data)).collect()
    assert all(r.n_removed_lines == 1 and r.removed_words == 4 for r in got)


# ---- 4

def test_pieces_equal_the_tokenizer_on_any_text():
    p = op4_planes.Pieces(BPE)
    rng = random.Random(3)
    parts = ["a", "the", " ", "  ", "\n", "\t", "é", "ß", "12", "'s", "'", "!", "..", "\x85", "\xa0", "　", "\x1c", "<|endoftext|>", "|", "日本", "\r", "’"]
    for _ in range(150):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 20))) for _ in range(4)]
        raw = [t.encode() for t in texts]
        off = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
        ids, n = p.encode(np.frombuffer(b"".join(raw), np.uint8), off, 2)
        for t, got in zip(texts, np.split(ids, np.cumsum(n)[:-1])):
            assert got.tolist() == [*p.tokenizer.encode(t, add_special_tokens=False).ids, 2], repr(t)


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_shard_file_round_trip(kind):
    rng = np.random.default_rng(0)
    f = io.BytesIO()
    w = op4_planes.Writer(f, block=100, kind=kind)
    docs = [rng.integers(0, 50257, n).astype(np.uint32) for n in (0, 1, 99, 100, 101, 350, 7)]
    for i in range(0, len(docs), 2):
        part = docs[i:i + 2]
        w.add(np.arange(i, i + len(part)), np.array([len(x) for x in part]), np.concatenate(part))
    w.close()
    r = op4_planes.Reader(io.BytesIO(f.getvalue()), len(f.getvalue()), kind)
    got = list(r.documents())
    assert [d for d, _ in got] == list(range(len(docs)))
    assert all(np.array_equal(a, b) for (_, a), b in zip(got, docs))
    every = np.concatenate(docs)
    assert np.array_equal(r.chunk(2), every[200:300])  # random access through the index
    with pytest.raises(ValueError):
        op4_planes.Reader(io.BytesIO(b"x" * 64), 64, kind)


def test_encode_and_read_against_the_library(documents):
    data = [r for r in ODD if r[0] != 5] + [(5, "same text here")]
    got = {r.doc_id: r for r in op4_planes.encode_and_read(documents(data, extra=True), BPE).collect()}
    tok = op4_planes.Pieces(BPE).tokenizer
    at = 0
    for d, t in sorted(data, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        r = got[d]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert op4_planes.encode_and_read(documents([]), BPE).count() == 0


# ---- 6

def scan(text):
    raw = (text or "").encode()
    return next(op6_licenses.scan_step(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])))


@pytest.mark.parametrize("text, base, labels", [
    ("Released under the MIT License.", "mit", "mit"),
    ("SPDX-License-Identifier: Apache-2.0", "", "apache-2.0"),
    ("licensed under the GNU General Public License, version 3.", "gpl", "gpl,gpl-3.0"),
    ("CC BY-SA 4.0", "cc-by", "cc-by,cc-by-sa"),
    ("the GNU Lesser General Public License", "", "lgpl"),
    ("gnu-general//public LICENSE", "gpl", "gpl"),
    ("gnu general public licenses", "", ""), ("admit license", "", ""), ("", "", ""), (None, "", "")])
def test_license_labels(text, base, labels):
    r = scan(text)
    assert (r["base_labels"], r["labels"]) == (base, labels) and 0 <= r["score"] <= 1


def test_license_containment_and_priority():
    t = "the gnu lesser general public license version 2.1 and gnu general public license"
    assert [r.label for _, _, r in op6_licenses.detect(t)] == ["lgpl-2.1", "gpl"]
    assert len(op6_licenses.rules()) > 300
    for r in op6_licenses.rules():
        assert 0 < r.score <= 1


def test_license_words_and_places(documents):
    data = [(1, "Use MIT license; mit\nLICENSE é9 x"), (2, None), (3, "CC-BY CC_BY ccby"), (4, "GNU " * 5)] + [(5, "apache license")] * 2
    got = op6_licenses.scan(documents(data, extra=True)).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 6 and sum(r.doc_id == 5 for r in got) == 2
    assert (by[1].n_words, by[1].n_base, by[1].first_word, by[1].last_word) == (7, 2, 1, 3)
    assert (by[3].n_words, by[3].n_base, by[3].first_word, by[3].last_word) == (5, 2, 0, 2)
    assert (by[2].n_words, by[2].n_base, by[2].first_word, by[2].labels) == (0, 0, None, "")
    assert op6_licenses.scan(documents([])).count() == 0


# ---- 8

def all_scores(voc, text):
    edges = voc.edges(("▁" + text).replace(" ", "▁") if text else "")
    out = []

    def walk(j, score):
        if j == 0:
            out.append(score)
        else:
            for i, _, x in edges[j]:
                walk(i, score + x)
    walk(len(edges) - 1, 0.0)
    return sorted(out, reverse=True)


def test_n_best_against_all_segmentations():
    voc = op8_pieces.vocabulary(PIECES)
    rng = random.Random(2)
    for _ in range(60):
        texts = ["".join(rng.choice("abethn ino.,é日\n▁'1") for _ in range(rng.randint(0, 9))) for _ in range(3)]
        raw = [t.encode() for t in texts]
        off = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
        got = list(op8_pieces.encode_step(voc, np.frombuffer(b"".join(raw), np.uint8), off, 4))
        for t, (ids, best, tops, ok) in zip(texts, got):
            want = all_scores(voc, t)
            assert tops == want[:4] and best == want[0]
            assert ok == ("▁" not in t) and (not ok or voc.decode(ids.tolist()) == t)


def test_long_segments_and_odd_rows(documents):
    voc = op8_pieces.vocabulary(PIECES)
    text = "a" * 300 + " " + "日" * 40 + " the end"
    raw = text.encode()
    (ids, best, tops, ok), = op8_pieces.encode_step(voc, np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), 3)
    whole = voc.n_best(("▁" + text).replace(" ", "▁"), 3)
    assert ok and tops == [x for x, _ in whole] and voc.decode(ids.tolist()) == text
    got = op8_pieces.digest(documents(ODD, extra=True), PIECES).collect()
    assert len(got) == len(ODD)
    empty = [r for r in got if r.doc_id in (1, 2)]
    assert all(r.n_pieces == 0 and r.scores == [0.0] and r.round_trip for r in empty)
    assert op8_pieces.digest(documents([]), PIECES).count() == 0
    back = {r.doc_id: r.decoded for r in op8_pieces.encode(documents(ODD), PIECES).collect()}
    assert all(back[d] == (t or "") for d, t in ODD if d != 7) and back[7] == "x " * 40000


# ---- 10

PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1><nav><a href=/>Home</a></nav></header>
<div class="cookie-notice">We use cookies, accept.</div><div id="content"><h2>Big story</h2><p>First paragraph, with
<a href=x>link</a>words; and more text here.</p><p>Short.</p><div class="ad">Buy now!</div><blockquote>Quote, indeed.</blockquote>
<ul><li>One item, yes.<li>Two items, no.</ul><!-- note --><p>Last one &amp; so on &#169;, fine.</p><form><label>Search</label></form></div>
<div class="comments"><p>Nice article, thanks a lot for this. I really liked it, very much.</p></div><aside>Other</aside>
<footer><p>(c) 2024, all rights.</p></footer><script>var t="</p>";</script></body></html>"""


def test_main_text_of_a_page():
    assert op10_html.main_text(PAGE) == ("Big story First paragraph, with linkwords; and more text here. Short. Quote, indeed. "
                                         "One item, yes. Two items, no. Last one & so on ©, fine.")


@pytest.mark.parametrize("page, text", [(None, ""), ("", ""), ("plain words", "plain words"), ("<p>a<p>b", "a b"), ("<b>x</b>y<br>z", "xy z"),
                                        ("<nav>menu</nav>", ""), ("<p>unclosed <b>bold", "unclosed bold"), ("<!-- only", ""), ("a < b", "a < b"),
                                        ("<script>never ends", ""), ("<article><h1>Head</h1><p>Text, here.</p></article><p>x", "Head Text, here.")])
def test_main_text_of_odd_pages(page, text):
    assert op10_html.main_text(page) == text


def test_extract_keeps_rows(spark):
    df = spark.createDataFrame([(1, "u", PAGE, "x"), (2, None, None, "x"), (1, "u", PAGE, "x"), (None, "v", "<p>t</p>" * 3000, "x")],
                               "page_id long, url string, html string, text string")
    got = op10_html.extract(df).collect()
    assert len(got) == 4 and got[0].text == got[2].text and got[1].text == "" and got[1].n_chars == 0
    assert got[3].n_chars == 5999
    assert op10_html.extract(df.limit(0)).count() == 0
