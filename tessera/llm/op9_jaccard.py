"""N-gram Jaccard join with token-combination prefixes.

A document's tokens are the 64-bit hashes of its distinct word 5-grams.  In a
common order (rare tokens by hash, then hot tokens by rising frequency), a
document with n tokens can miss at most e = floor((1 - t) n) of them in any
partner, so partners share a signature drawn from its prefix:

* rare tokens are signatures of their own;
* hot tokens (the at most ``HOT`` most frequent ones, found by counting all
  tokens) are cut into classes, and signatures are pairs of hot tokens of one
  class; the prefix is extended until the rare tokens, plus in each class all
  hot tokens but one, exceed e.  Then e misses cannot spoil every signature.

Classes follow the document's size (sizes of partners differ by 1/t at most;
a document writes its pairs for its own and the next size step).

Texts with equal token sets are one node.  Signatures meet in buckets; small
groups give their size-compatible pairs, large ones only links to their first
and next member.  Pairs pass a parity sketch (never drops a true pair), then
the exact test on both whole texts.  A large group whose members are still in
different components is then compared through the sketches alone, across
components, in tiles; what passes is tested exactly as well.  So every link
between components is found, and no group emits all its pairs.

Returned per document: tokens, links found, and the component's smallest id.

Defined cases: no text or no words: no tokens, linked with nothing; a null id
is linked with nothing; a repeated row is one document, returned per row; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm.blocks import lean
from tessera.llm.common import LOWER, Rolling, column, connected, mix, pack_rows, skew_join, steps, store, width, within, words

SIZE, PERCENT = 5, 80
#: Most hot tokens (a broadcast of at most 16 MB), and the least documents of one.
HOT, HOT_DOCS = 1 << 20, 50
#: Text bytes within which tokens are counted before counts are sent on.
COUNTED = 4 << 20
#: Text bytes that are cut into tokens at once (a longer text is cut alone).
PIECE = 1 << 19
#: Groups up to this size give their pairs themselves.
SMALL = 16
#: Rows of groups whose pairs are formed at once.
CHUNK = 1 << 14
#: Members of a large group that one comparison tile holds, per side.
TILE = 1024
_STEP = 1.26  # sizes of partners (at most 1.25 : 1) are in the same or neighbouring steps


def token_sets(data: np.ndarray, off: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """(row, token) of the distinct word n-grams of each text, sorted.

    Cutting takes some forty bytes for each byte of text; it goes by pieces of
    whole texts, so that only the tokens grow with what is handed in."""
    rows, grams, lo = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], 0
    while lo < len(off) - 1:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + PIECE, "right")) - 1)
        r, g = _piece_sets(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], size)
        rows.append(r + lo)
        grams.append(g)
        lo = hi
    return np.concatenate(rows), np.concatenate(grams)


def _piece_sets(data: np.ndarray, off: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    low = LOWER[data]
    start, end, row = words(low, off)
    if not len(start):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h = Rolling(low)(start, end)
    n = np.bincount(row, minlength=len(off) - 1)
    grams, rows = [], []
    if len(h) >= size:
        g = np.full(len(h) - size + 1, size, np.uint64)
        for k in range(size):
            g = mix(g + h[k:len(h) - size + 1 + k])
        one = row[:len(g)] == row[size - 1:]
        grams.append(g[one])
        rows.append(row[:len(g)][one])
    at = np.cumsum(n) - n
    for r in np.flatnonzero((n > 0) & (n < size)).tolist():
        g = np.full(1, n[r], np.uint64)
        for k in range(n[r]):
            g = mix(g + h[at[r] + k:at[r] + k + 1])
        grams.append(g)
        rows.append(np.array([r]))
    g, r = np.concatenate(grams), np.concatenate(rows)
    o = np.lexsort((g, r))
    g, r = g[o], r[o]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (r[1:] != r[:-1])
    return r[new], g[new]


def sketch(tokens: np.ndarray) -> bytes:
    """Parity of the tokens in each of 2**k cells: two sketches differ in at
    most as many cells as the sets have unshared tokens."""
    cells = 64
    while cells < 2 * len(tokens):
        cells *= 2
    return np.packbits((np.bincount((tokens & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1).astype(np.uint8)).tobytes()


def _fold(s: np.ndarray, size: int) -> np.ndarray:
    while s.shape[-1] > size:
        s = s[..., :s.shape[-1] // 2] ^ s[..., s.shape[-1] // 2:]
    return s


def may_link(n: np.ndarray, m: np.ndarray, a: list[bytes], b: list[bytes], percent: int = PERCENT) -> np.ndarray:
    """Which pairs' sketches allow a link: unshared tokens <= (n + m)(100 - t) / (100 + t)."""
    out = np.zeros(len(a), bool)
    for i, (x, y) in enumerate(zip(a, b)):
        size = min(len(x), len(y))
        d = np.bitwise_count(_fold(np.frombuffer(x, np.uint8), size) ^ _fold(np.frombuffer(y, np.uint8), size)).sum()
        out[i] = int(d) * (100 + percent) <= int(n[i] + m[i]) * (100 - percent)
    return out


def _pairs_of_classes(tokens: np.ndarray, label: int, need: int) -> np.ndarray:
    """Signatures from hot tokens (in order): pairs within a class, over the
    shortest prefix in which all but one of each class make up ``need``."""
    classes = max(1, int(_STEP ** label / 8))
    kind = (mix(tokens) >> np.uint64(11)) % np.uint64(classes)
    first = np.zeros(len(tokens), bool)
    first[np.unique(kind, return_index=True)[1]] = True
    p = int(np.searchsorted(np.cumsum(~first), need)) + 1
    t, kind = tokens[:p], kind[:p]
    o = np.lexsort((t, kind))
    t, kind, out, d = t[o], kind[o], [], 1
    while d < len(t) and (same := kind[d:] == kind[:-d]).any():
        out.append(mix(mix(t[:-d][same] + np.uint64(label + 1)) + t[d:][same]))
        d += 1
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def signatures(tokens: np.ndarray, hot: np.ndarray, rank: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Signatures of one document's (distinct, sorted) tokens."""
    n = len(tokens)
    if n < 2:  # a partner would have to be equal
        return np.empty(0, np.uint64)
    need = n * (100 - percent) // 100 + 1
    at = np.minimum(np.searchsorted(hot, tokens), max(0, len(hot) - 1))
    is_hot = hot[at] == tokens if len(hot) else np.zeros(n, bool)
    rare = tokens[~is_hot]
    if len(rare) >= need:
        return rare[:need]
    often = tokens[is_hot][np.argsort(rank[at[is_hot]], kind="stable")]
    label = int(np.log(n) / np.log(_STEP))
    return np.unique(np.concatenate([rare, *(_pairs_of_classes(often, x, need - len(rare)) for x in (label, label + 1))]))


def _bounds(rows: np.ndarray, n: int) -> np.ndarray:
    return np.searchsorted(rows, np.arange(n + 1))


_FEATURES = "kind int, id long, n long, sig_a long, sig_b long, sketch binary, token long, docs long"


def features(docs: DataFrame) -> DataFrame:
    """kind 0: a document's size, set digest and sketch.  kind 1: tokens that
    several documents of one step hold, with their number there."""
    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for b, data, off in steps(batches, budget=COUNTED):
            row, tok = token_sets(data, off)
            at = _bounds(row, b.num_rows)
            n = np.diff(at)
            sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(tok), dtype=np.uint64)])
            more = np.concatenate([[np.uint64(0)], np.cumsum(mix(mix(tok) + np.uint64(7)), dtype=np.uint64)])
            t, c = np.unique(tok, return_counts=True)
            t, c = t[c >= 3], c[c >= 3]
            k, m = b.num_rows, len(t)
            none = lambda x: pa.nulls(x, pa.int64())
            yield pack_rows(kind=pa.array(np.zeros(k, np.int32)), id=b.column(0), n=n.astype(np.int64),
                            sig_a=(sums[at[1:]] - sums[at[:-1]]).view(np.int64), sig_b=(more[at[1:]] - more[at[:-1]]).view(np.int64),
                            sketch=pa.array([sketch(tok[i:j]) for i, j in zip(at[:-1], at[1:])], pa.binary()), token=none(k), docs=none(k))
            yield pack_rows(kind=pa.array(np.ones(m, np.int32)), id=none(m), n=none(m), sig_a=none(m), sig_b=none(m),
                            sketch=pa.nulls(m, pa.binary()), token=t.view(np.int64), docs=c.astype(np.int64))

    return docs.mapInArrow(task, _FEATURES)


def groups(docs: DataFrame, hot: np.ndarray, rank: np.ndarray, percent: int) -> DataFrame:
    """Of the groups of two or more documents that share a signature: candidate
    pairs (a, b), and the members (a, null, key, size of the group) of the large ones.
    Pairs are formed where a bucket's groups are whole."""
    spark = docs.sparkSession
    buckets = width(spark)
    shared = spark.sparkContext.broadcast((hot, rank))

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        hot, rank = shared.value
        for b, data, off in steps(batches):
            row, tok = token_sets(data, off)
            at, ids = _bounds(row, b.num_rows), column(b, "id")
            seen: set[bytes] = set()
            keys, who = [], []
            for r in np.argsort(ids, kind="stable").tolist():
                mine = tok[at[r]:at[r + 1]]
                if (raw := mine.tobytes()) in seen:  # an equal set in this step: its first id stands for it
                    continue
                seen.add(raw)
                s = signatures(mine, hot, rank, percent)
                keys.append(s)
                who.append(np.full(len(s), r, np.int64))
            if not keys:
                continue
            keys, who = np.concatenate(keys), np.concatenate(who)
            bucket = ((mix(keys) >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
            o = np.lexsort((who, bucket))
            keys, who, bucket = keys[o], who[o], bucket[o]
            cut = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
            n = np.diff(at)
            some = np.flatnonzero(np.diff(cut))
            yield pack_rows(bucket=some.astype(np.int32),
                            keys=pa.array([keys[cut[i]:cut[i + 1]].tobytes() for i in some], pa.binary()),
                            ids=pa.array([ids[who[cut[i]:cut[i + 1]]].astype(np.int64).tobytes() for i in some], pa.binary()),
                            ns=pa.array([n[who[cut[i]:cut[i + 1]]].astype(np.int32).tobytes() for i in some], pa.binary()))

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        held = [(r["keys"], r["ids"], r["ns"]) for b in batches for r in b.to_pylist()]
        if not held:
            return
        key, ids, n = (np.frombuffer(b"".join(x), t) for x, t in zip(zip(*held), (np.uint64, np.int64, np.int32)))
        del held
        o = np.lexsort((ids, key))
        key, ids, n = key[o], ids[o], n[o]
        first = np.ones(len(key), bool)
        first[1:] = key[1:] != key[:-1]
        start = np.flatnonzero(first)
        size = np.diff(np.append(start, len(key)))
        many = np.repeat(size, size)
        lead = np.repeat(ids[start], size)
        keep = many > 1
        key, ids, n, many, lead = key[keep], ids[keep], n[keep], many[keep], lead[keep]
        big, new = many > SMALL, np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        none = lambda x: pa.nulls(x, pa.int64())
        lo = 0
        while lo < len(key):  # slices of whole groups (a longer group is a slice of its own)
            at = int(np.searchsorted(new, lo + CHUNK, "right")) - 1
            hi = len(key) if lo + CHUNK >= len(key) else int(new[at]) if new[at] > lo else int(new[at + 1]) if at + 1 < len(new) else len(key)
            s = slice(lo, hi)
            p = _near(key[s], ids[s], n[s].astype(np.int64), many[s], lead[s], percent)
            yield pack_rows(a=p[:, 0], b=p[:, 1], key=none(len(p)), size=none(len(p)))
            for i in range(lo, hi, CHUNK):
                t = slice(i, min(hi, i + CHUNK))
                k = int(big[t].sum())
                yield pack_rows(a=ids[t][big[t]], b=none(k), key=key[t][big[t]].view(np.int64), size=many[t][big[t]].astype(np.int64))
            lo = hi

    sent = docs.mapInArrow(send, "bucket int, keys binary, ids binary, ns binary").repartition(buckets, "bucket")
    return sent.mapInArrow(meet, "a long, b long, key long, size long")


def _near(key: np.ndarray, ids: np.ndarray, n: np.ndarray, size: np.ndarray, first: np.ndarray, percent: int) -> np.ndarray:
    """Candidate pairs (a, b), a < b, of whole groups, in (key, id) order: in groups of up to SMALL
    members those of compatible size, in larger ones links to the first and the next id."""
    big = size > SMALL
    out = [np.stack([first, ids], 1)[big & (first != ids)]]
    for d in range(1, min(SMALL, len(key))):
        i = np.flatnonzero((key[d:] == key[:-d]) & ((d == 1) | (size[d:] <= SMALL)))
        lo, hi = np.minimum(n[i], n[i + d]), np.maximum(n[i], n[i + d])
        i = i[lo * 100 >= hi * percent]
        out.append(np.stack([ids[i], ids[i + d]], 1))
    return np.unique(np.concatenate(out), axis=0)


def _filtered(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs of node ids as pairs of representatives that size and sketch allow."""
    def side(x: str) -> DataFrame:
        return nodes.select(F.col("id").alias(x), F.col("rep").alias(f"r_{x}"), F.col("n").alias(f"n_{x}"))

    p = pairs.join(side("a"), "a").join(side("b"), "b").where("r_a <> r_b")
    p = p.where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    p = p.select(F.least("r_a", "r_b").alias("a"), F.greatest("r_a", "r_b").alias("b")).distinct()
    s = nodes.where("id = rep")
    p = (p.join(s.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a")), "a")
         .join(s.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b")), "b"))

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for b in batches:
            ok = may_link(column(b, "n_a"), column(b, "n_b"), b["s_a"].to_pylist(), b["s_b"].to_pylist(), percent)
            yield b.select(["a", "b"]).filter(pa.array(ok))

    return p.select("a", "b", "n_a", "n_b", "s_a", "s_b").mapInArrow(task, "a long, b long")


def verify(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole texts link."""
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    texts = within(docs.where("id is not null"), ids, "id")
    both = (pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
            .join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a"))

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for whole in batches:
            for b, data, off in steps([whole], "text_a"):
                ra, ta = token_sets(data, off)
                parts = [token_sets(d, o) for _, d, o in steps([b], "text_b", 1 << 62)]
                rb, tb = parts[0]
                r, t = np.concatenate([ra, rb]), np.concatenate([ta, tb])
                o = np.lexsort((t, r))
                r, t = r[o], t[o]
                both_ = np.bincount(r[1:][(r[1:] == r[:-1]) & (t[1:] == t[:-1])], minlength=b.num_rows)
                any_ = np.bincount(r, minlength=b.num_rows) - both_
                ok = (100 * both_ >= percent * any_) & (any_ > 0)
                yield b.select(["a", "b"]).filter(pa.array(ok))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(task, "a long, b long").distinct()


def _across(g: DataFrame, nodes: DataFrame, component: DataFrame, percent: int) -> DataFrame:
    """Pairs in different components that size and sketch allow, from large
    groups that still hold more than one component."""
    at = nodes.select("id", "rep", "n", "sketch")
    big = g.where("b is null").select("key", F.col("a").alias("id"), "size")
    # representatives of each key; a key with one component left is done
    with_rep = (big.join(at.select("id", "rep"), "id").join(component, F.col("rep") == component["member"], "left")
                .select("key", "rep", "size", F.coalesce("component", "rep").alias("c")))
    with_rep = store(with_rep.distinct(), "jaccard-open")
    open_ = with_rep.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("m")).where("lo <> hi")
    rows = skew_join(with_rep, open_.select("key", "m"), ["key"], "m")
    # tiles: members of a key are dealt into cells, each pair of cells is one tile
    cells = F.ceil(F.col("m") / TILE).cast("int")
    rows = (rows.withColumn("cell", F.pmod(F.xxhash64("rep"), cells).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), cells - 1)))
            .select("key", F.least("cell", "other").alias("i"), F.greatest("cell", "other").alias("j"), "cell", "rep", "c"))
    rows = rows.join(at.where("id = rep").select("rep", "n", "sketch"), "rep")

    def tile(t: pa.Table) -> pa.Table:
        lean()
        rep, c, n = (t[x].to_numpy() for x in ("rep", "c", "n"))
        sk = t["sketch"].to_pylist()
        out = []
        o = np.argsort(n, kind="stable")
        rep, c, n, sk = rep[o], c[o], n[o], [sk[i] for i in o]
        for i in range(len(rep)):
            hi = int(np.searchsorted(n * percent, n[i] * 100, "right"))
            js = np.arange(i + 1, hi)
            js = js[(c[js] != c[i]) & (rep[js] != rep[i])]
            if not len(js):
                continue
            mine = np.frombuffer(sk[i], np.uint8)
            other = np.stack([_fold(np.frombuffer(sk[j], np.uint8), len(mine)) for j in js])
            d = np.bitwise_count(other ^ mine).sum(1, dtype=np.int64)
            js = js[d * (100 + percent) <= (n[js] + n[i]) * (100 - percent)]
            out.append(np.stack([np.minimum(rep[i], rep[js]), np.maximum(rep[i], rep[js])], 1))
        p = np.concatenate(out) if out else np.empty((0, 2), np.int64)
        return pa.table({"a": p[:, 0], "b": p[:, 1]})

    return rows.groupBy("key", "i", "j").applyInArrow(tile, "a long, b long").distinct()


def components(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """Per document: id, n_shingles, component_id, n_links (links of its token
    set that were found and tested), is_copy (an earlier document has the same set)."""
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    f = store(features(d), "jaccard-features")
    table = f.where("kind = 0").select("id", "n", "sig_a", "sig_b", "sketch")
    counts = f.where("kind = 1").groupBy("token").agg(F.sum("docs").alias("docs"))
    total = table.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = (counts.where(F.col("docs") > max(HOT_DOCS, total >> 20)).orderBy(F.desc("docs"), "token").limit(HOT)
           .toPandas().sort_values(["docs", "token"]))
    tokens = hot["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    known = table.where("id is not null and n > 0")
    first = known.groupBy("sig_a", "sig_b", "n").agg(F.min("id").alias("rep"), F.count("*").alias("rows"))
    nodes = store(skew_join(known, first, ["sig_a", "sig_b", "n"], "rows").select("id", "rep", "n", "sketch").dropDuplicates(["id"]), "jaccard-nodes")
    g = store(groups(d.where("id is not null"), tokens[order], np.arange(len(tokens))[order], percent), "jaccard-groups")
    links = store(verify(store(_filtered(g.where("b is not null").select("a", "b").distinct(), nodes, percent), "jaccard-pairs"), d, percent), "jaccard-links")
    comp = store(connected(links), "jaccard-components").select(F.col("id").alias("member"), "component")
    more = store(_across(g, nodes, comp, percent), "jaccard-pairs").join(links, ["a", "b"], "left_anti")
    if not more.isEmpty():
        links = links.unionByName(store(verify(store(more, "jaccard-pairs"), d, percent), "jaccard-links"))
        comp = store(connected(links), "jaccard-components").select(F.col("id").alias("member"), "component")
    per = (links.select(F.col("a").alias("rep")).unionByName(links.select(F.col("b").alias("rep")))
           .groupBy("rep").agg(F.count("*").alias("n_links")))
    reps = (nodes.where("id = rep").select("rep").join(comp, F.col("rep") == F.col("member"), "left")
            .select("rep", F.coalesce("component", "rep").alias("component")).join(per, "rep", "left"))
    size = nodes.groupBy("rep").agg(F.count("*").alias("rows"))
    placed = skew_join(nodes.select("id", "rep"), reps.join(size, "rep"), ["rep"], "rows").select(
        F.col("id").alias("__id"), "component", "n_links", (F.col("id") != F.col("rep")).alias("is_copy"))
    return (table.select("id", "n").join(placed, F.col("id") == F.col("__id"), "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"),
                    F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("is_copy", F.lit(False)).alias("is_copy")))
