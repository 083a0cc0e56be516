"""Quality rules: cross-document line frequency on top of per-document rules.

Only DataFrame functions.  Each text is split into lines; a line's key is the
64-bit hash of its normalised form (lower case, runs of white space as one
space, trimmed).  For each (host, line) the distinct documents are counted;
lines found in more documents of a host than its limit are removed, and a
document that loses more than a share of its words is rejected.

``clean`` returns the texts without the removed lines.

Shuffles: one row per distinct line of a document (key, host, words), and for
``clean`` the texts that may hold a removed line, no others.  The count combines on the map side.  Lines so frequent that one key
could fill a task (over 1/1000 of all line rows: at most 1000 keys, a proven
bound) are joined by broadcast, all others by a shuffle join.

Defined cases: a null text has no words and no lines; a null host is a host
of its own; repeated rows are separate documents; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.common import _marked, skew_join, store

GAP = r"[\x20\x09-\x0D]+"
NO_WORD = r"^[\x20\x09-\x0D]*$"
BLANKS, SYMBOLS = " \t\n\v\f\r", "#*$%&|<>"

#: A line is removed if it stands in more documents of its host than both.
MIN_LINE_DOCS = 20
LINE_SHARE = 0.1
#: A document is rejected if the removed lines hold more than this share of its words.
DEPLETED = 0.5


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def _repeated(words: Column, span: int) -> Column:
    """Hashes of the words, and of the ``span``-word windows of the column ``__h`` that holds them."""
    n = F.size("__h")
    h = F.transform(words, lambda w: F.xxhash64(w))
    # ranges are closed: no window if there are fewer words
    at = F.when(n >= span, F.sequence(F.lit(1), n - (span - 1))).otherwise(F.array().cast("array<int>"))
    grams = F.transform(at, lambda i: F.xxhash64(*[F.element_at(F.col("__h"), i + k) for k in range(span)]))
    return h, grams


def base_rules(docs: DataFrame, text: str = "text", span: int = 5) -> DataFrame:
    """``docs`` without its text, plus the per-document counts and ``base_failed``."""
    t = F.coalesce(F.col(text), F.lit(""))
    keep = [F.col(f"`{c}`") for c in docs.columns if c != text]
    h, grams = _repeated(F.col("__w"), span)
    lines = F.filter(F.split(F.col("__t"), "\n"), lambda x: ~x.rlike(NO_WORD))
    d = docs.select(*keep, t.alias("__t")).select(*keep, "__t", _words(F.col("__t")).alias("__w"), lines.alias("__l"))
    # what is counted leaves the row at once: text, words and lines are not copied from step to step
    counts = {"n_words": F.size("__w"), "word_chars": F.length(F.translate("__t", BLANKS, "")),
              "n_symbols": F.length("__t") - F.length(F.translate("__t", SYMBOLS, "")), "n_dup_lines": F.size("__l") - F.size(F.array_distinct("__l"))}
    d = d.select(*keep, *[c.cast("long").alias(name) for name, c in counts.items()], h.alias("__h"))
    d = d.withColumn("__g", grams).drop("__h").withColumn("__some", F.size(F.array_distinct("__g")) < F.size("__g"))
    # windows that occur again, by position; then the words they cover together
    pairs = F.array_sort(F.arrays_zip(F.col("__g").alias("h"), F.sequence(F.lit(1), F.size("__g")).alias("p")))
    same = F.transform(F.col("__s"), lambda x, i: F.when(
        (F.get(F.col("__s"), i - 1)["h"] == x["h"]) | (F.get(F.col("__s"), i + 1)["h"] == x["h"]), x["p"]))
    starts = F.array_sort(F.array_compact(same))
    some = F.col("__some")
    d = d.withColumn("__s", F.when(some, pairs)).drop("__g").withColumn("__p", starts).drop("__s")
    covered = F.aggregate(
        F.transform(F.col("__p"), lambda p, i: F.least(F.lit(span), F.coalesce(F.get(F.col("__p"), i + 1) - p, F.lit(span)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    d = d.withColumn("n_repeat_words", F.when(some, covered).otherwise(F.lit(0).cast("long")))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return d.withColumn("base_failed", failed).drop("__some", "__p")


def _norm(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), GAP, " "))


def _host_key(host: str) -> Column:
    return F.xxhash64(F.col(host), F.col(host).isNull())


def line_rows(docs: DataFrame, id_col: str, host: str, text: str, *more: Column) -> DataFrame:
    """One row per line of a document: host key, line key, words, and whether
    the document holds a line twice."""
    norm = F.filter(F.transform(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), _norm), lambda x: x != "")
    one = docs.select(F.col(id_col).alias("__id"), _host_key(host).alias("__hk"), norm.alias("__a"), *more)
    one = one.withColumn("__twice", F.size(F.array_distinct("__a")) < F.size("__a"))
    others = [c for c in one.columns if c != "__a"]
    return (one.select(*others, F.explode("__a").alias("__x"))
            .select(*others, F.xxhash64("__x").alias("__key"),
                    (F.length("__x") - F.length(F.replace("__x", F.lit(" "), F.lit(""))) + 1).cast("long").alias("__n")))


def removed(docs: DataFrame, id_col: str = "doc_id", host: str = "source", text: str = "text",
            min_line_docs: int = MIN_LINE_DOCS, line_share: float = LINE_SHARE, *more: Column) -> DataFrame:
    """The rows of ``line_rows`` that stand above their host's limit."""
    rows = store(line_rows(docs, id_col, host, text, *more), "quality-lines")
    hosts = docs.groupBy(_host_key(host).alias("__hk")).agg(F.count("*").alias("__docs"))
    # (line, document) pairs: only documents that hold a line twice have to be made distinct
    pairs = rows.where(~F.col("__twice")).select("__hk", "__key").unionByName(
        rows.where(F.col("__twice")).select("__hk", "__key", "__id").distinct().select("__hk", "__key"))
    found = pairs.groupBy("__hk", "__key").agg(F.count("*").alias("__in")).where(F.col("__in") > min_line_docs)
    frequent = store(found.join(hosts, "__hk")
                     .where(F.col("__in") > F.lit(line_share) * F.col("__docs")).select("__hk", "__key", "__in"), "quality-frequent")
    # at most 1000 keys can each hold over 1/1000 of the pairs
    hot = frequent.where(F.col("__in") * 1000 > rows.agg(F.count("*")).scalar()).select("__hk", "__key")
    rare = frequent.join(F.broadcast(hot), ["__hk", "__key"], "left_anti").select("__hk", "__key")
    by_hot = rows.join(F.broadcast(hot), ["__hk", "__key"], "left_semi")
    by_rare = rows.join(F.broadcast(hot), ["__hk", "__key"], "left_anti").join(rare, ["__hk", "__key"], "left_semi")
    return by_hot.unionByName(by_rare)


def lost(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_removed_lines, removed_words) of the removed lines' documents."""
    return rows.groupBy(F.col("__id").alias(id_col)).agg(F.count("*").alias("n_removed_lines"), F.sum("__n").alias("removed_words"))


def depleted(docs: DataFrame, id_col: str = "doc_id", host: str = "source", text: str = "text",
             min_line_docs: int = MIN_LINE_DOCS, line_share: float = LINE_SHARE) -> DataFrame:
    """(id, n_removed_lines, removed_words) of documents that hold lines above their host's limit."""
    return lost(removed(docs, id_col, host, text, min_line_docs, line_share), id_col)


def _text_key(host: str, text: str) -> list[Column]:
    return [_host_key(host).alias("__hk"), F.xxhash64(text).alias("__ta"), F.xxhash64(F.lit(1), F.col(text)).alias("__tb")]


def clean(docs: DataFrame, id_col: str = "doc_id", host: str = "source", text: str = "text",
          min_line_docs: int = MIN_LINE_DOCS, line_share: float = LINE_SHARE, rows: DataFrame | None = None) -> DataFrame:
    """``docs`` without the lines above their host's limit; the others keep their
    order and form.  ``rows``: the removed lines, if they are known (``removed_of``).

    What goes depends on host and text alone, so rows meet their removed lines by
    these: null and repeated ids are cleaned as well.  Only texts that may hold
    such a line are shuffled.
    """
    rows = removed_of(docs, id_col, host, text, min_line_docs, line_share) if rows is None else rows
    gone = store(rows.groupBy("__hk", "__ta", "__tb").agg(F.collect_set("__key").alias("__gone")), "quality-gone")
    _, ta, tb = _text_key(host, text)
    d = _marked(docs.withColumns({"__hk": _host_key(host), "__ta": ta, "__tb": tb}), gone.select("__ta"), "__ta", 23)
    kept = F.array_join(F.filter(F.split(F.col(text), "\n"), lambda x: ~F.array_contains(F.col("__gone"), F.xxhash64(_norm(x)))), "\n")
    doubt = d.where("__tessera_hit").drop("__tessera_hit")
    size = doubt.groupBy("__hk", "__ta", "__tb").agg(F.count("*").alias("__rows"))
    keys = ["__hk", "__ta", "__tb"]
    cut = skew_join(doubt, size.join(gone.select(*keys, "__gone"), keys, "left"), keys, "__rows")
    cut = cut.withColumn(text, F.when(F.col("__gone").isNull(), F.col(text)).otherwise(kept))
    clear = d.where("not __tessera_hit")
    cols = [F.col(f"`{c}`") for c in docs.columns]
    return clear.select(*cols).unionByName(cut.select(*cols))


def removed_of(docs: DataFrame, id_col: str = "doc_id", host: str = "source", text: str = "text",
               min_line_docs: int = MIN_LINE_DOCS, line_share: float = LINE_SHARE) -> DataFrame:
    """``removed`` with the key of each line's text, written: for ``clean`` and ``quality``."""
    _, ta, tb = _text_key(host, text)
    return store(removed(docs, id_col, host, text, min_line_docs, line_share, ta, tb), "quality-removed")


def quality(docs: DataFrame, id_col: str = "doc_id", host: str = "source", text: str = "text",
            min_line_docs: int = MIN_LINE_DOCS, line_share: float = LINE_SHARE,
            max_removed: float = DEPLETED, rows: DataFrame | None = None) -> DataFrame:
    """Per document: counts, ``base_failed``, the removed lines and words, ``kept``.

    Ids are unique.  Other columns of ``docs`` are left out, so none can clash.
    """
    base = base_rules(docs.select(F.col(id_col), F.col(text)), text)
    gone = depleted(docs, id_col, host, text, min_line_docs, line_share) if rows is None else lost(rows, id_col)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    d = base.join(gone, id_col, "left").select(*base.columns, zero("n_removed_lines"), zero("removed_words"))
    return d.withColumn("kept", ~F.col("base_failed") & (F.col("removed_words") <= max_removed * F.col("n_words")))
