"""Main text of web pages by tag-path ratios.

A page is cut into text blocks, each with its root-to-leaf tag path.  Per path
the text length, the punctuation, the words inside links and the number of
nodes are summed; the ratios length / nodes and punctuation / nodes are
smoothed over the blocks in page order with a Gaussian window and fused by
multiplication, links counting against a path.  Blocks whose path reaches a
share of the page's spread are content.  The main text is what stands in the
smallest element that holds nearly all content, without the elements that are
never article text (menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles, reader comments).

Pages are independent: no shuffle, and a task holds one page at a time.

Defined cases: a null or empty page, or one without content, has an empty
text; markup that is never closed ends with its parent or the page; a page
that is plain text is one block; repeated rows are extracted each.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Fixed values of the HTML standard: elements without content, elements whose
# content is not markup, elements that break a line of text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol
optgroup option p pre search section select summary table tbody td template tfoot th thead title tr ul br""".split())
#: Start tags that end an open element (up to the element's own container).
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr"}), "th": ({"td", "th"}, {"tr"}),
        "option": ({"option"}, {"select"}), "tbody": ({"tbody", "thead", "tfoot"}, {"table"})}
#: Elements that never hold article text.
NEVER = frozenset("""head title script style template noscript nav menu footer aside form button select option textarea
input iframe svg canvas audio video object dialog search""".split())
#: Words in class, id or role that mark such elements (fixed values).
MARKS = frozenset("""ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies
consent notice notices gdpr popup modal newsletter subscribe subscription signup login nav navbar navigation menu breadcrumb
breadcrumbs sidebar aside widget related recommended recommendations share sharing social footer comment comments disqus
respond reply replies pagination pager skip toolbar masthead copyright complementary contentinfo search alert alertdialog""".split())
HEADS = frozenset({"header", "hgroup"})
#: Elements that can hold an article.
HOLDERS = frozenset("html body main article section div td center".split())
PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？、¿¡]")
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_MARK = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
SMOOTH = 1.0
#: Paths at or above this many standard deviations over zero count as content.
SPREAD = 0.5
#: Share of the content's text that an article element has to hold to be chosen;
#: any other element has to hold all of it.
HOLDS = 0.9


class Block(NamedTuple):
    path: str            # tags from the root
    nodes: tuple         # (number, tag) of the elements it stands in that can hold an article
    text: str            # one line, blanks folded
    links: int           # characters inside links
    dropped: bool        # inside an element that never holds article text


def _marked(tag: str, attributes: str) -> bool:
    if tag in NEVER:
        return True
    if tag in ("html", "body", "article", "main") or not attributes:
        return False
    if _HIDDEN.search(attributes):
        return True
    return any(w in MARKS for m in _MARK.finditer(attributes) for w in re.split(r"[^a-z0-9]+", (m[1] or m[2] or m[3] or "").lower()))


def blocks(page: str) -> list[Block]:
    """The page's text blocks in order."""
    out: list[Block] = []
    stack: list[tuple[str, int, bool]] = []
    text: list[str] = []
    links = count = at = 0

    def flush() -> None:
        nonlocal links
        line = " ".join("".join(text).split())
        if line:
            out.append(Block("/".join(t for t, _, _ in stack if t in BLOCK), tuple((n, t) for t, n, _ in stack if t in HOLDERS), line,
                             min(links, len(line)), any(d for _, _, d in stack)))
        text.clear()
        links = 0

    def close(k: int) -> None:
        if any(t in BLOCK for t, _, _ in stack[k:]):
            flush()
        del stack[k:]

    def said(raw: str) -> None:
        nonlocal links
        if raw:
            s = entities.unescape(raw)
            text.append(s)
            if any(t == "a" for t, _, _ in stack):
                links += len(s.strip())

    while at < len(page):
        m = _TAG.search(page, at)
        said(page[at:m.start()] if m else page[at:])
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            k = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if k is not None:
                close(k)
            elif tag in BLOCK:
                flush()
            continue
        if tag in BLOCK:
            flush()
            if tag != "br":  # a new block ends an open paragraph
                k = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in BLOCK), None)
                if k is not None and stack[k][0] == "p":
                    close(k)
            what, holder = ENDS.get(tag, ((), ()))
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in holder:
                    break
                if stack[i][0] in what:
                    close(i)
                    break
        if tag in VOID:
            continue
        if tag in RAW:  # no markup inside; its text is never article text
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
            at = end.start() if end else len(page)
            if end:
                at = page.find(">", at) + 1 or len(page)
            continue
        count += 1
        inside = any(t in ("article", "main") for t, _, _ in stack)
        stack.append((tag, count, _marked(tag, m[3]) or (tag in HEADS and not inside)))
    flush()
    return out


def ratios(found: list[Block]) -> np.ndarray:
    """Fused, smoothed tag-path ratio of every block."""
    sums: dict[str, np.ndarray] = {}
    for b in found:
        sums[b.path] = sums.get(b.path, 0) + np.array([len(b.text), len(PUNCTUATION.findall(b.text)), b.links, 1.0])
    per = np.array([sums[b.path] for b in found])
    plain = 1 - per[:, 2] / per[:, 0]
    a, b = per[:, 0] / per[:, 3] * plain, (1 + per[:, 1]) / per[:, 3] * plain
    x = np.arange(-2, 3)
    w = np.exp(-(x / SMOOTH) ** 2 / 2)
    w /= w.sum()
    smooth = lambda v: np.convolve(np.pad(v, 2, mode="edge"), w, "valid")
    return smooth(a) * smooth(b)


def main_text(page: str | None) -> str:
    found = [b for b in blocks(page or "")]
    usable = [b for b in found if not b.dropped]
    if not usable:
        return ""
    score = ratios(found)
    by_path: dict[str, list[float]] = {}
    for b, s in zip(found, score):
        if not b.dropped:
            by_path.setdefault(b.path, []).append(s)
    least = SPREAD * float(np.std(score))
    paths = {p for p, s in by_path.items() if float(np.mean(s)) >= least}
    content = [b for b in usable if b.path in paths] or usable
    # the smallest element that holds the content
    weight: dict[tuple[int, str], int] = {}
    for b in content:
        for n in b.nodes:
            weight[n] = weight.get(n, 0) + len(b.text)
    total = sum(len(b.text) for b in content)
    holders = [n for n, x in weight.items() if x >= (HOLDS if n[1] in ("article", "main") else 1) * total]
    top = max(holders, default=None)  # elements are numbered as they open: the last is the innermost
    return " ".join(b.text for b in usable if top is None or top in b.nodes)


def extract(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per page: id, url, text (empty if none), n_chars (code points of the text)."""
    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                got = [main_text(x.as_py()) for x in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(got, pa.string()),
                                                  pa.array(list(map(len, got)), pa.int64())], ["id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).alias("id"), F.col(url).alias("url"), F.col(html).alias("html"))
    return (rows.mapInArrow(task, f"id {dict(rows.dtypes)['id']}, url {dict(rows.dtypes)['url']}, text string, n_chars long")
            .select(F.col("id").alias(id_col), F.col("url").alias(url), "text", "n_chars"))
