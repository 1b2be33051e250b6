"""Main text of web pages: the maximum-scoring run of words and tags.

A page is read as a sequence of words and tags. Words score positive, tags score
negative, words in boilerplate elements count against the region; one linear scan
finds the run with the highest sum (the longer one on a tie). The text of the run,
without boilerplate elements inside it, is the main text.

Weights come from labelled pages: those that mark their main text with an
``article`` element. For words and for each tag name, apart for tags inside and
outside such an element, the weight is the log odds of standing in the main text,
held to the sign of its kind. The sample is bounded (``TRAIN_PAGES`` pages, the
first by hash of their id). Pages without the element are scored by the weights
of the bare tag names.

Boilerplate elements: ``SKIP`` (never text), ``ASIDE`` (menus, headers, footers,
sidebars, forms) and elements whose class, id or role holds a word of ``MARKS``
(adverts, notices, comments, shares and the like), but not ``article`` and ``main``
themselves: their classes name topics. A ``header`` inside the article is part of it.

A page may hold several main elements: the words of each score positive, and the
scan tells which of them belong to the run.

Text: character references are decoded; white space inside a block becomes one
space; blocks are trimmed and joined by one line feed; nothing else is dropped.
``br`` is white space, not a block end. Damaged markup: an unclosed element ends
with the next enclosing end tag, a cut-off last tag is dropped, an unclosed
comment, script or style runs to the end.

Defined cases: null and empty pages give an empty text; every row is read on its
own, so ties and repeated rows need no rule; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.tables import table

TRAIN_PAGES = 1000
LEAST, MOST = 0.05, 4.0  # bounds of a weight

# Element names by their part in a page, and marks of boilerplate.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIP = frozenset("head script style noscript template title svg math iframe object canvas audio video".split())
ASIDE = frozenset("nav header footer aside form menu button select textarea dialog label fieldset".split())
MAIN = frozenset("article main".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q ruby rt rp s samp small "
    "span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main "
    "menu nav ol p pre section table ul".split())
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "menu nav navbar navigation breadcrumb breadcrumbs header masthead footer sidebar aside widget widgets "
    "cookie cookies consent notice notices gdpr popup modal overlay alert "
    "comment comments reply replies respond disqus discussion "
    "share sharing social related recommended teaser subscribe subscription newsletter signup login "
    "search searchform form toolbar pagination pager tags complementary contentinfo".split())

_TOKEN = re.compile(
    r"<!--(?P<comment>.*?)(?:-->|\Z)"
    r"|<(?P<raw>script|style|title|textarea|noscript|template|iframe|svg|math)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<bad>[a-zA-Z/!?][^>]*)(?:>|\Z)"
    r"|(?P<text>[^<]+|<)", re.S | re.I)
_MARK = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[a-z]+")

#: Weights used where a tag was not seen on labelled pages.
DEFAULT = {"word": 1.0, "": 1.0, "+": LEAST}


class Item:
    """A text (name empty) or a tag of a page."""

    __slots__ = ("name", "text", "words", "block", "out", "main")

    def __init__(self, name: str, text: str, block: int, out: bool, main: int):
        self.name, self.text, self.block, self.out, self.main = name, text, block, out, main
        self.words = 0 if name else len(text.split())


def _marked(attrs: str, main: bool) -> bool:
    """Whether class, id or role tell boilerplate; has-sidebar and the like do not,
    nor does a header of the main text."""
    for m in _MARK.finditer(attrs):
        for name in "".join(m.groups("")).lower().split():
            parts = _PART.findall(name)
            if parts and parts[0] not in ("has", "with", "no", "is") and not MARKS.isdisjoint(
                    set(parts) - {"header"} if main else parts):
                return True
    return False


def items(page: str) -> Iterator[Item]:
    """Texts and tags in page order; main is the number of the outermost main
    element around it (0: none), out tells boilerplate."""
    stack: list[tuple[str, bool, int]] = []  # (name, out, main)
    block = mains = 0
    out, main = False, 0
    for m in _TOKEN.finditer(page):
        if (text := m["text"]) is not None:
            yield Item("", text, block, out, main)
            continue
        if not m["name"]:
            continue
        name, attrs = m["name"].lower(), m["attrs"]
        if m["end"]:
            k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), -1)
            if k >= 0:
                del stack[k:]
                _, out, main = stack[-1] if stack else ("", False, 0)
        else:
            if name in CLOSES_P or name == "li":
                old = "li" if name == "li" else "p"
                stop = ("ul", "ol", "menu") if name == "li" else ("li", "td", "th", "div", "article", "section", "blockquote")
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == old:
                        del stack[k:]
                        _, out, main = stack[-1] if stack else ("", False, 0)
                        break
                    if stack[k][0] in stop:
                        break
            if name not in VOID and not attrs.endswith("/"):
                marked = name not in ("html", "body") and name not in MAIN and _marked(attrs, bool(main))
                if name in MAIN and not main and not out and not marked:
                    mains += 1
                    main = mains
                elif name in SKIP or marked or name in ASIDE and not (name == "header" and main):
                    out = True
                stack.append((name, out, main))
        if name not in INLINE:
            block += 1
        yield Item("/" + name if m["end"] else name, " " if name == "br" else "", block, out, main)


def page_items(page: str) -> tuple[list[Item], bool]:
    """Items of a page, and whether it has main elements with words."""
    got = list(items(page))
    return got, any(x.main and not x.out and x.words for x in got)


def learn(pages: Iterator[str]) -> Counter:
    """Counts of (key, in main text) on labelled pages; key: word, tag, tag+."""
    seen: Counter = Counter()
    for page in pages:
        got, main = page_items(page)
        if not main:
            continue
        for x in got:
            inside = bool(x.main) and not x.out
            if not x.name:
                seen["word", inside] += x.words
            else:
                seen[x.name, inside] += 1
                seen[x.name + "+" if x.main else "", inside] += 1
                seen["+" if x.main else "", inside] += 1
    return seen


def weights(seen: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Score of a word (positive) and of each tag (negative)."""
    if not seen:
        return {k: v if k == "word" else -v for k, v in DEFAULT.items()}
    odds = lambda k: math.log((seen.get((k, True), 0) + 1) / (seen.get((k, False), 0) + 1))
    held = lambda x: min(max(x, LEAST), MOST)
    out = {k: -held(-odds(k)) for k, _ in seen if k != "word"}
    return {k: -v for k, v in DEFAULT.items()} | out | {"word": held(max(odds("word"), DEFAULT["word"]))}


def best_run(scores: list[float]) -> tuple[int, int]:
    """Maximum-scoring contiguous part, the longer one on a tie; (0, 0) if none is positive."""
    best, run, at, found = 0.0, 0.0, 0, (0, 0)
    for i, x in enumerate(scores):
        if run < 0:
            run, at = 0.0, i
        run += x
        if run > best or run == best and best > 0 and i + 1 - at > found[1] - found[0]:
            best, found = run, (at, i + 1)
    return found


def main_text(page: str, weight: dict[str, float]) -> str:
    got, main = page_items(page)
    scores = []
    for x in got:
        inside = not main or bool(x.main) or x.out
        if not x.name:
            # Boilerplate inside or between main elements is left out, but does not cut the run in two.
            scores.append(x.words * weight["word"] * (-1 if not inside else 1 if not x.out else -1 if not main else 0))
        else:
            key = x.name + "+" if main and inside else x.name
            scores.append(weight.get(key, weight["+"] if main and inside else weight[""]))
    a, b = best_run(scores)
    blocks: list[str] = []
    last = -1
    for x in got[a:b]:
        if x.out or main and not x.main:
            continue
        if x.block != last:
            blocks.append("")
            last = x.block
        blocks[-1] += x.text
    clean = (" ".join(html.unescape(t).split()) for t in blocks)
    return "\n".join(t for t in clean if t)


def train(pages: DataFrame) -> dict[str, float]:
    """Weights from a bounded sample of labelled pages."""
    labelled = pages.where("page_id is not null and html ilike '%<article%'")
    ids = labelled.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(TRAIN_PAGES)
    # At most TRAIN_PAGES ids: a proven bound for the broadcast. The pages stay where they are read.
    sample = labelled.select("page_id", F.col("html").alias("__html")).join(F.broadcast(ids), "page_id")

    def count(batches):
        for batch in batches:
            seen = learn(x or "" for x in batch.column(0).to_pylist())
            keys = list(seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in keys], pa.string()), pa.array([i for _, i in keys], pa.bool_()),
                 pa.array([seen[k] for k in keys], pa.int64())], ["key", "inside", "n"])

    counts = sample.select("__html").mapInArrow(count, "key string, inside boolean, n long").groupBy(
        "key", "inside").agg(F.sum("n").alias("n"))
    return weights({(r["key"], r["inside"]): r["n"] for r in counts.collect()})


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every page."""
    weight = train(pages)
    rows = pages.select("page_id", "url", F.col("html").alias("__html"))

    def texts(batches):
        for batch in batches:
            got = [main_text(x or "", weight) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(got, pa.string())], ["page_id", "url", "text"])

    kind = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(texts, f"page_id {kind['page_id']}, url {kind['url']}, text string")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page and its length in code points."""
    got = extract(table(spark, sf_dir, "pages", ("page_id", "url", "html")))
    return got.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
