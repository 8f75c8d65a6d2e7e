"""The main text of a web page: the best-scoring run of its words and tags."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache
from math import log
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from millrace.llm.arrow import only

# Labelled pages that weights are learned from at most, those with the least hash of their id.
FIT_PAGES = 2_000
# Greatest weight, the least that a tag takes away, and the most that a tag does which only
# groups or lays out text.
GREATEST, TAG_LEAST, PLAIN_MOST = 6.0, 0.05, 0.25
# What a stretch that keeps no text takes away; its tags take away more.
INTERRUPTION = 0.5
# Words that an element listed below counts as having had outside the text, before learning.
PRIOR_WORDS = 200

TOKEN = re.compile(
    r"<(?:(?P<tag>(?!(?:script|style|textarea|title|iframe|noscript|template|svg)\b)"
    r"/?[a-z](?:[^>\"']|\"[^\"]*\"|'[^']*')*+>)"
    r"|(?P<raw>script|style|textarea|title|iframe|noscript|template|svg)\b"
    r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)"
    r"|(?P<torn>/?[a-z][^>]*(?:>|\Z)))", re.S | re.I)
NAME = re.compile(r"</?([a-z][a-z0-9:-]*)", re.I)
MARKS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"\shidden(?=[\s>=/])|aria-hidden\s*=\s*[\"']?true", re.I)

VOID = {"br", "img", "hr", "input", "meta", "link", "wbr", "source", "col", "area", "base", "embed"}
# Elements that do not end a block, and those among the others that may hold anything.
INLINE = {"a", "b", "i", "u", "s", "em", "strong", "span", "small", "big", "sub", "sup", "font",
          "mark", "abbr", "cite", "code", "q", "time", "label", "br", "wbr", "img", "tt", "del",
          "ins", "kbd", "samp", "var", "dfn", "bdi", "bdo", "data", "acronym"}
PLAIN = {"div", "section", "ul", "ol", "li", "dl", "dt", "dd", "table", "thead", "tbody", "tr",
         "td", "th", "p", "blockquote", "pre", "figure", "figcaption", "main", "center", "hr",
         "h1", "h2", "h3", "h4", "h5", "h6", "caption", "details", "summary", "address"} | INLINE
# Elements that keep no text of a page, before any page was seen.
ASIDE = {"nav", "footer", "aside", "form", "head", "header", "menu", "button", "select",
         "dialog", "fieldset", "option", "legend"}
ASIDE_MARK = re.compile(
    r"(?:^|[-_])(?:ads?|advert\w*|promo\w*|sponsor\w*|banner|nav\w*|menu\w*|breadcrumbs?|sidebar|"
    r"widgets?|footer|masthead|cookies?|consent|notices?|alert|popup|modal|newsletter|subscribe|"
    r"signup|share|sharing|social|related|recommended|comments?|disqus|repl(?:y|ies)|respond|"
    r"login|search|searchbox|toolbar|pagination|pager|skip|complementary|contentinfo|navigation|"
    r"form|hidden)(?:[-_]|$)", re.I)
BODY = {"article", "main"}


@lru_cache(maxsize=4096)
def parsed(tag: str) -> tuple[str, tuple[str, ...], bool]:
    """Name, marks (classes, id, role, as ``.mark``) and whether the tag closes itself."""
    marks = [f".{m}" for found in MARKS.findall(tag) for m in "".join(found).lower().split()]
    if HIDDEN.search(tag):
        marks.append(".hidden")
    return NAME.match(tag)[1].lower(), tuple(marks), tag.endswith("/>")


class Around:
    """The marks of the elements around a text: those that one element adds to its parents'.

    A page's elements share their parents by reference, so that a depth of any number of
    elements costs one step for each.
    """

    __slots__ = ("parent", "keys")

    def __init__(self, parent: Around | None, keys: tuple[str, ...]):
        self.parent, self.keys = parent, keys


class Token(NamedTuple):
    """A tag, or the text up to the next one with the marks of the elements around it."""
    tag: str
    text: str
    around: Around


def tokens(page: str) -> list[Token]:
    """The tags and texts of a page; comments, scripts and styles are left out."""
    out: list[Token] = []
    # Open elements: name, the marks that are new with it, and the marks around.
    stack: list[tuple[str, Around]] = []
    names: Counter = Counter()
    marked: set[str] = set()
    around = Around(None, ())
    at = 0

    def leave() -> None:
        nonlocal around
        name, own = stack.pop()
        names[name] -= 1
        marked.difference_update(own.keys)
        around = own.parent

    def text(upto: int) -> None:
        if upto > at and not page[at:upto].isspace():
            out.append(Token("", page[at:upto], around))

    for match in TOKEN.finditer(page):
        text(match.start())
        at = match.end()
        if match.lastgroup not in ("tag", "torn"):
            continue
        tag = match[0]
        name, marks, closed = parsed(tag)
        if tag[1] == "/":
            out.append(Token("/" + name, "", around))
            if name in INLINE and name != "a":
                continue
            if names[name]:
                while stack[-1][0] != name:
                    leave()
                leave()
        else:
            out.append(Token(name, "", around))
            if name in VOID or closed or name in INLINE and name != "a" and not marks:
                continue
            if name == "a":
                keys = ("a",)
            elif name in PLAIN or name == "header" and any(names[n] for n in BODY):
                keys = marks
            else:
                keys = (*marks, name)
            while stack and name not in INLINE and stack[-1][0] == "a":
                leave()  # a link does not reach over blocks
            if keys or name not in ("p", "li"):
                around = Around(around, tuple(key for key in dict.fromkeys(keys) if key not in marked))
                marked.update(around.keys)
                names[name] += 1
                stack.append((name, around))
    text(len(page))
    return out


def labelled(page_tokens: list[Token]) -> tuple[int, int] | None:
    """The tokens of the text, on a page that marks it by exactly one closed article."""
    opens = [k for k, t in enumerate(page_tokens) if t.tag == "article"]
    closes = [k for k, t in enumerate(page_tokens) if t.tag == "/article"]
    if len(opens) == len(closes) == 1 and opens[0] < closes[0]:
        return opens[0] + 1, closes[0]
    return None


def counts(page_tokens: list[Token]) -> Counter:
    """(what, inside): how many words or tags of each kind lie in and beyond the text."""
    out: Counter = Counter()
    span = labelled(page_tokens)
    if span is None:
        return out
    # Words of each element, in the order in which elements begin, so parents come first.
    under: dict[Around, list[int]] = {}
    for k, token in enumerate(page_tokens):
        inside = span[0] <= k < span[1]
        path, at = [], token.around
        while at is not None and at not in under:
            path.append(at)
            at = at.parent
        for element in reversed(path):
            under[element] = [0, 0]
        if token.tag:
            out[f"<{token.tag}", inside] += 1
        else:
            n = len(token.text.split())
            out["word", inside] += n
            under[token.around][inside] += n
    for element in reversed(under):
        words = under[element]
        if element.parent is not None:
            for inside in (False, True):
                under[element.parent][inside] += words[inside]
        for key in element.keys:
            for inside in (False, True):
                if words[inside]:
                    out[f"in {key}", inside] += words[inside]
    return out


@dataclass
class Weights:
    """Logarithms of how much more often a word or tag lies in the text than beyond it."""
    learned: dict[str, float] = field(default_factory=dict)

    @staticmethod
    def of(counted: dict[str, tuple[int, int]]) -> Weights:
        out = {}
        for what, (inside, beyond) in counted.items():
            if what.startswith("in "):
                key = what[3:]
                if key in ASIDE or key.startswith(".") and ASIDE_MARK.search(key[1:]):
                    beyond += PRIOR_WORDS
            out[what] = max(-GREATEST, min(GREATEST, log((inside + 1) / (beyond + 1))))
        return Weights(out)

    def plain_word(self) -> float:
        """What a word with no marks around it scores."""
        return max(self.learned.get("word", 1.0), 1.0)

    def key(self, key: str) -> float:
        """The most that a word scores with this mark around it; negative where the element
        keeps no text."""
        known = self.learned.get(f"in {key}")
        if known is None:
            aside = key in ASIDE or key.startswith(".") and ASIDE_MARK.search(key[1:])
            known = -GREATEST if aside else self.plain_word()
        # A link may stand in a text as well as in a menu.
        return max(known, 0.1) if key == "a" else known

    def word(self, around: Around, known: dict[Around, float]) -> float:
        """The least by all marks around; ``known`` keeps what was found for elements."""
        path, at = [], around
        while at is not None and at not in known:
            path.append(at)
            at = at.parent
        least = known[at] if at is not None else self.plain_word()
        for element in reversed(path):
            least = min([least, *[self.key(key) for key in element.keys]])
            known[element] = least
        return least

    def tag(self, name: str) -> float:
        """Always negative."""
        known = min(self.learned.get(f"<{name}", -PLAIN_MOST), -TAG_LEAST)
        return max(known, -PLAIN_MOST) if name.lstrip("/") in PLAIN else known


def best_run(scores: list[float]) -> tuple[int, int]:
    """Bounds of the contiguous run with the greatest sum, by one scan; the first of equals."""
    best, bounds, total, start = 0.0, (0, 0), 0.0, 0
    for k, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, k
        total += score
        if total > best:
            best, bounds = total, (start, k + 1)
    return bounds


def extract(page: str, weights: Weights) -> str:
    """The blocks of the best region, one to a line, without what keeps no text inside it."""
    found = tokens(page)
    scores, of_tag, of_word = [], {}, {}
    for tag, text, around in found:
        if tag:
            if tag not in of_tag:
                of_tag[tag] = weights.tag(tag)
            scores.append(of_tag[tag])
        else:
            one = weights.word(around, of_word)
            # However long, what keeps no text counts as one interruption.
            scores.append(one * len(text.split()) if one > 0 else max(one, -INTERRUPTION))
    a, b = best_run(scores)
    blocks, parts = [], []
    for token, score in zip(found[a:b], scores[a:b]):
        if token.tag:
            if token.tag in ("br", "wbr", "img"):
                parts.append(" " if token.tag == "br" else "")
            elif token.tag.lstrip("/") not in INLINE:
                blocks.append("".join(parts))
                parts = []
        elif score > 0:
            parts.append(html.unescape(token.text))
    blocks.append("".join(parts))
    joined = (" ".join(block.split()) for block in blocks)
    return "\n".join(block for block in joined if block)


# --- Over tables -----------------------------------------------------------------------

def train(pages: DataFrame, rows: int = FIT_PAGES) -> Weights:
    """Weights from at most ``rows`` pages, those with the least hash of their id.

    A page counts if it marks its text by exactly one closed ``article``. Without any such
    page the weights are those that the lists above give.
    """
    chosen = (pages.select("page_id").filter("page_id IS NOT NULL AND html IS NOT NULL").distinct()
              .orderBy(F.xxhash64("page_id"), "page_id").limit(rows)
              .select(F.col("page_id").alias("chosen_id")))
    # At most ``rows`` ids, so small enough for every executor.
    sample = pages.select("page_id", "html").join(
        F.broadcast(chosen), F.col("page_id") == F.col("chosen_id")).select("html")

    def run(batches):
        for batch in batches:
            total: Counter = Counter()
            for page in batch.column("html").to_pylist():
                total.update(counts(tokens(page or "")))
            names = sorted({what for what, _ in total})
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, type=pa.string()),
                 pa.array([total[n, True] for n in names], type=pa.int64()),
                 pa.array([total[n, False] for n in names], type=pa.int64())],
                names=["what", "inside", "beyond"])

    # As many names as the sampled pages have.
    counted = sample.mapInArrow(run, "what string, inside long, beyond long").groupBy("what").agg(
        F.sum("inside").alias("inside"), F.sum("beyond").alias("beyond"))
    return Weights.of({row["what"]: (row["inside"], row["beyond"]) for row in counted.collect()})


def main_text(pages: DataFrame, weights: Weights) -> DataFrame:
    """page_id, url and text of every row.

    Character references are decoded, white space inside a block becomes one space, and
    blocks are joined in page order by a line break. A NULL or empty page, and one without
    words, has an empty text. Repeated rows and NULL ids give a row each. Other columns are
    ignored. An empty table gives no rows.
    """
    held = pages.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        for batch in batches:
            for n in range(0, len(batch), 256):
                some = batch.slice(n, 256)
                texts = [extract(page, held.value) if page else ""
                         for page in (x.as_py() for x in some.column("html"))]
                yield pa.RecordBatch.from_arrays(
                    [some.column("page_id"), some.column("url"), pa.array(texts, type=pa.string())],
                    names=["page_id", "url", "text"])

    types = [pages.schema["page_id"], pages.schema["url"], T.StructField("text", T.StringType())]
    return only(pages, "page_id", "url", "html").mapInArrow(run, T.StructType(types))
