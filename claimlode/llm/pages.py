"""Main text of HTML pages: the contiguous region with the highest score.

A page becomes a row of words and tags. Words score positive, tags negative, with weights learned
from the pages that mark their article themselves, before anything but scripts and the like is left out;
one scan finds the maximum-scoring subsequence. Elements within the region that never belong to an article
(menus, forms, adverts, comments and so on) give no text, and blocks of the region become lines.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html import unescape
from itertools import accumulate
from math import exp, log
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?"
    r"|<(script|style|noscript|template|textarea|select|svg|iframe|title|xmp)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|</?[a-zA-Z][^>]*>?""",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.IGNORECASE)
HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?=[\s=]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.IGNORECASE)
#: Elements without text of the article, whatever their class.
LEFT_OUT = frozenset("head nav header footer aside form button menu dialog input label fieldset object canvas audio video".split())
#: Words in class, id, role or label that mark what an article page has beside the article.
BESIDE = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner"
    " nav navbar navigation menu breadcrumb breadcrumbs sidebar side aside complementary widget widgets"
    " header masthead footer contentinfo copyright comment comments commentlist respond reply replies disqus discussion"
    " cookie cookies consent notice notices gdpr alert popup modal overlay newsletter subscribe signup paywall"
    " share sharing social related recommended teaser teasers tags pagination pager toolbar search login".split()
)
#: Words that may stand with them in a name; any other word ("no-sidebar", "entry-header") makes it another name.
WITH_BESIDE = frozenset(
    "site page main global top bottom left right upper lower inner outer primary secondary first last list lists item items"
    " box block unit slot area section region zone panel bar buttons button links link icons form posts articles stories"
    " wrapper wrap container holder group row inline mobile desktop sticky fixed google thread js post entry article story blog".split()
)
HEADER = frozenset(["header", "masthead"])
OF_TEXT = frozenset(["post", "entry", "article", "story", "blog"])
#: Words of names that wrap an article as well as anything else.
WRAPPER = frozenset(
    "content contents main page site article post entry hentry story single body layout grid row col column columns"
    " wrapper wrap container outer inner section primary".split()
)
PART = re.compile(r"[\s_-]+")
#: Elements that begin and end a block.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LANDMARKS = ("article", "main")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARTS = frozenset("caption tbody thead tfoot tr td th".split())
#: Elements whose end tag may be missing: the start tags that end them, and the elements between that keep them open.
OPEN_ENDED = {
    "p": (BLOCKS - PARTS - {"body", "html", "legend"} | {"dialog"}, frozenset("table caption td th button object".split())),
    "li": (frozenset(["li"]), BLOCKS - {"address", "div", "p", "li"}),
    "dt": (frozenset(["dt", "dd"]), BLOCKS - {"address", "div", "p", "dt", "dd"}),
    "dd": (frozenset(["dt", "dd"]), BLOCKS - {"address", "div", "p", "dt", "dd"}),
    "td": (PARTS, frozenset(["table"])),
    "th": (PARTS, frozenset(["table"])),
    "tr": (PARTS - {"td", "th"}, frozenset(["table"])),
    "caption": (PARTS, frozenset(["table"])),
    "tbody": (frozenset(["tbody", "thead", "tfoot"]), frozenset(["table"])),
    "thead": (frozenset(["tbody", "thead", "tfoot"]), frozenset(["table"])),
    "tfoot": (frozenset(["tbody", "thead", "tfoot"]), frozenset(["table"])),
    "option": (frozenset(["option", "optgroup"]), BLOCKS),
    "a": (frozenset(["a"]), frozenset("table caption td th button object".split())),
    "button": (frozenset(["button"]), frozenset("table caption td th object".split())),
}
#: Elements that name what stands in them; a tag is counted by the two innermost ones around it.
SECTIONS = frozenset("head nav header footer aside form menu dialog".split())
#: Names that are counted by themselves; all others count as one.
KNOWN = BLOCKS | VOID | LEFT_OUT | frozenset("a b i em strong span u s small code sup sub cite q time abbr mark".split())
#: Words of classes, ids, roles and labels fall into so many buckets.
CLASS_BUCKETS = 1 << 14
#: What a tag costs at least, in words.
FLOOR = 1e-3
#: Weights of a word that are tried, and pages they are tried on (those with the smallest digests).
WORD_WEIGHTS = tuple(2.0**power for power in range(-10, 4))
SAMPLE_PAGES = 1024
IN_HEAD = frozenset("base basefont bgsound link meta head html".split())
#: Start tag -> the elements that it ends.
ENDS = {name: {open_ for open_, (by, _) in OPEN_ENDED.items() if name in by} for name in BLOCKS | {"dialog", "option", "optgroup", "a", "button"}}

@dataclass(slots=True)
class Token:
    """A run of text, or a tag with the kinds it is counted under."""

    name: str  # "word" or the name of a tag
    text: str = ""
    mark: int = 0  # number of the landmark (article, main) it is in, 0 for none
    left: str = ""  # "beside" in an element that stands beside the article, "hidden" in one that is not shown
    kinds: tuple[str, ...] = ()  # of the tag, or of the tag whose element holds the text


def left_open(opened: list[str], name: str, closing: bool) -> int:
    """How many of the opened elements stay open at this tag, by the rules of HTML for end tags that are missing."""
    if closing:
        if opened and opened[-1] == name:
            return len(opened) - 1
        names = HEADINGS if name in HEADINGS else (name,)
        if name in ("body", "html"):
            kept: frozenset = frozenset()
        elif name in PARTS or name == "table":
            kept = frozenset(["table"])
        elif name in BLOCKS or name in LEFT_OUT:
            kept = frozenset("table caption td th object".split()) | (OPEN_ENDED["p"][1] if name == "p" else set())
            kept |= {"ul", "ol"} if name == "li" else set()
        else:
            kept = BLOCKS | LEFT_OUT  # the end of an element within lines ends no block
        for i in range(len(opened) - 1, -1, -1):
            if opened[i] in names:
                return i
            if opened[i] in kept:
                break
        return len(opened)
    stay = len(opened)
    if opened and opened[-1] == "head" and name not in IN_HEAD:
        return stay - 1
    for ended in ENDS.get(name, ()):
        if ended not in opened:
            continue
        kept = OPEN_ENDED[ended][1]
        for i in range(len(opened) - 1, -1, -1):
            if opened[i] == ended:
                stay = min(stay, i)
                break
            if opened[i] in kept:
                break
    return stay


@lru_cache(maxsize=1 << 16)
def class_kinds(attributes: str) -> tuple[str, ...]:
    """One bucket for each word of the names of a tag."""
    words = [word for _, *values in ATTRIBUTE.findall(attributes) for word in PART.split("".join(values).lower()) if word]
    return tuple(f".{crc32(word.encode("utf-8", "replace")) % CLASS_BUCKETS}" for word in words)


def kinds_of(name: str, opened: list[str], attributes: str) -> tuple[str, ...]:
    """The kinds of a tag: its name within at most two sections around it, and the buckets of its names.

    Sections are what the page says beside its text, so article and main do not count. All kinds together are bounded
    by the known names and ``CLASS_BUCKETS``, whatever the pages hold.
    """
    known = name if name in KNOWN else "other"
    around = [one for one in opened if one in SECTIONS]
    named = "/".join([*around[-2:], known]) if around else known
    return (named, *class_kinds(attributes)) if "=" in attributes else (named,)


def tokens(html: str) -> list[Token]:
    """Texts and tags of a page, all but scripts, styles and the like; those of elements beside the article are marked so."""
    out: list[Token] = []
    depth, skip, left = Counter(), "", ""
    opened: list[str] = []
    held: list[tuple[str, ...]] = []  # the kinds of the opened elements
    outer = 0  # so many elements were open where the left-out one began
    landmarks, inside = 0, 0
    doubtful: list[tuple[int, int]] = []  # open elements, named both as beside the text and as a wrapper: depth, first token
    spans: list[tuple[int, int]] = []
    at = 0

    def text(upto: int) -> None:
        if upto > at:
            out.append(Token("word", html[at:upto], inside, left, held[-1] if held else ()))

    for match in TAG.finditer(html):
        text(match.start())
        at = match.end()
        name = (match[3] or "").lower()
        if not name:
            continue
        closing = bool(match[2])
        attributes = match[4] or ""
        stay = left_open(opened, name, closing)
        own = closing and stay < len(opened) and stay == outer
        del opened[stay:], held[stay:]
        tag = Token(name, "", inside, left, kinds_of(name, opened, "" if closing else attributes))
        if skip:
            # the left-out element ends at its own end tag, where HTML ends it without one (a new block, an end
            # tag of what it stands in), or where a landmark begins or the body ends
            landmark = name in LANDMARKS and not closing and not depth[name] and skip not in LANDMARKS and skip != "aside"
            if len(opened) > outer and not landmark and not (closing and name in ("body", "html")):
                if not closing and name not in VOID:
                    opened.append(name)
                    held.append(tag.kinds)
                out.append(tag)
                continue
            skip = left = tag.left = ""
            del opened[outer:], held[outer:]
            if own:
                out.append(tag)
                continue
        while doubtful and doubtful[-1][0] >= len(opened):
            spans.append((doubtful.pop()[1], len(out)))
        what = "no"
        if not closing and name not in VOID:
            if name in LEFT_OUT and not (name == "header" and inside):
                what = "yes"
            elif attributes:
                what = beside(name, attributes, inside > 0, depth["article"] > 0)
        out.append(tag)
        if what == "yes":
            if not attributes.rstrip().endswith("/"):
                skip, outer = name, len(opened)
                left = "hidden" if HIDDEN.search(attributes) else "beside"
                opened.append(name)
                held.append(tag.kinds)
            continue
        if what == "open":
            doubtful.append((len(opened), len(out)))
        if not closing and name not in VOID:
            opened.append(name)
            held.append(tag.kinds)
        if name in LANDMARKS:
            depth[name] += -1 if closing else 1
            depth[name] = max(0, depth[name])
            total = depth["article"] + depth["main"]
            if not closing and total == 1:
                landmarks += 1
                inside = landmarks
            elif total == 0:
                inside = 0
    text(len(html))
    return mark_small(out, spans + [(start, len(out)) for _, start in doubtful])


def beside(name: str, attributes: str, inside: bool, nested: bool) -> str:
    """Whether an element stands beside the article: "yes", "no", or "open" if its names also are those of a wrapper.

    Names are compared whole. ``inside``: in an article or main, where headers belong to the text;
    ``nested``: in an article, where another one can be a comment or a teaser.
    """
    if name in ("body", "html", "main"):
        return "no"
    if HIDDEN.search(attributes):
        return "yes"
    if (name == "article" and not nested) or (name == "header" and inside):
        return "no"
    found = wrapper = False
    for kind, *values in ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        for one in value.split() if kind.lower() == "class" else [value]:
            parts = {part.rstrip("0123456789") for part in PART.split(one)} - {""}
            words = parts & BESIDE
            if words and parts <= BESIDE | WITH_BESIDE:
                found |= not (words <= HEADER and (inside or parts & OF_TEXT))
            else:
                wrapper |= bool(parts) and parts <= WRAPPER
    return ("open" if wrapper else "yes") if found else "no"


def mark_small(out: list[Token], spans: list[tuple[int, int]]) -> list[Token]:
    """Mark spans that stand beside the text: without a landmark of their own, and fewer words than the rest has."""
    if not spans:
        return out
    words = [0]
    for one in out:
        words.append(words[-1] + (len(one.text.split()) if not one.left else 0))
    both = {side: sum(words[i + 1] - words[i] for i, one in enumerate(out) if (one.mark > 0) is side) for side in (True, False)}
    at = 0
    for start, stop in sorted(spans, key=lambda span: (span[0], -span[1])):
        if start < at or start == stop:
            continue  # in a span that is left out
        side = out[start].mark
        if 2 * (words[stop] - words[start]) <= both[side > 0] and all(one.mark == side for one in out[start:stop]):
            for one in out[start:stop]:
                one.left = one.left or "beside"
            at = stop
    return out


def region(scores: list[float]) -> tuple[int, int]:
    """Borders of the contiguous run with the highest sum; the earliest of equal ones, the longest from there."""
    best, borders, total, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total < 0:
            total, start = 0.0, i
        total += score
        if total > best or (total == best and borders[0] == start and best > 0):
            best, borders = total, (start, i + 1)
    return borders


def weight(kinds: tuple[str, ...], weights: dict[str, float]) -> float:
    """The lowest weight of a tag's kinds; a name not seen within these sections counts as the name alone."""
    name = weights.get(kinds[0])
    if name is None:
        name = weights.get(kinds[0].rsplit("/", 1)[-1], weights["other"])
    if len(kinds) == 1:
        return name
    return min(name, *(weights.get(kind, name) for kind in kinds[1:]))


def scores(row: list[Token], weights: dict[str, float]) -> list[float]:
    """The score of each token: words positive, tags negative.

    A word counts in full where its element's tag stands in articles as often as elsewhere, else by the odds of that tag.
    Words of elements beside the article score nothing, so no such element pulls the region towards itself, while its tags
    still part it from the text. Where the page marks its article, its tags inside the mark cost next to nothing, and
    words outside stand beside the article.
    """
    marked = any(one.mark for one in row)
    word, floor = weights["word"], -weights["word"] * FLOOR
    found = []
    for one in row:
        if one.name == "word":
            if one.left or (marked and not one.mark):
                found.append(0.0)
            else:
                odds = exp(weight(one.kinds, weights)) if one.kinds and not marked else 1.0
                found.append(word * odds * len(one.text.split()))
        elif one.left == "hidden":
            found.append(0.0)
        else:
            found.append(floor if one.mark or one.name in LANDMARKS else weight(one.kinds, weights))
    return found


def main_text(html: str | None, weights: dict[str, float]) -> str:
    """The blocks of the best region, one to a line."""
    if not html:
        return ""
    row = tokens(html)
    marked = any(one.mark for one in row)
    start, stop = region(scores(row, weights))
    blocks, pieces = [], []
    for one in [*row[start:stop], Token("p")]:
        if one.left or (one.name == "word" and marked and not one.mark):
            continue
        if one.name == "word":
            pieces.append(one.text)
        elif one.name in BLOCKS:
            block = " ".join(unescape("".join(pieces)).split())
            if block:
                blocks.append(block)
            pieces = []
        elif one.name == "br":
            pieces.append(" ")
    return "\n".join(blocks)


def count_tags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tags in and out of the article, by kind, of all pages that mark it; elements beside it are counted like any others."""
    counts: Counter = Counter()
    for batch in batches:
        for html in batch.column(0):
            row = tokens(html.as_py() or "")
            if not any(one.mark for one in row):
                continue
            for one in row:
                if one.name != "word" and one.left != "hidden" and one.name not in LANDMARKS:
                    own = {*one.kinds, one.kinds[0].rsplit("/", 1)[-1], ""}
                    counts.update((kind, one.mark > 0) for kind in own)
    kinds, inner, n = zip(*((*key, n) for key, n in counts.items()), strict=True) if counts else [()] * 3
    yield pa.record_batch(
        [pa.array(kinds, pa.string()), pa.array(inner, pa.bool_()), pa.array(n, pa.int64())], names=["kind", "inner", "n"]
    )


def tag_weights(n: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Log odds of standing in the article by kind of tag, never above zero; kind "" counts all tags.

    One tag is added to each kind, shared out as all tags are, so a kind never seen has odds of 1.
    """
    total = {side: n.get(("", side), 0) for side in (True, False)}
    if not all(total.values()):
        return {}
    share = {side: total[side] / (total[True] + total[False]) for side in total}
    rate = {(kind, side): (n.get((kind, side), 0) + share[side]) / total[side] for kind, _ in n for side in total}
    return {kind: min(0.0, log(rate[kind, True] / rate[kind, False])) for kind, _ in n if kind}


def complete(tags: dict[str, float], word: float) -> dict[str, float]:
    """Weights for one weight of a word; no tag is free, and a tag never seen costs a tenth of a word."""
    return {**{kind: min(value, -word * FLOOR) for kind, value in tags.items()}, "word": word, "other": -word / 10}


def hit_rates(row: list[Token], ways: list[dict[str, float]]) -> list[float]:
    """F1 over words of the regions found in a marked page with each set of weights; marks and lists of names are out of sight."""
    ends = [0, *accumulate(len(one.text.split()) for one in row)]
    inner = [0, *accumulate(len(one.text.split()) * (one.mark > 0) for one in row)]
    plain = [Token(one.name, one.text, 0, "", one.kinds) for one in row]
    found = []
    for weights in ways:
        start, stop = region(scores(plain, weights))
        both = inner[stop] - inner[start]
        found.append(2 * both / (inner[-1] + ends[stop] - ends[start]) if both else 0.0)
    return found


def learn_weights(pages: DataFrame) -> dict[str, float]:
    """Weights of tags and words, from all pages of (html) that mark their article.

    A tag weighs its log odds of standing in the article. The weight of a word is the one of ``WORD_WEIGHTS`` with which
    the scan, kept from seeing marks and lists of names, finds the articles of ``SAMPLE_PAGES`` pages best.
    """
    spark = pages.sparkSession
    counted = pages.select("html").mapInArrow(count_tags, "kind string, inner boolean, n long")
    sums = counted.groupBy("kind", "inner").agg(F.sum("n").alias("n")).collect()
    tags = tag_weights({(r["kind"], r["inner"]): r["n"] for r in sums})
    if not tags:
        return complete({}, 1.0)
    digest = F.xxhash64("html")
    last = pages.select(digest.alias("digest")).orderBy("digest").limit(SAMPLE_PAGES).agg(F.max("digest")).first()[0]
    shared = spark.sparkContext.broadcast(tags)  # bounded by the kinds of tags

    def rates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ways = [complete(shared.value, word) for word in WORD_WEIGHTS]
        sums = [0.0] * len(ways)
        for batch in batches:
            for html in batch.column(0):
                row = [one for one in tokens(html.as_py() or "") if one.left != "hidden"]
                if any(one.mark for one in row):
                    sums = [total + rate for total, rate in zip(sums, hit_rates(row, ways), strict=True)]
        yield pa.record_batch([pa.array(WORD_WEIGHTS, pa.float64()), pa.array(sums, pa.float64())], names=["word", "rate"])

    tried = pages.where(digest <= last).select("html").mapInArrow(rates, "word double, rate double")
    found = {r["word"]: round(r["rate"], 6) for r in tried.groupBy("word").agg(F.sum("rate").alias("rate")).collect()}
    best = sorted(word for word, rate in found.items() if rate == max(found.values()))
    return complete(tags, best[len(best) // 2])


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of (page_id, url, html).

    A null or empty page, or one without a word outside left-out elements, has an empty text. Rows are
    taken one by one, repeated ones alike; other columns are ignored. Without any page that marks its
    article, words score 1 and tags -0.1.
    """
    shared = pages.sparkSession.sparkContext.broadcast(learn_weights(pages))  # bounded by the kinds of tags

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            text = pa.array([main_text(html.as_py(), weights) for html in batch.column(2)], pa.string())
            yield pa.record_batch([batch.column(0), batch.column(1), text], names=["page_id", "url", "text"])

    found = pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))
