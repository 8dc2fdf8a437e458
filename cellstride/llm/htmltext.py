"""Main text of web pages: the best-scoring contiguous region of words and tags."""

from __future__ import annotations

import html
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache
from math import log

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..sources.staging import stage
from . import common

#: Fixed values of HTML: elements whose content is no text, and elements that begin and end a block.
RAW = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "head", "title", "textarea", "select",
       "button"}
FOREIGN = {"svg", "math"}  # of the raw elements, those that may end in their own tag
BLOCKS = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "div", "dl", "dt", "fieldset",
          "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li",
          "main", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: Elements that end by themselves where a like one or their parent's end follows.
LOOSE = {"p", "li", "dd", "dt", "td", "th", "tr", "tbody", "thead", "tfoot", "option", "b", "i", "em", "strong", "a", "span"}
#: Page furniture by element, and by the words of class, id and role.
FURNITURE = {"nav", "footer", "header", "aside", "form", "menu", "dialog"}
MARKED = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment",
          "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "disqus", "footer", "gdpr", "header",
          "masthead", "menu", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "popup", "promo", "promoted",
          "related", "replies", "reply", "share", "sharing", "sidebar", "skip", "social", "sponsor", "sponsored", "subscribe",
          "toolbar", "widget"}
#: What holds the article is not dropped for such a word (a header inside it is).
HOLDERS = {"html", "body", "article", "main"}

TOKEN = regex.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"""|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>"']|"[^"]*"|'[^']*')*+)>"""
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)", regex.S)
#: One attribute at a time, so that nothing inside another's name or value is taken for one.
ATTRIBUTE = regex.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NAME_PART = regex.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
#: Words that say nothing in a compound name beside one of the words above: site-header is a header, no-sidebar is none.
NEUTRAL = {"site", "main", "page", "top", "bottom", "left", "right", "inner", "outer", "wrap", "wrapper", "container", "block", "box",
           "area", "list", "section", "item", "items", "bar", "primary", "secondary", "global", "sub", "links", "block", "panel", "row",
           "col", "module", "region", "user", "post", "article", "js"}


def _furniture(name: str, rest: str) -> bool:
    if name in HOLDERS:
        return False
    if name in FURNITURE:
        return True
    for key, *values in ATTRIBUTE.findall(rest) if rest else ():
        key, value = key.lower(), "".join(values)
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return True
        if key in ("class", "id", "role") and any(map(_names_furniture, value.split())):
            return True
    return False


@cache
def _names_furniture(name: str) -> bool:
    """Whether a class, id or role is that of page furniture: its parts are words for it, or say nothing."""
    parts = {x.lower() for x in NAME_PART.findall(name) if not x.isdigit()}
    return not parts.isdisjoint(MARKED) and parts <= MARKED | NEUTRAL


def tokens(page: str) -> Iterator[tuple[str, str, bool]]:
    """(kind, value, furniture): text runs ("text", within a link "link") and tags ("tag", name or /name), in page order.

    Within an article or main element, the kind of a tag is "held".  Text in raw elements, comments and markup
    declarations does not come out.  Furniture says whether the token stands in page furniture.
    """
    open_: list[tuple[str, bool]] = []
    names: Counter = Counter()
    at = depth = held = 0
    while True:
        m = TOKEN.search(page, at)
        text = page[at:m.start() if m else len(page)]
        if text:
            yield "link" if names["a"] else "text", html.unescape(text), depth > 0
        if not m:
            return
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        if m["close"] or m["close2"]:
            if names[name]:
                while open_:
                    n, dropped = open_.pop()
                    names[n] -= 1
                    depth -= dropped
                    held -= n in ("article", "main")
                    if n == name:
                        break
            yield "held" if held else "tag", "/" + name, depth > 0
            continue
        rest = m["rest"] or m["rest2"] or ""
        yield "held" if held else "tag", name, depth > 0
        if name in FOREIGN and rest.rstrip().endswith("/"):
            yield "held" if held else "tag", "/" + name, depth > 0
        elif name in RAW:
            # Everything up to the end tag; an unclosed one ends the page, an unclosed head ends at the body.
            end = regex.compile(rf"</{regex.escape(name)}\b[^>]*>" + (r"|(?=<body\b)" if name == "head" else ""), regex.I).search(page, at)
            at = end.end() if end else len(page)
            yield "held" if held else "tag", "/" + name, depth > 0
        elif name not in VOID and not rest.rstrip().endswith("/"):
            if name in LOOSE and open_ and open_[-1][0] == name and not open_[-1][1]:
                open_.pop()
                names[name] -= 1
            dropped = _furniture(name, rest)
            open_.append((name, dropped))
            names[name] += 1
            depth += dropped
            held += name in ("article", "main")


@dataclass
class Weights:
    """Score of a word (positive), of a word within a link (negative) and of tags by (kind, name) (negative).

    A tag not met in its place scores as in the other place, one not met at all as ``other`` of its kind.
    """
    word: float = 1.0
    link: float = -0.3
    tags: dict[tuple[str, str], float] = field(default_factory=dict)
    other: dict[str, float] = field(default_factory=lambda: {"tag": -0.5, "held": -0.01})

    def tag(self, kind: str, name: str) -> float:
        known = self.tags.get((kind, name))
        if known is None:
            known = self.other["held"] if kind == "held" else self.tags.get(("held", name), self.other["tag"])
            self.tags[kind, name] = known
        return known


def best_region(scores: list[float]) -> tuple[int, int]:
    """Begin and end of the contiguous run with the largest sum (of equal ones the first, then the longest); one scan."""
    best, region, total, begin = 0.0, (0, 0), 0.0, 0
    for i, x in enumerate(scores):
        if total < 0:
            total, begin = 0.0, i
        total += x
        if total > best or (total == best and region[0] == begin and best > 0):
            best, region = total, (begin, i + 1)
    return region


def extract(page: str | None, weights: Weights) -> str:
    """Text of the best region: its blocks, white space within a block made one space, joined by newlines."""
    found = list(tokens(page or ""))
    of_word = {"text": weights.word, "link": weights.link}
    scores = [weights.tag(k, v) if k not in of_word else 0.0 if dropped else of_word[k] * len(v.split())
              for k, v, dropped in found]
    begin, end = best_region(scores)
    blocks, now = [], []
    for kind, value, dropped in found[begin:end]:
        if kind in of_word:
            if not dropped:
                now.append(value)
        elif value.lstrip("/") in BLOCKS:
            blocks.append("".join(now))
            now = []
        elif value == "br":
            now.append(" ")
    blocks.append("".join(now))
    return "\n".join(b for b in (" ".join(x.split()) for x in blocks) if b)


def count_labelled(page: str, text: str) -> Counter:
    """Of a labelled page, how often words and tags stand within the labelled content and outside.

    Text runs are matched with the label's words in order; a heading may repeat the label's beginning.  The content
    reaches from the first to the last match.
    """
    found = list(tokens(page))
    wanted, whole, matched, at = text.split(), " ".join(text.split()), [], 0
    for i, (kind, value, _) in enumerate(found):
        own = value.split() if kind in ("text", "link") else []
        if own and own == wanted[at:at + len(own)]:
            matched.append(i)
            at += len(own)
        elif own and whole.startswith(" ".join(own)):
            matched.append(i)
            at = len(own) if own == wanted[:len(own)] else 0
    out: Counter = Counter()
    if matched and 2 * at >= len(wanted):
        for i, (kind, value, _) in enumerate(found):
            inside = matched[0] <= i <= matched[-1]
            words = kind in ("text", "link")
            out[kind, "" if words else value, inside] += len(value.split()) if words else 1
    return out


def fit_weights(counts: dict[tuple[str, str, bool], int]) -> Weights:
    """Log-likelihood ratios of inside against outside, scaled so that a word scores one; tags and words within links stay below zero."""
    total = {side: sum(n for (_, _, s), n in counts.items() if s == side) + 1.0 for side in (True, False)}

    def ratio(kind: str, name: str) -> float:
        return (log((counts.get((kind, name, True), 0) + 0.5) / total[True])
                - log((counts.get((kind, name, False), 0) + 0.5) / total[False]))
    word = max(ratio("text", ""), 0.1)
    link = min(max(ratio("link", "") / word, -1.0), 0.0) if any(k == "link" for k, _, _ in counts) else Weights.link
    tags = {(k, n): min(ratio(k, n) / word, -0.001) for k, n, _ in counts if k not in ("text", "link")}
    other = dict(Weights().other)
    for kind in other:
        met = sorted(w for (k, _), w in tags.items() if k == kind)
        if met:
            other[kind] = met[len(met) // 2]
    return Weights(1.0, link, tags, other)


def learn(labelled: DataFrame, sample: int = 400) -> Weights:
    """Weights from labelled pages (html, text), at most ``sample`` of them; pages that do not hold their text teach nothing.

    Tags of a name not met get the mean of those that speak against content; without any page, the defaults hold.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for page, text in zip(batch.column("html"), batch.column("text")):
                total.update(count_labelled(page.as_py(), text.as_py()))
        keys = sorted(total)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                                          pa.array([k[2] for k in keys], pa.bool_()),
                                          pa.array([total[k] for k in keys], pa.int64())], ["kind", "name", "inside", "n"])

    pages = labelled.where("html is not null and text is not null").select(
        F.col("html").cast("string"), F.col("text").cast("string")).limit(sample)
    counts = pages.mapInArrow(run, "kind string, name string, inside boolean, n bigint").groupBy(
        "kind", "name", "inside").agg(F.sum("n").alias("n"))
    # Bounded: the tag names of at most ``sample`` pages.
    found = {(r["kind"], r["name"], r["inside"]): r["n"] for r in counts.collect()}
    return fit_weights(found) if found else Weights()


def extract_text(df: DataFrame, weights: Weights, html_col: str = "html", out: str = "text") -> DataFrame:
    """``df`` with the main text of each whole page.

    Words in page furniture (menus, headers, footers, sidebars, notices, adverts, forms, comments) score nothing and are left
    out of the text; the other words score ``weights.word``, tags what the labelled pages taught.  Furniture is told by element, by a
    true ``hidden`` attribute and by names of class, id or role that say nothing else.  A null or empty page, or
    one without words, gives an empty text; long pages are read whole in one scan, repeated rows each, an empty table gives an
    empty result.  A column of the new name is replaced.
    """
    kept = common.without(df, out)
    names = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([extract(x.as_py(), weights) for x in batch.column("html")], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("row"), made], ["row", out])

    # The other columns travel as one struct, so no name of theirs can clash.
    rows = df.select(F.struct(*[F.col(f"`{n}`") for n in names], F.lit(0).alias("__")).alias("row"), F.col(f"`{html_col}`").cast("string").alias("html"))
    done = rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField(out, T.StringType())]))
    return done.select(*[F.col("row").getField(n).alias(n) for n in names], out)


def labelled_pages(pages: DataFrame, docs: DataFrame, sample: int = 400) -> DataFrame:
    """Pages whose content is known: the url's number names the document that the page shows.

    The sample is that of the smallest hashes of page_id and url, whatever the order of the table.
    """
    numbered = common.mark_rows(pages, "__mark").where("url is not null and html is not null").withColumn("doc_id", F.expr(
        r"try_cast(regexp_extract(url, '/([0-9]+)([/?#]|$)', 1) as bigint)")).where("doc_id is not null")
    # Chosen by numbers alone; pages are fetched for the chosen ones.
    chosen = stage(numbered.select("__mark", F.xxhash64(F.lit(42), "page_id", "url").alias("h")).orderBy("h", "__mark").limit(sample), "chosen-pages")
    some = stage(numbered.join(F.broadcast(chosen.select("__mark")), "__mark", "left_semi").select("html", "doc_id"), "labelled-pages")
    # Only the numbers are broadcast, ``sample`` at most; the texts they pick are joined to the pages after that.
    known = docs.select("doc_id", "text").join(F.broadcast(some.select("doc_id").distinct()), "doc_id")
    return some.join(known, "doc_id").select("html", "text")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = common.table(spark, sf_dir, "pages").select("page_id", "url", "html")
    weights = learn(labelled_pages(pages, common.table(spark, sf_dir, "documents")))
    return extract_text(pages, weights).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
