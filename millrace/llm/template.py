"""Main text of web pages: site templates are element subtrees that recur across a host's pages."""

from __future__ import annotations

import re
from collections import Counter
from functools import reduce
from html import unescape
from operator import xor

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import query, stage, table

# Elements by role.
RAW = ("script", "style", "title", "textarea", "noscript", "template", "iframe", "svg", "math", "select")
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption",
    "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "html", "li", "main", "menu", "nav", "ol", "p", "pre",
    "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
PROSE = {"h1", "h2", "h3", "h4", "h5", "h6", "p", "blockquote", "pre"}
# Fixed value: the elements that make the frame of a page.
FRAME = {"html", "body", "div", "section", "header", "footer", "nav", "aside", "main", "article", "form", "center", "table", "ul", "ol"}
NOT_TEXT = {"head", "nav", "footer", "aside", "form", "dialog", "menu", "button"}
# Words in class, id and role that name what is not the article.
ROLES = {
    "ad", "ads", "advert", "advertisement", "adverts", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "complementary", "consent", "contentinfo",
    "cookie", "cookies", "disqus", "footer", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "popup", "promo", "promoted",
    "related", "replies", "search", "share", "sharing", "sidebar", "skip", "social", "sponsor", "sponsored", "subscribe", "teaser", "toolbar", "widget",
}
# Words that name no content, so that a name made of them and a role is still that role's.
PLAIN_WORDS = {
    "area", "articles", "bar", "block", "bottom", "box", "btn", "button", "buttons", "container", "content", "form", "global", "header", "icons", "inner", "item", "items",
    "left", "link", "links", "list", "main", "media", "outer", "page", "panel", "posts", "primary", "reader", "right", "secondary", "section", "side", "site", "stories", "to",
    "top", "user", "wrap", "wrapper",
}
_NAME = r"(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)"
_TAG = re.compile(rf"<{_NAME}(?P<attrs>(?:\"[^\"]*+\"|'[^']*+'|[^'\">])*+)>")
_TORN_TAG = re.compile(rf"<{_NAME}(?P<attrs>[^>]*+)>")
_RAW_END = {t: re.compile(rf"</{t}\s*+>", re.I) for t in RAW}
_ATTR = re.compile(r"([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>][^\s>]*+)))?", re.S)


def tokens(html: str):
    """(start, end, tag, is end tag, attributes) of all markup in order; comments, declarations and raw elements have tag None.

    Reads every character a bounded number of times: after the first tag whose quotes do not close before the
    page ends, tags end at the next ``>``, whatever the quotes.
    """
    at, last, tag_at = 0, html.rfind(">"), _TAG.match
    while (i := html.find("<", at)) >= 0:
        if html.startswith("<!--", i):
            end = html.find("-->", i + 4)
            at = len(html) if end < 0 else end + 3
            yield i, at, None, False, ""
        elif i > last:
            return
        elif html.startswith(("<!", "<?"), i):
            at = html.find(">", i) + 1
            yield i, at, None, False, ""
        else:
            m = tag_at(html, i)
            if m is None and tag_at == _TAG.match and (html[i + 1 : i + 2].isalpha() or html[i + 1 : i + 2] == "/") and (m := _TORN_TAG.match(html, i)):
                tag_at = _TORN_TAG.match
            at = i + 1
            if m is None:
                continue
            at, tag = m.end(), m["tag"].lower()
            if m["end"] or tag not in _RAW_END:
                yield i, at, tag, bool(m["end"]), m["attrs"]
                continue
            if not (tag in ("svg", "math") and m["attrs"].endswith("/")):
                found = _RAW_END[tag].search(html, at)
                at = found.end() if found else len(html)
            yield i, at, None, False, ""


class Node:
    __slots__ = ("drop", "hash", "kind", "parts", "tag")

    def __init__(self, tag: str, drop: bool = False, kind: str = ""):
        self.tag, self.drop, self.kind, self.parts, self.hash = tag, drop, kind, [], 0

    def close(self) -> None:
        """The subtree's hash: its tag, and the words and subtrees in it, in order."""
        words = "\x00".join(p if isinstance(p, str) else f"\x01{p.hash:x}" for p in self.parts)
        self.hash = xxhash.xxh3_64_intdigest(f"{self.tag}\x02{' '.join(words.split())}") >> 1


def _names_role(word: str) -> bool:
    """A role's own name, or roles and words without content joined by hyphens."""
    pieces = re.split(r"[-_]+", word)
    return word in ROLES or (any(p in ROLES for p in pieces) and all(p in ROLES or p in PLAIN_WORDS or p.isdigit() for p in pieces))


def _named_apart(tag: str, attrs: str) -> bool:
    """Does class, id or role name a part of a page that is not its article?

    Prose is only what a whole class or role calls so: ids of headings are made from their text.
    """
    for name, *values in _ATTR.findall(attrs):
        name, value = name.lower(), next((v for v in values if v), "").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return tag not in ("html", "body")
        if name not in ("class", "id", "role") or (name == "id" and tag in PROSE):
            continue
        for word in value.split():
            if (word in ROLES if tag in PROSE else _names_role(word) or word == "header"):
                return tag not in ("html", "body", "main")
    return False


def _classes(attrs: str) -> str:
    """The classes of an element in order of name, numbers left out."""
    value = next((v for name, *values in _ATTR.findall(attrs) if name.lower() == "class" for v in values if v), "")
    return " ".join(sorted({re.sub(r"\d+", "0", w) for w in value.lower().split()}))


def parse(html: str) -> list[Node]:
    """All elements of a page in document order of their ends, the root last.

    Inline elements leave no node unless they are named apart, and all inside a dropped element is dropped. A paragraph ends where a block
    starts, an end tag closes all that is open inside it, and an unknown end tag is ignored.
    """
    root = Node("#root")
    stack, done, place, opened = [root], [], 0, Counter()

    def close():
        node = stack.pop()
        opened[node.tag] -= 1
        node.close()
        done.append(node)

    for start, end, tag, ends, attrs in tokens(html):
        if start > place:
            stack[-1].parts.append(unescape(html[place:start]))
        place = end
        if tag is None:
            continue
        if ends:
            if opened[tag] > 0:
                while stack[-1].tag != tag:
                    close()
                close()
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                stack[-1].parts.append(" ")
            continue
        apart = tag in NOT_TEXT or (tag == "header" and not opened["article"]) or _named_apart(tag, attrs)
        if tag not in BLOCKS and not apart:
            continue
        if tag in BLOCKS:
            while stack[-1].tag in PROSE and stack[-1].tag != "blockquote" or (tag == "li" and stack[-1].tag == "li"):
                close()
        node = Node(tag, apart or stack[-1].drop, _classes(attrs) if tag in FRAME else "")
        stack[-1].parts.append(node)
        opened[tag] += 1
        stack.append(node)
    if place < len(html):
        stack[-1].parts.append(unescape(html[place:]))
    while stack:
        close()
    return done


def _length(node: Node, without: str = "") -> int:
    """Characters of text under a node that is not dropped, outside of elements ``without``."""
    total, work = 0, [node]
    while work:
        for p in work.pop().parts:
            if isinstance(p, str):
                total += len("".join(p.split()))
            elif not p.drop and p.tag != without:
                work.append(p)
    return total


def marked_by(nodes: list[Node]) -> str | None:
    """Which element marks the article: the main part, or articles inside it that hold the larger part of its text; without one, any article."""
    there = {t: [n for n in nodes if n.tag == t and not n.drop] for t in ("article", "main")}
    if there["main"]:
        whole, own = (sum(_length(n, w) for n in there["main"]) for w in ("", "article"))
        return "article" if whole > 2 * own and not any(_outside(there["main"], a) for a in there["article"]) else "main"
    return "article" if there["article"] else None


def _outside(mains: list[Node], article: Node) -> bool:
    work = list(mains)
    while work:
        for p in work.pop().parts:
            if p is article:
                return False
            if not isinstance(p, str):
                work.append(p)
    return True


def _holders(nodes: list[Node], mark: str) -> list[Node]:
    """The outermost marked elements in page order."""
    found, work = [], [nodes[-1]]
    while work:
        node = work.pop()
        if node.tag == mark and not node.drop:
            found.append(node)
        else:
            work.extend(p for p in reversed(node.parts) if not isinstance(p, str) and not p.drop)
    return found


def article_places(nodes: list[Node], mark: str):
    """(node, its hashes with its place counted from the start and from the end) of the parts of marked elements.

    Parts of divisions and sections right inside count too; items of lists and rows of tables do not.
    """
    for level in (0, 1):
        holders = _holders(nodes, mark)
        for holder in holders if level == 0 else [p for h in holders for p in h.parts if not isinstance(p, str) and not p.drop and p.tag in ("article", "div", "section")]:
            parts = [p for p in holder.parts if not isinstance(p, str) and not p.drop and p.parts]
            for i, part in enumerate(parts):
                yield part, [xxhash.xxh3_64_intdigest(f"{level}{holder.tag}{sign}{n}:{part.hash}") >> 1 for sign, n in (("+", i), ("-", len(parts) - i))]


def layout(nodes: list[Node], depth: int = 5) -> int:
    """Hash of the distinct paths of tags and classes in the frame of a page, without the parts named apart."""
    paths, work = set(), [(nodes[-1], "", 0)]
    while work:
        node, path, level = work.pop()
        for p in node.parts:
            if not isinstance(p, str) and p.tag in FRAME and not p.drop:
                paths.add(here := f"{path}>{p.tag}.{p.kind}")
                if level + 1 < depth:
                    work.append((p, here, level + 1))
    return xxhash.xxh3_64_intdigest("\n".join(sorted(paths))) >> 1


def main_text(html: str | None, templates=frozenset(), most: float = 0.5) -> str:
    """Text of the article: blocks in page order, joined by one space.

    Where a page marks its article, only that counts, without the parts named apart; ``templates`` are then parts with their places
    in articles (see :func:`article_places`). They go unless they hold more than the share ``most`` of the article's text: such pages
    are copies of each other. Pages without a mark lose the parts named apart and the subtrees in ``templates``.
    """
    if not html:
        return ""
    nodes = parse(html)
    marked = marked_by(nodes)
    gone = set()
    if marked and templates:
        found = [n for n, places in article_places(nodes, marked) if any(p in templates for p in places)]
        if sum(map(_length, found)) <= most * sum(map(_length, _holders(nodes, marked))):
            gone = {id(n) for n in found}
    blocks, line = [], []

    def end_block():
        text = " ".join("".join(line).split())
        if text:
            blocks.append(text)
        line.clear()

    work = [(nodes[-1], marked is None)]
    while work:
        item, inside = work.pop()
        if item is None:
            end_block()
        elif isinstance(item, str):
            if inside:
                line.append(item)
        elif not item.drop and (id(item) not in gone if marked else item.hash not in templates):
            inside = inside or item.tag == marked
            end_block()
            work.append((None, inside))
            work.extend((p, inside) for p in reversed(item.parts))
        elif item.tag in BLOCKS:
            end_block()
    end_block()
    return " ".join(blocks)


def _parts(nodes: list[Node], section: str | None) -> list[str]:
    """The groups of a host's pages that a page is in: its section (if its path has one) and its layout."""
    return ([] if section is None else [f"/{section}"]) + [f"#{layout(nodes):x}"]


def _subtrees(batches):
    """(host, part, subtree, page), the whole host as part ``''`` with page 0; a null subtree counts the page itself.

    Articles are part ``@``: their parts with their places, and as page the article without this part, so that
    copies of an article count once.
    """
    for batch in batches:
        out = []
        for host, section, html in zip(*(batch.column(c).to_pylist() for c in ("host", "section", "html")), strict=True):
            nodes = parse(html or "")
            mark = marked_by(nodes)
            if mark:
                whole = reduce(xor, {n.hash for h in _holders(nodes, mark) for n in [h, *(p for p in h.parts if not isinstance(p, str))]}, 0)
                rest = {place: whole ^ n.hash for n, places in article_places(nodes, mark) for place in places}
                own = reduce(xor, {n.hash for h in _holders(nodes, mark) for n in h.parts if not isinstance(n, str)}, 0)
                out += [(host, "@", None, own)] + [(host, "@", place, page) for place, page in rest.items()]
                continue
            found = {None} | {n.hash for n in nodes if n.tag not in ("#root", "html", "body") and n.parts}
            for part, page in [("", 0)] + [(p, nodes[-1].hash) for p in _parts(nodes, section)]:
                out += [(host, part, h, page) for h in found]
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
        columns = zip(*out, strict=True) if out else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["host", "part", "subtree", "page"])


def _layouts(batches):
    """Pages with the key of their layout, ``@`` where the article is marked."""
    for batch in batches:
        found = []
        for html in batch.column("html").to_pylist():
            nodes = parse(html or "")
            found.append("@" if marked_by(nodes) else _parts(nodes, None)[-1])
        yield batch.append_column("layout", pa.array(found, pa.string()))


def _extract(batches):
    for batch in batches:
        texts = [main_text(h, frozenset(t or ())) for h, t in zip(batch.column("html").to_pylist(), batch.column("templates").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def host_of(url):
    return F.lower(F.nullif(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def section_of(url):
    """The first directory of a URL's path, null where the path has none."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)/", 1)
    return F.nullif(path, F.lit(""))


def templates(pages: DataFrame, least_pages: int = 5, share: float = 0.3, many_pages: int = 30, article_share: float = 0.5) -> DataFrame:
    """(host, part, templates): hashes of the subtrees that recur across the pages of a host.

    Part ``@`` are the parts of marked articles at their place, counted from the start or the end: those on at least
    ``article_share`` of the host's different articles, which must differ besides, and on ``least_pages`` of them. A word that many
    articles hold in different places stays. The other parts are for pages that mark no article: ``''`` is the whole host: subtrees on at least ``share`` of its pages, and on ``least_pages``. As a large
    host mixes layouts, the same share is asked of the pages of each layout and of each section (first directory of the
    path); there copies of a page count once, and ``many_pages`` must have the subtree, whatever the size of the host.

    A page can hold so many such subtrees only that a part's list is bounded by the size of its pages.
    """
    url = F.col("url")
    rows = pages.select(host_of(url).alias("host"), section_of(url).alias("section"), F.col("html").cast("string").alias("html")).where("host is not null")
    found = rows.mapInArrow(_subtrees, "host string, part string, subtree long, page long").groupBy("host", "part", "subtree", "page").agg(F.count(F.lit(1)).alias("n"))
    least = F.when(F.col("part").isin("", "@"), least_pages).otherwise(max(least_pages, many_pages))
    counted = found.groupBy("host", "part", "subtree").agg(F.sum(F.when(F.col("part") == "", F.col("n")).otherwise(1)).alias("n")).where(F.col("n") >= least)
    counted = stage(counted, "page-subtrees")
    sizes = counted.where("subtree is null").select("host", "part", F.col("n").alias("pages"))
    common = counted.where("subtree is not null").join(sizes, ["host", "part"]).where(F.col("n") >= F.col("pages") * F.when(F.col("part") == "@", article_share).otherwise(share))
    return common.groupBy("host", "part").agg(F.array_sort(F.collect_list("subtree")).alias("templates"))


def extract(pages: DataFrame, broadcast_rows: int = 200_000, **options) -> DataFrame:
    """(page_id, url, text, n_chars), a row per page.

    Element subtrees are hashed, counted per host, section and layout in Spark, and deleted where they recur; see :func:`main_text`.
    The template lists are broadcast while the groups of pages that have any number at most ``broadcast_rows``.

    Defined cases: null or empty html gives an empty text; a null url, or one without host, has no
    templates; repeated pages are pages of their own; null ids are carried along; other columns are ignored.
    """
    known = stage(templates(pages, **options), "page-templates")
    side = F.broadcast(known) if known.count() <= broadcast_rows else known
    kinds, url = dict(pages.dtypes), F.col("url")
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), host_of(url).alias("host"), F.concat(F.lit("/"), section_of(url)).alias("section"))
    rows = rows.mapInArrow(_layouts, f"page_id {kinds['page_id']}, url {kinds['url']}, html string, host string, section string, layout string")
    lists = F.array().cast("array<bigint>")
    marked = F.col("layout") == "@"
    for key in (F.lit(""), F.col("section"), F.col("layout")):
        one = side.select(F.col("host").alias("h"), F.col("part").alias("p"), F.col("templates").alias("more"))
        rows = rows.withColumn("key", F.when(marked, F.when(key == "@", key)).otherwise(key)).join(one, (F.col("host") == F.col("h")) & (F.col("key") == F.col("p")), "left").drop("h", "p", "key")
        rows = rows.withColumn("templates", F.concat(lists, F.coalesce("more", F.array().cast("array<bigint>")))).drop("more")
        lists = F.col("templates")
    out = rows.mapInArrow(_extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
    return out.withColumn("n_chars", F.char_length("text").cast("long"))


@query("op2_template_removal")
def op2(spark, folder):
    return extract(table(spark, folder, "pages", "page_id", "url", "html"))
