"""Main text of web pages: rules for what is never the article, and removal of site templates.

A page is read into a tree of elements. Elements that are not the article by their tag, role or the words of their class
and id go at once; what is left of ``article`` elements (else ``main``, else the body) is the page's content. Each block of
the content is then hashed with all it holds (tag and text, from the leaves up). In Spark the hashes are counted for each
host: a subtree that stands on half of a host's different pages, and on ``LEAST_PAGES`` at least, belongs to the site's
template and is deleted from all of them. Pages whose whole content is equal count once, so copies of an article on many
pages are no template, and neither are near copies unless they are half of the host.

A host has few templates (no more than twice the blocks of its mean page), so they travel to the pages as one list a host; the
host of a third of all pages is counted by partial sums, and its pages meet the list in a join that can be split.

Blocks are separated by block elements; inside one, white space (line breaks included) becomes one space. Character
references are decoded. Missing end tags are implied as browsers do; a script or style without an end reaches to the end.

Defined cases: null html is empty; a page without text gives an empty text; pages without a host (null or odd url) have no
template; repeated rows are each extracted; other columns pass through, ``text`` and ``n_chars`` replace columns of that name.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle, sliced, strings, worker_memory

LEAST_PAGES, SHARE = 10, 0.5
TAG = re.compile(r"""<!--(?:.*?-->|.*)|<([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|</([a-zA-Z][^\s/>]*+)[^>]*+>|<[!?/][^>]*+>""", re.S)
LOOSE = re.compile(r"<([a-zA-Z][^\s/>]*+)([^>]*+)>")  # where a quote is never closed
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
WORD = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")
HEAD, PARAGRAPH = frozenset(["head"]), frozenset(["p"])
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
IN_HEAD = frozenset("base link meta noscript script style template title".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCKS = HEADINGS | frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form header hgroup hr html "
    "legend li main menu nav ol optgroup option p pre search section summary table tbody tfoot thead tr ul".split()
)
SPACED = frozenset(["br", "td", "th", "img"])
#: A start tag ends open elements of these kinds, up to the nearest element of the second set.
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "th": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
HOLDERS = frozenset("table td th caption button object body html article main section".split())  # a paragraph outside stays open
GONE = frozenset(
    "applet aside audio button canvas dialog embed footer form head iframe input map menu nav noembed noframes noscript object script search select "
    "style svg template textarea video".split()
)
GONE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
INLINE_WORDS = frozenset("ad ads advert advertisement advertising adverts share sharing social sponsor sponsored".split())  # of elements in a line
GONE_WORDS = frozenset(
    "ad adbox adsense ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies "
    "disclaimer discussion disqus footer login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted "
    "promotion related replies respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split()
)


STAYS, BY_TAG, BY_NAME, HEADER = range(4)


class Element:
    __slots__ = ("tag", "gone", "children", "code")

    def __init__(self, tag: str, gone: int = STAYS):
        self.tag, self.gone, self.children, self.code = tag, gone, [], 0


class Open:
    """The open elements, with what is needed to see at once that a tag has nothing to end."""

    def __init__(self, root: Element):
        self.stack, self.of_tag, self.in_paragraph = [root], Counter([root.tag]), [False]

    def push(self, element: Element) -> None:
        self.stack.append(element)
        self.of_tag[element.tag] += 1
        self.in_paragraph.append(element.tag == "p" or (element.tag not in HOLDERS and self.in_paragraph[-1]))

    def close(self, tags: frozenset[str], holders: frozenset[str] = frozenset()) -> None:
        """End the innermost of ``tags`` and all within it, if none of ``holders`` stands between."""
        if not any(self.of_tag[t] for t in tags):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in tags:
                self.of_tag.subtract(e.tag for e in self.stack[i:])
                del self.stack[i:], self.in_paragraph[i:]
                return
            if self.stack[i].tag in holders:
                return

    def imply(self, tag: str) -> None:
        """End what a start tag ends without saying so."""
        if tag not in IN_HEAD and tag != "head":
            self.close(HEAD)
        if tag in BLOCKS and self.in_paragraph[-1]:
            self.close(PARAGRAPH, HOLDERS)
        if tag in ENDS:
            self.close(*ENDS[tag])


def judge(tag: str, attributes: str) -> tuple[str, int]:
    """The kind of an element (its role may make it an article) and whether it is no part of one, by its tag, role or the
    words of its class and id."""
    if tag in GONE:
        return tag, BY_TAG
    gone = HEADER if tag == "header" else STAYS
    if attributes and tag not in ("html", "body"):
        for name, *values in ATTRIBUTE.findall(attributes):
            words = {w.lower() for w in WORD.findall(next((v for v in values if v), ""))}
            if name.lower() == "role":
                if words & GONE_ROLES:
                    gone = BY_NAME
                tag = next((w for w in ("article", "main") if w in words), tag)
            elif words & (GONE_WORDS if tag in BLOCKS else INLINE_WORDS):
                gone = BY_NAME
            elif "header" in words and tag in BLOCKS and not gone:
                gone = HEADER
    return tag, gone


def parse(source: str) -> Element:
    """Tree of a page. Children are elements and pieces of undecoded text."""
    root = Element("html")
    now = Open(root)
    at, end = 0, len(source)
    while at < end:
        open_at = source.find("<", at)
        if open_at < 0:
            open_at = end
        if open_at > at:
            now.stack[-1].children.append(source[at:open_at])
        if open_at == end:
            break
        found = TAG.match(source, open_at) or LOOSE.match(source, open_at)
        if not found:
            now.stack[-1].children.append("<")
            at = open_at + 1
            continue
        at = found.end()
        if found.re is TAG and found[3]:
            now.close(frozenset([found[3].lower()]))
            continue
        if not found[1]:
            continue
        tag = found[1].lower()
        if tag in ("html", "body"):
            now.close(HEAD)
            continue
        now.imply(tag)
        element = Element(*judge(tag, found[2]))
        now.stack[-1].children.append(element)
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(source, at)
            at = stop.end() if stop else end
            element.gone = BY_TAG
        elif tag not in VOID:
            now.push(element)
    return root


def _elements(element: Element) -> list[Element]:
    return [c for c in element.children if isinstance(c, Element)]


def _tops(root: Element, wanted: str, through: frozenset[int]) -> list[Element]:
    """The outermost wanted elements, below elements that stay or are gone for one of the reasons ``through``."""
    tops, todo = [], [root]
    while todo:
        element = todo.pop()
        if element.tag == wanted and not element.gone:
            tops.append(element)
        elif not element.gone or element.gone in through:
            todo += reversed(_elements(element))
    return tops


def content(root: Element) -> list[Element]:
    """The elements that hold the article: article elements, else main, else (where these stand inside elements with a
    misleading class) any of them, else the body. Of an article's own header the headings stay."""
    tops = next((t for through in (frozenset(), frozenset([BY_NAME, HEADER])) for wanted in ("article", "main") if (t := _tops(root, wanted, through))), None)
    if not tops:
        return [root]
    todo = list(tops)
    while todo:
        element = todo.pop()
        if element.gone == HEADER:
            element.children, element.gone = _headings(element), STAYS
        if not element.gone:
            todo += _elements(element)
    return tops


def _headings(header: Element) -> list[Element]:
    found, todo = [], _elements(header)[::-1]
    while todo:
        element = todo.pop()
        if element.tag in HEADINGS and element.gone in (STAYS, HEADER):
            found.append(element)
        elif not element.gone:
            todo += reversed(_elements(element))
    return found


def hash_blocks(tops: list[Element]) -> list[int]:
    """Give every element its hash; the distinct hashes of the blocks that have text."""
    order, todo = [], list(tops)
    while todo:
        element = todo.pop()
        order.append(element)
        todo += [c for c in element.children if isinstance(c, Element) and not c.gone]
    out = set()
    for element in reversed(order):
        parts, told = [element.tag], False
        for c in element.children:
            if isinstance(c, str):
                piece = " ".join(c.split())
                parts.append(piece)
                told = told or piece != ""
            elif not c.gone and c.code:
                parts.append(str(c.code))
                told = True
        element.code = xxhash.xxh3_64_intdigest("\0".join(parts).encode("utf-8", "surrogatepass")) - 2**63 if told else 0
        if told and element.tag in BLOCKS and element.tag not in HEADINGS:
            out.add(element.code)
    for top in tops:
        out.discard(top.code)
    return sorted(out)


def text_of(tops: list[Element], template: frozenset[int]) -> str:
    """Blocks of the content in page order, without the template's subtrees."""
    blocks: list[str] = []
    now: list[str] = []

    def finish():
        block = " ".join(references.unescape("".join(now)).split())
        if block:
            blocks.append(block)
        now.clear()

    for top in tops:
        todo: list = [top]
        while todo:
            item = todo.pop()
            if isinstance(item, str):
                now.append(item)
            elif item is None:
                finish()
            elif not item.gone and not (item.code in template and item.tag in BLOCKS and item.tag not in HEADINGS):
                block = item.tag in BLOCKS
                if block:
                    finish()
                    todo.append(None)
                elif item.tag in SPACED:
                    now.append(" ")
                todo += reversed(item.children)
        finish()
    return "\n\n".join(blocks)


def host_of(url: Column) -> Column:
    """Lower-case host of an absolute url, else null."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.when(F.length(host) > 0, host)


def site_templates(pages: DataFrame, html: str = "html", url: str = "url", least_pages: int = LEAST_PAGES, share: float = SHARE) -> DataFrame:
    """host and template (hashes of the subtrees that recur on its pages). Settled."""
    rows = pages.select(host_of(F.col(url)).alias("host"), F.col(html).alias("html")).where(F.col("host").isNotNull() & F.col("html").isNotNull())

    def run(batches):
        worker_memory("")
        for batch in sliced(batches, "html"):
            hosts, bodies, codes = [], [], []
            for host, source in zip(batch.column("host").to_pylist(), strings(batch.column("html")), strict=True):
                tops = content(parse(source))
                found = hash_blocks(tops)
                body = xxhash.xxh3_64_intdigest(",".join(str(t.code) for t in tops)) - 2**63
                hosts += [host] * (len(found) + 1)
                bodies += [body] * (len(found) + 1)
                codes += [None, *found]  # the first one counts the page
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(bodies, pa.int64()), pa.array(codes, pa.int64())], names=["host", "body", "code"])

    seen = settle(rows.mapInArrow(run, "host string, body long, code long").distinct().groupBy("host", "code").agg(F.count(F.lit(1)).alias("n")), "subtrees")
    pages_of = seen.where(F.col("code").isNull()).select("host", F.col("n").alias("pages"))
    common = seen.where(F.col("code").isNotNull() & (F.col("n") >= least_pages)).join(pages_of, "host").where(F.col("n") >= share * F.col("pages"))
    return settle(common.groupBy("host").agg(F.collect_list("code").alias("template")), "templates")


def extract_text(pages: DataFrame, html: str = "html", url: str = "url", least_pages: int = LEAST_PAGES, share: float = SHARE) -> DataFrame:
    """The pages with text and n_chars in place of ``html``."""
    templates = site_templates(pages, html, url, least_pages, share)
    keep = [c for c in pages.columns if c not in (html, "text", "n_chars")]
    packed = pages.select(F.struct(*keep).alias("rest"), F.coalesce(F.col(html), F.lit("")).alias("html"), host_of(F.col(url)).alias("host"))
    met = packed.join(templates, "host", "left").select("rest", "html", "template")
    kind = met.schema["rest"].dataType.simpleString()

    def run(batches):
        worker_memory("")
        for batch in sliced(batches, "html"):
            out = []
            for source, template in zip(strings(batch.column("html")), batch.column("template").to_pylist(), strict=True):
                tops = content(parse(source))
                if template:
                    hash_blocks(tops)
                out.append(text_of(tops, frozenset(template or ())))
            yield pa.RecordBatch.from_arrays([batch.column("rest"), pa.array(out, pa.string())], names=["rest", "text"])

    done = met.mapInArrow(run, f"rest {kind}, text string")
    return done.select(*[F.col("rest")[c].alias(c) for c in keep], "text", F.char_length("text").cast("long").alias("n_chars"))
