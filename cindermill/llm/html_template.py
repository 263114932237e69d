"""Main text of web pages by template deduction over the pages of a host.

Pages of a host are put together by layout, a hash of the kinds of containers that they have. Tokens are
tags, told apart by the containers around them, and text nodes. Over all pages of a layout each token has
an occurrence vector, one count per page. Vectors are compared by a sum of page
hashes times counts, which Spark adds up in parts, so no host's pages have to come together. Tokens
with equal vectors form a class; a class is valid if it has several tokens, a tag among them, enough of the pages, and
an order (by mean place; a token met more than once in a page stands for a repeated part). The
largest valid class with one occurrence a page is the template's root: its tags, in order, leave
slots between them, and the other valid classes nest in the slots where they stand. A page is read along the root: what its
slots hold besides the template's own text is the page's, and all of it is extracted, in page order.

Of a slot's text three kinds are no article: text in elements for navigation, forms and the like; text in containers whose class,
id or role names them so; and containers that hold nothing but the template's text, or nothing but several links.
Where a page has article or main elements, only those count, and template text within them stays. A form that holds
the page's structure, and a marked container that holds all article elements, do not count against what is in them, nor does
a mark on an article element itself, unless it is a comment. Where all text would go, the largest of the marked containers stays.

Defined cases: null or empty html, or a page without text, gives an empty text; a layout of one or two pages has no
template text; a null url counts as a host of its own; cut-off pages end where they are cut; end tags may be left out where HTML
allows it; repeated rows are pages like any other.
"""

from __future__ import annotations

import html as entities
import json
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cindermill.llm.common import materialise, texts

#: Elements that hold others, those of which text is never article text, and those of which it is not unless they hold the article.
CONTAINERS = frozenset("html head body header nav main article section aside footer div ul ol dl table td th form fieldset figure blockquote details dialog title noscript svg select button template iframe object canvas label".split())
NEVER = frozenset("head nav button select title noscript template svg iframe object canvas dialog".split())
SELDOM = frozenset("header footer aside form fieldset".split())
#: Elements that begin a block, that have no content, that a head may hold, of which the content is no markup, and that a new block ends.
BLOCKS = frozenset("html head body header nav main article section aside footer div ul ol dl table form fieldset figure blockquote details p h1 h2 h3 h4 h5 h6 li dt dd tr td th caption figcaption pre hr br address summary title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEAD = frozenset("html head base link meta title style script noscript template".split())
RAW = frozenset("script style textarea xmp noembed noframes".split())
SHORT = frozenset("button select label".split())
CELLS = frozenset("td th tr tbody thead tfoot".split())
#: Elements by which a form is seen to hold a page.
STRUCTURE = frozenset("nav header footer main article h1".split())
#: Words in a container's class, id or role that mark boilerplate, those that comments go by, those that mark boilerplate where they
#: are a whole class or id, and words that only tell a state.
BOILERPLATE = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent notice notices alert popup modal overlay sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead related recommended share sharing social newsletter subscribe subscription signup login search pagination pager widget toolbar copyright".split())
COMMENTS = frozenset("comment comments disqus replies respond".split())
ALONE = frozenset("side foot top bottom".split())
AROUND = ("has-", "with-", "no-", "without-")
STATES = ("-open", "-closed", "-on", "-off", "-enabled", "-disabled", "-allowed", "-active", "-visible", "-count")
#: Roles and properties that article elements go by.
ARTICLE_MARKS = frozenset("main article articlebody".split())

# quotes count only behind an equals sign; no part is read twice, so a tag is read in one pass
_TAG = re.compile(r"<!---?>|<!--(?:.*?)(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?>[^>\"'=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[=\"'])*+)>|<[!?/][^>]*+>", re.S)
_OPENS = re.compile(r"<(?:[a-zA-Z!?]|/|\Z)")
_MARKS = re.compile(r"(?:^|\s)(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
#: Tags that tell layouts apart.
LAYOUT = r"<(?:main|article|section|aside|header|footer|nav|div|form|table)(?:\s+(?:class|id)=[\"'][^\"'>]*)?"


def _boilerplate(marks: list[str]) -> tuple[bool, bool]:
    """Whether classes and ids mark boilerplate, and whether comments."""
    words = {w for mark in marks if not mark.startswith(AROUND) and not mark.endswith(STATES) for w in re.split(r"[^a-z]+", mark)}
    return not BOILERPLATE.isdisjoint(words) or not ALONE.isdisjoint(marks), not COMMENTS.isdisjoint(words)


class Page:
    """A page's containers, numbered as they begin, and its tags and texts in order."""

    def __init__(self, html: str):
        # by container: its parent, name, hash of the way to it, whether it is an article element, what speaks against it
        self.parent, self.name, self.path, self.strong, self.never, self.seldom, self.comment = [-1], ["#page"], [0], [False], [False], [False], [False]
        self.structure = [0]
        #: (token, container, begins a block) of tags; (None, container, text, within a link) of texts
        self.nodes: list[tuple] = []
        self.stack, self.open = [0], Counter()
        self._read(html)

    def _push(self, name: str, attributes: str) -> None:
        found = [(m[1].lower(), (m[2] or m[3] or m[4] or "").lower()) for m in _MARKS.finditer(attributes)] if attributes else []
        marks = [word for _, value in found for word in value.split()]
        top = self.stack[-1]
        label = name + re.sub("[0-9]+", "0", " ".join(marks))
        strong = name in ("article", "main") or any(kind in ("role", "itemprop") and value in ARTICLE_MARKS for kind, value in found)
        marked, comment = _boilerplate(marks) if marks and name not in ("html", "body") else (False, False)
        inside = self.within[-1]
        self.parent.append(top)
        self.name.append(name)
        self.path.append(xxhash.xxh64_intdigest(label, self.path[top]))
        self.strong.append(strong)
        self.never.append(name in NEVER)
        self.comment.append(comment)
        self.seldom.append((name in SELDOM and not (name == "header" and inside)) or comment or (marked and not strong))
        self.structure.append(0)
        self.within.append(inside or strong)
        self.open[name] += 1
        self.stack.append(len(self.parent) - 1)

    def _pop(self) -> None:
        self.open[self.name[self.stack.pop()]] -= 1
        self.within.pop()

    def _close(self, name: str) -> None:
        """Ends the innermost open container of that name and those within it."""
        if self.open[name] > 0:
            while self.name[self.stack[-1]] != name:
                self._pop()
            self._pop()

    def _make_room(self, name: str) -> None:
        """Ends what a new element of that name ends without a tag."""
        if name not in HEAD and self.open["head"]:
            self._close("head")
        if name in BLOCKS:
            while self.name[self.stack[-1]] in SHORT:
                self._pop()
        if name in CELLS:
            while self.name[self.stack[-1]] not in ("table", "#page") and self.open["table"]:
                self._pop()

    def _read(self, html: str) -> None:
        self.within = [False]
        at, link, size = 0, 0, len(html)
        while at < size:
            end, found = html.find("<", at), None
            while end >= 0 and not _OPENS.match(html, end):  # a sign like any other
                end = html.find("<", end + 1)
            if end < 0:
                end = size
            else:
                found = _TAG.match(html, end)  # none: the page's end cuts the tag off
            if end > at:
                text = html[at:end]
                if not text.isspace() and self.name[self.stack[-1]] == "head":
                    self._close("head")
                self.nodes.append((None, self.stack[-1], " " if text.isspace() else text, link > 0))
            if not found:
                return
            at = found.end()
            if found[2] is None:
                continue
            name, closing = found[2].lower(), bool(found[1])
            if name in RAW and not closing:
                last = _RAW_END[name].search(html, at)
                at = size if last is None or (close := html.find(">", last.end())) < 0 else close + 1
                continue
            if name == "a":
                link = 0 if closing else 1
            if not closing:
                self._make_room(name)
                if name in STRUCTURE:
                    self.structure[self.stack[-1]] += 1
            elif name in CONTAINERS:
                self._close(name)
            around = self.stack[-1]
            self.nodes.append((xxhash.xxh64_intdigest(("/" if closing else "") + name, self.path[around]), around, name in BLOCKS, False))
            if name in CONTAINERS and not closing and not (found[3].endswith("/") and name == "svg"):
                self._push(name, found[3])

    def tokens(self) -> dict[int, list]:
        """token -> [count, sum of places, whether it is a tag]; a place is the number of tags before."""
        out: dict[int, list] = {}
        place = 0
        for token, container, text, _ in self.nodes:
            if token is None:
                if text.isspace():
                    continue
                token, tag = text_token(self.path[container], text), False
            else:
                place, tag = place + 1, True
            row = out.setdefault(token, [0, 0, tag])
            row[0] += 1
            row[1] += place
        return out

    def _above(self, values: list[int]) -> list[int]:
        """Sums over every container and all within it."""
        for k in range(len(values) - 1, 0, -1):
            values[self.parent[k]] += values[k]
        return values

    def _below(self, own: list[bool]) -> list[bool]:
        """Whether it holds for a container or one around it."""
        for k in range(1, len(own)):
            own[k] = own[k] or own[self.parent[k]]
        return own

    def _sizes(self, chosen) -> list[int]:
        """Characters of the texts that are chosen by (container, text, link), by container."""
        sizes = [0] * len(self.parent)
        for token, container, text, link in self.nodes:
            if token is None and chosen(container, text, link):
                sizes[container] += len(text.strip())
        return self._above(sizes)

    def barred(self) -> tuple[list[bool], list[bool]]:
        """By container: no article text in it; within an article element."""
        never = self._below(list(self.never))
        holds = self._above([int(s and not n) for s, n in zip(self.strong, never)])
        structure = self._above(list(self.structure))
        against = [bad and not (holds[0] and holds[k] == holds[0]) and not (self.name[k] == "form" and structure[k]) for k, bad in enumerate(self.seldom)]
        while True:
            barred = self._below([a or b for a, b in zip(never, against)])
            left = self._sizes(lambda container, text, link: not barred[container])
            if left[0] or not any(against):
                break
            # nothing is left: the largest of the outermost of them stays, comments last
            whole = self._sizes(lambda container, text, link: not never[container])
            outer = [k for k in range(len(against)) if against[k] and not barred[self.parent[k]]]
            best = max(outer, key=lambda k: (not self.comment[k], whole[k], -k), default=None)
            if best is None or not whole[best]:
                break
            against[best] = False
        inside = self._below([s and not b for s, b in zip(self.strong, barred)])
        return barred, inside

    def blocks(self, template: dict) -> list[list[str]]:
        """The article's texts by block."""
        barred, inside = self.barred()
        held = self._sizes(lambda container, text, link: inside[container] and not barred[container])[0]
        out: list[list[str]] = [[]]
        if held:
            for token, container, text, _ in self.nodes:
                if token is not None:
                    if text:
                        out.append([])
                elif inside[container] and not barred[container]:
                    out[-1].append(text)
            return out
        own = self.own_texts(template)
        fresh = [0] * len(self.parent)
        plain, links, size = [0] * len(self.parent), [0] * len(self.parent), [0] * len(self.parent)
        for (token, container, text, link), mine in zip(self.nodes, own):
            if token is None and not barred[container] and not text.isspace():
                fresh[container] += mine
                size[container] += 1
                plain[container] += not link and any(c.isalnum() for c in text)
                links[container] += link
        fresh, plain, links, size = map(self._above, (fresh, plain, links, size))
        # containers of template text or of links alone, unless there is nothing else
        constant = [k > 0 and size[k] > 0 and not fresh[k] for k in range(len(fresh))] if fresh[0] else [False] * len(fresh)
        menus = [k > 0 and links[k] > 1 and not plain[k] for k in range(len(fresh))] if plain[0] else [False] * len(fresh)
        left_out = self._below([a or b for a, b in zip(constant, menus)])
        for token, container, text, _ in self.nodes:
            if token is not None:
                if text:
                    out.append([])
            elif not barred[container] and not left_out[container]:
                out[-1].append(text)
        return out

    def own_texts(self, template: dict) -> list[int]:
        """By node: 1 for a text that is not the template's in the slot where it stands."""
        numbers = {token: i for i, token in enumerate(template["root"])}
        texts_of = {int(k): set(marks) for k, marks in template["text"].items()}
        at, out = -1, []
        for token, container, text, _ in self.nodes:
            if token is not None:
                at = numbers.get(token, at)
                out.append(0)
            else:
                out.append(int(not text.isspace() and text_token(self.path[container], text) not in texts_of.get(at, ())))
        return out


def text_token(path: int, text: str) -> int:
    return xxhash.xxh64_intdigest("#" + " ".join(text.split()), path)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


TOKENS = "host string, token long, tag boolean, pages long, total long, vector long, places double"
ENTRIES = 100_000


def token_table(pages: DataFrame) -> DataFrame:
    """Per host and token: pages with it, occurrences, signature of its occurrence vector, places; a null token has the host's pages."""
    kinds = (pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64())

    def rows(sums: dict) -> pa.RecordBatch:
        made = [(host, None if token is None else _signed(token), tag, n, total, _signed(vector), places) for (host, token), (n, total, vector, places, tag) in sums.items()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*made)) or [()] * 7, kinds)], names=["host", "token", "tag", "pages", "total", "vector", "places"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int | None], list] = {}
        for batch in batches:
            for host, html in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
                mark = xxhash.xxh64_intdigest(html) | 1
                for token, (n, places, tag) in [*Page(html).tokens().items(), (None, (1, 0, True))]:
                    row = sums.setdefault((host, token), [0, 0, 0, 0.0, tag])
                    row[0] += 1
                    row[1] += n
                    row[2] = (row[2] + mark * n) & 0xFFFFFFFFFFFFFFFF
                    row[3] += places / n
                if len(sums) >= ENTRIES:
                    yield rows(sums)
                    sums = {}
        yield rows(sums)

    parts = pages.select("host", "html").mapInArrow(run, TOKENS)
    # signatures are added modulo 2**64 in two halves, which cannot overflow
    low, high = F.col("vector").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("vector", 32)
    return parts.groupBy("host", "token", "tag").agg(F.sum("pages").alias("pages"), F.sum("total").alias("total"), F.sum(low).alias("low"), F.sum(high).alias("high"), F.sum("places").alias("places")).withColumn("vector", F.concat_ws(":", F.pmod("low", F.lit(1 << 32)), F.pmod(F.col("high") + F.shiftright("low", 32), F.lit(1 << 32)))).drop("low", "high")


def deduce(rows: list[dict], pages: int) -> dict:
    """Template of one layout from its tokens: the root's tags in order, and the template's texts by slot."""
    if pages < 3:
        return {"root": [], "text": {}}
    classes: dict[tuple, list[dict]] = {}
    for row in rows:
        classes.setdefault((row["pages"], row["total"], row["vector"]), []).append(row)
    order = lambda row: row["places"] / row["pages"]
    valid = {key: members for key, members in classes.items() if len(members) > 1 and any(m["tag"] for m in members)}
    single = [key for key in valid if key[0] == key[1]]
    if not single:
        return {"root": [], "text": {}}
    top = max(single, key=lambda key: (sum(m["tag"] for m in valid[key]), key[0], key[2]))
    root = sorted((m for m in valid[top] if m["tag"]), key=lambda m: (order(m), m["token"]))
    begins, nested = [order(m) for m in root], {}
    for key, members in valid.items():
        for m in members:
            if not m["tag"]:
                nested.setdefault(bisect_right(begins, order(m)) - 1, set()).add(m["token"] & 0xFFFFFFFFFFFFFFFF)
    return {"root": [m["token"] & 0xFFFFFFFFFFFFFFFF for m in root], "text": {str(at): sorted(found) for at, found in nested.items()}}


def templates(pages: DataFrame, support: float = 0.5) -> DataFrame:
    """host, template (JSON) for every value of host, which here stands for a layout of a host."""
    tokens = materialise(token_table(pages))
    hosts = tokens.where("token IS NULL").select("host", F.col("pages").alias("n"))
    # tokens on half of the pages are no more than twice those of a page
    frequent = tokens.where("token IS NOT NULL").join(hosts, "host").where(F.col("pages") >= support * F.col("n"))

    def build(group: pa.Table) -> pa.Table:
        host, n = group.column("host")[0].as_py(), group.column("n")[0].as_py()
        return pa.table({"host": pa.array([host]), "template": pa.array([json.dumps(deduce(group.to_pylist(), n))])})

    return frequent.groupBy("host").applyInArrow(build, "host string, template string")


NO_TEMPLATE = {"root": [], "text": {}}


def extract(html: str, template: dict | None) -> str:
    """The main text of one page."""
    blocks = Page(html).blocks(template or NO_TEMPLATE)
    lines = (" ".join(entities.unescape("".join(b)).split()) for b in blocks)
    return "\n".join(line for line in lines if line)


#: Parts into which the pages of a layout are dealt when they meet its template.
DEALT = 8


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for rows with page_id, url and html."""
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit("")))
    layout = F.array_sort(F.array_distinct(F.regexp_extract_all(F.regexp_replace(F.coalesce(F.col("html"), F.lit("")), "[0-9]+", "0"), F.lit(LAYOUT), F.lit(0))))
    rows = pages.select("page_id", "url", "html", F.concat_ws(" ", host, F.hex(F.xxhash64(layout))).alias("host"))
    made = materialise(templates(rows)).select("*", F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1))).alias("part"))
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("page_id", "html"), F.lit(DEALT)).cast("int"))
    joined = dealt.join(made, ["host", "part"], "left").select("page_id", "url", "html", "template")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str | None, dict | None] = {None: None}
        for batch in batches:
            out = []
            for html, template in zip(texts(batch.column(2)), batch.column(3).to_pylist()):
                if template not in known:
                    if len(known) > 1000:
                        known = {None: None}
                    known[template] = json.loads(template)
                out.append(extract(html, known[template]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")
