"""Main text of web pages by template deduction: equivalence classes of tokens over a host's pages.

Pages of a host share a template.  A page is read as a tree of tokens: elements, each told apart from others of its
name by its place among them at every level (so an opening and its end are one token), and runs of text.

1. Classes: tokens that occur on the same pages of a host, equally often, have one occurrence vector and are an
   equivalence class.  A vector isn't gathered: its fingerprint, the sum over pages of count x hash(page), is, so a host
   with a third of all pages costs no task more than its distinct tokens.  Classes on fewer than LEAST_PAGES
   pages, or than LEAST_SHARE of the host's, are no template.
2. Validity: on every page the tokens of a class must stand in the same order, and each in the same token of a class
   around it; tokens that don't are taken out.
3. Nesting: valid tokens form the template, a tree, by what encloses them.  What stands between them is slots.
4. The main slot is chosen by content, over all of the host's pages: from the whole page down, the element that
   holds at least MAIN_SHARE of the text that is neither template nor links, as long as it holds blocks of its own
   and no other block element beside it holds a fair part; headings (h1) are not left behind.
5. A page's text is what stands in the main element without the template's own text, link lists among its slots, and
   what tag names and roles mark as menu, header, footer, sidebar, notice, advert, form, comment, script or style.

Names are hints only: they take such parts out, and an article or main element inside the main slot narrows it; on
pages without them the template alone decides.  A page whose host has no template (too few pages) or that lacks the
main element is read by its hints.  Pages with the same text outside marked parts, copies of one article, count once.

Blocks: block elements and template cuts end a block; white space inside one becomes one space; blocks
are joined by two line feeds.

Edge cases: a null or empty page has the empty text; a page without a host, or alone on its host, has no
template but the tags' own meaning; unclosed elements end with what encloses them; a tag that never ends takes the
rest of the page, as in browsers; time grows in proportion to a page, however it is nested or broken; references are decoded, once;
rows are independent, so repeated ones give repeated results; extra columns are not read; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm.scratch import Scratch
from readloom.llm.tables import table

#: Pages of a host, of different texts, that a class must be on, and their least share; the least share for text.
LEAST_PAGES, LEAST_SHARE, TEXT_SHARE = 3, 0.5, 0.9
#: Of an element's text, the share that the main one inside it holds; what other blocks may hold beside it.
MAIN_SHARE, BESIDE = 0.5, 0.25

_token = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:\"[^\"]*+\"|'[^']*+'|[^'\">])*+)>|[^<]+|<", re.DOTALL)
_begins_tag = re.compile(r"</?[a-zA-Z]")
_role = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_space = re.compile(r"\s+")
_digits = re.compile(r"\d+")
#: Elements by what they mean: those whose content is no text, page furniture, blocks, and those without content.
RAW = {"script", "style", "noscript", "template", "svg", "iframe", "object", "textarea", "title"}
FURNITURE = {"nav", "header", "footer", "aside", "form", "menu", "button", "select", "dialog", "head", "fieldset", "label", "input"}
BLOCKS = {"p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "dl", "dt", "dd", "blockquote", "pre", "section", "article", "main", "table", "tr", "td", "th", "thead", "tbody", "tfoot", "caption", "figure", "figcaption", "address", "details", "summary", "hr", "body", "html", "center"} | {"nav", "header", "footer", "aside", "form", "menu", "dialog", "fieldset"}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var"}
HOLDERS = {"article", "main"}
ROLES = re.compile(r"(?:^|[\s_-])(?:nav|navigation|navbar|menu|menus|header|footer|sidebar|side|aside|cookie|cookies|consent|notice|notices|banner|ad|ads|advert|adverts|advertisement|sponsor|sponsored|promo|popup|modal|newsletter|subscribe|signup|login|share|social|related|breadcrumb|breadcrumbs|comment|comments|respond|reply|replies|disqus|widget|toolbar|pagination|search|alert|contentinfo|complementary)(?:$|[\s_-])", re.IGNORECASE)
#: Elements that no role turns into furniture, and those that end an open paragraph.
_plain = HOLDERS | {"body", "html", "h1", "b", "i", "em", "strong"}
_ends_p = BLOCKS - {"body", "html"}
#: What a token is: text, a block element, inside a link, inside marked furniture, a main heading, an article or main element.
TEXT, BLOCK, LINK, MARKED, HEADING, HOLDER = 1, 2, 4, 8, 16, 32


def furniture(name: str, role: str) -> bool:
    return name in RAW or name in FURNITURE or bool(role and name not in _plain and ROLES.search(role))


def code_of(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


@lru_cache(maxsize=65_536)
def element(name: str, attributes: str) -> tuple[str, int, int, int]:
    """Label, its code, the kind that content inherits, and the element's own kind."""
    role = " ".join([x for y in _role.findall(attributes) for x in y if x]) if attributes else ""
    label = f"{name}.{_digits.sub('0', role)}" if role else name
    held = (LINK if name == "a" else 0) | (MARKED if furniture(name, role) else 0)
    return label, code_of(label), held, (BLOCK if name in BLOCKS else 0) | (HEADING if name == "h1" else 0) | (HOLDER if name in HOLDERS else 0)


def tidy(text: str) -> str:
    return _space.sub(" ", html.unescape(text)).strip()


class Page:
    """A page's tokens in order: key, parent's number, kind, text, its length when tidy, and the number of its block.

    A key is the hash of a tuple of integers, which no process salts: the parent's key, the label's code and the place
    among the parent's elements of that label; of a text, the codes of the labels around it and its own.
    """

    def __init__(self, source: str):
        self.keys: list[int] = []
        self.parents: list[int] = []
        self.kinds: list[int] = []
        self.texts: list[str] = []
        self.sizes: list[int] = []
        self.blocks: list[int] = []
        #: Open elements: name, number of the token, kind that its content inherits, key without places, and where
        #: the nearest element that isn't inline stands; how many of each name are open.
        stack: list[tuple[str, int, int, int, int]] = [("", -1, 0, 0, 0)]
        opened: Counter = Counter()
        places: list[dict[int, int]] = [{}]
        block = 0
        skip = None
        for m in _token.finditer(source):
            closing, name, attributes = m.group(1), m.group(2), m.group(3)
            if name is None:
                text = m.group()
                if text == "<" and _begins_tag.match(source, m.start()):
                    break
                if not skip and not text.startswith(("<!", "<?")):
                    self._add(stack[-1], text, block)
                continue
            name = name.lower()
            if skip:
                if closing and name == skip:
                    skip = None
                continue
            if closing:
                if name in BLOCKS:
                    block += 1
                while opened[name]:
                    places.pop()
                    gone = stack.pop()[0]
                    opened[gone] -= 1
                    if gone == name:
                        break
                continue
            if name in BLOCKS:
                block += 1
                if name in _ends_p:
                    # A block ends an open paragraph and the inline elements left open in it.
                    at = stack[-1][4]
                    if stack[at][0] == "p":
                        opened.subtract(s[0] for s in stack[at:])
                        del stack[at:], places[at:]
            if name in VOID or attributes.rstrip().endswith("/"):
                if name == "br":
                    self._add(stack[-1], " ", block)
                continue
            if name in RAW:
                skip = name
                continue
            _, code, held, kind = element(name, attributes)
            place = places[-1][code] = places[-1].get(code, 0) + 1
            _, parent, inherited, path, base = stack[-1]
            held |= inherited
            self.keys.append(hash((self.keys[parent] if parent >= 0 else 0, code, place)))
            self.parents.append(parent)
            self.kinds.append(held | kind)
            self.texts.append("")
            self.sizes.append(0)
            self.blocks.append(block)
            stack.append((name, len(self.keys) - 1, held, hash((path, code)), base if name in INLINE else len(stack)))
            opened[name] += 1
            places.append({})

    def _add(self, within: tuple[str, int, int, int, int], text: str, block: int) -> None:
        _, parent, inherited, path, _ = within
        clean = tidy(text)
        self.keys.append(hash((path, code_of(clean), 1)) if clean else 0)
        self.parents.append(parent)
        self.kinds.append(TEXT | inherited)
        self.texts.append(text)
        self.sizes.append(len(clean))
        self.blocks.append(block)

    def body(self) -> int:
        """A hash of the text outside marked parts; 0 for a page without tokens."""
        runs = sorted(k for k, kind in zip(self.keys, self.kinds) if k and kind & TEXT and not kind & MARKED)
        return hash(tuple(runs)) if self.keys else 0

    def main_text(self, main: int | None = None, own: frozenset | set = frozenset(), lists: frozenset | set = frozenset()) -> str:
        """The text in the template's main element, without the template's own text and its lists of links."""
        inside: list[int] = []  # per token: 0 outside, 1 inside the main element, 2 inside an article in it, -1 left out
        found = main is not None and main in self.keys
        for key, parent, kind in zip(self.keys, self.parents, self.kinds):
            at = inside[parent] if parent >= 0 else int(not found)
            if at >= 0:
                if kind & MARKED or key in lists:
                    at = -1
                elif not kind & TEXT:
                    at = 2 if at and kind & HOLDER else max(at, int(key == main))
            inside.append(at)
        level = 2 if any(at == 2 for at, kind in zip(inside, self.kinds) if not kind & TEXT) else 1
        out: list[str] = []
        parts: list[str] = []
        last = None
        for at, key, kind, text, block in zip(inside, self.keys, self.kinds, self.texts, self.blocks):
            if block != last:
                if clean := tidy("".join(parts)):
                    out.append(clean)
                parts.clear()
                last = block
            if kind & TEXT and at >= level and not (at < 2 and key in own):
                parts.append(text)
        if clean := tidy("".join(parts)):
            out.append(clean)
        return "\n\n".join(out)


_TREE = "host string, body long, keys array<long>, parents array<int>, kinds array<int>, sizes array<int>"


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            page = Page(source or "")
            if page.keys:
                rows.append((host, page.body(), page.keys, page.parents, page.kinds, page.sizes))
        types = [pa.string(), pa.int64(), pa.list_(pa.int64()), *[pa.list_(pa.int32())] * 3]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["host", "body", "keys", "parents", "kinds", "sizes"])


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch, host and token: pages, smallest and largest count on a page, and the vector's fingerprint."""
    for batch in batches:
        sums: dict[tuple[str, int], list[int]] = {}
        for host, body, keys, kinds in zip(*(batch.column(c).to_pylist() for c in ("host", "body", "keys", "kinds"))):
            mark = body & 0xFFFFFFFF
            kind_of = dict(zip(keys, kinds))
            for key, n in Counter(keys).items():
                s = sums.get((host, key))
                if s is None:
                    if key:
                        sums[host, key] = [1, n, n, n * mark, kind_of[key] & TEXT > 0]
                    continue
                s[0] += 1
                if n < s[1]:
                    s[1] = n
                elif n > s[2]:
                    s[2] = n
                s[3] = (s[3] + n * mark) & 0x3FFFFFFFFFFF
        ids = list(sums)
        columns = [[h for h, _ in ids], [k for _, k in ids], *[[sums[x][i] for x in ids] for i in range(5)]]
        types = [pa.string(), *[pa.int64()] * 5, pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["host", "key", "pages", "low", "high", "mark", "is_text"])


_PLACES = {"host": pa.string(), "key": pa.int64(), "mark": pa.int64(), "rank_low": pa.int64(), "rank_high": pa.int64(), "in_low": pa.int64(), "in_high": pa.int64(), "kind": pa.int64(), "chars": pa.int64(), "link_chars": pa.int64(), "blocks": pa.int64(), "headings": pa.int64(), "pages": pa.int64()}


def places_of(keys: list[int], parents: list[int], kinds: list[int], sizes: list[int], classes: dict[int, int], own: set[int]) -> dict[int, list[int]]:
    """Of one page, for each element of a class: rank in its class, key of the class token around it, kind, and what it
    holds: characters that are neither template nor marked nor links, those of links, blocks and headings."""
    out: dict[int, list[int]] = {}
    ranks: Counter = Counter()
    around: list[int] = []  # per token: the nearest class token that it is or is in
    for key, parent, kind, size in zip(keys, parents, kinds, sizes):
        over = around[parent] if parent >= 0 else 0
        around.append(over)
        if kind & TEXT:
            if key in classes:
                ranks[classes[key]] += 1
            if over and key not in own and not kind & MARKED:
                out[over][5 if kind & LINK else 4] += size
        elif key in classes:
            out[key] = [classes[key], ranks[classes[key]], over, kind, 0, 0, 0, 0]
            ranks[classes[key]] += 1
            around[-1] = key
        elif over:
            out[over][6] |= int(kind & BLOCK > 0)
            out[over][7] |= int(kind & HEADING > 0)
    for _, _, over, kind, chars, links, blocks, headings in reversed(out.values()):  # inner ones first
        if over:
            held = out[over]
            held[4] += chars
            held[5] += links
            held[6] |= blocks | int(kind & BLOCK > 0)
            held[7] |= headings | int(kind & HEADING > 0)
    return out


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch, host and class element: its ranks, what it is in, and what it holds, over the pages that have it."""
    for batch in batches:
        sums: dict[tuple[str, int], list[int]] = {}
        for host, keys, parents, kinds, sizes, frequent, own in zip(*(batch.column(c).to_pylist() for c in ("host", "keys", "parents", "kinds", "sizes", "frequent", "own"))):
            classes = {f["key"]: f["mark"] for f in frequent}
            for key, (mark, rank, over, kind, chars, links, blocks, headings) in places_of(keys, parents, kinds, sizes, classes, set(own)).items():
                s = sums.get((host, key))
                if s is None:
                    sums[host, key] = [mark, rank, rank, over, over, kind, chars, links, blocks, headings, 1]
                    continue
                s[1], s[2], s[3], s[4], s[5] = min(s[1], rank), max(s[2], rank), min(s[3], over), max(s[4], over), s[5] & kind
                for i, n in zip(range(6, 11), (chars, links, blocks, headings, 1)):
                    s[i] += n
        ids = list(sums)
        columns = [[h for h, _ in ids], [k for _, k in ids], *[[sums[x][i] for x in ids] for i in range(11)]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _PLACES.values())], list(_PLACES))


class Template:
    """The valid classes of a host, nested; rows as _places gives them, summed over the host."""

    def __init__(self, rows: list[dict]):
        ordered = {r["key"]: r for r in rows if r["rank_low"] == r["rank_high"] and r["in_low"] == r["in_high"]}
        self.nodes: dict[int, dict] = {}
        # A token whose enclosing token isn't valid isn't either.
        for key in ordered:
            chain, x = [], key
            while x and x in ordered and x not in self.nodes:
                chain.append(x)
                x = ordered[x]["in_low"]
            if not x or x in self.nodes:
                self.nodes.update((c, ordered[c]) for c in chain)
        self.inside: dict[int, list[dict]] = defaultdict(list)
        for r in self.nodes.values():
            self.inside[r["in_low"]].append(r)
        for slots in self.inside.values():
            slots.sort(key=lambda r: (-r["pages"], r["rank_low"], r["key"]))

    def main(self) -> int | None:
        """The main element's key: down from the page to where its text is."""
        at, chars = 0, None
        while True:
            slots = self.inside.get(at, [])
            best = max((r for r in slots if r["kind"] & BLOCK and not r["kind"] & MARKED), key=lambda r: (r["chars"], -r["key"]), default=None)
            if best is None or not best["chars"] or 2 * best["blocks"] < best["pages"]:
                break
            others = [r for r in slots if r is not best and not r["kind"] & MARKED]
            if chars is not None and best["chars"] < MAIN_SHARE * chars:
                break
            if sum(r["chars"] for r in others if r["blocks"]) > BESIDE * best["chars"] or any(r["kind"] & HEADING or r["headings"] for r in others):
                break
            at, chars = best["key"], best["chars"]
            if best["kind"] & HOLDER:
                break
        return at or None

    def lists(self, main: int | None) -> list[int]:
        """Slots of the main element that hold more text in links than outside."""
        return sorted(r["key"] for r in self.inside.get(main or 0, []) if r["kind"] & BLOCK and r["link_chars"] > r["chars"] and r["key"] != main)


def _deduce(key, group):
    rows = group.drop_columns(["host"]).to_pylist()
    template = Template(rows)
    main = template.main()
    return pa.table({"host": pa.array([key[0].as_py()], pa.string()), "main": pa.array([main], pa.int64()), "lists": pa.array([template.lists(main)], pa.list_(pa.int64()))})


def deduce_templates(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """(host, main, own, lists): the main element's key, the keys of the template's text, and of its lists of links.

    What is gathered per host is its template's candidates: no more than twice the tokens of a mean page.
    """
    parsed = pages.select("host", "html").filter("host <> ''").mapInArrow(_parsed, _TREE)
    trees = scratch.save(parsed.groupBy("host", "body").agg(F.min(F.struct("keys", "parents", "kinds", "sizes")).alias("x")).select("host", "body", "x.*"), "trees")
    tokens = trees.select("host", "body", "keys", "kinds").mapInArrow(_occurrences, "host string, key long, pages long, low long, high long, mark long, is_text boolean")
    tokens = tokens.groupBy("host", "key").agg(F.sum("pages").alias("pages"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("mark").alias("mark"), F.max("is_text").alias("is_text"))
    sizes = trees.groupBy("host").agg(F.count("*").alias("host_pages")).filter(F.col("host_pages") >= LEAST_PAGES)
    frequent = tokens.filter((F.col("pages") >= LEAST_PAGES) & (F.col("low") == F.col("high"))).join(sizes, "host").filter(F.col("pages") >= F.col("host_pages") * LEAST_SHARE)
    own = F.collect_list(F.when(F.col("is_text") & (F.col("pages") >= F.col("host_pages") * TEXT_SHARE), F.col("key")))
    # The fingerprint and the number of pages name the class.
    mark = F.xxhash64("mark", "pages")
    classes = scratch.save(frequent.groupBy("host").agg(F.collect_list(F.struct("key", mark.alias("mark"))).alias("frequent"), own.alias("own")), "classes")
    places = trees.drop("body").join(classes, "host").mapInArrow(_places, ", ".join(f"{n} {'string' if n == 'host' else 'long'}" for n in _PLACES))
    summed = places.groupBy("host", "key").agg(
        F.min("mark").alias("mark"), F.min("rank_low").alias("rank_low"), F.max("rank_high").alias("rank_high"), F.min("in_low").alias("in_low"), F.max("in_high").alias("in_high"),
        F.bit_and("kind").alias("kind"), *[F.sum(c).alias(c) for c in ("chars", "link_chars", "blocks", "headings", "pages")],
    )
    found = summed.groupBy("host").applyInArrow(_deduce, "host string, main long, lists array<long>")
    return classes.select("host", "own").join(found, "host", "left")


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for source, main, own, lists in zip(*(batch.column(c).to_pylist() for c in ("html", "main", "own", "lists"))):
            texts.append(Page(source or "").main_text(main, set(own or ()), set(lists or ())))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract_main_text(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    scratch = Scratch(pages.sparkSession, "templates")
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), host.alias("host"))
    templates = scratch.save(deduce_templates(rows, scratch), "templates")
    scratch.close("templates")
    joined = rows.join(templates, "host", "left").select("page_id", "url", "html", "main", "own", "lists")
    return joined.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


QUERIES = {"op6_html_text": op6_html_text}
