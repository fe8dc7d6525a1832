"""Main text of web pages by consensus paths per host.

First pass: every page is read into elements; of its containers the deepest that holds most of the page's text (links and
known boilerplate count little), widened to the ancestors that add only paragraphs, headings, lists and the like, is its
candidate. The page votes for the candidate's generalised path: the tags and classes from the root, digits replaced. Votes
are summed per host and path in Spark, and each host's path with most votes wins. Second pass: each page's text is taken
from all its elements with the host's winning path, or from its own candidate where it has none.

Formulas, objects and what stands for scripts are parts of the text around them; scripts, styles and drawings inside a
block don't part it. Text is kept whole: character references are decoded, white space inside a block becomes one space, blocks are trimmed
and joined by line feeds in page order. Left out inside the element are menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles and reader comments, by tag or by a mark. A mark is a whole class, id or role that is made of MARKS
alone, and words of layout before or after them ("site-footer", "comment-list"; not "has-sidebar" or "related-work"). It
never counts on html, body, main, article and blocks of text, nor, like the tag form, on an element that holds most of the
page's text, unless that is what readers wrote.

Defined cases: null or empty html has empty text; pages without a host share the empty host; unclosed and unmatched tags
are repaired as browsers do for blocks; what follows a tag or comment that never ends is no text; ties go to the larger text,
then the larger key of the path; repeated rows and null ids are rows of their own, extracted alike; an empty table gives no
rows; columns that are kept may have any name. Reading a page takes time and memory linear in its length, however its
elements are nested: a path is a number made from the parent's number and the element's own tag and classes.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from weftline.llm.common import cut, free, table

#: Share of a page's text that its candidate must hold; share above which a marked element is no boilerplate; share of
#: links above which an ancestor's own text is; bytes of winners that are broadcast at most; salts otherwise.
MOST_OF, HALF, LINKS, BROADCAST, SALTS = 0.8, 0.5, 0.5, 8 << 20, 16

#: Elements whose inside is no text, up to their end tag; they don't part the text around them.
RAW = frozenset("script style textarea template iframe svg annotation annotation-xml".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MATHS = frozenset("math semantics mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose msub msup msubsup munder mover munderover mmultiscripts mprescripts mtable mtr mtd".split())
INLINE = MATHS | frozenset("a abbr acronym audio b bdi bdo big canvas cite code data del dfn em font i ins kbd label map mark nobr noscript object output picture q rb rp rt ruby s samp slot small span strike strong sub sup time tt u var video".split())
CONTAINERS = frozenset("body article main section div td center form fieldset details blockquote".split())
#: Containers that a candidate may be widened to, and where that ends.
WIDENED, WIDEST = frozenset("article main section div".split()), frozenset("article main".split())
#: Elements whose text is an article's.
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table thead tbody tr td th figure figcaption caption".split())
DROPPED = frozenset("head nav header footer aside form button select menu dialog".split()) | RAW
SIBLINGS = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",))}
#: Words that mark what isn't the article, those of them that mark readers' text, and words of layout beside them.
COMMENTS = frozenset("comment comments respond reply replies disqus".split())
MARKS = COMMENTS | frozenset("ad ads advert adverts advertisement advertising adbox banner sponsor sponsored promo promotion sidebar aside menu menus nav navbar navigation breadcrumb breadcrumbs header masthead footer cookie cookies consent notice notices notification alert popup modal overlay newsletter subscribe signup share sharing social related recommended recommendations widget pagination pager toolbar login search form complementary contentinfo".split())
BEFORE = frozenset("site page main top bottom left right primary secondary global sub mobile desktop sticky user reader".split())
AFTER = frozenset("list container wrapper wrap box area section bar block links link posts articles buttons button panel items item inner row holder group thread top bottom left right".split())
#: Words of the article itself, before marks that aren't parts of it.
OWN, HEADS = frozenset("post article entry content story".split()), frozenset("header footer masthead banner widget".split())
#: Where a mark never counts.
UNMARKED = frozenset("html body main article".split()) | TEXTUAL

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ENDS = re.compile(r">|=\s*[\"']")
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+(?:x\d+)?")
_DIGITS = re.compile(r"\d+")
HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


@lru_cache(65_536)
def mark(name: str) -> str | None:
    """The first word of MARKS in a class, id or role that is made of such words and words of layout around them."""
    if _PARTS.sub("", name).strip("-_"):
        return None
    parts = [p.lower() for p in _PARTS.findall(name) if not p[0].isdigit()]
    found = [k for k, p in enumerate(parts) if p in MARKS]
    if not found:
        return None
    first, last = found[0], found[-1]
    before = BEFORE if parts[first] in HEADS else BEFORE | OWN
    fine = all(p in before for p in parts[:first]) and all(p in MARKS for p in parts[first:last]) and all(p in AFTER for p in parts[last + 1 :])
    return parts[first] if fine else None


def tags(source: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, name, whether it ends an element, attributes) of each tag in order; comments and declarations have an
    empty name. The search never reads a character more than a few times."""
    at, end = source.find("<"), len(source)
    unquoted: set[str] = set()  # quotes of which there are no more
    while at >= 0:
        stop = -1
        if source.startswith("<!--", at):
            stop = source.find("-->", at + 4)
            stop = end if stop < 0 else stop + 3
            yield at, stop, "", False, ""
        else:
            closing = source.startswith("</", at)
            if m := _NAME.match(source, at + 1 + closing):
                stop = m.end()
                while True:
                    d = _ENDS.search(source, stop)
                    if d is None:
                        stop = end
                        break
                    stop = d.end()
                    quote = d[0][-1]
                    if quote == ">":
                        break
                    if quote not in unquoted:
                        close = source.find(quote, stop)
                        if close < 0:
                            unquoted.add(quote)
                        else:
                            stop = close + 1
                inside = source[m.end() : stop]
                yield at, stop, m[0].lower(), closing, "" if closing else inside
            elif source[at + 1 : at + 2] in ("!", "?", "/") and at + 1 < end:
                stop = source.find(">", at)
                stop = end if stop < 0 else stop + 1
                yield at, stop, "", False, ""
            else:
                stop = at + 1
        at = source.find("<", stop)


class Page:
    """Elements and text blocks of a page. keys (numbers of paths), parents, tags, labels, depths and marks are by element;
    blocks are (element, text, link characters)."""

    def __init__(self, source: str | None):
        self.keys, self.parents, self.tags, self.labels, self.depths = [0], [-1], [""], [""], [0]
        self.marks: list[str | None] = [None]
        self.blocks: list[tuple[int, str, int]] = []
        self._read(source or "")
        self._leave_out()

    def _read(self, source: str) -> None:
        stack: list[tuple[str, int]] = [("", 0)]  # (tag, element)
        # Where in the stack the open elements of each tag are, and those that aren't inline.
        places: dict[str, list[int]] = {}
        outer: list[int] = [0]
        text: list[str] = []
        link: list[str] = []
        at, end = 0, len(source)

        def flush() -> None:
            if text:
                block = " ".join(entities.unescape("".join(text)).split())
                if block:
                    self.blocks.append((stack[-1][1], block, len(" ".join(entities.unescape("".join(link)).split()))))
                text.clear()
                link.clear()

        def close(depth: int) -> None:
            if outer[-1] >= depth:
                flush()
            while len(stack) > depth:
                places[stack.pop()[0]].pop()
            while outer[-1] >= depth:
                outer.pop()

        def top(tag: str) -> int:
            """The place of the innermost open element of a tag; 0 where there is none."""
            return places[tag][-1] if places.get(tag) else 0

        def add(piece: str) -> None:
            if piece:
                text.append(piece)
                if places.get("a"):
                    link.append(piece)

        for start, stop, tag, closing, attributes in tags(source):
            if start < at:
                continue
            add(source[at:start])
            at = stop
            if not tag:
                continue
            if closing:
                depth = top(tag)
                # An inline element ends within its block.
                if depth and (tag not in INLINE or depth > outer[-1]):
                    close(depth)
                continue
            if tag in VOID:
                if tag == "hr":
                    flush()
                else:
                    add(" ")
                continue
            if tag in RAW or tag == "xmp":
                found = re.compile(rf"</{tag}[\s/>]", re.I).search(source, at)
                if tag == "xmp":
                    flush()
                    add(entities.escape(source[at : found.start() if found else end]))
                    flush()
                at = source.find(">", found.start()) + 1 or end if found else end
                continue
            if tag not in INLINE:
                flush()
                names, stops = SIBLINGS.get(tag, ("", ()))
                closed = ("p", *names.split())
                if any(places.get(n) for n in closed):
                    # Elements that this one ends, outwards to the first that holds it.
                    wall = max(top(t) for t in (*stops, *CONTAINERS) if t not in closed)
                    inside = [places[n][bisect_right(places[n], wall)] for n in closed if top(n) > wall]
                    if inside:
                        close(min(inside))
            label, what = tag, "tag" if tag in DROPPED else None
            if attributes:
                named = {k.lower(): a or b or c or "" for k, a, b, c in _ATTRIBUTE.findall(attributes)}
                if named:
                    if what is None and tag not in UNMARKED:
                        what = next((m for v in named.values() for w in v.split() if (m := mark(w))), None)
                    if named.get("class"):
                        label += "." + ".".join(sorted(set(_DIGITS.sub("#", named["class"]).split())))
            parent = stack[-1][1]
            self.keys.append(xxhash.xxh64_intdigest(label, self.keys[parent]) >> 1)
            self.parents.append(parent)
            self.tags.append(tag)
            self.labels.append(label)
            self.depths.append(self.depths[parent] + 1)
            self.marks.append(what)
            places.setdefault(tag, []).append(len(stack))
            if tag not in INLINE:
                outer.append(len(stack))
            stack.append((tag, len(self.keys) - 1))
        add(source[at:])
        flush()

    def _sums(self, values: list[int]) -> list[int]:
        """What the elements and all inside them have."""
        for k in range(len(values) - 1, 0, -1):
            values[self.parents[k]] += values[k]
        return values

    def _leave_out(self) -> None:
        """Drops the blocks inside elements that aren't the article."""
        if any(self.marks):
            size = [0] * len(self.keys)
            for element, block, _ in self.blocks:
                size[element] += len(block)
            size = self._sums(size)
            out = [False] * len(self.keys)
            for k, what in enumerate(self.marks):
                fine = what is None or size[k] > HALF * size[0] and (self.tags[k] == "form" if what == "tag" else what not in COMMENTS)
                out[k] = k > 0 and (out[self.parents[k]] or not fine)
            self.blocks = [b for b in self.blocks if not out[b[0]]]

    def path(self, element: int) -> str:
        """The tags and classes from the root."""
        labels = []
        while element > 0:
            labels.append(self.labels[element])
            element = self.parents[element]
        return "/" + "/".join(reversed(labels))

    def candidate(self) -> tuple[int, int] | None:
        """(element, worth) of the container of the page's text."""
        size, links, bare = [0] * len(self.keys), [0] * len(self.keys), [0] * len(self.keys)
        worth = [0] * len(self.keys)
        for element, block, linked in self.blocks:
            size[element] += len(block)
            links[element] += linked
            worth[element] += max(0, len(block) - 3 * linked)
            if self.tags[element] not in TEXTUAL and self.tags[element] not in INLINE:
                bare[element] += len(block)
        worth, size, links, bare = map(self._sums, (worth, size, links, bare))
        best = None
        for k, tag in enumerate(self.tags):
            if tag in CONTAINERS and worth[k] and worth[k] >= MOST_OF * worth[0] and (best is None or self.depths[k] > self.depths[best]):
                best = k
        if best is None:
            return None
        at = best
        while self.tags[best] not in WIDEST and (at := self.parents[at]) > 0 and self.tags[at] not in ("body", "html"):
            if bare[at] > bare[best] or links[at] - links[best] > LINKS * (size[at] - size[best]):
                break
            if self.tags[at] in WIDENED and size[at] > size[best]:
                best = at
        return best, worth[best]

    def text(self, key: int | None) -> str:
        """Blocks inside the elements whose path has this key, or inside the page's candidate."""
        inside = [key is not None and k > 0 and p == key for k, p in enumerate(self.keys)]
        if not any(inside):
            found = self.candidate()
            inside = [k == found[0] for k in range(len(self.keys))] if found else [True] * len(self.keys)
        for k, parent in enumerate(self.parents):
            if parent >= 0 and inside[parent]:
                inside[k] = True
        return "\n".join(block for element, block, _ in self.blocks if inside[element])


def host(url_col: str = "url"):
    return F.lower(F.regexp_extract(F.coalesce(F.col(f"`{url_col}`").cast("string"), F.lit("")), HOST, 1))


def consensus(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, key): the path that most pages of a host vote for."""

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cast: dict[tuple[str, int], list[int]] = {}
            for h, source in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                page = Page(source.as_py())
                if found := page.candidate():
                    mine = cast.setdefault((h, page.keys[found[0]]), [0, 0])
                    mine[0] += 1
                    mine[1] += found[1]
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in cast], pa.string()), pa.array([k[1] for k in cast], pa.int64()), pa.array([v[0] for v in cast.values()], pa.int64()), pa.array([v[1] for v in cast.values()], pa.int64())], ["host", "key", "n", "worth"])

    cast = pages.select(host(url_col).alias("host"), F.col(f"`{html_col}`").cast("string").alias("html")).mapInArrow(votes, "host string, key long, n long, worth long")
    sums = cast.groupBy("host", "key").agg(F.sum("n").alias("n"), F.sum("worth").alias("worth"))
    return sums.groupBy("host").agg(F.max(F.struct("n", "worth", "key")).alias("w")).select("host", F.col("w.key").alias("key"))


def extract(pages: DataFrame, keep: list[str], url_col: str = "url", html_col: str = "html", text_col: str = "text") -> DataFrame:
    """The columns keep and text_col (with underscores where keep has that name) of each page."""
    winners = cut(consensus(pages, url_col, html_col))
    size = winners.agg(F.sum(F.octet_length("host") + 72)).first()[0] or 0
    own = pages.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), host(url_col).alias("h"), F.col(f"`{html_col}`").cast("string").alias("html"))
    if size <= BROADCAST:
        joined = own.join(F.broadcast(winners), own["h"] == winners["host"], "left")
    else:
        # Hosts may be hot: their rows are dealt to SALTS keys, which each winner is copied to.
        dealt = own.withColumn("salt", F.pmod(F.xxhash64("html"), F.lit(SALTS)))
        copied = winners.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = dealt.join(copied, (dealt["h"] == copied["host"]) & (dealt["salt"] == copied["s"]), "left")
    ready = joined.select("row", "key", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [Page(source.as_py()).text(key) for key, source in zip(b.column(1).to_pylist(), b.column(2), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.string())], ["row", "text"])

    found = ready.mapInArrow(run, StructType([ready.schema["row"], StructField("text", StringType())]))
    return found.select("row.*", F.col("text").alias(free(text_col, keep)))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(table(spark, sf_dir, "pages"), ["page_id", "url"])
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


QUERIES = {"op6_consensus_html_extraction": op6}
