"""HTML and plain-text readers: documents to typed blocks (S7, S8, S18), in Arrow batches of the standard parser."""

from __future__ import annotations

import re
from html.parser import HTMLParser
from typing import NamedTuple

#: Tags that begin a block, classes of div that are no text, and tags without an end; fixed values.
BLOCK_TAGS, LEFT_OUT = frozenset("p h3 h4 h5 h6 li tr".split()), frozenset("figcenter figleft figright footnote".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_PAGE = re.compile(r"Page_(\d+)")


class Block(NamedTuple):
    kind: str
    text: str
    page_start: int | None
    page_end: int | None
    small_caps: str | None


class Blocks(HTMLParser):
    """Typed blocks with the pages that they stand on: the last page marker before a block and those inside it.

    What is open is a stack of (tag, role): a block, small capitals, a page marker, or what is left out; text counts by
    the roles that are open. With `paged`, blocks before the first page marker are left out.
    """

    def __init__(self, paged: bool = False):
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.open: list[tuple[str, str]] = []
        self.page: int | None = None
        self.paged, self.kind = paged, ""
        self.text: list[str] = []
        self.capitals: list[str] = []
        self.pages: list[int] = []

    def inside(self, role: str) -> bool:
        return any(r == role for _, r in self.open)

    def role(self, tag: str, named: dict[str, str | None]) -> str:
        classes = set((named.get("class") or "").split())
        if tag in ("script", "style") or tag == "div" and classes & LEFT_OUT:
            return "out"
        if tag == "span" and "pageno" in classes and (m := _PAGE.fullmatch(named.get("id") or "")):
            self.page = int(m[1])
            if self.inside("block"):
                self.pages.append(self.page)
            return "marker"
        if self.inside("block"):
            return "capitals" if tag == "span" and "sc" in classes else ""
        return "block" if tag in BLOCK_TAGS or tag == "div" and "line" in classes else ""

    def handle_starttag(self, tag, attrs):
        if self.inside("out"):
            if tag not in VOID:
                self.open.append((tag, ""))
            return
        if tag in BLOCK_TAGS and any(t == tag and r == "block" for t, r in self.open) and tag in ("p", "li", "tr"):
            self.handle_endtag(tag)  # its end may be left out
        if self.inside("block"):
            if tag == "br":
                self.text.append("\n")
            elif tag in ("td", "th") and self.text:
                self.text.append("\t")
        if tag in VOID:
            return
        role = self.role(tag, dict(attrs))
        if role == "block":
            self.kind, self.text, self.capitals = "line" if tag == "div" else tag, [], []
            self.pages = [] if self.page is None else [self.page]
        self.open.append((tag, role))

    def handle_endtag(self, tag):
        if not any(t == tag for t, _ in self.open):
            return
        while self.open:
            closed, role = self.open.pop()
            if role == "block":
                self._block()
            if closed == tag:
                break

    def _block(self) -> None:
        words, capitals = (" ".join("".join(parts).split()) for parts in (self.text, self.capitals))
        if words and (self.pages or not self.paged):
            self.blocks.append(Block(self.kind, words, min(self.pages, default=None), max(self.pages, default=None), capitals or None))

    def handle_data(self, data):
        if self.inside("block") and not self.inside("out") and not self.inside("marker"):
            self.text.append(data)
            if self.inside("capitals"):
                self.capitals.append(data)

    def close(self):
        super().close()
        while self.open:
            if self.open.pop()[1] == "block":
                self._block()


def html_blocks(source: str | None, paged: bool = False) -> list[Block]:
    parser = Blocks(paged)
    parser.feed(source or "")
    parser.close()
    return parser.blocks
