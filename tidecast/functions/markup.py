"""Headline and article of a page from its tokens: tags with quoted attributes, comments, raw text, entities.

Patterns over a whole page break on a ``>`` inside an attribute or a comment, and know the entities they
list; the standard tokenizer knows all. Pages are parsed where they lie, in Arrow batches.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidecast.functions.text import IMAGE_MARKER

_UNSEEN = {"script", "style", "template", "noscript", "textarea", "title", "head"}
_EMPTY = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


@dataclass(frozen=True)
class Block:
    """Elements that hold a paragraph: a tag, and a part that one of its attributes must contain."""

    tag: str
    attribute: str | None = None
    contains: str = ""

    def fits(self, tag: str, attributes: dict[str, str | None]) -> bool:
        if tag != self.tag:
            return False
        return self.attribute is None or self.contains in (attributes.get(self.attribute, "\0") or "")


PARAGRAPHS = (Block("p"),)


@dataclass
class _Open:
    tag: str
    depth: int
    parts: list[str] = field(default_factory=list)


class _Reader(HTMLParser):
    """Collects the first headline and all paragraphs of a page."""

    def __init__(self, blocks: tuple[Block, ...]):
        super().__init__(convert_charrefs=True)
        self.blocks = blocks
        self.headline: str | None = None
        self.paragraphs: list[str] = []
        self.unseen: list[str] = []
        self.title: list[str] | None = None
        self.block: _Open | None = None

    def _end_block(self) -> None:
        if self.block is not None:
            self.paragraphs.append("".join(self.block.parts).strip(" "))
            self.block = None

    def handle_starttag(self, tag, attrs):
        if tag in _UNSEEN:
            if tag != "head":
                self.unseen.append(tag)
            return
        if self.unseen:
            return
        if tag == "br":
            self.handle_data("\n")
        elif tag == "h1" and self.headline is None and self.title is None:
            self._end_block()
            self.title = []
        elif any(b.fits(tag, dict(attrs)) for b in self.blocks):
            self._end_block()
            self.block = _Open(tag, 1)
        elif self.block is not None and tag == self.block.tag and tag not in _EMPTY:
            self.block.depth += 1

    def handle_startendtag(self, tag, attrs):
        if tag in _EMPTY:
            self.handle_starttag(tag, attrs)
        else:
            self.handle_starttag(tag, attrs)
            if tag in _UNSEEN:
                self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.unseen:
            if tag == self.unseen[-1]:
                self.unseen.pop()
        elif tag == "h1" and self.title is not None:
            self.headline, self.title = "".join(self.title).strip(" "), None
        elif self.block is not None and tag == self.block.tag:
            self.block.depth -= 1
            if self.block.depth == 0:
                self._end_block()

    def handle_data(self, data):
        if self.unseen:
            return
        if self.title is not None:
            self.title.append(data)
        elif self.block is not None:
            self.block.parts.append(data)


def read_page(html: str | None, blocks: tuple[Block, ...] = PARAGRAPHS) -> tuple[str | None, str | None]:
    """Headline (the first ``h1``) and article (its paragraphs, one per line) of a page; null for a null page.

    A page without one has an empty string. What is open at the end of the page, a comment too,
    ends there.
    """
    if html is None:
        return None, None
    reader = _Reader(blocks)
    opened = html.rfind("<!--")
    reader.feed(html + "-->" if opened >= 0 and "-->" not in html[opened:] else html)
    reader.close()
    reader._end_block()
    if reader.title is not None and reader.headline is None:
        reader.headline = "".join(reader.title).strip(" ")
    return reader.headline or "", "\n".join(reader.paragraphs).partition(IMAGE_MARKER)[0]


def page_article(html: str, blocks: tuple[Block, ...] = PARAGRAPHS) -> Column:
    """``struct(headline, article)`` of a column of pages, up to the image credits."""

    @F.pandas_udf("headline string, article string")
    def read(pages: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([read_page(page, blocks) for page in pages], columns=["headline", "article"], dtype=object)

    return read(F.col(html))
