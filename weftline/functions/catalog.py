"""The library's functions for SQL: register() names them in a session.

Table functions, for FROM … , LATERAL f(…): html_blocks, text_paragraphs, logical_lines. Scalar functions: compact_key,
plain_text, title_similarity, resolve_url.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from weftline.functions import text, urls
from weftline.sources.html import html_blocks

_MARKER = re.compile(r"\{(\d+)(?: continued)?\}")
_BLANK = re.compile(r"\n[ \t]*\n")


class HtmlBlocks:
    """Typed blocks of a page in order, with the book pages that they stand on; `paged` leaves out those before the first."""

    def eval(self, source: str, paged: bool):
        for k, b in enumerate(html_blocks(source, bool(paged))):
            yield k, *b


class TextParagraphs:
    """Paragraphs of plain text between blank lines, with the page of the last {number} before them; pictures are left out."""

    def eval(self, source: str):
        page, n = None, 0
        for part in _BLANK.split(source or ""):
            part = part.strip(" ")
            if m := _MARKER.fullmatch(part):
                page = int(m[1])
            elif part and not part.startswith("[Illustration:"):
                yield n, page, part
                n += 1


class LogicalLines:
    """Lines of a page that aren't blank, numbered from 1 within each page; pages are parted by form feeds."""

    def eval(self, source: str):
        for p, page in enumerate((source or "").split("\f")):
            for n, line in enumerate((x for x in page.split("\n") if x.strip()), 1):
                yield p + 1, n, line


TABLE_FUNCTIONS = {
    "html_blocks": (HtmlBlocks, "pos int, kind string, text string, page_start int, page_end int, small_caps string"),
    "text_paragraphs": (TextParagraphs, "pos int, page long, text string"),
    "logical_lines": (LogicalLines, "page int, line int, text string"),
}


def _each(f):
    """A pandas UDF that gives strings of strings, nulls for nulls."""

    def run(x: pd.Series) -> pd.Series:
        return x.map(lambda v: None if v is None else f(v))

    return F.pandas_udf(run, "string")


def _similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([text.matching_ratio(x or "", y or "") for x, y in zip(a, b, strict=True)])


def _resolved(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else urls.resolved(x, y) for x, y in zip(a, b, strict=True)])


def register(spark: SparkSession) -> list[str]:
    """Registers all functions and returns their names."""
    for name, (kind, schema) in TABLE_FUNCTIONS.items():
        spark.udtf.register(name, F.udtf(kind, returnType=schema))
    scalars = {"compact_key": _each(text.compact_key), "plain_text": _each(text.plain_text), "title_similarity": F.pandas_udf(_similarity, "double"), "resolve_url": F.pandas_udf(_resolved, "string")}
    for name, f in scalars.items():
        spark.udf.register(name, f)
    return sorted([*TABLE_FUNCTIONS, *scalars])
