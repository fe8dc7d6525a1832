"""Fill-in-middle transformation.

A text is cut into units (runs of ASCII letters, and single other characters). Two numbers drawn from the document's seed
choose the units after which the prefix and the middle end, two more choose the form. Training examples then hold the
three parts behind marks: `psm` is prefix, suffix, middle, `spm` is suffix, prefix, middle, `plain` is the text as it is.

An Arrow-batched pandas UDF does the work inside the row, without a shuffle: `regex` finds the units of a whole text and
the offsets of their ends go into a compact array, two lookups in it give the slices, and hashlib makes seeds and digests.

Defined cases: a null text is the empty text, which is plain; so is a text that holds a mark, so that every output can be
restored; a null id is the empty id; repeated ids draw the same numbers, repeated rows give the same results; an empty
table gives no rows; docs may have columns of any names.
"""

from __future__ import annotations

import hashlib
from array import array

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.common import beside, free, table

#: The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of a hundred texts so many are transformed, and of a hundred of these so many have the suffix first.
TRANSFORMED, SUFFIX_FIRST = 90, 20

_UNITS = regex.compile("[A-Za-z]+|[^A-Za-z]")


def unit_ends(text: str) -> array:
    """Where each unit of text ends, in code points."""
    return array("L", (m.end() for m in _UNITS.finditer(text)))


def seeds(doc_id) -> tuple[int, int, int, int]:
    """Four numbers of 32 bits that depend on the id alone."""
    found = hashlib.sha256(b"1:" + ("" if doc_id is None else str(doc_id)).encode()).digest()
    return tuple(int.from_bytes(found[k : k + 4], "big") for k in (0, 4, 8, 12))


def rearranged(doc_id, text: str, transformed: int = TRANSFORMED, suffix_first: int = SUFFIX_FIRST) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, code points of the prefix and of the middle, output); no lengths where the form is plain."""
    ends = unit_ends(text)
    n = len(ends)
    one, two, three, four = seeds(doc_id)
    if not text or three % 100 >= transformed or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    first, last = sorted((one % (n + 1), two % (n + 1)))
    a, b = (ends[k - 1] if k else 0 for k in (first, last))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if four % 100 < suffix_first:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def restored(output: str, form: str) -> str:
    """The text that rearranged() made output of. As no part holds a mark, and a mark's `<` is its only one, the first
    place of each mark is its own."""
    if form == "plain":
        return output
    one, two = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    second = output.index(two, len(one))
    third = output.index(MIDDLE, second + len(two))
    parts = output[len(one) : second], output[second + len(two) : third], output[third + len(MIDDLE) :]
    prefix, suffix = parts[:2] if form == "psm" else parts[1::-1]
    return prefix + parts[2] + suffix


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


_KIND = "n long, form string, prefix_chars long, middle_chars long, output string, output_sha256 string, restored_sha256 string"


def example(doc_id: Column, text: Column, texts: bool = True, transformed: int = TRANSFORMED, suffix_first: int = SUFFIX_FIRST) -> Column:
    """A struct of the units' count n, form, lengths, output (null unless texts) and the digests of output and of the text
    restored from it."""

    def made(ids: pd.Series, batch: pd.Series) -> pd.DataFrame:
        rows = []
        for i, t in zip(ids, batch, strict=True):
            n, form, before, inside, output = rearranged(i, t, transformed, suffix_first)
            rows.append((n, form, before, inside, output if texts else None, _digest(output), _digest(restored(output, form))))
        found = pd.DataFrame(rows, columns=[c.split()[0] for c in _KIND.split(", ")], dtype=object)
        return found.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})

    return F.pandas_udf(made, _KIND)(F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(text.cast("string"), F.lit("")))


def rearrange(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", out_col: str = "example") -> DataFrame:
    """docs plus out_col, the struct of example()."""
    made = beside(docs, example(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("made"))
    return made.select("row.*", F.col("made").alias(free(out_col, docs.columns)))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = docs.select("doc_id", example(F.col("doc_id"), F.col("text"), texts=False).alias("e"))
    return made.select("doc_id", "e.n", "e.form", "e.prefix_chars", "e.middle_chars", "e.output_sha256", "e.restored_sha256")


QUERIES = {"op11_fill_in_middle": op11}

ORACLE = {
    "op11_fill_in_middle": r"""
WITH seeded AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS s FROM documents),
units AS (
  SELECT doc_id, t, CASE WHEN t = '' THEN [] ELSE regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') END AS u,
         ('0x' || substr(s, 1, 8))::BIGINT AS h1, ('0x' || substr(s, 9, 8))::BIGINT AS h2,
         ('0x' || substr(s, 17, 8))::BIGINT AS h3, ('0x' || substr(s, 25, 8))::BIGINT AS h4
  FROM seeded),
cuts AS (
  SELECT doc_id, t, u, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM units),
parts AS (
  SELECT doc_id, t, n, form, coalesce(array_to_string(u[:a], ''), '') AS p, coalesce(array_to_string(u[a + 1:b], ''), '') AS m,
         coalesce(array_to_string(u[b + 1:], ''), '') AS s
  FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts"""
}
