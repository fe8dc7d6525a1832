"""Language identification by compression.

A raw-content zstandard dictionary is made for each language from a bounded sample of labelled rows. A text is encoded,
block by block, once with each dictionary; the language whose dictionary gives the smallest output is chosen. Where the
runner-up is within a narrow margin the choice is rejected.

The sample: rows with a non-null label and text are dealt by a hash of both into SAMPLE_DOCS slots per language and the
least hash of each slot is taken, so at most SAMPLE_DOCS documents of each language and SAMPLE_ROWS in all reach the driver;
DICTIONARY bytes of each language are kept, DICTIONARIES in all. Many languages share these bounds alike: none is left out
before there are SAMPLE_ROWS of them. Everything else covers all rows and whole texts.

Defined cases: null or letterless text is `und` with score 0 and rejected; equal sizes go to the language with more
labelled rows (then the alphabetically first) and are rejected; with one language learned all texts with letters are of it;
without any labelled row every text is `und`; null ids count as learned from, repeated rows are predicted alike; an empty
table gives no rows; docs may have columns of any names, and keep_identified() gives them back as they were.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from weftline.llm.common import cut, table

UNKNOWN = "und"
#: Labelled documents sampled for a language and in all, bytes of a dictionary and of all.
SAMPLE_DOCS, SAMPLE_ROWS, DICTIONARY, DICTIONARIES = 48, 24_576, 65_536, 16 << 20
#: Bytes of a block, zstandard's level, the relative margin under which a choice is rejected, and that of score 1.
BLOCK, LEVEL, MARGIN, CERTAIN = 16_384, 6, 0.004, 0.1

#: Marks belong to the letters that they stand on.
_NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")


def letters(text: str) -> bytes:
    """A text's words in lower case, all else as single spaces; nothing where no character is a letter."""
    if not any(map(str.isalpha, text)):
        return b""
    return _NOT_LETTERS.sub(" ", text.lower()).strip().encode("utf-8", "surrogatepass")


def in_training(id_col: str = "doc_id") -> Column:
    """Rows that may be learned from: those not held out."""
    return ~held_out(id_col)


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % 3 == 1


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", sample_docs: int = SAMPLE_DOCS, size: int = DICTIONARY) -> dict[str, bytes]:
    """language -> dictionary, from the labelled rows that aren't held out; the language with most rows first."""
    text, label = F.col(f"`{text_col}`").cast("string"), F.col(f"`{label_col}`").cast("string")
    rows = docs.where(in_training(id_col) & label.isNotNull() & text.isNotNull()).select(label.alias("lang"), F.xxhash64(label, text).alias("h"), text.alias("text"))
    slots = cut(rows.groupBy("lang", F.pmod("h", F.lit(sample_docs)).alias("slot")).agg(F.min("h").alias("h"), F.count(F.lit(1)).alias("n")))
    langs = slots.select("lang").distinct().count()
    each, size = max(1, min(sample_docs, SAMPLE_ROWS // max(1, langs))), min(size, DICTIONARIES // max(1, langs))
    by_slot = F.slice(F.array_sort(F.collect_list(F.struct("slot", "h"))), 1, each)
    ranked = slots.groupBy("lang").agg(F.sum("n").alias("n"), F.transform(by_slot, lambda s: s["h"]).alias("hashes")).orderBy(F.desc("n"), "lang").limit(SAMPLE_ROWS).collect()
    wanted = [h for r in ranked for h in r["hashes"]]
    if not wanted:
        return {}
    share = max(1, size // each)
    texts: dict[str, dict[int, bytes]] = {}
    # Of a very long document the middle is enough for its share of the dictionary.
    taken = F.col("text").substr(F.greatest(F.lit(1), (F.length("text") / 2).cast("int") - 4 * share), F.lit(8 * share))
    for lang, h, text in rows.select("lang", "h", taken.alias("t")).where(F.col("h").isin(wanted)).dropDuplicates(["lang", "h"]).collect():
        texts.setdefault(lang, {})[h] = letters(text)
    made = {}
    for lang in [r["lang"] for r in ranked if r["lang"] in texts]:
        parts = [texts[lang][h] for h in sorted(texts[lang])]
        content = b" ".join(p[: max(share, size // len(parts))] for p in parts)[:size]
        if len(content) >= 8:
            made[lang] = content
    return made


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes], level: int = LEVEL, block: int = BLOCK):
        self.langs, self.block = list(dictionaries), block
        self.coders = []
        for lang in self.langs:
            d = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            self.coders.append(zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False).compress)

    def sizes(self, text: str | None) -> list[int] | None:
        """Bytes of the text's blocks under each dictionary; None where there is no letter."""
        data = letters(text or "")
        if not data:
            return None
        parts = [data[i : i + self.block] for i in range(0, len(data), self.block)]
        return [sum(len(coder(p)) for p in parts) for coder in self.coders]

    def __call__(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, rejected)."""
        sizes = self.sizes(text)
        if not sizes:
            return UNKNOWN, 0.0, True
        if len(sizes) == 1:
            return self.langs[0], 1.0, False
        best, second = sorted(sizes)[:2]
        margin = (second - best) / second
        return self.langs[sizes.index(best)], min(1.0, margin / CERTAIN), margin < MARGIN


def classify(docs: DataFrame, dictionaries: dict[str, bytes], keep: list[str], text_col: str = "text") -> DataFrame:
    """(row, lang, score, rejected) for each row of docs; row is a struct of the columns keep."""
    # The text goes to Python once, where it is kept anyway.
    own = keep.index(text_col) if text_col in keep and dict(docs.dtypes)[text_col] == "string" else None
    text = F.lit(None).cast("string") if own is not None else F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Classifier(dictionaries)
        for b in batches:
            made = [model(t.as_py()) for t in (b.column(1) if own is None else b.column(0).field(own))]
            new = [pa.array([m[k] for m in made], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([b.column(0), *new], ["row", "lang", "score", "rejected"])

    return rows.mapInArrow(run, StructType([rows.schema["row"], StructField("lang", StringType()), StructField("score", DoubleType()), StructField("rejected", BooleanType())]))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = classify(docs, learn(docs), ["doc_id"]).select("row.doc_id", "lang", "score", "rejected")
    return found.select("doc_id", held_out().alias("held_out"), F.col("lang").alias("lang_pred"), "score", "rejected")


def keep_identified(docs: DataFrame) -> DataFrame:
    """docs without those whose language is rejected."""
    return classify(docs, learn(docs), docs.columns).where("NOT rejected").select("row.*")


QUERIES = {"op1_compression_langid": op1}
