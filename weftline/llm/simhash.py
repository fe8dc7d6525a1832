"""SimHash near-duplicates by anchor points.

Fingerprints are split into three bands of 23, 23 and 18 bits. Two fingerprints that differ in at most four bits differ
in at most one bit in some band. The anchors of a band are the words of a perfect covering code (the binary Golay code
for 23 bits; two Hamming(7,4) words and four plain bits for 18), so each band value has one nearest anchor, its home,
within the covering radius. A fingerprint is replicated to every anchor within the covering radius plus one bit, and
homes are compared with all visitors of their anchor. That finds every linked pair.

An anchor's homes grow with the table. From WIDE distinct fingerprints on, anchors are pairs of code words of two bands,
2 ** 24 for each two: the same pairs differ in at most two bits in some two bands, and a fingerprint visits the anchors
within the covering radii plus two bits in both together. Either way finds the same links; the second has fourteen times the
rows and a four-thousandth of the comparisons.

Equal fingerprints meet once: comparisons are between distinct ones. A task gives a spanning forest of the links it
finds, not all pairs, so large groups of near copies give few edges.

Defined cases: null or wordless text has fingerprint 0, linked like any other; fewer words than a shingle make one
shingle of them all; rows with a null id keep their row, and a component's id is its smallest non-null id (null if it
has none); repeated ids are one document each row of which keeps its own fingerprint; an empty table gives no rows. Other
columns of docs are left out of near_duplicates(), where a result column that is called like id_col gets a trailing
underscore; keep_first() gives all columns back, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from weftline.llm import jaccard
from weftline.llm.common import beside, columns, components, cut, free, hot_split, joined_labels, runs, table, width

SHINGLE, THRESHOLD, SEED = 4, 4, 42
#: Homes of one anchor that a task takes at most; distinct fingerprints from which anchors are pairs of code words.
HOMES, WIDE = 50_000, 1 << 25


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The signed 64-bit SimHash of a text's word shingles, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    if len(words) <= shingle:
        spans = [(0, len(joined))]
    else:
        spans = zip([0, *ends], [e - 1 for e in ends[shingle - 1 :]], strict=False)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at : at + 65_536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) for each row of docs."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [fingerprint(t.as_py(), shingle) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.int64())], ["id", "fp"])

    return rows.mapInArrow(run, StructType([rows.schema["id"], StructField("fp", LongType())]))


class Cyclic:
    """A perfect binary cyclic code of n bits, message length k, generator poly and the given radius."""

    def __init__(self, n: int, k: int, poly: int, radius: int):
        self.n, self.k = n, k
        unit = []
        for bit in range(n):
            x = 1 << bit
            for high in range(n - 1, n - k - 1, -1):
                if x >> high & 1:
                    x ^= poly << (high - (n - k))
            unit.append(x)
        self.unit = unit
        self.errors = np.zeros(1 << (n - k), np.int64)
        level = {0: 0}
        for _ in range(radius):
            level |= {s ^ unit[b]: e | 1 << b for s, e in list(level.items()) for b in range(n) if not e >> b & 1 and s ^ unit[b] not in level}
        for s, e in level.items():
            self.errors[s] = e

    def anchor(self, x: np.ndarray) -> np.ndarray:
        """The message of the code word nearest to each x."""
        s = np.zeros(len(x), np.int64)
        for bit, u in enumerate(self.unit):
            s ^= (x >> bit & 1) * u
        return (x ^ self.errors[s]) >> (self.n - self.k)


GOLAY = Cyclic(23, 12, 0xC75, 3)
HAMMING = Cyclic(7, 4, 0b1011, 1)
#: (first bit, bits) of each band.
BANDS = ((0, 23), (23, 23), (46, 18))


def home_anchor(band: int, x: np.ndarray) -> np.ndarray:
    if BANDS[band][1] == 23:
        return GOLAY.anchor(x)
    return HAMMING.anchor(x & 127) | HAMMING.anchor(x >> 7 & 127) << 4 | (x >> 14) << 8


def values(fps: np.ndarray, band: int) -> np.ndarray:
    first, bits = BANDS[band]
    return (fps.view(np.uint64) >> np.uint64(first)).astype(np.int64) & ((1 << bits) - 1)


def anchors(band: int, x: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, bits) of all anchors that are the home of a value at most `most` bits (two at most) from x, each with
    the fewest bits, in the order of rows."""
    bits = BANDS[band][1]
    flips = [[0], [1 << b for b in range(bits)], [1 << b | 1 << c for b in range(bits) for c in range(b)]][: most + 1]
    masks = np.array([f for level in flips for f in level], np.int64)
    level = np.repeat(np.arange(len(flips)), [len(f) for f in flips])
    found = home_anchor(band, (x[:, None] ^ masks[None, :]).ravel()).reshape(len(x), -1) << 2 | level[None, :]
    found.sort(axis=1)
    fresh = np.ones(found.shape, bool)
    fresh[:, 1:] = found[:, 1:] >> 2 != found[:, :-1] >> 2
    row, column = np.nonzero(fresh)
    kept = found[row, column]
    return row, kept >> 2, kept & 3


def replicas(fps: np.ndarray, wide: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows (key, fingerprint, home): each fingerprint at its home anchor and at all others that it visits, by band or by
    two bands."""
    out = []
    if not wide:
        for band in range(len(BANDS)):
            row, anchor, bits = anchors(band, values(fps, band), 1)
            out.append((anchor | band << 50, fps[row], bits == 0))
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))
    met = [anchors(band, values(fps, band), 2) for band in range(len(BANDS))]
    for table, (p, q) in enumerate(combinations(range(len(BANDS)), 2)):
        (row, a, i), (other, b, j) = met[p], met[q]
        # Each anchor of the first band with all of the same row in the second.
        size = np.bincount(other, minlength=len(fps))
        times = size[row]
        left = np.repeat(np.arange(len(row)), times)
        right = np.arange(len(left)) - np.repeat(np.cumsum(times) - times, times) + (np.cumsum(size) - size)[row[left]]
        near = i[left] + j[right] <= 2
        left, right = left[near], right[near]
        out.append((a[left] << 20 | b[right] | table << 50, fps[row[left]], i[left] + j[right] == 0))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def forest(homes: np.ndarray, visitors: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join what the links between homes and all rows of an anchor join."""
    nodes = np.concatenate([homes, visitors])
    labels = np.arange(len(nodes))
    step = max(1, 2_000_000 // len(nodes))
    for at in range(0, len(homes), step):
        i, j = np.nonzero(np.bitwise_count(homes[at : at + step, None] ^ nodes[None, :]) <= threshold)
        i += at
        if (i != j).any():
            labels = joined_labels(labels, i, j)
    moved = np.flatnonzero(labels != np.arange(len(nodes)))
    return nodes[moved], nodes[labels[moved]]


def fingerprint_edges(distinct: DataFrame, threshold: int = THRESHOLD, homes: int = HOMES, wide: bool | None = None) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) that connect exactly those that links connect."""
    if threshold > 4:
        raise ValueError("three bands cover four differing bits at most")
    wide = distinct.count() >= WIDE if wide is None else wide
    step = 1_000 if wide else 20_000

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, step):
                key, fp, home = replicas(b.column(0).to_numpy(zero_copy_only=False)[at : at + step].astype(np.int64), wide)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp), pa.array(home)], ["key", "fp", "home"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["key", "part"]):
            fp, home = group["fp"].to_numpy(), group["home"].to_numpy()
            a, b = forest(fp[home].view(np.uint64), fp[~home].view(np.uint64), threshold) if home.any() else (fp[:0], fp[:0])
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    rows = distinct.select("fp").mapInArrow(replicate, "key long, fp long, home boolean")
    dealt = hot_split(rows, "key", "fp", homes)
    n = width(distinct.sparkSession)
    return dealt.repartition(n, "key", "part").sortWithinPartitions("key", "part").mapInArrow(compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, threshold: int = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, fp, component) for each row of docs."""
    own = cut(fingerprints(docs, shingle, id_col, text_col))
    distinct = cut(own.groupBy("fp").agg(F.min("id").alias("least")))
    linked = components(fingerprint_edges(distinct, threshold))
    named = distinct.join(linked, distinct["fp"] == linked["node"], "left").select("fp", "least", "root")
    groups = named.where("root IS NOT NULL").groupBy("root").agg(F.min("least").alias("first"))
    classes = named.join(groups, "root", "left").select(F.col("fp").alias("of"), F.coalesce("first", "least").alias("component"))
    # AQE splits the partition of a fingerprint that many rows share.
    return own.join(classes, own["fp"] == classes["of"]).select(F.col("id").alias(id_col), F.col("fp").alias(free("fp", [id_col])), F.col("component").alias(free("component", [id_col])))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without near-duplicates, texts whose sets of five-word shingles have a Jaccard similarity of at least 0.8: links
    of their fingerprints are checked by it, and what four bits don't find signatures do. Of each component one row stays. Rows with an id are preferred, by id, then by hash of the text and of all columns; rows
    that are equal in all these are equal."""
    text = F.col(f"`{text_col}`").cast("string")
    whole = F.xxhash64(*columns(docs), *[c.isNull() for c in columns(docs)])
    place = F.struct(F.col(f"`{id_col}`").isNull().alias("no_id"), F.col(f"`{id_col}`").alias("id"), F.md5(F.coalesce(text, F.lit(""))).alias("text"), whole.alias("whole"))
    rows = beside(docs, place.alias("place"), text.alias("text"))
    first = jaccard.first_rows(rows, "place", fingerprint_edges).select(F.col("first.text").alias("t"), F.col("first.whole").alias("w")).distinct()
    marked = rows.select("row", F.col("place.text").alias("text"), F.col("place.whole").alias("whole"))
    kept = marked.join(first, (marked["text"] == first["t"]) & (marked["whole"] == first["w"]), "left_semi")
    return kept.dropDuplicates(["text", "whole"]).select("row.*")


QUERIES = {"op9_simhash_anchor_dedup": op9}
