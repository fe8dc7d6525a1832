"""Document fingerprints by content-defined chunking.

A gear hash rolls over a text's UTF-8 bytes; a chunk ends where its masked bits are zero, under a strict mask before the
normal size and a loose one after it (normalised chunking), never under LEAST and at MOST bytes at the latest. As
boundaries depend on the 32 bytes before them alone, an edit moves only the chunks around it. The fingerprint is the set
of the chunks' digests, each with the bytes its chunks hold; the containment of one text in another is the share of its
bytes whose digests the other has too.

Neighbours in the descending order of ids meet in one range: rows are dealt to ranges of ids, the head of each range is
copied to the range before it, and each range is streamed in order. An id that many rows have, as null, is dealt to ranges
of its texts' hashes, and equal rows that a batch has several of travel as one with their number. Text is shuffled once.

Defined cases: null text is empty; an empty text has the fingerprint of no chunks, is contained fully in every empty
text and not at all in others; rows with equal ids follow in descending order of their text's hash and text, and null ids
come last; the last row's next is the first; a single row is its own next; an empty table gives no rows; ids are whole
numbers (others are refused, as their order would be lost); other columns of docs are left out, and where id_col is the
name of a result column, that column's name gets a trailing underscore.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from weftline.llm.common import free, table, width

LEAST, NORMAL, MOST = 32, 64, 192
STRICT, LOOSE = np.uint32(0b1111111 << 25), np.uint32(0b11111 << 27)
#: The gear table, by rule: the low words of XXH64 of each byte.
GEAR = np.array([xxhash.xxh64_intdigest(bytes([b]), 7) & 0xFFFFFFFF for b in range(256)], np.uint32)
#: Rows that a range holds about; ranges at most.
RANGE_ROWS, MOST_RANGES = 1500, 20_000


def gear(data: bytes) -> np.ndarray:
    """The gear hash after each byte: the sum over the last 32 bytes of their gear shifted by their distance."""
    h = GEAR[np.frombuffer(data, np.uint8)]
    span = 1
    while span < 32:
        more = h.copy()
        more[span:] += h[:-span] << np.uint32(span)
        h, span = more, 2 * span
    return h


def chunk_ends(data: bytes, least: int = LEAST, normal: int = NORMAL, most: int = MOST) -> list[int]:
    """Where the chunks of data end."""
    n = len(data)
    if n <= least:
        return [n] if n else []
    h = gear(data)
    loose = np.flatnonzero((h & LOOSE) == 0)
    strict = ((h[loose] & STRICT) == 0).tolist()
    loose = (loose + 1).tolist()
    ends, start, k = [], 0, 0
    while n - start > least:
        while k < len(loose) and loose[k] < start + least:
            k += 1
        i, end = k, min(n, start + most)
        while i < len(loose) and loose[i] <= end:
            if strict[i] or loose[i] >= start + normal:
                end = loose[i]
                break
            i += 1
        ends.append(end)
        start = end
    if start < n:
        ends.append(n)
    return ends


def chunk_set(text: str) -> dict[int, int]:
    """digest -> bytes of the chunks with it."""
    data = text.encode("utf-8", "surrogatepass")
    found: dict[int, int] = {}
    at = 0
    digest = xxhash.xxh64_intdigest
    for end in chunk_ends(data):
        d = digest(data[at:end])
        found[d] = found.get(d, 0) + end - at
        at = end
    return found


def fingerprint(chunks: dict[int, int]) -> str:
    """digest:bytes of all chunks, by digest."""
    return " ".join(f"{d:016x}:{n}" for d, n in sorted(chunks.items()))


def containment(a: dict[int, int], b: dict[int, int]) -> float:
    """The share of a's bytes in chunks that b has too."""
    if not a or not b:
        return float(not a and not b)
    return sum(min(n, b[d]) for d, n in a.items() if d in b) / sum(a.values())


def edited(text: str, following: str) -> str:
    """text with its last floor(n/2) code points replaced by the first as many (or all) of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_NULL = -(2**63)


class Ranges:
    """Numbers of ranges of about so many rows, ascending with (whether there is an id, the id, the hash)."""

    def __init__(self, docs: DataFrame, rows: int):
        n, known = docs.agg(F.count(F.lit(1)), F.count("id")).first()
        ranges = min(max(-(-n // rows), 4 * width(docs.sparkSession)), -(-n // 32), MOST_RANGES)
        size = max(1, -(-n // max(1, ranges)))
        found: list[int] = []
        if known > size:
            steps = -(-known // size)
            found = docs.agg(F.percentile_approx("id", [k / steps for k in range(1, steps)], 20 * steps).alias("c")).first()["c"] or []
        held = Counter(found)
        # An id that ends several ranges has them all for itself.
        hot = {c: m for c, m in held.items() if m > 1}
        self.cuts = np.array(sorted({*held, *(c - 1 for c in hot if c > _NULL)}), np.int64)
        parts = [max(1, -(-(n - known) // size))] + [1] * (len(self.cuts) + 1)
        for c, m in hot.items():
            parts[1 + int(np.searchsorted(self.cuts, c))] = m
        self.parts = np.array(parts, np.int64)
        self.first = np.cumsum(self.parts) - self.parts

    def of(self, ids: pa.Array, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of each row, and the ids with null as the least."""
        filled = ids.fill_null(_NULL).to_numpy(zero_copy_only=False)
        span = np.where(ids.is_null().to_numpy(zero_copy_only=False), 0, 1 + np.searchsorted(self.cuts, filled, side="left"))
        share = (hashes.astype(np.float64) / 2.0**64 + 0.5).clip(0, 1 - 1e-12)
        return (self.first[span] + (share * self.parts[span]).astype(np.int64)).astype(np.int32), filled


def with_next(docs: DataFrame, made, schema: str, id_col: str = "doc_id", text_col: str = "text", rows: int = RANGE_ROWS) -> DataFrame:
    """made(stream) over each partition, where stream gives (id, text, next text) of each row in its order.

    made is a function from an iterator of those to an iterator of record batches of the given schema.
    """
    if not isinstance(docs.schema[id_col].dataType, IntegralType):
        raise TypeError("ids must be whole numbers")
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    ranges = Ranges(own, rows)

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[int, int]] = {}
        for b in batches:
            hashes = b.column(1).to_numpy(zero_copy_only=False)
            number, ids = ranges.of(b.column(0), hashes)
            order = np.lexsort((hashes, ids, number))
            last = np.flatnonzero(np.append(np.diff(number[order]) != 0, True)) if len(order) else []
            for at in order[last].tolist() if len(order) else []:
                key = (int(ids[at]), int(hashes[at]))
                best[int(number[at])] = max(key, best.get(int(number[at]), key))
        yield pa.RecordBatch.from_arrays([pa.array(list(best), pa.int32()), pa.array([k[0] for k in best.values()], pa.int64()), pa.array([k[1] for k in best.values()], pa.int64())], ["range", "id", "hash"])

    # One row per range reaches the driver; there are a few times MOST_RANGES at most.
    heads = own.select("id", "hash").mapInArrow(tops, "range int, id long, hash long").groupBy("range").agg(F.max(F.struct("id", "hash")).alias("top")).collect()
    numbers = sorted(r["range"] for r in heads)
    # Descending, a range is followed by the next lower one, and the lowest by the highest.
    before = {r: numbers[(k + 1) % len(numbers)] for k, r in enumerate(numbers)}
    head_of = {r["range"]: (r["top"]["id"], r["top"]["hash"]) for r in heads}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes = b.column(2).to_numpy(zero_copy_only=False)
            number, ids = ranges.of(b.column(0), hashes)
            seen: dict[tuple, list[int]] = {}
            for k, key in enumerate(zip(number.tolist(), ids.tolist(), hashes.tolist(), strict=True)):
                seen.setdefault(key, []).append(k)
            first, copies, moved = [], [], []
            for key, at in seen.items():
                texts = Counter(b.column(1)[k].as_py() for k in at) if len(at) > 1 else {None: 1}
                if len(texts) == 1:
                    first.append(at[0]), copies.append(len(at))
                else:
                    first.extend(at), copies.extend([1] * len(at))
                if head_of[key[0]] == key[1:]:
                    moved.extend(at if len(texts) > 1 else at[:1])
            names = ["range", "head", "copies", "id", "text", "hash"]
            rows = b.take(pa.array(first, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(number[first]), pa.array(np.zeros(len(first), bool)), pa.array(copies, pa.int64()), *rows.columns], names)
            if moved:
                rows = b.take(pa.array(moved, pa.int64()))
                to = pa.array([before[int(number[k])] for k in moved], pa.int32())
                yield pa.RecordBatch.from_arrays([to, pa.array(np.ones(len(moved), bool)), pa.array(np.ones(len(moved)), pa.int64()), *rows.columns], names)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        held, done = None, None
        for b in batches:
            for number, head, copies, i, text in zip(*(b.column(k).to_pylist() for k in range(5)), strict=True):
                if held is not None and held[0] == number and done != number:
                    yield held[1], held[2], text
                if head:
                    done, held = number, None
                else:
                    # Of equal rows each but the last is followed by its like.
                    for _ in range(copies - 1):
                        yield i, text, text
                    held = (number, i, text)

    dealt = own.select("id", "text", "hash").mapInArrow(deal, "range int, head boolean, copies long, id long, text string, hash long")
    sorted_rows = dealt.repartition(width(docs.sparkSession), "range").sortWithinPartitions("range", "head", F.desc_nulls_last("id"), F.desc("hash"), F.desc("text"))
    return sorted_rows.mapInArrow(lambda batches: made(stream(batches)), schema)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batch: int = 512) -> DataFrame:
    """One row per row of docs: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
    names = (id_col, *(free(n, [id_col]) for n in ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")))

    def made(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        known, chunks = None, {}
        out: list[tuple] = []
        for i, text, following in rows:
            mine = chunks if text == known else chunk_set(text)
            known, chunks = following, mine if following == text else chunk_set(following)
            new = edited(text, following)
            other = chunk_set(new)
            out.append((i, len(text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), fingerprint(mine), fingerprint(other), containment(mine, other), containment(mine, chunks)))
            if len(out) >= batch:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    schema = ", ".join(f"`{n}` {k}" for n, k in zip(names, ("long", "long", "string", "string", "string", "double", "double"), strict=True))
    return with_next(docs, made, schema, id_col, text_col)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


QUERIES = {"op7_chunk_fingerprints": op7}
