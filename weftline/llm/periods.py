"""Periodic runs of words.

A run is a stretch of words with smallest period q that no neighbour extends and that is at least max(LEAST, TIMES * q)
long. Every run starts, within its first period, with a Lyndon word that is the longest one there under one of the two
orders of the words (which one depends on the word after the run). So each text is scanned from right to left under both
orders. The scan keeps, for each place, where the next smaller suffix starts, which is a stack of Lyndon words: an
earlier word swallows those after it that it is smaller than. Where the word found stands again right behind itself,
the repetition is extended to both sides.

Comparisons and extensions ask how far two places agree. That is answered by a few words compared directly, then by
doubling and halving over rolling hashes (modulo 2 ** 61 - 1, made only for texts that need them). A stretch found by
hashes is compared word by word before it counts, and remembered by its distance, so that it is compared once; if hashes
ever agreed wrongly, the words decide. No suffix array is made, and time is near linear even for a text of one word.

Texts are scanned inside the row, without a shuffle.

Defined cases: a null text has no words; a text without runs has no best run, the digest of nothing for its runs and all
its words kept; equal exponents go to the smaller start, then to the smaller period; a null id is the empty id where the
id matters; repeated rows give the same results; an empty table gives no rows; docs may have columns of any names.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from weftline.llm.common import batched, free, table

#: A run has at least LEAST words and at least TIMES periods.
LEAST, TIMES = 6, 4
#: Words compared directly before hashes are asked, the hashes' modulus and base.
DIRECT, MODULUS, BASE = 8, (1 << 61) - 1, 0x1F3D5B79A2C4E681
#: Bytes of texts of one batch in a worker.
BYTES = 8 << 20

_WORDS = re.compile("[^ \t-\r]+")


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall(text or "")


class Agreement:
    """How far the words at two places agree, to the right and to the left."""

    def __init__(self, words: list[int]):
        self.words, self.n = words, len(words)
        self.hashes: list[int] | None = None
        #: distance -> (from, to): all words of that stretch agree with those at the distance, the one at `to` doesn't.
        self.known: dict[int, tuple[int, int]] = {}

    def _hashed(self) -> None:
        h, made = 0, [0]
        for w in self.words:
            h = (h * BASE + w + 1) % MODULUS
            made.append(h)
        power, powers = 1, [1]
        for _ in self.words:
            power = power * BASE % MODULUS
            powers.append(power)
        self.hashes, self.powers = made, powers

    def _equal(self, i: int, j: int, k: int) -> bool:
        """Whether the hashes of k words from i and from j are equal."""
        h, p = self.hashes, self.powers[k]
        return (h[i + k] - h[i] * p - h[j + k] + h[j] * p) % MODULUS == 0

    def _longest(self, least: int, most: int, agree) -> int:
        """The largest k with agree(k), for which all smaller k agree too; least agrees."""
        if self.hashes is None:
            self._hashed()
        step, low = max(1, least), least
        while low < most and agree(min(most, low + step)):
            low = min(most, low + step)
            step *= 2
        high = min(most, low + step)
        while low + 1 < high:
            mid = (low + high) // 2
            low, high = (mid, high) if agree(mid) else (low, mid)
        return low

    def right(self, i: int, j: int) -> int:
        """The number of words from i on that equal those from j on; i < j."""
        w, n, d = self.words, self.n, j - i
        seen = self.known.get(d)
        if seen is not None:
            low, high = seen
            if low <= i <= high:
                return high - i
            if i < low <= j and w[i:low] == w[j : low + d]:
                self.known[d] = (i, high)
                return high - i
        k, most = 0, n - j
        direct = min(DIRECT, most)
        while k < direct and w[i + k] == w[j + k]:
            k += 1
        if k < DIRECT or k == most:
            return k
        k = self._longest(k, most, lambda k: self._equal(i, j, k))
        if w[i : i + k] != w[j : j + k]:
            k = next(x for x in range(k) if w[i + x] != w[j + x])
        while k < most and w[i + k] == w[j + k]:
            k += 1
        self.known[d] = (i, i + k)
        return k

    def left(self, i: int, j: int) -> int:
        """The number of words before i that equal those before j; i < j."""
        w, d = self.words, j - i
        k, direct = 0, min(DIRECT, i)
        while k < direct and w[i - k - 1] == w[j - k - 1]:
            k += 1
        if k == DIRECT and k < i:
            k = self._longest(k, i, lambda k: self._equal(i - k, j - k, k))
            if w[i - k : i] != w[j - k : j]:
                k = next(x for x in range(k) if w[i - x - 1] != w[j - x - 1])
            while k < i and w[i - k - 1] == w[j - k - 1]:
                k += 1
        seen = self.known.get(d)
        if seen is not None and seen[0] <= i <= seen[1]:
            self.known[d] = (min(seen[0], i - k), seen[1])
        return k


def _scan(words: list[int], least: int, times: int, found: dict[tuple[int, int], int]) -> None:
    """Adds to found, (start, period) -> end, the runs whose Lyndon words are the longest under the order of words."""
    n, agreement = len(words), Agreement(words)
    right, smaller, last = agreement.right, [n] * n, {}
    for i in range(n - 1, -1, -1):
        own, j, k = words[i], i + 1, 0
        while j < n:
            other = words[j]
            if own < other:
                j = smaller[j]
            elif own > other:
                break
            else:
                k = right(i, j)
                if j + k == n or words[i + k] > words[j + k]:
                    break
                j = smaller[j]
        smaller[i] = j
        if j == n or words[j] != own:
            continue
        q = j - i
        # The first of a run's Lyndon words has times - 1 periods behind its start, and it and its repetitions agree.
        if i + (times - 1) * q > n:
            continue
        before = last.get(q)
        if before is not None and before[0] <= i and j < before[1]:
            continue
        k = right(i, j)
        if k < (times - 2) * q:
            continue
        start, end = i - agreement.left(i, j), j + k
        last[q] = (start, end)
        if end - start >= max(least, times * q):
            found[start, q] = end


def runs_of(words: list, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period. times must be at least 2."""
    if times < 2:
        raise ValueError("a run holds its period twice at least")
    if len(words) < max(least, times):
        return []
    numbers: dict = {}
    ids = [numbers.setdefault(w, len(numbers)) for w in words]
    if len(numbers) == len(ids):
        return []
    found: dict[tuple[int, int], int] = {}
    _scan(ids, least, times, found)
    most = len(numbers)
    _scan([most - w for w in ids], least, times, found)
    return [(start, end - start, q) for (start, q), end in sorted(found.items())]


def best_of(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest exponent; runs come by start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words that no run repeats: of each run its first period stays, unless another run repeats it."""
    if not runs:
        return words
    change = [0] * (len(words) + 1)
    for start, length, q in runs:
        change[start + q] += 1
        change[start + length] -= 1
    kept, depth = [], 0
    for word, step in zip(words, change, strict=False):
        depth += step
        if not depth:
            kept.append(word)
    return kept


def planted(doc_id, words: list[str]) -> list[str]:
    """words; for one id in ten, from some place on the words repeat those from there."""
    g, tenth = divmod(zlib.crc32(("" if doc_id is None else str(doc_id)).encode()), 10)
    n = len(words)
    if tenth or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    root = words[a : a + p]
    return words[:a] + (root * ((n - a) // p + 1))[: n - a]


_RUN = StructType([StructField(c, LongType()) for c in ("start", "length", "period")])


def _found(docs: DataFrame, id_col: str, text_col: str, carried, plant: bool, kind: StructType, result) -> DataFrame:
    """One row for each of docs: carried, and the columns of kind that result(words, runs) gives."""
    rows = docs.select(F.struct(*carried).alias("row"), F.col(f"`{id_col}`").cast("string").alias("i"), F.col(f"`{text_col}`").cast("string").alias("t"))
    schema = StructType([rows.schema["row"], *kind])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = []
        for i, t in zip(batch.column("i"), batch.column("t"), strict=True):
            words = words_of(t.as_py())
            if plant:
                words = planted(i.as_py(), words)
            made.append(result(words, runs_of(words)))
        from pyspark.sql.pandas.types import to_arrow_type

        new = [pa.array([m[k] for m in made], to_arrow_type(f.dataType)) for k, f in enumerate(kind)]
        return pa.RecordBatch.from_arrays([batch.column("row"), *new], ["row", *kind.names])

    def batches(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batched(run, them, BYTES)

    return rows.mapInArrow(batches, schema)


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", runs_col: str = "runs", collapsed_col: str = "collapsed") -> DataFrame:
    """docs plus the array runs_col of (start, length, period), and collapsed_col, the text without repeated periods."""
    kind = StructType([StructField("runs", ArrayType(_RUN)), StructField("kept", StringType())])
    found = _found(docs, id_col, text_col, [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns], False, kind, lambda words, runs: ([dict(zip(_RUN.names, r, strict=True)) for r in runs], " ".join(collapsed(words, runs))))
    return found.select("row.*", F.col("runs").alias(free(runs_col, docs.columns)), F.col("kept").alias(free(collapsed_col, [*docs.columns, runs_col])))


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    longs = ("n_runs", "start", "length", "period", "exponent_milli")
    kind = StructType([*[StructField(c, LongType()) for c in longs], StructField("runs_sha256", StringType()), StructField("collapsed_sha256", StringType())])

    def row(words: list[str], runs: list[tuple[int, int, int]]) -> tuple:
        best = best_of(runs)
        exponent = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        return (len(runs), *exponent, _digest("".join(f"{s},{k},{q}\n" for s, k, q in runs)), _digest(" ".join(collapsed(words, runs))))

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _found(docs, "doc_id", "text", [F.col("doc_id")], True, kind, row).select("row.doc_id", *kind.names)


QUERIES = {"op12_lyndon_runs": op12}
