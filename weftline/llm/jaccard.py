"""Near-duplicates by the Jaccard similarity of sets of word shingles.

Two sets of m and n shingles are linked if they share at least the share LEAST of their union, that is at least
LEAST / (1 + LEAST) of m + n. Pairs whose SimHash fingerprints are linked by anchors (simhash) are
compared first and give the first labels. Four bits of 64 find few pairs at the least similarity, so other candidates share a signature: BANDS signatures of a set are each made of ROWS of its minima
under different hashes. A pair at the least similarity of 0.8 shares none with a chance of (1 - 0.8 ** 5) ** 40, about one
in eight million, and one of higher similarity with a lower one. All candidates are compared by their whole sets, so none
is linked that isn't similar enough, up to collisions of 64-bit hashes of shingles and sets.

Large groups of near copies share many signatures. First every signature's sets meet only its leader, that of them of whose
signatures the most are shared. A set's label is then the least set that it is linked with in two steps, so that sets of
one label are connected. In some rounds the sets of a signature whose label isn't its most frequent one meet a few sets of
that label, others for each signature, and labels that turn out linked become one. Last, sets whose label still isn't their
signature's most frequent one meet all others of another label, which is every pair left that could connect
anything. Pairs that can't be linked are never compared: their distances from the leader differ by more than a link allows, or the
bits of one that the other lacks are too many.
Whole sets are made once, of the sets that share a signature: a bitmap of EACH bits for one and BITS at most tells them
from the others before the shuffle.

Defined cases: words and letters as in simhash; null and wordless texts have the empty set and are equal; fewer words
than a shingle make one shingle of them all; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from weftline.llm.common import components, gone, kept, merged, mixed

SHINGLE, SEED = 5, 42
#: The least similarity, as a fraction.
LEAST = (4, 5)
#: Signatures of a set, and minima that each is made of.
BANDS, ROWS = 40, 5
#: Bits of a bitmap of sets: so many for each, and at most.
EACH, BITS = 32, 1 << 26
#: Sets of a signature's main label that the others meet, by round.
MET = (2, 8)
#: Longs of the sketch of a set that bounds what it shares with another.
SKETCH = 32
#: Words whose hashes a worker remembers, and their longest.
WORDS, LONGEST = 1 << 15, 64


class Hashes(dict):
    """Hashes of words, each made once as long as the table is small."""

    def __missing__(self, word: bytes) -> int:
        made = xxhash.xxh64_intdigest(word, SEED)
        if len(word) <= LONGEST:
            if len(self) >= WORDS:
                self.clear()
            self[word] = made
        return made


_HASHES = Hashes()


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The set of 64-bit hashes of a text's word shingles, sorted: a polynomial in the words' hashes, mixed."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, n)
    size = min(size, n)
    made = np.full(n - size + 1, size, np.uint64)
    for k in range(size):
        made = made * np.uint64(0x9E3779B97F4A7C15) + each[k : n - size + 1 + k]
    made ^= made >> np.uint64(32)
    made *= np.uint64(0xD6E8FEB86659FD93)
    return np.unique(made ^ (made >> np.uint64(32)))


def name(found: np.ndarray) -> int:
    """What tells a set from others, as a signed long."""
    return int(np.uint64(xxhash.xxh64_intdigest(found.tobytes(), SEED)).view(np.int64))


_TURNS = np.random.default_rng(SEED).integers(1 << 63, size=BANDS * ROWS, dtype=np.uint64)[:, None]


def signatures(found: np.ndarray) -> np.ndarray:
    """The BANDS signatures of a set; the empty set's are those of no other."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 2048):
        turned = (found[None, at : at + 2048] ^ _TURNS) * np.uint64(0x9E3779B97F4A7C15)
        turned ^= turned >> np.uint64(29)
        np.minimum(least, (turned * np.uint64(0xBF58476D1CE4E5B9)).min(1), out=least)
    made = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        made = (made ^ least[k::ROWS]) * np.uint64(0xD6E8FEB86659FD93)
        made ^= made >> np.uint64(32)
    return made


def fingerprint(found: np.ndarray) -> int:
    """The signed SimHash of a set: a bit is 1 if set in over half the hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(found), 65_536):
        ones += np.unpackbits(found[at : at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(found), bitorder="little").view(np.int64)[0])


def lists(made: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, made)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(made).view(np.int64)))


def signed(rows: DataFrame) -> DataFrame:
    """(id, set, size, fp, signatures) for each of rows (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                made = [shingles(t.as_py()) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([name(m) for m in made], pa.int64()), pa.array([len(m) for m in made], pa.int64()), pa.array([fingerprint(m) for m in made], pa.int64()), lists([signatures(m) for m in made])], ["id", "set", "size", "fp", "signatures"])

    return rows.mapInArrow(run, StructType([rows.schema["id"], StructField("set", LongType()), StructField("size", LongType()), StructField("fp", LongType()), StructField("signatures", ArrayType(LongType()))]))


def members(sets: DataFrame, size: int) -> np.ndarray:
    """A bitmap of size bits of the sets in a column `set`; each of its few rows holds 4 KB."""
    at = F.pmod("set", F.lit(size)) + 1  # these functions count from one
    rows = sets.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect()
    found = np.zeros(size // 8, np.uint8)
    for bucket, bits in rows:
        found[(bucket - 1) * len(bits) : bucket * len(bits)] = np.frombuffer(bits, np.uint8)
    return found


def sketch(found: np.ndarray) -> np.ndarray:
    bits = np.zeros(64 * SKETCH, np.uint8)
    bits[(found & np.uint64(64 * SKETCH - 1)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64)


def whole_sets(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(set, shingles, bits), kept, of the sets wanted, each once; bits has the bits set that the shingles' last bits say."""
    wanted = kept(wanted)
    size = min(BITS, max(1 << 15, 1 << (EACH * wanted.count()).bit_length()))
    shared = rows.sparkSession.sparkContext.broadcast(members(wanted, size).tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                made = {name(m): m for m in (shingles(t.as_py()) for t in b.column(0)[at : at + 1000])}
                fine = {k: m for k, m in made.items() if bits[k % size >> 3] >> (k % size & 7) & 1}
                if fine:
                    yield pa.RecordBatch.from_arrays([pa.array(list(fine), pa.int64()), lists(list(fine.values())), lists([sketch(m) for m in fine.values()])], ["set", "shingles", "bits"])

    made = rows.select("text").mapInArrow(run, "set long, shingles array<long>, bits array<long>")
    found = kept(made.join(merged(wanted), "set", "left_semi").dropDuplicates(["set"]))
    # Nothing reads the bitmap any more, which the driver would hold as long as the application runs.
    shared.destroy()
    gone(wanted)
    return found


def enough(shared: Column, m: Column, n: Column) -> Column:
    """Whether so many shared shingles of sets of m and n make a link."""
    return shared * sum(LEAST) >= (m + n) * LEAST[0]


def measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, far, near): the distance (1 less the similarity) of the pairs (a, b) of sets, from (set, shingles), and whether
    they are linked."""
    a = sets.select(F.col("set").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("set").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(merged(a), "a").join(merged(b), "b").select("a", "b", F.size("sa").alias("m"), F.size("sb").alias("n"), F.size(F.array_intersect("sa", "sb")).alias("shared"))
    return kept(both.select("a", "b", (1 - F.col("shared") / (F.col("m") + F.col("n") - F.col("shared"))).alias("far"), enough(F.col("shared"), F.col("m"), F.col("n")).alias("near")))


def pair(left: str = "set", right: str = "set_b", a: str = "a", b: str = "b") -> list[Column]:
    return [F.least(left, right).alias(a), F.greatest(left, right).alias(b)]


def alone(bits: str, other_bits: str) -> Column:
    """At least so many shingles of a set aren't in another: bits that only it has set."""
    return F.aggregate(F.zip_with(bits, other_bits, lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y)))), F.lit(0), lambda s, n: s + n)


def near() -> Column:
    """Whether a set and one of other() may share enough, by their sizes, their distances from a third (which obey the
    triangle's inequality) and their sketches."""
    m, n = F.col("size"), F.col("size_b")
    apart = F.abs(F.col("far") - F.col("far_b"))
    first = enough(F.least(m, n), m, n) & F.coalesce(apart <= 1 - LEAST[0] / LEAST[1] + 1e-9, F.lit(True))
    return F.when(first, enough(F.least(m - alone("bits", "bits_b"), n - alone("bits_b", "bits")), m, n)).otherwise(False)


def other(rows: DataFrame) -> DataFrame:
    """rows with all columns but signature renamed, for a join of rows with each other."""
    return rows.select("signature", *[F.col(c).alias(f"{c}_b") for c in rows.columns if c != "signature"])


def labels(links: DataFrame) -> DataFrame:
    """(set, root): the least set within two links of each linked set."""
    both = links.union(links.select("b", "a"))
    one = both.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("b"))
    two = one.select(F.col("a").alias("b"), F.col("b").alias("c"))
    return one.join(merged(two), "b").select(F.col("a").alias("set"), "c").withColumnRenamed("c", "root")


def anchored(distinct: DataFrame, fingerprint_edges: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(a, b): pairs of sets (set, fp) whose fingerprints are equal or linked by anchors, that connect what these connect."""
    heads = kept(distinct.groupBy("fp").agg(F.min("set").alias("head")))
    near = fingerprint_edges(heads.select("fp"))
    one, two = heads.select(F.col("fp").alias("a"), F.col("head").alias("set")), heads.select(F.col("fp").alias("b"), F.col("head").alias("set_b"))
    equal = distinct.select("set", "fp").join(merged(heads), "fp").select("set", F.col("head").alias("set_b"))
    return kept(equal.union(near.join(merged(one), "a").join(merged(two), "b").select("set", "set_b")).where("set <> set_b").select(*pair()).distinct())


def edges(met: DataFrame, rows: DataFrame, near_prints: DataFrame) -> DataFrame:
    """Edges (a, b) that connect the sets that links connect, from rows (signature, set, size) of the sets, the texts, and
    pairs (a, b) that fingerprints find."""
    common = met.groupBy("signature").agg(F.min("set").alias("least"), F.max("set").alias("most")).where("least <> most").select("signature")
    live = kept(met.join(merged(common), "signature"))
    named = near_prints.select(F.explode(F.array("a", "b")).alias("set"))
    sets = whole_sets(rows, live.select("set").union(named).distinct())
    close = measured(near_prints, sets).where("near").select("a", "b")
    counts = live.groupBy("set").agg(F.count(F.lit(1)).alias("n"))
    leaders = live.join(merged(counts), "set").groupBy("signature").agg(F.max(F.struct("n", "set", "size")).alias("first"))
    first = leaders.select("signature", F.col("first.set").alias("set_b"))
    met = kept(live.join(merged(first), "signature").select("signature", "set", "size", "set_b", *pair()))
    star = measured(met.where("a <> b").select("a", "b").distinct(), sets)
    found = close.union(star.where("near").select("a", "b"))
    # How far each set is from its signature's leader.
    apart = met.join(merged(star.select("a", "b", "far")), ["a", "b"], "left").select("signature", "set", "size", F.when(F.col("a") == F.col("b"), 0.0).otherwise(F.col("far")).alias("far"))
    rest = kept(apart.join(merged(labels(found)), "set", "left").select("signature", "set", "size", "far", F.coalesce("root", "set").alias("root")))
    gone(live, met)
    for k in range(len(MET) + 1):
        roots = rest.groupBy("signature", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("signature").agg(F.max(F.struct("n", "root")).alias("most"), F.count(F.lit(1)).alias("roots"))
        # Signatures of one label are done with.
        left = rest.join(merged(roots.where("roots > 1").select("signature", F.col("most.root").alias("major"))), "signature")
        left = kept(left if k else left.join(merged(sets.select("set", "bits")), "set"))
        gone(rest)
        rest = left
        if left.isEmpty():
            break
        minor, met = left.where("root <> major").drop("major"), left.drop("major")
        if k < len(MET):
            # Other members of the main label for each signature, so that a set meets many of them.
            one, slot = F.max_by(F.struct("set", "size", "far", "bits", "root"), F.xxhash64("signature", "set", F.lit(k))), F.pmod(F.xxhash64("set"), F.lit(MET[k]))
            met = left.where("root = major").groupBy("signature", slot).agg(one.alias("m")).select("signature", "m.*")
        pairs = kept(minor.join(merged(other(met)), "signature").where((F.col("root") != F.col("root_b")) & near()).select(*pair(), *pair("root", "root_b", "x", "y")).distinct())
        new = measured(pairs.select("a", "b").distinct(), sets).where("near").select("a", "b")
        found = found.union(new)
        if k < len(MET):
            # Labels are linked where sets of theirs are.
            joined = labels(pairs.join(merged(new), ["a", "b"], "left_semi").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()).select(F.col("set").alias("root"), F.col("root").alias("to"))
            rest = kept(left.drop("major").join(merged(joined), "root", "left").select("signature", "set", "size", "far", "bits", F.coalesce("to", "root").alias("root")))
            gone(left)
        gone(pairs)
    gone(rest, sets)
    return found


def first_rows(docs: DataFrame, id_col: str, fingerprint_edges: Callable[[DataFrame], DataFrame], text_col: str = "text") -> DataFrame:
    """(first): the smallest id_col of each component of docs. fingerprint_edges links distinct fingerprints (column fp)."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    distinct = kept(signed(rows).groupBy("set").agg(F.min("id").alias("least"), F.first("size").alias("size"), F.first("fp").alias("fp"), F.first("signatures").alias("signatures")))
    met = distinct.select(F.explode("signatures").alias("signature"), "set", "size")
    joined = components(edges(met, rows, anchored(distinct, fingerprint_edges)))
    named = distinct.join(merged(joined), distinct["set"] == joined["node"], "left").select("least", F.coalesce("root", mixed(F.col("set"))).alias("root"))
    return named.groupBy("root").agg(F.min("least").alias("first")).select("first")
