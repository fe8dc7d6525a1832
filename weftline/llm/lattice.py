"""Embedding near-duplicates by lattice hashing.

Unit vectors are projected at random to 16 dimensions, in TABLES independent tables; each half of a projection is decoded
to the nearest point of the E8 lattice, and the two points are the cell of the vector in that table. A vector lives in
its home cell and also visits, per half, the neighbouring lattice points that it lies closest to. Homes are compared
with the homes and visitors of their cell; the cosine, in double precision, decides.

Equal vectors meet once: comparisons are between distinct ones, each with the number of its copies. A pair may meet in
several tables; it counts in the first where it does, which each side's cells tell, so link counts need no pair table.
Per cell a task gives each vector's count and a spanning forest of the links, never all pairs. Cells with more than HOMES
homes are dealt into parts.

What it finds: all links given are true ones (cosine >= 0.95, decided in double precision on the given components).
Recall by one pair's cosine, on 20,000 random unit vectors of 64 dimensions: about 0.98 at 0.95, 0.99 at 0.96 and 0.999
at 0.98; the tests measure it against brute force. SCALE sets the cells' size: smaller cells hold fewer vectors and find
fewer of the pairs near the threshold.

Defined cases: null vectors and those that are zero, empty or hold null or non-finite components link with nothing and are their own
component; vectors of different lengths don't link; rows with equal vectors link with each other; repeated ids are
vectors of their own but share the component's naming; a null id keeps its row, and a component's id is its smallest
non-null id; ids are whole numbers (others are refused); an empty table gives no rows; other columns of rows are left out,
and a result column that is called like id_col gets a trailing underscore.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from weftline.llm.common import components, cut, free, hot_split, joined_labels, table, whole_groups, width

COSINE, TABLES, VISITS, SCALE, SEED, HOMES = 0.95, 5, 1, 0.85, 11, 8_000
HALVES = 2


def e8(x: np.ndarray) -> np.ndarray:
    """Twice the point of the E8 lattice nearest to each row of x, in integers."""

    def d8(y: np.ndarray) -> np.ndarray:
        r = np.rint(y)
        odd = np.flatnonzero(r.sum(axis=1).astype(np.int64) & 1)
        if len(odd):
            gap = y[odd] - r[odd]
            worst = np.abs(gap).argmax(axis=1)
            r[odd, worst] += np.where(gap[np.arange(len(odd)), worst] >= 0, 1, -1)
        return r

    a, b = d8(x), d8(x - 0.5) + 0.5
    near = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
    return np.rint(2 * np.where(near[:, None], a, b)).astype(np.int64)


def e8_roots() -> np.ndarray:
    """Twice the 240 shortest vectors of the lattice, by their definition."""
    whole = []
    for i, j in combinations(range(8), 2):
        for s, t in product((2, -2), repeat=2):
            v = [0] * 8
            v[i], v[j] = s, t
            whole.append(v)
    half = [v for v in product((1, -1), repeat=8) if v.count(-1) % 2 == 0]
    return np.array(whole + half, np.int64)


ROOTS = e8_roots()


def key_of(points: np.ndarray) -> np.ndarray:
    """A 64-bit key of each row of lattice coordinates (exact for |coordinate| < 128 in eight dimensions, mixed beyond)."""
    h = np.zeros(len(points), np.uint64)
    for c in points.T:
        h = (h ^ (c.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return h


def projections(dim: int, tables: int = TABLES, seed: int = SEED) -> np.ndarray:
    """Orthonormal random directions, (tables, 16, dim), scaled so that a unit vector's half has norm about 1."""
    rng = np.random.default_rng([seed, dim])
    out = []
    for _ in range(tables):
        g = rng.standard_normal((8 * HALVES, max(dim, 1)))
        out.append(g / np.sqrt(8.0))
    return np.array(out)


def cells(unit: np.ndarray, tables: int = TABLES, visits: int = VISITS, scale: float = SCALE, seed: int = SEED) -> np.ndarray:
    """Keys (rows, tables, 1 + visits per half): the home cell of each row and those it visits."""
    n, dim = unit.shape
    out = np.zeros((n, tables, 1 + HALVES * visits), np.uint64)
    for t, p in enumerate(projections(dim, tables, seed)):
        y = unit @ p.T / scale
        points, around = [], []
        for h in range(HALVES):
            half = y[:, 8 * h : 8 * h + 8]
            home = e8(half)
            gap = half - home / 2
            # Of the 240 neighbours the closest are those whose direction the gap points along most.
            reach = gap @ ROOTS.T
            best = np.argpartition(-reach, visits - 1, axis=1)[:, :visits] if visits else np.zeros((n, 0), np.int64)
            points.append(home)
            around.append(home[:, None, :] + ROOTS[best])
        salt = np.uint64((t + 1) * 0x94D049BB133111EB & 0xFFFFFFFFFFFFFFFF)
        own = [key_of(q) for q in points]
        join = lambda a, b: (a * np.uint64(3) + (b ^ (b >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)) ^ salt
        out[:, t, 0] = join(own[0], own[1])
        for v in range(visits):
            out[:, t, 1 + v] = join(key_of(around[0][:, v]), own[1])
            out[:, t, 1 + visits + v] = join(own[0], key_of(around[1][:, v]))
    return out


def meets(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, t: int) -> np.ndarray:
    """Whether rows i of cells a and rows j of cells b meet in table t: one's home is the other's home or visited."""
    x, y = a[i, t], b[j, t]
    return (x[:, :1] == y).any(axis=1) | (y[:, :1] == x).any(axis=1)


def usable_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of all rows; v is null where the vector can't link."""
    if not isinstance(rows.schema[id_col].dataType, IntegralType):
        raise TypeError("ids must be whole numbers")
    v = F.col(f"`{vector_col}`") if dict(rows.dtypes)[vector_col] == "array<float>" else F.col(f"`{vector_col}`").cast("array<double>")
    fine = F.coalesce(F.size(v) > 0, F.lit(False)) & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))
    return rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.when(fine, v).alias("v"))


#: Rows of the tables that a task compares at once; pairs whose products are gathered at once; comparisons from which a
#: cell is one matrix product.
ROWS, PAIRS, LARGE = 20_000, 60_000, 20_000


def candidates(x: np.ndarray, group: np.ndarray, home: np.ndarray, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) of the rows of one group, i at home, whose cosine is about the least or more: each home with the homes after
    it and with all visitors. Rows are sorted by group, homes first."""
    starts = np.flatnonzero(np.append(True, np.diff(group) != 0)) if len(group) else np.zeros(0, np.int64)
    ends = np.append(starts[1:], len(group))
    homes = np.add.reduceat(home, starts, dtype=np.int64) if len(starts) else starts
    sizes = ends - starts
    small = []
    for s, e, h in zip(starts.tolist(), ends.tolist(), homes.tolist(), strict=True):
        if h * (e - s) < LARGE:
            continue
        step = max(1, 1_000_000 // (e - s))
        for at in range(s, s + h, step):
            i, j = np.nonzero(x[at : min(at + step, s + h)] @ x[s:e].T >= cosine - 1e-9)
            i, j = i + at, j + s
            yield i[j > i], j[j > i]
    small = homes * sizes < LARGE
    rows = np.flatnonzero(home & np.repeat(small, sizes))
    left = np.repeat(ends, sizes)[rows] - rows - 1
    upto = np.cumsum(left)
    thin = x.astype(np.float32)
    at = 0
    while at < len(rows):
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS)))
        n = left[at:end]
        i = np.repeat(rows[at:end], n)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        near = np.einsum("ij,ij->i", thin[i], thin[j]) >= cosine - 1e-4
        yield i[near], j[near]
        at = end


def links(vectors: DataFrame, cosine: float = COSINE, tables: int = TABLES, visits: int = VISITS, scale: float = SCALE, homes: int = HOMES) -> DataFrame:
    """(a, b, n) of distinct vectors (node, v, copies): rows with b null give n linked copies of a; others are edges
    that connect what links connect."""

    single = dict(vectors.dtypes)["v"] == "array<float>"

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                s = b.slice(at, 2000)
                node, copies = s.column(0).to_numpy(), s.column(2).to_numpy()
                values = s.column(1)
                sizes = np.diff(values.offsets.to_numpy())
                flat = values.flatten().to_numpy(zero_copy_only=False)
                starts = np.cumsum(sizes) - sizes
                for dim in np.unique(sizes).tolist():
                    rows = np.flatnonzero(sizes == dim)
                    x = np.ascontiguousarray(flat[starts[rows][:, None] + np.arange(dim)])
                    c = cells(normal(x.astype(np.float64)), tables, visits, scale)
                    n, wide = len(rows), 1 + HALVES * visits
                    # Of one table's cells each counts once; all of a row's cells travel with it.
                    fresh = np.ones((n, tables, wide), bool)
                    for k in range(1, wide):
                        fresh[:, :, k] = (c[:, :, :k] != c[:, :, k : k + 1]).all(axis=2)
                    row, t, k = np.nonzero(fresh)
                    pick = pa.array(row)
                    raw = pa.Array.from_buffers(pa.binary(x.dtype.itemsize * dim), n, [None, pa.py_buffer(x)])
                    packed = pa.Array.from_buffers(pa.binary(8 * tables * wide), n, [None, pa.py_buffer(np.ascontiguousarray(c))])
                    yield pa.RecordBatch.from_arrays([pa.array(c[row, t, k].view(np.int64) ^ dim), pa.array(t.astype(np.int32)), pa.array(k == 0), pa.array(node[rows][row]), pa.array(copies[rows][row]), raw.take(pick).cast(pa.binary()), packed.take(pick).cast(pa.binary())], ["key", "t", "home", "node", "copies", "v", "cells"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, group in whole_groups(batches, ["key", "part", "t"], ROWS):
            size = pa.compute.binary_length(rows["v"]).to_numpy()
            for s in np.unique(size).tolist():
                mine = np.flatnonzero(size == s)
                home = rows["home"].to_numpy()[mine]
                order = np.lexsort((~home, group[mine]))
                first, count, edges = linked(rows.take(pa.array(mine[order])).combine_chunks(), group[mine][order], home[order])
                if len(first):
                    yield pa.RecordBatch.from_arrays([pa.array(first), pa.nulls(len(first), pa.int64()), pa.array(count)], ["a", "b", "n"])
                if len(edges[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(edges[0]), pa.array(edges[1]), pa.array(np.zeros(len(edges[0]), np.int64))], ["a", "b", "n"])

    def bits(column: pa.ChunkedArray, kind, n: int) -> np.ndarray:
        """The values of binaries of one length, a row each."""
        return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(n, -1)

    def linked(rows: pa.Table, group: np.ndarray, home: np.ndarray):
        node, copies, t = rows["node"].to_numpy(), rows["copies"].to_numpy(), rows["t"].to_numpy()
        n = len(node)
        x = normal(bits(rows["v"], np.float32 if single else np.float64, n).astype(np.float64))
        c = bits(rows["cells"], np.uint64, n).reshape(n, tables, -1)
        labels, count = np.arange(n), np.zeros(n, np.int64)
        for i, j in candidates(x, group, home, cosine):
            exact = np.einsum("ij,ij->i", x[i], x[j]) >= cosine
            i, j = i[exact], j[exact]
            if not len(i):
                continue
            # A visitor's own home (or part of this one) may hold the other as a visitor: the pair counts where the
            # smaller node is at home.
            mutual = ~home[j] & (c[j, t[j], :1] == c[i, t[i]]).any(axis=1)
            own = ~mutual | (node[i] < node[j])
            for s in range(tables - 1):
                own &= (t[i] <= s) | ~meets(c, c, i, j, s)
            np.add.at(count, i[own], copies[j[own]])
            np.add.at(count, j[own], copies[i[own]])
            labels = joined_labels(labels, i, j)
        some, moved = np.flatnonzero(count), np.flatnonzero(labels != np.arange(n))
        return node[some], count[some], (node[moved], node[labels[moved]])

    rows = vectors.select("node", "v", "copies").mapInArrow(replicate, "key long, t int, home boolean, node long, copies long, v binary, cells binary")
    dealt = hot_split(rows, "key", "node", homes)
    return dealt.repartition(width(vectors.sparkSession), "key", "part").sortWithinPartitions("key", "part", "t").mapInArrow(compare, "a long, b long, n long")


def normal(x: np.ndarray) -> np.ndarray:
    """Rows of unit length; scaled by the largest component first, so that none overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", **how) -> DataFrame:
    """(id_col, n_links, component_id, kept) for each row."""
    own = usable_vectors(rows, id_col, vector_col)
    usable = own.where("v IS NOT NULL")
    distinct = cut(usable.groupBy("v").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("least")).withColumn("node", F.monotonically_increasing_id()))
    found = cut(links(distinct, **how).groupBy("a", "b").agg(F.sum("n").alias("n")))
    counts = found.where("b IS NULL").select("a", F.col("n").alias("others"))
    joined = components(found.where("b IS NOT NULL").select("a", "b")).select(F.col("node").alias("of"), "root")
    named = distinct.join(joined, F.col("node") == F.col("of"), "left").select("node", "v", "copies", "least", "root")
    firsts = named.where("root IS NOT NULL").groupBy("root").agg(F.min("least").alias("first"))
    classes = named.join(firsts, "root", "left").join(counts, F.col("node") == F.col("a"), "left")
    classes = classes.select(F.col("v").alias("w"), (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n"), F.coalesce("first", "least").alias("component"))
    # AQE splits the partition of a vector that many rows share.
    out = own.join(classes, F.col("v") == F.col("w"), "left")
    component = F.coalesce("component", "id")
    made = (F.coalesce("n", F.lit(0)).cast("long"), component, F.coalesce(F.col("id") == component, F.lit(False)))
    return out.select(F.col("id").alias(id_col), *[c.alias(free(n, [id_col])) for c, n in zip(made, ("n_links", "component_id", "kept"), strict=True)])


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


QUERIES = {"op10_e8_lattice_dedup": op10}
