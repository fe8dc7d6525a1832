"""Layouts in the plane (V13, V14): a neighbour-graph embedding, and how it orders distances.

The embedding holds positions as a table. Each round deals the rows with their edges to blocks; a block moves its own rows
by some steps of attraction along edges and repulsion from a bounded sample, with all others where the last round left
them, and rounds are cut from each other's lineage. No task holds all rows, and the sample's size doesn't grow.

Spearman's correlation of all pairs' distances needs ranks of all pairs, but no list of them: histograms, refined where
they are coarse, say how many distances lie below one, and a last pass over the blocks gives sums of ranks alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.vectors import _LAYOUTS, Rows, compared, in_plane, neighbours, packed, unit_rows
from weftline.plans.registry import query, table
from weftline.streaming.ledger import shared_path

#: Neighbours of a row, rounds, steps of a round, rows of a block, rows of the sample that repels, first step's width.
NEIGHBOURS, ROUNDS, STEPS, ROWS, REPELLING, RATE = 15, 10, 10, 2048, 256, 0.1
#: The curve of similarity by distance for a least distance of 0.1, repulsions per attraction, longest move along an axis.
CURVE, NEGATIVE, LONGEST = (1.577, 0.895), 5, 4.0


def linear_layout(rows: DataFrame) -> DataFrame:
    """(id, x, y): the projection on two principal components."""
    data = rows.select("id", array_to_vector("v").alias("features"))
    made = PCA(k=2, inputCol="features", outputCol="plane").fit(data).transform(data)
    xy = vector_to_array("plane")
    return made.select("id", xy[0].alias("x"), xy[1].alias("y"))


def fuzzy_edges(near: DataFrame) -> DataFrame:
    """(src, dst, w), both ways, from (src, dst, sim, rank): memberships that fall from 1 at the nearest neighbour at a rate
    that makes their sum log2 of the neighbours' number, united over both directions."""
    lists = near.groupBy("src").agg(F.array_sort(F.collect_list(F.struct("rank", "dst", "sim"))).alias("near"))

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for src, found in zip(b["src"], b["near"], strict=True):
                far = np.array([1 - r["sim"] for r in found])
                beyond, low, high = np.maximum(far - far[0], 0), 0.0, 1e3
                for _ in range(64):
                    mid = (low + high) / 2
                    low, high = (low, mid) if np.exp(-beyond / mid).sum() > np.log2(len(far)) else (mid, high)
                yield pd.DataFrame({"src": src, "dst": [r["dst"] for r in found], "w": np.exp(-beyond / high)})

    one = lists.mapInPandas(weigh, "src long, dst long, w double")
    both = one.select("src", "dst", F.col("w").alias("a"), F.lit(0.0).alias("b")).union(one.select("dst", "src", F.lit(0.0), "w"))
    return both.groupBy("src", "dst").agg(F.max("a").alias("a"), F.max("b").alias("b")).select("src", "dst", (F.col("a") + F.col("b") - F.col("a") * F.col("b")).alias("w"))


def cut(df: DataFrame) -> DataFrame:
    """df kept in the shared checkpoint folder; on one machine without one, in a temporary folder."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(df.sparkSession.conf.get("spark.checkpoint.dir", None) or shared_path(df.sparkSession))
    return df.checkpoint()


def _moves(own: np.ndarray, others: np.ndarray, src: np.ndarray, inner: np.ndarray, w: np.ndarray, sample: np.ndarray, rates: np.ndarray) -> np.ndarray:
    """own positions after a step for each rate. Edges go from own[src] to own[inner], or to others where inner is -1."""
    a, b = CURVE
    weight = np.bincount(src, w, len(own))
    for rate in rates:
        away = own[src] - np.where((inner >= 0)[:, None], own[inner], others)
        square = (away**2).sum(1) + 1e-12
        pull = np.clip((-2 * a * b * square ** (b - 1) / (1 + a * square**b))[:, None] * away, -LONGEST, LONGEST) * w[:, None]
        moved = np.stack([np.bincount(src, pull[:, c], len(own)) for c in (0, 1)], 1)
        for part in range(0, len(own), 1024):
            off = own[part : part + 1024, None] - sample[None]
            square = (off**2).sum(2)
            push = np.where(square > 1e-12, 2 * b / ((0.001 + square) * (1 + a * square**b)), 0.0)
            moved[part : part + 1024] += np.clip(push[:, :, None] * off, -LONGEST, LONGEST).mean(1) * (NEGATIVE * weight[part : part + 1024, None])
        own = own + rate * moved
    return own


def manifold_layout(rows: DataFrame, k: int = NEIGHBOURS, rounds: int = ROUNDS, steps: int = STEPS, block: int = ROWS, seed: int = 7) -> DataFrame:
    """(id, x, y) of (id, label, v), by the graph of the k nearest neighbours; the same for the same rows and seed."""
    edges = cut(fuzzy_edges(neighbours(rows, k)))
    start = linear_layout(rows)
    most = start.agg(F.max(F.greatest(F.abs("x"), F.abs("y"))).alias("m"), F.count(F.lit(1)).alias("n")).first()
    # Rounded, so that the order in which the components were summed doesn't show.
    at = cut(start.select("id", *[F.round(F.col(c) * F.lit(10 / (most["m"] or 1)), 5).alias(c) for c in "xy"]))
    blocks = max(1, -(-most["n"] // block))
    rates = RATE * (1 - np.arange(rounds * steps) / (rounds * steps))
    for r in range(rounds):
        part = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(blocks)).cast("int")
        mine = at.select(part.alias("part"), F.col("id").alias("src"), F.lit(None).cast("long").alias("dst"), F.lit(None).cast("double").alias("w"), "x", "y")
        ends = edges.join(at.select(F.col("id").alias("dst"), "x", "y"), "dst")
        dealt = mine.union(ends.select(F.pmod(F.xxhash64("src", F.lit(seed)), F.lit(blocks)).cast("int").alias("part"), "src", "dst", "w", "x", "y"))
        far = at.orderBy(F.xxhash64("id", F.lit(seed + r)), "id").limit(REPELLING).select("x", "y").collect()
        at = cut(dealt.groupBy("part").applyInPandas(_round(np.array(far, float).reshape(-1, 2), rates[r * steps : (r + 1) * steps]), "id long, x double, y double"))
    return at


def _round(sample: np.ndarray, rates: np.ndarray) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["src", "dst"])
        node = g["dst"].isna().to_numpy()
        ids, own = g.loc[node, "src"].to_numpy(np.int64), g.loc[node, ["x", "y"]].to_numpy(float)
        e = g[~node]
        src, dst = np.searchsorted(ids, e["src"].to_numpy(np.int64)), e["dst"].to_numpy().astype(np.int64)
        inner = np.minimum(np.searchsorted(ids, dst), len(ids) - 1)
        inner = np.where(ids[inner] == dst, inner, -1)
        own = _moves(own, e[["x", "y"]].to_numpy(float), src, inner, e["w"].to_numpy(float), sample, rates)
        return pd.DataFrame({"id": ids, "x": own[:, 0], "y": own[:, 1]})

    return run


@query("V13_manifold_layout")
def manifold(spark, sf_dir):
    """Positions of the vectors by their neighbours' graph. No twin: each position depends on all rounds; tests compare its
    trustworthiness with that of the linear projection."""
    found = manifold_layout(unit_rows(table(spark, sf_dir, "embeddings")))
    return found.select(F.col("id").alias("vec_id"), F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


#: Distances are whole numbers of GRAIN. A histogram's buckets hold at most one of SHARES of all pairs, or one distance. It starts
#: with CELLS at most, and STRIP rows of a block are compared at once.
GRAIN, SHARES, CELLS, SPLIT, STRIP = 1e-8, 1 << 14, 1 << 18, 64, 32


Halves = Callable[[Callable, str], DataFrame]


class _Places:
    """The bucket of a distance among edges, which hold all multiples of a power of two: a shift tells the cell, and only those
    in a cell with more edges are searched for."""

    def __init__(self, edges: np.ndarray, shift: int):
        self.edges, self.shift = edges, shift
        cells = int(edges[-1] >> shift) + 1
        self.start = np.searchsorted(edges, np.arange(cells) << shift)
        self.split = np.append(self.start[1:], len(edges)) - self.start > 1
        self.plain = not self.split.any()

    def of(self, d: np.ndarray) -> np.ndarray:
        cell = d >> self.shift
        if self.plain:
            return cell
        at, more = self.start[cell], np.flatnonzero(self.split[cell])
        at[more] = np.searchsorted(self.edges, d[more], "right") - 1
        return at


def _counts(halves: Halves, edges: list[np.ndarray], shifts: list[int]) -> list[np.ndarray]:
    """How many pairs' distances lie from each edge to the next, for both distances."""

    def run(lefts: list[Rows], rights: list[Rows]) -> Iterator[pd.DataFrame]:
        places = [_Places(e, s) for e, s in zip(edges, shifts, strict=True)]
        sums, held = [np.zeros(len(e), np.int64) for e in edges], [[], []]

        def add(least: int) -> None:
            if sum(map(len, held[0])) >= least:
                for s, some in zip(sums, held, strict=True):
                    s += np.bincount(np.concatenate(some), minlength=len(s))
                    some.clear()

        for whole in _whole(lefts, rights):
            for some, place, d in zip(held, places, whole, strict=True):
                some.append(place.of(d))
            add(8 * max(map(len, edges)))
        add(1)
        for axis, s in enumerate(sums):
            at = np.flatnonzero(s)
            yield pd.DataFrame({"axis": axis, "at": at, "n": s[at]})

    out = [np.zeros(len(e), np.int64) for e in edges]
    for r in halves(run, "axis int, at int, n long").groupBy("axis", "at").agg(F.sum("n").alias("n")).collect():
        out[r["axis"]][r["at"]] = r["n"]
    return out


def _whole(lefts: list[Rows], rights: list[Rows]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Both distances of each unordered pair that two parts hold, in whole grains; a part with itself gives each pair once. A
    strip of rows comes at a time, so that what is made of it stays in the processor's cache."""
    own = {a.block for a in lefts} == {b.block for b in rights}
    planes = {id(x): in_plane(x.v) for x in (*lefts, *rights)}
    for a in lefts:
        for b in rights:
            if own and a.block > b.block:
                continue
            p, q, columns = planes[id(a)], planes[id(b)].T.copy(), b.unit.T
            for k in range(0, len(a.ids), STRIP):
                strip = slice(k, k + STRIP)
                d1, d2 = 1 - a.unit[strip] @ columns, np.sqrt((p[strip, 0, None] - q[None, 0]) ** 2 + (p[strip, 1, None] - q[None, 1]) ** 2)
                keep = a.ids[strip, None] < b.ids[None, :] if a.block == b.block else slice(None)
                yield tuple(np.rint(d[keep].ravel() * 1e8).astype(np.int64) for d in (d1, d2))


def distance_spearman(rows: DataFrame, shares: int = SHARES) -> DataFrame:
    """(spearman) of the distances of all unordered pairs of (id, label, v) in the whole space and in the plane, equal
    distances sharing their mean rank.

    In a bucket of one distance, or of one pair, ranks are exact; in others they are spread by the distance, so that a rank is off
    by a small part of 1 / shares of all.
    """
    blocks, size = packed(rows)
    # Read once for each pass; cut, so that rows aren't packed again.
    blocks = cut(blocks)

    def halves(run: Callable, schema: str) -> DataFrame:
        return compared(blocks, blocks, size, run, schema, half=True)

    top = _extent(blocks)
    shifts = [max(0, (t // CELLS).bit_length()) for t in top]
    edges = [np.arange((t >> s) + 1) << s for t, s in zip(top, shifts, strict=True)]
    while True:
        counts = _counts(halves, edges, shifts)
        total = int(counts[0].sum())
        finer = []
        for e, n, t in zip(edges, counts, top, strict=True):
            ends = np.append(e[1:], t + 1)
            coarse = np.flatnonzero((n > max(1, total / shares)) & (ends - e > 1))
            new = [np.linspace(e[k], ends[k], SPLIT, endpoint=False).astype(np.int64) for k in coarse]
            finer.append(np.unique(np.concatenate([e, *new])))
        if all(len(f) == len(e) for f, e in zip(finer, edges, strict=True)):
            break
        edges = finer
    if total < 2:
        return rows.sparkSession.createDataFrame([(None,)], "spearman double")
    before = [np.cumsum(n) - n for n in counts]
    wide = [np.append(e[1:], t + 1) - e for e, t in zip(edges, top, strict=True)]

    lines = [_ranks(*x, total) for x in zip(edges, counts, before, wide, strict=True)]

    def sums(lefts: list[Rows], rights: list[Rows]) -> Iterator[pd.DataFrame]:
        places = [_Places(e, s) for e, s in zip(edges, shifts, strict=True)]
        held = np.zeros(6)
        for whole in _whole(lefts, rights):
            u, w = (flat[at] + slope[at] * d for d, at, (flat, slope) in zip(whole, [p.of(d) for p, d in zip(places, whole, strict=True)], lines, strict=True))
            held += [len(u), u.sum(), w.sum(), u @ u, w @ w, u @ w]
        yield pd.DataFrame([held], columns=list("nabcde"))

    n, a, b, c, d, e = halves(sums, ", ".join(f"{x} double" for x in "nabcde")).agg(*[F.sum(x) for x in "nabcde"]).first()
    spread = ((c - a * a / n) * (d - b * b / n)) ** 0.5
    return rows.sparkSession.createDataFrame([(float((e - a * b / n) / spread) if spread > 0 else None,)], "spearman double")


def _ranks(edges: np.ndarray, n: np.ndarray, before: np.ndarray, wide: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """(flat, slope) of each bucket: a distance's rank is flat plus slope times it, as a share of all, less a half."""
    slope = np.where((wide > 1) & (n > 1), n / wide, 0.0)
    flat = np.where(slope > 0, before + 0.5 - (edges - 0.5) * slope, before + 0.5 * n + 0.5)
    return flat / total - 0.5, slope / total


def _extent(blocks: DataFrame) -> list[int]:
    """Whole grains that no distance exceeds: two for the cosine, the diagonal of what holds all rows for the plane."""

    def corners(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                p = in_plane(Rows(r).v)
                yield pd.DataFrame([[*p.min(axis=0), *p.max(axis=0)]], columns=["x", "y", "z", "w"])

    r = blocks.mapInPandas(corners, "x double, y double, z double, w double").agg(F.min("x"), F.min("y"), F.max("z"), F.max("w")).first()
    return [int(2 / GRAIN) + 1, 1 if r[0] is None else int(np.hypot(r[2] - r[0], r[3] - r[1]) / GRAIN) + 2]


@query("V14_distance_spearman", f"WITH {_LAYOUTS.format(on='<')}, r AS (SELECT rank() OVER (ORDER BY d1) + (count(*) OVER (PARTITION BY d1) - 1) / 2 AS r1, rank() OVER (ORDER BY d2) + (count(*) OVER (PARTITION BY d2) - 1) / 2 AS r2 FROM p) SELECT round(corr(r1, r2), 6) AS spearman FROM r")
def spearman(spark, sf_dir):
    return distance_spearman(unit_rows(table(spark, sf_dir, "embeddings"))).select(F.round("spearman", 6).alias("spearman"))
