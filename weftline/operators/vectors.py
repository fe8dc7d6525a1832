"""Similarity, vector, cluster and geometry operators (V, with W1, W2, J12, J13).

Dense comparisons run as blocks: rows are packed into blocks of a bounded size, blocks are dealt to a grid of parts, and a
task compares all blocks of one part with all of another, one matrix product at a time. Only its best neighbours or its sums
leave it. Each row goes to as many tasks as the grid has columns and rows, however many blocks there are. Agglomeration and hulls are sequential by
nature and run per group; k-means and PCA are MLlib's.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.quantiles import exact_quantiles
from weftline.plans.registry import query, sql_query, table

#: Rows of a block that is one side of a product; columns and rows of the grid, and rows of a part beyond which it gets more.
BLOCK, GRID, HELD = 1024, 16, 1 << 16

# ---- dense vectors


class Rows:
    """A block: ids, labels (null: NaN) and vectors, in the order of ids."""

    def __init__(self, r):
        self.block = r.block
        self.ids, self.labels = np.frombuffer(r.ids, np.int64), np.frombuffer(r.labels, np.float64)
        self.v = np.frombuffer(r.v, np.float64).reshape(len(self.ids), -1)
        self.unit = self.v / np.linalg.norm(self.v, axis=1, keepdims=True)


def packed(rows: DataFrame, block: int = BLOCK) -> tuple[DataFrame, int]:
    """One row for each block of rows (id, label, v), and the number of rows."""
    n = rows.count()
    dealt = rows.select(F.pmod(F.xxhash64("id"), F.lit(max(1, -(-n // block)))).cast("int").alias("block"), "id", F.col("label").cast("double").alias("label"), "v")

    def pack(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("id")
        parts = g["id"].to_numpy(np.int64), g["label"].to_numpy(np.float64), np.array(g["v"].tolist(), np.float64)
        return pd.DataFrame([(g["block"].iloc[0], *(p.tobytes() for p in parts))], columns=["block", "ids", "labels", "v"])

    return dealt.groupBy("block").applyInPandas(pack, "block int, ids binary, labels binary, v binary"), n


def compared(left: DataFrame, right: DataFrame, n: int, run: Callable[[list, list], Iterator[pd.DataFrame]], schema: str, kind=Rows, half: bool = False) -> DataFrame:
    """What run yields for each pair of parts: of the blocks of left (read by kind) and of right (Rows), where the larger side
    has n rows. With half, for tables compared with themselves, only parts i <= j."""
    grid = max(1, min(max(GRID, -(-n // HELD)), -(-n // BLOCK)))
    part, every = F.pmod(F.hash("block"), F.lit(grid)), F.sequence(F.lit(0), F.lit(grid - 1))
    a, b = left.select("*", part.alias("i")).select("*", F.explode(every).alias("j")), right.select(*[F.col(c).alias(c) for c in right.columns], part.alias("j")).select("*", F.explode(every).alias("i"))
    if half:
        a, b = a.where("i <= j"), b.where("i <= j")
    cells = grid * (grid + 1) // 2 if half else grid * grid
    # As many partitions as cells, which AQE then doesn't join: there is much to do for few bytes.
    a, b = a.repartition(cells, "i", "j"), b.repartition(cells, "i", "j")

    def each(one: pd.DataFrame, other: pd.DataFrame) -> pd.DataFrame:
        found = list(run([kind(r) for r in one.itertuples()], [Rows(r) for r in other.itertuples()])) if len(one) and len(other) else []
        return pd.concat(found, ignore_index=True) if found else pd.DataFrame(columns=[c.split()[0] for c in schema.split(", ")])

    return a.groupBy("i", "j").cogroup(b.groupBy("i", "j")).applyInPandas(each, schema)


def self_compared(rows: DataFrame, run: Callable[[list, list], Iterator[pd.DataFrame]], schema: str, block: int = BLOCK, half: bool = False) -> DataFrame:
    blocks, n = packed(rows, block)
    return compared(blocks, blocks, n, run, schema, half=half)


class Best:
    """The k best (least value, then id) others of each row of a block, as candidates come by."""

    def __init__(self, rows: int, k: int):
        self.k, self.cut = k, np.full(rows, np.inf)
        self.row, self.dst, self.value, self.more = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.empty(0)

    def add(self, rough: np.ndarray, others: np.ndarray, exact: Callable, more: Callable, off: float = 1e-8) -> None:
        """rough values within off of the exact ones of each row with all others; what is infinite is left out."""
        if np.isinf(self.cut).any() and rough.shape[1] > self.k:
            self.cut = np.minimum(self.cut, np.partition(rough, self.k - 1, axis=1)[:, self.k - 1].astype(float) + off)
        # Compared as short numbers if they are; rounded up, so that none is lost.
        last = np.nextafter((self.cut + off).astype(rough.dtype), rough.dtype.type(np.inf))
        row, at = np.divmod(np.flatnonzero(rough <= last[:, None]), rough.shape[1])
        there = rough[row, at] < np.inf
        row, at = row[there], at[there]
        if not len(row):
            return
        row, dst = np.concatenate([self.row, row]), np.concatenate([self.dst, others[at]])
        value, extra = np.concatenate([self.value, exact(row[len(self.row) :], at)]), np.concatenate([self.more, more(row[len(self.row) :], at)])
        order = np.lexsort((dst, value, row))
        row, dst, value, extra = row[order], dst[order], value[order], extra[order]
        first = np.searchsorted(row, row, "left")
        place = np.arange(len(row)) - first
        last = place == self.k - 1
        self.cut[row[last]] = np.minimum(self.cut[row[last]], value[last])
        keep = place < self.k
        self.row, self.dst, self.value, self.more = row[keep], dst[keep], value[keep], extra[keep]


def unit_rows(rows: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """(id, label, v); a zero vector is an error, as it has no direction."""
    v = F.transform(vector_col, lambda x: x.cast("double"))
    length = F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)
    return rows.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.when(length > 0, v).otherwise(F.raise_error(F.lit("zero vector"))).alias("v"))


def neighbours(rows: DataFrame, k: int, block: int = BLOCK) -> DataFrame:
    """(src, dst, src_label, dst_label, sim, rank) of the exact k nearest by cosine, rounded to 8 digits; ties by id. Products
    are short numbers first; those that may be among the k best are made again in doubles."""

    def best(lefts: list[Rows], rights: list[Rows]) -> Iterator[pd.DataFrame]:
        short = [b.unit.T.astype(np.float32) for b in rights]
        for a in lefts:
            held, own = Best(len(a.ids), k), -a.unit.astype(np.float32)
            # Of unit vectors, short numbers' products are off by less, whatever the order of adding.
            off = 1e-8 + (own.shape[1] + 8) * 2.0**-23
            for b, other in zip(rights, short, strict=True):
                rough = own @ other
                if a.block == b.block:
                    rough[a.ids[:, None] == b.ids[None, :]] = np.inf
                held.add(rough, b.ids, lambda i, j, a=a, b=b: np.round(-(a.unit[i] * b.unit[j]).sum(1), 8), lambda i, j, b=b: b.labels[j], off)
            yield pd.DataFrame({"src": a.ids[held.row], "dst": held.dst, "src_label": a.labels[held.row], "dst_label": held.more, "sim": -held.value})

    local = self_compared(rows, best, "src long, dst long, src_label long, dst_label long, sim double", block)
    ranked = local.withColumn("rank", F.row_number().over(Window.partitionBy("src").orderBy(F.desc("sim"), "dst")))
    return ranked.where(F.col("rank") <= k)


_PAIRS = "WITH p AS (SELECT a.vec_id AS src, b.vec_id AS dst, a.label AS src_label, b.label AS dst_label, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 8) AS sim FROM $embeddings a, $embeddings b WHERE a.vec_id <> b.vec_id), r AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY sim DESC, dst) AS rank FROM p)"


@query("V3_V4_W1_exact_neighbours", f"{_PAIRS} SELECT src, dst, round(sim, 6) AS sim, rank FROM r WHERE rank <= 10")
def knn(spark, sf_dir):
    return neighbours(unit_rows(table(spark, sf_dir, "embeddings")), 10).select("src", "dst", F.round("sim", 6).alias("sim"), "rank")


@query("W2_reverse_rank", f"{_PAIRS} SELECT a.src, a.dst, a.rank AS forward, b.rank AS backward FROM r a JOIN r b ON a.src = b.dst AND a.dst = b.src WHERE a.rank <= 5 AND b.rank <= 10")
def reverse_rank(spark, sf_dir):
    near = neighbours(unit_rows(table(spark, sf_dir, "embeddings")), 10).select("src", "dst", "rank")
    back = near.select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.col("rank").alias("backward"))
    return near.where("rank <= 5").join(back, ["src", "dst"]).select("src", "dst", F.col("rank").alias("forward"), "backward")


@query(
    "V5_connectivity_outliers",
    f"{_PAIRS}, c AS (SELECT src, avg(sim) AS connectivity FROM r WHERE rank <= 5 GROUP BY src), q AS (SELECT quantile_cont(connectivity, 0.25) AS q1, quantile_cont(connectivity, 0.75) AS q3 FROM c) SELECT src, round(connectivity, 6) AS connectivity, connectivity < q1 - 1.5 * (q3 - q1) AS outlier FROM c, q",
)
def connectivity(spark, sf_dir):
    # Read several times by the quantiles; kept, so that all pairs are compared once.
    mean = neighbours(unit_rows(table(spark, sf_dir, "embeddings")), 5).groupBy("src").agg(F.avg("sim").alias("connectivity")).persist(StorageLevel.DISK_ONLY)
    q = exact_quantiles(mean.withColumn("all", F.lit(1)), "all", "connectivity", (0.25, 0.75)).select(F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3"))
    return mean.crossJoin(F.broadcast(q)).select("src", F.round("connectivity", 6).alias("connectivity"), (F.col("connectivity") < F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).alias("outlier"))


@query("V6_cross_source_rate", f"{_PAIRS} SELECT src_label, round(avg((src_label <> dst_label)::INT), 6) AS rate FROM r WHERE rank <= 10 GROUP BY src_label")
def cross_rate(spark, sf_dir):
    return neighbours(unit_rows(table(spark, sf_dir, "embeddings")), 10).groupBy("src_label").agg(F.round(F.avg((F.col("src_label") != F.col("dst_label")).cast("int")), 6).alias("rate")).select(F.col("src_label").cast("int").alias("src_label"), "rate")


#: Pairs that are approved already: here each marked row and the next.
_APPROVED = "(SELECT doc_id AS l, doc_id + 1 AS r FROM $labels WHERE quality = 1)"


def approved_pairs(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "labels").where("quality = 1").select(F.col("doc_id").alias("src"), (F.col("doc_id") + 1).alias("dst"))


@query(
    "J13_mutual_candidates",
    f"{_PAIRS} SELECT a.src, a.dst, round(a.sim, 6) AS sim FROM r a JOIN r b ON a.src = b.dst AND a.dst = b.src WHERE a.rank <= 10 AND b.rank <= 10 AND a.src < a.dst AND a.src_label <> a.dst_label AND NOT EXISTS (SELECT 1 FROM {_APPROVED} p WHERE least(p.l, p.r) = a.src AND greatest(p.l, p.r) = a.dst) ORDER BY round(a.sim, 6) DESC, a.src, a.dst LIMIT 50",
)
def mutual(spark, sf_dir):
    """Mutual neighbours of different labels, without the pairs that are approved, in whichever order."""
    near = neighbours(unit_rows(table(spark, sf_dir, "embeddings")), 10).select("src", "dst", "src_label", "dst_label", "sim")
    a, b = near.where("src < dst AND src_label <> dst_label"), near.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    known = approved_pairs(spark, sf_dir).select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
    return a.join(b, ["src", "dst"]).join(known, ["src", "dst"], "left_anti").select("src", "dst", F.round("sim", 6).alias("sim")).orderBy(F.desc("sim"), "src", "dst").limit(50)


@query("J12_pair_similarities", "SELECT a.label AS l, b.label AS r, count(*) AS n, round(avg(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[])), 6) AS mean_sim FROM $embeddings a JOIN $embeddings b ON a.vec_id < b.vec_id GROUP BY a.label, b.label")
def pair_similarities(spark, sf_dir):
    """All unordered pairs, summed by the labels of their ends inside each block."""

    def sums(lefts: list[Rows], rights: list[Rows]) -> Iterator[pd.DataFrame]:
        ls, rs = (np.unique(np.concatenate([b.labels for b in side])) for side in (lefts, rights))
        s, n = np.zeros((len(ls), len(rs))), np.zeros((len(ls), len(rs)))
        for a in lefts:
            one = (a.labels[:, None] == ls).astype(float)
            for b in rights:
                two = (b.labels[:, None] == rs).astype(float)
                keep = (a.ids[:, None] < b.ids[None, :]).astype(float)
                s += one.T @ (keep * (a.unit @ b.unit.T)) @ two
                n += one.T @ keep @ two
        i, j = np.nonzero(n)
        yield pd.DataFrame({"l": ls[i], "r": rs[j], "n": n[i, j].astype("int64"), "s": s[i, j]})

    part = self_compared(unit_rows(table(spark, sf_dir, "embeddings")), sums, "l int, r int, n long, s double")
    return part.groupBy("l", "r").agg(F.sum("n").alias("n"), F.round(F.sum("s") / F.sum("n"), 6).alias("mean_sim"))


@query(
    "V8_ambiguity_margin",
    """WITH u AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM $embeddings),
    c AS (SELECT label, n, list(m ORDER BY pos) AS c FROM (SELECT label, pos, avg(x) AS m, count(*) AS n FROM (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM u) t GROUP BY label, pos) s GROUP BY label, n),
    own AS (SELECT u.vec_id, u.label, u.v, c.n, CASE WHEN c.n > 1 THEN list_cosine_similarity(u.v, list_transform(range(1, 65), lambda i: (c.n * c.c[i] - u.v[i]) / (c.n - 1))) END AS own FROM u JOIN c ON c.label = u.label),
    o AS (SELECT own.vec_id, max(list_cosine_similarity(own.v, c.c)) AS other FROM own JOIN c ON c.label <> own.label GROUP BY own.vec_id)
    SELECT own.vec_id, own.n = 1 AS singleton, round(own.own - o.other, 6) AS margin, coalesce(own.own - o.other < 0.03, false) AS ambiguous FROM own JOIN o ON o.vec_id = own.vec_id""",
)
def ambiguity(spark, sf_dir):
    rows = unit_rows(table(spark, sf_dir, "embeddings"))
    means = rows.select("label", F.posexplode("v").alias("pos", "x")).groupBy("label", "pos").agg(F.avg("x").alias("m"), F.count(F.lit(1)).alias("n"))
    centres = means.groupBy("label", "n").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda p: p["m"]).alias("c"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    cosine = lambda a, b: dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))
    mine = F.broadcast(centres.select("label", "n", F.col("c").alias("centre")))
    own = rows.join(mine, "label").withColumn("rest", F.zip_with("centre", "v", lambda c, x: (F.col("n") * c - x) / (F.col("n") - 1)))
    others = F.broadcast(centres.select(F.col("label").alias("other_label"), F.col("c").alias("far")))
    best = own.join(others, F.col("label") != F.col("other_label")).groupBy("id").agg(F.max(cosine(F.col("v"), F.col("far"))).alias("other"))
    margin = F.when(F.col("n") > 1, cosine(F.col("v"), F.col("rest"))) - F.col("other")
    return own.join(best, "id").select(F.col("id").alias("vec_id"), (F.col("n") == 1).alias("singleton"), F.round(margin, 6).alias("margin"), F.coalesce(margin < 0.03, F.lit(False)).alias("ambiguous"))


#: Rows and columns of the similarities of clusters that are held at once.
HEIGHT, WIDTH = 256, 4096


def nearest(c: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which, similarity) of the most similar other row of c for each of some rows; of equals the first."""
    which, best = np.zeros(len(rows), np.int64), np.full(len(rows), -np.inf)
    for i in range(0, len(rows), HEIGHT):
        part = rows[i : i + HEIGHT]
        for j in range(0, len(c), WIDTH):
            sim = c[part] @ c[j : j + WIDTH].T
            own = np.flatnonzero((part >= j) & (part < j + WIDTH))
            sim[own, part[own] - j] = -np.inf
            at = sim.argmax(axis=1)
            value = sim[np.arange(len(part)), at]
            better = value > best[i : i + HEIGHT]
            which[i : i + HEIGHT][better], best[i : i + HEIGHT][better] = at[better] + j, value[better]
    return which, best


def merges(c: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pairs, similarity) of the merges of average linkage of distinct vectors c of so many rows each, until one is left; the
    greater of a pair goes. The mean similarity of two clusters is the product of their means, so no similarities are kept,
    and no merge brings a cluster nearer to others than the nearer of its parts was: all clusters that are each
    other's nearest are merged at once, and only those whose nearest is gone look for another."""
    c, size, ids = c.copy(), size.astype(float), np.arange(len(c))
    height, pairs, found = np.full(len(c), np.inf), [], []
    which, best = nearest(c, ids)
    while len(c) > 1:
        at = np.arange(len(c))
        mutual = (which[which] == at) & (at < which)
        if not mutual.any():  # equal ones in a ring, by rounding
            mutual[min(best.argmax(), which[best.argmax()])] = True
            which[np.flatnonzero(mutual)] = max(best.argmax(), which[best.argmax()])
        a = np.flatnonzero(mutual)
        b = which[a]
        h = np.minimum(best[a], np.minimum(height[a], height[b]))
        pairs.append(np.stack([ids[a], ids[b]], axis=1))
        found.append(h)
        both = size[a] + size[b]
        c[a] = (size[a, None] * c[a] + size[b, None] * c[b]) / both[:, None]
        size[a], height[a] = both, h
        gone = np.zeros(len(c), bool)
        gone[a] = gone[b] = True
        stale = gone | gone[which]
        gone[a] = False
        to = np.cumsum(~gone) - 1
        c, size, height, ids, which, best, stale = c[~gone], size[~gone], height[~gone], ids[~gone], to[which[~gone]], best[~gone], stale[~gone]
        if len(c) > 1:
            again = np.flatnonzero(stale)
            which[again], best[again] = nearest(c, again)
    return np.concatenate([np.zeros((0, 2), np.int64), *pairs]), np.concatenate([np.zeros(0), *found])


def agglomerate(ids: np.ndarray, v: np.ndarray, clusters: int) -> np.ndarray:
    """Average linkage on cosine until so many clusters are left; equal vectors go together first, those of smaller members
    before others; numbers follow the clusters' least ids. Memory grows as the vectors do."""
    order = np.argsort(ids)
    x = v[order] / np.linalg.norm(v[order], axis=1, keepdims=True)
    _, first, of = np.unique(x, axis=0, return_index=True, return_inverse=True)
    # Distinct vectors in the order of their first rows.
    place = np.argsort(np.argsort(first))[of.ravel()]
    first = np.sort(first)
    copies = np.flatnonzero(first[place] != np.arange(len(x)))
    copies = copies[np.argsort(place[copies], kind="stable")]
    left = max(0, len(x) - clusters)
    root = np.arange(len(x))
    root[copies[:left]] = first[place[copies[:left]]]
    if left > len(copies):
        pairs, similarity = merges(x[first], np.bincount(place))
        for i, j in first[pairs[np.argsort(-similarity, kind="stable")[: left - len(copies)]]].tolist():
            root[j] = i
    for k in range(len(x)):
        root[k] = root[root[k]]  # a root is no later than its rows
    out = np.empty(len(x), np.int64)
    out[order] = np.unique(root, return_inverse=True)[1]
    return out


@query("V7_average_linkage")
def linkage(spark, sf_dir):
    """Three clusters within each label. Each merge depends on those before, so each group is one task, which holds its vectors
    but not their similarities."""

    def run(g: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"vec_id": g["id"], "label": g["label"], "cluster": agglomerate(g["id"].to_numpy(), np.array(g["v"].tolist()), 3)})

    return unit_rows(table(spark, sf_dir, "embeddings")).groupBy("label").applyInPandas(run, "vec_id long, label int, cluster long")


#: Starts of k-means and its iterations.
STARTS, ITERATIONS = 8, 200


def kmeans(rows: DataFrame, k: int, starts: int = STARTS, seed: int = 7) -> DataFrame:
    """(id, cluster, v): the cheapest of some starts; clusters are numbered by their rounded centroid, then least id. A start
    that hasn't converged is reported by a warning."""
    held = rows.select("id", "v", array_to_vector("v").alias("features")).persist(StorageLevel.DISK_ONLY)
    best, open_ones = None, 0
    for s in range(starts):
        model = KMeans(k=k, maxIter=ITERATIONS, tol=1e-9, seed=1000 * seed + s, predictionCol="p").fit(held)
        open_ones += model.summary.numIter >= ITERATIONS
        if best is None or model.summary.trainingCost < best.summary.trainingCost:
            best = model
    if open_ones:
        warnings.warn(f"{open_ones} of {starts} starts of k-means haven't converged in {ITERATIONS} passes", stacklevel=2)
    named = best.transform(rows.select("id", "v", array_to_vector("v").alias("features"))).select("id", "p", "v")
    order = named.select("p", "id", F.posexplode("v").alias("pos", "x")).groupBy("p", "pos").agg(F.round(F.avg("x"), 12).alias("m"), F.min("id").alias("least")).groupBy("p").agg(F.array_sort(F.collect_list(F.struct("pos", "m"))).alias("c"), F.min("least").alias("least"))
    # One row for each of k clusters.
    number = order.select("p", F.row_number().over(Window.orderBy("c", "least")).alias("cluster"))
    held.unpersist()
    return named.join(F.broadcast(number), "p").select("id", (F.col("cluster") - 1).alias("cluster"), "v")


@query("V9_V10_two_level_kmeans")
def two_level(spark, sf_dir):
    """Fine clusters, and their centroids clustered again."""
    fine = kmeans(unit_rows(table(spark, sf_dir, "embeddings")), 12).select("id", F.col("cluster").alias("fine"), "v")
    centres = fine.select("fine", F.posexplode("v").alias("pos", "x")).groupBy("fine", "pos").agg(F.avg("x").alias("m")).groupBy("fine").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda p: p["m"]).alias("v"))
    top = kmeans(centres.select(F.col("fine").cast("long").alias("id"), "v"), 4).select(F.col("id").cast("int").alias("fine"), F.col("cluster").alias("top"))
    return fine.join(F.broadcast(top), "fine").select(F.col("id").alias("vec_id"), "fine", "top")


_FAR = {"cosine": "1 - list_cosine_similarity(a.v, b.v)", "euclidean": "list_distance(a.v, b.v)"}


@query(
    "V11_silhouette",
    "WITH u AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM $embeddings), "
    + "d AS (" + " UNION ALL ".join(f"SELECT '{m}' AS metric, a.vec_id, a.label, b.label AS other, avg({d}) AS d FROM u a JOIN u b ON a.vec_id <> b.vec_id GROUP BY a.vec_id, a.label, b.label" for m, d in _FAR.items())
    + "), s AS (SELECT metric, vec_id, label, max(CASE WHEN other = label THEN d END) AS a, min(CASE WHEN other <> label THEN d END) AS b FROM d GROUP BY metric, vec_id, label) SELECT metric, label, round(avg((b - a) / greatest(a, b)), 6) AS silhouette FROM s GROUP BY metric, label",
)
def silhouette(spark, sf_dir):
    """Silhouettes of the labels by cosine and Euclidean distance; blocks give each row's sum of distances to each label."""

    def sums(lefts: list[Rows], rights: list[Rows]) -> Iterator[pd.DataFrame]:
        ls = np.unique(np.concatenate([b.labels for b in rights]))
        for a in lefts:
            total = {"cosine": np.zeros((len(a.ids), len(ls))), "euclidean": np.zeros((len(a.ids), len(ls)))}
            n = np.zeros((len(a.ids), len(ls)))
            for b in rights:
                one = (b.labels[:, None] == ls).astype(float)
                square = (a.v**2).sum(1)[:, None] - 2 * a.v @ b.v.T + (b.v**2).sum(1)[None]
                far = {"cosine": 1 - a.unit @ b.unit.T, "euclidean": np.sqrt(np.maximum(square, 0))}
                keep = (a.ids[:, None] != b.ids[None, :]).astype(float) if a.block == b.block else 1.0
                for metric, d in far.items():
                    total[metric] += (d * keep) @ one
                n += keep @ one if a.block == b.block else one.sum(0)
            i, j = np.nonzero(n)
            for metric, s in total.items():
                yield pd.DataFrame({"metric": metric, "id": a.ids[i], "label": a.labels[i], "other": ls[j], "s": s[i, j], "n": n[i, j]})

    part = self_compared(unit_rows(table(spark, sf_dir, "embeddings")), sums, "metric string, id long, label int, other int, s double, n double")
    mean = part.groupBy("metric", "id", "label", "other").agg((F.sum("s") / F.sum("n")).alias("d"))
    ab = mean.groupBy("metric", "id", "label").agg(F.max(F.when(F.col("other") == F.col("label"), F.col("d"))).alias("a"), F.min(F.when(F.col("other") != F.col("label"), F.col("d"))).alias("b"))
    return ab.groupBy("metric", "label").agg(F.round(F.avg((F.col("b") - F.col("a")) / F.greatest("a", "b")), 6).alias("silhouette"))


_ARI = "WITH x AS (SELECT label AS a, vec_id % 7 AS b FROM $embeddings), c AS (SELECT a, b, count(*) AS n FROM x GROUP BY a, b), s AS (SELECT sum(n * (n - 1) / 2D) AS both FROM c), ra AS (SELECT sum(n * (n - 1) / 2D) AS s FROM (SELECT a, sum(n) AS n FROM c GROUP BY a) t), rb AS (SELECT sum(n * (n - 1) / 2D) AS s FROM (SELECT b, sum(n) AS n FROM c GROUP BY b) t), m AS (SELECT sum(n) * (sum(n) - 1) / 2D AS s FROM c) SELECT round((s.both - ra.s * rb.s / m.s) / ((ra.s + rb.s) / 2D - ra.s * rb.s / m.s), 6) AS ari FROM s CROSS JOIN ra CROSS JOIN rb CROSS JOIN m"
sql_query("V12_adjusted_rand", _ARI, _ARI.replace("2D", "2::DOUBLE"))


@query("V13_projection_pca")
def projection(spark, sf_dir):
    """The linear projection to the plane; layout.manifold_layout() follows the neighbours instead."""
    data = unit_rows(table(spark, sf_dir, "embeddings")).select("id", array_to_vector("v").alias("features"))
    made = PCA(k=2, inputCol="features", outputCol="plane").fit(data).transform(data)
    xy = vector_to_array("plane")
    return made.select(F.col("id").alias("vec_id"), F.round(xy[0], 8).alias("x"), F.round(xy[1], 8).alias("y"))


#: A layout in the plane that SQL can state too: each row's sums of all its components by the cosines and sines of their
#: places. Any other layout (projection()) is as good to the operators below.
PLANE = ("list_sum(list_transform({v}, lambda x, i: x::DOUBLE * cos(i)))", "list_sum(list_transform({v}, lambda x, i: x::DOUBLE * sin(i)))")


def in_plane(v: np.ndarray) -> np.ndarray:
    at = np.arange(1, v.shape[1] + 1)
    return v @ np.stack([np.cos(at), np.sin(at)], axis=1)


def plane(v: Column | str) -> tuple[Column, Column]:
    v = F.col(v) if isinstance(v, str) else v

    def along(turn) -> Column:
        return F.aggregate(F.transform(v, lambda x, i: x.cast("double") * turn(i + 1)), F.lit(0.0), lambda s, x: s + x)

    return along(F.cos), along(F.sin)


_E = f"e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v, {PLANE[0].format(v='embedding')} AS x, {PLANE[1].format(v='embedding')} AS y FROM $embeddings)"
_LAYOUTS = f"{_E}, p AS (SELECT a.vec_id AS src, b.vec_id AS dst, round(1 - list_cosine_similarity(a.v, b.v), 8) AS d1, round(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2), 8) AS d2 FROM e a JOIN e b ON a.vec_id {{on}} b.vec_id)"


def plane_distances(a: Rows, b: Rows) -> np.ndarray:
    """Distances in the plane of all rows of two blocks, not rounded."""
    p, q = in_plane(a.v), in_plane(b.v)
    return np.sqrt((p[:, 0, None] - q[None, :, 0]) ** 2 + (p[:, 1, None] - q[None, :, 1]) ** 2)


def plane_neighbours(rows: DataFrame, k: int) -> DataFrame:
    """(src, dst, d1, rank): the k nearest in the plane, ties by id, and how far they are in the whole space."""

    def best(lefts: list[Rows], rights: list[Rows]) -> Iterator[pd.DataFrame]:
        for a in lefts:
            held = Best(len(a.ids), k)
            for b in rights:
                d2 = plane_distances(a, b)
                if a.block == b.block:
                    d2[a.ids[:, None] == b.ids[None, :]] = np.inf
                held.add(d2, b.ids, lambda i, j, d2=d2: np.round(d2[i, j], 8), lambda i, j, a=a, b=b: np.round(1 - (a.unit[i] * b.unit[j]).sum(1), 8))
            yield pd.DataFrame({"src": a.ids[held.row], "dst": held.dst, "d1": held.more, "d2": held.value})

    local = self_compared(rows, best, "src long, dst long, d1 double, d2 double")
    ranked = local.withColumn("rank", F.row_number().over(Window.partitionBy("src").orderBy("d2", "dst")))
    return ranked.where(F.col("rank") <= k).select("src", "dst", "d1", "rank")


class Asked:
    """A block of rows with the others whose ranks are asked."""

    def __init__(self, r):
        self.src, self.at, self.dst = (np.frombuffer(x, np.int64) for x in (r.src, r.at, r.dst))
        self.own, self.u = np.frombuffer(r.own, np.float64), np.frombuffer(r.u, np.float64).reshape(len(self.src), -1)


def ranks_of(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """(src, dst, sim, rank) of given pairs: the rank, of 1 to n - 1, of dst among all neighbours of src by similarity
    (rounded to 8 digits), ties by id. The pairs' sources are compared with all rows in blocks, which gives counts alone."""
    named = pairs.select("src", "dst").distinct()
    left = rows.select(F.col("id").alias("src"), F.col("v").alias("u"))
    right = rows.select(F.col("id").alias("dst"), F.col("v").alias("w"))
    blocks, n = packed(rows)
    # A row with what is asked of it, so that its similarities are computed once for all of that.
    asked = named.join(right, "dst").groupBy("src").agg(F.collect_list(F.struct("dst", "w")).alias("of")).join(left, "src")
    asked = asked.withColumn("block", F.pmod(F.xxhash64("src"), F.lit(max(1, -(-n // BLOCK)))).cast("int"))

    def pack(g: pd.DataFrame) -> pd.DataFrame:
        unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
        u = unit(np.array(g["u"].tolist(), np.float64))
        size = [len(of) for of in g["of"]]
        at = np.repeat(np.arange(len(g)), size)
        dst = np.array([q["dst"] for of in g["of"] for q in of], np.int64)
        own = np.concatenate([np.round((unit(np.array([q["w"] for q in of], np.float64)) * x).sum(1), 8) for of, x in zip(g["of"], u, strict=True)])
        parts = g["src"].to_numpy(np.int64), u, at.astype(np.int64), dst, own
        return pd.DataFrame([(g["block"].iloc[0], *(p.tobytes() for p in parts))], columns=["block", "src", "u", "at", "dst", "own"])

    asked = asked.groupBy("block").applyInPandas(pack, "block int, src binary, u binary, at binary, dst binary, own binary")

    def count(lefts: list[Asked], rights: list[Rows]) -> Iterator[pd.DataFrame]:
        for a in lefts:
            ahead = np.zeros(len(a.dst), np.int64)
            for b in rights:
                sim = np.round(a.u @ b.unit.T, 8)
                # A few rows at a time: each is compared with all that is asked of it.
                for k in range(0, len(a.dst), BLOCK):
                    part = slice(k, k + BLOCK)
                    s, own, dst, src = sim[a.at[part]], a.own[part, None], a.dst[part, None], a.src[a.at[part], None]
                    ahead[part] += (((s > own) | (s == own) & (b.ids[None] < dst)) & (b.ids[None] != src) & (b.ids[None] != dst)).sum(1)
            yield pd.DataFrame({"src": a.src[a.at], "dst": a.dst, "sim": a.own, "n": ahead})

    counts = compared(asked, blocks, n, count, "src long, dst long, sim double, n long", Asked)
    return counts.groupBy("src", "dst").agg(F.max("sim").alias("sim"), (F.sum("n") + 1).alias("rank"))


_NEAR2 = f"WITH {_LAYOUTS.format(on='<>')}, r AS (SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY d1, dst) AS r1, row_number() OVER (PARTITION BY src ORDER BY d2, dst) AS r2 FROM p)"


@query("V15_neighbour_retention", f"{_NEAR2} SELECT src, round(count(*) FILTER (WHERE r1 <= 10 AND r2 <= 10) / 10.0::DOUBLE, 6) AS retention FROM r GROUP BY src")
def retention(spark, sf_dir, k: int = 10):
    """The share of each row's k nearest in the whole space that are among its k nearest in the plane."""
    rows = unit_rows(table(spark, sf_dir, "embeddings"))
    both = neighbours(rows, k).select("src", "dst", F.lit(1).alias("one")).join(plane_neighbours(rows, k).select("src", "dst", F.lit(1).alias("two")), ["src", "dst"], "full")
    return both.groupBy("src").agg(F.round(F.count(F.when(F.col("one").isNotNull() & F.col("two").isNotNull(), 1)) / float(k), 6).alias("retention"))


@query("V16_trustworthiness", f"{_NEAR2}, n AS (SELECT count(*)::DOUBLE AS n FROM $embeddings) SELECT round(1 - 2 / (n * 10 * (2 * n - 31)) * sum(r1 - 10), 6) AS trustworthiness FROM r, n WHERE r2 <= 10 AND r1 > 10 GROUP BY n")
def trustworthiness(spark, sf_dir, k: int = 10):
    """How far the ranks in the whole space of the neighbours in the plane go beyond k; only those ranks are computed."""
    rows = unit_rows(table(spark, sf_dir, "embeddings"))
    n = rows.count()
    over = ranks_of(rows, plane_neighbours(rows, k)).where(F.col("rank") > k).agg(F.sum(F.col("rank") - k).alias("s"))
    return over.select(F.round(1 - F.lit(2.0) / (n * k * (2 * n - 3 * k - 1)) * F.col("s"), 6).alias("trustworthiness"))


@query(
    "V17_relation_overlay",
    f"""WITH {_E}, a AS (SELECT l, r FROM {_APPROVED} q JOIN e x ON x.vec_id = q.l JOIN e y ON y.vec_id = q.r),
    q AS (SELECT l AS src, r AS dst FROM a UNION SELECT r, l FROM a),
    s AS (SELECT q.src, q.dst, z.vec_id AS other, round(list_cosine_similarity(x.v, y.v), 8) AS own, round(list_cosine_similarity(x.v, z.v), 8) AS sim FROM q JOIN e x ON x.vec_id = q.src JOIN e y ON y.vec_id = q.dst JOIN e z ON z.vec_id NOT IN (q.src, q.dst)),
    k AS (SELECT src, dst, max(own) AS own, 1 + count(*) FILTER (WHERE sim > own OR sim = own AND other < dst) AS rank FROM s GROUP BY src, dst)
    SELECT a.l AS src, a.r AS dst, round(f.own, 6) AS cosine, f.rank AS forward, g.rank AS backward, round(sqrt((x.x - y.x) ** 2 + (x.y - y.y) ** 2), 6) AS projected
    FROM a JOIN k f ON f.src = a.l AND f.dst = a.r JOIN k g ON g.src = a.r AND g.dst = a.l JOIN e x ON x.vec_id = a.l JOIN e y ON y.vec_id = a.r""",
)
def overlay(spark, sf_dir):
    """Approved pairs with their cosine, the ranks either way among all rows, and how far apart the layout puts them."""
    rows = unit_rows(table(spark, sf_dir, "embeddings"))
    ids = rows.select("id")
    pairs = approved_pairs(spark, sf_dir).join(ids, F.col("src") == F.col("id"), "left_semi").join(ids, F.col("dst") == F.col("id"), "left_semi")
    ranks = ranks_of(rows, pairs.union(pairs.select(F.col("dst").alias("src"), F.col("src").alias("dst"))))
    back = ranks.select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.col("rank").alias("backward"))
    at = rows.select("id", *[c.alias(n) for c, n in zip(plane("v"), "xy", strict=True)])
    ends = pairs.join(at.select(F.col("id").alias("src"), F.col("x").alias("x1"), F.col("y").alias("y1")), "src").join(at.select(F.col("id").alias("dst"), F.col("x").alias("x2"), F.col("y").alias("y2")), "dst")
    far = F.sqrt((F.col("x1") - F.col("x2")) ** 2 + (F.col("y1") - F.col("y2")) ** 2)
    return ends.join(ranks, ["src", "dst"]).join(back, ["src", "dst"]).select("src", "dst", F.round("sim", 6).alias("cosine"), F.col("rank").alias("forward"), "backward", F.round(far, 6).alias("projected"))


def hull(points: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """The convex hull, counter-clockwise, without collinear points; two points or fewer as they are."""
    unique = sorted(set(points))
    if len(unique) <= 2:
        return unique

    def chain(run):
        out: list[tuple[float, float]] = []
        for p in run:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    return chain(unique) + chain(reversed(unique))


@query("V18_convex_hulls")
def hulls(spark, sf_dir):
    """(label, corner, x, y, centre_x, centre_y): hull and centre of each label's points in the plane. Each batch's own hull
    is taken first, so that a group's task gets few points."""

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for label, g in b.groupby("label"):
                kept = hull(list(zip(g["x"], g["y"], strict=True)))
                yield pd.DataFrame({"label": label, "x": [p[0] for p in kept], "y": [p[1] for p in kept]})

    def whole(g: pd.DataFrame) -> pd.DataFrame:
        kept = hull(list(zip(g["x"], g["y"], strict=True)))
        return pd.DataFrame({"label": g["label"].iloc[0], "corner": range(len(kept)), "x": [p[0] for p in kept], "y": [p[1] for p in kept]})

    x, y = plane("embedding")
    points = table(spark, sf_dir, "embeddings").select("label", F.round(x, 8).alias("x"), F.round(y, 8).alias("y"))
    centres = points.groupBy("label").agg(F.round(F.avg("x"), 8).alias("centre_x"), F.round(F.avg("y"), 8).alias("centre_y"))
    return points.mapInPandas(local, "label int, x double, y double").groupBy("label").applyInPandas(whole, "label int, corner int, x double, y double").join(F.broadcast(centres), "label")


sql_query(
    "V19_tolerant_comparison",
    "WITH a AS (SELECT l_orderkey, l_linenumber, l_discount AS s FROM $lineitem), b AS (SELECT l_orderkey, l_linenumber, l_discount + CASE WHEN l_orderkey % 5 = 0 THEN 0.00028 ELSE 0.00000001 END AS s FROM $lineitem WHERE l_orderkey % 11 <> 0) SELECT coalesce(a.l_orderkey, b.l_orderkey) AS l_orderkey, coalesce(a.l_linenumber, b.l_linenumber) AS l_linenumber, coalesce(abs(a.s - b.s) <= 1e-7, false) AS equivalent FROM a FULL OUTER JOIN b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber",
)
