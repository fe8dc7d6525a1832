"""What the operators of this subpackage share: lineage cuts, connected components, links inside groups."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free(name: str, taken) -> str:
    """name, with as many underscores after it as make it differ from all names taken, whatever their case."""
    taken = {t.lower() for t in taken}
    while name.lower() in taken:
        name += "_"
    return name


def columns(df: DataFrame) -> list[Column]:
    """The columns of df, whatever signs are in their names."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def beside(df: DataFrame, *more: Column) -> DataFrame:
    """The struct `row` of all of df's columns, and more; select("row.*") gives the columns back, whatever their names."""
    return df.select(F.struct(*columns(df)).alias("row"), *more)


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder for lineage cuts: the cluster's spark.checkpoint.dir. Only in one process, where it is unset, is
    it a temporary folder of our own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not re.match(r"local(\[|$)", sc.master):
                raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            folder = tempfile.mkdtemp(prefix="weftline-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared folder, so that a lost executor costs no recomputation of its past."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mixed(x):
    """A bijection of longs onto longs (three xorshift rounds), so that small ids come in an order like a random one."""
    for _ in range(3):
        x = x.bitwiseXOR(F.lit(0x2545F4914F6CDD1D))
        x = x.bitwiseXOR(F.shiftleft(x, 13))
        x = x.bitwiseXOR(F.shiftrightunsigned(x, 7))
        x = x.bitwiseXOR(F.shiftleft(x, 17))
    return x


#: Edges, each in both directions, that components() joins in one task at most.
FEW = 10_000


def merged(df: DataFrame) -> DataFrame:
    """df for the right side of a join of tables that grow with the input and are shuffled in any case. Where one happens to
    be small, Spark would broadcast it after its shuffle, and each broadcast costs the driver a thread and memory."""
    return df.hint("merge")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the undirected edges (a, b); equal roots mean the same component.

    Each round hooks every node to the smallest neighbour of its smallest neighbour and contracts the edges, which keeps
    joins between narrow tables, never gathers a component in one task and ends after about log n rounds, as node order
    is random. The last FEW edges are joined in one task: rounds of joins would cost more than they have to do.
    """

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches, pa.schema([("a", pa.int64()), ("b", pa.int64())]))
        nodes, at = np.unique(np.concatenate([rows["a"].to_numpy(), rows["b"].to_numpy()]), return_inverse=True)
        to = nodes[joined_labels(np.arange(len(nodes)), at[: len(rows)], at[len(rows) :])]
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(to)], ["from", "to"])

    def moved(back: DataFrame, hooks: DataFrame) -> DataFrame:
        return back.join(merged(hooks), back["root"] == hooks["from"], "left").select("node", F.coalesce("to", "root").alias("root"))

    edges = edges.where("a <> b").select(mixed(F.col("a")).alias("a"), mixed(F.col("b")).alias("b"), F.col("a").alias("x"), F.col("b").alias("y"))
    edges = cut(edges)
    live = cut(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    back = edges.select(F.explode(F.array(F.struct(F.col("x").alias("node"), F.col("a").alias("root")), F.struct(F.col("y").alias("node"), F.col("b").alias("root")))).alias("e")).select("e.*").distinct()
    while n := live.count():
        if n <= FEW:
            return moved(back, live.repartition(1).mapInArrow(rest, "from long, to long"))
        one = live.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("b"))
        two = one.select(F.col("a").alias("b"), F.col("b").alias("to"))
        hooks = cut(one.join(merged(two), "b").select(F.col("a").alias("from"), "to"))
        back = moved(back, hooks)
        left = live.join(merged(hooks), live["a"] == hooks["from"]).select(F.col("to").alias("a"), "b")
        both = left.join(merged(hooks), left["b"] == hooks["from"]).select("a", F.col("to").alias("b"))
        live = cut(both.where("a <> b").distinct())
    return back


def joined_labels(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Flat labels (each the smallest index of its class) after the links i-j."""
    while True:
        a, b = labels[i], labels[j]
        differ = a != b
        if not differ.any():
            return labels
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            further = labels[labels]
            if np.array_equal(further, labels):
                break
            labels = further


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of one key after another, from batches sorted by keys."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        changed = np.zeros(batch.num_rows, bool)
        for c in columns:
            changed[1:] |= c[1:] != c[:-1]
        changed[0] = bool(held) and any(c[0] != held[-1].column(k)[-1].as_py() for c, k in zip(columns, keys, strict=True))
        starts = np.flatnonzero(changed)
        if not len(starts):
            held.append(batch)
            continue
        if starts[0] > 0:
            held.append(batch.slice(0, starts[0]))
        if held:
            yield pa.Table.from_batches(held)
        for k, s in enumerate(starts[:-1]):
            yield pa.Table.from_batches([batch.slice(s, starts[k + 1] - s)])
        held = [batch.slice(starts[-1])]
    if held:
        yield pa.Table.from_batches(held)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], least: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(rows, number of each row's group) from batches sorted by keys: tables of whole groups, each of at least so many
    rows if there are more."""
    held: list[pa.RecordBatch] = []
    n = 0

    def numbers(rows: pa.Table) -> np.ndarray:
        changed = np.zeros(len(rows), bool)
        for k in keys:
            c = rows[k].to_numpy()
            changed[1:] |= c[1:] != c[:-1]
        return np.cumsum(changed)

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= least:
            rows = pa.Table.from_batches(held).combine_chunks()
            group = numbers(rows)
            end = int(np.searchsorted(group, group[-1]))
            if end:
                yield rows.slice(0, end), group[:end]
            held = rows.slice(end).to_batches()
            # A group larger than this waits for its end without being numbered again and again.
            n = 0 if not end else len(rows) - end
    if held:
        rows = pa.Table.from_batches(held).combine_chunks()
        yield rows, numbers(rows)


def hot_split(rows: DataFrame, key: str, node: str, limit: int) -> DataFrame:
    """rows plus a column part. The homes of a key with more than limit of them are dealt into parts by node, and all its
    other rows go to each part, so that no task gathers a hot key; home and visitor still meet exactly once."""
    hot = cut(rows.where("home").groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit).select(F.col(key).alias("hot_key"), F.ceil(F.col("n") / limit).cast("int").alias("parts")))
    if hot.isEmpty():
        return rows.withColumn("part", F.lit(0))
    parts = F.coalesce("parts", F.lit(1))
    dealt = rows.join(hot, rows[key] == hot["hot_key"], "left")
    own = F.array(F.pmod(F.xxhash64(node), parts).cast("int"))
    to = F.when(F.col("home"), own).otherwise(F.sequence(F.lit(0), parts - 1))
    # A home also visits the other parts of its own key.
    here = dealt.select(*rows.columns, F.explode(to).alias("part"))
    away = dealt.where("home AND parts > 1").select(*[F.lit(False).alias("home") if c == "home" else F.col(c) for c in rows.columns], F.explode(F.array_except(F.sequence(F.lit(0), parts - 1), own)).alias("part"))
    return here.unionByName(away)


def batched(fn: Callable, batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """fn over slices of at most most bytes, to bound what a worker holds."""
    for batch in batches:
        step = max(1, int(batch.num_rows * most / max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, step):
            yield fn(batch.slice(at, step))


def kept(df: DataFrame) -> DataFrame:
    """df as a table of its own in the shared folder, which goes when the application ends."""
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    found = spark.read.parquet(path)
    found.kept_at = place
    return found


def gone(*tables: DataFrame) -> None:
    """Deletes tables of kept() that nothing reads any more: what was made of them is kept itself."""
    for t in tables:
        t.kept_at.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(t.kept_at, True)
