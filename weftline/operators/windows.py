"""Window and sequence operators (W)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.plans.registry import query, sql_query, table

#: Rows of a group that one window numbers, at most about: the group's rows are dealt to so many buckets of a key.
BUCKET = 1 << 16


def first_of(rows: DataFrame, group: list[str], order: list[Column], most: int, name: str, salts: int = 64) -> DataFrame:
    """The first `most` rows of each group in an order, numbered: first of each of its salts, so that no task takes a group
    whole."""
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(*rows.columns), F.lit(salts)))
    few = salted.withColumn("__k", F.row_number().over(Window.partitionBy(*group, "__salt").orderBy(*order))).where(F.col("__k") <= most).drop("__k", "__salt")
    return few.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col(name) <= most)


def numbered(rows: DataFrame, group: str, buckets: list[Column], order: list[Column], name: str, total: str | None = None) -> DataFrame:
    """rows plus their number within the group, from 1, and the group's size: numbers within buckets, plus the sizes of the
    buckets before. buckets are coarse columns that rise with the order; each bucket is numbered by itself, so that no task
    sorts a group whole."""
    keys = [f"__b{k}" for k in range(len(buckets))]
    cut = rows.withColumns(dict(zip(keys, buckets, strict=True)))
    inside = Window.partitionBy(group, *keys).orderBy(*order)
    sizes = cut.groupBy(group, *keys).agg(F.count(F.lit(1)).alias("__size"))
    by = Window.partitionBy(group).orderBy(*keys)
    before = sizes.select(F.col(group).alias("__g"), *[F.col(k).alias(f"{k}x") for k in keys], (F.sum("__size").over(by) - F.col("__size")).alias("__before"), F.sum("__size").over(Window.partitionBy(group)).alias("__all"))
    same = F.col(group).eqNullSafe(F.col("__g"))
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"{k}x"))
    made = cut.withColumn("__k", F.row_number().over(inside)).join(before, same).withColumn(name, F.col("__before") + F.col("__k"))
    return (made if total is None else made.withColumn(total, F.col("__all"))).select(*rows.columns, name, *([total] if total else []))


@query(
    "W3_central_boundary",
    """WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM $embeddings),
    c AS (SELECT label, list(m ORDER BY pos) AS c FROM (SELECT label, pos, avg(x) AS m FROM (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM e) t GROUP BY label, pos) s GROUP BY label),
    d AS (SELECT c.label, e.vec_id, e.label = c.label AS inside, round(list_distance(e.v, c.c), 8) AS distance FROM e CROSS JOIN c),
    r AS (SELECT *, row_number() OVER (PARTITION BY label, inside ORDER BY distance, vec_id) AS near, row_number() OVER (PARTITION BY label, inside ORDER BY distance DESC, vec_id DESC) AS far FROM d)
    SELECT label, 'central' AS kind, near AS place, vec_id FROM r WHERE inside AND near <= 5 UNION ALL SELECT label, 'boundary', far, vec_id FROM r WHERE inside AND far <= 5 UNION ALL SELECT label, 'outside', near, vec_id FROM r WHERE NOT inside AND near <= 3""",
)
def samples(spark, sf_dir):
    """Of each group the rows nearest to its centroid and farthest from it, and the nearest of other groups."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    means = e.select("label", F.posexplode("v").alias("pos", "x")).groupBy("label", "pos").agg(F.avg("x").alias("m"))
    centres = means.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda p: p["m"]).alias("c"))
    gap = F.sqrt(F.aggregate(F.zip_with("v", "c", lambda x, m: (x - m) * (x - m)), F.lit(0.0), lambda s, x: s + x))
    # One row per group on the right.
    met = e.withColumnRenamed("label", "own").crossJoin(F.broadcast(centres)).select("label", "vec_id", (F.col("own") == F.col("label")).alias("inside"), F.round(gap, 8).alias("distance"))
    near, far = [F.asc("distance"), F.asc("vec_id")], [F.desc("distance"), F.desc("vec_id")]
    parts = [first_of(met.where(c), ["label"], order, most, "place").select("label", F.lit(kind).alias("kind"), "place", "vec_id") for kind, c, order, most in (("central", "inside", near, 5), ("boundary", "inside", far, 5), ("outside", "NOT inside", near, 3))]
    return parts[0].union(parts[1]).union(parts[2])


sql_query(
    "W4_best_second_alternative",
    "WITH n AS (SELECT o.o_custkey, l.l_suppkey, count(*) AS n FROM $orders o JOIN $lineitem l ON l.l_orderkey = o.o_orderkey WHERE l.l_suppkey <> o.o_custkey % 100 GROUP BY o.o_custkey, l.l_suppkey), r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, l_suppkey) AS r FROM n) SELECT o_custkey, max(CASE WHEN r = 1 THEN l_suppkey END) AS best, max(CASE WHEN r = 2 THEN l_suppkey END) AS second FROM r WHERE r <= 2 GROUP BY o_custkey",
)
sql_query("W5_bottom_five_percent", "WITH r AS (SELECT p_partkey, p_retailprice, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey) AS r, count(*) OVER (PARTITION BY p_brand) AS n FROM $part) SELECT p_partkey, r FROM r WHERE r <= greatest(1, ceil(n * 0.05))")
@query("W6_sequence_numbers", "SELECT doc_id, '[' || row_number() OVER (PARTITION BY source ORDER BY lower(lang), doc_id) || '/' || count(*) OVER (PARTITION BY source) || ']' AS number FROM $documents")
def sequence_numbers(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.lower("lang").alias("l"))
    made = numbered(docs, "source", [F.col("l"), F.floor(F.col("doc_id") / BUCKET)], [F.asc("l"), F.asc("doc_id")], "k", "n")
    return made.select("doc_id", F.concat(F.lit("["), "k", F.lit("/"), "n", F.lit("]")).alias("number"))


sql_query("W7_carry_forward", "SELECT conv_id, turn, last(CASE WHEN turn % 3 = 0 THEN turn END, true) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS page FROM $conversations", "SELECT conv_id, turn, last_value(CASE WHEN turn % 3 = 0 THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS page FROM $conversations")
sql_query("W8_next_start_boundary", "SELECT conv_id, turn AS first, coalesce(lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) - 1, turn) AS last FROM $conversations WHERE role = 'user'")
# Doubles would miss a budget that is spent to the last cent; decimals add the values as they are written. What decimals
# don't hold stays a sum of doubles.
sql_query(
    "W10_running_budget",
    """WITH s AS (SELECT event_id, user_id, sum(value) OVER w AS rough, cast(try_sum(try_cast(value AS DECIMAL(38, 18))) OVER w AS DOUBLE) AS exact FROM $events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
    c AS (SELECT event_id, user_id, CASE WHEN abs(rough) < 1e15D AND exact IS NOT NULL THEN exact ELSE rough END AS spent FROM s) SELECT event_id, user_id, round(spent, 4) AS spent FROM c WHERE spent <= 2000""",
    "SELECT event_id, user_id, round(spent, 4) AS spent FROM (SELECT event_id, user_id, sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS spent FROM $events) t WHERE spent <= 2000",
)
sql_query("W11_latest_batch", "WITH l AS (SELECT user_id, max_by(event_id, struct(ts, event_id)) AS latest FROM $events GROUP BY user_id) SELECT e.event_id, e.user_id, e.event_id <=> l.latest AS is_latest FROM $events e JOIN l ON l.user_id = e.user_id", "WITH l AS (SELECT user_id, event_id AS latest FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM $events) t WHERE r = 1) SELECT e.event_id, e.user_id, e.event_id IS NOT DISTINCT FROM l.latest AS is_latest FROM $events e JOIN l ON l.user_id = e.user_id")


def greedy_chunks(sizes, limit: int, joint: int = 2) -> list[int]:
    """For ordered sizes, the chunk of each: a new one starts where the joined length would exceed limit."""
    chunk, length, of = 0, None, []
    for size in sizes:
        if length is not None and length + joint + size > limit:
            chunk, length = chunk + 1, None
        length = size if length is None else length + joint + size
        of.append(chunk)
    return of


@query(
    "W9_greedy_packing",
    """WITH RECURSIVE o AS (SELECT conv_id, turn, length(text) AS size, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM $conversations),
    p AS (SELECT conv_id, turn, k, size::BIGINT AS used, 0 AS chunk FROM o WHERE k = 1
      UNION ALL SELECT o.conv_id, o.turn, o.k, CASE WHEN p.used + 2 + o.size > 900 THEN o.size ELSE p.used + 2 + o.size END, CASE WHEN p.used + 2 + o.size > 900 THEN p.chunk + 1 ELSE p.chunk END FROM p JOIN o ON o.conv_id = p.conv_id AND o.k = p.k + 1)
    SELECT conv_id, turn, chunk FROM p""",
)
def greedy(spark, sf_dir):
    """Each place depends on the one before, so a conversation is one pass in order, linear in its turns."""

    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("turn")
        return pd.DataFrame({"conv_id": g["conv_id"], "turn": g["turn"], "chunk": greedy_chunks(g["size"], 900)})

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.length("text").alias("size"))
    return rows.groupBy("conv_id").applyInPandas(run, f"conv_id {dict(rows.dtypes)['conv_id']}, turn {dict(rows.dtypes)['turn']}, chunk int")
