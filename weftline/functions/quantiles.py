"""Exact quantiles of groups of any size, by distributed selection.

Small groups are aggregated at once. Of a group of more than `limit` values no task takes all: a mergeable sketch gives
marks of known rank error, the wanted order statistic lies between two of them, the rows below are counted, and what lies
between is the next, far smaller bracket. The last bracket, of at most `limit` rows, or of one value, gives the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Values of a group that one task may take, marks of a sketch, and its accuracy (ranks are off by 1 / ACCURACY at most).
LIMIT, MARKS, ACCURACY = 50_000, 500, 20_000


def exact_quantiles(rows: DataFrame, key: str, value: str, ps: tuple[float, ...], limit: int = LIMIT) -> DataFrame:
    """(key, n, q): linearly interpolated quantiles ps of value in each group of key, nulls of value left out; q is an array
    in the order of ps. A null key is a group."""
    own = rows.select(F.col(key).alias("g"), F.col(value).cast("double").alias("v")).where("v IS NOT NULL")
    sizes = own.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    # There are at most rows / limit groups of more values.
    hot = sizes.where(F.col("n") > limit).select(F.col("g").alias("hot"), "n").collect()
    if not hot:
        return own.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.percentile("v", F.array(*[F.lit(float(p)) for p in ps])).alias("q")).withColumnRenamed("g", key)
    held = own.sparkSession.createDataFrame(hot, sizes.where("false").select(F.col("g").alias("hot"), "n").schema)
    is_hot = F.col("g").eqNullSafe(F.col("hot"))
    small = own.join(held.select("hot"), is_hot, "left_anti").groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.percentile("v", F.array(*[F.lit(float(p)) for p in ps])).alias("q"))
    large = own.join(held.select("hot"), is_hot, "left_semi")
    # Per group and p the ranks below and above; `k` counts from 0 inside the bracket.
    asked = [(r["hot"], r["n"], i, s, int(p * (r["n"] - 1)) + s, float("-inf"), float("inf"), None) for r in hot for i, p in enumerate(ps) for s in (0, 1) if int(p * (r["n"] - 1)) + s < r["n"]]
    kind = f"hot {own.schema['g'].dataType.simpleString()}, n long, i int, s int, k long, lo double, hi double, found double"
    marks = F.percentile_approx("v", F.array(*[F.lit(j / MARKS) for j in range(MARKS + 1)]), F.lit(ACCURACY))
    done = []
    while asked:
        todo = own.sparkSession.createDataFrame(asked, kind)
        brackets = todo.select("hot", "lo", "hi").distinct()
        inside = large.join(brackets, is_hot & F.col("v").between(F.col("lo"), F.col("hi")))
        sketched = {(r["hot"], r["lo"], r["hi"]): r for r in inside.groupBy("hot", "lo", "hi").agg(F.count(F.lit(1)).alias("m"), F.min("v").alias("least"), F.max("v").alias("most"), marks.alias("marks")).collect()}
        narrower, last = [], []
        for hot_key, n, i, s, k, lo, hi, _ in asked:
            r = sketched[hot_key, lo, hi]
            if r["least"] == r["most"]:
                done.append((hot_key, n, i, s, r["least"]))
            elif r["m"] <= limit:
                last.append((hot_key, n, i, s, k, lo, hi, None))
            else:
                at, off = k / r["m"], 2 / ACCURACY
                below = [q for j, q in enumerate(r["marks"]) if j / MARKS <= at - off]
                above = [q for j, q in enumerate(r["marks"]) if j / MARKS >= at + off]
                narrower.append((hot_key, n, i, s, k, lo, max(below[-1] if below else r["least"], lo), min(above[0] if above else r["most"], hi)))
        if last:
            ends = own.sparkSession.createDataFrame(last, kind)
            sorted_ones = large.join(ends.select("hot", "lo", "hi").distinct(), is_hot & F.col("v").between(F.col("lo"), F.col("hi"))).groupBy("hot", "lo", "hi").agg(F.array_sort(F.collect_list("v")).alias("vs"))
            picked = ends.join(sorted_ones.withColumnsRenamed({"hot": "hot2", "lo": "lo2", "hi": "hi2"}), F.col("hot").eqNullSafe(F.col("hot2")) & (F.col("lo") == F.col("lo2")) & (F.col("hi") == F.col("hi2")))
            done += [tuple(r) for r in picked.select("hot", "n", "i", "s", F.get("vs", F.col("k").cast("int")).alias("found")).collect()]
        asked = []
        if narrower:
            cuts = own.sparkSession.createDataFrame([(h, lo, new) for h, _, _, _, _, lo, new, _ in set(narrower)], f"hot {own.schema['g'].dataType.simpleString()}, lo double, new double").distinct()
            under = large.join(cuts, is_hot & (F.col("v") >= F.col("lo")) & (F.col("v") < F.col("new"))).groupBy("hot", "lo", "new").agg(F.count(F.lit(1)).alias("c"))
            counted = {(r["hot"], r["lo"], r["new"]): r["c"] for r in under.collect()}
            asked = [(h, n, i, s, k - counted.get((h, lo, new), 0), new, high, None) for h, n, i, s, k, lo, new, high in narrower]
    stats = {(h, i, s): v for h, _, i, s, v in done}
    answers = []
    for r in hot:
        qs = []
        for i, p in enumerate(ps):
            at = p * (r["n"] - 1)
            one = stats[r["hot"], i, 0]
            two = stats.get((r["hot"], i, 1), one)
            qs.append(one + (two - one) * (at - int(at)))
        answers.append((r["hot"], r["n"], qs))
    found = own.sparkSession.createDataFrame(answers, f"g {own.schema['g'].dataType.simpleString()}, n long, q array<double>")
    return small.unionByName(found).withColumnRenamed("g", key)
