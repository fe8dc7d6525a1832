"""Constraints as queries: each rule gives its violations as (rule, id, message), all are collected."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.plans.registry import query, sql_query, table


def violations(rule: str, rows: DataFrame, id_col: str, message: str) -> DataFrame:
    return rows.select(F.lit(rule).alias("rule"), F.col(id_col).cast("string").alias("id"), F.lit(message).alias("message"))


def check(rule: str, rows: DataFrame, id_col: str, holds: Column, message: str) -> DataFrame:
    """Rows where a predicate isn't true; null counts as not true."""
    return violations(rule, rows.where(~F.coalesce(holds, F.lit(False))), id_col, message)


def unique(rule: str, rows: DataFrame, key: str) -> DataFrame:
    return violations(rule, rows.groupBy(key).count().where("count > 1"), key, "repeated key")


def references(rule: str, rows: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    return violations(rule, rows.join(parent.select(F.col(parent_key).alias("__k")), F.col(key) == F.col("__k"), "left_anti"), key, "unknown parent")


def all_of(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


@query(
    "C7_C8_violations",
    """SELECT 'pk' AS rule, doc_id::VARCHAR AS id, 'repeated key' AS message FROM $documents GROUP BY doc_id HAVING count(*) > 1
    UNION ALL SELECT 'fk', l.doc_id::VARCHAR, 'unknown parent' FROM $labels l WHERE NOT EXISTS (SELECT 1 FROM $documents d WHERE d.doc_id = l.doc_id)
    UNION ALL SELECT 'domain', doc_id::VARCHAR, 'language outside the list' FROM $documents WHERE lang NOT IN ('en', 'de')
    UNION ALL SELECT 'size', doc_id::VARCHAR, 'declared size differs' FROM $documents WHERE n_chars <> length(text)
    UNION ALL SELECT 'customer', o_custkey::VARCHAR, 'unknown parent' FROM $orders o WHERE NOT EXISTS (SELECT 1 FROM $customer c WHERE c.c_custkey = o.o_custkey)
    UNION ALL SELECT 'price', p_partkey::VARCHAR, 'price out of range' FROM $part WHERE NOT (p_retailprice BETWEEN 1 AND 1500)""",
)
def all_violations(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return all_of([
        unique("pk", docs, "doc_id"),
        references("fk", labels, "doc_id", docs, "doc_id"),
        check("domain", docs, "doc_id", F.col("lang").isin("en", "de"), "language outside the list"),
        check("size", docs, "doc_id", F.col("n_chars") == F.length("text"), "declared size differs"),
        references("customer", table(spark, sf_dir, "orders"), "o_custkey", table(spark, sf_dir, "customer"), "c_custkey"),
        check("price", table(spark, sf_dir, "part"), "p_partkey", F.col("p_retailprice").between(1, 1500), "price out of range"),
    ])


@query(
    "C9_record_policies",
    """SELECT 'required' AS rule, event_id::VARCHAR AS id, 'props must hold k' AS message FROM $events WHERE props ->> 'k' IS NULL
    UNION ALL SELECT 'forbidden', event_id::VARCHAR, 'k above the limit' FROM $events WHERE (props ->> 'k')::BIGINT > 95
    UNION ALL SELECT 'enum', event_id::VARCHAR, 'event type' FROM $events WHERE event_type NOT IN ('click', 'view', 'purchase', 'signup')
    UNION ALL SELECT 'cross', event_id::VARCHAR, 'purchases need a value' FROM $events WHERE event_type = 'purchase' AND value < 1""",
)
def policies(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("k", F.from_json("props", "k long")["k"])
    return all_of([
        check("required", e, "event_id", F.col("k").isNotNull(), "props must hold k"),
        violations("forbidden", e.where("k > 95"), "event_id", "k above the limit"),
        check("enum", e, "event_id", F.col("event_type").isin("click", "view", "purchase", "signup"), "event type"),
        violations("cross", e.where("event_type = 'purchase' AND value < 1"), "event_id", "purchases need a value"),
    ])


sql_query("C10_label_approval", "SELECT n_regionkey AS level, lower(trim(n_name)) AS name, count(*) AS n FROM (SELECT n_regionkey, n_name FROM $nation UNION ALL SELECT n_regionkey, upper(n_name) FROM $nation WHERE n_nationkey % 4 = 0) x GROUP BY n_regionkey, lower(trim(n_name)) HAVING count(*) > 1")
sql_query("C11_staleness", "WITH stored AS (SELECT source, count(*) + CASE WHEN source = 'src7' THEN 1 ELSE 0 END AS n FROM $documents GROUP BY source), rebuilt AS (SELECT source, count(*) AS n FROM $documents GROUP BY source) SELECT 'stale' AS side, source, n FROM (SELECT * FROM stored EXCEPT ALL SELECT * FROM rebuilt) a UNION ALL SELECT 'missing', source, n FROM (SELECT * FROM rebuilt EXCEPT ALL SELECT * FROM stored) b")
sql_query("C17_dense_sequences", "SELECT conv_id, count(*) = max(turn) + 1 AND min(turn) = 0 AND count(DISTINCT turn) = count(*) AS dense FROM $conversations GROUP BY conv_id")
_EDGES = "WITH e AS (SELECT l_orderkey AS src, l_suppkey AS dst, round(l_discount, 6) AS sim, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS r FROM $lineitem), o AS (SELECT *, lag(sim) OVER (PARTITION BY src ORDER BY r) AS before FROM e)"
#: Rows of a partition whose lists are looked at together.
LISTED = 1 << 18


@query("C20_neighbour_integrity", f"{_EDGES} SELECT src, count(*) AS n, count(DISTINCT dst) = count(*) AS distinct_ends, max(CASE WHEN src = dst THEN 1 ELSE 0 END) = 0 AS no_self, max(CASE WHEN before < sim THEN 1 ELSE 0 END) = 0 AS sorted, min(sim) >= -1 AND max(sim) <= 1 AS bounded FROM o GROUP BY src")
def neighbour_integrity(spark, sf_dir):
    """Order lines as neighbour lists: their ends, order and range. Partitions are as many as the rows ask, so that what a task
    sorts and counts doesn't grow."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("src"), F.col("l_suppkey").alias("dst"), F.round("l_discount", 6).alias("sim"), "l_linenumber", "l_partkey", "l_extendedprice")
    dealt = lines.repartition(max(1, -(-lines.count() // LISTED)), "src")
    edges = dealt.withColumn("before", F.lag("sim").over(Window.partitionBy("src").orderBy("l_linenumber", "l_partkey", "dst", "l_extendedprice")))
    none = lambda wrong: F.max(F.when(wrong, 1).otherwise(0)) == 0
    return edges.groupBy("src").agg(F.count(F.lit(1)).alias("n"), (F.count_distinct("dst") == F.count(F.lit(1))).alias("distinct_ends"), none(F.col("src") == F.col("dst")).alias("no_self"), none(F.col("before") < F.col("sim")).alias("sorted"), ((F.min("sim") >= -1) & (F.max("sim") <= 1)).alias("bounded"))


sql_query("C21_reconciliation", "WITH d AS (SELECT l_orderkey, sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18, 4))) AS detail FROM $lineitem GROUP BY l_orderkey) SELECT o.o_orderkey, CAST(CAST(o.o_totalprice AS DECIMAL(18, 4)) - coalesce(d.detail, 0) AS DOUBLE) AS gap FROM $orders o LEFT JOIN d ON d.l_orderkey = o.o_orderkey WHERE abs(o.o_totalprice - coalesce(d.detail, 0)) > 1")
sql_query("C22_all_or_nothing", "SELECT d.source, count(l.doc_id) AS cached, count(*) AS n, count(l.doc_id) IN (0, count(*)) AS whole FROM $documents d LEFT JOIN $labels l ON l.doc_id = d.doc_id GROUP BY d.source")
