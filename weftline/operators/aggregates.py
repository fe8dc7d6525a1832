"""Aggregations (A)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.quantiles import exact_quantiles
from weftline.plans.registry import query, sql_query, table

#: Members of a block of ordered_digest().
BLOCK = 1000


def ordered_digest(rows: DataFrame, group: list[str], order: str, member: Column, sep: str) -> DataFrame:
    """(group, block, digest): SHA-256 of the members of each block of BLOCK numbers, in order. The blocks of a group in
    order make its digest; no task takes a group whole."""
    block = F.floor(F.col(order) / BLOCK).alias("block")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order), member.alias("m")))), lambda x: x["m"]), sep)
    return rows.groupBy(*group, block).agg(F.sha2(joined, 256).alias("digest"))

sql_query("A1_group_counts", "SELECT source, lang, count(*) AS n FROM $documents GROUP BY source, lang UNION ALL SELECT kind, 'kind', count(*) FROM (SELECT explode(array(lang, substring(source, 1, 4))) AS kind FROM $documents) GROUP BY kind", "SELECT source, lang, count(*) AS n FROM $documents GROUP BY source, lang UNION ALL SELECT kind, 'kind', count(*) FROM (SELECT unnest([lang, substring(source, 1, 4)]) AS kind FROM $documents) t GROUP BY kind")
sql_query("A2_document_frequency", "SELECT term, count(*) AS df FROM (SELECT doc_id, explode(array_distinct(regexp_extract_all(lower(text), '[a-z0-9]+', 0))) AS term FROM $documents) GROUP BY term", "SELECT term, count(*) AS df FROM (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+'))) AS term FROM $documents) t GROUP BY term")
sql_query("A3_guarded_ratios", "SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 4) AS sum_qty, min(l_discount) AS least, max(l_discount) AS most, round(avg(l_extendedprice), 6) AS mean_price, CASE WHEN sum(l_quantity) > 0 THEN round(sum(l_extendedprice) / sum(l_quantity), 6) ELSE 0 END AS per_unit FROM $lineitem GROUP BY l_returnflag, l_linestatus")
sql_query(
    "A4_usage_rollup",
    """SELECT coalesce(event_type, '(all)') AS recipe, count(*) AS requests, round(sum(value), 4) AS tokens, CASE WHEN count(cost) = count(*) THEN round(sum(cost), 6) END AS billed, round(sum(coalesce(cost, value * 0.1D / 1000000)), 6) AS reference
    FROM (SELECT event_type, value, CASE WHEN event_type = 'error' AND user_id % 2 = 0 THEN NULL ELSE value * 2D / 1000 END AS cost FROM $events) GROUP BY ROLLUP (event_type)""",
    """SELECT coalesce(event_type, '(all)') AS recipe, count(*) AS requests, round(sum(value), 4) AS tokens, CASE WHEN count(cost) = count(*) THEN round(sum(cost), 6) END AS billed, round(sum(coalesce(cost, value * 0.1::DOUBLE / 1000000)), 6) AS reference
    FROM (SELECT event_type, value, CASE WHEN event_type = 'error' AND user_id % 2 = 0 THEN NULL ELSE value * 2::DOUBLE / 1000 END AS cost FROM $events) t GROUP BY ROLLUP (event_type)""",
)
sql_query("A5_conditional_coverage", "SELECT d.source, count(*) AS n, count(*) FILTER (WHERE l.quality = 1) AS hits, round(count(*) FILTER (WHERE l.quality = 1) / cast(count(*) AS DOUBLE), 6) AS share FROM $documents d LEFT JOIN $labels l ON l.doc_id = d.doc_id GROUP BY d.source")
sql_query(
    "A6_A7_entropy_dominance",
    "WITH n AS (SELECT source, lang, count(*) AS n FROM $documents GROUP BY source, lang), t AS (SELECT *, sum(n) OVER (PARTITION BY source) AS total FROM n) SELECT source, round(abs(-sum(n / cast(total AS DOUBLE) * ln(n / cast(total AS DOUBLE))) / ln(4D)), 6) AS entropy, round(max(n) / cast(sum(n) AS DOUBLE), 6) AS dominance FROM t GROUP BY source",
    "WITH n AS (SELECT source, lang, count(*) AS n FROM $documents GROUP BY source, lang), t AS (SELECT *, sum(n) OVER (PARTITION BY source) AS total FROM n) SELECT source, round(abs(-sum(n / cast(total AS DOUBLE) * ln(n / cast(total AS DOUBLE))) / ln(4::DOUBLE)), 6) AS entropy, round(max(n) / cast(sum(n) AS DOUBLE), 6) AS dominance FROM t GROUP BY source",
)
sql_query(
    "A8_signal_partition",
    "WITH s AS (SELECT doc_id, size(array_compact(array(CASE WHEN contains(lower(text), 'the') THEN 1 END, CASE WHEN contains(lower(text), 'ein') THEN 2 END, CASE WHEN contains(lower(text), 'ción') THEN 3 END))) AS v FROM $documents) SELECT count(*) FILTER (WHERE v = 0) AS none, count(*) FILTER (WHERE v >= 1) AS some, count(*) FILTER (WHERE v > 1) AS several FROM s",
    "WITH s AS (SELECT doc_id, contains(lower(text), 'the')::INT + contains(lower(text), 'ein')::INT + contains(lower(text), 'ción')::INT AS v FROM $documents) SELECT count(*) FILTER (WHERE v = 0) AS none, count(*) FILTER (WHERE v >= 1) AS some, count(*) FILTER (WHERE v > 1) AS several FROM s",
)
sql_query("A9_exact_duplicates", "SELECT sha2(text, 256) AS hash, count(*) AS n, min(doc_id) AS first, array_join(transform(array_sort(collect_list(doc_id)), x -> cast(x AS STRING)), ',') AS members FROM $documents GROUP BY sha2(text, 256) HAVING count(*) > 1", "SELECT sha256(text) AS hash, count(*) AS n, min(doc_id) AS first, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS members FROM $documents GROUP BY sha256(text) HAVING count(*) > 1")
sql_query("A10_keep_first", "SELECT doc_id, key FROM (SELECT doc_id, sha2(lower(regexp_replace(text, '[^\\\\p{L}]', '')), 256) AS key, row_number() OVER (PARTITION BY sha2(lower(regexp_replace(text, '[^\\\\p{L}]', '')), 256) ORDER BY doc_id) AS r FROM $documents) WHERE r = 1", "SELECT doc_id, key FROM (SELECT doc_id, sha256(lower(regexp_replace(text, '[^\\p{L}]', '', 'g'))) AS key, row_number() OVER (PARTITION BY sha256(lower(regexp_replace(text, '[^\\p{L}]', '', 'g'))) ORDER BY doc_id) AS r FROM $documents) t WHERE r = 1")
sql_query("A11_mode", "WITH n AS (SELECT source, lang, count(*) AS n FROM $documents GROUP BY source, lang) SELECT source, lang AS label FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, lower(lang), lang) AS r FROM n) WHERE r = 1", "WITH n AS (SELECT source, lang, count(*) AS n FROM $documents GROUP BY source, lang) SELECT source, lang AS label FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, lower(lang), lang) AS r FROM n) t WHERE r = 1")

@query("A12_quantiles_iqr", "WITH q AS (SELECT lang, quantile_cont(n_chars::DOUBLE, 0.25) AS q1, quantile_cont(n_chars::DOUBLE, 0.75) AS q3 FROM $documents GROUP BY lang) SELECT lang, round(q1, 6) AS q1, round(q3, 6) AS q3, round(q1 - 1.5 * (q3 - q1), 6) AS fence FROM q")
def quartiles(spark, sf_dir):
    """Quartiles and the lower fence of each language's lengths; hot languages by selection."""
    q = exact_quantiles(table(spark, sf_dir, "documents"), "lang", "n_chars", (0.25, 0.75)).select("lang", F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3"))
    return q.select("lang", F.round("q1", 6).alias("q1"), F.round("q3", 6).alias("q3"), F.round(F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")), 6).alias("fence"))


sql_query("A13_centroid", "SELECT label, pos, round(avg(cast(x AS DOUBLE)), 6) AS mean, count(*) AS n FROM (SELECT label, posexplode(embedding) AS (pos, x) FROM $embeddings) GROUP BY label, pos", "SELECT label, pos - 1 AS pos, round(avg(x::DOUBLE), 6) AS mean, count(*) AS n FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM $embeddings) t GROUP BY label, pos")


@query(
    "A14_ordered_digest",
    "WITH b AS (SELECT source, doc_id // 1000 AS b, sha256(string_agg(doc_id || ':' || sha256(text), ';' ORDER BY doc_id)) AS digest FROM $documents GROUP BY source, doc_id // 1000) SELECT source, sha256(string_agg(digest, ';' ORDER BY b)) AS digest FROM b GROUP BY source",
)
def corpus_digest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    blocks = ordered_digest(docs, ["source"], "doc_id", F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.sha2("text", 256)), ";")
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "digest"))), lambda x: x["digest"]), ";")
    return blocks.groupBy("source").agg(F.sha2(whole, 256).alias("digest"))


sql_query("A15_cluster_sizes", "SELECT median(n) AS middle, min(n) AS least, max(n) AS most FROM (SELECT label, count(*) AS n FROM $embeddings GROUP BY label)", "SELECT median(n) AS middle, min(n) AS least, max(n) AS most FROM (SELECT label, count(*) AS n FROM $embeddings GROUP BY label) t")
sql_query("A16_option_lists", "SELECT facet, value FROM (SELECT DISTINCT 'lang' AS facet, lang AS value FROM $documents UNION SELECT 'source', source FROM $documents) ORDER BY facet, value", "SELECT facet, value FROM (SELECT DISTINCT 'lang' AS facet, lang AS value FROM $documents UNION SELECT 'source', source FROM $documents) t ORDER BY facet, value")
sql_query("A17_completion_status", "SELECT d.source, CASE WHEN count(l.doc_id) = 0 THEN 'not-started' WHEN count(l.doc_id) < count(*) THEN 'in-progress' ELSE 'complete' END AS status, count(l.doc_id) AS done FROM $documents d LEFT JOIN $labels l ON l.doc_id = d.doc_id GROUP BY d.source")
sql_query("A18_confidence_fallback", "SELECT conv_id, round(coalesce(max(CASE WHEN turn > 90 THEN 1D END), avg(length(text)) / 1000), 6) AS confidence FROM $conversations GROUP BY conv_id", "SELECT conv_id, round(coalesce(max(CASE WHEN turn > 90 THEN 1::DOUBLE END), avg(length(text)) / 1000), 6) AS confidence FROM $conversations GROUP BY conv_id")
sql_query("A19_cost_with_reserved", "SELECT user_id, round(sum(coalesce(CASE WHEN event_type <> 'error' THEN value END, 0) + coalesce(CASE WHEN event_type = 'error' THEN 1D END, 0)), 4) AS cost FROM $events GROUP BY user_id", "SELECT user_id, round(sum(coalesce(CASE WHEN event_type <> 'error' THEN value END, 0) + coalesce(CASE WHEN event_type = 'error' THEN 1::DOUBLE END, 0)), 4) AS cost FROM $events GROUP BY user_id")
sql_query("A20_combine_if_keys_agree", "SELECT l_orderkey, round(sum(l_quantity), 4) AS qty, max(l_shipdate) AS last FROM $lineitem GROUP BY l_orderkey HAVING count(DISTINCT struct(l_returnflag, l_linestatus)) = 1", "SELECT l_orderkey, round(sum(l_quantity), 4) AS qty, max(l_shipdate) AS last FROM $lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_returnflag || l_linestatus) = 1")
_X, _Y = ("aggregate(transform(embedding, (x, i) -> cast(x AS DOUBLE) * {}(i + 1)), 0D, (s, x) -> s + x)".format(f) for f in ("cos", "sin"))
_DUCK_X, _DUCK_Y = ("list_sum(list_transform(embedding, lambda x, i: x::DOUBLE * {}(i)))".format(f) for f in ("cos", "sin"))
_BOX = "SELECT label, round(min(x) - 0.4{0}, 6) AS x0, round(max(x) + 0.4{0}, 6) AS x1, round(min(y) - 0.4{0}, 6) AS y0, round(max(y) + 0.4{0}, 6) AS y1 FROM (SELECT label, {1} AS x, {2} AS y FROM $embeddings) t GROUP BY label"
sql_query("A21_bounding_box", _BOX.format("D", _X, _Y), _BOX.format("::DOUBLE", _DUCK_X, _DUCK_Y))
