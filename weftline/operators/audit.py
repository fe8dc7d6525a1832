"""Corpus audits and rule-based mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.packs import FACETS, NUMERIC, SCALES, Pattern, phrases
from weftline.operators.windows import first_of
from weftline.plans.registry import query, sql_query, table


def signals(docs: DataFrame, patterns: list[Pattern]) -> DataFrame:
    """(doc_id, source, lang, dimension, value, pattern): the patterns of each document's own locale that its text shows.

    A text is cut into its distinct words once, and into pairs and endings if the packs ask for them; they meet the packs'
    words and keys. The few patterns with a regex and no keys try it only on texts that have one of their words.
    """
    spark = docs.sparkSession
    plain, others = [p for p in patterns if p.regex is None or p.keys], [p for p in patterns if p.regex is not None and not p.keys]
    words = docs.select("doc_id", "source", "lang", F.lower("text").alias("low")).select("doc_id", "source", "lang", "low", F.array_distinct(F.regexp_extract_all("low", F.lit(r"\p{L}+"), F.lit(0))).alias("words"))
    shown = "words"
    if any(p.keys for p in plain):
        # Whatever isn't a letter or a space parts words.
        side = words.withColumn("run", F.split(F.regexp_replace("low", r"[^\p{L} ]+", " | "), " +"))
        pairs = F.zip_with(F.slice("run", 1, F.greatest(F.size("run") - 1, F.lit(0))), F.slice("run", 2, F.greatest(F.size("run") - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
        endings = F.transform(F.array_distinct(F.regexp_extract_all("low", F.lit(r"(\p{L}++)[,.] "), F.lit(1))), lambda w: F.concat(w, F.lit(".")))
        words, shown = side.select("doc_id", "source", "lang", "low", "words", F.concat("words", F.array_distinct(pairs), endings).alias("shown")), "shown"
    # As large as the pack, which is a parameter.
    table_of = F.broadcast(spark.createDataFrame([(p.locale, w, p.dimension, p.value, p.id) for p in plain for w in p.keys or p.words], "lang string, word string, dimension string, value string, pattern string").distinct())
    # Not explode(): Spark would filter by the words' number first, and so cut the text twice.
    found = words.select("doc_id", "source", "lang", F.explode_outer(shown).alias("word")).join(table_of, ["lang", "word"]).select("doc_id", "source", "lang", "dimension", "value", "pattern").distinct()
    if not others:
        return found
    tried = [F.when((F.col("lang") == p.locale) & F.arrays_overlap("words", F.array(*map(F.lit, p.words))), F.when(F.col("low").rlike(p.regex), F.struct(F.lit(p.dimension).alias("dimension"), F.lit(p.value).alias("value"), F.lit(p.id).alias("pattern")))) for p in others]
    more = words.select("doc_id", "source", "lang", F.explode_outer(F.array_compact(F.array(*tried))).alias("p")).where("p IS NOT NULL").select("doc_id", "source", "lang", "p.*")
    return found.union(more)


def _twin(patterns: list[Pattern]) -> str:
    tests = {p: p.regex or rf"(^|[^\p{{L}}])({'|'.join(p.words)})([^\p{{L}}]|$)" for p in patterns}
    hits = ", ".join(f"CASE WHEN lang = '{p.locale}' AND regexp_matches(low, '{test}') THEN {{'dimension': '{p.dimension}', 'value': '{p.value}', 'pattern': '{p.id}'}} END" for p, test in tests.items())
    values = ", ".join(f"('{d}', '{v}')" for d, v in sorted({p[:2] for p in patterns}))
    locales = ", ".join(sorted({f"'{p[2]}'" for p in patterns}))
    return f"WITH v(dimension, value) AS (VALUES {values}), l AS (SELECT doc_id, source, lang, lower(text) AS low FROM $documents), u AS (SELECT doc_id, source, lang, unnest([{hits}]) AS x FROM l), g AS MATERIALIZED (SELECT doc_id, source, lang, x.dimension AS dimension, x.value AS value, x.pattern AS pattern FROM u WHERE x IS NOT NULL), h AS (SELECT DISTINCT doc_id, source, lang, dimension, value FROM g), n AS (SELECT count(*) AS n, count(*) FILTER (WHERE lang NOT IN ({locales})) AS u FROM $documents)"


#: Words and phrases; the balance of dimensions goes by words alone, which decide what a text shows. Coverage, samples and scales
#: tell what the phrases add: where in a clause it is shown.
FACET_PATTERNS, SCALE_PATTERNS = [*FACETS, *phrases(FACETS)], [*SCALES, *phrases(SCALES)]
_FACETS, _ALL_FACETS, _SCALES = _twin(FACETS), _twin(FACET_PATTERNS), _twin([*SCALE_PATTERNS, *NUMERIC])


def covered(docs: DataFrame, patterns: list[Pattern]) -> DataFrame:
    """(dimension, value, hits, sources, share, unpatterned, beside, ending) of all values, those without a hit too: of the hits, beside
    and ending have a word of the value next to a function word, and at a clause's end."""
    known = sorted({p[2] for p in patterns})
    totals = docs.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("lang").isin(known)).alias("unpatterned"))
    each = signals(docs, patterns).groupBy("doc_id", "dimension", "value").agg(F.min("source").alias("source"), *[F.max(F.endswith("pattern", F.concat(F.lit("-"), "value", F.lit(f"-{kind}")))).alias(kind) for kind in ("pair", "ending")])
    found = each.groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("hits"), F.count_distinct("source").alias("sources"), F.count_if("pair").alias("beside"), F.count_if("ending").alias("ending"))
    values = docs.sparkSession.createDataFrame(sorted({p[:2] for p in patterns}), "dimension string, value string")
    whole = values.join(found, ["dimension", "value"], "left").crossJoin(F.broadcast(totals))
    return whole.select("dimension", "value", F.coalesce("hits", F.lit(0)).alias("hits"), F.coalesce("sources", F.lit(0)).alias("sources"), F.round(F.coalesce("hits", F.lit(0)) / F.col("n"), 6).alias("share"), "unpatterned", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("beside", "ending")])


_COVERED = "SELECT v.dimension, v.value, count(h.doc_id) AS hits, count(DISTINCT h.source) AS sources, round(count(h.doc_id) / any_value(n.n)::DOUBLE, 6) AS share, any_value(n.u) AS unpatterned, coalesce(any_value(k.beside), 0) AS beside, coalesce(any_value(k.ending), 0) AS ending FROM v CROSS JOIN n LEFT JOIN h ON h.dimension = v.dimension AND h.value = v.value LEFT JOIN (SELECT dimension, value, count(DISTINCT doc_id) FILTER (WHERE ends_with(pattern, '-' || value || '-pair')) AS beside, count(DISTINCT doc_id) FILTER (WHERE ends_with(pattern, '-' || value || '-ending')) AS ending FROM g GROUP BY dimension, value) k ON k.dimension = v.dimension AND k.value = v.value GROUP BY v.dimension, v.value"


@query("C1_facet_coverage", f"{_ALL_FACETS} {_COVERED}")
def coverage(spark, sf_dir):
    return covered(table(spark, sf_dir, "documents"), FACET_PATTERNS)


@query(
    "C1_dimension_balance",
    f"""{_FACETS}, m AS (SELECT dimension, doc_id, count(*) AS v FROM h GROUP BY dimension, doc_id), c AS (SELECT dimension, value, count(*) AS k FROM h GROUP BY dimension, value),
    q AS (SELECT v.dimension, count(*) AS values, sum(coalesce(c.k, 0)) AS t FROM v LEFT JOIN c ON c.dimension = v.dimension AND c.value = v.value GROUP BY v.dimension),
    e AS (SELECT c.dimension, abs(-sum(c.k / q.t::DOUBLE * ln(c.k / q.t::DOUBLE))) / any_value(ln(q.values)) AS entropy, max(c.k) / any_value(q.t)::DOUBLE AS dominance FROM c JOIN q ON q.dimension = c.dimension GROUP BY c.dimension)
    SELECT q.dimension, round(coalesce(any_value(e.entropy), 0), 6) AS entropy, round(coalesce(any_value(e.dominance), 0), 6) AS dominance, count(m.doc_id) AS any_signal, count(*) FILTER (WHERE m.v > 1) AS multi_value, any_value(n.n) - count(m.doc_id) AS no_signal FROM q CROSS JOIN n LEFT JOIN e ON e.dimension = q.dimension LEFT JOIN m ON m.dimension = q.dimension GROUP BY q.dimension""",
)
def balance(spark, sf_dir):
    """Per dimension the normalised entropy of its values, the largest value's share, and documents with one, several or no
    values."""
    docs = table(spark, sf_dir, "documents")
    hits = signals(docs, FACETS).groupBy("dimension", "doc_id").agg(F.collect_set("value").alias("values"))
    by_doc = hits.groupBy("dimension").agg(F.count(F.lit(1)).alias("any_signal"), F.count_if(F.size("values") > 1).alias("multi_value"))
    n = hits.select("dimension", F.explode("values").alias("value")).groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("n"))
    sums = n.groupBy("dimension").agg(F.sum("n").alias("t"), F.max("n").alias("most"), F.sum(F.col("n") * F.log("n")).alias("s"))
    sizes = docs.sparkSession.createDataFrame([(d, len({p[1] for p in FACETS if p[0] == d})) for d in sorted({p[0] for p in FACETS})], "dimension string, k int")
    total = docs.agg(F.count(F.lit(1)).alias("all"))
    entropy = F.abs(F.log("t") - F.col("s") / F.col("t")) / F.log("k")
    whole = sizes.join(sums, "dimension", "left").join(by_doc, "dimension", "left").crossJoin(F.broadcast(total)).na.fill(0, ["any_signal", "multi_value"])
    return whole.select("dimension", F.round(F.coalesce(entropy, F.lit(0.0)), 6).alias("entropy"), F.round(F.coalesce(F.col("most") / F.col("t"), F.lit(0.0)), 6).alias("dominance"), "any_signal", "multi_value", (F.col("all") - F.col("any_signal")).alias("no_signal"))


@query("C1_pattern_counts", f"{_ALL_FACETS} SELECT dimension, value, pattern, lang, source, count(*) AS docs FROM g GROUP BY dimension, value, pattern, lang, source")
def pattern_counts(spark, sf_dir):
    """Documents by pattern, language and source."""
    return signals(table(spark, sf_dir, "documents"), FACET_PATTERNS).groupBy("dimension", "value", "pattern", "lang", "source").agg(F.count(F.lit(1)).alias("docs"))


_SAMPLED = "SELECT dimension, value, pattern, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY dimension, value, pattern ORDER BY sha256(dimension || ':' || value || chr(0) || doc_id), doc_id) AS r FROM {0}) t WHERE r <= {1}"


@query("C1_pattern_samples", f"{_ALL_FACETS}, d AS (SELECT DISTINCT dimension FROM v), y AS (SELECT DISTINCT dimension, value, pattern, doc_id FROM g), z AS (SELECT d.dimension, '(none)' AS value, '(none)' AS pattern, x.doc_id FROM d CROSS JOIN $documents x WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.dimension = d.dimension AND h.doc_id = x.doc_id)) {_SAMPLED.format('y', 3)} UNION ALL {_SAMPLED.format('z', 6)}")
def pattern_samples(spark, sf_dir):
    """Documents to look at, drawn by hash: three of each pattern of each value, and six of each dimension that have none of its values."""
    docs = table(spark, sf_dir, "documents")
    hits = signals(docs, FACET_PATTERNS).select("doc_id", "dimension", "value", "pattern").distinct()
    dimensions = sorted({p[0] for p in FACETS})
    none = docs.join(hits.groupBy("doc_id").agg(F.collect_set("dimension").alias("have")), "doc_id", "left").select("doc_id", F.explode(F.array_except(F.array(*map(F.lit, dimensions)), F.coalesce("have", F.array().cast("array<string>")))).alias("dimension"))
    drawn = lambda rows, most: first_of(rows.withColumn("drawn", F.sha2(F.concat("dimension", F.lit(":"), "value", F.lit("\0"), F.col("doc_id").cast("string")), 256)), ["dimension", "value", "pattern"], [F.asc("drawn"), F.asc("doc_id")], most, "r").select("dimension", "value", "pattern", "doc_id")
    return drawn(hits, 3).union(drawn(none.withColumns({"value": F.lit("(none)"), "pattern": F.lit("(none)")}).select("doc_id", "dimension", "value", "pattern"), 6))


@query(
    "C2_participant_scales",
    f"{_SCALES}, c AS ({_COVERED}), m AS (SELECT doc_id, count(*) FILTER (WHERE dimension = 'scale') AS v FROM h GROUP BY doc_id), s AS (SELECT count(*) FILTER (WHERE v > 0) AS some, count(*) FILTER (WHERE v > 1) AS several FROM m) SELECT c.dimension, c.value, c.hits, c.sources, c.share, c.unpatterned, c.beside, c.ending, s.some AS any_signal, s.several AS multiple_signals, n.n - s.some AS no_signal FROM c CROSS JOIN s CROSS JOIN n",
)
def scales(spark, sf_dir):
    """Coverage of the eight scales and of counts of those who take part, and documents with one, several or no scales."""
    docs = table(spark, sf_dir, "documents")
    by_doc = signals(docs, SCALE_PATTERNS).groupBy("doc_id").agg(F.count_distinct("value").alias("v")).agg(F.count(F.lit(1)).alias("any_signal"), F.count_if(F.col("v") > 1).alias("multiple_signals"))
    totals = by_doc.crossJoin(docs.agg(F.count(F.lit(1)).alias("n")))
    return covered(docs, [*SCALE_PATTERNS, *NUMERIC]).crossJoin(F.broadcast(totals)).withColumn("no_signal", F.col("n") - F.col("any_signal")).drop("n")


_RULES = "WITH section(source, category) AS (VALUES ('src1', 'a'), ('src1', 'b'), ('src4', 'c')), legacy(trait, category) AS (VALUES ('en', 'b'), ('de', 'd'))"
_MAPPED = f"{_RULES}, m AS (SELECT d.doc_id, s.category, 'section' AS basis FROM $documents d JOIN section s ON s.source = d.source UNION SELECT d.doc_id, l.category, 'legacy' FROM $documents d JOIN legacy l ON l.trait = d.lang)"
sql_query(
    "C3_taxonomy_mapping",
    f"{_MAPPED} SELECT d.doc_id, coalesce(array_join(transform(array_sort(collect_set(m.category)), x -> x), ','), '') AS categories, coalesce(array_join(array_sort(collect_set(m.basis)), ','), '') AS basis, count(m.category) = 0 AS unassigned FROM $documents d LEFT JOIN m ON m.doc_id = d.doc_id GROUP BY d.doc_id",
    f"{_MAPPED} SELECT d.doc_id, coalesce(string_agg(DISTINCT m.category, ',' ORDER BY m.category), '') AS categories, coalesce(string_agg(DISTINCT m.basis, ',' ORDER BY m.basis), '') AS basis, count(m.category) = 0 AS unassigned FROM $documents d LEFT JOIN m ON m.doc_id = d.doc_id GROUP BY d.doc_id",
)
sql_query("C4_category_evidence", f"{_MAPPED}, c(category) AS (VALUES ('a'), ('b'), ('c'), ('d'), ('z')) SELECT c.category, count(DISTINCT m.doc_id) AS docs, count(DISTINCT CASE WHEN m.basis = 'section' THEN m.doc_id END) AS by_section, count(DISTINCT l.doc_id) AS counterexamples FROM c LEFT JOIN m ON m.category = c.category LEFT JOIN $labels l ON l.doc_id = m.doc_id AND l.toxic = 1 GROUP BY c.category")
sql_query(
    "C5_recipe_diff",
    r"SELECT d.doc_id, sha2(trim(d.text), 256) <> sha2(trim(regexp_replace(d.text, '(?U)\\s+', ' ')), 256) AS changed, e.vec_id IS NOT NULL AS cached FROM $documents d LEFT JOIN $embeddings e ON e.vec_id = d.doc_id",
    r"SELECT d.doc_id, sha256(trim(d.text)) <> sha256(trim(regexp_replace(d.text, '[\s\x{A0}]+', ' ', 'g'))) AS changed, e.vec_id IS NOT NULL AS cached FROM $documents d LEFT JOIN $embeddings e ON e.vec_id = d.doc_id",
)


@query("C6_distinct_facets", "SELECT doc_id, CASE source WHEN 'src2' THEN 'two,pair' WHEN 'src1' THEN 'one,two' ELSE 'source:' || source END AS facets FROM $documents")
def facets(spark, sf_dir):
    """Aliases and compounds resolved, order kept, repeats dropped."""
    docs = table(spark, sf_dir, "documents")
    terms = F.when(F.col("source") == "src2", F.array(F.lit("two"), F.lit("pair"), F.lit("two"))).when(F.col("source") == "src1", F.array(F.lit("one"), F.lit("one"), F.lit("two"))).otherwise(F.array(F.concat(F.lit("source:"), "source")))
    return docs.select("doc_id", F.array_join(F.array_distinct(terms), ",").alias("facets"))


sql_query("C12_pilot_report", "SELECT d.source, count(*) AS docs, CAST(count(l.doc_id) AS STRING) AS labelled, coalesce(CAST(max(e.label) AS STRING), 'not-recorded') AS cluster, coalesce(CAST(max(b.item_id) AS STRING), 'not-recorded') AS item FROM $documents d LEFT JOIN $labels l ON l.doc_id = d.doc_id LEFT JOIN $embeddings e ON e.vec_id = d.doc_id AND d.source < 'src15' LEFT JOIN $benchmark b ON b.item_id = d.doc_id GROUP BY d.source")
sql_query(
    "C13_evaluation_matrix",
    "WITH m(model, price) AS (VALUES ('a', 0.1D), ('b', 0.2D)), p AS (SELECT b.item_id, m.model, m.price, length(b.text) AS size FROM $benchmark b CROSS JOIN m) SELECT model, count(*) AS pairs, count(*) FILTER (WHERE item_id % 3 = 0) AS done, count(*) FILTER (WHERE item_id % 3 <> 0) AS pending, round(sum(CASE WHEN item_id % 3 = 0 THEN size * price END), 6) AS usage FROM p GROUP BY model",
    "WITH m(model, price) AS (VALUES ('a', 0.1::DOUBLE), ('b', 0.2::DOUBLE)), p AS (SELECT b.item_id, m.model, m.price, length(b.text) AS size FROM $benchmark b CROSS JOIN m) SELECT model, count(*) AS pairs, count(*) FILTER (WHERE item_id % 3 = 0) AS done, count(*) FILTER (WHERE item_id % 3 <> 0) AS pending, round(sum(CASE WHEN item_id % 3 = 0 THEN size * price END), 6) AS usage FROM p GROUP BY model",
)
sql_query("C14_cluster_units", "WITH f AS (SELECT label AS fine, label div 4 AS top, count(*) AS n, min(vec_id) AS sample FROM $embeddings GROUP BY label) SELECT fine, top, n, sample, sum(n) OVER (PARTITION BY top) AS top_n FROM f", "WITH f AS (SELECT label AS fine, label // 4 AS top, count(*) AS n, min(vec_id) AS sample FROM $embeddings GROUP BY label) SELECT fine, top, n, sample, sum(n) OVER (PARTITION BY top)::BIGINT AS top_n FROM f")
sql_query(
    "C15_review_packet",
    "WITH pairs AS (SELECT sha2(text, 256) AS h, min(doc_id) AS l, max(doc_id) AS r FROM $documents GROUP BY sha2(text, 256) HAVING count(*) > 1) SELECT p.l, p.r, a.source AS left_source, b.source AS right_source, NOT (a.lang <=> b.lang) AS invariant_broken, row_number() OVER (PARTITION BY a.source ORDER BY p.l) AS place FROM pairs p JOIN $documents a ON a.doc_id = p.l JOIN $documents b ON b.doc_id = p.r",
    "WITH pairs AS (SELECT sha256(text) AS h, min(doc_id) AS l, max(doc_id) AS r FROM $documents GROUP BY sha256(text) HAVING count(*) > 1) SELECT p.l, p.r, a.source AS left_source, b.source AS right_source, a.lang IS DISTINCT FROM b.lang AS invariant_broken, row_number() OVER (PARTITION BY a.source ORDER BY p.l) AS place FROM pairs p JOIN $documents a ON a.doc_id = p.l JOIN $documents b ON b.doc_id = p.r",
)
sql_query("C16_boundary_status", "SELECT conv_id, turn, CASE WHEN length(text) < 40 THEN 'too-short' WHEN role <> 'user' AND lead(role) OVER (PARTITION BY conv_id ORDER BY turn) IS NULL THEN 'open-end' WHEN role <> 'user' THEN 'needs-review' ELSE 'ready' END AS status FROM $conversations")
sql_query("C18_review_scaffold", "WITH dims(dimension) AS (VALUES ('clarity'), ('safety'), ('fidelity')) SELECT b.item_id, dims.dimension, CAST(NULL AS BIGINT) AS rating, sha2(b.text, 256) AS pinned FROM $benchmark b CROSS JOIN dims", "WITH dims(dimension) AS (VALUES ('clarity'), ('safety'), ('fidelity')) SELECT b.item_id, dims.dimension, CAST(NULL AS BIGINT) AS rating, sha256(b.text) AS pinned FROM $benchmark b CROSS JOIN dims")


@query("C19_comparison_payload", "SELECT vec_id, round(embedding[1]::DOUBLE, 6) AS x, label AS a, (vec_id % 7)::BIGINT AS b FROM $embeddings")
def payload(spark, sf_dir):
    """Points with their assignment in each variant."""
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(F.col("embedding")[0].cast("double"), 6).alias("x"), F.col("label").alias("a"), (F.col("vec_id") % 7).alias("b"))
