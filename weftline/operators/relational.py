"""Filters (F), joins (J), ranking limits (K) and set operations (H) over the star schema and the text tables."""

from __future__ import annotations

from urllib.parse import parse_qs

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions import text as udfs
from weftline.operators.windows import BUCKET, numbered
from weftline.plans.registry import query, sql_query, table

# ---- filters

sql_query("F1_array_membership", "SELECT doc_id FROM (SELECT doc_id, array(lang, source) AS kinds FROM $documents) WHERE array_contains(kinds, 'src3')", "SELECT doc_id FROM (SELECT doc_id, [lang, source] AS kinds FROM $documents) t WHERE list_contains(kinds, 'src3')")


def faceted(docs: DataFrame, search: str, text: Column, facets: dict[str, Column]) -> DataFrame:
    """Rows for a URL query string: its `query` is contained in the text, and of each facet named at least one value holds."""
    wanted = parse_qs(search)
    needle = " ".join(wanted.pop("query", [""])).strip().lower()
    rows = docs.where(F.contains(F.lower(text), F.lit(needle))) if needle else docs
    for name, values in wanted.items():
        have = facets[name]
        rows = rows.where(F.arrays_overlap(have, F.array(*map(F.lit, values))))
    return rows


@query("F2_faceted_search", "SELECT doc_id, lang, source FROM $documents WHERE contains(lower(text), 'the and') AND (lang IN ('en', 'fr')) AND source IN ('src1', 'src2', 'src5')")
def faceted_search(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return faceted(docs, "query=the+and&lang=en&lang=fr&source=src1&source=src2&source=src5", F.col("text"), {"lang": F.array("lang"), "source": F.array("source")}).select("doc_id", "lang", "source")


sql_query("F3_map_search", "SELECT doc_id FROM $documents WHERE contains(lower(text), trim(' ention ')) AND array_contains(array(lang, source), 'en')", "SELECT doc_id FROM $documents WHERE contains(lower(text), trim(' ention ')) AND list_contains([lang, source], 'en')")
sql_query(
    "F4_pattern_signals",
    r"""WITH p(lang, id, regex) AS (VALUES ('en', 'team', '(?iuU)(^|[^\\p{L}\\p{N}])(the|they) +and'), ('de', 'team', '(?iuU)(^|[^\\p{L}\\p{N}])(die|der) +ein'), ('es', 'team', '(?iuU)(^|[^\\p{L}\\p{N}])que +de'))
    SELECT d.doc_id, d.lang, p.id AS pattern, p.lang IS NULL AS unpatterned, coalesce(d.text RLIKE p.regex, false) AS matched FROM $documents d LEFT JOIN p ON p.lang = d.lang""",
    r"""WITH p(lang, id, regex) AS (VALUES ('en', 'team', '(?i)(^|[^\p{L}\p{N}])(the|they) +and'), ('de', 'team', '(?i)(^|[^\p{L}\p{N}])(die|der) +ein'), ('es', 'team', '(?i)(^|[^\p{L}\p{N}])que +de'))
    SELECT d.doc_id, d.lang, p.id AS pattern, p.lang IS NULL AS unpatterned, coalesce(regexp_matches(d.text, p.regex), false) AS matched FROM $documents d LEFT JOIN p ON p.lang = d.lang""",
)
sql_query(
    "F5_interval_containment",
    "SELECT doc_id FROM $documents WHERE exists(array(named_struct('lo', 10, 'hi', 40), named_struct('lo', 700, 'hi', 710)), r -> doc_id BETWEEN r.lo AND r.hi)",
    "SELECT doc_id FROM $documents WHERE list_bool_or(list_transform([{'lo': 10, 'hi': 40}, {'lo': 700, 'hi': 710}], lambda r: doc_id BETWEEN r.lo AND r.hi))",
)
sql_query("F6_score_threshold", "SELECT l_orderkey, l_linenumber, round(l_discount, 6) AS score FROM $lineitem WHERE l_discount >= 0.05")
sql_query("F7_life_plus_70", "SELECT o_custkey, max(o_orderdate) AS last, CAST(make_date(year(max(o_orderdate)) + 71, 1, 1) AS STRING) AS free_from, make_date(year(max(o_orderdate)) + 71, 1, 1) <= DATE '2068-06-01' AS is_free FROM $orders GROUP BY o_custkey")
#: (signal, pattern) of texts whose rights need a look: this library's own pack. Signs that aren't letters stand around.
RISKS = (
    ("attribution", r"according to|taken from|told by|described by|licen[sc]ed? "),
    ("named-source", r"after (miller|baker|weaver)"),
    ("verse", r"songs?|verses?|melod(y|ies)|refrain"),
    ("figure", r"(fig|ill|pl)[.] *[0-9]+"),
)
_RISK = r"(?i)(^|[^\p{L}\p{N}])("


def risk_signals(text: Column) -> Column:
    """The signals of a text, and that of two or more quotation marks."""
    tests = [F.when(text.rlike(f"{_RISK}{p})"), name) for name, p in RISKS]
    return F.array_compact(F.array(*tests, F.when(F.regexp_count(text, F.lit('["„]')) >= 2, "quotation")))


_DUCK_RISKS = ", ".join(f"CASE WHEN regexp_matches(t, '{_RISK}{p})') THEN '{name}' END" for name, p in RISKS)


@query(
    "F8_risk_signals",
    f"""SELECT doc_id, array_to_string(list_filter([{_DUCK_RISKS}, CASE WHEN len(regexp_extract_all(t, '["„]')) >= 2 THEN 'quotation' END], lambda x: x IS NOT NULL), ',') AS signals
    FROM (SELECT doc_id, text || CASE doc_id % 6 WHEN 0 THEN ' as told by many' WHEN 1 THEN ' After Miller.' WHEN 2 THEN ' a song, see Fig. 3 ' WHEN 3 THEN ' „one word"' ELSE '' END AS t FROM $documents) d""",
)
def risks(spark, sf_dir):
    ends = F.when(F.col("k") == 0, " as told by many").when(F.col("k") == 1, " After Miller.").when(F.col("k") == 2, " a song, see Fig. 3 ").when(F.col("k") == 3, ' „one word"').otherwise("")
    docs = table(spark, sf_dir, "documents").withColumn("k", F.col("doc_id") % 6).select("doc_id", F.concat("text", ends).alias("t"))
    return docs.select("doc_id", F.array_join(risk_signals(F.col("t")), ",").alias("signals"))


_URL, _BREAK = r"https?://[^\s)]+", r"\n\s*\n"
_EXPANDED, _FEMALE = r"(?i)(^|[^\p{L}])(he or she|his or her|she or he)", r"(?i)(^|[^\p{L}])girls?([^\p{L}]|$)"


def fidelity(src: Column, dst: Column, src_traits: Column, dst_traits: Column, title: Column, target: Column) -> dict[str, Column]:
    """Predicates that a translation keeps what its source states, by name."""
    count = lambda t, p: F.regexp_count(t, F.lit(p))
    found = lambda t, p: F.array_sort(F.regexp_extract_all(t, F.lit(p), F.lit(0)))
    share = F.length(F.trim(dst)) / F.greatest(F.lit(1), F.length(F.trim(src)))
    return {
        "non_empty": (F.trim(title) != "") & (F.trim(dst) != ""),
        "traits": F.size(src_traits) == F.size(dst_traits),
        "urls": (found(src, _URL) == found(dst, _URL)) & (count(src, _URL) == count(dst, "https?://")),
        "numbers": udfs.numbers(F.regexp_replace(src, _URL, "")) == udfs.numbers(F.regexp_replace(dst, _URL, "")),
        "breaks": count(src, _BREAK) == count(dst, _BREAK),
        "no_markers": ~(dst.contains("⏎") | dst.contains("↵") | dst.contains("\\n")),
        "no_expansion": ~dst.rlike(_EXPANDED),
        "no_invented_female": (target != "en") | src.rlike(_FEMALE) | ~dst.rlike(_FEMALE),
        "ratio": share.between(0.55, 1.8),
    }


_DUCK_NUMBERS = r"""list_sort(flatten(list_transform(regexp_extract_all(regexp_replace({0}, 'https?://[^\s)]+', '', 'g'), '[⁰¹²³⁴⁵⁶⁷⁸⁹]+|\d{{1,3}}(?:[ \x{{A0}}]\d{{3}})+|\d+(?:[.,/—–-]\d+)*'), lambda x: CASE WHEN regexp_matches(x, '[—–-]') THEN list_filter(regexp_split_to_array(regexp_replace(x, '[ \x{{A0}}]', '', 'g'), '[—–-]'), lambda y: y <> '') WHEN regexp_full_match(regexp_replace(x, '[ \x{{A0}}]', '', 'g'), '\d{{1,3}}([.,]\d{{3}})+') THEN [regexp_replace(regexp_replace(x, '[ \x{{A0}}]', '', 'g'), '[.,]', '', 'g')] ELSE [replace(regexp_replace(x, '[ \x{{A0}}]', '', 'g'), ',', '.')] END)))"""


@query(
    "F9_fidelity_predicates",
    rf"""WITH v AS (SELECT conv_id, turn, role, text || CASE turn % 4 WHEN 0 THEN ' 1,5 and 3-4 ' WHEN 1 THEN ' https://a.b/c 12 345' ELSE '' END AS src,
      CASE (conv_id + turn) % 7 WHEN 0 THEN text || ' 1.5 3 and 4' WHEN 1 THEN text || ' https://a.b/c 12345' WHEN 2 THEN text || ' he or she ⏎' WHEN 3 THEN text || ' girls' WHEN 4 THEN substr(text, 1, length(text) // 3) WHEN 5 THEN text || chr(10) || ' ' || chr(10) ELSE text END AS dst FROM $conversations),
    p AS (SELECT conv_id, turn, trim(role) <> '' AND trim(dst) <> '' AS non_empty, true AS traits,
      list_sort(regexp_extract_all(src, 'https?://[^\s)]+')) = list_sort(regexp_extract_all(dst, 'https?://[^\s)]+')) AND len(regexp_extract_all(src, 'https?://[^\s)]+')) = len(regexp_extract_all(dst, 'https?://')) AS urls,
      {_DUCK_NUMBERS.format("src")} = {_DUCK_NUMBERS.format("dst")} AS numbers, len(regexp_extract_all(src, '\n\s*\n')) = len(regexp_extract_all(dst, '\n\s*\n')) AS breaks,
      NOT regexp_matches(dst, '⏎|↵|\\n') AS no_markers, NOT regexp_matches(dst, '(?i)(^|[^\p{{L}}])(he or she|his or her|she or he)') AS no_expansion,
      regexp_matches(src, '(?i)(^|[^\p{{L}}])girls?([^\p{{L}}]|$)') OR NOT regexp_matches(dst, '(?i)(^|[^\p{{L}}])girls?([^\p{{L}}]|$)') AS no_invented_female,
      length(trim(dst)) / greatest(1, length(trim(src)))::DOUBLE BETWEEN 0.55 AND 1.8 AS ratio FROM v)
    SELECT *, non_empty AND traits AND urls AND numbers AND breaks AND no_markers AND no_expansion AND no_invented_female AND ratio AS faithful FROM p""",
)
def fidelity_predicates(spark, sf_dir):
    """Each turn and what a translator of known faults makes of it."""
    made = "CASE (conv_id + turn) % 7 WHEN 0 THEN concat(text, ' 1.5 3 and 4') WHEN 1 THEN concat(text, ' https://a.b/c 12345') WHEN 2 THEN concat(text, ' he or she ⏎') WHEN 3 THEN concat(text, ' girls') WHEN 4 THEN substr(text, 1, length(text) div 3) WHEN 5 THEN concat(text, '\\n \\n') ELSE text END"
    source = "concat(text, CASE turn % 4 WHEN 0 THEN ' 1,5 and 3-4 ' WHEN 1 THEN ' https://a.b/c 12 345' ELSE '' END)"
    v = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.expr(source).alias("src"), F.expr(made).alias("dst"))
    tests = fidelity(F.col("src"), F.col("dst"), F.array("role"), F.array("role"), F.col("role"), F.lit("en"))
    p = v.select("conv_id", "turn", *[c.alias(n) for n, c in tests.items()])
    return p.withColumn("faithful", F.forall(F.array(*tests), lambda x: x))


sql_query(
    "F10_signatures",
    "SELECT doc_id, CASE WHEN startswith(b, X'FFD8') THEN 'jpeg' WHEN startswith(b, X'89504E47') THEN 'png' WHEN startswith(b, X'255044462D') THEN 'pdf' ELSE 'other' END AS kind, octet_length(b) <= 20000 AS in_cap FROM (SELECT doc_id, concat(CASE doc_id % 4 WHEN 0 THEN X'FFD8' WHEN 1 THEN X'89504E47' WHEN 2 THEN X'255044462D' ELSE X'00' END, cast(text AS BINARY)) AS b FROM $documents)",
    "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'jpeg' WHEN 1 THEN 'png' WHEN 2 THEN 'pdf' ELSE 'other' END AS kind, strlen(text) + CASE doc_id % 4 WHEN 0 THEN 2 WHEN 1 THEN 4 WHEN 2 THEN 5 ELSE 1 END <= 20000 AS in_cap FROM $documents",
)
sql_query("F11_host_allow_list", "SELECT page_id, parse_url(url, 'PROTOCOL') = 'https' AND parse_url(url, 'HOST') RLIKE '(^|[.])example[.](com|org)$' AS allowed FROM $pages", "SELECT page_id, starts_with(url, 'https:') AND regexp_matches(regexp_extract(url, '^https?://([^/?#]+)', 1), '(^|[.])example[.](com|org)$') AS allowed FROM $pages")
sql_query(
    "F12_omitted_ranges_override",
    "WITH o(lo, hi) AS (VALUES (5, 9), (100, 120), (118, 130)), v(doc_id, text) AS (VALUES (1, 'one'), (7, 'seven')) SELECT d.doc_id, sha2(coalesce(v.text, d.text), 256) AS body_hash FROM $documents d LEFT ANTI JOIN o ON d.doc_id BETWEEN o.lo AND o.hi LEFT JOIN v ON v.doc_id = d.doc_id",
    "WITH o(lo, hi) AS (VALUES (5, 9), (100, 120), (118, 130)), v(doc_id, text) AS (VALUES (1, 'one'), (7, 'seven')) SELECT d.doc_id, sha256(coalesce(v.text, d.text)) AS body_hash FROM $documents d LEFT JOIN v ON v.doc_id = d.doc_id WHERE NOT EXISTS (SELECT 1 FROM o WHERE d.doc_id BETWEEN o.lo AND o.hi)",
)
sql_query("F13_recipe_upgrade_block", "WITH audited AS (SELECT doc_id FROM $labels WHERE quality = 1) SELECT d.doc_id FROM $documents d LEFT SEMI JOIN audited a ON a.doc_id = d.doc_id WHERE (SELECT max(toxic) FROM $labels) = 1", "SELECT d.doc_id FROM $documents d WHERE d.doc_id IN (SELECT doc_id FROM $labels WHERE quality = 1) AND (SELECT max(toxic) FROM $labels) = 1")

# ---- joins

sql_query("J1_dimension_lookup", "SELECT o.o_orderkey, c.c_name, n.n_name, r.r_name FROM $orders o JOIN $customer c ON o.o_custkey = c.c_custkey JOIN $nation n ON c.c_nationkey = n.n_nationkey JOIN $region r ON n.n_regionkey = r.r_regionkey")
sql_query("J2_consistent_join", "SELECT l.l_orderkey, l.l_linenumber, o.o_orderstatus FROM $lineitem l JOIN $orders o ON l.l_orderkey = o.o_orderkey AND l.l_linestatus = o.o_orderstatus AND l.l_shipdate >= o.o_orderdate")
sql_query("J3_language_fan_out", "SELECT doc_id, lang, explode(element_at(map('en', array('de'), 'de', array('en'), 'fr', array('de', 'en'), 'es', array('en', 'fr')), lang)) AS target FROM $documents", "SELECT doc_id, lang, unnest(CASE lang WHEN 'en' THEN ['de'] WHEN 'de' THEN ['en'] WHEN 'fr' THEN ['de', 'en'] WHEN 'es' THEN ['en', 'fr'] ELSE [] END) AS target FROM $documents")
sql_query("J4_optional_enrichment", "SELECT d.doc_id, coalesce(l.quality, -1) AS quality, coalesce(l.toxic, 0) AS toxic FROM $documents d LEFT JOIN $labels l ON l.doc_id = d.doc_id")
sql_query("J5_semi_join", "SELECT d.doc_id, d.lang FROM $documents d LEFT SEMI JOIN $labels l ON l.doc_id = d.doc_id", "SELECT d.doc_id, d.lang FROM $documents d WHERE d.doc_id IN (SELECT doc_id FROM $labels)")
sql_query(
    "J6_anti_join_both_ways",
    "SELECT 'unlabelled' AS side, d.doc_id FROM $documents d LEFT ANTI JOIN $labels l ON l.doc_id = d.doc_id UNION ALL SELECT 'unknown', l.doc_id FROM $labels l LEFT ANTI JOIN $documents d ON l.doc_id = d.doc_id",
    "SELECT 'unlabelled' AS side, d.doc_id FROM $documents d WHERE NOT EXISTS (SELECT 1 FROM $labels l WHERE l.doc_id = d.doc_id) UNION ALL SELECT 'unknown', l.doc_id FROM $labels l WHERE NOT EXISTS (SELECT 1 FROM $documents d WHERE l.doc_id = d.doc_id)",
)
sql_query(
    "J7_locator_range_join",
    """WITH blocks AS (SELECT conv_id, turn AS page_start, turn + 1 AS page_end, regexp_replace(lower(text), '[^a-z]+', ' ') AS key FROM $conversations),
    locators AS (SELECT conv_id, turn AS page, substring_index(regexp_replace(lower(text), '[^a-z]+', ' '), ' ', 6) AS expected FROM $conversations)
    SELECT l.conv_id, l.page, count(b.key) AS hits, count(b.key) = 1 AS located FROM locators l LEFT JOIN blocks b ON b.conv_id = l.conv_id AND l.page BETWEEN b.page_start AND b.page_end AND (b.key = l.expected OR startswith(b.key, l.expected)) GROUP BY l.conv_id, l.page""",
    r"""WITH blocks AS (SELECT conv_id, turn AS page_start, turn + 1 AS page_end, regexp_replace(lower(text), '[^a-z]+', ' ', 'g') AS key FROM $conversations),
    locators AS (SELECT conv_id, turn AS page, array_to_string((string_split(regexp_replace(lower(text), '[^a-z]+', ' ', 'g'), ' '))[1:6], ' ') AS expected FROM $conversations)
    SELECT l.conv_id, l.page, count(b.key) AS hits, count(b.key) = 1 AS located FROM locators l LEFT JOIN blocks b ON b.conv_id = l.conv_id AND l.page BETWEEN b.page_start AND b.page_end AND (b.key = l.expected OR starts_with(b.key, l.expected)) GROUP BY l.conv_id, l.page""",
)
sql_query(
    "J8_next_reliable_anchor",
    """SELECT conv_id, turn, coalesce(min(CASE WHEN role = 'user' THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), max(turn) OVER (PARTITION BY conv_id) + 1) AS block_end,
    count(CASE WHEN role <> 'user' THEN 1 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS unreliable_after FROM $conversations""",
)
sql_query(
    "J9_band_join_best",
    """WITH e AS (SELECT conv_id, turn AS expected, length(text) AS size FROM $conversations), near AS (SELECT conv_id, expected, size, explode(sequence(expected - 1, expected + 1)) AS page FROM e)
    SELECT conv_id, expected, page FROM (SELECT n.conv_id, n.expected, c.turn AS page, row_number() OVER (PARTITION BY n.conv_id, n.expected ORDER BY abs(length(c.text) - n.size + 25), c.turn) AS r FROM near n JOIN $conversations c ON c.conv_id = n.conv_id AND c.turn = n.page) WHERE r = 1""",
    """WITH e AS (SELECT conv_id, turn AS expected, length(text) AS size FROM $conversations)
    SELECT conv_id, expected, page FROM (SELECT n.conv_id, n.expected, c.turn AS page, row_number() OVER (PARTITION BY n.conv_id, n.expected ORDER BY abs(length(c.text) - n.size + 25), c.turn) AS r FROM e n JOIN $conversations c ON c.conv_id = n.conv_id AND abs(c.turn - n.expected) <= 1) t WHERE r = 1""",
)


def located(items: list[tuple], lines: list[tuple], least: float = 0.52) -> list[tuple]:
    """(number, position, score) of items (number, page, title) in order among lines (page, position, text): of the lines
    of its page after the last match the most similar one, the first of equals; below `least` an item isn't found and the
    search goes on from where it was."""
    keys: dict[int, list[tuple[int, str]]] = {}
    for page, position, text in sorted(lines):
        keys.setdefault(page, []).append((position, udfs.compact_key(udfs.heading(text))))
    last, found = -1, []
    for number, page, title in sorted(items):
        key = udfs.compact_key(title)
        scored = [(udfs.key_ratio(key, other), -position) for position, other in keys.get(page, []) if position > last]
        score, position = max(scored, default=(0.0, 0))
        if scored and score >= least:
            last = -position
            found.append((number, last, round(score, 6)))
    return found


def locate(items: DataFrame, lines: DataFrame, by: str, least: float = 0.52) -> DataFrame:
    """(by, number, position, score) for each group of items (by, number, page, title) and lines (by, page, position, text).
    A match depends on the one before, so each group is one pass."""

    def run(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        found = located(list(a[["number", "page", "title"]].itertuples(index=False, name=None)), list(b[["page", "position", "text"]].itertuples(index=False, name=None)), least)
        return pd.DataFrame({by: key[0], "number": [f[0] for f in found], "position": [f[1] for f in found], "score": [f[2] for f in found]})

    return items.groupBy(by).cogroup(lines.groupBy(by)).applyInPandas(run, f"{by} {dict(items.dtypes)[by]}, number long, position long, score double")


def sentences(turns: DataFrame) -> DataFrame:
    """(conv_id, page, position, text): the sentences of a conversation's turns, numbered through it."""
    each = turns.select("conv_id", F.col("turn").alias("page"), F.posexplode(F.split("text", r"(?<=[.!?])\s+")).alias("pos", "text")).where("trim(text) <> ''")
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("page", "pos")) - 1
    return each.select("conv_id", F.col("page").cast("long").alias("page"), place.cast("long").alias("position"), "text")


@query("J10_monotone_match")
def monotone_match(spark, sf_dir):
    """Per conversation, each turn's first words as a heading, found among the sentences of its turn after the last match."""
    turns = table(spark, sf_dir, "conversations")
    lines = sentences(turns)
    first = F.col("turn").cast("long")
    items = turns.select("conv_id", first.alias("number"), first.alias("page"), F.lower(F.regexp_extract("text", r"^\s*((?:\S+\s+){0,5}\S+)", 1)).alias("title"))
    return locate(items, lines, "conv_id")


#: Rows of a group that are the right side of one cell, and rows for each partition of cells, of which there are so many at most.
HELD, PER_CELL, CELLS = 2048, 1000, 1024


@query(
    "J11_self_theta_join",
    "SELECT a.p_partkey AS left_id, b.p_partkey AS right_id, round(abs(a.p_retailprice - b.p_retailprice), 6) AS gap FROM $part a JOIN $part b ON a.p_type = b.p_type AND a.p_size = b.p_size AND a.p_partkey < b.p_partkey AND a.p_brand <> b.p_brand",
)
def self_theta_join(spark, sf_dir):
    """Each two parts of one type and size and of different brands. Pairs grow with the square of a group, so its right sides
    are dealt to cells of a bounded size, and cells to as many partitions as there is work for, not for their few bytes."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size", "p_brand", "p_retailprice")
    groups = part.groupBy("p_type", "p_size").agg(F.count(F.lit(1)).alias("n"))
    sized = part.join(groups.where("n > 1").select("p_type", "p_size", F.ceil(F.col("n") / HELD).cast("int").alias("cells")), ["p_type", "p_size"])
    by = ["p_type", "p_size", "cell"]
    # A number of partitions that is given isn't joined by AQE.
    width = max(1, min(CELLS, -(-part.count() // PER_CELL)))
    a = sized.select("p_type", "p_size", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell"), F.col("p_partkey").alias("left_id"), F.col("p_brand").alias("left_brand"), F.col("p_retailprice").alias("left_price"))
    b = sized.select("p_type", "p_size", F.pmod(F.xxhash64("p_partkey"), "cells").cast("int").alias("cell"), F.col("p_partkey").alias("right_id"), F.col("p_brand").alias("right_brand"), F.col("p_retailprice").alias("right_price"))
    met = a.repartition(width, *by).join(b.repartition(width, *by).hint("merge"), by).where("left_id < right_id AND left_brand <> right_brand")
    return met.select("left_id", "right_id", F.round(F.abs(F.col("left_price") - F.col("right_price")), 6).alias("gap"))


sql_query("J14_bidirectional_links", "WITH e AS (SELECT a.doc_id AS l, b.doc_id AS r FROM $documents a JOIN $documents b ON sha2(a.text, 256) = sha2(b.text, 256) AND a.doc_id < b.doc_id), d AS (SELECT l AS id, r AS other FROM e UNION ALL SELECT r, l FROM e) SELECT d.id, d.other, x.source FROM d JOIN $documents x ON x.doc_id = d.other", "WITH e AS (SELECT a.doc_id AS l, b.doc_id AS r FROM $documents a JOIN $documents b ON sha256(a.text) = sha256(b.text) AND a.doc_id < b.doc_id), d AS (SELECT l AS id, r AS other FROM e UNION ALL SELECT r, l FROM e) SELECT d.id, d.other, x.source FROM d JOIN $documents x ON x.doc_id = d.other")
sql_query("J15_key_sets_equal", "SELECT coalesce(o.k, l.k) AS k, o.k IS NULL AS only_right, l.k IS NULL AS only_left FROM (SELECT o_orderkey AS k FROM $orders) o FULL OUTER JOIN (SELECT DISTINCT l_orderkey AS k FROM $lineitem) l ON o.k = l.k WHERE o.k IS NULL OR l.k IS NULL")
sql_query("J16_positional_zip", "SELECT doc_id, z.a AS word, z.b AS size FROM (SELECT doc_id, explode(arrays_zip(a, b)) AS z FROM (SELECT doc_id, split(source, 'c') AS a, transform(split(source, 'c'), x -> length(x)) AS b FROM $documents) WHERE size(a) = size(b))", "SELECT doc_id, unnest(string_split(source, 'c')) AS word, unnest(list_transform(string_split(source, 'c'), lambda x: length(x))) AS size FROM $documents")
sql_query("J17_index_reassociation", "SELECT i.conv_id, i.turn, r.text_hash FROM (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM $conversations) i JOIN (SELECT conv_id, turn + 1 AS k, sha2(text, 256) AS text_hash FROM $conversations) r ON r.conv_id = i.conv_id AND r.k = i.k", "SELECT i.conv_id, i.turn, r.text_hash FROM (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM $conversations) i JOIN (SELECT conv_id, turn + 1 AS k, sha256(text) AS text_hash FROM $conversations) r ON r.conv_id = i.conv_id AND r.k = i.k")
sql_query("J18_three_way_join", "SELECT d.doc_id, d.lang, e.label AS cluster, l.quality FROM $documents d JOIN $embeddings e ON e.vec_id = d.doc_id JOIN $labels l ON l.doc_id = d.doc_id")
sql_query("J19_stable_attributes", "SELECT a.conv_id, a.turn, NOT (a.role <=> b.role) AS changed FROM $conversations a JOIN $conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 2 WHERE NOT (length(a.text) <=> length(b.text))", "SELECT a.conv_id, a.turn, a.role IS DISTINCT FROM b.role AS changed FROM $conversations a JOIN $conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 2 WHERE length(a.text) IS DISTINCT FROM length(b.text)")
sql_query("J20_bucket_codes", "WITH b(upper, label) AS (VALUES (10, 'small'), (25, 'middle'), (40, 'large'), (1000, 'huge')) SELECT p.p_partkey, min_by(b.label, b.upper) AS bucket FROM $part p JOIN b ON p.p_size <= b.upper GROUP BY p.p_partkey", "WITH b(upper, label) AS (VALUES (10, 'small'), (25, 'middle'), (40, 'large'), (1000, 'huge')) SELECT p.p_partkey, arg_min(b.label, b.upper) AS bucket FROM $part p JOIN b ON p.p_size <= b.upper GROUP BY p.p_partkey")
sql_query(
    "J21_trait_aliases",
    """WITH alias(term, facet) AS (VALUES ('src1', 'one'), ('src2', 'two'), ('src11', 'one')), compound(term, facets) AS (VALUES ('src3', 'one,two'), ('src2', 'pair,duo'))
    SELECT d.doc_id, explode(coalesce(split(c.facets, ','), CASE WHEN a.facet IS NOT NULL THEN array(a.facet) END, array(concat('source:', d.lang, ':', d.source)))) AS facet FROM $documents d LEFT JOIN alias a ON a.term = d.source LEFT JOIN compound c ON c.term = d.source""",
    """WITH alias(term, facet) AS (VALUES ('src1', 'one'), ('src2', 'two'), ('src11', 'one')), compound(term, facets) AS (VALUES ('src3', 'one,two'), ('src2', 'pair,duo'))
    SELECT d.doc_id, unnest(coalesce(string_split(c.facets, ','), CASE WHEN a.facet IS NOT NULL THEN [a.facet] END, ['source:' || d.lang || ':' || d.source])) AS facet FROM $documents d LEFT JOIN alias a ON a.term = d.source LEFT JOIN compound c ON c.term = d.source""",
)
sql_query("J22_first_stop_heading", "SELECT a.conv_id, a.turn, min(b.turn) AS stop FROM $conversations a LEFT JOIN $conversations b ON b.conv_id = a.conv_id AND b.turn > a.turn AND b.turn < a.turn + 4 AND b.text RLIKE '^[A-Z][a-z]+\\\\.' GROUP BY a.conv_id, a.turn", "SELECT a.conv_id, a.turn, min(b.turn) AS stop FROM $conversations a LEFT JOIN $conversations b ON b.conv_id = a.conv_id AND b.turn > a.turn AND b.turn < a.turn + 4 AND regexp_matches(b.text, '^[A-Z][a-z]+\\.') GROUP BY a.conv_id, a.turn")
sql_query("J23_pending_pairs", "WITH m(model) AS (VALUES ('a'), ('b'), ('c')), p AS (SELECT item_id, model FROM $benchmark CROSS JOIN m), done AS (SELECT item_id, CASE item_id % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS model FROM $benchmark) SELECT p.item_id, p.model FROM p LEFT ANTI JOIN done ON done.item_id = p.item_id AND done.model = p.model", "WITH m(model) AS (VALUES ('a'), ('b'), ('c')) SELECT b.item_id, m.model FROM $benchmark b, m WHERE m.model <> CASE b.item_id % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END")
sql_query(
    "J24_interval_overlap_banner",
    "WITH want(lo, hi) AS (VALUES (1, 2), (4, 6)), hit AS (SELECT c.conv_id, c.turn, w.lo FROM $conversations c JOIN want w ON c.turn + 1 >= w.lo AND c.turn <= w.hi) SELECT conv_id, turn, lo, coalesce(turn div 2 <> lag(turn div 2) OVER (PARTITION BY conv_id, lo ORDER BY turn), true) AS banner FROM hit",
    "WITH want(lo, hi) AS (VALUES (1, 2), (4, 6)), hit AS (SELECT c.conv_id, c.turn, w.lo FROM $conversations c JOIN want w ON c.turn + 1 >= w.lo AND c.turn <= w.hi) SELECT conv_id, turn, lo, coalesce(turn // 2 <> lag(turn // 2) OVER (PARTITION BY conv_id, lo ORDER BY turn), true) AS banner FROM hit",
)


#: Entries and lines that are compared together; signs of a line beyond which its length alone bounds its similarity.
ENTRIES, LINES, LONGEST = 256, 4096, 4096
#: Lines of a block, those of the highest bounds, that show how similar the best are at least.
TRIED = 16


class Keys:
    """Keys as numbers of their signs, place after place: at each place those that reach it, the longest first."""

    def __init__(self, keys: list[str]):
        self.size = np.array([len(k) for k in keys], np.int64)
        self.order = np.argsort(-self.size, kind="stable")
        self.order = self.order[self.size[self.order] <= LONGEST]
        size = self.size[self.order]
        joined = "".join(keys[k] for k in self.order.tolist()).encode("utf-32-le", "surrogatepass")
        self.signs, number = np.unique(np.frombuffer(joined, np.uint32), return_inverse=True)
        place = np.arange(len(number)) - np.repeat(np.cumsum(size) - size, size)
        by_place, live = number[np.argsort(place, kind="stable")].astype(np.int32), np.bincount(place)
        self.codes = np.split(by_place, np.cumsum(live)[:-1]) if len(live) else []

    def common(self, key: str, longest: int = LONGEST) -> np.ndarray:
        """The length of the longest common subsequence of key and each of the keys, or more for those over longest: bits of
        words hold a row of its table, for all keys at once."""
        words = -(-len(key) // 64)
        stands = np.zeros((words, len(self.signs)), np.uint64)
        number = {int(c): k for k, c in enumerate(self.signs)}
        for i, c in enumerate(key):
            if ord(c) in number:
                stands[i >> 6, number[ord(c)]] |= np.uint64(1 << (i & 63))
        v = np.full((words, len(self.order)), ~np.uint64(0))
        for codes in self.codes[:longest]:
            n = len(codes)
            carry = np.zeros(n, bool)
            for w in range(words):
                old = v[w, :n]
                met = old & stands[w, codes]
                added = old + met
                over = added < met
                added += carry
                carry = over | carry & (added == 0)
                v[w, :n] = added | old ^ met
        found = np.zeros(len(self.size), np.int64)
        for w in range(words):
            found[self.order] += np.bitwise_count(~v[w] & np.uint64((1 << min(64, len(key) - 64 * w)) - 1))
        found[self.size > min(longest, LONGEST)] = len(key)
        return found


def best_of(lines: pd.DataFrame, entries: pd.DataFrame, place: list[str], most: int | None = None) -> pd.DataFrame:
    """(entry_id, title, score, place): the best of lines (key, place) for each of entries (entry_id, title, floor), if it may reach
    the floor; with most, of so many lines of the highest bounds."""
    keys, at = lines["key"].tolist(), list(zip(*(lines[p].tolist() for p in place), strict=True))
    made, out = Keys(keys), []
    for entry, title, floor in entries[["entry_id", "title", "floor"]].itertuples(index=False, name=None) if len(lines) else ():
        key = udfs.compact_key(title or "")
        # Longer lines are below the floor by their length alone; where there is none yet, a few similar in length are tried.
        longest = int(len(key) * (2 / floor - 1)) + 1 if floor > 0 else 2 * len(key) if most else LONGEST
        bound = 2 * made.common(key, longest) / np.maximum(made.size + len(key), 1)
        if most:
            bound[made.size > longest] = 0
        top = (-1.0, None)
        for k in np.argsort(-bound, kind="stable")[:most].tolist():
            if bound[k] < max(top[0], floor) - 1e-12:
                break
            score = udfs.key_ratio(key, keys[k], max(top[0], floor))
            if score >= 0 and (top[1] is None or score > top[0] or score == top[0] and at[k] < top[1]):
                top = (score, at[k])
        if top[1] is not None:
            out.append((entry, title, top[0], *top[1]))
    return pd.DataFrame(out, columns=["entry_id", "title", "score", *place])


def best_lines(entries: DataFrame, lines: DataFrame, place: list[str]) -> DataFrame:
    """(entry_id, score, place): the line most like each entry (entry_id, title) of all lines (place, line); the first line
    of equals, in the order of place. All entries are compared with all lines, in blocks; matching blocks of two keys are a
    common subsequence of theirs, so the longest one bounds their similarity, and lines whose bound is below the best so far
    aren't compared."""
    n, chunks = max(1, -(-entries.count() // ENTRIES)), max(1, -(-lines.count() // LINES))
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    own = lines.select(*place, udfs.compact(F.regexp_replace(udfs.heading_sql("line"), r"^\d{1,3}\s*[.)]\s*", "")).alias("key"))
    own = own.withColumn("chunk", F.pmod(F.xxhash64(*place), F.lit(chunks)).cast("int")).withColumn("b", every(n))
    asked = entries.select("entry_id", "title", F.pmod(F.xxhash64("entry_id", "title"), F.lit(n)).cast("int").alias("b"), every(chunks).alias("chunk"))
    kinds = ", ".join(f"{p} long" for p in place)

    # As many partitions as there are comparisons of blocks, up to a bound, which AQE then doesn't join: there is much to do
    # for few bytes.
    width = min(n * chunks, 4096)
    own = own.repartition(width, "chunk", "b").groupBy("chunk", "b")

    def compared(entries: DataFrame, most: int | None) -> DataFrame:
        met = own.cogroup(entries.repartition(width, "chunk", "b").groupBy("chunk", "b"))
        return met.applyInPandas(lambda g, e: best_of(g, e, place, most), f"entry_id {dict(asked.dtypes)['entry_id']}, title string, score double, {kinds}")

    # The best few of each block tell how similar the best of all are at least.
    floors = compared(asked.withColumn("floor", F.lit(-1.0)), TRIED).groupBy("entry_id", "title").agg(F.max("score").alias("floor"))
    floors = floors.select(F.col("entry_id").alias("e"), F.col("title").alias("t"), "floor")
    known = asked.join(floors, F.col("entry_id").eqNullSafe(F.col("e")) & F.col("title").eqNullSafe(F.col("t"))).drop("e", "t")
    top = compared(known, None).groupBy("entry_id").agg(F.max(F.struct("score", *[(-F.col(p)).alias(p) for p in place])).alias("t"))
    return top.select("entry_id", F.col("t.score").alias("score"), *[(-F.col(f"t.{p}")).alias(p) for p in place])


@query("J25_best_fuzzy_match")
def best_fuzzy(spark, sf_dir):
    """Each benchmark item's title (its first sentence) and the line of all conversations that is most like it; a pinned
    place takes precedence."""
    entries = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("long").alias("entry_id"), F.substring_index("text", ".", 1).alias("title"))
    turns = table(spark, sf_dir, "conversations")
    lines = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.posexplode(F.split("text", "\n")).alias("line_no", "line")).where("trim(line) <> ''").withColumn("line_no", F.col("line_no").cast("long"))
    pinned = spark.createDataFrame([(0, 0, 0, 0)], "entry_id long, p_conv long, p_turn long, p_line long")
    found = best_lines(entries, lines, ["conv_id", "turn", "line_no"]).join(F.broadcast(pinned), "entry_id", "left")
    return found.select("entry_id", F.coalesce("p_conv", "conv_id").alias("conv_id"), F.coalesce("p_turn", "turn").alias("turn"), F.coalesce("p_line", "line_no").alias("line_no"), F.when(F.col("p_conv").isNull(), F.round("score", 6)).alias("score"), F.when(F.col("p_conv").isNotNull(), "pinned").otherwise("best").alias("method"))


# ---- limits and orders

sql_query("K1_top_pairs", "SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 8) AS score FROM $lineitem ORDER BY score DESC, l_orderkey, l_linenumber LIMIT 50")
sql_query("K2_hash_sample", "SELECT lang, doc_id FROM (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY sha2(concat('salt', chr(0), doc_id), 256), doc_id) AS r FROM (SELECT DISTINCT lang, doc_id FROM $documents)) WHERE r <= 5", "SELECT lang, doc_id FROM (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY sha256('salt' || chr(0) || doc_id), doc_id) AS r FROM (SELECT DISTINCT lang, doc_id FROM $documents) x) t WHERE r <= 5")
@query("K3_declared_order", "SELECT doc_id, row_number() OVER (PARTITION BY source ORDER BY list_position(['fr', 'en', 'es', 'de'], lang), doc_id) AS place FROM $documents")
def declared_order(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.array_position(F.array(*map(F.lit, ("fr", "en", "es", "de"))), F.col("lang")).alias("p"))
    return numbered(docs, "source", [F.col("p"), F.floor(F.col("doc_id") / BUCKET)], [F.asc("p"), F.asc("doc_id")], "place").select("doc_id", "place")


sql_query("K4_next_pending", "SELECT d.source, min(d.doc_id) AS next FROM $documents d LEFT ANTI JOIN $labels l ON l.doc_id = d.doc_id GROUP BY d.source", "SELECT d.source, min(d.doc_id) AS next FROM $documents d WHERE d.doc_id NOT IN (SELECT doc_id FROM $labels) GROUP BY d.source")
sql_query("K5_arg_max_composite", "SELECT l_orderkey, max_by(l_linenumber, struct(l_extendedprice, -l_linenumber)) AS best FROM $lineitem GROUP BY l_orderkey", "SELECT l_orderkey, l_linenumber AS best FROM (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS r FROM $lineitem) t WHERE r = 1")
sql_query("K6_caseless_sort", "SELECT p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY lower(p_name), p_size, p_partkey) AS place FROM $part")
sql_query("K7_one_source_batch", "SELECT doc_id FROM $documents WHERE source = (SELECT min(source) FROM $documents) ORDER BY doc_id LIMIT 20")

# ---- sets

sql_query("H1_tagged_union", "SELECT 'c' AS tag, c_custkey AS id, c_name AS name FROM $customer UNION ALL SELECT 's', s_suppkey, s_name FROM $supplier")
sql_query("H2_set_differences", "SELECT 'minus' AS op, doc_id FROM (SELECT doc_id FROM $documents EXCEPT SELECT doc_id FROM $labels) UNION ALL SELECT 'both', doc_id FROM (SELECT doc_id FROM $documents INTERSECT SELECT doc_id FROM $labels)", "SELECT 'minus' AS op, doc_id FROM (SELECT doc_id FROM $documents EXCEPT SELECT doc_id FROM $labels) a UNION ALL SELECT 'both', doc_id FROM (SELECT doc_id FROM $documents INTERSECT SELECT doc_id FROM $labels) b")
sql_query("H3_currency", "SELECT d.doc_id, coalesce(e.vec_id IS NOT NULL AND size(e.embedding) = 64 AND forall(e.embedding, x -> x IS NOT NULL) AND e.label = d.doc_id % 10, false) AS current FROM $documents d LEFT JOIN $embeddings e ON e.vec_id = d.doc_id", "SELECT d.doc_id, coalesce(e.vec_id IS NOT NULL AND len(e.embedding) = 64 AND list_bool_and(list_transform(e.embedding, lambda x: x IS NOT NULL)) AND e.label = d.doc_id % 10, false) AS current FROM $documents d LEFT JOIN $embeddings e ON e.vec_id = d.doc_id")
sql_query("H4_uniqueness", "SELECT c.user_id, c.event_type, count(*) AS n FROM $events c GROUP BY c.user_id, c.event_type HAVING count(*) > 1")
sql_query("H5_multiset_difference", "SELECT event_type, count(*) AS n FROM (SELECT event_type, user_id FROM $events EXCEPT ALL SELECT event_type, user_id FROM $events WHERE value < 50) GROUP BY event_type", "SELECT event_type, count(*) AS n FROM (SELECT event_type, user_id FROM $events EXCEPT ALL SELECT event_type, user_id FROM $events WHERE value < 50) t GROUP BY event_type")
sql_query("H6_subset_test", "SELECT conv_id, size(array_except(collect_set(role), array('user', 'assistant'))) = 0 AS known_roles FROM $conversations GROUP BY conv_id", "SELECT conv_id, bool_and(role IN ('user', 'assistant')) AS known_roles FROM $conversations GROUP BY conv_id")
