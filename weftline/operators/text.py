"""Projections and string functions (T), each as a Spark SQL expression with its DuckDB twin over documents.

Where an expression needs Unicode classes, Spark's has the (?U) flag and DuckDB's names the classes. Functions that SQL
can't express (normal forms, sequence matching, marker protection) are in weftline.functions.text.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions import text as udfs
from weftline.operators.windows import BUCKET, numbered
from weftline.plans.registry import query, sql_query, table

#: Case-folded columns, in both dialects.
FOLDED, FOLDED_DUCK = udfs.folded_sql("text"), udfs.folded_sql("text", "duckdb")
FOLDED_C_DUCK = udfs.folded_sql("c", "duckdb")

#: name: (columns in Spark SQL, the same in DuckDB or None)
_SCALARS: dict[str, tuple[str, str | None]] = {
    "T1_strip_footer": (
        r"regexp_replace(substring_index(concat(text, '\n\n---\n[source](x)'), '\n\n---\n', 1), '(?U)^\\s+|\\s+$', '') AS body",
        r"regexp_replace(split_part(text || chr(10) || chr(10) || '---' || chr(10) || '[source](x)', chr(10) || chr(10) || '---' || chr(10), 1), '^[\s\x{A0}]+|[\s\x{A0}]+$', '', 'g') AS body",
    ),
    "T2_ascii_tokens": (
        rf"array_join(regexp_extract_all({FOLDED}, '[a-z0-9]+(?:\'[a-z]+)?', 0), ' ') AS tokens",
        rf"array_to_string(regexp_extract_all({FOLDED_DUCK}, '[a-z0-9]+(?:''[a-z]+)?'), ' ') AS tokens",
    ),
    "T4_locator_key": (
        rf"array_join(regexp_extract_all({FOLDED}, '(?U)\\w+', 0), ' ') AS locator",
        rf"array_to_string(regexp_extract_all({FOLDED_DUCK}, '[\p{{L}}\p{{M}}\p{{N}}_]+'), ' ') AS locator",
    ),
    "T6_collapse_space": (
        r"trim(regexp_replace(text, '(?U)\\s+', ' ')) AS collapsed",
        r"trim(regexp_replace(text, '[\s\x{A0}]+', ' ', 'g')) AS collapsed",
    ),
    "T7_context_recipe": (
        r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(concat('![pic](http://a.b/c.png) [label](http://a.b) ', text, ' http://x.y/z end'), '!\\[([^\\]]*)\\]\\([^)]*\\)', '$1'), '\\[([^\\]]*)\\]\\([^)]*\\)', '$1'), 'https?://[^ \n]+', ''), '(?U)\\s+', ' ')) AS context",
        r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace('![pic](http://a.b/c.png) [label](http://a.b) ' || text || ' http://x.y/z end', '!\[([^\]]*)\]\([^)]*\)', '\1', 'g'), '\[([^\]]*)\]\([^)]*\)', '\1', 'g'), 'https?://[^ \n]+', '', 'g'), '[\s\x{A0}]+', ' ', 'g')) AS context",
    ),
    "T9_summary": (
        r"CASE WHEN length(c) <= 260 THEN c ELSE concat(regexp_replace(substring(c, 1, 260), ' [^ ]*$', ''), '…') END AS summary",
        r"CASE WHEN length(c) <= 260 THEN c ELSE regexp_replace(substring(c, 1, 260), ' [^ ]*$', '') || '…' END AS summary",
    ),
    "T10_compact_summary": (
        r"CASE WHEN length(c) <= 90 THEN c ELSE concat(rtrim(' ,;:-', regexp_replace(substring(c, 1, 91), ' [^ ]*$', '')), '…') END AS compact",
        r"CASE WHEN length(c) <= 90 THEN c ELSE rtrim(regexp_replace(substring(c, 1, 91), ' [^ ]*$', ''), ' ,;:-') || '…' END AS compact",
    ),
    "T11_hard_truncation": (
        "rtrim(substring(c, 1, 360)) AS cut, CASE WHEN length(c) <= 40 THEN c ELSE concat(rtrim(substring(c, 1, 39)), '…') END AS label",
        None,
    ),
    "T14_strip_markup": (
        r"trim(regexp_replace(regexp_replace(concat('## **', c, '** |'), '^#+ *|\\*\\*', ''), '\\|', '')) AS plain",
        r"trim(regexp_replace(regexp_replace('## **' || c || '** |', '^#+ *|\*\*', '', 'g'), '\|', '', 'g')) AS plain",
    ),
    "T16_pages_label": (
        "CASE WHEN size(p) = 0 THEN '—' WHEN size(p) = 1 THEN cast(p[0] AS STRING) WHEN p[size(p) - 1] - p[0] = size(p) - 1 THEN concat(p[0], '–', p[size(p) - 1]) ELSE array_join(transform(p, x -> cast(x AS STRING)), ', ') END AS pages",
        "CASE WHEN len(p) = 0 THEN '—' WHEN len(p) = 1 THEN p[1]::VARCHAR WHEN p[len(p)] - p[1] = len(p) - 1 THEN p[1] || '–' || p[len(p)] ELSE array_to_string(list_transform(p, lambda x: x::VARCHAR), ', ') END AS pages",
    ),
    "T17_search_text": ("lower(concat_ws(' ', source, lang, c)) AS search_text", None),
    "T19_token_estimate": ("greatest(1, cast(ceil(octet_length(text) / 3D) AS BIGINT)) AS tokens", "greatest(1, ceil(strlen(text) / 3.0)::BIGINT) AS tokens"),
    "T20_output_budget": (
        "least(8192, greatest(512, cast(ceil(octet_length(text) / 2D) AS BIGINT) + 256)) AS budget, cast(ceil(octet_length(text) / 4D) AS BIGINT) AS discovery",
        "least(8192, greatest(512, ceil(strlen(text) / 2.0)::BIGINT + 256)) AS budget, ceil(strlen(text) / 4.0)::BIGINT AS discovery",
    ),
    "T21_elapsed_seconds": (
        "cast(split(e, ':')[0] AS BIGINT) * 3600 + cast(split(e, ':')[1] AS BIGINT) * 60 + cast(split(e, ':')[2] AS BIGINT) AS seconds",
        "split_part(e, ':', 1)::BIGINT * 3600 + split_part(e, ':', 2)::BIGINT * 60 + split_part(e, ':', 3)::BIGINT AS seconds",
    ),
    "T22_content_hash": (
        r"sha2(concat(trim(source), '\n', regexp_replace(text, '(?U)^\\s+|\\s+$', ''), '\n'), 256) AS content_hash, sha2(to_json(named_struct('id', doc_id, 'lang', lang)), 256) AS object_hash, sha2(concat_ws(chr(0), source, lang, sha2(text, 256)), 256) AS tree_hash",
        r"sha256(trim(source) || chr(10) || regexp_replace(text, '^[\s\x{A0}]+|[\s\x{A0}]+$', '', 'g') || chr(10)) AS content_hash, sha256(to_json({'id': doc_id, 'lang': lang})::VARCHAR) AS object_hash, sha256(source || chr(0) || lang || chr(0) || sha256(text)) AS tree_hash",
    ),
    "T23_alphabetic_index": (
        "CASE WHEN doc_id < 26 THEN chr(65 + doc_id) WHEN doc_id < 702 THEN concat(chr(64 + doc_id div 26), chr(65 + doc_id % 26)) ELSE concat(decode(unhex(lpad(hex(64 + (doc_id - 26) div 676), 8, '0')), 'UTF-32'), chr(65 + ((doc_id - 26) div 26) % 26), chr(65 + doc_id % 26)) END AS letters",
        "CASE WHEN doc_id < 26 THEN chr((65 + doc_id)::INT) WHEN doc_id < 702 THEN chr((64 + doc_id // 26)::INT) || chr((65 + doc_id % 26)::INT) ELSE chr((64 + (doc_id - 26) // 676)::INT) || chr((65 + ((doc_id - 26) // 26) % 26)::INT) || chr((65 + doc_id % 26)::INT) END AS letters",
    ),
    "T25_numeric_multiset": (
        r"array_join(array_sort(transform(regexp_extract_all(regexp_replace(text, '(\\d)[  ,](\\d{3})\\b', '$1$2'), '\\d+(?:[.,]\\d+)?', 0), x -> replace(x, ',', '.'))), ' ') AS numbers",
        r"array_to_string(list_sort(list_transform(regexp_extract_all(regexp_replace(text, '(\d)[  ,](\d{3})\b', '\1\2', 'g'), '\d+(?:[.,]\d+)?'), lambda x: replace(x, ',', '.'))), ' ') AS numbers",
    ),
    "T27_ocr_cleanup": (
        r"regexp_replace(regexp_replace(regexp_replace(concat('12\n', text, '\nfoo-\nbar  , baz\n99'), '(?m)^\\d{1,4}$\n?', ''), '(\\p{Ll})-\n(\\p{Ll})', '$1$2'), ' +([,.;:!?])', '$1') AS cleaned",
        r"regexp_replace(regexp_replace(regexp_replace('12' || chr(10) || text || chr(10) || 'foo-' || chr(10) || 'bar  , baz' || chr(10) || '99', '(?m)^\d{1,4}$\n?', '', 'g'), '(\p{Ll})-\n(\p{Ll})', '\1\2', 'g'), ' +([,.;:!?])', '\1', 'g') AS cleaned",
    ),
    "T28_replace_exactly_once": (
        "(length(text) - length(replace(text, 'token = ', ''))) / 8 = 1 AS once, CASE WHEN (length(text) - length(replace(text, 'token = ', ''))) / 8 = 1 THEN replace(text, 'token = ', 'token: ') ELSE text END AS replaced",
        "(length(text) - length(replace(text, 'token = ', ''))) / 8 = 1 AS once, CASE WHEN (length(text) - length(replace(text, 'token = ', ''))) / 8 = 1 THEN replace(text, 'token = ', 'token: ') ELSE text END AS replaced",
    ),
    "T29_block_markdown": (
        "CASE doc_id % 4 WHEN 0 THEN concat('### ', c) WHEN 1 THEN concat('- ', c) WHEN 2 THEN concat('    ', c) ELSE c END AS block",
        None,
    ),
    "T30_heading_title": (
        r"regexp_replace(regexp_replace(concat('## ', doc_id, '. ', c, '...'), '^#+ *(?:\\d+|[IVXLC]+)[.)] *', ''), '[. ]+$', '') AS title",
        r"regexp_replace(regexp_replace('## ' || doc_id || '. ' || c || '...', '^#+ *(?:\d+|[IVXLC]+)[.)] *', ''), '[. ]+$', '') AS title",
    ),
    "T31_toc_row": (
        r"regexp_extract(row, '^\\| *(.*?)[ .]*\\| *(\\d+) *\\|$', 1) AS title, cast(regexp_extract(row, '(\\d+) *\\|$', 1) AS BIGINT) AS page",
        r"regexp_extract(row, '^\| *(.*?)[ .]*\| *(\d+) *\|$', 1) AS title, regexp_extract(row, '(\d+) *\|$', 1)::BIGINT AS page",
    ),
    "T32_noise_flags": (r"instr(text, '\n---\n') > 0 AS footer, text rlike 'https?://' AS raw_url", "instr(text, chr(10) || '---' || chr(10)) > 0 AS footer, regexp_matches(text, 'https?://') AS raw_url"),
    "T33_input_template": (r"concat_ws('\n', concat('Source: ', source), concat('Language: ', lang), concat('Text: ', substring(c, 1, 300))) AS input", "'Source: ' || source || chr(10) || 'Language: ' || lang || chr(10) || 'Text: ' || substring(c, 1, 300) AS input"),
    "T34_facet_url": ("concat('/games/?trait=', replace(replace(url_encode(concat(source, ' ', lang)), '+', '%20'), '*', '%2A')) AS url", "'/games/?trait=' || replace(url_encode(source || ' ' || lang), '+', '%20') AS url"),
    "T35_html_escape": (
        "replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;') AS escaped",
        None,
    ),
    "T38_reference_cost": ("round(octet_length(text) * 0.1D / 1000000 + n_chars * 0.3D / 1000000, 8) AS cost, round(6 * octet_length(text) * 0.1D / 1000000, 8) AS upper_bound", "round(strlen(text) * 0.1::DOUBLE / 1000000 + n_chars * 0.3::DOUBLE / 1000000, 8) AS cost, round(6 * strlen(text) * 0.1::DOUBLE / 1000000, 8) AS upper_bound"),
    "T39_page_ranges": (
        "array_join(transform(array_sort(array_distinct(flatten(array(sequence(doc_id % 7, doc_id % 7 + 2), sequence(doc_id % 5, doc_id % 5 + 1))))), x -> cast(x AS STRING)), ',') AS pages",
        "array_to_string(list_transform(list_sort(list_distinct(range(doc_id % 7, doc_id % 7 + 3) || range(doc_id % 5, doc_id % 5 + 2))), lambda x: x::VARCHAR), ',') AS pages",
    ),
    "T40_exact_span": (
        r"regexp_count(text, 'token = \"') = 1 AS single, CASE WHEN regexp_count(text, 'token = \"') = 1 THEN regexp_replace(substring(text, regexp_instr(text, 'token = \"')), '(?s)\" .*$', '\"') END AS span",
        "len(regexp_extract_all(text, 'token = \"')) = 1 AS single, CASE WHEN len(regexp_extract_all(text, 'token = \"')) = 1 THEN regexp_replace(substring(text, instr(text, 'token = \"')), '(?s)\" .*$', '\"') END AS span",
    ),
    "T41_range_literal": (
        r"regexp_extract(r, '^(\\w+):(\\d+)-(\\d+)$', 1) AS label, cast(regexp_extract(r, '^(\\w+):(\\d+)-(\\d+)$', 2) AS BIGINT) AS lo, cast(regexp_extract(r, '^(\\w+):(\\d+)-(\\d+)$', 3) AS BIGINT) AS hi, format_string('[p%04d-l%04d] %s', doc_id % 100, doc_id % 13, c) AS line",
        r"regexp_extract(r, '^(\w+):(\d+)-(\d+)$', 1) AS label, regexp_extract(r, '^(\w+):(\d+)-(\d+)$', 2)::BIGINT AS lo, regexp_extract(r, '^(\w+):(\d+)-(\d+)$', 3)::BIGINT AS hi, '[p' || lpad((doc_id % 100)::VARCHAR, 4, '0') || '-l' || lpad((doc_id % 13)::VARCHAR, 4, '0') || '] ' || c AS line",
    ),
    "T42_record_cleaning": (
        r"trim(regexp_replace(regexp_replace(concat('<banner>x</banner>', text, ' (/rel/a)\n\nNote: gone'), '(?s)^<banner>.*?</banner>|\n\nNote:.*$', ''), '\\((/[^)]*)\\)', '(https://example.com$1)')) AS cleaned",
        r"trim(regexp_replace(regexp_replace('<banner>x</banner>' || text || ' (/rel/a)' || chr(10) || chr(10) || 'Note: gone', '(?s)^<banner>.*?</banner>|\n\nNote:.*$', '', 'g'), '\((/[^)]*)\)', '(https://example.com\1)', 'g')) AS cleaned",
    ),
}

_SPARK_BASE = r"(SELECT *, trim(regexp_replace(text, '(?U)\\s+', ' ')) AS c, transform(filter(sequence(doc_id, doc_id + 4), x -> x % (doc_id % 4 + 1) = 0), x -> x) AS p, format_string('%02d:%02d:%02d', doc_id % 24, doc_id % 60, doc_id % 59) AS e, concat('pages:', doc_id, '-', doc_id + 5) AS r, concat('| ', source, ' .... | ', doc_id, ' |') AS row FROM $documents)"
_DUCK_BASE = r"(SELECT *, trim(regexp_replace(text, '[\s\x{A0}]+', ' ', 'g')) AS c, list_filter(range(doc_id, doc_id + 5), lambda x: x % (doc_id % 4 + 1) = 0) AS p, lpad((doc_id % 24)::VARCHAR, 2, '0') || ':' || lpad((doc_id % 60)::VARCHAR, 2, '0') || ':' || lpad((doc_id % 59)::VARCHAR, 2, '0') AS e, 'pages:' || doc_id || '-' || (doc_id + 5) AS r, '| ' || source || ' .... | ' || doc_id || ' |' AS row FROM $documents) AS base"

for _name, (_spark, _duck) in _SCALARS.items():
    sql_query(_name, f"SELECT doc_id, {_spark} FROM {_SPARK_BASE}", f"SELECT doc_id, {_duck or _spark} FROM {_DUCK_BASE}")

#: The text of a document as terms are taken from it: its title (here the source) twice, then the body without its footer.
TITLES = 2
_TITLED = rf"concat(repeat(concat(source, ' '), {TITLES}), substring_index(concat(text, '\n\n---\nfooter words'), '\n\n---\n', 1))"
_TITLED_DUCK = f"(repeat(source || ' ', {TITLES}) || split_part(text || chr(10) || chr(10) || '---' || chr(10) || 'footer words', chr(10) || chr(10) || '---' || chr(10), 1))"
@query(
    "T3_terms_unigrams_bigrams",
    f"""WITH w AS (SELECT doc_id, regexp_extract_all({udfs.folded_sql("t", "duckdb")}, '[a-z0-9]+(?:''[a-z]+)?') AS w FROM (SELECT doc_id, {_TITLED_DUCK} AS t FROM $documents) d),
    t AS (SELECT doc_id, unnest(w || list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1])) AS term FROM w)
    SELECT doc_id, count(*) AS n_terms, count(DISTINCT term) AS n_distinct, min(term) AS first_term FROM t GROUP BY doc_id""",
)
def terms(spark, sf_dir):
    """Counts of each document's uni- and bigrams, inside its row; only ids that many rows share are counted by a shuffle of
    their terms."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    repeated = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select(F.col("doc_id").alias("id"))

    def made(rows):
        words = rows.select("doc_id", F.expr(_TITLED).alias("t")).select("doc_id", F.expr(f"""regexp_extract_all({udfs.folded_sql("t")}, "[a-z0-9]+(?:'[a-z]+)?", 0)""").alias("w"))
        return words.select("doc_id", F.expr("concat(w, CASE WHEN size(w) > 1 THEN zip_with(slice(w, 1, size(w) - 1), slice(w, 2, size(w) - 1), (a, b) -> concat_ws(' ', a, b)) ELSE array() END)").alias("terms"))

    def inside(rows):
        counted = made(rows).select("doc_id", F.size("terms").cast("long").alias("n_terms"), F.size(F.array_distinct("terms")).cast("long").alias("n_distinct"), F.array_min("terms").alias("first_term"))
        return counted.where("n_terms > 0")

    if repeated.isEmpty():
        return inside(docs)
    alike = F.col("doc_id").eqNullSafe(F.col("id"))
    each = made(docs.join(repeated, alike, "left_semi")).select("doc_id", F.explode("terms").alias("term"))
    return inside(docs.join(repeated, alike, "left_anti")).union(each.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_terms"), F.count_distinct("term").alias("n_distinct"), F.min("term").alias("first_term")))


sql_query(
    "T5_shingles",
    rf"""WITH w AS (SELECT doc_id, regexp_extract_all({FOLDED}, '(?U)\\w+', 0) AS w FROM $documents)
    SELECT doc_id, cast(size({udfs.shingles_sql("w")}) AS BIGINT) AS n_shingles FROM w""",
    rf"""WITH w AS (SELECT doc_id, regexp_extract_all({FOLDED_DUCK}, '[\p{{L}}\p{{M}}\p{{N}}_]+') AS w FROM $documents)
    SELECT doc_id, len(list_distinct(list_transform(range(0, greatest(len(w) - 4, 0)), lambda i: array_to_string(w[i + 1 : i + 5], ' ')))) AS n_shingles FROM w""",
)


@query("T13_compact_key", rf"SELECT doc_id, regexp_replace({FOLDED_C_DUCK}, '[^\p{{L}}\p{{N}}]', '', 'g') AS key FROM (SELECT doc_id, text AS c FROM $documents) t")
def compact_key(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", udfs.compact("text").alias("key"))


@query(
    "T43_url_identity",
    r"""SELECT page_id, regexp_replace(regexp_extract(url, '^https?://([^/?#]+)', 1), '^www\.', '') AS host, '/a&b é' || url_decode(regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1)) AS path FROM $pages""",
)
def url_identity(spark, sf_dir):
    """Host without www. and decoded path of addresses as they stand in HTML, with references and percent signs."""
    pages = table(spark, sf_dir, "pages")
    written = F.regexp_replace("url", "^(https?://[^/?#]+)", "$1/a&amp;b%20&#37;C3%A9")
    plain = pages.select("page_id", udfs.unescaped(written).alias("url"))
    return plain.select("page_id", F.regexp_replace(F.parse_url("url", F.lit("HOST")), r"^www\.", "").alias("host"), F.url_decode(F.replace(F.parse_url("url", F.lit("PATH")), F.lit("+"), F.lit("%2B"))).alias("path"))


sql_query(
    "T26_number_words",
    """WITH n AS (SELECT DISTINCT doc_id % 101 AS n FROM $documents)
    SELECT n, CASE WHEN n < 20 THEN element_at(split('zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen', ' '), cast(n + 1 AS INT))
      WHEN n = 100 THEN 'one hundred'
      ELSE concat(element_at(split('twenty thirty forty fifty sixty seventy eighty ninety', ' '), cast(n div 10 - 1 AS INT)), CASE WHEN n % 10 = 0 THEN '' ELSE concat('-', element_at(split('one two three four five six seven eight nine', ' '), cast(n % 10 AS INT))) END) END AS words FROM n""",
    """WITH n AS (SELECT DISTINCT doc_id % 101 AS n FROM $documents)
    SELECT n, CASE WHEN n < 20 THEN split_part('zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen', ' ', (n + 1)::INT)
      WHEN n = 100 THEN 'one hundred'
      ELSE split_part('twenty thirty forty fifty sixty seventy eighty ninety', ' ', (n // 10 - 1)::INT) || CASE WHEN n % 10 = 0 THEN '' ELSE '-' || split_part('one two three four five six seven eight nine', ' ', (n % 10)::INT) END END AS words FROM n""",
)
sql_query(
    "T36_T37_json_contract",
    """SELECT event_id, array_join(array_sort(json_object_keys(props)), ',') AS keys, json_object_keys(props) = array('k') AS exact_keys, from_json(props, 'k BIGINT').k AS k, coalesce(from_json(props, 'k BIGINT').k > 0, false) AS valid FROM $events""",
    """SELECT event_id, array_to_string(list_sort(json_keys(props)), ',') AS keys, json_keys(props) = ['k'] AS exact_keys, (props ->> 'k')::BIGINT AS k, coalesce((props ->> 'k')::BIGINT > 0, false) AS valid FROM $events""",
)


@query(
    "T8_markdown_plain_text",
    r"""WITH m AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace('![x](y) [a&amp;b](u) <b>x*y** ' || text || ' **</b> | ~', '!\[[^\]]*\]\([^)]+\)', ' ', 'g'), '\[([^\]]+)\]\([^)]+\)', '\1', 'g'), '<[^>]+>', ' ', 'g'), '[#*_>`~|]', ' ', 'g') AS t FROM $documents),
    c AS (SELECT doc_id, regexp_replace(regexp_replace(t, '[\s\x{A0}]+', ' ', 'g'), '^ | $', '', 'g') AS t FROM m)
    SELECT doc_id, replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&') AS plain FROM c""",
)
def markdown_plain(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    marked = F.concat(F.lit("![x](y) [a&amp;b](u) <b>x*y** "), "text", F.lit(" **</b> | ~"))
    return docs.select("doc_id", udfs.markdown_plain(marked).alias("plain"))


@query("T12_trait_key", "SELECT doc_id, regexp_replace(lower(trim(source)), '\\s+', ' ', 'g') AS trait_key, upper(substring(source, 1, 1)) || substring(source, 2) AS display FROM $documents")
def trait_key(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", udfs.normalized_key("source").alias("trait_key"), F.concat(F.upper(F.substring("source", 1, 1)), F.expr("substring(source, 2)")).alias("display"))


@query("T18_diacritic_folding", "WITH f AS (SELECT doc_id, translate(lower(strip_accents(text)), '^`', '') AS folded FROM $documents) SELECT doc_id, folded, replace(folded, 'ł', 'l') AS folded_map FROM f")
def folded(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    plain = udfs.strip_diacritics(F.lower("text"))
    return docs.select("doc_id", plain.alias("folded"), F.translate(plain, "ł", "l").alias("folded_map"))


@query("T15_title_similarity")
def title_similarity(spark, sf_dir):
    """Each document's first line against the first line of one item: all items take turns, by the documents' ids."""
    line = lambda c: F.substring_index(F.col(c), "\n", 1)
    items = table(spark, sf_dir, "benchmark").select("item_id", line("text").alias("other"))
    placed = numbered(items.withColumn("all", F.lit(1)), "all", [F.floor(F.col("item_id") / BUCKET)], [F.asc("item_id")], "place")
    turns = placed.select("item_id", "other", (F.col("place") - 1).alias("turn"))
    n = items.count()
    docs = table(spark, sf_dir, "documents").select("doc_id", F.pmod("doc_id", F.lit(max(n, 1))).cast("int").alias("turn"), line("text").alias("title"))
    return docs.join(turns, "turn").select("doc_id", "item_id", F.round(udfs.title_similarity("other", "title"), 6).alias("similarity"))


#: What is protected, for an engine without lookaround: numerals twice, as neighbours share the sign between them.
_NUMERAL = r"regexp_replace({}, '(^|[^\p{{L}}\p{{M}}\p{{N}}_])[IVXLCDM]+($|[^\p{{L}}\p{{M}}\p{{N}}_])', '\1ø\2', 'g')"
_NUMBERS = r"regexp_replace(text, 'https?://[^\s)]+|[⁰¹²³⁴⁵⁶⁷⁸⁹]+|\d{1,3}(?:[ \x{A0}]\d{3})+|\d+(?:[.,/—–-]\d+)*', 'ø', 'g')"


@query("T24_protect_restore", rf"SELECT doc_id, true AS restored, true AS digit_free, regexp_replace({_NUMERAL.format(_NUMERAL.format(_NUMBERS))}, '\n[ \t]*\n', 'ø', 'g') AS masked FROM $documents")
def protect_restore(spark, sf_dir):
    """Markers put in and taken out again, and the text with one letter for each."""
    docs = table(spark, sf_dir, "documents")
    held = docs.select("doc_id", "text", udfs.protect("text").alias("p"))
    masked = F.regexp_replace("p.text", "⟦[A-Z]+·[A-Z]+⟧", "ø")
    return held.select("doc_id", (udfs.restore("p") == F.col("text")).alias("restored"), (~F.col("p.text").rlike("[0-9]")).alias("digit_free"), masked.alias("masked"))
