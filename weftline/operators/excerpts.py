"""Numbers, spans, ranges, contents rows, costs and sorted lists of texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftline.functions import text as texts
from weftline.operators.windows import numbered
from weftline.plans.registry import query, table

# ---- T25


@query(
    "T25_numbers_of_translations",
    r"""WITH b AS (SELECT doc_id, text || ' 1 200, 3–4 and 2.500,75 or 1,250 of 7/8—9 in x² ' || doc_id || ',5' AS t FROM $documents),
    n AS (SELECT doc_id, list_transform(regexp_extract_all(t, '[⁰¹²³⁴⁵⁶⁷⁸⁹]+|\d{1,3}(?:[ \x{A0}]\d{3})+|\d+(?:[.,/—–-]\d+)*'), lambda v: regexp_replace(v, '[ \x{A0}]', '', 'g')) AS v FROM b),
    p AS (SELECT doc_id, flatten(list_transform(v, lambda x: CASE WHEN regexp_matches(x, '[—–-]') THEN list_filter(regexp_split_to_array(x, '[—–-]'), lambda y: y <> '') WHEN regexp_matches(x, '^\d{1,3}(?:[.,]\d{3})+$') THEN [regexp_replace(x, '[.,]', '', 'g')] ELSE [replace(x, ',', '.')] END)) AS v FROM n)
    SELECT doc_id, array_to_string(list_sort(v), ' ') AS numbers FROM p""",
)
def translated_numbers(spark, sf_dir):
    """The multiset of a text's numbers, however they are written: what a translation must keep."""
    docs = table(spark, sf_dir, "documents")
    t = F.concat("text", F.lit(" 1 200, 3–4 and 2.500,75 or 1,250 of 7/8—9 in x² "), F.col("doc_id").cast("string"), F.lit(",5"))
    return docs.select("doc_id", F.array_join(texts.numbers(t), " ").alias("numbers"))


# ---- T31


def contents_pairs(row: Column) -> Column:
    """array of (title, page): of a table row cell pairs of a title and a page, of any other line the title before dotted
    leaders and the page at its end; dots and bars around titles go."""
    tidy = lambda c: F.regexp_replace(F.trim(c), r"[\s.·…]+$", "")
    cells = F.transform(F.split(F.regexp_replace(F.trim(row), r"^\||\|$", ""), r"\|"), lambda c: F.trim(c))
    places = F.sequence(F.lit(1), F.greatest(F.size(cells) - 1, F.lit(1)))
    pair = lambda k: F.struct(tidy(F.element_at(cells, k)).alias("title"), F.regexp_extract(F.element_at(cells, k + 1), r"^\d+$", 0).alias("page"))
    of_cells = F.filter(F.transform(F.filter(places, lambda k: k < F.size(cells)), pair), lambda p: (p["page"] != "") & p["title"].rlike(r"\p{L}"))
    plain = r"^\s*(.*?\p{L}.*?)(?:\s*[.·…][\s.·…]*|\s{2,})(\d+)\s*$"
    of_line = F.when(row.rlike(plain), F.array(F.struct(tidy(F.regexp_extract(row, plain, 1)).alias("title"), F.regexp_extract(row, plain, 2).alias("page"))))
    return F.when(F.trim(row).startswith("|"), of_cells).otherwise(F.coalesce(of_line, F.array().cast("array<struct<title:string,page:string>>")))


@query(
    "T31_contents_pairs",
    """SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN source || '@' || doc_id || ';Second one@7' WHEN 1 THEN 'The ' || source || '@' || doc_id WHEN 2 THEN source || ' again@12' ELSE '' END AS pairs FROM $documents""",
)
def pairs_of_contents(spark, sf_dir):
    """Rows of tables of contents in four shapes: two pairs of cells, dotted leaders, spaces, none."""
    n, s = F.col("doc_id").cast("string"), F.col("source")
    k = F.col("doc_id") % 4
    row = F.when(k == 0, F.concat(F.lit("| "), s, F.lit(" ..... | "), n, F.lit(" | Second one… | 7 | 3 | 4 |"))).when(k == 1, F.concat(F.lit("The "), s, F.lit(" . . . . . "), n)).when(k == 2, F.concat(s, F.lit(" again    12"))).otherwise(F.concat(F.lit("| --- | "), s, F.lit(" |")))
    found = F.transform(contents_pairs(row), lambda p: F.concat(p["title"], F.lit("@"), p["page"]))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(found, ";").alias("pairs"))


# ---- T38

#: Prices of a million tokens, in and out, by model; attempts of the worst way through retries.
PRICES, WORST = {"small": (0.1, 0.3), "large": (2.0, 8.0)}, 6


def reference_cost(model: Column, tokens_in: Column, tokens_out: Column) -> Column:
    """What a use costs by the list; usage that isn't positive, or of a model without a price, is an error."""
    price = F.create_map(*[x for m, (a, b) in PRICES.items() for x in (F.lit(m), F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")))])[model]
    cost = F.round((tokens_in * price["a"] + tokens_out * price["b"]) / 1_000_000, 8)
    return F.when((tokens_in > 0) & (tokens_out > 0) & price.isNotNull(), cost).otherwise(F.raise_error(F.lit("usage must be positive, of a model with a price")).cast("double"))


@query(
    "T38_costs_by_model",
    """SELECT doc_id, round((octet_length(encode(text)) * CASE WHEN doc_id % 3 = 0 THEN 2.0 ELSE 0.1 END + length(text) * CASE WHEN doc_id % 3 = 0 THEN 8.0 ELSE 0.3 END)::DOUBLE / 1000000, 8) AS cost, round(6 * (octet_length(encode(text)) * CASE WHEN doc_id % 3 = 0 THEN 2.0 ELSE 0.1 END)::DOUBLE / 1000000, 8) AS bound FROM $documents WHERE text <> ''""",
)
def costs(spark, sf_dir):
    """The reference cost of each text, and a bound of what it can cost: no text has more tokens than bytes, sent so many
    times at worst."""
    docs = table(spark, sf_dir, "documents").where("text <> ''")
    model = F.when(F.col("doc_id") % 3 == 0, "large").otherwise("small")
    size = F.octet_length("text").cast("double")
    price = F.when(F.col("doc_id") % 3 == 0, PRICES["large"][0]).otherwise(PRICES["small"][0])
    return docs.select("doc_id", reference_cost(model, size, F.length("text").cast("double")).alias("cost"), F.round(WORST * size * price / 1_000_000, 8).alias("bound"))


# ---- T40


def exact_span(text: Column, start: str, end: str, exclusions: tuple[str, ...] = ()) -> Column:
    """(span, error): what stands from the one match of start to the one match of end after it, without what each exclusion
    matches once in it; `start`, `end` or `exclusion` where a pattern doesn't match exactly once."""
    once = lambda t, p: F.regexp_count(t, F.lit(p)) == 1
    rest = F.substr(text, F.greatest(F.regexp_instr(text, F.lit(start)), F.lit(1)))
    ends = F.regexp_instr(rest, F.lit(end))
    span, fine = F.substr(rest, F.lit(1), F.greatest(ends - 1, F.lit(0))), F.lit(True)
    for p in exclusions:
        fine = fine & once(span, p)
        span = F.regexp_replace(span, p, "")
    error = F.when(~once(text, start), "start").when(~once(rest, end), "end").when(~fine, "exclusion")
    return F.struct(F.when(error.isNull(), span).alias("span"), error.alias("error"))


@query(
    "T40_spans_with_exclusions",
    """WITH c AS (SELECT doc_id, regexp_replace(text, '[<>\\[\\]]', '', 'g') AS c FROM $documents)
    SELECT doc_id, CASE doc_id % 5 WHEN 1 THEN 'start' WHEN 2 THEN 'end' WHEN 3 THEN 'exclusion' WHEN 4 THEN 'start' END AS error, CASE WHEN doc_id % 5 = 0 THEN sha256('<begin>' || c || ' tail ') END AS span_sha256 FROM c""",
)
def spans(spark, sf_dir):
    """Texts between two marks, with a note inside that goes; some lack a mark, have one twice, or no note."""
    bare = F.regexp_replace("text", r"[<>\[\]]", "")
    k = F.col("doc_id") % 5
    begin, note, end = F.lit("<begin>"), F.lit("[note: x]"), F.lit("<end>")
    made = F.when(k == 0, F.concat(F.lit("head "), begin, bare, F.lit(" "), note, F.lit("tail "), end, F.lit(" after"))).when(k == 1, F.concat(bare, note, end)).when(k == 2, F.concat(begin, bare, note, end, F.lit(" "), end)).when(k == 3, F.concat(begin, bare, end)).otherwise(F.concat(begin, bare, note, begin, end))
    found = table(spark, sf_dir, "documents").select("doc_id", exact_span(made, "<begin>", "<end>", (r"\[note: [^\]]*\]",)).alias("s"))
    return found.select("doc_id", "s.error", F.sha2("s.span", 256).alias("span_sha256"))


# ---- T41


def page_range(literal: Column, pages: Column) -> Column:
    """(label, first, last) of `label:first-last`, if it is one within 1 to pages; else null."""
    shape = r"^([A-Za-z][\w-]*):(\d{1,9})-(\d{1,9})$"
    label, first, last = (F.regexp_extract(literal, shape, k) for k in (1, 2, 3))
    a, b = (F.when(literal.rlike(shape), x).cast("long") for x in (first, last))
    return F.when((a >= 1) & (a <= b) & (b <= pages), F.struct(label.alias("label"), a.alias("first"), b.alias("last")))


@query(
    "T41_excerpts_of_pages",
    """WITH t AS (SELECT conv_id, turn + 1 AS page, text FROM $conversations), m AS (SELECT conv_id, max(page) AS pages FROM t GROUP BY conv_id),
    r AS (SELECT conv_id, pages, CASE conv_id % 4 WHEN 0 THEN 2 WHEN 1 THEN 1 END AS a, CASE conv_id % 4 WHEN 0 THEN pages WHEN 1 THEN 2 END AS b FROM m),
    l AS (SELECT t.conv_id, t.page, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM t)
    SELECT r.conv_id, any_value(a) IS NOT NULL AS valid, sha256(coalesce(string_agg('[p' || lpad(l.page::VARCHAR, 4, '0') || '-l' || lpad(l.n::VARCHAR, 4, '0') || '] ' || l.line, chr(10) ORDER BY l.page, l.n), '')) AS excerpt_sha256 FROM r LEFT JOIN l ON l.conv_id = r.conv_id AND l.page BETWEEN r.a AND r.b GROUP BY r.conv_id""",
)
def excerpts(spark, sf_dir):
    """Numbered lines of the pages that a range literal names; literals beyond the last page, turned round or of another shape
    are refused."""
    talks = table(spark, sf_dir, "conversations").select("conv_id", (F.col("turn") + 1).alias("page"), "text")
    sizes = talks.groupBy("conv_id").agg(F.max("page").alias("pages"))
    k, last = F.col("conv_id") % 4, F.col("pages").cast("string")
    literal = F.when(k == 0, F.concat(F.lit("pages:2-"), last)).when(k == 1, "pages:1-2").when(k == 2, F.concat(F.lit("pages:1-9"), last)).otherwise("pages:3-2")
    ranges = sizes.select("conv_id", page_range(literal, F.col("pages")).alias("r"))
    lines = talks.select("conv_id", "page", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    shown = F.format_string("[p%04d-l%04d] %s", "page", F.col("at") + 1, "line")
    named = lines.join(ranges, "conv_id").where(F.col("page").between(F.col("r.first"), F.col("r.last")))
    joined = named.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "at", shown.alias("s")))), lambda x: x["s"]), "\n").alias("excerpt"))
    return ranges.join(joined, "conv_id", "left").select("conv_id", F.col("r").isNotNull().alias("valid"), F.sha2(F.coalesce("excerpt", F.lit("")), 256).alias("excerpt_sha256"))


# ---- A16, K6

_OPTIONS = r"o AS (SELECT DISTINCT facet, value FROM (SELECT lang AS facet, regexp_extract(text, '^\s*(\p{L}+)', 1) AS value FROM $documents UNION ALL SELECT lang, unnest(['łan', 'lan', 'lbn', 'maß', 'mass', 'mast', 'ça', 'cb', 'ezé', 'eze']) FROM $documents) t WHERE value <> '')"


#: Letters at which lists are cut into buckets, of three scripts; any letters cut right, these cut evenly.
LETTERS = "aąbcćdeęfghijklłmnńoópqrsśtuvwxyzźżαβγδεζηθικλμνξοπρστυφχψωабвгдежзийклмнопрстуфхцчшщыэюя"


def letters_before(value: Column, locale: str) -> Column:
    """How many of LETTERS don't come after the value in the order of a locale: compared in that order itself, so the number
    rises with it for letters that stand for two (ß) too."""
    return F.size(F.filter(F.array(*map(F.lit, LETTERS)), lambda x: F.collate(x, locale) <= F.collate(value, locale)))


@query("A16_options_by_locale", f"WITH {_OPTIONS} SELECT facet, value, row_number() OVER (PARTITION BY facet ORDER BY value COLLATE pl, value) AS place FROM o")
def options_by_locale(spark, sf_dir):
    """Distinct values of each facet in the order of a locale, where Polish ł follows l."""
    more = F.array(*map(F.lit, ("łan", "lan", "lbn", "maß", "mass", "mast", "ça", "cb", "ezé", "eze")))
    docs = table(spark, sf_dir, "documents")
    first = docs.select(F.col("lang").alias("facet"), F.regexp_extract("text", r"^\s*(\p{L}+)", 1).alias("value"))
    options = first.union(docs.select("lang", F.explode(more))).where("value <> ''").distinct()
    return numbered(options, "facet", [letters_before(F.col("value"), "pl")], [F.collate("value", "pl").asc(), F.asc("value")], "place")


@query("K6_folded_multi_key", "WITH d AS (SELECT doc_id, source, lower(regexp_extract(text, '^\\s*(\\p{L}+)', 1)) AS author, length(text) AS size FROM $documents) SELECT doc_id, row_number() OVER (PARTITION BY source ORDER BY author, size DESC, doc_id) AS place FROM d")
def folded_order(spark, sf_dir):
    """Documents of a source by first word whatever its case, then longest, then id."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.lower(F.regexp_extract("text", r"^\s*(\p{L}+)", 1)).alias("author"), F.length("text").alias("size"))
    return numbered(docs, "source", [F.substring("author", 1, 2)], [F.asc("author"), F.desc("size"), F.asc("doc_id")], "place").select("doc_id", "place")


# ---- W5


@query("W5_bottom_share_by_buckets", "WITH r AS (SELECT p_partkey, p_brand, p_retailprice, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey) AS r, count(*) OVER (PARTITION BY p_brand) AS n FROM $part) SELECT p_partkey, r FROM r WHERE r <= greatest(1, ceil(n * 0.05))")
def bottom_share(spark, sf_dir):
    """The cheapest twentieth of each brand, one at least, numbered by buckets of the price."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_retailprice")
    placed = numbered(parts, "p_brand", [F.floor(F.col("p_retailprice") / 10)], [F.asc("p_retailprice"), F.asc("p_partkey")], "r", "n")
    return placed.where(F.col("r") <= F.greatest(F.lit(1), F.ceil(F.col("n") * 0.05))).select("p_partkey", "r")
