"""Links, assets and addresses of pages (S7, S8, S11, S18, T43 and the functions of SQL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions import catalog, urls
from weftline.plans.registry import bound, query, table

_PLAIN = r"trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace({}, '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), '\s+', ' ', 'g'))"


@query(
    "S7_page_blocks",
    rf"""WITH p AS (SELECT page_id, regexp_extract(html, '<nav>(.*)</nav>', 1, 's') AS nav, replace(regexp_extract(html, '<article>(.*)</article>', 1, 's'), '</p>', '') AS body FROM $pages),
    b AS (SELECT page_id, 'li' AS kind, unnest(string_split(nav, '<li>')[2:]) AS t, generate_subscripts(string_split(nav, '<li>')[2:], 1) AS k FROM p
      UNION ALL SELECT page_id, 'p', unnest(string_split(replace(body, '<br>', ' '), '<p>')[2:]), generate_subscripts(string_split(body, '<p>')[2:], 1) FROM p),
    c AS (SELECT page_id, kind, k, {_PLAIN.format("t")} AS text FROM b)
    SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY kind, k) - 1 AS pos, kind, text FROM c WHERE text <> ''""",
)
def page_blocks(spark, sf_dir):
    """The blocks of every page's whole HTML, by the table function in SQL."""
    catalog.register(spark)
    return spark.sql(bound("SELECT page_id, CAST(b.pos AS BIGINT) AS pos, b.kind, b.text FROM $pages, LATERAL html_blocks(html, false) b", sf_dir))


@query(
    "S8_paragraphs_function",
    r"""WITH t AS (SELECT conv_id, turn, unnest(regexp_split_to_array(text, '\n[ \t]*\n')) AS para, generate_subscripts(regexp_split_to_array(text, '\n[ \t]*\n'), 1) AS k FROM $conversations)
    SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, turn ORDER BY k) - 1 AS pos, turn AS page, sha256(trim(para)) AS para_hash FROM t WHERE trim(para) <> ''""",
)
def paragraphs(spark, sf_dir):
    catalog.register(spark)
    return spark.sql(bound(r"SELECT conv_id, turn, CAST(p.pos AS BIGINT) AS pos, p.page, sha2(p.text, 256) AS para_hash FROM $conversations, LATERAL text_paragraphs(concat('{', turn, '}\n \t\n[Illustration: x]\n\n', text)) p", sf_dir))


@query(
    "S11_lines_function",
    r"""WITH p AS (SELECT doc_id, unnest(string_split(replace(text, '.' || chr(10), '.' || chr(12)), chr(12))) AS page, generate_subscripts(string_split(replace(text, '.' || chr(10), '.' || chr(12)), chr(12)), 1) AS k FROM $documents),
    l AS (SELECT doc_id, k, unnest(string_split(page, chr(10))) AS t, generate_subscripts(string_split(page, chr(10)), 1) AS raw FROM p)
    SELECT doc_id, k AS page, count(*) AS lines, sha256(string_agg(t, '|' ORDER BY raw)) AS digest FROM l WHERE regexp_matches(t, '[^\s\x{A0}\x{85}\x{1C}-\x{1F}]') GROUP BY doc_id, k""",
)
def lines(spark, sf_dir):
    catalog.register(spark)
    return spark.sql(bound(r"SELECT doc_id, CAST(l.page AS BIGINT) AS page, count(*) AS lines, sha2(array_join(transform(array_sort(collect_list(struct(l.line, l.text))), x -> x.text), '|'), 256) AS digest FROM $documents, LATERAL logical_lines(replace(text, '.\n', concat('.', char(12)))) l GROUP BY doc_id, l.page", sf_dir))


@query("L_scalar_functions", r"SELECT page_id, regexp_replace(url, '[^/?#]*([?#].*)?$', '') || 'next?p=1' AS next, CASE WHEN length(lower(url)) > 0 THEN 1::DOUBLE END AS same FROM $pages")
def scalars(spark, sf_dir):
    """Scalar functions by name."""
    catalog.register(spark)
    return spark.sql(bound("SELECT page_id, resolve_url(url, 'next?p=1') AS next, title_similarity(upper(url), url) AS same FROM $pages", sf_dir))


#: References that a page of a site may have beside those in the table's HTML: (reference, address by the page's own parts).
_HOST, _DIR, _FILE = r"regexp_extract(url, '^(https?://[^/?#]+)', 1)", r"regexp_extract(url, '^(https?://[^?#]*/)', 1)", r"regexp_extract(url, '^([^?#]*)', 1)"
_UP = r"regexp_replace(regexp_extract(url, '^(https?://[^?#]*/)', 1), '^(https?://[^/]+(?:/.*)?/)[^/]+/$', '\1')"
MADE = (
    ("b.png", f"{_DIR} || 'b.png'"), ("./b/./c?x=1", f"{_DIR} || 'b/c?x=1'"), ("../up#f", f"{_UP} || 'up#f'"), ("?q=2", f"{_FILE} || '?q=2'"), ("#part", r"regexp_replace(url, '#.*$', '') || '#part'"),
    ("//cdn.example.net/a/../s.css", "regexp_extract(url, '^(https?:)', 1) || '//cdn.example.net/s.css'"), ("/a/b/../../c/", f"{_HOST} || '/c/'"), ("../../../../x", f"{_HOST} || '/x'"), ("mailto:a@b.c", "'mailto:a@b.c'"), ("", r"regexp_replace(url, '#.*$', '')"),
)


@query("T43_resolved_references", "WITH r AS (SELECT page_id, url, unnest(range(10)) AS k FROM $pages) SELECT page_id, k, CASE k " + " ".join(f"WHEN {k} THEN {want}" for k, (_, want) in enumerate(MADE)) + " END AS target FROM r")
def references(spark, sf_dir):
    """References of each kind, resolved against every page's address."""
    made = F.array(*[F.lit(ref) for ref, _ in MADE])
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.posexplode(made).alias("k", "ref"))
    return pages.select("page_id", F.col("k").cast("long").alias("k"), urls.resolve(F.col("url"), F.col("ref")).alias("target"))


_ID = r"regexp_replace(lower(regexp_extract({0}, '^https?://([^/?#]+)', 1)), '^www\.', '') || regexp_replace(url_decode(regexp_extract({0}, '^https?://[^/?#]+([^?#]*)', 1)), '/$', '')"


@query(
    "S18_resolved_links",
    rf"""WITH w AS (SELECT page_id, url, html || '<img src="logo.png"><a href="' || regexp_replace(url, '^https?:', '') || '?again">self</a><a href="gone.html#x">gone</a><a href="#top">top</a><a href="mailto:x@y.z">m</a><link href="/s.css">' AS html FROM $pages),
    l AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS ref FROM w),
    t AS (SELECT page_id, url, ref, CASE WHEN ref LIKE 'mailto:%' THEN 'mail' WHEN ref LIKE '#%' THEN 'anchor' ELSE 'link' END AS kind, regexp_extract(url, '^(https?:)', 1) AS scheme,
      CASE WHEN ref LIKE '//%' THEN regexp_extract(url, '^(https?:)', 1) || ref WHEN ref LIKE '/%' THEN {_HOST} || ref ELSE {_DIR} || ref END AS target FROM l),
    known AS (SELECT DISTINCT {_ID.format("url")} AS id FROM $pages),
    c AS (SELECT page_id, kind, target, k.id IS NOT NULL AS there, regexp_extract(target, '^https?://([^/?#]+)', 1) = regexp_extract(url, '^https?://([^/?#]+)', 1) AS own FROM t LEFT JOIN known k ON k.id = {_ID.format("t.target")} AND t.kind = 'link')
    SELECT page_id, count(*) FILTER (WHERE kind = 'link') AS links, count(*) FILTER (WHERE kind = 'anchor') AS anchors, count(*) FILTER (WHERE kind = 'mail') AS mails, count(*) FILTER (WHERE kind = 'link' AND own) AS internal, count(*) FILTER (WHERE kind = 'link' AND NOT there) AS dangling, 2::BIGINT AS assets FROM c GROUP BY page_id""",
)
def resolved_links(spark, sf_dir):
    """Counts of a page's links by kind, of those whose target is no page, and of its assets. References are resolved on
    each page first; targets meet the pages by their identity."""
    more = F.concat(F.lit('<img src="logo.png"><a href="'), F.regexp_replace("url", "^https?:", ""), F.lit('?again">self</a><a href="gone.html#x">gone</a><a href="#top">top</a><a href="mailto:x@y.z">m</a><link href="/s.css">'))
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.concat("html", more).alias("html"))
    found = pages.select("page_id", "url", F.explode(F.regexp_extract_all("html", F.lit(r'(?i)<(a|area)\b[^>]*?\shref\s*=\s*"([^"]*)"'), F.lit(2))).alias("ref"))
    assets = pages.select("page_id", F.size(F.regexp_extract_all("html", F.lit(r'(?i)<(img|script|source|link)\b[^>]*?\s(?:src|href)\s*=\s*"([^"]*)"'), F.lit(2))).cast("long").alias("assets"))
    kind = F.when(F.col("ref").rlike("^[A-Za-z][A-Za-z0-9+.-]*:") & ~F.col("ref").rlike("(?i)^https?:"), "mail").when(F.col("ref").startswith("#"), "anchor").otherwise("link")
    target = urls.resolve(F.col("url"), F.col("ref"))
    links = found.select("page_id", "url", kind.alias("kind"), target.alias("target")).withColumn("id", F.when(F.col("kind") == "link", urls.identity(F.col("target"))))
    known = table(spark, sf_dir, "pages").select(urls.identity(F.col("url")).alias("known")).distinct()
    host = lambda c: F.regexp_extract(c, "^https?://([^/?#]+)", 1)
    link = F.col("kind") == "link"
    counted = links.join(known, F.col("id") == F.col("known"), "left").groupBy("page_id").agg(
        F.count_if(link).alias("links"), F.count_if(F.col("kind") == "anchor").alias("anchors"), F.count_if(F.col("kind") == "mail").alias("mails"),
        F.count_if(link & (host("target") == host("url"))).alias("internal"), F.count_if(link & F.col("known").isNull()).alias("dangling"),
    )
    return counted.join(assets, "page_id")
