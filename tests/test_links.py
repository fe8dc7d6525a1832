"""References by the standard's examples, and functions in SQL."""

from urllib.parse import urljoin

from pyspark.sql import functions as F

from weftline.functions import catalog, urls

BASE = "http://a/b/c/d;p?q"
#: The normal and abnormal examples of RFC 3986, 5.4.
EXAMPLES = {
    "g:h": "g:h", "g": "http://a/b/c/g", "./g": "http://a/b/c/g", "g/": "http://a/b/c/g/", "/g": "http://a/g", "//g": "http://g", "?y": "http://a/b/c/d;p?y", "g?y": "http://a/b/c/g?y", "#s": "http://a/b/c/d;p?q#s", "g#s": "http://a/b/c/g#s", "g?y#s": "http://a/b/c/g?y#s",
    ";x": "http://a/b/c/;x", "g;x": "http://a/b/c/g;x", "g;x?y#s": "http://a/b/c/g;x?y#s", "": "http://a/b/c/d;p?q", ".": "http://a/b/c/", "./": "http://a/b/c/", "..": "http://a/b/", "../": "http://a/b/", "../g": "http://a/b/g", "../..": "http://a/", "../../": "http://a/", "../../g": "http://a/g",
    "../../../g": "http://a/g", "../../../../g": "http://a/g", "/./g": "http://a/g", "/../g": "http://a/g", "g.": "http://a/b/c/g.", ".g": "http://a/b/c/.g", "g..": "http://a/b/c/g..", "..g": "http://a/b/c/..g", "./../g": "http://a/b/g", "./g/.": "http://a/b/c/g/", "g/./h": "http://a/b/c/g/h",
    "g/../h": "http://a/b/c/h", "g;x=1/./y": "http://a/b/c/g;x=1/y", "g;x=1/../y": "http://a/b/c/y", "g?y/./x": "http://a/b/c/g?y/./x", "g?y/../x": "http://a/b/c/g?y/../x", "g#s/./x": "http://a/b/c/g#s/./x", "g#s/../x": "http://a/b/c/g#s/../x",
}


def test_references_of_the_standard(spark):
    rows = spark.createDataFrame([(BASE, r) for r in EXAMPLES], "base string, ref string")
    got = {r.ref: r.target for r in rows.select("ref", urls.resolve(F.col("base"), F.col("ref")).alias("target")).collect()}
    assert got == EXAMPLES
    assert all(urljoin(BASE, r) == t for r, t in EXAMPLES.items())


def test_base_without_a_path_and_identity(spark):
    rows = spark.createDataFrame([("http://h", "x/../y"), ("http://h?q#f", "#s"), ("https://WWW.H.org/a%20b/?x#y", "")], "base string, ref string")
    got = [(r.t, r.i) for r in rows.select(urls.resolve(F.col("base"), F.col("ref")).alias("t"), urls.identity(F.col("base")).alias("i")).collect()]
    assert got == [("http://h/y", "h"), ("http://h?q#s", "h"), ("https://WWW.H.org/a%20b/?x", "h.org/a b")]


def test_functions_are_registered_and_take_odd_values(spark):
    names = catalog.register(spark)
    assert names == ["compact_key", "html_blocks", "logical_lines", "plain_text", "resolve_url", "text_paragraphs", "title_similarity"]
    one = spark.sql("SELECT compact_key('A b-Ç') AS a, compact_key(NULL) AS b, plain_text('*x* &amp;') AS c, title_similarity('', 'x') AS d, resolve_url('http://a/b', '../c') AS e").first()
    assert tuple(one) == ("abç", None, "x &", 0.0, "http://a/c")
    assert spark.sql("SELECT * FROM VALUES (CAST(NULL AS STRING)), ('') AS t(x), LATERAL html_blocks(x, false)").count() == 0
    rows = spark.sql("SELECT l.* FROM VALUES (replace('a\\n \\nb@\\n@c', '@', char(12))) AS t(x), LATERAL logical_lines(x) l").collect()
    assert [tuple(r) for r in rows] == [(1, 1, "a"), (1, 2, "b"), (3, 1, "c")]
    rows = spark.sql("SELECT p.* FROM VALUES ('lead\\n\\n{3}\\n \\none\\ntwo\\n\\n[Illustration: x]\\n\\n{4 continued}\\n\\nthree') AS t(x), LATERAL text_paragraphs(x) p").collect()
    assert [tuple(r) for r in rows] == [(0, None, "lead"), (1, 3, "one\ntwo"), (2, 4, "three")]
