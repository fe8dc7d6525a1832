"""Properties and literals of operators without an SQL twin, and of readers and writers."""

import tracemalloc
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from weftline.functions import text
from weftline.operators import relational, sparse, vectors, windows
from weftline.sources import files
from weftline.sources.html import html_blocks
from weftline.streaming import ledger


@pytest.mark.parametrize("body", ["see https://a.b/c?d=1, pages 12-14 and XIV.\n\nEnd 3.5", "", "no markers", "⟦A·B⟧ 7", "V and I, 1 000 km, x² \n \t\n 12XIV"])
def test_protect_restores(body):
    marked, kept = text.protected(body)
    assert not any(c.isdigit() for c in marked)
    assert text.restored(marked, kept) == body


def test_single_numerals_and_spaced_thousands_are_protected():
    marked, kept = text.protected("Part V of I: 10 000 men, 3–4 days,\n \nXIVa 2XIV x²")
    assert list(kept.values()) == ["V", "I", "10 000", "3–4", "\n \n", "2", "²"]
    with pytest.raises(ValueError):
        text.restored(marked + " 7", kept, digits=False)


def test_letters_count_like_columns_of_a_sheet():
    names = [text.letters(n) for n in range(20_000)]
    assert names[:3] == ["A", "B", "C"] and names[25:28] == ["Z", "AA", "AB"] and names[701:703] == ["ZZ", "AAA"]
    assert len(set(names)) == len(names) and sorted(names, key=lambda n: (len(n), n)) == names


def test_folding_is_pythons(spark):
    texts = ["Straße ẞ", "ΣΊΣΥΦΟΣ ς", "İstanbul ﬁne", "ŉ ǰ ſ", "ꭰ Ꭰ", "plain ASCII", "ᾳ ﬗ"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.expr(text.folded_sql("t")).alias("f"))
    assert all(r.f == r.t.casefold() for r in rows.collect())


def test_keys_with_and_without_ascii(spark):
    texts = ["  A b\tC ", "ＡＢ ﬁ  ß", "", None, "x²—Ünï"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", text.normalized_key("t").alias("n"), text.compact("t").alias("c"), text.strip_diacritics("t").alias("d"), text.unescaped("t").alias("u")).collect()
    for r in rows:
        assert r.c == (None if r.t is None else text.compact_key(r.t))
    assert [r.n for r in rows] == ["a b c", "ab fi ss", "", None, "x2—ünï"]
    assert rows[4].d == "x2—Uni"


def test_restore_refuses_missing_and_repeated_markers():
    marked, kept = text.protected("1 and 2")
    name = next(iter(kept))
    with pytest.raises(ValueError):
        text.restored(marked.replace(name, ""), kept)
    with pytest.raises(ValueError):
        text.restored(marked + name, kept)


def test_title_similarity():
    assert text.matching_ratio("", "x") == 0
    assert text.matching_ratio("B i e g", "bieg") == 1
    assert text.matching_ratio("the long run", "long") == pytest.approx(4 / 10)
    assert text.matching_ratio("Treasure hunt", "Treasvre hunt") > 0.8
    assert text.matching_ratio("Treasure hunt", "## 12. **Treasure hunt** |") == 1


def test_markdown_plain_text():
    assert text.plain_text("![a](b) [label](u) **bold** &amp; <i>x</i> | y") == "label bold & x y"
    assert text.plain_text("a*b<br>c![x](y)d [](z)") == "a b c d [](z)"


def test_tfidf_of_equal_and_disjoint_documents(spark):
    docs = spark.createDataFrame([(1, "a", "red fox runs"), (2, "b", "red fox runs"), (3, "c", "quiet lake")], "doc_id long, source string, text string")
    v = sparse.tfidf(docs).toPandas()
    w = {i: dict(zip(g.term, g.w, strict=True)) for i, g in v.groupby("id")}
    cosine = lambda a, b: sum(w[a][t] * w[b].get(t, 0) for t in w[a])
    assert cosine(1, 2) == pytest.approx(1) and cosine(1, 3) == 0


def test_neighbours_break_ties_by_id_and_blocks_do_not_matter(spark):
    rows = [(i, 0, [1.0, 0.0] if i % 2 else [0.0, 1.0]) for i in range(9)]
    v = vectors.unit_rows(spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>"))
    one = sorted((r.src, r.rank, r.dst) for r in vectors.neighbours(v, 3).collect())
    many = sorted((r.src, r.rank, r.dst) for r in vectors.neighbours(v, 3, block=2).collect())
    assert one == many
    assert [d for s, _, d in one if s == 1] == [3, 5, 7]


def test_zero_vector_is_an_error(spark):
    rows = spark.createDataFrame([(1, 0, [0.0, 0.0])], "vec_id long, label int, embedding array<float>")
    with pytest.raises(PySparkException):
        vectors.unit_rows(rows).collect()


def test_linkage_does_not_depend_on_order():
    v = np.array([[1, 0], [0.99, 0.1], [0, 1], [0.1, 0.99]])
    ids = np.array([4, 1, 3, 2])
    got = vectors.agglomerate(ids, v, 2)
    turned = vectors.agglomerate(ids[::-1], v[::-1], 2)[::-1]
    assert got.tolist() == turned.tolist() == [0, 0, 1, 1]


def test_linkage_holds_no_square_of_its_rows():
    """Over 4,000 rows all similarities would take 128 MB."""
    v = np.random.default_rng(3).normal(size=(4000, 8))
    v[2000:2100] = v[:100]
    tracemalloc.start()
    got = vectors.agglomerate(np.arange(4000), v, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 48 << 20
    assert set(got.tolist()) == {0, 1, 2} and got[2000:2100].tolist() == got[:100].tolist()


def test_linkage_of_copies_goes_by_smaller_members():
    v = np.array([[1.0, 0], [0, 1], [1, 0], [0, 1], [1, 0]])
    assert vectors.agglomerate(np.arange(5), v, 3).tolist() == [0, 1, 0, 2, 0]
    assert vectors.agglomerate(np.arange(5), v, 2).tolist() == [0, 1, 0, 1, 0]


def test_hull_drops_inner_and_collinear_points():
    assert vectors.hull([(0, 0), (1, 0), (1, 1), (0, 1), (0.5, 0.5), (0.5, 0)]) == [(0, 0), (1, 0), (1, 1), (0, 1)]
    assert vectors.hull([(1, 1), (1, 1)]) == [(1, 1)]


def test_projection_keeps_the_most_variance(spark, sf_dir):
    found = vectors.projection(spark, sf_dir).toPandas().sort_values("vec_id")
    x = np.array([r.v for r in vectors.unit_rows(vectors.table(spark, sf_dir, "embeddings")).orderBy("id").collect()])
    values = np.linalg.svd(x - x.mean(0), compute_uv=False)[:2] ** 2
    got = found[["x", "y"]].to_numpy()
    assert ((got - got.mean(0)) ** 2).sum(0) == pytest.approx(values, rel=1e-6)


def test_linkage_of_a_label_is_that_of_its_rows_alone(spark, sf_dir):
    found = vectors.linkage(spark, sf_dir).toPandas()
    rows = vectors.unit_rows(vectors.table(spark, sf_dir, "embeddings")).toPandas().set_index("id")
    for label, g in found.groupby("label"):
        ids = g.vec_id.to_numpy()
        assert vectors.agglomerate(ids, np.array(rows.v[ids].tolist()), 3).tolist() == g.cluster.tolist(), label


def test_greedy_chunks():
    assert windows.greedy_chunks([4, 4, 4, 9, 1], 10) == [0, 0, 1, 2, 3]
    assert windows.greedy_chunks([], 10) == [] and windows.greedy_chunks([20, 1], 10) == [0, 1]


def test_numbers_of_a_hot_group_by_buckets(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 10 < 9, "hot").when(F.col("id") % 20 < 10, "cold").alias("g"), "id")
    made = windows.numbered(rows, "g", [F.floor(F.col("id") / 64)], [F.asc("id")], "k", "n").collect()
    assert len(made) == 5000
    for g in ("hot", "cold", None):
        mine = sorted((r.id, r.k) for r in made if r.g == g)
        assert [k for _, k in mine] == list(range(1, len(mine) + 1)) and {r.n for r in made if r.g == g} == {len(mine)}


def test_first_of_takes_the_first_of_all_salts(spark):
    rows = spark.range(1000).select(F.lit(1).alias("g"), "id")
    assert sorted(r.id for r in windows.first_of(rows, ["g"], [F.desc("id")], 7, "r").collect()) == list(range(993, 1000))


def test_similar_pairs_are_those_of_brute_force(spark):
    import random

    rng = random.Random(3)
    words = [f"w{k}" for k in range(40)]
    texts = [" ".join(rng.choices(words, weights=range(1, 41), k=30)) for _ in range(60)]
    texts += [" ".join(w if rng.random() > 0.1 else "x" for w in t.split()) for t in texts[:20]]
    docs = spark.createDataFrame([(k, f"s{k % 3}", t) for k, t in enumerate(texts)], "doc_id long, source string, text string")
    v = sparse.tfidf(docs).cache()
    held = {i: dict(zip(g.term, g.w, strict=True)) for i, g in v.toPandas().groupby("id")}
    for least in (0.8, 0.4, 0.2):
        want = {(i, j) for i in held for j in held if i < j and i % 3 != j % 3 and sum(w * held[j].get(t, 0) for t, w in held[i].items()) >= least}
        assert {(r.left_id, r.right_id) for r in sparse.rare_pairs(v, least).collect()} == want
        for heavy, block in ((0, 64), (8, 7), (1000, 25)):
            assert {(r.left_id, r.right_id) for r in sparse.all_pairs(v, least, heavy=heavy, block=block).collect()} == want
    cosines = {(i, j): sum(w * held[j].get(t, 0) for t, w in held[i].items()) for i in held for j in held if i < j and i % 3 != j % 3}
    top = sorted((-round(c, 6), i, j) for (i, j), c in cosines.items() if c >= 0.09)[:20]
    found = sparse.all_pairs(v, 0.09, most=20, heavy=8, block=16).collect()
    assert sorted((-round(r.cosine, 6), r.left_id, r.right_id) for r in found)[:20] == top and len(found) < len(cosines)
    assert all({r.g1, r.g2} == {f"s{r.left_id % 3}", f"s{r.right_id % 3}"} and r.g1 == f"s{r.left_id % 3}" for r in found)


def test_shingle_pairs_are_those_of_brute_force(spark, tmp_path):
    import random
    import re

    rng = random.Random(5)
    items = [" ".join(rng.choices(["Fox", "hen,", "Straße", "lake", "owl", "x"], k=rng.randint(3, 40))) for _ in range(12)]
    docs = [" ".join(w if rng.random() > 0.06 else "new" for w in t.split()) + " " + " ".join(rng.choices("abcdef", k=rng.randint(0, 12))) for t in items * 4]
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))

    def shingles(t):
        w = re.findall(r"\w+", t.casefold())
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}

    want = {}
    for i, a in enumerate(map(shingles, items)):
        for k, b in enumerate(map(shingles, docs)):
            if a and b and len(a & b) / len(a | b) >= 0.45:
                want[i, k] = round(len(a & b) / len(a | b), 6)
    assert want and {(r.item_id, r.doc_id): r.jaccard for r in sparse.shingle_jaccard(spark, str(tmp_path)).collect()} == want


def test_title_counts_in_tfidf(spark):
    docs = spark.createDataFrame([(1, "a", "fox", "red hen\n\n---\nfoot"), (2, "b", "owl", "red hen")], "doc_id long, source string, title string, text string")
    terms = {r.term for r in sparse.tfidf(docs, title_col="title").where("id = 1").collect()}
    hashed = lambda words: spark.createDataFrame([(words,)], "w string").selectExpr("transform(split(w, ' '), x -> xxhash64(x)) AS h").selectExpr("CASE WHEN size(h) = 1 THEN h[0] ELSE xxhash64(h[0], h[1]) END AS t").first().t
    assert {hashed(t) for t in ("fox", "fox fox", "fox red", "red hen")} <= terms and hashed("foot") not in terms


def test_ranks_of_pairs_are_full_ranks(spark, sf_dir):
    rows = vectors.unit_rows(vectors.table(spark, sf_dir, "embeddings"))
    n = rows.count()
    near = {(r.src, r.dst): r["rank"] for r in vectors.neighbours(rows, n - 1).where("src < 3").collect()}
    pairs = spark.createDataFrame(list(near), "src long, dst long")
    assert {(r.src, r.dst): r["rank"] for r in vectors.ranks_of(rows, pairs).collect()} == near and max(near.values()) == n - 1


def test_lloyd_is_no_worse_than_one_plain_start(spark):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(4, 6)) * 5
    x = centre[np.arange(200) % 4] + rng.normal(size=(200, 6))
    rows = spark.createDataFrame([(k, r) for k, r in enumerate(x.tolist())], "id long, v array<double>")
    found = vectors.kmeans(rows, 4, starts=6).toPandas().sort_values("id")
    assert all(len(set(found.cluster[k::4])) == 1 for k in range(4)) and found.cluster.nunique() == 4


def test_best_line_of_all_lines(spark):
    entries = spark.createDataFrame([(1, "The Long Run"), (2, "Quiet lake"), (3, "")], "entry_id long, title string")
    bodies = ["nothing here", "## 3. The lang run", "quiet lakes", "the long run", "Quiet Lake", "the long run"]
    lines = spark.createDataFrame([(k, t) for k, t in enumerate(bodies)], "line_no long, line string").repartition(3)
    found = {r.entry_id: (r.line_no, r.score) for r in relational.best_lines(entries, lines, ["line_no"]).collect()}
    assert found == {1: (3, 1.0), 2: (4, 1.0), 3: (0, 0.0)}
    for entry, title in ((1, "The Long Run"), (2, "Quiet lake")):
        assert found[entry][1] == max(text.matching_ratio(title, t) for t in bodies)


def test_longest_common_subsequences_bound_matching_blocks():
    rng = np.random.default_rng(2)
    made = lambda n: "".join(rng.choice(list("abcdeß0é"), n))
    keys = ["", *[made(n) for n in rng.integers(0, 200, 60)]]

    def brute(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            before = 0
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
        return row[-1]

    for key in ("", "a", "xyz", made(63), made(64), made(65), made(150)):
        found = relational.Keys(keys).common(key).tolist()
        assert found == [brute(key, k) for k in keys]
        assert all(f == g if len(k) <= 100 else f >= g for f, g, k in zip(relational.Keys(keys).common(key, 100).tolist(), found, keys, strict=True))
        assert all(text.key_ratio(key, k) <= 2 * f / max(1, len(key) + len(k)) + 1e-12 for k, f in zip(keys, found, strict=True))


def test_a_similarity_is_given_up_only_below_the_least():
    rng = np.random.default_rng(5)
    made = lambda n: "".join(rng.choice(list("abcdefgh"), n))
    for a, b in ((made(rng.integers(1, 80)), made(rng.integers(1, 260))) for _ in range(300)):
        want = len(a) / len(b) if a in b else len(b) / len(a) if b in a else SequenceMatcher(None, a, b).ratio()
        assert text.key_ratio(a, b) == text.key_ratio(a, b, want) == want
        assert text.key_ratio(a, b, want + 0.01) in (want, -1.0)
    assert text.key_ratio("xyxyabcd", "qabcdwwww", 0.6) == -1.0


def test_few_lines_are_compared_by_matching_blocks(spark, monkeypatch):
    """Letters alone, which bounded it before, tell none of these lines from the best."""
    rng = np.random.default_rng(4)
    keys = ["".join(rng.permutation(list("abcdefghijklmnopqrstuvwxyz"))) for _ in range(500)]
    calls = []
    monkeypatch.setattr(text, "key_ratio", lambda a, b, least, plain=text.key_ratio: calls.append(a) or plain(a, b, least))
    group, asked = pd.DataFrame({"key": keys, "line_no": range(500)}), pd.DataFrame({"entry_id": [1], "title": [keys[7][:13] + keys[7][14:]], "floor": [-1.0]})
    assert relational.best_of(group, asked, ["line_no"]).drop(columns="title").iloc[0].tolist() == [1, 50 / 51, 7]
    assert relational.best_of(group, asked.assign(floor=0.99), ["line_no"]).empty
    assert len(calls) < 10


def test_located_items_follow_each_other():
    lines = [(1, 0, "first game"), (1, 1, "second game"), (1, 2, "first game"), (2, 3, "third"), (2, 4, "no")]
    items = [(1, 1, "Second game"), (2, 1, "First game"), (3, 2, "absent title"), (4, 2, "Third")]
    assert relational.located(items, lines) == [(1, 1, 1.0), (2, 2, 1.0), (4, 3, 1.0)]


def test_retry_after(spark):
    now = "TIMESTAMP_NTZ '2026-09-03 00:00:00'"
    cases = [("120", "2026-09-03 00:02:00"), ("-5", "2026-09-03 00:00:00"), (None, "2026-09-03 01:00:00"), ("soon", "2026-09-03 01:00:00"), ("Fri, 04 Sep 2026 00:00:00 GMT", "2026-09-04 00:00:00"), ("Wed, 02 Sep 2026 00:00:00 GMT", "2026-09-03 00:00:00")]
    rows = spark.createDataFrame([(h,) for h, _ in cases], "h string").select(ledger.retry_at(F.col("h"), F.expr(now)).cast("string").alias("r"))
    assert [r.r for r in rows.collect()] == [w for _, w in cases]


def test_pages_of_a_repository_without_pruned_folders(spark, tmp_path):
    for name, body in (("a/x.txt", "one\ntwo"), ("a/.git/y.txt", "no"), ("node_modules/z.txt", "no"), ("b/c/w.txt", "three")):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(body)
    assert sorted(r.value for r in files.repository_lines(spark, str(tmp_path), ("node_modules", ".git")).collect()) == ["one", "three", "two"]


def test_json_arrays_are_whole_files(spark, tmp_path):
    import json

    rows = spark.createDataFrame([(k, "ab"[k % 2], f"t{k}") for k in range(9)], "id int, lang string, body string").repartition(2)
    files.write_json_arrays(rows, str(tmp_path / "out"), "lang")
    found = [r["id"] for f in (tmp_path / "out").rglob("*.txt") for r in json.loads(f.read_text())]
    assert sorted(found) == list(range(9))


def test_faceted_search_is_and_of_ors(spark):
    docs = spark.createDataFrame([(1, "Red Fox", "en"), (2, "red hen", "de"), (3, "red owl", "fr")], "id int, t string, lang string")
    found = relational.faceted(docs, "query=RED&lang=en&lang=de", F.col("t"), {"lang": F.array("lang")})
    assert sorted(r.id for r in found.collect()) == [1, 2]
    assert relational.faceted(docs, "", F.col("t"), {}).count() == 3


def test_monotone_match_rises(spark, sf_dir):
    found = relational.monotone_match(spark, sf_dir).toPandas()
    assert len(found) and (found.score >= 0.52).all()
    for _, g in found.sort_values("number").groupby("conv_id"):
        assert g.position.is_monotonic_increasing and g.position.is_unique


def test_html_blocks_keep_pages_and_skip_figures():
    source = '<span class="pageno" id="Page_3"></span><h3>Title</h3><div class="figcenter"><p>no</p></div><p>one<br>two &amp; three<p>next<span class="pageno" id="Page_4">[4]</span> page</p><li>item</li>'
    assert html_blocks(source) == [("h3", "Title", 3, 3, None), ("p", "one two & three", 3, 3, None), ("p", "next page", 3, 4, None), ("li", "item", 4, 4, None)]
    assert html_blocks(None) == [] and html_blocks("<p>unpaged</p>", paged=True) == []


def test_text_after_footnotes_stays():
    source = '<p>a</p><div class="footnote"><p>note</p><div>deep<br></div></div><p>after</p><h3>H</h3><div class="line"><span class="sc">Small</span> x</div>'
    assert [(b.kind, b.text, b.small_caps) for b in html_blocks(source)] == [("p", "a", None), ("p", "after", None), ("h3", "H", None), ("line", "Small x", "Small")]


def test_front_matter_files(spark, tmp_path):
    (tmp_path / "a.md").write_text("---\nid: x1\nsection: s\n---\n\nBody text\n")
    (tmp_path / "b.md").write_text("no header")
    rows = {r.path[-4:]: r for r in files.read_markdown(spark, str(tmp_path)).collect()}
    assert rows["a.md"].header == {"id": "x1", "section": "s"} and rows["a.md"].body == "Body text"
    assert rows["b.md"].error


def test_exports_and_digests(spark, tmp_path):
    rows = spark.createDataFrame([(1, "en", "x", "hidden"), (2, "de", "y", "hidden")], "id int, lang string, body string, secret string")
    files.write_exports(rows, str(tmp_path / "out"), "lang", ("secret",))
    back = spark.read.json(str(tmp_path / "out"))
    assert set(back.columns) == {"id", "body", "lang"} and back.count() == 2
    files.write_cluster_texts(rows, str(tmp_path / "txt"), "lang", "body")
    assert spark.read.text(str(tmp_path / "txt")).count() == 2
    assert files.hashed_artifacts(spark, str(tmp_path / "out")).where("length(sha256) = 64").count() >= 2


def test_rdf_refuses_entities(spark):
    good = "<r><title>t</title><creator>b</creator><creator>a</creator></r>"
    rows = spark.createDataFrame([(good,), ("<!DOCTYPE x>" + good,)], "x string").select(files.parse_rdf("x").alias("r")).collect()
    assert rows[0].r.creators == ["a", "b"] and rows[1].r is None


def test_connector_pins_hosts_sizes_and_signatures():
    answers = {"https://api.example.org/x": ("https://api.example.org/x", {}, [b"%PDF", b"-1.7 body"]), "https://api.example.org/moved": ("https://other.org/", {}, []), "https://api.example.org/long": ("https://api.example.org/long", {}, [b"%PDF-"] + [b"x" * 60] * 5), "https://api.example.org/said": ("https://api.example.org/said", {"content-length": "900"}, []), "https://api.example.org/odd": ("https://api.example.org/odd", {}, [b"MZ"])}
    c = files.Connector(("api.example.org",), 100, "pdf", lambda url: answers[url])
    assert c.allowed("https://api.example.org/x") and not c.allowed("http://api.example.org/x") and not c.allowed("https://x.api.example.org/")
    assert c.open("https://api.example.org/x") == b"%PDF-1.7 body"
    for url, why in (("https://other.example.org", "host"), ("https://api.example.org/moved", "redirect"), ("https://api.example.org/long", "size"), ("https://api.example.org/said", "size"), ("https://api.example.org/odd", "signature")):
        with pytest.raises(files.Refused, match=why):
            c.open(url)


def test_rate_limit_slots_keep_the_gap(spark):
    rows = spark.sql("SELECT id AS event_id, 'p' AS provider, timestamp_micros(id * 100000) AS ts FROM range(5)")
    got = sorted(r.slot_us for r in ledger.slots(rows, "provider", "ts", 1).collect())
    assert got == [k * 1_000_000 for k in range(5)]


def test_two_level_kmeans_names_are_canonical(spark, sf_dir):
    found = vectors.two_level(spark, sf_dir).toPandas()
    assert found.fine.nunique() == 12 and found.groupby("fine").top.nunique().max() == 1
