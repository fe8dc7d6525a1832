"""Queries against their SQL twins on rows that once told them apart."""

from datetime import datetime

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_queries import ORACLES, rows

from weftline import plans
from weftline.llm import jaccard, simhash
from weftline.operators import vectors


@pytest.fixture
def same(spark, tmp_path):
    """same(query, table, schema, rows): the query's rows over that table, which must be its twin's."""

    def run(name, table, schema, data):
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{table}.parquet")
        duck = duckdb.connect()
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
        got = plans.queries()[name](spark, str(tmp_path)).toPandas()
        assert rows(got) == rows(duck.execute(ORACLES[name]).df())
        return got

    return run


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def test_letters_that_stand_for_two_are_ordered_among_them(same):
    words = "ßbe ssa SSau ssc ßd sst sz Sa łan lz æb aez ad éa zß źa żb xya яб αβ".split()
    same("A16_options_by_locale", "documents", DOCUMENTS, [(k, f"{w} x", "de", "src1", 5) for k, w in enumerate(words)])


def test_a_reference_that_the_title_cuts_off_is_text(same):
    pages = [(1, "http://a.b/", "<h1>A &amp</h1>"), (2, "http://a.b/", "<h1>A &amp; b &amp;lt; &copy &x</h1>")]
    got = same("S7_html_blocks", "pages", "page_id long, url string, html string", pages)
    assert "lead A &amp tail" in set(got["text"])


def test_letters_of_large_numbers(same):
    same("T23_alphabetic_index", "documents", DOCUMENTS, [(k, "a", "en", "src1", 1) for k in (0, 25, 26, 701, 702, 129_000, 130_000, 200_000, 1_200_000)])


def test_a_talks_own_first_line_stays(same):
    turns = [(7, 0, "user", "En.\nOne."), (7, 1, "assistant", "En.\nTwo tion goes. On"), (8, 0, "user", "12\nA"), (8, 1, "user", "iv")]
    got = same("T27_page_furniture", "conversations", "conv_id long, turn long, role string, text string", turns)
    assert got["text"].str.startswith("En.").sum() == 2


def test_a_budget_spent_to_the_last_cent(spark, tmp_path):
    """Added as doubles, the first user's values make 2000.0000000000002."""
    values = [303.79, 496.45, 364.89, 328.47, 462.45, 43.95]
    events = [(k, datetime(2024, 1, 1, 0, 0, k), 1, "click", v, "{}") for k, v in enumerate(values)]
    more = [(100, datetime(2024, 1, 1), 2, "click", 1.0, "{}"), (101, datetime(2024, 1, 2), 2, "click", float("inf"), "{}"), (102, datetime(2024, 1, 1), 3, "click", None, "{}"), (103, datetime(2024, 1, 2), 3, "click", -5.0, "{}")]
    spark.createDataFrame(events + more, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    got = {r.event_id: r.spent for r in plans.queries()["W10_running_budget"](spark, str(tmp_path)).collect()}
    assert got == {0: 303.79, 1: 800.24, 2: 1165.13, 3: 1493.6, 4: 1956.05, 5: 2000.0, 100: 1.0, 103: -5.0}


def test_facets_are_told_by_words_pairs_and_endings(same):
    texts = ["Not  on the hill, in. The-and was|of Yes, \nthe\nof them.", "THE.and a1 the 2of the, of", "of the", "", "is it. for;the and x the 'on' it for, on "]
    got = same("C1_pattern_counts", "documents", DOCUMENTS, [(k, t, "en", "src1", 1) for k, t in enumerate(texts)] + [(9, "Der, und das ein. von", "de", "src2", 1)])
    kinds = got["pattern"].str.extract("-(pair|ending)$")[0].fillna("word")
    assert set(kinds) == {"word", "pair", "ending"}


def test_rows_go_to_as_many_tasks_as_the_grid_has_sides(spark, monkeypatch):
    monkeypatch.setattr(vectors, "GRID", 2)
    monkeypatch.setattr(vectors, "BLOCK", 2)
    rows = spark.createDataFrame([(k, k % 3, [float(k), 1.0]) for k in range(60)], "id long, label int, v array<double>")
    blocks = vectors.packed(rows, 2)[0].count()
    met = vectors.self_compared(rows, lambda a, b: [pd.DataFrame({"a": [len(a)], "b": [len(b)]})], "a long, b long", block=2).collect()
    assert blocks > 10 and len(met) <= 4 and sum(r.a * r.b for r in met) == blocks**2


def test_near_dedup_links_by_fingerprints(spark, monkeypatch):
    """Without signatures in common, near texts are found by their fingerprints, and what these join is checked."""
    monkeypatch.setattr(jaccard, "signatures", None)
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(words), " ".join([*words, "more"]), " ".join(words[::-1]), "a b c d e f", "a b c d e g"]
    sets = [jaccard.shingles(t) for t in texts]
    names = [jaccard.name(s) for s in sets]
    distinct = spark.createDataFrame([(n, jaccard.fingerprint(s)) for n, s in zip(names, sets, strict=True)], "set long, fp long")
    near = jaccard.anchored(distinct, simhash.fingerprint_edges)
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    none = spark.createDataFrame([], "signature long, set long, size long")
    found = {tuple(r) for r in jaccard.edges(none, rows, near).collect()}
    assert found == {tuple(sorted(names[:2]))}


def test_blocks_as_read_give_the_pairs_of_all_vectors(spark, sf_dir):
    """blocks were shuffled to every other one, and vectors by term and back as rows."""
    from weftline.operators import sparse

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text").limit(120)
    again = docs.select((docs.doc_id + 1_000_000).alias("doc_id"), F.concat("source", F.lit("x")).alias("source"), "text")
    docs = docs.union(again).union(again.select(again.doc_id + 1_000_000, "source", "text")).union(spark.createDataFrame([(5_000_000, "a", None), (5_000_001, None, "word")], docs.schema)).repartition(3).cache()
    rows = lambda found: sorted((r.left_id, r.right_id, round(r.cosine, 6), r.g1 + r.g2 if r.g1 < r.g2 else r.g2 + r.g1) for r in found.collect())
    want = rows(sparse.all_pairs(sparse.tfidf(docs, title_col="source"), 0.09))
    blocks, n, columns = sparse.tfidf_blocks(sparse.hashed_terms(docs, "doc_id", "source", "text", "source", sparse.TITLES), heavy=50, block=32)
    pairs = sparse.compared(blocks, 0.09, None, lambda r, side: sparse._Counted(r, n, columns, side))
    assert rows(pairs) == want
    assert "Generate" not in pairs._jdf.queryExecution().analyzed().toString()
    first = sorted((-c, x, y) for x, y, c, _ in want)[:50]
    some = spark.createDataFrame([(x, y) for _, x, y in first[::2] + [(0, *r[:2]) for r in want[:40]]], "left_id long, right_id long").distinct()
    for copies in (some, some.limit(3)):
        assert [(-c, x, y) for x, y, c in sparse.best_pairs(blocks, n, columns, copies, 0.5, 50)] == first


def test_repeated_and_missing_ids_are_one_document(spark, tmp_path):
    from weftline.operators import sparse

    rows = [(1, "one two three", "en", "a", 13), (1, "four five", "en", "a", 9), (2, "one two three four five", "en", "b", 23), (None, "six", "en", "c", 3)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    v = sparse.tfidf(spark.read.parquet(f"{tmp_path}/documents.parquet"), title_col="source").toPandas()
    a, b = ({r.term: r.w for r in v[v.id == k].itertuples()} for k in (1, 2))
    found = sparse.tfidf_pairs(spark, str(tmp_path)).collect()
    assert [(r.left_id, r.right_id, r.cosine) for r in found] == [(1, 2, round(sum(w * b.get(t, 0) for t, w in a.items()), 6))]


def test_terms_are_counted_inside_the_row(same, spark, sf_dir):
    """every term of every document was shuffled."""
    plan = plans.queries()["T3_terms_unigrams_bigrams"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    data = [(1, "a b a", "en", "s"), (1, "c a b", "en", "t"), (2, "it's it's", "en", "s"), (3, None, "en", "s"), (4, "", "en", ""), (None, "x y", "en", "s"), (None, "y", "en", "s")]
    same("T3_terms_unigrams_bigrams", "documents", "doc_id long, text string, lang string, source string", data)


def test_pairs_of_a_group_are_dealt_to_cells(same, monkeypatch, spark, tmp_path):
    """a table of one small file had all its pairs made in one task."""
    from weftline.operators import relational

    for name, value in (("HELD", 8), ("PER_CELL", 10)):
        monkeypatch.setattr(relational, name, value)
    parts = [(k if k else None, "p", f"b{k % 3}", None if k % 50 == 7 else "large", k % 2, 900 + k / 7) for k in range(100)]
    got = same("J11_self_theta_join", "part", "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double", [*parts, (200, "p", "b0", "alone", 1, 1.0)])
    found = plans.queries()["J11_self_theta_join"](spark, str(tmp_path)).select(F.spark_partition_id().alias("p")).distinct().count()
    assert len(got) > 1000 and found > 3


def test_lists_are_dealt_to_as_many_tasks_as_rows_ask(same, monkeypatch, spark, tmp_path):
    """a task's memory grew with the table."""
    from weftline.operators import constraints

    monkeypatch.setattr(constraints, "LISTED", 10)
    lines = [(k // 4 if k // 4 else None, 10 + k, k // 4 if k == 17 else k % 3 if k % 5 else None, k % 4, 1000.0 + k, 0.1 * (k % 4) if k % 8 < 4 else 0.3 - 0.05 * (k % 4)) for k in range(120)]
    same("C20_neighbour_integrity", "lineitem", "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_discount double", lines)
    plan = plans.queries()["C20_neighbour_integrity"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and plan.count("Exchange") == 1


def test_distances_of_all_pairs_are_made_twice_only(spark, sf_dir, monkeypatch):
    """an extent, coarse and finer histograms and the sums each made all pairs again."""
    from weftline.operators import layout

    rows = vectors.unit_rows(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).where("id < 300")
    made, compared = [], layout.compared
    monkeypatch.setattr(layout, "compared", lambda *a, **k: made.append(1) or compared(*a, **k))
    found = layout.distance_spearman(rows, 1 << 10).first().spearman
    got = rows.toPandas()
    v = np.array(got["v"].tolist())
    v, unit = vectors.in_plane(v), v / np.linalg.norm(v, axis=1, keepdims=True)
    i, j = np.triu_indices(len(v), 1)
    d1, d2 = (pd.Series(np.round(x, 8)).rank() for x in (1 - (unit @ unit.T)[i, j], np.hypot(*(v[i] - v[j]).T)))
    assert len(made) == 2 and found == pytest.approx(d1.corr(d2), abs=1e-5)


def test_blocks_of_documents_are_dealt_out_and_few_pairs_are_summed(spark, monkeypatch):
    """small blocks were joined to few partitions, and all pairs summed in doubles."""
    from weftline.operators import sparse

    monkeypatch.setattr(sparse, "STRIP", 3)
    docs = [(k, f"s{k % 3}", " ".join(f"w{(k * m) % 23}" for m in range(1, 12)) + (" same words here" if k % 5 else "")) for k in range(80)]
    frame = spark.createDataFrame(docs, "doc_id long, source string, text string")
    hashed = sparse.hashed_terms(frame, "doc_id", "source", "text", "source", sparse.TITLES)
    blocks, n, columns = sparse.tfidf_blocks(hashed, heavy=12, block=4)
    assert blocks.select(F.spark_partition_id().alias("p")).distinct().count() > 3
    weights = {(r.id, r.term): r.w for r in sparse.tfidf(frame, title_col="source").collect()}
    terms = {t: k for k, t in enumerate(sorted({t for _, t in weights}))}
    x = np.zeros((len(docs), len(terms)))
    for (i, t), w in weights.items():
        x[i, terms[t]] = w
    cosine = x @ x.T
    for least in (0.09, 0.6):
        found = {(r.left_id, r.right_id): r.cosine for r in sparse.compared(blocks, least, None, lambda r, side: sparse._Counted(r, n, columns, side)).collect()}
        assert set(found) == {(i, j) for i in range(80) for j in range(i + 1, 80) if i % 3 != j % 3 and cosine[i, j] >= least}
        assert all(abs(c - cosine[p]) < 1e-12 for p, c in found.items())


def test_neighbours_of_short_products_are_those_of_doubles(spark, monkeypatch):
    """all products were doubles; now those that may be among the best are made again, however close they lie."""
    v = np.random.default_rng(3).normal(size=(8, 24)).repeat(25, axis=0)
    v += np.random.default_rng(4).choice([0, 1e-7, 3e-5, 1e-3], size=(len(v), 1)) * np.random.default_rng(5).normal(size=v.shape)
    kinds, add = set(), vectors.Best.add
    monkeypatch.setattr(vectors.Best, "add", lambda self, rough, *a: kinds.add(rough.dtype.name) or add(self, rough, *a))
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    sim = np.round(unit @ unit.T, 8)
    np.fill_diagonal(sim, -np.inf)
    want = {(i, j, r + 1) for i in range(len(v)) for r, j in enumerate(sorted(range(len(v)), key=lambda j: (-sim[i, j], j))[:7])}
    rows = spark.createDataFrame([(k, k % 3, x) for k, x in enumerate(v.tolist())], "id long, label int, v array<double>")
    found = vectors.neighbours(rows, 7, block=32).collect()
    assert {(r.src, r.dst, r.rank) for r in found} == want
    run = []
    monkeypatch.setattr(vectors, "self_compared", lambda rows, best, *a: run.append(best) or vectors.compared(*[vectors.packed(rows)[0]] * 2, len(v), best, a[0]))
    vectors.neighbours(rows, 7)
    packed = vectors.packed(rows)[0].toPandas()
    one = [vectors.Rows(r) for r in packed.itertuples()]
    list(run[0](one, one))
    assert kinds == {"float32"}


def test_connectivity_compares_all_pairs_once(spark, sf_dir):
    """the quantiles' passes each compared all pairs again."""
    plan = plans.queries()["V5_connectivity_outliers"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryTableScan" in plan


def test_phrases_show_in_coverage_samples_and_scales(same, spark, tmp_path):
    """A phrase holds its word, so that words alone decided these results, and phrases changed nothing."""
    texts = ["not", "not the", "not, so", "the not. so", "we and three, so", "two"]
    got = same("C1_facet_coverage", "documents", DOCUMENTS, [(k, t, "en", f"s{k}", 1) for k, t in enumerate(texts)])
    assert got.set_index("value").loc["denied", ["hits", "beside", "ending"]].tolist() == [4, 2, 2]
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    made = {}
    for name in ("C1_pattern_samples", "C2_participant_scales"):
        made[name] = plans.queries()[name](spark, str(tmp_path)).toPandas()
        assert rows(made[name]) == rows(duck.execute(ORACLES[name]).df())
    samples = made["C1_pattern_samples"]
    assert sorted(samples[samples["pattern"] == "en-polarity-denied-pair"]["doc_id"]) == [1, 3]
    scales = made["C2_participant_scales"].set_index("value")
    assert scales.loc[["group", "small-group", "pair"], ["beside", "ending"]].to_numpy().tolist() == [[1, 0], [1, 1], [0, 0]]
