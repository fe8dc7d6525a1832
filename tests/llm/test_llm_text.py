"""Fill-in-middle, periodic runs and toxicity: brute force, round trips, held-out labels, defined cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from weftline import llm
from weftline.llm import common, middles, periods, toxicity

CLASHES = ["row", "t", "i", "made", "example", "runs", "kept", "collapsed", "score", "s", "a.b"]
DOCS = "doc_id long, text string, lang string, " + ", ".join(f"`{c}` string" for c in CLASHES)
LONG = " ".join(random.Random(5).choice(["the", "and", "of"]) for _ in range(30_000))


@pytest.fixture(scope="module")
def odd(spark):
    texts = [(1, "ab cd"), (1, "ab cd"), (2, None), (None, "ab cd"), (3, ""), (4, LONG), (5, " \n\t"), (6, "a" * 60_000), (7, "é<P>😀"), (None, None), (8, "x " * 20_000)]
    return spark.createDataFrame([(i, t, None, *("k" for _ in CLASHES)) for i, t in texts], DOCS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- 11 fill-in-middle


def plain_example(doc_id, text):
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    one, two, three, four = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or three % 100 >= 90:
        return len(units), "plain", None, None, text
    a, b = sorted((one % (len(units) + 1), two % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if four % 100 < 20:
        return len(units), "spm", len(p), len(m), "<S>" + s + "<P>" + p + "<M>" + m
    return len(units), "psm", len(p), len(m), "<P>" + p + "<S>" + s + "<M>" + m


def test_examples_of_the_table(spark, sf_dir):
    got = llm.queries()["op11_fill_in_middle"](spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in common.table(spark, sf_dir, "documents").collect()}
    assert len(got) == len(texts)
    for r in got:
        n, form, before, inside, output = plain_example(r.doc_id, texts[r.doc_id] or "")
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256) == (n, form, before, inside, sha(output))
        assert r.restored_sha256 == sha(texts[r.doc_id] or "")
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_examples_sql_twin(spark, sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    names = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")
    want = con.execute(f"SELECT {', '.join(names)} FROM ({middles.ORACLE['op11_fill_in_middle']})").fetchall()
    assert sorted(map(tuple, llm.queries()["op11_fill_in_middle"](spark, sf_dir).select(*names).collect())) == sorted(want)


@pytest.mark.parametrize("seed", range(3))
def test_any_parts_are_restored(seed):
    r = random.Random(seed)
    for k in range(1500):
        text = "".join(r.choice(["<", "P", "S>", "M", ">", "<S", "a", "é", "\n", "\r\n", "😀"]) for _ in range(r.randint(0, 12)))
        n, form, _, _, output = middles.rearranged(k, text, transformed=100, suffix_first=50)
        assert n == len(re.findall("[A-Za-z]+|[^A-Za-z]", text)) and middles.restored(output, form) == text


def test_examples_defined_cases(spark, odd):
    rows = middles.rearrange(odd).collect()
    assert len(rows) == odd.count() and all(r["a.b"] == "k" and r["example"] == "k" for r in rows)
    for r in rows:
        want = plain_example("" if r.doc_id is None else r.doc_id, r.text or "")
        e = r["example_"]
        assert (e.n, e.form, e.prefix_chars, e.middle_chars, e.output) == want and e.restored_sha256 == sha(r.text or "")
    assert middles.rearrange(odd.limit(0)).count() == 0


# ---- 12 periodic runs


def plain_runs(words, least=6, times=4):
    n, found = len(words), set()
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if i > start and length >= max(least, times * q) and all(any(words[k] != words[k + p] for k in range(start, start + length - p)) for p in range(1, q)):
                found.add((start, length, q))
            if i == start:
                i += 1
    return sorted(found)


@pytest.mark.parametrize("times", [2, 3, 4])
def test_runs_are_those_of_brute_force(times):
    r = random.Random(times)
    for _ in range(700):
        letters = r.randint(1, 4)
        words = [str(r.randrange(letters)) for _ in range(r.randint(0, 50))]
        while words and r.random() < 0.6 and len(words) < 250:
            at, size = r.randrange(len(words)), r.randint(1, 9)
            words = words[:at] + words[at : at + size] * r.randint(2, 7) + words[at:]
        least = 6 if times == 4 else 2
        assert periods.runs_of(words, least, times) == plain_runs(words, least, times)


def test_runs_where_hashes_agree_wrongly(monkeypatch):
    """With hashes modulo 3 most answers of the search are wrong; the words decide."""
    monkeypatch.setattr(periods, "MODULUS", 3)
    r = random.Random(1)
    for _ in range(200):
        root = [r.randrange(3) for _ in range(r.randint(1, 14))]
        words = [r.randrange(3) for _ in range(r.randint(0, 30))] + root * r.randint(1, 6) + [r.randrange(3) for _ in range(r.randint(0, 30))]
        got = periods.runs_of(words)
        assert all(run in plain_runs(words) for run in got)
        agreement = periods.Agreement(words)
        for _ in range(20):
            i, j = sorted(r.sample(range(len(words) + 1), 2)) if len(words) > 1 else (0, 0)
            if i < j:
                k = agreement.right(i, j)
                assert words[i : i + k] == words[j : j + k]
                k = agreement.left(i, j)
                assert words[i - k : i] == words[j - k : j]


def test_runs_in_near_linear_time():
    import time

    a, b = ["a"], ["a", "b"]
    while len(b) < 60_000:
        a, b = b, b + a
    for words in (["a"] * 60_000, ["a", "b"] * 30_000, ["b", "a", "a"] * 20_000, b):
        began = time.time()
        runs = periods.runs_of(words)
        assert time.time() - began < 10
        assert len(set(words)) > 1 and words is b or len(runs) == 1 and runs[0][1] == 60_000


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    dropped = {k for s, length, q in runs for k in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    extra = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *extra, sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(" ".join(w for k, w in enumerate(words) if k not in dropped)))


def test_runs_of_the_table(spark, sf_dir):
    got = {r.doc_id: tuple(r) for r in llm.queries()["op12_lyndon_runs"](spark, sf_dir).collect()}
    docs = common.table(spark, sf_dir, "documents").collect()
    assert len(got) == len(docs)
    short = [r for r in docs if len((r.text or "").split()) < 1500]
    assert len(short) > 150
    for r in short:
        assert got[r.doc_id] == plain_row(r.doc_id, r.text or "")
    assert sum(v[1] > 0 for v in got.values()) > 10


def test_runs_defined_cases(spark, odd):
    rows = periods.find_runs(odd).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert r["runs"] == "k" and r["a.b"] == "k"
        runs = [tuple(x) for x in r["runs_"]]
        if r.doc_id == 8:
            assert runs == [(0, 20_000, 1)] and r["collapsed_"] == "x"
        elif r.doc_id != 4:
            assert runs == [] and r["collapsed_"] == " ".join(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    assert periods.find_runs(odd.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periods.runs_of(["a"], times=1)


# ---- 13 toxicity


def test_gradients_are_slopes(monkeypatch):
    monkeypatch.setattr(toxicity, "BLIND", 0.0)
    rng = np.random.default_rng(3)
    texts, toxic = [["aa", "bca", "aa"] * 20, ["c", "ab", "abc"], [], ["x"] * 30], np.array([1, 0, 1, 0])
    made = {"chars": rng.standard_normal((4, toxicity.CHAR)), "words": rng.standard_normal((3, toxicity.WORD_VECTOR)), **toxicity.Reader.made("char", toxicity.CHAR, toxicity.CHAR_STATE, toxicity.LOOK, rng), **toxicity.Reader.made("word", toxicity.WORD_VECTOR + 2 * toxicity.CHAR_STATE, toxicity.STATE, toxicity.LOOK, rng), "out": rng.standard_normal(2 * toxicity.STATE), "bias": np.full(1, -2.0)}
    net = toxicity.Network(list("abc"), ["aa", "c"], {k: v.astype(np.float64) for k, v in made.items()})

    def logit(words):
        w, words = net.weights, words or [""]
        chars, _ = net.over_chars.read(net.over_chars.projected(w["chars"]), *net.spelled(words))
        inputs = np.concatenate([w["words"][[net.words.get(x, 0) for x in words]], chars], 1)
        pooled, _ = net.over_words.read(net.over_words.projected(inputs), np.arange(len(words))[None], np.array([len(words) if words != [""] else 0]))
        return float(pooled[0] @ w["out"] + w["bias"][0])

    def loss():
        at_window = [np.array([logit(t[s : s + toxicity.WINDOW]) for s in toxicity.windows_of(len(t))]) for t in texts]
        none = np.array([np.log1p(-1 / (1 + np.exp(-z))).sum() for z in at_window])
        return np.where(toxic == 1, -np.log(-np.expm1(none)), -none).mean()

    grads = toxicity._gradients(net, texts, toxic, np.ones(4), rng)
    for name, g in grads.items():
        flat, k = net.weights[name].reshape(-1), int(np.abs(g).argmax())
        kept, step = flat[k], 0.02
        flat[k] = kept + step
        above = loss()
        flat[k] = kept - step
        slope = (above - loss()) / (2 * step)
        flat[k] = kept
        assert slope == pytest.approx(g.reshape(-1)[k], rel=0.05, abs=2e-4), name


def test_scoring_reads_as_training_does():
    rng = np.random.default_rng(5)
    weights = {k: v.astype(np.float32) for k, v in toxicity.Reader.made("word", 9, 6, 5, rng).items()}
    weights |= {k: rng.standard_normal(v.shape).astype(np.float32) for k, v in weights.items() if not v.any()}
    reader, inputs = toxicity.Reader(weights, "word"), rng.standard_normal((40, 9)).astype(np.float32)
    at, lengths = rng.integers(40, size=(90, 11)), rng.integers(0, 12, size=90)
    slow, _ = reader.read(reader.projected(inputs), at, lengths)
    assert np.abs(reader.pooled(reader.halved(inputs), at, lengths) - slow).max() < 1e-3
    x = np.linspace(-9, 9, 10_001).astype(np.float32)
    y = x.copy()
    toxicity._tanh(y)
    assert np.abs(y - np.tanh(x)).max() < 1e-4


def test_windows_cover_all_words():
    for n in range(0, 200):
        starts = toxicity.windows_of(n)
        assert {k for s in starts for k in range(s, min(n, s + toxicity.WINDOW))} == set(range(n))
        assert len(starts) == max(1, -(-(n - toxicity.STRIDE) // toxicity.STRIDE)) and (np.diff(starts) == toxicity.STRIDE).all()
    assert toxicity.words_of("ÄB_c1 " + "x" * 40) == ["äb", "c1", "x" * 16, "x" * 16, "x" * 8]
    assert toxicity.words_of(None) == []


@pytest.fixture(scope="module")
def network(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (common.table(spark, folder, t) for t in ("documents", "labels"))
    texts, toxic = toxicity.sample(docs, labels)
    assert len(set(texts)) == len(texts) and 0 < sum(toxic) <= toxicity.TOXIC
    held = {r.text for r in docs.where(toxicity.held_out()).collect()} - {r.text for r in docs.where(~toxicity.held_out()).collect()}
    assert not held & set(texts)
    return toxicity.learn(texts, toxic, steps=220)


def test_held_out_toxic_texts(spark, network):
    folder = "/root/testdata/sf0.1"
    docs = common.table(spark, folder, "documents").where(toxicity.held_out())
    rows = toxicity.scored(docs.join(common.table(spark, folder, "labels"), "doc_id"), network).where("lang = 'en' AND toxic IS NOT NULL").collect()
    toxic, clean = (np.array([r.score for r in rows if r.toxic == k]) for k in (1, 0))
    assert len(toxic) > 40 and len(clean) > 300
    assert (toxic >= toxicity.THRESHOLD).mean() > 0.8 and (clean >= toxicity.THRESHOLD).mean() < 0.1


def test_one_toxic_window_of_a_long_text_decides(network):
    plain, table = ["the", "of", "and", "onea"] * 4000, [np.zeros((6, 1, toxicity.STATE), np.float32)]
    memory: dict[str, int] = {}
    base, high = network.logits([plain, plain[:9000] + ["idiot", "moron", "trash", "scum", "loser"] + plain[9000:]], memory, table)
    assert high > base + 1


def test_toxicity_defined_cases(spark, odd, network):
    rows = toxicity.scored(odd, network).collect()
    assert len(rows) == odd.count() and all(r["score"] == "k" and 0 <= r["score_"] <= 1 for r in rows)
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r.text or "", r["score_"]) == r["score_"]
    again = {r.text or "": r["score_"] for r in toxicity.scored(odd.repartition(3), network).collect()}
    assert all(abs(again[t] - s) < 1e-4 for t, s in by_text.items())
    assert toxicity.scored(odd.limit(0), network).count() == 0
    assert {r["score_"] for r in toxicity.scored(odd, None).collect()} == {0.0}
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.sample(odd, none) == ([], []) and toxicity.learn(["a"], [1]) is None
    some = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (8, 0), (4, None)], "doc_id long, toxic int")
    texts, toxic = toxicity.sample(odd, some)
    held = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in (1, 8)}
    assert sorted(toxic) == sorted([1, 0] * (not held[1]) + [0] * (not held[8]))
    assert toxicity.learn(["", ""], [1, 0], steps=2) is not None
