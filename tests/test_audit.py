"""Pattern packs: what they refuse, and that signals are those of plain matching."""

import re

import pytest

from weftline.operators import audit, packs


def test_packs_cover_all_dimensions_and_refuse_empty_patterns():
    assert len({p.dimension for p in packs.FACETS}) == 12 and len({p.value for p in packs.SCALES}) == 8
    good = packs.FACETS[0]
    for bad in (good._replace(words=()), good._replace(words=("The",)), good._replace(words=("a b",)), good._replace(regex=""), good._replace(regex="x*"), good._replace(locale="")):
        with pytest.raises(ValueError):
            packs.checked([bad])
    with pytest.raises(ValueError):
        packs.checked([good, good])


def test_any_pack_and_locale_with_quotes_and_phrases(spark):
    pack = packs.checked([packs.Pattern("d", "v", "pl", "one", ("łąka", "las")), packs.Pattern("d", "w", "pl", "two", ("dwa",), r"dwa'? \"x\"")])
    rows = [(1, "s", "pl", "Łąka; lasy"), (2, "s", "pl", "lasy"), (3, "s", "en", "las"), (4, "s", "pl", "DWA' \"x\" las"), (5, "s", "pl", None), (6, "s", None, "las")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, text string")
    assert sorted((r.doc_id, r.pattern) for r in audit.signals(docs, pack).collect()) == [(1, "one"), (4, "one"), (4, "two")]
    assert {(r.value, r.hits, r.unpatterned) for r in audit.covered(docs, pack).collect()} == {("v", 2, 1), ("w", 1, 1)}


def test_signals_are_those_of_plain_matching(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = set()
    for r in docs.collect():
        words = set(re.findall(r"[^\W\d_]+", r.text.lower()))
        want |= {(r.doc_id, p.id) for p in packs.FACETS if p.locale == r.lang and words & set(p.words)}
    assert {(r.doc_id, r.pattern) for r in audit.signals(docs, packs.FACETS).collect()} == want
