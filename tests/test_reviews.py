"""Agreement of clusterings by its definition, and rules that the tables at hand break in few ways."""

from itertools import combinations

import numpy as np
import pytest

from weftline.operators import reviews


def test_adjusted_rand_is_that_of_all_pairs(spark):
    rng = np.random.default_rng(2)
    rows = [(int(a), int(b)) for a, b in zip(rng.integers(4, size=80), rng.integers(3, size=80), strict=True)]
    both = one = two = 0
    for (a, b), (c, d) in combinations(rows, 2):
        both, one, two = both + (a == c and b == d), one + (a == c), two + (b == d)
    n = 80 * 79 / 2
    want = (both - one * two / n) / ((one + two) / 2 - one * two / n)
    frame = spark.createDataFrame(rows, "a long, b long")
    assert reviews.adjusted_rand(frame, "a", "b").first().ari == pytest.approx(want)
    assert reviews.adjusted_rand(frame, "a", "a").first().ari == pytest.approx(1)
    found = reviews.seed_agreement(spark, "/root/testdata/sf0.001", k=4, seeds=(1, 2)).collect()
    assert len(found) == 1 and -1 <= found[0].ari <= 1


def test_manifest_errors(spark):
    blocks = spark.createDataFrame([("b", k, t) for k, t in enumerate(["One x", "two", "One y", "End"])], "book string, pos long, text string")
    entries = [("b", "fine", "One", "End"), ("b", "early", "two", "One"), ("b", "gone", "none", "End"), ("b", "open", "End", "two"), ("b", "twice", "One", "End"), ("b", "twice", "two", "End"), ("c", "far", "One", "End")]
    manifest = spark.createDataFrame(entries, "book string, id string, start_heading string, end_heading string")
    got = {r.id: (r.error, r.start, r.blocks) for r in reviews.selected(blocks, manifest).where("id <> 'twice'").collect()}
    assert got == {"fine": (None, 0, 3), "early": (None, 1, 1), "gone": ("start", None, 0), "open": ("end", 3, 0), "far": ("start", None, 0)}
    assert {r.error for r in reviews.selected(blocks, manifest).where("id = 'twice'").collect()} == {"repeated id"}
