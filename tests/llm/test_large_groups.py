"""Large groups of near copies: all links, without rows for all their pairs."""

import random

import pytest

from pageglean.llm import jaccard_join as J
from test_operators import plain_near, sentence


def near_group(n, words, changes, seed):
    """Texts with some other words each: pairs are as alike as not."""
    rng, first, out = random.Random(seed), sentence(seed, words).split(), []
    for i in range(n):
        text = list(first)
        for at in rng.sample(range(words), rng.randint(0, changes)):
            text[at] = f"other{seed}x{i}x{at}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("between, pivots", ((4096, 16), (0, 1), (3, 1), (6, 2)))
def test_links_of_large_buckets(spark, monkeypatch, between, pivots):
    monkeypatch.setattr(J, "BETWEEN", between)
    monkeypatch.setattr(J, "PIVOTS", pivots)
    shared = sentence(77, 12)
    texts = near_group(30, 100, 4, 1) + near_group(30, 100, 4, 2) + [f"{shared} {t}" for t in near_group(20, 60, 3, 3)] + [f"{shared} {sentence(s, 40)}" for s in range(200, 220)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r["doc_id"]), str(r["class_id"]), r["n_links"]) for r in J.near_duplicates(df, bucket=4, depth=2).collect())
    assert got == plain_near(rows)


def test_a_large_group_that_hangs_together_is_not_split(spark, monkeypatch):
    monkeypatch.setattr(J, "BETWEEN", 40)
    texts = near_group(200, 140, 8, 5)
    sketches = [J.sketch(s).astype("uint16").tobytes() for s in J.shingle_sets(texts)]
    rows = [(1, i, bytearray(s), len(texts), 0) for i, s in enumerate(sketches)]
    large = spark.createDataFrame(rows, "path long, node long, sketch binary, n long, pivot long")
    rest, _ = J._around_pivots(large, 82, 4)
    assert rest.count() == 0
