"""Very frequent passages: all repeats, without a row for each window of each text."""

from pageglean.llm import substrings
from test_operators import plain_repeats, sentence


def test_equal_segments_are_cut_into_windows_once(spark, monkeypatch):
    passage, cut, seen = sentence(31, 60), substrings._windows, []

    def spied(segments, window):
        seen.append(segments.count())
        return cut(segments, window)

    monkeypatch.setattr(substrings, "_windows", spied)
    rows = [(i, f"{sentence(1000 + i, 15)} {passage} {sentence(2000 + i, 15)}" if i % 9 else f"{passage} {passage}") for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substrings.remove_repeats(df, group=4).collect())
    assert got == sorted((str(k[0]), *v) for k, v in plain_repeats(rows).items())
    # Once for each anchor of the passage, besides those at its ends, which each text follows by other words.
    assert len(seen) == 1 and seen[0] < 4 * len(rows)
