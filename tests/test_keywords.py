import random

from pyspark.sql import functions as F

from pageglean.functions import text as X
from pageglean.operators import keywords as K
from pageglean.operators.bloom import key_filter, may_hold


def greedy(words, vocab):
    """Plain reading of the rule, to compare with."""
    out, i, longest = [], 0, max(len(k.split(" ")) for k in vocab)
    while i < len(words):
        for n in range(min(longest, len(words) - i), 0, -1):
            if " ".join(words[i:i + n]) in vocab:
                out.append((i, n, " ".join(words[i:i + n])))
                i += n
                break
        else:
            i += 1
    return out


def token_frame(spark, lists):
    return spark.createDataFrame([(i, f"u{i}", f, t) for i, f, t in lists], "page_id int, url string, field string, tokens array<string>")


def vocab_frame(spark, words):
    return spark.createDataFrame([(w,) for w in words], "keyword string")


def matches(spark, lists, words, **options):
    rows = K.phrase_matches(token_frame(spark, lists), vocab_frame(spark, words), **options).collect()
    return sorted((r.page_id, r.field, r.pos, r.n, r.keyword) for r in rows)


def test_matches_equal_a_plain_reading_of_the_rule(spark):
    rng = random.Random(7)
    words = "a b c d e".split()
    vocab = {" ".join(rng.choices(words, k=rng.randint(1, 4))) for _ in range(25)}
    lists = [(i, f, rng.choices(words + ["x"], k=rng.randint(0, 60))) for i in range(40) for f in ("title", "body")]
    want = sorted((i, f, *m) for i, f, t in lists for m in greedy(t, vocab))
    assert matches(spark, lists, vocab) == want
    # The same with the vocabulary broadcast.
    assert matches(spark, lists, vocab, small=True) == want


def test_long_keywords(spark):
    """Keywords of up to 40 words, of which some are the beginnings of others."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(6)]
    text = rng.choices(words, k=400)
    vocab = {" ".join(text[i:i + n]) for i, n in [(3, 40), (3, 1), (3, 7), (50, 17), (50, 15), (90, 16), (120, 8), (200, 9), (300, 30), (301, 4)]} | {" ".join(text[3:20] + ["no"])}
    lists = [(1, "body", text), (2, "body", text[40:] + text[:60]), (3, "title", text[:43]), (4, "title", text[:42])]
    assert matches(spark, lists, vocab) == sorted((i, f, *m) for i, f, t in lists for m in greedy(t, vocab))


def test_runs_longer_than_a_chunk(spark, monkeypatch):
    monkeypatch.setattr(K, "_CHUNK", 3)
    rng = random.Random(4)
    vocab = {"a a", "a b a", "b a", "a a a b"}
    lists = [(i, "body", rng.choices("ab", k=200)) for i in range(10)]
    assert matches(spark, lists, vocab) == sorted((i, f, *m) for i, f, t in lists for m in greedy(t, vocab))


def test_empty_vocabulary_and_no_tokens(spark):
    assert matches(spark, [(1, "body", ["a"]), (2, "body", [])], ["zz"]) == []
    empty = vocab_frame(spark, ["a"]).limit(0)
    assert K.phrase_matches(token_frame(spark, [(1, "body", ["a"])]), empty).count() == 0
    assert [r.term for r in K.terms_not_in_vocabulary(token_frame(spark, [(1, "body", ["a", "a"])]), empty).collect()] == ["a"]


def test_one_long_run_of_overlaps(spark):
    # More occurrences than one batch holds.
    text = ["th"] * 30_001
    assert matches(spark, [(1, "body", text)], ["th th"]) == [(1, "body", p, 2, "th th") for p in range(0, 30_000, 2)]


def test_phrases_do_not_span_fields(spark):
    assert matches(spark, [(1, "title", ["a"]), (1, "body", ["b"])], ["a b"]) == []


def test_tokens(spark):
    cases = {
        "The heart-attack, of (a) MAN_man!": ["heart-attack", "man", "man"],
        "x of z": ["x", "z"],
        "don't  can't stop　now go—on": ["can't", "stop", "go—on"],
        "a.b|c\\d[e]f^g{h}`i`": ["b", "c", "e", "f", "g", "h", "`i`"],
        "": [], " , ": [],
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", X.tokens(F.col("t")).alias("w"))
    assert {r.t: r.w for r in df.collect()} == cases


def test_vocabulary(spark):
    words = ["Heart Attack", "heart attack ", "new\nline", "", "  ", "flu"]
    assert sorted(r[0] for r in K.vocabulary(vocab_frame(spark, words)).collect()) == ["flu", "heart attack"]


def test_classify_counts_every_field(spark):
    pages = spark.createDataFrame([
        (1, "u1", '<html><head><title>Flu shot</title><meta name="keywords" content="flu"><meta name="description" value="flu">'
                  "<script>flu</script></head><body>The flu of flu shots; flu shot</body></html>"),
        (2, "u2", "<p>nothing</p>"),
    ], "page_id int, url string, html string")
    counts = K.classify_pages(pages, vocab_frame(spark, ["flu", "flu shot", "the flu"]))
    assert sorted((r.url, r.keyword, r.points) for r in counts.collect()) == [("u1", "flu", 4), ("u1", "flu shot", 2)]
    assert K.keyword_map(counts).first().keywords == {"flu": 4, "flu shot": 2}
    few = K.classify_pages(pages, vocab_frame(spark, ["flu", "flu shot"]), at_least=3)
    assert [r.keyword for r in few.collect()] == ["flu"]


def test_terms_outside_matches(spark):
    tokens = token_frame(spark, [(1, "body", "a b c b".split()), (1, "title", ["b"]), (2, "title", "a b".split())])
    terms = K.terms_not_in_vocabulary(tokens, vocab_frame(spark, ["a b"]))
    assert sorted((r.page_id, r.term) for r in terms.collect()) == [(1, "b"), (1, "c")]


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_terms_read_the_pages_once(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    terms = K.terms_not_in_vocabulary(K.field_tokens(K.page_fields(pages)), vocab_frame(spark, ["der", "de la"]))
    reused = [line for line in executed(terms).splitlines() if "ReusedExchange" in line]
    assert any("text#" in line for line in reused)


def test_matching_stays_in_the_jvm_and_shuffles_occurrences_only(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    tokens = K.field_tokens(K.page_fields(pages))
    before = spark.sparkContext._jsc.sc().dagScheduler().nextJobId()
    counts = K.keyword_counts(K.phrase_matches(tokens, vocab_frame(spark, ["der", "de la"])))
    assert spark.sparkContext._jsc.sc().dagScheduler().nextJobId() == before
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert not any(name in plan for name in ("EvalPython", "InArrow", "InPandas"))
    assert plan.count("Exchange hashpartitioning(page_id") == 2
    shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert not any("tokens" in line or "marked" in line for line in shuffled)


def test_places_are_shuffled_without_the_columns_of_their_page(spark):
    """Rows of the shuffles before the counts hold a page's URL once per field, not once per place."""
    url = "http://example.net/" + "x" * 200
    df = spark.createDataFrame([(1, url, "body", ["a", "b"] * 50), (1, url, "title", ["b"]), (2, None, "body", ["a"]), (None, url, "body", ["a", "c"])],
                               "page_id int, url string, field string, tokens array<string>")
    vocab = vocab_frame(spark, ["a", "b a"])
    rows = K.occurrences(K._places(K._addressed(df, ("page_id", "url")), vocab, False), vocab)
    assert "url" not in rows.columns
    assert sorted((r.n, r.who.field) for r in rows.filter("who IS NOT NULL").collect()) == [(-1, "body")] * 3 + [(-1, "title")]
    found = K.phrase_matches(df, vocab).groupBy("page_id", "url", "field", "keyword").count().collect()
    assert {tuple(r) for r in found} == {(1, url, "body", "a", 1), (1, url, "body", "b a", 49), (2, None, "body", "a", 1), (None, url, "body", "a", 1)}
    terms = K.terms_not_in_vocabulary(df, vocab).collect()
    assert {tuple(r) for r in terms} == {(1, url, "b"), (None, url, "c")}


def test_places_reach_no_further_than_the_longest_keyword(spark, monkeypatch):
    """A filter that lets everything pass makes no more places than words times the words of the longest keyword."""
    monkeypatch.setattr(K, "key_filter", lambda hashes, column: F.array_repeat(F.lit(-1).cast("long"), 1 << 15))
    lists = [(1, "body", ["a", "b"] * 150), (2, "title", ["b"])]
    vocab = vocab_frame(spark, ["a b", "b"])
    places = K._places(K._addressed(token_frame(spark, lists), ("page_id", "url")), vocab, False)
    assert places.filter("n > 0").count() == 300 + 299 + 1
    assert matches(spark, lists, ["a b", "b"]) == [(1, "body", p, 2, "a b") for p in range(0, 300, 2)] + [(2, "title", 0, 1, "b")]


def test_the_filter_grows_with_its_keys(spark):
    hashes = spark.range(800_000).select(F.xxhash64("id").alias("h"), (F.col("id") < 400_000).alias("key"))
    passes = hashes.withColumn("passes", may_hold(key_filter(hashes.filter("key"), "h"), F.col("h"))).groupBy("key", "passes").count()
    found = {(r.key, r.passes): r["count"] for r in passes.collect()}
    assert found[True, True] == 400_000 and (True, False) not in found
    assert found.get((False, True), 0) < 8_000


def test_a_token_leaves_the_scan_once_for_the_terms(spark):
    lists = [(1, "body", "a b c b".split()), (2, "title", "a x a".split())]
    rows = K._places(K._addressed(token_frame(spark, lists), ("page_id", "url")), vocab_frame(spark, ["a", "b c"]), True)
    assert sorted((r.page_id, r.text) for r in rows.filter("n IN (0, 1)").collect()) == [(1, "a"), (1, "b"), (1, "b"), (1, "c"), (2, "a"), (2, "a"), (2, "x")]


def test_terms_are_dealt_by_page_once(spark):
    tokens = token_frame(spark, [(1, "body", "a b c b".split()), (1, "title", ["b"]), (2, "title", "a b".split())])
    plan = K.terms_not_in_vocabulary(tokens, vocab_frame(spark, ["a b"]))._jdf.queryExecution().executedPlan().toString()
    assert not any("Exchange hashpartitioning" in line and "term#" in line for line in plan.splitlines())


def test_counts_are_dealt_by_page(spark):
    plan = K.keyword_counts(K.phrase_matches(token_frame(spark, [(1, "body", ["a"])]), vocab_frame(spark, ["a"])))._jdf.queryExecution().executedPlan().toString()
    keys = [line.split("hashpartitioning(")[1].split("), ")[0] for line in plan.splitlines() if "Exchange hashpartitioning(page_id" in line]
    assert len(keys) == 2 and not any("keyword#" in k for k in keys)
