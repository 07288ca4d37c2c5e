from pageglean.operators import segments as G

RESULT = "url string, category string, keyword string, flag string, listpoints string, sumofpoints string"


def results(spark, *groups):
    rows = [(u, c, f"k{i}", "1", str(i), "9") for u, c, n in groups for i in range(n)]
    return spark.createDataFrame(rows, RESULT)


def test_thresholds(spark):
    df = results(spark, ("u1", "HCP x", 4), ("u2", "HCP x", 5), ("u3", "DTC x", 2), ("u4", "DTC x", 3),
                 ("u5", "HCP DTC x", 3), ("u6", "other", 9), ("u7", None, 9))
    qa = G.qa_filter(G.qa_rollup(df))
    assert sorted(r.url for r in qa.collect()) == ["u2", "u4", "u5"]


def test_rollups(spark):
    df = results(spark, ("u", "DTC b", 3), ("u", "DTC a", 3))
    qa = G.qa_rollup(df)
    row = qa.filter("category = 'DTC a'").first()
    assert row.keyword == "k0 | k1 | k2" and row.listpoints == "0 | 1 | 2" and row.numberofkeywords == 3
    assert [tuple(r) for r in G.final_rollup(qa).collect()] == [("u", "DTC a | DTC b")]


def test_rows_with_a_missing_value_are_left_out(spark):
    df = spark.createDataFrame([("u", "DTC", "k", None, "1", "1"), ("u", "DTC", "l", "1", "1", "1")], RESULT)
    assert G.qa_rollup(df).first().keyword == "l"


def test_scores(spark):
    contains = spark.createDataFrame([(1, 1, 3), (1, 2, 4), (2, 1, 1)], "site_id int, keyword_id int, points int")
    site = spark.createDataFrame([(1, "u1"), (2, "u2")], "site_id int, page_url string")
    keywords = spark.createDataFrame([(1, "flu"), (2, "cold")], "id int, keyword string")
    segment = spark.createDataFrame([(1, 10), (2, 10), (1, 11), (2, 99)], "keyword_id int, custom_segment_id int")
    custom = spark.createDataFrame([(10, "DTC a", 7), (11, "HCP b", 2)], "id int, name string, threshold int")
    got = {tuple(r) for r in G.segment_scores(contains, site, keywords, segment, custom).collect()}
    assert got == {
        (10, "u1", "DTC a", "cold | flu", "1", "4 | 3", "7"), (11, "u1", "HCP b", "flu", "1", "3", "3"),
        (10, "u2", "DTC a", "flu", "0", "1", "1"), (11, "u2", "HCP b", "flu", "0", "1", "1")}
    assert [r.id for r in G.active_segments(segment, custom).collect()] == [10, 11]
    assert [r.id for r in G.only_ids(custom, "[11]").collect()] == [11] and G.only_ids(custom, "[]").count() == 2


def test_quotes_are_removed(spark):
    df = spark.createDataFrame([('a "b"', 1)], "t string, n int")
    assert tuple(G.publishable(df).first()) == ("a b", 1)
