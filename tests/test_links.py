import random
from collections import deque

import pytest

from pageglean.operators import links as L


def walk(edges, seeds):
    depth, queue = {}, deque((s, 0) for s in seeds)
    out = {}
    for s, d in edges:
        out.setdefault(s, set()).add(d)
    while queue:
        node, d = queue.popleft()
        for nxt in out.get(node, ()):
            if nxt not in depth:
                depth[nxt] = d + 1
                queue.append((nxt, d + 1))
    return depth


@pytest.mark.parametrize("buckets", [1, 3, 8])
def test_closure_equals_a_plain_walk(spark, buckets):
    rng = random.Random(3)
    edges = [(f"n{rng.randrange(60)}", f"n{rng.randrange(60)}") for _ in range(90)] + [(f"n{i}", "hub") for i in range(60)]
    links = spark.createDataFrame(edges, "src_url string, dst_url string")
    seeds = spark.createDataFrame([("n1",), ("n2",)], "url string")
    got = {r.url: r.depth for r in L.site_closure(links, seeds, buckets=buckets).collect()}
    assert got == walk(edges, ["n1", "n2"])


def test_a_long_chain(spark):
    links = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(8)], "src_url string, dst_url string")
    seeds = spark.createDataFrame([("n0",)], "url string")
    assert {r.url: r.depth for r in L.site_closure(links, seeds).collect()} == {f"n{i}": i for i in range(1, 9)}


def test_seed_is_reached_only_by_a_link_back(spark):
    seeds = spark.createDataFrame([("a",)], "url string")
    there = spark.createDataFrame([("a", "b"), ("b", "c")], "src_url string, dst_url string")
    back = spark.createDataFrame([("a", "b"), ("b", "a")], "src_url string, dst_url string")
    assert {r.url: r.depth for r in L.site_closure(there, seeds).collect()} == {"b": 1, "c": 2}
    assert {r.url: r.depth for r in L.site_closure(back, seeds).collect()} == {"b": 1, "a": 2}
    assert [r.url for r in L.site_closure(there, seeds, max_depth=1).collect()] == ["b"]
    nowhere = spark.createDataFrame([("z",)], "url string")
    assert L.site_closure(there, nowhere).collect() == []


def test_parts_are_full_and_hold_every_url_once(spark):
    urls = [(f"http://h/{i}",) for i in range(10_001)] + [("http://h/1",), (None,)]
    parts = L.url_parts(spark.createDataFrame(urls, "page_url string"), rows=1000).collect()
    sizes = {}
    for r in parts:
        sizes[r.part] = sizes.get(r.part, 0) + 1
    assert len({r.page_url for r in parts}) == len(parts) == 10_001
    assert [sizes[i] for i in range(11)] == [1000] * 10 + [1]


def test_fetchable(spark):
    log = spark.createDataFrame(
        [("a", 200, "text/html"), ("b", 404, "text/html"), ("c", 301, "application/pdf"), ("d", 403, "application/xhtml+xml")],
        "url string, status int, content_type string")
    assert sorted(r.url for r in L.fetchable(log).collect()) == ["a", "d"]


def test_a_round_is_one_job_and_moves_no_edge(spark, tmp_path):
    """From the second round on nothing but link targets is shuffled."""
    spark.sparkContext.setJobGroup("closure", "closure")
    links = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(6)], "src_url string, dst_url string")
    rounds, plans, write = [], [], L.Observation

    class Counting(write):
        def __init__(self):
            rounds.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup("closure")))
            super().__init__()

    L.Observation = Counting
    try:
        reached = L.site_closure(links, spark.createDataFrame([("n0",)], "url string"), buckets=4)
    finally:
        L.Observation = write
        spark.sparkContext.setJobGroup("", "")
    assert reached.count() == 6
    # A job for the shuffle that adaptive execution waits for, and one for the write.
    assert {b - a for a, b in zip(rounds[2:], rounds[3:])} == {2}
    # A round's joins, whose sides are stored tables.
    name = reached._jdf.queryExecution().analyzed().toString().split("closure_")[1][:32]
    edges, urls = spark.table(f"closure_{name}_edges"), spark.table(f"closure_{name}_urls")
    sources = urls.filter("depth = 2").selectExpr("url AS src_url").hint("merge")
    found = edges.join(sources, "src_url", "left_semi").selectExpr("dst_url AS url").distinct()
    plan = found.join(urls.filter("depth > 0").select("url").hint("merge"), "url", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
