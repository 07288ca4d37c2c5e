from pyspark.sql import functions as F

from pageglean import __main__ as command_line
from pageglean.functions.segments import NAME_PREFIXES
from pageglean.plans import jobs
from pageglean.sources import files
from pageglean.sources.store import Store

DAY = "2021-03-01"
NAME = NAME_PREFIXES[1] + "Winter, Ills"


def page(words, *links):
    return f"<html><body><p>{words}</p>" + "".join(f'<a href="{x}">l</a>' for x in links) + "</body></html>"


def site_pages(spark):
    rows = [
        (1, "http://shop.com/", page("welcome", "/flu", "/cold/", "http://other.org/x", "/forums/a")),
        (2, "http://shop.com/flu", page("flu flu shot and fever", "/", "/deep?x=1")),
        (3, "https://www.shop.com/cold/", page("cold cough", "/missing.pdf")),
        (4, "http://shop.com/deep?x=1", page("flu fever cough cold chill")),
        (5, "http://shop.com/island", page("flu")),
        (6, "http://other.org/x", page("flu cough")),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def dimensions(spark):
    keywords = spark.createDataFrame([(i, k) for i, k in enumerate(["flu", "flu shot", "fever", "cold", "cough", "chill"])], "id long, keyword string")
    segment = spark.createDataFrame([(0, 1), (2, 1), (3, 1), (4, 1), (5, 1), (3, 2), (4, 2)], "keyword_id long, custom_segment_id long")
    custom = spark.createDataFrame([(1, NAME, 3), (2, 'DTC "Cold"', 1)], "id long, name string, threshold int")
    return keywords, segment, custom


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_all_jobs(spark, tmp_path):
    pages, (keywords, segment, custom) = site_pages(spark), dimensions(spark)
    log = spark.createDataFrame([(u, 200, "text/html") for u in ("http://shop.com/", "http://shop.com/flu", "http://shop.com/cold", "http://shop.com/deep")]
                                + [("http://shop.com/missing.pdf", 200, "application/pdf")], "url string, status int, content_type string")
    folder = jobs.crawl(pages, "http://shop.com/", str(tmp_path / "urls"), DAY, fetch_log=log)
    urls = files.read_urls(spark, folder)
    assert rows(urls) == [("http://shop.com",), ("http://shop.com/cold",), ("http://shop.com/deep",), ("http://shop.com/flu",)]

    store = Store(spark, str(tmp_path / "mart"), buckets=4)
    more = urls.unionByName(spark.createDataFrame([("other.org/x",)], "page_url string"))
    jobs.classify(store, more, pages, keywords, segment, custom, DAY, "r1")
    maps = {r.page_url: r.keywords for r in store.read("keyword_store").collect()}
    assert maps == {
        "http://shop.com": {}, "http://shop.com/flu": {"flu": 1, "flu shot": 1, "fever": 1}, "http://shop.com/cold": {"cold": 1, "cough": 1},
        "http://shop.com/deep": {"flu": 1, "fever": 1, "cough": 1, "cold": 1, "chill": 1}, "http://other.org/x": {"flu": 1, "cough": 1}}
    assert store.read("site").count() == 5 and store.read("contains").count() == 12
    names = rows(store.read("site_category").select("domain", "custom_segment_name").distinct())
    assert names == [(d, n) for d in ("other.org", "shop.com") for n in ('DTC "Cold"', "Winter Ills")]
    assert store.read("site_category").count() == 6

    # The same day again changes nothing.
    snapshot = {t: rows(store.read(t)) for t in ("site", "contains", "site_category")}
    jobs.classify(store, more, pages, keywords, segment, custom, DAY, "r2")
    assert {t: rows(store.read(t)) for t in snapshot} == snapshot

    warehouse = Store(spark, str(tmp_path / "warehouse"), buckets=4)
    for run in ("w1", "w2"):
        assert jobs.refresh_warehouse(store, warehouse, str(tmp_path / "exports"), "shop.com", DAY, run)
        assert warehouse.read("site").count() == 4 and warehouse.read("contains").count() == 10
    assert not jobs.refresh_warehouse(store, warehouse, str(tmp_path / "exports"), "shop.com", "2020-01-01", "w3")
    assert warehouse.read("site").count() == 4

    jobs.publish_flags(warehouse, keywords, segment, custom, str(tmp_path / "out"), "shop.com", DAY)
    qa = spark.read.option("header", True).csv(str(tmp_path / "out" / "flag_cust_segment_shop_com_qa"))
    final = spark.read.option("header", True).csv(str(tmp_path / "out" / "flag_cust_segment_shop_com_final"))
    assert rows(qa.select("url", "category", "keyword", "numberofkeywords")) == [
        ("http://shop.com/deep", NAME, "chill | cold | cough | fever | flu", "5")]
    assert rows(final) == [("http://shop.com/deep", NAME)]

    jobs.publish_flags(warehouse, keywords, segment, custom, str(tmp_path / "out"), "nobody.com", DAY)
    assert files.read_published(spark, str(tmp_path / "out" / "flag_cust_segment_nobody_com_final"), "url string, category string").count() == 0

    removed = jobs.purge(store, urls, "shop.com", "p1")
    assert removed["site"] == 4 and removed["contains"] == 10
    assert [r.page_url for r in store.read("site").collect()] == ["other.org/x"]
    assert store.read("contains").count() == 2 and store.read("site_category").filter("domain = 'shop.com'").count() == 0
    assert [r.page_url for r in store.read("keyword_store").collect()] == ["http://other.org/x"]
    assert jobs.purge(store, urls, "shop.com", "p2") == {"site": 0, "contains": 0, "site_category": 0}


def test_gate(spark, tmp_path):
    pages, dims = site_pages(spark), dimensions(spark)
    channels = spark.createDataFrame([("http://shop.com/flu", '{"channels":[{"name":"a_health"}]}'),
                                      ("http://shop.com/cold", '{"channels":[{"name":"a_news"}]}')], "url string, response string")
    store = Store(spark, str(tmp_path / "mart"), buckets=2)
    jobs.classify(store, pages.select(F.col("url").alias("page_url")), pages, *dims, DAY, "g1", channels=channels)
    assert [r.page_url for r in store.read("keyword_store").collect()] == ["http://shop.com/flu"]


def test_command_line(spark, tmp_path, monkeypatch):
    tables = dict(zip(("keywords", "segment", "custom-segments"), dimensions(spark)), pages=site_pages(spark))
    options = {}
    for name, df in tables.items():
        options[f"--{name}"] = str(tmp_path / name)
        df.write.parquet(options[f"--{name}"])
    places = {f"--{n}": str(tmp_path / n) for n in ("mart", "warehouse", "exports", "out")}
    day = {"--date": DAY, "--domain": "shop.com"}

    def run(job, *names, **extra):
        known = {**options, **places, **day}
        words = [w for n in names for w in (n, known[n])] + [w for k, v in extra.items() for w in (f"--{k}", v)]
        monkeypatch.setattr("sys.argv", ["pageglean", job, *words])
        command_line.main()

    run("crawl", "--pages", "--date", seed="http://shop.com/", urls=str(tmp_path / "urls"))
    urls = str(tmp_path / "urls" / DAY)
    # Links are kept without the last slash, so the page behind "/" is listed as the bare host.
    run("classify", "--mart", "--pages", "--keywords", "--segment", "--custom-segments", "--date", urls=urls)
    run("refresh", "--mart", "--warehouse", "--exports", "--domain", "--date")
    run("publish", "--warehouse", "--keywords", "--segment", "--custom-segments", "--out", "--domain", "--date", ids="[1]")
    final = files.read_published(spark, str(tmp_path / "out" / "flag_cust_segment_shop_com_final"), "url string, category string")
    assert [r.url for r in final.collect()] == ["http://shop.com/deep"]
    run("purge", "--mart", "--domain", urls=urls)
    assert Store(spark, places["--mart"]).read("site").count() == 0
