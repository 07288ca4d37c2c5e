import gzip
import os

import pytest
from pyspark.sql import functions as F

from pageglean.sources import files
from pageglean.sources.store import Change, ChangedMeanwhile, Store


def part_files(folder):
    return sorted(f for f in os.listdir(folder) if f.endswith(".csv.gz"))


def test_parts_roundtrip(spark, tmp_path):
    folder = str(tmp_path / "2021-01-01")
    urls = spark.range(0, 6001, 1, 7).select(F.concat(F.lit("http://h/"), "id").alias("page_url"))
    files.write_url_parts(urls, folder)
    sizes = []
    for name in part_files(folder):
        with gzip.open(f"{folder}/{name}", "rt") as f:
            lines = f.read().splitlines()
        assert lines[0] == "page_url"
        sizes.append(len(lines) - 1)
    assert sorted(sizes) == [1001, 2500, 2500]
    back = files.read_urls(spark, folder)
    assert back.count() == back.distinct().count() == 6001


def test_url_scan_is_tolerant(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    with gzip.open(folder / "a.csv.gz", "wt") as f:
        f.write('page_url,n\nhttp://a,1\nhttp://bad,1,2,3\n"http://q,""x""",2\n,3\n')
    (folder / "other.csv").write_text("page_url,n\nhttp://no,1\n")
    with gzip.open(folder / "b.csv.gz", "wt") as f:
        f.write("page_url,n\nhttp://b,1\nhttp://bad2,1,,\n")
    got = [r.page_url for r in files.read_urls(spark, str(folder), str(tmp_path / "bad")).collect()]
    assert "http://bad" not in got and "http://no" not in got
    assert "http://a" in got and len(got) == 4
    report = {os.path.basename(r.file): (r.good, r.bad, r.urls) for r in files.scan_report(files.scan_urls(spark, str(folder))).collect()}
    assert report == {"a.csv.gz": (3, 1, 2), "b.csv.gz": (1, 1, 1)}
    kept = spark.read.json(str(tmp_path / "bad")).collect()
    assert sorted((os.path.basename(r.file), r.bad_line) for r in kept) == [("a.csv.gz", "http://bad,1,2,3"), ("b.csv.gz", "http://bad2,1,,")]


def test_keyword_list_roundtrip(spark, tmp_path):
    words = ["flu", "heart attack", 'say "x"']
    df = spark.createDataFrame([(w,) for w in words], "keyword string")
    files.write_keyword_list(df.coalesce(1), str(tmp_path / "k"))
    assert sorted(r[0] for r in files.read_keyword_list(spark, str(tmp_path / "k")).collect()) == sorted(words)


def test_export_roundtrip(spark, tmp_path):
    rows = [(1, 'http://a/"q",x', None), (2, "b\\c", 3)]
    schema = "site_id bigint, page_url string, points int"
    files.write_export(spark.createDataFrame(rows, schema), str(tmp_path / "e"))
    assert sorted(tuple(r) for r in files.read_export(spark, str(tmp_path / "e"), schema).collect()) == rows


def test_results_and_publishing(spark, tmp_path):
    rows = [(1, "u", "DTC a, b", "k", "1", "2", "3"), (2, "u", 'HCP "c"', "k", "0", "2", "2")]
    schema = "custom_segment_id bigint, url string, category string, keyword string, flag string, listpoints string, sumofpoints string"
    folder = str(tmp_path / "r")
    files.write_results(spark.createDataFrame(rows, schema), folder)
    assert sorted(d for d in os.listdir(folder) if d.startswith("custom")) == ["custom_segment_id=1", "custom_segment_id=2"]
    back = files.read_results(spark, folder)
    assert sorted((r.custom_segment_id, r.category) for r in back.collect()) == [(1, "DTC a, b"), (2, 'HCP "c"')]
    files.publish(back.select("url", "category"), str(tmp_path / "p"))
    published = spark.read.option("header", True).csv(str(tmp_path / "p"))
    assert sorted(r.category for r in published.collect()) == ["DTC a, b", "HCP c"]


def test_expired_results_are_dropped(spark, tmp_path):
    for day in ("2021-01-03", "2021-01-04", "2021-01-10"):
        (tmp_path / f"run_date={day}").mkdir()
    files.drop_expired(spark, str(tmp_path), "2021-01-11")
    assert sorted(os.listdir(tmp_path)) == ["run_date=2021-01-10"]


def sites(spark, store, n=40, day="2021-03-05"):
    urls = spark.range(n).select(F.concat(F.lit("http://h"), F.col("id") % 10, F.lit(".com/"), "id").alias("page_url"))
    when = F.lit(day).cast("date")
    return urls.select(F.xxhash64("page_url").alias("site_id"), "page_url", when.alias("last_scrapped_date"), when.alias("current_dates"),
                       store.bucket_of_url(F.col("page_url")).alias("bucket"))


def test_store_replaces_only_named_partitions(spark, tmp_path):
    store = Store(spark, str(tmp_path / "m"), buckets=4)
    assert store.read("site").count() == 0
    site = sites(spark, store)
    assert store.append("run0", "site", site) == 40
    assert store.read("site").count() == 40
    first = store.touched(site)[0]
    before = {b: f for b, f in store.snapshot().folders["site"].items() if b != str(first)}
    half = store.read("site", [first]).filter(F.endswith("page_url", F.lit("1")))
    kept = half.count()
    assert store.replace("run1", {"site": half}, [first]) == {"site": kept}
    assert store.read("site", [first]).count() == kept
    assert {b: f for b, f in store.snapshot().folders["site"].items() if b != str(first)} == before
    store.replace("run2", {"site": store.read("site", [first]).filter("false")}, [first])
    assert store.read("site", [first]).count() == 0
    assert store.read("site").columns == ["site_id", "page_url", "last_scrapped_date", "current_dates", "bucket"]


def test_a_change_that_stops_between_tables_is_not_seen(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "m"), buckets=2)
    site = sites(spark, store)
    facts = site.select("site_id", F.lit(1).alias("fact_id"), F.lit(1).alias("keyword_id"), F.lit(1).alias("points"), "current_dates", "bucket")
    tags = site.select("site_id", F.lit(1).alias("s_c_id"), F.lit("d").alias("domain"), F.lit("c").alias("custom_segment_name"), "current_dates", "bucket")
    tables = {"site": site, "contains": facts, "site_category": tags}
    store.replace("r1", tables, [0, 1])
    old = {t: sorted(map(tuple, store.read(t).collect())) for t in tables}
    reader = {t: store.read(t) for t in tables}

    class Stopped(Exception):
        pass

    fitted = Store._fitted

    def stop(self, table, rows):
        if table == "site_category":
            raise Stopped
        return fitted(self, table, rows)

    monkeypatch.setattr(Store, "_fitted", stop)
    with pytest.raises(Stopped):
        store.replace("r2", {t: rows.filter("false") for t, rows in tables.items()}, [0, 1])
    monkeypatch.undo()
    assert {t: sorted(map(tuple, store.read(t).collect())) for t in tables} == old
    # The same run again goes through, and a reader that was there before still has what it had.
    assert store.replace("r2", {t: rows.filter("false") for t, rows in tables.items()}, [0, 1]) == dict.fromkeys(tables, 0)
    assert {t: store.read(t).count() for t in tables} == dict.fromkeys(tables, 0)
    assert {t: sorted(map(tuple, rows.collect())) for t, rows in reader.items()} == old
    # What is named by no state any more goes.
    assert len(store.clean(keep=1)) >= 3 and store.read("site").count() == 0


def test_of_two_changes_at_once_the_later_is_refused(spark, tmp_path):
    store = Store(spark, str(tmp_path / "m"), buckets=2)
    site = sites(spark, store)
    store.append("r1", "site", site.limit(3))
    before = store.snapshot()
    store.append("r2", "site", site.limit(4))
    with pytest.raises(ChangedMeanwhile):
        store.change("r3", {"site": Change(site)}, before)
    assert store.read("site").count() == 7 and store.read("site", at=before).count() == 3


def test_a_day_reads_its_month_only(spark, tmp_path):
    store = Store(spark, str(tmp_path / "m"), buckets=2)
    store.append("r1", "site", sites(spark, store, 10, "2021-03-05").unionByName(sites(spark, store, 20, "2021-04-05")))
    month = store.read("site", day="2021-03-31")
    assert month.count() == 10 and store.read("site").count() == 30
    plan = month._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "= 202103)" in plan
