"""Segment results of pages, their rollups, and the published files' content."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pageglean.functions import segments as S
from pageglean.operators.joins import lookup

RESULT_COLUMNS = ("url", "category", "keyword", "flag", "listpoints", "sumofpoints")
_BAR = " | "


def active_segments(segment: DataFrame, custom_segments: DataFrame) -> DataFrame:
    """Ids of the segments that have keywords and a definition, in order."""
    used = segment.select(F.col("custom_segment_id").alias("id")).distinct()
    return used.join(custom_segments.select("id"), "id", "left_semi").orderBy("id")


def segment_lookup(ids: DataFrame, custom_segments: DataFrame) -> DataFrame:
    """Threshold and name of these segments."""
    return custom_segments.select("id", "threshold", "name").join(ids.select("id").distinct(), "id", "left_semi")


def only_ids(custom_segments: DataFrame, id_list: str) -> DataFrame:
    """Segments on a list literal of ids; an empty list means all of them."""
    ids = S.id_list(F.lit(id_list))
    return custom_segments.filter((F.size(ids) == 0) | F.array_contains(ids, F.col("id").cast("bigint")))


def _hits(contains: DataFrame, keywords: DataFrame, segment: DataFrame, custom_segments: DataFrame) -> DataFrame:
    """Facts with the segments of their keyword, moved once, to the place of their page."""
    names = custom_segments.select(F.col("id").alias("custom_segment_id"), "threshold", F.col("name").alias("category"))
    words = lookup(segment.join(keywords.select(F.col("id").alias("keyword_id"), "keyword"), "keyword_id"),
                   names.filter(F.col("category").isNotNull()), "custom_segment_id")
    facts = contains.select("site_id", "keyword_id", F.col("points").cast("bigint").alias("points"))
    return lookup(facts, words, "keyword_id").drop("keyword_id").repartition("site_id")


def _flag(total):
    return F.when(total >= F.col("threshold"), "1").otherwise("0").alias("flag")


def segment_rows(contains: DataFrame, site: DataFrame, keywords: DataFrame, segment: DataFrame,
                 custom_segments: DataFrame) -> DataFrame:
    """Result of every segment at once, a row per page, segment and keyword.

    ``listpoints`` are the keyword's points, ``sumofpoints`` those of the segment on the page, and ``flag`` says whether
    they reach the segment's threshold. The facts are moved once, by page; summing, flagging and fetching the URL follow in
    place.
    """
    whole = W.partitionBy("site_id", "custom_segment_id")
    summed = _hits(contains, keywords, segment, custom_segments).withColumn("total", F.sum("points").over(whole))
    return summed.join(site.select("site_id", F.col("page_url").alias("url")), "site_id").select(
        "custom_segment_id", "url", "category", "keyword", _flag(F.col("total")),
        F.col("points").cast("string").alias("listpoints"), F.col("total").cast("string").alias("sumofpoints"))


def segment_scores(contains: DataFrame, site: DataFrame, keywords: DataFrame, segment: DataFrame,
                   custom_segments: DataFrame) -> DataFrame:
    """One row per page and segment: keywords and points as lists, their sum, and whether it reaches the threshold.

    A page has a keyword once, so a list is no longer than the vocabulary.
    """
    entries = F.sort_array(F.collect_list(F.struct("keyword", "points"))).alias("entries")
    scored = _hits(contains, keywords, segment, custom_segments).groupBy(
        "site_id", "custom_segment_id", "category", "threshold").agg(entries, F.sum("points").alias("total"))
    return scored.join(site.select("site_id", F.col("page_url").alias("url")), "site_id").select(
        "custom_segment_id", "url", "category", F.array_join("entries.keyword", _BAR).alias("keyword"),
        _flag(F.col("total")), F.array_join(F.col("entries.points").cast("array<string>"), _BAR).alias("listpoints"),
        F.col("total").cast("string").alias("sumofpoints"))


def stack(results: Sequence[DataFrame]) -> DataFrame:
    """Results of several runs or files as one table; a column that one of them lacks is null there."""
    stacked = results[0]
    for more in results[1:]:
        stacked = stacked.unionByName(more, allowMissingColumns=True)
    return stacked


def qa_rollup(results: DataFrame) -> DataFrame:
    """One row per page and category with the results joined in keyword order, and the number of keywords."""
    whole = results.select(*[F.col(c).cast("string").alias(c) for c in RESULT_COLUMNS]).na.drop("any")
    entry = F.struct("keyword", "flag", "listpoints", "sumofpoints")
    gathered = whole.groupBy("url", "category").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    lists = [F.array_join(f"entries.{c}", _BAR).alias(c) for c in RESULT_COLUMNS[2:]]
    return gathered.select("url", "category", *lists).withColumn(
        "numberofkeywords", F.size(F.split("keyword", r"\|")))


def qa_filter(rollup: DataFrame, needed: dict[str, int] = S.KEYWORDS_NEEDED) -> DataFrame:
    """Rows of a known audience type with the keywords it needs."""
    return rollup.filter(S.enough_keywords(F.col("category"), F.col("numberofkeywords"), needed))


def final_rollup(qa: DataFrame) -> DataFrame:
    """One row per page with its categories."""
    gathered = qa.groupBy("url").agg(F.sort_array(F.collect_list(F.col("category").cast("string"))).alias("all"))
    return gathered.select("url", F.array_join("all", _BAR).alias("category"))


def publishable(table: DataFrame) -> DataFrame:
    """Table with the double quotes taken out of all text."""
    texts = {name for name, kind in table.dtypes if kind == "string"}
    return table.select(*[S.without_quotes(F.col(c)).alias(c) if c in texts else F.col(c) for c in table.columns])
