"""Known keywords and phrases on pages: leftmost, longest, not overlapping.

Pages are cut into tokens where they are read. A filter of fixed size, made of the keywords and of their beginnings, says at
each position how far a keyword may go on, so only places that may hold one leave the scan, as rows without the text around
them. They are joined with the vocabulary and shuffled by page and field. There, occurrences that overlap make runs, and the
choice of a reader who goes from left to right is made run by run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pageglean.functions import html as H
from pageglean.functions import text as X
from pageglean.functions.bind import let
from pageglean.operators.bloom import key_filter, may_hold
from pageglean.operators.joins import join_sized

FIELDS = ("title", "body", "keywords", "description")

def vocabulary(keywords: DataFrame, column: str = "keyword") -> DataFrame:
    """Distinct lower-case keywords; entries with a newline and empty entries are left out."""
    word = F.trim(F.lower(F.col(column)))
    return (
        keywords.filter(~F.contains(F.col(column), F.lit("\n")))
        .select(word.alias("keyword"))
        .filter(F.col("keyword") != "")
        .distinct()
    )


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores where a scan of a few small files keeps most of them idle; a larger one stays as it is.

    The size is what the planner knows of the files, so nothing runs to find it out.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    unit = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return df.repartition(cores) if size * 4 <= unit * cores else df


def page_fields(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per page and field (title, body, meta keywords, meta description) with its text."""
    others = [c for c in pages.columns if c != html]
    # Values that are used twice stay columns of their own, so that they are computed once.
    cut = spread(pages).select(*others, H.marked(F.col(html)).alias("marked"), H.meta_tags(F.col(html)).alias("metas"))
    sources = cut.select(
        *others, H.title_marked(F.col("marked")).alias("title"), H.shown_marked(F.col("marked")).alias("body"),
        H.meta_source(F.col("metas"), "keywords").alias("keywords"),
        H.meta_source(F.col("metas"), "description").alias("description"),
    )
    rows = F.array(*[F.struct(F.lit(name).alias("field"), F.col(name).alias("source")) for name in FIELDS])
    decoded = sources.select(*others, F.inline(rows)).select(*others, "field", H.decode_entities(F.col("source")).alias("text"))
    cleaned = F.when(F.col("field") == "title", H.without_decoded_tags(F.col("text"))).otherwise(F.col("text"))
    return decoded.select(*others, "field", cleaned.alias("text"))


def field_tokens(fields: DataFrame, stop_words: Sequence[str] = X.STOP_WORDS) -> DataFrame:
    """The fields with their tokens in place of their text."""
    return fields.withColumn("tokens", X.tokens(F.col("text"), stop_words)).drop("text")


def token_rows(tokens: DataFrame) -> DataFrame:
    """One row per token with its position in the field."""
    others = [c for c in tokens.columns if c != "tokens"]
    return tokens.select(*others, F.posexplode("tokens").alias("pos", "token"))


# Beginnings of keywords that the filter knows, in words. Between two of them a place goes on to the next one's end, but never
# further than the longest keyword: past the last one, a false beginning would else take all words up to the end of the field.
_BEGINNINGS = (1, 2, 4, 8)
# Tells a whole keyword from a beginning.
_WHOLE = "\n"
# Occurrences of a run that are gone through at once.
_CHUNK = 512


def _beginnings(vocab: DataFrame) -> DataFrame:
    """What the filter is made of: hashes of each keyword as a whole, and of its first 1, 2, 4 and 8 words."""
    words = F.split("keyword", " ")
    parts = F.transform(F.filter(F.array(*map(F.lit, _BEGINNINGS)), lambda k: k <= F.size(words)),
                        lambda k: F.xxhash64(F.array_join(F.slice(words, F.lit(1), k), " ")))
    return vocab.select(F.explode(F.concat(parts, F.array(F.xxhash64("keyword", F.lit(_WHOLE))))).alias("h"))


def _text(words: Column, at: Column, n: Column) -> Column:
    return F.array_join(F.slice(words, at + 1, n), " ")


def _hash(*columns: str | Column) -> Column:
    """Hash of columns that tells a null from its neighbours."""
    named = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.xxhash64(F.lit(0), *named, *map(F.isnull, named))


def _addressed(tokens: DataFrame, page: Sequence[str]) -> DataFrame:
    """Tokens with the first page column and ``whose``, a short hash of the page's other columns and the field.

    ``who`` holds these columns themselves. It goes on in one row of a field only, so URLs are not shuffled with every place.
    The hash stands first: shuffled rows are compressed best where what tells them apart lies side by side.
    """
    return tokens.select(_hash(*page[1:], "field").alias("whose"), page[0], F.struct(*page, "field").alias("who"), "tokens")


def _places(addressed: DataFrame, vocab: DataFrame, terms: bool) -> DataFrame:
    """Places that may hold a keyword: ``pos``, ``n`` words and their ``text``; with ``terms`` also all other tokens, as of 0 words.

    Each field with tokens also has a row of -1 words, the only one that holds ``who``; its text is as good as unique. There
    is no lambda in it and no value is derived twice (what is generated is not derived again where it is used), so all of it
    is compiled into one loop over the tokens, which stay where they are in memory.
    """
    others = [c for c in addressed.columns if c != "tokens"]
    known = key_filter(_beginnings(vocab), "h")
    longest = vocab.agg(F.max(F.size(F.split("keyword", " ")))).scalar()
    # The first of the listed stands for the field; tokens follow it.
    listed = F.when(F.size("tokens") > 0, F.concat(F.array(F.lit("")), F.col("tokens")))
    rows = addressed.select(*others, "tokens", F.posexplode(listed).alias("place", "token"))
    words, at, left = F.col("tokens"), F.col("place") - 1, F.least(F.size("tokens") - F.col("place") + 1, longest)
    head, begins = F.col("place") == 0, may_hold(known, F.xxhash64("token"))
    if not terms:
        rows = rows.filter(head | begins)
    hashes = [F.when(~head & (left >= n), F.xxhash64(_text(words, at, F.lit(n)))).alias(f"h{n}") for n in _BEGINNINGS[1:]]
    hashed = rows.select("*", F.inline(F.array(F.struct(*hashes))))
    # How many words from here on may belong to one keyword.
    reach = F.when(head, -1)
    if terms:
        reach = reach.when(~begins, 0)
    for n in _BEGINNINGS[1:]:
        reach = reach.when(~F.coalesce(may_hold(known, F.col(f"h{n}")), F.lit(False)), F.least(F.lit(n - 1), left))
    first = F.when(head, -1).otherwise(0 if terms else 1)
    reached = hashed.select(*others, "tokens", at.alias("pos"), "token", first.alias("first"), reach.otherwise(left).alias("reach"))
    grams = reached.select(*others, "tokens", "pos", "token", "reach", F.explode(F.sequence("first", "reach")).alias("n"))
    text = F.when(F.col("n") < 0, F.col("whose").cast("string")).when(F.col("n") == 0, F.col("token")).otherwise(_text(words, F.col("pos"), F.col("n")))
    found = grams.select(*others, "pos", "n", "reach", F.explode(F.array(text)).alias("text"))
    # A token that may be a keyword goes on as a place of one word, and not as of none too.
    whole = may_hold(known, F.xxhash64("text", F.lit(_WHOLE)))
    kept = F.when(F.col("n") < 0, True).when(F.col("n") == 0, (F.col("reach") < 1) | ~whole).otherwise(whole)
    # Told here that texts are not null, the planner has nothing to add below the shuffle that only one reader needs.
    return found.filter(F.col("text").isNotNull() & kept).select(
        *others[:2], "pos", "n", F.when(F.col("n") < 0, F.col("who")).alias("who"), "text")


def occurrences(places: DataFrame, vocab: DataFrame, small: bool = False) -> DataFrame:
    """The places where a keyword stands, overlapping ones included: ``pos``, ``n`` words, ``keyword``; and the rows of -1 words.

    The places are joined with the vocabulary, which is broadcast if it was measured to be ``small``.
    """
    known = vocab.select("keyword").distinct().withColumn("known", F.lit(True))
    given = places.withColumnRenamed("text", "keyword")
    return join_sized(given, known, "keyword", "left", small).filter("known OR n < 0").select(*given.columns)


def _fold(run: Column) -> Column:
    """The occurrences of a run, in order, that a reader takes.

    The choice at a position depends on all choices before it. A long run is gone through in chunks, as an array that grows
    by one is copied each time.
    """
    nothing = F.slice(run, F.lit(1), F.lit(0))

    def step(state: Column, place: Column) -> Column:
        taken = F.struct((place["pos"] + place["n"]).alias("until"), F.concat(state["kept"], F.array(place)).alias("kept"))
        return F.when(place["pos"] >= state["until"], taken).otherwise(state)

    def chunk(state: Column, places: Column) -> Column:
        inner = F.aggregate(places, F.struct(state["until"].alias("until"), nothing.alias("kept")), step)
        return let(inner, lambda i: F.struct(i["until"].alias("until"), F.concat(state["kept"], F.array(i["kept"])).alias("kept")))

    starts = F.sequence(F.lit(0), F.floor((F.size(run) - 1) / _CHUNK).cast("int"))
    chunks = F.transform(starts, lambda c: F.slice(run, c * _CHUNK + 1, F.lit(_CHUNK)))
    begin = F.struct(F.lit(0).alias("until"), F.slice(F.array(nothing), F.lit(1), F.lit(0)).alias("kept"))
    return F.when(F.size(run) == 1, run).otherwise(F.flatten(F.aggregate(chunks, begin, chunk)["kept"]))


def leftmost_longest(found: DataFrame, page: Sequence[str]) -> DataFrame:
    """Of all occurrences on pages, those that a reader would take, going from left to right.

    An occurrence that begins where all before it have ended opens a run; runs do not depend on each other. The row
    of -1 words is the first of its field and tells the others who they are of.
    """
    order = W.partitionBy(page[0], "whose").orderBy("pos", F.desc("n"))
    so_far = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    before = F.max(F.col("pos") + F.col("n")).over(order.rowsBetween(W.unboundedPreceding, -1))
    opens = found.withColumn("opens", F.coalesce(F.col("pos") >= before, F.lit(True)).cast("int"))
    runs = opens.withColumn("run", F.sum("opens").over(so_far)).withColumn("who", F.first("who").over(so_far)).filter("n > 0")
    named = runs.select(page[0], "whose", *[F.col("who")[c].alias(c) for c in (*page[1:], "field")], "run", "pos", "n", "keyword")
    place = F.struct("pos", (-F.col("n")).alias("longer"), "n", "keyword")
    lists = named.groupBy("whose", *page, "field", "run").agg(F.sort_array(F.collect_list(place)).alias("places"))
    kept = lists.select(*page, "field", F.explode(_fold(F.col("places"))).alias("place"))
    return kept.select(*page, "field", "place.pos", "place.n", "place.keyword")


def phrase_matches(tokens: DataFrame, vocab: DataFrame, page: Sequence[str] = ("page_id", "url"), small: bool = False) -> DataFrame:
    """Keyword occurrences as a reader going left to right would take them, always the longest one.

    ``tokens`` has the ``page`` columns (the first alone identifies a page), ``field`` and ``tokens``.
    """
    return leftmost_longest(occurrences(_places(_addressed(tokens, page), vocab, False), vocab, small), page)


def keyword_counts(matches: DataFrame, page: Sequence[str] = ("page_id", "url"), at_least: int = 1) -> DataFrame:
    """Occurrences of each keyword on each page, over all fields.

    Matches are shuffled by their page: they come page by page, so what names the page is compressed away in all but the first.
    """
    counts = matches.select(*page, "keyword").repartition(*page).groupBy(*page, "keyword").agg(F.count(F.lit(1)).alias("points"))
    return counts.filter(F.col("points") >= at_least) if at_least > 1 else counts


def classify_pages(pages: DataFrame, vocab: DataFrame, stop_words: Sequence[str] = X.STOP_WORDS,
                   at_least: int = 1, small: bool = False) -> DataFrame:
    """Pages (``page_id``, ``url``, ``html``; one row per page) to keyword counts."""
    tokens = field_tokens(page_fields(pages.select("page_id", "url", "html")), stop_words)
    return keyword_counts(phrase_matches(tokens, vocab, small=small), at_least=at_least)


def keyword_map(counts: DataFrame, page: Sequence[str] = ("url",)) -> DataFrame:
    """The counts of a page as one map, keywords in order. A page has at most as many entries as the vocabulary."""
    entries = F.sort_array(F.collect_list(F.struct("keyword", "points")))
    return counts.groupBy(*page).agg(F.map_from_entries(entries).alias("keywords"))


def explode_keyword_map(store: DataFrame) -> DataFrame:
    """Keyword maps as one row per page and keyword."""
    others = [c for c in store.columns if c != "keywords"]
    return store.select(*others, F.explode("keywords").alias("keyword", "points"))


def terms_not_in_vocabulary(tokens: DataFrame, vocab: DataFrame, page: Sequence[str] = ("page_id", "url"), small: bool = False) -> DataFrame:
    """Distinct page terms that stand outside every match, found by counting: all places minus matched places.

    Tokens leave the scan in one stream with the places that may hold a keyword, so pages are read once and their tokens are
    never stored. The stream is dealt by page, and so are the matches: no other shuffle holds the terms.
    """
    stream = _places(_addressed(tokens, page), vocab, True).repartition(page[0])
    # Told apart by generated columns, which the planner cannot test nor leave out below the shuffle: both sides read the same one.
    told = stream.select("whose", page[0], F.inline(F.array(F.struct("pos", "n"))), "who", "text")
    found = told.filter("n <> 0")
    matches = leftmost_longest(occurrences(found, vocab, small).repartition(page[0]), page)
    # The rows of -1 words tell the others who they are of, and count no place.
    of = F.max("who").over(W.partitionBy(page[0], "whose"))
    everywhere = told.filter("n <= 1").withColumn("of", of).filter("n >= 0").select(
        page[0], *[F.col("of")[c].alias(c) for c in page[1:]], F.col("text").alias("term"), F.lit(1).cast("long").alias("places"))
    matched = matches.select(*page, F.explode(F.split("keyword", " ")).alias("term"), F.lit(-1).cast("long").alias("places"))
    left = everywhere.unionByName(matched).groupBy(*page, "term").agg(F.sum("places").alias("places"))
    return left.filter(F.col("places") > 0).select(*page, "term")
