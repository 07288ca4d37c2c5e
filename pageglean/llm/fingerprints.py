"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

A text is a bag of words and the weight of a word is how often it stands there. For word x, sample k and weight w there
are r and c from Gamma(2, 1) and b from U(0, 1), the same wherever x stands. With t = floor(ln w / r + b) the sample's
word is the one of least ln c - r (t - b) - r, and the sample is this word with its t. Two texts agree in a sample with a
probability equal to the generalised Jaccard similarity of their bags.

Of a Gamma(2, 1), a share from U(0, 1) and the rest are two independent exponentials. So c u and c (1 - u) are drawn as
exponentials, where -ln u = r (1 - b) and -ln v = r b are the two of r, and weight 1 needs one draw: ln c - r (1 - b) is
ln (c u), and the value for weight w is this minus r t.

They are drawn from all 64 bits of a word's hash and the number of the sample, for every word of every text. The
draws of common words are a broadcast table, so that they are not made for each text anew; which words are in it changes
no result. Texts are shuffled once, by ranges of their id, which brings each document together with the next one; all
grouping after that happens inside these ranges.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SAMPLES = 64
# Words whose draws are in the broadcast table, and the documents, about, in which common words are looked for.
TERMS = 1 << 15
COMMON_ROWS = 5000
# A sample is known by the low 24 bits of word and t.
MARK = (1 << 24) - 1
ROWS_PER_RANGE = 500
CELLS = 1 << 16
_SPACES = "[ \\t\\n\\x0B\\f\\r]+"


def _hashed(word: Column, seed: int = 1) -> Column:
    return F.xxhash64(word, F.lit(seed))


def _uniform(word: Column, k: Column, n: int) -> Column:
    return (F.shiftrightunsigned(F.xxhash64(word.bitwiseXOR(k * 8 + n)), 12) + 0.5) * 2.0 ** -52


def _exponential(word: Column, k: Column, n: int) -> Column:
    return -F.ln(_uniform(word, k, n))


def _u(word: Column, k: Column) -> Column:
    a = _exponential(word, k, 0)
    return a / (a + _exponential(word, k, 1))


def _r(word: Column, k: Column) -> Column:
    return (-F.ln(_u(word, k) * _uniform(word, k, 2))).cast("float")


def _b(word: Column, k: Column) -> Column:
    v = _uniform(word, k, 2)
    return (F.ln(v) / F.ln(_u(word, k) * v)).cast("float")


def _once(word: Column, k: Column) -> Column:
    """The packed value for weight 1: ln c - r (1 - b) = ln (c u)."""
    return _packed(F.ln(_exponential(word, k, 0)), word)


def common_words(texts: DataFrame, rows: int, terms: int = TERMS) -> DataFrame:
    """Hashes ``word`` of about the ``terms`` most common words of ``text``, as a sample of the ``rows`` texts shows them."""
    some = texts.sample(min(1.0, COMMON_ROWS / max(1, rows)), 1)
    word = some.select(F.explode(F.array_distinct(F.split("text", _SPACES))).alias("word")).select(_hashed(F.col("word")).alias("word"))
    return word.groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n")).limit(terms).select("word")


def _drawn(f, samples: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(samples - 1)), lambda k: f(F.col("word"), k))


def samples_table(words: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """``word`` with arrays over the samples: ``r``, ``b`` and ``once``, the packed value for weight 1."""
    return words.repartition(8).select("word", _drawn(_r, samples).alias("r"), _drawn(_b, samples).alias("b"), _drawn(_once, samples).alias("once"))


def _packed(value: Column, word: Column) -> Column:
    """A value over the low 24 bits of a word's hash. Values lie between -192 and 64: logarithms of doubles and word counts."""
    return F.shiftleft(F.floor((value + 192) * float(1 << 31)), 24) + word.bitwiseAND(F.lit(MARK))


def _sample(k: int) -> Column:
    """Least packed value of a bag in sample k. Most words stand once in a text; their value is in the table or drawn here.

    The value of a repeated word is less by r t and its mark is another. ``once`` is mentioned once, as the code made of
    it would not be compiled otherwise.
    """
    word, r, repeated = F.col("word"), F.get("r", F.lit(k)), F.col("log_weight") > 0
    once = F.coalesce(F.get("once", F.lit(k)), _once(word, F.lit(k)))
    t = F.floor(F.col("log_weight") / r + F.get("b", F.lit(k)))
    less = F.when(repeated, F.shiftleft(F.floor(r * t * float(1 << 31)), 24)).otherwise(0)
    return F.min(F.when(word.isNotNull(), (once - less).bitwiseXOR(F.when(repeated, t.bitwiseAND(F.lit(MARK))).otherwise(0)))).alias(f"s{k}")


def signatures(texts: DataFrame, keys: list[str], table: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """``keys`` with ``signature``, one number of 24 bits per sample, or null for a text without words.

    ``texts`` has the keys, which tell texts apart, and ``content``. If it is partitioned by one of the keys, nothing is
    shuffled here. ``table`` has the draws of common words. Different words share a number with a probability of 2^-24.
    """
    word = texts.select(*keys, F.explode(F.split("content", _SPACES)).alias("word"))
    hashed = F.when(F.col("word") != "", _hashed(F.col("word")))
    bags = word.select(*keys, hashed.alias("word")).groupBy(*keys, "word").agg(F.ln(F.count(F.lit(1)).cast("double")).alias("log_weight"))
    # A word that repeats and is not in the table is rare enough to be drawn in arrays.
    r, b = (F.coalesce(name, F.when(F.col("log_weight") > 0, _drawn(f, samples))).alias(name) for name, f in (("r", _r), ("b", _b)))
    drawn = bags.join(F.broadcast(table), "word", "left").select(*keys, "word", "log_weight", r, b, "once")
    least = drawn.groupBy(*keys).agg(*[_sample(k) for k in range(samples)])
    marks = F.array(*[F.col(f"s{k}").bitwiseAND(F.lit(MARK)).cast("int") for k in range(samples)])
    return least.select(*keys, F.when(F.col("s0").isNotNull(), marks).alias("signature"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples. Two empty bags are alike; an empty one and another are not."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)) / F.size(a)
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(same).cast("double")


def written(signature: Column) -> Column:
    """A signature as text: six hexadecimal digits per sample; empty for a text without words."""
    return F.coalesce(F.array_join(F.transform(signature, lambda x: F.lpad(F.lower(F.hex(x)), 6, "0")), ""), F.lit(""))


def _ranges(docs: DataFrame, rows_per_range: int) -> tuple[DataFrame, Column, int, int]:
    """Ranges of ids of about so many rows: cell -> ``range`` and its first id, the cell of an id, and how many ranges and rows.

    Ids are counted in at most ``CELLS`` cells of equal width, and neighbouring cells are put together.
    """
    ends = docs.agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.count(F.lit(1)).alias("n")).first()
    low, width = float(ends["a"] or 0), float((ends["b"] or 0) - (ends["a"] or 0) + 1)
    # least() would skip a null id.
    place = F.least(F.floor((F.col("doc_id").cast("double") - low) / width * CELLS), F.lit(CELLS - 1))
    cell = F.when(F.col("doc_id").isNull(), -1).otherwise(place).cast("int")
    cells = docs.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"))
    # At most CELLS + 1 rows, so a window over all of them is small.
    before = F.sum("n").over(W.orderBy("cell").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("n")
    target = max(1, min(rows_per_range, math.ceil(ends["n"] / 2)))
    numbered = cells.withColumn("bin", F.floor(before / target)).withColumn("range", F.dense_rank().over(W.orderBy("bin")) - 1)
    kept = numbered.select("cell", "range", F.min(F.struct("cell", "first")).over(W.partitionBy("range"))["first"].alias("first"),
                           F.min("cell").over(W.partitionBy("range")).alias("first_cell"))
    count = numbered.agg(F.max("range")).first()[0]
    return kept, cell, (count if count is not None else -1) + 1, ends["n"]


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES, terms: int = TERMS,
                          rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Fingerprints of every whole text and of the text with its second half replaced by the start of the next document's.

    Columns: ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``,
    ``near_next``. Null texts count as empty; an empty text has the empty fingerprint. Documents follow each other by
    id, null ids first, and repeated ids by text; after the last comes the first. Other columns are not looked at.
    ``terms`` is how many words have their draws in the broadcast table; it changes no result.
    """
    plain = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ranges, cell, count, rows = _ranges(plain, rows_per_range)
    # The first documents of a range are also sent to the range before, as guests: there they are the next document.
    own = ranges.select("cell", "range").withColumnRenamed("cell", "own_cell")
    heads = ranges.select(F.col("first"), "first_cell", ((F.col("range") - 1 + count) % max(1, count)).alias("guest_of"),
                          (F.col("range") == 0).alias("wraps")).distinct()
    placed = plain.withColumn("cell", cell)
    placed = placed.join(F.broadcast(own), placed["cell"] == F.col("own_cell")).join(
        F.broadcast(heads), (placed["cell"] == F.col("first_cell")) & placed["doc_id"].eqNullSafe(F.col("first")), "left")
    seats = F.array(F.struct(F.col("range").alias("range"), F.lit(0).alias("guest")),
                    F.when(F.col("guest_of").isNotNull(), F.struct(F.col("guest_of").alias("range"), F.lit(1).alias("guest"))))
    seated = placed.select("doc_id", "text", F.inline(F.filter(seats, lambda s: s.isNotNull())))
    # A task holds a few ranges, a few megabytes of text.
    near = seated.repartition(max(1, math.ceil(count / 4)), "range")
    order = W.partitionBy("range").orderBy("guest", F.col("doc_id").asc_nulls_first(), "text")
    paired = near.withColumn("place", F.row_number().over(order)).withColumn("next", F.lead("text").over(order))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - half), F.substr("next", F.lit(1), half))
    # The small columns and the bags are made apart and put together by the place in the range; the shuffle is the same.
    small = paired.filter(F.col("guest") == 0).select(
        "range", "place", "doc_id", n.cast("long").alias("n_chars"), F.sha2(edited, 256).alias("edited_sha256"))
    kinds = F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("content")),
                    F.when(F.col("guest") == 0, F.struct(F.lit(1).alias("kind"), F.col("edited").alias("content"))))
    contents = paired.select("range", "place", "guest", "text", edited.alias("edited")).select(
        "range", "place", F.inline(F.filter(kinds, lambda s: s.isNotNull())))
    signed = signatures(contents, ["range", "place", "kind"], samples_table(common_words(plain, rows, terms), samples), samples)
    marks = signed.groupBy("range", "place").agg(*[
        F.max(F.when(F.col("kind") == k, F.struct("kind", "signature"))).alias(name) for k, name in enumerate(("plain", "changed"))])
    follow = marks.withColumn("next", F.lead("plain").over(W.partitionBy("range").orderBy("place"))).join(small, ["range", "place"])
    plain_mark, changed_mark, next_mark = (F.col(c)["signature"] for c in ("plain", "changed", "next"))
    return follow.select(
        "doc_id", "n_chars", "edited_sha256", written(plain_mark).alias("fingerprint"),
        written(changed_mark).alias("edited_fingerprint"), likeness(plain_mark, changed_mark).alias("near_edited"), likeness(plain_mark, next_mark).alias("near_next"))
