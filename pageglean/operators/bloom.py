"""A filter of keys whose size follows the number of keys, up to a bound.

It is made inside the query that uses it, by a subquery, so nothing runs while a query is built. A key that is in the table
always passes; another one passes seldom while the keys are fewer than a sixth of the bits, and often beyond that. So what
passes must still be joined with the keys: the filter only spares the rows that cannot match the way to the join.

Keys are given as 64-bit hashes. A hash names a word, of which there is a power of two, and three bits in it, so a test looks
at one word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A quarter of a megabyte of words at least, and four megabytes at most.
_WORDS_POWERS = (15, 19)
# Keys for which there is a word; with as many, one in a few hundred other hashes passes.
_KEYS_A_WORD = 2


def _word(h: Column, words: Column) -> Column:
    """The place of a hash among so many ``words``, told by bits that ``_bits`` leaves."""
    return F.shiftrightunsigned(h, 18).bitwiseAND(words.cast("long") - 1).cast("int")


def _bits(h: Column) -> Column:
    one = F.lit(1).cast("long")
    first, second, third = (F.call_function("shiftleft", one, F.shiftright(h, s).bitwiseAND(F.lit(63)).cast("int")) for s in (0, 6, 12))
    return first.bitwiseOR(second).bitwiseOR(third)


def key_filter(hashes: DataFrame, column: str) -> Column:
    """The filter of a column of hashes, an array of words for ``may_hold``."""
    h, (least, most) = F.col(column), _WORDS_POWERS
    keys = hashes.filter(h.isNotNull())
    power = F.ceil(F.log2(F.count(F.lit(1)) / _KEYS_A_WORD + 1)).cast("int")
    words = keys.agg(F.call_function("shiftleft", F.lit(1), F.least(F.greatest(power, F.lit(least)), F.lit(most))).alias("words")).scalar()
    given = keys.select(_word(h, words).cast("long").alias("id"), _bits(h).alias("word"))
    # Words that no key names hold nothing.
    empty = hashes.sparkSession.range(1).select(F.explode(F.sequence(F.lit(0).cast("long"), words - F.lit(1).cast("long"))).alias("id"),
                                                F.lit(0).cast("long").alias("word"))
    dense = given.unionByName(empty).groupBy("id").agg(F.bit_or("word").alias("word"))
    return dense.agg(F.transform(F.sort_array(F.collect_list(F.struct("id", "word"))), lambda w: w["word"]).alias("words")).scalar()


def may_hold(words: Column, h: Column) -> Column:
    """False only for hashes that the filter was not made of."""
    bits = _bits(h)
    return F.get(words, _word(h, F.size(words))).bitwiseAND(bits) == bits
