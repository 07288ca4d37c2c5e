"""Column expressions that turn page text into tokens."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The punctuation that separates words. Hyphen, quotes, angle brackets and backtick stay in words.
PUNCTUATION = r"!@#%$&)(+*?,/\][^}{_~.;=:|"

# The characters that count as whitespace, below and above U+0100.
WHITESPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
WIDE_WHITESPACE = "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"

# The common English stop-word list.
STOP_WORDS = tuple("""
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves he him his himself
she she's her hers herself it it's its itself they them their theirs themselves what which who whom this that that'll
these those am is are was were be been being have has had having do does did doing a an the and but if or because as
until while of at by for with about against between into through during before after above below to from up down in
out on off over under again further then once here there when where why how all any both each few more most other some
such no nor not only own same so than too very s t can will just don don't should should've now d ll m o re ve y ain
aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn mightn't
mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split())


# A class of characters below U+0100 only is matched by table lookup. The rare wide ones are turned into blanks first,
# in the texts where one range test says that they may occur.
_SEPARATORS = "[" + re.sub(r"([\\\[\]^&~|])", r"\\\1", PUNCTUATION + WHITESPACE) + "]+"
_MAYBE_WIDE = f"[{WIDE_WHITESPACE[0]}-{WIDE_WHITESPACE[-1]}]"


def tokens(text: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Array of lower-case words without stop words. Words around a removed stop word become neighbours."""
    dropped = ["", *stop_words]
    narrow = F.when(text.rlike(_MAYBE_WIDE), F.regexp_replace(text, f"[{WIDE_WHITESPACE}]", " ")).otherwise(text)
    return F.filter(F.split(F.lower(narrow), _SEPARATORS), lambda w: ~w.isin(dropped))
