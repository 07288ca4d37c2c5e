"""Column expressions over segment names, categories and channel responses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prefixes taken off a segment name, in this order, wherever they stand.
NAME_PREFIXES = (
    "PrimeAudience – DTC Interest In ",
    "PrimeAudience – HCP Interest In ",
    "PrimeAudience – ",
)

# The audience types, the tested-first one first, with the keywords a page needs for them.
KEYWORDS_NEEDED = {"DTC": 3, "HCP": 5}

# Second field of a channel name that lets a page be classified.
CLASSIFIED_CHANNELS = ("health", "family", "dtc", "hcp")

_RESPONSE = "channels array<struct<name: string>>"


def clean_name(name: Column) -> Column:
    """Segment name without commas and without its prefix."""
    cleaned = F.replace(name, F.lit(","), F.lit(""))
    for prefix in NAME_PREFIXES:
        cleaned = F.replace(cleaned, F.lit(prefix), F.lit(""))
    return cleaned


def value_type(category: Column) -> Column:
    """``DTC`` or ``HCP``, whichever the category names, or null."""
    (first, _), (second, _) = KEYWORDS_NEEDED.items()
    return (F.when(F.contains(category, F.lit(first)), first)
            .when(F.contains(category, F.lit(second)), second))


def enough_keywords(category: Column, count: Column, needed: dict[str, int] = KEYWORDS_NEEDED) -> Column:
    """The audience type is known and the page has the keywords it needs."""
    kind = value_type(category)
    tests = [(kind == name) & (count >= at_least) for name, at_least in needed.items()]
    return F.coalesce(tests[0] | tests[1], F.lit(False))


def channel_passes(response: Column, allowed: Sequence[str] = CLASSIFIED_CHANNELS) -> Column:
    """Some channel of the JSON response has an allowed second field in its name."""
    channels = F.from_json(response, _RESPONSE)["channels"]
    hit = F.exists(channels, lambda c: F.coalesce(F.get(F.split(c["name"], "_"), F.lit(1)).isin(*allowed), F.lit(False)))
    return F.coalesce(hit, F.lit(False))


def id_list(text: Column) -> Column:
    """Ids of a list literal such as ``[3, 5]``."""
    return F.from_json(text, "array<bigint>")


def without_quotes(value: Column) -> Column:
    return F.replace(value, F.lit('"'), F.lit(""))
