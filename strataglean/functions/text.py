"""Text expressions: shingles, lexicon counts, attribute strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The sentiment lexicon.
POSITIVE_WORDS = [
    "good", "great", "amazing", "love", "wonderful", "best", "excellent", "nice",
    "fun", "fresh", "freshest",
]
NEGATIVE_WORDS = ["terrible", "awful", "hate", "worst", "bad", "poor"]

# Ambience flags, category flags, values that switch a flag on.
AMBIENCE = ["romantic", "intimate", "classy", "touristy", "trendy", "upscale"]
WIFI_ON = ["yes"]


def lexicon_count(text: Column, words: list[str]) -> Column:
    """How many of the words occur in the lower-cased text, each counted once."""
    lowered = F.lower(text)
    total = F.lit(0)
    for word in words:
        total = total + lowered.contains(word).cast("int")
    return total


def word_list(text: Column) -> Column:
    """Lower-case words of the text."""
    return F.filter(F.split(F.lower(text), r"[ \t\r\n]+"), lambda w: w != "")


def shingles(words: Column, width: int = 3) -> Column:
    """Distinct runs of ``width`` words. ``words`` should be a column, not an
    expression: it is read ``width`` times."""
    runs = F.size(words) - F.lit(width - 1)
    shifted = [
        F.slice(words, F.lit(i + 1), F.greatest(runs, F.lit(0))).alias(f"w{i}") for i in range(width)
    ]
    return F.array_distinct(F.transform(
        F.arrays_zip(*shifted), lambda x: F.concat_ws(" ", *[x[f"w{i}"] for i in range(width)])
    ))


def literal_flag(mapping: Column, key: str) -> Column:
    """1 if the map written as ``{'key': True, ..}`` holds True for the key."""
    found = F.regexp_extract(mapping, f"'{key}': (True|False)", 1)
    return F.when(found == "True", F.lit(1)).otherwise(F.lit(0))


def comma_member(listing: Column, value: str) -> Column:
    """1 if the ', '-separated list contains the value."""
    return F.coalesce(F.array_contains(F.split(listing, ", "), value).cast("int"), F.lit(0))
