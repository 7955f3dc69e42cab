"""White space, tags, markers and the normal forms that comparisons use."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: What Python's str.split() treats as white space, as a Java character class.
SPACE = r"[\p{IsWhite_Space}\x1c-\x1f]"

# The clock pattern that rendered Markdown must not hold, and the leading speaker tag.
TIMECODE = r"\b\d{2}:\d{2}:\d{2}(?:[.,]\d{3})?\b"
SPEAKER_TAG = r"^\[S\d+\]"

#: Markers by which a reviewed text says what is uncertain.
UNCERTAIN = r"\[(?:inaudible|unclear|name\?|number\?|听不清|人名待核|数字待核)\]"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def collapse(text: Column) -> Column:
    return strip(F.regexp_replace(text, f"{SPACE}+", " "))


def strip_speaker_tag(text: Column) -> Column:
    return strip(F.regexp_replace(text, f"{SPEAKER_TAG}{SPACE}*", ""))


def has_timecode(text: Column) -> Column:
    return text.rlike(TIMECODE)


def words(text: Column) -> Column:
    """Lower-cased words without punctuation and symbols."""
    bare = F.regexp_replace(F.lower(text), r"[\p{P}\p{S}]+", "")
    return F.filter(F.split(bare, f"{SPACE}+"), lambda w: w != "")


def uncertain_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(UNCERTAIN)).cast("bigint")


def characters(text: Column, form: str = "NFKC") -> Column:
    """The text in a Unicode normal form (Spark has no built-in one, so by Arrow), lower-cased, without speaker labels,
    punctuation and white space."""

    @F.pandas_udf("string")
    def normal(s):
        return s.map(lambda t: unicodedata.normalize(form, t), na_action="ignore")

    normal.func.__annotations__ = {"s": pd.Series, "return": pd.Series}
    bare = F.lower(normal(F.regexp_replace(text, SPEAKER_TAG, "")))
    return F.regexp_replace(F.regexp_replace(bare, r"[\p{P}\p{S}]", ""), f"{SPACE}+", "")
