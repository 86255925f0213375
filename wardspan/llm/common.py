"""What several corpus operators share: word patterns, case, hashes and small joins."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Runs of characters that are not ASCII white space. Possessive: no backtracking on long texts.
WORDS = r"\S++"
# ASCII characters that are neither letters nor digits; anything beyond ASCII belongs to words.
_GAPS = "".join(chr(c) for c in range(1, 128) if not chr(c).isalnum())
HEX_DIGITS = 13  # 52 bits: every such number is exact in a double
HEX_RANGE = float(16**HEX_DIGITS)


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def count_words(text: Column) -> Column:
    """Number of words; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def plain_words(text: Column) -> Column:
    """Lower-cased words without punctuation as an array; null gives an empty array.

    Translated in one pass and split at single characters, which is far cheaper than a pattern.
    """
    text = F.replace(F.coalesce(text, F.lit("")), F.lit("\0"), F.lit(" "))  # translate cannot map it
    bare = F.translate(
        text, string.ascii_uppercase + _GAPS, string.ascii_lowercase + " " * len(_GAPS)
    )
    return F.array_remove(F.split(bare, " "), "")


def hash_number(text: Column) -> Column:
    """A number in [0, 16**13) from the MD5 of ``text``, the same in every engine."""
    return F.conv(F.substring(F.md5(text), 1, HEX_DIGITS), 16, 10).cast("long")


def crc_of_id(name: str) -> Column:
    """crc32 of an id's decimal text; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary"))


def fresh_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, lengthened until no column of ``df`` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted
