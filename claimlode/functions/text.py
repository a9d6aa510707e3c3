"""Column expressions over claim texts, ids and packed lists. No Python UDFs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The cleaning rule removes tags, then every run from the set phrase to its first
# full stop. (?d) keeps "." from stopping at anything but a line feed.
TAG_PATTERN = r"(?d)<.*?>"
PHRASE_PATTERN = r"(?diu)the present invention.*?\."
# Unicode white space plus the four ASCII separators that Python also strips.
EDGE_SPACE_PATTERN = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z"
# Fixed value: separator of packed lists.
LIST_SEPARATOR = " | "


def strip_space(text: Column) -> Column:
    """Remove Unicode white space at both ends; inner space stays."""
    return F.regexp_replace(text, EDGE_SPACE_PATTERN, "")


def clean_claim(text: Column) -> Column:
    """Claim text without tags and set phrases, stripped; null gives the empty text."""
    filled = F.coalesce(text, F.lit(""))
    untagged = F.regexp_replace(filled, TAG_PATTERN, "")
    return strip_space(F.regexp_replace(untagged, PHRASE_PATTERN, ""))


def is_blank(text: Column) -> Column:
    """True for null or white-space-only text."""
    return text.isNull() | (strip_space(text) == "")


def id_string(value: Column) -> Column:
    """Any id as stripped text. Null stays null, so it never joins."""
    return strip_space(value.cast("string"))


def publication_digits(number: Column) -> Column:
    """Digits that directly follow a two-letter country code, else null."""
    return F.nullif(F.regexp_extract(number, r"^[A-Z]{2}([0-9]+)", 1), F.lit(""))


def publication_core(number: Column) -> Column:
    """Digits left after dropping a two-character country code and the kind code.

    A design number therefore shares its core with the utility number of the same digits.
    """
    tidy = F.upper(strip_space(number))
    body = F.regexp_replace(F.substring(tidy, 3, 2**31 - 1), r"(?s)[A-Z][^A-Z]*\z", "")
    digits = F.regexp_replace(body, r"[^0-9]", "")
    return F.when(F.length(tidy) >= 5, F.nullif(digits, F.lit("")))


def normalize_id(value: Column) -> Column:
    """Digits up to the first letter, after a 2-3 letter prefix and its zeros; empty gives null."""
    # The three patterns.
    tidy = F.regexp_replace(F.upper(value.cast("string")), r"[^A-Z0-9]", "")
    unprefixed = F.regexp_replace(tidy, r"^[A-Z]{2,3}0*", "")
    return F.nullif(F.regexp_replace(unprefixed, r"[A-Z].*\z", ""), F.lit(""))


def pack_list(items: Column) -> Column:
    """Array of text as one separated text."""
    return F.array_join(items, LIST_SEPARATOR)


def unpack_list(packed: Column) -> Column:
    """Inverse of :func:`pack_list`; null and empty give the empty array."""
    parts = F.split(F.coalesce(packed, F.lit("")), r" [|] ")
    return F.array_remove(parts, "")


def fmt4(value: Column) -> Column:
    """Number as text with four decimals, rounding the exact binary value."""
    return F.call_function("format_number", value.cast("double"), F.lit("0.0000"))


def found_flag(ids: Column, true_id: Column) -> Column:
    """'Y' when the id is in the array, otherwise (also for nulls) 'N'."""
    return F.when(F.array_contains(ids, true_id), "Y").otherwise("N")


def overlap_size(left: Column, right: Column) -> Column:
    """Number of common distinct items of two arrays; a null array is empty."""
    empty = F.array().cast("array<string>")
    return F.size(F.array_intersect(F.coalesce(left, empty), F.coalesce(right, empty)))


def run_tag() -> Column:
    """Stamp of the running query, ``yyyyMMdd_HHmmss``."""
    return F.date_format(F.current_timestamp(), "yyyyMMdd_HHmmss")


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits, in text order."""
    parts = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.filter(parts, lambda word: word != "")


def add_null_columns(df, names: Sequence[str], data_type: str = "string"):
    """Append empty placeholder columns."""
    return df.withColumns({name: F.lit(None).cast(data_type) for name in names})
