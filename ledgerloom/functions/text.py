"""Cleaning and keys of company records, as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The legal forms that a cleaned name leaves out.
LEGAL_FORMS = ("inc", "corp", "ltd", "llc", "plc", "co", "company", "limited")


def clean_text(c: Column) -> Column:
    """Lower case without legal forms, punctuation and surplus blanks; null gives ''.

    Legal forms go before punctuation, so 'Foo-Bar LLC' is 'foobar' and 'co-op' is 'op'.
    """
    bare = F.regexp_replace(F.lower(c), rf"(?U)\b({'|'.join(LEGAL_FORMS)})\b", "")
    bare = F.regexp_replace(bare, r"(?U)[^a-z0-9\s]", "")
    return F.coalesce(F.trim(F.regexp_replace(bare, r"(?U)\s+", " ")), F.lit(""))


def clean_country(c: Column) -> Column:
    return F.upper(F.trim(c))


def clean_postal(c: Column) -> Column:
    """Digits and capitals only; lower-case letters are dropped, not raised."""
    return F.regexp_replace(c, "[^0-9A-Z]", "")


def blocking_key(country_clean: Column, name_clean: Column) -> Column:
    """Country (or UNK) and the first three characters of the name."""
    return F.concat_ws("||", F.coalesce(country_clean, F.lit("UNK")), F.substring(name_clean, 1, 3))


def parse_string_array(c: Column) -> Column:
    """Array of a text: a JSON array if it is one; else split at commas and semicolons, brackets and quotes gone.

    Blank text gives an empty array, null stays null; blanks at the outer ends survive.
    """
    bare = F.regexp_replace(F.regexp_replace(c, r"^\[|\]$", ""), '"', "")
    pieces = F.when(F.trim(bare) == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"\s*[,;]\s*"))
    return F.when(c.isNotNull(), F.coalesce(F.from_json(c, "array<string>"), pieces))


def sanitize(df):
    """NaN of float and double columns becomes null; other columns are as they were."""
    kinds = dict(df.dtypes)
    return df.select(*[F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")).alias(c) if kinds[c] in ("float", "double") else F.col(f"`{c}`") for c in df.columns])


def rows_as_json(df, ignore_nulls: bool = True) -> Column:
    """One JSON text per row of all columns."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": str(ignore_nulls).lower()})
