"""Parsing of scraped cells: credit lines, numbers, dates and links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from evergreen.functions.text import strip_space

# Separators and patterns of the landed pages, in order of precedence.
LINE_SEPARATORS = (" - ", " – ", " — ", " || ", " | ")
TAGGED_SEPARATOR = " _ "
COLON_SEPARATOR = ": "
TAG_PREFIX = r"^\s*[\[\(][^\]\)]{0,10}[\]\)]\s*"
TITLE_FEATURING = r"[ \t](?:ft\.?|feat\.?|featuring)[ \t].*$"
TITLE_META = r"[\(\[].*$"
TITLE_QUOTES = "‘’‚‛“”„‟「」『』'"
TRACK_URI_PREFIX = "spotify:track:"
TRACK_URL_PREFIX = "https://open.spotify.com/track/"


def clean_title(c: Column) -> Column:
    cut = F.regexp_replace(c, f"(?Udi){TITLE_FEATURING}", "")
    return strip_space(F.regexp_replace(cut, f"(?Ud){TITLE_META}", ""))


def _pair(artist: Column, title: Column) -> Column:
    return F.struct(strip_space(artist).alias("artist"), clean_title(strip_space(title)).alias("title"))


def cut_at(c: Column, sep: str) -> Column:
    """(artist, title) around the first ``sep``; null where it does not occur."""
    tail = F.substr(c, F.instr(c, sep) + F.lit(len(sep)))
    return F.when(F.contains(c, F.lit(sep)), _pair(F.substring_index(c, sep, 1), tail))


def split_dash(c: Column) -> Column:
    """(artist, title) at the first `` - ``, title left as it is; null without one."""
    parts = F.split(c, " - ", 2)
    return F.when(
        F.size(parts) == 2,
        F.struct(
            strip_space(F.get(parts, F.lit(0))).alias("artist"), strip_space(F.get(parts, F.lit(1))).alias("title")
        ),
    )


def parse_line(c: Column) -> Column:
    """(artist, title) of a free-form line: the first separator style that occurs wins."""
    quoted = rf"(?Ud)^((?s:.*?))[{TITLE_QUOTES}]([^{TITLE_QUOTES}]+)[{TITLE_QUOTES}]"
    lead, inner = strip_space(F.regexp_extract(c, quoted, 1)), strip_space(F.regexp_extract(c, quoted, 2))
    return F.coalesce(
        *[cut_at(c, sep) for sep in LINE_SEPARATORS],
        cut_at(F.regexp_replace(c, f"(?Ud){TAG_PREFIX}", ""), TAGGED_SEPARATOR),
        cut_at(c, COLON_SEPARATOR),
        F.when((lead != "") & (inner != ""), _pair(lead, inner)),
    )


def parse_count(c: Column) -> Column:
    """Whole number with thousands separators; null when it is not one."""
    digits = strip_space(F.replace(c, F.lit(","), F.lit("")))
    return F.when(F.rlike(digits, F.lit("[0-9]")), digits.try_cast("bigint"))  # a failed cast costs an exception


def release_year(c: Column) -> Column:
    """Year of a full date, else the first run of four digits, else null."""
    # A failed parse or cast costs an exception, so neither is tried on texts that have not what it needs.
    full = F.when(F.contains(c, F.lit("-")), F.try_to_date(c, "yyyy-MM-dd"))
    digits = F.nullif(F.regexp_extract(c, r"(\d{4})", 1), F.lit(""))
    return F.coalesce(F.year(full), digits.try_cast("int"))


def track_url(c: Column) -> Column:
    return F.replace(c, F.lit(TRACK_URI_PREFIX), F.lit(TRACK_URL_PREFIX))
