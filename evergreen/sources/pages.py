"""Totals read out of landed web pages."""

from __future__ import annotations

from dataclasses import dataclass
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evergreen.functions.parse import parse_count, parse_line, split_dash
from evergreen.functions.text import strip_space


@dataclass(frozen=True)
class Layout:
    """Where the rows and cells of a page are; ``container`` narrows the search first."""

    row: str
    cell: str
    container: tuple[str, ...] = ()


@dataclass(frozen=True)
class TotalsPage:
    """A table of totals: fewest cells of a usable row, the value's cell, the name format."""

    value_col: str
    min_cells: int
    value_cell: int
    free_form_names: bool = False


# Page layouts.
TABLE = Layout(
    row=r"(?is)<tr\b[^>]*>(.*?)(?=<tr\b|</tr|</tbody|</table|\z)",
    cell=r"(?is)<td\b[^>]*>(.*?)(?=<td\b|<tr\b|</td|</tr|\z)",
    container=(r"(?is)<table\b[^>]*>(.*?)(?=</table|\z)", r"(?is)<tbody\b[^>]*>(.*?)(?=</tbody|</table|\z)"),
)
LINK_LIST = Layout(row=r"(?is)<li\b[^>]*>(.*?)(?=<li\b|</li|</ul|</ol|\z)", cell=r"(?is)<a\b[^>]*>(.*?)</a>")
STREAM_TOTALS = TotalsPage("spotify_streams", 2, 1)
VIDEO_TOTALS = TotalsPage("youtube_views", 2, 1, free_form_names=True)
STORE_TOTALS = TotalsPage("itunes_total", 5, 4)
SUBSCRIPTION_TOTALS = TotalsPage("apple_total", 5, 4)


def decode_references(c: Column) -> Column:
    """Named and numeric character references that end in a semicolon; unknown ones stay as they are."""
    names = F.create_map(*[F.lit(x) for n, i in sorted(name2codepoint.items()) for x in (n, chr(i))], F.lit("apos"), F.lit("'"))

    def one(piece: Column) -> Column:
        name = F.regexp_extract(piece, r"^&(\w+);", 1)
        decimal, hexadecimal = (F.regexp_extract(piece, p, 1) for p in (r"^&#(\d+);", r"^&#[xX]([0-9a-fA-F]+);"))
        number = F.when(decimal != "", decimal.try_cast("bigint")).otherwise(F.conv(hexadecimal, 16, 10).try_cast("bigint"))
        is_character = (number > 0) & (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        safe = F.when(is_character, number).otherwise(0xFFFD)
        letter = F.decode(F.unhex(F.lpad(F.hex(safe), 8, "0")), "UTF-32")
        return (
            F.when((decimal != "") | (hexadecimal != ""), letter)
            .when(name != "", F.coalesce(F.try_element_at(names, name), piece))
            .otherwise(piece)
        )

    pieces = F.regexp_extract_all(c, F.lit(r"(?s)&#?\w+;|.[^&]*"), 0)
    return F.when(F.contains(c, F.lit("&")), F.array_join(F.transform(pieces, one), "")).otherwise(c)


def cell_text(html: Column) -> Column:
    """Text of a cell: tags and the space around them removed, entities decoded."""
    bare = strip_space(F.regexp_replace(html, r"(?U)\s*<[^>]*>\s*", ""))
    return strip_space(decode_references(F.coalesce(bare, F.lit(""))))


def page_rows(pages: DataFrame, keep: list[str], layout: Layout, min_cells: int) -> DataFrame:
    """(keep, pos, cells): rows with at least ``min_cells`` raw cells, in page order.

    Comments hold no rows; rows and cells may lack their end tags.
    """
    body = F.regexp_replace("html", r"(?s)<!--.*?(?:-->|\z)", "")
    for pattern in layout.container:
        body = F.regexp_extract(body, pattern, 1)
    found = pages.select(
        *keep, F.posexplode(F.regexp_extract_all(body, F.lit(layout.row), 1)).alias("pos", "_row")
    )
    cells = F.regexp_extract_all(F.col("_row"), F.lit(layout.cell), 1)
    return found.select(*keep, "pos", cells.alias("cells")).filter(F.size("cells") >= min_cells)


def page_totals(pages: DataFrame, keep: list[str], page: TotalsPage) -> DataFrame:
    """(keep, pos, artist, title, value): null parts mark a row that must be rejected."""
    rows = page_rows(pages, keep, TABLE, page.min_cells).select(
        *keep,
        "pos",
        cell_text(F.get("cells", F.lit(0))).alias("_name"),
        cell_text(F.get("cells", F.lit(page.value_cell))).alias("_value"),
    )
    parsed = parse_line(F.col("_name")) if page.free_form_names else split_dash(F.col("_name"))
    return rows.select(
        *keep, "pos", parsed.alias("_pair"), parse_count(F.col("_value")).alias(page.value_col)
    ).select(*keep, "pos", "_pair.artist", "_pair.title", page.value_col)


def is_usable(page: TotalsPage) -> Column:
    """Rows that become totals: name and number were read (free-form names must be non-empty)."""
    ok = F.col("artist").isNotNull() & F.col("title").isNotNull() & F.col(page.value_col).isNotNull()
    return ok & (F.col("artist") != "") & (F.col("title") != "") if page.free_form_names else ok


def extract_totals(pages: DataFrame, keep: list[str], page: TotalsPage) -> DataFrame:
    return page_totals(pages, keep, page).filter(is_usable(page))
