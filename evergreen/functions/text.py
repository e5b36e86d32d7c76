"""Text normalisation as native column expressions.

Word characters are spelled ``\\p{L}\\p{N}_`` so that accented letters count and
combining marks do not; ``d`` makes ``\\n`` the only line end.  Canonical
decomposition has no SQL function, but where its marks are dropped anyway it is a
translation of single characters, which the planner can move filters past.

Regular expressions dominate the cost of a run, so plain ASCII names, which most
are, skip the chain after one test, and cuts that all run to the end of the line
share one pattern where their order cannot matter.
"""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())

# Separators, suffixes and characters that decide when two credits are equal.
SPACE = r"\s\x1c-\x1f\x85\p{Z}"
NOT_WORD_OR_SPACE = rf"[^\p{{L}}\p{{N}}_{SPACE}]+"
PARENTHESISED = r"\([^)]*\)"
BRACKETED = r"\[[^\]]*\]"
EDITION_OR_PUNCTUATION = rf" - .*$|{NOT_WORD_OR_SPACE}"
LEADING_THE_OR_GUESTS = r"(?U)^the\s+|(?:[(,]|(?=[fvw])\b(?:feat\.?|ft\.?|featuring|with|vs\.?)\b).*"
AND_OR_X_OR_SLASH_OR_PUNCTUATION = rf"(?:[ \t][&x][ \t][^{SPACE}]|/).*|{NOT_WORD_OR_SPACE}"
PLAIN_TITLE = r"^[a-z0-9]+(?: [a-z0-9]+)*$"
PLAIN_NAME = r"^(?=[a-z0-9]+(?: [a-z0-9]+)*$)"
PLAIN_ARTIST = rf"{PLAIN_NAME}(?!the )(?!(?:.* )?(?:feat|ft|featuring|with|vs)(?: |$))(?!.* x )"
PLAIN_PRIMARY = rf"{PLAIN_NAME}(?!(?:.* )?(?:feat|ft|featuring|with|and|x)(?: |$))"
PRIMARY_KEYWORD = r"\b(?:featuring|feat\.?|ft\.?|with)\b.*"
PRIMARY_PUNCTUATION = r"[;,:].*"
PRIMARY_AMBIGUOUS = r"(?:\b(?:and|x)\b(?=\s*\S).*|&.*)"
FEATURED_SPLIT = r"[ \t](?:featuring|feat\.?|ft\.?)[ \t]"
COLLABORATOR_SPLIT = "|".join(
    [r"\s*,\s*", r"\s*&\s*", r"\s*/\s*", r"\s*:\s*", r"\s+x\s+", r"\s+with\s+", r"\s+vs\.?\s+", FEATURED_SPLIT]
)
SINGLE_NAME = r"(?Ui)^(?!.*\s(?:x|with|vs\.?|featuring|feat\.?|ft\.?)\s)[^,&/:⁄\"“”‘’'\n]+$"
SEPARATOR = "[,&/:⁄\"“”‘’']"
# Printable ASCII but separators and quotes; in such a text only words between blanks part names.
PLAIN_CREDIT = r"^[ !#-%(-+\-.0-9;-~]+\z"
PARTING_WORD = r" (?:x|with|vs\.?|featuring|feat\.?|ft\.?) "
QUOTES = "\"“”‘’'"
ATOMIC_ACTS = ("AC/DC", "HUNTR/X")
SLASH_STAND_IN = "⁄"


def _sub(c: Column, pattern: str, to: str = "", flags: str = "d") -> Column:
    return F.regexp_replace(c, f"(?{flags}){pattern}", to)


def _cut_once(c: Column, pattern: str) -> Column:
    """Delete the leftmost match, which runs to the end of its line; keep the following lines."""
    return F.regexp_replace(c, rf"(?Udi){pattern}((?s:\n.*)?)\z", "$1")


def _chain(c: Column, patterns: list[str]) -> Column:
    return reduce(_sub, patterns, c)


def strip_space(c: Column) -> Column:
    """Trim any Unicode white space (plain ``trim`` removes blanks only)."""
    return F.btrim(c, F.lit(WHITESPACE))


def squeeze(c: Column) -> Column:
    return F.trim(_sub(c, f"[{SPACE}]+", " "))


def _is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.length(c)


def _unmarked(ch: str) -> str:
    return "".join(x for x in unicodedata.normalize("NFD", ch) if unicodedata.category(x) != "Mn")


HANGUL = (0xAC00, 0xD7A3)
LEADS, VOWELS, TAILS = ("".join(map(chr, r)) for r in (range(0x1100, 0x1113), range(0x1161, 0x1176), range(0x11A8, 0x11C3)))
# All other characters that decomposition changes, by what is left of them without marks.
_CHANGED = {
    chr(i): _unmarked(chr(i))
    for i in range(0xC0, 0x30000)
    if not HANGUL[0] <= i <= HANGUL[1] and unicodedata.decomposition(chr(i)) and _unmarked(chr(i)) != chr(i)
}
SINGLE = {ch: left for ch, left in _CHANGED.items() if len(left) == 1}
SEVERAL = {ch: left for ch, left in _CHANGED.items() if len(left) > 1}
MARKS = "".join(chr(i) for i in (*range(0x300, 0x30000), *range(0xE0100, 0xE01F0)) if unicodedata.category(chr(i)) == "Mn")
HAS_SEVERAL = f"[{chr(HANGUL[0])}-{chr(HANGUL[1])}{''.join(SEVERAL)}]"


def _jamo(ch: Column) -> Column:
    """The two or three letters of a Hangul syllable, by the arithmetic of its code point."""
    place = F.ascii(ch) - HANGUL[0]
    pick = lambda letters, at: F.substring(F.lit(letters), at.cast("int"), F.lit(1))
    tail = place % len(TAILS + " ")
    per_lead = len(VOWELS) * len(TAILS + " ")
    vowel = F.floor(place % per_lead / len(TAILS + " "))
    lead = F.floor(place / per_lead)
    return F.concat(pick(LEADS, lead + 1), pick(VOWELS, vowel + 1), F.when(tail > 0, pick(TAILS, tail)).otherwise(""))


def _spelled_out(c: Column) -> Column:
    """Syllables and letters that decompose into several ones, in texts that hold any."""
    several = F.create_map(*[F.lit(x) for pair in SEVERAL.items() for x in pair])

    def one(ch: Column) -> Column:
        is_hangul = F.ascii(ch).between(*HANGUL)
        return F.when(is_hangul, _jamo(ch)).otherwise(F.coalesce(F.try_element_at(several, ch), ch))

    letters = F.transform(F.regexp_extract_all(c, F.lit("(?s)."), 0), one)
    return F.when(F.rlike(c, F.lit(HAS_SEVERAL)), F.array_join(letters, "")).otherwise(c)


def _drop_marks(c: Column) -> Column:
    """Letters become what they decompose to; marks, which have no counterpart, go."""
    single = {ch: left for ch, left in SINGLE.items() if ch not in MARKS}
    return F.translate(_spelled_out(c), "".join(single) + MARKS, "".join(single.values()))


def strip_accents(c: Column) -> Column:
    """Canonical decomposition without the nonspacing marks."""
    return F.when(_is_ascii(c), c).when(c.isNotNull(), _drop_marks(c))


_TITLE_TAIL = [PARENTHESISED, BRACKETED, EDITION_OR_PUNCTUATION]


def _plain_or(c: Column, plain: str, full: Column) -> Column:
    """``c`` lowered when that is already its key, else ``full``; null stays null."""
    lowered = F.lower(c)
    return F.when(F.rlike(lowered, F.lit(plain)), lowered).when(c.isNotNull(), full)


def title_key(c: Column) -> Column:
    """Key of a title; a null title has a null key and is never matched."""
    base = strip_space(F.lower(c))
    base = F.when(_is_ascii(c), base).otherwise(_drop_marks(base))
    return _plain_or(c, PLAIN_TITLE, squeeze(_chain(base, _TITLE_TAIL)))


def _link_tail(raw: Column, c: Column) -> Column:
    base = F.when(_is_ascii(raw), c).otherwise(_drop_marks(c))
    return squeeze(_chain(strip_space(F.lower(base)), _TITLE_TAIL))


def link_title_key(c: Column) -> Column:
    """Title key of the link tables: marks are dropped before lowering."""
    return _plain_or(c, PLAIN_TITLE, _link_tail(c, c))


def artist_key(c: Column) -> Column:
    """Key of the primary artist of a credit, before aliases."""
    base = strip_space(F.lower(c))
    base = F.when(_is_ascii(c), base).otherwise(_drop_marks(base))
    cuts = [LEADING_THE_OR_GUESTS, AND_OR_X_OR_SLASH_OR_PUNCTUATION]
    return _plain_or(c, PLAIN_ARTIST, squeeze(_chain(F.replace(base, F.lit("$"), F.lit("s")), cuts)))


def primary_artist(c: Column) -> Column:
    """Link-table key of the first credited artist; each cut happens at most once."""
    cut = reduce(_cut_once, [PRIMARY_KEYWORD, PRIMARY_PUNCTUATION, PRIMARY_AMBIGUOUS], c)
    return _plain_or(c, PLAIN_PRIMARY, _link_tail(c, cut))


def apply_aliases(df: DataFrame, col: str, aliases: dict[str, str]) -> DataFrame:
    """Replace ``col`` by its alias where one is configured (a literal map, no join)."""
    if not aliases:
        return df
    pairs = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
    return df.withColumn(col, F.coalesce(F.try_element_at(pairs, F.col(col)), F.col(col)))


def with_keys(
    df: DataFrame, aliases: dict[str, str], title: str = "title", artist: str = "artist"
) -> DataFrame:
    """Add ``key_title`` and ``key_artist``; rows lacking a title or artist are kept out."""
    known = df.filter(F.col(title).isNotNull() & F.col(artist).isNotNull())
    keyed = known.withColumns({"key_title": title_key(F.col(title)), "key_artist": artist_key(F.col(artist))})
    return apply_aliases(keyed, "key_artist", aliases)


def strip_quotes(c: Column) -> Column:
    return strip_space(F.btrim(strip_space(c), F.lit(QUOTES)))


def _protect(c: Column) -> Column:
    for act in ATOMIC_ACTS:
        parts = act.split("/")
        pattern = "/".join(f"(\\Q{p}\\E)" for p in parts)
        c = _sub(c, pattern, SLASH_STAND_IN.join(f"${i + 1}" for i in range(len(parts))), "Udi")
    return c


def collaborators(c: Column) -> Column:
    """Every name in a credit, in order, as an array."""
    parts = F.split(_protect(strip_quotes(c)), f"(?Udi){COLLABORATOR_SPLIT}")
    names = F.transform(parts, lambda p: F.replace(strip_quotes(p), F.lit(SLASH_STAND_IN), F.lit("/")))
    return F.filter(names, lambda n: n != "")


def is_single_name(c: Column) -> Column:
    """No separator and no quote: the credit is its only name."""
    plain = ~F.rlike(F.lower(c), F.lit(PARTING_WORD))
    return (
        F.when(F.rlike(c, F.lit(SEPARATOR)), F.lit(False))
        .when(F.rlike(c, F.lit(PLAIN_CREDIT)), plain)
        .otherwise(F.rlike(c, F.lit(SINGLE_NAME)))
    )


def collaborators_joined(c: Column) -> Column:
    is_plain = F.rlike(c, F.lit(PLAIN_CREDIT)) & ~F.rlike(F.lower(c), F.lit(PARTING_WORD))
    return F.when(is_plain, strip_space(c)).otherwise(F.array_join(collaborators(c), ";"))


def split_featured(c: Column) -> tuple[Column, Column]:
    """(main, featured) of a credit at the first featuring marker; featured may be null."""
    parts = F.split(strip_quotes(c), f"(?Udi){FEATURED_SPLIT}", 2)
    featured = F.get(parts, F.lit(1))
    main = F.when(featured.isNull(), F.get(parts, F.lit(0))).otherwise(strip_space(F.get(parts, F.lit(0))))
    return main, strip_space(featured)


def display_credit(c: Column) -> Column:
    main, featured = split_featured(c)
    return F.when(featured != "", F.concat(main, F.lit(" feat. "), featured)).otherwise(main)


def first_of_list(c: Column, sep: str = ";") -> Column:
    return F.substring_index(c, sep, 1)


def has_word(c: Column, word: str) -> Column:
    """Case-insensitive whole-word test, false for null."""
    return F.coalesce(F.rlike(c, F.lit(rf"(?Udi)\b{word}\b")), F.lit(False))
