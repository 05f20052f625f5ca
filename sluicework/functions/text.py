"""Text operators as column expressions: Bronze text to Silver columns.

All of them stay in the JVM. Regular expressions that must see letters and spaces of every script carry Java's ``(?U)``
flag; plain character classes are used where the set of characters is known, since they are faster.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping, Sequence
from functools import lru_cache
from html.entities import html5

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sluicework import lookups
from sluicework.functions.lookup import blank_to_null, let, literal_array, literal_map, lookup

# Every whitespace character; as patterns for ASCII texts and all others, and as a set of characters to trim.
ASCII_SPACE = r"[\t-\r\x1c-\x1f][\t-\r\x1c-\x20]*|\x20[\t-\r\x1c-\x20]+"
SPACE = r"(?U)[\s\x1c-\x1f]+"
SPACE_CHARACTERS = "".join(chr(code) for code in range(0x10000) if chr(code).isspace())


def strip_space(c: Column) -> Column:
    """Remove leading and trailing whitespace of any kind (``trim`` alone removes plain spaces only)."""
    return F.btrim(c, F.lit(SPACE_CHARACTERS))


def collapse_space(c: Column) -> Column:
    """One space for each run of whitespace, none at the ends. In ASCII texts only the runs that change are matched."""


    def collapse(text: Column) -> Column:
        ascii_only = F.octet_length(text) == F.char_length(text)
        return F.when(ascii_only, F.regexp_replace(text, ASCII_SPACE, " ")).otherwise(F.regexp_replace(text, SPACE, " "))

    return F.trim(let(c, collapse))


def contains_any(c: Column, words: Sequence[str]) -> Column:
    """Whether the lower-case text holds one of ``words``; false for null."""
    low = F.lower(c)
    hit = F.lit(False)
    for word in words:
        hit = hit | low.contains(word)
    return F.coalesce(hit, F.lit(False))


# --- HTML to text ---------------------------------------------------------------------------------------------------

_ATTRIBUTES = r"(?:[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+"
_RAW_TEXT = rf"(script|style)\b{_ATTRIBUTES}>(.*?)(?:</\1\s*>|\z)"
_COMMENT = r"!--.*?(?:-->|\z)"
_DECLARATION = r"!\[CDATA\[.*?\]\]>|[!?][^>]*(?:>|\z)"
_TAG = rf"/?[a-zA-Z]{_ATTRIBUTES}>|/?[a-zA-Z/][^>]*(?:>|\z)"
# The bracket comes first and alone, so that other characters are passed over by one comparison.
_MARKUP = f"(?is)<(?:{_COMMENT}|{_RAW_TEXT}|{_DECLARATION}|{_TAG})"
# Set around the bodies of script and style while the rest is decoded; characters for private use.
_RAW_START, _RAW_END = "", ""

_REFERENCE = r"\A(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
_FREQUENT = {n: html5[n] for n in ("lt;", "gt;", "quot;", "apos;", "nbsp;", "copy;", "eacute;", "rsquo;", "ndash;", "bull;", "amp;")}
# A reference other than the frequent ones, or what may be one.
_RARE = rf"&(?!{'|'.join(_FREQUENT)})[#a-zA-Z]"
# Names that count without their semicolon, also at the beginning of other text.
_UNCLOSED_NAMES = {n: html5[n] for n in sorted(html5, key=lambda n: (-len(n), n)) if not n.endswith(";")}
_UNCLOSED = rf"\A(?:{'|'.join(_UNCLOSED_NAMES)})"
# Numbers that stand for other characters, and numbers that stand for none, after the HTML standard.
_REPLACED = {0: "�", 13: "\r"} | {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)}
_DROPPED = r"\A[\x01-\x08\x0b\x0e-\x1f\x7f\x{fdd0}-\x{fdef}]|[\x{fffe}\x{ffff}]|[\x{1fffe}\x{1ffff}\x{2fffe}\x{2ffff}\x{3fffe}\x{3ffff}]"


def _numeric(reference: Column) -> Column:
    """``#233;`` or ``#xE9;`` -> ``é``."""
    digits = F.regexp_extract(reference, r"\A#[xX]?0*([0-9a-fA-F]*)", 1)
    is_hex = F.lower(F.substring(reference, 2, 1)) == "x"
    code = _code(digits, is_hex)
    plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    replaced = lookup(code.cast("string"), {str(n): char for n, char in _REPLACED.items()})
    none = code.between(0xD800, 0xDFFF) | (code > 0x10FFFF)
    return (
        F.when(none, F.lit("�"))
        .when((code <= 13) | code.between(0x80, 0x9F), F.coalesce(replaced, F.when(plain.rlike(_DROPPED), "").otherwise(plain)))
        .otherwise(F.when(plain.rlike(_DROPPED), "").otherwise(plain))
    )


def _code(digits: Column, is_hex: Column) -> Column:
    """The number, 0 for no digits, beyond all characters for very long ones."""
    known = F.when(is_hex, F.conv(digits, 16, 10)).otherwise(digits).cast("int")
    return F.when(F.length(digits) > 7, F.lit(0x110000)).when(digits == "", F.lit(0)).otherwise(known)


def _named(reference: Column) -> Column:
    """``eacute;`` -> ``é``; the longest name that may go unclosed at its beginning; else the text with its ampersand."""
    known = lookup(reference, html5)
    name = F.regexp_extract(reference, _UNCLOSED, 0)
    begun = F.concat(lookup(name, _UNCLOSED_NAMES), F.substring(reference, F.length(name) + 1, F.length(reference)))
    return F.coalesce(known, begun, F.concat(F.lit("&"), reference))


def _decode_piece(piece: Column) -> Column:
    """Text that followed an ampersand, with the reference at its beginning decoded."""

    def shown(reference: Column) -> Column:
        rest = F.substring(piece, F.length(reference) + 1, F.length(piece))
        value = F.when(reference == "", F.lit("&")).when(reference.startswith("#"), _numeric(reference)).otherwise(_named(reference))
        return F.concat(value, rest)

    return let(F.regexp_extract(piece, _REFERENCE, 0), shown)


def decode_entities(c: Column) -> Column:
    """Decode named (HTML 5) and numeric character references as a browser does, in one pass from left to right.

    Text without ``&`` is passed through untouched. What a reference gives is not read again: ``&amp;lt;`` is ``&lt;``.
    Where only the frequent ones occur they are replaced one after the other: none gives an ampersand but the last.
    """

    def decode(text: Column) -> Column:
        pieces = F.split(text, "&", -1)
        later = F.transform(F.slice(pieces, 2, F.size(pieces)), _decode_piece)
        rare = F.concat(F.get(pieces, F.lit(0)), F.array_join(later, ""))
        frequent = text
        for name, char in _FREQUENT.items():
            frequent = F.replace(frequent, F.lit(f"&{name}"), F.lit(char))
        return F.when(~text.contains("&"), text).when(text.rlike(_RARE), rare).otherwise(frequent)

    return let(c, decode)


def _without_markup(c: Column, drop_script: bool) -> Column:
    """Markup to spaces and references decoded; the bodies of script and style stay as they are, or go."""
    bare = F.when(c.contains("<"), F.regexp_replace(c, _MARKUP, " ")).otherwise(c)
    if drop_script:
        return decode_entities(F.replace(bare, F.lit("<"), F.lit(" < ")))
    bodies = F.split(F.regexp_replace(c, _MARKUP, f" {_RAW_START}$2{_RAW_END} "), _RAW_START, -1)
    parts = F.when(c.rlike(r"(?i)<(?:script|style)\b"), bodies).otherwise(F.array(bare))

    def part(piece: Column) -> Column:
        body = F.when(piece.contains(_RAW_END), F.substring_index(piece, _RAW_END, 1)).otherwise("")
        after = F.when(piece.contains(_RAW_END), F.substring(piece, F.length(body) + 2, F.length(piece))).otherwise(piece)
        return F.concat(body, decode_entities(F.replace(after, F.lit("<"), F.lit(" < "))))

    return F.array_join(F.transform(parts, part), "")


@F.pandas_udf(StringType())
def _parse_html(texts: pd.Series) -> pd.Series:
    from html.parser import HTMLParser

    class Collector(HTMLParser):
        def handle_data(self, data: str) -> None:
            self.parts.append(data)

    def text_of(value: str | None) -> str | None:
        if not value:
            return None
        parser = Collector()
        parser.parts = []
        parser.feed(value)
        parser.close()
        return " ".join(parser.parts)

    return texts.map(text_of)


def clean_html(c: Column, drop_script: bool = False, exact: bool = False) -> Column:
    """HTML to plain text: markup removed, text chunks joined by a space, entities decoded, whitespace collapsed.

    Bodies of script and style stay as text unless ``drop_script``. ``exact`` uses the standard library's HTML parser
    in an Arrow UDF, for input whose markup is too broken for the built-in expressions. Empty results are null.
    """
    if exact:
        text = _parse_html(c)
    else:
        text = _without_markup(c, drop_script)
    return let(collapse_space(text), blank_to_null)


# --- accents --------------------------------------------------------------------------------------------------------


@lru_cache(maxsize=1)
def _accent_table() -> tuple[str, str]:
    """Characters that decompose to one base character plus marks, with that base character."""
    source, target = [], []
    for code in range(0x80, 0x10000):
        char = chr(code)
        base = "".join(x for x in unicodedata.normalize("NFD", char) if unicodedata.category(x) != "Mn")
        if len(base) == 1 and base != char:
            source.append(char)
            target.append(base)
    return "".join(source), "".join(target)


def strip_accents(c: Column) -> Column:
    """'Québec' -> 'Quebec'. ASCII text, the usual case, is passed through after one cheap test."""
    source, target = _accent_table()

    def plain(text: Column) -> Column:
        bare = F.regexp_replace(F.translate(text, source, target), r"\p{Mn}+", "")
        return F.when(text.rlike(r"[^\x00-\x7F]"), bare).otherwise(text)

    return let(c, plain)


# --- extraction and classification ----------------------------------------------------------------------------------



def extract_years(
    text: Column,
    patterns: Sequence[str] = tuple(lookups.YEARS_PATTERNS),
    guard: str | None = "(?i)year",
    words: Sequence[str] | None = None,
) -> Column:
    """Number captured by the first pattern that matches; null when none does.

    ``guard`` is a cheap test that every matching text passes; it saves running all patterns on all texts. ``words`` has
    a lower-case word for each pattern that every ASCII text it matches holds ('' for none), to the same end; those of
    the default patterns are known.
    """
    if words is None:
        words = lookups.YEARS_WORDS if tuple(patterns) == tuple(lookups.YEARS_PATTERNS) else [""] * len(patterns)
    low, other = F.lower(text), F.octet_length(text) != F.char_length(text)

    def hit(pattern: str, word: str) -> Column:
        number = F.regexp_extract(text, f"(?iU){pattern}", 1).try_cast("int")
        # Beyond ASCII, other characters may count as the same letter.
        return F.when(low.contains(word) | other, number) if word else number

    found = F.coalesce(*(hit(p, w) for p, w in zip(patterns, words, strict=True)))
    return F.when(text.rlike(guard), found) if guard else found


def classify_by_rules(
    title: Column,
    years: Column,
    rules: Sequence[tuple[str, Sequence[str]]] = tuple(lookups.TITLE_RULES),
    brackets: Sequence[tuple[int, str]] = tuple(lookups.YEARS_BRACKETS),
    default: str = lookups.SENIORITY_DEFAULT,
) -> Column:
    """Label of the first rule whose pattern is in the title, else of the first bracket that holds the years."""
    out = None
    for label, patterns in rules:
        hit = title.rlike("(?iU)" + "|".join(patterns))
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    for limit, label in brackets:
        hit = years <= limit
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def infer_flag_from_text(flag: Column, text: Column, words: Sequence[str] = tuple(lookups.REMOTE_WORDS)) -> Column:
    """The flag, or true when the text holds one of the words; never null."""
    return F.coalesce(flag, F.lit(False)) | contains_any(text, words)


def _alternation(terms: Sequence[str]) -> str:
    """Pattern of the first term, in their order, that stands at a place. Those with the same first character are put
    together, so that most places are passed over by one comparison for each such character."""
    groups: dict[str, list[str]] = {}
    for term in terms:
        groups.setdefault(term[:1], []).append(re.escape(term[1:]))
    if "" in groups:
        return "|".join(re.escape(t) for t in terms)
    return "|".join(f"{re.escape(first)}(?:{'|'.join(rests)})" for first, rests in groups.items())


def extract_tags(text: Column, taxonomy: Sequence[str] = tuple(lookups.TAXONOMY)) -> Column:
    """Sorted unique lower-case terms of the taxonomy found as whole words by one scan; an empty array for null text."""
    terms = [t.lower() for t in taxonomy]
    found = F.regexp_extract_all(F.lower(text), F.lit(rf"(?U)\b({_alternation(terms)})\b"), F.lit(1))
    return F.coalesce(F.array_sort(F.array_distinct(found)), F.array().cast("array<string>"))


def province_alone(text: Column, codes: Mapping[str, str] = lookups.PROVINCE_CODES) -> Column:
    """Province of the first code that stands alone in a text."""
    return lookup(F.regexp_extract(text, rf"(?U)(?:,\s*|\s)({'|'.join(codes)})(?:\s|,|$|\b)", 1), codes)


def infer_location_from_text(
    text: Column,
    cities: dict[str, str] = lookups.CITY_PROVINCES,
    codes: dict[str, str] = lookups.PROVINCE_CODES,
) -> Column:
    """Struct (city, province) from "City, Province" in a text, else the province of a code standing alone.

    Among all cities followed by their province's name or by any code, the longest name wins, then table order; the
    city's own province is returned. A pattern is run only for a city whose name is in the text.
    """
    ranked = sorted(cities, key=len, reverse=True)
    any_code = "|".join(codes)
    patterns = {
        c: rf"(?U){re.escape(c)},?\s*(?:{re.escape(cities[c].lower())}|{any_code.lower()})\b" for c in ranked
    }
    names = {c: lookups.city_display(c) for c in ranked}

    def best_city(low: Column) -> Column:
        hits = F.filter(literal_array(ranked), lambda c: low.contains(c) & F.rlike(low, lookup(c, patterns)))
        first = F.slice(hits, 1, 1)
        places = F.transform(first, lambda c: F.struct(lookup(c, names).alias("city"), lookup(c, cities).alias("province")))
        return F.get(places, F.lit(0))

    by_code = F.struct(F.lit(None).cast("string").alias("city"), province_alone(text, codes).alias("province"))
    return F.when(text.isNotNull(), F.coalesce(let(F.lower(text), best_city), by_code))


def has_odd_characters(c: Column) -> Column:
    """Whether a text holds symbols or anything outside ASCII; false for null."""
    return F.coalesce(c.rlike(r"[\p{S}]|[^\x00-\x7F]"), F.lit(False))
