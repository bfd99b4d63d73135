"""Splitting message text into tokens, as native regular-expression columns.

The grammar is written without flags: case and Unicode are spelled out in the
character classes, so Java's engine and a linear-time engine read it alike. Repetition is over single character
classes only, which Java matches in a loop: a text of any length is safe
from stack overflow.
"""

from __future__ import annotations

from collections.abc import Callable
from html import entities

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The character classes (bodies, to be put in brackets).
# LETTER is a-z in any case, with the four non-ASCII characters that case
# folding maps onto ASCII letters.
SPACE = r"\t-\r\x1C-\x20\x85\p{Z}"
WORD = r"\p{L}\p{N}_"
LETTER = r"a-zA-Z\x{130}\x{131}\x{17F}\x{212A}"
DIGIT = r"\p{Nd}"
EYES = r":;=8"
NOSE = r"\-oO*'"
MOUTH = r")\](\[dDpP/:}{@|\\"
URL_CHAR = r"!$-_a-z\x{130}\x{131}\x{17F}\x{212A}"

# The token classes. The first one that matches at a place wins.
PHONE = (
    rf"(?:\+?[01][-.{SPACE}]*)?"  # country prefix
    rf"(?:\(?[{DIGIT}]{{3}}[-.){SPACE}]*)?"  # area code
    rf"[{DIGIT}]{{3}}[-.{SPACE}]*[{DIGIT}]{{4}}"
)
URL = rf"[hH][tT][tT][pP][sS\x{{17F}}]?://[{URL_CHAR}]+"
EMOTICON = rf"[<>]?[{EYES}][{NOSE}]?[{MOUTH}]|[{MOUTH}][{NOSE}]?[{EYES}][<>]?"
TAG = r"<[^>]+>"
USER = rf"@[{WORD}]+"
HASHTAG = rf"#+[{WORD}][{WORD}'\-]*[{WORD}]"
JOINED_WORD = rf"[{LETTER}][{LETTER}'_\-]+[{LETTER}]"
NUMBER = rf"[+\-]?[{DIGIT}]+[,/.:\-][{DIGIT}]+[+\-]?"
PLAIN_WORD = rf"[{WORD}]+"
ELLIPSIS = rf"\.[.{SPACE}]*\."
OTHER = rf"[^{SPACE}]"

CLASSES = (PHONE, URL, EMOTICON, TAG, USER, HASHTAG, JOINED_WORD, NUMBER, PLAIN_WORD, ELLIPSIS, OTHER)
# The two entity forms, and the one entity with a spelling of its own.
NUMERIC_ENTITY = rf"&#[{DIGIT}]+;"
NAMED_ENTITY = rf"&[{WORD}]+;"
AMP = "&amp;"
# ---------------------------------------------------------------------------

# The grammar as one plain alternation, and the form that Spark runs, which
# cannot change a match but is about twice as fast: an ASCII letter that begins
# neither a URL nor an emoticon can only begin a word, so words come first, with
# frequent characters named before Unicode properties; and the costlier classes
# first look at one character.
PLAIN_TOKEN = "|".join(CLASSES)
_FIRST_CHARACTER = {
    PHONE: rf"+({DIGIT}",
    URL: "hH",
    EMOTICON: rf"<>{EYES}{MOUTH}",
    NUMBER: rf"+\-{DIGIT}",
}
_WORD_FIRST = (
    rf"(?=[a-zA-Z])(?![hH][tT][tT][pP]|[dDpP][{NOSE}]?[{EYES}])"
    rf"(?:{JOINED_WORD}|[a-zA-Z0-9{WORD}]+)"
)
TOKEN = "|".join(
    [_WORD_FIRST, *(f"(?=[{_FIRST_CHARACTER[c]}])(?:{c})" if c in _FIRST_CHARACTER else c for c in CLASSES)]
)
# No token begins with a space: the one before it is passed over in the same step (one only, so that long gaps stay linear).
_SPACED_TOKEN = f"[{SPACE}]?+({TOKEN})"


def normalise_entities(text: Column, decode: bool = False) -> Column:
    """Spell `&amp;` as " and " in texts that hold some other named entity too.

    That condition is what the established results rest on. By default other
    entities stay as they are; `decode=True` also turns `&#233;` and `&eacute;`
    into the characters they name. Unknown names and impossible codes stay.
    """
    # Most texts hold no `&` at all and need no look for entities.
    has_other = text.contains("&") & F.replace(text, F.lit(AMP), F.lit(" ")).rlike(NAMED_ENTITY)
    decoded = _decode_named(_decode_numeric(text)) if decode else text
    return F.when(has_other, F.replace(decoded, F.lit(AMP), F.lit(" and "))).otherwise(decoded)


def _each_replaced(text: Column, pattern: str, change: Callable[[Column], Column]) -> Column:
    """The text with every match changed, in one pass: the pieces between matches, and the changed matches, in turn."""
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(between, found, lambda gap, match: F.concat(gap, F.when(match.isNull(), "").otherwise(change(match))))
    return F.array_join(pairs, "")


def _decode_numeric(text: Column) -> Column:
    def char(entity: Column) -> Column:
        code = F.substring(entity, F.lit(3), F.length(entity) - 3).try_cast("bigint")
        possible = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        return F.when(possible, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(entity)

    return _each_replaced(text, NUMERIC_ENTITY, char)


def _decode_named(text: Column) -> Column:
    names = {f"&{name};": chr(code) for name, code in entities.name2codepoint.items() if name != "amp"}
    table = F.create_map(*[F.lit(part) for pair in names.items() for part in pair])
    return _each_replaced(text, NAMED_ENTITY, lambda entity: F.coalesce(F.try_element_at(table, entity), entity))


def raw_tokens(text: Column, decode_entities: bool = False) -> Column:
    """The tokens of a text in order, in their own case: `array<string>`."""
    return F.regexp_extract_all(normalise_entities(text, decode_entities), F.lit(_SPACED_TOKEN), F.lit(1))


def fold_case(token: Column, keep_case: str = "url") -> Column:
    """Lower-case one token unless it holds a URL (or, on request, an emoticon)."""
    kept = {"url": token.contains("://") & token.rlike(URL), "emoticon": token.rlike(EMOTICON)}[keep_case]
    return F.when(kept, token).otherwise(F.lower(token))


def tokens(text: Column, keep_case: str = "url", decode_entities: bool = False) -> Column:
    """The tokens of a text in order, case folded: `array<string>`."""
    return F.transform(raw_tokens(text, decode_entities), lambda t: fold_case(t, keep_case))
