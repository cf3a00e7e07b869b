"""String functions whose meaning differs from Spark's closest built-in, as Column expressions.

Whitespace is Unicode's, as in Python's ``str.strip``; digits in patterns are Unicode's too; matches of a whole value end
at ``\\z``, never before a final line feed.
"""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a line ends at (fixed values): CR LF, LF, CR, VT, FF, FS, GS, RS, NEL, LS and PS.
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
#: White space (fixed values): Unicode's, and the separators FS to US.
SPACES = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """body(value) with the value written, and computed, once: a deep expression used often would grow without bound."""
    return F.element_at(F.transform(F.array(value), body), 1)


#: The characters of ``SPACES`` but the blank.
_RARE = [chr(c) for c in (*range(9, 14), *range(28, 32), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


def strip(c) -> Column:
    """Without white space at either end. Blanks are trimmed; only where something rarer is left does a pattern look for it."""
    rare = lambda v: F.substring(v, 1, 1).isin(*_RARE) | F.substring(v, -1, 1).isin(*_RARE)
    return let(F.trim(col(c)), lambda v: F.when(rare(v), F.regexp_replace(v, rf"\A{SPACES}+|{SPACES}+\z", "")).otherwise(v))


def lstrip(c) -> Column:
    return F.regexp_replace(col(c), rf"\A{SPACES}+", "")


def unquote_marks(c) -> Column:
    """Without any run of quote characters at either end."""
    return F.btrim(col(c), F.lit("\"'"))


def lines(c) -> Column:
    """The lines of a text: a final line end makes no empty line, an empty text has none."""
    return let(F.split(col(c), LINE_END), lambda p: F.when(F.element_at(p, -1) == "", F.slice(p, F.lit(1), F.size(p) - 1)).otherwise(p))


def full_match(c, pattern: str) -> Column:
    """Whether the whole value matches; null is null."""
    return col(c).rlike(rf"(?U)\A(?:{pattern})\z")


def key_of(c) -> Column:
    """The stripped part before the first colon."""
    return strip(F.element_at(F.split(col(c), ":", 2), 1))


def value_of(c) -> Column:
    """The stripped part after the first colon, without quote characters around it; empty without a colon."""
    return unquote_marks(strip(F.coalesce(F.get(F.split(col(c), ":", 2), F.lit(1)), F.lit(""))))


def normalized_id(c) -> Column:
    """An id's value: cut at the first `` #``, stripped, without quotes."""
    return unquote_marks(strip(F.substring_index(col(c), " #", 1)))


def _digit_table() -> tuple[str, str]:
    """Every decimal digit of Unicode beyond ASCII, and the ASCII digit of the same value."""
    other = [chr(c) for c in range(128, sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Nd"]
    return "".join(other), "".join(str(unicodedata.decimal(c)) for c in other)


def digits(c) -> Column:
    """With all decimal digits as ASCII digits, as a number's value is read from any script."""
    return F.translate(col(c), *_digit_table())


def percent_decoded(c) -> Column:
    """Percent escapes decoded, a plus kept; what is no escape stays as it is.

    Each run of escapes is decoded as a whole, so that the bytes of a character may be several of them; bytes that are not UTF-8
    become the replacement character, one for each part that cannot be decoded.
    """
    runs = F.regexp_extract_all(col(c), F.lit(r"(?:%[0-9A-Fa-f]{2})+|(?:(?!%[0-9A-Fa-f]{2})[\s\S])+"), F.lit(0))
    bytes_of = lambda x: F.unhex(F.replace(x, F.lit("%"), F.lit("")))
    plain = F.array_join(F.transform(runs, lambda x: F.when(x.rlike(r"\A%[0-9A-Fa-f]{2}"), F.make_valid_utf8(bytes_of(x).cast("string"))).otherwise(x)), "")
    return F.when(col(c).contains("%"), plain).otherwise(col(c))


def link_target(c) -> Column:
    """The path of a Markdown link: unwrapped or the first word, without its anchor, decoded; blank gives an empty path."""
    inner = lambda c: F.when(c.startswith("<") & c.contains(">"), F.regexp_extract(c, r"(?s)\A<([^>]*)>", 1)).otherwise(F.regexp_extract(c, rf"(?s)\A((?:(?!{SPACES}).)*)", 1))
    return let(F.substring_index(let(strip(c), inner), "#", 1), percent_decoded)


def folded(path: Column) -> Column:
    """A relative path with ``.`` and ``..`` resolved; what leads above the root is null."""
    step = lambda acc, x: (
        F.when(acc.isNull() | x.isin("", "."), acc)
        .when((x == "..") & (F.size(acc) == 0), F.lit(None).cast("array<string>"))
        .when(x == "..", F.slice(acc, F.lit(1), F.size(acc) - 1))
        .otherwise(F.concat(acc, F.array(x)))
    )
    return F.array_join(F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), step), "/")
