"""Column helpers for text, money and message formatting. All stay on the JVM."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, functions as F

# All characters Python and Unicode call white space; also used to trim values.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
LINE_BREAKS = "\n\r\x0b\x0c\x1c\x1d\x1e\x85  "

_DIGITS = [c for c in map(chr, range(0x80, 0x110000)) if c.isdigit()]
_FOREIGN_DIGITS = [c for c in _DIGITS if unicodedata.category(c) == "Nd"]


def _ranges(characters: list[str]) -> str:
    """The characters as ranges of a regular expression class."""
    out = []
    for c in characters:
        if out and ord(c) == ord(out[-1][1]) + 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(a if a == b else f"{a}-{b}" for a, b in out)


# Digits that are not decimal digits: superscripts, circled digits and the like.
_OTHER_DIGITS = _ranges([c for c in _DIGITS if unicodedata.category(c) != "Nd"])

# i: any case, d: only \n ends a line, U: Unicode-aware \s \d \b.
REGEX_FLAGS = "(?idU)"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def first_match(text: Column, patterns: list[str]) -> Column:
    """Stripped group 1 of the first pattern found anywhere in ``text``, else null."""
    return F.coalesce(*[
        blank_to_null(strip(F.regexp_extract(text, REGEX_FLAGS + p, 1))) for p in patterns
    ])


def first_line(text: Column) -> Column:
    """First non-blank line, stripped; '' if there is none."""
    body = F.ltrim(text, F.lit(WHITESPACE))
    line = F.regexp_extract(body, f"^[^{LINE_BREAKS}]*", 0)
    return F.coalesce(F.rtrim(line, F.lit(WHITESPACE)), F.lit(""))


def clean_money(raw: Column) -> Column:
    """'1,234.50' -> 1234.5, null if it is no number."""
    plain = F.translate(raw, "".join(_FOREIGN_DIGITS) + ",",
                        "".join(str(unicodedata.digit(c)) for c in _FOREIGN_DIGITS))
    return F.round(plain.try_cast("double"), 2)


def digit_count(text: Column) -> Column:
    """Number of digits of any script; plain ASCII text takes the quick way."""
    every = F.regexp_count(text, F.lit(r"\p{Nd}")) + F.regexp_count(text, F.lit(f"[{_OTHER_DIGITS}]"))
    return F.when(F.octet_length(text) == F.length(text), F.regexp_count(text, F.lit("[0-9]"))).otherwise(every)


def number_text(c: Column) -> Column:
    """A double written the shortest way without an exponent: 2808.0, 4090.27, 12345678.5."""
    magnitude = F.abs(c)
    fixed = F.regexp_replace(c.cast("decimal(38,2)").cast("string"), "0$", "")
    return F.when((magnitude >= 1e-3) & (magnitude < 1e7), c.cast("string")).otherwise(fixed)


def grouped(c: Column, digits: int) -> Column:
    """Thousands separators and fixed digits, half-even."""
    return F.format_number(c, digits)


def fixed(c: Column, digits: int) -> Column:
    return F.replace(F.format_number(c, digits), F.lit(","), F.lit(""))


def fill(template: str, **columns: Column) -> Column:
    """A message text with its {names} replaced by columns."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[F.lit(p) if i % 2 == 0 else columns[p].cast("string")
                      for i, p in enumerate(parts) if p])
