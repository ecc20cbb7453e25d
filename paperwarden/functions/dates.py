"""Date reading: a fixed ladder of shapes, month before day, partial dates stay unread.

Each step is a shape test plus ``try_cast`` to date, so a value that does not
fit costs no exception and the whole ladder stays in generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .fixed_values import MONTHS
from .text import blank_to_null, strip

_MONTH = "(" + "|".join(sorted(MONTHS, key=len, reverse=True)) + ")"
_ORDINAL = r"\b(\d{1,2})(?:st|nd|rd|th)\b"
_OTHER_WORD = rf"\b(?!{_MONTH}\b)[a-z]+\b"

# (shape, order of the groups as year, month, day)
NUMERIC_SHAPES = [
    (r"^(\d{4})[-/](\d{1,2})[-/](\d{1,2})$", "$1-$2-$3"),
    (r"^(\d{1,2})[-/](\d{1,2})[-/](\d{4})$", "$3-$1-$2"),
    (r"^(\d{1,2})[-/](\d{1,2})[-/](\d{4})$", "$3-$2-$1"),
    (r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"),
    (r"^(\d{1,2})[-/](\d{1,2})[-/](\d{2})$", "20$3-$1-$2"),
    (r"^(\d{1,2})[-/](\d{1,2})[-/](\d{2})$", "20$3-$2-$1"),
]
# (shape, group of the month, groups of year and day)
NAMED_SHAPES = [
    (rf"^{_MONTH}[ -/]+(\d{{1,2}})[ -/]+(\d{{4}})$", 1, 3, 2),
    (rf"^(\d{{1,2}})[ -/]*{_MONTH}[ -/]+(\d{{4}})$", 2, 3, 1),
    (rf"^(\d{{4}})[ -/]+{_MONTH}[ -/]+(\d{{1,2}})$", 2, 1, 3),
]


def tidy_date(raw: Column) -> Column:
    """Lower case, no ordinal endings, no words but month names, single spaces; values without letters as found."""
    plain = F.regexp_replace(F.lower(raw), _ORDINAL, "$1")
    plain = F.regexp_replace(plain, _OTHER_WORD, " ")
    words = blank_to_null(strip(F.regexp_replace(plain, r"(?U)[\s,]+", " ")))
    return F.when(raw.rlike("[A-Za-z]"), words).otherwise(raw)


def read_date(tidy: Column) -> Column:
    """Date of a tidied value, null if no shape fits or the day does not exist."""
    steps = [
        F.when(tidy.rlike(shape), F.regexp_replace(tidy, shape, order).try_cast("date"))
        for shape, order in NUMERIC_SHAPES
    ]
    numbers = F.create_map(*[F.lit(x) for item in MONTHS.items() for x in item])
    for shape, month, year, day in NAMED_SHAPES:
        part = [F.regexp_extract(tidy, shape, g) for g in (year, month, day)]
        text = F.concat_ws("-", part[0], F.try_element_at(numbers, part[1]).cast("string"), part[2])
        steps.append(F.when(tidy.rlike(shape), text.try_cast("date")))
    return F.coalesce(*steps)
