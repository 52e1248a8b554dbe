"""Cleaning rules for dirty source columns. Every rule is one column expression, so it stays in generated code."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tokens and formats the cleaned tables are defined by.
NULL_TOKENS = ("nan", "NaT", "None", "")
FEMALE_TOKENS = ("f", "female")
MALE_TOKENS = ("m", "male")
MONTH_DAY_YEAR = (r"^(\d{1,2})/(\d{1,2})/(\d{4})(?!\d)", "$3-$1-$2")
YEAR_MONTH_DAY = (r"^(\d{4})/(\d{1,2})/(\d{1,2})(?!\d)", "$1-$2-$3")
FALLBACK_FORMATS = ("MMM d, yyyy", "MMMM d, yyyy", "d MMM yyyy", "d MMMM yyyy", "yyyyMMdd")
# Years a date may have; what lies outside is a slip of the pen. They are also what nanosecond timestamps can hold.
YEARS = (1678, 2261)
# All white space, line ends and separators included.
WHITE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def once(col: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a column that costs something, computed once however often ``use`` names it.

    A filter on the result repeats the whole expression in the scan, where equal parts are not shared.
    """
    return F.get(F.transform(F.array(col), use), F.lit(0))


def strip(col: Column) -> Column:
    """Text without white space of any kind at its ends."""
    return F.btrim(col.cast("string"), F.lit(WHITE))


def clean_text(col: Column, null_tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Trimmed text; the null tokens become NULL."""
    text = strip(col)
    return F.when(~text.isin(*null_tokens), text)


def singularize(col: Column) -> Column:
    """Rough English singular of a lower-case word, e.g. batteries -> battery, bags -> bag, glass -> glass."""
    size = F.length(col)
    return (
        F.when(col.endswith("ies") & (size > 3), F.concat(F.substring(col, F.lit(1), size - 3), F.lit("y")))
        .when(col.endswith("sses"), F.substring(col, F.lit(1), size - 2))
        .when(col.endswith("es") | col.endswith("ss") | ~col.endswith("s"), col)
        .otherwise(F.substring(col, F.lit(1), size - 1))
    )


def normalize_category(col: Column) -> Column:
    """Category key: lower case, no white space, singular; an empty text is NULL."""
    squeezed = F.regexp_replace(F.lower(col.cast("string")), f"[{WHITE}]+", "")
    return F.nullif(singularize(squeezed), F.lit(""))


def normalize_gender(col: Column) -> Column:
    """'F', 'M' or NULL."""
    token = F.lower(strip(col))
    return F.when(token.isin(*FEMALE_TOKENS), "F").when(token.isin(*MALE_TOKENS), "M")


def to_utc_ts(col: Column) -> Column:
    """Timestamp (session time zone UTC); unreadable text becomes NULL."""
    return col.try_cast("timestamp")


def parse_mixed_date(col: Column, fallback_formats: Sequence[str] = FALLBACK_FORMATS) -> Column:
    """Date from text in mixed formats; unreadable text, and a year out of ``YEARS``, becomes NULL.

    Slashed dates (month/day/year, year/month/day) are turned into year-month-day, which a cast reads with or without a
    time of day (a zone is converted to UTC); anything else is tried in the fallback formats in turn. Which way to go is told by
    single characters: a filter on the date repeats the whole expression in the scan, so every part has to be cheap.
    """

    def moment(text: Column) -> Column:
        dashed = F.regexp_replace(F.regexp_replace(text, *MONTH_DAY_YEAR), *YEAR_MONTH_DAY)
        return (
            F.when(text.contains("/"), dashed.try_cast("timestamp"))
            .when(F.substring(text, 5, 1) == "-", text.try_cast("timestamp"))
            .otherwise(F.coalesce(F.lit(None).cast("timestamp"), *(F.try_to_timestamp(text, F.lit(f)) for f in fallback_formats)))
        )

    return once(once(strip(col), moment), lambda m: F.when(F.year(m).between(*YEARS), m.cast("date")))


def latest_of(*cols: Column) -> Column:
    """Latest of several timestamps in a row; NULLs are skipped."""
    return F.greatest(*cols)
