"""Release date text to years."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ludolens import fixed_values as fixed


def release_year(date_text: Column) -> Column:
    """The year of a release date in one of six shapes, NULL if unknown.

    ``M/d/yyyy`` (then ``d/M/yyyy``), ``MMM d, yyyy``, ``d MMM, yyyy``, a text
    with ``Q1 yyyy`` in it, and a bare ``yyyy``.
    """

    def parsed(format_text: str) -> Column:
        return F.year(F.try_to_date(date_text, format_text))

    digits = F.regexp_extract(date_text, fixed.YEAR_DIGITS_PATTERN, 1)
    return (
        F.when(
            date_text.rlike(fixed.SLASH_DATE_PATTERN),
            F.coalesce(*[parsed(f) for f in fixed.SLASH_DATE_FORMATS]),
        )
        .when(date_text.rlike(fixed.MONTH_FIRST_PATTERN), parsed(fixed.MONTH_FIRST_FORMAT))
        .when(date_text.rlike(fixed.DAY_FIRST_PATTERN), parsed(fixed.DAY_FIRST_FORMAT))
        .when(date_text.rlike(fixed.QUARTER_PATTERN), digits.try_cast("int"))
        .when(date_text.rlike(fixed.BARE_YEAR_PATTERN), date_text.try_cast("int"))
    )


def year_label(year: Column) -> Column:
    """A year as text, with a word for the unknown one."""
    return F.coalesce(year.cast("string"), F.lit(fixed.UNKNOWN))


def year_prefix(date_text: Column) -> Column:
    """The first four characters of an ISO date."""
    return F.substring(date_text, 1, 4)
