"""Naive timestamps: no session time zone ever touches them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioflow.functions.text import bind, col, strip

MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]


def revision_ts(text) -> Column:
    """`yyyy-MM-ddTHH:mm:ssZ` of a wiki revision as a naive timestamp."""
    text = col(text)
    shaped = text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$")
    return F.when(shaped, F.regexp_replace(text, "Z$", "")).try_cast("timestamp_ntz")


def _month_number(name: Column) -> Column:
    names = F.array(*[F.lit(m) for m in MONTHS])
    return F.lpad(F.array_position(names, F.lower(F.left(name, F.lit(3)))).cast("string"), 2, "0")


def lenient_ts(text) -> Column:
    """Parse the common written forms of a date and time; anything else is null."""
    return bind(strip(text), _iso_form).try_cast("timestamp_ntz")


def _iso_form(text: Column) -> Column:
    """Year to second in ISO order, for the forms that are known."""
    clock = r"(\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?)"
    # The clock is taken as written: zones and offsets are accepted and not applied.
    zone = r"(?: ?(?:Z|UTC|GMT|[+-]\d{2}:?\d{2}))?"
    tail = r"(?:(?:, ?| at |T| )" + clock + r" ?([AaPp]\.?[Mm]\.?)?" + zone + r")?$"
    word = r"^(?:[A-Za-z]{3,9},? +)?"
    iso = r"^(\d{4}-\d{1,2}-\d{1,2})(?:[T ](\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?))?(?: ?(?:Z|[+-]\d{2}:?\d{2}))?$"
    packed = r"^(\d{4})(\d{2})(\d{2})(?:T?(\d{2})(\d{2})(\d{2}))?Z?$"
    slash = r"^(\d{1,2})/(\d{1,2})/(\d{4})" + tail
    day_first = word + r"(\d{1,2}) ([A-Za-z]{3,9})\.?,? (\d{4})" + tail
    month_first = word + r"([A-Za-z]{3,9})\.? (\d{1,2}),? (\d{4})" + tail
    year_last = r"^[A-Za-z]{3,9},? +([A-Za-z]{3,9}) +(\d{1,2}) " + clock + zone + r" (\d{4})$"

    def part(pattern, n):
        return F.regexp_extract(text, pattern, n)

    def stamp(year, month, day, clock, half=None):
        date = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
        hour = F.regexp_extract(clock, r"^(\d{1,2})", 1).try_cast("int")
        if half is not None:
            # 12 AM is midnight and 12 PM noon; an hour beyond 12 cannot have a half.
            twelve = hour % 12 + F.when(half.rlike("^[Pp]"), 12).otherwise(0)
            hour = F.when(half == "", hour).when(hour.between(1, 12), twelve)
        full = F.concat(F.lpad(hour.cast("string"), 2, "0"), F.regexp_extract(clock, r"^\d{1,2}(.*)$", 1))
        return F.when(clock == "", date).otherwise(F.concat(date, F.lit(" "), full))

    return (
        F.when(text.rlike(iso), F.trim(F.concat_ws(" ", part(iso, 1), part(iso, 2))))
        .when(
            text.rlike(packed),
            F.concat(
                F.concat_ws("-", part(packed, 1), part(packed, 2), part(packed, 3)),
                F.when(part(packed, 4) == "", F.lit("")).otherwise(
                    F.concat(F.lit(" "), F.concat_ws(":", part(packed, 4), part(packed, 5), part(packed, 6)))
                ),
            ),
        )
        .when(text.rlike(slash), stamp(part(slash, 3), part(slash, 1), part(slash, 2), part(slash, 4), part(slash, 5)))
        .when(
            text.rlike(day_first),
            stamp(part(day_first, 3), _month_number(part(day_first, 2)), part(day_first, 1), part(day_first, 4), part(day_first, 5)),
        )
        .when(
            text.rlike(month_first),
            stamp(part(month_first, 3), _month_number(part(month_first, 1)), part(month_first, 2), part(month_first, 4), part(month_first, 5)),
        )
        .when(
            text.rlike(year_last),
            stamp(part(year_last, 4), _month_number(part(year_last, 1)), part(year_last, 2), part(year_last, 3)),
        )
    )


def iso_text(ts) -> Column:
    """ISO text; the fraction is written only where there is one."""
    ts = col(ts)
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(F.date_format(ts, "SSSSSS") == "000000", whole).otherwise(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )


def record_text(ts) -> Column:
    return F.date_format(col(ts), "yyyy-MM-dd'T'HH:mm:ss")
