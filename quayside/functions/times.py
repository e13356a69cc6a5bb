"""Local time texts to UTC, as column expressions.

Every parser comes as a pair: the value (NULL when there is none) and a flag that tells
a text that cannot be read from a text that spells "no value".
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Year offset of the local calendar, hours ahead of UTC, spellings of "no value".
ERA_YEAR_ZERO = 1911
UTC_OFFSET_HOURS = 8
NO_VALUE_SPELLINGS = ("待接靠", "null", "")
AFTERNOON = "下午"

_OFFSET = f"INTERVAL '{UTC_OFFSET_HOURS}' HOUR"
_BLANKS = " \t\n\x0b\x0c\r"
_CLOCK = r"\d{1,2}:[0-5]?\d(?::[0-5]?\d)?"
_ERA = rf"^\d{{1,4}}/\d{{1,4}}/\d{{1,4}} {_CLOCK}$"
_MERIDIEM = r"^\d{4}/\d{1,2}/\d{1,2} .* \d{1,2}:[0-5]?\d:[0-5]?\d$"
_CONTENT_SHAPE = r"^\s*\d+/\d+/\d+\s+\S+\s*$"
_CONTENT = rf"^\d{{1,4}}/\d{{1,4}}/\d{{1,4}}\s+{_CLOCK}$"
_COMPACT = r"^\d{12}$"


def to_utc(local: Column) -> Column:
    return local - F.expr(_OFFSET)


def to_local(utc: Column) -> Column:
    return utc + F.expr(_OFFSET)


def _of_parts(text: Column, shape: str, separators: str, make: Callable[[Column], Column]) -> Column:
    """``make`` of what stands between the separators, of a text of that shape; else NULL.

    Bound in an array of one, so that a text is matched and split once for all its numbers.
    """
    parts = F.when(text.rlike(shape), F.split(text, separators))
    return F.element_at(F.transform(F.array(parts), make), 1)


def _number(parts: Column, place: int) -> Column:
    return F.try_element_at(parts, F.lit(place)).try_cast("int")


def _year(year: Column) -> Column:
    """Years the calendar has; others are no time."""
    return F.when(year.between(1, 9999), year)


def _moment(parts: Column) -> Column:
    """Local-calendar time of date and clock numbers; missing seconds count as 0."""
    year, month, day, hour, minute, second = (_number(parts, i) for i in range(1, 7))
    return F.try_make_timestamp_ntz(
        _year(year + F.lit(ERA_YEAR_ZERO)), month, day, hour, minute, F.coalesce(second, F.lit(0)))


def era_time(text: Column) -> Column:
    """``Y/M/D H:M[:S]`` in the local calendar, shifted to UTC.

    A text without a slash is taken as it stands, without a shift.
    """
    return (
        F.when(text.isin(*NO_VALUE_SPELLINGS), F.lit(None))
        .when(text.contains("/"), to_utc(_of_parts(text, _ERA, "[/ :]", _moment)))
        .otherwise(text.try_cast("timestamp_ntz"))
    )


def era_time_rejected(text: Column) -> Column:
    return F.coalesce(~text.isin(*NO_VALUE_SPELLINGS) & era_time(text).isNull(), F.lit(False))


def meridiem_time(text: Column) -> Column:
    """``Y/M/D <half of day> h:m:s`` on a 12-hour clock, shifted to UTC.

    Hour 12 counts as 0; any half of day other than the afternoon counts as morning.
    """
    def make(parts: Column) -> Column:
        afternoon = (F.size(parts) == 7) & (F.try_element_at(parts, F.lit(4)) == AFTERNOON)
        hour = _number(parts, -3)
        hour = F.when(hour.between(1, 12), hour % 12 + F.when(afternoon, 12).otherwise(0))
        return F.try_make_timestamp_ntz(
            _year(_number(parts, 1)), _number(parts, 2), _number(parts, 3), hour, _number(parts, -2), _number(parts, -1))

    return to_utc(_of_parts(text, _MERIDIEM, "[/ :]", make))


def meridiem_time_rejected(text: Column) -> Column:
    """Every event carries a time, so a missing one is rejected too."""
    return meridiem_time(text).isNull()


def _compact_time(text: Column) -> Column:
    digits = F.when(text.rlike(_COMPACT), text)
    year, month, day, hour, minute = (
        F.substring(digits, start, length).try_cast("int") for start, length in ((1, 4), (5, 2), (7, 2), (9, 2), (11, 2)))
    return F.try_make_timestamp_ntz(_year(year), month, day, hour, minute, F.lit(0))


def content_time(text: Column) -> Column:
    """Free text: a local-calendar time if it has a slash, ``yyyyMMddHHmm`` if it has
    exactly 12 characters, else no value. Shifted to UTC."""
    return (
        F.when((text == "") | (text == "null"), F.lit(None))
        .when(text.contains("/"), to_utc(_of_parts(F.btrim(text, F.lit(_BLANKS)), _CONTENT, r"[/:\s]+", _moment)))
        .when(F.char_length(text) == 12, to_utc(_compact_time(text)))
    )


def content_time_rejected(text: Column) -> Column:
    """A text shaped like a time that is none. Other slashed or short text is no value."""
    shaped = F.when(text.contains("/"), text.rlike(_CONTENT_SHAPE)).otherwise(F.char_length(text) == 12)
    return F.coalesce(shaped & content_time(text).isNull(), F.lit(False))


def display_time(utc: Column) -> Column:
    """Local ``yyyy/MM/dd HH:mm:ss``; a missing time prints as ``None``."""
    return F.coalesce(F.date_format(to_local(utc), "yyyy/MM/dd HH:mm:ss"), F.lit("None"))
