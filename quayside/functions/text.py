"""Keys, addresses and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside import rules


def ship_id(voyage_number: Column) -> Column:
    return F.substring(voyage_number, 1, 6)


def voyage_serial(voyage_number: Column) -> Column:
    return F.substring(voyage_number, 7, 4)


def page_address(base: str, voyage_number: Column) -> Column:
    """The address under which a voyage's own page is found."""
    return F.concat(
        F.lit(f"{base}?SP_ID="), ship_id(voyage_number), F.lit("&SP_SERIAL="), voyage_serial(voyage_number)
    )


def voyage_of_address(base: str, url: Column) -> Column:
    """The voyage that a page of ``base`` is about; NULL for other pages."""
    parameters = F.substring(url, len(base) + 1, 2**30)
    pattern = r"(?s)^\?SP_ID=(.*)&SP_SERIAL=(.*)$"
    key = F.concat(F.regexp_extract(parameters, pattern, 1), F.regexp_extract(parameters, pattern, 2))
    # Built the same way, the address must come out again.
    return F.when(page_address(base, key) == url, key)


def full_name(chinese: Column, english: Column) -> Column:
    """Both names joined; a missing one is skipped."""
    return F.concat_ws("", chinese, english)


def qualified_event(event: Column, navigation_status: Column) -> Column:
    """Event name with the navigation status appended where the event needs it."""
    status = F.coalesce(navigation_status, F.lit("None"))
    return F.when(
        event.isin(*rules.SUFFIXED_EVENTS), F.concat(event, F.lit(" ("), status, F.lit(")"))
    ).otherwise(event)


def in_fleet(ship_name: Column) -> Column:
    """True if any fleet name occurs in the ship's name."""
    return ship_name.rlike("|".join(rules.FLEET))
