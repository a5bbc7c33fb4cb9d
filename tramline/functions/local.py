"""Local time of the network: instants are seconds since 1970, local dates and hours those of ZONE."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "Europe/Warsaw"


def instant(service_date: Column, seconds: Column) -> Column:
    """The instant `seconds` after noon less 12 hours of the service date, right on days when clocks change too."""
    noon = F.to_utc_timestamp(F.timestamp_add("HOUR", F.lit(12), service_date.cast("timestamp")), ZONE)
    return F.unix_seconds(noon) - 43200 + seconds


def midnight(date: Column) -> Column:
    return F.unix_seconds(F.to_utc_timestamp(date.cast("timestamp"), ZONE))


def wall(at: Column) -> Column:
    return F.from_utc_timestamp(F.timestamp_seconds(at), ZONE)


def local_date(at: Column) -> Column:
    return F.to_date(wall(at))


def local_hour(at: Column) -> Column:
    return F.hour(wall(at))


def whole_hour(at: Column) -> Column:
    """The start of the hour; offsets are whole hours, so local and universal hours start together."""
    return at - F.pmod(at, F.lit(3600))


def stop_post_code(stop_id: Column) -> Column:
    """Two digits after a group of four characters, else what follows the last colon, else the rest, else all."""
    rest = F.when(F.char_length(stop_id) > 4, F.substring(stop_id, 5, 1000))
    return F.when(stop_id.rlike(r"^.{4}[0-9]{2}$"), F.substring(stop_id, 5, 2)).when(stop_id.rlike(r":[^:]+$"), F.regexp_extract(stop_id, r":([^:]+)$", 1)).otherwise(F.coalesce(rest, stop_id))


def schedule_class(service_id: Column) -> Column:
    """The kind of day that a service runs on. A general weekday service with a date before it runs as on that day."""
    token = F.regexp_extract(service_id, r"(?:^|:)(Pc|Pt|Sb|Nd)[A-Za-z]*$", 1)
    day = F.dayofweek(F.regexp_extract(service_id, r"^(\d{4}-\d{2}-\d{2}):", 1).try_cast("date"))
    names = F.array(*map(F.lit, ("sunday_holiday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday")))
    general = F.when(token == "Pc", F.coalesce(F.try_element_at(names, day), F.lit("weekday")))
    return F.when(token == "Nd", "sunday_holiday").when(token == "Sb", "saturday").when(token == "Pt", "friday").otherwise(F.coalesce(general, F.lit("unknown")))


def one_class(classes: Column) -> Column:
    """What a set of kinds comes to: the only one beside `weekday`, or the only one, or `mixed`."""
    special = F.array_remove(classes, "weekday")
    return F.when(F.size(special) == 1, special[0]).when(F.size(special) > 1, "mixed").when(F.size(classes) == 1, classes[0]).otherwise("unknown")


def in_area(lat: Column, lon: Column) -> Column:
    return lat.between(51.0, 53.5) & lon.between(19.5, 22.5)
