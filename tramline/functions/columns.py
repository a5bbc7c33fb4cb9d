"""Column expressions of the transit domain."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A delay at or under EARLY is early, one from LATE on is late (seconds).
EARLY, LATE = -60, 180
EARTH_M = 6_371_000.0
#: The twelve buckets of a delay in whole seconds, from and to, both included; null has no end.
BUCKETS = (
    ("early_over_5m", None, -301),
    ("early_2_to_5m", -300, -121),
    ("early_1_to_2m", -120, -60),
    ("on_time_early_30_60s", -59, -31),
    ("on_time_early_0_30s", -30, -1),
    ("on_time_late_0_30s", 0, 30),
    ("on_time_late_30_60s", 31, 60),
    ("on_time_late_1_to_3m", 61, 179),
    ("late_3_to_5m", 180, 300),
    ("late_5_to_10m", 301, 600),
    ("late_10_to_20m", 601, 1200),
    ("late_over_20m", 1201, None),
)


def _many(times: Column | None, when: Column | None = None) -> Column:
    """How many rows hold `when`, or there are; `times`: a row stands for so many."""
    when = F.lit(True) if when is None else when
    return F.count_if(when) if times is None else F.sum(F.when(when, times).otherwise(0))


def delay_block(delay: Column, times: Column | None = None) -> list[Column]:
    """Arrivals, mean, median, 90th percentile, and counts and rates of early, on-time and late ones. Rows without a
    delay are arrivals too: counts and rates are of all rows. `times`: how many arrivals a row stands for."""
    early, late = _many(times, delay <= EARLY), _many(times, delay >= LATE)
    on_time, n = _many(times, (delay > EARLY) & (delay < LATE)), _many(times)
    mean = F.avg(delay) if times is None else F.try_divide(F.sum(delay * times), _many(times, delay.isNotNull()))
    at = lambda share: F.percentile(delay, share) if times is None else F.percentile(delay, share, times)
    rate = lambda c: F.try_divide(c.cast("double"), n.cast("double"))
    return [
        n.alias("arrivals"), mean.alias("mean_delay"), at(0.5).alias("median_delay"), at(0.9).alias("p90_delay"),
        early.alias("early_count"), on_time.alias("on_time_count"), late.alias("late_count"), rate(early).alias("early_rate"), rate(on_time).alias("on_time_rate"), rate(late).alias("late_rate"),
    ]


def delay_histogram(delay: Column, times: Column | None = None) -> Column:
    """An array of structs (bucket_label, min_delay_seconds, max_delay_seconds, n), one for each bucket, in order."""
    whole = lambda x: F.lit(x).cast("long")
    inside = lambda lo, hi: (F.lit(True) if lo is None else delay >= lo) & (F.lit(True) if hi is None else delay <= hi)
    return F.array(*[F.struct(F.lit(n).alias("bucket_label"), whole(lo).alias("min_delay_seconds"), whole(hi).alias("max_delay_seconds"), _many(times, inside(lo, hi)).alias("n")) for n, lo, hi in BUCKETS])


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres along the sphere."""
    rad = F.radians
    a = F.pow(F.sin((rad(lat2) - rad(lat1)) / 2), 2) + F.cos(rad(lat1)) * F.cos(rad(lat2)) * F.pow(F.sin((rad(lon2) - rad(lon1)) / 2), 2)
    return 2 * EARTH_M * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def gtfs_seconds(text: Column) -> Column:
    """HH:MM:SS with any number of hours to seconds; null if it isn't such a time. Minutes and seconds are cut from the
    end, so that the text is matched once and split never."""
    part = lambda start, n: F.substring(text, start, n).try_cast("int")
    hours = F.substring_index(text, ":", 1).try_cast("int")
    return F.when(text.rlike(r"^\d+:[0-5]\d:[0-5]\d$"), hours * 3600 + part(-5, 2) * 60 + part(-2, 2))


def scheduled_time(service_date: Column, seconds: Column, zone: str = "Europe/Warsaw") -> Column:
    """The instant `seconds` after local noon less 12 hours."""
    noon = F.to_utc_timestamp(F.timestamp_add("HOUR", F.lit(12), service_date.cast("timestamp")), zone)
    return F.timestamp_add("SECOND", seconds - 12 * 3600, noon)


def _bare(char: str) -> str:
    """The letter without its marks."""
    return "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))


#: Lower-case Latin letters that are one plain letter with marks, by their decomposition, and the barred l.
_MARKED = {c: _bare(c) for c in map(chr, [*range(0xDF, 0x250), *range(0x1E00, 0x1F00)]) if c == c.lower() and len(_bare(c)) == 1 and _bare(c).isascii()} | {"ł": "l"}


def search_key(text: Column) -> Column:
    """Lower case, without the marks of Latin letters, one space between words."""
    plain = F.translate(F.lower(text), "".join(_MARKED), "".join(_MARKED.values()))
    return F.trim(F.regexp_replace(plain, r"\s+", " "))


def easter(year: Column) -> Column:
    """Easter Sunday of the Gregorian calendar."""
    div, mod = (lambda a, b: F.floor(a / b).cast("int")), (lambda a, b: F.pmod(a, F.lit(b)))
    a, b, c = mod(year, 19), div(year, 100), mod(year, 100)
    d, e = div(b, 4), mod(b, 4)
    g = div(b - div(b + 8, 25) + 1, 3)
    h = mod(19 * a + b - d - g + 15, 30)
    left = mod(32 + 2 * e + 2 * div(c, 4) - h - mod(c, 4), 7)
    m = div(a + 11 * h + 22 * left, 451)
    day = h + left - 7 * m + 114
    return F.make_date(year.cast("int"), div(day, 31), mod(day, 31) + 1)


def day_type(date: Column) -> Column:
    return F.when(F.dayofweek(date).isin(1, 7), "weekend").otherwise("weekdays")
