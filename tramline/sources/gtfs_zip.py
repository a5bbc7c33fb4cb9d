"""Timetable archives: six members of a zip, read strictly and within bounds."""

from __future__ import annotations

import hashlib
import io
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Members and the columns that each has to have.
MEMBERS = {
    "trips.txt": ("trip_id", "route_id", "service_id"),
    "stop_times.txt": ("trip_id", "stop_id", "stop_sequence", "arrival_time", "departure_time"),
    "stops.txt": ("stop_id", "stop_name", "stop_lat", "stop_lon"),
    "routes.txt": ("route_id", "route_short_name", "route_type"),
    "calendar_dates.txt": ("service_id", "date", "exception_type"),
    "shapes.txt": ("shape_id", "shape_pt_lat", "shape_pt_lon", "shape_pt_sequence"),
}
MOST_BYTES, MOST_ROWS = 640 << 20, 1_800_000


class BadArchive(ValueError):
    pass


def snapshot_id(data: bytes, taken: str) -> str:
    """The instant and the first twelve digits of the archive's SHA-256."""
    return f"{taken}_{hashlib.sha256(data).hexdigest()[:12]}"


def changed(data: bytes, latest: str | None) -> bool:
    """Whether an archive differs from the latest snapshot."""
    return latest is None or not latest.endswith(hashlib.sha256(data).hexdigest()[:12])


def load(spark: SparkSession, data: bytes, snapshot: str) -> dict[str, DataFrame]:
    """Each member as a frame of texts with its snapshot and date. Refuses an archive whose hash isn't the snapshot's, that
    lacks a member or column, or that is larger than a timetable can be: an archive is one city's, read on the driver."""
    if changed(data, snapshot):
        raise BadArchive("the archive's hash isn't that of the snapshot")
    out = {}
    with zipfile.ZipFile(io.BytesIO(data)) as archive:
        sizes = {i.filename: i.file_size for i in archive.infolist()}
        if missing := MEMBERS.keys() - sizes.keys():
            raise BadArchive(f"members missing: {sorted(missing)}")
        if sum(sizes[m] for m in MEMBERS) > MOST_BYTES:
            raise BadArchive("the archive unpacks to too many bytes")
        for member, required in MEMBERS.items():
            lines = archive.read(member).decode("utf-8-sig").splitlines()
            if len(lines) - 1 > MOST_ROWS:
                raise BadArchive(f"{member} has too many rows")
            if absent := set(required) - set(lines[0].split(",") if lines else ()):
                raise BadArchive(f"{member} lacks {sorted(absent)}")
            text = spark.createDataFrame([(x,) for x in lines[1:]], "value string")
            rows = text.select(F.from_csv("value", ", ".join(f"`{c}` string" for c in lines[0].split(","))).alias("x")).select("x.*")
            out[member.removesuffix(".txt")] = rows.withColumns({"gtfs_snapshot_id": F.lit(snapshot), "gtfs_snapshot_date": F.lit(snapshot[:10]).cast("date")})
    return out
