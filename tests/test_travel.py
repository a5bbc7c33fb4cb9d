"""Lookups of travel times."""

from tramline.plans import travel as T


def test_slot_without_a_value_leaves_it_to_the_next(spark):
    """A slot of last stops alone knows the usual delay, yet no boarding percentile; the next level knows both."""
    keys = ", ".join(f"{k} {t}" for k, t in T.SLOT_KEYS.items())
    fine = ("line_stop_hour", "7", 0, "100701", 1, 8, None, None, None, None, 150, 40.0, None)
    coarse = ("line_stop", "7", 0, "100701", None, None, None, None, None, None, 200, 30.0, -95.0)
    slots = spark.createDataFrame([fine, coarse], f"level string, {keys}, n bigint, dq50 double, e3 double")
    key = (1, "7", 0, "100701", 1, 8, 1, False, False, 3)
    rows = spark.createDataFrame([key], "id int, line string, direction_id bigint, stop_id string, daytype int, hr int, hb int, is_tram boolean, is_origin boolean, rel_b int")
    assert [tuple(r) for r in T.with_slots(rows, slots, ["dq50", "e3"]).select("id", "dq50", "e3").collect()] == [(1, 40.0, -95.0)]
