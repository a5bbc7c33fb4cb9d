"""Episodes and traversals are found once for all courses between the same terminals, and frames stay short."""

import re
from collections import Counter

from tramline.plans import matching as M
from tramline.queries import QUERIES


def test_no_frame_runs_to_the_end_of_its_partition(spark, sf_dir):
    """Such a frame is made anew for each row, so that its time grows with the square of a vehicle's rows."""
    plan = QUERIES["competing_ownership"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    frames = re.findall(r"specifiedwindowframe\(rowframe, (\S+), (\S+)\)", plan.lower())
    assert frames and not [f for f in frames if f[1].startswith("unboundedfollowing") and not f[0].startswith("unboundedpreceding")]


def drawn(spark):
    """Thirty courses of one vehicle between the same terminals, one listed again on another line, and its pings."""
    course = [("v", f"t{k}", "1", "1", k * 1500, k * 1500 + 1300, 52.1, 21.0, 52.12, 21.02) for k in range(30)]
    course += [("v", "t3", "2", "1", 4500, 5800, 52.1, 21.0, 52.12, 21.02), ("u", "t3", "1", "1", 4500, 5800, 52.1, 21.0, 52.1, 21.0)]
    c = spark.createDataFrame(course, "vehicle_number string, trip_id string, line string, brigade string, scheduled_start_s long, scheduled_end_s long, origin_lat double, origin_lon double, destination_lat double, destination_lon double")
    share = [0, 0, 0.1, 0.5, 0.9, 1, 1, 0.6, 0.3, 0]
    ping = [(v, line, "1", k * 1500 + i * 120 + (400 if k % 7 == 5 and i > 4 else 0), 52.1 + x * 0.02, 21.0 + x * 0.02) for v, line, n in (("v", "1", 30), ("v", "2", 4), ("u", "1", 5)) for k in range(n) for i, x in enumerate(share if k % 4 else share[:4])]
    return c, spark.createDataFrame(ping, "vehicle_number string, line string, brigade string, time_s long, lat double, lon double")


def test_shared_episodes_equal_those_of_each_course(spark):
    courses, pings = drawn(spark)
    each = M.at_places(pings, courses, M.COURSE, M.TIMED)
    got = M.episodes(courses, pings)
    assert Counter(got.select(*each.columns).collect()) == Counter(each.collect())
    want = M.traversals(each)
    got = M.course_traversals(courses, pings)
    assert Counter(got.select(*want.columns).collect()) == Counter(want.collect())
    assert {r.candidate_kind for r in got.collect()} == {"candidate", "partial"}


def test_competing_equals_all_pairs(spark):
    rows = [("v" if k % 3 else "u", f"t{k}", k * 37 % 200 * 10, k * 37 % 200 * 10 + k % 5 * 9) for k in range(150)]
    got = M.competing(spark.createDataFrame(rows, "v string, t string, a long, z long"), "v", "a", "z", ["t"]).collect()
    for r in got:
        assert r.is_competing == any(x[0] == r.v and x[1] != r.t and x[2] <= r.z and x[3] >= r.a for x in rows)
