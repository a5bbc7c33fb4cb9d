"""Duties are settled from counts, chains of each vehicle and the evidence of the best one, not from all evidence at once."""

import random
from collections import Counter

from tramline.plans import duties as D
from tramline.queries import QUERIES
from tramline.sources import published as P


def test_no_episodes_of_courses_are_stored(spark, sf_dir):
    """Their number grows with the square of a vehicle's courses; traversals are stored once for a place."""
    d = f"file://{sf_dir}"
    assert QUERIES["duty_settlement"](spark, d).count() > 50
    names = {k[2] for k in P._written if k[1] == d}
    assert "terminal_episodes" not in names and "place_traversals" in names


def test_duties_in_parts_equal_duties_at_once(spark):
    rng = random.Random(4)
    courses, found, want = [], [], Counter()
    for duty in range(12):
        own = [(f"{duty % 4}", f"{duty // 4}", f"d{duty}t{k:02}", k * 1500, rng.random() < 0.9) for k in range(9)]
        courses += own
        mine = []
        for k, (_, _, trip, start, _) in enumerate(own):
            for v in "abc"[: 1 + duty % 3]:
                kind = rng.choice(("candidate", "candidate", "candidate", "partial", "observation", None))
                late = rng.choice((0, 0, 10, 60, 1200, 3000))
                if kind:
                    spot = (None, None, None) if kind == "observation" else (start + late - 30, start + late, start + late + 1200 if kind == "candidate" else None)
                    mine.append((v, trip, kind, kind == "candidate" and rng.random() < 0.8, *spot, k))
        mine.sort(key=lambda e: (e[7], e[0], e[2], e[4] or 0))
        found += [e[:7] for e in mine]
        told = [{"course": e[7], "kind": e[2], "fits": e[3], "vehicle": e[0], "origin": e[4], "departs": e[5], "arrives": e[6]} for e in mine]
        want.update((own[0][0], own[0][1], *x.values()) for x in D.settle([{"trip_id": c[2], "start": c[3], "settled": c[4]} for c in own], told))
    c = spark.createDataFrame(courses, "line string, brigade string, trip_id string, scheduled_start_s long, settled boolean")
    e = spark.createDataFrame(found, "vehicle_number string, trip_id string, kind string, fits boolean, origin long, departs long, arrives long")
    got = D.settled_duties(c, e).collect()
    assert Counter(tuple(r) for r in got) == want
    assert {"executed", "vehicle_change_signal", "missed"} <= {r.execution_status for r in got}


def test_a_long_duty_is_settled(spark):
    """Three thousand courses, each with a ride that fits and one that doesn't."""
    starts = [k * 1500 for k in range(3000)]
    ride = lambda k, fits: {"course": k, "kind": "candidate", "fits": fits, "vehicle": "a", "origin": starts[k] - 30, "departs": starts[k], "arrives": starts[k] + 1200}
    out = D.settle([{"trip_id": f"t{k}", "start": s, "settled": True} for k, s in enumerate(starts)], [ride(k, f) for k in range(3000) for f in (True, False)])
    assert {(x["execution_status"], x["candidates"]) for x in out} == {("executed", 2)}
