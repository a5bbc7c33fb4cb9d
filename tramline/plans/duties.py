"""Which vehicle ran each course of a duty: the best chain of traversals, filled gaps, rivals, and a status for each course.

A duty is a line's brigade on one day: its courses, and the traversals of the one vehicle with the best chain, are all
that a group holds when it's settled; chains are found before, in a group for each vehicle of a duty."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Callable
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramline.plans.matching import COURSE, fits

#: Fixed values of the policy, in seconds: a rival within so much is as good; a vehicle so much later after so long away
#: has resumed under another course.
AS_GOOD, LATER, AWAY = 30, 900, 900

RESULT = "line string, brigade string, trip_id string, trip_order int, vehicle_number string, execution_status string, confidence string, execution_reason string, candidates int, owned_from_s long, owned_to_s long"


def resumed(course: dict, before: dict, start: int, before_start: int) -> bool:
    """Whether a traversal is so much later than the one before it, after so long an absence, that it's no successor."""
    later = (course["departs"] - start) - (before["departs"] - before_start)
    return later > LATER and course["origin"] - before["arrives"] > AWAY


def best_chain(starts: list[int], candidates: list[dict]) -> tuple[int, float, tuple] | None:
    """One vehicle's best chain: most courses, then least change of delay, then the first in order of names.

    A traversal {course, origin, departs, arrives} is of a later course than the one before and departs after that one
    arrived. What may follow depends on the last traversal alone, so the best chain to each is enough and the search is
    exact. Returns (-courses, cost, chain of indices into `candidates`)."""
    order = sorted(range(len(candidates)), key=lambda i: (candidates[i]["course"], candidates[i]["origin"], candidates[i]["departs"]))
    if not order:
        return None
    course, origin, departs, arrives = (np.array([candidates[i][k] for i in order], dtype=np.int64) for k in ("course", "origin", "departs", "arrives"))
    delay = departs - np.array(starts, dtype=np.int64)[course]
    n, cost = np.full(len(order), -1), np.abs(delay).astype(float)
    chains: list[tuple] = []
    for i, at in enumerate(order):
        own, before = (int(course[i]), int(origin[i]), int(departs[i]), at), ()
        may = np.flatnonzero((course[:i] < course[i]) & (departs[i] > arrives[:i]) & ~((delay[i] - delay[:i] > LATER) & (origin[i] - arrives[:i] > AWAY)))
        if len(may):
            may = may[n[may] == n[may].min()]
            total = cost[may] + np.abs(delay[i] - delay[may])
            # chains of one length: the first in order of names stays so with the same end
            before = min(chains[j] for j in may[total == total.min()])
            n[i], cost[i] = -len(before) - 1, total.min()
        chains.append((*before, own))
    i = min(range(len(order)), key=lambda i: (n[i], cost[i], chains[i]))
    return int(n[i]), float(cost[i]), tuple(x[3] for x in chains[i])


def filled(starts: list[int], candidates: list[dict], chosen: dict[int, int]) -> dict[int, int]:
    """`chosen` (course to candidate) with courses between that a traversal of the same vehicle fits: the one whose delay
    is nearest the mean of the neighbours'."""
    out = dict(chosen)
    for k in sorted({c["course"] for c in candidates}):
        if k in out or not out:
            continue
        before = max((x for x in out if x < k), default=None)
        after = min((x for x in out if x > k), default=None)
        b, a = (candidates[out[x]] if x is not None else None for x in (before, after))
        fit = [i for i, c in enumerate(candidates) if c["course"] == k and (b is None or (c["departs"] > b["arrives"] and not resumed(c, b, starts[k], starts[before]))) and (a is None or c["arrives"] < a["departs"])]
        if fit:
            near = [candidates[out[x]]["departs"] - starts[x] for x in (before, after) if x is not None]
            mean = sum(near) / len(near)
            out[k] = min(fit, key=lambda i: (abs(candidates[i]["departs"] - starts[k] - mean), candidates[i]["origin"], candidates[i]["arrives"]))
    return out


def verdicts(courses: list[dict], own: list[dict], doubtful: set[int]) -> list[dict]:
    """Statuses of a duty's courses (trip_id, start, settled, in order; tried, fitted, observed: what evidence of any
    vehicle there is) by the evidence `own` (course, kind, fits, vehicle, origin, departs, arrives) of the vehicle whose
    chain is the best. `doubtful`: courses of it and of rivals as good."""
    starts = [c["start"] for c in courses]
    usable = [e for e in own if e["kind"] == "candidate" and e["fits"]]
    found = best_chain(starts, usable)
    picked = {k: usable[i] for k, i in filled(starts, usable, {usable[i]["course"]: i for i in found[2]}).items()} if found else {}
    order = sorted(picked)
    partial, origins = defaultdict(list), defaultdict(list)
    for e in own:
        partial[e["course"]].append(e) if e["kind"] == "partial" else origins[e["origin"]].append(e)

    @cache
    def reanchored(last: int, following: int) -> bool:
        """Whether the vehicle's next ride fits a course between, but too late after too long away."""
        return any(last < e["course"] < following and resumed(e, picked[last], starts[e["course"]], starts[last]) for e in origins[picked[following]["origin"]] if e["kind"] == "candidate")

    out = []
    for k, course in enumerate(courses):
        got, before, after = picked.get(k), picked.get(k - 1), picked.get(k + 1)
        turned = after is not None and any(e["departs"] < after["origin"] and (before is None or e["origin"] > before["arrives"]) for e in partial[k])
        i, j = bisect_left(order, k), bisect_right(order, k)
        moved_on = 0 < i and j < len(order) and reanchored(order[i - 1], order[j])
        if k in doubtful:
            status = ("vehicle_change_signal", "low", "multiple_vehicles_terminal_progression")
        elif got:
            status = ("executed", "high", "terminal_progression")
        elif not course["settled"]:
            status = ("uncertain", "low", "passenger_boundaries_unknown")
        elif turned:
            status = ("short_turned", "medium", "next_course_origin_before_destination")
        elif moved_on:
            status = ("missed", "medium", "later_course_reanchored")
        elif before is not None and after is not None:
            status = ("skipped", "medium", "adjacent_courses_terminal_progression")
        elif course["tried"] and not course["fitted"]:
            status = ("uncertain", "low", "implausible_schedule_alignment")
        elif course["observed"]:
            status = ("uncertain", "low", "terminal_progression_incomplete")
        else:
            status = ("missed", "medium", "no_line_observation")
        ran = got if status[0] == "executed" else None
        out.append({"trip_id": course["trip_id"], "trip_order": k + 1, "vehicle_number": ran and ran["vehicle"], "execution_status": status[0], "confidence": status[1], "execution_reason": status[2], "candidates": course["tried"], "owned_from_s": ran and ran["departs"], "owned_to_s": ran and ran["arrives"]})
    return out


def settle(courses: list[dict], evidence: list[dict]) -> list[dict]:
    """Statuses of a duty's courses (trip_id, start, settled, in order) from evidence (course, kind, fits, vehicle, origin,
    departs, arrives), kind candidate, partial or observation."""
    starts = [c["start"] for c in courses]
    chains = []
    for vehicle in sorted({e["vehicle"] for e in evidence if e["kind"] == "candidate" and e["fits"]}):
        own = [e for e in evidence if e["vehicle"] == vehicle and e["kind"] == "candidate" and e["fits"]]
        n, cost, chain = best_chain(starts, own)
        chains.append((n, cost, vehicle, {own[i]["course"] for i in chain}))
    chains.sort(key=lambda c: c[:3])
    rivals = [c for c in chains[1:] if c[0] == chains[0][0] and c[1] - chains[0][1] <= AS_GOOD]
    doubtful = set().union(*[c[3] for c in [chains[0], *rivals]]) if rivals else set()
    tried = defaultdict(list)
    for e in evidence:
        tried[e["course"], e["kind"]].append(e["fits"])
    told = [{**c, "tried": len(tried[k, "candidate"]), "fitted": any(tried[k, "candidate"]), "observed": bool(tried[k, "observation"])} for k, c in enumerate(courses)]
    return verdicts(told, [e for e in evidence if chains and e["vehicle"] == chains[0][2] and e["kind"] != "observation"], doubtful)


def evidence(courses: DataFrame, pings: DataFrame, traversal: DataFrame) -> DataFrame:
    """What speaks for a vehicle on a course: its traversals, or that it was seen at all."""
    t = traversal.select(*COURSE, F.col("candidate_kind").alias("kind"), F.coalesce(fits(), F.lit(False)).alias("fits"), F.col("origin_event_s").alias("origin"), F.col("departure_event_s").alias("departs"), F.col("destination_event_s").alias("arrives"))
    none = F.lit(None).cast("long")
    on = ["vehicle_number", "line", "brigade"]
    seen = courses.join(pings.select(*on).distinct(), on, "left_semi").select(*COURSE).distinct().join(traversal.select(*COURSE).distinct(), COURSE, "left_anti")
    return t.unionByName(seen.select(*COURSE, F.lit("observation").alias("kind"), F.lit(False).alias("fits"), none.alias("origin"), none.alias("departs"), none.alias("arrives")))


DUTY = ["line", "brigade"]


def settled_duties(courses: DataFrame, found: DataFrame, keep: Callable[[str, DataFrame], DataFrame] = lambda _, df: df) -> DataFrame:
    """Every course (line, brigade, trip_id, scheduled_start_s, settled) with its status; `found` is its evidence.

    Courses without evidence stay, duties without any have all courses missed. Courses that start together keep the
    order of their names; a course listed twice is one. Evidence is counted for each course and vehicle, chains are found
    for each vehicle of a duty from what fits, and only the evidence of the vehicle with the best chain meets the duty's
    courses in one task. `keep` stores what is read again."""
    c = courses.select(*DUTY, "trip_id", "scheduled_start_s", "settled").dropDuplicates([*DUTY, "trip_id"])
    c = keep("duty_courses", c.withColumn("course", F.row_number().over(Window.partitionBy(*DUTY).orderBy("scheduled_start_s", "trip_id")) - 1))
    candidate = F.col("kind") == "candidate"
    tally = keep("duty_tallies", found.groupBy("trip_id", "vehicle_number").agg(F.count_if(candidate).alias("tried"), F.coalesce(F.bool_or(candidate & F.col("fits")), F.lit(False)).alias("fitted"), F.bool_or(F.col("kind") == "observation").alias("observed")))
    usable = c.join(found.where(candidate & F.col("fits")), "trip_id").select(*DUTY, "vehicle_number", "course", "scheduled_start_s", "origin", "departs", "arrives")

    def chain(group: pa.Table) -> pa.Table:
        r = sorted(group.to_pylist(), key=lambda e: (e["course"], e["origin"]))
        # a vehicle's own courses in order stand for the duty's
        listed = sorted({(e["course"], e["scheduled_start_s"]) for e in r})
        at = {k: i for i, (k, _) in enumerate(listed)}
        n, cost, best = best_chain([s for _, s in listed], [{**e, "course": at[e["course"]]} for e in r])
        return pa.Table.from_pylist([{**{k: r[0][k] for k in (*DUTY, "vehicle_number")}, "n": n, "cost": cost, "chain": [r[i]["course"] for i in best]}], schema=CHAINS)

    chains = keep("duty_chains", usable.groupBy(*DUTY, "vehicle_number").applyInArrow(chain, "line string, brigade string, vehicle_number string, n int, cost double, chain array<int>"))
    best = F.min(F.struct("n", "cost", "vehicle_number")).over(Window.partitionBy(*DUTY))
    good = chains.withColumn("best", best).where((F.col("n") == F.col("best.n")) & (F.col("cost") - F.col("best.cost") <= AS_GOOD)).withColumn("rivals", F.count(F.lit(1)).over(Window.partitionBy(*DUTY)))
    doubtful = good.where("rivals > 1").select(*DUTY, F.explode("chain").alias("course")).distinct().withColumn("doubtful", F.lit(True))
    first = good.where("vehicle_number = best.vehicle_number").select(*DUTY, "vehicle_number")
    mine = c.join(tally.select("trip_id", "vehicle_number"), "trip_id").join(F.broadcast(first), [*DUTY, "vehicle_number"]).select(*DUTY, "trip_id", "vehicle_number", "course")
    own = found.where("kind <> 'observation'").join(F.broadcast(mine), ["trip_id", "vehicle_number"]).select(*[F.col(k).alias(f"own_{k}") for k in (*DUTY, "course")], "kind", "fits", F.col("vehicle_number").alias("vehicle"), "origin", "departs", "arrives")
    any_of = tally.groupBy("trip_id").agg(F.sum("tried").alias("tried"), F.bool_or("fitted").alias("fitted"), F.bool_or("observed").alias("observed"))
    told = c.join(any_of, "trip_id", "left").join(doubtful, [*DUTY, "course"], "left").fillna({"tried": 0, "fitted": False, "observed": False, "doubtful": False})

    def run(group: pa.Table, evidence: pa.Table) -> pa.Table:
        listed = sorted(group.to_pylist(), key=lambda x: x["course"])
        ev = sorted(({**e, "course": e["own_course"]} for e in evidence.to_pylist()), key=lambda e: (e["course"], e["kind"], e["origin"] or 0))
        out = verdicts([{**x, "start": x["scheduled_start_s"]} for x in listed], ev, {x["course"] for x in listed if x["doubtful"]})
        return pa.Table.from_pylist([{**{k: listed[0][k] for k in DUTY}, **x} for x in out], schema=SCHEMA)

    return told.groupBy(*DUTY).cogroup(own.groupBy("own_line", "own_brigade")).applyInArrow(run, RESULT)


CHAINS = pa.schema([("line", pa.string()), ("brigade", pa.string()), ("vehicle_number", pa.string()), ("n", pa.int32()), ("cost", pa.float64()), ("chain", pa.list_(pa.int32()))])
SCHEMA = pa.schema([(n, {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}[t]) for n, t in (x.split() for x in RESULT.split(", "))])
