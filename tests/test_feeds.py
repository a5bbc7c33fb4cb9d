import random
import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tramline.plans import feed_health as H
from tramline.plans import matching as M
from tramline.sources import gtfs_zip, sinks
from tramline.streaming import health


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_alignment_equals_all_choices():
    """Against every choice of at most one candidate for each stop."""
    rng = random.Random(3)
    for _ in range(60):
        c = [(s, rng.randrange(8), rng.randrange(100) * 10, s * 100, rng.randrange(70)) for s in range(1, 5) for _ in range(rng.randrange(4))]
        c = [(s, g, g * 100 + t % 100, w, d) for s, g, t, w, d in c]
        if not c:
            assert M.align(c) == []
            continue
        delays = sorted(t - w for _, _, t, w, _ in c)
        n = len(delays)
        middle = (delays[n // 2] + delays[(n - 1) // 2]) / 2
        cost = lambda x: 1 + x[4] / 75 + abs(x[2] - x[3] - middle) / 900
        best = (0, 0.0)

        def go(chosen, i):
            nonlocal best
            best = max(best, (len(chosen), -sum(map(cost, chosen))))
            for j in range(i, len(c)):
                x, last = sorted(c)[j], chosen[-1] if chosen else None
                if last is None or (last[0] < x[0] and last[1] < x[1] and last[2] <= x[2]):
                    go([*chosen, x], j + 1)

        go([], 0)
        got = M.align(c)
        value = -sum(min(cost(x) for x in c if x[:3] == g) for g in got)
        assert len(got) == best[0] and value == pytest.approx(best[1])


def test_incident_machine_equals_batch(spark):
    rng = random.Random(1)
    rows, at = [], 0
    for _ in range(900):
        at += 60 if rng.random() < 0.995 else 180
        rows.append(("bus", at, (at // 60) % 90 < 40 or rng.random() < 0.02))
    state, events = (0, -1, 0, 0, 0), []
    for _, t, bad in rows:
        state, more = health.step(state, t, bad, 15)
        events += more
    got = H.incidents(spark.createDataFrame(rows, "mode string, at_s long, is_bad boolean")).collect()
    want = sorted([("degraded", r.start_s) for r in got] + [("recovered", r.end_s) for r in got if r.end_s is not None], key=lambda e: e[1])
    assert events == want and len(want) > 4


def test_streams_in_append_mode(spark, tmp_path):
    """Minute counters with a late ping that counts, one that doesn't, and a vehicle seen twice; incidents over batches."""
    src, base = tmp_path / "in", 1_700_000_040
    schema = "mode string, vehicle string, t long"
    batches = [[("bus", "a", base), ("bus", "a", base + 5), ("bus", "b", base + 70)], [("bus", "c", base + 10), ("bus", "b", base + 900)], [("bus", "b", base + 2000)], [("bus", "z", base + 1), ("bus", "b", base + 2500)], [("bus", "b", base + 4000)]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(src / str(i)))
        time.sleep(1.1)  # files are taken in the order of their seconds
    files = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(src)).withColumn("gps_time", F.timestamp_seconds("t"))
    q = health.minute_counters(files).writeStream.format("memory").queryName("counted").outputMode("append").option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {(int(r.minute.timestamp()) - base, r.accepted, r.vehicles) for r in spark.table("counted").collect()}
    assert {(0, 3, 2), (60, 1, 1), (900, 1, 1)} <= got and len(got) == len({m for m, _, _ in got}), got
    minutes = [("bus", 60 * i, 20 <= i < 60) for i in range(1, 100)]
    for i in range(0, 99, 33):
        spark.createDataFrame(minutes[i : i + 33], "mode string, at_s long, is_bad boolean").coalesce(1).write.parquet(str(tmp_path / "m" / str(i)))
        time.sleep(1.1)
    stream = spark.readStream.schema("mode string, at_s long, is_bad boolean").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "m"))
    q = health.incident_events(stream).writeStream.format("memory").queryName("incidents").outputMode("append").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert rows_of(spark.table("incidents")) == [("bus", "degraded", 1200), ("bus", "recovered", 3600)]


def test_archive_is_read_strictly(spark, tmp_path):
    import io
    import zipfile

    def archive(skip=None, drop=None):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for m, cols in gtfs_zip.MEMBERS.items():
                if m != skip:
                    cols = [c for c in cols if c != drop]
                    z.writestr(m, ",".join(cols) + "\n" + ",".join(f'"{c}, 1"' for c in cols) + "\n")
        return out.getvalue()

    data = archive()
    name = gtfs_zip.snapshot_id(data, "2024-03-20T05:00:00Z")
    got = gtfs_zip.load(spark, data, name)
    assert sorted(got) == ["calendar_dates", "routes", "shapes", "stop_times", "stops", "trips"]
    r = got["stops"].first()
    assert r.stop_name == "stop_name, 1" and r.gtfs_snapshot_id == name and str(r.gtfs_snapshot_date) == "2024-03-20"
    assert not gtfs_zip.changed(data, name) and gtfs_zip.changed(data + b"x", name) and gtfs_zip.changed(data, None)
    for bad in (archive(skip="shapes.txt"), archive(drop="stop_lat")):
        with pytest.raises(gtfs_zip.BadArchive):
            gtfs_zip.load(spark, bad, gtfs_zip.snapshot_id(bad, "2024-03-20T05:00:00Z"))
    with pytest.raises(gtfs_zip.BadArchive):
        gtfs_zip.load(spark, data, "2024-03-20T05:00:00Z_000000000000")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "n long, day string")
    root = str(tmp_path / "parts")
    assert sinks.append_once(df, root) == sinks.append_once(df.orderBy(F.desc("n")), root)
    sinks.append_once(df.where("n = 1"), root)
    assert spark.read.parquet(root).count() == 4
    table = str(tmp_path / "table")
    sinks.overwrite_partitions(df, table, ["day"])
    sinks.overwrite_partitions(spark.createDataFrame([(9, "b")], "n long, day string"), table, ["day"])
    assert rows_of(spark.read.parquet(table).select("n", "day")) == [(1, "a"), (9, "b")]
    pub = str(tmp_path / "pub")
    first = sinks.publish(spark, pub, {"t": df})

    def refuse(tables):
        raise ValueError("no")

    with pytest.raises(ValueError):
        sinks.publish(spark, pub, {"t": df.limit(0)}, [refuse])
    assert sinks.current(spark, pub) == first and sinks.views(spark, pub) == ["t"] and spark.table("t").count() == 3
    second = sinks.publish(spark, pub, {"t": df.where("n > 1")})
    assert sinks.current(spark, pub) == second and len(sinks.expire(spark, pub, 1)) == 2 and spark.read.parquet(f"{pub}/{second['generation']}/t").count() == 2
    changes = sinks.changed_partitions(df, spark.createDataFrame([(1, "a"), (2, "b"), (5, "c")], "n long, day string"), "day")
    assert rows_of(changes) == [("b", "replace"), ("c", "drop")]
    sinks.write_artifact(df, str(tmp_path / "artifact"), {"n": "int", "day": "string"}, ["n"], ["n"])
    assert spark.read.parquet(str(tmp_path / "artifact")).schema["n"].dataType.simpleString() == "int"
    for bad in ({"unique": ["day"]}, {"required": ["x"]}):
        with pytest.raises(ValueError):
            sinks.write_artifact(df.withColumn("x", F.lit(None).cast("int")), str(tmp_path / "bad"), {"n": "int", "day": "string", "x": "int"}, **bad)


def test_aligned_stops_rise(spark, sf_dir):
    got = entry.queries()["aligned_stops"](spark, sf_dir).collect()
    by = {}
    for r in got:
        by.setdefault((r.vehicle_number, r.trip_id), []).append((r.stop_sequence, r.segment, r.crossing_s))
    assert len(got) > 50
    for stops in by.values():
        stops.sort()
        assert all(a[0] < b[0] and a[1] < b[1] and a[2] <= b[2] for a, b in zip(stops, stops[1:]))


def test_every_query_has_sql_or_a_test():
    missing = {k for k in entry.queries() if k not in entry.oracle_sql()}
    assert {k for k in missing if not k.startswith("op") and k != "pipeline"} == {"aligned_stops"}


def test_search_equals_plain_rounds(spark):
    """Against all chains of at most three rides over drawn timetables, with walks between them."""
    from tramline.plans import journeys as J

    rng = random.Random(5)
    calls, walks = [], [(f"s{a}", f"s{(a + 3) % 9}", 120 + 10 * a) for a in range(9)]
    for trip in range(40):
        t, stop = rng.randrange(3000), rng.randrange(9)
        for pos in range(rng.randrange(2, 6)):
            calls.append((f"t{trip}", pos, f"s{stop}", t + 5, t, rng.random() < 0.9, rng.random() < 0.9))
            t, stop = t + rng.randrange(60, 700), (stop + rng.choice((1, 2, 8))) % 9
    asked, until = [("a", "s0", 0), ("b", "s4", 900), ("c", "nowhere", 0)], 5000
    late = lambda s: max(0, s) * 1.1
    want = []
    for name, origin, at in asked:
        end = at + until
        best, rides = {origin: at}, {}
        for a, b, s in walks:
            if a == origin and at + s < end:
                best[b] = min(best.get(b, end), at + s)
        front = dict(best)
        for n in (1, 2, 3):
            rode = {}
            for x in calls:
                for y in calls:
                    if x[0] == y[0] and y[1] > x[1] and x[5] and y[6] and x[2] in front and front[x[2]] <= x[3] < end:
                        t = max(-int(-(x[3] + late(y[4] - x[3])) // 1), y[4], x[3])
                        if t < end and t < rode.get(y[2], rides.get(y[2], end)):
                            rode[y[2]] = t
            rides |= rode
            new = dict(rode)
            for a, b, s in walks:
                if a in rode and rode[a] + s < end:
                    new[b] = min(new.get(b, end), rode[a] + s)
            front = {k: t for k, t in new.items() if t < best.get(k, end + 1)}
            best |= front
            want += [(name, k, n, t) for k, t in front.items()]
    c = spark.createDataFrame(calls, "trip_id string, pos int, stop_id string, dep_s int, arr_s int, may_board boolean, may_alight boolean")
    w = spark.createDataFrame(walks, "from_stop_id string, to_stop_id string, walk_s int")
    r = spark.createDataFrame(asked, "request string, stop_id string, depart_s int")
    got = J.search(r, c, w, lambda _, df: df, lambda s: s * 1.1, vehicles=3, most=until)
    assert rows_of(got) == sorted(want, key=str) and len({v for _, _, v, _ in want}) > 1
    assert J.search(r.limit(0), c, w, lambda _, df: df, lambda s: s * 1.1, vehicles=2).count() == 0


def test_spread_points_keep_their_gap(spark):
    from tramline.plans import serving as V

    rng = random.Random(2)
    drawn = {k: sorted(rng.choice((rng.random() * 3, 96 + rng.random() * 4, rng.random() * 100)) for _ in range(n)) for k, n in enumerate((1, 2, 30, 300))}
    df = spark.createDataFrame([(k, i + 1, x) for k, xs in drawn.items() for i, x in enumerate(xs)], "k int, point_rank int, x_percent double")
    got = {(r.k, r.point_rank): r.x for r in V.spread(df, ["k"]).collect()}
    for k, xs in drawn.items():
        n, gap = len(xs), min(0.55, 100 / max(1, len(xs) - 1))
        x = list(xs)
        for i in range(1, n):
            x[i] = max(x[i], x[i - 1] + gap)
        if n > 1:
            x = [v - max(0, x[-1] - 100) for v in x]
            for i in range(n - 2, -1, -1):
                x[i] = min(x[i], x[i + 1] - gap)
            x = [min(100, max(0, v + max(0, -x[0]))) for v in x]
        assert [got[k, i + 1] for i in range(n)] == pytest.approx(x)


def test_best_chain_equals_all_chains():
    from tramline.plans import duties as D

    rng = random.Random(11)
    lengths = set()
    for _ in range(150):
        starts = [k * 1500 for k in range(rng.randrange(1, 6))]
        own = []
        for _ in range(rng.randrange(1, 9)):
            k = rng.randrange(len(starts))
            departs = starts[k] + rng.choice((-600, 0, 60, 300, 1200, 2400))
            own.append({"course": k, "origin": departs - 30, "departs": departs, "arrives": departs + rng.choice((900, 1400, 1700))})
        chains = []

        def go(chain, cost):
            if chain:
                chains.append((-len(chain), cost))
            for c in own:
                delay = c["departs"] - starts[c["course"]]
                if not chain:
                    go([c], abs(delay))
                    continue
                b = chain[-1]
                was = b["departs"] - starts[b["course"]]
                if c["course"] > b["course"] and c["departs"] > b["arrives"] and not (delay - was > 900 and c["origin"] - b["arrives"] > 900):
                    go([*chain, c], cost + abs(delay - was))

        go([], 0)
        n, cost, chain = D.best_chain(starts, own)
        assert (n, cost) == min(chains) and len(chain) == -n
        lengths.add(-n)
    assert len(lengths) > 3 and D.best_chain([0], []) is None


def test_settled_statuses(spark):
    from tramline.plans import duties as D

    course = [{"trip_id": f"t{k}", "start": k * 3000, "settled": k != 5} for k in range(8)]
    ride = lambda k, v, late=0, kind="candidate", fits=True: {"course": k, "kind": kind, "fits": fits, "vehicle": v, "origin": k * 3000 + late - 30, "departs": k * 3000 + late, "arrives": k * 3000 + late + 1200 if kind == "candidate" else None}
    found = [ride(0, "a"), ride(2, "a", 60), ride(3, "a", kind="partial"), ride(4, "a", 90), ride(6, "a", 9000, fits=False), ride(7, "b", kind="observation")]
    got = [(x["execution_status"], x["execution_reason"]) for x in D.settle(course, found)]
    assert [s for s, _ in got] == ["executed", "skipped", "executed", "short_turned", "executed", "uncertain", "uncertain", "uncertain"]
    assert [r for _, r in got[5:]] == ["passenger_boundaries_unknown", "implausible_schedule_alignment", "terminal_progression_incomplete"]
    assert D.settle(course[:2], [])[0]["execution_reason"] == "no_line_observation"
    two = D.settle(course[:2], [ride(0, "a"), ride(0, "b", 10)])
    assert two[0]["execution_status"] == "vehicle_change_signal" and two[0]["vehicle_number"] is None and two[1]["execution_status"] == "missed"
    # a vehicle that was away long and comes back an hour late under the next course
    away = [ride(0, "a"), {**ride(1, "a", 3000), "arrives": 9000}, {**ride(2, "a", 0), "origin": 5970, "departs": 6000, "arrives": 7200}]
    assert [x["execution_status"] for x in D.settle(course[:3], away)] == ["executed", "missed", "executed"]
    c = spark.createDataFrame([("1", "1", f"t{k}", k * 3000, True) for k in (0, 1, 1)], "line string, brigade string, trip_id string, scheduled_start_s long, settled boolean")
    e = spark.createDataFrame([("a", "t0", "candidate", True, 0, 30, 900)], "vehicle_number string, trip_id string, kind string, fits boolean, origin long, departs long, arrives long")
    assert sorted((r.trip_id, r.execution_status) for r in D.settled_duties(c, e).collect()) == [("t0", "executed"), ("t1", "missed")]
    assert D.settled_duties(c.limit(0), e).count() == 0
