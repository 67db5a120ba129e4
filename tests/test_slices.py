"""Sweep-line slices against brute force over all (slice, seat) pairs, membership, report lists, running sums with carries; co-member groups."""

import collections
import datetime as dt
import itertools
import random

from pyspark.sql import functions as F

from fieldlens.operators import slices, staffing

SCHEMA = ("assignment_id long, unit_name string, cost_center_id int, cost_center_name string, date_line date, source_database string, assigned_name string, "
          "first_name string, last_name string, assignment_status string, scheduled_hours double, hours_worked double, shift_start timestamp_ntz, shift_end timestamp_ntz")
T0 = dt.datetime(2024, 1, 7)


def seat(i, unit, cc, src, name, status, sched, worked, start, end):
    at = lambda h: None if h is None else T0 + dt.timedelta(hours=h)
    first, last = (name.split(", ")[1], name.split(", ")[0]) if name and ", " in name else (None, None)
    day = T0.date() if start is None else at(start).date()
    return (i, unit, cc, None if cc is None else f"Center {cc}", day, src, name, first, last, status, sched, worked, at(start), at(end))


def fixture(n=150):
    rng = random.Random(8)
    out = []
    for i in range(n):
        start = rng.choice([0, 6, 6.5, 12, 18, 23.75, 30, 47, 100]) + rng.choice([0, 0, 1 / 3])
        name = rng.choice([None, "Roe, Ann", "Poe, Bo", "solo"])
        out.append(seat(i, rng.choice(["U1", "U1", "U1", "U2", None]), rng.choice([1, 2, None]), rng.choice(["src0", "src1"]), name, "ASSIGNED" if name else "OPEN",
                        rng.choice([None, 0.0, 8.0, 7.25]), rng.choice([None, 3.125, 8.5]), start, start + rng.choice([0, 4, 8.5, 12, 26])))
    out += [seat(900, "U3", 1, "src0", "solo", "ASSIGNED", 5.0, 5.0, None, 4), seat(901, "U3", 1, "src0", "solo", "ASSIGNED", 5.0, 5.0, 3, None), seat(902, "U3", 1, "src0", None, "OPEN", 0.0, None, 1, 9)]
    return out


def brute(rows):
    keys = SCHEMA.replace(",", "").split()[::2]
    seats = [dict(zip(keys, r)) for r in rows]
    found = {}
    for unit in {s["unit_name"] for s in seats} - {None}:
        own = [s for s in seats if s["unit_name"] == unit]
        points = sorted({s[c] for s in own for c in ("shift_start", "shift_end")} - {None})
        for a, b in itertools.pairwise(points):
            groups = collections.defaultdict(list)
            for s in own:
                if s["shift_start"] is not None and s["shift_end"] is not None and s["shift_start"] <= a and s["shift_end"] >= b and s["shift_end"] > a:
                    groups[s["cost_center_id"], s["date_line"]].append(s)
            for (cc, day), m in groups.items():
                hours = round((b - a).total_seconds() / 3600 + 1e-9, 2)
                sched, worked = (sum(s[c] or 0 for s in m) for c in ("scheduled_hours", "hours_worked"))
                found[unit, a, b, cc, day] = (len(m), ", ".join(sorted({s["assignment_status"] for s in m})), round(len(m) * hours, 2), round(sum(s["assigned_name"] is None for s in m) * hours, 2),
                                             worked, sched, round(worked / sched * 100, 1) if sched else 0.0, ", ".join(sorted({s["source_database"] for s in m})), hours,
                                             sorted(s["assigned_name"] or "OPEN" for s in m))
    return found


def test_slices_equal_all_pairs(spark):
    rows = fixture()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = brute(rows)
    got = slices.slice_facts(df).collect()
    assert len(got) == len(want)
    for r in got:
        w = want[r.unit_name, r.start_time, r.end_time, r.cost_center_id, r.date_line]
        assert (r.crew_count, r.assignment_statuses, r.source_databases) == (w[0], w[1], w[7])
        for have, should in zip((r.total_scheduled_hours, r.total_open_hours, r.total_worked_hours, r.total_individual_scheduled_hours, r.interval_duration_hours), (w[2], w[3], w[4], w[5], w[8])):
            assert abs(have - should) < 0.0051
        assert abs(r.utilization_percentage - w[6]) < 0.11


def test_members_and_report_names(spark):
    rows = fixture()
    df = spark.createDataFrame(rows, SCHEMA)
    members = slices.slice_members(df)
    assert members.count() == sum(1 for r in rows if r[1] and r[12] and r[13] and r[13] > r[12])  # a row a seat, no list
    assert all(f.dataType.simpleString().startswith("array") is False for f in members.schema.fields)
    report = slices.crew_names(slices.slice_facts(df).where("unit_name = 'U1'"), members)
    want = brute(rows)
    for r in report.collect():
        assert r.crew_names == "; ".join(want[r.unit_name, r.start_time, r.end_time, r.cost_center_id, r.date_line][9])
        assert "Ann Roe" in r.crew_full_names or "Roe, Ann" not in r.crew_names
    assert report.count() == sum(1 for k in want if k[0] == "U1")
    assert slices.slice_facts(df.limit(0)).count() == 0


def test_seats_are_not_multiplied_by_slices(spark):
    """One busy unit and day: what is joined is boundaries with groups, however many seats there are."""
    rows = [seat(i, "U", 1, "src0", None, "OPEN", 0.0, None, i % 4, 8 + i % 3) for i in range(3000)]
    plan = slices.slice_facts(spark.createDataFrame(rows, SCHEMA))
    got = {(r.start_time.hour, r.end_time.hour): r.crew_count for r in plan.collect()}
    assert got == {(h, h + 1): sum(1 for i in range(3000) if i % 4 <= h and 8 + i % 3 >= h + 1) for h in (0, 1, 2, 8, 9)} | {(3, 8): 3000}
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_running_sums_carry_over_buckets(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", None]), i, rng.randrange(-5, 6)) for i in range(500)]
    got = slices.running_sums(spark.createDataFrame(rows, "k string, t int, n long"), ["k"], "t", F.floor(F.col("t") / 37), ["n"]).collect()
    total = collections.Counter()
    want = []
    for k, t, n in rows:
        total[k] += n
        want.append((k or "", t, total[k]))
    assert sorted((r.k or "", r.t, r.n) for r in got) == sorted(want)


def test_co_members_are_rows_not_lists(spark):
    rows = [(1, "s", 7, dt.date(2024, 1, 7), T0, "Ann"), (2, "s", 7, dt.date(2024, 1, 7), T0, "Bo"), (3, "s", 7, dt.date(2024, 1, 7), T0, "Ann"), (4, "s", 7, dt.date(2024, 1, 7), T0, None),
            (5, "t", 7, dt.date(2024, 1, 7), T0, "Cy"), (6, "s", None, dt.date(2024, 1, 7), T0, "Di")]
    df = spark.createDataFrame(rows, "assignment_id long, source_database string, unit_id long, date_line date, shift_start timestamp_ntz, assigned_name string")
    counts, names = staffing.co_members(df)
    assert sorted((r.source_database, r.members) for r in counts.collect()) == [("s", 4), ("t", 1)]
    assert sorted((r.member_name, r.bearers) for r in names.collect()) == [("Ann", 2), ("Bo", 1), ("Cy", 1)]
    got = {r.assignment_id: (r.partner_count, r.partner_names) for r in staffing.shift_partners(df).collect()}
    assert got == {1: (3, "Ann, Bo"), 2: (3, "Ann"), 3: (3, "Ann, Bo"), 4: (3, "Ann, Bo"), 5: (0, None), 6: (0, None)}


def test_groups_grow_with_the_data_not_their_size(spark):
    from fieldlens.sources import roles
    sizes = []
    for root in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        counts, names = staffing.co_members(roles.shifts(spark, root).withColumn("assigned_name", F.col("user_id").cast("string")))
        sizes.append((names.count() / roles.shifts(spark, root).count(), counts.agg(F.max("members")).first()[0]))
    assert max(s for s, _ in sizes) <= 1 and sizes[1][1] < 4 * sizes[0][1]
