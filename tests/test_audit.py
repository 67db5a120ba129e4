"""Audit, matching and crew operators where ids repeat across sources, and their NULL paths."""

import datetime as dt

from fieldlens.operators import audit, classify, crew, matching

D = dt.date(2024, 1, 7)
T = dt.datetime(2024, 1, 7, 8)
USERS = "user_id long, source_database string, first_name string, last_name string, hourly_wage double"


def users(spark):
    return spark.createDataFrame([(1, "a", "Ann", "Roe", 10.0), (1, "b", "Bo", "Poe", 20.0), (2, "a", None, "Solo", 30.0)], USERS)


def test_cancel_audit_keeps_sources_apart(spark):
    runs = spark.createDataFrame([(7, "a", -1, 0, 1), (7, "b", -1, 0, 1), (8, "a", -1, 1, 1), (9, "a", -2, 0, None), (10, "a", 1, 0, 1), (11, "a", -1, 0, 5)],
                                 "leg_id long, source_database string, last_status_id int, deleted int, canceled_reason_id int")
    log = spark.createDataFrame([(1, "a", 7, "canceled_time", 1), (2, "a", 7, "canceled_time", 2), (9, "b", 7, "canceled_time", 1), (99, "a", 7, "other", 1), (3, "a", 11, "canceled_time", 77)],
                                "id long, source_database string, leg_id long, field string, user_id long")
    reasons = spark.createDataFrame([(1, "No show", "a"), (1, "Weather", "b")], "canceled_reason_id int, cancel_reason_name string, source_database string")
    got = {(r.leg_id, r.source_database): (r.last_change_id, r.canceled_by, r.cancel_reason_name) for r in audit.cancel_audit(runs, log, users(spark), reasons).collect()}
    assert got == {(7, "a"): (2, "Solo, ", "No show"), (7, "b"): (9, "Poe, Bo", "Weather"), (9, "a"): (None, ", ", None), (11, "a"): (3, ", ", None)}


def test_attachment_log_follows_the_chain(spark):
    events = spark.createDataFrame([(1, 5, 1, "create", T, "a"), (2, 5, 1, "create", T, "b"), (3, 5, 1, "view", T, "a"), (4, 6, 1, "create", T, "a"), (5, 7, 1, "create", T, "a")],
                                   "log_id long, attachment_id long, uploader_id long, action string, uploaded_at timestamp_ntz, source_database string")
    files = spark.createDataFrame([(5, "f.pdf", "a"), (5, "g.pdf", "b"), (7, "h.pdf", "a")], "attachment_id long, file_name string, source_database string")
    links = spark.createDataFrame([(50, 100, 5, "a"), (51, 101, 5, "a"), (50, 200, 5, "b")], "leg_attachment_id long, leg_id long, attachment_id long, source_database string")
    types = spark.createDataFrame([(50, "a", "PCS"), (50, "a", "Face"), (50, "a", "PCS"), (51, "a", None)], "leg_attachment_id long, source_database string, type_name string")
    got = sorted((r.log_id, r.leg_id, r.file_name, r.attachment_types) for r in audit.attachment_log(events, files, links, types).collect())
    assert got == [(1, 100, "f.pdf", "Face, PCS"), (1, 101, "f.pdf", "Unspecified"), (2, 200, "g.pdf", "Unspecified")]


def _compliance(spark, runs, crew_rows, log, records):
    runs = spark.createDataFrame([(*r, "r", D) for r in runs], "leg_id long, source_database string, run_number long, run_outcome string, calltype_name string, reason_for_transport string, "
                                 "source_name string, region string, service_date date")
    crew_df = spark.createDataFrame(crew_rows, "leg_id long, source_database string, crew_user_id long")
    log = spark.createDataFrame(log, "leg_id long, source_database string, uploader_id long, attachment_types string, uploaded_at timestamp_ntz")
    records = spark.createDataFrame(records, "id long, run_number string, source_database string, finalizer_id long, finalized int")
    return {(r.leg_id, r.source_database, r.user_id): r for r in audit.compliance(runs, crew_df, log, records, users(spark)).collect()}


def test_compliance_takes_one_care_record_and_keeps_sources_apart(spark):
    runs = [(7, "a", 70, "ran", "ALS", None, None), (7, "b", 70, "ran", "ALS", "Other", "Home"), (8, "a", 80, "turned", "ALS", None, None)]
    crew_rows = [(7, "a", 1), (7, "a", 2), (7, "a", 1), (7, "b", 1), (8, "a", 1)]
    log = [(7, "a", 2, "PCS", T), (7, "a", 9, "Face", T - dt.timedelta(hours=1))]
    # the finalized record wins over a newer one, then the newest; another source's record does not count
    records = [(1, "70", "a", 1, 1), (2, "70", "a", 2, 0), (3, "70", "a", 2, None), (4, None, "a", 2, 1), (5, "70", "b", 55, 1)]
    got = _compliance(spark, runs, crew_rows, log, records)
    assert set(got) == {(7, "a", 1), (7, "b", 1)}
    a, b = got[7, "a", 1], got[7, "b", 1]
    assert (a.is_finalizer, a.finalizer_is_crew_member, a.total_attachments, a.crew_attachments, a.all_attachment_types, a.first_attachment_time) == (True, True, 2, 1, "Face; PCS", T - dt.timedelta(hours=1))
    assert a.is_compliant and a.requires_attachment and a.crew_member_name == "Roe, Ann"
    assert (b.total_attachments, b.is_compliant, b.finalizer_id, b.finalizer_is_crew_member, b.crew_member_name) == (0, False, 55, False, "Poe, Bo")


def test_compliance_exemptions_and_missing_values(spark):
    cases = {1: ("ALS", None, None, True), 2: (None, None, None, True), 3: ("Medicar", None, None, False), 4: ("ALS", "Dialysis", None, False), 5: ("ALS", "Doctors Appointment", "x", False),
             6: ("ALS", None, "Big Vet Ride North", False), 7: (None, "Dialysis", None, False), 8: ("BLS", "Other", "x", True)}
    got = _compliance(spark, [(i, "a", i, "ran", c, r, s) for i, (c, r, s, _) in cases.items()], [(i, "a", 1) for i in cases], [], [])
    for i, (*_, required) in cases.items():
        row = got[i, "a", 1]
        assert row.requires_attachment is required and row.is_compliant is (not required) and row.finalizer_id is None


def test_qa_recon_starts_from_the_legs(spark):
    legs = spark.createDataFrame([(7, "a", D, 1, "ALS", "Urgent"), (7, "b", D, 1, "ALS", None), (9, "a", D, None, None, "x"), (10, "a", D, None, None, "x")],
                                 "leg_id long, source_database string, service_date date, patient_id long, calltype_name string, level_of_service string")
    links = spark.createDataFrame([(7, 70, "a"), (7, 71, "b"), (9, 99, "a")], "leg_id long, run_id long, source_database string")
    records = spark.createDataFrame([(70, 1, "a", 1, D, 1), (71, 2, "b", 0, None, 1), (70, 3, "b", 1, D, 1)],
                                    "run_id long, run_num long, source_database string, finalized int, finalized_date date, create_user long")
    log = spark.createDataFrame([(70, "a", None), (70, "b", "bad"), (71, "b", "bad")], "run_id long, source_database string, errors string")
    qa = spark.createDataFrame([(71, "b", "Flagged", D, 1)], "run_id long, source_database string, status_name string, qa_date date, set_by_user long")
    patients = spark.createDataFrame([(1, "a", "Pat A", D), (1, "b", "Pat B", D)], "patient_id long, source_database string, patient_name string, dob date")
    got = sorted(((r.run_id or 0, r.source_database, r.patient_name, r.calltype, r.finalized, r.status_name, r.reviewer_name, r.crew_name, r.exported)
                  for r in audit.qa_recon(legs, links, records, log, qa, users(spark), patients).collect()), key=str)
    assert got == sorted([(70, "a", "Pat A", "ALS Urgent", "Yes", "Submitted", None, "Roe, Ann", "Exported"), (71, "b", "Pat B", None, "No", "Flagged", "Poe, Bo", "Poe, Bo", "Failed"),
                          (0, "a", None, None, "No", "Not Finalized", None, None, "Not Exported")], key=str)  # the two legs without a record are one row


def test_pay_list_by_source(spark):
    runs = spark.createDataFrame([(7, "src0", 70, D, T, T + dt.timedelta(hours=2), 1), (7, "src1", 70, D, T, T + dt.timedelta(hours=1), 1)],
                                 "leg_id long, source_database string, run_number long, service_date date, assigned_time timestamp_ntz, clear_time timestamp_ntz, last_status_id int")
    link = spark.createDataFrame([(7, "src0", 1), (7, "src1", 1)], "leg_id long, source_database string, crew_user_id long")
    u = spark.createDataFrame([(1, "src0", "Ann", "Roe", 10.0), (1, "src1", "Bo", "Poe", 20.0)], USERS)
    assert sorted((r.source_database, r.crew_name, r.pay_amount) for r in audit.pay_list(runs, link, u).collect()) == [("src0", "Ann Roe", 20.0), ("src1", "Bo Poe", 20.0)]


def test_run_crew_meets_leg_link_and_seat_by_source(spark):
    from pyspark.sql import functions as F
    times = ["pickup_time", "assigned_time", "acknowledged_time", "enroute_time", "at_scene_time", "transporting_time", "at_destination_time", "clear_time"]
    runs = spark.createDataFrame([(7, 70, s, D, "ALS", None, *[T + dt.timedelta(minutes=10 * i) for i in range(8)]) for s in ("a", "b")],
                                 "leg_id long, run_number long, source_database string, service_date date, calltype_name string, canceled_time timestamp_ntz, " + ", ".join(f"{t} timestamp_ntz" for t in times))
    runs = runs.withColumn("created", F.col("pickup_time")).withColumn("call_started_time", F.col("pickup_time"))
    link = spark.createDataFrame([(7, "a", 500), (7, "b", 500), (7, "b", 500)], "leg_id long, source_database string, shift_assignment_id long")
    columns = {"assignment_id": "long", "source_database": "string", "user_id": "long"}
    seats = spark.createDataFrame([(500, "a", 1), (500, "b", 2), (500, "c", 3)], ", ".join(f"{k} {v}" for k, v in columns.items()))
    seats = seats.select(*columns, *[F.lit(None).cast("string").alias(c) for c in crew.SEAT_ATTRS if c not in columns])
    got = sorted((r.leg_id, r.source_database, r.assignment_id, r.user_id) for r in crew.run_crew(runs, link, seats).collect())
    assert got == [(7, "a", 500, 1), (7, "b", 500, 2)]


def test_only_live_regular_seats_of_known_users_match(spark):
    seats = spark.createDataFrame([(1, 1, "a", "0", "true", "Regular"), (2, 1, "a", "1", "true", "Regular"), (3, 1, "a", "0", "false", "Regular"), (4, 1, "a", "0", "true", "Swap"),
                                   (5, None, "a", "0", "true", "Regular"), (6, 9, "a", "0", "true", "Regular"), (7, 2, "b", "0", "true", "Regular"), (8, 1, "a", None, None, None)],
                                  "assignment_id long, user_id long, source_database string, deleted string, published string, seat_type string")
    assert [r.assignment_id for r in matching.matchable(seats, users(spark)).collect()] == [1]
    assert sorted(r.assignment_id for r in matching.live_seats(seats).collect()) == [1, 3, 4, 5, 6, 7]
    punches = spark.createDataFrame([(1, 1, "a"), (2, 9, "a"), (3, 2, "b"), (4, None, "a")], "time_id long, time_user_id long, source_database string")
    assert [r.time_id for r in matching.of_users(punches, users(spark)).collect()] == [1]


def test_the_latest_note_for_a_slot_gives_the_requirement(spark):
    seats = spark.createDataFrame([(1, "a", 5, 0, 0, "U"), (2, "b", 5, 0, 0, "U"), (3, "a", 5, 1, 9, "Memphis - Orientation"), (4, "a", None, 0, None, None)],
                                  "assignment_id long, source_database string, unit_id long, position_slot int, earning_code_id int, unit_name string")
    notes = spark.createDataFrame([(1, "a", 5, 0, 2), (4, "a", 5, 0, 1), (9, "b", 5, 0, 2), (3, "a", 5, 1, 77)], "id long, source_database string, unit_id long, slot int, template_id int")
    templates = spark.createDataFrame([(1, "FTO Medic", 1, 2, "a"), (2, "Third Party", None, None, "b"), (2, "EMT", 1, 1, "a")],
                                      "template_id int, template_name string, min_licensure_id int, min_level_id int, source_database string")
    codes = spark.createDataFrame([(0, "Regular", "a"), (0, "Normal", "b")], "earning_code_id int, earning_code string, source_database string")
    out = matching.with_requirements(seats, notes, templates, codes)
    got = {r.assignment_id: (r.required_qualification, r.min_level_id, r.earning_code) for r in out.collect()}
    assert got == {1: ("FTO Medic", 2, "Regular"), 2: ("Third Party", None, "Normal"), 3: (None, None, None), 4: (None, None, None)}
    from pyspark.sql import functions as F
    flags = classify.shift_flags(out.withColumn("cost_center_name", F.lit("X")))
    assert {r.assignment_id: r.is_training for r in flags.collect()} == {1: True, 2: True, 3: True, 4: False}
