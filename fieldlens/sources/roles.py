"""Role views: the driver's tables re-read as the operational entities the operators
expect (run header, leg revision, stage times, shift seat, punch, ...).

Every role is a deterministic DataFrame expression over the given tables, so its size
grows with them; nothing is generated on the driver. The same derivations are written
in DuckDB SQL for the oracle (``fieldlens/plans/oracle.py``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.functions.scalars import add_hours, add_minutes, epoch_seconds, ntz_lit
from fieldlens.operators.matching import live_seats
from fieldlens.operators.keys import current_pointer, distinct_on
from fieldlens.sources.tables import load_table, parts_of, values_relation

# ---------------------------------------------------------------------------
# Fixed values of the fixture (chosen for the driver tables; not derived from data).
# as_of dates: event roles, order roles.
AS_OF_EVENTS = dt.date(2024, 1, 25)
AS_OF_ORDERS = dt.date(2001, 8, 1)
# Pay-period anchors (Sunday starts), 14-day periods.
PERIOD_ANCHOR_EVENTS = dt.date(2023, 12, 24)
PERIOD_ANCHOR_ORDERS = dt.date(1994, 12, 25)
# Call type by order priority.
CALL_TYPES = [
    ("1-URGENT", "CCT"),
    ("2-HIGH", "ALS"),
    ("3-MEDIUM", "BLS"),
    ("4-NOT SPECIFIED", "Standby - BLS"),
    ("5-LOW", "Medicar"),
]
# Local time zone per source.
SOURCE_TZ = [("src0", "America/Chicago"), ("src1", "America/Detroit"), ("src2", "America/Chicago")]
# Allow-listed cost centers: (cost_center_id, cost_center_name, source_database, special_event).
VALID_COST_CENTERS = [
    (0, "ECONOMY", "src0", False), (1, "LARGE", "src0", True), (2, "MEDIUM", "src0", False),
    (3, "PROMO", "src0", False), (4, "SMALL", "src0", False), (5, "STANDARD", "src0", False),
    (0, "ECONOMY", "src1", False), (1, "LARGE", "src1", True), (2, "MEDIUM", "src1", False),
    (3, "PROMO", "src1", False), (4, "SMALL", "src1", False), (5, "STANDARD", "src1", False),
    (1, "LARGE", "src2", True), (2, "MEDIUM", "src2", False), (4, "SMALL", "src2", False),
    (5, "STANDARD", "src2", False),
]
# Cancel reasons by id, the same ids in every source.
CANCEL_REASONS = [(0, "No show"), (1, "Weather"), (2, "Facility closed"), (3, "Duplicate")]
# Certification templates of seats: (template id, name, least licence, least level); earning codes.
TEMPLATES = [(0, "EMT", 1, 1), (1, "Paramedic", 2, 2), (2, "Third Party", None, None), (3, "FTO Paramedic", 2, 3), (4, "Nurse", 3, 2)]
EARNING_CODES = [(0, "Regular"), (1, "Overtime"), (2, "Holiday")]
# Reasons and facilities of runs, by leg id.
REASONS_FOR_TRANSPORT = [(0, "Dialysis"), (1, "Doctors Appointment"), (2, None), (3, "Discharge")]
VET_RIDE = "Vet Ride North"
# ---------------------------------------------------------------------------

# Total order that makes (l_orderkey, l_linenumber) revisions unique.
REVISION_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
REVISION_COLUMNS = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def source_tag(c) -> F.Column:
    return F.concat(F.lit("src"), (c % 3).cast("string"))


def call_types(spark: SparkSession) -> DataFrame:
    return values_relation(spark, CALL_TYPES, "o_orderpriority string, calltype_name string")


def source_zones(spark: SparkSession) -> DataFrame:
    return values_relation(spark, SOURCE_TZ, "source_database string, local_tz string")


def valid_cost_centers(spark: SparkSession) -> DataFrame:
    return values_relation(spark, VALID_COST_CENTERS,
                           "cost_center_id int, cost_center_name string, "
                           "source_database string, special_event boolean")


def revisions(spark: SparkSession, root: str) -> DataFrame:
    """leg_revision: one row per (leg_id, rev) after DISTINCT ON with a total order."""
    li = load_table(spark, root, "lineitem")
    first = distinct_on(li, ["l_orderkey", "l_linenumber"], REVISION_ORDER)
    return first.select(
        F.col("l_orderkey").alias("leg_id"), F.col("l_linenumber").alias("rev"),
        "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate")


def customer_regions(spark: SparkSession, root: str) -> DataFrame:
    """customer -> nation -> region; nation and region are fixed-size dimensions."""
    c = load_table(spark, root, "customer", ["c_custkey", "c_nationkey"])
    n = load_table(spark, root, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = load_table(spark, root, "region", ["r_regionkey", "r_name"])
    return (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
             .join(F.broadcast(r), F.col("n_regionkey") == r.r_regionkey)
             .select("c_custkey", "n_name", F.lower("r_name").alias("market")))


def current_revisions(spark: SparkSession, root: str) -> DataFrame:
    """Current revision of every leg in one pass: the highest revision number, and within
    it the first row by the revision total order.

    This is DISTINCT ON (leg, rev) + header pointer max(rev) + the (leg, rev) join fused
    into one top-1 window keyed by the leg. Lines are dealt by leg first: to cut them before, a scan task would have
    to sort all rows of its split, which spills once the split outgrows the task's memory; a dealt partition stays small."""
    li = load_table(spark, root, "lineitem").repartition("l_orderkey")
    cur = distinct_on(li, ["l_orderkey"], [("l_linenumber", "desc_nulls_last"), *REVISION_ORDER])
    return cur.select(
        F.col("l_orderkey").alias("leg_id"), F.col("l_linenumber").alias("rev"), *REVISION_COLUMNS)


def header_rows(spark: SparkSession, root: str) -> DataFrame:
    """Orders with the nation of their customer: what :func:`header_columns` derives all header columns from, narrow enough to be dealt again."""
    o = load_table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority", "o_totalprice")
    c = load_table(spark, root, "customer", ["c_custkey", "c_nationkey"])
    return o.join(c, o.o_custkey == c.c_custkey, "left").drop("c_custkey")


def header_columns(spark: SparkSession, root: str, rows: DataFrame, *more: str) -> DataFrame:
    """run header columns of :func:`header_rows`, and ``more`` of the rows' own columns. Nation, region and call types are of fixed size."""
    key = F.col("o_orderkey")
    pickup = add_hours(F.col("o_orderdate"), key % 24)
    n = load_table(spark, root, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = load_table(spark, root, "region", ["r_regionkey", "r_name"])
    places = n.join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", F.lower("r_name").alias("market"))
    return (rows.join(call_types(spark), "o_orderpriority", "left").join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        key.alias("leg_id"), key.alias("run_number"),
        F.col("o_custkey").alias("user_id"),
        source_tag(F.col("o_custkey")).alias("source_database"),
        F.col("o_orderdate").cast("date").alias("service_date"),
        pickup.alias("pickup_time"),
        add_hours(pickup, -(key % 72)).alias("created"),
        F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", -1)
         .when((F.col("o_orderstatus") == "P") & (key % 2 == 0), 0)
         .otherwise(F.lit(None)).cast("int").alias("last_status_id"),
        F.when(key % 3 == 0, F.lit("lost")).alias("lost_call_status"),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("emergency"),
        F.col("o_orderpriority").alias("level_of_service"),
        "calltype_name",
        (F.col("o_totalprice") / 900.0).alias("mileage"),
        F.col("market"), F.col("n_name").alias("state"),
        F.element_at(F.array(*[F.lit(r).cast("string") for _, r in REASONS_FOR_TRANSPORT]), (F.floor(key / 3) % 4 + 1).cast("int")).alias("reason_for_transport"),
        F.when(key % 13 == 0, F.lit(VET_RIDE)).otherwise(F.lit("Facility")).alias("source_name"),
        (key % 5).cast("int").alias("canceled_reason_id"),
        F.when(key % 4 == 0, F.lit("caller")).alias("cancel_reason_text"),
        F.when(key % 29 == 0, 1).otherwise(0).alias("deleted"), *more))


def header_base(spark: SparkSession, root: str) -> DataFrame:
    """run header columns derived from orders (without the revision pointer)."""
    return header_columns(spark, root, header_rows(spark, root))


def run_header(spark: SparkSession, root: str, revs: DataFrame | None = None) -> DataFrame:
    """run_header: one row per order; ``rev`` points at the highest revision (NULL if none)."""
    revs = revs if revs is not None else revisions(spark, root)
    return header_base(spark, root).join(current_pointer(revs, "leg_id", "rev"), "leg_id", "left")


def stage_rows(spark: SparkSession, root: str) -> DataFrame:
    """Each run that has a revision with its current one: the rows that :func:`stage_columns` derives the stage times from."""
    cur = current_revisions(spark, root)
    return header_rows(spark, root).join(cur, F.col("o_orderkey") == F.col("leg_id")).drop("leg_id")


def stage_times(spark: SparkSession, root: str) -> DataFrame:
    """Current revision of each run with its status timestamps (NULL paths injected).

    Equivalent to ``current_revision(run_header, revisions)`` (BO-1, see
    :func:`fieldlens.operators.keys.current_revision`), planned as one top-1 window."""
    return stage_columns(spark, root, stage_rows(spark, root))


def stage_columns(spark: SparkSession, root: str, rows: DataFrame) -> DataFrame:
    """:func:`stage_times` of :func:`stage_rows`. Names, texts and times follow from a row's few numbers, so they are derived where the rows are read
    and neither shuffled nor stored."""
    cur = header_columns(spark, root, rows, "rev", *REVISION_COLUMNS)
    q = F.col("l_quantity").cast("bigint")
    d = F.round(F.col("l_discount") * 100).cast("bigint")
    t = F.round(F.col("l_tax") * 10000).cast("bigint")
    pickup = F.col("pickup_time")
    assigned = add_minutes(pickup, -d)
    scene_raw = add_minutes(pickup, q - 20)
    return cur.select(
        "*",
        F.col("created").alias("call_started_time"),
        assigned.alias("assigned_time"),
        add_minutes(assigned, F.lit(2)).alias("acknowledged_time"),
        add_minutes(assigned, F.lit(5)).alias("enroute_time"),
        F.when(F.col("rev") % 5 == 0, F.lit(None)).otherwise(scene_raw).alias("at_scene_time"),
        F.when(F.col("rev") % 7 == 0, F.lit(None)).otherwise(add_minutes(scene_raw, F.lit(10)))
         .alias("transporting_time"),
        add_minutes(scene_raw, F.lit(35)).alias("at_destination_time"),
        add_minutes(scene_raw, t).alias("clear_time"),
        F.when(F.col("last_status_id").isNull() | (F.col("last_status_id") < 0),
               add_minutes(pickup, F.lit(-30))).alias("canceled_time"),
    )


def cost_centers(spark: SparkSession, root: str) -> DataFrame:
    """cost_center: in each source, the distinct part types numbered alphabetically from 0.

    The distinct set is tiny (bounded by the type domain), so the unpartitioned numbering
    window runs on an already-reduced input."""
    types = load_table(spark, root, "part", ["p_type"]).distinct()
    from pyspark.sql import Window
    numbered = types.select(
        (F.row_number().over(Window.orderBy("p_type")) - 1).cast("int").alias("cost_center_id"),
        F.col("p_type").alias("cost_center_name"))
    return numbered.withColumn("source_database", F.explode(F.array(*[F.lit(s) for s, _ in SOURCE_TZ])))


def seat_personnel(spark: SparkSession, root: str) -> DataFrame:
    """what seats require: every signup noted its unit's and slot's template; the latest note holds."""
    e = load_table(spark, root, "events", ["event_id", "user_id", "event_type"]).where(F.col("event_type") == "signup")
    eid = F.col("event_id")
    return e.select(eid.alias("id"), F.floor(F.col("user_id") / 6).cast("bigint").alias("unit_id"), (eid % 2).cast("int").alias("slot"),
                    (F.floor(eid / 2) % 6).cast("int").alias("template_id"), source_tag(F.col("user_id")).alias("source_database"))


def _by_source(spark: SparkSession, rows, schema: str) -> DataFrame:
    """fixed rows, the same in every source."""
    return values_relation(spark, [(*r, s) for r in rows for s, _ in SOURCE_TZ], schema + ", source_database string")


def templates(spark: SparkSession) -> DataFrame:
    return _by_source(spark, TEMPLATES, "template_id int, template_name string, min_licensure_id int, min_level_id int")


def earning_codes(spark: SparkSession) -> DataFrame:
    return _by_source(spark, EARNING_CODES, "earning_code_id int, earning_code string")


def cancel_reasons(spark: SparkSession) -> DataFrame:
    return _by_source(spark, CANCEL_REASONS, "canceled_reason_id int, cancel_reason_name string")


def shifts(spark: SparkSession, root: str, events: DataFrame | None = None) -> DataFrame:
    """shift seats from ``signup`` events: open seat (NULL user) every 10th, 6-hour starts.
    ``events`` replaces the events table (e.g. an earlier snapshot of it)."""
    e = events if events is not None else load_table(spark, root, "events")
    e = e.select("event_id", "ts", "user_id", "event_type").where(F.col("event_type") == "signup")
    eid = F.col("event_id")
    start = add_hours(F.col("ts").cast("date").cast("timestamp_ntz"),
                      (F.floor(F.hour("ts") / 6) * 6).cast("int"))
    base = e.select(
        eid.alias("assignment_id"),
        F.when(eid % 10 == 0, F.lit(None)).otherwise(F.col("user_id")).cast("bigint").alias("user_id"),
        source_tag(F.col("user_id")).alias("source_database"),
        F.when(eid % 50 == 0, F.lit(None)).otherwise(F.floor(F.col("user_id") / 6)).cast("bigint").alias("unit_id"),
        start.alias("shift_start"),
        (eid % 6).cast("int").alias("cost_center_id"),
        (4 + eid % 9).cast("int").alias("span_hours"),
        F.when(eid % 41 == 0, "1").otherwise("0").alias("deleted"),
        F.when(eid % 37 == 0, "false").otherwise("true").alias("published"),
        F.when(eid % 43 == 0, "Swap").otherwise("Regular").alias("seat_type"),
        (eid % 2).cast("int").alias("position_slot"),
        (eid % 4).cast("int").alias("earning_code_id"),
    )
    base = base.withColumn("shift_end", add_hours("shift_start", F.col("span_hours"))) \
        .withColumn("date_line", F.col("shift_start").cast("date")) \
        .withColumn("unit_name", F.concat(F.lit("Unit "), F.col("unit_id").cast("string")))
    return live_seats(base.join(cost_centers(spark, root), ["cost_center_id", "source_database"], "left"))


def punches(spark: SparkSession, root: str) -> DataFrame:
    """timesheet punches from ``click``/``view`` events, epoch seconds, 0 = still open."""
    e = load_table(spark, root, "events", ["event_id", "ts", "user_id", "event_type", "value"]) \
        .where(F.col("event_type").isin("click", "view"))
    eid = F.col("event_id")
    start = epoch_seconds("ts")
    return e.select(
        eid.alias("time_id"), F.col("user_id").alias("time_user_id"),
        (eid + 1).alias("shift_assignment_id"),
        start.alias("time_start_ts"),
        F.when(eid % 17 == 0, F.lit(0).cast("bigint"))
         .otherwise(start + F.round(F.col("value") * 60).cast("bigint")).alias("time_end_ts"),
        source_tag(F.col("user_id")).alias("source_database"),
        F.col("ts").alias("date_created"))


def history_log(spark: SparkSession, root: str) -> DataFrame:
    """status-change log from ``error`` events; the leg id comes from the JSON payload."""
    e = load_table(spark, root, "events", ["event_id", "user_id", "event_type", "props", "ts"]) \
        .where(F.col("event_type") == "error")
    return e.select(
        F.col("event_id").alias("id"), source_tag(F.col("user_id")).alias("source_database"),
        F.get_json_object("props", "$.k").cast("bigint").alias("leg_id"),
        F.lit("canceled_time").alias("field"),
        F.col("user_id"), F.col("ts").alias("changed_at"))


def periods(spark: SparkSession, dates: DataFrame, date_col: str,
            anchor: dt.date = PERIOD_ANCHOR_EVENTS) -> DataFrame:
    """14-day Sunday-start pay periods that cover all dates in ``dates``, in step with
    ``anchor`` (period 1; periods before it have numbers from 0 down).

    The date range is one aggregate over the data; the period list it expands to is
    bounded by the calendar span (26 rows a year), not by the row count."""
    d = F.col(date_col).cast("date")
    bounds = dates.agg(F.min(d).alias("lo"), F.max(d).alias("hi"))
    steps = (F.floor(F.datediff("lo", F.lit(anchor)) / 14) * 14).cast("int")
    first = F.least(F.lit(anchor), F.date_add(F.lit(anchor), steps))
    seq = F.when(F.col("hi") >= first, F.sequence(first, F.col("hi"), F.expr("INTERVAL 14 DAYS")))
    p = bounds.select(F.explode(seq).alias("start_date"))
    return p.select(
        F.year("start_date").alias("pay_period_year"),
        (F.floor(F.datediff("start_date", F.lit(anchor)) / 14) + 1).cast("int").alias("pay_period_number"),
        "start_date", F.date_add("start_date", 13).alias("end_date"))


def users(spark: SparkSession, root: str) -> DataFrame:
    """user dimension from customer x nation x region."""
    c = load_table(spark, root, "customer")
    reg = customer_regions(spark, root)
    return c.join(reg, "c_custkey", "left").select(
        F.col("c_custkey").alias("user_id"),
        source_tag(F.col("c_custkey")).alias("source_database"),
        F.col("c_name").alias("username"),
        F.split("c_name", "#").getItem(0).alias("last_name"),
        F.split("c_name", "#").getItem(1).alias("first_name"),
        F.col("c_mktsegment").alias("job_title"),
        F.col("n_name").alias("state"), "market",
        F.when(F.col("c_acctbal") < 0, F.lit("1")).otherwise(F.lit("0")).alias("disabled"),
        F.when(F.col("c_custkey") % 50 == 0, 1).otherwise(0).alias("deactivated"),
        F.round(F.abs(F.col("c_acctbal")) / 100.0, 2).alias("hourly_wage"))


def _legs_of(spark: SparkSession, root: str) -> DataFrame:
    """leg id, number of its source, day."""
    o = load_table(spark, root, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    return o.select(F.col("o_orderkey").alias("leg_id"), (F.col("o_custkey") % 3).alias("_k"), F.col("o_orderdate").cast("date").alias("seat_day"))


def crew_link_rows(spark: SparkSession, root: str) -> DataFrame:
    """distinct (leg, supplier) pairs with the number of the leg's source and its day. Lines are dealt by leg, for the distinct and the join alike."""
    li = load_table(spark, root, "lineitem", ["l_orderkey", "l_suppkey"]).repartition(parts_of(spark, root, "lineitem"), "l_orderkey").distinct()
    legs = _legs_of(spark, root)
    return li.join(legs, li.l_orderkey == legs.leg_id).select("leg_id", "l_suppkey", "_k", "seat_day")


def crew_link_columns(rows: DataFrame) -> DataFrame:
    day = F.datediff("seat_day", F.lit(PERIOD_ANCHOR_ORDERS))
    return rows.select("leg_id", source_tag(F.col("_k")).alias("source_database"), (F.col("l_suppkey") * 3 + F.col("_k")).alias("crew_user_id"), "seat_day",
                       (F.col("l_suppkey") * 100000 + day).alias("shift_assignment_id"))


def crew_link(spark: SparkSession, root: str) -> DataFrame:
    """leg-shift link: distinct (leg, crew member) pairs with the day they served. A leg's crew comes from the leg's own source; the crew seat
    id numbers (supplier, day), so the same ids stand for other seats in other sources."""
    return crew_link_columns(crew_link_rows(spark, root))


def crew_shifts(spark: SparkSession, root: str, link: DataFrame | None = None) -> DataFrame:
    """crew seats: one 12-hour day seat (06:00-18:00) per source, crew member and service day. Links are dealt by crew member, so a join
    with users finds the seats in place."""
    link = (link if link is not None else crew_link(spark, root)) \
        .select("source_database", "crew_user_id", "shift_assignment_id", "seat_day") \
        .repartition(parts_of(spark, root, "lineitem"), "crew_user_id", "source_database").distinct()
    date_line = F.col("seat_day")
    start = add_hours(date_line.cast("timestamp_ntz"), F.lit(6))
    s = F.col("crew_user_id")
    return link.select(
        F.col("shift_assignment_id").alias("assignment_id"), s.alias("user_id"),
        "source_database", date_line.alias("date_line"),
        start.alias("shift_start"), add_hours(start, F.lit(12)).alias("shift_end"),
        F.concat(F.lit("Unit "), F.floor(s / 15).cast("bigint").cast("string")).alias("unit_name"),
        (F.floor(s / 3) % 6).cast("int").alias("cost_center_id"))


def _lines(spark: SparkSession, root: str, columns: list[str]) -> DataFrame:
    li = load_table(spark, root, "lineitem", ["l_orderkey", "l_linenumber", *columns])
    legs = _legs_of(spark, root)
    return li.join(legs, li.l_orderkey == legs.leg_id).withColumns({"attachment_id": F.col("l_orderkey") * 100000 + F.col("l_linenumber"), "source_database": source_tag(F.col("_k"))})


def attachment_events(spark: SparkSession, root: str) -> DataFrame:
    """attachment log: each line item is an event; returned ones create an attachment, the others view or delete one. Uploaded by the crew member."""
    li = _lines(spark, root, ["l_suppkey", "l_returnflag", "l_shipdate"])
    action = F.when(F.col("l_returnflag") == "R", "create").when(F.col("l_returnflag") == "A", "delete").otherwise("view")
    return li.select(F.col("attachment_id").alias("log_id"), "attachment_id", (F.col("l_suppkey") * 3 + F.col("_k")).alias("uploader_id"), action.alias("action"),
                     F.col("l_shipdate").alias("uploaded_at"), "source_database")


def attachments(spark: SparkSession, root: str) -> DataFrame:
    """attachments: files of the first six lines of a leg."""
    li = _lines(spark, root, ["l_shipdate"]).where("l_linenumber <= 6")
    return li.select("attachment_id", F.concat(F.lit("file-"), F.col("attachment_id").cast("string"), F.lit(".pdf")).alias("file_name"), F.col("l_shipdate").alias("attachment_date"), "source_database")


def leg_attachments(spark: SparkSession, root: str) -> DataFrame:
    """links from attachments to legs: those of more than one piece."""
    li = _lines(spark, root, ["l_quantity"]).where("l_quantity > 1")
    return li.select((F.col("attachment_id") * 2).alias("leg_attachment_id"), "leg_id", "attachment_id", "source_database")


def attachment_types(spark: SparkSession, root: str) -> DataFrame:
    """types tagged on each leg-attachment link: the part types of its finished lines."""
    li = _lines(spark, root, ["l_partkey", "l_linestatus"]).where(F.col("l_linestatus") == "F")
    p = load_table(spark, root, "part", ["p_partkey", "p_type"])
    return li.join(p, li.l_partkey == p.p_partkey, "left").select(
        (F.col("attachment_id") * 2).alias("leg_attachment_id"), "source_database", F.col("p_type").alias("type_name"))


def finalizations(spark: SparkSession, root: str) -> DataFrame:
    """care records that name a run by its number as text: one for each leg, a second one for every third, finalized or not."""
    legs = load_table(spark, root, "orders", ["o_orderkey", "o_custkey"])
    key, k = F.col("o_orderkey"), F.col("o_custkey") % 3
    first = legs.select((key * 2).alias("id"), key.cast("string").alias("run_number"), source_tag(F.col("o_custkey")).alias("source_database"),
                        ((F.col("o_custkey") % 100) * 3 + k).alias("finalizer_id"), F.when(key % 4 != 0, 1).alias("finalized"))
    again = legs.where(key % 3 == 0).select((key * 2 + 1).alias("id"), key.cast("string").alias("run_number"), source_tag(F.col("o_custkey")).alias("source_database"),
                                            F.when(key % 5 != 0, (key % 10) * 3 + k).alias("finalizer_id"), (key % 2).cast("int").alias("finalized"))
    return first.unionByName(again)


def event_delta(spark: SparkSession, root: str, base: bool) -> DataFrame:
    """Base load (ts < 2024-01-25) or delta load (ts >= 2024-01-24, changed value)."""
    e = load_table(spark, root, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    if base:
        return e.where(F.col("ts") < ntz_lit(dt.datetime(2024, 1, 25)))
    return e.where(F.col("ts") >= ntz_lit(dt.datetime(2024, 1, 24))) \
        .withColumn("value", F.round(F.col("value") + 1.0, 2))


def qa_runs(spark: SparkSession, root: str) -> DataFrame:
    """patient-care records from documents, QA status from labels."""
    d = load_table(spark, root, "documents", ["doc_id", "source", "lang", "n_chars"])
    lab = load_table(spark, root, "labels", ["doc_id", "quality", "toxic"])
    return d.join(lab, "doc_id", "left")


def care_records(spark: SparkSession, root: str) -> DataFrame:
    """patient-care records: finalized when the text length is even; the lead crew
    member (record creator) is a user of the record's source."""
    d = load_table(spark, root, "documents", ["doc_id", "n_chars"])
    i = F.col("doc_id")
    return d.select(i.alias("run_id"), (i + 1000).alias("run_num"), source_tag(i).alias("source_database"),
                    (F.col("n_chars") % 2 == 0).cast("int").alias("finalized"),
                    F.when(F.col("n_chars") % 2 == 0, F.date_add(F.lit(dt.date(2024, 1, 1)), (i % 60).cast("int"))).alias("finalized_date"),
                    ((i % 150) * 3 + i % 3).alias("create_user"))


def record_legs(spark: SparkSession, root: str) -> DataFrame:
    """which leg a care record is of: the leg of the same number, in the record's source."""
    d = load_table(spark, root, "documents", ["doc_id"])
    return d.select(F.col("doc_id").alias("leg_id"), F.col("doc_id").alias("run_id"), source_tag(F.col("doc_id")).alias("source_database"))


def patients(spark: SparkSession, root: str) -> DataFrame:
    """patients: customers with a day of birth."""
    c = load_table(spark, root, "customer", ["c_custkey", "c_name"])
    name = F.split("c_name", "#")
    return c.select(F.col("c_custkey").alias("patient_id"), source_tag(F.col("c_custkey")).alias("source_database"),
                    F.concat(name.getItem(0), F.lit(", "), name.getItem(1)).alias("patient_name"), F.date_add(F.lit(dt.date(1940, 1, 1)), (F.col("c_custkey") % 20000).cast("int")).alias("dob"))


def export_log(spark: SparkSession, root: str) -> DataFrame:
    """export trigger log: a labelled record was exported; quality 0 logged an error."""
    lab = load_table(spark, root, "labels", ["doc_id", "quality"])
    return lab.select(F.col("doc_id").alias("run_id"), source_tag(F.col("doc_id")).alias("source_database"),
                      F.when(F.col("quality") == 0, F.lit("validation failed")).alias("errors"))


def qa_statuses(spark: SparkSession, root: str) -> DataFrame:
    """QA review status: toxic-labelled records are flagged by a reviewer."""
    lab = load_table(spark, root, "labels", ["doc_id", "toxic"]).where(F.col("toxic") == 1)
    i = F.col("doc_id")
    return lab.select(i.alias("run_id"), source_tag(i).alias("source_database"), F.lit("Flagged").alias("status_name"),
                      F.date_add(F.lit(dt.date(2024, 2, 1)), (i % 30).cast("int")).alias("qa_date"), ((i % 100) * 3 + i % 3).alias("set_by_user"))
