"""Audit operators: cancel audit with last actor, attachment log, attachment compliance,
QA/export reconciliation, QA status, contract pay list, user dimension (BO-40..46)."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.functions.scalars import concat_skip_null, hours_between, last_first, month_start, truthy, week_start_monday
from fieldlens.operators.keys import distinct_on, latest_by

# ---------------------------------------------------------------------------
# Fixed values of the fixture (names in the driver tables).
ATTACHMENT_REQUIRED_CALL_TYPES = ["ALS", "BLS", "CCT"]
EXEMPT_REASONS = ["Dialysis", "Doctors Appointment"]
EXEMPT_SOURCE = "%Vet Ride%"
QA_STATUS_NAMES = [(1, "Reviewed"), (2, "Approved")]
PAY_SOURCES = ["src0", "src1"]
# ---------------------------------------------------------------------------


def cancel_audit(runs: DataFrame, log: DataFrame, users: DataFrame, reasons: DataFrame, field: str = "canceled_time") -> DataFrame:
    """Cancelled or turned runs (status < 0) that are not deleted, with the name of their reason and the last user who set
    ``field`` (BO-40, JN-18, WN-1). The log is cut to its latest row per source and leg (a top-1
    window, pruned before the shuffle) and left-joined; the actor's name is
    ``CONCAT(last, ', ', first)`` with PostgreSQL's NULL-skipping CONCAT. Legs, users and reasons are known by source and id."""
    key = ["leg_id", "source_database"]
    last = latest_by(log.where(F.col("field") == field), key, "id").select(*key, F.col("id").alias("last_change_id"), F.col("user_id").alias("canceled_by_user_id"))
    names = users.select(F.col("user_id").alias("canceled_by_user_id"), "source_database", "last_name", "first_name")
    c = runs.where((F.col("last_status_id") < 0) & (F.col("deleted") == 0))
    j = c.join(last, key, "left").join(names, ["canceled_by_user_id", "source_database"], "left").join(reasons, ["canceled_reason_id", "source_database"], "left")
    return j.withColumn("canceled_by", concat_skip_null("last_name", F.lit(", "), "first_name")).drop("last_name", "first_name")


def link_types(types: DataFrame, link: str = "leg_attachment_id") -> DataFrame:
    """The sorted distinct types of each link (``STRING_AGG(DISTINCT name ORDER BY name)``, AG-8): as long as the type domain."""
    return types.groupBy("source_database", link).agg(F.array_join(F.array_sort(F.collect_set("type_name")), ", ").alias("attachment_types"))


def attachment_log(events: DataFrame, attachments: DataFrame, links: DataFrame, types: DataFrame, action: str = "create", default: str = "Unspecified") -> DataFrame:
    """Attachment log (BO-41): the ``action`` events of the log whose attachment is there and linked to a leg, one row per link, with the
    link's types (``default`` when it has none). All four tables are known by source and id."""
    made = events.where(F.col("action") == action)
    by_file = ["attachment_id", "source_database"]
    out = made.join(attachments, by_file).join(links, by_file).join(link_types(types), ["source_database", "leg_attachment_id"], "left")
    return out.withColumn("attachment_types", F.coalesce(F.nullif(F.col("attachment_types"), F.lit("")), F.lit(default)))


def exempt(required_types: Sequence[str] = ATTACHMENT_REQUIRED_CALL_TYPES, reasons: Sequence[str] = EXEMPT_REASONS, source_pattern: str = EXEMPT_SOURCE) -> F.Column:
    """Runs that need no attachment: by reason for transport, by the facility's name, or by a call type that is none of ``required_types``. A value that is
    missing exempts nobody (Q-15)."""
    rules = [F.col("reason_for_transport").isin(*reasons), F.col("source_name").like(source_pattern), ~F.col("calltype_name").isin(*required_types)]
    return functools.reduce(operator.or_, [F.coalesce(r, F.lit(False)) for r in rules])


def compliance(runs: DataFrame, crew: DataFrame, log: DataFrame, records: DataFrame, users: DataFrame) -> DataFrame:
    """Attachment compliance (BO-42): one row per attributed crew member per ran leg.
    ``log``: the attachment log; ``records``: care records (id, text ``run_number``, finalizer_id, finalized).

    Of the care records of a run number the finalized one counts, then the newest. A leg is compliant when it is exempt or any
    crew member uploaded an attachment (team effort). Attribution: only the finalizer when they
    were crew; every crew member when the finalizer was not crew or there is none. Crew is distinct per leg (Q-14 corrected).

    Uploads, the finalizer and whether they are crew are brought to one row per leg first; everything is keyed by source and leg, so the
    joins share one exchange key."""
    key = ["source_database", "leg_id"]
    legs = runs.where(F.col("run_outcome") == "ran")
    crew = crew.select(*key, "crew_user_id").distinct()
    is_crew = crew.select(*key, F.col("crew_user_id").alias("uploader_id"), F.lit(True).alias("_is_crew"))
    summary = log.join(is_crew, [*key, "uploader_id"], "left").groupBy(*key).agg(
        F.count(F.lit(1)).alias("total_attachments"),
        F.count_if(F.coalesce("_is_crew", F.lit(False))).alias("crew_attachments"),
        F.array_join(F.array_sort(F.collect_set("attachment_types")), "; ").alias("all_attachment_types"),
        F.min("uploaded_at").alias("first_attachment_time"))
    record = distinct_on(records.where(F.col("run_number").isNotNull()), ["source_database", "run_number"], [("finalized", "desc_nulls_last"), ("id", "desc")])
    # the care-record side keys runs by a text run number: join with a cast key (JN-17)
    final = record.select("source_database", F.col("run_number").alias("_rn"), "finalizer_id", "finalized")
    leg = legs.withColumn("_rn", F.col("run_number").cast("string")).join(final, ["source_database", "_rn"], "left").drop("_rn")
    own = crew.select(*key, F.col("crew_user_id").alias("finalizer_id"), F.lit(True).alias("_final"))
    leg = leg.join(summary, key, "left").join(own, [*key, "finalizer_id"], "left").withColumns({
        "finalizer_is_crew_member": F.coalesce("_final", F.lit(False)),
        "total_attachments": F.coalesce("total_attachments", F.lit(0)),
        "crew_attachments": F.coalesce("crew_attachments", F.lit(0)),
        "requires_attachment": ~exempt(),
        "is_compliant": exempt() | F.coalesce(F.col("crew_attachments") > 0, F.lit(False)),
    }).withColumn("has_crew_attachment", F.col("crew_attachments") > 0)
    names = users.select(F.col("user_id").alias("crew_user_id"), "source_database", concat_skip_null("last_name", F.lit(", "), "first_name").alias("crew_member_name"))
    rows = crew.join(leg, key).where((F.col("crew_user_id") == F.col("finalizer_id")) | ~F.col("finalizer_is_crew_member") | F.col("finalizer_id").isNull())
    return rows.join(names, ["crew_user_id", "source_database"], "left").select(
        F.col("crew_user_id").alias("user_id"), "crew_member_name", "run_number", "leg_id", "source_database", "region", "service_date",
        week_start_monday("service_date").alias("week_start"), month_start("service_date").alias("month_start"), "calltype_name", "source_name", "reason_for_transport",
        "finalizer_id", "finalized", "finalizer_is_crew_member",
        F.coalesce(F.col("crew_user_id") == F.col("finalizer_id"), F.lit(False)).alias("is_finalizer"),
        "total_attachments", "crew_attachments", "all_attachment_types", "first_attachment_time", "has_crew_attachment", "requires_attachment", "is_compliant")


def qa_recon(legs: DataFrame, record_legs: DataFrame, records: DataFrame, export_log: DataFrame, qa: DataFrame, users: DataFrame, patients: DataFrame) -> DataFrame:
    """QA/export reconciliation (BO-43, JN-19), from the legs on: a leg's care record, its patient and call type, review and export.
    Legs without a record stay as one row per day, patient and type with a NULL run id.

    Export status: Exported (log row, no errors), Failed (log row with errors), Not
    Exported (no log row). The QA status falls back to Submitted / Not Finalized. The
    user dimension is joined twice, as reviewer and as lead crew member. Everything is known by source and id."""
    src = "source_database"
    names = users.select("user_id", src, last_first("last_name", "first_name").alias("_name"))
    reviewer = names.select(F.col("user_id").alias("set_by_user"), src, F.col("_name").alias("reviewer_name"))
    lead = names.select(F.col("user_id").alias("create_user"), src, F.col("_name").alias("crew_name"))
    j = (legs.join(record_legs, ["leg_id", src], "left").join(records, ["run_id", src], "left")
         .join(qa, ["run_id", src], "left").join(export_log.withColumn("_logged", F.lit(True)), ["run_id", src], "left")
         .join(reviewer, ["set_by_user", src], "left").join(lead, ["create_user", src], "left").join(patients, ["patient_id", src], "left"))
    fin = F.col("finalized") == 1
    out = j.select(
        F.when(F.col("run_num").isNotNull(), F.col("run_id")).alias("run_id"), "run_num", F.col("service_date").alias("date_of_service"), "patient_name", "dob",
        F.concat("calltype_name", F.lit(" "), "level_of_service").alias("calltype"),
        F.when(fin, "Yes").otherwise("No").alias("finalized"), "finalized_date",
        F.coalesce(F.col("status_name"), F.when(fin, "Submitted").otherwise("Not Finalized")).alias("status_name"),
        "qa_date", "reviewer_name", "crew_name",
        F.when(F.col("_logged") & F.col("errors").isNull(), "Exported")
         .when(F.col("_logged") & F.col("errors").isNotNull(), "Failed")
         .when(F.col("_logged").isNull(), "Not Exported").alias("exported"),
        "errors", src)
    return out.distinct()


def qa_status(records: DataFrame, statuses: DataFrame) -> DataFrame:
    """Active QA status per record (BO-44, JN-4): the status join carries the
    ``removed = 0`` condition in its ON clause, so records without an active status
    stay, with NULL status."""
    st = records.where(F.col("quality").isNotNull()).select(
        F.col("doc_id").alias("run_id"), (F.col("quality") + 1).cast("int").alias("status_id"),
        F.col("toxic").alias("removed"))
    s = st.join(F.broadcast(statuses), "status_id", "left")
    r = records.select(F.col("doc_id").alias("run_id"), "source")
    j = r.join(s, (r.run_id == s.run_id) & (s.removed == 0), "left")
    return j.select(r.run_id, r.source, s.status_id, s.status_name)


def pay_list(runs: DataFrame, link: DataFrame, users: DataFrame, sources: Sequence[str] = PAY_SOURCES) -> DataFrame:
    """Contract pay list (BO-45): every crew member of every run of the selected sources that
    was not cancelled out (status >= -1), with the hours on task and the member's wage; a run
    without crew keeps one row. On the current revision only (Q-16 corrected)."""
    r = runs.where(F.col("source_database").isin(*sources) & (F.col("last_status_id") >= -1)).select(
        "leg_id", "run_number", F.col("service_date").alias("leg_date"), "clear_time", "assigned_time",
        hours_between("clear_time", "assigned_time").alias("time_on_task_hours"), "source_database")
    crew = link.select("leg_id", "source_database", "crew_user_id").distinct()
    u = users.select(F.col("user_id").alias("crew_user_id"), "source_database",
                     concat_skip_null("first_name", F.lit(" "), "last_name").alias("crew_name"), "hourly_wage")
    out = r.join(crew, ["leg_id", "source_database"], "left").join(u, ["crew_user_id", "source_database"], "left")
    return out.withColumn("pay_amount", F.col("time_on_task_hours") * F.col("hourly_wage")) \
        .drop("leg_id").distinct()


def user_dim(users: DataFrame) -> DataFrame:
    """User dimension (BO-46): surrogate key, names only when both parts are present,
    disabled/deactivated/active flags over mixed boolean encodings (SC-25)."""
    both = F.col("first_name").isNotNull() & F.col("last_name").isNotNull()
    disabled_txt = F.lower(F.trim(F.col("disabled").cast("string")))
    return users.select(
        "user_id", "source_database",
        F.concat(F.col("user_id").cast("string"), F.lit("_"), F.col("source_database")).alias("surrogate_key"),
        F.when(both, F.concat("first_name", F.lit(" "), "last_name")).alias("full_name"),
        F.when(both, last_first("last_name", "first_name")).alias("display_name"),
        "job_title", "state",
        truthy("disabled").alias("is_disabled"),
        F.coalesce(F.col("deactivated") == 1, F.lit(False)).alias("is_deactivated"),
        F.coalesce((disabled_txt.isin("0", "false") | F.col("disabled").isNull()) & (F.col("deactivated") == 0),
                   F.lit(False)).alias("is_active"))
