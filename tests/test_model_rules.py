"""Survivorship, bridge, reschedule id parsing, feeds, checks, sequence."""

import datetime as dt
import os
import random

from pyspark.sql import Observation
from pyspark.sql import functions as F

from vaultline.constants import SOURCE_CLINIC
from vaultline.operators.checks import Check, from_watched, run_checks, watched
from vaultline.operators.sequence import next_value, previous_value
from vaultline.operators.survive import source_rank, survive
from vaultline.sources.feeds import scan_feed, scan_union_extracts

T = dt.datetime


def test_survivorship_prefers_clinic_even_when_older(spark):
    df = spark.createDataFrame(
        [("p1", "clinic", SOURCE_CLINIC, T(2024, 1, 1)), ("p1", "partner", "partner_clinic", T(2024, 2, 1)),
         ("p2", "partner-only", "partner_clinic", T(2024, 2, 1))],
        "hk string, name string, record_source string, load_date timestamp_ntz")
    got = {r.hk: r.name for r in survive(
        df, "hk", [source_rank("record_source", [SOURCE_CLINIC]), F.col("load_date").desc()]).collect()}
    assert got == {"p1": "clinic", "p2": "partner-only"}


def test_bridge_exam_payment_attaches_only_to_its_exam(spark, monkeypatch):
    from vaultline.plans.warehouse import Warehouse

    wh = Warehouse(spark, "/nonexistent")
    s = "string"
    wh.overrides = {
        "lnk_appointment": spark.createDataFrame(
            [("a1", "p", "pr", "f", "s"), ("a2", "p", "pr", "f", "s")],
            f"appointment_hk {s}, patient_hk {s}, practitioner_hk {s}, facility_hk {s}, specialty_hk {s}"),
        "lnk_appointment_insurance": spark.createDataFrame([], f"appointment_hk {s}, insurance_provider_hk {s}"),
        "lnk_exam": spark.createDataFrame([("e1", "a1", "t")], f"exam_hk {s}, source_appointment_hk {s}, exam_type_hk {s}"),
        "lnk_payment_appointment": spark.createDataFrame([("pay-a2", "a2")], f"payment_hk {s}, reference_hk {s}"),
        "lnk_payment_exam": spark.createDataFrame([("pay-e1", "e1"), ("pay-x", "e-unknown")], f"payment_hk {s}, reference_hk {s}"),
        "lnk_feedback": spark.createDataFrame([], f"appointment_hk {s}, feedback_hk {s}"),
    }
    rows = {r.appointment_hk: r for r in wh.bridge_encounter.collect()}
    assert len(rows) == 2
    assert rows["a1"].exam_hk == "e1" and rows["a1"].exam_payment_hk == "pay-e1"
    assert rows["a1"].appointment_payment_hk is None and rows["a1"].appointment_insurance_provider_hk is None
    assert rows["a2"].exam_payment_hk is None and rows["a2"].appointment_payment_hk == "pay-a2"


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_csv_feed_keeps_codes_and_resolves_double_ids(spark, tmpdir_path):
    _write(os.path.join(tmpdir_path, "facilities", "facilities_2024-01-01.csv"),
           "facility_id,cnes_code,name,address,city,state,phone\n1,0123456,F1,,C,ST,0800\n")
    _write(os.path.join(tmpdir_path, "appointments", "appointments_2024-01-01.csv"),
           "appointment_id,rescheduled_from_id,patient_id,practitioner_id,specialty_id,facility_id,"
           "scheduled_at,visit_type,insurance_provider_id,current_status,created_at\n"
           "13,12.0,1,1,1,1,2024-01-05 09:00:00,SELF_PAY,,SCHEDULED,2024-01-01 08:00:00\n")
    fac = scan_feed(spark, tmpdir_path, "facilities").first()
    assert fac.cnes_code == "0123456"
    from vaultline.functions.keys import prefixed_key
    ap = scan_feed(spark, tmpdir_path, "appointments").select(
        prefixed_key("APPOINTMENT", F.col("rescheduled_from_id").cast("bigint")).alias("k"),
        "scheduled_at").first()
    expect = spark.range(1).select(prefixed_key("APPOINTMENT", F.lit(12).cast("bigint"))).first()[0]
    assert ap.k == expect
    assert ap.scheduled_at == T(2024, 1, 5, 9)


def test_dated_extracts_union_and_latest(spark, tmpdir_path):
    head = "specialty_id,name\n"
    _write(os.path.join(tmpdir_path, "specialties", "specialties_2024-01-01.csv"), head + "1,Old\n2,Two\n")
    _write(os.path.join(tmpdir_path, "specialties", "specialties_2024-01-02.csv"), head + "1,New\n")
    u = scan_union_extracts(spark, tmpdir_path, "specialties")
    assert u.count() == 3
    latest = {r.specialty_id: (r.name, r.extract_date) for r in
              scan_union_extracts(spark, tmpdir_path, "specialties", latest_by="specialty_id").collect()}
    assert latest == {1: ("New", dt.date(2024, 1, 2)), 2: ("Two", dt.date(2024, 1, 1))}


def test_checks_count_failures(spark):
    df = spark.createDataFrame([(1, "A"), (1, "B"), (2, None), (None, "Z")], "id int, v string")
    parent = spark.createDataFrame([("A",), ("B",)], "v string")
    checks = [Check("t", "id", "unique"), Check("t", "id", "not_null"),
              Check("t", "v", "accepted_values", ("A", "B")),
              Check("t", "v", "relationships", to_model="p", to_field="v")]
    tables = {"t": df, "p": parent}.__getitem__
    want = {("id", "unique"): 1, ("id", "not_null"): 1, ("v", "accepted_values"): 1, ("v", "relationships"): 1}
    got = {(r.column_name, r.test): r.failures for r in run_checks(spark, checks, tables).collect()}
    assert got == want
    # Counted while the rows are written, the row-wise tests need no second read.
    seen = Observation()
    df.observe(seen, *[c.alias(n) for n, c in watched(checks).items()]).write.format("noop").mode("overwrite").save()
    rows, rest = from_watched(checks, seen.get)
    assert [c.test for c in rest] == ["unique", "relationships"]
    assert {r[1:3]: r[3] for r in rows} == {k: n for k, n in want.items() if k[1] in ("not_null", "accepted_values")}


def test_a_table_that_fails_does_not_stop_the_others(spark):
    df = spark.createDataFrame([(1,), (1,)], "id int")
    broken = df.select(F.raise_error(F.lit("unreadable")).cast("int").alias("id"))
    checks = [Check("broken", "id", "unique"), Check("missing", "id", "not_null"), Check("t", "id", "unique")]
    got = [tuple(r) for r in run_checks(spark, checks, {"t": df, "broken": broken}.__getitem__).collect()]
    assert got == [("broken", "id", "unique", None), ("missing", "id", "not_null", None), ("t", "id", "unique", 1)]


def test_bucketed_neighbours_equal_plain(spark):
    rnd = random.Random(3)
    rows = [("k%d" % rnd.randrange(4), T(2024, 1, 1) + dt.timedelta(hours=rnd.randrange(24 * 9)), i, None if i % 11 == 0 else i)
            for i in range(400)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, id int, v int")
    for fn in (previous_value, next_value):
        plain = fn(df, ["k"], ["ts", "id"], "v", "n")
        buck = fn(df, ["k"], ["ts", "id"], "v", "n", bucket=F.to_date("ts"))
        a = sorted(tuple(r) for r in plain.select("id", "n").collect())
        b = sorted(tuple(r) for r in buck.select("id", "n").collect())
        assert a == b


def test_calendar_window_matches_source_definition(spark):
    from vaultline.operators.calendar import calendar_window

    anchor = spark.createDataFrame([(dt.date(1998, 12, 31),)], "d date")
    cal = calendar_window(anchor, "d")
    assert cal.count() == 1096
    r = cal.filter(F.col("date_day") == dt.date(1998, 12, 27)).first()
    assert (r.date_key, r.day_of_week, r.day_name, r.is_weekend, r.quarter, r.month_name) == (
        19981227, 1, "Sunday", True, 4, "December")


def test_audits_count_injected_violations(spark):
    from conftest import SF_SMALL
    from vaultline.plans import quality as Q
    from vaultline.plans.warehouse import Warehouse

    wh = Warehouse(spark, SF_SMALL)
    appts = wh.model("stg_appointments")
    pay = wh.model("stg_payments")
    insured = appts.filter("visit_type = 'INSURANCE'").select("appointment_hk").limit(1)
    bad_ref = pay.limit(1).drop("reference_hk").crossJoin(
        insured.withColumnRenamed("appointment_hk", "reference_hk")).select(*pay.columns)
    unpaid = pay.filter("payment_status = 'PAID'").limit(1).withColumn("paid_at", F.lit(None).cast("timestamp_ntz"))
    wh.overrides["stg_payments"] = pay.unionByName(bad_ref).unionByName(unpaid)
    fb = wh.model("stg_patient_feedback")
    open_appt = appts.filter("current_status <> 'COMPLETED'").select("appointment_hk").limit(1)
    wh.overrides["stg_patient_feedback"] = fb.unionByName(
        fb.limit(1).drop("appointment_hk").crossJoin(open_appt).select(*fb.columns))
    before = {r.audit: r.violations for r in Q.audit_selfpay(spark, SF_SMALL).collect()}
    after = {r.audit: r.violations for r in Q.audit_selfpay(spark, SF_SMALL, wh=wh).collect()}
    assert after["selfpay"] == before["selfpay"] + 1
    assert Q.audit_paid_at(spark, SF_SMALL, wh=wh).first().violations == 1
    assert Q.audit_feedback(spark, SF_SMALL, wh=wh).first().violations == 1


def test_malformed_extract_stops_the_load(spark, tmpdir_path):
    import pytest

    _write(os.path.join(tmpdir_path, "specialties", "specialties_2024-01-01.csv"),
           "specialty_id,name\n1,Fine\nnot-a-number,Broken\n")
    with pytest.raises(Exception, match="specialty_id is not an integer id: not-a-number"):
        scan_feed(spark, tmpdir_path, "specialties").collect()
    head = "exam_type_id,name,category,self_pay_price,tuss_code\n"
    _write(os.path.join(tmpdir_path, "exam_types", "exam_types_2024-01-01.csv"), head + "1,A,B,12.50,7\n2,A,B,cheap,7\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST|cannot|parse"):
        scan_feed(spark, tmpdir_path, "exam_types").collect()
    head = "exam_id,status,status_at\n"
    _write(os.path.join(tmpdir_path, "exam_status_history", "exam_status_history_2024-01-01.csv"),
           head + "1,SCHEDULED,2024-01-01 10:00:00\n2,SCHEDULED,yesterday\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST|cannot|parse"):
        scan_feed(spark, tmpdir_path, "exam_status_history").collect()
