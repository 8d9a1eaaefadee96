"""Queries move what they read: staging that one place reads is not written, and
windows and keys that nobody reads are not computed."""

import pytest

from conftest import SF_SMALL
from vaultline.operators.checks import Check, table_report
from vaultline.plans import quality
from vaultline.plans.registry import MODEL_KEYS, registry
from vaultline.plans.warehouse import MODEL_DEPS, Warehouse, read_once, reads_rescheduled
from vaultline.session import scratch_path


def written(monkeypatch):
    seen, write = {}, Warehouse._materialized

    def kept(self, df, name="order_facts"):
        seen[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(self, df, name)

    monkeypatch.setattr(Warehouse, "_materialized", kept)
    return seen


def same(a, b):
    return a.exceptAll(b).count() == 0 == b.exceptAll(a).count()


def test_read_once_follows_the_model_graph():
    assert read_once("dim_date") == {"stg_appointments", "stg_exams"}
    assert read_once("lnk_appointment") == {"stg_appointments", "order_facts"}
    assert read_once("fact_appointment") == {"stg_exams"}
    assert not read_once("stg_payments") and not read_once("lnk_appointment", "hub_appointment")
    assert reads_rescheduled("int_appointments_with_insurance") and not reads_rescheduled("dim_date")


@pytest.mark.parametrize("query", ["dim_date", "dq_accepted_values", "audit_selfpay", "ref_values", "audit_orphans"])
def test_lookups_read_in_one_place_are_not_written(spark, monkeypatch, query):
    seen = written(monkeypatch)
    registry()[query](spark, SF_SMALL).collect()
    assert "order_facts" in seen and not {"stg_appointments", "stg_exams"} & set(seen)


def test_no_window_without_the_rescheduled_link(spark, monkeypatch):
    seen = written(monkeypatch)
    registry()["dq_relationships"](spark, SF_SMALL).collect()
    assert "Window" not in seen["stg_appointments"]


def test_models_read_once_have_the_same_rows(spark):
    plain = Warehouse(spark, SF_SMALL)
    names = [m for k, m in MODEL_KEYS.items() if k in (
        "stg_exam", "lnk_appointment", "lnk_exam", "int_exam_insured", "dim_date", "hub_exam", "fact_exam")]
    for key, model in MODEL_KEYS.items():
        if model in names:
            assert same(registry()[key](spark, SF_SMALL), plain.model(model)), key
    for audit in (quality.audit_selfpay, quality.audit_orphans, quality.ref_values):
        assert same(audit(spark, SF_SMALL), audit(spark, SF_SMALL, plain))


def test_lookups_carry_business_keys(spark):
    wh = Warehouse(spark, SF_SMALL)
    wh.prepare("stg_appointments", "stg_exams")
    for model in ("stg_appointments", "stg_exams"):
        kept = scratch_path(spark, "tables", wh.run_id, model)
        assert not [c for c in spark.read.parquet(kept).columns if c.endswith("_hk")]


@pytest.mark.parametrize("query", ["lnk_appointment", "lnk_exam"])
def test_link_keys_are_derived_after_the_shuffle(spark, query):
    plan = registry()[query](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any("Exchange hashpartitioning(lnk_" in line for line in plan.splitlines())


def test_encounters_are_joined_by_id(spark):
    """Over derived links; over given ones, which have hash keys only, the result is the same."""
    wh, given = Warehouse(spark, SF_SMALL), Warehouse(spark, SF_SMALL)
    for name in MODEL_DEPS["bridge_encounter"]:
        given.overrides[name] = wh.model(name)
    for name in ("bridge_encounter", "fact_appointment"):
        assert same(wh.model(name), given.model(name))
    plan = wh.model("bridge_encounter")._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line]
    assert len(joins) == 5 and not any("unhex" in line for line in joins)
    keys = wh.model("stg_appointments").schema["appointment_id"].dataType.simpleString()
    assert keys == "bigint" and dict(wh._encounters(False).dtypes)["appointment_hk"] == "bigint"


@pytest.mark.parametrize("kind", ["string", "int"])
def test_relationships_of_keys_and_other_values(spark, kind):
    keys = ["ab" * 32, "AB" * 32, "", " x", None] if kind == "string" else [1, 2, 3, 4, None]
    child = spark.createDataFrame([(k,) for k in keys * 2], f"k {kind}")
    parent = spark.createDataFrame([(keys[0],), (keys[0],), (keys[3],), (None,)], f"p {kind}")
    check = Check("c", "k", "relationships", to_model="d", to_field="p")
    report = table_report(child, [check], {"d": parent}.__getitem__)
    assert [r.failures for r in report.collect()] == [4]
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert ("unhex" in plan) == (kind == "string")
