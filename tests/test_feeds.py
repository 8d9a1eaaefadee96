"""CSV feeds bind by header, keep ids exact and round-trip quotes; staging and
builds write only what they need."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vaultline.operators.loaders import sat_rows
from vaultline.plans.warehouse import Warehouse
from vaultline.sources.feeds import FeedHeaderError, NewExtracts, scan_feed, scan_union_extracts, write_extract
from vaultline.sources.stored import StoredTable


def put(root, entity, text, day="2024-02-01"):
    folder = os.path.join(root, entity)
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, f"{entity}_{day}.csv"), "w", encoding="utf-8") as f:
        f.write(text)


def test_quoted_fields(spark, tmpdir_path):
    put(tmpdir_path, "specialties", 'specialty_id,name\n1,"a ""b"", c"\n2.0,plain\n')
    assert [tuple(r) for r in scan_feed(spark, tmpdir_path, "specialties").orderBy("specialty_id").collect()] == [
        (1, 'a "b", c'), (2, "plain")]
    out = tmpdir_path + "/again"
    write_extract(scan_feed(spark, tmpdir_path, "specialties"), out, "specialties", "2024-02-02")
    assert scan_feed(spark, out, "specialties").filter("specialty_id = 1").first().name == 'a "b", c'


@pytest.mark.parametrize("header", ["specialty_id", "specialty_id,title", "specialty_id,name,name"])
def test_headers_that_lack_or_repeat_a_column_stop_the_load(spark, tmpdir_path, header):
    row = ",".join("1" for _ in header.split(","))
    put(tmpdir_path, "specialties", f"{header}\n{row}\n")
    with pytest.raises(FeedHeaderError, match="specialties"):
        scan_feed(spark, tmpdir_path, "specialties")


def test_columns_are_bound_by_name(spark, tmpdir_path, caplog):
    """Every file in its own order, wider, in capitals, with a byte-order mark."""
    put(tmpdir_path, "specialties", "specialty_id,name\n1,one\n", "2024-02-01")
    put(tmpdir_path, "specialties", 'name,specialty_id\n"two, 2",2.0\n', "2024-02-02")
    put(tmpdir_path, "specialties", "note,Name,x,SPECIALTY_ID\nn,three,y,3\n,,,4\n", "2024-02-03")
    put(tmpdir_path, "specialties", "\ufeffspecialty_id,name\n5,five\n", "2024-02-04")
    put(tmpdir_path, "specialties", "", "2024-02-05")
    put(tmpdir_path, "specialties", "name,specialty_id\n", "2024-02-06")
    got = scan_union_extracts(spark, tmpdir_path, "specialties")
    assert sorted((r.specialty_id, r.name, str(r.extract_date)) for r in got.collect()) == [
        (1, "one", "2024-02-01"), (2, "two, 2", "2024-02-02"), (3, "three", "2024-02-03"), (4, None, "2024-02-03"),
        (5, "five", "2024-02-04")]
    assert got.columns == ["specialty_id", "name", "extract_date"]
    assert "['note', 'x']" in caplog.text
    assert "note" not in got._jdf.queryExecution().executedPlan().toString()  # extra columns are not parsed
    put(tmpdir_path, "exam_status_history", "status_at,exam_id,status\n2024-01-01 10:00:00,7,SCHEDULED\n2024-01-02T11:00:00,8.0,X\n")
    assert sorted(map(str, scan_feed(spark, tmpdir_path, "exam_status_history").select("exam_id", "status", F.col("status_at").cast("string")).collect())) == [
        "Row(exam_id=7, status='SCHEDULED', status_at='2024-01-01 10:00:00')", "Row(exam_id=8, status='X', status_at='2024-01-02 11:00:00')"]


def test_an_unchanged_folder_is_not_scanned_again(spark, tmpdir_path, monkeypatch):
    manifest = StoredTable(spark, tmpdir_path + "/manifest")
    run = lambda: NewExtracts(spark, tmpdir_path + "/land", "specialties", manifest)
    land = lambda text, day: put(tmpdir_path + "/land", "specialties", "specialty_id,name\n" + text, day)
    land("1,one\n", "2024-02-01")
    first = run()
    assert [tuple(r)[:2] for r in first.rows().collect()] == [(1, "one")]
    assert len(run().files) == 1  # not noted as read: a run that dies reads it again
    assert first.done() == 1
    with monkeypatch.context() as m:
        m.setattr("vaultline.sources.feeds._scan", lambda *a: pytest.fail("scanned"))
        again = run()
        assert again.files == [] and again.rows().collect() == [] and again.done() == 0
        assert again.rows().columns == ["specialty_id", "name", "extract_date"]
    land("2,two\n", "2024-02-02")
    land("1,one, again\n".replace(", ", " "), "2024-02-01")  # replaced
    second = run()
    assert sorted(r.name for r in second.rows().collect()) == ["one again", "two"]
    assert second.done() == 2 and run().files == []
    put(tmpdir_path + "/land", "facilities", "facility_id,cnes_code,name,address,city,state,phone\n1,01,F,,,,\n")
    other = NewExtracts(spark, tmpdir_path + "/land", "facilities", manifest)
    assert other.rows().first().cnes_code == "01" and other.done() == 1


def test_ids_above_double_precision(spark, tmpdir_path):
    put(tmpdir_path, "specialties", "specialty_id,name\n9007199254740993,x\n9223372036854775807.0,y\n,z\n")
    got = {r.name: r.specialty_id for r in scan_feed(spark, tmpdir_path, "specialties").collect()}
    assert got == {"x": 9007199254740993, "y": 9223372036854775807, "z": None}
    put(tmpdir_path + "/bad", "specialties", "specialty_id,name\n1.5,x\n")
    with pytest.raises(Exception):
        scan_feed(spark, tmpdir_path + "/bad", "specialties").collect()


def test_master_data_needs_no_order_base(spark, tmpdir_path):
    wh = Warehouse(spark, SF_SMALL)
    wh.prepare("dim_facility")
    assert "order_facts" not in wh.__dict__ and set(wh._staged) == {"stg_facilities"}
    # From CSV feeds the root needs no tables at all.
    base = Warehouse(spark, SF_SMALL, materialize=False)
    write_extract(base.feed("facilities"), tmpdir_path, "facilities", "2024-02-01")
    csv = Warehouse(spark, tmpdir_path + "/none", feed_source=lambda n: scan_feed(spark, tmpdir_path, n))
    csv.prepare("dim_facility")
    assert csv.model("dim_facility").count() == Warehouse(spark, SF_SMALL).model("dim_facility").count()


def test_methods_are_defined_once():
    import inspect
    import re

    import vaultline.plans.warehouse as w

    names = re.findall(r"^    def (\w+)", inspect.getsource(w.Warehouse), re.M)
    assert len(names) == len(set(names))


@pytest.mark.parametrize("bucket", [None, lambda c: F.to_date(c)])
def test_rerun_with_null_time_or_source_appends_nothing(spark, bucket):
    rows = spark.createDataFrame(
        [("a", "h1", None, "s"), ("a", "h2", "2024-01-01", "s"), ("a", "h2", "2024-01-02", None), ("b", "h1", "2024-01-03", None),
         ("a", "h1", "2024-01-02", "s")],
        "pk string, hd string, ldts string, src string").withColumn("ldts", F.col("ldts").cast("timestamp_ntz"))
    load = lambda new, old=None: sat_rows(new, "pk", "hd", [], ldts="ldts", source="src", existing=old, bucket=bucket)
    first = load(rows)
    assert first.count() == 5
    assert load(rows, first).count() == 0
    late = rows.limit(0).unionByName(spark.createDataFrame([("a", "h9", "2024-01-05", "s")], "pk string, hd string, ldts string, src string")
                                     .withColumn("ldts", F.col("ldts").cast("timestamp_ntz")))
    assert [r.hd for r in load(late, first).collect()] == ["h9"]
