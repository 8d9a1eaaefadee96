"""Key and hashdiff conventions (hand-written cases)."""

import hashlib

from pyspark.sql import functions as F

from vaultline.functions.keys import (
    digits_key,
    hash_key,
    hashdiff,
    link_key,
    optional_link_key,
    prefixed_key,
    raw_link_key,
    typed_reference_key,
)


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_digits_key_normalises_formatting(spark):
    got = one(spark, [("123.456.789-01",), ("12345678901",), (None,)], "c string", digits_key("c"))
    assert got[0] == got[1] == sha("12345678901")
    assert got[2] is None


def test_hash_key_upper_trim(spark):
    got = one(spark, [(" ab ",), ("AB",)], "c string", hash_key("c"))
    assert got[0] == got[1] == sha("AB")


def test_prefixed_keys_separate_id_spaces(spark):
    df = spark.createDataFrame([(5, "EXAM")], "id long, t string")
    r = df.select(
        prefixed_key("APPOINTMENT", "id").alias("a"),
        prefixed_key("EXAM", "id").alias("e"),
        typed_reference_key("t", "id").alias("ref"),
    ).first()
    assert r.a != r.e
    assert r.e == r.ref == sha("EXAM-5")


def test_prefixed_key_of_null_is_null(spark):
    assert one(spark, [(None,)], "id long", prefixed_key("APPOINTMENT", "id")) == [None]


def test_link_keys(spark):
    df = spark.createDataFrame([("a", "b", None)], "x string, y string, z string")
    r = df.select(link_key("x", "y").alias("l"), optional_link_key("z", "x", "z").alias("o"),
                  raw_link_key(F.lit(7), "x", "y").alias("raw")).first()
    assert r.l == sha("a-b")
    assert r.o is None
    assert r.raw == sha("7-A-B")


def test_hashdiff_null_equals_empty_and_is_case_sensitive(spark):
    df = spark.createDataFrame([(None, "a"), ("", "a"), ("", "A")], "p string, q string")
    got = [r[0] for r in df.select(hashdiff(["p", "q"])).collect()]
    assert got[0] == got[1] == sha("||a")
    assert got[2] != got[1]


def test_hashdiff_narrow_feed_keeps_positions(spark):
    df = spark.createDataFrame([("n", "x")], "name string, city string")
    got = df.select(hashdiff(["name", None, "city"])).first()[0]
    assert got == sha("n||||x")
