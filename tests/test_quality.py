"""Expectation suites: one aggregation, GX-style result records."""

import pytest

from chorus.operators import quality as q
from chorus.plans import gate


def test_suite_results(spark):
    df = spark.createDataFrame(
        [(1, "a", "2024-01-01 10:00:00", 5.0, "12"),
         (2, None, "01/01/2024", -1.0, "x"),
         (3, "b", None, None, None)],
        "id int, s string, ts string, v double, t string")
    r = {(x.expectation, x.column): x for x in q.run_suite(df, "s", [
        q.not_null("s"), q.in_set("s", ["a"]),
        q.datetime_format("ts", "%Y-%m-%d %H:%M:%S"),
        q.between("v", 0, None), q.of_type("t", "int"),
        q.of_type("id", "int"), q.type_in_list("v", ["float", "int"])
    ]).collect()}
    nn = r[("expect_column_values_to_not_be_null", "s")]
    assert (nn.element_count, nn.unexpected_count, nn.success) == (3, 1, False)
    assert nn.unexpected_percent == pytest.approx(100 / 3)
    ins = r[("expect_column_values_to_be_in_set", "s")]
    assert (ins.missing_count, ins.unexpected_count) == (1, 1)
    assert ins.unexpected_percent == 50.0
    assert r[("expect_column_values_to_match_strftime_format", "ts")] \
        .unexpected_count == 1
    assert r[("expect_column_values_to_be_between", "v")].unexpected_count == 1
    assert r[("expect_column_values_to_be_of_type", "t")].unexpected_count == 1
    assert r[("expect_column_values_to_be_of_type", "id")].success
    assert r[("expect_column_values_to_be_in_type_list", "v")].success


def test_strftime_translation():
    assert q.strftime_to_spark("%Y-%m-%d %H:%M:%S") == "yyyy-MM-dd HH:mm:ss"
    assert q.strftime_to_spark("%d/%m/%YT") == "dd/MM/yyyy'T'"


def test_gate_fails_fast(spark):
    df = spark.createDataFrame([(None,)], "country string")
    tables = {"t": df}
    res = q.run_suites(tables, {"x": ("t", [q.not_null("country")])})
    with pytest.raises(q.QualityGateError):
        q.assert_passed(res)


def test_gate_has_thirty_checks():
    assert sum(len(e) for _, e in gate.SUITES.values()) == 30


def test_column_names_resolve_case_insensitively(spark):
    df = spark.createDataFrame([(1,), (-2,)], "events int")
    r = q.run_suite(df, "s", [q.between("Events", 0, None),
                              q.of_type("EVENTS", "int")]).collect()
    assert [x.unexpected_count for x in r] == [1, 0]


def test_all_missing_column_gives_null_percent(spark):
    df = spark.createDataFrame([(None,), (None,)], "s string")
    r = q.run_suite(df, "s", [q.in_set("s", ["a"]), q.not_null("s")]).collect()
    assert r[0].unexpected_percent is None and r[0].success
    assert r[1].unexpected_percent == 100.0 and not r[1].success
