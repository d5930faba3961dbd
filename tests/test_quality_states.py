"""Metrics from states of loads against a full scan, and that only new loads are read."""

import pytest
from helpers import rows

from fleetmart.operators import quality as Q
from fleetmart.operators import quality_states as Qs
from fleetmart.sources import versions as V

SUITE = Q.Suite.from_config({"name": "t", "pk": ["file"], "columns_dq_validations": [
    {"function": "expect_column_values_to_match_regex", "args": {"column": "name", "regex": "^[a-z]*$"}, "meta": {"critical": True}},
    {"function": "expect_column_values_to_be_unique", "args": {"column": "n"}},
    {"function": "expect_column_values_to_be_unique", "args": {"column": "x"}},
    {"function": "expect_column_values_to_not_be_null", "args": {"column": "name"}},
    {"function": "expect_column_mean_to_be_between", "args": {"column": "x", "min_value": 1, "max_value": 3}},
    {"function": "expect_column_values_to_be_of_type", "args": {"column": "n", "type": "int"}},
]})
SCHEMA = "file string, name string, n int, x double"
LOADS = {
    1: [("f1", "abc", 5, 1.5), ("f1", "a1", 6, 0.0), (None, None, None, None)],
    2: [("f2", "xyz", 5, -0.0), ("f2", None, 7, 2.5), ("f3", "9", 7, float("nan"))],
    3: [],
    4: [("f4", "q", 8, 4.5), ("f4", "q", 9, 4.5)],
}


def loads(spark, numbers, read):
    def one(n):
        read.append(n)
        return spark.createDataFrame(LOADS[n], SCHEMA)

    return {n: (lambda n=n: one(n)) for n in numbers}


def test_states_equal_a_full_scan_and_read_new_loads_only(spark, tmp_path):
    store, read = str(tmp_path / "store"), []
    for numbers, fresh in (((1,), [1]), ((1, 2), [2]), ((1, 2), []), ((1, 2, 3, 4), [3, 4]), ((2, 4), [])):
        read.clear()
        got = Qs.metrics(spark, store, SUITE, loads(spark, numbers, read), "r", "2024-07-18 22:23:50")
        assert read == fresh
        whole = spark.createDataFrame([r for n in numbers for r in LOADS[n]], SCHEMA)
        want = Q.metrics(whole, SUITE, "r", "2024-07-18 22:23:50")
        assert got.columns == want.columns and [str(r) for r in rows(got)] == [str(r) for r in rows(want)]
    assert Qs.metrics(spark, str(tmp_path / "none"), SUITE, {}, "r", "2024-07-18 22:23:50") is None


def test_another_suite_is_refused(spark, tmp_path):
    store = str(tmp_path / "store")
    Qs.refresh(spark, store, SUITE, loads(spark, (1,), []))
    other = Q.Suite("t", ["file"], SUITE.expectations[:2])
    with pytest.raises(ValueError, match="another suite"):
        Qs.refresh(spark, store, other, loads(spark, (1, 2), []))


def test_two_runs_at_once(spark, tmp_path, monkeypatch):
    store, read = str(tmp_path / "store"), []
    write, calls = V.write_version, []

    def rival(*a):
        calls.append(1)
        if len(calls) == 1:
            Qs.refresh(spark, store, SUITE, loads(spark, (1,), read))
        return write(*a)

    monkeypatch.setattr(V, "write_version", rival)
    Qs.refresh(spark, store, SUITE, loads(spark, (1, 2), read))
    assert sorted(Qs.checked(spark, store)) == [1, 2] and V.versions(spark, store) == [1, 2]
    got = Qs.metrics(spark, store, SUITE, loads(spark, (1, 2), read), "r", "2024-07-18 22:23:50")
    assert got.first()["element_count"] == 6
