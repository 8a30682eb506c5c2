"""Every registered query with SQL equals it; the others satisfy invariants."""

import json

import pytest

from brinemark import fixed_values as fv
from brinemark.workload.oracle import ORACLE
from brinemark.workload.queries import QUERIES
from tests.compare import difference, duck, rows_of_duck, rows_of_spark


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, sf_dir, con, name):
    assert difference(rows_of_spark(QUERIES[name](spark, sf_dir)), rows_of_duck(con, ORACLE[name])) is None


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_mle_fit_is_usable(spark, sf_dir):
    rows = QUERIES["gpd_fit_mle"](spark, sf_dir).collect()
    assert len(rows) == 5
    for r in rows:
        # A sample of enough peaks may still have no maximum; the SQL says which.
        assert r["shape"] is None or (r["n_peaks"] >= 10 and r["scale"] > 0 and r["shape"] > -1)


def test_forest_metrics_and_gate(spark, sf_dir):
    row = QUERIES["train_forest_metrics"](spark, sf_dir).first()
    assert 0.5 < row["accuracy"] <= 1 and 0 <= row["min_recall"] <= 1
    assert row["accepted"] == all(row[c] >= 0.85 for c in ("accuracy", "balanced_accuracy", "f1_macro", "min_recall"))


def test_streamed_classes_share_out(spark, sf_dir):
    rows = QUERIES["stream_classify"](spark, sf_dir).collect()
    assert {r["wave_classification"] for r in rows} == set(fv.SEA_STATES)
    totals = {}
    for r in rows:
        key = (r["year"], r["month"], r["coast_name"])
        totals[key] = totals.get(key, 0) + r["percentage"]
    assert all(abs(t - 100) < 0.1 for t in totals.values())


def test_payload_documents(spark, sf_dir):
    rows = QUERIES["coast_payload"](spark, sf_dir).collect()
    assert {r["id"] for r in rows} == set(fv.COASTS)
    for r in rows:
        doc = json.loads(r["json"])
        assert doc["has_data"] and doc["name"] == r["coast_name"]
        assert list(doc["seastate"]["series"]) == fv.SEA_STATES
        assert all(len(v) == 12 for v in doc["seastate"]["series"].values())
        assert doc["annual"]["years"] == sorted(doc["annual"]["years"])
        for slots in doc["monthly_by_year"].values():
            assert len(slots["mean_hs"]) == 12 and len(slots["n"]) == 12


def test_packed_forecast(spark, sf_dir):
    doc = json.loads(QUERIES["pack_forecast"](spark, sf_dir).first()["json"])
    assert doc["metrics"] == ["Height", "Wind"]
    numbers = [int(p[1:]) for p in doc["periods"]]
    assert numbers == sorted(numbers)
    assert all(len(doc["series"][p][m]) == 7 for p in doc["periods"] for m in doc["metrics"])
