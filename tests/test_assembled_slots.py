"""Assembled vectors take their slots from the fitted plan, not from another pass over the texts."""

from codeloom.catalog import REGISTRY, Tables
from codeloom.operators import features


def test_assembled_slots_come_from_the_plan(spark, monkeypatch):
    seen = []
    real = features.slot_table
    monkeypatch.setattr(features, "slot_table", lambda table: seen.append(table.columns) or real(table))
    rows = [(i, f"cook {i % 2} line", None, None, "x", "F", "b", float(i)) for i in range(12)]
    survey = spark.createDataFrame(rows, "id int, qe4 string, qe1oth string, qe8aoth string, qe2b string, qe1 string, qse1 string, qe10 double")
    found = REGISTRY["assemble_features"].run(Tables(spark, "/none", {"survey": survey})).collect()
    assert seen == [["term"]] and len(found) == 12 and len({len(r["features"]) for r in found}) == 1
    assert all(any(r["features"]) for r in found)
