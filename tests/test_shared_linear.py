"""The shared linear pass: several links, penalties and folds trained together, one job set per epoch."""

import pytest

from codeloom.models.shared import HINGE, SIGMOID, SOFTMAX, LinearSpec, train


def test_shared_pass_learns_every_model_and_keeps_folds_apart(spark):
    rows, feats = [], []
    for i in range(60):
        label = ["a", "b", "c"][i % 3]
        rows.append((i, label, 1 + (i % 4 == 0), i % 2))
        feats += [(i, f"t_{label}", 1.0), (i, f"noise_{i % 5}", 0.5)]
    rows_df = spark.createDataFrame(rows, "id long, label string, copies long, fold int")
    feats_df = spark.createDataFrame(feats, "id long, term string, weight double")
    specs = [LinearSpec(f"{link}{fold}", link, 1e-3, fold) for link in (SOFTMAX, SIGMOID, HINGE) for fold in (-1, 0, 1)]
    model = train(feats_df, rows_df, ["a", "b", "c"], specs, epochs=15, rate=0.3)
    probs = model.probabilities(feats_df).collect()
    assert len(probs) == 60
    for r in probs:
        for m in range(len(specs)):
            block = r["p"][3 * m:3 * m + 3]
            assert sum(block) == pytest.approx(1.0)
    oof = model.out_of_fold(feats_df, rows_df).collect()
    assert {r["model"] for r in oof} == {s.name for s in specs if s.fold >= 0}
    assert all(r["fold"] == int(r["model"][-1]) for r in oof)
    assert sum(r["label"] == r["predicted"] for r in oof) / len(oof) > 0.95
    assert model.arrays(feats_df, "softmax-1").count() == 60
