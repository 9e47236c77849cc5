"""Logistic candidates gather rows into blocks that are large beside the coefficients."""

import pytest

from codeloom.config import CodingConfig
from codeloom.models import classifiers


def example(spark):
    from codeloom.operators import features
    weights = spark.createDataFrame([(i, f"t{j}", 1.0 + i % 5) for i in range(24) for j in (i % 3, 3 + i % 2)], "id bigint, term string, weight double")
    rows = spark.createDataFrame([(i, str(i % 3), 1 + i % 2) for i in range(24)], "id bigint, label string, copies bigint")
    slots = features.slot_table(weights)
    return classifiers.Example(rows, weights, weights, features.indexed_vectors(weights, slots, slots.count()))


@pytest.mark.parametrize("family", [classifiers.SGD, classifiers.LOGISTIC])
def test_blocks_are_set_and_leave_the_model_alone(spark, monkeypatch, family):
    data, config, sizes = example(spark), CodingConfig(), []
    base = classifiers.LogisticRegression
    fit = base._fit
    monkeypatch.setattr(base, "_fit", lambda self, rows: sizes.append(self.getMaxBlockSizeInMB()) or fit(self, rows))
    probabilities = lambda: {r["id"]: r["probs"] for r in classifiers.candidate(family, max_iter=5)(data, ["0", "1", "2"], config, 5).arrays(data).collect()}
    found = probabilities()
    assert sizes and set(sizes) == {classifiers.BLOCK_MB} and classifiers.BLOCK_MB > 1
    monkeypatch.setattr(classifiers, "BLOCK_MB", 0.0)
    usual = probabilities()
    assert len(found) == 24 and all(found[i] == pytest.approx(usual[i], abs=1e-6) for i in usual)
