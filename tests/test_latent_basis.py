"""The latent basis of a narrow block comes from one pass over the rows."""

import numpy as np
from pyspark.mllib.linalg.distributed import RowMatrix

from codeloom.operators import features


def test_basis_is_that_of_the_matrix_in_one_pass(spark, monkeypatch):
    draw = np.random.default_rng(3)
    matrix = draw.random((60, 12)) * (draw.random((60, 12)) < 0.4)
    rows = [(i, f"t{j:02d}", float(matrix[i, j])) for i in range(60) for j in range(12) if matrix[i, j]]
    weights = spark.createDataFrame(rows, "id int, term string, weight double")
    vectors = features.indexed_vectors(weights, features.slot_table(weights), 12).repartition(3)
    with monkeypatch.context() as patch:
        patch.setattr(RowMatrix, "computeSVD", lambda *a, **k: 1 / 0)
        patch.setattr(features, "GRAM_ROWS", 7)
        basis = features.latent_basis(vectors, 4)
    _, strength, right = np.linalg.svd(matrix, full_matrices=False)
    assert basis.shape == (12, 4) and np.allclose(np.abs((right[:4] * basis.T).sum(axis=1)), 1)
    monkeypatch.setattr(features, "GRAM_DIMS", 2)
    assert np.allclose(features.latent_basis(vectors, 4), basis, atol=1e-6)


def test_components_without_strength_are_left_out(spark):
    weights = spark.createDataFrame([(1, "a", 1.0), (2, "a", 2.0), (3, "b", 1.0)], "id int, term string, weight double")
    vectors = features.indexed_vectors(weights, features.slot_table(weights), 3)
    assert features.latent_basis(vectors, 3).shape == (3, 2)
