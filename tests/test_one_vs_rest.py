"""One-vs-rest candidates hold one class at a time on the driver."""

from codeloom.config import CodingConfig
from codeloom.models import classifiers
from codeloom.operators import features


def test_one_vs_rest_fits_one_class_at_a_time(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(classifiers.OneVsRest, "fit", lambda self, rows: seen.append(self.getParallelism()))
    weights = spark.createDataFrame([(i, f"t{i % 3}", 1.0) for i in range(12)], "id bigint, term string, weight double")
    rows = spark.createDataFrame([(i, str(i % 3), 1) for i in range(12)], "id bigint, label string, copies bigint")
    vectors = features.indexed_vectors(weights, features.slot_table(weights), 3)
    example = classifiers.Example(rows, weights, weights, vectors)
    for family in (classifiers.SGD, classifiers.SVC):
        classifiers.candidate(family)(example, ["0", "1", "2"], CodingConfig(), 3)
    assert seen == [1, 1]
