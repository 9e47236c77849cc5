"""Slots come from the fitted plan: the same table as from the answers' weights, without another pass over the texts."""

from codeloom.config import CodingConfig
from codeloom.operators import features


def fitted(spark):
    rows = [(i, f"Jobtitle: plumber {['of pipes', 'for boats', None, ''][i % 4] or ''} ward{i % 3}", ["a", None, "b"][i % 3],
             float(i) if i % 5 else None, 1 + i % 2) for i in range(24)]
    answers = spark.createDataFrame(rows + rows[:2], "id bigint, doc string, qe1 string, qe10 double, copies bigint")
    return answers, features.fit_features(answers, ("qe1",), ("qe10",), CodingConfig())


def test_slots_of_the_plan_equal_those_of_the_weights(spark):
    answers, plan = fitted(spark)
    slots = lambda table: sorted(map(tuple, features.slot_table(table).collect()))
    found = slots(plan.terms())
    assert found == slots(plan.all_blocks(answers))
    assert len(found) == plan.size and [s for _, s in found] == list(range(plan.size))


def test_terms_do_not_unfold_texts(spark, monkeypatch):
    _, plan = fitted(spark)
    monkeypatch.setattr(features, "TERM_ROWS", {})
    assert plan.terms().count() == plan.size
    assert features.FeaturePlan(plan.vocabulary, plan.categories, [], plan.category_names, plan.size - 1).terms().count() == plan.size - 1
