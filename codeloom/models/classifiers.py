"""Candidate classifiers on Spark ML vectors and on long feature tables, behind one small interface.

``fit`` takes distinct answers with their labels and copies; ``arrays`` returns (id, codes, probs), one row per answer, and
``proba`` the same as (id, code, prob).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial
from typing import Any

from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeloom.config import CodingConfig
from codeloom.functions.probability import array_total, bind, sigmoid, softmax
from codeloom.models import naive_bayes
from codeloom.operators.features import FeaturePlan

# Classes that one-vs-rest fits at a time: each holds some thirty vectors of the vocabulary's size on the driver.
OVR_PARALLELISM = 1

# Megabytes of rows that a logistic fit gathers into one block. Each block costs a pass over all coefficients, which grow with the
# vocabulary; Spark's own 1 MB makes that pass dearer than the rows themselves.
BLOCK_MB = 16.0

# Names of the candidate families.
SGD, LOGISTIC, SVC, COMPLEMENT, FOREST = "sgd_log_elasticnet", "logreg_balanced", "linear_svc_balanced", "complement_nb", "tree_ensemble"


@dataclass
class Example:
    """Training or scoring input in both forms; ``vectors`` is built only when an ML candidate asks for it."""

    rows: DataFrame                # id, label, copies (training) or id (scoring)
    weights: DataFrame             # id, term, weight: all blocks
    nonnegative: DataFrame         # id, term, weight: text and one-hot blocks
    vectors: DataFrame | None      # id, features


# Candidate families of each search level. No size of the data takes a family away.
SEARCH_FAMILIES = {
    "light": (SGD, LOGISTIC, COMPLEMENT),
    "robust": (SGD, LOGISTIC, SVC, COMPLEMENT, FOREST),
    "max": (SGD, LOGISTIC, SVC, COMPLEMENT, FOREST),
}


def candidate_families(config: CodingConfig) -> list[str]:
    """The families to compare: the caller's list, else those of the search level."""
    level = SEARCH_FAMILIES.get(config.model_search, (SGD, LOGISTIC))
    if config.candidate_models is None:
        return list(level)
    return [n for n in level if n in config.candidate_models] or list(config.candidate_models[:1])


def balanced(rows: DataFrame) -> DataFrame:
    """Instance weight = copies * rows / (classes * rows of the class)."""
    per_class = rows.groupBy("label").agg(F.sum("copies").alias("_n"))
    totals = per_class.agg(F.sum("_n").alias("n"), F.count("*").alias("k")).first()
    # one row per class of the classification
    return rows.join(F.broadcast(per_class), "label").withColumn(
        "instance_weight", F.col("copies") * F.lit(float(totals["n"]) / float(totals["k"])) / F.col("_n")).drop("_n")


def spread(arrays: DataFrame) -> DataFrame:
    """(id, code, prob) from (id, codes, probs)."""
    return arrays.select("id", F.explode_outer(F.arrays_zip(F.col("codes").alias("code"), F.col("probs").alias("prob"))).alias("e")).select(
        "id", F.col("e.code").alias("code"), F.col("e.prob").alias("prob"))


@dataclass
class ComplementClassifier:
    model: naive_bayes.ComplementModel

    def arrays(self, example: Example) -> DataFrame:
        groups = example.rows.select("id").distinct().withColumn("grp", F.lit("all"))
        return self.model.arrays(example.nonnegative, groups).select("id", "codes", "probs")

    def proba(self, example: Example) -> DataFrame:
        return spread(self.arrays(example))


@dataclass
class VectorClassifier:
    """A fitted Spark ML classifier with the mapping from class index to code."""

    model: Any
    classes: list[str]
    link: str  # probability, sigmoid or softmax

    def arrays(self, example: Example) -> DataFrame:
        scored = self.model.transform(example.vectors)
        column = "probability" if self.link == "probability" else "rawPrediction"
        scores = vector_to_array(F.col(column))
        if self.link == "softmax":
            values = softmax(scores)
        elif self.link == "sigmoid":
            values = bind(F.transform(scores, sigmoid), lambda p: bind(array_total(p), lambda s: F.transform(p, lambda x: x / s)))
        else:
            values = scores
        codes = F.array(*[F.lit(c) for c in self.classes])
        return scored.select("id", codes.alias("codes"), values.alias("probs"))

    def proba(self, example: Example) -> DataFrame:
        return spread(self.arrays(example))


def fit_complement(example: Example, classes: list[str], config: CodingConfig, vocabulary_size: int, alpha: float | None = None):
    labels = example.rows.select("id", F.lit("all").alias("grp"), "label", "copies")
    sums = naive_bayes.label_term_sums(example.nonnegative, labels)
    return ComplementClassifier(naive_bayes.fit(sums, vocabulary_size, config.complement_alpha if alpha is None else alpha))


def training_vectors(example: Example, classes: list[str]) -> DataFrame:
    codes = F.array(*[F.lit(c) for c in classes])
    index = (F.array_position(codes, F.col("label").cast("string")) - 1).cast("double")
    return balanced(example.rows.withColumn("label", F.col("label").cast("string"))).withColumn("target", index).join(
        example.vectors, "id").select("features", "target", "instance_weight")


def fit_vector(example: Example, classes: list[str], config: CodingConfig, vocabulary_size: int, family: str, **overrides):
    rows = training_vectors(example, classes).persist()
    common = dict(featuresCol="features", labelCol="target", weightCol="instance_weight")
    blocks = dict(maxBlockSizeInMB=BLOCK_MB)
    ratio = 0.25 if config.profile == "accuracy" else 0.15
    if family == SGD:
        base = LogisticRegression(regParam=overrides.get("alpha", config.sgd_alpha), maxIter=overrides.get("max_iter", config.sgd_max_iter),
                                  elasticNetParam=min(max(overrides.get("l1_ratio", ratio), 0.0), 1.0), tol=1e-4, **common, **blocks)
        estimator, link = OneVsRest(classifier=base, parallelism=OVR_PARALLELISM, **common), "sigmoid"
    elif family == LOGISTIC:
        count = max(1, rows.count())
        estimator, link = LogisticRegression(
            family="multinomial", regParam=1.0 / (overrides.get("c", config.logistic_c) * count),
            elasticNetParam=min(max(overrides.get("l1_ratio", ratio), 0.0), 1.0),
            maxIter=overrides.get("max_iter", config.logistic_max_iter), **common, **blocks), "probability"
    elif family == SVC:
        count = max(1, rows.count())
        base = LinearSVC(regParam=1.0 / (config.svc_c * count), maxIter=overrides.get("max_iter", 100), **common)
        estimator, link = OneVsRest(classifier=base, parallelism=OVR_PARALLELISM, **common), "softmax"
    elif family == FOREST:
        estimator, link = RandomForestClassifier(
            numTrees=overrides.get("trees", config.tree_count), maxDepth=overrides.get("depth", 6), seed=config.seed, **common), "probability"
    else:
        raise ValueError(f"unknown family {family!r}")
    try:
        return VectorClassifier(estimator.fit(rows), classes, link)
    finally:
        rows.unpersist()


def candidate(name: str, **overrides):
    """A function (example, classes, config, vocabulary_size) -> fitted classifier."""
    if name == COMPLEMENT:
        return partial(fit_complement, **overrides)
    return partial(fit_vector, family=name, **overrides)
