"""Many linear models in one pass: every candidate, parameter setting and fold shares each epoch's two aggregates.

The weights are one long table (term, w): w is an array over (model, class) slots, so all models read the feature
table once an epoch. An epoch is

1. scores: features x weights by term, summed per answer (one vector aggregate, combined before the shuffle);
2. residuals per answer and model from its link (softmax, one-vs-rest logistic, squared hinge), times the answer's
   copies, and zero where the model's fold leaves the answer out;
3. gradients: features x residuals by answer, summed per term (the same aggregate; a term that a third of all
   answers carry is summed inside each task first);
4. an Adam step on every slot in the weights table, with each model's own L2 penalty.

The number of Spark jobs is the number of epochs, whatever the number of models; no model's matrix is ever on the
driver. The out-of-fold table (model, id, fold, label, probabilities) comes from the same weights and serves
cross-validation, selection and ensemble weights.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeloom.operators.lookup import BROADCAST_BYTES, lookup_join
from codeloom.session import stage

BIAS = "__bias__"
SOFTMAX, SIGMOID, HINGE = "softmax", "sigmoid", "hinge"


@dataclass(frozen=True)
class LinearSpec:
    """One model: its name, link, L2 penalty and the fold it leaves out (-1: fitted on all rows)."""

    name: str
    link: str
    l2: float
    fold: int = -1


def summed(table: DataFrame, key: str, values: str) -> DataFrame:
    """(key, values): element-wise sums of equal-length arrays per key, as one mergeable aggregate."""
    total = table.groupBy(key).agg(Summarizer.sum(array_to_vector(values)).alias("_v"))
    return total.select(key, vector_to_array("_v").alias(values))


def with_bias(features: DataFrame) -> DataFrame:
    """(id, term, x): the feature table with a constant term for every answer."""
    ids = features.select("id").distinct()
    return features.select("id", F.col("term").cast("string").alias("term"), F.col("weight").cast("double").alias("x")).unionByName(
        ids.select("id", F.lit(BIAS).alias("term"), F.lit(1.0).alias("x")))


def linked(z: str, label: str, classes: int, specs: list[LinearSpec]) -> tuple[F.Column, F.Column]:
    """Probabilities and residuals (d loss / d score) over all slots, from scores ``z`` and the class index ``label``."""
    probs, residuals = [], []
    for m, spec in enumerate(specs):
        block = F.slice(F.col(z), m * classes + 1, classes)
        truth = [(F.col(label) == c).cast("double") for c in range(classes)]
        if spec.link == SOFTMAX:
            top = F.array_max(block)
            exp = F.transform(block, lambda v: F.exp(v - top))
            total = F.aggregate(exp, F.lit(0.0), lambda a, v: a + v)
            p = [F.element_at(exp, c + 1) / total for c in range(classes)]
            r = [p[c] - truth[c] for c in range(classes)]
        elif spec.link == SIGMOID:
            raw = [1.0 / (1.0 + F.exp(-F.element_at(block, c + 1))) for c in range(classes)]
            total = sum(raw[1:], raw[0])
            p = [q / total for q in raw]
            r = [raw[c] - truth[c] for c in range(classes)]
        else:  # squared hinge, one class against the rest; probabilities by a softmax of the margins
            top = F.array_max(block)
            exp = F.transform(block, lambda v: F.exp(v - top))
            total = F.aggregate(exp, F.lit(0.0), lambda a, v: a + v)
            p = [F.element_at(exp, c + 1) / total for c in range(classes)]
            sign = [2.0 * truth[c] - 1.0 for c in range(classes)]
            r = [-2.0 * sign[c] * F.greatest(F.lit(0.0), 1.0 - sign[c] * F.element_at(block, c + 1)) for c in range(classes)]
        probs += p
        residuals += r
    return F.array(*probs), F.array(*residuals)


@dataclass
class LinearModels:
    """The fitted weights of all specs, and how to score with them."""

    specs: list[LinearSpec]
    classes: list[str]
    weights: DataFrame  # term, w
    small: bool = False  # whether the weights table fits the broadcast bound

    def scores(self, features: DataFrame) -> DataFrame:
        """(id, z): the scores of every slot for every answer of the feature table."""
        rows = lookup_join(with_bias(features), self.weights, ["term"], "id", how="inner", broadcast=self.small)
        return summed(rows.select("id", F.transform("w", lambda v: v * F.col("x")).alias("z")), "id", "z")

    def probabilities(self, features: DataFrame) -> DataFrame:
        """(id, p): probabilities of every slot, model after model, classes in order."""
        p, _ = linked("z", "_none", len(self.classes), self.specs)
        return self.scores(features).withColumn("_none", F.lit(-1)).select("id", p.alias("p"))

    def arrays(self, features: DataFrame, name: str) -> DataFrame:
        """(id, codes, probs) of one model."""
        m = next(i for i, s in enumerate(self.specs) if s.name == name)
        codes = F.array(*[F.lit(c) for c in self.classes])
        return self.probabilities(features).select("id", codes.alias("codes"), F.slice("p", m * len(self.classes) + 1, len(self.classes)).alias("probs"))

    def out_of_fold(self, features: DataFrame, rows: DataFrame) -> DataFrame:
        """(model, id, fold, label, predicted, prob): each model with a fold, on the rows of that fold only.

        ``rows`` has id, label (code), fold and copies; a row stands for its copies in the scores.
        """
        c = len(self.classes)
        codes = F.array(*[F.lit(x) for x in self.classes])
        found = self.probabilities(features).join(rows.select("id", F.col("label").cast("string").alias("label"), "fold", "copies"), "id")
        parts = []
        for m, spec in enumerate(self.specs):
            if spec.fold < 0:
                continue
            block = F.slice("p", m * c + 1, c)
            best = F.array_position(block, F.array_max(block))
            truth = F.array_position(codes, F.col("label"))
            parts.append(found.filter(F.col("fold") == spec.fold).select(
                F.lit(spec.name).alias("model"), "id", "fold", "label", "copies", F.element_at(codes, best.cast("int")).alias("predicted"),
                F.when(truth > 0, F.element_at(block, truth.cast("int"))).otherwise(F.lit(0.0)).alias("prob")))
        table = parts[0]
        for part in parts[1:]:
            table = table.unionByName(part)
        return table


def train(features: DataFrame, rows: DataFrame, classes: list[str], specs: list[LinearSpec], epochs: int = 60,
          rate: float = 0.1) -> LinearModels:
    """Fit all specs together by full-batch Adam on the copies-weighted mean loss.

    ``features`` is (id, term, weight); ``rows`` is (id, label, copies, fold) with labels among ``classes``. Answers
    without features are fitted by their bias alone; labels outside ``classes`` are ignored.
    """
    c, k = len(classes), len(specs) * len(classes)
    codes = F.array(*[F.lit(x) for x in classes])
    table = stage(with_bias(features), "shared-features")
    labelled = rows.select("id", (F.array_position(codes, F.col("label").cast("string")) - 1).cast("int").alias("_label"),
                           F.col("copies").cast("double").alias("_copies"), F.col("fold").cast("int").alias("_fold"))
    labelled = stage(labelled.filter(F.col("_label") >= 0), "shared-labels")
    # every model's total weight of rows, so each is the mean over its own training rows
    totals = {r["_fold"]: r["n"] for r in labelled.groupBy("_fold").agg(F.sum("_copies").alias("n")).collect()}
    everything = sum(totals.values()) or 1.0
    scale = [1.0 / max(everything - (totals.get(s.fold, 0.0) if s.fold >= 0 else 0.0), 1.0) for s in specs]
    mask = lambda v, i: v * F.when(F.element_at(F.array(*[F.lit(s.fold) for s in specs]), (i / c).cast("int") + 1) == F.col("_fold"), 0.0).otherwise(
        F.col("_copies") * F.element_at(F.array(*[F.lit(x) for x in scale]), (i / c).cast("int") + 1))
    penalty = F.array(*[F.lit(s.l2) for s in specs for _ in range(c)])
    zero = F.array_repeat(F.lit(0.0), k)
    weights = stage(table.select("term").distinct().select("term", zero.alias("w"), zero.alias("m1"), zero.alias("m2")), "shared-weights")
    # the size of the weights follows from their shape: terms x slots x 8 bytes, plus the term
    width = weights.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("term")).alias("b")).first()
    small = (width["n"] or 0) * (k * 8 + 48) + (width["b"] or 0) <= BROADCAST_BYTES
    model = LinearModels(specs, classes, weights.select("term", "w"), small)
    for epoch in range(1, epochs + 1):
        scores = summed(lookup_join(table, model.weights, ["term"], "id", how="inner", broadcast=small)
                        .select("id", F.transform("w", lambda v: v * F.col("x")).alias("z")), "id", "z")
        _, residual = linked("z", "_label", c, specs)
        residuals = scores.join(labelled, "id").select("id", F.transform(residual, mask).alias("r"))
        grads = summed(table.join(residuals, "id").select("term", F.transform("r", lambda v: v * F.col("x")).alias("g")), "term", "g")
        step = weights.join(grads, "term", "left").select(
            "term", F.coalesce("g", zero).alias("g"), "w", "m1", "m2")
        step = step.select("term", F.arrays_zip("w", "g", "m1", "m2", penalty.alias("l2")).alias("_s"))
        bias = F.col("term") == BIAS
        fix1, fix2 = 1 - 0.9 ** epoch, 1 - 0.999 ** epoch

        def move(s):
            g = s["g"] + F.when(bias, 0.0).otherwise(s["l2"] * s["w"])
            m1 = 0.9 * s["m1"] + 0.1 * g
            m2 = 0.999 * s["m2"] + 0.001 * g * g
            return F.struct((s["w"] - rate * (m1 / fix1) / (F.sqrt(m2 / fix2) + 1e-8)).alias("w"), m1.alias("m1"), m2.alias("m2"))

        moved = step.select("term", F.transform("_s", move).alias("_s"))
        weights = stage(moved.select("term", F.col("_s.w").alias("w"), F.col("_s.m1").alias("m1"), F.col("_s.m2").alias("m2")), "shared-weights")
        model = LinearModels(specs, classes, weights.select("term", "w"), small)
    return model
