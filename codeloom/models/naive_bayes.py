"""Complement naive Bayes on long feature tables, for any number of groups in one job.

A group is one model: a cross-validation fold, a major group, or both. Counts are aggregated once per
(group, label, term); nothing has the size rows x classes before the top candidates are cut.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codeloom.functions.probability import softmax
from codeloom.operators.lookup import lookup_join
from codeloom.session import stage


def label_term_sums(features: DataFrame, labels: DataFrame, group: str = "grp") -> DataFrame:
    """(grp, label, term, s): weighted feature sums. ``labels`` has (id, grp, label, copies)."""
    joined = features.join(labels.select("id", group, "label", "copies"), "id")
    return joined.groupBy(group, "label", "term").agg(F.sum(F.col("weight") * F.col("copies")).alias("s"))


def leave_fold_out(sums: DataFrame, folds: int) -> DataFrame:
    """Sums of every training complement from per-fold sums: fold f's model sees all other folds."""
    others = F.array_except(F.sequence(F.lit(0), F.lit(folds - 1)), F.array(F.col("fold").cast("int")))
    keys = [c for c in sums.columns if c not in ("fold", "s")]
    spread = sums.select(*keys, "s", F.explode(others).alias("fold"))
    return spread.groupBy(*keys, "fold").agg(F.sum("s").alias("s"))


@dataclass
class ComplementModel:
    """``deltas``: (grp, term, label, delta). ``classes``: (grp, classes array<struct<code, lnz>>)."""

    deltas: DataFrame
    classes: DataFrame

    def scores(self, features: DataFrame, groups: DataFrame, broadcast: bool | None = None) -> DataFrame:
        """(id, grp, codes array, scores array). ``groups`` has (id, grp): the models to evaluate per row."""
        weighted = features.join(groups.select("id", "grp"), "id")
        mass = weighted.groupBy("id", "grp").agg(F.sum("weight").alias("sx"))
        # a row without any known term keeps its place: all its scores are 0, so all classes are equally likely
        mass = groups.select("id", "grp").join(mass, ["id", "grp"], "left").withColumn("sx", F.coalesce("sx", F.lit(0.0)))
        packed = self.deltas.groupBy("grp", "term").agg(F.collect_list(F.struct("label", "delta")).alias("d"))
        hits = lookup_join(weighted, packed, ("grp", "term"), spread="id", how="inner", broadcast=broadcast)
        sums = (
            hits.select("id", "grp", "weight", F.inline("d")).groupBy("id", "grp", "label")
            .agg(F.sum(F.col("weight") * F.col("delta")).alias("v"))
            .groupBy("id", "grp").agg(F.map_from_entries(F.collect_list(F.struct("label", "v"))).alias("m"))
        )
        rows = mass.join(sums, ["id", "grp"], "left").join(F.broadcast(self.classes), "grp")
        # one class list per model: bounded by the classification, see fit()
        scores = F.transform("classes", lambda c: F.col("sx") * c["lnz"] + F.coalesce(
            F.try_element_at("m", c["code"]), F.lit(0.0)))
        return rows.select("id", "grp", F.col("classes.code").alias("codes"), scores.alias("scores"))

    def arrays(self, features: DataFrame, groups: DataFrame, broadcast: bool | None = None) -> DataFrame:
        """(id, grp, codes array, probs array): one row per row and model, classes in code order."""
        return self.scores(features, groups, broadcast).select("id", "grp", "codes", softmax(F.col("scores")).alias("probs"))

    def proba(self, features: DataFrame, groups: DataFrame, broadcast: bool | None = None) -> DataFrame:
        """(id, grp, code, prob) for every class of the row's models."""
        scored = self.scores(features, groups, broadcast)
        return scored.select("id", "grp", F.explode_outer(F.arrays_zip(
            F.col("codes").alias("code"), softmax(F.col("scores")).alias("prob"))).alias("e")).select(
            "id", "grp", F.col("e.code").alias("code"), F.col("e.prob").alias("prob"))

    def top(self, features: DataFrame, groups: DataFrame, k: int, broadcast: bool | None = None) -> DataFrame:
        """(id, grp, code, prob) of the k best classes, cut inside the row before anything is exploded."""
        scored = self.scores(features, groups, broadcast)
        entries = F.transform(
            F.arrays_zip(F.col("codes").alias("code"), softmax(F.col("scores")).alias("prob")),
            lambda e: F.struct((-F.round(e["prob"], 12)).alias("order"), e["code"].alias("code"), e["prob"].alias("prob")))
        best = F.slice(F.array_sort(entries), 1, k)
        return scored.select("id", "grp", F.explode_outer(best).alias("e")).select(
            "id", "grp", F.col("e.code").alias("code"), F.col("e.prob").alias("prob"))


def fit(sums: DataFrame, vocabulary_size: int, alpha: float, group: str = "grp") -> ComplementModel:
    """Model tables from (grp, label, term, s).

    For class c and term i the weight is -log((all_i + a - s_ci) / (T + a V - T_c)). The part that is equal
    for all classes cancels in the softmax, so only terms seen with a class need a row.
    """
    sums = stage(sums.withColumn("label", F.col("label").cast("string")).filter(F.col("s") > 0), "nb-sums")
    per_term = Window.partitionBy(group, "term")
    deltas = sums.withColumn("a", F.sum("s").over(per_term)).select(
        F.col(group).alias("grp"), "term", "label",
        (F.log(F.col("a") + alpha) - F.log(F.greatest(F.col("a") - F.col("s"), F.lit(0.0)) + alpha)).alias("delta"))
    totals = sums.groupBy(group, "label").agg(F.sum("s").alias("t"))
    rest = F.sum("t").over(Window.partitionBy(group)) - F.col("t")
    classes = (
        totals.select(F.col(group).alias("grp"), F.struct(
            F.col("label").alias("code"), F.log(rest + alpha * vocabulary_size).alias("lnz")).alias("c"))
        .groupBy("grp").agg(F.array_sort(F.collect_list("c")).alias("classes"))
    )
    return ComplementModel(stage(deltas, "nb-deltas"), stage(classes, "nb-classes"))


def keyed_scores(features: DataFrame, labels: DataFrame, folds: int, seed: int, vocabulary_size: int, alpha: float) -> DataFrame:
    """(grp, macro_f1, log_loss): cross-validation of every group's model in one keyed job.

    Per-fold sums are aggregated once; the model for a fold sees the sums of the other folds.
    """
    from codeloom.operators import metrics
    from codeloom.operators.filters import stratified_folds
    from codeloom.operators.ranking import PROB_DIGITS

    dealt = stage(stratified_folds(labels.withColumn("_c", F.concat_ws("|", "grp", "label")), folds, seed, "_c").drop("_c"), "nb-folds")
    per_fold = features.join(dealt, "id").groupBy("grp", "fold", "label", "term").agg(F.sum(F.col("weight") * F.col("copies")).alias("s"))
    sums = leave_fold_out(per_fold, folds).withColumn("model", F.concat_ws("|", "grp", "fold"))
    model = fit(sums, vocabulary_size, alpha, "model")
    checks = dealt.withColumn("model", F.concat_ws("|", "grp", "fold"))
    proba = stage(model.proba(features, checks.select("id", F.col("model").alias("grp")).distinct()), "nb-checks")
    best = proba.groupBy("id", "grp").agg(
        F.min(F.struct((-F.round("prob", PROB_DIGITS)).alias("o"), "code")).alias("b")).select("id", "grp", F.col("b.code").alias("predicted"))
    rows = checks.select("id", F.col("grp").alias("key"), F.col("model").alias("grp"), "label", "fold")
    judged = (
        rows.join(best, ["id", "grp"])
        .join(proba.select("id", "grp", F.col("code").alias("label"), "prob"), ["id", "grp", "label"], "left")
        .select("key", F.col("grp").alias("fold"), "label", "predicted", F.coalesce("prob", F.lit(0.0)).alias("prob"))
    )
    per_model = metrics.macro_f1(judged).join(metrics.log_loss(judged), "fold")
    key = F.element_at(F.split("fold", r"\|"), 1)
    return per_model.groupBy(key.alias("grp")).agg(F.avg("macro_f1").alias("macro_f1"), F.avg("log_loss").alias("log_loss"))
