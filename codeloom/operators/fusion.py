"""Combining candidate lists: ensembles, class alignment, two-level products and fusion with the vote."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codeloom.config import CodingConfig
from codeloom.functions.probability import array_total, bind
from codeloom.operators.ranking import PROB_DIGITS, top_k


def align_classes(proba: DataFrame, classes: list[str], id_col: str = "id") -> DataFrame:
    """Probabilities over exactly ``classes``, re-normalised; a row without any gets the uniform distribution.

    Every row needs every class, so the classes are spread inside the row instead of by a join.
    """
    expected = F.array(*[F.lit(c) for c in sorted(classes)])
    known = proba.groupBy(id_col).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("code").cast("string"), "prob"))).alias("given"))
    values = F.transform(expected, lambda c: F.coalesce(F.get(F.array(F.try_element_at("given", c)), F.lit(0)), F.lit(0.0)))
    normal = bind(values, lambda v: bind(array_total(v), lambda total: F.transform(
        v, lambda p: F.when(total > 0, p / total).otherwise(F.lit(1.0 / max(1, len(classes)))))))
    return known.select(id_col, F.explode_outer(F.arrays_zip(expected.alias("code"), normal.alias("prob"))).alias("e")).select(
        id_col, F.col("e.code").alias("code"), F.col("e.prob").alias("prob"))


def share_of_total(values: Column) -> Column:
    """An array divided by its total; the uniform distribution where the total is zero."""
    return bind(values, lambda v: bind(array_total(v), lambda total: F.transform(
        v, lambda p: F.when(total > 0, p / total).otherwise(F.lit(1.0) / F.size(v)))))


def aligned(codes: Column, probs: Column, classes: list[str]) -> Column:
    """``probs`` over exactly ``classes``, re-normalised. Where the codes already are the classes nothing is looked up."""
    expected = F.array(*[F.lit(c) for c in sorted(classes)])
    given = F.map_from_arrays(codes, probs)
    looked_up = bind(given, lambda m: F.transform(expected, lambda c: F.coalesce(F.try_element_at(m, c), F.lit(0.0))))
    return share_of_total(F.when(codes == expected, probs).otherwise(looked_up))


def average_in_rows(models: list[tuple[DataFrame, float]], classes: list[str], id_col: str = "id") -> DataFrame:
    """(id, probs): the weighted mean of models' (id, codes, probs) rows as one array per row, in the order of the sorted classes."""
    total = sum(weight for _, weight in models)
    total = total if total > 0 else 1.0
    mean = None
    for table, weight in models:
        part = table.select(id_col, F.transform(aligned(F.col("codes"), F.col("probs"), classes), lambda p: p * F.lit(weight / total)).alias("probs"))
        if mean is None:
            mean = part
        else:
            both = mean.join(part.withColumnRenamed("probs", "_more"), id_col, "full")
            mean = both.select(id_col, F.when(F.col("probs").isNull(), F.col("_more")).when(F.col("_more").isNull(), F.col("probs")).otherwise(
                F.zip_with("probs", "_more", lambda a, b: a + b)).alias("probs"))
    return mean.select(id_col, share_of_total(F.col("probs")).alias("probs"))


def top_in_rows(mean: DataFrame, classes: list[str], k: int, id_col: str = "id") -> DataFrame:
    """(id, rank, code, prob): the k best classes, cut inside the row before anything is exploded."""
    expected = F.array(*[F.lit(c) for c in sorted(classes)])
    entries = F.zip_with(expected, "probs", lambda c, p: F.struct((-F.round(p, PROB_DIGITS)).alias("order"), c.alias("code"), p.alias("prob")))
    best = F.slice(F.array_sort(entries), 1, max(1, k))
    return mean.select(id_col, F.posexplode_outer(best).alias("pos", "e")).select(
        id_col, (F.col("pos") + 1).alias("rank"), F.col("e.code").alias("code"), F.col("e.prob").alias("prob"))


def normalize_rows(candidates: DataFrame, id_col: str = "id") -> DataFrame:
    """Divide by the row total; rows whose total is zero become uniform over their codes."""
    row = Window.partitionBy(id_col)
    total, size = F.sum("prob").over(row), F.count("*").over(row)
    return candidates.withColumn("_t", total).withColumn("_n", size).withColumn(
        "prob", F.when(F.col("_t") > 0, F.col("prob") / F.col("_t")).otherwise(F.lit(1.0) / F.col("_n"))).drop("_t", "_n")


def ensemble_average(models: list[tuple[DataFrame, float]], id_col: str = "id") -> DataFrame:
    """Weighted mean of several models' probabilities, re-normalised per row."""
    total = sum(weight for _, weight in models)
    total = total if total > 0 else 1.0
    weighted = [p.select(id_col, "code", (F.col("prob") * F.lit(weight / total)).alias("prob")) for p, weight in models]
    union = weighted[0]
    for part in weighted[1:]:
        union = union.unionByName(part)
    return normalize_rows(union.groupBy(id_col, "code").agg(F.sum("prob").alias("prob")), id_col)


def combine_levels(majors: DataFrame, within: DataFrame, id_col: str = "id") -> DataFrame:
    """(id, major, code, prob) with prob = p(major) * p(code within major)."""
    return majors.join(within, [id_col, "major"]).select(
        id_col, "major", "code", (F.col("p_major") * F.col("p_within")).alias("prob"))


def add_baselines(majors: DataFrame, modelled: DataFrame, baseline: DataFrame, topk: int, id_col: str = "id") -> DataFrame:
    """Candidates of majors that have no model, from the shares of their most frequent codes.

    ``modelled`` lists majors with a model. ``baseline`` has (major, code, share, rank). Both hold at most one
    row per group or code of the classification, so they are small by nature and Spark may broadcast them.
    """
    open_majors = majors.join(modelled.select("major"), "major", "left_anti")
    return open_majors.join(baseline.filter(F.col("rank") <= topk), "major").select(
        id_col, "major", "code", (F.col("p_major") * F.col("share")).alias("prob"))


def max_merge(candidates: DataFrame, id_col: str = "id") -> DataFrame:
    """One row per code: the best probability among the majors that proposed it."""
    return candidates.groupBy(id_col, "code").agg(F.max("prob").alias("prob"))


def fuse(model: DataFrame, semantic: DataFrame, config: CodingConfig, topk: int, id_col: str = "id") -> DataFrame:
    """Weighted sum of model and neighbour candidates: (id, rank, code, prob).

    ``model`` has (id, code, prob), already cut to topk. ``semantic`` has (id, code, prob, conf, max_sim); it
    counts only for rows whose best neighbour is close and whose vote is confident. One grouped pass over the
    union; the semantic factor travels with its rows, so no join is needed.
    """
    ml = max(0.0, config.model_weight)
    trusted = (F.col("max_sim") >= config.semantic_min_similarity) & (F.col("conf") >= config.semantic_min_confidence)
    factor = F.when(trusted, F.lit(max(0.0, config.semantic_weight)) * F.greatest(F.lit(0.25), F.col("max_sim"))).otherwise(0.0)
    from_model = model.filter(F.col("code").isNotNull() & (F.col("prob") > 0)).select(
        id_col, F.col("code").cast("string").alias("code"), (F.col("prob") * ml).alias("score"), F.lit(0.0).alias("sem"))
    from_votes = semantic.withColumn("sem", factor).filter((F.col("sem") > 0) & F.col("code").isNotNull() & (F.col("prob") > 0)).select(
        id_col, F.col("code").cast("string").alias("code"), (F.col("prob") * F.col("sem")).alias("score"), "sem")
    row = Window.partitionBy(id_col)
    merged = (
        from_model.unionByName(from_votes).groupBy(id_col, "code").agg(F.sum("score").alias("score"), F.max("sem").alias("sem"))
        .withColumn("denominator", F.greatest(F.lit(1e-9), F.lit(ml) + F.max("sem").over(row)))
        .withColumn("prob", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score") / F.col("denominator"))))
    )
    return top_k(merged, topk, id_col, prob="score").select(id_col, "rank", "code", "prob")
