"""Row filters of training and routing."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codeloom.functions.codes import MAJOR_GROUPS, code_missing, code_of, major_group, number_of, occupation_labelled
from codeloom.functions.text import normalized


def labelled_industry(df: DataFrame, target: str, listed: Sequence[str] = ()) -> DataFrame:
    """Rows with a usable industry code, added as ``label``."""
    return df.withColumn("label", code_of(df, target)).filter(~code_missing(F.col("label"), listed))


def labelled_occupation(df: DataFrame, target: str, title: str, listed: Sequence[int] = ()) -> DataFrame:
    """Rows with a usable occupation code and a title; adds ``label`` (int)."""
    number = number_of(df, target)
    rows = df.filter(occupation_labelled(number, listed))
    if title in df.columns:
        rows = rows.filter(F.length(normalized(df, title)) > 0)
    return rows.withColumn("label", F.rint(number).cast("int"))


def valid_major(rows: DataFrame) -> DataFrame:
    """Keep labels of the known major groups; adds ``major``."""
    return rows.withColumn("major", major_group(F.col("label"))).filter(F.col("major").isin(*MAJOR_GROUPS))


def class_counts(rows: DataFrame, by: Sequence[str] = ("label",)) -> DataFrame:
    return rows.groupBy(*by).agg(F.count("*").alias("n"))


def rare_classes(rows: DataFrame, minimum: int, by: Sequence[str] = ("label",)) -> DataFrame:
    """Classes below the support threshold."""
    return class_counts(rows, by).filter(F.col("n") < minimum)


def drop_rare(rows: DataFrame, minimum: int, by: Sequence[str] = ("label",)) -> DataFrame:
    """Rows of classes with enough support. The class table holds one row per code of the classification."""
    return rows.join(rare_classes(rows, minimum, by).select(*by), list(by), "left_anti")


def drop_rare_within(rows: DataFrame, minimum: int) -> DataFrame:
    """Rows whose code has enough support inside its major group."""
    return drop_rare(rows, minimum, ("major", "label"))


@dataclass(frozen=True)
class Size:
    rows: int
    classes: int


def measure(rows: DataFrame, label: str = "label") -> Size:
    found = rows.groupBy(label).agg(F.count("*").alias("n")).agg(F.sum("n").alias("rows"), F.count("*").alias("classes")).first()
    return Size(int(found["rows"] or 0), int(found["classes"]))


def require(size: Size, rows: int, classes: int, what: str) -> None:
    if size.rows < rows or size.classes < classes:
        raise ValueError(f"{what}: not enough labelled data, rows={size.rows}, classes={size.classes}")


def needs_model(used: Column, present: Column) -> Column:
    """Rows that the dictionary left open and that have text."""
    return ~used & present


def apply_mask(missing: Column, top: Column, conf: Column, threshold: float, overwrite: bool = False) -> Column:
    """Write a prediction: the cell may be written, there is a prediction, and it is confident enough."""
    allowed = F.lit(True) if overwrite else missing
    return F.coalesce(allowed & top.isNotNull() & (conf >= threshold), F.lit(False))


def group_baseline(rows: DataFrame, keep: int | None = None) -> DataFrame:
    """(major, code, share, rank): the codes of every major group by frequency, at most ``keep`` of them where it is given."""
    per = Window.partitionBy("major")
    ranked = (
        class_counts(rows, ("major", "label")).withColumn("share", F.col("n") / F.sum("n").over(per))
        .withColumn("rank", F.row_number().over(per.orderBy(F.desc("n"), F.asc(F.col("label").cast("string")))))
        .select("major", F.col("label").cast("string").alias("code"), "share", "rank")
    )
    return ranked if keep is None else ranked.filter(F.col("rank") <= keep)


def class_weights(rows: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weights: rows / (classes * rows of the class)."""
    counts = rows.groupBy(label).agg(F.count("*").alias("n"))
    whole = Window.partitionBy(F.lit(0))  # one row per class, not per survey row
    return counts.select(label, "n", (F.sum("n").over(whole) / (F.count("*").over(whole) * F.col("n"))).alias("class_weight"))


def stratified_folds(rows: DataFrame, folds: int, seed: int, label: str = "label", id_col: str = "id") -> DataFrame:
    """Adds ``fold``: within a class, rows are dealt to folds by a hash order of their ids.

    A class may hold most of the rows, so the order is taken inside hashed slices of a class; dealing
    continues from slice to slice through the slices' sizes, which keeps fold sizes within one row per class.
    """
    ticket = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"-{seed}")))
    sliced = rows.withColumn("_ticket", ticket).withColumn("_slice", F.substring("_ticket", 1, 2))
    inside = Window.partitionBy(label, "_slice").orderBy("_ticket")
    before = Window.partitionBy(label).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(label, "_slice").agg(F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    )
    return (
        sliced.withColumn("_pos", F.row_number().over(inside)).join(offsets, [label, "_slice"])
        .withColumn("fold", F.pmod(F.col("_before") + F.col("_pos") - 1, F.lit(folds)).cast("int"))
        .drop("_ticket", "_slice", "_pos", "_before")
    )


def with_folds(counts: DataFrame, requested: int) -> DataFrame:
    """Class counts with the number of folds that the smallest class allows (0 when it has one row)."""
    whole = Window.partitionBy(F.lit(0))  # one row per class
    smallest = F.min("n").over(whole)
    folds = F.when(smallest < 2, F.lit(0)).otherwise(F.greatest(F.lit(2), F.least(F.lit(requested), smallest)))
    return counts.withColumn("folds", folds.cast("bigint"))
