"""Top-k, padding, promotion and the review queue on long candidate tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PROB_DIGITS = 12


def by_probability(partition: str | list[str], prob: str = "prob", code: str = "code"):
    """Order of candidates everywhere: higher probability, then smaller code.

    Probabilities are compared at 12 digits, so sums taken in another order still tie.
    """
    keys = [partition] if isinstance(partition, str) else partition
    return Window.partitionBy(*keys).orderBy(F.desc(F.round(prob, PROB_DIGITS)), F.asc(F.col(code).cast("string")))


def top_k(candidates: DataFrame, k: int, id_col: str = "id", prob: str = "prob", code: str = "code") -> DataFrame:
    """The k best candidates per row with their rank. Spark limits groups before the shuffle."""
    return candidates.withColumn("rank", F.row_number().over(by_probability(id_col, prob, code))).filter(F.col("rank") <= max(1, k))


def to_wide(ranked: DataFrame, k: int, id_col: str = "id") -> DataFrame:
    """One row per id with code1..codek and prob1..probk; absent ranks are null codes with probability 0."""
    columns = []
    for r in range(1, k + 1):
        columns.append(F.max(F.when(F.col("rank") == r, F.col("code"))).alias(f"code{r}"))
        columns.append(F.coalesce(F.max(F.when(F.col("rank") == r, F.col("prob"))), F.lit(0.0)).alias(f"prob{r}"))
    return ranked.groupBy(id_col).agg(*columns)


def review_queue(ranked: DataFrame, contexts: DataFrame, trigger: float, limit: int | None, id_col: str = "id") -> DataFrame:
    """The rows, or the first ``limit`` of them in id order, that have candidates, context and too little confidence."""
    first = ranked.filter((F.col("rank") == 1) & F.col("code").isNotNull()).select(
        id_col, F.col("code").alias("top_code"), F.col("prob").alias("conf"))
    doubtful = first.filter(F.col("conf") < trigger).join(contexts.filter(F.col("context") != ""), id_col)
    return doubtful if limit is None else doubtful.orderBy(id_col).limit(limit)


def parse_choice(answer: Column) -> Column:
    """The code in a chooser's answer: a JSON-like code field, else the first stand-alone 2-6 digit number."""
    named = F.regexp_extract(answer, r'"code"\s*:\s*"?([0-9A-Za-z\-]+)"?', 1)
    bare = F.regexp_extract(answer, r"\b(\d{2,6})\b", 1)
    return F.coalesce(F.nullif(named, F.lit("")), F.nullif(bare, F.lit("")))


def accept_choices(
    ranked: DataFrame,
    answers: DataFrame,
    trigger: float,
    limit: int | None,
    free_code: bool = False,
    id_col: str = "id",
) -> DataFrame:
    """Valid choices (id, chosen): low-confidence rows whose parsed code is one of their candidates.

    ``limit`` counts accepted choices in id order, as the reviewers' budget does.
    """
    candidates = ranked.filter(F.col("code").isNotNull()).groupBy(id_col).agg(
        F.collect_set(F.col("code").cast("string")).alias("codes"),
        F.max(F.when(F.col("rank") == 1, F.col("prob"))).alias("conf"))
    parsed = answers.select(id_col, parse_choice(F.col("answer")).alias("chosen")).filter(F.col("chosen").isNotNull())
    doubtful = candidates.filter(F.col("conf") < trigger).join(parsed, id_col)
    accepted = doubtful if free_code else doubtful.filter(F.array_contains("codes", F.col("chosen")))
    accepted = accepted.select(id_col, "chosen")
    return accepted if limit is None else accepted.orderBy(id_col).limit(limit)


def promote(ranked: DataFrame, choices: DataFrame, confidence: float, k: int, id_col: str = "id") -> DataFrame:
    """Put each chosen code first with a fixed confidence; the others keep their order.

    Probabilities stay with their position, lowered to three quarters, and do not move with their code.
    """
    codes = ranked.filter(F.col("code").isNotNull()).groupBy(id_col).agg(
        F.array_sort(F.collect_list(F.struct("rank", F.col("code").cast("string").alias("code"), "prob"))).alias("old"))
    joined = codes.join(choices, id_col, "left")
    others = F.transform(F.filter("old", lambda e: e["code"] != F.col("chosen")), lambda e: e["code"])
    reordered = F.concat(F.array("chosen"), others)
    old_codes = F.transform("old", lambda e: e["code"])
    new = F.when(F.col("chosen").isNull(), old_codes).otherwise(F.slice(reordered, 1, k))
    positions = joined.select(id_col, "chosen", "old", F.posexplode_outer(new).alias("pos", "code"))
    old_prob = F.coalesce(F.get("old", F.col("pos"))["prob"], F.lit(0.0))
    prob = (
        F.when(F.col("chosen").isNull(), old_prob).when(F.col("pos") == 0, F.lit(confidence))
        .otherwise(F.greatest(F.lit(0.0), old_prob * 0.75))
    )
    return positions.select(id_col, (F.col("pos") + 1).alias("rank"), "code", prob.alias("prob"))
