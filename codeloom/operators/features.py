"""Text, category and number features as long (id, term, weight) tables.

The long form has no driver-side vocabulary and no row-by-class matrices; terms are strings with a block
prefix, so the blocks are concatenated by a union. ``to_vectors`` turns it into ML vectors when needed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeloom.config import CodingConfig
from codeloom.functions.codes import code_or_missing, number_of
from codeloom.operators.lookup import lookup_join
from codeloom.session import stage

WORD, CHAR, CATEGORY, NUMBER, LATENT = "w:", "c:", "k:", "n:", "s:"
# The widest block whose products one pass sums, the rows that it multiplies at a time, and the tasks that add the sums.
GRAM_DIMS, GRAM_ROWS, GRAM_TASKS = 1024, 4096, 8
SVD_FLOOR = 1e-9  # a component's least share of the first singular value, as in Spark's decomposition
TASK_CHARS = 1 << 19  # characters of documents per task that counts their terms


def word_terms(doc: Column) -> Column:
    """Words of two or more word characters, and pairs of neighbouring words."""
    words = F.regexp_extract_all(doc, F.lit(r"\w{2,}"), F.lit(0))
    return F.flatten(F.transform(F.array(words), lambda w: F.concat(w, F.when(
        F.size(w) > 1, F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w) - 1),
                                  lambda a, b: F.concat(a, F.lit(" "), b))).otherwise(F.array().cast("array<string>")))))


def word_rows(docs: DataFrame) -> DataFrame:
    """(id, copies, term) for every word and word pair of (id, doc, copies) rows."""
    return docs.select("id", "copies", F.explode_outer(word_terms(F.col("doc"))).alias("term")).filter(F.col("term").isNotNull())


def char_rows(docs: DataFrame) -> DataFrame:
    """(id, copies, term): character 3-, 4- and 5-grams inside words padded with one space on both sides.

    Words, start positions and sizes are unfolded by generators one after the other, all in generated code.
    """
    padded = F.concat(F.lit(" "), F.col("word"), F.lit(" "))
    starts = (
        docs.select("id", "copies", F.explode_outer(F.split("doc", r"\s+")).alias("word"))
        .filter(F.length("word") > 0)
        .select("id", "copies", padded.alias("w"), (F.length("word") + 2).alias("n"))
        .select("id", "copies", "w", "n", F.explode_outer(F.sequence(F.lit(1), F.col("n") - 2)).alias("i"))
    )
    grams = F.array(
        F.substring("w", F.col("i"), F.lit(3)),
        F.when(F.col("i") + 3 <= F.col("n"), F.substring("w", F.col("i"), F.lit(4))),
        F.when(F.col("i") + 4 <= F.col("n"), F.substring("w", F.col("i"), F.lit(5))))
    return starts.select("id", "copies", F.explode_outer(grams).alias("term")).filter(F.col("term").isNotNull())


TERM_ROWS = {WORD: word_rows, CHAR: char_rows}


def term_tasks(docs: DataFrame) -> int:
    """Number of tasks that share the documents' terms: it follows their characters, so a task's terms stay bounded."""
    return max(1, -(-int(docs.agg(F.sum(F.length("doc")).alias("n")).first()["n"] or 0) // TASK_CHARS))


def term_counts(docs: DataFrame, block: str, tasks: int | None = None) -> DataFrame:
    """(id, term, tf, copies) from (id, doc, copies): how often each term occurs in each document.

    The documents are dealt by id before their terms are unfolded. Terms are a hundred times their documents, and all
    that is grouped by id (counts, lengths, vectors) then stays where it is.
    """
    dealt = docs.select("id", "doc", "copies").repartition(term_tasks(docs) if tasks is None else tasks, "id")
    return TERM_ROWS[block](dealt).groupBy("id", "term").agg(F.count("*").alias("tf"), F.max("copies").alias("copies"))


def document_total(docs: DataFrame) -> int:
    return int(docs.agg(F.sum("copies").alias("n")).first()["n"] or 0)


def build_vocabulary(counts: DataFrame, total: int, min_df: int, max_share: float, max_terms: int | None = None) -> DataFrame:
    """(term, df, cf, idf): terms in enough but not too many documents; the most frequent ``max_terms`` where a limit is given."""
    allowed = (
        counts.groupBy("term").agg(F.sum("copies").alias("df"), F.sum(F.col("tf") * F.col("copies")).alias("cf"))
        .filter((F.col("df") >= min_df) & (F.col("df") <= max_share * total))
    )
    kept = allowed if max_terms is None else allowed.orderBy(F.desc("cf"), F.asc("term")).limit(max_terms)
    return kept.withColumn("idf", F.log((1.0 + total) / (1.0 + F.col("df"))) + 1.0)


def tfidf(counts: DataFrame, vocabulary: DataFrame, broadcast: bool | None = None) -> DataFrame:
    """(id, term, weight): sublinear term frequency times smooth idf, unit length per document."""
    raw = lookup_join(counts, vocabulary.select("term", "idf"), ("term",), spread="id", how="inner", broadcast=broadcast)
    raw = raw.withColumn("raw", (1.0 + F.log("tf")) * F.col("idf"))
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("id")))
    return raw.select("id", "term", (F.col("raw") / length).alias("weight"))


def category_terms(df: DataFrame, names: Sequence[str], id_col: str = "id") -> DataFrame:
    """One-hot in long form: (id, term = column=value, weight = 1)."""
    values = [F.concat(F.lit(f"{name}="), code_or_missing(df, name)) for name in names]
    if not values:
        return df.select(id_col, F.lit("").alias("term"), F.lit(1.0).alias("weight")).filter(F.lit(False))
    return df.select(F.col(id_col).alias("id"), F.explode_outer(F.array(*values)).alias("term"), F.lit(1.0).alias("weight"))


@dataclass(frozen=True)
class NumberScale:
    name: str
    median: float
    mean: float
    std: float


def fit_numbers(df: DataFrame, names: Sequence[str], weight: str | None = None) -> list[NumberScale]:
    """Median of the known values, then mean and population deviation of the filled column.

    ``weight`` names a column of copies, for tables that hold distinct answers.
    """
    scales = []
    copies = F.col(weight) if weight else F.lit(1)
    for name in names:
        value = number_of(df, name)
        numbers = df.select(value.alias("x"), copies.cast("bigint").alias("w"))
        median = numbers.agg(F.percentile("x", F.lit(0.5), F.col("w")).alias("m")).first()["m"]
        median = float(median) if median is not None else 0.0
        filled = F.coalesce("x", F.lit(median))
        stats = numbers.agg(
            F.sum("w").alias("n"), F.sum(filled * F.col("w")).alias("s"), F.sum(filled * filled * F.col("w")).alias("q")).first()
        n = float(stats["n"] or 0) or 1.0
        mean = float(stats["s"] or 0.0) / n
        variance = max(0.0, float(stats["q"] or 0.0) / n - mean * mean)
        scales.append(NumberScale(name, median, mean, variance ** 0.5))
    return scales


def scaled(df: DataFrame, scale: NumberScale) -> Column:
    std = scale.std if scale.std > 0 else 1.0
    return (F.coalesce(number_of(df, scale.name), F.lit(scale.median)) - scale.mean) / std


def unit_documents(weights: DataFrame, dims: int) -> DataFrame:
    """Dense unit vectors (id, vec) from weighted terms, by hashing terms with a sign into ``dims`` slots.

    Stands in for an external text encoder; any table with (id, vec) can be used instead.
    """
    hashed = F.xxhash64("term")
    sign = F.when(F.shiftright(hashed, 32) % 2 == 0, 1.0).otherwise(-1.0)
    slots = (
        weights.groupBy("id", F.pmod(hashed, F.lit(dims)).cast("int").alias("slot"))
        .agg(F.sum(F.col("weight") * sign).alias("v"))
    )
    packed = slots.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("slot", "v"))).alias("m"),
                                     F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"))
    filled = F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda i: F.coalesce(
        F.try_element_at("m", i), F.lit(0.0)) / F.when(F.col("norm") > 0, F.col("norm")).otherwise(F.lit(1.0)))
    return packed.select("id", filled.alias("vec"))


def text_block(weights: DataFrame) -> DataFrame:
    """The word and character terms of a feature table."""
    return weights.filter(F.substring("term", 1, 2).isin(WORD, CHAR))


def hashed_vectors(weights: DataFrame, dims: int) -> DataFrame:
    """Sparse ML vectors (id, features) by hashing terms into ``dims`` slots; no vocabulary is collected."""
    slots = weights.groupBy("id", F.pmod(F.xxhash64("term"), F.lit(dims)).cast("int").alias("slot")).agg(F.sum("weight").alias("v"))
    return _pack(slots, dims)


def indexed_vectors(weights: DataFrame, slots: DataFrame, size: int, broadcast: bool | None = None,
                    ids: DataFrame | None = None) -> DataFrame:
    """Sparse ML vectors (id, features) with one slot per vocabulary term. ``slots`` has (term, slot).

    Rows of ``ids`` without any known term get an empty vector; without ``ids`` they are left out.
    """
    joined = lookup_join(weights, slots, ("term",), spread="id", how="inner", broadcast=broadcast)
    return _pack(joined.select("id", "slot", F.col("weight").alias("v")), size, ids)


def slot_table(weights: DataFrame) -> DataFrame:
    """(term, slot) for all terms of a feature table or of ``FeaturePlan.terms``, in the order of the terms.

    Terms are numbered inside the ranges given by their first characters; only the ranges' sizes are summed in one task.
    """
    terms = stage(weights.select("term").distinct().withColumn("_range", F.substring("term", 1, 5)), "terms-by-range")
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = terms.groupBy("_range").agg(F.count("*").alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy("term"))
    numbered = terms.withColumn("_pos", inside).join(offsets, "_range")
    return stage(numbered.select("term", (F.col("_before") + F.col("_pos") - 1).cast("int").alias("slot")), "slots")


def _pack(slots: DataFrame, size: int, ids: DataFrame | None = None) -> DataFrame:
    ordered = slots.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("slot", "v"))).alias("e")).select(
        "id", F.col("e.slot").alias("indices"), F.col("e.v").alias("values"))
    if ids is not None:
        ordered = ids.select("id").distinct().join(ordered, "id", "left").select(
            "id", F.coalesce("indices", F.array().cast("array<int>")).alias("indices"), F.coalesce("values", F.array().cast("array<double>")).alias("values"))
    schema = T.StructType([ordered.schema["id"], T.StructField("features", VectorUDT())])

    def to_udt(batches):
        for batch in batches:
            n = batch.num_rows
            vector = pa.StructArray.from_arrays(
                [pa.array(np.zeros(n, dtype=np.int8)), pa.array(np.full(n, size, dtype=np.int32)),
                 batch.column("indices"), batch.column("values")], names=["type", "size", "indices", "values"])
            yield pa.RecordBatch.from_arrays([batch.column("id"), vector], names=["id", "features"])

    return ordered.mapInArrow(to_udt, schema)


def gram_matrix(vectors: DataFrame, dims: int) -> np.ndarray:
    """Transposed matrix times matrix of sparse rows, in one pass: a task returns its own sum, dims x dims doubles."""
    def summed(batches):
        total = np.zeros((dims, dims))
        for batch in batches:
            f = batch.column("f")
            indices, values = f.field("indices"), f.field("values")
            bounds = indices.offsets.to_numpy()
            for at in range(0, batch.num_rows, GRAM_ROWS):
                to = min(at + GRAM_ROWS, batch.num_rows)
                rows = np.zeros((to - at, dims))
                low, high = bounds[at] - bounds[0], bounds[to] - bounds[0]
                rows[np.repeat(np.arange(to - at), np.diff(bounds[at:to + 1])), indices.flatten().to_numpy()[low:high]] = values.flatten().to_numpy()[low:high]
                total += rows.T @ rows
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])

    def added(batches):
        total = np.zeros((dims, dims))
        for batch in batches:
            for packed in batch.column("total").to_pylist():
                total += np.frombuffer(packed).reshape(dims, dims)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])

    sums = vectors.select(F.col("features").alias("f")).mapInArrow(summed, "total binary")
    few = sums.repartition(GRAM_TASKS).mapInArrow(added, "total binary")  # the driver gets this many matrices, however many tasks there are
    return sum((np.frombuffer(r["total"]).reshape(dims, dims) for r in few.collect()), np.zeros((dims, dims)))


def latent_basis(vectors: DataFrame, components: int) -> np.ndarray:
    """Right singular vectors of a hashed feature block, as a (dims, components) matrix.

    One pass over the distributed rows sums their products where the block has at most ``GRAM_DIMS`` columns, and the basis is that
    matrix' leading eigenvectors; wider blocks are decomposed by Spark's iteration, which reads the rows some dozens of times.
    Each component's sign is fixed by its largest entry.
    """
    first = vectors.select("features").first()
    if first is not None and first["features"].size <= GRAM_DIMS:
        values, basis = np.linalg.eigh(gram_matrix(vectors, first["features"].size))
        strength = np.sqrt(np.maximum(values[::-1], 0.0))
        basis = basis[:, ::-1][:, :components][:, strength[:components] > SVD_FLOOR * strength[0]]
    else:
        from pyspark.mllib.linalg.distributed import RowMatrix
        from pyspark.mllib.util import MLUtils

        rows = MLUtils.convertVectorColumnsFromML(vectors.select("features"), "features")
        basis = RowMatrix(rows).computeSVD(components, computeU=False).V.toArray()
    signs = np.sign(basis[np.abs(basis).argmax(axis=0), np.arange(basis.shape[1])])
    return basis * np.where(signs == 0, 1.0, signs)


def latent_features(vectors: DataFrame, basis: np.ndarray) -> DataFrame:
    """(id, latent array<double>): sparse rows times the basis, per Arrow batch."""
    id_type = vectors.schema["id"].dataType.simpleString()
    components = basis.shape[1]
    flat = vectors.select("id", F.col("features").alias("f"))

    def project(batches):
        for batch in batches:
            f = batch.column("f")
            indices, values = f.field("indices"), f.field("values")
            sizes = np.diff(indices.offsets.to_numpy())
            row = np.repeat(np.arange(batch.num_rows), sizes)
            out = np.zeros((batch.num_rows, components))
            np.add.at(out, row, basis[indices.flatten().to_numpy()] * values.flatten().to_numpy()[:, None])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.FixedSizeListArray.from_arrays(pa.array(out.ravel()), components).cast(pa.list_(pa.float64()))],
                names=["id", "latent"])

    return flat.mapInArrow(project, f"id {id_type}, latent array<double>")


@dataclass
class FeaturePlan:
    """A fitted featurizer: vocabulary, known categories and number scales."""

    vocabulary: DataFrame  # block, term, idf
    categories: DataFrame  # term
    scales: list[NumberScale]
    category_names: tuple[str, ...]
    size: int

    def text_weights(self, answers: DataFrame, tasks: int | None = None) -> DataFrame:
        """(id, term, weight) of the text block for (id, doc, copies) rows."""
        parts = []
        tasks = term_tasks(answers) if tasks is None else tasks
        for block in (WORD, CHAR):
            known = self.vocabulary.filter(F.col("block") == block)
            counts = term_counts(answers, block, tasks)
            parts.append(tfidf(counts, known).withColumn("term", F.concat(F.lit(block), "term")))
        return parts[0].unionByName(parts[1])

    def nonnegative(self, answers: DataFrame, text: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
        """Text and one-hot blocks: the input of naive Bayes. With ``tasks`` all blocks are dealt alike by id."""
        text = self.text_weights(answers, tasks) if text is None else text
        dealt = answers if tasks is None else answers.repartition(tasks, "id")
        hot = lookup_join(category_terms(dealt, self.category_names), self.categories, ("term",), spread="id", how="inner")
        return text.unionByName(hot.select("id", F.concat(F.lit(CATEGORY), "term").alias("term"), "weight"))

    def numbers(self, answers: DataFrame) -> DataFrame:
        if not self.scales:
            return answers.select("id", F.lit("").alias("term"), F.lit(0.0).alias("weight")).filter(F.lit(False))
        pairs = F.array(*[F.struct(F.lit(NUMBER + s.name).alias("term"), scaled(answers, s).alias("weight")) for s in self.scales])
        return answers.select("id", F.explode_outer(pairs).alias("p")).select("id", "p.term", "p.weight")

    def terms(self) -> DataFrame:
        """(term): the terms of all blocks. Those of the answers that the plan was fitted on, without unfolding their texts again."""
        text = self.vocabulary.select(F.concat("block", "term").alias("term"))
        hot = self.categories.select(F.concat(F.lit(CATEGORY), "term").alias("term"))
        spark = self.vocabulary.sparkSession
        numbers = spark.createDataFrame([(NUMBER + s.name,) for s in self.scales], "term string")  # one row per number column
        return text.unionByName(hot).unionByName(numbers)

    def all_blocks(self, answers: DataFrame) -> DataFrame:
        """All blocks, dealt alike by id, so that their vectors need no further shuffle."""
        tasks = term_tasks(answers)
        return self.nonnegative(answers, tasks=tasks).unionByName(self.numbers(answers.repartition(tasks, "id")))


def fit_features(answers: DataFrame, category_names: Sequence[str], number_names: Sequence[str], config: CodingConfig) -> FeaturePlan:
    """Fit all blocks on (id, doc, copies, categories..., numbers...) rows of distinct answers."""
    total = document_total(answers)
    docs = answers.select("id", "doc", "copies")
    tasks = term_tasks(docs)
    blocks = []
    for block, min_df, cap in (
        (WORD, config.word_min_count, config.max_word_terms), (CHAR, config.char_min_count, config.max_char_terms),
    ):
        vocabulary = build_vocabulary(term_counts(docs, block, tasks), total, min_df, config.doc_prop_max, cap)
        blocks.append(vocabulary.select(F.lit(block).alias("block"), "term", "idf"))
    vocabulary = stage(blocks[0].unionByName(blocks[1]), "vocabulary")
    known = tuple(n for n in category_names if n in answers.columns)
    categories = stage(category_terms(answers, known).select("term").distinct(), "categories")
    numbers = [n for n in number_names if n in answers.columns]
    scales = fit_numbers(answers, numbers, "copies")
    size = vocabulary.count() + categories.count() + len(scales)
    return FeaturePlan(vocabulary, categories, scales, known, size)
