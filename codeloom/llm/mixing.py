"""Mix sources to target weights by Sainte-Lague apportionment of equal-token blocks. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codeloom.llm.words import WORD
from codeloom.session import stage

WEIGHTS = (5, 2, 1)
BLOCK_WORDS = 16
SHARD_WORDS = 1 << 18
SHARD_ROWS = 1 << 13
STRIDE = 2147483647  # a prime above any number of blocks in a shard, so block numbers are permuted


def hex_long(text: Column) -> Column:
    """The first 32 bits of a text's md5 as a number."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def apportion(parties: DataFrame, group: Sequence[str], votes: str, seats: str, name: str) -> DataFrame:
    """Sainte-Lague: in each group the ``seats`` go to the highest quotients votes/(2k+1); ties go to the smaller ``name``.

    With n parties and V votes the last quotient that wins lies between V/(N+n/2) and V/(N-n/2), up to the divisor of two.
    So a party surely wins the seats below that range, and only the quotients inside it, about five a party, are ranked.
    Adds the column ``won``.
    """
    whole = Window.partitionBy(*group)
    n, total = F.count(F.lit(1)).over(whole), F.sum(F.col(votes).cast("double")).over(whole)
    share = F.when(F.col("_v") > 0, F.col(votes) / F.col("_v")).otherwise(0.0)
    ranged = (parties.withColumn("_n", n).withColumn("_v", total)
              .withColumn("_low", F.greatest(F.lit(0), F.floor(share * (F.col(seats) - F.col("_n") / 2)) - 1).cast("long"))
              .withColumn("_high", F.when(F.col(votes) > 0, F.ceil(share * (F.col(seats) + F.col("_n") / 2)) + 1).otherwise(0).cast("long")))
    ranged = ranged.withColumn("_rest", F.col(seats) - F.sum("_low").over(whole))
    # the party's own row has no quotient, so parties without a seat stay
    quotients = ranged.withColumn("_k", F.explode(F.sequence(F.col("_low") - 1, F.greatest(F.col("_high"), F.col("_low")) - 1)))
    quotients = quotients.withColumn("_q", F.when(F.col("_k") >= F.col("_low"), F.col(votes) / (2 * F.col("_k") + 1)))
    ranked = quotients.withColumn("_rank", F.row_number().over(whole.orderBy(F.desc_nulls_last("_q"), name)))
    won = F.sum((F.col("_q").isNotNull() & (F.col("_rank") <= F.col("_rest"))).cast("long"))
    keep = [c for c in parties.columns if c not in (*group, name)]
    return (ranked.groupBy(*group, name)
            .agg(*[F.first(c).alias(c) for c in keep], (F.first("_low") + won).alias("won")))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """Target words of each source: 150 % of all words by weight, no source above twice its own, the excess shared again.

    Sources are weighted in code-point order, null last. Those that reach their limit are the first in order of
    limit/weight, so the whole resharing is one running sum. Windows run over one row per source.
    """
    everything = Window.partitionBy()
    ordered = Window.orderBy(F.asc_nulls_last("source"))
    named = (sizes.withColumn("place", F.row_number().over(ordered))
             .withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") - 1) % len(weights) + 1).cast("long")))
    by_limit = Window.orderBy(F.col("source_size") / F.col("weight"), "place").rowsBetween(Window.unboundedPreceding, -1)
    # words are counted in halves: the budget is 3 halves a word, the limit 4
    named = (named.withColumn("_budget", 3 * F.sum("source_size").over(everything) - F.coalesce(F.sum(4 * F.col("source_size")).over(by_limit), F.lit(0)))
             .withColumn("_weights", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_limit), F.lit(0))))
    named = named.withColumn("_full", 4 * F.col("source_size") * F.col("_weights") <= F.col("weight") * F.col("_budget"))
    left = 3 * F.sum("source_size").over(everything) - F.sum(F.when(F.col("_full"), 4 * F.col("source_size")).otherwise(0)).over(everything)
    sharing = F.sum(F.when(F.col("_full"), 0).otherwise(F.col("weight"))).over(everything)
    named = named.withColumn("_left", left).withColumn("_sharing", sharing)
    target = F.when(F.col("_full"), (2 * F.col("source_size")).cast("double")).otherwise(
        (F.col("weight") * F.col("_left")).cast("double") / (2 * F.col("_sharing")).cast("double"))
    return named.withColumn("target", target).drop("_budget", "_weights", "_full", "_left", "_sharing")


def mixed(docs: DataFrame, seed: str = "mix", weights: Sequence[int] = WEIGHTS, block_words: int = BLOCK_WORDS,
          shard_words: int = SHARD_WORDS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """How many words of each document a mix takes: columns doc_id, source, size, source_size, target, taken.

    1. A source is cut into shards by a seeded hash of the id; the number of shards follows its words and rows, so a shard
       is bounded and a hot source only has more of them.
    2. The mix has 150 % of all words in blocks of ``block_words``. Sainte-Lague gives them to sources by target, then to a
       source's shards by size: an integer quota for each shard.
    3. A shard's documents lie end to end in seeded order and are cut into blocks. Each whole pass over the shard costs its
       number of blocks; what is left of the quota takes the first blocks of a seeded permutation of the block numbers.

    So no document is taken more than twice, and reruns agree. Null text has size 0; null source is the last source; other
    columns are ignored; repeated ids are rows of their own. An empty table gives an empty result.
    """
    return dealt(docs, seed, weights, block_words, shard_words, shard_rows).select("doc_id", "source", "size", "source_size", "target", "taken")


def dealt(docs: DataFrame, seed: str, weights: Sequence[int], block_words: int, shard_words: int, shard_rows: int, more: Sequence[str] = ()) -> DataFrame:
    """The rows of ``mixed``, with the shard (place, shard), the document's place in it (draw, doc_id) and the columns ``more``.

    The first of ``more`` takes part in the draw; rows of a shard with the same draw are in order of all of them.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), *[F.col(c).cast("string") for c in more[:1]]))
    sized = stage(docs.select("doc_id", "source", *more, F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size"),
                              digest.alias("draw")), "mix-sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    targets = (source_targets(sizes, weights).withColumn("shards", F.greatest(
        F.lit(1), F.ceil(F.col("source_size") / shard_words), F.ceil(F.col("source_rows") / shard_rows)).cast("long")))
    all_words = F.sum("source_size").over(Window.partitionBy())
    targets = targets.withColumn("blocks", F.floor((3 * all_words + block_words) / (2 * block_words)).cast("long"))
    sources = stage(apportion(targets, [], "target", "blocks", "place").withColumnRenamed("won", "quota"), "mix-sources")

    placed = (sized.join(sources.select(F.col("source").alias("_source"), "source_size", "target", "place", "shards", "quota"),
                         F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
              .withColumn("shard", F.pmod(F.conv(F.substring("draw", 9, 8), 16, 10).cast("long"), F.col("shards"))))
    placed = stage(placed, "mix-placed")
    shards = placed.groupBy("place", "shard").agg(F.sum("size").alias("shard_size"), F.first("quota").alias("quota"))
    shards = apportion(shards, ["place"], "shard_size", "quota", "shard")
    shards = shards.select("place", "shard", F.ceil(F.col("shard_size") / block_words).cast("long").alias("shard_blocks"), "won")
    quota = F.least("won", 2 * F.col("shard_blocks"))
    some = F.greatest(F.lit(1), F.col("shard_blocks"))
    shards = (shards.withColumn("passes", F.floor(quota / some).cast("long")).withColumn("part_blocks", quota % some)
              .withColumn("turn", hex_long(F.concat(F.lit(f"{seed}:block:"), F.col("place").cast("string"), F.lit(":"), F.col("shard").cast("string")))))
    line = Window.partitionBy("place", "shard").orderBy("draw", "doc_id", *more)
    rows = (placed.withColumn("stop", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("start", F.col("stop") - F.col("size")).join(shards, ["place", "shard"]))
    block, zero = F.lit(block_words).cast("long"), F.lit(0).cast("long")

    def from_block(sofar: Column, b: Column) -> Column:
        inside = F.least("stop", (b + 1) * block) - F.greatest("start", b * block)
        return sofar + F.when(F.pmod(b * F.lit(STRIDE) + F.col("turn"), F.greatest(F.lit(1), F.col("shard_blocks"))) < F.col("part_blocks"), inside).otherwise(zero)

    numbers = F.sequence(F.floor(F.col("start") / block).cast("long"), F.floor((F.col("stop") - 1) / block).cast("long"))
    partly = F.when((F.col("size") > 0) & (F.col("part_blocks") > 0), F.aggregate(numbers, zero, from_block)).otherwise(zero)
    return rows.withColumn("taken", F.col("passes") * F.col("size") + partly)


def mix_rows(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """The mixed table: whole documents, 0 to 2 copies of each, whose words follow the quota of every shard.

    A document has as many copies as ``taken`` holds whole ones, and one more where the shard's running sum of the parts left over
    passes a half. The sum runs by size, so a shard's words differ from those taken by less than its longest document. Each row
    is mixed by itself: rows with null or repeated ids are drawn by their text as well.
    """
    rows = stage(docs.withColumn("_row", F.monotonically_increasing_id()).withColumn("_print", F.xxhash64("doc_id", "source", "text")), "mix-rows")
    taken = dealt(rows, seed, WEIGHTS, BLOCK_WORDS, SHARD_WORDS, SHARD_ROWS, ("_print", "_row"))
    some = F.greatest(F.col("size"), F.lit(1))
    line = Window.partitionBy("place", "shard").orderBy("size", "draw", "_print", "_row").rowsBetween(Window.unboundedPreceding, 0)
    sofar = F.sum("_part").over(line)
    taken = (taken.withColumn("_whole", F.floor(F.col("taken") / some)).withColumn("_part", F.col("taken") % some / some)
             .withColumn("_sum", sofar)
             .withColumn("_copies", (F.col("_whole") + F.floor(F.col("_sum") + 0.5) - F.floor(F.col("_sum") - F.col("_part") + 0.5)).cast("int")))
    rows = rows.drop("_print").join(taken.filter("_copies > 0").select("_row", "_copies"), "_row").drop("_row")
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).drop("_copy", "_copies")
