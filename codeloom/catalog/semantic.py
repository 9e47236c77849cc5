"""Vectors, nearest neighbours, votes and fusion with model candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeloom.catalog.candidates import CONFIG, RANKED, TOPK, ranked, rounded
from codeloom.catalog.registry import Tables, query
from codeloom.operators import fusion, semantic
from codeloom.sources.cache import keyed, missing_documents

K = CONFIG.semantic_k

UNIT = "list_transform(embedding, lambda v: v::double / sqrt(list_inner_product(embedding::double[], embedding::double[])))"
KNN = {
    "units_v": f"select cast(vec_id as bigint) as id, {UNIT} as vec from {{embeddings}}",
    "sims_v": """
        select q.id, m.id as ex_id, round(list_inner_product(q.vec, m.vec), 10) as sim from {units_v} q cross join {units_v} m""",
    "knn_v": f"""
        select * from (select *, row_number() over (partition by id order by sim desc, ex_id) as rank from {{sims_v}}) r where rank <= {K}""",
    "votes_v": """
        select n.id, m.label, sum(greatest(0, n.sim) ** 2 * m.weight) as votes, max(greatest(0, n.sim)) as near
        from {knn_v} n join {memory} m on n.ex_id = m.ex_id group by n.id, m.label""",
    "vote_v": f"""
        select id, rank, label as code, prob, conf, max_sim from (
            select id, label, prob, max(prob) over (partition by id) as conf, max_sim,
                   row_number() over (partition by id order by round(prob, 9) desc, label) as rank
            from (select *, votes / sum(votes) over (partition by id) as prob, max(near) over (partition by id) as max_sim from {{votes_v}}) p
        ) r where rank <= {TOPK}""",
}


def neighbours(t: Tables) -> DataFrame:
    queries = t.embeddings.select(F.col("vec_id").cast("bigint").alias("id"), F.col("embedding").alias("vec"))
    return semantic.nearest(queries, t.memory.select("ex_id", "vec"), K)


@query("unit_vectors", """
    select id, i, round(v, 6) as v from (
        select cast(vec_id as bigint) as id, unnest(range(0, len(embedding))) as i, unnest(list_transform(
            list_transform(embedding, lambda e: e::double * (1 + vec_id % 3)),
            lambda e: e / sqrt(list_inner_product(list_transform(embedding, lambda x: x::double * (1 + vec_id % 3)),
                                                  list_transform(embedding, lambda x: x::double * (1 + vec_id % 3)))))) as v
        from {embeddings}) u""")
def unit_vectors(t: Tables) -> DataFrame:
    """Vectors stretched by a factor, brought back to unit length."""
    stretch = (1 + F.col("vec_id") % 3).cast("double")
    stretched = F.transform(F.col("embedding").cast("array<double>"), lambda e: e * stretch)
    unit = t.embeddings.select(F.col("vec_id").cast("bigint").alias("id"), semantic.unit_vector(stretched).alias("vec"))
    return unit.select("id", F.posexplode_outer("vec").alias("i", "v")).select("id", F.col("i").cast("bigint").alias("i"), F.round("v", 6).alias("v"))


@query("knn_topk", "select id, ex_id, cast(rank as int) as rank, round(sim, 6) as sim from {knn_v}", KNN)
def knn_topk(t: Tables) -> DataFrame:
    return rounded(neighbours(t).select("id", "ex_id", "rank", "sim"), "sim")


@query("knn_vote", """
    select id, cast(rank as int) as rank, code, round(prob, 6) as prob, round(conf, 6) as conf, round(max_sim, 6) as max_sim from {vote_v}""", KNN)
def knn_vote(t: Tables) -> DataFrame:
    return rounded(semantic.vote(neighbours(t), t.memory, TOPK), "prob", "conf", "max_sim")


FUSED = {
    **RANKED, **KNN,
    "semantic_v": """
        select id, code, prob, case when max_sim >= 0.42 and conf >= 0.25 then 0.85 * greatest(0.25, max_sim) else 0 end as factor from {vote_v}""",
    "fused_v": """
        select id, code, sum(score) as score, max(factor) as factor from (
            select id, code, prob as score, 0.0::double as factor from {ranked_v} where prob > 0
            union all select id, code, prob * factor, factor from {semantic_v} where factor > 0 and prob > 0) u
        group by id, code""",
}


@query("fuse_candidates", f"""
    select id, cast(rank as int) as rank, code, round(prob, 6) as prob from (
        select id, code, least(1, greatest(0, score / greatest(1e-9, 1.0 + max(factor) over (partition by id)))) as prob,
               row_number() over (partition by id order by round(score, 12) desc, code) as rank from {{fused_v}}) r
    where rank <= {TOPK}""", FUSED)
def fuse_candidates(t: Tables) -> DataFrame:
    votes = semantic.vote(neighbours(t), t.memory, TOPK)
    return rounded(fusion.fuse(ranked(t), votes, CONFIG, TOPK), "prob")


@query("embedding_cache_miss", """
    select cast(c.conv_id as bigint) as conv_id, cast(c.turn as bigint) as turn, sha256('hashed-tfidf' || chr(31) || c.text) as key
    from {conversations} c where c.text not in (select text from {conversations} where role = 'user' and text is not null)""")
def embedding_cache_miss(t: Tables) -> DataFrame:
    """Texts whose vectors are not cached, when the cache holds everything users have said."""
    docs = t.conversations.select("conv_id", "turn", F.col("text").alias("doc"))
    seen = t.conversations.filter(F.col("role") == "user").select(F.col("text").alias("doc"))
    cached = keyed(seen, "hashed-tfidf").select("key").distinct()
    return missing_documents(docs, cached, "hashed-tfidf").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "key")
