"""Ranking, alignment, two-level products, fusion, promotion and metrics on probability tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeloom.catalog.dictionaries import DICT_VIEWS
from codeloom.catalog.registry import Tables, query
from codeloom.catalog.scalar import LABEL_VIEWS, occupation_rows
from codeloom.config import CodingConfig
from codeloom.functions import text
from codeloom.operators import filters, fusion, metrics, ranking

TOPK = 4
CONFIG = CodingConfig()
CLASSES = [str(311000 + i) for i in range(8)]

ORDERED = "row_number() over (partition by id order by round(prob, 12) desc, code)"
RANKED = {
    "ranked_v": f"select id, code, prob, rank from (select *, {ORDERED} as rank from {{proba}}) r where rank <= {TOPK}",
}


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


def ranked(t: Tables) -> DataFrame:
    return ranking.top_k(t.proba, TOPK)


@query("topk_proba", "select id, cast(rank as int) as rank, code, round(prob, 6) as prob from {ranked_v}", RANKED)
def topk_proba(t: Tables) -> DataFrame:
    return rounded(ranked(t).select("id", "rank", "code", "prob"), "prob")


@query("ranked_wide", "select id, " + ", ".join(
    f"max(case when rank = {r} then code end) as code{r}, round(coalesce(max(case when rank = {r} then prob end), 0), 6) as prob{r}"
    for r in range(1, TOPK + 1)) + " from {ranked_v} group by id", RANKED)
def ranked_wide(t: Tables) -> DataFrame:
    return rounded(ranking.to_wide(ranked(t), TOPK), *[f"prob{r}" for r in range(1, TOPK + 1)])


TOP_GROUPS = {"top_groups_v": """
    select * from (select *, row_number() over (partition by id order by round(p_major, 12) desc, cast(major as varchar)) as rank
                   from {majors}) m where rank <= 3"""}


def top_groups_of(t: Tables) -> DataFrame:
    return ranking.top_k(t.majors, CONFIG.top_groups, prob="p_major", code="major")


@query("top_groups", "select id, major, round(p_major, 6) as p_major, cast(rank as int) as rank from {top_groups_v}", TOP_GROUPS)
def top_groups(t: Tables) -> DataFrame:
    return rounded(top_groups_of(t).select("id", "major", "p_major", "rank"), "p_major")


ALIGNED = {
    "classes_v": "select distinct code from {proba}",
    "ids_v": "select distinct id from {proba}",
    "aligned_v": """
        select i.id, c.code, coalesce(p.prob, 0) / sum(coalesce(p.prob, 0)) over (partition by i.id) as prob
        from {ids_v} i cross join {classes_v} c left join {proba} p on p.id = i.id and p.code = c.code""",
}


@query("align_classes", "select id, code, round(prob, 6) as prob from {aligned_v}", ALIGNED)
def align_classes(t: Tables) -> DataFrame:
    return rounded(fusion.align_classes(t.proba, CLASSES), "prob")


WEIGHTS = (0.81, 0.64, 0.49)


@query("ensemble_average", f"""
    select id, code, round(s / sum(s) over (partition by id), 6) as prob from (
        select id, code, sum(w * prob) as s from (
            select id, code, prob, {WEIGHTS[0]}::double as w from {{proba}}
            union all select id, code, prob, {WEIGHTS[1]}::double from {{proba_b}}
            union all select id, code, prob, {WEIGHTS[2]}::double from {{proba_c}}) u group by id, code) g""")
def ensemble_average(t: Tables) -> DataFrame:
    return rounded(fusion.ensemble_average(list(zip((t.proba, t.proba_b, t.proba_c), WEIGHTS))), "prob")


LEVELS = {
    **LABEL_VIEWS, **TOP_GROUPS,
    "products_v": """
        select w.id, w.major, w.code, m.p_major * w.p_within as prob from {top_groups_v} m
        join {within} w on m.id = w.id and m.major = w.major""",
    "baseline_v": """
        select major, cast(label as varchar) as code, count(*) / sum(count(*)) over (partition by major) as share,
               row_number() over (partition by major order by count(*) desc, cast(label as varchar)) as rank
        from {valid_soc_v} group by major, label""",
    "from_baseline_v": f"""
        select m.id, m.major, b.code, m.p_major * b.share as prob from {{top_groups_v}} m
        join {{baseline_v}} b on m.major = b.major and b.rank <= {TOPK}""",
    "merged_v": """
        select id, code, max(prob) as prob from (
            select * from {products_v} union all select * from {from_baseline_v}) u group by id, code""",
}


@query("hier_combine", "select id, major, code, round(prob, 6) as prob from {products_v}", LEVELS)
def hier_combine(t: Tables) -> DataFrame:
    return rounded(fusion.combine_levels(top_groups_of(t), t.within), "prob")


def baseline_candidates(t: Tables) -> DataFrame:
    none_modelled = t.within.select("major").distinct().filter(F.lit(False))
    return fusion.add_baselines(top_groups_of(t), none_modelled, filters.group_baseline(occupation_rows(t)), TOPK)


@query("hier_baseline", "select id, major, code, round(prob, 6) as prob from {from_baseline_v}", LEVELS)
def hier_baseline(t: Tables) -> DataFrame:
    return rounded(baseline_candidates(t), "prob")


@query("max_merge", "select id, code, round(prob, 6) as prob from {merged_v}", LEVELS)
def max_merge(t: Tables) -> DataFrame:
    products = fusion.combine_levels(top_groups_of(t), t.within)
    return rounded(fusion.max_merge(products.unionByName(baseline_candidates(t))), "prob")


# ---- chooser --------------------------------------------------------------------------------------------------

PARSED = r"""
    select id, coalesce(nullif(regexp_extract(answer, '"code"\s*:\s*"?([0-9A-Za-z\-]+)"?', 1), ''),
                        nullif(regexp_extract(answer, '\b(\d{{2,6}})\b', 1), '')) as chosen from {answers}"""
CHOICES = {
    **RANKED,
    "parsed_v": PARSED,
    "accepted_v": """
        select p.id, p.chosen from {parsed_v} p
        join {ranked_v} f on p.id = f.id and f.rank = 1 and f.prob < 0.55
        join {ranked_v} c on p.id = c.id and p.chosen = c.code""",
    "renumbered_v": """
        select r.id, r.code, a.chosen,
               row_number() over (partition by r.id order by case when r.code = a.chosen then 0 else 1 end, r.rank) as rank
        from {ranked_v} r left join {accepted_v} a on r.id = a.id""",
    "promoted_v": """
        select n.id, n.rank, n.code,
               case when n.chosen is null then o.prob when n.rank = 1 then 0.72::double else o.prob * 0.75 end as prob
        from {renumbered_v} n join {ranked_v} o on n.id = o.id and n.rank = o.rank""",
}


@query("parse_choice", "select id, chosen from {parsed_v}", CHOICES)
def parse_choice(t: Tables) -> DataFrame:
    return t.answers.select("id", ranking.parse_choice(F.col("answer")).alias("chosen"))


@query("apply_choices", "select id, chosen from {accepted_v}", CHOICES)
def apply_choices(t: Tables) -> DataFrame:
    return ranking.accept_choices(ranked(t), t.answers, CONFIG.chooser_trigger_industry, None)


@query("rerank_promote", "select id, cast(rank as int) as rank, code, round(prob, 6) as prob from {promoted_v}", CHOICES)
def rerank_promote(t: Tables) -> DataFrame:
    best = ranked(t)
    choices = ranking.accept_choices(best, t.answers, CONFIG.chooser_trigger_industry, None)
    return rounded(ranking.promote(best, choices, CONFIG.chooser_confidence, TOPK), "prob")


@query("review_queue", f"""
    select r.id, r.code as top_code, round(r.prob, 6) as conf,
           concat_ws(chr(10), case when n.title <> '' then 'qe4: ' || n.title end, case when n.employer <> '' then 'qa20: ' || lower(n.employer) end) as context
    from {{ranked_v}} r join {{normed_v}} n on r.id = n.id
    where r.rank = 1 and r.prob < 0.55 and (n.title <> '' or n.employer <> '')""", {**RANKED, **DICT_VIEWS})
def review_queue(t: Tables) -> DataFrame:
    s = t.survey
    contexts = s.select("id", text.review_context(s, ("qe4", "qa20")).alias("context"))
    queue = ranking.review_queue(ranked(t), contexts, CONFIG.chooser_trigger_industry, CONFIG.chooser_max_rows)
    return rounded(queue.select("id", "top_code", "conf", "context"), "conf")


# ---- metrics --------------------------------------------------------------------------------------------------

FOLDED = {
    **RANKED, **ALIGNED,
    "folds_v": "select id, label, cast((row_number() over (partition by label order by md5(cast(id as varchar) || '-42')) - 1) % 5 as int) as fold from {truth}",
    "scored_v": """
        select f.fold, f.label, p.code as predicted from {folds_v} f join {ranked_v} p on f.id = p.id and p.rank = 1""",
    "cells_v": "select fold, label, predicted, count(*) as n from {scored_v} group by fold, label, predicted",
    "per_class_v": """
        select fold, label, sum(hit) as tp, sum(actual) as actual, sum(guessed) as guessed from (
            select fold, label, case when label = predicted then n else 0 end as hit, n as actual, 0 as guessed from {cells_v}
            union all select fold, predicted, 0, 0, n from {cells_v}) u group by fold, label""",
    "f1_v": "select fold, avg(case when actual + guessed = 0 then 0 else 2.0 * tp / (actual + guessed) end) as macro_f1 from {per_class_v} group by fold",
    "loss_v": """
        select f.fold, avg(-ln(least(greatest(a.prob, 2.220446049250313e-16), 1 - 2.220446049250313e-16))) as log_loss
        from {folds_v} f join {aligned_v} a on f.id = a.id and f.label = a.code group by f.fold""",
}


def folded(t: Tables) -> DataFrame:
    return filters.stratified_folds(t.truth, 5, 42)


def best_guess(t: Tables) -> DataFrame:
    return folded(t).join(ranking.top_k(t.proba, 1).select("id", F.col("code").alias("predicted")), "id")


def true_probability(t: Tables) -> DataFrame:
    aligned = fusion.align_classes(t.proba, CLASSES)
    return folded(t).join(aligned.withColumnRenamed("code", "label"), ["id", "label"])


@query("macro_f1", "select fold, round(macro_f1, 6) as macro_f1 from {f1_v}", FOLDED)
def macro_f1(t: Tables) -> DataFrame:
    return rounded(metrics.macro_f1(best_guess(t)), "macro_f1")


@query("log_loss", "select fold, round(log_loss, 6) as log_loss from {loss_v}", FOLDED)
def log_loss(t: Tables) -> DataFrame:
    return rounded(metrics.log_loss(true_probability(t)), "log_loss")


def model_scores(t: Tables) -> DataFrame:
    """Scores of three models on the same folds, one row per model."""
    folds = folded(t)
    parts = []
    for name, proba in (("by_quantity", t.proba), ("by_price", t.proba_b), ("by_count", t.proba_c)):
        guesses = folds.join(ranking.top_k(proba, 1).select("id", F.col("code").alias("predicted")), "id")
        losses = folds.join(fusion.align_classes(proba, CLASSES).withColumnRenamed("code", "label"), ["id", "label"])
        parts.append(metrics.summarize(metrics.macro_f1(guesses), metrics.log_loss(losses)).select(
            F.lit(name).alias("model"), "macro_f1", "log_loss"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _score_sql(source: str) -> str:
    return f"""
    select avg(f1) as macro_f1, avg(ll) as log_loss from (
        select fold, avg(case when actual + guessed = 0 then 0 else 2.0 * tp / (actual + guessed) end) as f1 from (
            select fold, label, sum(hit) as tp, sum(actual) as actual, sum(guessed) as guessed from (
                select fold, label, case when label = predicted then n else 0 end as hit, n as actual, 0 as guessed from c_{source}
                union all select fold, predicted, 0, 0, n from c_{source}) u group by fold, label) g group by fold) a
        join (select f.fold, avg(-ln(least(greatest(coalesce(p.prob, 0), 2.220446049250313e-16), 1 - 2.220446049250313e-16))) as ll
              from {{folds_v}} f join (select distinct id from {{{source}}}) i on f.id = i.id
              left join {{{source}}} p on f.id = p.id and f.label = p.code group by f.fold) b on a.fold = b.fold"""


SCORES = {**FOLDED}
for _source in ("proba", "proba_b", "proba_c"):
    SCORES[f"cells_{_source}"] = f"""
        select f.fold, f.label, p.code as predicted, count(*) as n from {{folds_v}} f
        join (select *, {ORDERED} as rank from {{{_source}}}) p on f.id = p.id and p.rank = 1 group by f.fold, f.label, p.code"""
    SCORES[f"score_{_source}"] = _score_sql(_source).replace(f"c_{_source}", f"{{cells_{_source}}}")
SCORES["scores_v"] = """
    select 'by_quantity' as model, macro_f1, log_loss from {score_proba} union all
    select 'by_price', macro_f1, log_loss from {score_proba_b} union all
    select 'by_count', macro_f1, log_loss from {score_proba_c}"""


@query("select_models", """
    select model, cast(row_number() over (order by round(macro_f1, 12) desc, round(log_loss, 12), model) as int) as rank,
           round(macro_f1, 6) as macro_f1, round(macro_f1 ** 2, 6) as weight from {scores_v}
    order by macro_f1 desc, log_loss limit 2""", SCORES)
def select_models(t: Tables) -> DataFrame:
    return rounded(metrics.select_models(model_scores(t), 2, CONFIG.ensemble_power).select("model", "rank", "macro_f1", "weight"),
                   "macro_f1", "weight")


@query("cv_summary", """
    select round(sum(macro_f1 ** 2 * macro_f1) / sum(macro_f1 ** 2), 6) as cv_macro_f1, round(avg(log_loss), 6) as cv_log_loss
    from {scores_v}""", SCORES)
def cv_summary(t: Tables) -> DataFrame:
    scored = metrics.select_models(model_scores(t), 3, CONFIG.ensemble_power)
    return rounded(metrics.weighted_summary(scored), "cv_macro_f1", "cv_log_loss")
