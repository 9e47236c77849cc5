"""Dictionaries, lookups, fuzzy matching, routing and write-back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeloom.catalog import oracle as O
from codeloom.catalog.registry import Tables, query
from codeloom.catalog.scalar import COLS, LABEL_VIEWS, industry_rows, occupation_rows
from codeloom.functions import codes, text
from codeloom.operators import dictionary, filters, fuzzy, writeback
from codeloom.session import stage

MIN_COUNT, PURITY, TOPK = 5, 0.90, 4
FUZZY_THRESHOLD = 80

# ---- comparison SQL -------------------------------------------------------------------------------------------

NORMED = f"""
    select id, {O.key_part('qa20')} as employer, {O.key_part('qe4')} as title_part, {O.norm('qe4')} as title,
           {O.key_part('qe1oth')} as industry_other, {O.key_part('qe8aoth')} as selfemp_other,
           {O.code_number('qa20a')} as industry_code, coalesce({O.code_number('qa20a')}, 'MISSING') as naics, qa20a, qe4ar
    from {{survey}}"""
KEYS = """
    select id, 1 as no, 'employer' as spec, employer as key, industry_code from {normed_v} where employer <> 'MISSING'
    union all select id, 2, 'employer_title', employer || '||' || title_part, industry_code from {normed_v}
        where employer <> 'MISSING' or title_part <> 'MISSING'
    union all select id, 3, 'industry_other', industry_other, industry_code from {normed_v} where industry_other <> 'MISSING'
    union all select id, 4, 'selfemp_other', selfemp_other, industry_code from {normed_v} where selfemp_other <> 'MISSING'
    union all select id, 5, 'title_industry', title_part || '||' || industry_other, industry_code from {normed_v}
        where title_part <> 'MISSING' or industry_other <> 'MISSING'"""


def ranked_sql(source: str, keys: str, label: str) -> str:
    return f"""
    select {keys}, {label} as label, count(*) as label_n, sum(count(*)) over (partition by {keys}) as n,
           row_number() over (partition by {keys} order by count(*) desc, {label}) as rk
    from {source} group by {keys}, {label}"""


def entries_sql(ranked: str, keys: str, cast_label: str = "") -> str:
    alternates = ", ".join(
        f"max(case when rk = {r} then label end) as alt{r - 1}, max(case when rk = {r} then label_n / n end) as alt{r - 1}_prob"
        for r in range(2, 7))
    return f"""
    select {keys}, max(case when rk = 1 then label end) as top, max(case when rk = 1 then label_n / n end) as top_prob,
           cast(max(n) as bigint) as n, {alternates}
    from {ranked} group by {keys} having max(n) >= {MIN_COUNT}"""


TITLE_ROWS = f"""
    select n.title, n.naics, v.label from {{normed_v}} n join {{valid_soc_v}} v on n.id = v.id where n.title <> ''
    union all
    select n.title, 'MISSING', v.label from {{normed_v}} n join {{valid_soc_v}} v on n.id = v.id where n.title <> ''"""

DICT_VIEWS = {
    **LABEL_VIEWS,
    "normed_v": NORMED,
    "keys_v": KEYS,
    "employer_ranked_v": ranked_sql(f"(select * from {{keys_v}} where no = 1 and not {O.code_missing('industry_code')}) k", "spec, key", "industry_code"),
    "key_ranked_v": ranked_sql(f"(select * from {{keys_v}} where not {O.code_missing('industry_code')}) k", "spec, key", "industry_code"),
    "employer_dict_v": entries_sql("{employer_ranked_v}", "spec, key"),
    "key_dict_v": entries_sql("{key_ranked_v}", "spec, key"),
    "title_rows_v": TITLE_ROWS,
    "title_ranked_v": ranked_sql("{title_rows_v}", "title, naics", "label"),
    "title_dict_v": entries_sql("{title_ranked_v}", "title, naics"),
}
ALTS = ", ".join(f"alt{i}, round(alt{i}_prob, 6) as alt{i}_prob" for i in range(1, 6))
FIRST_ALTS = ", ".join(f"alt{i}" for i in range(1, TOPK))


def flat_entries(entries: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    alternates = []
    for i in range(dictionary.ALTERNATES):
        item = F.get("alts", F.lit(i))
        alternates += [item["code"].alias(f"alt{i + 1}"), F.round(item["prob"], 6).alias(f"alt{i + 1}_prob")]
    return entries.select(*keys, "top", F.round("top_prob", 6).alias("top_prob"), "n", *alternates)


def flat_decision(df: DataFrame, *keep: str) -> DataFrame:
    alts = [F.get("alts", F.lit(i))["code"].alias(f"alt{i + 1}") for i in range(TOPK - 1)]
    return df.select("id", *keep, "pred", F.round("conf", 6).alias("conf"), "used", *alts)


def industry_dictionary(t: Tables, specs=COLS.key_specs) -> DataFrame:
    rows = industry_rows(t)
    return dictionary.build_dictionary(rows, F.col("label"), specs, MIN_COUNT)


def title_dictionary(t: Tables) -> DataFrame:
    return dictionary.build_title_dictionary(occupation_rows(t), F.col("label"), "qe4", "qa20a", MIN_COUNT)


# ---- dictionaries ---------------------------------------------------------------------------------------------

@query("dict_build", f"select spec, key, top, round(top_prob, 6) as top_prob, n, {ALTS} from {{employer_dict_v}}", DICT_VIEWS)
def dict_build(t: Tables) -> DataFrame:
    return flat_entries(industry_dictionary(t, COLS.key_specs[:1]), ("spec", "key"))


@query("dict_build_multi", f"select spec, key, top, round(top_prob, 6) as top_prob, n, {ALTS} from {{key_dict_v}}", DICT_VIEWS)
def dict_build_multi(t: Tables) -> DataFrame:
    return flat_entries(industry_dictionary(t), ("spec", "key"))


@query("soc_dict_build", f"select title, naics, top, round(top_prob, 6) as top_prob, n, {ALTS} from {{title_dict_v}}", DICT_VIEWS)
def soc_dict_build(t: Tables) -> DataFrame:
    return flat_entries(title_dictionary(t), ("title", "naics"))


@query("fuzzy_dict", f"select title, naics, top, round(top_prob, 6) as top_prob, n from {{title_dict_v}} where top_prob >= {PURITY}", DICT_VIEWS)
def fuzzy_dict(t: Tables) -> DataFrame:
    entries = fuzzy.fuzzy_entries(title_dictionary(t), MIN_COUNT, PURITY)
    return entries.select("title", "naics", "top", F.round("top_prob", 6).alias("top_prob"), "n")


@query("fuzzy_cap", f"""
    select naics, title, n, cast(bucket_rank as int) as bucket_rank from (
        select *, row_number() over (partition by naics order by n desc, title) as bucket_rank
        from {{title_dict_v}} where top_prob >= {PURITY}) r where bucket_rank <= 50""", DICT_VIEWS)
def fuzzy_cap(t: Tables) -> DataFrame:
    """A report of each bucket's 50 most frequent titles; matching itself uses all of them."""
    entries = fuzzy.fuzzy_entries(title_dictionary(t), MIN_COUNT, PURITY)
    return fuzzy.rank_in_bucket(entries, 50).select("naics", "title", "n", "bucket_rank")


# ---- lookups --------------------------------------------------------------------------------------------------

def cascade_sql(dictionary_view: str, where: str) -> str:
    return f"""
    select s.id, h.top as pred, round(coalesce(h.top_prob, 0), 6) as conf, h.top is not null as used, {FIRST_ALTS}
    from {{normed_v}} s left join (
        select k.id, d.*, row_number() over (partition by k.id order by k.no) as pick
        from {{keys_v}} k join {{{dictionary_view}}} d on k.spec = d.spec and k.key = d.key
        where d.n >= {MIN_COUNT} and d.top_prob >= {PURITY} and {where}) h on s.id = h.id and h.pick = 1"""


@query("dict_lookup", cascade_sql("key_dict_v", "k.no = 1"), DICT_VIEWS)
def dict_lookup(t: Tables) -> DataFrame:
    entries = stage(industry_dictionary(t, COLS.key_specs[:1]), "dict")
    return flat_decision(dictionary.lookup_cascade(t.survey, entries, COLS.key_specs[:1], PURITY, MIN_COUNT, TOPK))


@query("dict_cascade", cascade_sql("key_dict_v", "true"), DICT_VIEWS)
def dict_cascade(t: Tables) -> DataFrame:
    entries = stage(industry_dictionary(t), "dict")
    return flat_decision(dictionary.lookup_cascade(t.survey, entries, COLS.key_specs, PURITY, MIN_COUNT, TOPK))


TITLE_LOOKUP = f"""
    select id, title, naics, case when ok then top end as pred, case when ok then top_prob else 0 end as conf, ok as used,
           {', '.join(f'case when ok then alt{i} end as alt{i}' for i in range(1, TOPK))}
    from (
        select s.id, s.title, s.naics, coalesce(p.top, o.top) as top, coalesce(p.top_prob, o.top_prob) as top_prob,
               coalesce(coalesce(p.top_prob, o.top_prob) >= {PURITY}, false) as ok,
               {', '.join(f'case when p.top is not null then p.alt{i} else o.alt{i} end as alt{i}' for i in range(1, TOPK))}
        from {{normed_v}} s left join {{title_dict_v}} p on s.title = p.title and s.naics = p.naics
        left join {{title_dict_v}} o on s.title = o.title and o.naics = 'MISSING') j"""
TITLE_VIEWS = {**DICT_VIEWS, "title_lookup_v": TITLE_LOOKUP}


def looked_up_titles(t: Tables, entries: DataFrame | None = None) -> DataFrame:
    entries = stage(title_dictionary(t), "titles") if entries is None else entries
    return dictionary.lookup_title(t.survey, entries, "qe4", "qa20a", PURITY, MIN_COUNT, TOPK)


@query("soc_dict_lookup", f"select id, title, naics, pred, round(conf, 6) as conf, used, {FIRST_ALTS} from {{title_lookup_v}}", TITLE_VIEWS)
def soc_dict_lookup(t: Tables) -> DataFrame:
    return flat_decision(looked_up_titles(t), "title", "naics")


FUZZY_VIEWS = {
    **TITLE_VIEWS,
    "fuzzy_dict_v": f"select * from {{title_dict_v}} where top_prob >= {PURITY}",
    "fuzzy_open_v": """
        select l.id, l.title, case when l.naics in (select naics from {fuzzy_dict_v}) then l.naics else 'MISSING' end as bucket
        from {title_lookup_v} l where not l.used and l.title <> ''""",
    "fuzzy_pairs_v": """
        select q.bucket, q.title as query, c.title as choice, c.n, c.top, c.top_prob, c.alt1, c.alt2, c.alt3,
               array_to_string(list_sort(string_split(q.title, ' ')), ' ') as a,
               array_to_string(list_sort(string_split(c.title, ' ')), ' ') as b
        from (select distinct bucket, title from {fuzzy_open_v}) q join {fuzzy_dict_v} c on q.bucket = c.naics""",
    "fuzzy_close_v": f"""
        select distinct a, b from {{fuzzy_pairs_v}}
        where 100 * abs(length(a) - length(b)) <= {100 - FUZZY_THRESHOLD} * (length(a) + length(b))
          and 100 * levenshtein(a, b) <= {100 - FUZZY_THRESHOLD} * (length(a) + length(b))""",
    # longest common subsequence: one dynamic programming row per character of a
    "lcs_v": """
        select a, b, 0 as i, list_transform(range(0, length(b) + 1), lambda x: 0) as scores from {fuzzy_close_v}
        union all
        select a, b, i + 1, list_reduce(range(1, length(b) + 1), lambda acc, j: list_append(acc,
            case when substring(a, cast(i + 1 as bigint), 1) = substring(b, j, 1) then scores[j] + 1
                 else greatest(scores[j + 1], acc[len(acc)]) end), [0::bigint])
        from lcs_v where i < length(a)""",
    "fuzzy_best_v": f"""
        select * from (
            select p.*, 200.0 * l.scores[len(l.scores)] / (length(p.a) + length(p.b)) as similarity,
                   row_number() over (partition by p.bucket, p.query
                       order by 200.0 * l.scores[len(l.scores)] / (length(p.a) + length(p.b)) desc, n desc, choice) as pick
            from {{fuzzy_pairs_v}} p join {{lcs_v}} l on p.a = l.a and p.b = l.b and l.i = length(l.a)
            where 200 * l.scores[len(l.scores)] >= {FUZZY_THRESHOLD} * (length(p.a) + length(p.b))) r where pick = 1""",
}


@query("fuzzy_match", f"""
    select o.id, o.title, o.naics, case when o.used then o.pred else f.top end as pred,
           round(case when o.used then o.conf when f.top is null then 0 else f.top_prob * f.similarity / 100 end, 6) as conf,
           (o.used or f.top is not null) as used, round(f.similarity, 6) as similarity, f.choice as matched_title,
           {', '.join(f'case when o.used then o.alt{i} else f.alt{i} end as alt{i}' for i in range(1, TOPK))}
    from {{title_lookup_v}} o left join {{fuzzy_open_v}} q on o.id = q.id
    left join {{fuzzy_best_v}} f on q.bucket = f.bucket and q.title = f.query""", FUZZY_VIEWS)
def fuzzy_match(t: Tables) -> DataFrame:
    learned = stage(title_dictionary(t), "titles")
    open_rows = looked_up_titles(t, learned)
    entries = fuzzy.fuzzy_entries(learned, MIN_COUNT, PURITY)
    matched = fuzzy.fuzzy_lookup(open_rows, entries, FUZZY_THRESHOLD, TOPK)
    return flat_decision(matched.withColumn("similarity", F.round("similarity", 6)), "title", "naics", "similarity", "matched_title")


# ---- routing and write-back -----------------------------------------------------------------------------------

@query("route_to_model", f"""
    select n.id from ({cascade_sql('key_dict_v', 'true')}) d join {{normed_v}} n on d.id = n.id
    where not d.used and (n.title <> '' or n.employer <> 'MISSING' or n.industry_other <> 'MISSING')""", DICT_VIEWS)
def route_to_model(t: Tables) -> DataFrame:
    entries = stage(industry_dictionary(t), "dict")
    decided = dictionary.lookup_cascade(t.survey, entries, COLS.key_specs, PURITY, MIN_COUNT, TOPK)
    present = text.text_present(decided, ("qe4", "qa20", "qe1oth"))
    return decided.filter(filters.needs_model(F.col("used"), present)).select("id")


DECISION = f"""
    select l.id, s.qe4ar as before, cast(l.pred as varchar) as top1, l.conf,
           ({O.occupation_missing('s.qe4ar')} and l.pred is not null and l.conf >= 0.93) as applied
    from {{title_lookup_v}} l join {{survey}} s on l.id = s.id"""
APPLY_VIEWS = {**TITLE_VIEWS, "decision_v": DECISION}


def decided_titles(t: Tables) -> DataFrame:
    rows = looked_up_titles(t)
    mask = filters.apply_mask(codes.occupation_missing(codes.number_of(rows, "qe4ar")), F.col("pred"), F.col("conf"), 0.93)
    return rows.withColumn("applied", mask)


@query("apply_mask", "select id, before, top1, round(conf, 6) as conf, applied from {decision_v}", APPLY_VIEWS)
def apply_mask(t: Tables) -> DataFrame:
    return decided_titles(t).select("id", F.col("qe4ar").alias("before"), F.col("pred").cast("string").alias("top1"),
                                    F.round("conf", 6).alias("conf"), "applied")


@query("fill_missing_codes", """
    select id, before, case when applied then cast(top1 as double) else before end as after, round(conf, 6) as conf, applied
    from {decision_v}""", APPLY_VIEWS)
def fill_missing_codes(t: Tables) -> DataFrame:
    rows = decided_titles(t)
    return rows.select("id", F.col("qe4ar").alias("before"),
                       writeback.assign_occupation(F.col("qe4ar"), F.col("applied"), F.col("pred")).alias("after"),
                       F.round("conf", 6).alias("conf"), "applied")


INDUSTRY_DECISION = f"""
    select d.id, n.qa20a as before, d.pred, d.conf,
           ({O.code_missing('n.industry_code')} and d.pred is not null and d.conf >= 0.0) as applied,
           {', '.join(f'd.alt{i}' for i in range(1, TOPK))}
    from ({cascade_sql('key_dict_v', 'true')}) d join {{normed_v}} n on d.id = n.id"""
ASSIGN_VIEWS = {**DICT_VIEWS, "industry_decision_v": INDUSTRY_DECISION}


def decided_industry(t: Tables) -> DataFrame:
    entries = stage(industry_dictionary(t), "dict")
    rows = dictionary.lookup_cascade(t.survey, entries, COLS.key_specs, PURITY, MIN_COUNT, TOPK)
    mask = filters.apply_mask(codes.code_missing(codes.code_of(rows, "qa20a")), F.col("pred"), F.col("conf"), 0.0)
    return rows.withColumn("applied", mask)


@query("assign_codes", """
    select id, case when applied then try_cast(pred as double) else before end as as_number,
           case when applied then pred else cast(cast(before as bigint) as varchar) end as as_text, applied
    from {industry_decision_v}""", ASSIGN_VIEWS)
def assign_codes(t: Tables) -> DataFrame:
    rows = decided_industry(t).withColumn("as_text", codes.clean_code(F.col("qa20a"), "double"))
    return rows.select("id", writeback.assign_code(rows, "qa20a", F.col("applied"), F.col("pred")).alias("as_number"),
                       writeback.assign_code(rows, "as_text", F.col("applied"), F.col("pred")).alias("as_text"), "applied")


@query("applied_counts", """
    select 'qa20a' as target, count(*) as n_rows, cast(sum(cast(applied as int)) as bigint) as n_applied, count(pred) as n_predicted
    from {industry_decision_v}
    union all
    select 'qe4ar', count(*), cast(sum(cast(applied as int)) as bigint), count(top1) from {decision_v}""",
       {**APPLY_VIEWS, **ASSIGN_VIEWS})
def applied_counts(t: Tables) -> DataFrame:
    t.keep("survey")
    industry = decided_industry(t).select(F.lit("qa20a").alias("target"), "applied", F.col("pred").alias("top1"))
    titles = decided_titles(t).select(F.lit("qe4ar").alias("target"), "applied", F.col("pred").cast("string").alias("top1"))
    return writeback.applied_counts(industry.unionByName(titles))


@query("scored_survey", """
    select s.id, s.qe4, case when d.applied then cast(d.top1 as double) else s.qe4ar end as qe4ar, s.qa20a
    from {survey} s join {decision_v} d on s.id = d.id""", APPLY_VIEWS)
def scored_survey(t: Tables) -> DataFrame:
    """Scored rows written with their column metadata and read back."""
    from codeloom.sources.survey import attach_labels, column_labels, restore_labels
    labelled = attach_labels(t.survey, {"qe4ar": {"label": "occupation code", "measure": "nominal"}})
    rows = decided_titles(t)
    filled = rows.select("id", "qe4", writeback.assign_occupation(F.col("qe4ar"), F.col("applied"), F.col("pred")).alias("qe4ar"), "qa20a")
    written = stage(restore_labels(filled, labelled), "scored")
    if column_labels(written) != column_labels(labelled, written.columns):
        raise RuntimeError("column metadata was lost on the way through the sink")
    return written


def shown_percent(p: str) -> str:
    return f"printf('%.1f', round_even({p} * 100, 1)) || '%'"


LOG_VIEWS = {
    **APPLY_VIEWS, **ASSIGN_VIEWS,
    "industry_alts_v": """
        select d.id, string_agg(r.label || ' (' || %s || ')', ', ' order by r.rk) as alts
        from {industry_pick_v} d join {key_ranked_v} r on d.spec = r.spec and d.key = r.key
        where r.rk between 2 and 4 group by d.id""" % shown_percent("r.label_n / r.n"),
    "industry_pick_v": f"""
        select * from (select k.id, k.spec, k.key, row_number() over (partition by k.id order by k.no) as pick
            from {{keys_v}} k join {{key_dict_v}} d on k.spec = d.spec and k.key = d.key
            where d.n >= {MIN_COUNT} and d.top_prob >= {PURITY}) p where pick = 1""",
    "title_alts_v": """
        select d.id, string_agg(lpad(cast(r.label as varchar), 6, '0') || ' (' || %s || ')', ', ' order by r.rk) as alts
        from {title_pick_v} d join {title_ranked_v} r on d.title = r.title and d.naics = r.naics
        where r.rk between 2 and 4 group by d.id""" % shown_percent("r.label_n / r.n"),
    "title_pick_v": """
        select l.id, l.title, case when p.top is null then 'MISSING' else l.naics end as naics
        from {title_lookup_v} l left join {title_dict_v} p on l.title = p.title and l.naics = p.naics where l.used""",
}


@query("decision_log", f"""
    select n.id, 'id=' || n.id || ' | qa20a: ' || n.naics || ' -> ' || case when d.applied then d.pred else n.naics end
        || ' (model_top=' || coalesce(d.pred, 'MISSING') || ' conf=' || {shown_percent('d.conf')}
        || ' applied=' || case when d.applied then 'YES' else 'NO' end || ') [alts: ' || coalesce(a.alts, '') || ']'
        || ' | qe4ar: ' || {{shown}}before) || ' -> ' || {{shown}}after)
        || ' (model_top=' || coalesce(o.top1, 'MISSING') || ' conf=' || {shown_percent('o.conf')}
        || ' applied=' || case when o.applied then 'YES' else 'NO' end || ') [alts: ' || coalesce(b.alts, '') || ']' as line
    from {{normed_v}} n join {{industry_decision_v}} d on n.id = d.id join (
        select *, case when applied then cast(top1 as double) else before end as after from {{decision_v}}) o on n.id = o.id
    left join {{industry_alts_v}} a on n.id = a.id left join {{title_alts_v}} b on n.id = b.id""".replace("{shown}before)", "coalesce(lpad(cast(cast(round_even(o.before, 0) as bigint) as varchar), 6, '0'), 'MISSING')")
       .replace("{shown}after)", "coalesce(lpad(cast(cast(round_even(o.after, 0) as bigint) as varchar), 6, '0'), 'MISSING')"), LOG_VIEWS)
def decision_log(t: Tables) -> DataFrame:
    t.keep("survey")
    industry = decided_industry(t)
    industry = industry.withColumn("after", writeback.assign_code(industry, "qa20a", F.col("applied"), F.col("pred")))
    left = industry.select("id", writeback.decision_text(
        "qa20a", writeback.shown_code(industry, "qa20a"), writeback.shown_code(industry, "after"), F.col("pred"), F.col("conf"),
        F.col("applied"), writeback.alternates_text(F.col("alts"), pad=False)).alias("industry_part"))
    titles = decided_titles(t)
    titles = titles.withColumn("after", writeback.assign_occupation(F.col("qe4ar"), F.col("applied"), F.col("pred")))
    right = titles.select("id", writeback.decision_text(
        "qe4ar", writeback.shown_occupation(titles, "qe4ar"), writeback.shown_occupation(titles, "after"),
        codes.six_digits(F.col("pred").cast("double")), F.col("conf"), F.col("applied"),
        writeback.alternates_text(F.col("alts"), pad=True)).alias("title_part"))
    return left.join(right, "id").select("id", writeback.log_line("id", [F.col("industry_part"), F.col("title_part")]).alias("line"))
