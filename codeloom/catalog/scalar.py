"""Sources, scalar functions and row filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeloom.catalog import oracle as O
from codeloom.catalog.registry import Tables, query
from codeloom.config import SurveyColumns
from codeloom.functions import codes, probability, text
from codeloom.operators import filters
from codeloom.sources.codebook import codebook_documents
from codeloom.sources.survey import attach_labels

COLS = SurveyColumns()
SURVEY_COLUMNS = ("id", "qe4", "qe5a", "qa20", "qe1oth", "qe8aoth", "qe2b", "qe1", "qse1", "qa9", "qe10", "qa20a", "qe4ar", "qe5ar")


@query("scan_survey", f"select {', '.join(SURVEY_COLUMNS)} from {{survey}}")
def scan_survey(t: Tables) -> DataFrame:
    labelled = attach_labels(t.survey, {"qa20a": {"label": "industry code", "missing": [999999]}})
    return labelled.select(*SURVEY_COLUMNS)


@query("codebook_docs", f"""
    select {O.code_text('soc_code')} as code,
           'title: ' || {O.norm('title')} || ' | description: ' || {O.norm('description')} as doc
    from {{codebook}} where not {O.code_missing('soc_code')}""")
def codebook_docs(t: Tables) -> DataFrame:
    return codebook_documents(t.codebook, "occupation").select("code", "doc")


@query("normalize_text", f"select cast(doc_id as bigint) as id, {O.norm('text')} as norm from {{documents}}")
def normalize_text(t: Tables) -> DataFrame:
    return t.documents.select(F.col("doc_id").alias("id"), text.normalize_text(F.col("text")).alias("norm"))


@query("expand_abbrev", f"select id, {O.norm('qe4')} as title, {O.norm('qe8aoth')} as selfemp from {{survey}}")
def expand_abbrev(t: Tables) -> DataFrame:
    s = t.survey
    return s.select("id", text.normalized(s, "qe4").alias("title"), text.normalized(s, "qe8aoth").alias("selfemp"))


@query("clean_code", f"""
    select id, {O.code_text('code_text')} as text_code, {O.code_number('code_number')} as number_code from {{raw_codes}}""")
def clean_code(t: Tables) -> DataFrame:
    r = t.raw_codes
    return r.select("id", codes.code_of(r, "code_text").alias("text_code"), codes.code_of(r, "code_number").alias("number_code"))


@query("cat_to_string", f"""
    select id, coalesce({O.code_number('qa20a')}, 'MISSING') as industry, coalesce({O.code_text('qe1')}, 'MISSING') as status,
           coalesce({O.code_text('qe8aoth')}, 'MISSING') as selfemp from {{survey}}""")
def cat_to_string(t: Tables) -> DataFrame:
    s = t.survey
    return s.select("id", codes.code_or_missing(s, "qa20a").alias("industry"), codes.code_or_missing(s, "qe1").alias("status"),
                    codes.code_or_missing(s, "qe8aoth").alias("selfemp"))


@query("code_major", f"""
    select id, case when {O.rounded('code_number')} between 100000 and 999999
                    then cast(floor({O.rounded('code_number')} / 10000) as int) end as major from {{raw_codes}}""")
def code_major(t: Tables) -> DataFrame:
    return t.raw_codes.select("id", codes.major_group(F.col("code_number")).alias("major"))


@query("format_code6", f"""
    select id, case when code_number is null then 'MISSING' when {O.rounded('code_number')} between 0 and 999999
        then lpad(cast(cast({O.rounded('code_number')} as bigint) as varchar), 6, '0') else cast(code_number as varchar) end as shown
    from {{raw_codes}}""")
def format_code6(t: Tables) -> DataFrame:
    return t.raw_codes.select("id", codes.six_digits(F.col("code_number")).alias("shown"))


@query("format_code", f"select id, coalesce({O.code_text('code_text')}, 'MISSING') as shown from {{raw_codes}}")
def format_code(t: Tables) -> DataFrame:
    return t.raw_codes.select("id", F.coalesce(codes.clean_code(F.col("code_text")), F.lit(codes.MISSING)).alias("shown"))


@query("missing_soc", f"""
    select id, {O.occupation_missing('code_number')} as missing,
           ({O.occupation_missing('code_number')} or coalesce(code_number in (110042, 311000), false)) as missing_listed from {{raw_codes}}""")
def missing_soc(t: Tables) -> DataFrame:
    number = F.col("code_number")
    return t.raw_codes.select("id", codes.occupation_missing(number).alias("missing"),
                              codes.occupation_missing(number, (110042, 311000)).alias("missing_listed"))


@query("missing_code", f"""
    select id, {O.code_missing(O.code_text('code_text'))} as text_missing, {O.code_missing(O.code_number('code_number'))} as number_missing,
           ({O.code_missing(O.code_text('code_text'))} or {O.code_text('code_text')} = '1998') as text_missing_listed from {{raw_codes}}""")
def missing_code(t: Tables) -> DataFrame:
    r = t.raw_codes
    coded = codes.code_of(r, "code_text")
    return r.select("id", codes.code_missing(coded).alias("text_missing"),
                    codes.code_missing(codes.code_of(r, "code_number")).alias("number_missing"),
                    codes.code_missing(coded, ("1998",)).alias("text_missing_listed"))


@query("text_present", f"""
    select id, ({O.norm('qe4')} <> '' or {O.norm('qe8aoth')} <> '') as present from {{survey}}""")
def text_present(t: Tables) -> DataFrame:
    s = t.survey
    return s.select("id", text.text_present(s, ("qe4", "qe8aoth", "absent_column")).alias("present"))


DOC_SQL = "coalesce(nullif(concat_ws(' | '" + "".join(
    f", case when {O.norm(c)} <> '' then '{p} ' || {O.norm(c)} end"
    for c, p in (("qa20", "EMPLOYER:"), ("qe4", "JOBTITLE:"), ("qe5a", "UNUSEDSKILL_TITLE:"), ("qe1oth", "INDUSTRY_OTHER:"),
                 ("qe8aoth", "SELFEMP_OTHER:"), ("qe2b", "WORKCITY:"))) + "), ''), '__EMPTY__')"


@query("build_docs", f"""
    select id, {DOC_SQL} as doc,
           case when qe8aoth is null then '__EMPTY__' else 'SELFEMP_OTHER: ' || {O.norm('qe8aoth')} end as sparse_doc,
           case when qa20a is null then '__EMPTY__' else 'NAICS: ' || {O.norm(O.float_text('qa20a'))} end as code_doc
    from {{survey}}""")
def build_docs(t: Tables) -> DataFrame:
    s = t.survey
    return s.select("id", text.build_document(s, COLS.industry().text, COLS.prefixes).alias("doc"),
                    text.build_document(s, ("qe8aoth", "qa9a"), COLS.prefixes).alias("sparse_doc"),
                    text.build_document(s, ("qa20a",), COLS.prefixes).alias("code_doc"))


@query("review_context", f"""
    select cast(doc_id as bigint) as id,
        case when {O.norm('source')} = '' then '' else 'source: ' || {O.norm('source')} || chr(10) end ||
        case when {O.norm('text')} = '' then '' else 'text: ' || {O.norm('text')} end as context
    from {{documents}}""")
def review_context(t: Tables) -> DataFrame:
    d = t.documents
    return d.select(F.col("doc_id").alias("id"), text.review_context(d, ("source", "text")).alias("context"))


@query("numeric_coerce", """
    select id, try_cast(trim(code_text) as double) as from_text, code_number as from_number from {raw_codes}""")
def numeric_coerce(t: Tables) -> DataFrame:
    r = t.raw_codes
    return r.select("id", codes.number_of(r, "code_text").alias("from_text"), codes.number_of(r, "code_number").alias("from_number"))


@query("composite_key", f"""
    select id, nullif({O.key_part('qa20')} || '||' || {O.key_part('qe4')}, 'MISSING||MISSING') as employer_title,
           nullif({O.key_part('qe4')} || '||' || {O.key_part('qe1oth')}, 'MISSING||MISSING') as title_industry,
           nullif({O.key_part('qe4')} || '||' || coalesce({O.code_number('qa20a')}, 'MISSING'), 'MISSING||MISSING') as title_code
    from {{survey}} where {O.norm('qe4')} <> '' or qa20a is not null or {O.norm('qe1oth')} <> ''""")
def composite_key(t: Tables) -> DataFrame:
    s = t.survey
    some = text.text_present(s, ("qe4", "qe1oth")) | F.col("qa20a").isNotNull()
    return s.filter(some).select(
        "id", codes.composite_key(s, ("qa20", "qe4")).alias("employer_title"),
        codes.composite_key(s, ("qe4", "qe1oth")).alias("title_industry"),
        codes.composite_key(s, ("qe4", "qa20a")).alias("title_code"))


@query("softmax_scores", """
    select id, code, round(exp(s - max(s) over (partition by id)) / sum(exp(s - top)) over (partition by id), 6) as p,
           round(1 / (1 + exp(-s)), 6) as p_binary
    from (select id, code, w1 / 10.0 as s, max(w1 / 10.0) over (partition by id) as top from {line_weights}) t""")
def softmax_scores(t: Tables) -> DataFrame:
    score = F.col("w1") / 10.0
    rows = t.line_weights.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("code", score.alias("s")))).alias("e"))
    spread = rows.select("id", F.explode_outer(F.arrays_zip(
        F.col("e.code").alias("code"), F.col("e.s").alias("s"), probability.softmax(F.col("e.s")).alias("p"))).alias("z"))
    return spread.select("id", "z.code", F.round("z.p", 6).alias("p"), F.round(probability.sigmoid(F.col("z.s")), 6).alias("p_binary"))


LABELLED = f"select id, {O.code_number('qa20a')} as label from {{survey}} where not {O.code_missing(O.code_number('qa20a'))}"
LABELLED_SOC = f"""
    select id, cast({O.rounded('qe4ar')} as int) as label, cast(floor({O.rounded('qe4ar')} / 10000) as int) as major from {{survey}}
    where {O.occupation_labelled('qe4ar')} and {O.norm('qe4')} <> ''"""
VALID_SOC = f"select id, label, major from {{labelled_soc_v}} where major in ({O.MAJOR_LIST})"
LABEL_VIEWS = {"labelled_naics_v": LABELLED, "labelled_soc_v": LABELLED_SOC, "valid_soc_v": VALID_SOC}


def industry_rows(t: Tables) -> DataFrame:
    return filters.labelled_industry(t.survey, "qa20a")


def occupation_rows(t: Tables) -> DataFrame:
    return filters.valid_major(filters.labelled_occupation(t.survey, "qe4ar", "qe4"))


@query("labelled_naics", LABELLED)
def labelled_naics(t: Tables) -> DataFrame:
    return industry_rows(t).select("id", "label")


@query("labelled_soc", "select id, label from {labelled_soc_v}", LABEL_VIEWS)
def labelled_soc(t: Tables) -> DataFrame:
    return filters.labelled_occupation(t.survey, "qe4ar", "qe4").select("id", "label")


@query("valid_major", VALID_SOC, LABEL_VIEWS)
def valid_major(t: Tables) -> DataFrame:
    return occupation_rows(t).select("id", "label", "major")


@query("drop_rare_class", """
    select id, label from {labelled_naics_v} where label in (
        select label from {labelled_naics_v} group by label having count(*) >= 20)""", LABEL_VIEWS)
def drop_rare_class(t: Tables) -> DataFrame:
    return filters.drop_rare(industry_rows(t), 20).select("id", "label")


@query("rare_classes", "select label, count(*) as n from {labelled_naics_v} group by label having count(*) < 20", LABEL_VIEWS)
def rare_classes(t: Tables) -> DataFrame:
    return filters.rare_classes(industry_rows(t), 20)


@query("drop_rare_major", """
    select id, label, major from {valid_soc_v} where major in (
        select major from {valid_soc_v} group by major having count(*) >= 600)""", LABEL_VIEWS)
def drop_rare_major(t: Tables) -> DataFrame:
    return filters.drop_rare(occupation_rows(t), 600, ("major",)).select("id", "label", "major")


@query("drop_rare_within", """
    select v.id, v.label, v.major from {valid_soc_v} v join (
        select major, label from {valid_soc_v} group by major, label having count(*) >= 12) k
      on v.major = k.major and v.label = k.label""", LABEL_VIEWS)
def drop_rare_within(t: Tables) -> DataFrame:
    return filters.drop_rare_within(occupation_rows(t), 12).select("id", "label", "major")


@query("size_guards", """
    select 'industry' as stage, count(*) as n_rows, count(distinct label) as n_classes,
           (count(*) >= 50 and count(distinct label) >= 2) as enough from {labelled_naics_v}
    union all
    select 'occupation', count(*), count(distinct label), count(*) >= 100 from {labelled_soc_v}""", LABEL_VIEWS)
def size_guards(t: Tables) -> DataFrame:
    def guard(rows: DataFrame, stage: str, minimum: int, classes: int) -> DataFrame:
        per_class = filters.class_counts(rows)
        return per_class.agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_classes")).select(
            F.lit(stage).alias("stage"), "n_rows", "n_classes",
            ((F.col("n_rows") >= minimum) & (F.col("n_classes") >= classes)).alias("enough"))
    return guard(industry_rows(t), "industry", 50, 2).unionByName(
        guard(filters.labelled_occupation(t.survey, "qe4ar", "qe4"), "occupation", 100, 1))


@query("class_counts", """
    select label, n, cast(case when smallest < 2 then 0 else greatest(2, least(5, smallest)) end as bigint) as folds from (
        select label, count(*) as n, min(count(*)) over () as smallest from {labelled_naics_v} group by label) c""", LABEL_VIEWS)
def class_counts(t: Tables) -> DataFrame:
    counts = filters.class_counts(industry_rows(t))
    return filters.with_folds(counts, 5)


@query("distinct_codes", """
    select major, count(distinct label) as n_codes, count(*) as n_rows from {valid_soc_v} group by major""", LABEL_VIEWS)
def distinct_codes(t: Tables) -> DataFrame:
    per_code = filters.class_counts(occupation_rows(t), ("major", "label"))
    return per_code.groupBy("major").agg(F.count("*").alias("n_codes"), F.sum("n").alias("n_rows"))


@query("group_baseline", """
    select major, cast(label as varchar) as code, round(share, 6) as share, cast(rank as int) as rank from (
        select major, label, count(*) / sum(count(*)) over (partition by major) as share,
               row_number() over (partition by major order by count(*) desc, cast(label as varchar)) as rank
        from {valid_soc_v} group by major, label) b""", LABEL_VIEWS)
def group_baseline(t: Tables) -> DataFrame:
    return filters.group_baseline(occupation_rows(t)).withColumn("share", F.round("share", 6))


@query("class_weights", """
    select label, count(*) as n, round(sum(count(*)) over () / (count(*) over () * count(*)), 6) as class_weight
    from {labelled_naics_v} group by label""", LABEL_VIEWS)
def class_weights(t: Tables) -> DataFrame:
    return filters.class_weights(industry_rows(t)).withColumn("class_weight", F.round("class_weight", 6))


@query("stratified_folds", """
    select id, label, cast((row_number() over (partition by label order by md5(cast(id as varchar) || '-42')) - 1) % 5 as int) as fold
    from {labelled_naics_v}""", LABEL_VIEWS)
def stratified_folds(t: Tables) -> DataFrame:
    return filters.stratified_folds(industry_rows(t).select("id", "label"), 5, 42)


@query("exemplars", f"""
    select id, label, doc from (
        select id, {O.code_number('qa20a')} as label,
               case when {O.norm('qe4')} = '' then '__EMPTY__' else 'JOBTITLE: ' || {O.norm('qe4')} end as doc from {{survey}}) e
    where not {O.code_missing('label')} and doc <> '__EMPTY__'""")
def exemplars(t: Tables) -> DataFrame:
    from codeloom.operators.semantic import exemplars as usable
    s = t.survey
    kept = usable(s, text.build_document(s, ("qe4",), COLS.prefixes), codes.code_of(s, "qa20a"), 1.0)
    return kept.select(F.col("ex_id").alias("id"), "label", "doc")


@query("exemplar_union", f"""
    select 'survey' as origin, cast(id as varchar) as ref, {O.code_number('qa20a')} as label, 1.0::double as weight,
           'EMPLOYER: ' || {O.norm('qa20')} as doc
    from {{survey}} where not {O.code_missing(O.code_number('qa20a'))} and {O.norm('qa20')} <> ''
    union all
    select 'codebook', soc_code, {O.code_text('soc_code')}, 0.6::double,
           'title: ' || {O.norm('title')} || ' | description: ' || {O.norm('description')}
    from {{codebook}} where not {O.code_missing('soc_code')}""")
def exemplar_union(t: Tables) -> DataFrame:
    from codeloom.operators.semantic import exemplars as usable
    s = t.survey
    own = usable(s, text.build_document(s, ("qa20",), COLS.prefixes), codes.code_of(s, "qa20a"), 1.0)
    book = codebook_documents(t.codebook, "occupation")
    listed = usable(book, F.col("doc"), F.col("code"), 0.60, id_col="code")
    return own.select(F.lit("survey").alias("origin"), F.col("ex_id").cast("string").alias("ref"), "label", "weight", "doc").unionByName(
        listed.select(F.lit("codebook").alias("origin"), F.col("ex_id").alias("ref"), "label", "weight", "doc"))
