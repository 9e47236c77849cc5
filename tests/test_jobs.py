"""Small end-to-end runs and SQL comparison of quick queries."""

import glob

import pytest
from pyspark.sql import functions as F

from codeloom.catalog import REGISTRY, Tables
from codeloom.catalog.jobs import CONFIG, COLS
from codeloom.plans import flat, jobs
from codeloom.sources import cache, codebook, survey as surveys
from codeloom.session import stage

FOLDER = "/root/testdata/sf0.001"
QUICK = ("scan_survey", "codebook_docs", "clean_code", "missing_soc", "text_present", "labelled_naics", "stratified_folds", "dict_build_multi",
         "dict_cascade", "soc_dict_lookup", "fuzzy_match", "fill_missing_codes", "decision_log", "topk_proba", "align_classes", "max_merge",
         "rerank_promote", "macro_f1", "knn_vote", "fuse_candidates", "tfidf_word", "clf_complement_nb")


@pytest.mark.parametrize("name", QUICK)
def test_matches_sql(spark, name):
    from compare import connect, difference
    assert difference(REGISTRY[name].run(Tables(spark, FOLDER)), connect(FOLDER), REGISTRY[name].oracle) is None


def test_score_fills_only_missing_and_is_stable(spark):
    rows = stage(Tables(spark, FOLDER).survey, "survey")
    industry = flat.train_flat(rows, COLS.industry(), CONFIG)
    bundle = jobs.Bundle(CONFIG, COLS, industry, None, None)
    scored = jobs.score_bundle(rows, bundle)
    joined = scored.select("id", "qa20a", "qa20a__before", "qa20a__ranked", "qa20a__applied").collect()
    assert len(joined) == rows.count() and any(r["qa20a__applied"] for r in joined)
    for r in joined:
        before = r["qa20a__before"]
        if r["qa20a__applied"]:
            assert before in (None, 999999.0) and r["qa20a"] == float(r["qa20a__ranked"][0]["code"])
        else:
            assert r["qa20a"] == before
        probs = [e["prob"] for e in r["qa20a__ranked"]]
        codes = [e["code"] for e in r["qa20a__ranked"]]
        assert len(set(codes)) == len(codes) <= 4 and all(0 <= p <= 1 for p in probs)
    again = jobs.score_bundle(scored.select(*rows.columns), bundle)
    assert again.filter("qa20a__applied").count() == 0


def test_too_little_data_is_refused(spark):
    with pytest.raises(ValueError):
        flat.train_flat(Tables(spark, FOLDER).survey.limit(20), COLS.industry(), CONFIG)


def test_metadata_and_sinks(spark, tmp_path):
    df = surveys.attach_labels(spark.createDataFrame([(1, 2.0)], "id int, qa20a double"), {"qa20a": {"label": "industry"}})
    surveys.write_survey(df, str(tmp_path / "p"))
    back = surveys.read_survey(spark, str(tmp_path / "p"))
    assert surveys.column_labels(back) == {"qa20a": {"label": "industry"}}
    surveys.write_survey(df, str(tmp_path / "c"), "csv")
    assert surveys.read_survey(spark, str(tmp_path / "c"), "csv").count() == 1
    assert spark.read.json(str(tmp_path / "c.labels")).first()["column"] == "qa20a"
    surveys.write_decision_log(df.select(F.col("id").cast("string").alias("line")), str(tmp_path / "log"), ["head"])
    assert glob.glob(str(tmp_path / "log.header" / "*.txt"))


def test_codebook_files(spark, tmp_path):
    (tmp_path / "book.csv").write_text("Title,SOC_Code,Notes\nNurse,291141.0,RN\nNone,999,x\n,111011,\n")
    rows = codebook.load_codebook(spark, str(tmp_path / "book.csv"), "occupation").collect()
    assert [(r["code"], r["doc"]) for r in rows] == [("291141", "Title: nurse | Notes: registered nurse")]
    assert codebook.load_codebook(spark, str(tmp_path / "absent.csv"), "industry").count() == 0


def test_embedding_cache_encodes_only_misses(spark, tmp_path):
    seen = []

    def encode(df):
        seen.append(df.count())
        return df.select("key", F.array(F.length("doc").cast("double")).alias("vec"))

    path = str(tmp_path / "vectors")
    docs = lambda *texts: spark.createDataFrame([(x,) for x in texts], "doc string")
    assert cache.cached_vectors(docs("a", "b", "b"), path, "m", encode).count() == 2
    assert cache.cached_vectors(docs("b", "ccc"), path, "m", encode).count() == 2
    assert seen == [2, 1]


def test_missing_lists_come_from_the_caller(spark):
    from codeloom import CodingConfig
    saved = CodingConfig(missing_industry_values=("1",))
    caller = CodingConfig(missing_industry_values=("2",), missing_occupation_values=(7,))
    used = saved.at_score_time(caller)
    assert used.missing_industry_values == ("2",) and used.missing_occupation_values == (7,)


def test_code_column_by_preference(spark):
    book = spark.createDataFrame([("11-1011", "111021", "chief")], "CODE string, Soc string, title string")
    assert [r.code for r in codebook.codebook_documents(book, "occupation").collect()] == ["111021"]
