"""Hand-worked values of the scalar functions."""

import pytest
from pyspark.sql import functions as F

from codeloom.config import CodingConfig, SurveyColumns
from codeloom.functions import codes, text
from codeloom.operators.ranking import parse_choice


def one(spark, value, kind, make):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(make(df).alias("y")).first()["y"]


@pytest.mark.parametrize("raw, expected", [
    (None, ""), ("", ""), ("   ", ""), ("  Asst. Mgr/Owner ", "assistant manager/owner"), ("R.N.", "r n"), ("RN (ICU)", "registered nurse icu"),
    ("A+ Cert.", "a+ cert"), ("a+cert", "a pluscert"), ("Café\tChef", "caf chef"), ("IT-Tech #2", "it-technician #2"), ("DIR", "director"),
    ("ceo & cfo", "chief executive officer chief financial officer"), ("!!!", ""), ("tech_lead", "technician lead"), ("C++", "c++"),
])
def test_normalize_text(spark, raw, expected):
    assert one(spark, raw, "string", lambda df: text.normalized(df, "x")) == expected


@pytest.mark.parametrize("raw, expected", [(561110.0, "561110 0"), (12345678.0, "12345678 0"), (1.5, "1 5"), (float("nan"), ""), (None, "")])
def test_numbers_are_text_too(spark, raw, expected):
    assert one(spark, raw, "double", lambda df: text.normalized(df, "x")) == expected


@pytest.mark.parametrize("raw, expected", [
    (12345678.5, "12345678.5"), (1e16, "1e+16"), (0.00001, "1e-05"), (1e7, "10000000.0"), (0.1, "0.1"), (-3.0, "-3.0"), (1.5e-7, "1.5e-07")])
def test_float_text(spark, raw, expected):
    assert one(spark, raw, "double", lambda df: text.float_text(F.col("x"))) == expected


@pytest.mark.parametrize("raw, kind, expected", [
    ("00123.0", "string", "123"), ("00123", "string", "00123"), (" 123.00 ", "string", "123"), ("", "string", None), ("\t ", "string", None),
    ("A-1", "string", "A-1"), (None, "string", None), (311000.0, "double", "311000"), (2.5, "double", "2.5"), (float("nan"), "double", None),
    (float("inf"), "double", None), (1e7, "double", "10000000"), (3.0000000001, "double", "3"), (-0.0, "double", "0"), (7, "bigint", "7")])
def test_clean_code(spark, raw, kind, expected):
    assert one(spark, raw, kind, lambda df: codes.code_of(df, "x")) == expected


@pytest.mark.parametrize("raw, expected", [("12d", None), ("1e3", 1000.0), (" 5 ", 5.0), ("0x1f", None), ("", None), (None, None), (".5", 0.5), ("NaN", None)])
def test_numeric(spark, raw, expected):
    assert one(spark, raw, "string", lambda df: codes.number_of(df, "x")) == expected


def test_occupation_range_before_and_after_rounding(spark):
    # 99999.7 is missing as an answer but usable as a label once rounded; group 10 is not a group
    assert one(spark, 99999.7, "double", lambda df: codes.occupation_missing(F.col("x"))) is True
    assert one(spark, 99999.7, "double", lambda df: codes.occupation_labelled(F.col("x"))) is True
    assert one(spark, 111011.0, "double", lambda df: codes.occupation_missing(F.col("x"))) is False
    assert one(spark, 121011.0, "double", lambda df: codes.occupation_missing(F.col("x"))) is True
    assert one(spark, 111011.0, "double", lambda df: codes.occupation_missing(F.col("x"), (111011,))) is True
    assert one(spark, None, "double", lambda df: codes.occupation_missing(F.col("x"))) is True


@pytest.mark.parametrize("raw, expected", [(1234.0, "001234"), (None, "MISSING"), (1234567.0, "1234567.0"), (0.5, "000000"), (1.5, "000002")])
def test_six_digits(spark, raw, expected):
    assert one(spark, raw, "double", lambda df: codes.six_digits(F.col("x"))) == expected


def test_documents_and_keys(spark):
    df = spark.createDataFrame([("Nurse", None, 5.0), (None, " ", None)], "qe4 string, qa20 string, qa20a double")
    prefixes = SurveyColumns().prefixes
    docs = [r[0] for r in df.select(text.build_document(df, ("qe4", "qa20", "nowhere", "qa20a"), prefixes)).collect()]
    assert docs == ["JOBTITLE: nurse | NAICS: 5 0", "__EMPTY__"]
    keys = [r[0] for r in df.select(codes.composite_key(df, ("qe4", "qa20a"))).collect()]
    assert keys == ["nurse||5", None]


def test_review_context_limit(spark):
    df = spark.createDataFrame([("word " * 2000,)], "t string")
    assert len(df.select(text.review_context(df, ("t",), 3000)).first()[0]) == 3000


@pytest.mark.parametrize("raw, expected", [
    ('{"code":"123456"}', "123456"), ('{"code": 42}', "42"), ("I pick 311000.", "311000"), ("a 7 or 12345678", None), ("", None), (None, None)])
def test_parse_choice(spark, raw, expected):
    assert one(spark, raw, "string", lambda df: parse_choice(F.col("x"))) == expected


def test_config():
    assert CodingConfig.for_profile("fast").ensemble_size == 1
    assert CodingConfig.for_profile("robust").latent_components == 64
    with pytest.raises(ValueError):
        CodingConfig.for_profile("turbo")
    saved = CodingConfig(dict_purity=0.8)
    merged = saved.at_score_time(CodingConfig(dict_purity=0.99, overwrite_all=True))
    assert merged.dict_purity == 0.8 and merged.overwrite_all
    assert CodingConfig.from_dict({**saved.to_dict(), "unknown": 1}) == saved
