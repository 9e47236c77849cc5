from pyspark.sql import functions as F

from codeloom.operators import dictionary, filters

SPECS = (("a", ("x",)), ("b", ("x", "y")))


def labelled(spark):
    rows = [(i, "Acme Svcs", "clerk" if i % 2 else "cook", "1" if i % 2 else "2") for i in range(10)]
    rows += [(100 + i, "Solo", None, "3") for i in range(5)] + [(200, None, None, "9")]
    return spark.createDataFrame(rows, "id bigint, x string, y string, label string")


def test_impure_entry_does_not_stop_the_cascade(spark):
    df = labelled(spark)
    entries = dictionary.build_dictionary(df, F.col("label"), SPECS, 5).collect()
    by_key = {(e["spec"], e["key"]): e for e in entries}
    assert by_key[("a", "acme services")]["top_prob"] == 0.5 and by_key[("a", "acme services")]["top"] == "1"
    assert [a["code"] for a in by_key[("a", "acme services")]["alts"]] == ["2"]
    assert ("a", "MISSING") not in by_key and ("b", "MISSING||MISSING") not in by_key
    table = spark.createDataFrame(entries, dictionary.build_dictionary(df, F.col("label"), SPECS, 5).schema)
    for broadcast in (True, False):
        got = {r["id"]: r for r in dictionary.lookup_cascade(df, table, SPECS, 0.9, 5, 4, broadcast=broadcast).collect()}
        assert got[1]["pred"] == "1" and got[2]["pred"] == "2" and got[100]["pred"] == "3"
        assert got[1]["used"] and got[1]["conf"] == 1.0
        assert not got[200]["used"] and got[200]["conf"] == 0.0


def test_rows_without_industry_count_twice(spark):
    df = spark.createDataFrame([(1, "Cook", None, 10)] * 3 + [(2, "Cook", "5", 20)], "id bigint, t string, n string, label int")
    found = {r["naics"]: r for r in dictionary.build_title_dictionary(df, F.col("label"), "t", "n", 1).collect()}
    assert found["MISSING"]["n"] == 7 and found["5"]["n"] == 1
    assert found["MISSING"]["top"] == 10 and abs(found["MISSING"]["top_prob"] - 6 / 7) < 1e-12


def test_existing_impure_pair_hides_the_title_entry(spark):
    df = spark.createDataFrame(
        [(i, "Cook", "5", 10 + i % 2) for i in range(10)] + [(100 + i, "Cook", "6", 10) for i in range(200)],
        "id bigint, t string, n string, label int")
    table = dictionary.build_title_dictionary(df, F.col("label"), "t", "n", 5)
    queries = spark.createDataFrame([(1, "cook", "5"), (2, "cook", "6"), (3, "cook", "7"), (4, "baker", "6")], "id bigint, t string, n string")
    for broadcast in (True, False):
        got = {r["id"]: r for r in dictionary.lookup_title(queries, table, "t", "n", 0.9, 5, 4, broadcast=broadcast).collect()}
        assert not got[1]["used"] and got[2]["pred"] == 10 and got[3]["pred"] == 10 and not got[4]["used"]


def test_folds_are_stratified_and_repeatable(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 10 == 0, "rare").otherwise("hot").alias("label"))
    one = {r["id"]: r["fold"] for r in filters.stratified_folds(df, 4, 1).collect()}
    two = {r["id"]: r["fold"] for r in filters.stratified_folds(df.repartition(7), 4, 1).collect()}
    assert one == two
    sizes = {}
    for i, fold in one.items():
        sizes.setdefault(i % 10 == 0, [0] * 4)[fold] += 1
    assert all(max(s) - min(s) <= 1 for s in sizes.values())
