"""Column, join and aggregate operators."""

import math

from helpers import column, rows
from pyspark.sql import functions as F

from tagloom.operators import aggregates as ag
from tagloom.operators import columns as co
from tagloom.operators import joins as jo
from tagloom.plans import recipes
from tagloom.sources.lexicons import stack_lexicons


def test_remap_and_case(spark):
    assert column(spark, ["PUB", "X", None], lambda c: co.remap_labels(c, ["PUB"], "ORG")) == ["ORG", "MISC", "MISC"]
    cases = [("Personal", "PERSON"), ("Location", "GPE")]
    got = column(spark, ["Location Personal", "Location", "x"], lambda c: co.case_contains(c, cases, "MISC"))
    assert got == ["PERSON", "GPE", "MISC"]


def test_ratio_by_zero_is_null(spark):
    df = spark.createDataFrame([(1, 0), (1, 3)], "a int, b int")
    assert rows(df, co.pct_ratio("a", "b")) == [(33.33,), (None,)]


def test_maps(spark):
    types = {"ORG": "COM"}
    assert column(spark, ["B-ORG", "O", "B-XXX"], lambda c: co.map_tag_type(c, types)) == ["B-COM", "O", None]
    df = spark.sql("SELECT array('a', 'b', 'a') AS k, array(1, 2, 3, 4) AS v")
    assert df.select(co.zip_to_map(F.col("k"), F.col("v"))).first()[0] == {"a": 3, "b": 2}
    pairs = spark.sql("SELECT map('a', 1, 'b', 2) AS m")
    assert rows(co.map_entries(pairs, "m")) == [("a", 1), ("b", 2)]


def test_pos_tables(spark):
    df = spark.createDataFrame([("中国#NN", 1.0), ("今天#NT", 9.0), ("人#NR", 3.0), ("abc#NN", 5.0), ("的#NN", 7.0)], "word_pos string, value double")
    stops = spark.createDataFrame([("的",)], "word string")
    assert [r[0] for r in co.clean_pos_table(df, stops).collect()] == ["人#NR", "中国#NN"]
    assert column(spark, ["a#NN b#VV c#NN"], lambda c: co.lexical_words(c, ["#NN"])) == [["a", "c"]]
    nouns = spark.createDataFrame([("a#NN",), ("a#NN",), ("b#VV",)], "w string")
    assert rows(co.noun_words(nouns, "w")) == [("a#NN",)]


def test_joins(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "id int, a string")
    b = spark.createDataFrame([(1, "y"), (2, "z")], "id int, b string")
    assert rows(jo.join_inner(a, b, "id")) == [(1, "x", "y")]
    assert rows(jo.join_all([a, b, b.withColumnRenamed("b", "c")], "id", "left")) == [(1, "x", "y", "y"), (2, None, "z", "z")]
    assert jo.union_all([a, b]).columns == ["id", "a", "b"]
    assert rows(jo.only_in(a, b.where("id = 1"), "id"), "id") == [(2,)]


def test_lexicon_variants(spark):
    tokens = spark.createDataFrame([("Oslo",), ("oslo",), ("zzz",)], "token string")
    lexicons = stack_lexicons(
        {
            "place": spark.createDataFrame([("oslo",)], "token string"),
            "size": spark.createDataFrame([("oslo", "7"), ("Oslo", "8")], "token string, value string"),
        }
    )
    got = {r["token"]: (r["place"], r["size"]) for r in jo.add_lexicons(tokens, lexicons, ["place", "size"]).collect()}
    assert got == {"Oslo": ("0", "8"), "oslo": ("True", "7"), "zzz": ("0", "0")}
    lower = jo.add_lexicons(tokens, lexicons, ["size"], lower=True)
    assert {r["token"]: r["size"] for r in lower.collect()} == {"Oslo": "7", "oslo": "7", "zzz": "0"}
    flag = jo.add_lexicons(tokens, lexicons, ["place"], kind="flag")
    assert {r["token"]: r["place"] for r in flag.collect()} == {"Oslo": "0", "oslo": "1", "zzz": "0"}
    own = jo.add_lexicons(tokens, lexicons, ["place"], kind="token")
    assert {r["token"]: r["place"] for r in own.collect()} == {"Oslo": "0", "oslo": "oslo", "zzz": "0"}


def test_term_scores(spark):
    docs = spark.createDataFrame([(1, "a a b"), (2, "a c")], "doc_id long, text string")
    terms = ag.term_frequencies(docs)
    assert rows(ag.tf_over_df(terms)) == [("a", 1.5), ("b", 1.0), ("c", 1.0)]
    assert rows(ag.tf_times_df(terms)) == [("a", 6.0), ("b", 1.0), ("c", 1.0)]
    assert ag.token_total(terms).first()[0] == 5
    assert rows(ag.zscore_flag(ag.tf_over_df(terms))) == [("a", 1), ("b", 0), ("c", 0)]
    same = spark.createDataFrame([("a", 2.0), ("b", 2.0)], "word string, score double")
    assert rows(ag.zscore_flag(same)) == [("a", 1), ("b", 1)]


def test_entropies(spark):
    labels = spark.createDataFrame([("a",), ("a",), ("b",)], "l string")
    assert math.isclose(ag.label_entropy(labels, "l").first()[0], 0.918296, abs_tol=1e-6)
    weights = spark.createDataFrame(
        [(1, "x", "t", "d", 1), (2, "y", "t", "d", 3), (3, "x", "t", "d", 0), (4, "x", "u", "d", 5)],
        "n int, brand string, topic string, dimension string, weight int",
    )
    got = {r["topic"]: (r["total"], r["entropy"]) for r in ag.grouped_entropy(weights, ["topic", "dimension"], "brand", "weight", "n").collect()}
    assert got["t"][0] == 4
    assert math.isclose(got["t"][1], -(0.75 * math.log(0.75)))
    assert got["u"] == (5, 0.0)


def test_bag_of_words_keeps_empty_documents(spark):
    docs = spark.createDataFrame([(1, "The cat the"), (2, ""), (3, "zzz")], "doc_id long, text string")
    assert rows(ag.bag_of_words(docs, ["the", "cat"])) == [(1, 2, 1), (2, 0, 0), (3, 0, 0)]


def test_tfidf_rows_have_length_one(spark):
    docs = spark.createDataFrame([(1, "a b a cc"), (2, "b x")], "doc_id long, text string")
    got = rows(ag.tfidf_l2(docs))
    for doc in (1, 2):
        assert math.isclose(sum(v * v for d, _, v in got if d == doc), 1.0)
    idf_a, idf_b = math.log(3 / 2) + 1, math.log(3 / 3) + 1
    assert math.isclose({(d, w): v for d, w, v in got}[(1, "a")], 2 * idf_a / math.hypot(2 * idf_a, idf_b))


def test_nested_recipes(spark):
    rowset = spark.sql(
        "SELECT array(named_struct('status', 'active', 'acronyms', array('B', 'A', 'A', 'X Y')),"
        " named_struct('status', 'obsolete', 'acronyms', array('C'))) AS institutes"
    )
    assert [r[0] for r in recipes.institute_acronyms(rowset).collect()] == ["A", "B"]
    companies = spark.sql("SELECT named_struct('company_details', named_struct('name', 'Acme')) AS company_info")
    assert rows(recipes.company_names(companies)) == [("Acme",)]


def test_titles_recipe(spark):
    raw = spark.createDataFrame(
        [("en", "A", "Personal name"), ("en", "B", "Thing"), ("de", "C", "Location"), ("en", "D", "Organisation")],
        "Language string, Title string, Type string",
    )
    assert rows(recipes.typed_titles(raw)) == [("A", "PERSON"), ("D", "ORG")]
