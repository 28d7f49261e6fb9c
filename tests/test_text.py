import pytest
from pyspark.sql import functions as F

from labelloom.functions import text
from labelloom.operators import naming


def apply(spark, fn, *values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r.y for r in df.select(fn(F.col("x")).alias("y")).collect()]


def test_clean_response(spark):
    cases = {
        "Sure! Category: **Marine Biology**": "Marine Biology",
        "1. machine learning\nbecause of words": "machine learning",
        "- ai/ml (models)": "ai/ml models",
        "The answer: one two three four": "one two three",
        "Label: x. Category: cooking": "cooking",
        "• cafés und Bäume!": "cafés und Bäume",
        "": "",
    }
    assert apply(spark, text.clean_response, *cases) == list(cases.values())


def test_normalize_label(spark):
    long = "a" * 30 + " " + "b" * 15 + " " + "c" * 10
    got = apply(spark, text.normalize_label, "  Two   Words ", long, "   ", None)
    assert got == ["two words", "a" * 30 + " " + "b" * 15, None, None]


def test_validate_label(spark):
    got = apply(
        spark, text.validate_label, "", None, "machine learning", "  sports  ",
        "the of astronomy and more", "is to by at",
    )
    assert got == ["unlabeled", "unlabeled", "machine learning", "sports", "astronomy", "is"]


@pytest.mark.parametrize("a, b, want", [("Sports News", "sports news ", 1.0), ("a b", "b c", 1 / 3), ("", " ", 1.0), ("x", "", 0.0)])
def test_label_similarity(spark, a, b, want):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(text.label_similarity(F.col("a"), F.col("b")).alias("s")).first().s == pytest.approx(want)


def docs(spark, *rows):
    return spark.createDataFrame([(c, i, t) for i, (c, t) in enumerate(rows)], "cluster_id int, id long, content string")


def test_keyword_label(spark):
    df = docs(
        spark, (0, "machine learning neural transformer model models"), (1, "nothing here"),
        (2, "Fish and egg, egg, fish"), (-1, "fish"),
    )
    got = {r.cluster_id: r.label for r in naming.keyword_labels(df).collect()}
    assert got[0] == "ai ml concepts" and got[1] is None
    # Substrings count: "egg" three keywords lists tie is broken by list order.
    assert got[2] == "cooking instructions"


def test_token_label_ties_by_first_appearance(spark):
    df = docs(spark, (0, "zebra apple the zebra apple"), (0, "cat zebra apple cat cat"), (1, "it is a so"), (2, "beta alpha"))
    got = {r.cluster_id: r.label for r in naming.token_labels(df).collect()}
    assert got == {0: "zebra apple", 2: "beta alpha"}


def test_confidence_and_labels(spark):
    sizes = spark.createDataFrame([("unlabeled", 50), ("technology", 50), ("a b c d", 10), ("cluster_3", 100)], "l string, n long")
    got = [r.c for r in sizes.select(naming.confidence(F.col("l"), F.col("n")).alias("c")).collect()]
    assert got == pytest.approx([0.72, 0.96, 0.12 + 0.24, 0.72])


def test_label_clusters_with_responses(spark):
    df = docs(spark, (0, "fish fish"), (1, "alpha beta"), (2, "revenue"), (3, "stock market"), (-1, "noise text"))
    answers = spark.createDataFrame([(0, "sea life"), (1, None), (2, "unknown")], "cluster_id int, label string")
    got = {r.cluster_id: r.label for r in naming.label_clusters(df, answers).collect()}
    assert got == {0: "sea life", 1: "cluster_1", 2: "business performance", 3: "business performance", -1: "noise"}


def test_representatives_and_prompts(spark, points):
    df = points([[0.0], [1.0], [2.0], [9.0]], [0, 0, 0, 1])
    reps = naming.representatives(df, 10)
    assert [r.id for r in reps.where("cluster_id = 0").orderBy("rank").collect()] == [1, 0, 2]
    assert naming.representatives(df, 2).where("cluster_id = 0").count() == 2
    texts = reps.withColumn("content", F.repeat(F.lit("x"), 300))
    prompt = naming.prompts(texts).where("cluster_id = 1").first().prompt
    assert "1. " + "x" * 200 + "\n" in prompt and "x" * 201 not in prompt


def test_join_labels_default(spark):
    labels = spark.createDataFrame([(0, "a", 0.9)], "cluster_id int, label string, confidence double")
    rows = naming.join_labels(docs(spark, (0, "t"), (5, "t")), labels).orderBy("id").collect()
    assert [(r.label, r.confidence) for r in rows] == [("a", 0.9), ("unknown", 0.0)]
