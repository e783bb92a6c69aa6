import pytest

SF = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"

# columns that clash with working names of the operators
EXTRA = ("score", "size", "key", "fp", "group", "component", "shard", "node", "rank", "label", "text_key", "lang_pred",
         "weight", "copies", "vector", "sigs", "next", "of")

LONG = " ".join(f"word{i % 977} and the thing{i % 89}" for i in range(9000))

ROWS = [
    (1, "The cat sat on the mat and looked at the moon.", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, "b"),
    (4, " \t\n ", "en", None),
    (5, LONG, "en", "a"),
    (6, "The cat sat on the mat and looked at the moon.", "en", "b"),
    (6, "The cat sat on the mat and looked at the moon.", "en", "b"),
    (7, "La maison est dans la rue et le chien dort.", "fr", "b"),
    (7, "Another text under an id that is taken.", "en", None),
    (None, "A text without an id, of the fourth kind.", "en", "c"),
    (None, None, None, None),
    (8, "12345 !!! ???", "fr", "c"),
    (9, "x", "en", "a"),
    (10, "é 😀 ß  double  space \n", "fr", "c"),
]


def frame(spark, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in EXTRA)
    data = [(*r, len(r[1] or ""), *["clash"] * len(EXTRA)) for r in rows]
    return spark.createDataFrame(data, schema)


@pytest.fixture(scope="session")
def odd_docs(spark):
    return frame(spark, ROWS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def odd_rows():
    return ROWS


@pytest.fixture(scope="session")
def make_docs(spark):
    return lambda rows: frame(spark, rows)
