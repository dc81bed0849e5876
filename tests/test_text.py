import re

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from tarnkeep.functions.text import clean_identifier, clean_text


def expected(text):
    """The stated behaviour, on one value."""
    if text is None or text.strip().upper() in ("", "NULL"):
        return ""
    return re.sub(r"[^a-zA-Z0-9\s,.\-]", "", text).strip()


def cleaned(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["c"] for r in df.select("i", clean_text(df.t).alias("c")).orderBy("i").collect()]


def test_samples(spark):
    assert cleaned(spark, ["Hello_World!", "NULL", "Test@123", None]) == [
        "HelloWorld", "", "Test123", "",
    ]


def test_edge_texts(spark):
    texts = [
        "", " ", "\t null \n", "nuLL", " x ", "\x1cy\x1f", "a b　", "été",
        "_", " - ", "a\nb\t", "x" * 5000 + " " * 5000 + "_", "null.", "a​b", " z\u0085",
    ]
    assert cleaned(spark, texts) == [expected(t) for t in texts]


@settings(max_examples=10, deadline=None, derandomize=True, database=None,
          phases=[Phase.generate], suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"], exclude_characters="\x00")), max_size=40))
def test_any_text(spark, texts):
    if texts:
        assert cleaned(spark, texts) == [expected(t) for t in texts]


def test_identifier(spark):
    df = spark.sql("select 'a-b c.é_9' t")
    assert df.select(clean_identifier(df.t)).first()[0] == "a_b_c___9"
