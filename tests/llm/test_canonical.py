import unicodedata

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scriptorium.llm import canonical as C

CASES = [("Ｌｅ ｓｏｉｒ", "Le soir"), ("ﬁn ﬆ", "fin st"), ("été", "été"), ("so​ir⁠", "soir"), ("a b　c d", "a b c d"), ("νieոt", "vient"), ("ⓥⓘⓢ", "vis"), ("𝐥’𝐞𝐬𝐩é𝐫", "l’espér"), ("ⅼune", "lune"), ("so­ir", "soir"), ("nuıt", "nuit"), ("Ꭺdam", "Adam"), ("ᴀbc", "abc"), ("le\tsoir", "le soir"), ("so\x07ir", "soir")]
SAME = ["L’été « où » — œuvre… 12 №", "свет", "λόγος", "ἀγάπη", "דבר", "a\nb", "½ «…» “x” – ¿", "", "ſ"[:0], "Kırık ışık", "yağmurlı ışık İstanbul", "می‌خواهم", "क्‍ष", "👩‍🌾", "x² + y³ en m²"]


@pytest.mark.parametrize("text,want", CASES)
def test_disguised(text, want):
    assert C.canonical(text) == want


@pytest.mark.parametrize("text", SAME)
def test_untouched(text):
    assert C.canonical(text) == text


@given(st.text(max_size=60))
def test_fixed_point_and_composed(text):
    y = C.canonical(text)
    assert C.canonical(y) == y
    assert not any(unicodedata.category(c) == "Zs" and c != " " for c in y)


@given(st.text(alphabet="abcéèœ ’«»—…\n0-9ÀÇ", max_size=80))
def test_ordinary_text_is_stable(text):
    assert C.canonical(text) == text


def test_spliced_segments_equal_the_whole():
    text = "début ｘ milieu é fin " * 200
    assert C.canonical(text) == unicodedata.normalize("NFKC", text)


def test_column(spark):
    rows = [(1, "Ｌｅ", None), (2, None, ""), (3, "plain", "é"), (3, "plain", "é")]
    df = spark.createDataFrame(rows, "id long, title string, body string").withColumn("field", F.lit("clash"))
    got = sorted(map(tuple, C.disguised(df, "id", ["title", "body"]).collect()))
    assert got == [(1, "title", "Le"), (3, "body", "é"), (3, "body", "é")]
    assert [r[0] for r in df.select(C.canonical_text(F.col("title"))).collect()] == ["Le", None, "plain", "plain"]
    assert C.disguised(df.limit(0), "id", ["title"]).isEmpty()
