import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from scriptorium.llm import encoding as E

OWN, WIDTHS = E.coder(E.TOKENIZERS, "byte_bpe_50k"), E._widths(E.TOKENIZERS, "byte_bpe_50k")
PIECES = ["mot", " ", "  ", "\n", "\n\n", "'s", "'re", "'", "12", "é", "œ", "　", " ", "…", "!!", "\U0001f600", "你好", "\t", "a" * 40, "<|endoftext|>", "don't", " we'll"]


@pytest.mark.parametrize("leaf", [1, 2, 3, 7, 64])
def test_tree_equals_the_tokenizer(leaf):
    rng = random.Random(leaf)
    for _ in range(300):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randrange(0, 60)))
        ids = E.encode(text, OWN, WIDTHS, leaf)
        assert ids == OWN.encode_ordinary(text) and E.decode(ids, OWN) == text


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80), st.integers(1, 20))
def test_any_text(text, leaf):
    text = E._clean(text)
    assert E.encode(text, OWN, WIDTHS, leaf) == OWN.encode_ordinary(text)


def test_same_as_the_other_library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{E.TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    texts = ["Été  l’œuvre <|endoftext|> x", "a\n\n b\tc 12,5", "x" * 50_000, "mot " * 20_000, " " * 40_000]
    assert [e.ids for e in t.encode_batch(texts, add_special_tokens=False)] == E.encode_texts(texts, E.TOKENIZERS, "byte_bpe_50k")[0]


def test_rows(spark):
    df = spark.createDataFrame([(1, "un deux", 5), (2, None, 5), (3, "", 5), (1, "un deux", 5), (4, "mot " * 30_000, 5)], "doc_id long, text string, ids int")
    got = sorted(((r.id, r.ids) for r in E.token_ids(df, "doc_id", "text").collect()), key=str)
    by = dict(got)
    assert len(got) == 5 and by[2] == by[3] == [] and E.decode(by[4], OWN) == "mot " * 30_000
    assert E.token_ids(df.limit(0), "doc_id", "text").isEmpty()
    assert [r.n for r in E.token_counts(df, "text", "n").orderBy("doc_id").collect()] == [len(by[1])] * 2 + [0, 0, len(by[4])]


def test_a_lone_surrogate_is_replaced():
    assert E.encode_texts(["a\ud800b"], E.TOKENIZERS, "byte_bpe_50k")[0][0] == OWN.encode_ordinary("a�b")
