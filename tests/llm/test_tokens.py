import random
from pathlib import Path

import pytest

from tarnquill.llm.tokens import VOCABULARY, Encoder, token_counts, token_ids

pytestmark = pytest.mark.skipif(not Path(VOCABULARY).exists(), reason="no vocabulary file")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(VOCABULARY)
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def encoder():
    return Encoder(Path(VOCABULARY).read_text(encoding="utf-8"))


def test_random_texts_equal_the_library(encoder, library):
    rng = random.Random(5)
    letters = "aab thein<|endoftext|>\n\t\r\x1c\x85é中文能源😀  ٣ⅷ'sll!!--  "
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(5_000)]
    assert [encoder.encode(t) for t in texts] == library(texts)


def test_long_texts_equal_the_library(encoder, library):
    texts = ["a" * 30_000, " " * 5_000 + "x", "能源" * 5_000, "word " * 20_000, "=" * 10_000]
    assert [encoder.encode(t) for t in texts] == library(texts)


def test_columns(spark, library):
    rows = [(1, None, "x", None), (2, "", "x", None), (3, "wind <|endoftext|>", "x", "s"), (4, "  ", "x", "s"), (5, "same", "x", "s"), (6, "same", "x", "s")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string, source string")
    found = {r.doc_id: r.ids for r in token_ids(df).collect()}
    assert found[1] == [] and found[2] == [] and found[5] == found[6] and found[3] == library(["wind <|endoftext|>"])[0]
    assert {r.doc_id: r.n_tokens for r in token_counts(df).collect()} == {k: len(v) for k, v in found.items()}
    assert token_ids(df.limit(0)).count() == 0
