import base64
import os
import random

import pytest

from docflux.llm import tokenize as K

PATH = f"{K.TOKENIZER_DIR}/{K.VOCABULARY}.tiktoken"
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary")
ODD = ["", " ", "\n\n a", "<|endoftext|>", "\x1c\x1d x\x85y z  ​", "\x00\x01", "é" * 3000, "😀 👩‍👩‍👧", "don't I'LL we've", "ก" * 300 + " ข", " \t\n x", "▁ a▁b", "᠎  x", "　全角１２", "a\r\nb", "x" * 5000]


@pytest.fixture(scope="module")
def codec():
    return K.Codec()


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in open(PATH, "rb") if x.strip())}
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def test_ids_and_round_trip(codec, reference):
    rng = random.Random(1)
    alphabet = "abc XYZ'\n\t12é漢ก😀.,!- "
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 80))) for _ in range(400)]
    for text in texts:
        ids = codec.encode(text)
        assert ids == reference.encode_ordinary(text)
        assert codec.decode(ids) == text and codec.count(text) == len(ids)


def test_a_full_cache_changes_nothing(codec, monkeypatch):
    monkeypatch.setattr(K, "CACHE_ENTRIES", 3)
    other = K.Codec()
    for text in ODD * 2:
        assert other.encode(text) == codec.encode(text)


def test_corpus(spark, reference):
    rows = list(enumerate([*ODD, None, "", "same", "same"]))
    df = spark.createDataFrame([(i, t, t, [1]) for i, t in rows], "doc_id bigint, text string, _other string, ids array<int>")
    got = {r["doc_id"]: r["ids"] for r in K.encode_corpus(df).collect()}
    assert got == {i: reference.encode_ordinary(t) if t else [] for i, t in rows}
    assert K.encode_corpus(df.limit(0)).count() == 0
    counts = {r["doc_id"]: r["n_tokens"] for r in K.count_tokens(df, "text", ["doc_id"]).collect()}
    assert counts == {i: len(x) for i, x in got.items()}
