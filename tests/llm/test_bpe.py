"""BPE by forced boundaries beside the library."""

import random
import unicodedata

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidewright.llm.bpe import Vocabulary, encode_decode, encode_texts
from tidewright.llm.queries import TOKENIZERS

from llm_cases import AWKWARD, SF, awkward, nothing  # noqa: F401

PATH = f"{TOKENIZERS}/word_bpe_49k.json"


@pytest.fixture(scope="module")
def both():
    with open(PATH, encoding="utf-8") as file:
        return Vocabulary(file.read()), Tokenizer.from_file(PATH)


def same(vocab, library, text):
    ids = np.frombuffer(vocab.encode(text), "<i4").tolist()
    want = library.encode(text, add_special_tokens=False).ids
    assert ids == want, text[:80]
    assert vocab.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_awkward_texts(both):
    for text in AWKWARD:
        same(*both, text or "")


def test_every_character(both):
    for start in range(0x20, 0x30000, 64):
        chars = [chr(c) for c in range(start, start + 64) if unicodedata.category(chr(c)) not in ("Cn", "Cs")]
        same(*both, "a".join(chars) + " " + " ".join(chars))


def test_random_strings(both):
    rng = random.Random(1)
    pool = "abcdeABCthing  \n\t'.,!?#0129éÉßΣς<|>endoftext日🙂́‍"
    for _ in range(400):
        same(*both, "".join(rng.choice(pool) for _ in range(rng.randint(0, 60))))


def test_documents(spark, both):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    _, library = both
    for r in encode_decode(docs, PATH).collect():
        want = library.encode(r.text, add_special_tokens=False).ids
        assert r.token_ids == want and r.decoded == library.decode(want, skip_special_tokens=False)


def test_rows_and_columns(spark, awkward, nothing):
    found = encode_texts(awkward.withColumnRenamed("kept", "Token_IDs"), PATH)
    assert found.columns == ["doc_id", "text", "bucket", "token_ids"] and found.count() == awkward.count()
    assert encode_decode(nothing, PATH).count() == 0


def test_memory_is_bounded(both):
    with open(PATH, encoding="utf-8") as file:
        small = Vocabulary(file.read(), remember=10)
    for k in range(100):
        same(small, both[1], f"word{k} other{k * k}")
    assert len(small.chunks) <= 10 and len(small.words) <= 10 and len(small.fragments) <= 10
