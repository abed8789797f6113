"""What a worker holds from tasks of other operators."""

import numpy as np
import pyarrow as pa

from tidewright.llm import fmindex
from tidewright.llm.bpe import vocabulary
from tidewright.llm.common import gathered, slices
from tidewright.llm.queries import TOKENIZERS


def test_other_operators_tasks_give_back_what_bpe_remembers():
    with open(f"{TOKENIZERS}/word_bpe_49k.json", encoding="utf-8") as file:
        text = file.read()
    batch = pa.record_batch([["some words", None]], names=["text"])
    known = vocabulary(text)
    list(slices([batch], "text", 100, vocabulary))
    assert vocabulary(text) is known
    list(slices([batch], "text", 100))
    assert vocabulary.cache_info().currsize == 0
    vocabulary(text)
    list(gathered([]))
    assert vocabulary.cache_info().currsize == 0


def test_suffix_order_beside_plain_sorting():
    rng = np.random.default_rng(5)
    for n in (1, 2, 50, 400):
        text = np.append(rng.integers(1, 4, n), 0).astype(np.int32)
        order = fmindex.suffix_order(text, n + 1)
        assert order.tolist() == sorted(range(n + 1), key=lambda i: text[i:].tolist())
        assert order.dtype == np.int32
