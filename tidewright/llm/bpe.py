"""BPE encoding and decoding by forced boundaries.

Two neighbouring bytes that stand together inside no token of the vocabulary can never
be merged over, so a cut between them is certain. Words are cut there and the fragments
are encoded on their own; merges are local, so their tokens, put together, are the
word's. The vocabulary is a `tokenizers` JSON file of the kind: NFC, white space to
one space, lower case, split by a pattern, bytes as characters, an end-of-word mark.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import REMEMBERED, ship, slices, text_bytes, with_fields, without

# White space as the vocabulary's normalizer knows it (Unicode White_Space)
WHITE = "".join(map(chr, [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def byte_characters() -> list[str]:
    """The character that stands for each byte in the vocabulary: printable Latin-1 for
    itself, the others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Memory:
    """What was computed for the latest keys: two halves of bounded size, the older of
    which is dropped when the newer is full."""

    def __init__(self, most: int):
        self.half, self.new, self.old = max(1, most // 2), {}, {}

    def get(self, key):
        found = self.new.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.new) >= self.half:
            self.old, self.new = self.new, {}
        self.new[key] = value

    def __len__(self) -> int:
        return len(self.new) + len(self.old)


class Vocabulary:
    """Tokens, merges and cuts of one file, and bounded memories of chunks, words and fragments."""

    def __init__(self, text: str, remember: int = 600_000):
        said = json.loads(text)
        model = said["model"]
        self.ids: dict[str, int] = dict(model["vocab"])
        self.end = model["end_of_word_suffix"] or ""
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.rank = {(a, b): k for k, (a, b) in enumerate(pairs)}
        special = {t["content"]: t["id"] for t in said["added_tokens"]}
        self.special = special
        names = self.ids | special
        self.tokens = [""] * (max(names.values()) + 1)
        for name, number in names.items():
            self.tokens[number] = name
        pattern = said["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.split = regex.compile(pattern)
        self.unspaced = re.compile(f"[^{WHITE}]+")
        self.marked = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True)) + ")")
        self.alphabet = byte_characters()
        # pairs of neighbours inside tokens; the last symbol of a word carries the mark
        self.inside = {pair for token in self.ids for s in [self.symbols(token)] for pair in zip(s, s[1:])}
        self.chunks, self.words, self.fragments = Memory(remember), Memory(remember), Memory(remember // 4)

    def symbols(self, token: str) -> tuple[str, ...]:
        if self.end and token.endswith(self.end) and len(token) > len(self.end):
            body = token[:-len(self.end)]
            return (*body[:-1], body[-1] + self.end)
        return tuple(token)

    def fragment(self, symbols: tuple[str, ...]) -> bytes:
        """Ids of one fragment: the merge of the lowest rank first, from the left."""
        known = self.fragments.get(symbols)
        if known is not None:
            return known
        parts, ranks = list(symbols), self.rank
        while len(parts) > 1:
            best, pair = len(ranks), None
            for p in zip(parts, parts[1:]):
                rank = ranks.get(p, best)
                if rank < best:
                    best, pair = rank, p
            if pair is None:
                break
            merged, k = [], 0
            while k < len(parts):
                if k + 1 < len(parts) and (parts[k], parts[k + 1]) == pair:
                    merged.append(parts[k] + parts[k + 1])
                    k += 2
                else:
                    merged.append(parts[k])
                    k += 1
            parts = merged
        found = array("i", [self.ids[p] for p in parts]).tobytes()
        self.fragments.put(symbols, found)
        return found

    def word(self, word: str) -> bytes:
        """Ids of one word, fragment by fragment."""
        symbols = [self.alphabet[b] for b in word.encode()]
        symbols[-1] += self.end
        inside, found, start = self.inside, [], 0
        for k, pair in enumerate(zip(symbols, symbols[1:]), 1):
            if pair not in inside:
                found.append(self.fragment(tuple(symbols[start:k])))
                start = k
        found.append(self.fragment(tuple(symbols[start:])))
        ids = b"".join(found)
        if len(word) <= 64:
            self.words.put(word, ids)
        return ids

    def chunk(self, chunk: str) -> bytes:
        """Ids (int32) of a run of characters without white space."""
        known = self.chunks.get(chunk)
        if known is not None:
            return known
        found: list[bytes] = []
        for part in self.marked.split(chunk) if "<" in chunk else (chunk,):
            if part in self.special:
                found.append(array("i", [self.special[part]]).tobytes())
                continue
            if not part.isascii():
                part = unicodedata.normalize("NFC", part)
                part = "".join([c.lower() for c in part])  # one by one: no final sigma
            else:
                part = part.lower()
            for word in self.split.findall(part):
                found.append(self.words.get(word) or self.word(word))
        ids = b"".join(found)
        if len(chunk) <= 64:
            self.chunks.put(chunk, ids)
        return ids

    def encode(self, text: str) -> bytes:
        # str.split knows the same white space, and four separators more
        odd = "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text
        known, chunk = self.chunks.new.get, self.chunk
        found = []
        for c in self.unspaced.findall(text) if odd else text.split():
            ids = known(c)
            if ids is None:
                ids = chunk(c)
                known = self.chunks.new.get
            found.append(ids)
        return b"".join(found)

    def decode(self, ids: list[int]) -> str:
        """Without a decoder in the file, the library joins tokens by spaces."""
        return " ".join(map(self.tokens.__getitem__, ids))


@cache
def vocabulary(text: str) -> Vocabulary:
    return Vocabulary(text)


REMEMBERED.append(vocabulary)


def encode_decode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "token_ids",
                  decoded_col: str = "decoded", chunk_bytes: int = 2 << 20) -> DataFrame:
    """`docs` with the token ids of its text and the text decoded from them. `path` names
    the vocabulary file, read once on the driver and sent along (under 4 MB); nothing is
    truncated or padded, and no special token is added.

    Nulls: a null text is empty: no ids, decoded to the empty text. Repeated rows and
    ties: each row on its own. Empty table: no rows. Columns of `docs` called like the
    new ones are replaced. Characters that Python's Unicode tables do not know yet are
    taken as neither letters nor digits, and have no lower case.
    """
    ship(docs)
    with open(path, encoding="utf-8") as file:
        sent = docs.sparkSession.sparkContext.broadcast(file.read())
    docs = without(docs, ids_col, decoded_col)
    schema = with_fields(docs, f"`{ids_col}` array<int>, `{decoded_col}` string")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(sent.value)
        for batch in slices(batches, text_col, chunk_bytes, vocabulary):
            blobs = [vocab.encode(t.decode("utf-8", "replace")) for t in text_bytes(batch.column(text_col))]
            ends = np.cumsum([0, *(len(b) // 4 for b in blobs)])
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(blobs), "<i4")))
            decoded = [vocab.decode(np.frombuffer(b, "<i4").tolist()) for b in blobs]
            yield pa.record_batch([*batch.columns, ids, pa.array(decoded, pa.string())],
                                  names=[*batch.schema.names, ids_col, decoded_col])

    return docs.mapInArrow(run, schema)


def encode_texts(docs: DataFrame, path: str, **options) -> DataFrame:
    """`docs` with the token ids of its text; see encode_decode."""
    return without(encode_decode(docs, path, **options), options.get("decoded_col", "decoded"))
