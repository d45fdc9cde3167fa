"""Token counts by the whole-token shortcut.

Offline, each string of the vocabulary is encoded alone; those that give one token, their own, are *proven*.
In the corpus a pre-token that is proven counts one without any merging; only the rest is merged.

Pre-tokens come from pieces cut at ASCII white space. Byte-level pre-tokenisation gives the same inside a
piece as inside the text, unless white space beyond ASCII or a special string is near: such texts are encoded
whole by the library.

Null texts count as empty (0 bytes, 0 tokens); repeated rows and null ids pass through; an empty table gives
an empty result; texts of any length are worked on whole; other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docstream.llm.shipping import ship
from docstream.llm.tokenizing import Memory, load, once, tokenizer_file

PIECES = re.compile(r" ?[^ \t\n\r\f\v]+|[ \t\n\r\f\v]+(?![^ \t\n\r\f\v])|[ \t\n\r\f\v]")
#: White space, for one table of characters or another, that the pieces are not cut at.
OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0 ᠎ -‏    ⁠　﻿]")
#: The letter of a blank in a byte-level vocabulary.
BLANK = chr(256 + 32)
SCHEMA = "doc_id long, n_bytes long, n_tokens long"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def whole_tokens(json_text: str) -> frozenset[str]:
    """Vocabulary strings proven to encode alone as one token, their own; as many as the vocabulary at most."""
    tokenizer, letters = load(json_text), byte_letters()
    candidates, ids = [], []
    for token, number in tokenizer.get_vocab(with_added_tokens=False).items():
        try:
            candidates.append(bytes(letters[c] for c in token).decode("utf-8"))
        except (KeyError, UnicodeDecodeError):
            continue
        ids.append(number)
    found = tokenizer.encode_batch(candidates, add_special_tokens=False)
    return frozenset(text for text, number, got in zip(candidates, ids, found, strict=True) if got.ids == [number])


class Counter:
    """Counts the tokens of texts in a worker."""

    TOGETHER = 1000

    def __init__(self, json_text: str, whole: frozenset[str]):
        self.tokenizer, self.whole = load(json_text), whole
        self.cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memory = Memory(self._pieces)
        #: Stops that are one token alone; after letters they are a pre-token of their own.
        self.STOPS = {c for c in ".,;:!?" if c in whole}
        vocabulary = self.tokenizer.get_vocab()
        self.starts = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.starts[[n for token, n in vocabulary.items() if token.startswith(BLANK)]] = True

    def _merge(self, pretokens: list[str]) -> list[int]:
        """Tokens of each pre-token. Those of a blank and letters are merged many at once: each starts with a blank."""
        counts = [0] * len(pretokens)
        plain = [k for k, text in enumerate(pretokens) if text[0] == " " and text[1:].isalpha()]
        single = [k for k, text in enumerate(pretokens) if not (text[0] == " " and text[1:].isalpha())]
        groups = [plain[k : k + self.TOGETHER] for k in range(0, len(plain), self.TOGETHER)]
        joined = self.tokenizer.encode_batch_fast(["".join([pretokens[k] for k in g]) for g in groups], add_special_tokens=False)
        for group, got in zip(groups, joined, strict=True):
            ids = np.array(got.ids)
            starts = np.flatnonzero(self.starts[ids])
            if len(starts) != len(group):
                single += group
                continue
            for k, n in zip(group, np.diff(starts, append=len(ids)).tolist(), strict=True):
                counts[k] = n
        alone = self.tokenizer.encode_batch_fast([pretokens[k] for k in single], add_special_tokens=False)
        for k, got in zip(single, alone, strict=True):
            counts[k] = len(got.ids)
        return counts

    def _pieces(self, pieces: list[str]) -> list[int]:
        """Tokens of each piece: one for each proven pre-token, and what merging gives for the rest."""
        counts, rest = [0] * len(pieces), []
        for k, piece in enumerate(pieces):
            if piece in self.whole:
                counts[k] = 1
                continue
            letters = piece[1:] if piece[0] == " " else piece
            if letters.isalpha():
                rest.append((k, piece))
            elif letters[-1:] in self.STOPS and letters[:-1].isalpha():
                counts[k] = 1
                if piece[:-1] in self.whole:
                    counts[k] += 1
                else:
                    rest.append((k, piece[:-1]))
            else:
                for _, (start, end) in self.cut(piece):
                    pretoken = piece[start:end]
                    if pretoken in self.whole:
                        counts[k] += 1
                    else:
                        rest.append((k, pretoken))
        for (k, _), n in zip(rest, self._merge([x for _, x in rest]), strict=True):
            counts[k] += n
        return counts

    def count(self, texts: list[str | None]) -> list[int]:
        found: list[int | None] = []
        cut: list[list[str]] = []
        for text in texts:
            text = text or ""
            if any(s in text for s in self.special) or OTHER_SPACE.search(text):
                found.append(len(self.tokenizer.encode(text, add_special_tokens=False).ids))
            else:
                found.append(None)
                cut.append(PIECES.findall(text))
        known = self.memory.ready(set().union(*cut)) if cut else {}
        rest = iter(cut)
        return [sum(map(known.__getitem__, next(rest))) if n is None else n for n in found]


def count_tokens(docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``n_bytes`` and ``n_tokens`` of each row, as the tokenizer file ``tokenizer`` counts them."""
    ship(docs.sparkSession)
    json_text = tokenizer_file(tokenizer)
    shared = docs.sparkSession.sparkContext.broadcast((json_text, whole_tokens(json_text)))
    mark = zlib.crc32(json_text.encode())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = once(("counter", mark), lambda: Counter(*shared.value))
        for batch in batches:
            for start in range(0, max(batch.num_rows, 1), 256):
                part = batch.slice(start, 256)
                texts = part.column(1)
                counts = counter.count(texts.to_pylist())
                sizes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
                yield pa.record_batch([part.column(0), sizes, pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    found = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(work, SCHEMA)
    return found.withColumnRenamed("doc_id", key)


def over(limit: int) -> Column:
    """Whether a row has more tokens than a window of ``limit`` holds."""
    return F.col("n_tokens") > F.lit(limit)
