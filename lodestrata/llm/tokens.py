"""Sizes of texts in tokens of a public tokenizer, and word-hash projections of the same texts.

Tokens never reach across a space that follows a word, so a text is counted word by word: the tokenizer runs once per
distinct word and the counts are kept in a bounded table. Texts whose white space breaks that rule (a space between
other white space) are encoded whole. Both ways give exactly the tokenizer's number.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: The vocabulary's path on every executor, and the pattern it is used with (fixed value).
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MAX_WORDS = 400_000
DIMS = 3
_IRREGULAR = re.compile(r"\s (?:\s|\Z)")


class Sizer:
    """Counts tokens of texts and, if ``project``, projects their words to ``DIMS`` dimensions."""

    def __init__(self, vocabulary: str = VOCABULARY, project: bool = True) -> None:
        import tiktoken

        self.project = project

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._clear()

    def _clear(self) -> None:
        self.ids: dict[str, int] = {}
        self.sizes = np.zeros(1024, np.int64)
        self.vectors = np.zeros((1024, DIMS))

    def _id(self, word: str) -> int:
        n = len(self.ids)
        if n == len(self.sizes):
            self.sizes = np.concatenate([self.sizes, np.zeros_like(self.sizes)])
            self.vectors = np.concatenate([self.vectors, np.zeros_like(self.vectors)])
        self.ids[word] = n
        self.sizes[n] = len(self.encoding.encode_ordinary(" " + word))
        if not self.project:
            return n
        digest = hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=4 * DIMS).digest()
        self.vectors[n] = np.frombuffer(digest, np.uint32) / 2**31 - 1
        return n

    def measure(self, text: str | None) -> tuple[int, np.ndarray]:
        """(tokens, mean projection of the words) of a text."""
        if not text:
            return 0, np.zeros(DIMS)
        if len(self.ids) > MAX_WORDS:
            self._clear()
        words = text.split(" ")
        ids = self.ids
        try:
            at = [ids[w] for w in words]
        except KeyError:
            at = [ids[w] if w in ids else self._id(w) for w in words]
        vector = self.vectors[at].mean(0) if self.project else self.vectors[0]
        if _IRREGULAR.search(text):
            return len(self.encoding.encode_ordinary(text)), vector
        first = len(self.encoding.encode_ordinary(words[0])) if words[0] else 0
        return first + int(self.sizes[at[1:]].sum()), vector


@lru_cache(maxsize=2)
def sizer_of(vocabulary: str, project: bool = True) -> Sizer:
    """One sizer per worker process and vocabulary; its table of words serves all tasks of the worker."""
    return Sizer(vocabulary, project)


def sized(df: DataFrame, id_col: str, text_col: str, keep: list[str], vocabulary: str = VOCABULARY, project: bool = True) -> DataFrame:
    """``doc_id``, the columns ``keep``, ``n_tokens`` and, if ``project``, the projections ``x0``.. of every row."""
    rows = df.select(df[id_col].cast("bigint").alias("doc_id"), *[df[c] for c in keep], df[text_col].alias("__text"))
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    shape = ", ".join([f"`{c}` {types[c]}" for c in ("doc_id", *keep)] + ["n_tokens bigint"] + [f"x{i} float" for i in range(DIMS if project else 0)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sizer = sizer_of(vocabulary, project)
        for batch in batches:
            got = [sizer.measure(t) for t in batch.pop("__text")]
            batch["n_tokens"] = np.array([n for n, _ in got], np.int64)
            if project:
                vectors = np.array([v for _, v in got], np.float32).reshape(len(got), DIMS)
                for i in range(DIMS):
                    batch[f"x{i}"] = vectors[:, i]
            yield batch

    return rows.mapInPandas(run, shape)
