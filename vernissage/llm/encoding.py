"""Encoding of a corpus with a public byte-level BPE tokenizer.

A text is encoded by a tree reduction: it is halved until a part is no longer
than ``leaf`` characters, parts are encoded to ids, and two neighbours are
joined by encoding a window over their seam again. The window grows on both
sides until the tokens outside it are proven to stay; the ids before it, of it
and after it are then concatenated up the tree, and so are decoded bytes. The
join is associative with the empty node as its unit. Encoding is a narrow map
without shuffle.

The proof: at a *cut*, a place where any match of the word pattern that covers
the character before must end (see ``CUT``), the ids of the text are those of
the text before and those of the text after. Whether a place is a cut depends on the
characters beside it alone, so a cut within a part is a cut of the whole. The
window runs from the last cut before the seam to the first one after it. Where
there is none up to the end of a part, that part is encoded again as a whole.

Defined cases: empty and null texts give the empty list; strings of special
tokens are ordinary text; unpaired surrogates cannot occur in Spark strings.
"""

from __future__ import annotations

import base64
from collections.abc import Callable

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vernissage.session import spread

#: Where the vocabulary files are, unless a caller says otherwise.
TOKENIZERS = "/opt/tokenizers"

#: Fixed value: the word pattern of the byte-level BPE vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Letters, digits and signs that every version of Unicode classes alike; a cut lies beside such
#: characters only, so that the two pattern engines cannot disagree about it.
_L, _N, _S = r"A-Za-zÀ-ÖØ-öø-ɏа-яА-Яα-ωぁ-ゖァ-ヺ一-龥가-힣", "0-9", r"!-&(-/:-@\[-`{-~«»‐-”、。「」"

#: Places where a word ends whatever stands further off: before a blank between two characters that
#: are none, and between characters of two classes. After an apostrophe a letter may belong to it.
CUT = regex.compile(rf"(?<=[{_L}{_N}{_S}])(?= [{_L}{_N}{_S}'])|(?<=[{_L}])(?=[{_N}{_S}'])|(?<=[{_N}])(?=[{_L}{_S}'])|(?<=[{_S}])(?=[{_L}{_N}])")

#: Characters of a leaf at most, and of the first window on each side of a seam.
LEAF, WINDOW = 1024, 32

#: Bytes of a vocabulary file at most; it is sent to the executors.
MAX_VOCABULARY = 64 << 20


class TreeEncoder:
    """Encodes texts of any length; ``leaf`` is the longest part encoded in one piece."""

    def __init__(self, vocabulary: bytes, leaf: int = LEAF, window: int = WINDOW):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line)}
        encoding = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.piece_ids: Callable[[str], list[int]] = encoding.encode_ordinary
        self.piece_bytes: Callable[[list[int]], bytes] = encoding.decode_bytes
        self.leaf, self.window = max(leaf, 1), max(window, 1)

    def encode(self, text: str | None) -> list[int]:
        return self.reduce(text, 0, len(text)) if text else []

    def reduce(self, text: str, start: int, end: int) -> list[int]:
        """Ids of ``text[start:end]``."""
        if end - start <= self.leaf:
            return self.piece_ids(text[start:end])
        seam = (start + end) // 2
        return self.join(text, start, seam, end, self.reduce(text, start, seam), self.reduce(text, seam, end))

    def join(self, text: str, start: int, seam: int, end: int, left: list[int], right: list[int]) -> list[int]:
        """Ids of ``text[start:end]`` from those of its parts before and after the seam."""
        a, b = self.last_cut(text, start, seam), self.first_cut(text, seam, end)
        kept = len(left) - len(self.piece_ids(text[a:seam]))
        dropped = len(self.piece_ids(text[seam:b]))
        return left[:kept] + self.piece_ids(text[a:b]) + right[dropped:]

    def last_cut(self, text: str, start: int, seam: int) -> int:
        """The last cut of ``text[start:seam]``, looked for in growing windows; its start if there is none."""
        size = self.window
        while True:
            at = max(start, seam - size)
            cuts = [m.start() for m in CUT.finditer(text, at, seam) if m.start() > start]
            if cuts or at == start:
                return cuts[-1] if cuts else start
            size *= 2

    def first_cut(self, text: str, seam: int, end: int) -> int:
        """The first cut of ``text[seam:end]``, looked for in growing windows; its end if there is none."""
        size = self.window
        while True:
            stop = min(end, seam + size)
            cut = next((m.start() for m in CUT.finditer(text, seam, stop) if m.start() > seam), None)
            if cut is not None or stop == end:
                return end if cut is None else cut
            size *= 2

    def decode(self, ids: list[int]) -> str:
        """The text of ids: bytes of leaves of ids, concatenated up the tree."""

        def part(a: int, b: int) -> bytes:
            if b - a <= self.leaf:
                return self.piece_bytes(ids[a:b])
            return part(a, (a + b) // 2) + part((a + b) // 2, b)

        return part(0, len(ids)).decode("utf-8", errors="replace")


def load_vocabulary(name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> bytes:
    with open(f"{folder}/{name}.tiktoken", "rb") as f:
        data = f.read(MAX_VOCABULARY + 1)
    if len(data) > MAX_VOCABULARY:
        raise ValueError(f"{name} is larger than {MAX_VOCABULARY} bytes")
    return data


_encoders: dict[tuple[int, int], TreeEncoder] = {}


def encoder_udf(spark, name: str = "byte_bpe_50k", folder: str = TOKENIZERS, leaf: int = LEAF) -> Callable[[Column], Column]:
    vocabulary = spark.sparkContext.broadcast(load_vocabulary(name, folder))

    @F.pandas_udf(T.ArrayType(T.IntegerType(), False))
    def encode(texts: pd.Series) -> pd.Series:
        key = (hash(vocabulary.value), leaf)
        if key not in _encoders:
            _encoders[key] = TreeEncoder(vocabulary.value, leaf)
        enc = _encoders[key]
        return pd.Series([enc.encode(t) for t in texts], dtype=object)

    return encode


def encode_corpus(docs: DataFrame, text: str = "text", out: str = "ids", **options) -> DataFrame:
    """Adds ``out``: the token ids of every text."""
    return spread(docs).withColumn(out, encoder_udf(docs.sparkSession, **options)(F.col(text)))
