"""Held-out passages that appear, whole or in part, in a training corpus.

Every document is brought to plain words, and these to the codes they have in
the test items' vocabulary. Word n-grams of the items seed the search: a
document and an item that share enough seeds, or fewer of which one is rare in
the corpus, are aligned by Smith-Waterman over words, which finds passages that
are written differently or have single words changed, added or missing.

The test items are taken in blocks of a bounded number of words. A block is sent
to the executors, and the corpus is read in two narrow maps: the first keeps,
of documents that share a seed, the codes and the seeds; the frequencies of the
block's seeds are counted from these over the whole corpus; the second aligns.
No text is shuffled, and no seed or document is capped.

What counts (``allowed`` words of an item or passage may be changed or missing):
an item of fewer than ``PASSAGE`` words must appear whole but for these; of a
longer one a passage of ``PASSAGE`` words but for these, wherever they stand, or
an alignment that scores ``COPY``. A pair that counts shares as many seeds as ``needed`` says, so that it is a
candidate however frequent its seeds are.

Defined cases: null and empty texts and items match nothing; an item that
occurs twice under different ids is found under both; repeated documents are
each reported; Chinese and Japanese characters count as words; columns other
than the two named are ignored.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vernissage.llm.canonical import canonical
from vernissage.session import checkpoint, small_rows, spread

#: Words of a passage that counts, and how many of them may be changed or missing.
PASSAGE, CHANGED = 15, 2
#: Score (words equal less words changed, added or missing) from which a more densely changed copy counts.
COPY = 20
#: Words of a seed; seeds of items too short to share one of these for sure are shorter.
SEED = 4
#: A seed is rare if at most this share of the documents (or ``RARE_LEAST`` of them) has it. With a
#: rare one among them this many shared seeds make a candidate.
RARE_SHARE, RARE_LEAST, FEW = 0.001, 20, 2
#: Words of the items sent to the executors at a time.
BLOCK_WORDS = 1_000_000
#: Words of an item, and of a document, that are aligned at a time; neighbours overlap.
PIECE, STRETCH = 256, 2048

_TAGS = regex.compile(r"<[/!?a-zA-Z][^<>]*>")
_WORD = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]|[\p{L}\p{M}\p{N}--[\p{Han}\p{Hiragana}\p{Katakana}]]+", regex.V1)
_HYPHEN = regex.compile(r"(?<=\p{L})[-‐]\s*\n\s*(?=\p{Ll})")
_MARKS = regex.compile(r"\p{M}+")
_ASCII = re.compile(r"[a-z0-9]+")
_OTHER = re.compile("[^\x00-\x7f]")


@cache
def _folded() -> dict[str, str]:
    """Latin letters with accents and the plain letters they stand for; most typographic marks are blanks."""
    out = {"ß": "ss", "ł": "l", "ø": "o"} | dict.fromkeys("«»–—‘’‚“”„…€·¡¿•°×", " ")
    for cp in range(0xC0, 0x250):
        ch = chr(cp).lower()
        base = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
        if base.isascii() and base.isalpha():
            out.setdefault(chr(cp), base)
    return out


def _fold(m: re.Match) -> str:
    return _folded().get(m.group(), m.group())


def plain_words(text: str | None) -> list[str]:
    """Words in one form: no tags, entities, look-alikes, accents, capitals or broken words."""
    if not text:
        return []
    t = html.unescape(text) if "&" in text else text
    t = canonical(_TAGS.sub(" ", t) if "<" in t else t)
    if "\n" in t:
        t = _HYPHEN.sub("", t)
    t = t.lower()
    if not t.isascii():
        t = _OTHER.sub(_fold, t)
    if t.isascii():
        return _ASCII.findall(t)
    return _WORD.findall(_MARKS.sub("", unicodedata.normalize("NFKD", t)))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _words_udf(texts: pd.Series) -> pd.Series:
    return texts.map(plain_words)


def allowed(n_words: int) -> int:
    """Words of an item of this length that may be changed or missing: one in seven, ``CHANGED`` at most."""
    return min(CHANGED, n_words // 7)


def _shared(n_words: int, size: int) -> int:
    """Seeds of this size that a passage shares at least: errors part it into one more run than there are."""
    n, e = min(n_words, PASSAGE), allowed(n_words)
    return n - e - (e + 1) * (size - 1)


def seed_size(n_words: int) -> int:
    sure = [k for k in range(SEED, 0, -1) if _shared(n_words, k) >= 2]
    return sure[0] if sure else 1


def needed(n_words: int) -> int:
    return max(1, _shared(n_words, seed_size(n_words)))


def gram_hashes(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the n-grams of known words (codes from 0 on)."""
    n = len(codes) - size + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    h, known = np.full(n, size, np.uint64), np.ones(n, bool)
    for k in range(size):
        part = codes[k : k + n]
        known &= part >= 0
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + (part.astype(np.int64) + 1).astype(np.uint64)
    at = np.flatnonzero(known)
    h = h[at]
    return at, ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)


@dataclass
class Items:
    """A block of test items with the places of their seeds, sorted by hash."""

    ids: list
    codes: list[np.ndarray]
    vocabulary: dict[str, int]
    sizes: list[int]
    seeds: np.ndarray  # distinct hashes in order
    starts: np.ndarray  # places of seed i: starts[i] to starts[i + 1]
    item: np.ndarray
    place: np.ndarray
    needed: np.ndarray

    @classmethod
    def of(cls, rows: Sequence[tuple[object, Sequence[str]]]) -> Items:
        vocabulary: dict[str, int] = {}
        codes = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words], np.int32) for _, words in rows]
        found = [(i, *gram_hashes(c, seed_size(len(c)))) for i, c in enumerate(codes)]
        hashes = np.concatenate([h for *_, h in found]) if found else np.empty(0, np.int64)
        order = np.argsort(hashes, kind="stable")
        seeds, starts = np.unique(hashes[order], return_index=True)
        item = np.concatenate([np.full(len(h), i) for i, _, h in found])[order] if found else np.empty(0, np.int64)
        place = np.concatenate([at for _, at, _ in found])[order] if found else np.empty(0, np.int64)
        return cls([i for i, _ in rows], codes, vocabulary, sorted({seed_size(len(c)) for c in codes}), seeds, np.r_[starts, len(hashes)], item, place, np.array([needed(len(c)) for c in codes], np.int64))

    def encode(self, words: Sequence[str | None]) -> np.ndarray:
        return np.array([self.vocabulary.get(w, -1) for w in words], np.int32)

    def hits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the codes where a seed begins, in order, and its number."""
        places, numbers = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for size in self.sizes if len(self.seeds) else ():
            at, h = gram_hashes(codes, size)
            i = np.minimum(np.searchsorted(self.seeds, h), len(self.seeds) - 1)
            same = self.seeds[i] == h
            places.append(at[same])
            numbers.append(i[same])
        place, number = np.concatenate(places), np.concatenate(numbers)
        order = np.argsort(place, kind="stable")
        return place[order], number[order]

    def uses(self, numbers: np.ndarray) -> np.ndarray:
        """Indexes into ``item`` and ``place`` of all uses of distinct seeds."""
        lengths = self.starts[numbers + 1] - self.starts[numbers]
        return np.repeat(self.starts[numbers] - np.r_[0, lengths.cumsum()[:-1]], lengths) + np.arange(lengths.sum())

    def candidates(self, doc: np.ndarray, number: np.ndarray, rare: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and items that share enough places; ``doc`` and ``number`` tell the seeds of many documents."""
        seed = np.unique(doc.astype(np.int64) * len(self.seeds) + number)
        doc, number = seed // len(self.seeds), seed % len(self.seeds)
        lengths = self.starts[number + 1] - self.starts[number]
        pair = np.repeat(doc, lengths) * len(self.ids) + self.item[self.uses(number)]
        pairs, at, n = np.unique(pair, return_inverse=True, return_counts=True)
        with_rare = np.bincount(at, weights=np.repeat(rare[number], lengths), minlength=len(pairs)) > 0
        needed = self.needed[pairs % len(self.ids)]
        kept = pairs[(n >= needed) | (with_rare & (n >= np.minimum(FEW, needed)))]
        return kept // len(self.ids), kept % len(self.ids)

    def _neighbours(self, codes: np.ndarray) -> np.ndarray:
        return codes[:-1].astype(np.int64) * len(self.vocabulary) + codes[1:]

    def may_leak(self, docs: list[np.ndarray], doc: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Whether each document can hold a leak of each item, by the pairs of neighbouring words both have.

        A passage that counts keeps all pairs of its words but two for each
        error, at most; a copy by its score keeps ``COPY - 1``. Most documents that
        share a phrase only are told apart here, without an alignment.
        """
        if not len(doc):
            return np.zeros(0, bool)
        known, where = np.unique(np.concatenate([self._neighbours(c) for c in self.codes]), return_inverse=True)
        first = np.r_[0, np.cumsum([max(0, len(c) - 1) for c in self.codes])]
        of = np.repeat(np.arange(len(docs)), [max(0, len(c) - 1) for c in docs])
        found = np.concatenate([np.where((c[:-1] >= 0) & (c[1:] >= 0), self._neighbours(c), -1) for c in docs])
        at = np.minimum(np.searchsorted(known, found), max(0, len(known) - 1))
        same = known[at] == found if len(known) else np.zeros(len(found), bool)
        there = np.unique(of[same] * max(1, len(known)) + at[same])
        # All pairs of all candidates' items in a row; ``cum`` counts those the document has.
        lengths = first[item + 1] - first[item]
        begin = np.r_[0, lengths.cumsum()]
        within = np.arange(begin[-1]) - np.repeat(begin[:-1], lengths)
        key = np.repeat(doc, lengths) * max(1, len(known)) + where[np.repeat(first[item], lengths) + within]
        place = np.minimum(np.searchsorted(there, key), max(0, len(there) - 1))
        cum = np.r_[0, (there[place] == key if len(there) else np.zeros(len(key), bool)).cumsum()]
        words = np.array([len(c) for c in self.codes])[item]
        window = np.minimum(words, PASSAGE) - 1
        errors = np.array([allowed(n) for n in range(PASSAGE + 1)])[np.minimum(words, PASSAGE)]
        # The best window of each item: one that would pass its end is that at its end.
        wide = np.repeat(window, lengths)
        start = np.repeat(begin[:-1], lengths) + np.minimum(within, np.repeat(lengths, lengths) - wide)
        most, filled = np.zeros(len(doc), np.int64), lengths > 0
        if filled.any():
            most[filled] = np.maximum.reduceat(cum[start + wide] - cum[start], begin[:-1][filled])
        return (most >= window - 2 * errors) | (cum[begin[1:]] - cum[begin[:-1]] >= COPY - 1)


@dataclass(frozen=True)
class Alignment:
    """``ops``: for each step ``=`` equal, ``x`` changed, ``d`` missing from, ``i`` added in the document."""

    score: int = 0
    first: int = 0
    end: int = 0
    doc_first: int = 0
    doc_end: int = 0
    ops: str = ""

    def leaks(self, n_item: int) -> bool:
        """Whether a stretch of ``PASSAGE`` item words (or all there are) has no more errors than allowed.

        Item words before and after the alignment are errors. A longer, more
        densely changed copy counts by its score.
        """
        if self.score >= COPY:
            return True
        # Errors up to and including each item word; added words count with the word after them.
        marks = np.cumsum([*[1] * self.first, *self._errors(), *[1] * (n_item - self.end)])
        size = min(n_item, PASSAGE)
        before = np.r_[0, marks[:-size]] if len(marks) > size else np.zeros(1, int)
        return bool(self.ops) and int((marks[size - 1 :] - before).min()) <= allowed(n_item)

    def _errors(self) -> list[int]:
        out, added = [], 0
        for op in self.ops:
            if op == "i":
                added += 1
            else:
                out.append(added + (op != "="))
                added = 0
        return out


def align(item: np.ndarray, doc: np.ndarray) -> Alignment:
    """Best local alignment of two arrays of codes: match 1, mismatch or gap -1.

    One row of the matrix at a time; gaps along the row are a running maximum.
    """
    m = len(doc)
    if not len(item) or not m:
        return Alignment()
    # Scores are kept with their column number added: then a gap along the row costs nothing,
    # and the row's running maximum is all that it needs.
    column = np.arange(m + 1, dtype=np.int32)
    gain = np.where(item[:, None] == doc[None, :], np.int32(2), np.int32(0))
    g = np.empty((len(item) + 1, m + 1), dtype=np.int32)
    g[0] = column
    for i in range(len(item)):
        row = g[i + 1]
        np.subtract(g[i], 1, out=row)
        np.maximum(row, column, out=row)
        np.maximum(row[1:], g[i, :-1] + gain[i], out=row[1:])
        np.maximum.accumulate(row, out=row)
    h = g - column
    end, doc_end = (int(x) for x in np.unravel_index(h.argmax(), h.shape))
    i, j = end, doc_end
    top, ops = int(h[i, j]), []
    while i and j and h[i, j] > 0:
        same = doc[j - 1] == item[i - 1]
        if h[i, j] == h[i - 1, j - 1] + (1 if same else -1):
            ops.append("=" if same else "x")
            i, j = i - 1, j - 1
        elif h[i, j] == h[i - 1, j] - 1:
            ops.append("d")
            i -= 1
        else:
            ops.append("i")
            j -= 1
    return Alignment(top, i, end, j, doc_end, "".join(reversed(ops)))


def _leak_in(item: np.ndarray, doc: np.ndarray, least: int) -> Alignment | None:
    """The best alignment that leaks; where the best one does not, those beside it are looked at."""
    if min(len(item), len(doc)) < least:
        return None
    found = align(item, doc)
    if found.score < least:
        return None
    if found.leaks(len(item)):
        return found
    return _leak_in(item, doc[: found.doc_first], least) or _leak_in(item, doc[found.doc_end :], least)


def find_leak(item: np.ndarray, doc: np.ndarray, item_places: np.ndarray, doc_places: np.ndarray) -> Alignment | None:
    """A leak near the seeds both share; long items and documents are taken in overlapping parts.

    A passage that counts is shorter than half a part, so that one part holds it whole.
    """
    n = min(len(item), PASSAGE)
    least, reach = n - 2 * allowed(n), 2 * min(len(item), PIECE)
    doc_places = np.sort(doc_places)
    gaps = np.flatnonzero(np.diff(doc_places) > 2 * reach)
    stretches = [(max(0, int(doc_places[a]) - reach), min(len(doc), int(doc_places[b]) + SEED + reach)) for a, b in zip(np.r_[0, gaps + 1], np.r_[gaps, len(doc_places) - 1])]
    best: Alignment | None = None
    for p in range(0, max(1, len(item) - PIECE // 2), PIECE // 2):
        if not ((item_places >= p) & (item_places < p + PIECE)).any():
            continue
        for low, high in stretches:
            for at in range(low, high, STRETCH // 2):
                one = _leak_in(item[p : p + PIECE], doc[at : min(high, at + STRETCH)], least)
                if one and (best is None or one.score > best.score):
                    best = Alignment(one.score, one.first + p, one.end + p, one.doc_first + at, one.doc_end + at, one.ops)
                if at + STRETCH >= high:
                    break
    return best


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``doc_id, item_id, score, first_word, n_words`` of every leaked item in every document."""
    spark = docs.sparkSession
    test = checkpoint(items.select(F.col(item_id).alias("i"), _words_udf(F.col(text)).alias("w")).filter("size(w) > 0").distinct())
    n_blocks = -(-(test.agg(F.sum(F.size("w"))).first()[0] or 0) // BLOCK_WORDS) or 1
    texts = docs.select(F.col(doc_id).alias("d"), F.col(text).alias("t")).filter("t is not null")
    limit = max(RARE_LEAST, int(RARE_SHARE * texts.count()))
    texts = spread(texts)
    if n_blocks > 1:
        texts = checkpoint(texts.select("d", F.array_join(_words_udf("t"), " ").alias("t")))
    found = None
    for k in range(n_blocks):
        part = test.filter(F.pmod(F.xxhash64("i", "w"), F.lit(n_blocks)) == k)
        # A block holds about BLOCK_WORDS words, whatever the number of items.
        one = _block_leaks(texts, [(r["i"], r["w"]) for r in part.collect()], items.schema[item_id].dataType.simpleString(), limit, plain=n_blocks > 1)
        found = one if found is None else found.unionByName(one)
    return found.withColumnsRenamed({"d": doc_id, "i": item_id})


def _block_leaks(texts: DataFrame, rows: list, item_type: str, limit: int, plain: bool) -> DataFrame:
    """``d, i, score, first_word, n_words`` for one block of items."""
    sc = texts.sparkSession.sparkContext
    doc_type = texts.schema["d"].dataType.simpleString()
    block = Items.of(rows)
    shared = sc.broadcast(block)

    def sharing(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        items = shared.value
        least = min([FEW, *items.needed.tolist()])
        for pdf in batches:
            words = [t.split(" ") for t in pdf["t"]] if plain else [plain_words(t) for t in pdf["t"]]
            # All documents of the batch as one row of codes, with a word no item has between them.
            ends = np.cumsum([len(w) + 1 for w in words])
            codes = items.encode([w for one in words for w in (*one, None)])
            place, number = items.hits(codes)
            doc = np.searchsorted(ends, place, side="right")
            out = []
            with_hits, first = np.unique(doc, return_index=True)
            for k, a, b in zip(with_hits, first, np.r_[first[1:], len(doc)]):
                start = ends[k] - len(words[k]) - 1
                enough = len(items.uses(np.unique(number[a:b]))) >= least
                out.append((pdf["d"].iloc[k], codes[start : ends[k] - 1] if enough else None, (place[a:b] - start).astype(np.int32) if enough else None, number[a:b].astype(np.int32)))
            yield pd.DataFrame(out, columns=["d", "codes", "places", "seeds"])

    hits = checkpoint(texts.mapInPandas(sharing, f"d {doc_type}, codes array<int>, places array<int>, seeds array<int>"))
    frequent = hits.select(F.explode(F.array_distinct("seeds")).alias("seed")).groupBy("seed").agg(F.count("*").alias("df")).filter(F.col("df") > limit)
    # One row per seed of the block at most.
    rare = np.ones(len(block.seeds), bool)
    rare[[r["seed"] for r in small_rows(frequent.select("seed"), max(1, len(rare)), "the list of frequent seeds")]] = False
    told = sc.broadcast(rare)

    def aligned(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        items = shared.value
        for pdf in batches:
            out = []
            docs = [np.asarray(c, np.int32) for c in pdf["codes"]]
            doc = np.repeat(np.arange(len(docs)), [len(x) for x in pdf["seeds"]])
            number, place = (np.concatenate([np.asarray(x, np.int64) for x in pdf[c]]) if len(pdf) else np.empty(0, np.int64) for c in ("seeds", "places"))
            first = np.searchsorted(doc, np.arange(len(docs) + 1))
            with_doc, with_item = items.candidates(doc, number, told.value)
            likely = items.may_leak(docs, with_doc, with_item)
            for k, i in zip(with_doc[likely].tolist(), with_item[likely].tolist()):
                numbers, places = number[first[k] : first[k + 1]], place[first[k] : first[k + 1]]
                used = items.uses(np.unique(numbers))
                used = used[items.item[used] == i]
                own = np.isin(numbers, np.searchsorted(items.starts, used, side="right") - 1)
                found = find_leak(items.codes[i], docs[k], items.place[used], places[own])
                if found:
                    out.append((pdf["d"].iloc[k], items.ids[i], found.score, found.first, found.end - found.first))
            yield pd.DataFrame(out, columns=["d", "i", "score", "first_word", "n_words"])

    return hits.filter("codes is not null").mapInPandas(aligned, f"d {doc_type}, i {item_type}, score int, first_word int, n_words int")
