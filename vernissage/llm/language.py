"""Languages of documents and of their segments, with a confidence.

A multinomial naive Bayes model over hashed character n-grams is fitted on
sentences with a trusted language. Its matrix of log-probabilities (languages ×
buckets, a fixed size) is broadcast; sentences are scored in batches of sparse
counts in numpy. Within a document a Viterbi path over the sentences, with a
price for every change of language, gives the segments.

Titles, names and quoted phrases do not count: quoted text is taken out before
scoring, and a language needs a segment with enough words of its own.

Defined cases: null, empty and wordless texts have no language; a label that
names no known language is meaningless; without labelled sentences no text
has a language; a label in another notation or with a
region is the language it names; ties go to the first language by code.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vernissage.functions.text import fold
from vernissage.session import small_rows, spread

#: Labelled sentences the model is fitted on at most; more are refused, not sampled.
MAX_SAMPLES = 100_000
BUCKETS_BITS = 16
ORDERS = (1, 2, 3, 4)
#: n-grams of one place say nearly the same: the log-likelihood is divided by this.
TEMPERATURE = 4.0
#: Log-odds a change of language within a document costs.
SWITCH = 6.0
#: Default of ``min_words``: words from which on a segment makes its language one of the document's,
#: so that titles and names do not; a character of Chinese or Japanese is half a word.
MIN_WORDS = 8.0
#: Default of ``least_words``: words a text needs that has no such segment; below, it has no language.
LEAST_WORDS = 2.0
#: Documents at most from which the model learns further words of the languages it knows.
SAMPLE_DOCUMENTS = 2_000
#: Characters of a document of that sample at most; longer ones teach nothing, they are scored like all.
SAMPLE_CHARS = 20_000
#: Characters scored at a time, and of one piece of a sentence without end.
BATCH_CHARS, PIECE_CHARS = 400_000, 100_000

#: ISO 639-1 codes with their other codes and names.
LANGUAGE_NAMES = {
    "en": "eng english", "de": "deu ger german deutsch", "fr": "fra fre french francais", "es": "spa spanish espanol castellano",
    "it": "ita italian italiano", "pt": "por portuguese portugues", "nl": "nld dut dutch nederlands", "ru": "rus russian", "ja": "jpn japanese",
    "sv": "swe swedish svenska", "pl": "pol polish polski", "da": "dan danish", "no": "nor norwegian", "fi": "fin finnish", "cs": "ces cze czech",
    "hu": "hun hungarian", "ro": "ron rum romanian", "el": "ell gre greek", "tr": "tur turkish", "uk": "ukr ukrainian", "zh": "zho chi chinese", "ko": "kor korean", "ar": "ara arabic", "he": "heb hebrew", "ca": "cat catalan",
}

_TAGS = re.compile(r"<[/!?a-zA-Z][^<>]*>|https?://\S+|(?<!\S)[^\s@]+@\S+|#\w+")
#: Quoted phrases of any length, on one line; a straight mark after a letter or digit opens nothing (it may be inches).
_QUOTED = re.compile("|".join(rf"{a}[^{a}{b}\n]*{b}" for a, b in ("«»", "„“", "„”", "“”", "「」", "『』", "‹›")) + r"|(?<!\w)\"[^\"\n]*\"")
#: A sentence that ends within a quotation: what holds several sentences is text of its own, no phrase.
_INNER_END = re.compile(r"(?<=\w\w\w\w)[.!?…]\s+(?=[A-ZÀ-ÞΑ-ΩА-Я¿¡])|[。！？](?=[^。！？])")
_SENTENCE = re.compile(r"[^\n.!?。！？]+(?:[.!?]+(?![\s\n])[^\n.!?。！？]+)*[.!?。！？]*")
_WORDS = re.compile(r"[^\W\d_]+")
_MARKED = regex.compile(r"[\p{L}\p{M}]+")
_MARK = regex.compile(r"\p{M}")
_CJK = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]")


def _plain(text: str) -> str:
    if "<" in text or "&" in text or "#" in text or "@" in text or "://" in text:
        text = html.unescape(_TAGS.sub(" ", text))
    return unicodedata.normalize("NFC", text)


def _unquoted(text: str) -> str:
    """Text with blanks in the place of quoted phrases."""
    return _QUOTED.sub(lambda m: m.group() if _INNER_END.search(m.group()[1:-1]) else " " * len(m.group()), text)


def _letters(text: str) -> str:
    """Words in lower case with one blank around each; everything else is dropped."""
    text = text.lower()
    # Marks that stay after composition belong to their words; few texts have any.
    words = _WORDS.findall(text) if text.isascii() or not _MARK.search(text) else _MARKED.findall(text)
    return " " + " ".join(words) + " "


def _ngrams(texts: list[str], bits: int, orders: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order the bucket of every n-gram of all texts, in order, and the text it belongs to."""
    joined = "".join(texts)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in texts])
    code = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    h = np.zeros(len(code), dtype=np.uint64)
    for n in range(1, max(orders, default=0) + 1):
        if len(code) < n:
            break
        h = h[: len(code) - n + 1] * np.uint64(0x100000001B3) + code[n - 1 :] + np.uint64(1)
        if n in orders:
            own, g = owner[: len(h)], h
            if n > 1:
                within = own == owner[n - 1 :]
                own, g = own[within], g[within]
            yield (((g ^ (g >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - bits)).astype(np.int32), own


def ngram_buckets(texts: list[str], bits: int = BUCKETS_BITS, orders: tuple[int, ...] = ORDERS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of all orders and the text of each."""
    found = list(_ngrams(texts, bits, orders))
    if not found:
        return np.empty(0, np.int32), np.empty(0, np.int32)
    return np.concatenate([b for b, _ in found]), np.concatenate([o for _, o in found])


def _batches(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Pieces of texts with the text each is of, a bounded number of characters at a time."""
    of: list[int] = []
    part: list[str] = []
    size = 0
    for i, t in enumerate(texts):
        for at in range(0, max(1, len(t)), PIECE_CHARS):
            of.append(i)
            part.append(t[at : at + PIECE_CHARS])
            size += len(part[-1])
            if size >= BATCH_CHARS:
                yield of, part
                of, part, size = [], [], 0
    if part:
        yield of, part


@dataclass
class NaiveBayes:
    languages: list[str]
    by_bucket: np.ndarray  # log-probabilities, buckets × languages

    @classmethod
    def fit(cls, samples: list[tuple[str, str]], alpha: float = 0.05) -> NaiveBayes:
        languages = sorted({lang for lang, _ in samples})
        size = 1 << BUCKETS_BITS
        counts = np.zeros((len(languages), size))
        for i, lang in enumerate(languages):
            own = [_letters(_unquoted(_plain(t))) for x, t in samples if x == lang and t]
            for at in range(0, len(own), 200):
                counts[i] += np.bincount(ngram_buckets(own[at : at + 200])[0], minlength=size)
        counts += alpha
        return cls(languages, np.ascontiguousarray(np.log(counts / counts.sum(axis=1, keepdims=True)).T.astype(np.float32)))

    def scores(self, texts: list[str]) -> np.ndarray:
        """Tempered log-likelihood of every text under every language (texts × languages)."""
        out = np.zeros((len(texts), len(self.languages)), dtype=np.float64)
        for pieces, part in _batches(texts):
            of, whole = np.asarray(pieces), len(set(pieces)) == len(pieces)
            for b, owner in _ngrams(part, BUCKETS_BITS, ORDERS):
                if len(b):
                    # One row of probabilities per n-gram; n-grams of a text lie side by side.
                    starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                    sums, to = np.add.reduceat(self.by_bucket[b], starts, axis=0), of[owner[starts]]
                    if whole:
                        out[to] += sums
                    else:  # pieces of one text meet in one row
                        np.add.at(out, to, sums)
        return out / TEMPERATURE


@dataclass
class Segment:
    start: int
    end: int
    lang: str
    confidence: float
    words: float


def segments(model: NaiveBayes, texts: list[str]) -> list[list[Segment]]:
    """Segments of each text (places refer to the text without tags)."""
    pieces: list[str] = []
    spans: list[list[tuple[int, int, int, float]]] = []
    for text in texts:
        plain = _plain(text)
        bare = _unquoted(plain)
        own = []
        for m in _SENTENCE.finditer(bare) if model.languages else ():
            letters = _letters(m.group())
            if len(letters) > 2:
                cjk = 0 if letters.isascii() else len(_CJK.findall(letters))
                # Words of two letters or more; of East Asian text the characters count.
                words = sum([len(w) > 1 for w in letters.split()]) if not cjk else sum([not _CJK.search(w) for w in letters.split()])
                own.append((m.start(), m.end(), len(pieces), words + cjk / 2))
                pieces.append(letters)
        spans.append(own)
    score = model.scores(pieces) if pieces else np.zeros((0, len(model.languages)))
    out = []
    for own in spans:
        found: list[Segment] = []
        if own:
            rows = score[[p for _, _, p, _ in own]]
            path = _viterbi(rows)
            i = 0
            while i < len(own):
                j = i
                while j + 1 < len(own) and path[j + 1] == path[i]:
                    j += 1
                total = rows[i : j + 1].sum(axis=0)
                p = np.exp(total - total.max())
                found.append(Segment(own[i][0], own[j][1], model.languages[path[i]], float(p[path[i]] / p.sum()), sum(w for *_, w in own[i : j + 1])))
                i = j + 1
        out.append(found)
    return out


def _viterbi(rows: np.ndarray) -> list[int]:
    tops = rows.argmax(axis=1)
    if (tops == tops[0]).all():
        return [int(tops[0])] * len(tops)  # the best of every sentence: no path is better
    best, back = rows[0], []
    for r in rows[1:]:
        top = int(best.argmax())
        stay = best >= best[top] - SWITCH
        back.append(np.where(stay, np.arange(len(best)), top))
        best = np.where(stay, best, best[top] - SWITCH) + r
    path = [int(best.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def languages_of(found: list[Segment], min_words: float = MIN_WORDS, least_words: float = LEAST_WORDS) -> dict[str, float]:
    """Languages that count, with the confidence of their best segment."""
    out: dict[str, float] = {}
    for s in found:
        if s.words >= min_words:
            out[s.lang] = max(out.get(s.lang, 0.0), s.confidence)
    if not out and found:
        longest = max(found, key=lambda s: s.words)
        if longest.words >= least_words:
            out[longest.lang] = longest.confidence
    return out


def fit_model(samples: DataFrame, docs: DataFrame | None = None, lang: str = "lang", text: str = "text", id_col: str = "doc_id") -> NaiveBayes:
    """Model of the labelled sentences and, if given, of a bounded sample of labelled documents.

    The sample are the ``SAMPLE_DOCUMENTS`` documents with the least hash of
    their id among those with a usable label. A document teaches the model only
    if all its sentences together are in the language it is labelled with,
    judged by the model of the trusted sentences.
    """
    rows = small_rows(samples.select(lang, text).filter(F.col(lang).isNotNull() & F.col(text).isNotNull()), MAX_SAMPLES, "the labelled sentences")
    trusted = [(r[0], r[1]) for r in rows]
    model = NaiveBayes.fit(trusted)
    if docs is None or not model.languages:
        return model
    named = docs.select(label_language(lang).alias("named"), text, id_col).filter(F.col("named").isin(*model.languages) & (F.length(text) <= SAMPLE_CHARS))
    more = [(r["named"], r[text]) for r in named.orderBy(F.xxhash64(id_col), id_col).limit(SAMPLE_DOCUMENTS).collect()]
    agreed = []
    for (label, t), found in zip(more, segments(model, [t for _, t in more])):
        words = {}
        for s in found:
            words[s.lang] = words.get(s.lang, 0.0) + s.words
        if words and max(words, key=words.get) == label and words[label] >= 0.7 * sum(words.values()):
            agreed.append((label, t))
    return NaiveBayes.fit(trusted + agreed)


def document_segments(docs: DataFrame, model: NaiveBayes, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, segment, start, end, lang, confidence, words`` of every segment of every document."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def score(batches):
        for pdf in batches:
            for at in range(0, len(pdf), 256):
                part = pdf.iloc[at : at + 256]
                rows = [
                    (d, n, s.start, s.end, s.lang, s.confidence, s.words)
                    for d, found in zip(part[id_col], segments(shared.value, list(part[text])))
                    for n, s in enumerate(found)
                ]
                yield pd.DataFrame(rows, columns=["id", "segment", "start", "end", "lang", "confidence", "words"])

    rows = spread(docs.select(id_col, text).filter(F.col(text).isNotNull()))
    return rows.mapInPandas(score, f"id {kind}, segment int, start int, end int, lang string, confidence double, words double").withColumnRenamed("id", id_col)


def document_languages(docs: DataFrame, model: NaiveBayes, id_col: str = "doc_id", text: str = "text", label: str = "lang", min_words: float = MIN_WORDS, least_words: float = LEAST_WORDS) -> DataFrame:
    """``id, label, languages`` (map of language to confidence; empty for texts without words)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def score(batches):
        for pdf in batches:
            for at in range(0, len(pdf), 256):
                part = pdf.iloc[at : at + 256]
                found = segments(shared.value, [t or "" for t in part[text]])
                yield pd.DataFrame({"id": part[id_col].values, "label": part[label].values, "languages": [list(languages_of(f, min_words, least_words).items()) for f in found]})

    out = spread(docs.select(id_col, text, label)).mapInPandas(score, f"id {kind}, label string, languages array<struct<lang:string,confidence:double>>")
    return out.withColumnRenamed("id", id_col)


def label_language(c: Column | str) -> Column:
    """ISO 639-1 code a label names, in whatever notation and with any region; null if it names none."""
    names = {n: code for code, more in LANGUAGE_NAMES.items() for n in (code, *more.split())}
    table = F.create_map(*[F.lit(x) for kv in sorted(names.items()) for x in kv])
    key = fold(c)
    return F.coalesce(F.try_element_at(table, key), F.try_element_at(table, F.regexp_extract(key, r"^([a-z]{2,3})[-_][a-z0-9_-]+$", 1)))


def mislabelled(docs: DataFrame, model: NaiveBayes, **words: float) -> DataFrame:
    """``doc_id, lang, confidence``: one row per language of documents whose label does not tell their one language.

    ``words``: ``min_words`` and ``least_words`` of ``languages_of``.
    """
    found = document_languages(docs, model, **words)
    named = found.withColumn("named", label_language("label")).filter(F.size("languages") > 0)
    wrong = F.col("named").isNull() | (F.size("languages") > 1) | (F.col("languages")[0]["lang"] != F.col("named"))
    return named.filter(wrong).select("doc_id", F.inline("languages"))
