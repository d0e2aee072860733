import pytest

from vernissage.llm import language as L

from ..conftest import rows

DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def samples(spark):
    return [(r.lang, r.text) for r in spark.read.parquet(f"{DIR}/lang_samples.parquet").orderBy("sample_id").collect()]


@pytest.fixture(scope="module")
def model(samples):
    return L.NaiveBayes.fit(samples)


def test_held_out_accuracy(samples):
    train = [s for i, s in enumerate(samples) if i % 3]
    held = [s for i, s in enumerate(samples) if i % 3 == 0]
    m = L.NaiveBayes.fit(train)
    got = [max(L.languages_of(x), key=L.languages_of(x).get) for x in L.segments(m, [t for _, t in held])]
    assert sum(g == lang for g, (lang, _) in zip(got, held)) >= 0.97 * len(held)


def test_documents_agree_with_trusted_labels(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    m = L.fit_model(spark.read.parquet(f"{DIR}/lang_samples.parquet"), docs)
    found = L.document_languages(docs.filter("lang in ('en', 'de', 'fr', 'es', 'it', 'pt', 'nl', 'ru', 'ja')"), m).filter("size(languages) = 1")
    right = found.filter("languages[0].lang = label").count()
    assert right > 0.85 * found.count()  # some labels are wrong


EN = "There are nine pieces in this group, and none of them is larger than a door. "
DE = "Bitte beachten Sie, dass die Farben auf Ihrem Bildschirm anders wirken können. "
RU = "Никто не ожидал, что маленькие рисунки так быстро найдут покупателя. "
JA = "この組には九点の作品があり、扉より大きいものはありません。"


@pytest.mark.parametrize(
    "text, langs",
    [
        (EN, {"en"}), (EN + DE, {"en", "de"}), (EN + "\n***\n" + RU, {"en", "ru"}), (JA + EN, {"ja", "en"}), (EN.upper(), {"en"}), (f"<p>{EN}</p>", {"en"}),
        (EN + "Синее окно.", {"en"}), (EN + "The work „Bitte beachten Sie, dass die Farben anders wirken können“ is small.", {"en"}), (EN + "Wilhelm Grünewald, Käthe Schröder.", {"en"}),
        ("", set()), (None, set()), ("1987, 2004 — 🎨", set()), ("12 x 30 cm; 3/50", set()), (EN * 200 + DE, {"en", "de"}),
    ],
)
def test_languages_of_texts(model, text, langs):
    assert set(L.languages_of(L.segments(model, [text or ""])[0])) == langs


def test_segments_cover_their_sentences(model):
    got = L.segments(model, [EN + EN + DE])[0]
    assert [s.lang for s in got] == ["en", "de"] and all(0.5 < s.confidence <= 1 for s in got)
    assert (EN + EN + DE)[got[1].start : got[1].end].strip() == DE.strip()


@pytest.mark.parametrize("label, code", [("en", "en"), ("EN", "en"), ("en_US", "en"), ("pt-BR", "pt"), ("Deutsch", "de"), ("ger", "de"), ("français", "fr"), ("xx", None), ("und", None), ("", None), (None, None), ("unknown", None), ("jpn", "ja"), ("english language", None)])
def test_labels(one, label, code):
    assert one(L.label_language("s"), "s string", label) == code


def test_mislabelled(spark, model):
    data = [(1, EN, "en"), (2, EN, "en-GB"), (3, EN, None), (4, EN, "de"), (5, EN + DE, "en"), (6, None, "de"), (7, "", None), (8, EN, "und"), (9, "🎨", "xx")]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, lang string")
    assert rows(L.mislabelled(docs, model), "doc_id", "lang") == [(3, "en"), (4, "en"), (5, "de"), (5, "en"), (8, "en")]


def test_a_sentence_without_end_is_scored_in_pieces(model, monkeypatch):
    text = " ".join([EN.strip(" .")] * 50)
    whole = model.scores([text, DE, text])
    monkeypatch.setattr(L, "PIECE_CHARS", 700)
    monkeypatch.setattr(L, "BATCH_CHARS", 1500)
    pieces = model.scores([text, DE, text])
    assert abs(pieces - whole).max() < 0.02 * abs(whole).max() and (pieces.argmax(1) == whole.argmax(1)).all()


def test_ngrams_do_not_cross_texts():
    together, owner = L.ngram_buckets([" ab ", " cd "])
    alone, _ = L.ngram_buckets([" cd "])
    assert sorted(together[owner == 1]) == sorted(alone)
    assert len(L.ngram_buckets([])[0]) == 0 and len(L.ngram_buckets(["", "a"])[0]) == 1



@pytest.mark.parametrize(
    "text, langs",
    [
        # Markup and quotations of any length; text that only looks like them.
        ('<p data-note="' + "Bitte beachten Sie die Farben dieser Ansicht " * 40 + '">' + EN + "</p>", {"en"}), ("“" + ", ".join(["Bitte beachten Sie die Farben dieser Ansicht"] * 20) + ".” " + EN, {"en"}),
        ('The panel is 12" high. ' + EN + DE + ' The other is 10" high.', {"en", "de"}), (EN + 'The work "Étude pour une forêt brûlée No. 51 de la rivière" is small.', {"en"}), (EN + "「静かな島で海辺の眺めを制作した作品である。」 " + EN, {"en"}), ("3 < 4. " + EN + DE + " 5 > 4.", {"en", "de"}), ('"' + DE * 3 + '"', {"de"}),
    ],
)
def test_markup_and_quotations_of_any_length(model, text, langs):
    assert set(L.languages_of(L.segments(model, [text])[0])) == langs


def test_least_words_are_parameters(spark, model):
    docs = spark.createDataFrame([(1, EN + "Bitte beachten Sie die Farben.", "en")], "doc_id bigint, text string, lang string")
    assert L.mislabelled(docs, model).count() == 0
    assert rows(L.mislabelled(docs, model, min_words=4.0), "doc_id", "lang") == [(1, "de"), (1, "en")]


def test_long_texts_are_read_in_linear_time(model):
    import time

    began = time.perf_counter()
    for text in ("x" * 300_000 + "@", "<" * 300_000, '"' * 100_001, "«" * 100_000, "日本の画家" * 60_000 + " http://x"):
        L._unquoted(L._plain(text))
    assert time.perf_counter() - began < 5
