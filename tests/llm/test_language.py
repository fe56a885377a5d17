import numpy as np
import pytest
from llm_cases import ROWS, crc, frame, rows

from orderlens.llm import language

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def network(spark):
    return language.fit(spark.read.parquet(f"{FOLDER}/documents.parquet"))


def test_held_out_accuracy(spark, network):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    result = language.predict_languages(docs, network).collect()
    truth = dict(rows("documents", "doc_id, lang", FOLDER))
    assert len(result) == len(truth)
    assert all(r["held_out"] == (crc(r["doc_id"]) % 4 == 2) and 0 <= r["score"] <= 1 for r in result)
    held = [r for r in result if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_tables_equal_the_convolution(network):
    rng = np.random.default_rng(3)
    windows = rng.integers(0, 256, (5, language.WINDOW), dtype=np.uint8)
    pooled = []
    for w, f in zip(language.WIDTHS, network.filters, strict=True):
        places = range(language.WINDOW - w + 1)
        pooled.append([[max(network.embedding[x[i : i + w]].ravel() @ f[:, k] for i in places) for k in range(language.FILTERS)] for x in windows])
    hidden = np.maximum(np.concatenate(pooled, 1) + network.bias, 0)
    score = np.exp(hidden @ network.output + network.output_bias)
    expected = score / score.sum(1, keepdims=True)
    assert np.allclose(language.Predictor(network).probabilities(windows), expected, atol=1e-4)


def test_windows_cover_every_byte():
    texts = [b"", b"ab", b"x" * 256, b"y" * 700]
    offsets = np.cumsum([0, *map(len, texts)])
    windows, row, length = language.windows_of(np.frombuffer(b"".join(texts), np.uint8), offsets)
    back = [b"".join(w[:n].tobytes() for w, r, n in zip(windows, row, length, strict=True) if r == i) for i in range(4)]
    assert back == texts


def test_odd_rows(spark, network):
    docs = [*ROWS, (50, "12 34 !?"), (51, "一二三"), (52, "\u0300")]
    got = {(r["doc_id"], r["lang_pred"] == "und") for r in language.predict_languages(frame(spark, docs, ["lang", "score"]), network).collect()}
    for doc, text in docs:
        assert (doc, not any(c.isalpha() for c in text or "")) in got
    kept = language.keep_determined(frame(spark, docs, ["lang"]), network)
    assert kept.columns == ["doc_id", "text", "lang"]
    assert kept.count() == sum(any(c.isalpha() for c in t or "") for _, t in docs)


def test_nothing_labelled(spark):
    docs = frame(spark, ROWS).selectExpr("*", "cast(null as string) lang")
    network = language.fit(docs)
    assert network is None
    assert {r["lang_pred"] for r in language.predict_languages(docs, network).collect()} == {"und"}
    assert language.predict_languages(docs.limit(0), network).collect() == []


def test_sample_is_bounded_by_rows_of_each_language_alone(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    sample = language.training_sample(docs, 20, 50)
    counts = {lang: sum(1 for found, _ in sample if found == lang) for lang, _ in sample}
    assert set(counts.values()) == {20} and len(counts) == 4 and all(len(piece) <= 50 for _, piece in sample)
    allowed = {t for d, t, lang in rows("documents", "doc_id, text, lang", FOLDER) if crc(d) % 4 != 2}
    assert all(any(piece in t for t in allowed) for _, piece in sample)
    assert sorted(sample) == sorted(language.training_sample(docs.repartition(5), 20, 50))


def kept_share(spark, network, texts):
    return language.keep_determined(frame(spark, list(enumerate(texts))), network).count() / len(texts)


def test_gibberish_and_an_unlearnt_language_go_and_short_clean_texts_stay(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    every = rows("documents", "text, lang", FOLDER)
    network = language.fit(docs, reject=True)
    rng = np.random.default_rng(1)
    letters = list("abcdefghijklmnopqrstuvwxyz    ")
    gibberish = ["".join(rng.choice(letters, n)) for n in rng.integers(60, 900, 200)]
    assert kept_share(spark, network, gibberish) <= 0.02
    assert kept_share(spark, network, [t for t, _ in every if t]) >= 0.997
    for words in (2, 5, 20):
        short = [" ".join(t.split(" ")[3 : 3 + words]) for t, _ in every if t and len(t.split(" ")) > 40]
        assert kept_share(spark, network, short) >= 0.99
    three = language.fit(docs.filter("lang <> 'de'"), reject=True)
    assert kept_share(spark, three, [t for t, lang in every if lang == "de" and t]) <= 0.15
    assert kept_share(spark, three, [t for t, lang in every if lang != "de" and t]) >= 0.99
    for lang, text in (("pl", "Jeden język nigdy nie wystarcza, a przecież wszyscy ludzie mówią inaczej; dlatego szukamy słów."),
                       ("ru", "Это предложение написано по-русски, и сеть никогда не видела таких букв.")):
        assert kept_share(spark, network, [text]) == 0, lang
