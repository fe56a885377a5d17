"""Language identification by a byte convolutional network, trained in numpy.

Bytes (A-Z folded) are embedded; filters of several widths slide over a fixed window, each keeps its largest response,
and a softmax over the kept responses gives the languages' probabilities. Training takes a bounded sample of labelled rows:
``per_language`` texts of each language, those of the smallest hash of the id, and of a text longer than ``piece_chars``
a piece of that length from a place that a hash chooses. Prediction covers the whole text: all its windows, in batches,
weighted by their bytes.

A network may have one class more, which stands for no known language. It learns from counterfeits of the sampled pieces:
letters dealt out anew, or exchanged for others throughout, so that lengths, spaces and marks stay and only the language
goes. A text is rejected if its mean probability of that class is above the bound for its length; bounds are set on a
quarter of the sample that is not learnt from, so that its pieces, cut to all lengths, stay.

For prediction a filter is folded into tables over byte pairs, so a response is two lookups and a sum.

Defined cases: a null text and a text without a letter are ``und`` with score 0, and so is every text when nothing is
labelled; a short window is padded with zero bytes; equal probabilities go to the first language by name; repeated
rows are predicted each; a row without an id counts as training row; extra columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import FOLD, text_slices

WINDOW = 256
EMBEDDING = 8
FILTERS = 16
WIDTHS = (2, 3, 4)
SAMPLE_PER_LANGUAGE = 400
SAMPLE_CHARS = 480
LEAST_REJECTION = 0.5  # mean probability of no known language below which no text is rejected
LENGTH_CLASSES = 12  # by powers of two of the bytes; the last holds all longer texts
EPOCHS = 10
BATCH = 32
CHUNK = 256  # windows that are looked up together
UNDETERMINED = "und"


@dataclass
class Network:
    """Languages in order and the weights: byte embedding, filters by width, filter biases, output layer.

    With ``bounds``, by length class, the output layer has one more class for no known language.
    """

    languages: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    output: np.ndarray
    output_bias: np.ndarray
    bounds: np.ndarray | None = None


def windows_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of the rows of a slice: bytes (n, WINDOW), row and length of each."""
    size = np.diff(offsets)
    count = -(-size // WINDOW)
    row = np.repeat(np.arange(len(size)), count)
    number = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[row] + number * WINDOW
    length = np.minimum(offsets[row + 1] - start, WINDOW)
    place = start[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < length[:, None]
    found = np.where(inside, FOLD[data[np.minimum(place, max(len(data) - 1, 0))]] if len(data) else 0, 0)
    return found.astype(np.uint8), row, length


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], classes: int, seed: int = 7) -> Network:
    """Fit a network to byte windows and their classes' numbers by Adam on the cross-entropy."""
    rng = np.random.default_rng(seed)
    net = Network(
        languages,
        rng.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32),
        [rng.normal(0, 1 / np.sqrt(w * EMBEDDING), (w * EMBEDDING, FILTERS)).astype(np.float32) for w in WIDTHS],
        np.zeros(len(WIDTHS) * FILTERS, np.float32),
        rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, classes)).astype(np.float32),
        np.zeros(classes, np.float32),
    )
    weights = [net.embedding, *net.filters, net.bias, net.output, net.output_bias]
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            bytes_, n = windows[pick], len(pick)
            embedded = net.embedding[bytes_]
            pooled, chosen = [], []
            for w, f in zip(WIDTHS, net.filters, strict=True):
                columns = np.concatenate([embedded[:, i : WINDOW - w + 1 + i] for i in range(w)], axis=2)
                response = (columns.reshape(-1, w * EMBEDDING) @ f).reshape(n, -1, FILTERS)
                best = response.argmax(1)
                chosen.append(best)
                pooled.append(np.take_along_axis(response, best[:, None], 1)[:, 0])
            raw = np.concatenate(pooled, 1) + net.bias
            hidden = np.maximum(raw, 0)
            wrong = _softmax(hidden @ net.output + net.output_bias)
            wrong[np.arange(n), labels[pick]] -= 1
            wrong /= n
            back = (wrong @ net.output.T) * (raw > 0)
            d_embedding, d_filters = np.zeros_like(net.embedding), []
            for k, (w, f, best) in enumerate(zip(WIDTHS, net.filters, chosen, strict=True)):
                own = back[:, k * FILTERS : (k + 1) * FILTERS]
                symbols = bytes_[np.arange(n)[:, None, None], best[:, :, None] + np.arange(w)]  # n, filter, width
                patch = net.embedding[symbols].reshape(n, FILTERS, -1)
                d_filters.append(np.einsum("nf,nfd->df", own, patch))
                d_patch = (own[:, :, None] * f.T[None]).reshape(n, FILTERS, w, EMBEDDING)
                np.add.at(d_embedding, symbols.ravel(), d_patch.reshape(-1, EMBEDDING))
            step += 1
            slopes = [d_embedding, *d_filters, back.sum(0), hidden.T @ wrong, wrong.sum(0)]
            for w, g, m, v in zip(weights, slopes, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= 0.005 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


class Predictor:
    """A network with its filters folded into tables over byte pairs."""

    def __init__(self, net: Network):
        self.net = net
        self.tables = []
        for w, f in zip(WIDTHS, net.filters, strict=True):
            single = [net.embedding @ f[i * EMBEDDING : (i + 1) * EMBEDDING] for i in range(w)]
            pairs = [
                (i, (single[i][:, None] + single[i + 1][None]).reshape(-1, FILTERS)) if i + 1 < w else (i, single[i])
                for i in range(0, w, 2)
            ]
            self.tables.append((w, pairs))

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = np.empty((len(windows), len(self.net.output_bias)), np.float32)
        for at in range(0, len(windows), CHUNK):
            some = windows[at : at + CHUNK].astype(np.int32)
            pair = some[:, :-1] * 256 + some[:, 1:]
            pooled = []
            for w, tables in self.tables:
                response = None
                for i, values in tables:
                    index = (pair if len(values) > 256 else some)[:, i : i + WINDOW - w + 1]
                    part = np.take(values, index, axis=0)
                    response = part if response is None else np.add(response, part, out=response)
                pooled.append(response.max(1))
            hidden = np.maximum(np.concatenate(pooled, 1) + self.net.bias, 0)
            out[at : at + CHUNK] = _softmax(hidden @ self.net.output + self.net.output_bias)
        return out


def held_out(doc_id: Column) -> Column:
    """Whether the row's label must not be learnt from."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def training_sample(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, piece_chars: int = SAMPLE_CHARS) -> list[tuple[str, str]]:
    """``per_language`` (lang, piece of text) of each language among the rows that may be learnt from, or all there are."""
    labelled = docs.select("doc_id", "text", "lang").filter(
        ~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    spread = F.greatest(F.length("text") - piece_chars, F.lit(0)) + 1
    piece = F.substr("text", F.pmod(F.xxhash64("doc_id", F.lit(3)), spread) + 1, F.lit(piece_chars))
    drawn = Window.partitionBy("lang").orderBy("h", "piece")  # cut to ``per_language`` before it is shuffled
    rows = labelled.select("lang", piece.alias("piece"), F.xxhash64("doc_id").alias("h")).withColumn("n", F.row_number().over(drawn))
    rows = rows.filter(F.col("n") <= per_language).orderBy("lang", "n")
    return [(r["lang"], r["piece"]) for r in rows.collect()]


def _windows(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Windows of the pieces that are long enough to learn from, and the place of each one's piece."""
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in pieces])])
    windows, row, length = windows_of(np.frombuffer(b"".join(pieces), np.uint8), offsets)
    whole = (length >= WINDOW // 2) | (np.diff(offsets)[row] < WINDOW)
    return windows[whole], row[whole]


def counterfeit(piece: str, rng: np.random.Generator) -> str:
    """The piece with its letters dealt out anew, or a part of its alphabet exchanged, everything else in its place."""
    letters = [c for c in piece if c.isalpha()]
    if rng.random() < 0.5:
        order = iter(rng.permutation(len(letters)))
        return "".join(letters[next(order)] if c.isalpha() else c for c in piece)
    alphabet = list("abcdefghijklmnopqrstuvwxyz")
    some = rng.permutation(26)[: rng.integers(8, 27)]
    change = dict(zip([alphabet[i] for i in some], [alphabet[i] for i in np.roll(some, 1)], strict=True))
    return "".join(change.get(c, c) for c in piece.lower())


def shortened(piece: str, rng: np.random.Generator) -> str:
    """A run of whole words of the piece, of any length."""
    words = piece.split(" ")
    size = int(np.exp(rng.uniform(0, np.log(len(words) + 1))))
    start = int(rng.integers(0, len(words) - size + 1))
    return " ".join(words[start : start + size])


def fit(
    docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, piece_chars: int = SAMPLE_CHARS, reject: bool = False
) -> Network | None:
    """A network learnt from ``docs`` (doc_id, text, lang), with a class for no known language if ``reject``; None
    without labelled texts."""
    sample = training_sample(docs, per_language, piece_chars)
    if not sample:
        return None
    languages = sorted({lang for lang, _ in sample})
    number = {lang: i for i, lang in enumerate(languages)}
    if not reject:
        windows, row = _windows([text.encode() for _, text in sample])
        return train(windows, np.array([number[lang] for lang, _ in sample])[row], languages, len(languages))
    rng = np.random.default_rng(11)
    learnt = [s for i, s in enumerate(sample) if i % 4]
    kept = [s for i, s in enumerate(sample) if not i % 4]
    cases = [(number[lang], piece if i % 2 else shortened(piece, rng)) for i, (lang, piece) in enumerate(learnt)]
    cases += [(len(languages), counterfeit(text, rng)) for _, text in list(cases)]
    windows, row = _windows([text.encode() for _, text in cases])
    net = train(windows, np.array([c for c, _ in cases])[row], languages, len(languages) + 1)
    net.bounds = np.full(LENGTH_CLASSES, LEAST_REJECTION)
    trials = [text.encode() for _, piece in kept for text in (piece, *(shortened(piece, rng) for _ in range(8)))]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in trials])])
    chance = _mean_probabilities(Predictor(net), np.frombuffer(b"".join(trials), np.uint8), offsets)[:, -1]
    size = length_class(np.diff(offsets))
    for k in range(LENGTH_CLASSES):  # a short text never has a lower bound than a longer one
        here = chance[size >= k]
        if len(here):
            net.bounds[k] = max(LEAST_REJECTION, (1 + here.max()) / 2)
    return net


def length_class(size: np.ndarray) -> np.ndarray:
    """The power of two of a number of bytes."""
    return np.minimum(np.log2(np.maximum(size, 1)).astype(np.int64), LENGTH_CLASSES - 1)


_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def _with_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which rows of a slice hold a letter."""
    before = np.concatenate([[0], np.cumsum(_LETTER[data])])
    found = np.diff(before[offsets]) > 0
    beyond = np.concatenate([[0], np.cumsum(data >= 128)])
    for r in np.flatnonzero(~found & (np.diff(beyond[offsets]) > 0)):
        found[r] = any(c.isalpha() for c in data[offsets[r] : offsets[r + 1]].tobytes().decode())
    return found


def _mean_probabilities(model: Predictor, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean probabilities of every row of a slice, all windows weighted by their bytes."""
    windows, row, length = windows_of(data, offsets)
    total = np.zeros((len(offsets) - 1, len(model.net.output_bias)))
    np.add.at(total, row, model.probabilities(windows).astype(np.float64) * length[:, None])
    return total / np.maximum(np.diff(offsets), 1)[:, None]


def _predict(model: Predictor | None, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Language number (-1: undetermined), score, and probability of no known language of every row of a slice."""
    n = len(offsets) - 1
    if not model or not len(data):
        return np.full(n, -1), np.zeros(n), np.zeros(n)
    mean = _mean_probabilities(model, data, offsets)
    k = len(model.net.languages)
    none = mean[:, k] if mean.shape[1] > k else np.zeros(n)
    known = _with_letter(data, offsets)
    return np.where(known, mean[:, :k].argmax(1), -1), np.where(known, np.clip(mean[:, :k].max(1), 0, 1), 0), none


def predict_languages(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score (mean probability of that language) of every row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(net)  # some thousand weights

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Predictor(shared.value) if shared.value else None
        names = np.array([*(shared.value.languages if model else []), UNDETERMINED], object)
        for rows, data, offsets in text_slices(batches, "text"):
            best, score, _ = _predict(model, data, offsets)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(names[best], pa.string()), pa.array(score)],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        predict, "doc_id bigint, held_out boolean, lang_pred string, score double"
    )


def keep_determined(docs: DataFrame, net: Network | None) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is determined; with bounds, only those within them."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Predictor(shared.value) if shared.value else None
        for rows, data, offsets in text_slices(batches, "text"):
            best, _, none = _predict(model, data, offsets)
            good = best >= 0
            if model and model.net.bounds is not None:
                good &= none <= model.net.bounds[length_class(np.diff(offsets))]
            yield rows.filter(pa.array(good))

    return docs.mapInArrow(keep, docs.schema)
