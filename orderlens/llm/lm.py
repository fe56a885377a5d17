"""Language-model scoring with sharded Elias-Fano n-gram tries.

Tokens are words (all but white space, A-Z folded) and one end per text; begin marks stand before the first token and are
no tokens. The model of order n interpolates with a Dirichlet prior: for a context h of k - 1 tokens

    p(w | h) = (c(h, w) + PRIOR[k] * p(w | h')) / (c(h) + PRIOR[k]),   p(w) = (c(w) + 1) / (N + V + 1)

where h' is h without its first token. A count and its context's count settle a share c(h, w) / (c(h) + PRIOR[k]) and a
back-off weight PRIOR[k] / (c(h) + PRIOR[k]), so scores do not depend on how the counts are spread. Counts come from all
texts that may be learnt from. A task cuts its texts into blocks of about ``BLOCK_BYTES`` and parses each once:

1. A block sends its distinct words with their counts to word shards, ranges of the word hash. A shard sums them and
   answers with the total counts. The shards' sizes turn known words into dense ids 0 .. V - 1; V is the begin mark.
2. A block sends its distinct n-grams to shards chosen by a hash of the first two words, so a frequent word is spread over
   all of them, while all n-grams that begin with the same two words meet. A shard adds them up and builds its trie:
   first words, then for every level monotone pointers and the next words, the latter relative to their context (each
   range goes on from the last value of the range before), with shares and back-off weights quantised to 8 bits on a
   logarithmic scale. The levels are Elias-Fano coded in one memory map of the task and read value by value. Every distinct
   n-gram is looked up once, by successor search down the levels; the codes are dealt out to the blocks that asked.
3. A block turns the answers into log10 probabilities of its texts.

Nothing is broadcast or collected but the text volume; blocks send only what is not empty. Counts are taken per block
before they move, so a frequent word or n-gram is one entry per block, and rows with equal ids or texts stay where they lie.

Defined cases: a null or empty text is its end alone; nothing to learn from gives p = 1 for every token; an unknown word
ends the contexts that hold it; words are told apart by 64-bit hashes; a text of any length is scored whole, in a block
of its own if need be; repeated rows are scored and counted each; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import mmap
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACED, Words, mix, text_slices
from .eliasfano import EliasFano

ORDER = 3
PRIOR = {2: 2048.0, 3: 8.0}  # what the lower order weighs, in occurrences of the context
BLOCK_BYTES = 8 << 20
WORD_SHARD_BLOCKS = 4  # blocks whose words fill a word shard
GRAM_SHARD_BLOCKS = 1  # blocks whose n-grams fill a shard
LEVELS = 255  # quantisation steps of a share; 0 says that there is none
LOWEST = -10.0  # log10 of the smallest share

_U = np.uint64
_END = mix(np.array([0x5EED_E0D], _U))

#: What travels: to a block's place (its number) or a shard's (-1 - its number), from a block, packed arrays; a word
#: shard's tokens and types in its row of sizes.
ROW = "place bigint, block bigint, shard int, kind int, data array<binary>, tokens bigint, types bigint"
_ROW = pa.schema([
    ("place", pa.int64()), ("block", pa.int64()), ("shard", pa.int32()), ("kind", pa.int32()), ("data", pa.list_(pa.binary())),
    ("tokens", pa.int64()), ("types", pa.int64()),
])
TEXTS, WORDS, TOTALS, SIZES, GRAMS, CODES = range(6)

RESULT = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
)
_RESULT = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
    ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
])


def pack(values: np.ndarray) -> bytes:
    """Non-negative integers by byte planes of the width that the largest needs, so that high planes compress well."""
    values = np.ascontiguousarray(values, dtype=_U)
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + values.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpack(data) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8)
    width = int(planes[0])
    out = np.zeros(((len(planes) - 1) // width, 8), np.uint8)
    out[:, :width] = planes[1:].reshape(width, -1).T
    return out.view(_U).ravel()


def _rows(rows: list[tuple]) -> pa.Table:
    rows = [(*r, 0, 0)[:7] for r in rows]
    return pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_ROW)], schema=_ROW)


def _unrows(table: pa.Table, kind: int) -> list[tuple]:
    """(shard, block, packed arrays) of the rows of a kind, in order."""
    found = zip(*(table[c].to_pylist() for c in ("kind", "shard", "block", "data")), strict=True)
    return sorted(((shard, block, data) for k, shard, block, data in found if k == kind), key=lambda r: r[:2])


def quantised(share: np.ndarray) -> np.ndarray:
    """Shares in (0, 1] as codes 1 .. LEVELS, rounded down so that no sum of shares exceeds one; 0 for none."""
    place = 1 - np.log10(np.maximum(share, 10.0**LOWEST)) / LOWEST
    return np.where(share > 0, 1 + np.floor(place * (LEVELS - 1) + 1e-9), 0).astype(np.uint8)


def dequantised(code: np.ndarray) -> np.ndarray:
    """Shares of codes, 0 for code 0."""
    return _SHARES[code]


_SHARES = np.concatenate([[0.0], 10.0 ** (LOWEST * (1 - np.arange(LEVELS) / (LEVELS - 1)))])


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((mix(keys) >> _U(32)) * _U(shards) >> _U(32)).astype(np.int64)


class Level:
    """One level of a trie: for each range of the level above its next words, Elias-Fano coded relative to the range."""

    def __init__(self, ranges: np.ndarray, words: np.ndarray):
        """``ranges``: the bounds of the ranges in ``words``, which rise within each range; no range is empty."""
        last = words[ranges[1:] - 1] if len(ranges) > 1 else np.zeros(0, _U)
        base = np.concatenate([np.zeros(1, _U), np.cumsum(last, dtype=_U)])
        relative = words + np.repeat(base[:-1], np.diff(ranges))
        self.parts = [
            EliasFano.of(ranges.astype(_U), len(words) + 1).to_bytes(),
            EliasFano.of(relative, int(relative[-1]) + 1 if len(words) else 1).to_bytes(),
        ]

    def mapped(self, region: memoryview) -> None:
        """Move the level into a memory map."""
        at = 0
        for part in self.parts:
            region[at : at + len(part)] = part
            at += len(part)
        self.pointers = EliasFano.from_buffer(region)
        self.words = EliasFano.from_buffer(region[len(self.parts[0]) :])
        self.parts = []

    def places(self, ranges: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The place of each word within its range, -1 if it is not there; ``ranges`` of -1 have no words."""
        out = np.full(len(ranges), -1, np.int64)
        asked = np.flatnonzero(ranges >= 0) if self.words.n else np.zeros(0, np.int64)
        if not len(asked):
            return out
        ranges, words = ranges[asked], words[asked]
        new = np.flatnonzero(np.concatenate([[True], ranges[1:] != ranges[:-1]]))  # bounds are read once per run
        run = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(ranges))))
        begin = self.pointers.access(ranges[new]).astype(np.int64)
        end = self.pointers.access(ranges[new] + 1).astype(np.int64)
        base = np.where(begin > 0, self.words.access(np.maximum(begin - 1, 0)), _U(0))
        want = words + base[run]
        # the last value of the range before may equal the wanted one
        at = np.maximum(self.words.successor(want), begin[run])
        good = at < end[run]
        good[good] = self.words.access(at[good]) == want[good]
        out[asked[good]] = at[good]
        return out


class Trie:
    """First words, pairs and, of order three, triples with quantised shares and back-off weights, in a memory map."""

    def __init__(self, grams: list[np.ndarray], codes: list[np.ndarray], base: int):
        """``grams[0]``: sorted pairs first * base + second; ``grams[1]``: sorted place of the pair * base + third."""
        self.codes, levels = codes, []
        first = grams[0] // _U(base)
        new = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]])) if len(first) else np.zeros(0, np.int64)
        levels.append(Level(np.array([0, len(new)] if len(new) else [0]), first[new]))
        levels.append(Level(np.append(new, len(first)), grams[0] % _U(base)))
        if len(grams) > 1:
            owner = grams[1] // _U(base)
            self.with_next = np.unique(owner)
            levels.append(Level(np.append(np.searchsorted(owner, self.with_next), len(owner)), grams[1] % _U(base)))
        sizes = [sum(map(len, level.parts)) for level in levels]
        self.map = mmap.mmap(-1, sum(sizes))
        for level, end, size in zip(levels, np.cumsum(sizes).tolist(), sizes, strict=True):
            level.mapped(memoryview(self.map)[end - size : end])
        self.levels = levels

    def pairs(self, keys: np.ndarray, base: int) -> np.ndarray:
        """The place of every pair, -1 for unknown ones."""
        first = keys // _U(base)
        new = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]])) if len(keys) else np.zeros(0, np.int64)
        place = self.levels[0].places(np.zeros(len(new), np.int64), first[new])
        return self.levels[1].places(np.repeat(place, np.diff(np.append(new, len(keys)))), keys % _U(base))

    def triples(self, pair: np.ndarray, third: np.ndarray) -> np.ndarray:
        """The place of every triple by its pair's place."""
        at = np.minimum(np.searchsorted(self.with_next, pair.astype(_U)), max(len(self.with_next) - 1, 0))
        known = (pair >= 0) & (self.with_next[at] == pair.astype(_U)) if len(self.with_next) else np.zeros(len(pair), bool)
        return self.levels[2].places(np.where(known, at, -1), third)

    def code(self, kind: int, place: np.ndarray) -> np.ndarray:
        """Codes of places: 0 shares of pairs, 1 shares of triples, 2 back-off weights of pairs."""
        codes = self.codes[kind]
        return np.where(place >= 0, codes[np.maximum(place, 0)], 0).astype(np.uint8) if len(codes) else np.zeros(len(place), np.uint8)


class Block:
    """Texts as numbers of distinct words, with the documents' bounds."""

    def __init__(self, doc_ids: np.ndarray, no_id: np.ndarray, held: np.ndarray, size: np.ndarray, token: np.ndarray, n_words: int, end: int):
        self.doc_ids, self.no_id, self.held, self.size, self.token, self.n_words, self.end = doc_ids, no_id, held, size, token, n_words, end
        self.first = np.concatenate([[0], np.cumsum(size)])  # tokens of each text, its end included

    @classmethod
    def parse(cls, parts: list[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]) -> tuple[Block, np.ndarray, np.ndarray]:
        """A block of slices, its distinct word hashes and their counts in texts to learn from."""
        rows = pa.Table.from_batches([p[0] for p in parts]).combine_chunks()
        size = np.concatenate([np.diff(first) for _, _, first in parts]) + 1
        first = np.concatenate([[0], np.cumsum(size)])
        tokens = np.empty(first[-1], _U)
        is_end = np.zeros(len(tokens), bool)
        is_end[first[1:] - 1] = True
        tokens[is_end], tokens[~is_end] = _END[0], np.concatenate([h for _, h, _ in parts])
        words, token = np.unique(tokens, return_inverse=True)
        ids = rows["doc_id"].combine_chunks()
        held = rows["held_out"].combine_chunks().to_numpy(zero_copy_only=False).astype(bool)
        block = cls(
            ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), held, size, token, len(words),
            int(np.searchsorted(words, _END[0])),
        )
        return block, words, np.bincount(token[block.train()], minlength=len(words))

    def train(self) -> np.ndarray:
        return np.repeat(~self.held, self.size)

    def packed(self) -> list[bytes]:
        return [
            self.doc_ids.astype(np.int64).tobytes(), pack(self.no_id), pack(self.held), pack(self.size), pack(self.token),
            pack(np.array([self.n_words, self.end])),
        ]

    @classmethod
    def unpacked(cls, data: list[bytes]) -> Block:
        n_words, end = unpack(data[5]).tolist()
        return cls(
            np.frombuffer(data[0], np.int64), unpack(data[1]).astype(bool), unpack(data[2]).astype(bool),
            unpack(data[3]).astype(np.int64), unpack(data[4]).astype(np.int64), n_words, end,
        )


class Grams:
    """A block's distinct n-grams in order of shards.

    ``pairs`` and ``shard`` tell of the distinct first two words, ``pair`` the place of each window's pair or -1; of
    order three ``owner`` and ``third`` tell of the distinct triples, ``triple`` of each window's. Windows begin at every
    place of the texts with ``order`` - 1 begin marks before them and ``order`` - 2 blanks behind.
    """

    def __init__(self, block: Block, ids: np.ndarray, vocabulary: int, order: int, shards: int):
        self.begin, self.blank, self.base = vocabulary, vocabulary + 1, vocabulary + 2
        before, behind = order - 1, order - 2
        segment = block.size + before + behind
        start = np.concatenate([[0], np.cumsum(segment)])
        x = np.full(start[-1], self.blank, np.int64)
        self.token_at = np.arange(len(block.token)) + np.repeat(start[:-1] + before - block.first[:-1], block.size)
        x[self.token_at] = ids[block.token]
        for i in range(before):
            x[start[:-1] + i] = self.begin
        window = np.ones(len(x), bool)
        for i in range(before):
            window[start[1:] - 1 - i] = False
        at = np.flatnonzero(window)
        self.window_of = np.full(len(x), -1)  # by the place where a window begins
        self.window_of[at] = np.arange(len(at))
        train = np.repeat(~block.held, segment)[at]
        first, second = x[at], x[at + 1]
        known = (first >= 0) & (second >= 0) & bool(vocabulary)
        key, inverse = np.unique(first[known].astype(_U) * _U(self.base) + second[known].astype(_U), return_inverse=True)
        shard = _shard(key, shards)
        by_shard = np.argsort(shard, kind="stable")
        rank = np.empty(len(key), np.int64)
        rank[by_shard] = np.arange(len(key))
        self.pairs, self.shard = key[by_shard], shard[by_shard]
        self.pair = np.full(len(at), -1)
        self.pair[known] = rank[inverse]
        if order == 2:
            self.counts = np.bincount(self.pair[known & train], minlength=len(key))
            return
        third = x[at + 2]
        third = np.where(third < 0, self.blank, third)
        triple, inverse = np.unique(self.pair[known].astype(_U) * _U(self.base) + third[known].astype(_U), return_inverse=True)
        self.triple = np.full(len(at), -1)
        self.triple[known] = inverse
        self.owner, self.third = (triple // _U(self.base)).astype(np.int64), triple % _U(self.base)
        self.counts = np.bincount(self.triple[known & train], minlength=len(triple))


def _parser(block_bytes: int, word_shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        parts, held = [], 0

        def done() -> pa.RecordBatch:
            block, words, counts = Block.parse(parts)
            rows = [(number, number, -1, TEXTS, block.packed())]
            cut = np.searchsorted((words >> _U(32)) * _U(word_shards) >> _U(32), np.arange(word_shards + 1))
            for shard, (a, b) in enumerate(zip(cut, cut[1:], strict=False)):
                if a < b:
                    rows.append((-1 - shard, number, shard, WORDS, [pack(words[a:b]), pack(counts[a:b])]))
            return _rows(rows).combine_chunks().to_batches()[0]

        for batch, data, offsets in text_slices(batches, "text"):
            if parts and held + len(data) > block_bytes:
                yield done()
                number, parts, held = number + 1, [], 0
            words = Words(data, offsets, SPACED)
            parts.append((batch.select(["doc_id", "held_out"]), words.hashes(), words.first))
            held += len(data)
        if parts:
            yield done()

    return run


def _word_totals(rows: pa.Table) -> pa.Table:
    """Total counts of a shard's words for every block that asks, with the shard's tokens and known words."""
    asked = _unrows(rows, WORDS)
    if not asked:
        return _rows([])
    words = [unpack(data[0]) for *_, data in asked]
    counts = np.concatenate([unpack(data[1]) for *_, data in asked])
    _, inverse = np.unique(np.concatenate(words), return_inverse=True)
    total = np.zeros(int(inverse.max()) + 1, np.int64)
    np.add.at(total, inverse, counts.astype(np.int64))
    known = total > 0
    number = np.where(known, np.cumsum(known), 0)  # from 1 on, 0 for unknown words
    shard = asked[0][0]
    out = [(-1 - shard, -1, shard, SIZES, [], int(total.sum()), int(known.sum()))]
    cut = np.cumsum([0, *map(len, words)])
    for (_, block, _), a, b in zip(asked, cut, cut[1:], strict=False):
        out.append((block, block, shard, TOTALS, [pack(total[inverse[a:b]]), pack(number[inverse[a:b]])]))
    return _rows(out)


class Corpus:
    """What all shards know together: tokens, types, and ids of shard * ``most`` + number within the shard."""

    def __init__(self, answers: pa.Table):
        first = next(c for c in answers["corpus"].to_pylist() if c is not None)
        self.tokens, self.types, self.most = first["tokens"], first["types"], first["most"]

    def known(self, answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Total counts and ids (-1 if unknown) of a block's words."""
        counts, ids = [], []
        for shard, _, data in _unrows(answers, TOTALS):
            number = unpack(data[1]).astype(np.int64)
            counts.append(unpack(data[0]).astype(np.int64))
            ids.append(np.where(number > 0, number - 1 + shard * self.most, -1))
        return np.concatenate(counts), np.concatenate(ids)


def _asker(order: int, word_shards: int, shards: int):
    def ask(rows: pa.Table, answers: pa.Table) -> pa.Table:
        texts = _unrows(rows, TEXTS)
        if not texts:
            return _rows([])
        block, corpus = Block.unpacked(texts[0][2]), Corpus(answers)
        counts, ids = corpus.known(answers)
        vocabulary = word_shards * corpus.most
        grams = Grams(block, ids, vocabulary, order, shards)
        of_id = np.append(ids, vocabulary)  # the begin mark occurs before every text to learn from
        by_id = np.argsort(of_id)
        sorted_ids, sorted_counts = of_id[by_id], np.append(counts, counts[block.end])[by_id]
        first = (grams.pairs // _U(grams.base)).astype(np.int64)
        new = np.ones(len(first), bool)
        new[1:] = (first[1:] != first[:-1]) | (grams.shard[1:] != grams.shard[:-1])
        context = sorted_counts[np.searchsorted(sorted_ids, first)]
        cut = np.searchsorted(grams.shard, np.arange(shards + 1))
        size = np.bincount(grams.owner, minlength=len(first)) if order > 2 else np.ones(len(first), np.int64)
        deep = np.concatenate([[0], np.cumsum(size)])
        out = []
        for shard in np.unique(grams.shard).tolist():
            a, b = cut[shard], cut[shard + 1]
            data = [
                pack(np.array([grams.base])), pack(np.diff(grams.pairs[a:b], prepend=_U(0))), pack(context[a:b][new[a:b]]),
                pack(grams.counts[deep[a] : deep[b]]),
            ]
            if order > 2:
                data += [pack(size[a:b]), pack(grams.third[deep[a] : deep[b]])]
            out.append((-1 - shard, texts[0][1], shard, GRAMS, data))
        return _rows(out)

    return ask


def _answerer(order: int):
    def answer(rows: pa.Table) -> pa.Table:
        """Build the shard's trie from all blocks' counts and look every distinct n-gram up in it, once."""
        asked = _unrows(rows, GRAMS)
        base = int(unpack(asked[0][2][0])[0])
        keys = [np.cumsum(unpack(data[1]), dtype=_U) for *_, data in asked]
        pairs, place = np.unique(np.concatenate(keys), return_inverse=True)
        context = np.concatenate([_spread(k // _U(base), unpack(data[2])) for k, (*_, data) in zip(keys, asked, strict=True)])
        of_pair = np.zeros(len(pairs))
        of_pair[place] = context
        counts = np.concatenate([unpack(data[3]) for *_, data in asked]).astype(np.float64)  # sums below 2 ** 53 are exact
        cut, levels = np.cumsum([0, *map(len, keys)]), [pairs]
        if order > 2:
            owner = np.concatenate([np.repeat(place[a:b], unpack(data[4]).astype(np.int64)) for (*_, data), a, b in zip(asked, cut, cut[1:], strict=False)])
            third = np.concatenate([unpack(data[5]) for *_, data in asked])
            triples, deep = np.unique(owner.astype(_U) * _U(base) + third, return_inverse=True)
            count = np.bincount(deep, counts, len(triples))
            owner, third = (triples // _U(base)).astype(np.int64), triples % _U(base)
            real = (count > 0) & (third != _U(base - 1))
            total = np.bincount(owner, count, len(pairs))
            after = np.bincount(owner[real], count[real], len(pairs))
            weight = np.where(after > 0, PRIOR[3] / (after + PRIOR[3]), 0)
        else:
            total = np.bincount(place, counts, len(pairs))
        seen = total > 0
        share = total[seen] / (of_pair[seen] + PRIOR[2])
        if order > 2:
            new_place = np.cumsum(seen) - 1
            levels.append(new_place[owner[real]].astype(_U) * _U(base) + third[real])
            codes = [quantised(share), quantised(count[real] / (after[owner[real]] + PRIOR[3])), quantised(weight[seen])]
        else:
            codes = [quantised(share)]
        trie = Trie([pairs[seen], *levels[1:]], codes, base)
        at = trie.pairs(pairs, base)
        found = [trie.code(0, at)[place]]
        if order > 2:
            found += [trie.code(2, at)[place], trie.code(1, trie.triples(at[owner], third))[deep]]
            ends = np.cumsum([0, *(len(unpack(data[5])) for *_, data in asked)])
        out = []
        for i, (shard, block, _) in enumerate(asked):
            data = [codes[cut[i] : cut[i + 1]].tobytes() for codes in found[:2]]
            if order > 2:
                data.append(found[2][ends[i] : ends[i + 1]].tobytes())
            out.append((block, block, shard, CODES, data))
        return _rows(out)

    return answer


def _spread(first: np.ndarray, values: np.ndarray) -> np.ndarray:
    """One value per run of equal ``first``, for every entry."""
    new = np.ones(len(first), bool)
    new[1:] = first[1:] != first[:-1]
    return values[np.cumsum(new) - 1]


def _scorer(order: int, word_shards: int, shards: int):
    def score(rows: pa.Table, answers: pa.Table) -> pa.Table:
        texts = _unrows(rows, TEXTS)
        if not texts:
            return _RESULT.empty_table()
        block, corpus = Block.unpacked(texts[0][2]), Corpus(answers)
        counts, ids = corpus.known(answers)
        grams = Grams(block, ids, word_shards * corpus.most, order, shards)
        replies = [data for *_, data in _unrows(answers, CODES)]

        def codes(kind: int) -> np.ndarray:
            """Codes of a block's distinct n-grams, with 0 for windows that have none."""
            return np.frombuffer(b"".join([*(d[kind] for d in replies), b"\0"]), np.uint8)

        word = block.token
        unigram = (counts + 1) / (corpus.tokens + corpus.types + 1)
        context = np.zeros(len(word), np.int64)
        context[1:] = counts[word[:-1]]
        context[block.first[:-1]] = counts[block.end]
        pair = grams.pair[grams.window_of[grams.token_at - 1]]
        probability = dequantised(codes(0))[pair] + PRIOR[2] / (context + PRIOR[2]) * unigram[word]
        if order > 2:
            window = grams.window_of[grams.token_at - 2]
            weight = dequantised(codes(1))[grams.pair[window]]
            probability = dequantised(codes(2))[grams.triple[window]] + np.where(weight > 0, weight, 1.0) * probability
        at = block.first[:-1]
        return pa.table({
            "doc_id": pa.array(block.doc_ids, mask=block.no_id), "held_out": pa.array(block.held),
            "n_tokens": pa.array(block.size),
            "n_known": pa.array(np.add.reduceat((counts > 0)[word].astype(np.int64), at)),
            "train_tokens": pa.array(np.full(len(at), corpus.tokens)),
            "base_score": pa.array(np.add.reduceat(np.log10(unigram)[word], at)),
            "score": pa.array(np.add.reduceat(np.log10(probability), at)),
        })

    return score


def held_out(doc_id: Column) -> Column:
    """Whether the row must not be learnt from."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(7)) == 2


def score_documents(docs: DataFrame, block_bytes: int = BLOCK_BYTES, order: int = ORDER) -> DataFrame:
    """Base and model log10 probabilities of every row of ``docs`` (doc_id, text), see ``RESULT``; ``order`` is 2 or 3."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    word_shards, shards = -(-blocks // WORD_SHARD_BLOCKS), -(-blocks // GRAM_SHARD_BLOCKS)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    parsed = rows.mapInArrow(_parser(block_bytes, word_shards), ROW).repartition("place")
    totals = parsed.groupBy("place").applyInArrow(_word_totals, ROW)
    numbers = F.struct(
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("types"), F.lit(0)).alias("types"),
        F.coalesce(F.max("types"), F.lit(0)).alias("most"),
    )
    corpus = totals.filter(F.col("kind") == SIZES).agg(numbers.alias("corpus")).scalar()
    totals = totals.filter(F.col("kind") == TOTALS).withColumn("corpus", corpus)
    requests = parsed.groupBy("place").cogroup(totals.groupBy("place")).applyInArrow(_asker(order, word_shards, shards), ROW)
    codes = requests.groupBy("place").applyInArrow(_answerer(order), ROW)
    answers = totals.unionByName(codes, allowMissingColumns=True)
    return parsed.groupBy("place").cogroup(answers.groupBy("place")).applyInArrow(_scorer(order, word_shards, shards), RESULT)
