"""BPE encoding and decoding by depth-first traversal of a trie over distinct words.

A text is normalised (NFC, white space to one space, lower case per character) and cut into words by the pattern of
the vocabulary file. The distinct words of a step that a worker does not know yet, sorted, are the depth-first order of a
trie over their byte symbols; a stack holds the current path.
Every node stands for a prefix and holds the last token of that prefix's encoding: the one token that ends the prefix
and may follow the last token of what stands before it. Two tokens may stand side by side if merging their symbols
gives back the two. So a node needs its ancestors only, and shared prefixes are encoded once. A word's final symbol
carries the end mark and hangs below its prefix as a child of its own.

Defined cases: a null text is empty (no ids, empty decoded text); special tokens written in a text become their id, as
the tokenizers library does; words of any length take memory in proportion; repeated rows are encoded each; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

END = "</w>"
NEVER = 1 << 60
FINAL = 0x1000
PAIR = 32  # bits of a token id in a pair's key
CACHED_WORDS = 60_000  # words of a generation; a worker process keeps two, from batch to batch and task to task
CACHED_SYMBOLS = 16 << 20  # and their letters
CACHED_PAIRS = 250_000
STEP_BYTES = 1 << 20  # text that is cut and encoded together; a single longer text is a step of its own

#: White space and the word pattern of the vocabulary file.
SPACE = r"[\t-\r \x85\xa0  -     　]"
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^" + SPACE[1:-1] + r"\p{L}\p{N}]+"

#: The same words for texts of ASCII and Latin-1 letters, which the standard library matches faster.
PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*")
PLAIN_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\t-\r 0-9a-zß-öø-ÿ]+")


def byte_symbols() -> list[str]:
    """The printable symbol of each byte in byte-level vocabularies: itself if printable, else the next of U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Tokens, merge ranks and special tokens of a vocabulary file.

    A symbol is one character; the final symbol of a word, which carries the end mark, is that character ``FINAL`` places
    further on. Tokens are known by their ids; ``left``, ``right`` and ``made`` tell which merge makes a token, and
    ``endings`` is a trie over the reversed tokens.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text = {i: t for t, i in ids.items()} | {i: t for t, i in self.special.items()}
        size = max(self.text) + 1
        self.rank: dict[int, int] = {}
        self.left, self.right, self.made = [0] * size, [0] * size, [-1] * size
        self.result: list[int] = []
        for i, (a, b) in enumerate(map(tuple, model["merges"])):
            whole = ids[a + b]
            self.rank[ids[a] << PAIR | ids[b]] = i
            self.result.append(whole)
            self.left[whole], self.right[whole], self.made[whole] = ids[a], ids[b], i
        self.symbols = {i: self._symbols(t) for t, i in ids.items()}
        self.alone = {t: i for i, t in self.symbols.items() if len(t) == 1}
        self.length = [len(self.symbols.get(i, "")) for i in range(size)]
        self.bytes = [i.to_bytes(4, "little") for i in range(size)]
        self.endings: dict[str, list] = {}  # last symbol -> [token or -1, what may stand before it]
        for i, symbols in self.symbols.items():
            branch = self.endings
            for symbol in reversed(symbols):
                node = branch.setdefault(symbol, [-1, {}])
                branch = node[1]
            node[0] = i
        self.of_byte = {b: ord(symbol) for b, symbol in enumerate(byte_symbols())}
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.word = regex.compile(WORD)
        self.space = re.compile(SPACE + "+")

    def _symbols(self, token: str) -> str:
        if len(token) > len(END) and token.endswith(END):
            return token[: -len(END) - 1] + chr(ord(token[-len(END) - 1]) + FINAL)
        return token

    def symbols_of(self, word: str) -> str:
        """A word's bytes as symbols."""
        symbols = word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(self.of_byte)
        return symbols[:-1] + chr(ord(symbols[-1]) + FINAL)

    def merged(self, symbols: str) -> list[int]:
        """Tokens of symbols after all merges, lowest rank first, leftmost first among equals."""
        tokens = [self.alone[symbol] for symbol in symbols]
        while len(tokens) > 1:
            ranks = [self.rank.get(a << PAIR | b, NEVER) for a, b in zip(tokens, tokens[1:], strict=False)]
            best = min(ranks)
            if best == NEVER:
                break
            at = ranks.index(best)
            tokens[at : at + 2] = [self.result[best]]
        return tokens

    def words(self, text: str) -> list[str]:
        """The words of a text without special tokens."""
        if PLAIN.fullmatch(text):
            return PLAIN_WORD.findall(text.lower())
        text = self.space.sub(" ", unicodedata.normalize("NFC", text))
        return self.word.findall(text.replace("Σ", "σ").lower())

    def pieces(self, text: str) -> list[str]:
        """Words and special tokens of a text in order."""
        if "<|" not in text or not self.split_special:
            return self.words(text)
        out = []
        for part in self.split_special.split(text):
            if part in self.special:
                out.append(part)
            else:
                out += self.words(part)
        return out


@cache
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary per worker process and path."""
    return Vocabulary(path)


class TrieEncoder:
    """Encodes distinct words through a trie; keeps the pair verdicts and the words it has met, within bounds."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.known: dict[str, bytes] = {}
        self.shown: dict[str, str] = {}
        self.pairs: dict[int, bool] = {}
        self.stands: dict[int, bool] = {}
        self.older: tuple[dict[str, bytes], dict[str, str]] = {}, {}
        self.held = 0

    def whole(self, token: int) -> bool:
        """Whether the token's symbols merge into the token."""
        verdict = self.stands.get(token)
        if verdict is None:
            verdict = self.stands[token] = self.vocab.merged(self.vocab.symbols[token]) == [token]
        return verdict

    def fits(self, left: int, right: int) -> bool:
        """Whether the two tokens stand side by side in an encoding.

        Both are taken apart along the border, what merged last first. At each moment the two neighbours of the
        border must have no merge that comes before the one which, in the tokens, takes either of them away.
        """
        rank, made = self.vocab.rank, self.vocab.made
        a, b, a_goes, b_goes, verdict = left, right, NEVER, NEVER, True
        while True:
            crossing = rank.get(a << PAIR | b, NEVER)
            if crossing < a_goes and crossing <= b_goes:
                verdict = False
                break
            a_made, b_made = made[a], made[b]
            if a_made == b_made == -1:
                break
            if a_made > b_made:
                a, a_goes = self.vocab.right[a], a_made
            else:
                b, b_goes = self.vocab.left[b], b_made
        self.pairs[left << PAIR | right] = verdict
        return verdict

    def learn(self, words: Iterable[str]) -> None:
        """Encode words that are not known yet.

        Sorted words are the trie's depth-first order: what a word shares with the one before is on the stack ``last``,
        whose i-th entry is the last token of the encoding of the first i symbols. A node's token is found among those
        that end its prefix: the one that stands whole and fits behind the last token before it.
        """
        endings, length, numbers, texts = self.vocab.endings, self.vocab.length, self.vocab.bytes, self.vocab.text
        known, shown, pairs, fits, whole = self.known, self.shown, self.pairs, self.fits, self.whole
        before, last, held = "", [-1], 0
        for symbols, word in sorted(zip(map(self.vocab.symbols_of, words), words, strict=True)):
            at, size = 0, len(symbols)
            for a, b in zip(before, symbols, strict=False):
                if a != b:
                    break
                at += 1
            del last[at + 1 :]
            while at < size:
                start, branch, found = at, endings, -1
                while start >= 0 and (node := branch.get(symbols[start])):
                    token, branch = node
                    if token >= 0:
                        if start:
                            verdict = pairs.get(last[start] << PAIR | token)
                            if verdict is None:
                                verdict = fits(last[start], token)
                        else:
                            verdict = True
                        if verdict and whole(token):
                            found = token
                            break
                    start -= 1
                if found < 0:
                    raise ValueError(f"the vocabulary has no token that ends {symbols[: at + 1]!r}")
                last.append(found)
                at += 1
            before, tokens = symbols, []
            while at:
                token = last[at]
                tokens.append(token)
                at -= length[token]
            tokens.reverse()
            known[word] = b"".join([numbers[t] for t in tokens])
            shown[word] = " ".join([texts[t] for t in tokens])
            held += size
        self.held += held

    def prepare(self, lists: list[list[str]]) -> None:
        """Make every word of the lists known."""
        if len(self.known) > CACHED_WORDS or self.held > CACHED_SYMBOLS:
            self.older, self.held = (self.known, self.shown), 0
            self.known, self.shown = {}, {}
        if len(self.pairs) > CACHED_PAIRS:
            self.pairs.clear()
        new: set[str] = set().union(*lists) - self.known.keys()
        ids, texts = self.older
        for word in new & ids.keys():  # still in use
            self.known[word], self.shown[word] = ids[word], texts[word]
        new -= self.known.keys()
        for token, number in self.vocab.special.items():
            if token in new:
                new.discard(token)
                self.known[token], self.shown[token] = self.vocab.bytes[number], token
        self.learn(list(new))

    def encode(self, pieces: list[str]) -> bytes:
        """Ids of prepared words as little-endian 32-bit integers."""
        return b"".join(map(self.known.__getitem__, pieces))

    def decoded(self, pieces: list[str]) -> str:
        """What ``decode`` makes of the ids of prepared words."""
        return " ".join(map(self.shown.__getitem__, pieces))


def decode(vocab: Vocabulary, ids: Iterable[int]) -> str:
    """The text that ids stand for in a vocabulary without a decoder: its tokens with spaces between."""
    return " ".join(map(vocab.text.__getitem__, ids))


@cache
def encoder(path: str) -> TrieEncoder:
    """One encoder per worker process and path, so a word is learnt once for all of its tasks."""
    return TrieEncoder(vocabulary(path))


def steps(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Row slices of a batch (doc_id, text) with ``STEP_BYTES`` of text at most or one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, done + STEP_BYTES, "right")), start + 1)
        yield batch.slice(start, stop - start)
        start = stop


def encoder_function(path: str, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            for part in steps(batch):
                lists = [coder.vocab.pieces(t or "") for t in part.column(1).to_pylist()]
                coder.prepare(lists)
                ids = [coder.encode(pieces) for pieces in lists]
                sizes = pa.array([len(i) // 4 for i in ids], pa.int64())
                if digests:
                    columns = [
                        sizes, pa.array([hashlib.sha256(i).hexdigest() for i in ids]),
                        pa.array([hashlib.sha256(coder.decoded(pieces).encode()).hexdigest() for pieces in lists]),
                    ]
                    names = ["n_tokens", "ids_sha256", "decoded_sha256"]
                else:
                    columns = [sizes, pa.array([np.frombuffer(i, "<u4").astype(np.int32) for i in ids], pa.list_(pa.int32())), pa.array([coder.decoded(pieces) for pieces in lists], pa.string())]
                    names = ["n_tokens", "ids", "decoded"]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=["doc_id", *names])

    return run


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids and decoded text of every row of ``docs`` (doc_id, text); ``path``: a vocabulary file."""
    return docs.select("doc_id", "text").mapInArrow(
        encoder_function(path, False), "doc_id bigint, n_tokens bigint, ids array<int>, decoded string"
    )


def encoding_digests(docs: DataFrame, path: str) -> DataFrame:
    """As ``encode_documents``, with SHA-256 digests in place of ids and decoded text."""
    return docs.select("doc_id", "text").mapInArrow(
        encoder_function(path, True), "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
