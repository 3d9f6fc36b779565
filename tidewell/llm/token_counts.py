"""Exact token counts of every prefix of a text, by dynamic programming over byte-pair tokens.

A byte-pair encoding has one valid last token for every prefix of a word: the token that ends
there and forms a valid pair with the last token of what stands before it. So the count of a
prefix is the count at that earlier place plus one, and one pass over the places of a word gives
the counts of all its prefixes. Words are independent of each other, so the count of any prefix
of a text is the sum over its whole words plus one stored number of the word it ends in: budgets
and cuts are read off, nothing is encoded again.

Cases: a null or empty text has no tokens; texts of any length are read whole; repeated rows are
kept; other columns of the input are not carried over. The special string of the vocabulary is
one token wherever it stands, as the tokenizers library does it by default.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer, models

from tidewell.llm import worker
from tidewell.llm.text import pieces

#: Fixed value: the pre-tokenization pattern of this vocabulary, as published with it.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CONTRACTIONS = ("'re", "'ve", "'ll")
#: Words of up to so many bytes are rows of one matrix, or of another; longer ones are solved one by one.
MATRIX_WIDTHS = (32, 256)
#: Cells of a matrix.
CELLS = 1 << 21
#: Entries a worker keeps of words, stretches and token pairs before it starts over, and bytes of the first two.
CACHE_ENTRIES = 300_000
CACHE_BYTES = 64 << 20
PAIR_ENTRIES = 4_000_000

_STRETCH = re.compile(r"\s*\S+|\s+")
_CONTROL = re.compile("[\x1c-\x1f]")
_BASE = 0x9E3779B97F4A7C15
_M64 = (1 << 64) - 1


def byte_alphabet() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class PairCheck:
    """Whether two tokens may follow each other; asked once per pair."""

    def __init__(self, bare: Tokenizer, spelling: list[str]):
        self.bare, self.spelling = bare, spelling
        self.keys, self.valid = np.zeros(0, np.int64), np.zeros(0, bool)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys, back = np.unique(left.astype(np.int64) << 32 | right, return_inverse=True)
        place = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        if len(self.keys):
            known = self.keys[np.minimum(place, len(self.keys) - 1)] == keys
        answer = np.zeros(len(keys), bool)
        answer[known] = self.valid[place[known]]
        new = keys[~known]
        if len(new):
            pairs = [(int(k) >> 32, int(k) & 0xFFFFFFFF) for k in new]
            met = self.bare.encode_batch_fast(
                [self.spelling[a] + self.spelling[b] for a, b in pairs], add_special_tokens=False
            )
            answer[~known] = [tuple(e.ids) == p for e, p in zip(met, pairs)]
            if len(self.keys) > PAIR_ENTRIES:
                self.keys, self.valid = np.zeros(0, np.int64), np.zeros(0, bool)
                place, known = np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
                new = keys
            self.keys = np.insert(self.keys, place[~known], new)
            self.valid = np.insert(self.valid, place[~known], answer[~known])
        return answer[back]


class Spines:
    """The same for single pairs, from the merges alone.

    While a token is merged together, the piece at its edge is replaced by larger and larger ones: its
    spine. A piece ends when the next one is merged. Two tokens do not stay apart if some piece at the
    end of the left one and some piece at the beginning of the right one have a merge that comes before
    both end; of equal merges the one further left comes first.
    """

    def __init__(self, merges: list[tuple[str, str]], vocabulary: dict[str, int]):
        self.rank = {(vocabulary[a], vocabulary[b]): n for n, (a, b) in enumerate(merges)}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for n, (a, b) in enumerate(merges):
            self.parts.setdefault(vocabulary[a + b], (vocabulary[a], vocabulary[b], n))
        self.spines: tuple[dict[int, list], dict[int, list]] = ({}, {})
        self.known: dict[tuple[int, int], bool] = {}

    def spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """(piece, merge that ends it) at the beginning (0) or end (1) of a token, the whole token first."""
        found = self.spines[side].get(token)
        if found is None:
            found, piece, ends = [], token, float("inf")
            while True:
                found.append((piece, ends))
                if piece not in self.parts:
                    break
                *parts, ends = self.parts[piece]
                piece = parts[side]
            self.spines[side][token] = found
        return found

    def apart(self, left: int, right: int) -> bool:
        answer = self.known.get((left, right))
        if answer is None:
            if len(self.known) > CACHE_ENTRIES:
                self.known.clear()
            rank = self.rank.get
            answer = self.known[left, right] = not any(
                (merge := rank((a, b))) is not None and merge < ends_a and merge <= ends_b
                for a, ends_a in self.spine(left, 1)
                for b, ends_b in self.spine(right, 0)
            )
        return answer


class PrefixCounter:
    """Counts of all prefixes of words, and the counts of whole stretches of text, kept per worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        vocabulary = model["model"]["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["model"]["merges"]]
        self.special = [t["content"] for t in model["added_tokens"]]
        self.whole_text = Tokenizer.from_file(path)
        bare = Tokenizer(models.BPE(vocab=vocabulary, merges=merges))
        self.alphabet = byte_alphabet()
        back = {c: b for b, c in self.alphabet.items()}
        spelling = [""] * (max(vocabulary.values()) + 1)
        self.ids: dict[bytes, int] = {}
        for token, i in vocabulary.items():
            spelling[i] = token
            if all(c in back for c in token):
                self.ids[bytes(back[c] for c in token)] = i
        self.pair_is_valid = PairCheck(bare, spelling)
        self.alone_is_valid = Spines(merges, vocabulary)
        self.suffixes: frozenset[bytes] = frozenset()
        met = bare.encode_batch_fast(spelling, add_special_tokens=False)
        self.stands_alone = np.array([e.ids == [i] for i, e in enumerate(met)])
        tokens = list(self.ids)
        codes = np.array([self._code(t) for t in tokens], dtype=np.uint64)
        order = np.argsort(codes)
        self.codes, self.code_ids = codes[order], np.array([self.ids[t] for t in tokens])[order]
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[codes >> np.uint64(42)] = True
        self.longest = max(map(len, tokens))
        self.held = 0  # bytes of the words, their counts, and the stretches
        self.words: dict[str, bytes] = {}
        self.stretches: dict[str, int] = {}
        self.pattern = regex.compile(WORD_PATTERN)

    @staticmethod
    def _code(token: bytes) -> int:
        h = 0
        for b in token:
            h = (h * _BASE + b + 1) & _M64
        return h

    def prefixes(self, words: list[bytes]) -> list[np.ndarray]:
        """For each word the token count of its first 1, 2, … bytes."""
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(words)
        order = sorted((i for i, w in enumerate(words) if w), key=lambda i: -len(words[i]))
        sizes = np.array([len(words[i]) for i in order])
        first = len(order)
        for width in MATRIX_WIDTHS:
            start = int(np.searchsorted(-sizes, -width))
            for at in range(start, first, max(1, CELLS // width)):
                rows = order[at : min(first, at + max(1, CELLS // width))]
                counts = self._matrix([words[i] for i in rows])
                for row, i in enumerate(rows):
                    out[i] = counts[row, 1 : len(words[i]) + 1]
            first = start
        for i in order[:first]:
            out[i] = self._one(words[i])
        return out

    def _matrix(self, words: list[bytes]) -> np.ndarray:
        """All words at once, place by place; words come longest first."""
        lengths = np.array([len(w) for w in words])
        width = int(lengths[0])
        data = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
        base = np.uint64(_BASE)
        power = np.cumprod(np.r_[np.uint64(1), np.full(width, base, np.uint64)], dtype=np.uint64)
        rolled = np.zeros((width + 1, len(words)), np.uint64)
        for t in range(width):
            rolled[t + 1] = rolled[t] * base + data[:, t].astype(np.uint64) + np.uint64(1)
        last = np.zeros((width + 1, len(words)), np.int64)
        counts = np.zeros((width + 1, len(words)), np.uint32)
        active = len(words)
        for t in range(1, width + 1):
            while lengths[active - 1] < t:
                active -= 1
            open_rows = np.arange(active)
            for size in sorted(range(1, min(t, self.longest) + 1), key=lambda s: (abs(s - 3), s)):
                codes = rolled[t, open_rows] - rolled[t - size, open_rows] * power[size]
                near = np.flatnonzero(self.maybe[codes >> np.uint64(42)])
                at = np.minimum(np.searchsorted(self.codes, codes[near]), len(self.codes) - 1)
                hit = self.codes[at] == codes[near]
                near, ids = near[hit], self.code_ids[at[hit]]
                if not len(near):
                    continue
                rows = open_rows[near]
                good = self.stands_alone[ids] if size == t else self.pair_is_valid(last[t - size, rows], ids)
                rows, ids = rows[good], ids[good]
                last[t, rows] = ids
                counts[t, rows] = counts[t - size, rows] + 1
                keep = np.ones(len(open_rows), bool)
                keep[near[good]] = False
                open_rows = open_rows[keep]
                if not len(open_rows):
                    break
        return counts.T

    def _one(self, word: bytes) -> np.ndarray:
        """The same for one long word."""
        if not self.suffixes:
            self.suffixes = frozenset(t[i:] for t in self.ids for i in range(len(t)))
        last, counts = [0] * (len(word) + 1), [0] * (len(word) + 1)
        for t in range(1, len(word) + 1):
            for size in range(1, t + 1):
                piece = word[t - size : t]
                if piece not in self.suffixes:
                    break
                i = self.ids.get(piece)
                if i is not None and self.stands_alone[i] and (size == t or self.alone_is_valid.apart(last[t - size], i)):
                    last[t], counts[t] = i, counts[t - size] + 1
                    break
        return np.array(counts[1:], np.uint32)

    def _enter(self, words: list[str]) -> None:
        """Enter the counts of all prefixes of new words."""
        for word, counts in zip(words, self.prefixes([w.encode() for w in words])):
            if word in CONTRACTIONS:  # cut after its first letter, it is two words
                counts = np.array([1, 2, counts[2]], np.uint32)
            self.words[word] = counts.astype("<u4").tobytes()
            self.held += 5 * len(counts)

    def learn(self, stretches: list[str]) -> None:
        """Enter the counts of new stretches, and of all prefixes of their new words."""
        if len(self.words) > CACHE_ENTRIES or self.held > CACHE_BYTES:
            self.words.clear()
            self.held = sum(map(len, self.stretches))
        found = [self.pattern.findall(s) for s in stretches]
        self._enter([w for w in {w for words in found for w in words} if w not in self.words])
        self.held += sum(map(len, stretches))
        for s, words in zip(stretches, found):
            if any(t in s for t in self.special):
                self.stretches[s] = len(self.whole_text.encode(s, add_special_tokens=False).ids)
            else:
                self.stretches[s] = sum(int.from_bytes(self.words[w][-4:], "little") for w in words)

    def split(self, text: str) -> list[str]:
        """Stretches of a text (white space, then a run of other characters) that count on their own."""
        return _STRETCH.findall(text)

    def stretch_counts(self, stretches: list[str]) -> np.ndarray:
        """Each stretch's tokens; those not met before are learnt together."""
        new = [s for s in set(stretches) if s not in self.stretches]
        if new:
            if len(self.stretches) > CACHE_ENTRIES or self.held > CACHE_BYTES:
                self.stretches.clear()
                self.held = sum(map(len, self.words.values()))
                new = list(set(stretches))
            self.learn(new)
        return np.fromiter(map(self.stretches.__getitem__, stretches), np.int64, len(stretches))

    def within(self, stretch: str) -> np.ndarray:
        """The counts of a stretch's first 1, 2, … bytes, each as if the text ended there."""
        if any(t in stretch for t in self.special):
            ends = [len(stretch[: i + 1].encode()) for i in range(len(stretch))]
            counts = [len(self.whole_text.encode(stretch[: i + 1], add_special_tokens=False).ids) for i in range(len(stretch))]
            return np.repeat(counts, np.diff([0, *ends]))
        core = stretch.lstrip()
        blank = stretch[: len(stretch) - len(core)]
        out, done, before = [], 0, 0
        self._enter([w for w in dict.fromkeys([*self.pattern.findall(stretch), blank]) if w and w not in self.words])
        for word in self.pattern.findall(stretch):
            counts = np.frombuffer(self.words[word], "<u4").astype(np.int64)
            out.append(counts + done)
            done += int(counts[-1])
            before += len(counts)
        out = np.concatenate(out) if out else np.zeros(0, np.int64)
        if blank:  # a cut inside the white space leaves it one word
            whole = np.frombuffer(self.words[blank], "<u4")
            out[: len(whole)] = whole
        return out

    def count_all(self, texts: list[str | None], limit: int | None = None) -> list[tuple[int, int, int]]:
        """Of each text: its bytes, its tokens, and the bytes of its longest prefix within ``limit`` tokens."""
        split = [None if not t or _CONTROL.search(t) else self.split(t) for t in texts]
        counts = self.stretch_counts([s for stretches in split if stretches for s in stretches])
        out, at = [], 0
        for text, stretches in zip(texts, split):
            size = len(text.encode()) if text else 0
            if stretches is None:  # empty, or separators that the library's pattern does not take for white space
                total = len(self.whole_text.encode(text, add_special_tokens=False).ids) if text else 0
                cut = size if limit is None or total <= limit else self._cut_by_search(text, limit)
            else:
                own = counts[at : at + len(stretches)]
                at += len(stretches)
                total = int(own.sum())
                cut = size if limit is None or total <= limit else self._cut(stretches, own, limit)
            out.append((size, total, cut))
        return out

    def _cut(self, stretches: list[str], counts: np.ndarray, limit: int) -> int:
        sums = np.cumsum(counts)
        whole = int(np.searchsorted(sums, limit, side="right"))
        done = int(sums[whole - 1]) if whole else 0
        inner = self.within(stretches[whole])
        raw = stretches[whole].encode()
        fits = [j + 1 for j in np.flatnonzero(inner + done <= limit) if j + 1 == len(raw) or raw[j + 1] & 0xC0 != 0x80]
        return len("".join(stretches[:whole]).encode()) + (fits[-1] if fits else 0)

    def _cut_by_search(self, text: str, limit: int) -> int:
        spans = self.whole_text.encode(text, add_special_tokens=False).offsets
        return len(text[: spans[limit - 1][1]].encode()) if limit else 0

    def all_prefixes(self, text: str | None) -> np.ndarray:
        """The token count of each prefix of a text, by its bytes (0 first); right at ends of characters."""
        if not text:
            return np.zeros(1, np.int64)
        parts, done = [np.zeros(1, np.int64)], 0
        for stretch in self.split(text):
            parts.append(self.within(stretch) + done)
            done += int(self.stretch_counts([stretch])[0])
        return np.concatenate(parts)


def counter(path: str) -> PrefixCounter:
    return worker.kept(f"token counts {path}", lambda: PrefixCounter(path))


def count_tokens(
    documents: DataFrame, tokenizer: str, *, limit: int = 1024, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, n_bytes, n_tokens, cut_bytes) of each row; cut_bytes: its longest prefix within ``limit`` tokens.

    ``tokenizer`` is the place of a byte-level BPE file of the tokenizers library that every
    executor has. No shuffle: each task keeps a bounded cache of words and walks its own rows.
    """
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        own = counter(tokenizer)
        for batch in batches:
            for part in pieces(batch, text):
                results = own.count_all(part.column(text).to_pylist(), limit)
                yield pa.RecordBatch.from_arrays(
                    [part.column(key), *(pa.array([r[i] for r in results], pa.int64()) for i in range(3))],
                    names=[key, "n_bytes", "n_tokens", "cut_bytes"],
                )

    return documents.select(key, text).mapInArrow(run, f"{key} {kind}, n_bytes long, n_tokens long, cut_bytes long")
