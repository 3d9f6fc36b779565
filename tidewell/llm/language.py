"""Language identification by unigram pieces, summed over all segmentations of a word.

The pieces are those of a fixed public vocabulary. Each language has its own probabilities of
them, and the probability of a word in a language is the sum, over all ways to cut it into pieces,
of the product of the pieces' probabilities: a forward pass over the word's characters. The
probabilities are fitted by expectation maximisation with the matching backward pass. A text's
score is the sum over its words of the log probabilities; languages start out equal.

A run of letters is scored in parts of UNIT, each of which starts from the sums that the one before
ended with, so no segmentation is lost at their borders. Only in learning do the parts of longer runs
count by themselves.

Cases: a text that is null or has no letter (general category L) is ``und`` with score 0, as is every
text if nothing can be learnt; texts of any length are read whole; equal scores go to the first language by name; repeated rows are kept;
a null key is never learnt from and not held out. Other columns are not carried over.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm import worker
from tidewell.llm.text import pieces
from tidewell.operators.lookup import lookup
from tidewell.session import stage

UNIT = 32
ROUNDS = 4
SMOOTHING = 0.05
#: Probability of a character that no piece has.
UNKNOWN = 1e-7
#: Words, and their letters, that a worker remembers before it starts over, and words scored at a time.
CACHE_WORDS, CACHE_LETTERS = 200_000, 4_000_000
BLOCK = 20_000

_LETTERS = regex.compile(r"\p{L}+")


def words_of(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def public_pieces(path: str) -> list[str]:
    """The letters-only pieces of a sentencepiece vocabulary, lower-cased, without their word marks."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {model.id_to_piece(i).removeprefix("▁").lower() for i in range(model.get_piece_size())}
    return sorted(p for p in found if _LETTERS.fullmatch(p))


def _units(words: list[str]) -> tuple[list[str], np.ndarray]:
    """Words cut to UNIT characters at most, longest first, and the word each comes from."""
    units, origin = [], []
    for i, w in enumerate(words):
        for at in range(0, len(w), UNIT):
            units.append(w[at : at + UNIT])
            origin.append(i)
    order = sorted(range(len(units)), key=lambda i: -len(units[i]))
    return [units[i] for i in order], np.array([origin[i] for i in order], np.int64)


class Lattice:
    """Which pieces end where, in many words at once (longest first), beyond the first ``lead`` characters."""

    def __init__(self, vocabulary: Vocabulary, words: list[str], lead: int = 0):
        self.lead = lead
        self.lengths = np.array([len(w) for w in words])
        width = int(self.lengths[0]) if len(words) else 0
        codes = np.frombuffer("".join(w.ljust(width, "\0") for w in words).encode("utf-32-le"), np.uint32).reshape(-1, width)
        self.width = width
        self.arcs: list[list[tuple[int, int, np.ndarray]]] = []  # by end: (size, rows, ids)
        rolled = np.zeros((width + 1, len(words)), np.uint64)
        for t in range(width):
            rolled[t + 1] = rolled[t] * vocabulary.base + codes[:, t].astype(np.uint64) + np.uint64(1)
        for t in range(1, width + 1):
            active = int(np.searchsorted(-self.lengths, -t, side="right"))
            here = []
            for size in vocabulary.lengths if t > lead else ():
                if size > t:
                    break
                ids = vocabulary.find(rolled[t, :active] - rolled[t - size, :active] * vocabulary.power[size])
                if size == 1:
                    ids = np.where(ids < 0, vocabulary.size, ids)
                rows = np.flatnonzero(ids >= 0)
                if len(rows):
                    here.append((size, rows, ids[rows]))
            self.arcs.append(here)

    def forward(self, chance: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
        """The probability of each prefix of each word in each language: (place, word, language).

        ``start`` has those of the first ``lead`` characters, from none on.
        """
        out = np.zeros((self.width + 1, len(self.lengths), chance.shape[1]))
        out[: self.lead + 1] = 1 if start is None else start
        for t, arcs in enumerate(self.arcs, 1):
            for size, rows, ids in arcs:
                out[t, rows] += out[t - size, rows] * chance[ids]
        return out

    def expected(self, chance: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """How often each piece is used, by language, in words that occur ``weight`` times each."""
        ahead = self.forward(chance)
        behind = np.zeros_like(ahead)
        ends = (self.lengths, np.arange(len(self.lengths)))
        behind[ends] = weight / ahead[ends]
        out = np.zeros_like(chance)
        for t in range(self.width, 0, -1):
            for size, rows, ids in self.arcs[t - 1]:
                step = behind[t, rows] * chance[ids]
                behind[t - size, rows] += step
                used = step * ahead[t - size, rows]
                for language in range(chance.shape[1]):
                    out[:, language] += np.bincount(ids, used[:, language], minlength=len(chance))
        return out


class Vocabulary:
    """Pieces by the hash of their characters; the id after the last is any unknown character."""

    base = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, pieces_in: list[str]):
        self.size = len(pieces_in)
        self.lengths = sorted({1, *map(len, pieces_in)})
        self.power = np.cumprod(np.r_[np.uint64(1), np.full(self.lengths[-1], self.base, np.uint64)], dtype=np.uint64)
        codes = np.zeros(len(pieces_in), np.uint64)
        for i, p in enumerate(pieces_in):
            h = 0
            for c in p:
                h = (h * int(self.base) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
            codes[i] = h
        order = np.argsort(codes)
        self.codes, self.ids = codes[order], order
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[codes >> np.uint64(44)] = True

    def find(self, codes: np.ndarray) -> np.ndarray:
        out = np.full(len(codes), -1, np.int64)
        near = np.flatnonzero(self.maybe[codes >> np.uint64(44)])
        at = np.minimum(np.searchsorted(self.codes, codes[near]), len(self.codes) - 1)
        hit = self.codes[at] == codes[near]
        out[near[hit]] = self.ids[at[hit]]
        return out


@dataclass
class LanguageModel:
    languages: list[str]
    vocabulary: Vocabulary
    chance: np.ndarray
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log probability of each word in each language."""
        out = np.zeros((len(words), len(self.languages)))
        order = sorted(range(len(words)), key=lambda i: -len(words[i]))
        for at in range(0, len(order), BLOCK):
            rows = order[at : at + BLOCK]
            out[rows] = self._block_scores([words[i] for i in rows])
        return out

    def _block_scores(self, words: list[str]) -> np.ndarray:
        """The same of a block, longest first: part by part, each from the last prefixes of the one before."""
        out, start = np.zeros((len(words), len(self.languages))), None
        back = self.vocabulary.lengths[-1] - 1
        sizes = np.array([len(w) for w in words])
        for begin in range(0, len(words[0]), UNIT):
            left, more = (int(np.searchsorted(-sizes, -size)) for size in (begin, begin + UNIT))  # longer than that
            lead = min(begin, back)
            lattice = Lattice(self.vocabulary, [w[begin - lead : begin + UNIT] for w in words[:left]], lead)
            ahead = lattice.forward(self.chance, start)
            ends = np.arange(more, left)
            out[ends] += np.log(ahead[lattice.lengths[ends], ends])
            if more:  # what goes on: scaled, so that the sums of long runs stay numbers
                stop = lead + UNIT
                start = ahead[stop - min(begin + UNIT, back) : stop + 1, :more]
                scale = start.max(axis=0)
                start = start / scale
                out[:more] += np.log(scale)
        return out


def fit(pieces_in: list[str], counts: dict[str, Counter]) -> LanguageModel | None:
    """The model of word counts by language."""
    languages = sorted(x for x, c in counts.items() if c)
    if not languages:
        return None
    vocabulary = Vocabulary(pieces_in)
    words = sorted(set().union(*(counts[x] for x in languages)))
    often = np.array([[counts[x][w] for x in languages] for w in words], float)
    chance = np.full((len(pieces_in) + 1, len(languages)), 1 / (len(pieces_in) + 1))
    chance[-1] = UNKNOWN
    for _ in range(ROUNDS):
        used = np.zeros_like(chance)
        for at in range(0, len(words), BLOCK):
            units, origin = _units(words[at : at + BLOCK])
            used += Lattice(vocabulary, units).expected(chance, often[origin + at])
        used = used[:-1] + SMOOTHING
        chance[:-1] = used / used.sum(axis=0)
    return LanguageModel(languages, vocabulary, chance)


class Scorer:
    """Scores texts with one model; remembers words between texts."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.place: dict[str, int] = {}
        self.held = 0
        self.scores = np.zeros((0, len(model.languages)))

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        split = [words_of(t) if t else [] for t in texts]
        met = {w for words in split for w in words}
        new = [w for w in met if w not in self.place]
        if len(self.place) + len(new) > CACHE_WORDS or self.held > CACHE_LETTERS:
            self.place, self.held, self.scores, new = {}, 0, self.scores[:0], list(met)
        if new:
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
            self.held += sum(map(len, new))
            self.scores = np.concatenate([self.scores, self.model.word_scores(new)])
        names, scores = [], []
        for words in split:
            if not words:
                names.append("und")
                scores.append(0.0)
                continue
            places = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
            total = self.scores[places].sum(axis=0)
            best = int(total.argmax())
            names.append(self.model.languages[best])
            scores.append(float(1 / np.exp(total - total[best]).sum()))
        return names, scores


def _scorer(model: LanguageModel) -> Scorer:
    return worker.kept(f"language {model.name}", lambda: Scorer(model))


def _likely(hashed: Column, rows: Column, wanted: int) -> Column:
    """Whether a hash below 2**30 is among about twice the ``wanted`` smallest of that many rows."""
    return hashed.cast("double") * rows < float(2 * wanted * (1 << 30))


def learn(
    documents: DataFrame,
    vocabulary: str,
    learn_from: Column,
    *,
    per_language: int = 400,
    key: str = "doc_id",
    text: str = "text",
    language: str = "lang",
) -> LanguageModel | None:
    """Fit on a bounded sample: at most ``per_language`` rows of each language where ``learn_from`` holds.

    The sample is the rows with the smallest hashes of their keys, of those whose text has a letter.
    Tasks count its words; the driver gets those counts, whose number the sample bounds.
    """
    usable = documents.where(
        learn_from & F.col(language).isNotNull() & F.col(key).isNotNull() & F.col(text).rlike(r"\p{L}")
    )
    ids = usable.select(
        F.col(key).alias("id"), F.col(language).alias("language"), F.pmod(F.xxhash64(key), F.lit(1 << 30)).alias("hash")
    )
    # twice the rows wanted pass by their hash alone, so a language of most rows is no large group
    rows = stage(ids.groupBy("language").agg(F.count("*").alias("n")), "languages")
    counted = lookup(ids, rows, {"language": F.col("language")}, {"n": "n"}, how="inner")
    likely = counted.where(_likely(F.col("hash"), F.col("n"), per_language))
    by_hash = Window.partitionBy("language").orderBy("hash", "id")
    chosen = (
        likely.withColumn("at", F.row_number().over(by_hash))
        .where(F.col("at") <= per_language)
        .select("id")
        .distinct()
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                found: dict[str, Counter] = {}
                for name, t in zip(part.column("language").to_pylist(), part.column("text").to_pylist()):
                    found.setdefault(name, Counter()).update(m[0] for m in _LETTERS.finditer(t.lower()))
                rows = [(x, w, n) for x, c in found.items() for w, n in c.items()]
                types = [("language", pa.string()), ("word", pa.string()), ("n", pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(types)], names=[c for c, _ in types])

    sample = usable.select(F.col(key).alias("id"), F.col(language).alias("language"), F.col(text).alias("text"))
    chosen = stage(chosen, "language-sample")
    # a repeated key could bring more rows than were chosen
    sample = sample.join(F.broadcast(chosen), "id", "left_semi").limit(chosen.count())
    counted = sample.select("language", "text").mapInArrow(count, "language string, word string, n long")
    rows = counted.groupBy("language", "word").agg(F.sum("n").alias("n")).toArrow()
    counts: dict[str, Counter] = {}
    for name, word, n in zip(*(rows.column(c).to_pylist() for c in ("language", "word", "n"))):
        counts.setdefault(name, Counter())[word] = n
    return fit(public_pieces(vocabulary), counts)


def identify(documents: DataFrame, model: LanguageModel | None, *, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` of every row, with lang_pred and score (the probability of that language)."""
    fields = [*keep, *([] if text in keep else [text])]
    schema = ", ".join(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text):
                texts = part.column(text).to_pylist()
                if model is None:
                    names, scores = ["und"] * len(texts), [0.0] * len(texts)
                else:
                    names, scores = _scorer(model).predict(texts)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    names=[*keep, "lang_pred", "score"],
                )

    return documents.select(*fields).mapInArrow(run, f"{schema}, lang_pred string, score double")
