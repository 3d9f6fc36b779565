"""Packing by powers of two: each document's tokens are cut into pieces of binary lengths.

A document of n tokens gives n // 4096 pieces of 4096 and one piece for each set bit of the rest,
longest first. Pieces of one length form a bucket, and every piece is a sequence of its own
bucket: no sequence holds two documents, and none needs padding, as its length is a power of two.

Cases: a null or empty text gives the one piece of its closing token; texts of any length are
encoded whole; repeated rows are packed each on its own; other columns are not carried over.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from tidewell.llm import worker
from tidewell.llm.text import distinct_spans, flat, pieces, words
from tidewell.llm.token_counts import byte_alphabet

#: Words, and parts of words, that a worker remembers before it starts over.
CACHE_WORDS, CACHE_PARTS = 350_000, 250_000
#: Bytes of these words.
CACHE_BYTES = 16 << 20
#: Bytes of texts handled together.
TOGETHER = 1 << 20
#: New words split together: what the library makes of them on its way is many times their size.
LEARNT_TOGETHER = 1 << 13

#: Fixed value: how this vocabulary splits lower-cased text, as published with it.
PART_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
#: Characters whose lower case, or whose being white space, depends on who asks; and special strings.
_DELICATE = re.compile("[\x00-\x1f\x7f-\xa0Σİŉǰΐΰ]|<\\|")


def binary_lengths(n: int, most: int) -> list[int]:
    """Powers of two that add up to n, none above ``most`` (a power of two), longest first."""
    return [most] * (n // most) + [1 << b for b in range(most.bit_length() - 2, -1, -1) if n % most >> b & 1]


class IdTable:
    """Lists of ids in one array, by number."""

    def __init__(self) -> None:
        self.ids, self.starts = np.zeros(0, "<u4"), np.zeros(1, np.int64)

    def __len__(self) -> int:
        return len(self.starts) - 1

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.ids = np.concatenate([self.ids, ids])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])

    def get(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists of these numbers one after the other, and their sizes."""
        begin = self.starts[numbers]
        sizes = self.starts[numbers + 1] - begin
        shift = np.repeat(begin - np.cumsum(sizes) + sizes, sizes)
        return self.ids[shift + np.arange(len(shift))], sizes


class WordEncoder:
    """Ids of texts, word by word. The vocabulary drops white space, so words stand on their own.

    A word is split into its parts (letters, a digit, other signs), which come up far more often;
    only parts not met before go through the library, and words that lower-casing or normalising
    could change in another way than the library does. New words are split all at once.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        # the library's merges alone, for parts that are lower-cased and split already
        self.bare = Tokenizer(models.BPE(vocab=model["vocab"], merges=merges, end_of_word_suffix=model["end_of_word_suffix"]))
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.alphabet = {b: c for b, c in byte_alphabet().items() if b != ord(" ")}
        self.pattern = regex.compile(PART_PATTERN + "| ")
        size = self.library.get_vocab_size()
        self.closes = np.array([(self.library.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self.words: dict[bytes, int] = {}
        self.held = self.part_bytes = 0  # bytes of the words and parts remembered
        self.parts: dict[str, int] = {" ": 0}  # what parts one word from the next has no ids
        self.word_ids, self.part_ids = IdTable(), IdTable()
        self.part_ids.add(np.zeros(0, "<u4"), np.zeros(1, np.int64))

    def _learn(self, words: list[bytes]) -> None:
        text, odd, keys = b" ".join(words).decode(), [], words
        if _DELICATE.search(text) or not unicodedata.is_normalized("NFC", text):
            every = text.split(" ")
            is_odd = [bool(_DELICATE.search(w)) or not unicodedata.is_normalized("NFC", w) for w in every]
            odd = [w for w, o in zip(every, is_odd) if o]
            text = " ".join(w for w, o in zip(every, is_odd) if not o)
            keys = [k for k, o in zip(words, is_odd) if not o] + [k for k, o in zip(words, is_odd) if o]
        plain = len(words) - len(odd)
        if len(self.parts) > CACHE_PARTS or self.part_bytes > CACHE_BYTES:
            self.parts, self.part_ids, self.part_bytes = {" ": 0}, IdTable(), 0
            self.part_ids.add(np.zeros(0, "<u4"), np.zeros(1, np.int64))
        parts = self.pattern.findall(text.lower()) if plain else []
        new = [p for p in set(parts) if p not in self.parts]
        if new:  # all at once: the last token of each part is marked
            spelled = " ".join(new).encode().decode("latin-1").translate(self.alphabet)
            ids = np.array(self.bare.encode_batch_fast([spelled], add_special_tokens=False)[0].ids, "<u4")
            sizes = np.diff(np.flatnonzero(np.r_[True, self.closes[ids]]))
            if len(sizes) != len(new):
                raise ValueError("the vocabulary does not mark the last token of a word")
            self.parts.update(zip(new, range(len(self.part_ids), len(self.part_ids) + len(new))))
            self.part_ids.add(ids, sizes)
            self.part_bytes += len(spelled)
        if plain:
            numbers = np.fromiter(map(self.parts.__getitem__, parts), np.int64, len(parts))
            ids, sizes = self.part_ids.get(numbers)
            ends = np.r_[0, np.flatnonzero(numbers == 0), len(parts)]
            self._enter(keys[:plain], ids, np.diff(np.r_[0, np.cumsum(sizes)][ends]))
        if odd:
            met = [e.ids for e in self.library.encode_batch_fast(odd, add_special_tokens=False)]
            self._enter(keys[plain:], np.array([i for ids in met for i in ids], "<u4"), np.array([len(ids) for ids in met]))

    def _enter(self, keys: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.words.update(zip(keys, range(len(self.word_ids), len(self.word_ids) + len(keys))))
        self.held += sum(map(len, keys))
        self.word_ids.add(ids, sizes)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each text has."""
        data, offsets = flat(column)
        starts, ends, counts = words(data, offsets)
        if not len(starts):
            return np.zeros(0, "<u4"), np.zeros(len(column), np.int64)
        first, back = distinct_spans(data, starts, ends)
        if len(self.words) > CACHE_WORDS or self.held > CACHE_BYTES:
            self.words, self.word_ids, self.held = {}, IdTable(), 0
        raw = data.tobytes()
        distinct = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        new = [word for word in distinct if word not in self.words]
        for at in range(0, len(new), LEARNT_TOGETHER):
            self._learn(new[at : at + LEARNT_TOGETHER])
        numbers = [self.words[word] for word in distinct]
        ids, sizes = self.word_ids.get(np.array(numbers, np.int64)[back])
        sums = np.r_[0, np.cumsum(sizes)]
        return ids, np.diff(sums[np.r_[0, np.cumsum(counts)]])


def encoder(path: str) -> WordEncoder:
    return worker.kept(f"packing {path}", lambda: WordEncoder(path))


def pack(
    documents: DataFrame,
    tokenizer: str,
    *,
    most: int = 4096,
    closing_id: int = 2,
    with_ids: bool = True,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: key, start, length, ids, ids_crc32, doc_tokens, sequence_id, offset, bucket.

    ``ids`` are the piece's tokens (left out unless ``with_ids``); ``bucket`` is the power of two of
    its length, to store sequences of one length together (``write.partitionBy("bucket")``). No
    shuffle: each task packs its own rows, as a sequence never needs a second document.
    """
    if most < 1 or most & (most - 1):
        raise ValueError("the longest sequence must be a power of two")
    kind = documents.schema[key].dataType.simpleString()
    fields = f"start long, length long, {'ids array<int>, ' if with_ids else ''}ids_crc32 long, doc_tokens long"
    names = [key, *(f.split()[0] for f in fields.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        for batch in batches:
            for part in pieces(batch, text, TOGETHER):
                ids, counts = own.encode(part.column(text))
                ids, counts = np.insert(ids, np.cumsum(counts), closing_id), counts + 1
                split = [binary_lengths(n, most) for n in counts.tolist()]
                length = np.array([size for sizes in split for size in sizes], np.int64)
                row = np.repeat(np.arange(len(split)), [len(sizes) for sizes in split])
                end = np.cumsum(length)
                start = end - length - (np.cumsum(counts) - counts)[row]
                raw = memoryview(ids.tobytes())
                sums = [zlib.crc32(raw[4 * (b - n) : 4 * b]) for b, n in zip(end.tolist(), length.tolist())]
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, end].astype(np.int32)), pa.array(ids.view(np.int32)))
                columns = [
                    part.column(key).take(pa.array(row)),
                    pa.array(start),
                    pa.array(length),
                    *([lists] if with_ids else []),
                    pa.array(sums, pa.int64()),
                    pa.array(counts[row]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        worker.trim()  # between tasks a worker keeps its words only

    found = documents.select(key, text).mapInArrow(run, f"{key} {kind}, {fields}")
    return found.select(
        "*",
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        F.log2("length").cast("int").alias("bucket"),
    )
