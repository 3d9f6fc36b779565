"""Byte-level BPE encoding and decoding in DataFrame functions, by folding ranked merges.

A vocabulary is a rank file: every piece of bytes has a rank, which is its id. A text is split into
words by the vocabulary's pattern. A word starts as the array of its bytes, each the piece of one
byte, and is folded: each step looks the rank of every two neighbours up in a literal map and merges
those of the lowest rank, wherever they stand, until no two neighbours have a rank. While a word is
folded a piece is one symbol, a character that stands for its id, so that a merge of two pieces is
one ``replace``, which goes from left to right as the merges do. Merging a rank everywhere
at once is the same as merging it place by place, as no merge makes a pair of a lower rank than its
own; ``read_ranks`` proves that for a file by folding every piece.

Words repeat, so the distinct words of all texts are counted and the ``most_words`` most frequent of
them folded once; their ids reach the texts as a literal map. Literals are set as session variables,
which Spark replaces by their values when it plans. What the map does not have (rarer words, words of
over ``LONGEST_WORD`` bytes) is folded where it stands: it is spelled among the ids, tasks hand
these over in Arrow batches, and all words of a batch take each step together, as arrays. No text is shuffled, only the counts of distinct
words are.

Decoding looks the bytes of every id up in a literal array and concatenates them.

Cases: a null or empty text has no ids and decodes to no bytes; repeated rows, null keys and other
columns are kept as they are; an id outside the vocabulary decodes to null as a whole. The words of
one text are held at once. A fold takes as many steps as the word has different merges, each as long
as the word, so a random word of 100,000 letters takes seconds while a repetitive one takes less.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import worker
from tidewell.llm.text import PIECE_BYTES
from tidewell.session import stage

#: Symbols are characters from here on; those of small vocabularies end before the surrogates.
FIRST_SYMBOL, FIRST_SYMBOL_OF_MANY, SURROGATES = 0x100, 0x10000, 0xD800
#: Buckets of the literal rank map: a lookup goes through the pairs of one bucket.
BUCKETS = 1 << 16
#: Pieces of a word up to which it is cheaper to take neighbours one by one.
SHORT = 64
#: Bytes of the longest word that may enter the table of frequent words.
LONGEST_WORD = 64
#: Words of a smaller map, looked up first.
FEWER_WORDS = (1 << 13,)
#: Bits of a rank in the pair table; and more than any rank.
RANK_BITS = 32
NO_RANK = 1 << RANK_BITS
#: Counts of words are binned by this many bins a doubling to find the least count that enters.
BINS = 8


@dataclass(frozen=True)
class Ranks:
    """Pieces by id, and for ids of two bytes or more the ids of the two pieces they are merged from."""

    pieces: tuple[bytes, ...]
    parts: tuple[tuple[int, int] | None, ...]


@lru_cache(maxsize=2)
def read_ranks(path: str) -> Ranks:
    """A rank file: one piece in base64 and its rank a line, ranks from 0 without gaps.

    Every piece must be what its own bytes fold to, from two pieces of lower rank.
    """
    with open(path, "rb") as file:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in file if line.strip())}
    pieces = sorted(ranks, key=ranks.__getitem__)
    if [ranks[p] for p in pieces] != list(range(len(pieces))) or any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError(f"{path}: ranks must be 0, 1, ... and hold every byte")
    return Ranks(tuple(pieces), tuple(_parts(p, ranks) for p in pieces))


def _parts(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, int] | None:
    """The last two pieces that the bytes of ``piece`` fold to."""
    if len(piece) == 1:
        return None
    left = [piece[i : i + 1] for i in range(len(piece))]
    while len(left) > 2:
        joined = [ranks.get(a + b, len(ranks)) for a, b in zip(left, left[1:])]
        at = min(range(len(joined)), key=joined.__getitem__)
        if joined[at] == len(ranks):
            raise ValueError(f"{piece!r} is not made by merges")
        left[at : at + 2] = [left[at] + left[at + 1]]
    first, second = ranks[left[0]], ranks[left[1]]
    if max(first, second) >= ranks[piece] and len(piece) > 2:
        raise ValueError(f"{piece!r} has a lower rank than its parts")
    return first, second


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _variable(spark: SparkSession, name: str, table: DataFrame, kind: str) -> Column:
    """The one value of ``table`` as a literal: Spark puts a session variable's value in its place."""
    spark.sql(f"DECLARE OR REPLACE VARIABLE {name} {kind}")
    table.createOrReplaceTempView(name)
    spark.sql(f"SET VARIABLE {name} = (SELECT value FROM {name})")
    spark.catalog.dropTempView(name)
    return F.expr(f"session.{name}")


def _literal(spark: SparkSession, text: str, parsed: Column, kind: str) -> Column:
    """The literal that ``parsed`` makes of the column ``text``. It is named by its value: a literal is set anew by itself only."""
    name = f"literal_{hashlib.sha256(f'{kind} {text}'.encode()).hexdigest()[:24]}"
    return _variable(spark, name, spark.createDataFrame([(text,)], "text string").select(parsed.alias("value")), kind)


def _texts(spark: SparkSession, values: list[str]) -> Column:
    return _literal(spark, "\n".join(values), F.split("text", "\n"), "ARRAY<STRING>")


# --- words ---------------------------------------------------------------------------------


def _code_points(spark: SparkSession, category: str) -> str:
    """What the tokenizer's Unicode version has in a category and this JVM's has not, as ranges."""
    every = "".join(map(chr, range(0xD800))) + "".join(map(chr, range(0xE000, 0x110000)))
    single = tiktoken.Encoding(
        "category", pat_str=category, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={}
    )
    others = spark._jvm.java.util.regex.Pattern.compile(category).matcher(every).replaceAll("")
    missing = [ord(c) for c in others if single.encode_ordinary(c)]
    ranges: list[list[int]] = []
    for point in missing:
        if ranges and point == ranges[-1][1] + 1:
            ranges[-1][1] = point
        else:
            ranges.append([point, point])
    return "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges)


def _factored(pattern: str) -> str:
    """Leading alternatives of plain characters that begin alike, with what they share in front: tried once a place."""
    if re.search(r"[(\[][^)\]]*[|]", pattern):  # not only alternatives of the whole
        return pattern
    parts = pattern.split("|")
    plain = next((i for i, p in enumerate(parts) if not re.fullmatch(r"[\w' ]{2,}", p) or p[0] != parts[0][0]), len(parts))
    if plain < 2:
        return pattern
    ends = "|".join(p[1:] for p in parts[:plain])
    return "|".join([f"{parts[0][0]}(?:{ends})", *parts[plain:]])


@lru_cache(maxsize=4)
def _java_patterns(spark: SparkSession, pattern: str) -> tuple[str, str]:
    """The pattern for the JVM, and with the letters and numbers that the JVM does not know yet."""
    pattern = _factored(pattern)
    more = {c: _code_points(spark, c) for c in (r"\p{L}", r"\p{N}") if c in pattern}

    def widened(part: str) -> str:
        inside = part.startswith("[")
        for category, ranges in more.items():
            part = part.replace(category, category + ranges if inside else f"[{category}{ranges}]")
        return part

    wide = "".join(widened(part) for part in re.split(r"(\[[^\]]*\])", pattern))
    return "(?U)" + pattern, "(?U)" + wide


def words_of(spark: SparkSession, text: Column, pattern: str) -> Column:
    """The words of a text in order; none of a null text."""
    plain, wide = _java_patterns(spark, pattern)
    unknown = (F.octet_length(text) > F.length(text)) & text.rlike(r"[\x{370}-\x{10FFFF}]") & text.rlike(r"\p{Cn}")
    found = F.when(unknown, F.regexp_extract_all(text, F.lit(wide), F.lit(0)))
    return F.coalesce(found.otherwise(F.regexp_extract_all(text, F.lit(plain), F.lit(0))), F.array().cast("array<string>"))


# --- folding -------------------------------------------------------------------------------


@dataclass(frozen=True)
class Folding:
    """The literals of a vocabulary."""

    ranks: Column  # buckets of a map from two symbols to the id of what they merge to
    parts: Column  # by id: the two symbols it is merged from
    symbols: Column  # by id: its symbol
    single: str  # the symbols of the 256 bytes
    first: int  # code point of the symbol of id 0

    def rank(self, pair: Column) -> Column:
        return F.element_at(F.get(self.ranks, _bucket(pair, BUCKETS)), pair)

    def fold(self, word: Column) -> Column:
        """The symbols of a word's pieces."""
        latin = F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")
        start = F.translate(latin, "".join(map(chr, range(256))), self.single)

        def step(state: Column) -> Column:
            left = state["left"]
            places = F.sequence(F.lit(1), F.greatest(F.length(left) - 1, F.lit(1)))
            of_short = F.transform(places, lambda place: self.rank(F.substring(left, place, F.lit(2))))
            neighbours = F.regexp_extract_all(left, F.lit("(?s)(?=(..))"), F.lit(1))
            least = F.array_min(F.when(F.length(left) <= SHORT, of_short).otherwise(F.transform(neighbours, self.rank)))
            merged = lambda rank: F.replace(state["left"], F.get(self.parts, rank), F.get(self.symbols, rank))
            return _let(least, lambda rank: F.struct(F.coalesce(merged(rank), state["left"]).alias("left"), rank.isNotNull().alias("open")))

        return F.aggregate(
            F.sequence(F.lit(1), F.octet_length(word)),
            F.struct(start.alias("left"), F.lit(True).alias("open")),
            lambda state, _: F.when(state["open"], step(state)).otherwise(state),
            lambda state: state["left"],
        )

    def ids(self, word: Column) -> Column:
        """The ids of a word's pieces."""
        return F.transform(F.split(self.fold(word), ""), lambda symbol: F.ascii(symbol) - self.first)


def folding(spark: SparkSession, path: str) -> Folding:
    known = read_ranks(path)
    first = FIRST_SYMBOL if FIRST_SYMBOL + len(known.pieces) <= SURROGATES else FIRST_SYMBOL_OF_MANY
    symbols = [chr(first + i) for i in range(len(known.pieces))]
    pairs = [symbols[p[0]] + symbols[p[1]] if p else "" for p in known.parts]
    merges = spark.createDataFrame([(pair, i) for i, pair in enumerate(pairs) if pair], "key string, value int")
    ranks = f"ranks_{hashlib.sha256(''.join(pairs).encode()).hexdigest()[:24]}"
    return Folding(
        ranks=_map(spark, ranks, merges, BUCKETS),
        parts=_texts(spark, pairs),
        symbols=_texts(spark, symbols),
        single="".join(symbols[known.pieces.index(bytes([b]))] for b in range(256)),
        first=first,
    )


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.hash(key), F.lit(buckets))


def _map(spark: SparkSession, name: str, entries: DataFrame, buckets: int) -> Column:
    """A map from ``key`` to ``value`` as a literal: buckets of maps, by the hashes of the keys."""
    held = F.collect_list(F.struct("key", "value")).alias("entries")
    filled = entries.groupBy(_bucket(F.col("key"), buckets).alias("id")).agg(held)
    in_order = F.sort_array(F.collect_list(F.struct("id", "entries")))
    every = spark.range(buckets).join(filled, "id", "left")
    table = every.agg(F.transform(in_order, lambda row: F.map_from_entries(row["entries"])).alias("value"))
    return _variable(spark, name, table, table.schema["value"].dataType.simpleString())


def _pieces(spark: SparkSession, path: str) -> Column:
    """By id: the bytes of a piece, as the characters of the same codes."""
    pieces = json.dumps([p.decode("latin-1") for p in read_ranks(path).pieces])
    return _literal(spark, pieces, F.from_json("text", "array<string>"), "ARRAY<STRING>")


# --- frequent words ------------------------------------------------------------------------


def frequent_words(words: DataFrame, vocabulary: Folding, most_words: int) -> list[tuple[str, int]]:
    """Variables that hold buckets of maps from words to ids, and how many buckets: the most frequent words.

    The last map has ``most_words`` at most, those before it the FEWER_WORDS most frequent of them, as a
    small map is quicker. ``words`` has one column of arrays. Words of a count that not all fit in with
    stay out.
    """
    spark = words.sparkSession
    counted = stage(words.select(F.explode(words.columns[0]).alias("word")).groupBy("word").agg(F.count("*").alias("n")), "words")
    level = F.floor(F.log2("n") * BINS).cast("int").alias("level")
    fitting = counted.where(F.octet_length("word") <= LONGEST_WORD).select("word", "n", level)
    least, room = None, most_words
    for row in fitting.groupBy("level").agg(F.count("*").alias("n")).orderBy(F.desc("level")).collect():
        room -= row["n"]
        if room < 0:
            break
        least = row["level"]
    chosen = fitting.where(F.col("level") >= least if least is not None else F.lit(False))
    # at most most_words short words from here on, told by the counts above
    ids = vocabulary.ids(F.col("word"))
    folded = chosen.repartition(F.xxhash64("word")).select(F.col("word").alias("key"), "n", ids.alias("value"))
    folded, found = stage(folded, "folded-words"), []
    for most in (*(n for n in FEWER_WORDS if n < most_words), most_words):
        some = folded if most == most_words else folded.orderBy(F.desc("n"), "key").limit(most)
        # the large map is kept small by buckets of two words
        name, buckets = f"words_{uuid.uuid4().hex}", 2 * most if most < most_words else -(-most // 2)
        _map(spark, name, some, buckets)
        found.append((name, buckets))
    return found


# --- other words ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Pairs:
    """The ranks of all pairs of ids (x, y) in one array, at the place of x plus y; the places of all x keep them apart."""

    byte_ids: np.ndarray  # by byte: its id
    places: np.ndarray  # by id: the place of its pairs
    table: np.ndarray  # the first id of the pair that stands here, and its rank

    def ranks(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        entry = self.table[self.places[first] + second] ^ (first << RANK_BITS)
        return np.where(entry < NO_RANK, entry, NO_RANK)


@lru_cache(maxsize=2)
def pairs_of(path: str) -> Pairs:
    known = read_ranks(path)
    rows: dict[int, list[tuple[int, int]]] = {}
    for rank, parts in enumerate(known.parts):
        if parts:
            rows.setdefault(parts[0], []).append((parts[1], rank))
    ids = len(known.parts)
    size, start = 6 * ids, 0
    places, taken = np.zeros(ids, np.int64), np.zeros(size, bool)
    table = np.full(size, ids << RANK_BITS, np.int64)  # no pair begins with id ``ids``
    for x, row in sorted(rows.items(), key=lambda r: -len(r[1])):  # long rows while there is room
        seconds, ranks = np.array(row, np.int64).T
        while True:
            tried = np.arange(start, start + 64) % (size - ids)
            free = ~taken[tried[:, None] + seconds].any(axis=1)
            if free.any():
                break
            start += 64
        places[x] = tried[free.argmax()]
        taken[places[x] + seconds] = True
        table[places[x] + seconds] = x << RANK_BITS | ranks
    byte_ids = np.array([known.pieces.index(bytes([b])) for b in range(256)], np.int64)
    return Pairs(byte_ids, places, table)


def fold_together(data: np.ndarray, sizes: np.ndarray, pairs: Pairs) -> tuple[np.ndarray, np.ndarray]:
    """The ids of words, given as bytes one after the other with their sizes; and how many each has. No word is empty."""
    left, counts = pairs.byte_ids[data], np.array(sizes, np.int64)
    last = np.zeros(len(left), bool)  # of its word
    last[np.cumsum(counts) - 1] = True
    symbols = np.arange(len(left))  # those of words that are still folded
    kept = np.ones(len(left), bool)
    words = np.arange(len(counts))
    while len(words):
        now = left[symbols]
        ranks = np.append(pairs.ranks(now[:-1], now[1:]), NO_RANK)
        ranks[last[symbols]] = NO_RANK
        lengths = counts[words]
        starts = np.cumsum(lengths) - lengths
        least = np.minimum.reduceat(ranks, starts)
        merged = np.flatnonzero((ranks == np.repeat(least, lengths)) & (ranks < NO_RANK))
        # where a pair overlaps the one before, as in a run of one symbol, every second is merged
        opens = np.r_[True, np.diff(merged) > 1][: len(merged)]
        into_run = np.arange(len(merged)) - np.maximum.accumulate(np.where(opens, np.arange(len(merged)), 0))
        merged = merged[into_run % 2 == 0]
        left[symbols[merged]] = ranks[merged]
        last[symbols[merged]] = last[symbols[merged + 1]]
        kept[symbols[merged + 1]] = False
        counts[words] -= np.bincount(np.searchsorted(starts, merged, side="right") - 1, minlength=len(words))
        open_ = least < NO_RANK
        stay = np.repeat(open_, lengths) & kept[symbols]
        symbols, words = symbols[stay], words[open_]
    return left[kept], counts


def _spelled(word: Column) -> Column:
    """The bytes of a word as numbers below zero: byte b is -1 - b, and -257 - b where the word begins."""
    latin = F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")
    return F.transform(F.split(latin, ""), lambda byte, at: F.when(at == 0, F.lit(-257)).otherwise(F.lit(-1)) - F.ascii(byte))


def fold_spelled(path: str) -> Callable[[Column], Column]:
    """Arrays of ids with the words folded that are spelled among them."""
    pairs = pairs_of(path)

    @F.arrow_udf("array<int>")
    def fold(ids: pa.Array) -> pa.Array:
        numbers = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        spelled = np.flatnonzero(numbers < 0)
        width = np.ones(len(numbers), np.int64)  # ids in place of each number
        width[spelled] = 0
        begins = np.flatnonzero(numbers[spelled] < -256)
        data = (-1 - numbers[spelled] & 255).astype(np.uint8)
        offsets, at, found = np.append(begins, len(spelled)), 0, [np.zeros(0, np.int64)]
        while at < len(begins):  # PIECE_BYTES at a time, or one word
            stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PIECE_BYTES, side="right")) - 1)
            new, counts = fold_together(data[offsets[at] : offsets[stop]], np.diff(offsets[at : stop + 1]), pairs)
            width[spelled[begins[at:stop]]] = counts
            found.append(new)
            at = stop
        whole = np.repeat(numbers, width)
        whole[whole < 0] = np.concatenate(found)
        ends = np.r_[0, np.cumsum(width)][np.r_[0, np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False))]]
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(whole.astype(np.int32)))

    return fold


# --- texts ---------------------------------------------------------------------------------


def encode(
    df: DataFrame, path: str, pattern: str, *, text: str = "text", ids: str = "ids", most_words: int = 1 << 18
) -> DataFrame:
    """``df`` with the ids of its texts, an array of integers."""
    spark, vocabulary = df.sparkSession, folding(df.sparkSession, path)
    words = words_of(spark, F.col(text), pattern)
    maps = frequent_words(df.select(words.alias("words")), vocabulary, most_words)

    def ids_of(word: Column) -> Column:
        known = [F.element_at(F.get(F.expr(f"session.{name}"), _bucket(word, buckets)), word) for name, buckets in maps]
        return F.coalesce(*known, _spelled(word))

    encoded = df.withColumn(ids, fold_spelled(path)(F.flatten(F.transform(words, ids_of))))
    for name, _ in maps:  # the frame has their values
        spark.sql(f"DROP TEMPORARY VARIABLE {name}")
    worker.trim()
    return encoded


def decode(spark: SparkSession, ids: Column, path: str) -> Column:
    """The bytes of the pieces with these ids, one after the other."""
    pieces = _pieces(spark, path)
    unknown = "\u0100"  # not the character of a byte
    whole = F.array_join(F.transform(ids, lambda i: F.get(pieces, i)), "", unknown)
    known = _let(whole, lambda latin: F.when(~F.contains(latin, F.lit(unknown)), latin))
    return F.encode(known, "ISO-8859-1")
