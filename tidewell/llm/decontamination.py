"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over a run of tokens; the positions it leaves out may differ. Seeds of the
test items and of the training texts that hash alike are hits. Every set of positions that may
differ in an item's run has a mask: where MASKS leave one uncovered, as in short items, it has its own. Around each hit the whole item is
laid over the text at that offset and compared token by token: a text is contaminated if some run
of WINDOW item tokens (all of a shorter item) agrees in at least the required share.

Test items come in blocks of bounded size, which every task holds while it reads the texts; a
benchmark of any size is so many blocks. Texts are never shuffled, so frequent passages cost the
same wherever they stand.

Cases: tokens are runs of letters and digits, ASCII letters in lower case, so that punctuation and
white space do not matter; null and empty texts and items have none; items of fewer than
LEAST_TOKENS tokens would meet everywhere, so they are found only as whole texts: in texts of just
their tokens; repeated rows and items give repeated pairs; a null key stays. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm import worker
from tidewell.llm.text import LOWER, flat, mixed, pieces, span_hashes, words
from tidewell.llm.toxicity import BREAKS

#: Fixed masks: 1 takes a token, 0 ignores it.
MASKS = ("111111", "11011011", "1101100011", "10110100101")
WINDOW = 13
LEAST_TOKENS = 5
#: Bytes of test items in a block.
BLOCK_BYTES = 1 << 20

_FACTORS = mixed(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every token, and where each text's tokens begin (with the end)."""
    data, offsets = flat(column)
    data = LOWER[data]
    starts, ends, counts = words(data, offsets, BREAKS)
    return span_hashes(data, starts, ends), np.r_[0, np.cumsum(counts)]


def seeds(hashes: np.ndarray, mask: str) -> np.ndarray:
    """The hash of the mask at each place where it fits."""
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i, c in enumerate(mask):
        if c == "1":
            out += hashes[i : i + n] * _FACTORS[i]
    return mixed(out + np.uint64(len(mask)))


def least_agreeing(width: int, share: float) -> int:
    """How many tokens of a run of ``width`` have to agree."""
    return math.ceil(share * width - 1e-9)


@lru_cache(maxsize=None)
def own_masks(width: int, share: float) -> tuple[tuple[str, int], ...]:
    """(mask, its place in the run) for each set of positions of a run that may differ and that no mask of MASKS leaves out.

    Masks begin and end with a 1, so that a run which the text's edge cuts is found as well.
    """
    out = []
    for gaps in combinations(range(width), width - max(1, least_agreeing(width, share))):
        run = "".join("0" if i in gaps else "1" for i in range(width))
        covered = any(
            all(run[at + i] == "1" for i, c in enumerate(mask) if c == "1") for mask in MASKS for at in range(width - len(mask) + 1)
        )
        if not covered:
            out.append((run.strip("0"), run.index("1")))
    return tuple(out)


@dataclass
class Items:
    """Distinct test items of one block, and their seeds in order of hash."""

    hashes: np.ndarray
    offsets: np.ndarray
    masks: list[tuple[str, np.ndarray, np.ndarray, np.ndarray]]  # mask, seed hashes, item, place in the item

    @staticmethod
    def of(column: pa.Array, share: float) -> Items:
        hashes, offsets = tokens(column)
        sizes = np.diff(offsets)
        item = np.repeat(np.arange(len(sizes)), sizes)
        wanted: dict[str, list[tuple[int, int]]] = {mask: [] for mask in MASKS}  # (width of the run, place in it)
        for width in sorted({min(int(n), WINDOW) for n in sizes if n >= LEAST_TOKENS}):
            for mask, at in own_masks(width, share):
                wanted.setdefault(mask, []).append((width, at))
        masks = []
        for mask, runs in wanted.items():
            found = seeds(hashes, mask)
            place = np.arange(len(found))
            within, size = place - offsets[item[place]], sizes[item[place]]
            good = (item[place] == item[place + len(mask) - 1]) & (size >= LEAST_TOKENS)
            if mask not in MASKS:  # for runs of just this width
                ours = np.zeros(len(found), bool)
                for width, at in runs:
                    ours |= (np.minimum(size, WINDOW) == width) & (within >= at) & (within - at + width <= size)
                good &= ours
            found, place = found[good], place[good]
            order = np.argsort(found, kind="stable")
            place = place[order]
            masks.append((mask, found[order], item[place], place - offsets[item[place]]))
        return Items(hashes, offsets, masks)

    def hits(self, hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Distinct (text, item, offset of the item in all tokens) of equal seeds, as rows."""
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        out = [np.zeros((0, 3), np.int64)]
        for mask, own, item, place in self.masks:
            found = seeds(hashes, mask)
            if not len(found) or not len(own):
                continue
            maybe = np.zeros(1 << 20, bool)
            maybe[own >> np.uint64(44)] = True
            at = np.flatnonzero(maybe[found >> np.uint64(44)])
            at = at[row[at] == row[at + len(mask) - 1]]
            low, high = np.searchsorted(own, found[at], "left"), np.searchsorted(own, found[at], "right")
            n = high - low
            pick = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            start = np.repeat(at, n)
            if len(pick):
                out.append(np.unique(np.stack([row[start], item[pick], start - place[pick]], axis=1), axis=0))
        return np.unique(np.concatenate(out), axis=0)

    def whole(self, hashes: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
        """(text, item, tokens) of texts that are a short item."""
        short: dict[bytes, list[int]] = {}
        for i in np.flatnonzero((np.diff(self.offsets) > 0) & (np.diff(self.offsets) < LEAST_TOKENS)).tolist():
            short.setdefault(self.hashes[self.offsets[i] : self.offsets[i + 1]].tobytes(), []).append(i)
        sizes = np.diff(offsets)
        few = np.flatnonzero((sizes > 0) & (sizes < LEAST_TOKENS)).tolist() if short else []
        return [(t, i, int(sizes[t])) for t in few for i in short.get(hashes[offsets[t] : offsets[t + 1]].tobytes(), ())]

    def verified(self, hashes: np.ndarray, offsets: np.ndarray, share: float) -> list[tuple[int, int, int, int, int]]:
        """(text, item, first token, tokens that agree, tokens of the item): the best offset of each pair that agrees enough."""
        best = {(t, i): (t, i, 0, n, n) for t, i, n in self.whole(hashes, offsets)}
        every = self.hits(hashes, offsets)
        for at in range(0, len(every), 4096):
            text, item, base = every[at : at + 4096].T
            size = np.diff(self.offsets)[item]
            ends = np.cumsum(size)
            owner = np.repeat(np.arange(len(item)), size)
            step = np.arange(len(owner)) - np.repeat(ends - size, size)
            place = base[owner] + step
            inside = (place >= offsets[text[owner]]) & (place < offsets[text[owner] + 1])
            same = inside & (hashes[np.clip(place, 0, len(hashes) - 1)] == self.hashes[self.offsets[item[owner]] + step])
            sums = np.r_[0, np.cumsum(same)]
            window = np.minimum(WINDOW, size)
            fits = step + window[owner] <= size[owner]
            first = np.flatnonzero(fits)
            agree = sums[first + window[owner[first]]] - sums[first]
            enough = agree >= np.ceil(share * window[owner[first]] - 1e-9)
            total = sums[ends] - sums[ends - size]
            for i in np.unique(owner[first[enough]]).tolist():
                key = (int(text[i]), int(item[i]))
                new = (*key, int(base[i] - offsets[text[i]]), int(total[i]), int(size[i]))
                if key not in best or (new[3], -new[2]) > (best[key][3], -best[key][2]):
                    best[key] = new
        return sorted(best.values())


def contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    *,
    share: float = 0.8,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(key, item_key, first_token, n_agreeing, n_item_tokens): every text that holds a test item, with it.

    ``first_token`` is where the item's beginning lies over the text (negative if the text begins
    inside the item).
    """
    items = benchmark.where(F.col(item_text).isNotNull()).select(F.col(item_key).alias("item"), F.col(item_text).alias("t"))
    distinct = items.select("t").distinct()
    size = distinct.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    kind = documents.schema[key].dataType.simpleString()
    numbers = "first_token long, n_agreeing long, n_item_tokens long"

    def search(block: list[str]) -> DataFrame:
        own = Items.of(pa.array(block, pa.string()), share)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            worker.alone()
            names = pa.array(block, pa.string())
            for batch in batches:
                for part in pieces(batch, text):
                    found = own.verified(*tokens(part.column(text)), share)
                    columns = [pa.array([r[i] for r in found], pa.int64()) for i in range(5)]
                    yield pa.RecordBatch.from_arrays(
                        [part.column(key).take(columns[0]), names.take(columns[1]), *columns[2:]],
                        names=["id", "t", "first_token", "n_agreeing", "n_item_tokens"],
                    )

        return documents.select(key, text).mapInArrow(run, f"id {kind}, t string, {numbers}")

    found: DataFrame | None = None
    for b in range(blocks):
        in_block = distinct.where(F.pmod(F.xxhash64("t"), F.lit(blocks)) == b)
        part = search([r["t"] for r in in_block.collect()])
        found = part if found is None else found.unionAll(part)
    return found.join(items, "t").select(
        F.col("id").alias(key), F.col("item").alias(item_key), "first_token", "n_agreeing", "n_item_tokens"
    )
