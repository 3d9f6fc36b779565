"""Toxicity by a factorisation machine over hashed terms.

A text is the set of its terms' hash buckets. The score is the logistic function of a bias, a
weight per bucket, and for every pair of buckets present the inner product of their factors, so
that words which are harmless alone can count together. Buckets enter the machine if they are
found more often with one label than with the other than chance explains, in all texts or in those
that hold a bucket which does so in all; the others have weight and factors zero. It is fitted by gradient descent on a bounded sample of labelled rows.

Cases: a null or empty text has the score of the bias alone; texts of any length are scored whole;
if there is nothing to learn from, all scores are 0; rows with a null label or key are not learnt
from; repeated rows are kept. Other columns are not carried over.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.text import LOWER, flat, pieces, span_hashes, words

BUCKET_BITS = 20
FACTORS = 8
#: Buckets that enter by themselves: at most so many, with a difference of at least so many standard
#: errors. As many more enter as their partners, with a difference that chance gives to no pair.
MOST_BUCKETS = 1024
LEAST_EVIDENCE = 4.0
STEPS, RATE, DECAY = 250, 0.05, 1e-4

#: ASCII that is neither letter nor digit ends a term.
BREAKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of each text's distinct terms, in order."""
    data, offsets = flat(column)
    data = LOWER[data]
    starts, ends, counts = words(data, offsets, BREAKS)
    buckets = span_hashes(data, starts, ends) >> np.uint64(64 - BUCKET_BITS)
    row = np.repeat(np.arange(len(counts)), counts)
    both = np.unique(row.astype(np.int64) << BUCKET_BITS | buckets.astype(np.int64))
    return both >> BUCKET_BITS, both & ((1 << BUCKET_BITS) - 1)


@dataclass
class FactorisationMachine:
    buckets: np.ndarray  # ascending
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, column: pa.Array) -> np.ndarray:
        row, bucket = terms(column)
        at = np.minimum(np.searchsorted(self.buckets, bucket), len(self.buckets) - 1)
        known = self.buckets[at] == bucket if len(self.buckets) else np.zeros(len(row), bool)
        row, at = row[known], at[known]
        n = len(column)
        total = self.bias + np.bincount(row, self.weights[at], minlength=n)
        for f in range(self.factors.shape[1]):
            v = self.factors[at, f]
            total += 0.5 * (np.bincount(row, v, minlength=n) ** 2 - np.bincount(row, v * v, minlength=n))
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def _evidence(seen: np.ndarray, with_label: np.ndarray, n: int, share: float) -> np.ndarray:
    """Standard errors by which buckets in ``seen`` of n texts differ from the share of the label among them."""
    spread = np.sqrt(np.maximum(seen * share * (1 - share) * (n - seen) / max(n - 1, 1), 1e-9))
    return np.where(seen >= 3, np.abs(with_label - seen * share) / spread, 0)


def partners(strong: np.ndarray, flat_buckets: np.ndarray, owner: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Buckets that tell the label in the texts that hold one of the strong ones."""
    seen = np.bincount(flat_buckets, minlength=1 << BUCKET_BITS)
    often = seen[flat_buckets] >= 3
    names, at = np.unique(flat_buckets[often], return_inverse=True)
    owner = owner[often]
    ends = np.searchsorted(owner, np.arange(len(labels)), side="right")
    sizes = np.diff(np.r_[0, ends])
    by_bucket = np.argsort(at, kind="stable")
    heads = np.searchsorted(at[by_bucket], np.arange(len(names) + 1))
    best, tried = np.zeros(len(names)), 0
    for i in np.searchsorted(names, strong):
        own = owner[by_bucket[heads[i] : heads[i + 1]]]
        size, label = sizes[own], labels[own]
        beside = at[np.arange(size.sum()) + np.repeat(ends[own] - np.cumsum(size), size)]
        both = np.bincount(beside, minlength=len(names))
        toxic = np.bincount(beside[np.repeat(label > 0, size)], minlength=len(names))
        near = np.flatnonzero(both >= 3)
        tried += len(near)
        best[near] = np.maximum(best[near], _evidence(both[near], toxic[near], len(own), label.mean()))
    best[np.isin(names, strong)] = 0
    first = np.argsort(-best, kind="stable")[:MOST_BUCKETS]
    least = max(LEAST_EVIDENCE, np.sqrt(2 * np.log(max(tried, 1))))
    return names[first[best[first] >= least]]


def fit(rows: list[np.ndarray], labels: np.ndarray) -> FactorisationMachine:
    """The machine of texts given as buckets, and their labels 0 and 1."""
    n, positive = len(labels), int(labels.sum())
    flat_buckets = np.concatenate(rows) if n else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(n), [len(r) for r in rows])
    seen = np.bincount(flat_buckets, minlength=1 << BUCKET_BITS)
    with_label = np.bincount(flat_buckets, labels[owner].astype(float), minlength=1 << BUCKET_BITS)
    share = positive / max(n, 1)
    evidence = _evidence(seen, with_label, n, share)
    best = np.argsort(-evidence, kind="stable")[:MOST_BUCKETS]
    buckets = best[evidence[best] >= LEAST_EVIDENCE]
    buckets = np.sort(np.r_[buckets, partners(buckets, flat_buckets, owner, labels)])
    at = np.searchsorted(buckets, flat_buckets)
    known = np.isin(flat_buckets, buckets)
    x = np.zeros((n, len(buckets)), np.float32)
    x[owner[known], at[known]] = 1
    y = labels.astype(np.float32)
    rng = np.random.default_rng(0)
    bias = np.float32(np.log((positive + 0.5) / (n - positive + 0.5)))
    start = [np.array([bias], np.float32), np.zeros(len(buckets), np.float32), rng.normal(0, 0.01, (len(buckets), FACTORS)).astype(np.float32)]
    first, second = [np.zeros_like(p) for p in start], [np.zeros_like(p) for p in start]
    balance = np.where(y > 0, 0.5 / max(share, 1e-6), 0.5 / max(1 - share, 1e-6)).astype(np.float32) / max(n, 1)
    for step in range(1, STEPS + 1):
        b, w, v = start
        xv = x @ v
        total = b + x @ w + 0.5 * ((xv * xv).sum(axis=1) - x @ (v * v).sum(axis=1))
        wrong = (1 / (1 + np.exp(-np.clip(total, -40, 40))) - y) * balance
        seen_wrong = x.T @ wrong
        slopes = [
            np.array([wrong.sum()], np.float32),
            seen_wrong + DECAY * w,
            x.T @ (wrong[:, None] * xv) - seen_wrong[:, None] * v + DECAY * v,
        ]
        for p, slope, m, s in zip(start, slopes, first, second):  # Adam
            m += 0.1 * (slope - m)
            s += 0.001 * (slope * slope - s)
            p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return FactorisationMachine(buckets, float(start[0][0]), start[1].astype(float), start[2].astype(float))


def learn(
    documents: DataFrame,
    labels: DataFrame,
    learn_from: Column,
    *,
    most_rows: int = 20_000,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> FactorisationMachine | None:
    """Fit on at most ``most_rows`` labelled rows where ``learn_from`` (of the key) holds.

    The sample is the rows with the smallest hashes of their keys, so it is bounded however many
    labels there are; a row of it without a text is no example. Tasks find the terms of whole texts;
    the driver gets at most 2**BUCKET_BITS numbers a row.
    """
    usable = labels.where(learn_from & F.col(label).isin(0, 1) & F.col(key).isNotNull())
    usable = usable.select(F.col(key).alias("id"), F.col(label).cast("int").alias("label"))
    chosen = usable.orderBy(F.xxhash64("id"), "id", "label").limit(most_rows)
    texts = documents.select(F.col(key).alias("id"), F.col(text).alias("text"))
    texts = texts.where(F.col("text").isNotNull())

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                row, bucket = terms(part.column("text"))
                offsets = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(bucket.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("label"), lists], names=["label", "buckets"])

    sample = texts.join(F.broadcast(chosen), "id").select("label", "text")
    # a repeated key could bring more rows than labels were chosen
    got = sample.mapInArrow(find, "label int, buckets array<int>").limit(most_rows).toArrow()
    known = got.column("label").to_numpy()
    if not len(known):
        return None
    rows = [np.asarray(x.values if hasattr(x, "values") else x, dtype=np.int64) for x in got.column("buckets")]
    return fit(rows, known)


def score(
    documents: DataFrame, machine: FactorisationMachine | None, *, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, score) of every row."""
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text):
                found = machine.score(part.column(text)) if machine else np.zeros(part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column(key), pa.array(found, pa.float64())], names=[key, "score"])

    return documents.select(key, text).mapInArrow(run, f"{key} {kind}, score double")
