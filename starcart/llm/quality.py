"""Quality of texts: counted rules, and a calibrated classifier of hashed n-grams.

The classifier is a logistic regression over hashed word n-grams, n-grams of word shapes
(length, case, symbols, whether a word repeats the one before) and character n-grams. Each family's
features are shares of its n-grams, so that the score is a mean weight and long texts are
not surer than short ones. It is trained on a bounded sample of labelled rows; a part of it that the
weights have not seen gives the calibration (Platt's sigmoid). Texts are scored in Arrow batches.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starcart.llm.words import IS_SPACE, LOWER, Stretches, Words, as_bytes, map_slices, mix, stored

MIN_WORDS = 10  # fixed thresholds
MAX_REPEATED = 20  # percent
KEEP = 0.5

WINDOW = 5
BITS = 16  # of the hashed features
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(b"#*$%&|<>")] = True
_IS_MARK = np.zeros(256, bool)
_IS_MARK[list(b"!?.,;:=+~^_-/\\()[]{}\"'@")] = True
_IS_UPPER = np.zeros(256, bool)
_IS_UPPER[65:91] = True
_IS_DIGIT = np.zeros(256, bool)
_IS_DIGIT[48:58] = True


def _before(flags: np.ndarray) -> np.ndarray:
    """How many are set before each place."""
    out = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def rule_counts(words: Words) -> dict[str, np.ndarray]:
    """Per text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words. Letters keep their case."""
    data, offsets = words.data, words.offsets
    begins = (data & 0xC0) != 0x80
    per_doc = lambda flags: np.diff(_before(flags)[offsets])
    return {
        "n_words": words.counts(),
        "word_chars": per_doc(begins & ~IS_SPACE[data]),
        "n_symbols": per_doc(_IS_SYMBOL[data]),
        "n_dup_lines": _repeated_lines(words),
        "n_repeat_words": _repeated_words(words),
    }


def _repeated_lines(words: Words) -> np.ndarray:
    data, n = words.data, len(words)
    ends = np.flatnonzero(data == 10)
    starts = np.append(0, ends[:-1] + 1)
    doc = np.searchsorted(words.offsets, starts, "right") - 1
    written = np.diff(_before(~IS_SPACE[data])[np.append(starts, len(data))]) > 0
    starts, ends, doc = starts[written], ends[written], doc[written]
    if not len(starts):
        return np.zeros(n, np.int64)
    keys = np.stack([doc.astype(np.uint64), Stretches(data).hash(starts, ends)], axis=1)
    different = np.unique(keys, axis=0)[:, 0].astype(np.int64)
    return np.bincount(doc, minlength=n) - np.bincount(different, minlength=n)


def _repeated_words(words: Words) -> np.ndarray:
    hashes, first, n = words.hashes(), words.first, len(words)
    if len(hashes) < WINDOW:
        return np.zeros(n, np.int64)
    windows = _grams(hashes, WINDOW)
    doc = np.repeat(np.arange(n), words.counts())
    inside = np.flatnonzero(doc[: len(windows)] == doc[WINDOW - 1 :])
    order = inside[np.lexsort((windows[inside], doc[inside]))]
    same = (windows[order][1:] == windows[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    twice = order[np.append(same, False) | np.append(False, same)]
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + WINDOW, -1)
    covered = np.cumsum(cover)[:-1] > 0
    return np.diff(_before(covered)[first])


def _grams(items: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` items."""
    total = np.zeros(max(len(items) - size + 1, 0), np.uint64)
    for k in range(size):
        factor = np.uint64(pow(0x9E3779B97F4A7C15, 2 * k + 1, 1 << 64))
        total += items[k : len(items) - size + 1 + k].astype(np.uint64) * factor
    return mix(total + np.uint64(size))


def _shapes(words: Words, hashes: np.ndarray) -> np.ndarray:
    """A number per word that tells its form but not its letters."""

    def of(flags: np.ndarray, most: int) -> np.ndarray:
        sums = _before(flags[words.data])
        return np.minimum(sums[words.ends] - sums[words.starts], most)

    again = np.zeros(len(hashes), np.int64)
    again[1:] = hashes[1:] == hashes[:-1]
    again[words.first[:-1][words.counts() > 0]] = 0
    length = np.minimum(words.ends - words.starts, 31) // 2
    upper = np.minimum(of(_IS_UPPER, 3), 3)
    parts = [(length, 16), (upper, 4), (of(_IS_SYMBOL, 3), 4), (of(_IS_MARK, 3), 4), (of(_IS_DIGIT, 1), 2), (again, 2)]
    shape = np.zeros(len(hashes), np.int64)
    for value, size in parts:
        shape = shape * size + value
    return shape


def ngrams(words: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per family the hashed n-grams of all texts, and where each text's begin.

    An n-gram over the end of a text is not one; such places hold feature 0, which has no weight.
    """
    hashes, n = words.hashes(), len(words)
    shapes = _shapes(words, hashes)
    letters = LOWER[words.data]
    doc_of_word = np.repeat(np.arange(n), words.counts())
    doc_of_byte = np.repeat(np.arange(n), np.diff(words.offsets))
    families = [
        (hashes, 1, doc_of_word, words.first),
        (hashes, 2, doc_of_word, words.first),
        (shapes, 1, doc_of_word, words.first),
        (shapes, 3, doc_of_word, words.first),
        (letters, 3, doc_of_byte, words.offsets),
        (letters, 4, doc_of_byte, words.offsets),
    ]
    out = []
    for family, (items, size, doc, first) in enumerate(families):
        grams = np.zeros(len(items), np.int64)
        if len(items) >= size:
            made = _grams(items, size) + np.uint64(family * 0x632BE5AB)
            inside = doc[: len(made)] == doc[size - 1 :]
            grams[: len(made)] = np.where(inside, (mix(made) >> np.uint64(64 - BITS)).astype(np.int64) | 1, 0)
        out.append((grams, first))
    return out


@dataclass(frozen=True)
class Quality:
    """Weights of the features and the calibration; without labels everything is as likely as not."""

    weights: np.ndarray
    bias: float = 0.0
    slope: float = 1.0
    shift: float = 0.0

    def margins(self, words: Words) -> np.ndarray:
        total = np.full(len(words), self.bias)
        for grams, first in ngrams(words):
            values = self.weights[grams]
            lengths = np.diff(first)
            full = np.flatnonzero(lengths > 0)
            if len(full):
                total[full] += np.add.reduceat(values, first[:-1][full]) / lengths[full]
        return total

    def probabilities(self, words: Words) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(words) + self.shift, -30, 30)))


def _sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    chosen = (
        labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int"))
        .where("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    small = F.broadcast(chosen)  # at most ``rows`` pairs of numbers
    return docs.select(F.col("doc_id").cast("long"), "text").join(small, "doc_id")


def fit_quality(docs: DataFrame, labels: DataFrame, rows: int = 2_000, epochs: int = 12) -> Quality:
    """Trained on at most ``rows`` labelled texts, chosen by a hash of the id, a quarter for calibration."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(as_bytes(batch.column("text")), lower=False)
        families = ngrams(words)
        found: tuple[list, list] = ([], [])
        for i in range(batch.num_rows):
            shares = np.zeros(1 << BITS)
            for grams, first in families:
                own = grams[first[i] : first[i + 1]]
                if len(own):
                    shares += np.bincount(own, minlength=1 << BITS) / len(own)
            shares[0] = 0
            at = np.flatnonzero(shares)
            found[0].append(at.astype(np.int32))
            found[1].append(shares[at].astype(np.float32))
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("quality"),
                pa.array(found[0], pa.list_(pa.int32())),
                pa.array(found[1], pa.list_(pa.float32())),
            ],
            ["doc_id", "quality", "at", "shares"],
        )

    drawn = map_slices(
        _sample(docs, labels, rows), run, "doc_id long, quality int, at array<int>, shares array<float>"
    )
    table = stored(drawn, "quality_sample").toArrow().sort_by("doc_id")
    quality = table.column("quality").to_numpy()
    if not len(quality) or quality.min() == quality.max():
        return Quality(np.zeros(1 << BITS))
    at = table.column("at").combine_chunks()
    shares = table.column("shares").combine_chunks().values.to_numpy()
    return _trained(at.offsets.to_numpy(), at.values.to_numpy(), shares, quality.astype(float), epochs)


def _trained(first, at, shares, y: np.ndarray, epochs: int, rate: float = 0.5, batch: int = 32) -> Quality:
    """Adagrad over batches of rows in a fixed random order; then the calibration."""
    rng = np.random.default_rng(11)
    order = rng.permutation(len(y))
    apart, train = order[: len(y) // 4], order[len(y) // 4 :]
    w, bias = np.zeros(1 << BITS), 0.0
    squares, bias_square = np.full(1 << BITS, 1e-6), 1e-6

    def margin(row: int) -> float:
        own = slice(first[row], first[row + 1])
        return float(shares[own] @ w[at[own]]) + bias

    for _ in range(epochs):
        rng.shuffle(train)
        for k in range(0, len(train), batch):
            rows = train[k : k + batch]
            errors = [1 / (1 + np.exp(-margin(r))) - y[r] for r in rows]
            places = np.concatenate([at[first[r] : first[r + 1]] for r in rows])
            steps = np.concatenate(
                [shares[first[r] : first[r + 1]] * e for r, e in zip(rows, errors, strict=True)]
            )
            slope = np.bincount(places, steps, minlength=1 << BITS) / len(rows)
            hit = np.flatnonzero(slope)
            squares[hit] += slope[hit] ** 2
            w[hit] -= rate * slope[hit] / np.sqrt(squares[hit])
            own = float(np.mean(errors))
            bias_square += own**2
            bias -= rate * own / np.sqrt(bias_square)
    w[0] = 0.0
    if not len(apart) or y[apart].min() == y[apart].max():
        return Quality(w, bias)
    slope, shift = _platt(np.array([margin(r) for r in apart]), y[apart])
    return Quality(w, bias, slope, shift)


def _platt(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a sigmoid over margins, with Platt's softened targets."""
    up, down = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    x = np.stack([margins, np.ones(len(y))], axis=1)
    v = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, x.T @ (p - target))
        v -= np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return float(v[0]), float(v[1])


def quality(docs: DataFrame, model: Quality) -> DataFrame:
    """Per row: doc_id, the counts of ``rule_counts``, base_failed, probability, kept.

    base_failed: fewer than MIN_WORDS words, or more than MAX_REPEATED percent of them in repeated
    windows. kept: not failed, and the probability of good quality is KEEP or more. A null text
    has no words and fails. Rows are judged one by one.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(as_bytes(batch.column("text")), lower=False)
        counts = rule_counts(words)
        n, repeated = counts["n_words"], counts["n_repeat_words"]
        failed = (n < MIN_WORDS) | (100 * repeated > MAX_REPEATED * n)
        p = model.probabilities(words)
        columns = {**counts, "base_failed": failed, "probability": p, "kept": ~failed & (p >= KEEP)}
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *map(pa.array, columns.values())], ["doc_id", *columns]
        )

    kind = dict(docs.dtypes)["doc_id"]
    return map_slices(
        docs.select("doc_id", "text"),
        run,
        f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, base_failed boolean, probability double, kept boolean",
    )
