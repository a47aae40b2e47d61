"""Documents that hold a benchmark passage, by greedy string tiling.

Words are runs of letters, digits and bytes above 127 of the lower-cased text, so that
punctuation does not matter. A document and an item that share a seed, a run of five
words, are tiled: the longest run of words common to both and not yet marked is marked in both, again
and again, down to five words. Runs of one length are found by Karp-Rabin hashes of all
windows of that length. The marked share of the item is its coverage, which does not depend on the
order of the runs, so that a passage whose sentences were reordered is found as well.

The benchmark is the stated set that all documents are held against. It is read in blocks of
a bounded number of words; each block goes to the tasks with the function, and documents are scanned once
per block. An item shorter than a seed is its own seed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starcart.llm.words import Words, as_bytes, map_batches, map_slices, mix, slices

SEED = 5
COVERAGE = 0.5
BLOCK_WORDS = 1_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BREAKS = np.ones(256, bool)
_BREAKS[list(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = False
_BREAKS[128:] = False


def plain_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and where each text's begin."""
    lowered = [t.decode("utf-8", "replace").lower().encode() for t in texts]
    words = Words(lowered, lower=False, breaks=_BREAKS)
    return words.hashes(), words.first


class Windows:
    """Karp-Rabin hashes of all windows of any length of a sequence of words."""

    def __init__(self, words: np.ndarray) -> None:
        self.powers = np.cumprod(np.full(len(words) + 1, _BASE), dtype=np.uint64)
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * self.powers[: len(words)], out=self.sums[1:])
        self.n = len(words)

    def of(self, size: int) -> np.ndarray:
        if size > self.n:
            return np.zeros(0, np.uint64)
        # a window's sum is scaled up to the power of the last one, so that equal windows agree
        sums = self.sums[size:] - self.sums[:-size]
        return mix(sums * self.powers[self.n - size - np.arange(len(sums))])


def tiles(doc: np.ndarray, item: np.ndarray, least: int, free: np.ndarray) -> list[tuple[int, int, int]]:
    """Greedy tiles ``(start in doc, start in item, words)``, longest first.

    ``free`` marks the words of doc that may be used. Among runs of one length the first in
    the document goes first, with the first place in the item.
    """
    free, open_ = free.copy(), np.ones(len(item), bool)
    last = len(doc) + len(item)
    # one base for both, so that their windows compare
    both = Windows(np.concatenate([doc, item]))
    out = []

    def at(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        hashes = both.of(size)
        used = np.zeros(last + 1, np.int64)
        np.cumsum(np.concatenate([~free, ~open_]), out=used[1:])
        clear = used[size:] == used[:-size]
        clear[max(len(doc) - size + 1, 0) : len(doc)] = False  # over the seam
        return hashes, np.flatnonzero(clear[: len(doc)]), np.flatnonzero(clear[len(doc) :])

    def common(size: int) -> bool:
        hashes, left, right = at(size)
        return bool(np.isin(hashes[len(doc) + right], hashes[left]).any())

    low, high = least, min(len(doc), len(item))
    while low <= high:
        if not common(low):
            break
        short, long = low, high  # the longest length with a match: matches shrink with the length
        while short < long:
            middle = (short + long + 1) // 2
            short, long = (middle, long) if common(middle) else (short, middle - 1)
        hashes, left, right = at(short)
        places: dict[int, list[int]] = {}
        for j in right.tolist():
            places.setdefault(int(hashes[len(doc) + j]), []).append(j)
        for i in left[np.isin(hashes[left], hashes[len(doc) + right])].tolist():
            if not free[i : i + short].all():
                continue
            for j in places[int(hashes[i])]:
                if open_[j : j + short].all() and np.array_equal(doc[i : i + short], item[j : j + short]):
                    free[i : i + short] = open_[j : j + short] = False
                    out.append((i, j, short))
                    break
        high = short - 1
    return out


@dataclass
class Block:
    """Items of one block with their seeds."""

    ids: list[int]
    items: list[np.ndarray]

    def __post_init__(self) -> None:
        seeds, owners, places = [], [], []
        for k, words in enumerate(self.items):
            size = min(SEED, len(words))
            own = Windows(words).of(size) if size else np.zeros(0, np.uint64)
            own = _portable(words, size) if size else own
            seeds.append(own)
            owners.append(np.full(len(own), k))
            places.append(np.arange(len(own)))
        self.seeds = np.concatenate(seeds) if seeds else np.zeros(0, np.uint64)
        order = np.argsort(self.seeds, kind="stable")
        self.seeds = self.seeds[order]
        self.owners = np.concatenate(owners)[order] if seeds else order
        self.places = np.concatenate(places)[order] if seeds else order
        self.sizes = sorted({min(SEED, len(w)) for w in self.items if len(w)})
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[self.seeds & np.uint64((1 << 22) - 1)] = True

    def held(self, seeds: np.ndarray) -> np.ndarray:
        """Positions of the given seeds that are seeds of an item."""
        at = np.flatnonzero(self.maybe[seeds & np.uint64((1 << 22) - 1)])
        return at[np.isin(seeds[at], self.seeds)]


def _portable(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words that does not depend on where it stands."""
    total = np.zeros(max(len(words) - size + 1, 0), np.uint64)
    for k in range(size):
        total += words[k : len(words) - size + 1 + k] * np.uint64(pow(int(_BASE), 2 * k + 1, 1 << 64))
    return mix(total + np.uint64(size))


def leaks(texts: list[bytes], block: Block, coverage: float = COVERAGE) -> list[list[tuple]]:
    """Per text, the items it covers: (item, covered words, words of the item, tiles)."""
    words, first = plain_words(texts)
    found: list[dict[int, list]] = [{} for _ in texts]
    for size in block.sizes:
        seeds = _portable(words, size)
        if not len(seeds):
            continue
        at = block.held(seeds)
        text = np.searchsorted(first, at, "right") - 1
        inside = at + size <= first[text + 1]
        for i, t in zip(at[inside].tolist(), text[inside].tolist(), strict=True):
            found[t].setdefault(size, []).append(i)
    out = []
    for t, hits in enumerate(found):
        doc = words[first[t] : first[t + 1]]
        out.append(_covered(doc, {s: np.array(i) - first[t] for s, i in hits.items()}, words, first[t], block, coverage))
    return out


def _covered(doc, hits, words, base, block: Block, coverage: float) -> list[tuple]:
    found = []
    for size, at in hits.items():
        seeds = _portable_at(words, base + at, size)
        lo = np.searchsorted(block.seeds, seeds, "left")
        hi = np.searchsorted(block.seeds, seeds, "right")
        # the items of each different seed, once
        _, once = np.unique(seeds, return_index=True)
        span = np.concatenate([np.arange(lo[k], hi[k]) for k in once])
        owner, place = block.owners[span], block.places[span]
        for k in np.unique(owner).tolist():
            item = block.items[k]
            if min(SEED, len(item)) != size:
                continue
            bound = np.zeros(len(item) + 1, np.int64)
            np.add.at(bound, place[owner == k], 1)
            np.add.at(bound, place[owner == k] + size, -1)
            if (np.cumsum(bound)[:-1] > 0).sum() < coverage * len(item):
                continue  # tiles lie within the seeds, so they cannot cover more
            own = np.isin(seeds, block.seeds[span[owner == k]])
            free = np.zeros(len(doc) + 1, np.int64)
            np.add.at(free, at[own], 1)
            np.add.at(free, at[own] + size, -1)
            free = np.cumsum(free)[:-1] > 0
            start, end = int(at[own].min()), int(at[own].max()) + size
            laid = tiles(doc[start:end], item, size, free[start:end])
            total = sum(n for _, _, n in laid)
            if total >= coverage * len(item):
                found.append((k, total, len(item), [(start + i, j, n) for i, j, n in laid]))
    return found


def _portable_at(words: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    total = np.zeros(len(at), np.uint64)
    for k in range(size):
        total += words[at + k] * np.uint64(pow(int(_BASE), 2 * k + 1, 1 << 64))
    return mix(total + np.uint64(size))


def blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[Block]:
    """The benchmark in blocks of about ``block_words`` words, one at a time.

    Items without id, text or words are left out.
    """
    items = benchmark.select(F.col("item_id").cast("long"), "text").where(
        "item_id is not null and text is not null"
    )
    # a word takes a byte and a break at least
    total = items.agg(F.sum(F.octet_length("text") / 2)).first()[0] or 0
    parts = max(1, int(np.ceil(total / block_words)))
    dealt = items.withColumn("part", F.pmod(F.xxhash64("item_id"), F.lit(parts)))
    for part in range(parts):
        rows = dealt.where(F.col("part") == part).drop("part").collect()
        words, first = plain_words([r.text.encode() for r in rows])
        kept = [k for k in range(len(rows)) if first[k + 1] > first[k]]
        yield Block([rows[k].item_id for k in kept], [words[first[k] : first[k + 1]] for k in kept])


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """A row per document and item that it covers.

    Columns: doc_id, item_id, covered and item_words (numbers of words), coverage, tiles (start in the
    document's words, start in the item's words, number of words). A null, empty or clean text has no row;
    repeated documents have a row each. An empty benchmark gives no rows.
    """
    kind = pa.list_(
        pa.struct([("doc_word", pa.int64()), ("item_word", pa.int64()), ("words", pa.int64())])
    )
    source = docs.select(F.col("doc_id").cast("long"), "text")

    def over(block: Block) -> DataFrame:
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = batch.column("doc_id").to_pylist()
            rows = [
                (ids[t], block.ids[k], total, n, total / n, laid)
                for t, found in enumerate(leaks(as_bytes(batch.column("text")), block, coverage))
                for k, total, n, laid in found
            ]
            names = ["doc_id", "item_id", "covered", "item_words", "coverage", "tiles"]
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            kinds = [pa.int64()] * 4 + [pa.float64(), kind]
            laid = [
                [dict(zip(("doc_word", "item_word", "words"), x, strict=True)) for x in one]
                for one in columns[5]
            ]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip([*columns[:5], laid], kinds, strict=True)], names
            )

        return map_slices(
            source,
            run,
            "doc_id long, item_id long, covered long, item_words long, coverage double, "
            "tiles array<struct<doc_word: long, item_word: long, words: long>>",
        )

    parts = [over(block) for block in blocks(benchmark)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of the documents, all columns, that cover no item."""
    for block in blocks(benchmark):

        def run(batches: Iterator[pa.RecordBatch], block: Block = block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in slices(batch):
                    found = leaks(as_bytes(piece.column("text")), block, coverage)
                    yield piece.filter(pa.array([not f for f in found], pa.bool_()))

        docs = map_batches(docs, run, docs.schema)
    return docs
