"""Probability of texts under a unigram model of subword pieces, over all segmentations.

Every word, with a blank before it, is a lattice: an edge is a vocabulary piece that fits there, and single
bytes always fit. A word's probability is the sum over all paths of the product of the pieces' probabilities, by a
forward recursion in log space; a text's is the product over its words and one end.
The vocabulary and its scores exist. The scores rank the pieces; a Zipf law over the ranks gives the first
probabilities, and one round of expected counts over all training rows gives the final ones.

Work goes by blocks of a few megabytes of text. A block keeps each of its different words
once, with postings per document. Word counts of the corpus are a plain grouped sum over (block,
word) rows; lattices are summed once per different word of the corpus, and counts and probabilities
come back to the blocks by a join. No word, however common, has more rows than there are blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starcart.llm.words import Stretches, Words, as_bytes, map_batches, slices, stored

SMOOTHING = 0.1  # added to each piece's expected count
ZIPF = 100
_UNIT = 1 << 16  # expected counts are summed as integers, so that sums do not depend on the order
_MAYBE = 1 << 21

BLOCK_BYTES = 6_000_000

_PACKED = (
    "block long, doc_ids binary, no_id binary, held binary, sizes binary, words binary, lengths binary, "
    "counts binary, posted binary, times binary, first binary"
)
#: Types of the packed arrays.
_KINDS = {
    "doc_ids": "<i8", "no_id": "?", "held": "?", "sizes": "<i4", "words": "u1", "lengths": "<i4",
    "counts": "<i4", "posted": "<i4", "times": "<i4", "first": "<i4",
}


@dataclass(frozen=True)
class Vocabulary:
    """Pieces as bytes with a blank for the word start, and log probabilities; the last is the end's."""

    pieces: tuple[bytes, ...]
    logp: np.ndarray


def first_vocabulary(model_file: bytes) -> Vocabulary:
    """The pieces of a sentencepiece model; pieces of the same bytes are one."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=model_file)
    weights: dict[bytes, float] = {bytes([b]): 0.0 for b in range(256)}
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            continue
        if model.is_byte(i):
            piece, weight = bytes([int(model.id_to_piece(i)[3:5], 16)]), 1e-6
        else:
            piece = model.id_to_piece(i).replace("▁", " ").encode()
            weight = 1 / (ZIPF - model.get_score(i))
        if b" " not in piece[1:]:
            weights[piece] = weights.get(piece, 0.0) + weight
    pieces = tuple(sorted(weights))
    p = np.array([max(weights[x], 1e-6) for x in pieces])
    logp = np.log(np.append(p / p.sum(), 1.0) / 2)
    return Vocabulary(pieces, logp)


class Lattice:
    """Edges and sums over the segmentations of many words."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        data = np.frombuffer(b"".join(vocabulary.pieces), np.uint8)
        lengths = np.array([len(x) for x in vocabulary.pieces])
        ends = np.cumsum(lengths)
        hashes = Stretches(data).hash(ends - lengths, ends)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.lengths = np.unique(lengths)
        self.logp = vocabulary.logp
        self.maybe = np.zeros(_MAYBE, bool)
        self.maybe[hashes & np.uint64(_MAYBE - 1)] = True

    def edges(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """(word, from, to, piece) of all pieces in the words ``data[starts:ends]``; places in the word."""
        stretches = Stretches(data)
        sizes = ends - starts
        word = np.repeat(np.arange(len(starts)), sizes)
        place = np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        at = np.repeat(starts, sizes) + place
        rest = np.repeat(sizes, sizes) - place
        out = []
        for length in self.lengths:
            fits = np.flatnonzero(rest >= length)
            if not len(fits):
                break
            hashes = stretches.hash(at[fits], at[fits] + length)
            fits, hashes = (x[self.maybe[hashes & np.uint64(_MAYBE - 1)]] for x in (fits, hashes))
            found = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            hit = self.hashes[found] == hashes
            fits = fits[hit]
            out.append((word[fits], place[fits], place[fits] + length, self.order[found[hit]]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    @staticmethod
    def _sums(word, source, target, weight, total: np.ndarray, flat: np.ndarray, last: int) -> None:
        """For each place in turn, log of the sum over the edges into it."""
        order = np.lexsort((word, target))
        word, source, target, weight = word[order], source[order], target[order], weight[order]
        cuts = np.searchsorted(target, np.arange(1, last + 2))
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if lo == hi:
                continue
            own = word[lo:hi]
            terms = total[flat[own] + source[lo:hi]] + weight[lo:hi]
            runs = np.flatnonzero(np.diff(own, prepend=-1))
            most = np.maximum.reduceat(terms, runs)
            lengths = np.diff(np.append(runs, len(own)))
            sums = np.add.reduceat(np.exp(terms - np.repeat(most, lengths)), runs)
            total[flat[own[runs]] + target[lo]] = most + np.log(sums)

    def logs(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Natural log of the probability of each word."""
        return self._forward(data, starts, ends)[0]

    def _forward(self, data, starts, ends):
        sizes = ends - starts
        if not len(sizes):
            return np.zeros(0), None, None, None
        edges = self.edges(data, starts, ends)
        word, source, target, piece = edges
        flat = np.cumsum(sizes + 1) - (sizes + 1)
        total = np.full(int((sizes + 1).sum()), -np.inf)
        total[flat] = 0.0
        self._sums(word, source, target, self.logp[piece], total, flat, int(sizes.max()))
        return total[flat + sizes], edges, flat, total

    def expected(self, data, starts, ends, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in the words, each weighted by its count."""
        out = np.zeros(len(self.logp) - 1)
        whole, edges, flat, ahead = self._forward(data, starts, ends)
        if edges is None:
            return out
        word, source, target, piece = edges
        sizes = ends - starts
        behind = np.full(len(ahead), -np.inf)
        behind[flat] = 0.0
        # the same recursion from the end: places counted backwards
        weight = self.logp[piece]
        self._sums(word, sizes[word] - target, sizes[word] - source, weight, behind, flat, int(sizes.max()))
        path = ahead[flat[word] + source] + weight + behind[flat[word] + sizes[word] - target]
        return np.bincount(
            piece, np.exp(path - whole[word]) * counts[word], minlength=len(out)
        )


def _packed_block(batch: pa.RecordBatch, block: int) -> dict:
    """A block's different words with training counts, and per document what words it has how often.

    ``posted[first[i]:first[i + 1]]`` are the words of document i, as distances, ``times`` how often each.
    """
    words = Words(as_bytes(batch.column("text")))
    per_doc = words.counts()
    held = batch.column("held").to_numpy(zero_copy_only=False).astype(bool)
    unique, one, inverse = np.unique(words.hashes(), return_index=True, return_inverse=True)
    starts, ends = words.starts[one], words.ends[one]
    doc = np.repeat(np.arange(batch.num_rows), per_doc)
    pairs, times = np.unique(doc * max(len(unique), 1) + inverse, return_counts=True)
    pair_doc, posted = np.divmod(pairs, max(len(unique), 1))
    counts = np.bincount(posted, times * ~held[pair_doc], minlength=len(unique))
    sizes = ends - starts
    at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    ids = batch.column("doc_id").to_pylist()
    row = {
        "doc_ids": [0 if i is None else i for i in ids],
        "no_id": [i is None for i in ids],
        "held": held,
        "sizes": per_doc,
        "words": words.data[np.repeat(starts, sizes) + at],
        "lengths": sizes,
        "counts": counts,
        "posted": np.diff(posted, prepend=0),
        "times": times,
        "first": np.searchsorted(pair_doc, np.arange(batch.num_rows + 1)),
    }
    return {"block": block, **{c: np.asarray(v).astype(_KINDS[c]).tobytes() for c, v in row.items()}}


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[f.name] for r in rows], f.type) for f in schema], schema=schema
    )


def _blocks(docs: DataFrame) -> DataFrame:
    names = [c.split()[0] for c in _PACKED.split(", ")]
    schema = pa.schema([(n, pa.int64() if n == "block" else pa.binary()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece in slices(batch, size=BLOCK_BYTES):
                yield _batch([_packed_block(piece, (task << 32) + number)], schema)
                number += 1

    return map_batches(docs, run, _PACKED, BLOCK_BYTES)


def _word_rows(packed: DataFrame) -> DataFrame:
    """``block, place, word, n``: a row per different word of a block, n times in its training rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data, lengths, counts = (
                    np.frombuffer(batch.column(c)[i].as_py(), _KINDS[c]) for c in ("words", "lengths", "counts")
                )
                ends = np.append(0, np.cumsum(lengths)).astype(np.int32)
                n = len(lengths)
                words = pa.BinaryArray.from_buffers(
                    pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(data.tobytes())]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, batch.column("block")[i].as_py())),
                        pa.array(np.arange(n, dtype=np.int32)),
                        words,
                        pa.array(counts.astype(np.int64)),
                    ],
                    ["block", "place", "word", "n"],
                )

    source = packed.select("block", "words", "lengths", "counts")
    return map_batches(source, run, "block long, place int, word binary, n long")


def _lattice_input(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words with a blank before each, in one buffer, and where they begin and end."""
    listed = words.to_pylist()
    data = np.frombuffer(b" " + b" ".join(listed), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in listed])
    return data, np.append(0, ends[:-1]), ends


def _expected(known: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """Expected uses of the pieces in all training words, under the given probabilities."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, total = Lattice(vocabulary), np.zeros(len(vocabulary.pieces))
        for batch in batches:
            for piece in slices(batch, "word"):
                total += lattice.expected(*_lattice_input(piece.column("word")), piece.column("c").to_numpy())
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(np.rint(total[at] * _UNIT).astype(np.int64))],
            ["piece", "n"],
        )

    uses = map_batches(known.where("c > 0").select("word", "c"), run, "piece int, n long")
    out = np.full(len(vocabulary.pieces), SMOOTHING)
    for row in uses.groupBy("piece").agg(F.sum("n").alias("n")).collect():  # one row per piece
        out[row.piece] += row.n / _UNIT
    return out


def _with_logs(known: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``word, c, logp``: each word's natural log of its probability."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(vocabulary)
        for batch in batches:
            for piece in slices(batch, "word"):
                logs = lattice.logs(*_lattice_input(piece.column("word")))
                yield piece.append_column("logp", pa.array(logs, pa.float64()))

    return map_batches(known, run, "word binary, c long, logp double")


def lattice_scores(docs: DataFrame, held: F.Column, model_file: bytes) -> DataFrame:
    """A row per document, scored by the model learnt from the rows that are not ``held``.

    doc_id, held_out, n_tokens (words and one end), n_known (those seen in training), train_tokens, base_score
    (log10 of the add-one word model) and score (log10 of the lattice model). A null or empty text is one end. A
    row without doc_id counts as not held. Without training rows all counts are zero. Equal rows score alike.
    """
    vocabulary = first_vocabulary(model_file)
    source = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(held, F.lit(False)).alias("held"), "text"
    )
    packed = stored(_blocks(source), "blocks")
    asked = _word_rows(packed)
    known = stored(asked.groupBy("word").agg(F.sum("n").alias("c")), "known")
    ends = docs.where(~F.coalesce(held, F.lit(False))).count()
    distinct, tokens = known.agg(F.count_if(F.col("c") > 0), F.coalesce(F.sum("c"), F.lit(0))).first()
    distinct, tokens = distinct + (ends > 0), tokens + ends
    uses = np.append(_expected(known, vocabulary), ends + SMOOTHING)
    learnt = Vocabulary(vocabulary.pieces, np.log(uses / uses.sum()))
    answers = asked.drop("n").join(_with_logs(known, learnt), "word").select("block", "place", "c", "logp")
    end_log, ends = float(learnt.logp[-1]), int(ends)

    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        row = {c: np.frombuffer(left.column(c)[0].as_py(), _KINDS[c]) for c in left.column_names if c != "block"}
        size = right.num_rows
        count, logs = np.zeros(size, np.int64), np.zeros(size)
        place = right.column("place").to_numpy()
        count[place], logs[place] = right.column("c").to_numpy(), right.column("logp").to_numpy()
        first, times, posted = row["first"], row["times"], np.cumsum(row["posted"])
        n = row["sizes"].astype(np.int64) + 1
        seen = _summed(times * (count[posted] > 0), first) + (ends > 0)
        base = _summed(times * np.log10(count[posted] + 1.0), first)
        base += np.log10(ends + 1.0) - n * np.log10(tokens + distinct + 1.0)
        model = (_summed(times * logs[posted], first) + end_log) / np.log(10)
        values = [
            pa.array(row["doc_ids"], mask=row["no_id"]),
            pa.array(row["held"]),
            pa.array(n),
            pa.array(seen.astype(np.int64)),
            pa.array(np.full(len(n), tokens, np.int64)),
            pa.array(base),
            pa.array(model),
        ]
        return pa.table(values, names)

    return (
        packed.drop("words", "lengths", "counts")
        .groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(
            score,
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
            "base_score double, score double",
        )
    )


def _summed(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of each stretch by itself, so that other documents leave no rounding in it."""
    out = np.zeros(len(first) - 1)
    full = np.flatnonzero(np.diff(first) > 0)
    if len(full):
        out[full] = np.add.reduceat(values, first[:-1][full])
    return out
