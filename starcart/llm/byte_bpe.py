"""Byte-level BPE: texts to token ids and back.

A text is split by a pattern; each match is encoded for itself by the ``tokenizers`` library,
whose model sees every byte as one printable character. Since the vocabulary comes as ranks, a
merge is any pair of tokens that together are a token, in the order of that token's rank.
The rank file's own rule merges the leftmost of several pairs that give the same token. The library
merges the pair listed first, so pairs of one token are listed such that overlapping ones
come out leftmost first. Of a few tokens, such as ``...``, no order does that for all
texts; matches that contain one of these are merged by ``merged`` below.

Tokens are whole bytes but not whole characters: a character may be split over tokens. Decoding
joins the tokens' bytes before it reads characters.
"""

from __future__ import annotations

import base64
import heapq
import os
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starcart.llm.words import give_back, map_batches, slices

_CACHED = 20_000  # pieces in a generation of a worker's cache, of at most _PIECE characters
_PIECE = 48

# The characters that \s stands for in the pattern's own dialect.
WHITE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


@lru_cache
def _ranges(category: str, most: int) -> str:
    """The characters of a category, up to a highest one, as ranges for a character class."""
    every = "".join(map(chr, chain(range(0xD800), range(0xE000, most + 1))))
    runs = regex.finditer(rf"\p{{{category}}}+", every)
    return "".join(f"{re.escape(r[0][0])}-{re.escape(r[0][-1])}" for r in runs)


def pattern_of(text: str, most: int = 0x10FFFF) -> re.Pattern:
    r"""The splitting pattern with \s, \S, \p{L} and \p{N} as plain character classes.

    With ``most`` 0xFFFF it is for texts without higher characters, and faster.
    """
    classes = {r"\s": WHITE, r"\p{L}": _ranges("L", most), r"\p{N}": _ranges("N", most)}
    out = []
    for part in re.split(r"(\[[^\]]*\])", text.replace(r"\S", r"[^\s]")):
        bracketed = part.startswith("[")
        for name, members in classes.items():
            part = part.replace(name, members if bracketed else f"[{members}]")
        out.append(part)
    return re.compile("".join(out))


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where it is printable, else from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merges the pair of lowest rank, the leftmost of equals, until no pair is a token."""
    n = len(piece)
    end = list(range(1, n + 1))  # of the token that starts here
    before = list(range(-1, n - 1))  # start of the token before
    alive = [True] * n
    heap: list[tuple[int, int, int, int]] = []

    def offer(i: int) -> None:
        j = end[i]
        if j < n:
            rank = ranks.get(piece[i : end[j]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, j, end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, j, k = heapq.heappop(heap)
        if not alive[i] or end[i] != j or end[j] != k:
            continue
        end[i], alive[j] = k, False
        if k < n:
            before[k] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


def _ordered_splits(token: bytes, ranks: dict[bytes, int]) -> tuple[list[int], bool]:
    """Where the token can be parted, in an order that keeps overlapping merges leftmost.

    In p q r with p + q = q + r = token the split after p has to come before the split
    after q. The flag tells that these demands contradict each other.
    """
    splits = [i for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
    after: dict[int, set[int]] = {i: set() for i in splits}
    for i in splits:
        q = len(token) - i
        if q != i and q in after and token.startswith(token[i:]):
            after[q].add(i)
    out: list[int] = []
    while after:
        ready = [i for i, needs in after.items() if not needs]
        if not ready:
            return out + sorted(after), True
        for i in ready:
            out.append(i)
            del after[i]
        for needs in after.values():
            needs.difference_update(ready)
    return out, False


class _Known(dict):
    """Token ids of pieces met so far, packed, in two generations: what is not met again is forgotten.

    Long pieces, which hardly come again, are not kept.
    """

    def __init__(self, encode_piece: Callable[[str], list[int]]) -> None:
        self.encode_piece = encode_piece
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece) or array("i", self.encode_piece(piece)).tobytes()
        if len(piece) <= _PIECE:
            self[piece] = ids
        return ids

    def age(self) -> None:
        if len(self) > _CACHED:
            self.older = dict(self)
            self.clear()


class Decoder:
    """The tokens of a rank file; ids may have gaps."""

    def __init__(self, rank_file: bytes) -> None:
        pairs = (line.split() for line in rank_file.splitlines() if line)
        self.tokens = {int(rank): base64.b64decode(token) for token, rank in pairs}
        listed = [self.tokens.get(i) for i in range(max(self.tokens) + 1)]
        self.lengths = np.array([-1 if t is None else len(t) for t in listed])
        self.starts = np.cumsum(np.maximum(self.lengths, 0)) - np.maximum(self.lengths, 0)
        self.data = np.frombuffer(b"".join(t or b"" for t in listed), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids; an unknown id is an error."""
        ids = np.asarray(ids, np.int64)
        if not len(ids):
            return b""
        known = ids.min() >= 0 and ids.max() < len(self.lengths)
        lengths = self.lengths[ids] if known else ids - ids - 1
        if lengths.min() < 0:
            raise ValueError("an id is not in the vocabulary")
        ends = np.cumsum(lengths)
        return self.data[np.arange(ends[-1]) + np.repeat(self.starts[ids] - ends + lengths, lengths)].tobytes()


class Codec(Decoder):
    """Encoder and decoder for one rank file and pattern."""

    def __init__(self, rank_file: bytes, pattern: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        from tokenizers import models

        super().__init__(rank_file)
        self.ranks = {token: rank for rank, token in self.tokens.items()}
        self.pattern, self.short = pattern_of(pattern), pattern_of(pattern, 0xFFFF)
        characters = byte_characters()
        name = {t: "".join([characters[b] for b in t]) for t in self.ranks}
        merges, circular = [], []
        for _, token in sorted(self.tokens.items()):
            splits, contradiction = _ordered_splits(token, self.ranks)
            merges += [(name[token[:i]], name[token[i:]]) for i in splits]
            if contradiction:
                circular.append(token.decode("utf-8", "surrogateescape"))
        self.model = models.BPE({name[t]: r for t, r in self.ranks.items()}, merges, ignore_merges=True)
        self.characters = {b: c for b, c in enumerate(characters)}
        self.circular = regex.compile("|".join(map(regex.escape, circular)) or "(?!)")
        self.known = _Known(self.encode_piece)

    def split(self, text: str) -> list[str]:
        """The matches of the pattern."""
        low = len(text.encode("utf-16-le")) == 2 * len(text)
        return (self.short if low else self.pattern).findall(text)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids per text, special tokens never."""
        out = []
        for text in texts:
            self.known.age()
            pieces = self.split(text)
            if len(pieces) > 1:
                packed = b"".join(itemgetter(*pieces)(self.known))
            else:
                packed = b"".join([self.known[piece] for piece in pieces])
            out.append(np.frombuffer(packed, np.int32))
        return out

    def encode_piece(self, piece: str) -> list[int]:
        """Token ids of one match of the pattern."""
        raw = piece.encode()
        if self.circular.search(piece):
            return [self.ranks[raw]] if raw in self.ranks else merged(raw, self.ranks)
        shown = raw.decode("latin-1").translate(self.characters)
        return [token.id for token in self.model.tokenize(shown)]


def char_spans(raw: bytes, starts: np.ndarray) -> list[tuple[int, int]]:
    """Characters that each token touches, [first, end); a split character belongs to each part."""
    if not len(starts):
        return []
    data = np.frombuffer(raw, np.uint8)
    begun = np.cumsum((data & 0xC0) != 0x80)  # characters begun up to and with this byte
    ends = np.append(starts[1:], len(data))
    return list(zip((begun[starts] - 1).tolist(), begun[ends - 1].tolist(), strict=True))


def encoded(docs: DataFrame, rank_file: bytes, pattern: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns with ``ids`` and ``starts``, the first byte of each token.

    A null text counts as empty; an empty text has no ids. Rows are encoded one by one.
    ``rank_file`` is the content of the vocabulary file, which goes to the tasks with the function.
    """

    def piece(batch: pa.RecordBatch, own: Codec) -> pa.RecordBatch:
        ids = own.encode([t or "" for t in batch.column("text").to_pylist()])
        sizes = np.fromiter((len(i) for i in ids), np.int32, len(ids))
        flat = np.concatenate(ids)
        lengths = own.lengths[flat]
        ends = np.cumsum(lengths)
        at = np.zeros(len(ids) + 1, np.int32)
        np.cumsum(sizes, out=at[1:])
        base = np.append(0, ends)[at[:-1]]
        starts = (ends - lengths - np.repeat(base, sizes)).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(at), pa.array(x)) for x in (flat, starts)]
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in keep), *lists], [*keep, "ids", "starts"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Codec(rank_file, pattern)  # for the task, half a second; not kept in idle workers
        give_back()  # the lists of merges, as large as the model
        for batch in batches:
            for part in slices(batch):
                yield piece(part, own)
        own.known.clear()

    source = docs.select(*{c: 0 for c in (*keep, "text")})
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return map_batches(source, run, f"{types}, ids array<int>, starts array<int>")


def decoded(df: DataFrame, rank_file: bytes) -> DataFrame:
    """The rows with ``decoded``, the bytes that their ``ids`` stand for; no or null ids give none."""

    def run(batches):
        own = Decoder(rank_file)
        for batch in batches:
            ids = batch.column("ids")
            values, at = ids.values.to_numpy(), ids.offsets.to_numpy()
            raw = [own.decode(values[a:b]) for a, b in zip(at, at[1:], strict=False)]
            yield batch.append_column("decoded", pa.array(raw, pa.binary()))

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return map_batches(df, run, f"{types}, decoded binary")


def digests(df: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Number of tokens and digests of ``ids`` and ``decoded``."""
    return df.select(
        *keep,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
