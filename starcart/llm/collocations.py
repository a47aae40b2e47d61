"""Phrases whose words keep together, mined with exact counts in counting quotient filters.

Texts fall into pieces at ``.,;:!?`` and line ends, and pieces into words at blanks and tabs; A-Z are lowered. Each
language is counted by itself; a null one is ``und``. Work goes by blocks of one language's text, which are
stored once, as codes into a list of the block's different words.

1. Words: the lists of all blocks meet by shard of the word's hash. Frequent words get numbers, which
   go back to the blocks that asked. All others end a run, as a phrase cannot be more frequent than its words.
2. Pairs of numbers are counted per block in a quotient filter. The sorted filters of all blocks are merged by shard,
   and the frequent pairs go back to the blocks that have them.
3. Runs of three and four words whose pairs are all frequent are counted the same way.
4. Only frequent phrases are rows: joins find the counts of their parts, and of the longer phrases they are in.

Nothing is as long as the corpus in one place: a shard has a share of the keys, and a word or a pair, however
common, is one counter per block. Null and empty texts have no words; a row is a document, repeated or not; other
columns are left out; an empty table has no phrases.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starcart.functions.hot import hot_keys, split_join
from starcart.llm import quotient_filter as qf
from starcart.llm.words import IS_SPACE, Words, map_batches, slices, spans, stored, string_hashes

LEAST = 30
TOP = 2000
BLOCK_BYTES = 16_000_000  # text of all languages that a task holds before it gives out blocks
_WINDOW_BYTES = 2_000_000

_PIECE_ENDS = np.zeros(256, bool)
_PIECE_ENDS[list(b".,;:!?\n\v\f\r")] = True
_WORD_ENDS = IS_SPACE | _PIECE_ENDS

_BLOCK = "block long, lang string, n long, codes binary, ends binary, words binary, counts binary"
_LIST = "shard int, block long, lang string, words binary, counts binary, codes binary"
_NUMBERED = "block long, lang string, word string, id long, f long, codes binary, ids binary"
_RUNS = "block long, lang string, ids binary"
_FILTER = "lang string, shard int, block long, filter binary"
_PHRASES = "lang string, words array<long>, f long, block long, pairs binary"


def planes(numbers: np.ndarray) -> bytes:
    """32-bit numbers, all first bytes before all second bytes, as these compress well."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)


def windows(text: bytes, size: int = _WINDOW_BYTES) -> Iterator[bytes]:
    """The text in stretches of about ``size`` bytes that cut no word."""
    at = 0
    while at < len(text):
        end = min(at + size, len(text))
        while end < len(text):
            ahead = np.flatnonzero(_WORD_ENDS[np.frombuffer(text, np.uint8, min(size, len(text) - end), end)])
            if len(ahead):
                end += int(ahead[0])
                break
            end = min(end + size, len(text))
        yield text[at:end]
        at = end


class _Stream:
    """Words of one language, one after another."""

    def __init__(self) -> None:
        self.words: list[pa.Array] = []
        self.ends: list[np.ndarray] = []  # whether a piece ends before the word
        self.ended = True
        self.size = 0

    def add(self, text: bytes) -> None:
        for window in windows(text):
            found = Words([window], breaks=_WORD_ENDS)
            ends = np.zeros(len(window) + 1, np.int64)
            np.cumsum(_PIECE_ENDS[found.data[: len(window)]], out=ends[1:])
            if len(found.starts):
                before = np.append(0, ends[found.ends[:-1]])
                ended = ends[found.starts] > before
                ended[0] |= self.ended
                self.ended = bool(ends[-1] > ends[found.ends[-1]])
                data = found.data[~_WORD_ENDS[found.data]]
                offsets = np.zeros(len(found.starts) + 1, np.int32)
                np.cumsum(found.ends - found.starts, out=offsets[1:])
                buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())]
                self.words.append(pa.Array.from_buffers(pa.binary(), len(offsets) - 1, buffers))
                self.ends.append(ended)
            else:
                self.ended = self.ended or bool(ends[-1])
            self.size += len(window)

    def block(self) -> tuple | None:
        """``n, codes, ends, words, counts``; codes count from the commonest word."""
        if not self.words:
            return None
        coded = pa.chunked_array(self.words).combine_chunks().dictionary_encode()
        codes = coded.indices.to_numpy()
        counts = np.bincount(codes, minlength=len(coded.dictionary))
        order = np.argsort(-counts, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        words = coded.dictionary.take(pa.array(order)).to_pylist()
        ends = np.packbits(np.concatenate(self.ends)).tobytes()
        return len(codes), planes(place[codes]), ends, b" ".join(words), counts[order].astype("<i4").tobytes()


def blocks(documents: DataFrame) -> DataFrame:
    """The texts as blocks of word codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        streams: dict[str, _Stream] = {}

        def flush() -> pa.RecordBatch:
            nonlocal block
            rows = []
            for lang in list(streams):
                found = streams.pop(lang).block()
                if found:
                    rows.append((block, lang, *found))
                    block += 1
            kinds = [pa.int64(), pa.string(), pa.int64(), *[pa.binary()] * 4]
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            names = ["block", "lang", "n", "codes", "ends", "words", "counts"]
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            for piece in slices(batch):
                langs = piece.column("lang").to_pylist()
                texts: dict[str, list[bytes]] = {}
                for lang, text in zip(langs, piece.column("text").cast(pa.binary()).to_pylist(), strict=True):
                    if text:
                        texts.setdefault("und" if lang is None else lang, []).append(text)
                for lang, own in texts.items():
                    streams.setdefault(lang, _Stream()).add(b"\n".join(own) + b"\n")
                if sum(s.size for s in streams.values()) >= BLOCK_BYTES:
                    yield flush()
        yield flush()

    return map_batches(documents.select("lang", "text"), run, _BLOCK)


def _lists(shards: int):
    """The words of a block by shard of their hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words = row["words"].split(b" ")
                counts = np.frombuffer(row["counts"], "<i4")
                shard = (string_hashes(pa.array(words, pa.binary())) % np.uint64(shards)).astype(np.int32)
                order = np.argsort(shard, kind="stable")
                first = np.flatnonzero(np.diff(shard[order], prepend=-1))
                cuts = spans(first, len(order))
                yield pa.record_batch(
                    [
                        pa.array(shard[order[first]], pa.int32()),
                        pa.array([row["block"]] * len(cuts), pa.int64()),
                        pa.array([row["lang"]] * len(cuts), pa.string()),
                        pa.array([b" ".join([words[i] for i in order[a:b].tolist()]) for a, b in cuts], pa.binary()),
                        pa.array([counts[order[a:b]].tobytes() for a, b in cuts], pa.binary()),
                        pa.array([order[a:b].astype("<u4").tobytes() for a, b in cuts], pa.binary()),
                    ],
                    ["shard", "block", "lang", "words", "counts", "codes"],
                )

    return run


def _numbered(shards: int, least: int):
    """Frequent words of a shard with a number each, and for every block its codes of them.

    The k-th word of shard s is number 1 + k * shards + s: numbers are different, and nearly without gaps.
    """

    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        lists = pc.split_pattern(pc.cast(table.column("words"), pa.string()), " ").combine_chunks()
        at = pc.list_parent_indices(lists)
        counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), "<i4").astype(np.int64)
        codes = np.frombuffer(b"".join(table.column("codes").to_pylist()), "<u4")
        langs = table.column("lang").combine_chunks().dictionary_encode()
        words = lists.flatten().dictionary_encode()
        size = max(len(words.dictionary), 1)
        lang_of = langs.indices.to_numpy()[at.to_numpy()].astype(np.int64)
        pair, place = np.unique(lang_of * size + words.indices.to_numpy(), return_inverse=True)
        total = np.zeros(len(pair), np.int64)
        np.add.at(total, place, counts)
        frequent = np.flatnonzero(total >= least)
        names = words.dictionary.take(pa.array(pair[frequent] % size))
        own = langs.dictionary.take(pa.array(pair[frequent] // size))
        ids = np.zeros(len(pair), np.int64)
        ids[frequent] = 1 + np.arange(len(frequent)) * shards + shard
        nothing = [None] * len(frequent)
        vocabulary = [nothing, own, names, ids[frequent], total[frequent], nothing, nothing]
        block = table.column("block").to_numpy()
        answers = []
        row = at.to_numpy()
        hit = np.flatnonzero(ids[place] > 0)
        for a, b in spans(np.flatnonzero(np.diff(row[hit], prepend=-1)), len(hit)):
            some = hit[a:b]
            answers.append((block[row[some[0]]], codes[some].tobytes(), ids[place[some]].astype("<u4").tobytes()))
        nothing = [None] * len(answers)
        asked, coded, given = zip(*answers, strict=True) if answers else ([], [], [])
        replies = [asked, nothing, nothing, nothing, nothing, coded, given]
        return pa.concat_tables(
            [
                pa.table([pa.array(c, t) for c, t in zip(x, _NUMBERED_KINDS, strict=True)], _NUMBERED_NAMES)
                for x in (vocabulary, replies)
            ]
        )

    return run


_NUMBERED_NAMES = ["block", "lang", "word", "id", "f", "codes", "ids"]
_NUMBERED_KINDS = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]


def _joined(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _runs(blocks_: pa.Table, answers: pa.Table) -> pa.Table:
    """A block's frequent words as numbers, in runs of two and more with a 0 after each."""
    out = []
    for row in blocks_.to_pylist():
        codes = from_planes(row["codes"]).astype(np.int64)
        ids = np.zeros(int(codes.max()) + 1, np.uint32)
        ids[_joined(answers.column("codes"), "<u4").astype(np.int64)] = _joined(answers.column("ids"), "<u4")
        words = ids[codes]
        ends = np.unpackbits(np.frombuffer(row["ends"], np.uint8), count=len(codes)).astype(bool)
        linked = (words[1:] > 0) & (words[:-1] > 0) & ~ends[1:]
        after, before = np.append(linked, False), np.append(False, linked)
        keep = np.flatnonzero(after | before)
        words, last = words[keep], ~after[keep]
        spread = np.zeros(len(words) + int(last.sum()), np.uint32)
        spread[np.arange(len(words)) + np.cumsum(last) - last] = words
        out.append({"block": row["block"], "lang": row["lang"], "ids": planes(spread)})
    return pa.Table.from_pylist(out, _RUNS_ARROW)


_RUNS_ARROW = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("ids", pa.binary())])


def _filters(lang: str, block: int, left: np.ndarray, right: np.ndarray, half: int, shard_bits: int) -> pa.RecordBatch:
    """The keys of one block counted, as a filter per shard."""
    counted = qf.added(*qf.permuted(left, right, half), np.ones(len(left), np.int64), half)
    filters = qf.packed(*counted, half, shard_bits)
    return pa.record_batch(
        [
            pa.array([lang] * len(filters), pa.string()),
            pa.array(list(filters), pa.int32()),
            pa.array([block] * len(filters), pa.int64()),
            pa.array(list(filters.values()), pa.binary()),
        ],
        ["lang", "shard", "block", "filter"],
    )


def _pair_filters(bits: int, shard_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = from_planes(row["ids"]).astype(np.uint64)
                both = np.flatnonzero((ids[1:] > 0) & (ids[:-1] > 0))
                yield _filters(row["lang"], row["block"], ids[both], ids[both + 1], bits, shard_bits)

    return run


def _phrase_rows(lang: str, words: list[np.ndarray], f: np.ndarray) -> pa.Table:
    """A row per phrase; a last word 0 is none."""
    stacked = np.stack(words, axis=1).astype(np.int64)
    flat = stacked[stacked > 0]
    offsets = np.zeros(len(stacked) + 1, np.int32)
    np.cumsum((stacked > 0).sum(axis=1), out=offsets[1:])
    n = len(f)
    nothing = [pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())]
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
    return pa.table([pa.array([lang] * n, pa.string()), lists, pa.array(f, pa.int64()), *nothing], _PHRASE_NAMES)


_PHRASE_NAMES = ["lang", "words", "f", "block", "pairs"]


def _frequent_pairs(bits: int, shard_bits: int, least: int):
    """Frequent pairs of a shard, and for every block those that it has."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        lang, shard = key[0].as_py(), key[1].as_py()
        filters = table.column("filter").to_pylist()
        left, right, f = qf.merged(shard, filters, bits, shard_bits)
        keep = f >= least
        left, right, f = left[keep], right[keep], f[keep]
        first, second = qf.restored(left, right, bits)
        known = left << np.uint64(32) | right
        plain = first << np.uint64(32) | second
        out = [_phrase_rows(lang, [first, second], f)]
        if len(known):
            blocks_, pairs = [], []
            for block, data in zip(table.column("block").to_pylist(), filters, strict=True):
                a, b, _ = qf.unpacked(shard, data, bits, shard_bits)
                asked = a << np.uint64(32) | b
                at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
                hit = at[known[at] == asked]
                if len(hit):
                    blocks_.append(block)
                    pairs.append(plain[hit].astype("<u8").tobytes())
            n = len(blocks_)
            columns = [
                pa.nulls(n, pa.string()),
                pa.nulls(n, pa.list_(pa.int64())),
                pa.nulls(n, pa.int64()),
                pa.array(blocks_, pa.int64()),
                pa.array(pairs, pa.binary()),
            ]
            out.append(pa.table(columns, _PHRASE_NAMES))
        return pa.concat_tables(out)

    return run


def _long_filters(bits: int, shard_bits: int):
    """Three and four words whose pairs are all frequent; the fourth of three is 0."""

    def run(runs: pa.Table, answers: pa.Table) -> pa.Table:
        known = np.sort(_joined(answers.column("pairs"), "<u8"))
        out = []
        for row in runs.to_pylist() if len(known) else []:
            ids = from_planes(row["ids"]).astype(np.uint64)
            if len(ids) < 3:
                continue
            pairs = ids[:-1] << np.uint64(32) | ids[1:]
            good = known[np.minimum(np.searchsorted(known, pairs), len(known) - 1)] == pairs
            three = np.flatnonzero(good[:-1] & good[1:])
            four = np.flatnonzero(good[:-2] & good[1:-1] & good[2:])
            at = np.concatenate([three, four])
            if not len(at):
                continue
            last = np.zeros(len(at), np.uint64)
            last[len(three) :] = ids[four + 3]
            shift = np.uint64(bits)
            left, right = ids[at] << shift | ids[at + 1], ids[at + 2] << shift | last
            out.append(pa.Table.from_batches([_filters(row["lang"], row["block"], left, right, 2 * bits, shard_bits)]))
        return pa.concat_tables(out) if out else pa.Table.from_pylist([], _FILTER_ARROW)

    return run


_FILTER_ARROW = pa.schema([("lang", pa.string()), ("shard", pa.int32()), ("block", pa.int64()), ("filter", pa.binary())])


def _frequent_long(bits: int, shard_bits: int, least: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[1].as_py()
        left, right, f = qf.merged(shard, table.column("filter").to_pylist(), 2 * bits, shard_bits)
        keep = f >= least
        left, right = qf.restored(left[keep], right[keep], 2 * bits)
        shift, mask = np.uint64(bits), np.uint64((1 << bits) - 1)
        words = [left >> shift, left & mask, right >> shift, right & mask]
        return _phrase_rows(key[0].as_py(), words, f[keep])

    return run


def _key(words: Column) -> Column:
    """Ids as one text to join by."""
    return F.concat_ws(" ", words.cast("array<string>"))


def phrase_counts(documents: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored tables: ``lang, n`` sums of words per block; ``lang, word, id, f``; ``lang, words, f``.

    The last are all phrases of one to four words, as ids, that occur ``least`` times or more.
    """
    spark = documents.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = stored(blocks(documents), "blocks")
    lists = map_batches(base.select("block", "lang", "words", "counts"), _lists(tasks), _LIST)
    numbered = stored(lists.groupBy("shard").applyInArrow(_numbered(tasks, least), _NUMBERED), "words")
    vocabulary = numbered.where("block is null").select("lang", "word", "id", "f")
    most = vocabulary.agg(F.max("id")).first()[0] or 1
    bits = int(most).bit_length()
    if bits > 32:
        raise ValueError("more than 2**32 frequent words")
    answers = numbered.where("block is not null").select("block", "codes", "ids")
    asked = base.select("block", "lang", "codes", "ends").groupBy("block")
    runs = stored(asked.cogroup(answers.groupBy("block")).applyInArrow(_runs, _RUNS), "runs")
    shard_bits = max(tasks - 1, 1).bit_length()
    pair_bits, long_bits = min(shard_bits, bits), min(shard_bits, 2 * bits)
    filters = map_batches(runs, _pair_filters(bits, pair_bits), _FILTER)
    merged = filters.groupBy("lang", "shard").applyInArrow(_frequent_pairs(bits, pair_bits, least), _PHRASES)
    pairs = stored(merged, "pairs")
    had = pairs.where("block is not null").select("block", "pairs")
    filters = runs.groupBy("block").cogroup(had.groupBy("block")).applyInArrow(_long_filters(bits, long_bits), _FILTER)
    long = filters.groupBy("lang", "shard").applyInArrow(_frequent_long(bits, long_bits, least), _PHRASES)
    phrases = (
        vocabulary.select("lang", F.array("id").alias("words"), "f")
        .unionByName(pairs.where("block is null").select("lang", "words", "f"))
        .unionByName(long.select("lang", "words", "f"))
    )
    return base.select("lang", "n"), vocabulary, stored(phrases, "phrases")


def _looked_up(df: DataFrame, key: str, table: DataFrame) -> DataFrame:
    """``df`` joined to a table with one row per key; a common key is dealt over tasks."""
    return split_join(df, table, key, hot_keys(df, key), "left").drop("_piece")


def scored(phrases: DataFrame) -> DataFrame:
    """Phrases of two and more words that no nearly as frequent longer one contains, with their worst cut."""
    size = F.size("words")
    several = phrases.where(size >= 2).withColumn("key", _key(F.col("words")))
    counts = phrases.select(_key(F.col("words")).alias("part"), "f")
    cuts = several.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    cuts = cuts.select(
        "lang", "key", "words", F.col("f").alias("a"), "k",
        _key(F.expr("slice(words, 1, k)")).alias("first"),
        _key(F.expr("slice(words, k + 1, size(words) - k)")).alias("rest"),
    )
    cuts = _looked_up(cuts, "first", counts.select(F.col("part").alias("first"), F.col("f").alias("l")))
    cuts = _looked_up(cuts, "rest", counts.select(F.col("part").alias("rest"), F.col("f").alias("r")))
    score = F.expr("cast(2000000 as decimal(38, 0)) * cast(a as decimal(20, 0)) div cast(l + r as decimal(20, 0))")
    worst = cuts.select("key", F.struct(score.alias("score"), "k", "lang", "words", "a", "l", "r").alias("cut"))
    worst = worst.groupBy("key").agg(F.min(F.struct("cut.score", "cut.k", "cut.lang", "cut.words", "cut.a", "cut.l", "cut.r")).alias("cut"))
    inside = F.expr(
        "flatten(transform(sequence(2, size(words) - 1), "
        "m -> transform(sequence(1, size(words) - m + 1), i -> slice(words, i, m))))"
    )
    longer = phrases.where(size >= 3).select(F.explode(inside).alias("part"), "f")
    longer = longer.groupBy(_key(F.col("part")).alias("key")).agg(F.max("f").alias("longer"))
    kept = worst.join(longer, "key", "left").where("longer is null or 100 * longer < 80 * cut.a")
    return kept.select("key", "cut.lang", "cut.words", "cut.score", "cut.a", "cut.l", "cut.r")


_SALTS = 256


def _best(df: DataFrame, top: int, partition: list[str]) -> DataFrame:
    """Rows that at most ``top - 1`` others precede, ties included."""
    order = Window.partitionBy(*partition).orderBy(F.desc("score"), F.desc("a"))
    return df.withColumn("_place", F.rank().over(order)).where(F.col("_place") <= top).drop("_place")


def collocations(documents: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of each language."""
    sizes, vocabulary, phrases = phrase_counts(documents, least)
    found = stored(scored(phrases), "scored")
    # ties at the limit stay until the phrases are spelt
    salt = F.pmod(F.xxhash64("key"), F.lit(_SALTS)).alias("salt")
    found = _best(found.select("*", salt), top, ["lang", "salt"]).drop("salt")
    found = _best(found, top, ["lang"])
    spelt = found.select("key", F.posexplode("words").alias("place", "id"))
    spelt = _looked_up(spelt, "id", vocabulary.select("id", "word"))
    spelt = spelt.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("x"))
    phrase = F.concat_ws(" ", F.transform("x", lambda x: x["word"])).alias("phrase")
    found = found.join(spelt.select("key", phrase), "key")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    found = found.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    sizes = sizes.groupBy("lang").agg(F.sum("n").alias("n"))
    return found.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE_SQL = rf"""
with pieces as (
    select row_number() over () as piece, lang, regexp_extract_all(part, '[^\x20\x09]+') as words
    from (
        select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) as part
        from documents
    )
),
sizes as (select lang, cast(sum(len(words)) as bigint) as n from pieces group by lang),
starts as (select lang, words, unnest(generate_series(1, len(words))) as i from pieces where len(words) > 0),
runs as (
    select lang, words[i:i + m - 1] as words from starts, (select unnest([1, 2, 3, 4]) as m)
    where i + m - 1 <= len(words)
),
phrases as (select lang, words, count(*) as f from runs group by lang, words having count(*) >= {LEAST}),
cuts as (
    select c.lang, c.words, c.f as a, k, x.f as l, y.f as r, (2000000::hugeint * c.f) // (x.f + y.f) as score
    from (select *, unnest(generate_series(1, len(words) - 1)) as k from phrases where len(words) > 1) c
    join phrases x on x.lang = c.lang and x.words = c.words[1:k]
    join phrases y on y.lang = c.lang and y.words = c.words[k + 1:]
),
worst as (select * from cuts qualify row_number() over (partition by lang, words order by score, k) = 1),
inside as (
    select lang, words[i:i + m - 1] as words, max(f) as longer
    from (
        select lang, words, f, m, unnest(generate_series(1, len(words) - m + 1)) as i
        from (select *, unnest(generate_series(2, len(words) - 1)) as m from phrases where len(words) > 2)
    ) group by 1, 2
),
kept as (
    select w.*, array_to_string(w.words, ' ') as phrase from worst w left join inside i using (lang, words)
    where longer is null or 100 * longer < 80 * a
),
ranked as (
    select *, row_number() over (partition by lang order by score desc, a desc, phrase) as "rank" from kept
)
select lang, "rank", phrase, a, l, r, n, cast(score as bigint) as score
from ranked join sizes using (lang) where "rank" <= {TOP}
"""
