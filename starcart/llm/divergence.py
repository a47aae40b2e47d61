"""How far the sources of a language differ in their terms.

A term is a run of letters A-Z, lowered, and of characters beyond ASCII. A language keeps the terms that are in at
least ``docs`` of its rows. Each source has a share p of every kept term, smoothed and in whole billionths; two
shares p and q differ by floor((p - q)² / (p + q)). Numbers are whole throughout, so results do not depend on the
order of rows.

1. Arrow's kernels split, lower, encode and count terms per task; partial counts leave a task in columns, by shard
   of the term's hash. A term, however common, is one count per task and source.
2. A shard adds them up and keeps the frequent terms: one columnar row per (language, shard), stored.
3. Totals per source come from these rows. Every shard gets those of its language and adds up the differences of
   all pairs of sources over its terms, and its ten strongest terms per source. A task gives out one row per source,
   with its sums for all others; no pair is a row before it is a sum over all terms.

Null texts, languages and sources are empty ones. A row is a document, repeated or not. An empty table has no
rows; a group without terms takes part with nothing but the smoothing. Shares are exact below 9e15 kept terms
per group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starcart.llm.words import map_batches, slices, spans, stored, string_hashes

DOCS = 10
TOP = 10
BILLION = 10**9

# Fixed value: what parts terms.
_BREAK = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
_HELD_ROWS = 500_000  # partial counts that a task merges before it gives them out
_CELLS = 1 << 20  # cells of a dense (source, term) matrix at a time

_PART = (
    "shard int, langs array<string>, sources array<string>, terms binary, "
    "group_at binary, term_at binary, n binary, docs binary"
)
_SHARD = (
    "lang string, shard int, terms array<string>, sources array<string>, totals array<bigint>, "
    "term_at binary, source_at binary, n binary"
)
_FOUND = "lang string, source string, sums binary, item string, value bigint"
_SUMS = "lang string, source string, sums array<bigint>"


def counted(batch: pa.RecordBatch) -> pa.Table:
    """``lang, source, term, n, docs`` of one batch; every group also has a row with an empty term."""
    lang, source, text = (pc.fill_null(batch.column(c), "") for c in ("lang", "source", "text"))
    lists = pc.split_pattern_regex(pc.ascii_lower(text), _BREAK)
    row, term = pc.list_parent_indices(lists), lists.flatten().dictionary_encode()
    rows = pa.table({"row": pc.cast(row, pa.int32()), "term": term.indices})
    rows = rows.group_by(["row", "term"]).aggregate([([], "count_all")])
    at = rows.column("row")
    groups = pa.table(
        {
            "lang": lang.dictionary_encode().indices.take(at),
            "source": source.dictionary_encode().indices.take(at),
            "term": rows.column("term"),
            "n": rows.column("count_all"),
        }
    )
    groups = groups.group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ([], "count_all")])
    found = pa.table(
        {
            "lang": lang.dictionary_encode().dictionary.take(groups.column("lang")),
            "source": source.dictionary_encode().dictionary.take(groups.column("source")),
            "term": term.dictionary.take(groups.column("term")),
            "n": groups.column("n_sum"),
            "docs": groups.column("count_all"),
        }
    )
    found = found.filter(pc.not_equal(found.column("term"), ""))
    marks = pa.table({"lang": lang, "source": source}).group_by(["lang", "source"]).aggregate([])
    nothing = pa.array(np.zeros(len(marks), np.int64))
    marks = marks.select(["lang", "source"]).append_column("term", pa.array([""] * len(marks), pa.string()))
    return pa.concat_tables([found, marks.append_column("n", nothing).append_column("docs", nothing)])


def _merged(tables: list[pa.Table]) -> pa.Table:
    keys = ["lang", "source", "term"]
    sums = pa.concat_tables(tables).group_by(keys).aggregate([("n", "sum"), ("docs", "sum")])
    return sums.select([*keys, "n_sum", "docs_sum"]).rename_columns([*keys, "n", "docs"])


def _longs(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().astype("<i8")


def _packed(table: pa.Table, shards: int) -> pa.RecordBatch:
    """A row of ``_PART`` per shard: its groups, its terms parted by zero bytes, and their counts in columns."""
    table = table.combine_chunks()
    term = table.column("term").cast(pa.binary()).combine_chunks().dictionary_encode()
    names = table.select(["lang", "source"]).group_by(["lang", "source"]).aggregate([])
    langs, sources = (names.column(c).to_pylist() for c in ("lang", "source"))
    place = {pair: i for i, pair in enumerate(zip(langs, sources, strict=True))}
    pairs = zip(table.column("lang").to_pylist(), table.column("source").to_pylist(), strict=True)
    group = np.fromiter((place[pair] for pair in pairs), np.int64, len(table))
    code = term.indices.to_numpy()
    shard = (string_hashes(term.dictionary) % np.uint64(shards)).astype(np.int32)[code]
    order = np.lexsort((group, code, shard))
    shard, group, code = shard[order], group[order], code[order]
    n, docs = _longs(table.column("n"))[order], _longs(table.column("docs"))[order]
    fresh = np.diff(code, prepend=-1) != 0  # all rows of a term are in one shard
    terms, at = term.dictionary.take(pa.array(code[fresh])).to_pylist(), np.cumsum(fresh) - 1
    rows = []
    for a, b in spans(np.flatnonzero(np.diff(shard, prepend=-1)), len(shard)):
        own, group_at = np.unique(group[a:b], return_inverse=True)
        rows.append(
            {
                "shard": int(shard[a]),
                "langs": [langs[i] for i in own],
                "sources": [sources[i] for i in own],
                "terms": b"\0".join(terms[at[a] : at[b - 1] + 1]),
                "group_at": group_at.astype("<i4").tobytes(),
                "term_at": (at[a:b] - at[a]).astype("<i4").tobytes(),
                "n": n[a:b].tobytes(),
                "docs": docs[a:b].tobytes(),
            }
        )
    return pa.RecordBatch.from_pylist(rows, _PART_ARROW)


_PART_ARROW = pa.schema(
    [
        ("shard", pa.int32()),
        ("langs", pa.list_(pa.string())),
        ("sources", pa.list_(pa.string())),
        ("terms", pa.binary()),
        *[(c, pa.binary()) for c in ("group_at", "term_at", "n", "docs")],
    ]
)


def _together(table: pa.Table, column: str, lists: pa.Array) -> pa.Array:
    """Places in the lists of the rows, as places in all lists one after another."""
    places = table.column(column).to_pylist()
    before = np.cumsum(pc.list_value_length(lists).to_numpy()) - pc.list_value_length(lists).to_numpy()
    sizes = np.array([len(p) // 4 for p in places])
    return pa.array(np.frombuffer(b"".join(places), "<i4") + np.repeat(before, sizes))


def _unpacked(table: pa.Table) -> pa.Table:
    """``lang, source, term, n, docs`` of the rows of ``_PART``."""
    terms = pc.split_pattern(pc.cast(table.column("terms"), pa.string()), "\0").combine_chunks()
    langs, sources = (table.column(c).combine_chunks() for c in ("langs", "sources"))
    group = _together(table, "group_at", langs)
    numbers = [pa.array(np.frombuffer(b"".join(table.column(c).to_pylist()), "<i8")) for c in ("n", "docs")]
    term = terms.flatten().take(_together(table, "term_at", terms))
    return pa.table(
        [langs.flatten().take(group), sources.flatten().take(group), term, *numbers],
        ["lang", "source", "term", "n", "docs"],
    )


def partial_counts(documents: DataFrame, shards: int) -> DataFrame:
    """Counts per task, packed by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        limit = _HELD_ROWS
        for batch in batches:
            for piece in slices(batch):
                held.append(counted(piece))
                if sum(map(len, held)) > limit:
                    held = [_merged(held)]
                    # merged counts stay as long as merging makes them few
                    if len(held[0]) > _HELD_ROWS // 2:
                        yield _packed(held.pop(), shards)
        if held:
            yield _packed(_merged(held), shards)

    texts = documents.select(*[F.col(c).cast("string").alias(c) for c in ("lang", "source", "text")])
    return map_batches(texts, run, _PART)


def _whole_shard(docs: int):
    """The counts of one shard added up, a row per language."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        rows = _merged([_unpacked(table)])
        spread = rows.group_by(["lang", "term"]).aggregate([("docs", "sum")])
        keep = pc.and_(pc.greater_equal(spread.column("docs_sum"), docs), pc.not_equal(spread.column("term"), ""))
        spread = spread.filter(keep).select(["lang", "term"])
        kept = rows.join(spread, ["lang", "term"], join_type="inner")
        out = []
        for lang in pc.unique(rows.column("lang")).to_pylist():
            own = kept.filter(pc.equal(kept.column("lang"), lang))
            every = pc.unique(rows.filter(pc.equal(rows.column("lang"), lang)).column("source"))
            sources = sorted(every.to_pylist(), key=str.encode)
            terms = sorted(pc.unique(own.column("term")).to_pylist(), key=str.encode)
            term_at = pc.index_in(own.column("term"), pa.array(terms, pa.string())).to_numpy()
            source_at = pc.index_in(own.column("source"), pa.array(sources, pa.string())).to_numpy()
            n = _longs(own.column("n"))
            totals = np.zeros(len(sources), np.int64)
            np.add.at(totals, source_at, n)
            out.append(
                {
                    "lang": lang,
                    "shard": key[0].as_py(),
                    "terms": terms,
                    "sources": sources,
                    "totals": totals.tolist(),
                    "term_at": term_at.astype("<i4").tobytes(),
                    "source_at": source_at.astype("<i4").tobytes(),
                    "n": n.tobytes(),
                }
            )
        return pa.Table.from_pylist(out, _SHARD_ARROW)

    return run


_SHARD_ARROW = pa.schema(
    [
        ("lang", pa.string()),
        ("shard", pa.int32()),
        ("terms", pa.list_(pa.string())),
        ("sources", pa.list_(pa.string())),
        ("totals", pa.list_(pa.int64())),
        ("term_at", pa.binary()),
        ("source_at", pa.binary()),
        ("n", pa.binary()),
    ]
)


def shares(counts: np.ndarray, total: np.ndarray | int, terms: int) -> np.ndarray:
    """1 + floor(10**9 * (count + 2) / (total + 2 * terms)), by long division with three digits at a time."""
    rest, below = counts + 2, np.asarray(total) + 2 * terms
    share = np.zeros_like(counts)
    for _ in range(3):
        rest = rest * 1000
        share = share * 1000 + rest // below
        rest = rest % below
    return share + 1


def differences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _compared(top: int):
    """Sums over the terms of a task for each pair of sources, and the strongest terms of each shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, tuple[list[str], np.ndarray]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                names = [x["source"] for x in row["profile"]]
                totals = np.array([x["total"] for x in row["profile"]], np.int64)
                own = np.searchsorted(
                    np.array([x.encode() for x in names], object), [x.encode() for x in row["sources"]]
                )
                term_at = np.frombuffer(row["term_at"], "<i4")
                source_at = own[np.frombuffer(row["source_at"], "<i4")]
                n = np.frombuffer(row["n"], "<i8")
                if row["lang"] not in sums:
                    if sum(len(s) ** 2 for s, _ in sums.values()) > _CELLS:
                        yield _pairs(sums)
                        sums = {}
                    sums[row["lang"]] = names, np.zeros((len(names), len(names)), np.int64)
                matrix = sums[row["lang"]][1]
                strongest: dict[int, list[tuple[int, int]]] = {}
                step = max(1, _CELLS // max(len(names), 1))
                by_term = np.argsort(term_at, kind="stable")
                edges = np.searchsorted(term_at[by_term], np.arange(0, len(row["terms"]) + step, step))
                for k, (a, b) in enumerate(zip(edges.tolist(), edges[1:].tolist(), strict=False)):
                    start = k * step
                    width = min(step, len(row["terms"]) - start)
                    cells = by_term[a:b]
                    count = np.zeros((len(names), width), np.int64)
                    count[source_at[cells], term_at[cells] - start] = n[cells]
                    p = shares(count, totals[:, None], row["kept"])
                    q = shares(count.sum(axis=0), int(totals.sum()), row["kept"])
                    for i in range(len(names)):
                        matrix[i, i + 1 :] += differences(p[i + 1 :], p[i]).sum(axis=1)
                        places = np.flatnonzero((count[i] > 0) & (p[i] > q))
                        value = differences(p[i, places], q[places])
                        first = np.lexsort((places, -value))[:top]
                        strongest.setdefault(i, []).extend(
                            zip((-value[first]).tolist(), (start + places[first]).tolist(), strict=True)
                        )
                found = [
                    (row["lang"], names[i], None, row["terms"][place], -value)
                    for i, all_of in strongest.items()
                    for value, place in sorted(all_of)[:top]
                ]
                if found:
                    yield _rows(found)
        if sums:
            yield _pairs(sums)

    return run


def _pairs(sums: dict[str, tuple[list[str], np.ndarray]]) -> pa.RecordBatch:
    """A row per source, with its sums for all sources of the language in their order."""
    return _rows(
        [
            (lang, own, both.tobytes(), None, None)
            for lang, (names, matrix) in sums.items()
            for own, both in zip(names, matrix + matrix.T, strict=True)
        ]
    )


def _rows(found: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*found, strict=True)) or [[]] * 5
    kinds = [pa.string(), pa.string(), pa.binary(), pa.string(), pa.int64()]
    names = ["lang", "source", "sums", "item", "value"]
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of rows that follow one another with the same language and source, added up."""
    own, total = None, None

    def row() -> pa.RecordBatch:
        columns = [pa.array([own[0]]), pa.array([own[1]]), pa.array([total.tolist()], pa.list_(pa.int64()))]
        return pa.record_batch(columns, ["lang", "source", "sums"])

    for batch in batches:
        for lang, source, sums in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if own != (lang, source):
                if own is not None:
                    yield row()
                own, total = (lang, source), np.zeros(len(sums) // 8, np.int64)
            total += np.frombuffer(sums, np.int64)
    if own is not None:
        yield row()


def columnar_shards(documents: DataFrame, shards: int, docs: int = DOCS) -> DataFrame:
    """The kept terms and their counts per source: a row per (language, shard); other columns are left out."""
    parts = partial_counts(documents, shards)
    return parts.groupBy("shard").applyInArrow(_whole_shard(docs), _SHARD)


def divergences(documents: DataFrame, docs: int = DOCS, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank``: each source against each other, and its own strongest terms."""
    tasks = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = stored(columnar_shards(documents, tasks, docs), "divergence")
    totals = shards.select("lang", F.explode(F.arrays_zip("sources", "totals")).alias("x"))
    totals = totals.groupBy("lang", F.col("x.sources").alias("source")).agg(F.sum("x.totals").alias("total"))
    profile = totals.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("source", "total"))).alias("profile"))
    kept = shards.groupBy("lang").agg(F.sum(F.size("terms")).alias("kept"))
    # a row per shard of each language, so that no language is one key
    dealt = profile.join(kept, "lang").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))))
    compared = shards.drop("totals").join(dealt, ["lang", "shard"])
    found = map_batches(
        compared.select("lang", "terms", "sources", "term_at", "source_at", "n", "profile", "kept"),
        _compared(top),
        _FOUND,
    )
    found = stored(found, "differences")
    sums = found.where("sums is not null").select("lang", "source", "sums")
    sums = map_batches(sums.repartition("lang", "source").sortWithinPartitions("lang", "source"), _added, _SUMS)
    names = profile.select("lang", F.col("profile.source").alias("names"))
    each = F.explode(F.arrays_zip(F.col("names").alias("item"), F.col("sums").alias("value"))).alias("x")
    pairs = sums.join(names, "lang").select("lang", "source", each)
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "x.item", "x.value").where("item != source")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order).alias("rank")
    terms = found.where("sums is null").select("lang", "source", F.lit("term").alias("part"), "item", "value", rank)
    return pairs.select("*", rank).unionByName(terms.where(F.col("rank") <= top))


ORACLE_SQL = rf"""
with given as (
    select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
    from documents
),
used as (
    select id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from given
),
kept as (select lang, term from used group by lang, term having count(distinct id) >= {DOCS}),
sizes as (select lang, count(*) as v from kept group by lang),
cells as (select lang, source, term, count(*) as c from used join kept using (lang, term) group by all),
groups as (
    select g.lang, g.source, coalesce(sum(c), 0) as n
    from (select distinct lang, source from given) g left join cells using (lang, source) group by all
),
p as (
    select g.lang, g.source, k.term, coalesce(c, 0) as c,
        1 + ({BILLION}::hugeint * (coalesce(c, 0) + 2)) // (g.n + 2 * s.v) as p
    from groups g join kept k using (lang) join sizes s using (lang) left join cells using (lang, source, term)
),
whole as (
    select k.lang, k.term, 1 + ({BILLION}::hugeint * (k.c + 2)) // (sum(k.c) over (partition by lang) + 2 * s.v) as q
    from (select lang, term, sum(c) as c from cells group by all) k join sizes s using (lang)
),
pairs as (
    select a.lang, a.source, b.source as item,
        (select coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0) from p x join p y using (lang, term)
         where x.lang = a.lang and x.source = a.source and y.source = b.source) as value
    from groups a join groups b on a.lang = b.lang and a.source <> b.source
),
found as (
    select lang, source, 'pair' as part, item, value from pairs
    union all
    select lang, source, 'term', term, (p - q) * (p - q) // (p + q) from p join whole using (lang, term)
    where c > 0 and p > q
),
ranked as (
    select *, row_number() over (partition by lang, source, part order by value desc, item) as r from found
)
select lang, source, part, item, cast(value as bigint) as value, cast(r as integer) as "rank"
from ranked where part = 'pair' or r <= {TOP}
"""
