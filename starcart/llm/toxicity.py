"""Toxic documents by a weighted finite-state grammar over clauses.

Tokens are runs of letters, clauses end at punctuation and line ends. A lexicon maps tokens to
symbols: insult, threat verb, target, negator, reporting verb, other. Small transducers, one per
concern, are composed into a single table that reads the symbols of a clause and emits
a tag per match: insult, insult at a target, negated insult, reported insult, threat, negated or
reported threat. A document's score is a logistic function of the weights its clauses emit per tag,
not of words as such.

Fitted on labelled rows: insults beyond the seed list (words and word beginnings that
are found in toxic rows far more often than chance allows, near copies counted once), their
weights, and the weight of each tag.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starcart.llm.words import (
    LOWER,
    Stretches,
    as_bytes,
    map_batches,
    map_slices,
    shingle_set,
    slices,
    stored,
)

# Words of four languages per symbol.
INSULTS = """
idiot idiots moron morons stupid pathetic worthless scum trash loser losers clown disgusting
imbecile dumb filthy vermin
dummkopf trottel abschaum wertlos widerlich
imbécile crétin ordure minable dégoûtant
idiota imbécil estúpido basura asqueroso
""".split()
THREATS = """
kill hurt destroy crush burn beat stab shoot punch murder
töten umbringen vernichten erschießen
tuer détruire frapper brûler
matar destruir golpear quemar
""".split()
TARGETS = """
you your yours he she they him her them his their
du dich dir dein deine euch euer
tu toi vous votre ton
tú ti usted ustedes vosotros
""".split()
NEGATORS = "not never isn't aren't wasn't don't nicht nie kein keine jamais nunca jamás".split()
REPORTERS = """
said says say told wrote writes claimed claims quoted quote reported called
sagte schrieb behauptete zitierte
déclaré écrivit affirma
dijo escribió afirmó
""".split()

OTHER, INSULT, THREAT, TARGET, NEGATOR, REPORTER = range(6)
TAGS = ("insult", "insult_target", "insult_negated", "insult_reported", "threat", "threat_weak")
SEED_WEIGHT = 3.0
PREFIXES = range(4, 9)
_FORMS = 4

_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ'")] = True
_IS_LETTER[128:] = True
_ENDS_CLAUSE = np.zeros(256, bool)
_ENDS_CLAUSE[list(b".,;:!?\n")] = True


# --- transducers: (start, step); step(state, symbol, tag) -> (state, tag) ---------------------


def _recent(symbol: int, reach: int, rewrite: dict[str, str]):
    """Rewrites tags while ``symbol`` was read among the last ``reach`` tokens."""

    def step(state: int, read: int, tag: str | None) -> tuple[int, str | None]:
        if state and tag in rewrite:
            tag = rewrite[tag]
        return (reach if read == symbol else max(state - 1, 0)), tag

    return 0, step


def _insult():
    return 0, lambda state, read, tag: (state, "insult" if read == INSULT else tag)


def _threat(reach: int = 3):
    """A threat verb with a target among the next tokens."""

    def step(state: int, read: int, tag: str | None) -> tuple[int, str | None]:
        if read == TARGET and state:
            return 0, "threat"
        return (reach if read == THREAT else max(state - 1, 0)), tag

    return 0, step


def compose(*parts) -> tuple[np.ndarray, np.ndarray]:
    """The transducers run one on another's tags, as tables of next states and of tags.

    Rows are the states that can be reached, the first one the start; columns are symbols. A tag
    is an index into TAGS, or -1.
    """
    start = tuple(p[0] for p in parts)
    numbers, table, emits = {start: 0}, [], []
    for state in (queue := [start]):
        row, out = [], []
        for symbol in range(6):
            tag, after = None, []
            for own, (_, step) in zip(state, parts, strict=True):
                own, tag = step(own, symbol, tag)
                after.append(own)
            if tuple(after) not in numbers:
                numbers[tuple(after)] = len(numbers)
                queue.append(tuple(after))
            row.append(numbers[tuple(after)])
            out.append(TAGS.index(tag) if tag else -1)
        table.append(row)
        emits.append(out)
    return np.array(table), np.array(emits)


def grammar() -> tuple[np.ndarray, np.ndarray]:
    negated = {"insult": "insult_negated", "insult_target": "insult_negated", "threat": "threat_weak"}
    reported = {
        "insult": "insult_reported", "insult_target": "insult_reported", "threat": "threat_weak"
    }
    return compose(
        _insult(),
        _threat(),
        _recent(TARGET, 4, {"insult": "insult_target"}),
        _recent(NEGATOR, 3, negated),
        _recent(REPORTER, 8, reported),
    )


@dataclass(frozen=True)
class Model:
    """Lexicon weights and tag weights; small, sent to the tasks with the function."""

    whole: dict[str, float]
    beginnings: dict[str, float]
    tags: np.ndarray = field(default_factory=lambda: np.array([1.5, 2.0, 0.5, 0.5, 3.0, 0.5]))
    kinds: float = 0.0
    bias: float = -4.0


# --- tokens and symbols ----------------------------------------------------------------------


def _table(words: dict[str, tuple[int, float]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted hashes with symbols and weights."""
    names = [w.encode() for w in words] or [b"\0"]
    data = np.frombuffer(b"".join(names), np.uint8)
    ends = np.cumsum([len(w) for w in names])
    hashes = Stretches(data).hash(ends - [len(w) for w in names], ends)
    order = np.argsort(hashes)
    values = list(words.values()) or [(OTHER, 0.0)]
    return (
        hashes[order],
        np.array([v[0] for v in values], np.int8)[order],
        np.array([v[1] for v in values])[order],
    )


def _find(table, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    known, symbols, weights = table
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    hit = known[at] == hashes
    return np.where(hit, symbols[at], OTHER), np.where(hit, weights[at], 0.0)


class Reader:
    """Symbols, weights and clauses of the tokens of several texts."""

    def __init__(self, model: Model) -> None:
        fixed = {w: (s, 1.0) for s, words in (
            (THREAT, THREATS), (TARGET, TARGETS), (NEGATOR, NEGATORS), (REPORTER, REPORTERS)
        ) for w in words}
        insults = {w: (INSULT, weight) for w, weight in model.whole.items()}
        self.model, self.whole = model, _table(fixed | insults)
        self.by_length: dict[int, dict] = {}
        for word, weight in model.beginnings.items():
            self.by_length.setdefault(len(word.encode()), {})[word] = (INSULT, weight)
        self.beginnings = {n: _table(words) for n, words in self.by_length.items()}
        next_states, emits = grammar()
        self.steps, self.emits = next_states.tolist(), emits.tolist()

    def read(self, texts: list[bytes]) -> list[list[tuple[int, int, int, float, int]]]:
        """Per text its matches: (start byte, end byte, tag, weight, hash of the token)."""
        raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        data = LOWER[raw]
        offsets = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=offsets[1:])
        edges = np.flatnonzero(np.diff(_IS_LETTER[data], prepend=False))
        starts, ends = edges[0::2], edges[1::2]
        found: list[list] = [[] for _ in texts]
        if not len(starts):
            return found
        stretches = Stretches(data)
        hashes = stretches.hash(starts, ends)
        symbols, weights = _find(self.whole, hashes)
        for length, table in self.beginnings.items():
            long = np.flatnonzero((ends - starts >= length) & (symbols == OTHER))
            own, weight = _find(table, stretches.hash(starts[long], starts[long] + length))
            hit = own == INSULT
            symbols[long[hit]], weights[long[hit]] = INSULT, weight[hit]
        clause = np.cumsum(_ENDS_CLAUSE[data])[starts]
        telling = np.unique(clause[(symbols == INSULT) | (symbols == THREAT)])
        wanted = np.flatnonzero(np.isin(clause, telling))
        texts_of = np.searchsorted(offsets, starts[wanted], "right") - 1
        state, last = 0, -1
        for i, text, c, symbol in zip(
            wanted.tolist(), texts_of.tolist(), clause[wanted].tolist(), symbols[wanted].tolist(), strict=True
        ):
            if c != last:
                state, last = 0, c
            tag = self.emits[state][symbol]
            state = self.steps[state][symbol]
            if tag >= 0:
                weight = weights[i] if symbol == INSULT else SEED_WEIGHT
                base = offsets[text]
                found[text].append(
                    (int(starts[i] - base), int(ends[i] - base), tag, float(weight), int(hashes[i]))
                )
        return found


def _features(matches: list[tuple]) -> np.ndarray:
    """Weights emitted per tag, and the number of different tokens, on a log scale."""
    sums = np.zeros(len(TAGS) + 1)
    for _, _, tag, weight, _ in matches:
        sums[tag] += weight
    sums[-1] = len({m[4] for m in matches})
    return np.log1p(sums)


# --- fitting ---------------------------------------------------------------------------------


def learns_from(doc_id: F.Column) -> F.Column:
    """Labels of the other rows are held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1


def _sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """``doc_id, text, toxic`` of at most ``rows`` labelled rows, by a hash of the id."""
    chosen = (
        labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
        .where(learns_from(F.col("doc_id")) & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    small = F.broadcast(chosen)  # at most ``rows`` pairs of numbers
    return docs.select(F.col("doc_id").cast("long"), "text").join(small, "doc_id").where("text is not null")


def _beginnings_of(words: list[str]) -> dict[str, int]:
    """Word beginnings with the number of words that have them."""
    return Counter(w[:k] for w in words for k in PREFIXES if len(w) >= k)


def _distinct_words(sample: DataFrame) -> DataFrame:
    """Words and beginnings per sampled text, near copies once.

    Texts that share one of four least shingles count as copies. A beginning counts once per word
    of a text that has it, four times at most, since one long text proves little.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text in as_bytes(batch.column("text")):
            data = LOWER[np.frombuffer(text, np.uint8)]
            edges = np.flatnonzero(np.diff(_IS_LETTER[data], prepend=False, append=False))
            starts, ends = edges[0::2], edges[1::2]
            hashes = Stretches(data).hash(starts, ends)
            lowered = data.tobytes()
            shingles = shingle_set(hashes, 3)
            least = [
                int((shingles * np.uint64(k)).min() >> np.uint64(1)) if len(shingles) else 0
                for k in (1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
            ]
            words = {lowered[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)}
            rows.append((least, sorted(w.decode() for w in words)))
        found = [_beginnings_of(words) for _, words in rows]
        columns = [pa.array([r[0][k] for r in rows], pa.int64()) for k in range(4)]
        columns += [
            pa.array([r[1] for r in rows], pa.list_(pa.string())),
            pa.array([list(f) for f in found], pa.list_(pa.string())),
            pa.array([[min(n, _FORMS) for n in f.values()] for f in found], pa.list_(pa.int32())),
        ]
        return pa.RecordBatch.from_arrays(
            [batch.column("toxic"), *columns],
            ["toxic", "m0", "m1", "m2", "m3", "words", "beginnings", "forms"],
        )

    out = map_slices(
        sample,
        run,
        "toxic int, m0 long, m1 long, m2 long, m3 long, words array<string>, "
        "beginnings array<string>, forms array<int>",
    )
    for k in range(4):
        out = out.dropDuplicates([f"m{k}"])
    return out.select("toxic", "words", "beginnings", "forms")


def _lexicon(sample: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """Weights of whole words and of word beginnings that speak for the label.

    A beginning counted k times in toxic and j times in clean texts of the sample is taken if
    chance explains that with less than one case in the lexicon: at least two toxic texts,
    k ln(k / (k + j) / share of toxic) >= ln(tests) + 1, and nine tenths of the counts
    toxic. Only the shortest such beginning of a word is kept.
    """
    texts = stored(_distinct_words(sample), "sample_words")
    n, toxic = texts.agg(F.count("*"), F.sum("toxic")).first()
    seeds = dict.fromkeys(INSULTS, SEED_WEIGHT)
    if not toxic or toxic == n:
        return seeds, {}
    counts = stored(
        texts.select("toxic", F.explode(F.arrays_zip("beginnings", "forms")).alias("b"))
        .groupBy(F.col("b.beginnings").alias("word"))
        .agg(
            F.sum(F.col("toxic") * F.col("b.forms")).alias("k"),
            F.sum("b.forms").alias("n"),
            F.sum("toxic").alias("texts"),
        )
        .where("n >= 3"),
        "beginnings",
    )
    tests = max(counts.count(), 1)
    share = toxic / n
    strong = (
        counts.where("texts >= 2 and k >= 0.9 * n")
        .where(F.col("k") * F.log(F.col("k") / F.col("n") / share) >= float(np.log(tests) + 1))
        .orderBy(F.length("word"), "word")
        .collect()
    )
    beginnings: dict[str, float] = {}
    for row in strong:  # shortest first
        if not any(row.word[:k] in beginnings for k in range(PREFIXES[0], len(row.word))):
            beginnings[row.word] = float(np.log((row.k + 0.5) / (row.n - row.k + 0.5)))
    seen = {
        r.word: float(np.log((r.k + 0.5) / (r.n - r.k + 0.5)))
        for r in texts.select("toxic", F.explode("words").alias("word"))
        .where(F.col("word").isin(INSULTS))
        .groupBy("word")
        .agg(F.sum("toxic").alias("k"), F.count("*").alias("n"))
        .collect()
    }
    return {w: max(seen.get(w, weight), 0.1) for w, weight in seeds.items()}, beginnings


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.3) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton steps, with a ridge on the weights."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-3
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + penalty * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def fit_toxicity(docs: DataFrame, labels: DataFrame, rows: int = 8_000) -> Model:
    """The grammar's weights, from a sample of at most ``rows`` labelled texts.

    Rows that ``learns_from`` holds out are never read. Without labels of both
    kinds the seed list and fixed tag weights make up the model.
    """
    sample = stored(_sample(docs, labels, rows), "labelled")
    whole, beginnings = _lexicon(sample)
    model = Model(whole, beginnings)
    reader = Reader(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [_features(m).tolist() for m in reader.read(as_bytes(batch.column("text")))]
        return pa.RecordBatch.from_arrays(
            [batch.column("toxic"), pa.array(found, pa.list_(pa.float64()))], ["toxic", "x"]
        )

    # one row for each different vector: the sample holds few of them
    rows_ = (
        map_slices(sample, run, "toxic int, x array<double>").groupBy("toxic", "x").count().collect()
    )
    y = np.array([r.toxic for r in rows_ for _ in range(r["count"])], float)
    if not len(y) or y.min() == y.max():
        return model
    x = np.array([r.x for r in rows_ for _ in range(r["count"])])
    weights, bias = _fit(x, y)
    return Model(whole, beginnings, weights[:-1], float(weights[-1]), bias)


# --- scoring ---------------------------------------------------------------------------------


def score_of(matches: list[tuple], model: Model) -> float:
    x = _features(matches)
    return float(1 / (1 + np.exp(-np.clip(x[:-1] @ model.tags + x[-1] * model.kinds + model.bias, -30, 30))))


def without_toxic(docs: DataFrame, model: Model, limit: float = 0.7) -> DataFrame:
    """The rows, all columns, whose text scores below the limit."""
    reader = Reader(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                found = reader.read(as_bytes(piece.column("text")))
                yield piece.filter(pa.array([score_of(m, model) < limit for m in found], pa.bool_()))

    return map_batches(docs, run, docs.schema)


def toxicity(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns of each row with ``score`` and ``matches``.

    score, from 0 to 1, is higher the likelier the text is toxic. matches are the matched spans:
    bytes of the UTF-8 text, tag and weight. A null or empty text, or one without a match, has
    the score of a text without matches. Rows are scored one by one, so repeated ones are alike.
    """
    reader = Reader(model)
    kind = pa.list_(
        pa.struct(
            [("start", pa.int64()), ("end", pa.int64()), ("tag", pa.string()), ("weight", pa.float64())]
        )
    )

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = reader.read(as_bytes(batch.column("text")))
        spans = [
            [{"start": s, "end": e, "tag": TAGS[t], "weight": w} for s, e, t, w, _ in m] for m in found
        ]
        return pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in keep),
                pa.array([score_of(m, model) for m in found], pa.float64()),
                pa.array(spans, kind),
            ],
            [*keep, "score", "matches"],
        )

    source = docs.select(*{c: 0 for c in (*keep, "text")})
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return map_slices(
        source,
        run,
        f"{types}, score double, matches array<struct<start: long, end: long, tag: string, weight: double>>",
    )
