"""Secrets in texts: three fixed patterns, and tokens that pass a battery of randomness tests.

Only Spark expressions: a document's matches are arrays in its row; only counts of tokens are shuffled.

A token is a run of 20 or more base64 characters. Its encoding is inferred from its characters: hex,
base32, lower-case alphanumeric, alphanumeric, base64; decimal numbers and letters of one case alone are not
tested. With A symbols in the encoding and L characters:

* chi-squared test of the A symbols being equally frequent;
* runs test of symbols in the lower and upper half of the alphabet;
* serial correlation of each symbol with the next one.

The three p-values are combined by Fisher's rule; a token below ``RANDOM_P`` is not random. Passing is
easy for short tokens, so it is not yet a discovery. ``p_text`` bounds the probability that ordinary text would
look as random as the token does: it is the likelihood of the token under a chain for text, divided by that under
equally frequent symbols of its own encoding (by Markov's inequality, text gets below p with probability p at most).
The chain knows that case, digits and separators come in runs, that vowels and consonants take turns, and how
frequent letters are; words, decimal numbers and names seen through any encoding, also hex, have their price.

Which tokens are discoveries is decided for all documents together, by Benjamini and Hochberg's rule for each encoding and
class of lengths: tokens are counted by quarter decades of ``p_text``, and the limit is the largest one at which
the number of tokens times the limit is at most ``FALSE_DISCOVERIES`` of those below it. Short tokens, of
which many look random by chance, thus do not set the limit of long ones, nor words in capitals that
of hex keys. No limit is above ``MOST_P``, as real texts may hold names that the chain does not know. The count is a
table of a few thousand rows whatever the corpus; the rows of a table that is empty have no limit to meet.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The patterns; the shortest match, or value of an assignment, that counts.
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")

TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}"
RANDOM_P = 0.01
FALSE_DISCOVERIES = 0.05
MOST_P = 1e-3
LENGTHS = (24, 32, 40, 64, 128)  # classes of lengths begin at 20 and at these
_DECADE = 4  # classes of p per decade
_LEAST_P = 75  # decades that are told apart

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DIGITS = "0123456789"
ALPHABETS = {  # tried in this order
    r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$": _DIGITS + "abcdef",
    r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$": _DIGITS + "ABCDEF",
    r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+$": _UPPER + "234567",
    r"^(?=.*[0-9])(?=.*[a-z])[a-z0-9]+$": _UPPER.lower() + _DIGITS,
    r"^(?=.*[A-Z])(?=.*[a-z0-9])[A-Za-z0-9]+$": _UPPER + _UPPER.lower() + _DIGITS,
    r"^(?=.*[A-Z])(?=.*[a-z])(?=.*[0-9])[A-Za-z0-9+/_-]+$": _UPPER + _UPPER.lower() + _DIGITS + "+/",
}


# Ordinary text as a chain over kinds of symbols. Letters per cent of European texts.
_VOWELS = {"a": 24, "e": 33, "i": 19, "o": 17, "u": 7}
_CONSONANTS = {
    "t": 11.5, "n": 12.5, "s": 11.5, "r": 11, "l": 7.5, "d": 7, "h": 5.5, "c": 5.5, "m": 4.5, "p": 4, "g": 3.5, "b": 2.7,
    "f": 2.5, "v": 2.2, "k": 1.8, "w": 1.6, "y": 1.5, "z": 1, "q": 0.7, "j": 0.6, "x": 0.4,
}
_SYMBOLS = _UPPER + _UPPER.lower() + _DIGITS + "+/"
_KINDS = ("lower", "upper", "digit", "other")
_NEXT = {  # chance of the kind that follows, in the order of _KINDS
    "lower": (0.86, 0.06, 0.03, 0.05),
    "upper": (0.50, 0.42, 0.04, 0.04),
    "digit": (0.08, 0.06, 0.80, 0.06),
    "other": (0.50, 0.25, 0.20, 0.05),
}
_VOWEL_AFTER = {"vowel": 0.2, "consonant": 0.55, "other": 0.35}
# states: vowel and consonant of either case, digit, other
_STATES = (("lower", "vowel"), ("lower", "consonant"), ("upper", "vowel"), ("upper", "consonant"), ("digit", "other"), ("other", "other"))


def _step(before: tuple[str, str], after: tuple[str, str]) -> float:
    chance = _NEXT[before[0]][_KINDS.index(after[0])]
    vowel = _VOWEL_AFTER[before[1]]
    return math.log(chance * {"vowel": vowel, "consonant": 1 - vowel, "other": 1.0}[after[1]])


def _emission(symbol: str) -> tuple[int, float]:
    """A symbol's state, and the logarithm of its chance there."""
    if symbol.isdigit():
        return 4, math.log(1 / 10)
    if not symbol.isalpha():
        return 5, math.log(1 / 2)
    letter, case = symbol.lower(), 2 * symbol.isupper()
    for k, shares in enumerate((_VOWELS, _CONSONANTS)):
        if letter in shares:
            return case + k, math.log(shares[letter] / sum(shares.values()))
    raise ValueError(symbol)


STEPS = [_step(x, y) for x in _STATES for y in _STATES]
EMISSIONS = [_emission(c) for c in _SYMBOLS]

def _places(text: Column, pattern: str, value: int = 0) -> Column:
    """The matches as (start, end, value), in order; characters, end exclusive.

    What lies between the matches comes from splitting the text by the same pattern, so lengths give
    the places.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value)) if value else matches
    gaps = F.split(text, pattern, -1)
    pairs = F.zip_with(
        F.slice(gaps, F.lit(1), F.size(matches)),
        F.arrays_zip(matches.alias("m"), values.alias("v")),
        lambda gap, m: F.struct(F.length(gap).alias("gap"), m["m"].alias("m"), m["v"].alias("v")),
    )
    start = F.struct(
        F.lit(0).alias("at"),
        F.array().cast("array<struct<start: int, end: int, value: string>>").alias("found"),
    )

    def add(state: Column, x: Column) -> Column:
        begin = state["at"] + x["gap"]
        end = begin + F.length(x["m"])
        one = F.struct(begin.alias("start"), end.alias("end"), x["v"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["found"], F.array(one)).alias("found"))

    found = F.aggregate(pairs, start, add, lambda state: state["found"])
    return F.when(text.rlike(pattern), found).otherwise(start["found"])


def _spans(places: Column, kind: int) -> Column:
    return F.transform(
        places,
        lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end")),
    )


def _normal_tail(z: Column) -> Column:
    """P(Z > z), to three digits."""
    return 1 / (1 + F.exp(F.least(F.lit(1.5976) * z + F.lit(0.07056) * z * z * z, F.lit(700.0))))


def _two_sided(z: Column) -> Column:
    return F.greatest(2 * _normal_tail(F.abs(z)), F.lit(1e-300))


def _tested(place: Column) -> Column:
    """A token's place with ``p_random`` and ``p_text``; null where no encoding fits."""
    body = F.regexp_replace(place["value"], "=+$", "")
    alphabet = F.coalesce(
        *(F.when(body.rlike(pattern), F.lit(symbols)) for pattern, symbols in ALPHABETS.items())
    )
    url_safe = F.translate(body, "-_", "+/")
    return F.struct(
        place["start"].alias("start"),
        place["end"].alias("end"),
        url_safe.alias("body"),
        alphabet.alias("alphabet"),
        F.coalesce(
            *(F.when(body.rlike(pattern), F.lit(i)) for i, pattern in enumerate(ALPHABETS))
        ).alias("encoding"),
    )


def _statistics(token: Column) -> Column:
    """Length, symbols, chi-squared value, and the fold over the symbols' numbers."""
    body, alphabet = token["body"], token["alphabet"]
    n, a = F.length(body).cast("double"), F.length(alphabet).cast("double")
    counts = F.transform(
        F.split(alphabet, "", -1),
        lambda c: F.when(c == "", 0.0).otherwise((F.length(body) - F.length(F.replace(body, c, F.lit("")))).cast("double")),
    )
    squares = F.aggregate(counts, F.lit(0.0), lambda s, x: s + x * x)
    middle = (a - 1) / 2
    states = F.array(*(F.lit(k) for k, _ in EMISSIONS))
    emissions = F.array(*(F.lit(e) for _, e in EMISSIONS))
    steps = F.array(*map(F.lit, STEPS))
    first = F.struct(
        F.lit(None).cast("double").alias("last"),
        F.lit(0.0).alias("product"),
        F.lit(1.0).alias("runs"),
        F.lit(len(_STATES) - 1).alias("state"),  # a token begins as after a separator
        F.lit(0.0).alias("text"),
    )
    # words in capitals are words: their case tells nothing
    capitals = ~body.rlike("[a-z]")

    def add(state: Column, c: Column) -> Column:
        x = F.instr(alphabet, c) - 1 - middle
        new_run = (state["last"] >= 0) != (x >= 0)
        place = F.instr(F.lit(_SYMBOLS), F.when(capitals, F.lower(c)).otherwise(c)) - 1
        kind = F.get(states, place)
        step = F.get(steps, state["state"] * len(_STATES) + kind)
        return F.struct(
            x.alias("last"),
            (state["product"] + F.coalesce(state["last"] * x, F.lit(0.0))).alias("product"),
            (state["runs"] + F.when(new_run, 1.0).otherwise(0.0)).alias("runs"),
            kind.alias("state"),
            (state["text"] + step + F.get(emissions, place)).alias("text"),
        )

    fold = F.aggregate(F.filter(F.split(body, "", -1), lambda c: c != ""), first, add)
    return F.struct(
        token["start"].alias("start"),
        token["end"].alias("end"),
        n.alias("n"),
        a.alias("a"),
        (a / n * squares - n).alias("chi"),
        fold.alias("fold"),
        _family(token["encoding"], n).alias("family"),
    )


def _p_values(s: Column) -> Column:
    n, a, chi = s["n"], s["a"], s["chi"]
    d = a - 1
    cube = F.greatest(chi / d, F.lit(0.0))
    z_chi = (F.pow(cube, F.lit(1 / 3)) - (1 - 2 / (9 * d))) / F.sqrt(2 / (9 * d))
    z_runs = (s["fold"]["runs"] - 1 - (n - 1) / 2) / F.sqrt((n - 1) / 4)
    z_serial = s["fold"]["product"] / ((a * a - 1) / 12) / F.sqrt(n - 1)
    half = -F.log(_normal_tail_floor(z_chi)) - F.log(_two_sided(z_runs)) - F.log(_two_sided(z_serial))
    random = F.exp(-half) * (1 + half + half * half / 2) >= RANDOM_P
    # of p_text; -1 for a token that is not random
    decades = -F.least(s["fold"]["text"] + n * F.log(a), F.lit(0.0)) / math.log(10)
    level = F.floor(F.least(decades, F.lit(float(_LEAST_P))) * _DECADE).cast("int")
    return F.struct(
        s["start"].alias("start"),
        s["end"].alias("end"),
        s["family"].alias("family"),
        F.when(random, level).otherwise(-1).alias("level"),
    )


def _family(encoding: Column, length: Column) -> Column:
    """The tokens that are judged together: those of one encoding and class of lengths."""
    classes = sum(((length >= n).cast("int") for n in LENGTHS), F.lit(0))
    return encoding * (len(LENGTHS) + 1) + classes


def limits(tokens: DataFrame) -> DataFrame:
    """One row with a map: the least level of a discovery, for each family that has any.

    ``tokens`` has a column of that name as from the tests. Level k holds the p_text from 10 ** -(k / 4) on downwards, which is
    the limit that is asked for when level k and all above it are discovered.
    """
    counts = tokens.select(F.explode("tokens").alias("t")).groupBy("t.family", "t.level").agg(F.count("*").alias("n"))
    above = Window.partitionBy("family").orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy("family")
    counts = counts.withColumn("found", F.sum("n").over(above)).withColumn("all", F.sum("n").over(every))
    limit = F.pow(F.lit(10.0), -F.col("level") / _DECADE)
    kept = counts.where((F.col("level") >= 0) & (limit <= MOST_P))
    kept = kept.where(F.col("all") * limit <= FALSE_DISCOVERIES * F.col("found"))
    least = kept.groupBy("family").agg(F.min("level").alias("level"))
    return least.agg(F.map_from_entries(F.collect_list(F.struct("family", "level"))).alias("limits"))


def _normal_tail_floor(z: Column) -> Column:
    return F.greatest(_normal_tail(z), F.lit(1e-300))


def find_secrets(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns with ``base`` and ``added``, arrays of (start, kind, end).

    Spans are characters of the text, end exclusive, kind a place in KINDS; ``base`` holds the matches of the
    three patterns and ``added`` random tokens that lie in none of them, both by start, then kind. A null
    text counts as empty and has none. The texts are read twice, first for the limits; repeated rows are alike.
    """
    names = [f"`{c}`" for c in keep]
    text = F.coalesce(F.col("text"), F.lit(""))
    # columns of the working projections get names that no kept column has
    rows = docs.select(F.struct(*names).alias("kept"), text.alias("text"))
    rows = rows.select(
        "kept",
        _places(F.col("text"), ASSIGN, value=2).alias("assign"),
        _places(F.col("text"), ACCESS).alias("access"),
        _places(F.col("text"), HEX).alias("hex"),
        _places(F.col("text"), TOKEN).alias("tokens"),
    )
    long_enough = {
        "assign": F.filter("assign", lambda x: F.length(x["value"]) >= 6),
        "access": F.filter("access", lambda x: F.length(x["value"]) >= 20),
        "hex": F.col("hex"),
    }
    spans = [_spans(p, KINDS.index(k)) for k, p in long_enough.items()]
    rows = rows.select("kept", "tokens", F.array_sort(F.concat(*spans)).alias("base"))
    rows = rows.select(
        "kept",
        "base",
        F.filter(
            F.transform("tokens", _tested),
            lambda t: t["alphabet"].isNotNull()
            & ~F.exists("base", lambda b: (b["start"] <= t["start"]) & (b["end"] >= t["end"])),
        ).alias("tokens"),
    )
    rows = rows.select("kept", "base", F.transform("tokens", _statistics).alias("tokens"))
    rows = rows.select("kept", "base", F.transform("tokens", _p_values).alias("tokens"))
    rows = rows.crossJoin(F.broadcast(limits(rows)))  # a single row
    added = F.filter("tokens", lambda t: t["level"] >= F.try_element_at("limits", t["family"]))
    return rows.select("kept.*", "base", _spans(added, 3).alias("added"))


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    one = F.transform(
        spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))
    )
    return F.array_join(one, ",")


def of_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == KINDS.index(kind))).cast("long")


def redacted(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """The rows, all columns, with each found span of the text replaced by ``mark``.

    Spans that overlap are replaced by one mark. ``n_chars``, where the table has it, becomes the new
    length; rows without a span stay as they are.
    """
    columns = docs.columns
    found = find_secrets(docs.select(F.struct(*(f"`{c}`" for c in columns)).alias("row"), "text"), ("row",))
    text = F.col("row")["text"]
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

    def add(state: Column, span: Column) -> Column:
        fresh = span["start"] >= state["at"]
        between = F.substring(text, state["at"] + 1, F.greatest(span["start"] - state["at"], F.lit(0)))
        done = F.concat(state["done"], F.when(fresh, F.concat(between, F.lit(mark))).otherwise(F.lit("")))
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), done.alias("done"))

    spans = F.array_sort(F.concat("base", "added"))
    rest = F.substring(text, F.col("s")["at"] + 1, F.length(text))
    changed = F.size("spans") > 0
    rows = found.select("row", spans.alias("spans"))
    rows = rows.select("row", "spans", F.when(changed, F.aggregate("spans", start, add)).alias("s"))
    rows = rows.select("row", "spans", F.concat(F.col("s")["done"], rest).alias("clean"))
    kinds = dict(docs.dtypes)
    new = {"text": F.col("clean"), "n_chars": F.length("clean").cast(kinds.get("n_chars", "long"))}
    return rows.select(
        *(
            (
                F.when(changed, new[c]).otherwise(F.col("row")[c]) if c in new else F.col("row")[c]
            ).alias(c)
            for c in columns
        )
    )
