"""Toxicity behind disguises: a noisy-channel decoder restores words, a logistic score over restored words follows.

The source model is a character trigram model counted over every document (a table of fixed size, 64^3). The channel
knows leetspeak (a digit or symbol for a letter), spacing (separators between the letters of a word) and repetition.
Words with such marks, and words with a doubled letter, become a lattice of what each character may stand for, and Viterbi finds
the likeliest reading; other words have one reading and skip it. Readings are kept per distinct word in a bounded cache.

The score is a logistic regression over the presence of restored words and of letter sequences within them. Features and
weights are fit on a bounded sample of labelled rows: SAMPLE_ROWS rows of the smallest hashes, and FEATURES features. Labels,
language, source and doc_id are no inputs of a score.

A null text is the empty text, whose score is that of no feature; without labels of both kinds every score is 0; repeated
rows score alike; labels that contradict each other for a doc_id count as toxic, null ones don't count; an empty table gives
an empty result; extra columns are kept by score() as far as its caller names them.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velograph.llm.shared import bit_table, settle, whole_text

SAMPLE_ROWS, FEATURES, GRAMS = 12_000, 400, (5, 6)
#: Of squared weights, by five-fold cross-validation on the training rows of sf0.1: 303 of 352 toxic rows found there and 2 of 2,803 clean ones
#: flagged (at 1.0: 291 and 1; at 0.03: 306 and 7).
PENALTY = 0.1
#: Names that a task counts before it passes the counts on.
NAMES = 200_000
#: Bits of the table of names that are common among toxic rows, as a power of two.
TABLE_BITS = 22
#: Letters of the character model, after the word boundary at 0; other letters share the last place.
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
SIDE = 64
#: What a character may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "l", "+": "t"}
SEPARATORS = " .-_*"
#: Channel costs, in nats.
AS_LEET, AS_BREAK, DROP_SEPARATOR, DROP_SECOND, DROP_MORE = 1.0, 3.0, 0.2, 2.0, 0.3

WORD = re.compile(r"[^\W\d_]+")
MARK = re.compile(r"[0-9@$!|+]+")
SPACED = re.compile(r"(?<![^\W_])([^\W_]|[@$!|+])\1*(?:[\s.\-_*]+([^\W_]|[@$!|+])\2*){2,}(?![^\W_])")
GAP = re.compile(r"[\s.\-_*]+")
DOTTED = re.compile(r"(?:[^\W\d_][.\-_*]){2,}[^\W\d_](?![^\W\d_])")
TWICE = re.compile(r"(.)\1+")
#: Letters at the beginning of a feature that a word is searched for first.
START = 4


def places() -> np.ndarray:
    """Of each code point below 256 its place in the model."""
    table = np.zeros(256, np.int64)
    for i, c in enumerate(LETTERS, 1):
        table[ord(c)] = i
    return table


def count_trigrams(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Trigram counts over all texts: SIDE^3 numbers, whatever the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, total = places(), np.zeros(SIDE**3, np.int64)
        for batch in batches:
            block, size = [], 0
            for i, value in enumerate(batch.column(0)):
                block.append(value.as_py())
                size += len(block[-1])
                if size > 1 << 20 or i == batch.num_rows - 1:
                    codes = np.frombuffer("\n".join(["", *block, ""]).lower().encode("utf-32-le", "replace"), np.uint32)
                    at = table[np.minimum(codes, 255)]
                    at = np.where((codes > 255), SIDE - 1, at)
                    total += np.bincount((at[:-2] * SIDE + at[1:-1]) * SIDE + at[2:], minlength=SIDE**3)
                    block, size = [], 0
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found], pa.int64())], names=["gram", "n"])

    out = np.zeros(SIDE**3, np.int64)
    for r in docs.select(whole_text(text)).mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect():
        out[r["gram"]] = r["n"]
    return out


class Decoder:
    """Viterbi over the lattice of a marked word."""

    def __init__(self, counts: np.ndarray):
        cube = counts.reshape(SIDE, SIDE, SIDE).astype(float)
        pair = cube.sum(axis=0) + 0.01
        back = pair / pair.sum(axis=1, keepdims=True)
        self.cost = (-np.log((cube + 2 * back[None]) / (cube.sum(axis=2, keepdims=True) + 2))).tolist()
        self.place = {c: i for i, c in enumerate(LETTERS, 1)}

    def options(self, word: str) -> list[list[tuple[str, float]]]:
        out = []
        for i, c in enumerate(word):
            again = i > 0 and word[i - 1] == c
            if c in LEET:
                own = [(t, AS_LEET) for t in LEET[c]] + [(" ", AS_BREAK)] + ([("", DROP_MORE)] if again else [])
            elif c in SEPARATORS:
                own = [("", DROP_SEPARATOR), (" ", AS_LEET)]
            elif c.isalpha():
                more = again and (word[i - 2 : i - 1] == c or word[i + 1 : i + 2] == c)
                own = [(c, 0.0)] + ([("", DROP_MORE if more else DROP_SECOND)] if again else [])
            else:
                own = [(" ", 0.0)]
            out.append(own)
        return out

    def restore(self, word: str) -> str:
        """The likeliest reading; states are the last two letters, and each step keeps the best way to each of them."""
        states: dict[tuple[int, int], tuple[float, object]] = {(0, 0): (0.0, None)}
        for own in [*self.options(word), [(" ", 0.0)]]:
            fresh: dict[tuple[int, int], tuple[float, object]] = {}
            for (a, b), (cost, way) in states.items():
                for c, paid in own:
                    if c == "":
                        key, total, to = (a, b), cost + paid, way
                    elif c == " " and b == 0:
                        key, total, to = (0, 0), cost + paid, way
                    else:
                        at = 0 if c == " " else self.place.get(c, SIDE - 1)
                        key, total, to = (b, at), cost + paid + self.cost[a][b][at], (way, c)
                    if key not in fresh or total < fresh[key][0]:
                        fresh[key] = (total, to)
            states = fresh
        way, out = min(states.values(), key=lambda x: x[0])[1], []
        while way is not None:
            way, c = way
            out.append(c)
        return "".join(reversed(out)).strip()


def marked(lower: str) -> set[str]:
    """Stretches that may hold a disguised word: tokens with a digit or symbol, as they stand and without marks at their ends, and letters set apart."""
    found, end = set(), -1
    for m in MARK.finditer(lower):
        if m.start() < end:
            continue
        start, end = m.span()
        while start and not lower[start - 1].isspace():
            start -= 1
        while end < len(lower) and not lower[end].isspace():
            end += 1
        for ends in (".,;:?*#&%)(\"'", "!.,;:?*#&%$)(\"'"):
            token = lower[start:end].strip(ends)
            if MARK.search(token):
                found.add(token)
    found.update(GAP.sub(" ", m[0]) for m in SPACED.finditer(lower))
    found.update(m[0] for m in DOTTED.finditer(lower))
    return found


def single(word: str) -> str:
    """The word with every run of a letter as one."""
    return TWICE.sub(r"\1", word) if TWICE.search(word) else word


class Listed:
    """Names whose bit is set, each standing for itself."""

    def __init__(self, bits: bytes):
        self.bits = bits

    def __contains__(self, name: str) -> bool:
        return bool(self.bits[zlib.crc32(name.encode("utf-8")) & ((1 << TABLE_BITS) - 1)])

    def __getitem__(self, name: str) -> str:
        return name


class Reader:
    """The features of a text, through bounded caches."""

    def __init__(self, decoder: Decoder, features: dict[str, int] | Listed | None = None, limit: int = 200_000):
        self.decoder, self.features, self.limit = decoder, features, limit
        # the beginnings of features, with runs of a letter as one: a reading of a plain word only shortens its runs
        known = features if isinstance(features, dict) else {}
        self.wholes = {single(f.strip()) for f in known if f[0] == " "}
        self.starts = {single(f)[:START] for f in known if f[0] != " "}
        self.short = [x for x in self.starts if len(x) < START]
        self.picky = bool(known)
        self.words: dict[str, tuple] = {}
        self.tokens: dict[str, tuple] = {}

    def named(self, word: str) -> list[str]:
        out = [f" {word} "]
        for n in GRAMS:
            out += [word[i : i + n] for i in range(len(word) - n + 1)]
        return out

    def may_hold(self, word: str) -> bool:
        """Whether any reading of a plain word can hold a feature; saves the reading of most words."""
        plain = single(word)
        return plain in self.wholes or any(plain[i : i + START] in self.starts for i in range(len(plain) - START + 1)) or any(x in plain for x in self.short)

    def of_word(self, word: str) -> tuple:
        if self.picky and not self.may_hold(word):
            return ()
        readings = [word]
        if TWICE.search(word):
            readings += WORD.findall(self.decoder.restore(word))
        names = {x for r in readings for x in self.named(r)}
        return tuple(names) if self.features is None else tuple(self.features[x] for x in names if x in self.features)

    def of_token(self, token: str) -> tuple:
        return tuple({x for w in WORD.findall(self.decoder.restore(token)) for x in self.of_word(w)})

    def read(self, text: str) -> set:
        lower, found = text.lower(), set()
        for distinct, cache, of in ((set(WORD.findall(lower)), self.words, self.of_word), (marked(lower), self.tokens, self.of_token)):
            for w in distinct:
                hit = cache.get(w)
                if hit is None:
                    if len(cache) > self.limit or self.features is None:
                        cache.clear()
                    hit = cache[w] = of(w)
                if hit:
                    found.update(hit)
        return found


def is_held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


class Model:
    def __init__(self, counts: np.ndarray, features: dict[str, int], weights: np.ndarray, bias: float):
        self.counts, self.features, self.weights, self.bias = counts, features, weights, bias


def logistic(rows: list[list[int]], labels: np.ndarray, n: int, steps: int = 400, penalty: float = PENALTY) -> tuple[np.ndarray, float]:
    """Weights and bias by accelerated gradient steps on the penalised loss."""
    x = np.zeros((len(rows), n + 1))
    x[:, n] = 1.0
    for i, r in enumerate(rows):
        x[i, r] = 1.0
    keep = np.append(np.full(n, penalty), 0.0)
    step = 1.0 / (0.25 * np.linalg.norm(x, 2) ** 2 + penalty)
    w, back = np.zeros(n + 1), np.zeros(n + 1)
    for t in range(steps):
        at = w + (t / (t + 3)) * (w - back)
        back, w = w, at - step * (x.T @ (1 / (1 + np.exp(-np.clip(x @ at, -30, 30))) - labels) + keep * at)
    return w[:n], float(w[n])


def fit(docs: DataFrame, labels: DataFrame, text: str = "text") -> Model:
    """The model of docs (language model: all of them) and of the labels of rows that aren't held out."""
    counts = count_trigrams(docs, text)
    spark = docs.sparkSession
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~is_held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # at most SAMPLE_ROWS ids and labels
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS).select(F.col("doc_id").alias("__doc"), F.col("toxic").cast("int").alias("toxic"))
    rows = docs.select(F.col("doc_id").alias("__id"), whole_text(text).alias("text"))
    sample = rows.join(F.broadcast(settle(picked, "toxic-ids")), F.col("__id") == F.col("__doc")).select("toxic", "text")
    sample = settle(sample.repartition(4 * spark.sparkContext.defaultParallelism), "toxic-sample")
    model = spark.sparkContext.broadcast(counts)

    def counted(batches: Iterator[pa.RecordBatch], label: bool, features: Listed | None, n: str) -> Iterator[pa.RecordBatch]:
        """In how many rows of a label each name stands, in parts of some NAMES names, so that a task's memory is bounded."""
        reader, seen = Reader(Decoder(model.value), features, NAMES // 10), Counter()

        def out() -> pa.RecordBatch:
            part = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["name", n])
            seen.clear()
            return part

        for batch in batches:
            for toxic, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (toxic > 0) == label:
                    seen.update(reader.read(value))
                    if len(seen) > NAMES:
                        yield out()
        yield out()

    totals = {r["toxic"]: r["count"] for r in sample.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).count().collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        return Model(counts, {}, np.zeros(0), -math.inf)
    common = settle(sample.mapInArrow(lambda b: counted(b, True, None, "n1"), "name string, n1 long").groupBy("name").agg(F.sum("n1").alias("n1")).filter(F.col("n1") >= max(3, n1 // 400)), "toxic-names")
    # counts of the other rows need one more pass; a table of fixed size tells which names may be common, the join tells which are
    listed = spark.sparkContext.broadcast(np.unpackbits(np.frombuffer(bit_table(common, F.crc32(F.encode("name", "UTF-8")), TABLE_BITS), np.uint8), bitorder="little").tobytes())

    rest = sample.mapInArrow(lambda b: counted(b, False, Listed(listed.value), "n0"), "name string, n0 long").groupBy(F.col("name").alias("__name")).agg(F.sum("n0").alias("n0"))
    both = common.join(rest, F.col("name") == F.col("__name"), "left").select("name", F.col("n1").cast("double").alias("a"), F.coalesce("n0", F.lit(0)).cast("double").alias("b"))
    # the features that most exceed what they would be without a bond to the label
    a, b, share = F.col("a"), F.col("b"), n1 / (n1 + n0)
    gain = a * F.log(a / ((a + b) * share)) + F.when(b > 0, b * F.log(b / ((a + b) * (1 - share)))).otherwise(0.0)
    best = both.filter(a > (a + b) * share).withColumn("gain", gain).filter("gain > 6").orderBy(F.desc("gain"), F.desc("a"), "name").limit(FEATURES).collect()
    features = {r["name"]: k for k, r in enumerate(best)}
    held = spark.sparkContext.broadcast(features)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(Decoder(model.value), held.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([sorted(reader.read(v)) for v in batch.column(1).to_pylist()], pa.list_(pa.int32()))], names=["toxic", "found"])

    got = sample.mapInArrow(rows, "toxic int, found array<int>").collect()
    weights, bias = logistic([r["found"] for r in got], np.array([float(r["toxic"] > 0) for r in got]), len(features))
    return Model(counts, features, weights, bias)


def score(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns keep, and score (0 to 1)."""
    if "score" in keep:
        raise ValueError("a column is in the way: score")
    held = docs.sparkSession.sparkContext.broadcast(model)
    at = keep.index(text) if text in keep else len(keep)
    own = [] if text in keep else [whole_text(text).alias("__text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        reader, weights = Reader(Decoder(m.counts), m.features), m.weights.tolist()
        for batch in batches:
            out = []
            for value in batch.column(at):
                total = m.bias + sum([weights[i] for i in sorted(reader.read(value.as_py() or ""))]) if weights else m.bias
                out.append(1 / (1 + math.exp(-max(total, -500.0))) if total > -math.inf else 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(out, pa.float64())], names=[*keep, "score"])

    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("score", T.DoubleType())])
    return docs.select(*keep, *own).mapInArrow(run, schema)


def reject(docs: DataFrame, labels: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """docs without those that score threshold or more."""
    scored = score(docs, fit(docs, labels, text), text, tuple(docs.columns))
    return scored.filter(F.col("score") < threshold).select(*docs.columns)
