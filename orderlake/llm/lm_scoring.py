"""Language-model scores: a log-bilinear model trained with noise-contrastive estimation.

Tokens are words (A-Z lowered) and one end per text. A token belongs to a unit: the most frequent tokens are units of
their own, the others share one by their last two bytes. The model predicts the unit from the units before it: a
context vector, each earlier unit's vector scaled dimension by dimension by its distance, is compared with the vector
of every unit. Inside a shared unit the smoothed unigram shares out the probability; each shared unit keeps a share
for tokens never seen. All probabilities of a context sum to one, and the softmax over units is one matrix product.

All training text is used. Counts of every token are aggregated by Spark and grow with the corpus. The vectors, of
fixed size, are trained in rounds: each task runs noise-contrastive steps over its texts of the round from the
vectors of the round before, and Spark averages them by tokens. Rounds take disjoint parts of the texts.

For scoring, counts of up to ``FRONT`` frequent tokens go to every task (the bound is kept by a threshold taken from a
histogram of counts); all other occurrences are joined with the table of counts. Every score uses exact counts.

Null or empty text: the end alone. Null id: held out. Repeated rows are scored, and learnt from, each by itself. An
empty training set gives uniform units. Existing columns of the added names are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.frames import table, without
from orderlake.llm.text import Words, mix, slices, words_of

FRONT = 1 << 18  # counts sent to every task, at most
SLOTS = 1 << 20  # places of them in a table looked up by hash
OWN, SHARED = 192, 64  # units of one token, and of many
UNITS = OWN + SHARED
BEGIN = UNITS  # stands before the first token; is never predicted
CONTEXT, DIMENSION = 4, 24
NOISE, BATCH, RATE = 64, 2048, 0.1
ROUND_PARTS = (1, 3, 12)  # sixteenths of the texts learnt from in each round
SMOOTH = 0.1
LARGEST = 70.0
FLUSH_TOKENS = 4_000_000
END = mix(np.array([0x656E64]))[0]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PARAMETERS = (("context", (CONTEXT, DIMENSION)), ("inputs", (UNITS + 1, DIMENSION)),
               ("outputs", (UNITS, DIMENSION)), ("bias", (UNITS,)))


@dataclass
class Tokens:
    """Tokens of a column of texts, each text with its end; ``first[i]:first[i + 1]`` are those of text ``i``."""

    hashes: np.ndarray
    groups: np.ndarray  # shared unit a token would belong to, from 0
    first: np.ndarray


def tokens_of(column: pa.Array) -> Tokens:
    words: Words = words_of(column, lower=True)
    data, last = words.data, words.ends - 1
    before = np.maximum(last - 1, words.starts)
    # Of the lowered word: a token has one group, however its occurrences are spelled.
    tail = _LOWER[data[before]].astype(np.uint64) * np.uint64(256) + _LOWER[data[last]]
    groups = (mix(tail) % np.uint64(SHARED)).astype(np.int32)
    at = words.first[1:]
    return Tokens(np.insert(words.hashes, at, END), np.insert(groups, at, 0), words.first + np.arange(len(at) + 1))


@dataclass
class Vectors:
    """The trained arrays; ``flat`` and ``from_flat`` lay them out one after another."""

    context: np.ndarray
    inputs: np.ndarray
    outputs: np.ndarray
    bias: np.ndarray

    @staticmethod
    def start(shares: np.ndarray) -> Vectors:
        rng = np.random.default_rng(11)
        spread = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        return Vectors(
            np.full((CONTEXT, DIMENSION), 1 / CONTEXT, np.float32), spread(UNITS + 1, DIMENSION),
            spread(UNITS, DIMENSION), np.log(shares).astype(np.float32),
        )

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, name).ravel() for name, _ in _PARAMETERS]).astype(np.float64)

    @staticmethod
    def from_flat(values: np.ndarray) -> Vectors:
        parts, at = {}, 0
        for name, shape in _PARAMETERS:
            size = int(np.prod(shape))
            parts[name] = values[at : at + size].reshape(shape).astype(np.float32)
            at += size
        return Vectors(**parts)

    def predicted(self, before: np.ndarray) -> np.ndarray:
        """Context vectors of rows of earlier units."""
        return sum(self.inputs[before[:, j]] * self.context[j] for j in range(CONTEXT))

    def log_probabilities(self, before: np.ndarray, units: np.ndarray) -> np.ndarray:
        """Natural logarithm of each unit's probability after its context."""
        out = np.empty(len(units))
        ones = np.ones(UNITS, dtype=np.float32)
        for low in range(0, len(units), BATCH):
            part = slice(low, low + BATCH)
            scores = self.predicted(before[part]) @ self.outputs.T
            scores += self.bias
            np.minimum(scores, LARGEST, out=scores)  # far above any trained score; keeps the sum finite
            own = scores[np.arange(len(scores)), units[part]]
            np.exp(scores, out=scores)
            out[part] = own - np.log(scores @ ones)
        return out


def sums_by(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sum of the values, one vector each, that go to each of ``n`` rows."""
    width = values.shape[1]
    place = rows[:, None] * width + np.arange(width)
    return np.bincount(place.ravel(), weights=values.ravel(), minlength=n * width).reshape(n, width).astype(np.float32)


def contexts(units: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The units before each token, nearest first; places before a text hold ``BEGIN``."""
    out = np.full((len(units), CONTEXT), BEGIN, dtype=np.int32)
    depth = np.arange(len(units)) - np.repeat(first[:-1], np.diff(first))
    for j in range(CONTEXT):
        inside = np.flatnonzero(depth > j)
        out[inside, j] = units[inside - j - 1]
    return out


class Trainer:
    """Noise-contrastive steps with AdaGrad over batches of tokens; one set of noise units serves a batch."""

    def __init__(self, vectors: Vectors, shares: np.ndarray) -> None:
        self.v = vectors
        self.rng = np.random.default_rng(23)
        self.edges = np.cumsum(shares)
        self.noise_log = np.log(NOISE * shares).astype(np.float32)
        self.sums = {name: np.full(shape, 1e-3, np.float32) for name, shape in _PARAMETERS}

    def _descend(self, name: str, gradient: np.ndarray) -> None:
        self.sums[name] += gradient * gradient
        getattr(self.v, name)[...] -= RATE * gradient / np.sqrt(self.sums[name])

    def step(self, before: np.ndarray, units: np.ndarray) -> None:
        v, n = self.v, len(units)
        noise = np.minimum(np.searchsorted(self.edges, self.rng.random(NOISE) * self.edges[-1]), UNITS - 1)
        inputs = v.inputs[before]
        hidden = (inputs * v.context).sum(axis=1)
        true_score = (hidden * v.outputs[units]).sum(axis=1) + v.bias[units] - self.noise_log[units]
        noise_score = hidden @ v.outputs[noise].T + v.bias[noise] - self.noise_log[noise]
        sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -30, 30)))
        pull, push = (sigmoid(true_score) - 1) / n, sigmoid(noise_score) / n
        to_hidden = pull[:, None] * v.outputs[units] + push @ v.outputs[noise]
        outputs = sums_by(units, pull[:, None] * hidden, UNITS) + sums_by(noise, push.T @ hidden, UNITS)
        bias = np.bincount(units, weights=pull, minlength=UNITS) + np.bincount(
            noise, weights=push.sum(axis=0), minlength=UNITS
        )
        context = (inputs * to_hidden[:, None, :]).sum(axis=0)
        seen = sums_by(before.ravel(), (to_hidden[:, None, :] * v.context).reshape(-1, DIMENSION), UNITS + 1)
        for name, gradient in (("outputs", outputs), ("bias", bias), ("context", context), ("inputs", seen)):
            self._descend(name, gradient)


@dataclass
class Model:
    """What scoring needs: frequent counts in a table looked up by hash, unit masses, and the vectors."""

    total: int
    distinct: int
    slot_hash: np.ndarray
    slot_count: np.ndarray
    slot_unit: np.ndarray  # -1: the token shares a unit
    mass: np.ndarray  # smoothed count of each shared unit, with the share of tokens never seen
    shares: np.ndarray  # of each unit among training tokens
    vectors: Vectors | None = None

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether a token's count is here, the count, and its own unit or -1."""
        slot = (hashes >> np.uint64(44)).astype(np.int64)
        found = self.slot_hash[slot] == hashes
        return found, np.where(found, self.slot_count[slot], 0), np.where(found, self.slot_unit[slot], -1)

    def units(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found, count, own = self.look_up(tokens.hashes)
        return np.where(own >= 0, own, OWN + tokens.groups).astype(np.int32), found, count


def is_held_out(id_col: str) -> Column:
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(name.cast("binary")) % 10 == 0


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []

    def flush() -> pa.RecordBatch:
        keys = np.concatenate([h for h, _ in held])
        groups = np.concatenate([g for _, g in held])
        token, at, n = np.unique(keys, return_index=True, return_counts=True)
        arrays = [pa.array(token.view(np.int64)), pa.array(groups[at]), pa.array(n)]
        return pa.RecordBatch.from_arrays(arrays, ["token", "part", "n"])

    size = 0
    for batch in slices(batches, "text"):
        tokens = tokens_of(batch.column(0))
        held.append((tokens.hashes, tokens.groups))
        size += len(tokens.hashes)
        if size >= FLUSH_TOKENS:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()


def count_tokens(texts: DataFrame) -> DataFrame:
    """(token, part, n) of all tokens: 64-bit hash, shared unit it would belong to, occurrences. A written table."""
    counted = texts.select("text").mapInArrow(_count, "token bigint, part int, n bigint")
    return table(counted.groupBy("token", "part").agg(F.sum("n").alias("n")), "token-counts")


def prepare(counts: DataFrame) -> Model:
    """Totals, frequent counts and units from the table of counts; the driver sees at most ``FRONT`` of its rows."""
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    level = F.floor(F.log2("n") * 8).cast("int")
    histogram = {r.level: r.tokens for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("tokens")).collect()}
    least, room = None, FRONT
    for step in sorted(histogram, reverse=True):
        room -= histogram[step]
        if room < 0:
            break
        least = step
    front = counts.where(level >= F.lit(least)).toPandas() if least is not None else counts.limit(0).toPandas()
    front = front.sort_values(["n", "token"], ascending=False)
    hashes = front["token"].to_numpy(np.int64).view(np.uint64)
    unit = np.full(len(front), -1, dtype=np.int32)
    unit[:OWN] = np.arange(min(OWN, len(front)))
    unit_mass = np.zeros(UNITS)
    unit_mass[: min(OWN, len(front))] = front["n"].to_numpy()[:OWN]
    parts = {r.part: (r.n, r.tokens) for r in counts.groupBy("part").agg(F.sum("n").alias("n"), F.count("*").alias("tokens")).collect()}
    mass = np.full(SHARED, SMOOTH)
    own = front.iloc[:OWN]
    for part, (n, tokens) in parts.items():
        there = own["part"] == part
        rest = n - int(own["n"][there].sum())
        mass[part] += rest + SMOOTH * (tokens - int(there.sum()))
        unit_mass[OWN + part] = rest
    slot = (hashes >> np.uint64(44)).astype(np.int64)
    slot_hash, slot_count = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.int64)
    slot_unit = np.full(SLOTS, -1, np.int32)
    # Written from rare to frequent: of tokens that meet in a slot the most frequent stays, the others are joined.
    slot_hash[slot[::-1]], slot_count[slot[::-1]] = hashes[::-1], front["n"].to_numpy()[::-1]
    slot_unit[slot[::-1]] = unit[::-1]
    kept = set(slot_unit[slot_unit >= 0].tolist())
    for i in range(min(OWN, len(front))):  # a unit whose token lost its slot: the token shares a unit after all
        if i not in kept:
            part = int(own["part"].iloc[i])
            n = int(own["n"].iloc[i])
            mass[part] += n + SMOOTH
            unit_mass[OWN + part] += n
            unit_mass[i] = 0
    shares = (unit_mass + 1) / (unit_mass + 1).sum()
    return Model(int(total), int(distinct), slot_hash, slot_count, slot_unit, mass, shares)


def _learn(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = model.vectors
        trainer = Trainer(Vectors.from_flat(start.flat()), model.shares)
        seen = 0
        for batch in slices(batches, "text"):
            tokens = tokens_of(batch.column(0))
            units, _, _ = model.units(tokens)
            before = contexts(units, tokens.first)
            order = trainer.rng.permutation(len(units))
            for low in range(0, len(units), BATCH):
                part = order[low : low + BATCH]
                trainer.step(before[part], units[part])
            seen += len(units)
        if seen:
            flat = trainer.v.flat()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat), pa.array(np.full(len(flat), float(seen)))],
                ["place", "value", "weight"],
            )

    return run


def train(docs: DataFrame, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model from all texts of ``docs``, given the counts of their tokens."""
    model = prepare(counts)
    model.vectors = Vectors.start(model.shares)
    part = F.pmod(F.xxhash64(F.col(id_col)), F.lit(sum(ROUND_PARTS)))
    low = 0
    for size in ROUND_PARTS:
        chosen = docs.where((part >= low) & (part < low + size)).select(F.col(text_col).alias("text"))
        rows = (
            chosen.mapInArrow(_learn(model), "place int, value double, weight double")
            .groupBy("place")
            .agg((F.sum(F.col("value") * F.col("weight")) / F.sum("weight")).alias("value"))
            .toPandas()
        )
        if len(rows):
            values = np.zeros(len(rows))
            values[rows["place"].to_numpy()] = rows["value"].to_numpy()
            model.vectors = Vectors.from_flat(values)
        low += size
    return model


def _score(model: Model):
    log_mass = np.log10(model.mass)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, row = TaskContext.get().partitionId(), 0
        for batch in slices(batches, "text"):
            tokens = tokens_of(batch.column(1))
            units, found, count = model.units(tokens)
            logs = model.vectors.log_probabilities(contexts(units, tokens.first), units) / np.log(10)
            known_log = np.where(found, np.log10(count + SMOOTH), 0.0)
            shared = units >= OWN
            # A shared unit's probability is shared out by smoothed counts; those of the front are known here.
            inside = np.where(shared, known_log - log_mass[np.where(shared, units - OWN, 0)], 0.0)
            first = tokens.first[:-1]
            rare = np.flatnonzero(~found)
            offsets = np.searchsorted(rare, tokens.first).astype(np.int32)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + n) + (task << 40)),
                    batch.column(0),
                    pa.array(np.diff(tokens.first)),
                    pa.array(np.add.reduceat(found.astype(np.int64), first)),
                    pa.array(np.add.reduceat(known_log, first)),
                    pa.array(np.add.reduceat(logs + inside, first)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(tokens.hashes[rare].view(np.int64))),
                ],
                ["row", "id", "n_tokens", "front", "front_log", "model_log", "rare"],
            )
            row += n

    return run


def score(docs: DataFrame, counts: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text: id, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` (log10)."""
    schema = "row bigint, id bigint, n_tokens bigint, front bigint, front_log double, model_log double, " \
             "rare array<bigint>"  # fmt: skip
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    scored = table(texts.mapInArrow(_score(model), schema), "scores")
    rare = (
        scored.select("row", F.explode("rare").alias("token"))
        .join(counts.select("token", "n"), "token", "left")
        .groupBy("row")
        .agg(
            F.count("n").alias("rare_known"),
            F.sum(F.log10(F.coalesce("n", F.lit(0)) + F.lit(SMOOTH))).alias("rare_log"),
        )
    )
    scale = float(np.log10(model.total + SMOOTH * (model.distinct + 1)))
    none = F.lit(0.0)
    return scored.drop("rare").join(rare, "row", "left").select(
        F.col("id").alias(id_col),
        "n_tokens",
        (F.col("front") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("bigint").alias("train_tokens"),
        (F.col("front_log") + F.coalesce("rare_log", none) - F.col("n_tokens") * F.lit(scale)).alias("base_score"),
        (F.col("model_log") + F.coalesce("rare_log", none)).alias("score"),
    )


def train_and_score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learn from the texts that are not held out; score all. Adds ``held_out`` to what ``score`` returns."""
    rows = without(docs.select(id_col, text_col), ())
    training = rows.where(~is_held_out(id_col))
    counts = count_tokens(training.select(F.col(text_col).alias("text")))
    model = train(training, counts, id_col, text_col)
    return score(rows, counts, model, id_col, text_col).withColumn("held_out", is_held_out(id_col))
