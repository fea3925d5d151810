"""Masked pseudo-likelihood of texts by a small window network that sees both sides of every word.

The network predicts a word's class. How often each word occurs is a table that grows
with the corpus; it tells the words of a class apart and meets the texts in a join.
Training doesn't depend on how the input is split: a text's unit and its place in it
are drawn from its content, and sums are in whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriframe.llm.shared import slices, stored, with_columns

#: Words on either side, size of the hidden layer.
WINDOW, HIDDEN = 3, 24
#: A word's class is a pair of digits of its hash.
DIGIT, CLASSES = 32, 1024
RATE, BATCH = 0.05, 8192
#: Words of a unit, which is trained in one go, about; each of the rounds takes its share of the units, and ends with their average.
UNIT_WORDS, ROUNDS = 1_000_000, 4
#: Characters of a unit's texts that are turned into one stretch.
STRETCH = 1_000_000
#: Words that make up more than one in so many go to the tasks by broadcast: there are fewer of them than this.
FREQUENT = 1 << 20
#: Fractions of a weight, and of a log, in which sums are taken; words in one part of a unit's weight.
PARTS, LOG_PARTS, WEIGHT_WORDS = 1 << 24, 1 << 30, 1024
#: Multipliers by which the bytes of a word are told apart by place; they come round after so many bytes.
_PLACES = 1 << 12
#: Names and shapes of the weights, in the order in which they travel.
SHAPES = {
    "left": (CLASSES + 1, HIDDEN), "right": (CLASSES + 1, HIDDEN), "near_left": (WINDOW,), "near_right": (WINDOW,), "bias": (HIDDEN,),
    "high": (HIDDEN, DIGIT), "high_bias": (DIGIT,), "given": (DIGIT, HIDDEN), "low": (HIDDEN, DIGIT), "low_bias": (DIGIT,),
}
WEIGHTS = sum(int(np.prod(s)) for s in SHAPES.values())


def initial(seed: int = 3) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(seed)
    model = {name: (draw.normal(0, 0.1, shape) if len(shape) > 1 else np.zeros(shape)).astype(np.float32) for name, shape in SHAPES.items()}
    for side in ("near_left", "near_right"):
        model[side] = (1 / np.arange(1, WINDOW + 1)).astype(np.float32)
    return model


def flat(model: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([model[name].ravel() for name in SHAPES])


def unflat(values: np.ndarray) -> dict[str, np.ndarray]:
    model, at = {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        model[name] = values[at:at + size].reshape(shape).astype(np.float32)
        at += size
    return model


_FACTOR = np.random.default_rng(5).integers(1, 1 << 63, _PLACES, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def hashes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in a row, and the number of words of each text.

    Words are runs without ASCII white space in lower case; a hash is 64 bits of
    their bytes.
    """
    parts = [t.lower().encode() + b" " for t in texts]
    data = np.frombuffer(b"".join(parts), np.uint8)
    inside = ~_SPACE[data]
    start = np.flatnonzero(inside & np.concatenate([[True], ~inside[:-1]])) if len(data) else np.empty(0, np.int64)
    text_ends = np.cumsum([len(p) for p in parts])
    count = np.diff(np.searchsorted(start, text_ends, "left"), prepend=0)
    if not len(start):
        return start, count
    end = np.flatnonzero(~inside & np.concatenate([[False], inside[:-1]]))
    size = end - start
    byte = data[inside].astype(np.uint64)
    first = np.cumsum(size) - size
    place = np.arange(len(byte)) - np.repeat(first, size)
    hashed = np.add.reduceat((byte + np.uint64(1)) * _FACTOR[place & (_PLACES - 1)], first)
    hashed = (hashed ^ (hashed >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return hashed.view(np.int64), count


def classes_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> 48) & (CLASSES - 1)


def padded(hashes: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes of several texts in a row with padding around each, and the places of the words."""
    place = np.arange(len(hashes)) + WINDOW * (1 + np.repeat(np.arange(len(count)), count))
    classes = np.full(len(hashes) + WINDOW * (len(count) + 1), CLASSES, np.int64)
    classes[place] = classes_of(hashes)
    return classes, place


def _sides(model: dict, classes: np.ndarray, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
    return model["left"][classes[a - WINDOW:b]], model["right"][classes[a:b + WINDOW]]


def hidden(model: dict, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hidden layer of a stretch: words on both sides, weighted by their distance, and never the word itself."""
    n = len(left) - WINDOW
    x = np.repeat(model["bias"][None], n, axis=0)
    for k in range(WINDOW):
        x += model["near_left"][k] * left[WINDOW - 1 - k:WINDOW - 1 - k + n]
        x += model["near_right"][k] * right[1 + k:1 + k + n]
    return np.tanh(x, out=x)


def _powers(model: dict, name: str, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Powers of e of a digit's scores, a column for each place, and their sums."""
    x = model[name].T @ h.T
    x += model[name + "_bias"][:, None]
    x -= x.max(0)
    np.exp(x, out=x)
    return x, x.sum(0)


def _targets(classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    real = classes < CLASSES
    target = np.where(real, classes, 0)
    return real.astype(np.float32), target // DIGIT, target % DIGIT


def class_log_probs(model: dict, classes: np.ndarray) -> np.ndarray:
    """Log-probability of the class at each place given the words on both sides: its high digit, then its low one; 0 at padding."""
    out = np.zeros(len(classes))
    for a in range(WINDOW, len(classes) - WINDOW, BATCH):
        b = min(a + BATCH, len(classes) - WINDOW)
        h = hidden(model, *_sides(model, classes, a, b))
        real, top, bottom = _targets(classes[a:b])
        rows = np.arange(b - a)
        high, high_sum = _powers(model, "high", h)
        h += model["given"][top]
        low, low_sum = _powers(model, "low", h)
        # an underflowing power would be a probability of zero
        out[a:b] = np.where(real, np.log(np.maximum(high[top, rows] / high_sum, 1e-30)) + np.log(np.maximum(low[bottom, rows] / low_sum, 1e-30)), 0)
    return out


def _spread(values: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Sums of the values of equal rows."""
    order = np.argsort(rows.astype(np.uint16), kind="stable")
    ordered = rows[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    out = np.zeros((size, values.shape[1]), np.float32)
    out[ordered[first]] = np.add.reduceat(values[order], first, axis=0)
    return out


def learn(model: dict, squares: dict, classes: np.ndarray, a: int, b: int) -> None:
    """One step along the gradient of the log-probabilities of a stretch, with a rate for each weight."""
    left, right = _sides(model, classes, a, b)
    h = hidden(model, left, right)
    n, rows = b - a, np.arange(b - a)
    real, top, bottom = _targets(classes[a:b])
    high, total = _powers(model, "high", h)
    high *= real / total
    high[top, rows] -= real
    given = h + model["given"][top]
    low, total = _powers(model, "low", given)
    low *= real / total
    low[bottom, rows] -= real
    to_given = low.T @ model["low"].T
    x = (to_given + high.T @ model["high"].T) * (1 - h * h)
    slope = {"bias": x.sum(0), "high": (high @ h).T, "high_bias": high.sum(1), "low": (low @ given).T, "low_bias": low.sum(1), "given": _spread(to_given, top, DIGIT)}
    # a word is a neighbour of several places: their slopes are added up where it stands, then by class
    for side, near, standing_in, at in (
            ("left", "near_left", left, [WINDOW - 1 - k for k in range(WINDOW)]), ("right", "near_right", right, [1 + k for k in range(WINDOW)])):
        standing = np.zeros((n + WINDOW, HIDDEN), np.float32)
        for k in range(WINDOW):
            standing[at[k]:at[k] + n] += model[near][k] * x
        slope[near] = np.array([np.vdot(x, standing_in[i:i + n]) for i in at])
        slope[side] = _spread(standing, classes[a - WINDOW:b] if side == "left" else classes[a:b + WINDOW], CLASSES + 1)
    words = max(1, int(real.sum()))
    for name, g in slope.items():
        g = (g / words).astype(np.float32)
        squares[name] += g * g
        model[name] -= RATE * g / (np.sqrt(squares[name]) + 1e-6)


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``word`` (a hash), ``n``: how often each word occurs in all texts; one row a distinct word, written."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in slices(batches, text):
            words, n = np.unique(hashes_of(texts)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(n.astype(np.int64))], names=["word", "n"])

    return stored(docs.select(F.col(f"`{text}`").alias(text)).mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")


class _Unit:
    """Training of one unit from given weights, a stretch of texts at a time."""

    def __init__(self, start: dict):
        self.model = {name: w.copy() for name, w in start.items()}
        self.squares = {name: np.full(shape, 1e-8, np.float32) for name, shape in SHAPES.items()}
        self.words, self.texts, self.held = 0, [], 0

    def add(self, text: str) -> None:
        self.texts.append(text)
        self.held += len(text)
        if self.held >= STRETCH:
            self.learn()

    def learn(self) -> None:
        hashes, count = hashes_of(self.texts)
        classes, _ = padded(hashes, count)
        self.words += len(hashes)
        for a in range(WINDOW, len(classes) - WINDOW, BATCH):
            learn(self.model, self.squares, classes, a, min(a + BATCH, len(classes) - WINDOW))
        self.texts, self.held = [], 0

    def result(self) -> Iterator[pa.RecordBatch]:
        """The weights in whole numbers, times the unit's share."""
        self.learn()
        if self.words:
            share = -(-self.words // WEIGHT_WORDS)
            values = np.append(np.rint(flat(self.model).astype(float) * PARTS).astype(np.int64) * share, share)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], names=["number", "value"])


def _round(texts: DataFrame, weights) -> np.ndarray | None:
    """The average of the weights after each unit of ``unit, text`` has been learnt from, in its own order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, current = None, None
        for batch in batches:
            of, texts = batch.column(0), batch.column(1)
            for k in range(batch.num_rows):
                number = of[k].as_py()
                if number != current:
                    if unit:
                        yield from unit.result()
                    unit, current = _Unit(unflat(weights.value)), number
                unit.add(texts[k].as_py())
        if unit:
            yield from unit.result()

    got = texts.mapInArrow(run, "number int, value long").groupBy("number").agg(F.sum("value").alias("value")).toPandas()
    if not len(got):
        return None
    values = got.sort_values("number")["value"].to_numpy(np.int64)
    return values[:-1] / (PARTS * float(values[-1]))


def train(docs: DataFrame, text: str = "text", spread: Sequence[str] = ()) -> dict:
    """A model of all texts: ``weights`` of the network, ``counts`` of every word as a frame, words and distinct words of each class.

    Texts are dealt to units of about ``UNIT_WORDS`` words by a hash, so the number of units grows with the
    corpus; ``spread`` names columns that go into the hash, which deal out copies of one text. Each text is learnt from once: in each of
    ``ROUNDS`` rounds a part of the units starts from the same weights, and their
    results are averaged by their words. A unit is a stream of texts in the order of their hash,
    so neither the weights, bit by bit, nor the memory depend on the partitions. The driver receives
    one number for each weight and class, however large the corpus is. Null and empty
    texts add nothing; an empty corpus gives the first weights.
    """
    counts = word_counts(docs, text)
    of_class = counts.groupBy(F.shiftright("word", 48).bitwiseAND(F.lit(CLASSES - 1)).cast("int").alias("class")).agg(F.sum("n").alias("n"), F.count("*").alias("distinct"))
    totals = np.zeros((CLASSES, 2), np.int64)
    for number, n, distinct in of_class.collect():
        totals[number] = n, distinct
    units = ROUNDS * max(1, -(-int(totals[:, 0].sum()) // (UNIT_WORDS * ROUNDS)))
    columns = [F.col(f"`{c}`") for c in (text, *spread)]
    placed = docs.where(F.col(f"`{text}`") != "").select(
        F.pmod(F.xxhash64(*columns), F.lit(units)).cast("int").alias("unit"), F.col(f"`{text}`").alias("text"), F.xxhash64(F.lit(1), *columns).alias("place"))
    weights = flat(initial()).astype(float)
    for number in range(ROUNDS):
        mine = placed.where(F.pmod("unit", F.lit(ROUNDS)) == number).repartition(max(1, min(units // ROUNDS, 4096)), "unit")
        ordered = mine.sortWithinPartitions("unit", "place", "text").select("unit", "text")
        found = _round(ordered, docs.sparkSession.sparkContext.broadcast(weights))
        weights = weights if found is None else found
    return {"weights": unflat(weights), "counts": counts, "classes": totals}


def frequent_words(model: dict) -> tuple[np.ndarray, np.ndarray]:
    """The words that are more than one in ``FREQUENT`` of all, sorted, and their counts: fewer than ``FREQUENT``."""
    got = model["counts"].where(F.col("n") * FREQUENT > int(model["classes"][:, 0].sum())).toPandas()
    got = got.sort_values("word")
    return got["word"].to_numpy(np.int64), got["n"].to_numpy(np.int64)


def class_bases(classes: np.ndarray) -> np.ndarray:
    """Log of what divides a word's count and one, by class: its words, distinct words and one."""
    return np.log(classes.sum(1) + 1.0)


def log_parts(n: np.ndarray) -> np.ndarray:
    return np.rint(np.log(n + 1.0) * LOG_PARTS).astype(np.int64)


def score(docs: DataFrame, model: dict, text: str = "text", words: str = "n_words", out: str = "log_prob", carry: bool = True) -> DataFrame:
    """The rows with the number of words and the sum of their conditional log-probabilities.

    Each word is predicted from ``WINDOW`` words on either side, as a class by the
    network, and as itself within its class by its count in the corpus and one. Frequent words are looked up
    in the tasks, all others joined with the table of counts; a word that the corpus
    doesn't have counts as none. Null and empty texts have no word and 0. Rows are
    independent; columns of the names given for the results are replaced. The text is left out unless ``carry``, since
    the rows are written on the way.
    """
    spark = docs.sparkSession
    kept = docs.drop(words, out)
    names = [c for c in kept.columns if carry or c != text]
    packed = kept.select(
        F.monotonically_increasing_id().alias("row"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("kept") if names else F.struct(F.lit(1)).alias("kept"),
        F.col(f"`{text}`").alias("text"))
    sent = spark.sparkContext.broadcast((model["weights"], model["classes"], *frequent_words(model)))
    schema = T.StructType([f for f in packed.schema.fields if f.name != "text"] + [
        T.StructField("n", T.LongType()), T.StructField("classes", T.DoubleType()), T.StructField("frequent", T.LongType()),
        T.StructField("rare", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.IntegerType()))])

    def run(batches):
        weights, totals, common, n_common = sent.value
        base, value = class_bases(totals), log_parts(n_common)
        for batch, texts in slices(batches, "text", 1_000_000):
            hashes, count = hashes_of(texts)
            classes, place = padded(hashes, count)
            ends = np.cumsum(count)
            at = np.minimum(np.searchsorted(common, hashes), max(len(common) - 1, 0))
            known = common[at] == hashes if len(common) else np.zeros(len(hashes), bool)
            by_class = np.append(0.0, np.cumsum(class_log_probs(weights, classes)[place] - base[classes_of(hashes)]))
            by_count = np.append(0, np.cumsum(np.where(known, value[at], 0) if len(common) else np.zeros(len(hashes), np.int64)))
            # the others by text, each once with how often it occurs
            of_text = np.repeat(np.arange(len(count)), count)[~known]
            order = np.lexsort((hashes[~known], of_text))
            word, owner = hashes[~known][order], of_text[order]
            first = np.flatnonzero(np.append(True, (word[1:] != word[:-1]) | (owner[1:] != owner[:-1]))) if len(word) else np.zeros(0, np.int64)
            offsets = np.searchsorted(owner[first], np.arange(len(count) + 1)).astype(np.int32)
            yield with_columns(batch.drop_columns(["text"]), {
                "n": pa.array(count.astype(np.int64)), "classes": pa.array(by_class[ends] - by_class[ends - count]), "frequent": pa.array(by_count[ends] - by_count[ends - count]),
                "rare": pa.ListArray.from_arrays(offsets, pa.array(word[first])),
                "times": pa.ListArray.from_arrays(offsets, pa.array(np.diff(first, append=len(word)).astype(np.int32)))})

    rows = stored(packed.mapInArrow(run, schema), "scored")
    others = rows.select("row", F.inline(F.arrays_zip("rare", "times"))).toDF("row", "word", "times")
    counted = others.join(model["counts"], "word").select("row", (F.col("times") * F.rint(F.log(F.col("n") + 1.0) * LOG_PARTS).cast("long")).alias("value"))
    of_row = counted.groupBy("row").agg(F.sum("value").alias("value"))
    total = F.col("classes") + (F.col("frequent") + F.coalesce("value", F.lit(0))) / LOG_PARTS
    return rows.drop("rare", "times").join(of_row, "row", "left").select(
        *[F.col("kept")[c].alias(c) for c in names], F.col("n").alias(words), total.alias(out))
