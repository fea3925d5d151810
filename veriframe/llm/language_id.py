"""Language of words and texts by a linear-chain conditional random field."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriframe.llm.shared import slices, with_columns

UNKNOWN = "und"
#: Rows of each language that a model is fitted on at most, and characters of a text that may be among them.
SAMPLE, SAMPLE_CHARS = 250, 20_000
#: Parts in which the rows of a language are ranked first.
PARTS = 64
#: Hashed features, words of a language in the lexicon, words of a chain.
SIZE, LEXICON, SPAN = 1 << 15, 150, 128
#: Code-switched training chains, their words, passes over them and the first learning rate.
CHAINS, CHAIN, PASSES, RATE = 3_000, 48, 3, 0.3
_WORDS = re.compile(r"[^\W\d_]+").findall
_GRAMS = (1, 2, 3, 4)
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)
_REMEMBERED = 300_000


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case."""
    found = _WORDS(text.lower())
    return found if text.isascii() else [w for w in found if any(map(str.isalpha, w))]


def word_features(words: list[str], lexicon: dict[str, list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all words in a row, and where each word's begin.

    Every word is framed, so its n-grams of up to four characters hold its affixes.
    A word of the lexicon has a feature for itself and one for each of its languages.
    """
    framed = ["\x02" + w + "\x03" for w in words]
    codes = np.frombuffer("".join(framed).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.array([len(w) for w in framed])
    owner = np.repeat(np.arange(len(words)), sizes)
    features, owners = [], []
    for n in _GRAMS:
        if len(codes) < n:
            continue
        hashed = sum(codes[k:len(codes) - n + 1 + k] * _MIX[k] for k in range(n)) + np.uint64(n)
        inside = owner[:len(codes) - n + 1] == owner[n - 1:]
        features.append(((hashed * _MIX[0]) >> np.uint64(64 - 15)).astype(np.int64)[inside])
        owners.append(owner[:len(codes) - n + 1][inside])
    extra = [(k, f) for k, w in enumerate(words) for f in lexicon.get(w, ())]
    features.append(np.array([f for _, f in extra], np.int64))
    owners.append(np.array([k for k, _ in extra], np.int64))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(features)[order], np.searchsorted(owner[order], np.arange(len(words)))


def make_lexicon(texts: dict[str, list[list[str]]]) -> dict[str, list[int]]:
    """Feature numbers, beyond the hashed ones, of the most frequent words of each language: one for the word, one for the language."""
    chosen: dict[str, list[int]] = {}
    for k, lang in enumerate(sorted(texts)):
        counts = Counter(w for words in texts[lang] for w in words)
        for word in sorted(counts, key=lambda w: (-counts[w], w))[:LEXICON]:
            chosen.setdefault(word, []).append(SIZE + k)
    first = SIZE + len(texts)
    return {w: [*langs, first + n] for n, (w, langs) in enumerate(sorted(chosen.items()))}


def posteriors(scores: np.ndarray, size: np.ndarray, model: dict, pairs: bool = False):
    """Forward-backward over chains padded to one length: ``scores`` is chain by place by label.

    Answers the probability of each label at each place (padding: zero), and on
    request the expected number of each transition.
    """
    n, length, labels = scores.shape
    step = np.exp(model["step"])
    local = np.exp(scores - scores.max(2, keepdims=True))
    real = np.arange(length) < size[:, None]
    forward, backward = np.empty_like(local), np.empty_like(local)
    now = local[:, 0] * np.exp(model["start"])
    forward[:, 0] = now / now.sum(1, keepdims=True)
    for t in range(1, length):
        now = (forward[:, t - 1] @ step) * local[:, t]
        forward[:, t] = now / now.sum(1, keepdims=True)
    after = np.ones((n, labels))
    for t in range(length - 1, -1, -1):
        backward[:, t] = after
        before = (after * local[:, t]) @ step.T
        before /= before.sum(1, keepdims=True)
        after = np.where(real[:, t, None], before, 1.0)  # behind a chain's end nothing is known
    both = forward * backward * real[:, :, None]
    both /= np.maximum(both.sum(2, keepdims=True), 1e-300)
    if not pairs:
        return both
    left, right = forward[:, :-1], (local * backward)[:, 1:]
    joint = left[:, :, :, None] * step[None, None] * right[:, :, None, :] * real[:, 1:, None, None]
    joint /= np.maximum(joint.sum((2, 3), keepdims=True), 1e-300)
    return both, joint.sum((0, 1))


def emissions(features: np.ndarray, start: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return np.add.reduceat(weights[features], start, axis=0) if len(start) else np.zeros((0, weights.shape[1]))


def fit(rows: list[tuple[str, str]], seed: int = 11) -> dict:
    """A model of texts and their languages.

    Chains are made by joining stretches of random texts, half of them in several
    languages, so the transitions learn to stay and to switch. Weights follow the
    gradient of the chains' likelihood with a rate per weight.
    """
    texts: dict[str, list[list[str]]] = {}
    for text, lang in rows:
        if found := words_of(text or ""):
            texts.setdefault(lang, []).append(found)
    langs = sorted(texts)
    lexicon = make_lexicon(texts)
    model = {"langs": langs, "lexicon": lexicon, "weights": np.zeros((SIZE + len(langs) + len(lexicon), max(1, len(langs)))),
             "step": np.zeros((len(langs), len(langs))), "start": np.zeros(len(langs))}
    if len(langs) < 2:
        return model
    vocabulary = sorted({w for of in texts.values() for words in of for w in words})
    number = {w: k for k, w in enumerate(vocabulary)}
    numbered = [[np.array([number[w] for w in words]) for words in texts[lang]] for lang in langs]
    features, start = word_features(vocabulary, lexicon)
    ends = np.append(start[1:], len(features))
    pick = np.random.default_rng(seed)
    chains, gold = np.empty((CHAINS, CHAIN), np.int64), np.empty((CHAINS, CHAIN), np.int64)
    for c in range(CHAINS):
        at, lang = 0, int(pick.integers(len(langs)))
        while at < CHAIN:
            words = numbered[lang][pick.integers(len(numbered[lang]))]
            take = int(min(CHAIN - at, pick.integers(6, CHAIN + 1), len(words)))
            first = int(pick.integers(len(words) - take + 1))
            chains[c, at:at + take], gold[c, at:at + take] = words[first:first + take], lang
            at += take
            if c % 2:
                lang = int(pick.integers(len(langs)))
    sums = {k: np.full_like(model[k], 1e-2) for k in ("weights", "step", "start")}
    hot, size = np.eye(len(langs)), np.full(100, CHAIN)
    for _ in range(PASSES):
        for batch in np.array_split(pick.permutation(CHAINS), CHAINS // 100):
            used, inverse = np.unique(chains[batch], return_inverse=True)
            count = ends[used] - start[used]
            mine = np.repeat(start[used] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
            feats = features[mine]
            scores = emissions(feats, np.concatenate([[0], np.cumsum(count)[:-1]]), model["weights"])[inverse.reshape(len(batch), CHAIN)]
            seen, moves = posteriors(scores, size[:len(batch)], model, True)
            truth = hot[gold[batch]]
            error = np.zeros((len(used), len(langs)))
            np.add.at(error, inverse.ravel(), (truth - seen).reshape(-1, len(langs)))
            touched, place = np.unique(feats, return_inverse=True)
            slope = np.zeros((len(touched), len(langs)))
            np.add.at(slope, place, np.repeat(error, count, axis=0))
            slope = slope / len(batch) - 1e-4 * model["weights"][touched]
            sums["weights"][touched] += slope * slope
            model["weights"][touched] += RATE * slope / np.sqrt(sums["weights"][touched])
            real_moves = np.einsum("btk,btl->kl", truth[:, :-1], truth[:, 1:])
            for name, slope in (("step", (real_moves - moves) / len(batch)), ("start", (truth[:, 0] - seen[:, 0]).mean(0))):
                sums[name] += slope * slope
                model[name] += RATE * slope / np.sqrt(sums[name])
    return model


class Labeller:
    """Word probabilities by a model, with the scores of words remembered."""

    def __init__(self, model: dict):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.model["langs"])))

    def _scores(self, words: list[str]) -> np.ndarray:
        if len(self.known) > _REMEMBERED:
            self.forget()
        found = list(map(self.known.get, words))
        if None in found:
            new = list({w for w, k in zip(words, found) if k is None})
            fresh = emissions(*word_features(new, self.model["lexicon"]), self.model["weights"])
            self.known.update(zip(new, range(len(self.scores), len(self.scores) + len(new))))
            self.scores = np.concatenate([self.scores, fresh])
            found = list(map(self.known.get, words))
        return self.scores[np.array(found, np.int64)]

    def label(self, texts: list[str]) -> Iterator[tuple[list[str], np.ndarray]]:
        """Each text's words and the probabilities of their languages.

        A line is a chain; a line of over ``SPAN`` words is a chain for each ``SPAN`` of them.
        """
        words, chains, bounds = [], [], [0]
        for text in texts:
            for line in text.split("\n"):
                found = words_of(line)
                for at in range(0, len(found), SPAN):
                    chains.append((len(words) + at, min(SPAN, len(found) - at)))
                words += found
            bounds.append(len(words))
        scores = self._scores(words)
        out = np.zeros_like(scores)
        chains = np.array(chains, np.int64).reshape(-1, 2)
        order = np.argsort(chains[:, 1], kind="stable")
        for block in np.array_split(order, max(1, len(order) // 512)) if len(order) else []:
            first, size = chains[block, 0], chains[block, 1]
            place = first[:, None] + np.minimum(np.arange(size.max()), size[:, None] - 1)
            seen = posteriors(scores[place], size, self.model)
            real = np.arange(size.max()) < size[:, None]
            out[place[real]] = seen[real]
        for a, b in zip(bounds, bounds[1:]):
            yield words[a:b], out[a:b]


def sample(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> list[tuple[str, str]]:
    """Texts and languages of at most ``SAMPLE`` rows of each language, the same ones for the same rows.

    Rows are taken in the order of a hash of their id, without null languages, null
    texts and texts of over ``SAMPLE_CHARS`` characters; rows that repeat an id and
    language count once.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where(
        f"lang is not null and doc_id is not null and length(text) <= {SAMPLE_CHARS}")
    # each language is ranked in parts, then in fewer, so that no task ranks more than PARTS / 8 times the sample after the first
    keys = rows.select("doc_id", "lang").distinct().select(
        "doc_id", "lang", F.expr("pmod(xxhash64(doc_id), 1000000007)").alias("draw"), F.expr(f"pmod(xxhash64(doc_id, 1), {PARTS})").alias("part"))
    chosen = keys
    for group in ("lang, part", "lang, pmod(part, 8)", "lang"):
        chosen = chosen.withColumn("rank", F.expr(f"row_number() over (partition by {group} order by draw, doc_id)")).where(f"rank <= {SAMPLE}").drop("rank")
    chosen = chosen.select("doc_id", "lang")
    # at most SAMPLE keys a language, the rows that the driver gets next: sent out, so that no text is shuffled
    found = rows.join(F.broadcast(chosen), ["doc_id", "lang"]).dropDuplicates(["doc_id", "lang"]).orderBy("lang", "doc_id")
    return [(r["text"], r["lang"]) for r in found.select("text", "lang").toLocalIterator()]


def predict(docs: DataFrame, model: dict, text: str = "text", lang: str = "lang_pred", score: str = "score", words: str | None = None) -> DataFrame:
    """The rows with the language that has the most probability over the words of their text, and its mean probability.

    Null texts, texts without a letter and all texts of a model without a language
    have ``und`` and 0. Ties go to the first language by name. ``words`` names a
    further column with every word, its likeliest language and that one's probability,
    for text that changes between languages. Whole texts are read; rows are
    independent. Columns of the names given for the results are replaced.
    """
    kept = docs.drop(lang, score, *[words] * bool(words))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    fields = [*kept.schema.fields, T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())]
    kind = pa.list_(pa.struct([("word", pa.string()), ("lang", pa.string()), ("score", pa.float64())]))
    if words:
        fields.append(T.StructField(words, T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())]))))

    def run(batches):
        labeller, langs = Labeller(sent.value), sent.value["langs"]
        for batch, texts in slices(batches, text, 1_000_000):
            preds, scores, labelled = [], [], []
            for found, seen in labeller.label(texts) if langs else (([], None) for _ in texts):
                mean = seen.mean(0) if found else None
                best = int(mean.argmax()) if found else 0
                preds.append(langs[best] if found else UNKNOWN)
                scores.append(min(1.0, float(mean[best])) if found else 0.0)
                if words:
                    labelled.append([{"word": w, "lang": langs[int(p.argmax())], "score": float(p.max())} for w, p in zip(found, seen)] if found else [])
            more = {lang: pa.array(preds, pa.string()), score: pa.array(scores, pa.float64())}
            if words:
                more[words] = pa.array(labelled, kind)
            yield with_columns(batch, more)

    return kept.mapInArrow(run, T.StructType(fields))
