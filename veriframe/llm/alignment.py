"""How two tokenizers cut the same texts: groups between common ends, linked ids, and how many documents hold each link.

Rows are shuffled by their full text, every distinct text is tokenised and aligned
once, counts of linked ids are weighted by how many documents have the text, and
the measures are joined back to the rows.
"""

from __future__ import annotations

import hashlib
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriframe.llm.shared import slices, stored

#: Characters of text that are tokenised at once.
BATCH_CHARS = 1_000_000
#: Pairs of ids whose counts are broadcast at once (17 bytes each); more of them take several passes.
BLOCK_PAIRS = 2_000_000
#: A text that more than this share of the rows have is joined by broadcast: fewer than 1 / FREQUENT texts can be.
FREQUENT = 1 / 1024
MEASURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
#: A pair of ids is one number: that of A times this plus that of B.
PAIR = 1 << 32


def _byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 for itself, the others from 256 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


def _flat(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tokens' sizes, their places in all bytes one after another, and those bytes."""
    size = np.array([len(t) for t in tokens])
    return size, np.cumsum(size) - size, np.frombuffer(b"".join(tokens), np.uint8)


def spells(ids: np.ndarray, size: np.ndarray, start: np.ndarray, everything: np.ndarray, want: np.ndarray) -> bool:
    """Whether the tokens' bytes, one after another, are the wanted ones."""
    sizes = size[ids]
    ends = np.cumsum(sizes)
    if (ends[-1] if len(ends) else 0) != len(want):
        return False
    return bool((everything[np.repeat(start[ids] - (ends - sizes), sizes) + np.arange(len(want))] == want).all())


class Aligner:
    """Both tokenizers, and the bytes of their tokens by id."""

    def __init__(self, a_json: bytes, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        alphabet, vocabulary = _byte_alphabet(), self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, k in vocabulary.items():
            self.a_bytes[k] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        self.b_bytes = [
            bytes([int(self.b.id_to_piece(k)[3:5], 16)]) if self.b.is_byte(k) else self.b.id_to_piece(k).replace("▁", " ").encode()
            for k in range(self.b.get_piece_size())]
        self.a_size, self.a_start, self.a_all = _flat(self.a_bytes)
        self.b_size, self.b_start, self.b_all = _flat(self.b_bytes)
        # A token's id as text with what follows it: in its group, at the end of A's part, at the end of the group.
        last = max(len(self.a_bytes), len(self.b_bytes))
        self.texts = [f"{k}{sign}" for sign in ",|;" for k in range(last)]
        self.stride = last

    def tokens(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The ids of a space and each text; both empty where the bytes of either are others."""
        a = self.a.encode_batch_fast([f" {t}" for t in texts], add_special_tokens=False)
        b = self.b.encode(texts, num_threads=1)
        out, none = [], np.zeros(0, np.int64)
        for text, left, right in zip(texts, a, b):
            left, right, want = np.array(left.ids, np.int64), np.array(right, np.int64), np.frombuffer(b" " + text.encode(), np.uint8)
            same = spells(left, self.a_size, self.a_start, self.a_all, want) and spells(right, self.b_size, self.b_start, self.b_all, want)
            out.append((left, right) if same else (none, none))
        return out

    def align(self, a: np.ndarray, b: np.ndarray) -> tuple[str, int, np.ndarray, np.ndarray]:
        """The groups as text, their number, the distinct linked pairs in order and how many occurrences link each.

        Cut the text where either tokenizer ends a token: every stretch between
        two cuts lies in one token of A and one of B, and no two stretches in the same two, so
        the stretches are the links. Groups end where both do.
        """
        if not len(a):
            return "", 0, np.zeros(0, np.int64), np.zeros(0, np.int64)
        a_ends, b_ends = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        ends = np.zeros(a_ends[-1] + 1, np.uint8)  # by byte: 1 where a token of A ends, 2 where one of B does
        ends[a_ends] = 1
        ends[b_ends] |= 2
        cuts = ends[np.flatnonzero(ends)]
        in_a, in_b, both = (cuts & 1) != 0, cuts >= 2, cuts == 3
        a_of, b_of, group = (np.cumsum(x) - x for x in (in_a, in_b, both))
        linked = np.sort(a[a_of] * PAIR + b[b_of])
        first = np.flatnonzero(np.append(True, linked[1:] != linked[:-1]))
        links = np.diff(first, append=len(linked))
        # A group's tokens of A come first: each is moved on by B's of earlier groups, each of B by A's up to its group.
        a_shift, b_shift = b_of[np.flatnonzero(both)], a_of[np.flatnonzero(both)] + 1
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + np.append(0, a_shift + 1)[group[in_a]]] = a + self.stride * both[in_a]
        codes[np.arange(len(b)) + b_shift[group[in_b]]] = b + 2 * self.stride * both[in_b]
        return "".join(map(self.texts.__getitem__, codes.tolist()))[:-1], len(b_shift), linked[first], links


@lru_cache(maxsize=1)
def _aligner(a_json: bytes, b_model: bytes) -> Aligner:
    return Aligner(a_json, b_model)


def _aligned(distinct: DataFrame, files, digest: bool) -> DataFrame:
    """Per distinct text ``text_key, rows, n_a, n_b, n_groups, n_links, groups, pairs, links``, without the text."""
    def run(batches):
        aligner = _aligner(*files.value)
        for batch, texts in slices(batches, "text", BATCH_CHARS):
            tokens = aligner.tokens(texts)
            found = [aligner.align(a, b) for a, b in tokens]
            groups = [hashlib.sha256(f[0].encode()).hexdigest() if digest and f[1] else f[0] for f in found]
            at = np.cumsum([0, *[len(f[2]) for f in found]]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(c, pa.int64()) for c in (
                    [len(a) for a, _ in tokens], [len(b) for _, b in tokens], [f[1] for f in found], [int(f[3].sum()) for f in found])],
                 pa.array(groups, pa.string()),
                 *[pa.ListArray.from_arrays(at, pa.array(np.concatenate([f[k] for f in found]), kind)) for k, kind in ((2, pa.int64()), (3, pa.int32()))]],
                names=["text_key", "rows", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "links"])

    return distinct.mapInArrow(
        run, "text_key binary, rows long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, links array<int>")


def _valued(aligned: DataFrame, counts: list, part: int) -> DataFrame:
    """``text_key, n_best, count_sum``: what the pairs of a block add to each text."""
    def run(batches):
        keys, values, best = counts[part].value
        for batch in batches:
            pairs, links = batch.column(1), batch.column(2)
            flat, many = pairs.flatten().to_numpy(), links.flatten().to_numpy().astype(np.int64)
            at = np.minimum(np.searchsorted(keys, flat), len(keys) - 1)
            known = keys[at] == flat
            sums = [np.cumsum(np.append(0, many * known * x[at])) for x in (best, values)]
            sizes = pairs.value_lengths().fill_null(0).to_numpy()
            ends = np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(s[ends] - s[ends - sizes]) for s in sums]], names=["text_key", "n_best", "count_sum"])

    return aligned.where("n_links > 0").select("text_key", "pairs", "links").mapInArrow(run, "text_key binary, n_best long, count_sum long")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, documents, best``: in how many documents each pair is linked, and whether no pair of its A id is in more."""
    counts = aligned.select("rows", F.explode("pairs").alias("pair")).groupBy("pair").agg(F.sum("rows").alias("documents"))
    counts = stored(counts, "pairs")
    top = counts.groupBy(F.expr(f"pair div {PAIR}").alias("a")).agg(F.max("documents").alias("most"))
    return counts.join(top, F.expr(f"pair div {PAIR} = a")).select("pair", "documents", (F.col("documents") == F.col("most")).alias("best"))


def _blocks(counts: DataFrame) -> list:
    """The counts in broadcasts of about ``BLOCK_PAIRS`` pairs: sorted pairs, their counts, and which are best."""
    spark, out = counts.sparkSession, []
    blocks = max(1, -(-counts.count() // BLOCK_PAIRS))
    for block in range(blocks):
        part = counts.where(F.expr(f"pmod(xxhash64(pair), {blocks}) = {block}")).toArrow()
        keys, values, best = (part.column(k).to_numpy() for k in range(3))
        order = np.argsort(keys)
        if len(keys):
            out.append(spark.sparkContext.broadcast((keys[order], values[order], best[order].astype(bool))))
    return out


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text", digest: bool = False) -> DataFrame:
    """The documents with ``n_a, n_b, n_groups, n_links, n_best, count_sum, groups``, in the place of columns of these names.

    A space and the text are encoded by the byte-level vocabulary at ``a_path``
    (a tokenizers file) and by the pieces at ``b_path`` (a sentencepiece model, which
    adds the space itself), without special tokens. ``groups`` lists the ids of both between
    common ends, ``a1,a2|b1;a3|b2,b3``, or its SHA-256 in hex with ``digest``. Links are the occurrences of overlapping tokens;
    ``count_sum`` adds up the documents that hold each link's pair of ids, repeated
    documents included, and ``n_best`` counts the links whose pair is the most common one of its A id, ties included.

    Null and empty texts, and texts whose tokens' bytes are not those of the space and the text, have zeros and ''.
    Every row gives one row, whatever its id.
    """
    spark = docs.sparkSession
    with open(a_path, "rb") as a, open(b_path, "rb") as b:
        files = spark.sparkContext.broadcast((a.read(), b.read()))
    column = F.col(f"`{text}`")
    full = docs.where(column.isNotNull() & (column != "")).select(column.alias("text"))
    distinct = full.groupBy("text").agg(F.count("*").alias("rows"))
    aligned = stored(_aligned(distinct.select(F.unhex(F.sha2("text", 256)).alias("text_key"), "rows", "text"), files, digest), "aligned")
    counts = _blocks(pair_counts(aligned))
    valued = None
    for part in range(len(counts)):
        more = _valued(aligned, counts, part)
        valued = more if valued is None else valued.unionAll(more)
    plain = aligned.select("text_key", "rows", "n_a", "n_b", "n_groups", "n_links", "groups")
    if valued is None:
        valued = spark.createDataFrame([], "text_key binary, n_best long, count_sum long")
    if len(counts) > 1:
        valued = valued.groupBy("text_key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    measures = stored(plain.join(valued, "text_key", "left").select(
        "text_key", "rows", "n_a", "n_b", "n_groups", "n_links", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")], "groups"), "measures")
    return _joined(docs, measures, text)


def _joined(docs: DataFrame, measures: DataFrame, text: str) -> DataFrame:
    """The measures of each row's text. A text of very many rows would fill one task: those go out by broadcast, bounded in number by ``FREQUENT``."""
    out = [*MEASURES, "groups"]
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in out]).alias("row")
    keyed = docs.select(row, F.when(F.col(f"`{text}`") != "", F.unhex(F.sha2(F.col(f"`{text}`"), 256))).alias("text_key"))
    total = measures.agg(F.sum("rows")).first()[0] or 0
    often = measures.where(F.col("rows") > total * FREQUENT).drop("rows")
    rest = measures.where(F.col("rows") <= total * FREQUENT).drop("rows")
    there = keyed.where("text_key is not null")
    small = F.broadcast(often)
    parts = [
        there.join(small, "text_key").select("row.*", *out),
        there.join(F.broadcast(often.select("text_key")), "text_key", "left_anti").join(rest, "text_key").select("row.*", *out),
        keyed.where("text_key is null").select("row.*", *[F.lit(0).cast("long").alias(c) for c in MEASURES], F.lit("").alias("groups")),
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])
