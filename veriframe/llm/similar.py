"""Near copies of texts by their word shingles: SimHash fingerprints, then min-hashes for what lies beyond their radius, each pair verified by its exact Jaccard similarity."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriframe.llm import simhash
from veriframe.llm.components import components
from veriframe.llm.shared import slices, stored, with_columns
from veriframe.llm.simhash import _LOWER, SEED, _word_blocks, only, row_of

SHINGLE = 5
#: The least similarity of a near copy, in hundredths.
LEAST = 80
#: Bits in which fingerprints of candidates differ at most, and blocks they are cut into: two of them agree, 28 keys of 16 bits.
RADIUS, BLOCKS = 6, 8
#: Keys of a text and min-hashes in each: a pair at 0.8 shares no key with a probability of (1 - 0.8^4)^32 = 4e-8.
BANDS, ROWS = 32, 4
_DRAW = np.random.default_rng(42)
_FLIPS = _DRAW.integers(0, 1 << 64, BANDS * ROWS, np.uint64)[:, None]
_FACTORS = _DRAW.integers(0, 1 << 64, BANDS * ROWS, np.uint64)[:, None] | np.uint64(1)
#: Pairs of a node that are verified together, about.
PART = 64
#: Members of a group beyond which it is dealt out in pairs of blocks.
GROUP = 1024


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles, words as in SimHash; a text shorter than one is one, no word gives none."""
    found, rest, whole = [], [], False
    for words in _word_blocks((text or "").encode().translate(_LOWER), shingle - 1):
        rest = words
        if len(words) >= shingle:
            whole = True
            spread = [words[k:] for k in range(shingle)]
            found.append(np.unique(np.array([xxhash.xxh64_intdigest(b" ".join(s), SEED) for s in zip(*spread)], np.uint64)))
    if not whole:
        found = [np.array([xxhash.xxh64_intdigest(b" ".join(rest), SEED)] if rest else [], np.uint64)]
    return np.unique(np.concatenate(found))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """A key for each band of min-hashes of a set that isn't empty."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for part in range(0, len(hashes), 256):
        mixed = (hashes[None, part:part + 256] ^ _FLIPS) * _FACTORS
        np.minimum(least, (mixed ^ (mixed >> np.uint64(32))).min(1), out=least)
    rows = np.concatenate([np.arange(BANDS, dtype=np.uint64)[:, None], least.reshape(BANDS, ROWS)], axis=1)
    return np.array([xxhash.xxh64_intdigest(r.tobytes()) for r in rows], np.uint64).view(np.int64)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _sketches(rows: DataFrame) -> DataFrame:
    """``row, node, n, fingerprint, keys``: the hash of a row's shingle set, its size, its SimHash and its min-hash keys."""
    schema = T.StructType([
        *rows.drop("text").schema.fields, T.StructField("node", T.LongType()), T.StructField("n", T.IntegerType()),
        T.StructField("fingerprint", T.LongType()), T.StructField("keys", T.ArrayType(T.LongType()))])

    def run(batches):
        for batch, texts in slices(batches, "text"):
            sets = [shingles(t) for t in texts]
            yield with_columns(batch.drop_columns(["text"]), {
                "node": pa.array([_signed(xxhash.xxh64_intdigest(s.tobytes())) for s in sets], pa.int64()),
                "n": pa.array([len(s) for s in sets], pa.int32()),
                "fingerprint": pa.array([_signed(simhash.fingerprint_of(s)) for s in sets], pa.int64()),
                "keys": pa.array([band_keys(s) if len(s) else [] for s in sets], pa.list_(pa.int64()))})

    return rows.mapInArrow(run, schema)


def _sets(texts: DataFrame) -> DataFrame:
    """``node, shingles`` of the rows ``node, text``."""
    def run(batches):
        for batch, found in slices(batches, "text", 1_000_000):
            yield with_columns(batch.drop_columns(["text"]), {"shingles": pa.array([shingles(t).view(np.int64) for t in found], pa.list_(pa.int64()))})

    return texts.mapInArrow(run, "node long, shingles array<long>")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose sets are alike enough.

    A node of many pairs is dealt out in parts of about ``PART`` pairs, each with the node's set, so
    no task gets all of them.
    """
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    spread = pairs.join(parts, "a").select("a", "b", F.pmod(F.xxhash64("b"), "parts").alias("part"))
    left = parts.select("a", F.explode(F.expr("sequence(0L, parts - 1L)")).alias("part")).join(
        sets.select(F.col("node").alias("a"), F.col("shingles").alias("s")), "a")
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("t"))
    both = spread.join(left, ["a", "part"]).join(right, "b").select("a", "b", F.expr("size(s) + size(t)").alias("total"), F.expr("size(array_intersect(s, t))").alias("shared"))
    return both.where(f"100 * cast(shared as long) >= {LEAST} * (cast(total as long) - shared)").select("a", "b")


def _sized(pairs: DataFrame) -> DataFrame:
    """The distinct pairs ``a, b`` whose sizes ``m, n`` leave the similarity possible."""
    return pairs.where(f"100 * cast(least(m, n) as long) >= {LEAST} * cast(greatest(m, n) as long)").select("a", "b").distinct()


def _by_fingerprint(nodes: DataFrame) -> DataFrame:
    """Pairs ``a, m, b, n`` that SimHash proposes among the nodes ``node, n, fingerprint``.

    The least node of a fingerprint meets the others of the same one, and the least ones
    of fingerprints that differ in at most ``RADIUS`` bits meet along links that connect all of these.
    """
    prints = stored(nodes.groupBy("fingerprint").agg(F.min(F.struct("node", "n")).alias("lead"), F.count("*").alias("nodes")), "prints")
    pair = [F.col("x.node").alias("a"), F.col("x.n").alias("m"), F.col("y.node").alias("b"), F.col("y.n").alias("n")]
    equal = nodes.select("fingerprint", F.struct("node", "n").alias("y")).join(
        prints.where("nodes > 1").select("fingerprint", F.col("lead").alias("x")), "fingerprint").where("x.node <> y.node")
    near = simhash.links(prints, RADIUS, BLOCKS)
    x, y = (prints.select(F.col("fingerprint").alias(end), F.col("lead").alias(name)) for end, name in (("a", "x"), ("b", "y")))
    return equal.select(*pair).unionAll(near.join(x, "a").join(y, "b").select(*pair))


def links(sketches: DataFrame, texts: DataFrame) -> DataFrame:
    """Edges ``a, b`` that connect all nodes that are alike and are proposed by SimHash or share a key; ``texts`` has ``row, text``.

    First come the pairs of SimHash. Fingerprints of a pair at 0.8 may differ in more bits than any
    radius with narrow groups allows, so min-hash keys follow for the rest: every member of a key is compared
    with its least one unless SimHash has connected them. Where that leaves
    members of a key in several components, those outside the least one's component are
    compared with all members, in cells of at most about twice ``GROUP`` sets; a cell
    answers with links that connect what is alike, not with all pairs. Keys with the same members are one.
    """
    nodes = stored(sketches.where("n > 0").select("node", "n", "fingerprint", "keys").distinct(), "nodes")
    proposed = stored(_sized(_by_fingerprint(nodes.select("node", "n", "fingerprint"))), "proposed")
    keys = stored(nodes.select("node", "n", F.explode("keys").alias("key")), "keys")
    shared = keys.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    met = stored(keys.join(shared, "key"), "met")
    involved = met.select("node").unionAll(proposed.select("a")).unionAll(proposed.select("b")).distinct()
    # copies are one row of each task before they meet
    one = sketches.groupBy("node").agg(F.min("row").alias("row")).join(involved, "node", "left_semi").select("node", "row.id", "row.one", "row.other")
    same = (F.xxhash64("text") == F.col("one")) & (F.xxhash64(F.lit(1), "text") == F.col("other")) & F.col("row.id").eqNullSafe(F.col("id"))
    found = texts.join(one, same).select("node", "text").dropDuplicates(["node"])
    sets = stored(_sets(found), "sets")
    printed = stored(_verified(proposed, sets), "alike")
    joined = stored(components(printed), "roots")
    rooted = met.join(joined, "node", "left").select("key", F.struct("node", "n", F.coalesce("root", "node").alias("root")).alias("y"))
    leads = rooted.groupBy("key").agg(F.min("y").alias("x"))
    starred = stored(_sized(rooted.join(leads, "key").where("x.root <> y.root").select(
        F.col("x.node").alias("a"), F.col("x.n").alias("m"), F.col("y.node").alias("b"), F.col("y.n").alias("n"))), "pairs")
    first = stored(printed.unionAll(_verified(starred, sets)), "alike")
    roots = stored(components(first), "roots")
    placed = met.select("key", "node", "n", "members").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    split = placed.groupBy("key").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.min_by("root", "node").alias("of_lead"), F.count("*").alias("all"),
        F.bit_xor(F.xxhash64("node")).alias("digest")).where("low <> high")
    once = split.groupBy("all", "digest", "of_lead").agg(F.min("key").alias("key"))
    rows = stored(placed.select("key", "node", "root").join(once.select("key", "of_lead", "all"), "key"), "split")
    outside = rows.where("root <> of_lead").groupBy("key").agg(F.count("*").alias("others"))

    def blocks(members: str) -> Column:
        return F.ceil(F.col(members) / GROUP).cast("long")

    sized = rows.join(outside, "key").select("key", "node", "root", "of_lead", blocks("others").alias("mine"), blocks("all").alias("theirs"))
    block = "pmod(xxhash64(node), {0})"
    cells = sized.where("root <> of_lead").selectExpr(
        "key", f"{block.format('mine')} as mine", "explode(sequence(0L, theirs - 1L)) as theirs", "true as outside", "node", "root").unionAll(
        sized.selectExpr("key", "explode(sequence(0L, mine - 1L)) as mine", f"{block.format('theirs')} as theirs", "false as outside", "node", "root"))
    second = cells.join(sets, "node").groupBy("key", "mine", "theirs").applyInPandas(_connected, "a long, b long").distinct()
    return stored(first.unionAll(second), "alike")


def _connected(cell: pd.DataFrame) -> pd.DataFrame:
    """Links between members of a cell that are alike and in different components so far: enough to connect them, at most one a component.

    Rows are ``outside, node, root, shingles``; each outside member's shared shingles
    are counted with all others at once, over the members that hold each shingle.
    """
    nodes, roots, sets = cell["node"].to_numpy(np.int64), cell["root"].to_numpy(np.int64), cell["shingles"].tolist()
    size = np.array([len(s) for s in sets])
    held = np.concatenate([np.asarray(s, np.int64) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(held, kind="stable")
    shingle, holders = held[order], owner[order]
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    links = []
    for k in np.flatnonzero(cell["outside"].to_numpy(bool)):
        mine = np.asarray(sets[k], np.int64)
        low, high = np.searchsorted(shingle, mine), np.searchsorted(shingle, mine, "right")
        many = high - low
        at = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum())
        shared = np.bincount(holders[at], minlength=len(sets))
        alike = np.flatnonzero((100 * shared >= LEAST * (size[k] + size - shared)) & (roots != roots[k]))
        _, first = np.unique(roots[alike], return_index=True)
        for other in alike[first]:
            x, y = find(int(roots[k])), find(int(roots[other]))
            if x != y:
                parent[x] = y
                links.append((int(min(nodes[k], nodes[other])), int(max(nodes[k], nodes[other]))))
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group of near copies: that of the least id, then of the least hash of its text; those without an id come last.

    Near copies are texts whose sets of five-word shingles have a Jaccard similarity
    of at least ``LEAST`` hundredths; a group is all that such pairs connect. Candidates
    come by SimHash, then by min-hashes. Texts
    without a word are equal. Rows are judged one by one, as in SimHash's.
    """
    rows = docs.select(row_of(doc_id, text).alias("row"), F.col(text).alias("text"))
    sketches = stored(_sketches(rows), "sketches")
    roots = components(links(sketches, rows))
    nodes = sketches.groupBy("node").agg(F.min("row").alias("row"))
    first = nodes.join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("row").alias("row"))
    return only(docs, sketches.select("row"), first, doc_id, text)
