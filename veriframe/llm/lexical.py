"""Ranked lexical search: each item's best documents by branch and bound over trees of term vectors.

A task cuts its documents into trees. A document's vector is restricted to the terms
of the items and ordered by how many documents hold a term, so that common terms
come first and documents with the same ones share a path. Every node knows the
most occurrences of each term and the least length factor below it; both bound the
score of all its documents, and an item descends only where the bound can still
reach its ten best.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veriframe.llm.shared import slices, stored

#: Characters of items that are broadcast at once; more of them take several passes.
BLOCK_CHARS = 1_000_000
#: Terms of the items that share a tree, and documents in it: what bounds a tree's matrices.
TREE_TERMS, TREE_DOCS = 4096, 4096
#: Documents in a leaf.
LEAF = 64
# Fixed values of the score.
SCALE, HUNDRED, SHARE, TF_SCALE, TF_WEIGHT, M_WEIGHT = 1000, 100, 90, 1_000_000_000, 1000, 8
# Bytes of a term as lower case, others as spaces: every byte beyond ASCII belongs to a term.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order: runs of ASCII letters, digits and anything beyond ASCII; only A-Z are lower-cased."""
    return (text or "").encode().translate(_TABLE).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(SCALE * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _blocks(items: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[int, list[bytes]]]]:
    """The items with a term in blocks of at most ``BLOCK_CHARS``, fetched one partition at a time; equal rows are one."""
    block, held = [], 0
    rows = items.select(F.col(item_id).cast("long").alias("item"), F.col(text).alias("text")).where("item is not null and text is not null").distinct()
    for item, value in rows.toLocalIterator():
        if not (found := sorted(set(terms(value)))):
            continue
        if block and held + len(value) > BLOCK_CHARS:
            yield block
            block, held = [], 0
        block.append((item, found))
        held += len(value)
    if block:
        yield block


def _vectors(docs: DataFrame, vocabulary) -> DataFrame:
    """``doc_id, n, terms, tfs`` of the documents that have a term: their length, and the numbers and occurrences of the items' terms."""
    def run(batches):
        number = vocabulary.value
        for batch, texts in slices(batches, "text"):
            rows, n, ids, tfs = [], [], [], []
            for row, text in enumerate(texts):
                found = terms(text)
                if not found:
                    continue
                counts = Counter([k for t in found if (k := number.get(t)) is not None])
                rows.append(row)
                n.append(len(found))
                ids.append(list(counts))
                tfs.append(list(counts.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(n, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))],
                names=["doc_id", "n", "terms", "tfs"])

    return docs.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


class Tree:
    """Documents as rows of a matrix of occurrences, sorted by path; nodes are ranges of rows.

    ``order`` numbers the terms from the most common one, which is column 0. ``tf``
    is documents by terms. A node is a range ``low, high`` of rows that share a
    prefix of their paths; siblings with few documents share a leaf. ``most`` holds a node's tf
    maxima and ``least`` its minimum of ``m``.
    """

    def __init__(self, paths: list[np.ndarray], tfs: list[np.ndarray], m: np.ndarray, ids: np.ndarray, width: int):
        at = sorted(range(len(paths)), key=lambda k: paths[k].tolist())
        self.paths = [paths[k] for k in at]
        self.m, self.ids = m[at], ids[at]
        self.tf = np.zeros((len(at), width), np.int32)
        for row, k in enumerate(at):
            self.tf[row, paths[k]] = tfs[k]
        self.low, self.high, self.children = [], [], []
        self.root = self._node(0, len(at), 0)
        self.most = np.stack([self.tf[a:b].max(0) for a, b in zip(self.low, self.high)])
        self.least = np.array([self.m[a:b].min() for a, b in zip(self.low, self.high)])

    def _node(self, low: int, high: int, depth: int) -> int:
        number = len(self.low)
        self.low.append(low)
        self.high.append(high)
        self.children.append(None)
        todo = [(number, depth)]
        while todo:  # no recursion: a path is as long as a document has terms
            node, depth = todo.pop()
            a, b = self.low[node], self.high[node]
            if b - a <= LEAF:
                continue
            parts, depth = self._split(a, b, depth)
            kids = []
            for start, stop, on in parts:
                kids.append(len(self.low))
                self.low.append(start)
                self.high.append(stop)
                self.children.append(None)
                if on:
                    todo.append((kids[-1], depth + 1))
            self.children[node] = np.array(kids)
        return number

    def _split(self, low: int, high: int, depth: int) -> tuple[list[tuple[int, int, bool]], int]:
        """The ranges below a node and whether they go on: one for each next term, small neighbours together; a path that all share is passed over."""
        while True:
            heads = np.array([p[depth] if len(p) > depth else -1 for p in self.paths[low:high]])
            if heads[0] != heads[-1] or heads[0] < 0:
                break
            depth += 1
        if heads[-1] < 0:  # equal paths that all end here
            return [(k, min(k + LEAF, high), False) for k in range(low, high, LEAF)], depth
        cuts = [low, *(np.flatnonzero(heads[1:] != heads[:-1]) + 1 + low).tolist(), high]
        parts, start = [], low
        for a, b in zip(cuts, cuts[1:]):
            if b - a > LEAF:
                if start < a:
                    parts.append((start, a, False))
                if heads[a - low] < 0:
                    parts += [(k, min(k + LEAF, b), False) for k in range(a, b, LEAF)]
                else:
                    parts.append((a, b, True))
                start = b
            elif b - start > LEAF:
                parts.append((start, a, False))
                start = a
        if start < high:
            parts.append((start, high, False))
        return parts, depth

    def search(self, columns: np.ndarray, weights: np.ndarray, best: list[tuple[int, int]], k: int) -> list[tuple[int, int]]:
        """The best ``k`` of the given ones and the tree's documents, as ``(-score, doc_id)`` in order."""
        def scores(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
            tf = tf.astype(np.int64)
            return (TF_SCALE * tf // np.maximum(TF_WEIGHT * tf + M_WEIGHT * m[:, None], 1)) @ weights

        least = -best[-1][0] if len(best) == k else 1
        todo = [(int(scores(self.most[[self.root]][:, columns], self.least[[self.root]])[0]), self.root)]
        while todo:
            bound, node = todo.pop()
            if bound < least:
                continue
            kids = self.children[node]
            if kids is None:
                a, b = self.low[node], self.high[node]
                found = scores(self.tf[a:b, columns], self.m[a:b])
                good = np.flatnonzero(found >= least)
                if len(good):
                    best = sorted([*best, *zip((-found[good]).tolist(), self.ids[a:b][good].tolist())])[:k]
                    least = -best[-1][0] if len(best) == k else 1
                continue
            bounds = scores(self.most[np.ix_(kids, columns)], self.least[kids])
            on = np.flatnonzero(bounds >= least)
            todo += [(int(bounds[n]), int(kids[n])) for n in on[np.argsort(bounds[on], kind="stable")]]
        return best


def _groups(items: list[tuple[int, list[int]]]) -> Iterator[tuple[list[tuple[int, list[int]]], list[int]]]:
    """The items in runs of at most ``TREE_TERMS`` distinct terms (an item with more is a run), and those terms."""
    run, held = [], set()
    for item, mine in items:
        if run and len(held.union(mine)) > TREE_TERMS:
            yield run, sorted(held)
            run, held = [], set()
        run.append((item, mine))
        held.update(mine)
    if run:
        yield run, sorted(held)


def _best(vectors: DataFrame, block, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """``item_id, doc_id, score``: of every task the best ``k`` documents of each item."""
    def run(batches):
        items, df = block.value
        groups = []
        for mine, used in _groups([(n, of) for n, (_, of) in enumerate(items)]):  # by place: items may share an id
            place = {t: c for c, t in enumerate(sorted(used, key=lambda t: (-df[t], t)))}  # the most common first
            columns = np.full(len(df), -1)
            columns[list(place)] = list(place.values())
            groups.append((columns, len(place), [
                (n, np.array([place[t] for t in of]), np.array([weight(n_docs, int(df[t])) for t in of])) for n, of in mine]))
        best: dict[int, list[tuple[int, int]]] = {n: [] for n in range(len(items))}
        for rows in _of_size(batches):
            ids = np.array([r[0] for r in rows])
            m = np.array([HUNDRED - SHARE + SHARE * r[1] * n_docs // n_terms for r in rows], np.int64)
            for columns, width, mine in groups:
                paths, tfs = [], []
                for _, _, of, tf in rows:
                    at = columns[of]
                    there = np.flatnonzero(at >= 0)
                    there = there[np.argsort(at[there])]
                    paths.append(at[there])
                    tfs.append(tf[there])
                tree = Tree(paths, tfs, m, ids, width)
                for n, where, weights in mine:
                    best[n] = tree.search(where, weights, best[n], k)
        found = [(items[n][0], doc, -score) for n, mine in best.items() for score, doc in mine]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["item_id", "doc_id", "score"])

    return vectors.mapInArrow(run, "item_id long, doc_id long, score long")


def _of_size(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, int, np.ndarray, np.ndarray]]]:
    """The rows with an id and a term of an item, ``TREE_DOCS`` at a time."""
    rows = []
    for batch in batches:
        ids, n = batch.column(0), batch.column(1)
        terms_of, tfs = batch.column(2), batch.column(3)
        at = terms_of.offsets.to_numpy()
        flat, many = terms_of.values.to_numpy(), tfs.values.to_numpy()
        low = tfs.offsets.to_numpy()
        for r in range(batch.num_rows):
            if ids[r].is_valid and at[r + 1] > at[r]:
                rows.append((ids[r].as_py(), n[r].as_py(), flat[at[r]:at[r + 1]], many[low[r]:low[r] + at[r + 1] - at[r]]))
                if len(rows) == TREE_DOCS:
                    yield rows
                    rows = []
    if rows:
        yield rows


def search(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item, equal scores by the smaller id.

    All documents count for the statistics and are searched, by their whole texts;
    those without an id are counted but not returned. Rows that repeat an id are
    judged one by one and may both be returned. Null and empty texts have no term and are
    not counted; an item without a term, without an id or without a document gives
    no row, and an item that is repeated word for word counts once. Items that
    share an id are ranked together. Other columns are not read.

    Texts are read once for each block of items; each task keeps ``k`` documents an
    item, which are all that is shuffled.
    """
    spark = docs.sparkSession
    kept = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = None
    for block in _blocks(items, item_id, item_text):
        names = sorted({t for _, mine in block for t in mine})
        number = {t: n for n, t in enumerate(names)}
        vectors = stored(_vectors(kept, spark.sparkContext.broadcast(number)), "vectors")
        n_docs, n_terms = vectors.agg(F.count("*"), F.sum("n")).first()
        df = np.zeros(len(names), np.int64)  # at most one number for each term of the block
        for term, count in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            df[term] = count
        numbered = [(item, [number[t] for t in mine if df[number[t]]]) for item, mine in block]
        part = _best(vectors, spark.sparkContext.broadcast(([i for i in numbered if i[1]], df)), n_docs, n_terms, k)
        found = part if found is None else found.unionAll(part)
    if found is None:
        return spark.createDataFrame([], SCHEMA)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


SCHEMA = "item_id long, rank int, doc_id long, score long"
