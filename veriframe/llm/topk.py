"""Exact top-k search by inner product, pruned by segment statistics from coarse to fine."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriframe.llm.shared import stored

SCALE = 1024
#: Vectors with larger components travel as doubles instead of whole numbers and are scored by ``best_of_large``.
LARGEST = 1 << 15
#: Where squares of the norm stay below it, no sum of products passes a long.
SQUARE = 1 << 62
#: Added to a score beyond a long, so that its digits sort like the score.
_SHIFT = 1 << 2200
#: Rows in a block of queries and of candidates, on average.
QUERY_BLOCK, BLOCK = 1024, 4096
#: Numbers of segments, coarse to fine.
LEVELS = (2, 8, 32)


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``vec_id, v, w``: distinct rows with whole components floor(1024 * x), as they are in ``v`` or, of
    vectors with a component over ``LARGEST``, divided by 1024 in ``w``; unusable vectors are left out."""
    good = F.expr("v is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))")
    small = f"forall(v, x -> abs(x) <= {LARGEST})"
    # from 2^52 on a double is a whole number
    whole = f"if(abs(x) < {1 << 52}, floor({SCALE} * if(abs(x) < {1 << 52}, x, 0D)) / {SCALE}D, x)"
    return (
        vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
        .where("vec_id is not null").where(good)
        .select("vec_id", F.expr(f"if({small}, transform(v, x -> cast(floor({SCALE} * if(abs(x) <= {LARGEST}, x, 0D)) as int)), null)").alias("small"),
                F.expr(f"if({small}, null, transform(v, x -> {whole}))").alias("w"))
        .select("vec_id", F.col("small").alias("v"), "w")
        .distinct())


def _stack(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.int64)


def statistics(vectors: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of equal segments, each times the root of its length; a last segment takes what is left over."""
    cut = np.linspace(0, vectors.shape[1], min(segments, vectors.shape[1]) + 1).astype(int)
    size = np.diff(cut)
    sums = np.add.reduceat(vectors, cut[:-1], axis=1).astype(float)
    squares = np.add.reduceat(vectors * vectors, cut[:-1], axis=1).astype(float)
    return sums / np.sqrt(size), np.sqrt(np.maximum(squares - sums * sums / size, 0))


def least_distances(queries: tuple[np.ndarray, np.ndarray], rows: tuple[np.ndarray, np.ndarray], q: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Lower bounds of the squared distances of the named pairs: in each segment, means and deviations each differ at least so much."""
    return ((queries[0][q] - rows[0][r]) ** 2).sum(1) + ((queries[1][q] - rows[1][r]) ** 2).sum(1)


def best_in_block(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> pd.DataFrame:
    """The k best scores of each query in a block of rows, ties to the smaller id.

    A score is (|q|^2 + |r|^2 - d^2) / 2, so a lower bound of the squared distance d^2
    bounds it from above. The first ``4 k`` rows by the coarsest bound are scored;
    their k-th score is what the others' bounds must reach at every level. Bounds
    get a margin for rounding; ties reach it and are kept.
    """
    order = np.argsort(ids, kind="stable")
    ids, rows = ids[order], rows[order]
    levels = [(statistics(queries, s), statistics(rows, s)) for s in LEVELS]
    q_square, r_square = (queries * queries).sum(1).astype(float), (rows * rows).sum(1).astype(float)
    (q_mean, q_dev), (r_mean, r_dev) = levels[0]
    out = []
    for start in range(0, len(query_ids), 128):
        q = slice(start, min(start + 128, len(query_ids)))
        numbers = np.arange(q.start, q.stop)
        # the coarsest level for all pairs at once, by the binomial formula
        lower = (q_square[q, None] - 2 * (q_mean[q] @ r_mean.T + q_dev[q] @ r_dev.T) + r_square[None, :])
        upper = (q_square[q, None] + r_square[None, :] - lower) / 2
        margin = 1 + 1e-9 * (q_square[q, None] + r_square[None, :])
        upper += margin
        own = ids[None, :] == query_ids[q, None]
        upper[own] = -np.inf
        floor = np.full(len(numbers), -np.inf)
        if len(ids) > 4 * k:
            seeds = np.argpartition(-upper, 4 * k, axis=1)[:, :4 * k]
            scores = np.einsum("qd,qsd->qs", queries[q], rows[seeds]).astype(float)
            scores[np.take_along_axis(own, seeds, 1)] = -np.inf
            floor = np.sort(scores, axis=1)[:, -k]
        at, r = np.nonzero((upper >= floor[:, None]) & ~own)
        for (qs, rs) in levels[1:]:
            bound = (q_square[numbers[at]] + r_square[r] - least_distances(qs, rs, numbers[at], r)) / 2
            keep = bound + 1 + 1e-9 * (q_square[numbers[at]] + r_square[r]) >= floor[at]
            at, r = at[keep], r[keep]
        score = (queries[numbers[at]] * rows[r]).sum(1)
        best = np.lexsort((ids[r], -score, at))
        at, r, score = at[best], r[best], score[best]
        first = np.searchsorted(at, np.arange(len(numbers)))
        place = np.arange(len(at)) - first[at]
        keep = place < k
        out.append(pd.DataFrame({"query_id": query_ids[numbers[at[keep]]], "vec_id": ids[r[keep]], "score": score[keep]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def _whole(x: float) -> int:
    return int(x * SCALE) if abs(x) < 1e300 else int(x) * SCALE


def best_of_large(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """``query_id, vec_id, score``: the k best rows of each query, of components divided by 1024 and of any finite size.

    Products of doubles, with what rounding may add or take, say which rows can be
    among the k best; these are scored in whole numbers of any length.
    """
    if not len(query_ids) or not len(ids):
        return []
    scaled = np.ldexp(rows, -int(np.frexp(np.abs(rows).max())[1]))
    lengths = np.sqrt((scaled * scaled).sum(1))
    whole: dict[int, list[int]] = {}
    out = []
    for query_id, query in zip(query_ids.tolist(), queries):
        own = np.flatnonzero(ids != query_id)
        if not len(own):
            continue
        near = np.ldexp(query, -int(np.frexp(np.abs(query).max())[1]))
        score = scaled[own] @ near
        off = (len(near) + 8) * 2.0 ** -50 * lengths[own] * np.sqrt((near * near).sum()) + 1e-150
        least = np.sort(score - off)[-k] if len(own) > k else -np.inf
        wanted = [_whole(x) for x in query.tolist()]
        found = []
        for r in own[score + off >= least].tolist():
            if r not in whole:
                whole[r] = [_whole(x) for x in rows[r].tolist()]
            found.append((-sum(x * y for x, y in zip(wanted, whole[r])), int(ids[r])))
        out += [(query_id, i, -s) for s, i in sorted(found)[:k]]
    return out


def _told(found: list[tuple[int, int, int]]) -> pd.DataFrame:
    """Rows of scores: those beyond a long are null, with the side and digits that sort like them."""
    fits = [-(1 << 63) <= s < 1 << 63 for _, _, s in found]
    return pd.DataFrame({
        "query_id": pd.array([q for q, _, _ in found], "Int64"), "vec_id": pd.array([i for _, i, _ in found], "Int64"),
        "score": pd.array([s if ok else None for (_, _, s), ok in zip(found, fits)], "Int64"),
        "beyond": pd.array([0 if ok else 1 if s > 0 else -1 for (_, _, s), ok in zip(found, fits)], "Int32"),
        "digits": pd.Series([None if ok else f"{s + _SHIFT:0552x}" for (_, _, s), ok in zip(found, fits)], dtype=object)})


def _split(vectors: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which rows have a square that surely fits; their components as whole numbers, those of all rows divided by 1024."""
    small = vectors["v"].notna().to_numpy()
    length = [np.abs(np.asarray(v, np.int64)).max() if ok else 0 for v, ok in zip(vectors["v"], small)]
    small &= np.array([len(v) * int(m) ** 2 < SQUARE if ok else False for v, m, ok in zip(vectors["v"], length, small)], bool)
    whole = _stack(vectors["v"][small]) if small.any() else np.empty((0, 0), np.int64)
    parts = np.empty((0, 0)) if small.all() else np.array([np.asarray(w, float) if w is not None else np.asarray(v, float) / SCALE for v, w in zip(vectors["v"], vectors["w"])])
    return small, whole, parts


def best_of_any(query_ids: np.ndarray, wanted: pd.DataFrame, ids: np.ndarray, candidates: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best scores of each query among the rows whose products fit a long, and the k best among all other pairs."""
    q_small, q_whole, q_parts = _split(wanted)
    r_small, r_whole, r_parts = _split(candidates)
    out = []
    if q_small.any() and r_small.any():
        best = best_in_block(query_ids[q_small], q_whole, ids[r_small], r_whole, k).astype("int64")
        out.append(best.assign(beyond=0, digits=None))
    if not (q_small.all() and r_small.all()):
        q_parts = q_parts if len(q_parts) else q_whole / SCALE
        r_parts = r_parts if len(r_parts) else r_whole / SCALE
        found = best_of_large(query_ids[~q_small], q_parts[~q_small], ids, r_parts, k)
        found += best_of_large(query_ids[q_small], q_parts[q_small], ids[~r_small], r_parts[~r_small], k)
        out.append(_told(found))
    return out[0] if len(out) == 1 else pd.concat([o.astype({"query_id": "Int64", "vec_id": "Int64", "score": "Int64", "beyond": "Int32", "digits": object}) for o in out])


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k rows of greatest inner product with each query, ``query_id, rank, vec_id, score``.

    Components are floor(1024 * x); ties go to the smaller vec_id; rows with the
    query's own id are no candidates. Vectors that are null, empty or hold null,
    non-finite or very large components (over ``LARGEST``) take no part, nor do rows
    without an id; rows that repeat an id and its vector are one. Only vectors of
    equal length meet. Other columns are not read.

    Components may have any finite size: where the norms don't prove that the products fit a
    long, rows are scored in whole numbers of any length. A score beyond a long is
    null, its rank is right.

    Rows are dealt by hash to blocks of about ``BLOCK``, queries to blocks of about
    ``QUERY_BLOCK``, and each pair of blocks is one small task; of every block a query
    gets at most k rows, which are ranked at the end.
    """
    rows = stored(usable(vectors, vec_id, vector).withColumn("n", F.expr("if(v is null, size(w), size(v))")), "vectors")
    asked = stored(usable(queries, vec_id, vector).withColumn("n", F.expr("if(v is null, size(w), size(v))")), "asked")
    blocks = max(1, -(-rows.count() // BLOCK))
    query_blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    left = rows.select("n", "vec_id", "v", "w", F.expr(f"cast(pmod(xxhash64(vec_id, v, w), {blocks}) as int)").alias("block"),
                       F.explode(F.expr(f"sequence(0, {query_blocks - 1})")).alias("query_block"))
    right = asked.select("n", "vec_id", "v", "w", F.expr(f"cast(pmod(xxhash64(vec_id, v, w), {query_blocks}) as int)").alias("query_block"),
                         F.explode(F.expr(f"sequence(0, {blocks - 1})")).alias("block"))

    def compare(candidates: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        if not len(candidates) or not len(wanted):
            return _told([])
        return best_of_any(wanted["vec_id"].to_numpy(), wanted, candidates["vec_id"].to_numpy(), candidates, k)

    key = ["n", "block", "query_block"]
    met = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(compare, "query_id long, vec_id long, score long, beyond int, digits string")
    ranked = met.withColumn("rank", F.expr("row_number() over (partition by query_id order by beyond desc, score desc, digits desc, vec_id)"))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
