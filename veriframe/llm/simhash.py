"""Near-duplicate documents by SimHash fingerprints, compared as bit slices."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriframe.llm.components import components
from veriframe.llm.shared import numbered, slices, stored, with_columns

BITS = 64
SEED = 42
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Bytes of one text whose words are held at once.
_BLOCK = 1 << 22
#: Rows compared at once at least, and members of a group beyond which it is dealt out in blocks.
_LANES = 1 << 15
GROUP = 4096


def _word_blocks(data: bytes, overlap: int) -> Iterator[list[bytes]]:
    """The words of a text in blocks; each block begins with the last words of the one before."""
    kept: list[bytes] = []
    start = 0
    while start < len(data):
        end = min(len(data), start + _BLOCK)
        while end < len(data) and data[end] not in b"\x20\x09\x0a\x0b\x0c\x0d":
            end += 1
        block = kept + data[start:end].split()
        yield block
        kept = block[len(block) - overlap:] if overlap and len(block) > overlap else block if overlap else []
        start = end


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of a text's word shingles as an unsigned number; no word gives zero."""
    data = (text or "").encode().translate(_LOWER)
    ones, total, rest = np.zeros(BITS, np.int64), 0, []
    for words in _word_blocks(data, shingle - 1):
        rest = words
        if len(words) < shingle:
            continue
        spread = [words[k:] for k in range(shingle)]
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(s), SEED) for s in zip(*spread)], np.uint64)
        total += len(hashes)
        ones += _ones(hashes)
    if not total:
        return xxhash.xxh64_intdigest(b" ".join(rest), SEED) if rest else 0
    return _majority(ones, total)


def _ones(hashes: np.ndarray) -> np.ndarray:
    """In how many hashes each bit is set."""
    ones = np.zeros(BITS, np.int64)
    for part in range(0, len(hashes), 1 << 16):
        piece = hashes[part:part + (1 << 16)]
        ones += np.unpackbits(piece.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return ones


def _majority(ones: np.ndarray, total: int) -> int:
    return int(np.packbits(ones * 2 > total, bitorder="little").view(np.uint64)[0])


def fingerprint_of(hashes: np.ndarray) -> int:
    """SimHash of shingle hashes as an unsigned number; none gives zero."""
    return _majority(_ones(hashes), len(hashes))


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3, out: str = "fingerprint") -> DataFrame:
    """The rows with their fingerprint as a signed long.

    A-Z are lower-cased, words are separated by ASCII white space, shingles are
    joined by one space and hashed with XXH64 (seed 42); a bit is set if it is set
    in over half of the hashes, repeats included. Null and empty texts get zero, a
    text shorter than a shingle is one shingle. A column of the same name is replaced.
    """
    kept = docs.drop(out)

    def run(batches):
        for batch, texts in slices(batches, text):
            found = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield with_columns(batch, {out: pa.array(found)})

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(out, T.LongType())]))


def _masks(radius: int, parts: int) -> list[int]:
    """Signed masks of every choice of blocks of which one must agree within the radius."""
    edges = [BITS * k // parts for k in range(parts + 1)]
    blocks = [((1 << edges[k + 1]) - 1) ^ ((1 << edges[k]) - 1) for k in range(parts)]
    masks = [sum(chosen) for chosen in combinations(blocks, parts - radius)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def _as_int(flags: np.ndarray) -> int:
    return int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")


def sliced_links(cell: np.ndarray, prints: np.ndarray, radius: int) -> np.ndarray:
    """Labels of rows (sorted by cell) so that rows linked within a cell share the smallest row number.

    Plane b is one long integer that holds bit b of every row. The rows are
    compared with themselves shifted by 1, 2, ...: a shift updates the distances
    of all lanes at once by carry-save addition into vertical counters, which start
    so that the carry out of the last one says "beyond the radius". A shift is
    abandoned once no lane is left within the radius.
    """
    n = len(prints)
    bits = np.unpackbits(prints.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    planes = [_as_int(bits[:, b]) for b in range(BITS)]
    width = max(2, (radius + 1).bit_length())
    first = (1 << width) - 1 - radius
    labels = np.arange(n)
    for shift in range(1, n):
        same = cell[:-shift] == cell[shift:]
        if not same.any():
            break
        alive = _as_int(same)
        counters = [alive if first >> k & 1 else 0 for k in range(width)]
        for at in range(0, BITS, 3):
            a, b, c = ((p ^ (p >> shift)) & alive for p in (*planes[at:at + 3], 0, 0)[:3])
            for level, carry in ((0, a ^ b ^ c), (1, (a & b) | (c & (a ^ b)))):
                for k in range(level, width):
                    if not carry:
                        break
                    counters[k], carry = counters[k] ^ carry, counters[k] & carry
                alive &= ~carry
            if not alive:
                break
        if alive:
            flags = np.unpackbits(np.frombuffer(alive.to_bytes((n + 7) // 8, "little"), np.uint8), bitorder="little")
            left = np.flatnonzero(flags[:n])
            labels = _joined(labels, left, left + shift)
    return labels


def _joined(labels: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Labels after joining the labels of the given rows pairwise."""
    pairs = np.stack([labels[left], labels[right]], 1)
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    if not len(pairs):
        return labels
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    for a, b in np.unique(pairs, axis=0).tolist():
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    swap = np.arange(len(labels))
    for x in parent:
        swap[x] = root(x)
    return swap[labels]


def links(prints: DataFrame, radius: int = 2, parts: int | None = None, column: str = "fingerprint") -> DataFrame:
    """Edges ``a, b`` that connect all distinct fingerprints within the radius.

    The bits are cut into ``parts`` blocks; fingerprints within the radius agree in
    at least ``parts - radius`` of them, so each choice of that many blocks is a
    group key. Groups of one are left out. A group of more than ``GROUP`` members
    is dealt out as pairs of its blocks, so no task holds more than two of them.
    Within a group the edges are a spanning forest of its links.
    """
    parts = parts or radius + 3
    keys = prints.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("choice"), F.col(column).bitwiseAND(F.lit(m)).alias("masked"), F.col(column).alias("print"))
        for k, m in enumerate(_masks(radius, parts))
    ])).alias("key")).select("key.*")
    shared = keys.groupBy("choice", "masked").agg(F.count("*").alias("members")).where("members > 1")
    dealt = (
        keys.join(shared, ["choice", "masked"])
        .withColumn("blocks", F.ceil(F.col("members") / GROUP).cast("int"))
        .withColumn("block", F.expr("cast(pmod(xxhash64(print), blocks) as int)"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .select(F.xxhash64("choice", "masked", F.least("block", "other"), F.greatest("block", "other")).alias("cell"), "print")
    )

    def flush(cells: np.ndarray, values: np.ndarray) -> pd.DataFrame:
        labels = sliced_links(cells, values, radius)
        moved = labels != np.arange(len(labels))
        return pd.DataFrame({"a": values[moved], "b": values[labels[moved]]}).query("a != b").drop_duplicates()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cells, values = np.empty(0, np.int64), np.empty(0, np.int64)
        for frame in frames:
            cells = np.concatenate([cells, frame["cell"].to_numpy(np.int64)])
            values = np.concatenate([values, frame["print"].to_numpy(np.int64)])
            if len(cells) >= _LANES and cells[0] != cells[-1]:
                cut = int(np.flatnonzero(cells != cells[-1])[-1]) + 1  # the last cell may go on
                yield flush(cells[:cut], values[:cut])
                cells, values = cells[cut:], values[cut:]
        if len(cells):
            yield flush(cells, values)

    return dealt.repartition("cell").sortWithinPartitions("cell").mapInPandas(run, "a long, b long")


def _rooted(prints: DataFrame, row: str, radius: int) -> DataFrame:
    """``fingerprint, least, root`` of the distinct fingerprints; ``least`` is the smallest value of the column ``row``."""
    nodes = prints.groupBy("fingerprint").agg(F.min(row).alias("least"))
    roots = components(links(nodes, radius))
    return nodes.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = 2, shingle: int = 3) -> DataFrame:
    """One row per document: ``doc_id, fingerprint`` (16 hex digits) and ``component_id``.

    Documents whose fingerprints differ in at most ``radius`` bits are linked;
    ``component_id`` is the smallest doc_id reachable. Texts without a word share
    the fingerprint zero. Equal fingerprints are one node, so a group of copies of
    any size costs one row per task. Repeated rows stay, each with its own result;
    a null doc_id is passed over by the minimum (null only if the component has no
    other). Other columns are not read. An empty table gives no row.
    """
    prints = stored(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", shingle).select("doc_id", "fingerprint"), "prints")
    rooted = _rooted(prints, "doc_id", radius)
    classes = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = rooted.join(classes, "root").select("fingerprint", "component_id")
    return prints.join(of_print, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def row_of(doc_id: str, text: str) -> Column:
    """What a row is told apart and ordered by: its id, rows without one last, then hashes of its text."""
    return F.expr(f"named_struct('none', `{doc_id}` is null, 'id', `{doc_id}`, 'one', xxhash64(`{text}`), 'other', xxhash64(1, `{text}`))")


def only(docs: DataFrame, rows: DataFrame, first: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The documents whose ``row`` is among the first ones, of rows that repeat id and text one; ``rows`` has that of all."""
    wanted = rows.groupBy("row").agg(F.count("*").alias("rows")).join(first.select("row"), "row", "left_semi")
    kept = stored(wanted.select("rows", "row.id", "row.one", "row.other"), "kept")
    plain, named = numbered(docs)
    hashed = plain.withColumns({"one": F.xxhash64(named[text]), "other": F.xxhash64(F.lit(1), named[text])})

    def among(part: DataFrame) -> DataFrame:
        same = (hashed["one"] == part["one"]) & (hashed["other"] == part["other"]) & hashed[named[doc_id]].eqNullSafe(part["id"])
        return hashed.join(part, same, "left_semi")

    single, several = among(kept.where("rows = 1")), among(kept.where("rows > 1"))
    return single.unionAll(several.dropDuplicates([named[doc_id], "one", "other"])).drop("one", "other").toDF(*docs.columns)


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = 2, shingle: int = 3) -> DataFrame:
    """One document of each component: that of the least id, then of the least hash of its text; those without an id come last.

    Rows are judged one by one, so rows that share an id but not the text, and rows
    without an id, each stay if their component has no earlier row.
    """
    rows = docs.select(row_of(doc_id, text).alias("row"), F.col(text).alias("text"))
    prints = stored(fingerprints(rows, "text", shingle).select("row", "fingerprint"), "prints")
    first = _rooted(prints, "row", radius).groupBy("root").agg(F.min("least").alias("row"))
    return only(docs, prints, first, doc_id, text)
