"""Benchmark passages in documents, found by exact pieces and verified within an edit budget."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriframe.llm.shared import slices

#: Edits allowed for each character of an item.
BUDGET = 0.1
#: Characters of benchmark text that are broadcast at once; a larger benchmark takes several passes.
BLOCK_CHARS = 4_000_000
#: Characters of the grams that are counted before a distance is computed.
GRAM = 4


def normal(text: str | None) -> str:
    """Lower case, runs of white space as one space."""
    return " ".join((text or "").lower().split())


def budget(length: int, rate: float = BUDGET) -> int:
    return int(length * rate)


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """The item in ``errors + 1`` pieces of almost equal length, with their places: one stays whole if there are no more errors."""
    cut = [len(item) * k // (errors + 1) for k in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cut, cut[1:])]


def _symbols(pattern: str) -> dict[str, int]:
    found: dict[str, int] = {}
    for k, c in enumerate(pattern):
        found[c] = found.get(c, 0) | 1 << k
    return found


def closest(symbols: dict[str, int], length: int, text: str, most: int) -> tuple[int, int]:
    """Least edit distance of the pattern to any substring of the text, and the first place where such a one ends.

    Myers' bit-parallel columns: bit k of ``plus`` and ``minus`` says whether row
    k + 1 of the column is one more or less than row k. Answers ``most + 1`` if it is beyond that.
    """
    top, mask = 1 << (length - 1), (1 << length) - 1
    plus, minus, score, best, end = mask, 0, length, most + 1, -1
    for at, c in enumerate(text):
        equal = symbols.get(c, 0)
        across = (((equal & plus) + plus) ^ plus) | equal
        right_plus = minus | (mask & ~(across | plus))
        right_minus = plus & across
        if right_plus & top:
            score += 1
        elif right_minus & top:
            score -= 1
        right_plus = (right_plus << 1) & mask
        right_minus = (right_minus << 1) & mask
        down = equal | minus
        plus = right_minus | (mask & ~(down | right_plus))
        minus = right_plus & down
        if score < best:
            best, end = score, at + 1
            if not best:
                break
    return best, end


def _grams(text: str) -> list[str]:
    return [text[k:k + GRAM] for k in range(len(text) - GRAM + 1)]


class Finder:
    """The pieces of a block of items in one automaton."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items = [(k, text, budget(len(text), rate)) for k, text in items]
        self.symbols = [_symbols(text) for _, text, _ in self.items]
        self.grams = [_grams(text) for _, text, _ in self.items]
        self.automaton = ahocorasick.Automaton()
        owners: dict[str, list[tuple[int, int]]] = {}
        for n, (_, text, errors) in enumerate(self.items):
            for place, piece in pieces(text, errors):
                owners.setdefault(piece, []).append((n, place))
        for piece, of in owners.items():
            self.automaton.add_word(piece, (len(piece), of))
        self.automaton.make_automaton()

    def find(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """``item, start, end, distance`` of the closest passage of each item within its budget; places are those of a window around it in the normal text."""
        windows: dict[int, list[list[int]]] = {}
        for last, (size, of) in self.automaton.iter(text):
            for n, place in of:
                _, item, errors = self.items[n]
                start = last + 1 - size - place - errors
                end = last + 1 - size - place + len(item) + errors
                mine = windows.setdefault(n, [])
                if mine and start <= mine[-1][1] and end >= mine[-1][0]:
                    mine[-1][0], mine[-1][1] = min(start, mine[-1][0]), max(end, mine[-1][1])
                else:
                    mine.append([start, end])
        for n, mine in windows.items():
            item_id, item, errors = self.items[n]
            best = (errors + 1, 0, 0)
            for start, end in mine:
                start = max(0, start)
                there = set(_grams(text[start:end]))
                if sum(g in there for g in self.grams[n]) < len(self.grams[n]) - GRAM * errors:
                    continue  # an edit changes at most so many grams of the item
                distance, stop = closest(self.symbols[n], len(item), text[start:end], errors)
                if distance < best[0]:
                    best = (distance, max(start, start + stop - len(item) - errors), start + stop)
                    if not distance:
                        break
            if best[0] <= errors:
                yield item_id, best[1], best[2], best[0]


@lru_cache(maxsize=2)
def _finder(items: tuple[tuple[int, str], ...], rate: float) -> Finder:
    return Finder(list(items), rate)


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of at most ``BLOCK_CHARS`` (a longer item is a block), fetched one partition at a time."""
    block, held = [], 0
    rows = benchmark.select(F.col(item_id).cast("long"), F.col(text)).where(F.col(text).isNotNull() & F.col(item_id).isNotNull())
    for item, value in rows.toLocalIterator():
        if not (value := normal(value)):
            continue
        if block and held + len(value) > BLOCK_CHARS:
            yield block
            block, held = [], 0
        block.append((item, value))
        held += len(value)
    if block:
        yield block


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", rate: float = BUDGET) -> DataFrame:
    """Rows ``doc_id, item_id, start, end, distance``: documents that hold an item with at most ``rate`` edits per character.

    Both sides are compared in lower case with single spaces; ``start`` and ``end``
    frame the closest passage in that form (the first of equals). A document without
    a match gives no row; repeated documents give one row each. Null and empty
    texts and items, and items without an id, match nothing. Other columns are not
    read. The benchmark goes to the executors in blocks of bounded size, one pass each.
    """
    spark = docs.sparkSession
    kept = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = None
    for block in _blocks(benchmark, item_id, item_text):
        part = _found(kept, spark.sparkContext.broadcast(tuple(block)), rate)
        found = part if found is None else found.unionAll(part)
    return spark.createDataFrame([], SCHEMA) if found is None else found


SCHEMA = "doc_id long, item_id long, start int, end int, distance int"


def _found(docs: DataFrame, items, rate: float) -> DataFrame:
    def run(batches):
        finder = _finder(items.value, rate)
        for batch, texts in slices(batches, "text"):
            ids = batch.column(0)
            rows = [(ids[n].as_py(), *hit) for n, t in enumerate(texts) for hit in finder.find(normal(t))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()))],
                names=["doc_id", "item_id", "start", "end", "distance"])

    return docs.mapInArrow(run, SCHEMA)


def decontaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", rate: float = BUDGET) -> DataFrame:
    """The documents without a benchmark item, with all their columns; repeated rows and rows without an id are judged one by one."""
    spark = docs.sparkSession
    for block in _blocks(benchmark, item_id, item_text):
        docs = _clean(docs, spark.sparkContext.broadcast(tuple(block)), text, rate)
    return docs


def _clean(docs: DataFrame, items, text: str, rate: float) -> DataFrame:
    def run(batches):
        finder = _finder(items.value, rate)
        for batch, texts in slices(batches, text):
            yield batch.filter(pa.array([next(finder.find(normal(t)), None) is None for t in texts]))

    return docs.mapInArrow(run, docs.schema)
