"""Byte-level BPE by rank, many words at a time in padded matrices."""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from veriframe.llm.shared import slices, with_columns

_NONE = np.int32(2**31 - 1)
#: Words of more bytes are merged one by one with a heap; the others by matrices as wide as these.
_WIDTHS = (4, 8, 12, 16, 24, 32, 64, 128)
_WIDTH_OF = [next(w for w in _WIDTHS if n <= w) for n in range(_WIDTHS[-1] + 1)]
#: Prefixes that name a run of text: one match, a whole text without a space, the word before a text's first space. Other names have no space.
_MATCH, _WHOLE, _FIRST = "   ", "  ", " "
#: Rows of a matrix, and names that a worker remembers.
_ROWS = 1 << 14
_WORDS = 400_000


def unicode_pattern(pattern: str) -> str:
    r"""The pattern with ``\s`` spelt out as the Unicode property, since ``regex`` counts four control characters as space."""
    return pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")


class Vocabulary:
    """Token bytes by id, and the ids of mergeable pairs in a hash table."""

    def __init__(self, ranks: bytes, pattern: str):
        pairs = [line.split() for line in ranks.splitlines() if line]
        self.ids = {base64.b64decode(a): int(b) for a, b in pairs}
        self.split = regex.compile(unicode_pattern(pattern)).findall
        self.byte_id = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)
        size = max(self.ids.values()) + 1
        tokens = [b""] * size
        for token, k in self.ids.items():
            tokens[k] = token
        self.tokens = tokens
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)
        self.offset = np.concatenate([[0], np.cumsum([len(t) for t in tokens])])
        self._hash_pairs()
        self.forget()

    def _hash_pairs(self) -> None:
        left, right, merged = [], [], []
        for token, k in self.ids.items():
            for cut in range(1, len(token)):
                a, b = self.ids.get(token[:cut]), self.ids.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), merged.append(k)
        keys = np.array(left, np.int64) << 32 | np.array(right, np.int64)
        values = np.array(merged, np.int32)
        self.shift = np.uint64(64 - max(4, (2 * len(keys)).bit_length()))
        size = 1 << int(64 - self.shift)
        self.keys, self.values, self.probes = np.full(size, -1, np.int64), np.full(size, _NONE, np.int32), 0
        slot, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[slot[todo]] < 0]
            self.keys[slot[free]] = keys[free]  # of those that want one slot, one stays
            placed = self.keys[slot[todo]] == keys[todo]
            self.values[slot[todo[placed]]] = values[todo[placed]]
            todo = todo[~placed]
            slot[todo] = (slot[todo] + 1) & (size - 1)
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of the token that a pair becomes; padding and unknown pairs get the largest number."""
        keys = (left.astype(np.int64) << 32 | right.astype(np.int64)).ravel()
        out = np.full(len(keys), _NONE, np.int32)
        todo = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        slot = self._slot(keys[todo])
        for _ in range(self.probes):
            there = self.keys[slot]
            hit = there == keys[todo]
            out[todo[hit]] = self.values[slot[hit]]
            on = ~hit & (there >= 0)
            if not on.any():
                break
            todo, slot = todo[on], (slot[on] + 1) & (len(self.keys) - 1)
        return out.reshape(left.shape)

    def merge_rows(self, words: list[bytes], width: int) -> np.ndarray:
        """Ids of words of at most ``width`` bytes, padded by -1. Each round, every row merges its leftmost pair of least rank; rows without one leave."""
        data = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
        size = np.array([len(w) for w in words])
        ids = np.where(np.arange(width) < size[:, None], self.byte_id[data], -1).astype(np.int32)
        out = np.full((len(words), width), -1, np.int32)
        number, column = np.arange(len(words)), np.arange(width - 1)
        ranks = self.merged(ids[:, :-1], ids[:, 1:])
        while len(number):
            at = ranks.argmin(1)
            best = ranks[np.arange(len(at)), at]
            done = best == _NONE
            if done.any():
                out[number[done], :ids.shape[1]] = ids[done]
                go = ~done
                number, ids, ranks, at, best = number[go], ids[go], ranks[go], at[go], best[go]
                if not len(number):
                    break
            rows = np.arange(len(at))
            ids[rows, at] = best
            beyond = column[:ids.shape[1] - 1] > at[:, None]
            ids[:, :-1] = np.where(beyond, ids[:, 1:], ids[:, :-1])
            ids[:, -1] = -1
            ranks[:, :-1] = np.where(beyond[:, :-1], ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = _NONE
            if ids.shape[1] > 2:  # every row has lost an id
                ids, ranks = ids[:, :-1], ranks[:, :-1]
            last = ids.shape[1] - 1
            right = np.where(at < last, ids[rows, np.minimum(at + 1, last)], -1)
            here = at < ranks.shape[1]
            ranks[rows[here], at[here]] = self.merged(best[here], right[here])
            inner = at > 0
            ranks[rows[inner], at[inner] - 1] = self.merged(ids[rows[inner], at[inner] - 1], best[inner])
        return out

    def merge_long(self, word: bytes) -> list[int]:
        """Ids of one word of any length: the same merges, taken from a heap by rank and place."""
        ids = self.byte_id[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        pairs = {}

        def rank(a: int, b: int) -> int:
            if (a, b) not in pairs:
                pairs[a, b] = self.ids.get(self.tokens[a] + self.tokens[b], int(_NONE))
            return pairs[a, b]

        heap = [(r, k, ids[k], ids[k + 1]) for k in range(n - 1) if (r := rank(ids[k], ids[k + 1])) != _NONE]
        heapq.heapify(heap)
        while heap:
            r, k, a, b = heapq.heappop(heap)
            nxt = after[k]
            if ids[k] != a or nxt < 0 or ids[nxt] != b:
                continue
            ids[k], ids[nxt] = r, -1
            after[k] = after[nxt]
            if after[nxt] >= 0:
                before[after[nxt]] = k
            for p in (before[k], k):
                if p >= 0 and after[p] >= 0 and (r := rank(ids[p], ids[after[p]])) != _NONE:
                    heapq.heappush(heap, (r, p, ids[p], ids[after[p]]))
        return [x for x in ids if x >= 0]

    def forget(self) -> None:
        """Drop what is remembered: runs of text by name, and matches of the pattern by name, each as a run of ids."""
        self.chunks, self.chunk_start, self.chunk_ids = {}, np.zeros(1, np.int64), np.empty(0, np.int32)
        self.matches, self.match_start, self.match_ids = {}, np.zeros(1, np.int64), np.empty(0, np.int32)

    def _learn_matches(self, new: list[str]) -> None:
        data = [w.encode() for w in new]
        single: dict[int, list[int]] = {}
        by_width: dict[int, list[int]] = {}
        for k, word in enumerate(data):
            whole = self.ids.get(word)
            if whole is not None:
                single[k] = [whole]
            elif len(word) > _WIDTHS[-1]:
                single[k] = self.merge_long(word)
            else:
                by_width.setdefault(_WIDTH_OF[len(word)], []).append(k)
        order, flat, sizes = list(single), [np.array([x for v in single.values() for x in v], np.int32)], [[len(v) for v in single.values()]]
        for width, members in by_width.items():
            for part in range(0, len(members), _ROWS):
                piece = members[part:part + _ROWS]
                found = self.merge_rows([data[k] for k in piece], width)
                real = found >= 0
                order += piece
                flat.append(found[real])
                sizes.append(real.sum(1))
        first = len(self.matches)
        self.matches.update(zip((new[k] for k in order), range(first, first + len(new))))
        self.match_start = np.concatenate([self.match_start, self.match_start[-1] + np.cumsum(np.concatenate(sizes), dtype=np.int64)])
        self.match_ids = np.concatenate([self.match_ids, *flat])

    def _learn_chunks(self, new: list[str]) -> None:
        """Remember the ids of the named runs of text; -1 for words that white space touches."""
        found: dict[str, list[str]] = {}
        for name in new:
            if name.startswith(_MATCH):
                found[name] = [name[len(_MATCH):]]
            elif name.startswith(_WHOLE):
                found[name] = self.split(name[len(_WHOLE):])
            elif not (word := name.removeprefix(_FIRST)) or word[-1].isspace() or word[0].isspace():
                self.chunks[name] = -1
            else:
                found[name] = self.split(word if name.startswith(_FIRST) else " " + word)
        unknown = list({m for matches in found.values() for m in matches if m not in self.matches})
        if unknown:
            self._learn_matches(unknown)
        index = np.array([self.matches[m] for matches in found.values() for m in matches], np.int64)
        ids, ends = _gather(self.match_ids, self.match_start, index)
        count = np.cumsum([len(matches) for matches in found.values()], dtype=np.int64)
        first = len(self.chunk_start) - 1
        self.chunks.update(zip(found, range(first, first + len(found))))
        self.chunk_start = np.concatenate([self.chunk_start, self.chunk_start[-1] + np.concatenate([[0], ends])[count]])
        self.chunk_ids = np.concatenate([self.chunk_ids, ids])

    def _places(self, names: list[str]) -> np.ndarray:
        found = list(map(self.chunks.get, names))
        if None in found:
            self._learn_chunks(list({name for name, k in zip(names, found) if k is None}))
            found = list(map(self.chunks.get, names))
        return np.array(found, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids end.

        A single space between two other characters that are no white space always
        begins a match, and no match goes over it, so the words between spaces can
        be looked up as they are. A text in which white space touches one of these
        spaces is split as a whole.
        """
        if max(len(self.chunks), len(self.matches)) > _WORDS:
            self.forget()
        rows = [text.split(" ") for text in texts]
        for row in rows:
            row[0] = (_FIRST if len(row) > 1 else _WHOLE) + row[0]
        index = self._places([x for row in rows for x in row])
        count = np.cumsum([len(row) for row in rows], dtype=np.int64)
        if (index < 0).any():
            for k in np.unique(np.searchsorted(count, np.flatnonzero(index < 0), "right")).tolist():
                rows[k] = [_MATCH + m for m in self.split(texts[k])]
            index = self._places([x for row in rows for x in row])
            count = np.cumsum([len(row) for row in rows], dtype=np.int64)
        ids, ends = _gather(self.chunk_ids, self.chunk_start, index)
        return ids, np.concatenate([[0], ends])[count]

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of runs of ids, and where each run's bytes end."""
        data, token_ends = _gather(self.blob, self.offset, ids.astype(np.int64))
        return data, np.concatenate([[0], token_ends])[ends]


def _gather(flat: np.ndarray, start: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``flat[start[i]:start[i + 1]]`` for every i of index, in a row, and the end of each."""
    size = start[index + 1] - start[index]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(start[index] - ends + size, size) + np.arange(total)], ends


@lru_cache(maxsize=2)
def vocabulary(ranks: bytes, pattern: str) -> Vocabulary:
    return Vocabulary(ranks, pattern)


def _rank_file(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """The rows with the token ids of their text, and on request the bytes decoded from these ids.

    ``path`` is a rank file (base64 token and rank in each line), read by the driver
    and broadcast: its size does not depend on the data. Matches of ``pattern`` are
    encoded separately, without special tokens. A match that is a token as a whole
    is that token. Null and empty texts have no ids. Columns of the names given for
    the results are replaced; all others stay.
    """
    ranks = df.sparkSession.sparkContext.broadcast(_rank_file(path))
    kept = df.drop(ids, *[decoded] * bool(decoded))
    schema = T.StructType([*kept.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])
    if decoded:
        schema = schema.add(decoded, T.BinaryType())

    def run(batches):
        words = vocabulary(ranks.value, pattern)
        for batch, texts in slices(batches, text, 1_000_000):
            flat, ends = words.encode(texts)
            more = {ids: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(flat))}
            if decoded:
                data, bounds = words.decode(flat, ends)
                more[decoded] = _binary(data, bounds)
            yield with_columns(batch, more)

    return kept.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """The rows with the bytes that their ids stand for; null ids and no ids give no bytes.

    An id outside the vocabulary fails the job. A column of the result's name is replaced.
    """
    ranks = df.sparkSession.sparkContext.broadcast(_rank_file(path))
    kept = df.drop(out)

    def run(batches):
        words = vocabulary(ranks.value, "$^")
        for batch in batches:
            rows = [x or [] for x in batch.column(batch.schema.get_field_index(ids)).to_pylist()]
            flat = np.array([k for row in rows for k in row], np.int64)
            if len(flat) and (flat.min() < 0 or flat.max() >= len(words.tokens)):
                raise ValueError("id outside the vocabulary")
            data, bounds = words.decode(flat, np.cumsum([len(row) for row in rows], dtype=np.int64))
            yield with_columns(batch, {out: _binary(data, bounds)})

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(out, T.BinaryType())]))


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])
