"""Packing of token ids into sequences of a fixed length.

Method: minimum bin slack. A text's ids are cut into full windows of ``capacity`` and one
remaining length. Remaining lengths of a partition are counted, and each window takes the
longest one left plus the multiset of others that comes closest to the space behind it: a
bitset of reachable sums, extended by one (length, power-of-two count) step at a time, from
which the counts are traced back. Only if no multiset fills the window is one more text cut.

No shuffle: a partition packs its own texts, in blocks of ``BLOCK`` remaining pieces, and
hands what did not fill to its next block. What is left at its end (below one window) becomes
sequences whose lengths are powers of two, which need no padding. So any split of the input,
also one with a hot source or copies, gives full windows, and a repeated task repeats its
result.

Defined cases: a null or empty text is the separator alone; a null id is kept; repeated rows
are separate texts; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

CAPACITY = 1024
BLOCK = 16384
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown}
    letters.update({chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)})
    return letters


@lru_cache(maxsize=2)
def encoder(path: str):
    """The byte-level BPE of a ``tokenizers`` file, with the same ids.

    Merges of these files are in the order of the ids, so the ids are ranks and ``tiktoken``
    gives the same result at about five times the speed for a text without added tokens, but
    for very long runs of white space, which it refuses. ``encode`` sees to both.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    special = {x["content"] for x in described["added_tokens"]}
    letters = _byte_letters()
    ranks = {
        bytes(letters[c] for c in token): rank
        for token, rank in described["model"]["vocab"].items()
        if token not in special
    }
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def encode(path: str) -> Callable[[str], np.ndarray]:
    """The ids that ``tokenizers`` gives a text, without those its post-processor adds."""
    from tokenizers import Tokenizer

    fast, whole = encoder(path).encode_to_numpy, Tokenizer.from_file(path)
    added = [x.content for x in whole.get_added_tokens_decoder().values()]

    def ids(text: str) -> np.ndarray:
        if not any(token in text for token in added):
            try:
                return fast(text, disallowed_special=())
            except ValueError:  # its pattern ran out of stack
                pass
        return np.array(whole.encode(text, add_special_tokens=False).ids, np.uint32)

    return ids


def best_fill(lengths: list[int], counts: dict[int, int], space: int) -> list[tuple[int, int]]:
    """(length, count) pairs whose sum is the largest reachable up to ``space``.

    ``lengths`` are the distinct lengths, ascending, and ``counts`` how many there are.
    """
    reach, goal, mask = 1, 1 << space, (2 << space) - 1
    steps: list[tuple[int, int, int]] = []
    for place in range(bisect_right(lengths, space) - 1, -1, -1):
        length = lengths[place]
        left, step = min(counts[length], space // length), 1
        while left:
            step = min(step, left)
            more = (reach | reach << step * length) & mask
            if more != reach:
                steps.append((length, step, reach))
                reach = more
            left -= step
            step *= 2
        if reach & goal:
            break
    total, taken = reach.bit_length() - 1, []
    for length, step, before in reversed(steps):
        if not before >> total & 1:
            taken.append((length, step))
            total -= step * length
    return taken


class _Packer:
    """Pieces of one partition; ``out`` collects finished rows."""

    def __init__(self, capacity: int, first_id: int, tokens: bool) -> None:
        self.capacity, self.sequence, self.tokens = capacity, first_id, tokens
        self.held: dict[int, list[tuple]] = {}
        self.lengths: list[int] = []
        self.counts: dict[int, int] = {}
        self.pending = self.total = 0
        self.out: list[tuple] = []

    def add(self, doc, ids: np.ndarray) -> None:
        whole = len(ids) - len(ids) % self.capacity
        for start in range(0, whole, self.capacity):
            self._emit([(doc, start, ids[start : start + self.capacity], len(ids))])
        if whole < len(ids):
            self._hold((doc, whole, ids[whole:].copy(), len(ids)))

    def _hold(self, piece: tuple) -> None:
        length = len(piece[2])
        if not self.counts.get(length):
            insort(self.lengths, length)
            self.held.setdefault(length, [])
        self.held[length].append(piece)
        self.counts[length] = self.counts.get(length, 0) + 1
        self.pending += 1
        self.total += length

    def _take(self, length: int) -> tuple:
        self.counts[length] -= 1
        if not self.counts[length]:
            del self.lengths[bisect_left(self.lengths, length)]
        self.pending -= 1
        self.total -= length
        return self.held[length].pop()

    def _emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, size in pieces:
            crc = zlib.crc32(ids.astype("<u4").tobytes())
            row = (doc, start, len(ids), crc, size, self.sequence, offset)
            self.out.append((*row, ids) if self.tokens else row)
            offset += len(ids)
        self.sequence += 1

    def fill(self) -> None:
        """Pack as long as there is enough for a whole window."""
        while self.total >= self.capacity:
            pieces = [self._take(self.lengths[-1])]
            space = self.capacity - len(pieces[0][2])
            if space:
                for length, count in best_fill(self.lengths, self.counts, space):
                    pieces += [self._take(length) for _ in range(count)]
                    space -= length * count
            if space:  # nothing fits: the longest left is longer than the space
                pieces += self._cut(space)
            self._emit(pieces)

    def _cut(self, space: int) -> list[tuple]:
        doc, start, ids, size = self._take(self.lengths[-1])
        if len(ids) > space:
            self._hold((doc, start + space, ids[space:], size))
        return [(doc, start, ids[:space], size)]

    def finish(self) -> None:
        """The rest, below one window, as sequences of powers of two."""
        self.fill()
        while self.total:
            space, pieces = 1 << self.total.bit_length() - 1, []
            while space:
                pieces += self._cut(space)
                space -= len(pieces[-1][2])
            self._emit(pieces)


def pack(
    docs: DataFrame,
    tokenizer: str,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = CAPACITY,
    separator: int = 0,
    block: int = BLOCK,
    tokens: bool = False,
) -> DataFrame:
    """One row per piece: the id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset`` and, with ``tokens``, the ids as ``input_ids``.

    ``tokenizer`` is the path of a byte-level BPE file on every executor. ``sequence_id`` is
    the partition's number times 2^40 plus a running number.
    """
    chosen = docs.select(docs[id_column].alias("_id"), docs[text_column].alias("_text"))
    names = [id_column, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    types = [chosen.schema["_id"].dataType.simpleString(), *["bigint"] * 6]
    if tokens:
        names, types = [*names, "input_ids"], [*types, "array<int>"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encode(tokenizer)
        kind = None
        packer = _Packer(capacity, TaskContext.get().partitionId() << 40, tokens)
        for batch in batches:
            kind = batch.schema.field(0).type
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    packer.add(doc, np.append(ids_of(text or ""), np.uint32(separator)))
                if packer.pending >= block:
                    packer.fill()
                if len(packer.out) >= 4096:
                    yield _batch(packer, names, kind)
        packer.finish()
        if packer.out:
            yield _batch(packer, names, kind)

    schema = ", ".join(f"`{n}` {t}" for n, t in zip(names, types, strict=True))
    return chosen.mapInArrow(work, schema)


def _batch(packer: _Packer, names: list[str], kind: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*packer.out, strict=True))
    packer.out = []
    arrays = [pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:7])]
    if len(columns) > 7:
        arrays.append(pa.array([x.astype(np.int32) for x in columns[7]], pa.list_(pa.int32())))
    return pa.RecordBatch.from_arrays(arrays, names)
