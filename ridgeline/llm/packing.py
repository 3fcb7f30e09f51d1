"""Cost-balanced packing of token ids into training sequences.

Documents are packed in blocks of bounded token count, each within the task
that encodes it: no ids are shuffled or stored. Within a block, documents go in
descending length to the sequence of lowest cost (linear plus quadratic, the
attention within a document) that still has room; one that fits nowhere is cut
at the largest room left. A document longer than a sequence first fills whole
sequences. All sequences of a block but the last ones are full; the rest of the
block is split into sequences of power-of-two lengths, which need no padding.

Null text counts as empty: one piece with the end id. Repeated rows are packed
each. Ties go to the first sequence in order. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import released
from ridgeline.llm.tokens import END_ID, Room, encoder, text_slices

CAPACITY = 4096
BLOCK_TOKENS = 4_000_000      # ids held at a time by a task: 16 MB
OUT_TOKENS = 500_000          # ids in one Arrow batch
SEQUENCE_BITS = 32            # a sequence's id: its task's number above these bits


@dataclass(frozen=True)
class Cost:
    """Estimated cost of a piece of n ids: linear * n + quadratic * n^2."""

    linear: float = 1.0
    quadratic: float = 1.0 / 1024

    def of(self, n):
        return self.linear * n + self.quadratic * n * n


def room_sizes(tokens: int, capacity: int) -> list[int]:
    """Lengths of the sequences that hold ``tokens`` ids without padding: full ones, then
    falling powers of two."""
    full, rest = divmod(tokens, capacity)
    return [capacity] * full + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack_lengths(lengths: np.ndarray, capacity: int = CAPACITY, cost: Cost = Cost()) -> np.ndarray:
    """Pieces of documents of these lengths as rows (document, start, length, sequence,
    offset). Every id lies in one piece, and every sequence is full."""
    sizes = np.array(room_sizes(int(lengths.sum()), capacity), np.int64)
    whole = lengths // capacity
    n_whole = int(whole.sum())
    out: list[tuple[int, int, int, int, int]] = []
    s = 0
    for d in np.flatnonzero(whole):
        for j in range(int(whole[d])):
            out.append((int(d), j * capacity, capacity, s, 0))
            s += 1
    room, spent = sizes.copy(), np.zeros(len(sizes))
    room[:n_whole] = 0
    rest = lengths - whole * capacity
    for d in np.argsort(-rest, kind="stable"):
        start, left = int(whole[d]) * capacity, int(rest[d])
        while left:
            fits = room >= left
            s = int(np.argmin(np.where(fits, spent, np.inf))) if fits.any() else int(np.argmax(room))
            n = min(left, int(room[s]))
            out.append((int(d), start, n, s, int(sizes[s] - room[s])))
            room[s] -= n
            spent[s] += cost.of(n)
            start, left = start + n, left - n
    return np.array(out, np.int64).reshape(-1, 5)


def pack_documents(docs: DataFrame, tokenizer: str, *, capacity: int = CAPACITY, cost: Cost = Cost(),
                   key: str = "doc_id", text: str = "text", end_id: int = END_ID, room: Room = Room()) -> DataFrame:
    """One row per piece: key, start, length, doc_tokens, sequence_id, offset, and its ids
    as little-endian unsigned 32-bit integers in ``ids``."""
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    names = [key, "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, task = encoder(tokenizer, end_id, room), TaskContext.get().partitionId()
        used = 0
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal used
            keys = pa.concat_arrays([k for k, _, _ in held])
            ids = np.concatenate([x for _, x, _ in held]).astype("<u4")
            lengths = np.concatenate([np.diff(e, prepend=0) for _, _, e in held])
            held.clear()
            begin = np.cumsum(lengths) - lengths
            pieces = pack_lengths(lengths, capacity, cost)
            pieces = pieces[np.lexsort((pieces[:, 4], pieces[:, 3]))]
            part = np.cumsum(pieces[:, 2]) // OUT_TOKENS
            for p in np.split(pieces, np.flatnonzero(np.diff(part)) + 1):
                d, start, n, seq, at = p.T
                cuts = np.concatenate([[0], np.cumsum(n)])
                flat = ids[np.repeat(begin[d] + start - cuts[:-1], n) + np.arange(cuts[-1])]
                data = pa.Array.from_buffers(pa.binary(), len(n), [
                    None, pa.py_buffer((cuts * 4).astype(np.int32)), pa.py_buffer(flat)])
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(d)), pa.array(start), pa.array(n), pa.array(lengths[d]),
                     pa.array((task << SEQUENCE_BITS) + used + seq), pa.array(at), data], names=names)
            used += len(room_sizes(int(lengths.sum()), capacity))

        tokens = 0
        for batch in batches:
            for b in text_slices(batch, 1, room.chars):
                ids, ends = enc.encode(b.column(1))
                held.append((b.column(0), ids, ends))
                tokens += len(ids)
                if tokens >= BLOCK_TOKENS:
                    yield from flush()
                    tokens = 0
        if held:
            yield from flush()

    return rows.mapInArrow(released(run), f"`{key}` long, start long, length long, doc_tokens long, "
                                "sequence_id long, offset long, ids binary")
