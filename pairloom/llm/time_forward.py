"""Subtree totals by time-forward processing: nodes in reverse level order hand their totals on to their parents through a
priority queue that spills."""

from __future__ import annotations

import heapq
import pickle
import tempfile
from collections.abc import Iterator
from typing import IO, Any

import pyarrow as pa

#: Messages that a queue holds before it writes them out as a sorted run.
HELD = 200_000
#: Messages of a run that are read at once.
READ = 4096

Key = tuple[int, int, int]
Message = tuple[Key, int, int]


class SpillingQueue:
    """Messages by key; beyond ``held`` they go to a sorted run on disk. A run has no name and goes with the queue."""

    def __init__(self, held: int) -> None:
        self.held, self.heap, self.runs = held, [], 0
        self.heads: list[tuple[Message, int, Iterator[Message]]] = []

    def push(self, message: Message) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.held:
            run: IO[bytes] = tempfile.TemporaryFile()
            rows = sorted(self.heap)
            for at in range(0, len(rows), READ):
                pickle.dump(rows[at : at + READ], run)
            run.seek(0)
            self.heap = []
            self.runs += 1
            self._advance(self.runs, self._read(run))

    @staticmethod
    def _read(run: IO[bytes]) -> Iterator[Message]:
        with run:
            while True:
                try:
                    rows = pickle.load(run)
                except EOFError:
                    return
                yield from rows

    def _advance(self, number: int, run: Iterator[Message]) -> None:
        if (first := next(run, None)) is not None:
            heapq.heappush(self.heads, (first, number, run))

    def upto(self, key: Key) -> Iterator[Message]:
        """Takes out the messages up to and with ``key``, in order."""
        while True:
            least = self.heap[0] if self.heap else None
            if self.heads and (least is None or self.heads[0][0] < least):
                if self.heads[0][0][0] > key:
                    return
                message, number, run = heapq.heappop(self.heads)
                self._advance(number, run)
                yield message
            elif least is not None and least[0] <= key:
                yield heapq.heappop(self.heap)
            else:
                return


NODE = "shard long, depth long, k1 long, k2 long, up1 long, up2 long, children long, leaves long, saved long"
TOTALS = "depth long, k1 long, k2 long, n_children long, n_leaves long, saved long"
_NAMES = [c.split()[0] for c in TOTALS.split(", ")]


def forward(batches: Iterator[pa.RecordBatch], held: int = HELD) -> Iterator[pa.RecordBatch]:
    """Totals of nodes (``NODE``) that come sorted by shard, descending depth and key.

    A node starts with what it has itself (children, leaves and saved of other shards too) and gets a message from each
    child of its shard; one without children is a leaf. What nobody in the shard waits for is left.
    """
    of: Any = None
    queue = SpillingQueue(held)
    for batch in batches:
        made: list[tuple[int, ...]] = []
        for shard, depth, k1, k2, up1, up2, children, leaves, saved in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if shard != of:
                of, queue = shard, SpillingQueue(held)
            key = (-depth, k1, k2)
            for to, more_leaves, more_saved in queue.upto(key):
                if to == key:
                    children, leaves, saved = children + 1, leaves + more_leaves, saved + more_saved
            leaves = leaves or int(not children)
            made.append((depth, k1, k2, children, leaves, saved))
            if up1 is not None:
                queue.push(((1 - depth, up1, up2), leaves, saved))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*made, strict=True)] if made else [pa.array([], pa.int64())] * 6, names=_NAMES)
