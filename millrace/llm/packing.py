"""Documents packed into token windows by multiway differencing."""

from __future__ import annotations

import heapq
from bisect import insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, types as T

from millrace.llm.arrow import only, text_slices
from millrace.llm.encoder import encoder

CAPACITY = 2048
END_ID = 1
# What is left of a document beyond whole windows is cut into pieces of at most this length:
# about four pieces to a window is what differencing needs to come out even.
PIECE = 512
# Windows that are balanced at a time. Bounds a task's memory, whatever its input.
GROUP_WINDOWS = 512

Window = tuple[int, list[int]]


def differencing(sizes: list[int], k: int) -> list[Window]:
    """The sizes in ``k`` windows of nearly equal sum: (sum, indices), largest sum first.

    Starts with a partial partition for each size. The two partitions with the largest
    difference between their windows are merged, the largest window of one with the
    smallest of the other, until one is left. Empty windows are implied and not returned.
    """
    def entry(n: int, windows: list[Window]):
        smallest = windows[-1][0] if len(windows) == k else 0
        return smallest - windows[0][0], n, windows

    heap = [entry(n, [(size, [n])]) for n, size in enumerate(sizes)]
    heapq.heapify(heap)
    n = len(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        if len(a) < len(b):
            a, b = b, a
        if len(a) + len(b) <= k:
            for window in b:
                insort(a, window, key=lambda w: -w[0])
        else:
            alone = k - len(b)
            met = [(x[0] + y[0], x[1] + y[1])
                   for x, y in zip(a[alone:], reversed(b[k - len(a):]))]
            a = sorted(a[:alone] + met + b[:k - len(a)], key=lambda w: -w[0])
        heapq.heappush(heap, entry(n, a))
        n += 1
    return heap[0][2] if heap else []


def balanced(sizes: list[int], capacity: int) -> list[Window]:
    """The sizes in as few windows as differencing fills without exceeding the capacity."""
    k = -(-sum(sizes) // capacity)
    while True:
        windows = differencing(sizes, k)
        if not windows or windows[0][0] <= capacity:
            return windows
        k += 1


def pieces_schema(id_type: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("doc_id", id_type), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType())])


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int | None = END_ID,
         piece: int = PIECE, group_windows: int = GROUP_WINDOWS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    A document is the ids of its text, then ``end_id``. Whole windows are cut from its front;
    the rest, in pieces of at most ``piece`` ids, is balanced with the rests of documents of
    the same task, a bounded group at a time. Each id lies in exactly one piece, and the
    pieces of a sequence fill it from offset 0 without gaps. ``ids`` holds the piece's ids as
    little-endian unsigned 32-bit integers. ``sequence_id`` is the task's number and a count.

    Nothing is shuffled: a task packs what it reads. A NULL or empty text is the end id
    alone, or no row without one. Repeated rows and NULL ids are packed as they come. Other
    columns are ignored. An empty table gives no rows.
    """
    if not 0 < piece <= capacity:
        raise ValueError("a piece must have 1 to capacity ids")
    schema = pieces_schema(docs.schema["doc_id"].dataType)
    names = schema.names

    def run(batches):
        encode = encoder(tokenizer).encode
        ending = [] if end_id is None else [end_id]
        sequence = TaskContext.get().partitionId() << 32
        whole, rest, waiting = [], [], 0

        def emit(windows: list[list[tuple]], id_type) -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            rows = []
            for window in windows:
                offset = 0
                for doc, start, ids, total in window:
                    rows.append((doc, start, len(ids), ids.astype("<u4").tobytes(), total,
                                 sequence, offset))
                    offset += len(ids)
                sequence += 1
            if rows:
                types = [id_type, pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 3]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=t) for c, t in zip(zip(*rows), types)], names=names)

        def even() -> list[list[tuple]]:
            return [[rest[i] for i in sorted(inside)]
                    for _, inside in balanced([len(x[2]) for x in rest], capacity)]

        id_type = None
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            doc_ids = batch.column("doc_id").to_pylist()
            for first, end, data, offsets in text_slices(batch):
                ids, bounds = encode(data, offsets)
                for row in range(first, end):
                    own = ids[bounds[row - first]:bounds[row - first + 1]]
                    own = np.append(own, np.array(ending, own.dtype))
                    size, at = len(own), 0
                    while size - at >= capacity:
                        whole.append([(doc_ids[row], at, own[at:at + capacity], size)])
                        at += capacity
                    waiting += size - at
                    while at < size:
                        part = own[at:at + piece]
                        rest.append((doc_ids[row], at, part, size))
                        at += len(part)
                    if len(whole) >= group_windows:
                        yield from emit(whole, id_type)
                        whole = []
                    if waiting >= group_windows * capacity:
                        yield from emit(even(), id_type)
                        rest, waiting = [], 0
        yield from emit(whole + even(), id_type)

    return only(docs, "doc_id", "text").mapInArrow(run, schema)
