"""Sum-of-squares online packing of documents into windows of tokens.

Every task packs the documents of its own partition as they come, sorted, so nothing is shuffled. A level array counts
the partially filled windows of each fill. A document is first cut into whole windows; what is left goes to
the fill that makes the sum of the squared counts smallest: a new window, or one of a fill it still fits, where
a window it completes leaves the sum. At the end of a partition the fullest windows still open are filled up with pieces of
the emptiest, which are cut again; the rest becomes windows of a power of two, which need no padding.

Defined results: a NULL or empty text is the end id alone; NULL ids and repeated rows are packed as rows of
their own; ties between fills go to the fullest; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, types as T

from liftline.llm import tokens
from liftline.llm.common import map_frames, texts


class SumOfSquares:
    """Windows filled one document at a time. ``take`` yields (document, start, length, window, offset)."""

    def __init__(self, window: int):
        self.window = window
        self.counts = np.zeros(window + 1, np.int64)
        self.open: list[list] = [[] for _ in range(window + 1)]
        self.next = 0
        #: Ids that left the window the rule had given them, at the end.
        self.moved = 0

    def _new(self) -> int:
        self.next += 1
        return self.next - 1

    def level(self, n: int) -> int:
        """The fill to add ``n`` ids to, 0 for a new window: the least growth of the sum of squares."""
        count, room = self.counts, self.window - n
        at = np.flatnonzero(count[1 : room + 1]) + 1
        if not len(at):
            return 0
        filled = count[at + n].copy()
        growth = 2 * (filled - count[at]) + 2
        if at[-1] == room:
            growth[-1] = 1 - 2 * count[room]
        best = len(at) - 1 - int(np.argmin(growth[::-1]))
        return int(at[best]) if growth[best] <= 2 * count[n] + 1 else 0

    def take(self, document: int, n: int) -> Iterator[tuple[int, int, int, int, int]]:
        start = 0
        while n - start >= self.window:
            yield document, start, self.window, self._new(), 0
            start += self.window
        n -= start
        if not n:
            return
        fill = self.level(n)
        if fill:
            self.counts[fill] -= 1
            pieces = self.open[fill].pop()
        else:
            pieces = []
        pieces.append((document, start, n))
        if fill + n < self.window:
            self.counts[fill + n] += 1
            self.open[fill + n].append(pieces)
        else:
            yield from self._laid(pieces)

    def _laid(self, pieces: list) -> Iterator[tuple[int, int, int, int, int]]:
        window, offset = self._new(), 0
        for document, start, n in pieces:
            yield document, start, n, window, offset
            offset += n

    def finish(self) -> Iterator[tuple[int, int, int, int, int]]:
        """The windows still open, without padding: the fullest keep their pieces and are filled up with pieces of the emptiest, cut where
        they must be; of the last one the rest becomes windows of a power of two."""
        open_windows = [(fill, pieces) for fill, level in enumerate(self.open) for pieces in level]
        low, high = 0, len(open_windows) - 1  # they stand from the emptiest to the fullest
        spare: list[tuple[int, int, int]] = []
        laid = []

        def taken(need: int) -> list[tuple[int, int, int]]:
            nonlocal low
            out = []
            while need:
                if not spare:
                    spare.extend(reversed(open_windows[low][1]))
                    low += 1
                document, start, n = spare.pop()
                used = min(n, need)
                out.append((document, start, used))
                need -= used
                if used < n:
                    spare.append((document, start + used, n - used))
            return out

        left = sum(n for _, _, n in spare) + sum(fill for fill, _ in open_windows)
        while low <= high and left >= self.window:
            fill, pieces = open_windows[high]
            high -= 1
            laid += self._laid(pieces + taken(self.window - fill))
            self.moved += self.window - fill
            left -= self.window
        while left >= self.window:
            laid += self._laid(taken(self.window))
            self.moved += self.window
            left -= self.window
        for size in [1 << k for k in reversed(range(31)) if left >> k & 1]:
            laid += self._laid(taken(size))
            self.moved += size
        yield from laid


SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("ids_crc32", T.LongType(), False),
        T.StructField("doc_tokens", T.LongType(), False),
        T.StructField("sequence_id", T.LongType(), False),
        T.StructField("offset", T.LongType(), False),
        T.StructField("ids", T.BinaryType(), False),
    ]
)


def pack(
    docs: DataFrame, tokenizer: str, window: int = 1024, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: its document's id, where it lies in the document and in its sequence, and its ids as
    little-endian unsigned 32-bit integers. ``sequence_id`` holds the task's number in its upper bits."""
    rows = texts(docs, id_col, text_col)
    id_type = rows.schema["doc_id"].dataType
    fields = [T.StructField(f.name, id_type if f.name == "doc_id" else f.dataType, f.nullable) for f in SCHEMA]
    schema = T.StructType(fields if with_ids else fields[:-1])

    def packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId() << 32
        packer = SumOfSquares(window)
        held: dict[int, tuple] = {}  # documents with a piece in an open window: id, ids from the piece on, its start, length
        serial = 0

        def row(document: int, start: int, n: int, sequence: int, offset: int, drop: bool) -> tuple:
            doc_id, ids, base, total = held.pop(document) if drop else held[document]
            part = ids[start - base : start - base + n].astype("<u4").tobytes()
            return (doc_id, start, n, zlib.crc32(part), total, task + sequence, offset, part)[: len(schema)]

        for doc_ids, arrays in tokens.batches(frames, tokenizer, end_id):
            out = []
            for doc_id, ids in zip(doc_ids, arrays):
                held[serial] = (doc_id, ids, 0, len(ids))
                tail = len(ids) - len(ids) % window
                for piece in packer.take(serial, len(ids)):
                    out.append(row(*piece, drop=piece[1] == tail))
                if tail == len(ids):
                    del held[serial]
                elif serial in held:
                    held[serial] = (doc_id, ids[tail:].copy(), tail, len(ids))
                serial += 1
            if out:
                yield frame(out)
        out = [row(*piece, drop=False) for piece in packer.finish()]
        if out:
            yield frame(out)

    def frame(out: list[tuple]) -> pd.DataFrame:
        done = pd.DataFrame(out, columns=schema.names)
        return done.assign(doc_id=pd.Series([r[0] if r[0] == r[0] else None for r in out], dtype=object))

    # whole ids: a NULL would turn a block of long ids into doubles
    as_text = rows.selectExpr("CAST(doc_id AS STRING) AS doc_id", "text").sortWithinPartitions("doc_id", "text")
    string_schema = T.StructType([T.StructField("doc_id", T.StringType()), *schema.fields[1:]])
    done = map_frames(as_text, packed, string_schema)
    return done.withColumn("doc_id", done["doc_id"].cast(id_type))
