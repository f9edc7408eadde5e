"""Bounded-space online packing of documents into sequences of a fixed number of tokens.

Each task keeps a fixed number of open windows. What is left of a document after its full windows
goes where it leaves the least room; if it fits nowhere, its head fills up the fullest window, which
is emitted, and its tail is placed again. The windows that a task leaves open are merged by the same
rule with those of a few other tasks, and so on until one group is left; its last windows are joined
end to end. What then remains is cut at powers of two, so that nothing needs padding.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.llm.common import chunks, texts_of
from statloom.llm.tokens import Encoder, default_path
from statloom.storage import scratch_path

SEQUENCE, END_ID = 4096, 2
#: Windows that a task keeps open, and tasks whose open windows meet in one merge.
OPEN_WINDOWS, MERGED_TASKS = 32, 16

#: A piece: row of its document, ids before it, its ids (4 bytes each, little-endian), all ids of the document.
Piece = tuple[object, int, bytes, int]


class Packer:
    """The open windows of one task; ``done`` collects emitted windows."""

    def __init__(self, size: int, windows: int):
        self.size, self.windows = size, windows
        self.open: list[tuple[int, list[Piece]]] = []  # tokens and pieces of each window
        self.done: list[list[Piece]] = []

    def place(self, piece: Piece) -> None:
        doc, start, ids, total = piece
        size = self.size
        full = len(ids) // (4 * size)
        for k in range(full):
            self.done.append([(doc, start + k * size, ids[4 * k * size : 4 * (k + 1) * size], total)])
        start, ids = start + full * size, ids[4 * full * size :]
        while n := len(ids) // 4:
            best, room = None, size + 1
            for k, (used, _) in enumerate(self.open):
                if n <= size - used < room:
                    best, room = k, size - used
            if best is None and len(self.open) < self.windows:
                self.open.append((0, []))
                best, room = len(self.open) - 1, size
            if best is None:
                best = max(range(len(self.open)), key=lambda k: self.open[k][0])
                room = size - self.open[best][0]
            used, pieces = self.open[best]
            pieces.append((doc, start, ids[: 4 * room], total))
            taken = min(n, room)
            self.open[best] = (used + taken, pieces)
            if used + taken == size:
                self.done.append(pieces)
                del self.open[best]
            start, ids = start + taken, ids[4 * taken :]

    def finish(self) -> None:
        """Joins the open windows end to end and cuts the rest at powers of two."""
        rest = [p for _, pieces in self.open for p in pieces]
        self.open = []
        left = sum(len(p[2]) // 4 for p in rest)
        while left:
            want = room = self.size if left >= self.size else 1 << (left.bit_length() - 1)
            window = []
            while room:
                doc, start, ids, total = rest.pop(0)
                taken = min(room, len(ids) // 4)
                window.append((doc, start, ids[: 4 * taken], total))
                if len(ids) > 4 * taken:
                    rest.insert(0, (doc, start + taken, ids[4 * taken :], total))
                room -= taken
            self.done.append(window)
            left -= want


def _rows(windows: Iterable[list[Piece]], numbers: Iterable[int], open_: bool, task: int) -> list[tuple]:
    out = []
    for number, pieces in zip(numbers, windows, strict=False):
        offset = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            out.append((doc, start, n, total, number, offset, ids, open_, task))
            offset += n
    return out


_PIECE = "start long, length long, doc_tokens long, sequence_id long, offset long, ids binary, open boolean, task long"
_NAMES = [x.split()[0] for x in _PIECE.split(", ")]


def _pack(text: str, id: str, kind: pa.DataType, path: str, size: int, windows: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        task = TaskContext.get().partitionId()
        encoder, packer, number = Encoder(path), Packer(size, windows), task << 28

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [[]] * (len(_NAMES) + 1)
            kinds = [kind, *[pa.int64()] * 5, pa.binary(), pa.bool_(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], [id, *_NAMES])

        for batch in chunks(batches, text, 4 << 20):
            ids, counts = encoder.encode_ended(texts_of(batch, text), end)
            raw, at = ids.astype("<u4").tobytes(), np.concatenate([[0], np.cumsum(counts)]).tolist()
            for i, doc in enumerate(batch.column(id).to_pylist()):
                packer.place((doc, 0, raw[4 * at[i] : 4 * at[i + 1]], at[i + 1] - at[i]))
            yield batch_of(_rows(packer.done, range(number, number + len(packer.done)), False, task))
            number += len(packer.done)
            packer.done = []
        yield batch_of(_rows([p for _, p in packer.open], range(len(packer.open)), True, task))

    return run


def _merge(id: str, size: int, windows: int, level: int, last: bool):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        task = int(frame["group"].iloc[0])
        packer = Packer(size, windows)
        frame = frame.sort_values(["length", "task", "sequence_id", "offset"], ascending=[False, True, True, True])
        for row in frame.itertuples(index=False):
            doc = None if pd.isna(row.doc) else row.doc
            packer.place((doc, int(row.start), bytes(row.ids), int(row.doc_tokens)))
        if last:
            packer.finish()
        first = (level << 56) | (task << 28)
        rows = _rows(packer.done, range(first, first + len(packer.done)), False, task)
        rows += _rows([p for _, p in packer.open], range(len(packer.open)), True, task)
        return pd.DataFrame(rows, columns=["doc", *_NAMES])

    return run


def pack(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    size: int = SEQUENCE,
    windows: int = OPEN_WINDOWS,
    end: int = END_ID,
    merged: int = MERGED_TASKS,
) -> DataFrame:
    """One row per piece: ``id, start, length, doc_tokens, sequence_id, offset, ids``.

    Every id of every document (its text's ids and ``end``) lies in one piece; ``ids`` are 4 bytes
    each, little-endian. A NULL or empty text is the id ``end`` alone; a NULL id stays NULL. Equal
    rows are packed separately. A long text's ids are held by its task at once, four bytes each. An empty table gives no rows. Sequences have ``size`` ids, but for
    at most log2(size) last ones, whose lengths are falling powers of two.
    """
    if size & (size - 1):
        raise ValueError("size must be a power of two")
    spark, path = docs.sparkSession, tokenizer or default_path()
    source = docs.select(F.col(id).alias("doc"), F.col(text).cast("string").alias("__text"))
    kind = source.schema["doc"].dataType.simpleString()
    arrow = _arrow_kind(spark, kind)
    schema = f"doc {kind}, {_PIECE}"

    def written(df: DataFrame) -> DataFrame:
        place = scratch_path(spark, "packing")
        df.write.option("compression", "zstd").parquet(place)
        return spark.read.schema(schema).parquet(place)

    packed = written(source.mapInArrow(_pack("__text", "doc", arrow, path, size, windows, end), schema))
    parts, left, level = [packed.where("not open")], packed.where("open"), 0
    while True:
        tasks = left.agg(F.max("task")).first()[0]
        if tasks is None:
            break
        level += 1
        last = tasks < merged
        grouped = left.withColumn("group", (F.col("task") / merged).cast("long")).groupBy("group")
        step = written(grouped.applyInPandas(_merge("doc", size, windows, level, last), schema))
        parts.append(step.where("not open"))
        left = step.where("open")
        if last:
            break
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(
        F.col("doc").alias(id), "start", "length", "doc_tokens", "sequence_id", "offset", "ids"
    )


def _arrow_kind(spark, kind: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(spark.createDataFrame([], f"x {kind}").schema["x"].dataType)
