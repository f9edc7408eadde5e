"""Training-order materialisation of token sequences.

Documents become one stream of ids per task, cut into sequences of equal length. The sequences have a
dense number (those of the first task, then of the second, ...); a keyed Feistel network permutes the
numbers, walking its cycles until a number is below the total, and so gives each sequence its global
slot. Equal ranges of slots are written as shards of records of one size, in the order of slots, so
that a reader finds any slot by its offset and can go on from where it stopped.

Shards are written by Spark's text writer: a record is its ids as raw bytes and a closing id 0.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.llm.common import arrow_rows, chunks, mixed, release, texts_of
from statloom.llm.tokens import Encoder, default_path
from statloom.storage import materialize, scratch_path

LENGTH, END_ID, SHARD_RECORDS, ROUNDS = 4096, 2, 512, 6
#: Documents or sequences that Python gets at once.
BATCH_ROWS = 256
#: Ids take two bytes; this one, which no vocabulary of at most 65,535 ids has, fills up a sequence.
PAD_ID = 0xFFFF


def feistel(number: np.ndarray, total: int, key: int, rounds: int = ROUNDS) -> np.ndarray:
    """The place of each number below ``total`` in a permutation of them that ``key`` chooses."""
    half = np.uint64(max(1, ((max(total, 2) - 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    keys = mixed(np.arange(1, rounds + 1, dtype=np.uint64) + np.uint64(key % (1 << 63)) * np.uint64(2))
    out = np.asarray(number, np.uint64).copy()
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> half, out[walking] & mask
        for k in keys:
            left, right = right, left ^ (mixed(right ^ k) & mask)
        out[walking] = (left << half) | right
        walking = walking[out[walking] >= np.uint64(total)]
    return out.astype(np.int64)


def token_sequences(
    docs: DataFrame, id: str = "doc_id", text: str = "text", tokenizer: str | None = None, length: int = LENGTH, end: int = END_ID
) -> DataFrame:
    """``task, local, n_ids, doc, start, ids``: sequences in the order of the input's rows.

    ``doc`` and ``start`` tell the document of the first id and how many of its ids came before;
    ``ids`` is compressed. Each document is followed by the id ``end``; a NULL text is that id alone.
    Only the last sequence of a task may have fewer than ``length`` ids. A long text's ids are held by
    its task at once. Other columns are not read. An empty table has none.
    """
    path = tokenizer or default_path()
    source = docs.select(F.col(id).alias("doc"), F.col(text).cast("string").alias("text"))
    kind = source.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        task, local, encoder = TaskContext.get().partitionId(), 0, Encoder(path)
        press, rest = zstandard.ZstdCompressor(level=3), np.zeros(0, np.uint16)
        origin: tuple = (None, 0)  # of the first id in ``rest``
        arrow = None

        def rows_of(made: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*made, strict=True))
            kinds = [pa.int64(), pa.int64(), pa.int64(), arrow, pa.int64(), pa.binary()]
            names = ["task", "local", "n_ids", "doc", "start", "ids"]
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in chunks(batches, "text", 2 << 20):
            arrow = batch.schema.field("doc").type
            ids, counts = encoder.encode_ended(texts_of(batch, "text"), end)
            if len(ids) and ids.max() >= PAD_ID:
                raise ValueError("ids of this tokenizer do not fit into two bytes")
            stream, held = np.concatenate([rest, ids.astype("<u2")]), len(rest)
            first = held + np.cumsum(counts) - counts
            names = batch.column("doc").to_pylist()
            full, made = len(stream) // length, []

            def told(at: int, first=first, names=names, held=held, origin=origin) -> tuple:
                if at < held:
                    return origin[0], origin[1] + at
                i = int(np.searchsorted(first, at, "right")) - 1
                return names[i], at - int(first[i])

            for k in range(full):
                at = k * length
                made.append((task, local + k, length, *told(at), press.compress(stream[at : at + length].tobytes())))
            local += full
            rest = stream[full * length :].copy()
            if len(rest):
                origin = told(full * length)
            if made:
                yield rows_of(made)
        if len(rest):
            padded = np.concatenate([rest, np.full(length - len(rest), PAD_ID, np.uint16)])
            yield rows_of([(task, local, len(rest), *origin, press.compress(padded.astype("<u2").tobytes()))])
        del encoder, press
        release()

    return source.mapInArrow(run, f"task long, local long, n_ids long, doc {kind}, start long, ids binary")


def training_order(sequences: DataFrame, key: int, shard_records: int = SHARD_RECORDS) -> DataFrame:
    """The sequences with ``slot``, ``shard`` and ``record`` (their place in it) instead of their task.

    ``sequences`` must be a written table: it is read for the counts and again for the order.
    """
    spark = sequences.sparkSession
    # one row per task that made sequences
    counts = sequences.groupBy("task").agg(F.count(F.lit(1)).alias("n")).orderBy("task").toPandas()
    total = int(counts["n"].sum())
    bases = pd.DataFrame({"task": counts["task"], "base": counts["n"].cumsum() - counts["n"]}).astype("int64")
    based = sequences.join(F.broadcast(spark.createDataFrame(bases, "task long, base long")), "task")

    @F.pandas_udf("long")
    def slot(numbers: pd.Series) -> pd.Series:
        return pd.Series(feistel(numbers.to_numpy(), total, key))

    placed = based.withColumn("slot", slot(F.col("base") + F.col("local")))
    return placed.select(
        "slot",
        F.floor(F.col("slot") / shard_records).alias("shard"),
        (F.col("slot") % shard_records).alias("record"),
        *("n_ids", "doc", "start", "ids"),
    )


_MANIFEST = "total long, length long, shard_records long, stride long, pad_id long, key long, tokenizer string"


def write_shards(
    ordered: DataFrame, path: str, total: int, key: int, tokenizer: str, length: int = LENGTH, shard_records: int = SHARD_RECORDS
) -> None:
    """One file per shard under ``path/shards``, its records in the order of their slots, and last a
    manifest under ``path/manifest``: without it the shards are not complete. A range of slots is
    sorted and written by one task."""

    def open_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                raw = [press.decompress(x.as_buffer()) for x in part.column("ids")]
                yield pa.RecordBatch.from_arrays([part.column("shard"), pa.array(raw, pa.binary())], ["shard", "raw"])
        release()

    spark = ordered.sparkSession
    ranges = ordered.select("shard", "slot", "ids").repartition("shard").sortWithinPartitions("shard", "slot")
    records = ranges.select("shard", "ids").mapInArrow(open_, "shard long, raw binary")
    lines = records.select("shard", F.col("raw").cast("string").alias("value"))
    lines.write.partitionBy("shard").option("lineSep", "\0\0").text(f"{path}/shards")
    told = [(total, length, shard_records, 2 * (length + 1), PAD_ID, key, os.path.basename(tokenizer))]
    spark.createDataFrame(told, _MANIFEST).coalesce(1).write.json(f"{path}/manifest")


def read_slots(spark: SparkSession, path: str, first: int = 0, past: int | None = None) -> DataFrame:
    """``slot, ids`` (two bytes each, padding included) of the slots from ``first`` to before ``past``.

    A shard that is missing or shorter than the manifest says is an error.
    """
    told = spark.read.schema(_MANIFEST).json(f"{path}/manifest").first()
    total, length, per, stride = told["total"], told["length"], told["shard_records"], told["stride"]
    past = total if past is None else min(past, total)
    if first >= past:
        return spark.createDataFrame([], "slot long, ids binary")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{path}/shards")
    shard = F.regexp_extract("path", r"shard=(\d+)/", 1).cast("long")
    files = files.select(shard.alias("shard"), "length", "content").where(F.col("shard").between(first // per, (past - 1) // per))
    whole = F.least(F.lit(per), total - F.col("shard") * per) * stride
    good = files.where(F.col("length") == whole).select("shard").count()  # lengths are read without contents
    if good != (past - 1) // per - first // per + 1:
        raise ValueError(f"{path}: shards are missing or cut off")
    files = files.select("shard", "content")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content"), strict=True):
                raw = memoryview(content.as_buffer())
                for k in range(0, len(raw) // stride, 128):
                    some = range(k, min(k + 128, len(raw) // stride))
                    slots = [shard * per + i for i in some]
                    ids = [bytes(raw[i * stride : i * stride + 2 * length]) for i in some]
                    yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int64()), pa.array(ids, pa.binary())], ["slot", "ids"])
        release()

    return files.mapInArrow(cut, "slot long, ids binary").where((F.col("slot") >= first) & (F.col("slot") < past))


def materialise_order(
    docs: DataFrame,
    path: str,
    key: int,
    id: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    length: int = LENGTH,
    shard_records: int = SHARD_RECORDS,
) -> DataFrame:
    """Writes the shards of ``docs`` under ``path``; returns ``slot, shard, offset, n_ids, id, start``.

    ``offset`` is the byte at which the record begins in its shard. Nulls, empty tables and repeated
    rows are as in :func:`token_sequences`; an empty table writes a manifest and no shard.
    """
    tokenizer = tokenizer or default_path()
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        made = materialize(token_sequences(docs, id, text, tokenizer, length), "sequences")
        ordered = training_order(made, key, shard_records)
        write_shards(ordered, path, made.count(), key, tokenizer, length, shard_records)
    return ordered.select(
        "slot", "shard", (F.col("record") * (2 * (length + 1))).alias("offset"), "n_ids", F.col("doc").alias(id), "start"
    )


def new_path(spark: SparkSession) -> str:
    """A new folder where all executors reach it."""
    return scratch_path(spark, "training-order")
