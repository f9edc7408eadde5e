"""Line dedup with a log-template tree.

A line's words are masked (a word with a digit is a variable field) and the line goes down a tree of
fixed depth: first by its number of words, then by its leading words. In a leaf the words that most
texts have at a position form the template, the other positions are variable; a line belongs to it
if enough of its words agree. After a few such rounds the rest of the leaf is divided by seeds: the
most frequent remaining line (the smallest hash among equals) takes all that agree with it, until no
line is left, so a leaf has as many templates as it holds. A template that recurs in several different
texts is dropped everywhere but at its first occurrence.

Texts that are equal count once, so that exact copies of a document do not empty it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.llm.common import arrow_rows, chunks, distinct_words, mixed, ragged, release, texts_of
from statloom.storage import join_bounded, materialize

#: Leading words on the way to a leaf, share of a line's words after these that must agree with its
#: template (one at least), share of a leaf's texts that make a word part of it, rounds by majority before those by seed.
DEPTH, AGREE, CONSTANT, ROUNDS = 3, 0.7, 0.5, 2
#: Lines with fewer words stay; short ones must recur in more texts than others.
LEAST_WORDS, SHORT_WORDS, SHORT_TEXTS, TEXTS = 3, 8, 10, 3

#: A leaf whose rest has at most this many lines and words is divided in one task; a larger one meets
#: in blocks. Both give the same templates.
LEAF_LINES, LEAF_WORDS = 2_000, 4_000_000

#: Bytes of lines that a task cuts into words at once (a longer line is alone), documents of a batch
#: that goes to Python, words of the lines that are counted by position at once.
CHUNK, BATCH_ROWS, CHUNK_WORDS = 2 << 20, 1_000, 1 << 19


def _letters(words: list[bytes]) -> np.ndarray:
    """The hash of each word, where all words with a digit are the same one."""
    flat = np.frombuffer(b"".join(words), np.uint8)
    size = np.fromiter(map(len, words), np.int64, len(words))
    variable = np.logical_or.reduceat((flat >= ord("0")) & (flat <= ord("9")), np.cumsum(size) - size)
    letter = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    letter[variable] = xxhash.xxh64_intdigest(b"<*>")
    return letter


def _slices(texts: list[bytes], most: int) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """Lines of all texts, the text of each and its number there, in runs of ``most`` bytes (a longer line is alone)."""
    lines, row, number, held = [], [], [], 0
    for i, text in enumerate(texts):
        for k, line in enumerate(text.split(b"\n")):
            if lines and held + len(line) > most:
                yield lines, np.array(row), np.array(number)
                lines, row, number, held = [], [], [], 0
            lines.append(line), row.append(i), number.append(k)
            held += len(line) + 1
    if lines:
        yield lines, np.array(row), np.array(number)


def _lines(id: str, text: str, depth: int, least: int, schema: pa.Schema):
    def hashed(lines: list[bytes], row: np.ndarray, number: np.ndarray, ids: pa.Array, hashes: np.ndarray) -> pa.RecordBatch | None:
        distinct, which, size = distinct_words(lines)
        long = size >= least
        if not long.any():
            return None
        letter = _letters(distinct)[which[np.repeat(long, size)]]
        row, number, size = row[long], number[long], size[long]
        start = np.cumsum(size) - size
        most = int(size.max())
        places, sizes = mixed(np.arange(1, most + 1)), mixed(np.arange(most + 1))[size]
        with np.errstate(over="ignore"):
            placed = mixed(letter + places[ragged(np.zeros_like(size), size)])
            line, leaf = np.add.reduceat(placed, start) + sizes, sizes
            for k in range(depth):
                deep = size > k
                leaf[deep] += placed[start[deep] + k]
        short = pa.py_buffer(letter.astype("<u2"))  # 16 bits of each word tell positions apart
        ends = pa.py_buffer(np.concatenate([[0], 2 * (start + size)]).astype(np.int32))
        columns = {
            "id": ids.take(pa.array(row)),
            "text_hash": pa.array(hashes[row]),
            "line_no": pa.array(number),
            "line": pa.array(line.view(np.int64)),
            "leaf": pa.array(leaf.view(np.int64)),
            "n": pa.array(size),
            "letters": pa.Array.from_buffers(pa.binary(), len(size), [None, ends, short]),
        }
        return pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text, CHUNK):
            texts = texts_of(batch, text)
            hashes = np.array([xxhash.xxh64_intdigest(t) for t in texts], np.uint64).view(np.int64)
            for lines, row, number in _slices(texts, CHUNK):
                made = hashed(lines, row, number, batch.column(id), hashes)
                if made is not None:
                    yield made
        release()

    return run


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per line and position."""
    for batch in chunks(batches, "letters", 2 * CHUNK_WORDS):
        size = batch.column("n").to_numpy()
        letters = np.frombuffer(b"".join(batch.column("letters").to_pylist()), "<u2").astype(np.int32)
        spread = pa.array(np.repeat(np.arange(batch.num_rows), size))
        place = ragged(np.zeros(len(size), np.int64), size.astype(np.int64)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("leaf").take(spread), pa.array(place), pa.array(letters), batch.column("texts").take(spread)],
            ["leaf", "pos", "letter", "texts"],
        )


def _needed(n: int, agree: float, depth: int) -> int:
    """Words beyond the leading ones in which two lines of ``n`` words and one leaf must agree."""
    return max(1, math.ceil(agree * max(n - depth, 0) - 1e-9))


def _agreeing(agree: float, depth: int):
    """The lines that agree with the template of their leaf in enough places beyond the leading words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for letters, places, wanted in zip(*(batch.column(c).to_pylist() for c in ("letters", "places", "wanted")), strict=True):
                own = np.frombuffer(letters, "<u2")
                near.append(bool((own[places] == np.array(wanted, np.int64)).sum() >= _needed(len(own), agree, depth)))
            yield pa.RecordBatch.from_arrays([batch.column("line"), batch.column("leaf")], ["line", "leaf"]).filter(pa.array(near, pa.bool_()))

    return run


def _banded(agree: float, depth: int):
    """One row per line and band of positions.

    Lines that may differ in d positions are equal in at least one of d + 1 bands, so lines that
    agree share a block (leaf and words of a band).
    """

    def told(batch: pa.RecordBatch, rows: list[int], keys: list[int]) -> pa.RecordBatch:
        taken = batch.select(["leaf", "line", "n", "texts", "letters"]).take(pa.array(rows, pa.int64()))
        key = pa.array(np.array(keys, np.uint64).view(np.int64))
        return pa.RecordBatch.from_arrays([key, *taken.columns], ["block", "leaf", "line", "n", "texts", "letters"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, keys, held = [], [], 0
            for i, (leaf, n, letters) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("leaf", "n", "letters")), strict=True)):
                need, beyond = _needed(n, agree, depth), max(n - depth, 0)
                bands = max(beyond - need, 0) + 1
                cuts = [depth + beyond * k // bands for k in range(bands + 1)]
                for k in range(bands):
                    own = leaf.to_bytes(8, "little", signed=True) + k.to_bytes(4, "little") + letters[2 * cuts[k] : 2 * cuts[k + 1]]
                    rows.append(i), keys.append(xxhash.xxh64_intdigest(own))
                    held += len(letters)
                    if held >= CHUNK:  # each band has a copy of the line
                        yield told(batch, rows, keys)
                        rows, keys, held = [], [], 0
            yield told(batch, rows, keys)

    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block, in batches that hold whole blocks."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        block = batch.column("block").to_numpy()
        if held and block[0] != last:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
        last = block[-1]
        cut = int(np.searchsorted(block, last))
        if cut:
            yield from pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks().to_batches()
            held = []
        held.append(batch.slice(cut))
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _firsts(words: np.ndarray, need: int, seeds: bool) -> np.ndarray:
    """Per row the first row that agrees with it (itself if none before does).

    With ``seeds`` rows that follow another are passed over: the row is then the seed that takes it.
    """
    first, rest = np.arange(len(words)), np.arange(len(words))
    for c in range(len(words)):
        if not len(rest):
            break
        if seeds and first[c] != c:
            continue
        rest = rest[rest > c]
        near = (words[rest] == words[c]).sum(axis=1) >= need
        first[rest[near]] = c
        rest = rest[~near]
    return first


def _pointing(agree: float, depth: int, seeds: bool) -> Callable:
    """Per row the line it follows in its block, in the order of falling ``texts`` and rising hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            block, leaf, line, n, texts = (batch.column(c).to_numpy() for c in ("block", "leaf", "line", "n", "texts"))
            letters = batch.column("letters").to_pylist()
            order = np.lexsort((line, -texts, leaf, block))
            cuts = np.flatnonzero((np.diff(block[order]) != 0) | (np.diff(leaf[order]) != 0)) + 1
            up = np.arange(len(order))
            for a, b in zip([0, *cuts], [*cuts, len(order)], strict=True):
                if b - a > 1:
                    own = order[a:b]
                    words = np.frombuffer(b"".join(letters[i] for i in own), "<u2").reshape(b - a, -1)[:, depth:]
                    up[own] = own[_firsts(words, _needed(int(n[own[0]]), agree, depth), seeds)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (line, leaf, line[up], texts[up])], ["line", "leaf", "up", "up_texts"]
            )

    return run


_POINTED = "line long, leaf long, up long, up_texts long"


def seeded_templates(lines: DataFrame, agree: float, depth: int) -> DataFrame:
    """``(line, template)``: per leaf the most frequent remaining line takes all that agree with it.

    Small leaves are divided in one task. In others a line whose every agreeing line ranks lower is a
    seed whatever comes before it in the leaf; it takes the lines whose first agreeing line it is, and
    what is left goes on, until nothing is.
    """
    columns = ["leaf", "line", "n", "texts", "letters"]
    sizes = lines.groupBy("leaf").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("w"))
    crowded = (F.col("c") > LEAF_LINES) | (F.col("w") > LEAF_WORDS)
    sizes = materialize(sizes.where("c > 1").select("leaf", crowded.alias("crowded")), "leaf-sizes")

    def pointed(blocks: DataFrame, seeds: bool) -> DataFrame:
        return blocks.repartition("block").sortWithinPartitions("block").mapInArrow(_pointing(agree, depth, seeds), _POINTED)

    few = lines.join(sizes.where("NOT crowded").select("leaf"), "leaf", "left_semi")
    few = pointed(few.select(F.col("leaf").alias("block"), *columns), True)
    found = materialize(few.select("line", F.xxhash64("leaf", "up").alias("template")), "seeded")
    rest = materialize(lines.join(sizes.where("crowded").select("leaf"), "leaf", "left_semi").select(*columns), "crowded")
    seeds = rest.limit(0)
    while not rest.isEmpty():
        schema = "block long, leaf long, line long, n int, texts long, letters binary"
        up = pointed(rest.unionByName(seeds).mapInArrow(_banded(agree, depth), schema), False)
        up = up.groupBy("leaf", "line").agg(F.min(F.struct((-F.col("up_texts")).alias("t"), "up")).alias("up"))
        up = materialize(up.select("leaf", "line", F.col("up.up").alias("up")), "followed")
        mine = join_bounded(up, up.where("line = up").select("up"), ["up"])
        mine = materialize(mine.join(rest.select("line"), "line", "left_semi"), "seeded")
        found = found.unionByName(mine.select("line", F.xxhash64("leaf", "up").alias("template")))
        # seeds stay to be found by lines whose first agreeing line went to another seed
        seeds = seeds.unionByName(rest.join(mine.where("line = up").select("line"), "line", "left_semi").select(*columns))
        rest = materialize(rest.join(mine.select("line"), "line", "left_anti").select(*columns), "crowded")
    return found


def leaf_templates(lines: DataFrame, agree: float, constant: float, rounds: int, depth: int) -> DataFrame:
    """``(line, template)`` of the lines of leaves with several lines.

    ``lines`` has ``line, leaf, n, letters, texts``, one row per distinct line. Words are counted per
    leaf and position, so that a leaf of any size is summed up before its rows move.
    """
    found, rest = None, lines
    for number in range(rounds):
        crowded = materialize(rest.groupBy("leaf").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "leaves")
        rest = materialize(rest.join(crowded, "leaf", "left_semi"), "leaf-lines")
        if rest.isEmpty():
            break
        cells = rest.select("leaf", "n", "letters", "texts").mapInArrow(_cells, "leaf long, pos int, letter int, texts long")
        counts = cells.groupBy("leaf", "pos", "letter").agg(F.sum("texts").alias("texts"))
        best = counts.groupBy("leaf", "pos").agg(
            F.max(F.struct("texts", F.col("letter"))).alias("top"), F.sum("texts").alias("all")
        )
        kept = best.where((F.col("pos") >= depth) & (F.col("top.texts") >= constant * F.col("all"))).select("leaf", F.struct("pos", "top.letter").alias("p"))
        # as many entries as a line of the leaf has words
        template = kept.groupBy("leaf").agg(F.array_sort(F.collect_list("p")).alias("p"))
        template = materialize(template.select("leaf", F.col("p.pos").alias("places"), F.col("p.letter").alias("wanted")), "templates")
        shares = rest.join(template, "leaf").select("line", "leaf", "letters", "places", "wanted")
        near = materialize(shares.mapInArrow(_agreeing(agree, depth), "line long, leaf long"), "near")
        mine = near.select("line", F.xxhash64("leaf", F.lit(number)).alias("template"))
        found = mine if found is None else found.unionByName(mine)
        rest = materialize(rest.join(near.select("line", "leaf"), ["line", "leaf"], "left_anti"), "rest")
    seeded = seeded_templates(rest, agree, depth)
    return seeded if found is None else found.unionByName(seeded)


def _kept(lines: Column, dropped: Column) -> Column:
    """The lines between those that are dropped, whose numbers rise; each line is copied once."""

    def between(both: Column) -> Column:
        after = F.concat(F.array(F.lit(-1)), both["dropped"])
        before = F.concat(both["dropped"], F.array(F.size(both["lines"])))
        gaps = F.arrays_zip(after.alias("after"), before.alias("before"))
        return F.flatten(F.transform(gaps, lambda g: F.slice(both["lines"], g["after"] + 2, g["before"] - g["after"] - 1)))

    # an array of one struct, so that the lines are split once and not for each gap
    return F.transform(F.array(F.struct(lines.alias("lines"), dropped.alias("dropped"))), between)[0]


def drop_recurring_lines(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    texts: int = TEXTS,
    short_texts: int = SHORT_TEXTS,
    short_words: int = SHORT_WORDS,
    least_words: int = LEAST_WORDS,
    depth: int = DEPTH,
    agree: float = AGREE,
    constant: float = CONSTANT,
    rounds: int = ROUNDS,
) -> DataFrame:
    """The input rows without the lines of recurring templates, with ``n_lines`` and ``dropped``.

    ``dropped`` holds the numbers (from 0) of the lines that were taken out. A template recurs when
    it occurs in ``texts`` different texts, or ``short_texts`` if its lines have fewer than
    ``short_words`` words; its first occurrence, by id and line number, stays. Lines of fewer than
    ``least_words`` words stay. NULL texts stay NULL (no lines); a row with a NULL id counts, but
    keeps its lines. Rows with the same id lose the same line numbers. Empty tables give no rows.
    Input columns that bear an added name are replaced.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    schema = f"id {kind}, text_hash long, line_no int, line long, leaf long, n int, letters binary"
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(spark.createDataFrame([], schema).schema)
    with arrow_rows(spark, BATCH_ROWS):
        lines = materialize(source.mapInArrow(_lines("id", "text", depth, least_words, arrow), schema), "lines")

    # one row per line and text, then per line: hot lines are summed up before they move
    first = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "line_no"))).alias("first")
    in_texts = lines.groupBy("line", "leaf", "n", "text_hash").agg(first)
    per_line = in_texts.groupBy("line", "leaf", "n").agg(F.count(F.lit(1)).alias("texts"), F.min("first").alias("first"))
    per_line = materialize(per_line, "line-counts")

    leaves = per_line.groupBy("leaf").agg(F.count(F.lit(1)).alias("c"), F.sum("texts").alias("t"))
    leaves = materialize(leaves.where((F.col("c") > 1) & (F.col("t") >= texts)).select("leaf"), "leaves")
    shared = per_line.join(leaves, "leaf", "left_semi").select("line", "leaf", "n", "texts")
    shared = materialize(shared, "leaf-lines")
    letters = lines.select("line", "leaf", "letters").join(leaves, "leaf", "left_semi")
    letters = letters.groupBy("line").agg(F.min("letters").alias("letters"))
    members = leaf_templates(shared.join(materialize(letters, "letters"), "line"), agree, constant, rounds, depth)
    members = materialize(members, "members")

    named = per_line.select("line", "n", "texts", "first").join(members, "line", "left")
    named = materialize(named.withColumn("template", F.coalesce("template", "line")), "named")
    total = named.groupBy("template", "n").agg(
        F.sum("texts").alias("texts"), F.min("first").alias("first"), F.count(F.lit(1)).alias("lines")
    )
    enough = F.when(F.col("n") < short_words, short_texts).otherwise(texts)
    total = total.withColumn("enough", enough).where("texts >= enough").select("template", "first", "lines", "enough")
    marked = join_bounded(named.select("line", "template"), total, ["template"])
    marked = materialize(marked, "marked")
    # a text with several lines of a template counts once
    several = marked.where("lines > 1").select("line", "template", "enough")
    held = lines.select("line", "text_hash").join(several, "line").groupBy("template", "text_hash", "enough").agg(F.lit(1))
    held = held.groupBy("template", "enough").agg(F.count(F.lit(1)).alias("texts"))
    recurring = materialize(held.where("texts >= enough").select("template"), "recurring")
    several = join_bounded(marked.where("lines > 1"), recurring, ["template"])
    marked = marked.where("lines = 1").select("line", "first").unionByName(several.select("line", "first"))
    gone = lines.select("id", "line_no", "line").join(marked, "line")
    gone = gone.where((F.col("id") != F.col("first.id")) | (F.col("line_no") != F.col("first.line_no")))
    per_doc = materialize(gone.groupBy("id").agg(F.array_sort(F.collect_set("line_no")).alias("dropped")), "dropped")

    carried = [c for c in docs.columns if c.lower() not in ("n_lines", "dropped")]
    # merged by sorting at every size, as the list of dropped lines grows with the documents
    gone = per_doc.withColumnRenamed("id", "__id").hint("merge")
    joined = docs.select(*carried).join(gone, F.col(id) == F.col("__id"), "left")
    split = F.split(F.col(text).cast("string"), "\n", -1)
    cleaned = F.when(F.col("dropped").isNull(), F.col(text)).otherwise(F.array_join(_kept(split, F.col("dropped")), "\n"))
    return joined.select(
        *[cleaned.alias(c) if c == text else F.col(c) for c in carried],
        F.coalesce(F.size(split), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"),
    )
