"""Prefix trie of conversations, built in sorted shards joined by a splitter skeleton.

A turn is the digest of its role and text with the text's length, a conversation the digests of its
turns end to end; texts never move. The paths are dealt to shards by ranges of (path, id) between
splitters drawn from the paths, so that a group of copies of any size is divided by ids. A node whose
members lie in several shards is a prefix of a splitter between them: the trie of the splitters, the
skeleton, is sent to all tasks. A task walks its sorted paths once, finishes every node outside the
skeleton, and emits one partial row per skeleton node, which a reduction sums up; ids that end at a
skeleton node travel in blocks and are digested in order.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statloom.llm.common import shuffle_partitions
from statloom.storage import materialize

#: Bytes of a turn's digest in a path.
DIGEST = 16
#: Shared turns are at most so many (the remainder of crc32 by one more).
SHARED, BLOCK = 5, 100
#: Paths drawn per splitter, and bytes of all splitters together: longer ones are cut off.
DRAWN, SPLITTER_BYTES = 20, 32 << 20
#: Ids of a skeleton node travel in blocks of so many.
ENDS = 20_000
#: Rows of an emitted batch.
ROWS = 20_000

_EMPTY = hashlib.sha256(b"").hexdigest()
_NODE = (
    "kind int, node long, conv_id long, depth long, parent_conv_id long, parent long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string, seq long, ends binary"
)
_NAMES = [c.split()[0] for c in _NODE.split(", ")]
_INNER, _PARTIAL, _ENDS = 0, 1, 2


def shared_turns(id: Column) -> Column:
    """Turns that a conversation takes from the first one of its block of ids."""
    return F.crc32(id.cast("string").cast("binary")) % (SHARED + 1)


def conversation_paths(turns: DataFrame, id: str = "conv_id", rebuilt: bool = True) -> DataFrame:
    """``conv_id, path, chars``: one row per conversation, its turns in order.

    ``turns`` has ``id, turn, role, text``. Turns go by ``turn``, NULL first, equal ones by their
    digest; repeated rows are turns of their own; NULL role or text is empty; rows without an id
    belong to no conversation. ``rebuilt`` replaces the first h turns by those of conversation
    ``c - c % 100``, as :func:`shared_turns` tells. The turns of one conversation, 24 bytes each,
    must fit into a task's memory, however long their texts are.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    c = F.col(id).cast("long")
    source = turns.where(F.col(id).isNotNull()).select(
        c.alias("c"),
        (c - c % BLOCK).alias("block"),
        F.col("turn").alias("turn"),
        F.substring(F.unhex(F.sha2(told, 256)), 1, DIGEST).alias("digest"),
        F.char_length(text).cast("long").alias("chars"),
        (shared_turns(c) if rebuilt else F.lit(0)).cast("int").alias("h"),
    )
    first = F.col("c") != F.col("block")
    dealt = source.repartition("block").sortWithinPartitions("block", first, "c", F.col("turn").asc_nulls_first(), "digest")
    return dealt.select("block", "c", "h", "digest", "chars").mapInArrow(_paths, "conv_id long, path binary, chars binary")


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of conversations, the first of a block before the others."""
    out: list[tuple] = []
    own: list[tuple[bytes, bytes]] = []  # parts of the open conversation
    now, base, head = None, None, (b"", b"")

    def close() -> None:
        nonlocal base, head
        block, c, h = now
        path, chars = b"".join(p for p, _ in own), b"".join(n for _, n in own)
        if block != base:
            base, head = block, (path[: SHARED * DIGEST], chars[: SHARED * 8]) if c == block else (b"", b"")
        out.append((c, head[0][: h * DIGEST] + path[h * DIGEST :], head[1][: h * 8] + chars[h * 8 :]))

    def made() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) if out else [[], [], []]
        kinds = (pa.int64(), pa.binary(), pa.binary())
        out_batch = pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(columns, kinds, strict=True)], ["conv_id", "path", "chars"])
        out.clear()
        return out_batch

    for batch in batches:
        if not batch.num_rows:
            continue
        c, h, block = (batch.column(x).to_numpy() for x in ("c", "h", "block"))
        digests = b"".join(batch.column("digest").to_pylist())
        chars = batch.column("chars").to_numpy().astype("<i8").tobytes()
        cuts = [0, *(np.flatnonzero(np.diff(c)) + 1).tolist(), len(c)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            key = (int(block[a]), int(c[a]), int(h[a]))
            if now is not None and key != now:
                close()
                own = []
            now = key
            own.append((digests[DIGEST * a : DIGEST * b], chars[8 * a : 8 * b]))
        if len(out) >= ROWS:
            yield made()
    if now is not None:
        close()
    yield made()


def splitters(paths: DataFrame, shards: int) -> list[tuple[bytes, int]]:
    """At most ``shards - 1`` places (path, id) that divide the paths about evenly.

    They come from the paths whose ids have the smallest hashes; only the chosen ones leave the
    cluster, and together they have at most ``SPLITTER_BYTES`` bytes.
    """
    if shards < 2:
        return []
    drawn = paths.select("path", "conv_id").orderBy(F.xxhash64("conv_id"), "conv_id").limit(DRAWN * shards)
    drawn = materialize(drawn, "drawn")
    n = drawn.count()
    most = SPLITTER_BYTES // shards // DIGEST * DIGEST
    ranked = drawn.withColumn("r", F.row_number().over(Window.orderBy("path", "conv_id")))  # DRAWN rows a shard
    chosen = ranked.where((F.col("r") > 1) & ((F.col("r") - 1) % max(1, n // shards) == 0))
    chosen = chosen.select(F.substring("path", 1, most).alias("path"), "conv_id").collect()
    return sorted({(bytes(r.path), r.conv_id) for r in chosen})[: shards - 1]


def skeleton_of(places: list[tuple[bytes, int]]) -> list[tuple[int, bytes]]:
    """The trie of the splitters' paths: parent's number and last digest of each node; the root is node 0."""
    nodes: list[tuple[int, bytes]] = [(-1, b"")]
    known: dict[tuple[int, bytes], int] = {}
    for path, _ in places:
        at = 0
        for k in range(0, len(path), DIGEST):
            key = (at, path[k : k + DIGEST])
            if key not in known:
                known[key] = len(nodes)
                nodes.append(key)
            at = known[key]
    return nodes


class _Open:
    """A node on the way to the path that is read."""

    __slots__ = ("depth", "node", "chars", "least", "n", "children", "leaves", "saved", "ends", "waiting")

    def __init__(self, depth: int, node: int, chars: int):
        self.depth, self.node, self.chars = depth, node, chars
        self.least: int | None = None
        self.n = self.children = self.leaves = self.saved = 0
        self.ends: object = None  # digest of the ids that end here, or those of a skeleton node
        self.waiting: list[tuple] = []


class Walk:
    """The trie of one shard's sorted paths; ``rows`` collects what is finished."""

    def __init__(self, skeleton: list[tuple[int, bytes]], shard: int):
        self.inside = {key: k for k, key in enumerate(skeleton)}
        self.shard, self.seq = shard, 0
        self.rows: list[tuple] = []
        self.way = [_Open(0, 0, 0)]
        self.path = b""

    def _close(self) -> None:
        top = self.way.pop()
        if top.node >= 0:
            self._send(top)
            self.rows.append((_PARTIAL, top.node, top.least, top.depth, None, None, top.n, top.children, top.leaves, top.saved, None, top.chars, None))
            return
        leaves = top.leaves if top.children else 1
        saved = top.saved + (top.n - 1) * top.chars
        ends = _EMPTY if top.ends is None else top.ends.hexdigest()
        for row in top.waiting:
            self.rows.append((*row[:4], top.least, *row[5:]))
        up = self.way[-1]
        row = (_INNER, None, top.least, top.depth, None, None, top.n, top.children, leaves, saved, ends, None, None)
        if up.node >= 0:
            self.rows.append((*row[:5], up.node, *row[6:]))
        else:
            up.waiting.append(row)
        up.n, up.children, up.leaves, up.saved = up.n + top.n, up.children + 1, up.leaves + leaves, up.saved + saved
        up.least = top.least if up.least is None else min(up.least, top.least)

    def _send(self, top: _Open) -> None:
        if top.ends:
            ids = ",".join(map(str, top.ends)).encode()
            self.rows.append((_ENDS, top.node, None, self.shard, None, None, None, None, None, None, None, self.seq, ids))
            self.seq += 1
            top.ends = None

    def add(self, path: bytes, chars: bytes, id: int) -> None:
        """The next path of the shard."""
        both = min(len(path), len(self.path)) // DIGEST
        same = both
        if path[: both * DIGEST] != self.path[: both * DIGEST]:
            same = next(k for k in range(both) if path[k * DIGEST : (k + 1) * DIGEST] != self.path[k * DIGEST : (k + 1) * DIGEST])
        while len(self.way) > same + 1:
            self._close()
        for k in range(same, len(path) // DIGEST):
            node = self.inside.get((self.way[-1].node, path[k * DIGEST : (k + 1) * DIGEST]), -1) if self.way[-1].node >= 0 else -1
            self.way.append(_Open(k + 1, node, int.from_bytes(chars[8 * k : 8 * k + 8], "little")))
        top = self.way[-1]
        top.n += 1
        top.least = id if top.least is None else min(top.least, id)
        if top.node >= 0:
            top.ends = top.ends or []
            top.ends.append(id)
            if len(top.ends) >= ENDS:
                self._send(top)
        elif top.ends is None:
            top.ends = hashlib.sha256(str(id).encode())
        else:
            top.ends.update(b",%d" % id)
        self.path = path

    def finish(self) -> None:
        while self.way:
            self._close()


def _rows_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(_NAMES)
    kinds = [pa.int32(), *[pa.int64()] * 9, pa.string(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(columns, kinds, strict=True)], _NAMES)


def _shard_of(places: list[tuple[bytes, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist(), strict=True)
            shards = [bisect_right(places, key) for key in keys]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shards, pa.int32())], ["conv_id", "path", "chars", "shard"])

    return run


def _walk(skeleton):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = None
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("shard", "path", "chars", "conv_id"))
            for shard, path, chars, id in zip(*columns, strict=True):
                if walk is None or walk.shard != shard:
                    if walk:
                        walk.finish()
                        yield _rows_batch(walk.rows)
                    walk = Walk(skeleton.value, shard)
                walk.add(path, chars, id)
                if len(walk.rows) >= ROWS:
                    yield _rows_batch(walk.rows)
                    walk.rows = []
        if walk:
            walk.finish()
            yield _rows_batch(walk.rows)

    return run


def _digest_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by node and place: one digest of each node's ids."""
    now, made, done = None, None, []
    for batch in batches:
        for node, ids in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist(), strict=True):
            if node != now:
                if made:
                    done.append((now, made.hexdigest()))
                now, made = node, hashlib.sha256(ids)
            else:
                made.update(b"," + ids)
    if made:
        done.append((now, made.hexdigest()))
    columns = list(zip(*done, strict=True)) if done else [[], []]
    yield pa.RecordBatch.from_arrays([pa.array(list(columns[0]), pa.int64()), pa.array(list(columns[1]), pa.string())], ["node", "ends_sha256"])


def _rolled_up(skeleton: list[tuple[int, bytes]], summed: dict[int, tuple]) -> list[tuple]:
    """The finished skeleton nodes, from the sums of what hangs on each outside the skeleton."""
    size = len(skeleton)
    n, children, leaves, saved = ([0] * size for _ in range(4))
    least: list[int | None] = [None] * size
    depth, chars = [0] * size, [0] * size
    for k in range(size):
        depth[k] = depth[skeleton[k][0]] + 1 if k else 0
    for k in range(size - 1, -1, -1):  # children have higher numbers than their parents
        own = summed.get(k)
        if own:
            least_own, n_own, children_own, leaves_own, saved_own, chars[k] = own
            n[k], children[k], leaves[k], saved[k] = n[k] + n_own, children[k] + children_own, leaves[k] + leaves_own, saved[k] + saved_own
            least[k] = min((x for x in (least[k], least_own) if x is not None), default=None)
        if not n[k]:
            continue
        leaves[k] = leaves[k] if children[k] else 1
        saved[k] += (n[k] - 1) * chars[k]
        if k:
            up = skeleton[k][0]
            n[up], children[up], leaves[up], saved[up] = n[up] + n[k], children[up] + 1, leaves[up] + leaves[k], saved[up] + saved[k]
            least[up] = least[k] if least[up] is None else min(least[up], least[k])
    rows = []
    for k in range(size):
        if n[k]:
            parent = least[skeleton[k][0]] if k else None
            rows.append((k, least[k], depth[k], parent, n[k], children[k], leaves[k], saved[k]))
    return rows


def prefix_trie(turns: DataFrame, id: str = "conv_id", rebuilt: bool = True, shards: int | None = None) -> DataFrame:
    """One row per trie node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``.

    ``conv_id`` is the smallest member. The root has depth 0, no parent and no text. A conversation
    without turns is a member of the root alone. NULLs, equal turns and repeated rows are as in
    :func:`conversation_paths`; very long texts count their code points and are otherwise digests.
    An empty table has no node. Other columns of the input are not read. ``shards`` is the number of
    ranges (default: shuffle partitions); the result does not depend on it.
    """
    spark = turns.sparkSession
    shards = shards or shuffle_partitions(spark)
    paths = materialize(conversation_paths(turns, id, rebuilt), "paths")
    places = splitters(paths, shards)
    skeleton = skeleton_of(places)
    sent = spark.sparkContext.broadcast(skeleton)
    dealt = paths.mapInArrow(_shard_of(places), "conv_id long, path binary, chars binary, shard int")
    dealt = dealt.repartitionById(len(places) + 1, F.col("shard")).sortWithinPartitions("shard", "path", "conv_id")
    nodes = materialize(dealt.mapInArrow(_walk(sent), _NODE), "nodes")

    partial = nodes.where(F.col("kind") == _PARTIAL).groupBy("node").agg(
        F.min("conv_id"), F.sum("n_convs"), F.sum("n_children"), F.sum("n_leaves"), F.sum("saved_tokens"), F.max("seq")
    )
    # one row per skeleton node, whose number the splitters' bytes bound
    rows = _rolled_up(skeleton, {r[0]: tuple(r)[1:] for r in partial.collect()})
    schema = "node long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
    inner = spark.createDataFrame(rows, schema)
    # ids in the order of shards and of their blocks there, read one after the other
    ends = nodes.where(F.col("kind") == _ENDS).select("node", F.col("depth").alias("shard"), "seq", "ends")
    ends = ends.repartition("node").sortWithinPartitions("node", "shard", "seq").select("node", "ends")
    ends = ends.mapInArrow(_digest_ends, "node long, ends_sha256 string")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    tops = inner.join(ends, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_EMPTY)))
    known = F.broadcast(inner.select(F.col("node").alias("parent"), F.col("conv_id").alias("__top")))
    below = nodes.where(F.col("kind") == _INNER).join(known, "parent", "left")
    below = below.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "__top"))
    return tops.select(*columns).unionByName(below.select(*columns))
