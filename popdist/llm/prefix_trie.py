"""The prefix trie of conversations, by a splitter skeleton.

A conversation is a path: one 16-byte digest per turn.  Paths are cut into
shards by splitters, real (path, conv_id) keys drawn by hash.  A node whose
members lie in two shards is a prefix of the splitter between them, so the
trie of the splitters' paths, the skeleton, holds every node that no single
shard can finish.  Splitters are broadcast; each shard sorts its paths,
finishes all other nodes in one pass with a stack, and sends partial
aggregates for the skeleton's nodes, which are summed and then rolled up along
the skeleton's preorder.

Equal paths are ordered by conv_id and splitters carry conv_ids too, so a
conversation with a third of all copies spreads over shards like any other.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from popdist.llm.common import staged

WIDTH = 16  # bytes of a turn's digest
CONVS_PER_SHARD = 512
DRAWN_PER_SHARD = 8
#: bound on the splitters' bytes, drawn paths included
SKELETON_BYTES = 64 << 20
PIECE_IDS = 8192
WORD = r"[^\x20\x09-\x0D]+"
HEAD = 3  # turns that a rebuilt conversation can take from another

NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string")
_PART = ("kind int, sid long, under long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
         "n_leaves long, saved_tokens long, words long, ends_sha256 string, shard int, piece int, ids string")


def turn_digest(role: Column, text: Column) -> Column:
    """16 bytes that name (role, text); the role's length keeps them apart."""
    return F.substring(F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)), 1, WIDTH)


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, path, words): every conversation's path after its first turns
    were exchanged, and the words of each turn on it."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").cast("long").alias("turn"), turn_digest(role, text).alias("sym"),
                 F.regexp_count(text, F.lit(WORD)).cast("long").alias("words")).alias("t"))
    own = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))  # null turns first
    own = staged(own.select("conv_id", F.transform("turns", lambda t: F.struct(t["sym"].alias("sym"), t["words"].alias("words"))).alias("turns")),
                 "trie-own")
    heads = own.select(F.col("conv_id").alias("base"), F.slice("turns", 1, HEAD).alias("head"))
    none = F.slice("turns", 1, 0)
    h = F.pmod(F.crc32(F.encode(F.col("conv_id").cast("string"), "utf-8")), F.lit(HEAD + 1)).cast("int")
    both = own.withColumn("base", F.expr("conv_id - conv_id % 20")).join(heads, "base", "left")
    turns = F.concat(F.slice(F.coalesce("head", none), F.lit(1), h),
                     F.expr("slice(turns, h + 1, greatest(size(turns) - h, 0))"))
    both = both.withColumn("h", h).withColumn("turns", turns)
    return staged(both.select(
        "conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["sym"])), "")).alias("path"),
        F.transform("turns", lambda t: t["words"]).alias("words")), "trie-paths")


def _lcp(a: bytes, b: bytes) -> int:
    """Turns that two paths share from the start."""
    lo, hi = 0, min(len(a), len(b)) // WIDTH
    if a[:hi * WIDTH] == b[:hi * WIDTH]:
        return hi
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo * WIDTH:mid * WIDTH] == b[lo * WIDTH:mid * WIDTH]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def splitters(paths: DataFrame, per_shard: int) -> list[tuple[bytes, int]]:
    """Sorted (path, conv_id) keys that cut ``paths`` into shards of about
    ``per_shard``: drawn by hash, and fewer where paths are so long that the
    drawn ones would pass ``SKELETON_BYTES``."""
    n, longest = paths.agg(F.count("*"), F.max(F.length("path"))).first()
    shards = -(-n // per_shard)
    draw = min(shards * DRAWN_PER_SHARD, SKELETON_BYTES // max(longest or 0, 64))
    if shards < 2 or not draw:
        return []
    drawn = paths.select("path", "conv_id").orderBy(F.xxhash64("conv_id"), "conv_id").limit(draw).collect()
    keys = sorted((bytes(r.path), r.conv_id) for r in drawn)
    return sorted({keys[len(keys) * i // shards] for i in range(1, shards)})


class Skeleton:
    """The trie of the splitters' paths, its nodes numbered in preorder."""

    def __init__(self, keys: list[tuple[bytes, int]]):
        self.keys = keys
        self.numbers: list[np.ndarray] = []
        depth, parent = [0], [-1]
        before = b""
        line = np.zeros(1, np.int64)
        for path, _ in keys:
            same = _lcp(before, path)
            new = np.arange(len(depth), len(depth) + len(path) // WIDTH - same, dtype=np.int64)
            line = np.concatenate([line[:same + 1], new])
            depth += range(same + 1, len(line))
            parent += line[same:-1].tolist()
            self.numbers.append(line)
            before = path
        self.depth, self.parent = np.array(depth), np.array(parent)

    def last(self) -> np.ndarray:
        """The last node, in preorder, of every node's subtree."""
        out = np.arange(len(self.depth))
        for i in range(len(out) - 1, 0, -1):
            out[self.parent[i]] = max(out[self.parent[i]], out[i])
        return out

    def shard(self, path: bytes, conv_id: int) -> int:
        return bisect_right(self.keys, (path, conv_id))

    def line(self, shard: int, path: bytes) -> np.ndarray:
        """Numbers of the skeleton nodes that are prefixes of a shard's path."""
        best = np.zeros(1, np.int64)
        for j in (shard - 1, shard):
            if 0 <= j < len(self.keys):
                same = _lcp(self.keys[j][0], path)
                if same + 1 > len(best):
                    best = self.numbers[j][:same + 1]
        return best


class _Node:
    __slots__ = ("sid", "words", "n", "least", "kids", "leaves", "saved", "sha", "ids", "below")

    def __init__(self, sid: int, words: int):
        self.sid, self.words, self.n, self.least = sid, words, 0, None
        self.kids = self.leaves = self.saved = 0
        self.sha, self.ids, self.below = None, [], []


class _Shard:
    """One pass over a shard's sorted paths."""

    def __init__(self, number: int, skeleton: Skeleton):
        self.number, self.skeleton = number, skeleton
        self.stack: list[_Node] = []
        self.before = b""
        self.out: list[tuple] = []
        self.pieces: dict[int, int] = {}

    def _piece(self, node: _Node) -> None:
        if node.ids:
            at = self.pieces[node.sid] = self.pieces.get(node.sid, -1) + 1
            self.out.append((2, node.sid) + (None,) * 10 + (self.number, at, ",".join(map(str, node.ids))))
            node.ids = []

    def _close(self) -> None:
        node = self.stack.pop()
        depth = len(self.stack)
        up = self.stack[-1] if self.stack else None
        if node.sid >= 0:  # a skeleton node: what this shard knows of it
            self._piece(node)
            self.out.append((1, node.sid, None, node.least, depth, None, node.n, node.kids, node.leaves, node.saved,
                             node.words, None, None, None, None))
            if up is not None:
                up.n += node.n
                up.least = node.least if up.least is None else min(up.least, node.least)
            return
        if not node.kids:
            node.leaves += 1
        node.saved += (node.n - 1) * node.words
        for row in node.below:
            self.out.append((0, None, None, row[0], row[1], node.least, *row[3:]))
        ends = node.sha.hexdigest() if node.sha else hashlib.sha256(b"").hexdigest()
        row = (node.least, depth, None, node.n, node.kids, node.leaves, node.saved, None, ends, None, None, None)
        if up.sid >= 0:  # the merged skeleton knows that parent's smallest member
            self.out.append((0, None, up.sid, *row))
        else:
            up.below.append(row)
        up.n += node.n
        up.least = node.least if up.least is None else min(up.least, node.least)
        up.kids += 1
        up.leaves += node.leaves
        up.saved += node.saved

    def add(self, path: bytes, conv_id: int, words: list[int]) -> None:
        keep = _lcp(self.before, path) if self.stack else -1
        while len(self.stack) > keep + 1:
            self._close()
        if len(self.stack) <= len(words):
            line = self.skeleton.line(self.number, path)
            for d in range(len(self.stack), len(words) + 1):
                self.stack.append(_Node(int(line[d]) if d < len(line) else -1, words[d - 1] if d else 0))
        node = self.stack[-1]
        node.n += 1
        node.least = conv_id if node.least is None else min(node.least, conv_id)
        if node.sid >= 0:
            node.ids.append(conv_id)
            if len(node.ids) >= PIECE_IDS:
                self._piece(node)
        elif node.sha is None:
            node.sha = hashlib.sha256(str(conv_id).encode())
        else:
            node.sha.update(f",{conv_id}".encode())
        self.before = path

    def flush(self, end: bool) -> list[tuple]:
        while end and self.stack:
            self._close()
        rows, self.out = self.out, []
        return rows


def _arrow(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


_PART_ARROW = pa.schema([(f.split()[0], {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}[f.split()[1]])
                         for f in _PART.split(", ")])


def _deal(batches: Iterator[pa.RecordBatch], skeleton: Skeleton):
    for b in batches:
        shards = [skeleton.shard(p, c) for p, c in zip(b.column("path").to_pylist(), b.column("conv_id").to_pylist())]
        yield pa.RecordBatch.from_pydict({c: b.column(c) for c in ("conv_id", "path", "words")}
                                         | {"shard": pa.array(shards, pa.int32())})


def _finish(batches: Iterator[pa.RecordBatch], skeleton: Skeleton, batch: int = 4096):
    now: _Shard | None = None
    rows: list[tuple] = []
    for b in batches:
        for shard, path, conv, words in zip(*(b.column(c).to_pylist() for c in ("shard", "path", "conv_id", "words"))):
            if now is None or now.number != shard:
                rows += now.flush(True) if now else []
                now = _Shard(shard, skeleton)
            now.add(path, conv, words)
        rows += now.flush(False) if now else []
        while len(rows) >= batch:
            yield _arrow(rows[:batch], _PART_ARROW)
            rows = rows[batch:]
    rows += now.flush(True) if now else []
    for i in range(0, len(rows), batch):
        yield _arrow(rows[i:i + batch], _PART_ARROW)


def _hash_pieces(batches: Iterator[pa.RecordBatch]):
    """SHA-256 of each node's id list from its pieces, in order."""
    at, sha = None, None
    for b in batches:
        sids, shas = [], []
        for sid, ids in zip(b.column("sid").to_pylist(), b.column("ids").to_pylist()):
            if sid != at:
                if at is not None:
                    sids.append(at)
                    shas.append(sha.hexdigest())
                at, sha = sid, hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        yield pa.RecordBatch.from_pydict({"sid": pa.array(sids, pa.int64()), "ends_sha256": pa.array(shas, pa.string())})
    if at is not None:
        yield pa.RecordBatch.from_pydict({"sid": [at], "ends_sha256": [sha.hexdigest()]})


def _cumulated(rows: DataFrame, value: str, out: str, block: int = 4096) -> DataFrame:
    """Sum of ``value`` up to each ``sid``; windows hold ``block`` rows, and one row per block."""
    spread = rows.withColumn("_blk", F.expr(f"sid div {block}"))
    inner = Window.partitionBy("_blk").orderBy("sid").rowsBetween(Window.unboundedPreceding, 0)
    sums = spread.groupBy("_blk").agg(F.sum(value).alias("_s"))
    before = Window.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_blk", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_o"))
    return spread.withColumn(out, F.sum(value).over(inner)).join(sums, "_blk").withColumn(
        out, F.col(out) + F.col("_o")).drop("_blk", "_o")


def trie(paths: DataFrame, per_shard: int = CONVS_PER_SHARD) -> DataFrame:
    """One row per node of the trie of ``paths`` (conv_id, path, words): the
    smallest member, depth, the parent's smallest member, members, children,
    leaves and saved words of the subtree, and the digest of the conversations
    that end there.  No conversations, no nodes.  A path is one value of a row."""
    spark = paths.sparkSession
    skeleton = Skeleton(splitters(paths, per_shard))
    shared = spark.sparkContext.broadcast(skeleton)
    shards = len(skeleton.keys) + 1
    dealt = paths.mapInArrow(lambda it: _deal(it, shared.value), "conv_id long, path binary, words array<long>, shard int")
    sorted_ = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "path", "conv_id")
    parts = staged(sorted_.mapInArrow(lambda it: _finish(it, shared.value), _PART), "trie-parts")

    meta = spark.createDataFrame(pa.table({
        "sid": np.arange(len(skeleton.depth)), "up": skeleton.parent, "last": skeleton.last(),
        "forks": np.bincount(skeleton.parent[1:], minlength=len(skeleton.depth))}))
    sums = parts.where("kind = 1").groupBy("sid").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved"), F.max("words").alias("words"))
    sums = sums.join(meta, "sid").withColumn("n_children", F.col("n_children") + F.col("forks"))
    sums = sums.withColumn("n_leaves", F.col("n_leaves") + (F.col("n_children") == 0).cast("long")).withColumn(
        "saved", F.col("saved") + (F.col("n_convs") - 1) * F.col("words"))
    sums = staged(_cumulated(_cumulated(sums, "n_leaves", "leaves_to"), "saved", "saved_to"), "trie-skeleton")
    ends = sums.select(F.col("sid").alias("last"), F.col("leaves_to").alias("leaves_end"), F.col("saved_to").alias("saved_end"))
    ids = parts.where("kind = 2").select("sid", "shard", "piece", "ids").repartition("sid").sortWithinPartitions(
        "sid", "shard", "piece").mapInArrow(_hash_pieces, "sid long, ends_sha256 string")
    above = sums.select(F.col("sid").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    whole = sums.join(ends, "last").join(above, "up", "left").join(ids, "sid", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        (F.col("leaves_end") - F.col("leaves_to") + F.col("n_leaves")).alias("n_leaves"),
        (F.col("saved_end") - F.col("saved_to") + F.col("saved")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
    local = parts.where("kind = 0").join(
        above.select(F.col("up").alias("under"), F.col("parent_conv_id").alias("_p")), "under", "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "_p")).select(*whole.columns)
    return local.unionByName(whole)


def conversation_trie(conversations: DataFrame, per_shard: int = CONVS_PER_SHARD) -> DataFrame:
    """The trie of the rebuilt ``conversations`` (conv_id, turn, role, text).

    Turns go by turn, null first, turns of one number by (role, text) digest;
    null role or text counts as empty; repeated rows are turns of their own.
    Rows without conv_id belong to no conversation.  Other columns are not read.
    """
    return trie(rebuilt(conversations), per_shard)
