"""N-gram Jaccard join by a MinHash LSH forest with exact verification.

Documents with equal shingle sets are one class and are expanded never again.
A class has a MinHash signature; each tree of the forest labels it with a run
of the signature.  The labels of a tree, sorted, are its prefix trie: classes
that share a prefix stand side by side.

The forest is searched from the longest prefix to shorter ones.  A level
compares the classes of every node whose children differ, so a pair meets at
the longest prefix that it shares in any tree and is verified then, once, on
whole shingle sets.  After each level the similarities of the links found tell
how many were missed: a link of similarity s is found at prefix length k with
probability 1 - (1 - s^k)^trees.  Prefixes are shortened until the measured
recall reaches the target, at most to the length at which even links at the
threshold reach it.

No pair is ever a row.  A node's classes are a block, a large node is
split into pairs of blocks; a task counts the links of its block and reports,
for each class, how many documents it links to and one class of its
component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popdist.llm.bpe import slices, text_slices
from popdist.llm.common import NO_ID, by_rows, freed, numbered, staged, unused
from popdist.llm.components import components
from popdist.llm.substring_dedup import SpanHash, _squeezed, split_words, word_hashes

SHINGLE = 5
THRESHOLD = 0.8
TREES = 20
#: hashes of a whole label
DEPTH = 5
#: share of all links to be found
RECALL = 0.999999
#: steps of similarity, from the threshold to 1, in which links are counted
BINS = 40
#: classes of a block
BLOCK = 1024
#: standard deviations of a signature's estimate below the threshold at which
#: a pair is not verified
SIGMAS = 6.0
_SEEDS = np.random.default_rng(31)
_A = _SEEDS.integers(1, 2 ** 63, TREES * DEPTH, dtype=np.uint64) | np.uint64(1)
_B = _SEEDS.integers(0, 2 ** 63, TREES * DEPTH, dtype=np.uint64)


def chance(similarity: float, k: int, trees: int = TREES) -> float:
    """Probability that a pair shares a prefix of ``k`` values in some tree."""
    return 1 - (1 - similarity ** k) ** trees


def shortest_prefix(threshold: float = THRESHOLD, recall: float = RECALL, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix whose matches reach ``recall`` even at ``threshold``."""
    return next((k for k in range(depth, 1, -1) if chance(threshold, k, trees) >= recall), 1)


def measured_recall(links: dict[int, int], k: int) -> float:
    """Share of all links that prefixes of ``k`` values find, estimated from the
    found links of each bin: a link stands for 1 / chance links.  0 without any."""
    if not links:
        return 0.0
    width = (1 - THRESHOLD) / BINS
    return sum(links.values()) / sum(n / chance(THRESHOLD + i * width, k) for i, n in links.items())


def shingle_sets(texts: list[bytes], n: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingles of each text: ``n`` consecutive words,
    or all words where there are fewer; words split at ASCII white space,
    A-Z lower-cased.  No words, no shingles."""
    words = [split_words(t.lower()) for t in texts]
    h = word_hashes([w for ws in words for w in ws])
    spans, out, at = SpanHash(h), [], 0
    for ws in words:
        size = min(n, len(ws))
        starts = at + np.arange(len(ws) - size + 1 if ws else 0)
        a, b = spans.of(starts, starts + size)
        out.append(np.unique((a ^ (a >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) ^ b))
        at += len(ws)
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values [texts, TREES * DEPTH], the low 16 bits; no set is empty."""
    flat = np.concatenate(sets)
    first = np.cumsum([0, *map(len, sets)])[:-1]
    out = np.empty((len(sets), len(_A)), np.uint16)
    for i, (a, b) in enumerate(zip(_A, _B, strict=True)):
        out[:, i] = np.minimum.reduceat((flat * a + b) >> np.uint64(32), first) & np.uint64(0xFFFF)
    return out


def _described(docs: DataFrame) -> DataFrame:
    """(doc_id, row, name, set, sig, blank) of every row; set and sig are null where
    there are no shingles, blank (a 128-bit name of the text) elsewhere."""

    def run(batches):
        for b in batches:
            for s, texts in text_slices(b.column("text")):
                sets = shingle_sets(texts)
                full = [i for i, x in enumerate(sets) if len(x)]
                sets_as, sig = [None] * len(sets), [None] * len(sets)
                for i, row in zip(full, signatures([sets[i] for i in full]) if full else (), strict=True):
                    sets_as[i], sig[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest(), row.tobytes()
                n = len(texts)
                yield pa.RecordBatch.from_pydict(
                    {c: b.column(c).slice(s.start, n) for c in ("doc_id", "row", "name")}
                    | {"set": pa.array(sets_as, pa.binary()), "sig": pa.array(sig, pa.binary()),
                       "blank": pa.array([None if len(x) else hashlib.blake2b(t, digest_size=16).digest()
                                          for x, t in zip(sets, texts, strict=True)], pa.binary())})

    return docs.select("doc_id", "row", "name", "text").mapInArrow(
        run, "doc_id long, row long, name binary, set binary, sig binary, blank binary")


def _keyed(docs: DataFrame, row: str | None) -> DataFrame:
    """(doc_id, text, row, name): null texts as empty; name is 128 bits of doc_id
    and text, by which a row's text is found again in ``docs``; row is the column
    ``row``, or else a number that holds only for the one read that stages it."""
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))
    told = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(" "), text)
    return docs.select(doc_id.alias("doc_id"), text.alias("text"),
                       (F.monotonically_increasing_id() if row is None else F.col(row)).alias("row"),
                       F.unhex(F.substring(F.sha2(told, 256), 1, 32)).alias("name"))


def _texts(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (with a unique ``name``) and z, the compressed text of that name.
    Rows are chosen by 64 bits of the name, then joined by all of it, once each."""
    of = lambda d: d.withColumn("h", F.xxhash64("name"))
    texts = by_rows(of(keyed.select("name", "text")), staged(of(wanted).select("h"), "jaccard-wanted"), "h", "left_semi")
    return _squeezed(texts, "name binary").groupBy("name").agg(F.first("z").alias("z")).join(wanted, "name")


def _labels(classes: DataFrame) -> DataFrame:
    """(cid, tree, label), sorted by tree and label: the forest's tries.  A
    label is the big-endian bytes of its values, so prefixes are substrings."""

    def run(batches):
        for b in batches:
            sig = _matrix(b.column("sig")).astype(">u2")
            for t in range(TREES):
                label = np.ascontiguousarray(sig[:, t * DEPTH:(t + 1) * DEPTH])
                yield pa.RecordBatch.from_pydict({
                    "cid": b.column("cid"), "tree": pa.repeat(pa.scalar(t, pa.int32()), len(sig)),
                    "label": pa.array([row.tobytes() for row in label], pa.binary())})

    rows = classes.select("cid", "sig").mapInArrow(run, "cid long, tree int, label binary")
    return staged(rows.repartitionByRange("tree", "label").sortWithinPartitions("tree", "label"), "jaccard-labels")


def _members(labels: DataFrame, k: int) -> DataFrame:
    """(NODE, cid, own) of the trie nodes at depth ``k`` that have classes of two
    children, or at full depth two classes; large nodes as pairs of blocks."""
    prefix = lambda n: F.substring("label", 1, 2 * n)
    at = labels.select("cid", "tree", F.xxhash64(prefix(k)).alias("node"), prefix(min(k + 1, DEPTH)).alias("child"))
    many = F.col("n") > 1 if k == DEPTH else F.col("first") != F.col("last")
    nodes = staged(at.groupBy("tree", "node").agg(F.count("*").alias("n"), F.min("child").alias("first"), F.max("child").alias("last"))
                   .where(many).select("tree", "node", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "jaccard-nodes")
    return staged(at.drop("child").join(nodes, ["tree", "node"]), "jaccard-members") \
        .withColumn("own", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .withColumn("b1", F.least("own", "other")).withColumn("b2", F.greatest("own", "other")).select(*NODE, "cid", "own")


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, TREES * DEPTH)


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of equal ``keys`` of a sorted partition, one by one."""
    held: pa.Table | None = None
    for b in batches:
        t = pa.Table.from_batches([b])
        if held is not None:
            t = pa.concat_tables([held, t])
        change = np.zeros(max(0, len(t) - 1), dtype=bool)
        for c in keys:
            v = t.column(c).to_numpy()
            change |= v[1:] != v[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist()]
        t = t.combine_chunks()
        for a, e in zip(cuts, cuts[1:], strict=False):
            yield t.slice(a, e - a)
        held = t.slice(cuts[-1])
    if held is not None and len(held):
        yield held


NODE = ["tree", "node", "b1", "b2"]


def _candidates(sig: np.ndarray, own: np.ndarray, tree: int, k: int, paired: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of a block that first meet in this tree at depth ``k`` and whose
    signatures do not rule out a link.  ``own``: the block of each row; with
    ``paired`` the two rows of a pair come from different blocks."""
    m = len(sig)
    least = THRESHOLD - SIGMAS * np.sqrt(THRESHOLD * (1 - THRESHOLD) / sig.shape[1])
    left = np.flatnonzero(own == own.min()) if paired else np.arange(m)
    right = np.flatnonzero(own != own.min()) if paired else left
    found = []
    for i in range(0, len(left), 256):
        rows = left[i:i + 256]
        a, b = sig[rows], sig[right]
        equal = np.zeros((len(rows), len(right)), np.uint16)
        met = np.zeros(equal.shape, dtype=bool)
        for t in range(TREES):
            prefix = np.ones(equal.shape, dtype=bool)
            for d in range(DEPTH):
                same = a[:, None, t * DEPTH + d] == b[None, :, t * DEPTH + d]
                equal += same
                if d <= k:
                    prefix &= same
                    # met on a longer prefix, or on this one in an earlier tree
                    if d == k or d == k - 1 and t < tree:
                        met |= prefix
        ok = ~met & (equal >= least * sig.shape[1])
        if not paired:
            ok &= right[None, :] > rows[:, None]
        x, y = np.nonzero(ok)
        found.append((rows[x], right[y]))
    return (np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])) if found else (np.zeros(0, int),) * 2


def _linked(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs (x, y) have a Jaccard similarity of at least 0.8, exactly,
    and the bins of their similarities."""
    size = np.array([len(s) for s in sets], dtype=np.int64)
    if len(x) <= 64:
        shared = np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(x, y, strict=True)], dtype=np.int64)
    else:  # many pairs of few classes: multiply the incidence matrix, by columns
        rows = np.repeat(np.arange(len(sets)), size)
        _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        keep = count[column] > 1
        rows, column = rows[keep], column[keep]
        order = np.argsort(column, kind="stable")
        rows, column = rows[order], column[order]
        both = np.zeros((len(sets), len(sets)), np.float32)
        width, top = 4096, int(column[-1]) + 1 if len(column) else 0
        edges = np.searchsorted(column, np.arange(0, top + width, width))
        for i, (a, e) in enumerate(zip(edges, edges[1:], strict=False)):
            if e > a:
                used, place = np.unique(column[a:e], return_inverse=True)
                m = np.zeros((len(sets), len(used)), np.float32)
                m[rows[a:e], place] = 1
                both += m @ m.T
        shared = both[x, y].astype(np.int64)
    both = size[x] + size[y]
    linked = 9 * shared >= 4 * both  # shared / (both - shared) >= 4 / 5
    similarity = shared[linked] / (both - shared)[linked]
    bins = ((similarity - THRESHOLD) * BINS / (1 - THRESHOLD)).astype(np.int64)
    return linked, np.clip(bins, 0, BINS - 1)


def _roots(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The first row of each row's component, by links x - y."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _block_rows(t: pa.Table) -> tuple[np.ndarray, np.ndarray, int, bool]:
    return _matrix(t.column("sig")), t.column("own").to_numpy(), int(t.column("tree")[0].as_py()), t.column("b1")[0] != t.column("b2")[0]


def _places(in_blocks: DataFrame, k: int) -> DataFrame:
    """(NODE, cid, own) of the classes that have a candidate in their block."""

    def promising(batches):
        for t in _grouped(batches, NODE):
            if len(t) > 1:
                sig, own, tree, paired = _block_rows(t)
                x, y = _candidates(sig, own, tree, k, paired)
                if len(x):
                    yield from t.take(np.unique(np.concatenate([x, y]))).drop_columns(["sig"]).to_batches()

    return staged(in_blocks.mapInArrow(promising, "tree int, node long, b1 int, b2 int, cid long, own int"), "jaccard-places")


def _verified(full: DataFrame, k: int) -> DataFrame:
    """(cid, links, root, bins) of each block's linked classes, by whole shingle
    sets; ``bins`` of one row of a block counts its links by similarity."""

    def verify(batches):
        for t in _grouped(batches, NODE):
            sig, own, tree, paired = _block_rows(t)
            if paired and own.min() == own.max():
                continue
            x, y = _candidates(sig, own, tree, k, paired)
            if not len(x):
                continue
            linked, bins = _linked([np.frombuffer(s, np.uint64) for s in t.column("shingles").to_pylist()], x, y)
            x, y = x[linked], y[linked]
            if len(x):
                cid, copies = t.column("cid").to_numpy(), t.column("copies").to_numpy()
                degree = np.bincount(x, copies[y], len(t)) + np.bincount(y, copies[x], len(t))
                at = np.flatnonzero(degree)
                counts = [np.bincount(bins, minlength=BINS).tolist(), *[None] * (len(at) - 1)]
                yield pa.RecordBatch.from_pydict({
                    "cid": pa.array(cid[at]), "links": pa.array(degree[at].astype(np.int64)), "root": pa.array(cid[_roots(len(t), x, y)][at]),
                    "bins": pa.array(counts, pa.list_(pa.int64()))})

    return staged(full.mapInArrow(verify, "cid long, links long, root long, bins array<long>"), "jaccard-found")


def _classed(docs: DataFrame, row: str | None, levels: list[tuple[int, float]] | None = None) -> DataFrame:
    """(doc_id, row, top, n_links, blank) of every row of ``docs``, whose column
    ``row`` has unique staged numbers; without one, rows get numbers here.
    ``docs`` is read again for the texts that are compared.  ``top`` (none,
    doc_id, row) is the row that stands for the row's class: the smallest
    doc_id's, or where no row has a doc_id (``none``) the smallest row number's.
    ``levels`` is told the prefix lengths searched and the recall measured after
    each."""
    keyed = _keyed(docs, row)
    rows = staged(_described(keyed), "jaccard-rows")
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    classes = staged(
        rows.where("set is not null").groupBy("set").agg(
            F.min(F.struct(own.alias("top"), "name")).alias("of"), F.count("*").alias("copies"), F.first("sig").alias("sig"))
        .select("set", "of.top", "of.name", "copies", "sig", F.monotonically_increasing_id().alias("cid")), "jaccard-classes")
    labels = _labels(classes)

    def shingles(batches):
        for b in batches:
            texts = [zstandard.decompress(z) for z in b.column("z").to_pylist()]
            for s in slices(np.array([len(t) for t in texts], dtype=np.int64), 2 << 20):
                made = shingle_sets(texts[s])
                yield pa.RecordBatch.from_pydict(
                    {c: b.column(c).slice(s.start, len(made)) for c in ("cid", "sig", "copies")}
                    | {"shingles": pa.array([x.tobytes() for x in made], pa.binary())})

    found, links, done = None, {}, None
    for k in range(DEPTH, shortest_prefix() - 1, -1):
        with freed(docs.sparkSession) as keep:  # a level's nodes, members and places go when it is verified
            in_blocks = _members(labels, k).join(classes.select("cid", "sig"), "cid") \
                .select(*NODE, "cid", "own", "sig").repartition(*NODE).sortWithinPartitions(*NODE, "cid")
            places = _places(in_blocks, k)
            # the whole shingle sets of the classes that have a candidate, those of earlier levels made already
            new = places.select("cid").distinct()
            if done is not None:
                new = new.join(done.select("cid"), "cid", "left_anti")
            wanted = classes.join(new, "cid").select("cid", "sig", "copies", "name")
            sets = keep(staged(_texts(keyed, wanted).select("cid", "sig", "copies", "z").mapInArrow(
                shingles, "cid long, sig binary, copies long, shingles binary"), "jaccard-sets"))
            done = sets if done is None else done.unionByName(sets)
            full = places.join(done, "cid").repartition(*NODE).sortWithinPartitions(*NODE, "cid")
            level = keep(_verified(full, k))
        for r in level.where("bins is not null").select(F.posexplode("bins").alias("i", "n")).groupBy("i").agg(F.sum("n").alias("n")).collect():
            if r.n:
                links[r.i] = links.get(r.i, 0) + r.n
        found = level if found is None else found.unionByName(level)
        recall = measured_recall(links, k)
        if levels is not None:
            levels.append((k, recall))
        if recall >= RECALL:
            break
    roots = components(found.select(F.col("cid").alias("u"), F.col("root").alias("v")))
    degrees = found.groupBy("cid").agg(F.sum("links").alias("links"))
    labelled = classes.select("cid", "set", "copies", "top") \
        .join(degrees, "cid", "left").join(roots.select(F.col("u").alias("cid"), "root"), "cid", "left") \
        .withColumn("root", F.coalesce("root", "cid"))
    labelled = staged(labelled, "jaccard-labelled")
    least = labelled.groupBy("root").agg(F.min("top").alias("class_top"))
    of_set = staged(labelled.join(staged(least, "jaccard-least"), "root").select(
        "set", F.col("class_top").alias("top"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "jaccard-of-set")
    told = rows.where("set is not null").join(of_set, "set").select("doc_id", "row", "top", "n_links", "blank")
    return told.unionByName(rows.where("set is null").select(
        "doc_id", "row", own.alias("top"), F.lit(0).cast("long").alias("n_links"), "blank"))


def join(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, n_links) of every row of ``docs``.

    Two documents are linked when the Jaccard similarity of their sets of
    5-word shingles is at least 0.8.  ``n_links``: how many other rows the row
    is linked to, copies included; ``class_id``: the smallest doc_id of all
    rows that links connect it with.  Null texts count as empty; a text
    without words has no links and is its own class.  Repeated rows are copies.
    Rows without doc_id belong to their class like others; a class where no
    row has a doc_id is named by a number of its own, from ``NO_ID`` + 1 on.
    """
    return _classed(docs.select("doc_id", "text"), None).select(
        "doc_id", F.coalesce("top.doc_id", F.col("top.row") + F.lit(NO_ID + 1)).alias("class_id"), "n_links")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class, all columns unchanged: one of the
    smallest doc_id, or any one where no row has a doc_id.  Of texts without
    words, only rows that repeat doc_id and text go."""
    from pyspark.sql import Window

    number = unused(docs.columns, "_row")
    rows = numbered(docs, "jaccard-docs", number)
    once = Window.partitionBy("doc_id", "blank").orderBy("row")
    with freed(docs.sparkSession) as keep:
        told = staged(_classed(rows, number).select("doc_id", "row", F.col("top.row").alias("top"), "blank"), "jaccard-told")
        again = told.where("blank is not null and doc_id is not null") \
            .withColumn("_n", F.row_number().over(once)).where("_n > 1").select("row")
        gone = keep(staged(told.where("row <> top").select("row").unionByName(again).withColumnRenamed("row", number), "jaccard-gone"))
    return by_rows(rows, gone, number, "left_anti").select(*docs.columns)
