"""N-gram Jaccard join by a MinHash LSH forest, with exact verification.

Texts with the same set of shingles (five consecutive words) form a class, so copies are
handled once. A class has a path of DEPTH min-hashes in each of TREES prefix tries; classes meet in the nodes
of these tries, that is in prefixes of their paths. Long prefixes alone would miss pairs at the threshold, so they are
shortened: everywhere until pairs at the threshold meet in some tree with the target recall
(``longest_prefix``), and on to SHORTEST where the node above holds few classes (at most BLOCK), which costs little
there. So a node with many classes, as boilerplate makes them, is taken apart by further min-hashes, and a sparse one is not.

Classes of a node are compared by sketches, a byte of each min-hash; pairs whose sketches
agree far less than those of a pair at the threshold (five deviations) are no candidates. Strong pairs tie classes, and the
components of these ties are the candidate groups. Inside a group all pairs are compared exactly, by counting common
shingles with matrix products; a group goes to tasks in pairs of blocks of BLOCK classes. Tasks return
for each class its number of links and its smallest relative, never pairs.

Only texts of classes in a group of two or more are read again for this.

Defined results: null and empty texts have no shingles, link with nothing and stay a class of their
own each; a text of one to four words is a single shingle; rows that repeat are copies
of each other and count as links; a null doc_id is never a class id unless the class has no
other. n_links counts documents, not classes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtrend.llm.common import Words, mix64, row_identity, slices, whole_row, written
from jobtrend.llm.graph import components, in_blocks, map_whole_groups, roots

SHINGLE = 5
#: Similarity of a link, as a fraction, so that comparisons are exact.
THRESHOLD = (4, 5)
TREES, DEPTH, SHORTEST = 24, 6, 4
RECALL = 0.999
#: Classes of a block, and columns of a matrix product.
BLOCK, COLUMNS = 256, 4096
#: Classes that are compared by sketches in one task's group, and deviations below the threshold that still pass.
SKETCH_BLOCK, DEVIATIONS = 1024, 5.0


def longest_prefix(trees: int = TREES, depth: int = DEPTH, recall: float = RECALL, similarity: float = THRESHOLD[0] / THRESHOLD[1]) -> int:
    """The longest prefix by which pairs at the threshold still meet with the target recall."""
    while depth > SHORTEST and 1 - (1 - similarity**depth) ** trees < recall:
        depth -= 1
    return depth


def least_agreement(hashes: int, similarity: float = THRESHOLD[0] / THRESHOLD[1]) -> int:
    """How many bytes of the sketches of a pair at the threshold agree at least, but for one pair in some millions."""
    return math.floor(hashes * similarity - DEVIATIONS * math.sqrt(hashes * similarity * (1 - similarity)))


def shingle_sets(words: Words, size: int = SHINGLE) -> list[np.ndarray]:
    """For each text its sorted distinct shingles, as 64-bit hashes."""
    at = words.runs(size)
    doc, hashes = words.doc[at] if len(at) else at, words.run_hash(at, size)
    ends = np.searchsorted(doc, np.arange(words.n_docs), side="right")
    begins = np.searchsorted(doc, np.arange(words.n_docs), side="left")
    out = []
    for k in range(words.n_docs):
        n = int(words.counts[k])
        if 0 < n < size:
            out.append(mix64(words.run_hash(words.first[k : k + 1], n) + np.uint64(n)))
        else:
            out.append(np.unique(hashes[begins[k] : ends[k]]))
    return out


def _sets_of(texts: pa.ChunkedArray, size: int = SHINGLE) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for i in range(0, len(texts), 16):
        out += shingle_sets(Words(texts.slice(i, 16)), size)
    return out


def signatures(sets: list[np.ndarray], trees: int = TREES, depth: int = DEPTH, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """For each set (none is empty) the hashed prefixes of its paths, from SHORTEST to ``depth`` min-hashes
    (set, length, tree), and a byte of each min-hash."""
    rng = np.random.default_rng(seed)
    factors = rng.integers(0, 1 << 32, trees * depth, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
    shifts = rng.integers(0, 1 << 32, trees * depth, dtype=np.uint64).astype(np.uint32)
    x = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    sizes = np.array([len(s) for s in sets])
    begins = np.cumsum(sizes) - sizes
    prefixes = np.zeros((len(sets), depth - SHORTEST + 1, trees), np.uint64)
    sketch = np.zeros((len(sets), trees * depth), np.uint8)
    for t in range(trees):
        prefix = np.full(len(sets), t + 1, np.uint64)
        for k in range(depth):
            least = mix64(np.minimum.reduceat(x * factors[t * depth + k] + shifts[t * depth + k], begins).astype(np.uint64) + np.uint64(1))
            prefix = mix64(prefix ^ least)
            sketch[:, t * depth + k] = least & np.uint64(0xFF)
            if k + 1 >= SHORTEST:
                prefixes[:, k + 1 - SHORTEST, t] = prefix + np.uint64(k)
    return prefixes, sketch


def _signed(docs: DataFrame, doc_id: str, text: str, depth: int) -> DataFrame:
    """doc_id, identity, name (of its class; null without shingles), sketch and prefixes (an array for each length)."""
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), row_identity(doc_id, text).alias("identity"), F.col(text).cast("string").alias("text"))
    levels = [f"prefix{n}" for n in range(SHORTEST, depth + 1)]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, lambda x: x.column("text")):
            sets = shingle_sets(Words(batch.column("text")))
            some = [k for k, s in enumerate(sets) if len(s)]
            node: list = [None] * len(sets)
            sketches: list = [None] * len(sets)
            prefixes: list = [[None] * len(sets) for _ in levels]
            if some:
                found, sketch = signatures([sets[k] for k in some], depth=depth)
                for k, paths, own in zip(some, found.view(np.int64), sketch):
                    node[k] = _name(sets[k])
                    sketches[k] = own.tobytes()
                    for level, path in zip(prefixes, paths):
                        level[k] = path.tolist()
            columns = [batch.column("doc_id"), batch.column("identity"), pa.array(node, pa.binary()), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(x, pa.list_(pa.int64())) for x in prefixes)], names=["doc_id", "identity", "name", "sketch", *levels])

    return given.mapInArrow(task, "doc_id long, identity binary, name binary, sketch binary" + "".join(f", {x} array<long>" for x in levels))


def _name(shingles: np.ndarray) -> bytes:
    """128 bits of a set of shingles."""
    one, two = mix64(shingles), mix64(shingles ^ np.uint64(0x9E3779B97F4A7C15))
    return np.array([one.sum() ^ np.uint64(len(shingles)), mix64(two).sum()], np.uint64).tobytes()


def _connected(rows: pa.Table, begins: np.ndarray) -> Iterator[pa.RecordBatch]:
    """node, root of the classes in each group that strong pairs of sketches tie; every class is searched from once at most."""
    node = rows.column("node").to_numpy()
    sketch = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8).reshape(len(node), -1)
    least = least_agreement(sketch.shape[1])
    found_node, found_root = [], []
    for a, b in zip(begins, [*begins[1:], len(node)]):
        own, first = np.unique(node[a:b], return_index=True)
        codes = sketch[a:b][first]
        left = np.arange(len(own))
        while len(left) > 1:
            group, waiting, left = [left[0]], [left[0]], left[1:]
            while waiting and len(left):
                near = (codes[left] == codes[waiting.pop()]).sum(axis=1) >= least
                group += left[near].tolist()
                waiting += left[near].tolist()
                left = left[~near]
            if len(group) > 1:
                found_node += own[group].tolist()
                found_root += [int(own[min(group)])] * len(group)
    if found_node:
        yield pa.RecordBatch.from_arrays([pa.array(found_node, pa.int64()), pa.array(found_root, pa.int64())], names=["node", "root"])


def meetings(classes: DataFrame, signed: DataFrame, depth: int) -> DataFrame:
    """bucket, node: the nodes of the tries in which two classes or more meet, with prefixes as long as there are many classes.

    Classes carry their shortest prefixes; longer ones are taken from the table of rows, for those that need them.
    """
    keys = classes.select("node", F.posexplode(f"prefix{SHORTEST}").alias("tree", "bucket"))
    out = None
    for n in range(SHORTEST, depth + 1):
        counts = written(keys.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "prefixes")
        held = written(keys.join(counts, "bucket"), "shared")
        met = (held if n == depth else held.where(F.col("n") <= BLOCK)).select("bucket", "node")
        out = met if out is None else out.union(met)
        if n < depth:
            dense = held.where(F.col("n") > BLOCK).select("node", "tree")
            own = dense.select("node").distinct().join(classes.select("node", F.col("first.identity").alias("identity")), "node")
            longer = own.join(signed.select("identity", f"prefix{n + 1}"), "identity").dropDuplicates(["node"])
            keys = dense.join(longer, "node").select("node", "tree", F.get(f"prefix{n + 1}", "tree").alias("bucket"))
    return out


def _verify(group: pa.Table) -> pa.RecordBatch | None:
    """Links of the classes of one pair of blocks: node, links (documents), root."""
    node = group.column("node").to_numpy()
    node, first = np.unique(node, return_index=True)  # a repeated row brings its class twice
    if len(node) < 2:
        return None
    group = group.take(pa.array(first))
    copies, own = group.column("copies").to_numpy(), group.column("own").to_numpy()
    i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
    sets = _sets_of(group.column("text"))
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    values, column, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = df[column] > 1
    owner, column = owner[shared], column[shared]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(sets), len(sets)), np.float64)
    for a in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        low, high = np.searchsorted(column, [a, a + COLUMNS])
        x = np.zeros((len(sets), min(COLUMNS, int(column[-1]) + 1 - a)), np.float32)
        x[owner[low:high], column[low:high] - a] = 1
        common += x @ x.T
    union = sizes[:, None] + sizes[None, :] - common
    linked = THRESHOLD[1] * common >= THRESHOLD[0] * union
    np.fill_diagonal(linked, False)
    if i != j:
        linked &= own[:, None] != own[None, :]  # pairs within a block belong to (i, i)
    a, b = np.nonzero(np.triu(linked))
    root = node[roots(len(node), a, b)]
    alone = np.full(len(node), group.column("blocks")[0].as_py() == 1)
    return pa.RecordBatch.from_arrays([pa.array(node), pa.array((linked @ copies).astype(np.int64)), pa.array(root), pa.array(alone)], names=["node", "links", "root", "alone"])


def _verified(rows: pa.Table, begins: np.ndarray) -> Iterator[pa.RecordBatch]:
    for a, b in zip(begins, [*begins[1:], rows.num_rows]):
        if (out := _verify(rows.slice(a, b - a))) is not None:
            yield out


def _classes(signed: DataFrame) -> DataFrame:
    """A row for each class: node (a number of its own, fixed by the written table), name, first, copies, sketch and shortest prefixes."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "identity"))
    named = signed.where("name is not null").groupBy("name").agg(first.alias("first"), F.count("*").alias("copies"), *(F.first(x).alias(x) for x in ("sketch", f"prefix{SHORTEST}")))
    return written(named.withColumn("node", F.monotonically_increasing_id()), "classes")


def candidate_groups(classes: DataFrame, signed: DataFrame, depth: int) -> DataFrame:
    """node, component of the classes that strong pairs tie."""
    met = written(in_blocks(written(meetings(classes, signed, depth), "meetings"), "bucket", "node", SKETCH_BLOCK), "met")
    strong = map_whole_groups(met.join(classes.select("node", "sketch"), "node"), ["bucket", "i", "j"], _connected, "node long, root long")
    return written(components(strong.select(F.col("node").alias("u"), F.col("root").alias("v"))), "candidate-groups")


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, identity (of the row), class_id, n_links and stays (one identity a class), a row for each row."""
    depth = longest_prefix()
    signed = written(_signed(docs, doc_id, text, depth), "signatures")
    classes = _classes(signed)
    rows = signed.select("doc_id", "identity", "name").join(classes.select("name", "node"), "name", "left").select("doc_id", "identity", "node")
    groups = candidate_groups(classes, signed, depth)
    members = groups.join(classes.select("node", "first.identity", "copies"), "node")
    members = written(in_blocks(members, "component", "node", BLOCK), "members")
    # the texts of these classes, by an exchange at every size: what is asked for grows with the input
    texts = docs.select(row_identity(doc_id, text).alias("identity"), F.col(text).cast("string").alias("text")).hint("merge")
    compared = written(map_whole_groups(members.join(texts, "identity").drop("identity"), ["component", "i", "j"], _verified, "node long, links long, root long, alone boolean"), "links")
    linked = compared.groupBy("node").agg(F.sum("links").alias("links"), F.min("root").alias("root"))
    # groups of one block have their final roots; those of several are tied by the roots of each pair
    whole = components(compared.where("not alone").select(F.col("node").alias("u"), F.col("root").alias("v"))).withColumnRenamed("component", "final")
    placed = classes.select("node", "first", "copies").join(linked, "node", "left").join(whole, "node", "left")
    placed = written(placed.select("*", F.coalesce("final", "root", "node").alias("component")), "placed")
    heads = written(placed.groupBy("component").agg(F.min("first").alias("head")), "heads")
    ruled = written(placed.join(heads, "component").select("node", F.col("head.doc_id").alias("class_id"), F.col("head.identity").alias("head"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "ruled")
    return rows.join(ruled, "node", "left").select(
        "doc_id",
        "identity",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(F.col("identity") == F.col("head"), F.lit(True)).alias("stays"),
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each class: the smallest doc_id. Rows without shingles stay too.

    Of rows with the same doc_id and text the first one by its JSON text is returned (that exchange is left out
    where there are none).
    """
    joined = join(docs, doc_id, text)
    gone = joined.where("not stays").select(F.col("identity").alias("_gone")).distinct()
    packed = docs.select(whole_row(docs).alias("row"), row_identity(doc_id, text).alias("_own"))
    left = packed.join(gone, packed["_own"] == gone["_gone"], "left_anti")
    if joined.where("stays").groupBy("identity").count().where("count > 1").limit(1).count():
        left = left.groupBy("_own").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return left.select("row.*")
