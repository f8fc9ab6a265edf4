"""Near-duplicate vectors by binary codes of random rotations with correction factors.

A unit vector o is rotated and each coordinate kept as a sign: its code is the corner x of the
cube (coordinates +-1/sqrt(D)) nearest to it, and its correction factor is f = <x, o>. For another
vector q, <x, q> / f is an unbiased estimate of <o, q> with standard deviation
sqrt((1 - f^2) / (f^2 (D - 1))). Several independent rotations (at least BITS signs) average
their estimates. A pair is computed exactly, in double precision, only if the estimate
and CONFIDENCE deviations reach the threshold; all pairs that are linked have been.

Candidates come from the same codes: bands of some signs each; vectors of one label
whose signs agree in a band meet there. A band has about as many signs as doublings make the number of the label's
classes (``band_bits``), so what meets by chance stays the same for each vector however many there are, and there are as
many bands as the target RECALL needs (``band_count``): two vectors at the threshold agree in one sign with
probability 1 - acos(0.93) / pi = 0.88 (README has the measured recall). A pair that agrees in several
bands is handled in the first.

Equal vectors of a label form a class, handled once. Only classes that share a band travel, with vector, code and factors;
bands are read from the code again. Band groups go to tasks in pairs of blocks of BLOCK classes; tasks return numbers of links
and smallest relatives, never pairs. A task rotates each vector once.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and
those without a label, link with nothing; vectors of different length never link; repeated rows are
copies that link with each other; component_id of a null vec_id is the smallest id that it
reaches, or null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtrend.llm.common import process_cache, written
from jobtrend.llm.graph import components, in_blocks, map_whole_groups, roots

THRESHOLD = 0.93
#: Of meeting for a pair at the threshold, and the fewest signs of a band.
RECALL, LEAST_BITS = 0.9987, 8
#: Signs whose estimates are averaged, at least.
BITS = 512
CONFIDENCE = 4.0
BLOCK = 256
#: Pairs that are compared at once.
PAIRS = 1 << 16


def band_bits(classes: Column) -> Column:
    """Signs of a band for a label with so many classes."""
    return F.greatest(F.ceil(F.log2(F.greatest(classes, F.lit(1)))).cast("int"), F.lit(LEAST_BITS))


def band_count(bits: int, threshold: float) -> int:
    """Bands by which a pair at the threshold meets with the target recall."""
    agree = 1 - math.acos(min(max(threshold, -1.0), 1.0)) / math.pi
    return max(1, math.ceil(math.log(1 - RECALL) / math.log1p(-min(agree**bits, 1 - 1e-12))))


def rotations(dim: int, signs: int = BITS) -> np.ndarray:
    """Random rotations for at least so many signs: an array (rotation, dim, dim), the same in every task."""
    kept = process_cache()
    have = kept.setdefault(("rotations", dim), [])
    while len(have) * dim < signs:
        have.append(np.linalg.qr(np.random.default_rng([dim, len(have)]).normal(size=(dim, dim)))[0])
    return np.stack(have[: math.ceil(signs / dim)])


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def encode(units: np.ndarray, signs: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Signs (row, rotation, dim) and correction factors (row, rotation)."""
    turned = np.einsum("nd,rde->nre", units, rotations(units.shape[1], signs), optimize=True)
    return turned >= 0, np.abs(turned).sum(axis=2) / math.sqrt(units.shape[1])


def estimate(signs: np.ndarray, factors: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of coded vectors with rotated unit vectors, row by row, and deviations."""
    dim = turned.shape[2]
    each = (np.where(signs, turned, -turned)).sum(axis=2) / (factors * math.sqrt(dim))
    variance = (1 - factors**2).clip(0) / (factors**2 * max(dim - 1, 1))
    return each.mean(axis=1), np.sqrt(variance.sum(axis=1)) / factors.shape[1]


def _values(bits: np.ndarray, width: int, threshold: float) -> np.ndarray:
    """The band values (row, band) of rows of signs."""
    bands = band_count(width, threshold)
    return bits[:, : bands * width].reshape(len(bits), bands, width) @ (np.int64(1) << np.arange(width))


def _coded(classes: DataFrame, threshold: float) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 1024):
                batch = whole.slice(i, 1024)
                vectors = batch.column("vector")
                dims, widths = np.diff(vectors.offsets.to_numpy()), batch.column("width").to_numpy()
                flat = vectors.flatten().to_numpy().astype(np.float64)
                ends = np.cumsum(dims)
                codes: list = [None] * len(dims)
                factors: list = [None] * len(dims)
                bands: list = [None] * len(dims)
                for dim, width in sorted({*zip(dims.tolist(), widths.tolist())}):
                    own = np.flatnonzero((dims == dim) & (widths == width))
                    signs, found = encode(unit(flat[(ends[own] - dim)[:, None] + np.arange(dim)]), max(BITS, width * band_count(width, threshold)))
                    bits = signs.reshape(len(own), -1)
                    values = _values(bits, width, threshold)
                    for k, at in enumerate(own):
                        codes[at], factors[at], bands[at] = np.packbits(bits[k]).tobytes(), found[k, : math.ceil(BITS / dim)].tolist(), values[k].tolist()
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(codes, pa.binary()), pa.array(factors, pa.list_(pa.float64())), pa.array(bands, pa.list_(pa.int64()))],
                    names=[*batch.schema.names, "code", "factors", "bands"],
                )

    fields = ", ".join(f"{n} {t}" for n, t in classes.dtypes)
    return classes.mapInArrow(task, f"{fields}, code binary, factors array<double>, bands array<long>")


def _matrix(column: pa.ChunkedArray, dtype) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy().astype(dtype)
    return flat.reshape(len(column), -1)


def _links(threshold: float):
    def work(rows: pa.Table, begins: np.ndarray) -> Iterator[pa.RecordBatch]:
        sizes = np.diff([*begins, rows.num_rows])
        dims, widths = (rows.column(c).to_numpy() for c in ("dim", "width"))
        for dim, width in sorted({*zip(dims.tolist(), widths.tolist())}):  # the same for all of a group
            mine = (dims == dim) & (widths == width)
            yield from one(rows.take(pa.array(np.flatnonzero(mine))), sizes[mine[begins]], threshold)

    def one(rows: pa.Table, sizes: np.ndarray, threshold: float) -> Iterator[pa.RecordBatch]:
        node, own, copies = (rows.column(c).to_numpy() for c in ("node", "own", "copies"))
        band, i, j = (rows.column(c).to_numpy() for c in ("band", "i", "j"))
        units, width = unit(_matrix(rows.column("vector"), np.float64)), rows.column("width")[0].as_py()
        factors = _matrix(rows.column("factors"), np.float64)
        codes = np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint8).reshape(len(node), -1)
        bits = np.unpackbits(codes, axis=1)
        values = _values(bits, width, threshold)
        signs = bits[:, : factors.shape[1] * units.shape[1]].reshape(len(node), factors.shape[1], -1).astype(bool)
        turned = np.einsum("nd,rde->nre", units, rotations(units.shape[1]), optimize=True).astype(np.float32)
        # row r meets the rows behind it in its group
        ends = np.repeat(np.cumsum(sizes), sizes)
        behind = ends - np.arange(len(node)) - 1
        cuts = np.searchsorted(np.cumsum(behind), np.arange(PAIRS, behind.sum() + PAIRS, PAIRS))
        found_a, found_b = [], []
        low = 0
        for high in [*np.minimum(cuts + 1, len(node)), len(node)]:
            if high <= low:
                continue
            a = np.repeat(np.arange(low, high), behind[low:high])
            first = np.cumsum(behind[low:high]) - behind[low:high]
            b = a + 1 + np.arange(len(a)) - np.repeat(first, behind[low:high])
            low = high
            keep = (i[a] == j[a]) | (own[a] != own[b])
            a, b = a[keep], b[keep]
            agree = values[a] == values[b]
            keep = agree.argmax(axis=1) == band[a]
            a, b = a[keep], b[keep]
            for k in range(0, len(a), 4096):
                x, y = a[k : k + 4096], b[k : k + 4096]
                guess, deviation = estimate(signs[x], factors[x], turned[y])
                near = guess + CONFIDENCE * deviation + 1e-5 >= threshold  # rotated vectors are held in single precision
                x, y = x[near], y[near]
                near = (units[x] * units[y]).sum(axis=1) >= threshold
                found_a.append(x[near])
                found_b.append(y[near])
        a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (found_a, found_b))
        if not len(a):
            return
        names, at = np.unique(node[np.concatenate([a, b])], return_inverse=True)
        a_at, b_at = at[: len(a)], at[len(a) :]
        links = np.bincount(a_at, copies[b], len(names)) + np.bincount(b_at, copies[a], len(names))
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(links.astype(np.int64)), pa.array(names[roots(len(names), a_at, b_at)])], names=["node", "links", "root"])

    return work


def near_duplicates(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept: a row for each row."""
    whole = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.col("label").isNotNull() & (F.size("vector") > 0) & whole & F.exists("vector", lambda x: x != 0)
    kind = embeddings.schema[vector].dataType.simpleString()
    kept = "array<float>" if kind == "array<float>" else "array<double>"
    given = embeddings.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(vector).cast(kept).alias("vector"))
    sound = F.coalesce(sound, F.lit(False))
    # 128 bits name a class: two hashes over different bytes
    rows = given.withColumn("name", F.when(sound, F.struct(F.xxhash64("label", "vector").alias("a"), F.xxhash64(F.lit("name"), "vector", "label").alias("b"))))
    named = rows.where("name is not null").groupBy("name").agg(
        F.min("vec_id").alias("first_id"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("vector").alias("vector"), F.first(F.size("vector")).alias("dim")
    )
    # from here on classes have numbers of their own, fixed by the written table
    classes = written(named.withColumn("node", F.monotonically_increasing_id()), "classes")
    widths = classes.groupBy("label", "dim").agg(band_bits(F.count("*")).alias("width"))
    coded = written(_coded(classes.drop("name").join(widths, ["label", "dim"]), threshold), "codes")
    met = coded.select("node", "label", "dim", F.posexplode("bands").alias("band", "value"))
    met = met.select("node", F.xxhash64("label", "dim", "band", "value").alias("bucket"), "band")
    shared = written(met.groupBy("bucket").agg(F.count("*").alias("_m")).where("_m > 1").select("bucket"), "buckets")
    members = written(in_blocks(written(met.join(shared, "bucket"), "met"), "bucket", "node", BLOCK), "members")
    data = members.join(coded.select("node", "dim", "width", "copies", "vector", "code", "factors"), "node")
    found = written(map_whole_groups(data, ["bucket", "i", "j"], _links(threshold), "node long, links long, root long"), "links")
    tied = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    placed = written(coded.select("node", "first_id", "copies").join(links, "node", "left").join(tied, "node", "left").select("*", F.coalesce("component", "node").alias("own")), "placed")
    least = written(placed.groupBy("own").agg(F.min("first_id").alias("component_id")), "least")
    ruled = written(placed.join(least, "own").select("node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "ruled")
    out = rows.select("vec_id", "name").join(classes.select("name", "node"), "name", "left").join(ruled, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
