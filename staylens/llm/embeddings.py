"""Embedding near-duplicates by sorted projection passes.

Every pass draws random hyperplanes, orders the vectors lexicographically by the sign bits
of their projections (``BITS`` concatenated one-bit hashes) and compares each vector with
its ``WINDOW`` predecessors in that order by exact cosine.  Pairs at or above the threshold
are united across the passes; each task hands on a spanning forest of its links, never the
pairs.  Windows cross task borders: the rows at both ends of each task are compared again.

Inside a component all links are then counted exactly, so that a group of any size loses
none to the window.  Vectors within half the threshold angle of the component's mean all
link with each other (triangle inequality) and are counted without comparing.  The others
are compared with every member in tiles of about ``TILE`` x ``TILE`` vectors.

Recall: a pair at cosine c agrees on a bit with probability 1 - acos(c) / pi; it is found
in a pass when it agrees on about the first log2(2 n / WINDOW) bits (half a window of rows,
as prefixes hold unequal numbers).  The passes follow from the counted number of vectors, so
that among vectors spread over all directions a pair at the threshold is missed in about
``MISS`` of the cases at any size.  Where many vectors crowd into one direction without being
linked, prefixes hold more rows than this assumes.  So the passes run in two rounds at least,
each round's links are joined to the components so far, and further rounds follow until one
joins no more than ``MISS`` / 4 of all that is joined: the data, not the formula, end the search.

Cases: vectors that are null, empty, zero, or hold null or non-finite components link with
nothing and are kept; vectors of different lengths never link; repeated rows are vectors of
their own; a null id takes part, but a component is named by its least non-null id (null if
none); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, components, discard, store

THRESHOLD = 0.9
PASSES = 30  # at least
ROUND = 32  # passes of one shuffle
WINDOW = 512
SLACK = 1e-4  # of a cosine in single precision, before it is computed in double
MISS = 0.002  # of the pairs at the threshold
BITS = 63
TILE = 256
SEED = 17
ROWS = 2048  # of an Arrow batch


def matrix(column) -> np.ndarray:
    """Vectors of one length as rows."""
    if isinstance(column, pa.Array):
        return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    return np.array(list(column), np.float64).reshape(len(column), -1)


def lengths(column: pa.Array) -> np.ndarray:
    return pc.list_value_length(column).to_numpy()


def passes_for(n: int, window: int = WINDOW, threshold: float = THRESHOLD, miss: float = MISS) -> int:
    """Passes after which a pair at the threshold among ``n`` spread-out vectors is missed
    with probability ``miss``."""
    agree = 1 - math.acos(threshold) / math.pi
    found = agree ** math.log2(max(2 * n / window, 1.0))
    return PASSES if found >= 1 else max(PASSES, math.ceil(math.log(miss) / math.log1p(-found)))


def keys(vectors: np.ndarray, passes: int, seed: int) -> np.ndarray:
    """Sort key of every vector (rows) in every pass (columns)."""
    planes = np.random.default_rng([seed, vectors.shape[1]]).standard_normal((vectors.shape[1], passes * BITS))
    bits = (vectors @ planes > 0).reshape(len(vectors), passes, BITS)
    return bits.astype(np.int64) @ (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def window_pairs(x: np.ndarray, new: int, window: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs (i, j): i among the rows from ``new`` on, j among its predecessors."""
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    rough = unit.astype(np.float32)
    left, right = [], []
    for start in range(new, len(x), window):
        low, stop = max(0, start - window), min(len(x), start + window)
        i, j = np.nonzero(rough[start:stop] @ rough[low:stop].T >= np.float32(threshold - SLACK))
        i, j = i + start, j + low
        near = (j < i) & (i - j <= window)
        i, j = i[near], j[near]
        for part in range(0, len(i), 1 << 16):
            a, b = i[part : part + (1 << 16)], j[part : part + (1 << 16)]
            linked = np.einsum("ij,ij->i", unit[a], unit[b]) >= threshold
            left.append(a[linked])
            right.append(b[linked])
    empty = [np.zeros(0, np.int64)]
    return np.concatenate(left or empty), np.concatenate(right or empty)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least index that each of ``n`` rows is connected with."""
    label = np.arange(n)
    while len(a):
        before = label.copy()
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        label = label[label]
        if (label == before).all():
            break
    return label


_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("border", pa.int32()), ("tail", pa.bool_()),
                   ("pass", pa.int32()), ("place", pa.int32()), ("v", pa.list_(pa.float64()))])


def _edges(uid: np.ndarray, x: np.ndarray, new: int, window: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    i, j = window_pairs(x, new, window, threshold)
    label = forest(len(x), i, j)
    child = np.flatnonzero(label != np.arange(len(x)))
    return uid[child], uid[label[child]]


def _pass_batches(batches: Iterator[pa.RecordBatch], window: int, threshold: float) -> Iterator[pa.RecordBatch]:
    """Sorted rows (pass, uid, v) -> edges, and the first and last rows of the task."""
    task = TaskContext.get().partitionId()
    group, uid, x = None, np.zeros(0, np.int64), np.zeros((0, 0))
    heads = 0

    def rows(a=(), b=(), border=None, tail=None, group=None, places=(), v=()):
        n = len(a)
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b if len(b) else [None] * n, pa.int64()), pa.array([border] * n, pa.int32()),
             pa.array([tail] * n, pa.bool_()), pa.array([group[0] if group else None] * n, pa.int32()),
             pa.array(places if len(places) else [None] * n, pa.int32()), pa.array(list(v) if len(v) else [None] * n, pa.list_(pa.float64()))],
            schema=_EDGE,
        )

    for batch in batches:
        passes, ids = batch.column("pass").to_numpy(), batch.column("uid").to_numpy()
        dims = lengths(batch.column("v"))
        cut = np.flatnonzero((np.diff(passes) != 0) | (np.diff(dims) != 0)) + 1
        for low, high in zip([0, *cut], [*cut, len(ids)], strict=True):
            if low == high:
                continue
            own = (int(passes[low]), int(dims[low]))
            part = matrix(batch.column("v").slice(low, high - low))
            if own != group:
                group, uid, x = own, np.zeros(0, np.int64), np.zeros((0, own[1]))
            if heads < window:  # the task's first rows, for the border before it
                take = min(window - heads, high - low)
                yield rows(ids[low : low + take], border=task - 1, tail=False, group=group, places=range(heads, heads + take), v=part[:take])
                heads += take
            old = len(uid)
            uid, x = np.concatenate([uid, ids[low:high]]), np.concatenate([x, part])
            a, b = _edges(uid, x, old, window, threshold)
            yield rows(a, b)
            uid, x = uid[-window:], x[-window:]
    if group:
        yield rows(uid, border=task, tail=True, group=group, places=range(len(uid)), v=x)


def candidate_links(vectors: DataFrame, threshold: float, passes: int, window: int, seed: int) -> DataFrame:
    """Spanning edges (a, b) between the ``uid`` of a stored table (uid, v)."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = lengths(batch.column("v"))
            for dim in np.unique(dims):
                own = batch.filter(pa.array(dims == dim))
                table = keys(matrix(own.column("v")), passes, seed)
                for p in range(passes):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(table), p), pa.int32()), pa.array(np.full(len(table), dim), pa.int32()),
                         pa.array(table[:, p]), own.column("uid"), own.column("v")],
                        names=["pass", "dim", "key", "uid", "v"],
                    )

    kind = vectors.schema["v"].dataType.simpleString()
    order = ["pass", "dim", "key", "tie", "uid"]
    rows = vectors.mapInArrow(keyed, f"pass int, dim int, key long, uid long, v {kind}").withColumn("tie", F.xxhash64("pass", "uid"))
    # The tie-break also lets a crowd of equal keys spread over several tasks.
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = "a long, b long, border int, tail boolean, pass int, place int, v array<double>"
    found = store(rows.select("pass", "uid", "v").mapInArrow(lambda it: _pass_batches(it, window, threshold), schema), "pass-links")

    def across(frame: pd.DataFrame) -> pd.DataFrame:
        """Windows over the border between two tasks: at most 2 * ``window`` rows."""
        frame = frame.sort_values(["tail", "place"], ascending=[False, True])
        out = []
        for _, own in frame.groupby([frame["pass"], frame["v"].map(len)]):
            tails = int(own["tail"].sum())
            if 0 < tails < len(own):
                out.append(_edges(own["a"].to_numpy(), matrix(own["v"]), tails, window, threshold))
        return pd.DataFrame({"a": np.concatenate([a for a, _ in out] or [[]]), "b": np.concatenate([b for _, b in out] or [[]])}).astype("int64")

    borders = found.where("border IS NOT NULL").groupBy("border").applyInPandas(across, "a long, b long")
    return found.where("b IS NOT NULL").select("a", "b").union(borders)


def count_links(members: DataFrame, threshold: float) -> DataFrame:
    """(uid, n_links) for a stored table (component, uid, v) of linked vectors."""
    dims = F.col("v")
    unit = F.transform(dims, lambda c: c.cast("double") / F.sqrt(F.aggregate(dims, F.lit(0.0), lambda s, d: s + d.cast("double") * d.cast("double"))))
    means = (
        members.select("component", F.posexplode(unit).alias("i", "c")).groupBy("component", "i").agg(F.avg("c").alias("c"))
        .groupBy("component").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "c"))), lambda s: s["c"]).alias("mean"))
    )
    limit = float(np.cos(np.arccos(threshold) / 2)) + 1e-9

    def cosine(a: str, b: str):
        dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, p: s + p)
        return dot(a, b) / F.sqrt(dot(a, a)) / F.sqrt(dot(b, b))

    placed = members.join(store(means, "means"), "component").select(
        "component", "uid", "v", F.coalesce(cosine("v", "mean") >= limit, F.lit(False)).alias("tight")
    )
    placed = store(placed, "placed")
    sizes = store(
        placed.groupBy("component").agg(F.sum(F.col("tight").cast("long")).alias("tight_n"), F.count("*").alias("n"))
        .withColumn("loose_n", F.col("n") - F.col("tight_n")),
        "component-sizes",
    )
    tight = placed.where("tight").join(sizes, "component").select("uid", (F.col("tight_n") - 1).alias("c"))
    mixed = placed.join(sizes.where("loose_n > 0"), "component")

    def tiles(rows: DataFrame, size: str) -> DataFrame:
        tile = F.pmod(F.xxhash64("uid"), F.ceil(F.col(size) / TILE))
        return rows.groupBy("component", tile.alias("tile")).agg(
            F.collect_list("uid").alias("uid"), F.collect_list("v").alias("v"), F.collect_list("tight").alias("tight")
        )

    every = store(tiles(mixed, "n"), "tiles")
    loose = store(tiles(mixed.where("NOT tight"), "loose_n").select("component", F.col("uid").alias("uid2"), F.col("v").alias("v2")), "loose-tiles")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                x, y = matrix(r["v"]), matrix(r["v2"])
                cosine = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ (y / np.linalg.norm(y, axis=1, keepdims=True)).T
                uid, uid2, tight = np.array(r["uid"]), np.array(r["uid2"]), np.array(r["tight"])
                linked = (cosine >= threshold) & (uid[:, None] != uid2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([uid, uid2])), pa.array(np.concatenate([linked.sum(1), linked[tight].sum(0)]).astype(np.int64))], names=["uid", "c"]
                )

    arrow_batches(members.sparkSession, 16)
    compared = every.join(loose, "component").select("uid", "v", "tight", "uid2", "v2").mapInArrow(compare, "uid long, c long")
    return store(tight.union(compared).groupBy("uid").agg(F.sum("c").alias("n_links")), "link-counts")


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = THRESHOLD,
    passes: int | None = None,
    window: int = WINDOW,
    seed: int = SEED,
) -> DataFrame:
    """(id, n_links, component_id, kept): one row per input row.  Without ``passes``, as
    many as :func:`passes_for` says and more until a round adds nearly nothing."""
    spark = vectors.sparkSession
    arrow_batches(spark, ROWS)
    rows = store(
        vectors.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")), "vectors"
    )
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf"))
    usable = rows.where(
        F.col("v").isNotNull() & (F.size("v") > 0) & ~F.coalesce(F.exists("v", bad), F.lit(True)) & F.exists("v", lambda c: c != 0)
    ).select("uid", "v")
    planned = passes or passes_for(usable.count(), window, threshold)
    size = min(ROUND, -(-planned // 2))  # a round shuffles ROUND copies of the vectors at most
    tree, done, linked, settled = None, 0, 0, False
    while not settled:
        take = min(size, planned - done) if passes else size
        links = candidate_links(usable, threshold, take, window, seed + done)
        before, tree = tree, store(components(links if tree is None else links.union(tree)).toDF("a", "b"), "tree")
        if before is not None:
            discard(before)
        done += take
        gained, linked = -linked, tree.where("a <> b").count()
        gained += linked
        settled = done >= planned and (passes is not None or gained <= linked * MISS / 4)
    labels = tree.toDF("uid", "component")
    members = store(rows.join(labels, "uid").select("component", "uid", "id", "v"), "members")
    counts = count_links(members.select("component", "uid", "v"), threshold)
    names = store(members.groupBy("component").agg(F.min("id").alias("component_id")), "names")
    named = store(members.select("component", "uid").join(names, "component").select("uid", "component_id", F.lit(True).alias("linked")), "named")
    out = rows.select("uid", "id").join(counts, "uid", "left").join(named, "uid", "left")
    component = F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("id"))
    return out.select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"),
    )
