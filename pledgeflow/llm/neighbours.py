"""Approximate nearest neighbours by cosine with a hash-prefix forest.

Each tree gives a vector a long hash string, the signs of its products with random
orthogonal planes; the strings of a tree, sorted, are its array. A query descends to its
longest prefix match in every tree and all trees ascend together, a bit at a time, until
enough candidates share the prefix; those are compared exactly. How many are enough is
calibrated on a bounded sample of queries whose true neighbours are computed by brute force.

Trees are cut at a common prefix into subtrees, and subtrees with many rows or queries into
blocks, so every task holds a bounded piece; counts and best candidates of pieces add up.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pledgeflow.llm.text_batches import ship
from pledgeflow.session import materialise

TREES, LENGTH, SEED = 16, 64, 5
# queries of the calibration sample, and the share of their true neighbours it must reach
SAMPLE, TARGET = 200, 0.96
# rows and queries of one task's piece of a subtree
BLOCK_ROWS, BLOCK_QUERIES = 65_536, 16_384


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components, and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def planes(tree: int, dimension: int) -> np.ndarray:
    """``LENGTH`` unit planes, orthogonal in groups of the dimension."""
    rng = np.random.default_rng([SEED, tree, dimension])
    groups = [np.linalg.qr(rng.standard_normal((dimension, dimension)))[0].T for _ in range(-(-LENGTH // dimension))]
    return np.concatenate(groups)[:LENGTH]


def hash_strings(vectors: np.ndarray, trees: int) -> np.ndarray:
    """One 64-bit string per vector and tree, first bit highest, as unsigned integers."""
    out = np.empty((len(vectors), trees), np.uint64)
    for tree in range(trees):
        bits = vectors @ planes(tree, vectors.shape[1]).T > 0
        out[:, tree] = np.packbits(bits, axis=1).view(">u8")[:, 0]
    return out


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _hashed(classes: DataFrame, trees: int) -> DataFrame:
    """``classes`` with their hash strings, as signed integers."""
    schema = T.StructType([*classes.schema.fields]).add("strings", T.ArrayType(T.LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size")
            for size in pc.unique(sizes).to_pylist():
                part = batch.filter(pc.equal(sizes, size))
                strings = hash_strings(_matrix(part.column("vector")), trees).view(np.int64)
                column = pa.ListArray.from_arrays(np.arange(0, strings.size + 1, trees, np.int32), strings.ravel())
                yield pa.RecordBatch.from_arrays([*part.columns, column], names=schema.names)

    return ship(classes).mapInArrow(run, schema)


def _scores(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Cosines in double precision; each row's value does not depend on the others."""
    products = (rows * query).sum(axis=1)
    return products / (np.sqrt((rows * rows).sum(axis=1)) * np.sqrt((query * query).sum()))


def _best(scores: np.ndarray, names: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the k best scores, ties to the smaller name."""
    if len(scores) > 4 * k:
        bound = np.partition(scores, len(scores) - k)[len(scores) - k]
        maybe = np.flatnonzero(scores >= bound)
    else:
        maybe = np.arange(len(scores))
    return maybe[np.lexsort((names[maybe], -scores[maybe]))[:k]]


def _true_neighbours(classes: DataFrame, sample: Sequence, k: int) -> DataFrame:
    """(query, class, strings of the class): the k best of all classes for each sampled query."""
    queries = [(row["class"], row["size"], np.array(row["vector"], np.float64)) for row in sample]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, sizes = batch.column("class").to_numpy(), batch.column("size").to_numpy()
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                matrix, strings = _matrix(batch.column("vector").take(pa.array(at))), batch.column("strings").take(pa.array(at))
                for name, own_size, vector in queries:
                    if own_size != size:
                        continue
                    scores = np.where(names[at] == name, -2.0, _scores(matrix, vector))
                    best = _best(scores, names[at], k)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(best), name)),
                            pa.array(names[at][best]),
                            pa.array(scores[best]),
                            strings.take(pa.array(best)),
                        ],
                        names=["query", "class", "score", "strings"],
                    )

    found = ship(classes).mapInArrow(run, "query long, class long, score double, strings array<long>")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "class")
    return found.filter("score > -2").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _common_prefix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of 64-bit strings."""
    differing = (a ^ b).astype(np.uint64)
    length = np.full(differing.shape, 64)
    for shift in (32, 16, 8, 4, 2, 1):
        high = differing >> np.uint64(shift) > 0
        length = np.where(high, length - shift, length)
        differing = np.where(high, differing >> np.uint64(shift), differing)
    return length - (differing > 0)


def _range(strings: np.ndarray, query: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end positions, in a sorted array, of the strings that share ``depth`` bits with the query."""
    free = np.where(depth >= 64, np.uint64(0), np.uint64(0xFFFFFFFFFFFFFFFF) >> np.minimum(depth, 63).astype(np.uint64))
    low, high = query & ~free, query | free
    return np.searchsorted(strings, low, "left"), np.searchsorted(strings, high, "right")


def _pieces(classes: DataFrame, prefix: int, with_vectors: bool, queries: DataFrame | None = None) -> DataFrame:
    """Rows and queries of every tree, dealt to (tree, size, subtree, row block, query block).

    Blocks follow from counted subtree sizes, so a crowded subtree is split evenly.
    """
    value = ["vector"] if with_vectors else []
    tree = F.posexplode("strings").alias("tree", "string")
    subtree = F.lit(0).cast("long") if prefix == 0 else F.shiftrightunsigned("string", 64 - prefix)
    base = ["tree", "size", subtree.alias("subtree")]
    rows = classes.select("class", "size", "asks", *value, tree).select(*base, "class", "string", "asks", *value)
    asking = (queries if queries is not None else classes.filter("asks").withColumn("depth", F.lit(0)))
    asking = asking.select("class", "size", "depth", *value, tree).select(*base, "class", "string", "depth", *value)
    if queries is not None:
        rows = rows.join(asking.select("tree", "size", "subtree").distinct(), ["tree", "size", "subtree"], "left_semi")
    sizes = rows.groupBy("tree", "size", "subtree").agg(
        F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("row_blocks"),
        F.ceil(F.greatest(F.sum(F.col("asks").cast("int")), F.lit(1)) / BLOCK_QUERIES).cast("int").alias("query_blocks"),
    )
    sizes = materialise(sizes)
    keys = ["tree", "size", "subtree"]

    def dealt(frame: DataFrame, own: str, other: str, is_query: bool) -> DataFrame:
        joined = frame.join(sizes, keys)
        block = F.pmod(F.xxhash64("class"), F.col(f"{own}_blocks")).cast("int").alias(f"{own}_block")
        copies = F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)).alias(f"{other}_block")
        depth = F.col("depth") if is_query else F.lit(-1)
        return joined.select(*keys, "class", "string", depth.cast("int").alias("depth"), *value, block, copies)

    return dealt(rows, "row", "query", False).unionByName(dealt(asking, "query", "row", True))


_PIECE = ["tree", "size", "subtree", "row_block", "query_block"]


def _split(table: pa.Table) -> tuple[pa.Table, pa.Table]:
    is_row = pc.less(table.column("depth"), 0)
    rows, queries = table.filter(is_row), table.filter(pc.invert(is_row))
    order = np.argsort(rows.column("string").to_numpy().view(np.uint64))
    return rows.take(pa.array(order)), queries


def _prefix_counts(classes: DataFrame, prefix: int) -> DataFrame:
    """(class, counts): for each asking class, rows over all trees that share prefix, prefix + 1, ... 64 bits."""
    depths = list(range(prefix, LENGTH + 1))

    def count(table: pa.Table) -> pa.Table:
        rows, queries = _split(table)
        strings = rows.column("string").to_numpy().view(np.uint64)
        asked = queries.column("string").to_numpy().view(np.uint64)
        found = []
        for depth in depths:
            first, end = _range(strings, asked, np.full(len(asked), depth))
            found.append(end - first)
        return pa.table([queries.column("class"), *map(pa.array, found)], names=["class", *[f"d{d}" for d in depths]])

    schema = T.StructType([T.StructField("class", T.LongType()), *[T.StructField(f"d{d}", T.LongType()) for d in depths]])
    counted = ship(_pieces(classes, prefix, False)).groupBy(*_PIECE).applyInArrow(count, schema)
    return counted.groupBy("class").agg(F.array(*[F.sum(f"d{d}") for d in depths]).alias("counts"))


def _search(classes: DataFrame, queries: DataFrame, prefix: int, k: int) -> DataFrame:
    """(query, class, score): the k best candidates of every piece for each query."""

    def search(table: pa.Table) -> pa.Table:
        rows, queries = _split(table)
        out: list[list] = [[], [], []]
        if rows.num_rows and queries.num_rows:
            strings = rows.column("string").to_numpy().view(np.uint64)
            names, matrix = rows.column("class").to_numpy(), _matrix(rows.column("vector"))
            norms = np.sqrt((matrix * matrix).sum(axis=1))
            asked, vectors = queries.column("class").to_numpy(), _matrix(queries.column("vector"))
            first, end = _range(strings, queries.column("string").to_numpy().view(np.uint64), queries.column("depth").to_numpy())
            for name, vector, low, high in zip(asked, vectors, first.tolist(), end.tolist(), strict=True):
                if low == high:
                    continue
                rough = matrix[low:high] @ vector / norms[low:high]
                wanted = min(k + 1, len(rough))
                bound = np.partition(rough, len(rough) - wanted)[len(rough) - wanted]
                maybe = low + np.flatnonzero(rough >= bound - 1e-9 * (1 + abs(bound)))
                exact = _scores(matrix[maybe], vector)
                best = [i for i in _best(exact, names[maybe], k + 1) if names[maybe[i]] != name][:k]
                out[0] += [int(name)] * len(best)
                out[1] += names[maybe[best]].tolist()
                out[2] += exact[best].tolist()
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], names=["query", "class", "score"])

    pieces = ship(_pieces(classes, prefix, True, queries)).groupBy(*_PIECE)
    return pieces.applyInArrow(search, "query long, class long, score double")


def _ascended(classes: DataFrame, queries: DataFrame, prefix: int, k: int) -> DataFrame:
    """(query, class, score): candidates of every query, k classes at least or all others of its vector length.

    Queries that met fewer ascend further, to half the depth each time; at depth 0 one tree's root holds every row.
    """
    found = materialise(_search(classes, queries, prefix, k).distinct())
    lengths = materialise(classes.groupBy("size").agg((F.count("*") - 1).alias("others")))
    wanted = materialise(queries.join(lengths, "size").withColumn("wanted", F.least(F.lit(k), "others")))
    level = LENGTH
    while level:
        met = found.groupBy(F.col("query").alias("class")).agg(F.count_distinct("class").alias("met"))
        short = wanted.join(met, "class", "left").filter(F.coalesce("met", F.lit(0)) < F.col("wanted")).drop("met")
        wanted = materialise(short.withColumn("depth", F.col("depth").cast("int")))
        deepest = wanted.agg(F.max("depth")).first()[0]
        if deepest is None:
            break
        level = min(level, deepest) // 2
        wanted = wanted.withColumn("depth", F.least("depth", F.lit(level)))
        prefix, rows, asked = min(prefix, level), classes, wanted
        if not level:
            rows, asked = (x.withColumn("strings", F.slice("strings", 1, 1)) for x in (rows, asked))
        more = _search(rows, asked, prefix, k)
        found = materialise(found.unionByName(more).distinct())
    return found


def nearest(
    df: DataFrame, asks: Column, vector: str = "embedding", key: str = "vec_id", k: int = 5, trees: int = TREES, target: float = TARGET
) -> DataFrame:
    """(query_id, rank, vec_id, score): k nearest found by cosine for each row where ``asks`` holds.

    Candidates are all rows but the query's own; ties go to the smaller key. Vectors that are
    null or zero or hold null or non-finite components take no part, nor do null keys; vectors
    of different lengths are never compared. Equal vectors are searched once and share their
    neighbours; of a class of equal vectors only its k + 1 smallest keys can be among the
    nearest, so the others are left out as candidates, not as queries. Repeated keys count as
    rows. No rows if the table has no query or a single vector.
    """
    rows = df.filter(usable(F.col(vector)) & F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("id"), asks.alias("asks"), F.col(vector).alias("vector")
    )
    rows = rows.withColumns({"h1": F.xxhash64("vector"), "h2": F.xxhash64(F.lit(SEED), "vector")})
    rows = materialise(rows)
    by_value = Window.partitionBy("h1", "h2").orderBy("id")
    members = rows.select("id", "h1", "h2").withColumn("place", F.row_number().over(by_value)).filter(F.col("place") <= k + 1)
    classes = rows.groupBy("h1", "h2").agg(F.max("asks").alias("asks"), F.first("vector").alias("vector"))
    # a name no two classes share, fixed by the write below
    classes = classes.select(
        F.monotonically_increasing_id().alias("class"), "h1", "h2", "asks", F.size("vector").alias("size"), "vector"
    )
    classes = materialise(_hashed(classes, trees))
    asking = classes.filter("asks")
    sample = asking.orderBy(F.xxhash64("h1", "h2")).limit(SAMPLE).select("class", "size", "vector", "strings").collect()
    total = classes.count()
    true = _true_neighbours(classes, sample, k).select("query", "strings").collect() if sample else []
    if not true:
        prefix, enough = 0, 1
    else:
        own = {row["class"]: np.array(row["strings"], np.int64).view(np.uint64) for row in sample}
        reached = [
            (row["query"], int(_common_prefix(own[row["query"]], np.array(row["strings"], np.int64).view(np.uint64)).max())) for row in true
        ]
        depths = sorted(depth for _, depth in reached)
        common = depths[int((1 - target) * len(depths))]
        prefix = max(0, min(common - 1, int(math.log2(max(total / 4096, 1)))))
    counts = materialise(_prefix_counts(classes, prefix))
    if true:
        sampled = counts.filter(F.col("class").isin(list(own))).collect()
        held = {row["class"]: row["counts"] for row in sampled}
        needed = sorted(held[query][max(depth - prefix, 0)] for query, depth in reached)
        enough = needed[min(len(needed) - 1, int(math.ceil(target * len(needed))))]
    deep = F.size(F.filter("counts", lambda n: n >= enough))
    queries = asking.join(counts.select("class", F.greatest(deep - 1, F.lit(0)).alias("depth")), "class")
    queries = queries.withColumn("depth", F.col("depth") + prefix)
    found = _ascended(classes, queries, prefix, k)
    # copies of the query's own vector are its nearest; their score is computed like any other
    own_class = asking.select(F.col("class").alias("query"), "class", _self_cosine("vector").alias("score"))
    classes_ids = classes.select("class", "h1", "h2")
    named = members.join(classes_ids, ["h1", "h2"]).select("class", "id")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    best = found.unionByName(own_class).join(named, "class").withColumn("place", F.row_number().over(order))
    hits = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "id")))
    lists = best.filter(F.col("place") <= k + 1).groupBy("query").agg(hits.alias("near"))
    asked = rows.filter("asks").select("id", "h1", "h2").join(classes_ids, ["h1", "h2"]).select("id", F.col("class").alias("query"))
    near = F.filter("near", lambda x: x["id"] != F.col("id"))
    return (
        asked.join(lists, "query")
        .select("id", F.posexplode(F.slice(near, 1, k)).alias("rank", "hit"))
        .select(
            F.col("id").alias("query_id"),
            (F.col("rank") + 1).cast("int").alias("rank"),
            F.col("hit.id").alias("vec_id"),
            (-F.col("hit.s")).alias("score"),
        )
    )


def _self_cosine(vector: str) -> Column:
    square = F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return square / (F.sqrt(square) * F.sqrt(square))
