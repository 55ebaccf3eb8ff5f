"""Near copies among vectors: all pairs whose cosine reaches a threshold, by product quantisation.

Different vectors are compared once, however many rows have them. Each goes to the inverted list of its nearest coarse
centroid, with a code of its residual: one byte for each subspace, the place in that subspace's codebook.

A vector looks into its own list and into those lists that a near copy could be in, and that could not find it instead.
For a pair within distance r in lists i and j, the distances to the plane between both centroids add up to r at most, so
one of the two is within r / 2 of it. So the probes suffice: no pair is lost. A pair that both sides reach is taken from
one of them only.

In a list, distances to the coded vectors come from tables (the squared distance of each part of the query's residual to
each entry of the codebooks). A coded vector is off by a length that is stored with it, so whoever is farther than r plus that
length is no near copy. The others are compared by their cosine in double precision.

Lists that lie near one another share a bin, and a query travels once to each bin in which it has a list. A task compares a block of
queries with a bin. It returns a count for each vector and links that connect what is linked, never all pairs. A list longer than
a bin, as many near copies make it, is cut into parts by hash, each part and block of queries a task; that is exact, and
quadratic in such a list. Coarse centroids (at most ``MOST_LISTS``) and codebooks are fitted on a sample of at most
some ``TRAIN_ROWS`` different vectors; they decide speed, not results.

Vectors that are null, empty or zero, or hold null, NaN or infinite components link with nothing. Vectors of different
lengths do not link; each length is searched on its own. Repeated rows are linked with each other. A null id is never the
smallest one, unless its component has no other. An empty table gives no rows. Only the id and the vector are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import map_batches
from parley.llm.components import components
from parley.llm.vectors import mixed
from parley.session import materialize

THRESHOLD = 0.95
MOST_LISTS = 4096
ROWS_PER_LIST = 400
TRAIN_ROWS = 65_536
PART_DIMS = 4
CODES = 256
LIST_ROWS = 10_000
QUERY_ROWS = 20_000
TOGETHER = 256
BATCH_BYTES = 4 << 20
# more than what rounding can do to a distance of unit vectors, in double and in single precision
SLACK, TABLE_SLACK = 1e-9, 1e-4


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision; scaled by their largest component first, so that no square overflows."""
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True, initial=np.finfo(float).tiny)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def squared_distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1), 0)


def lloyd(x: np.ndarray, k: int, rounds: int = 8, seed: int = 1) -> np.ndarray:
    """At most ``k`` centres of the rows of ``x``."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        nearest = np.concatenate([squared_distances(x[i : i + 4096], centres).argmin(axis=1) for i in range(0, len(x), 4096)])
        sizes = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


class Quantiser:
    """Coarse centroids, and a codebook for the residuals of each run of dimensions."""

    def __init__(self, centroids: np.ndarray, parts: list[np.ndarray], codebooks: list[np.ndarray]):
        self.centroids, self.parts, self.codebooks = centroids, parts, codebooks
        self.between = np.sqrt(squared_distances(centroids, centroids))
        self.squares = [(book * book).sum(axis=1, keepdims=True).astype(np.float32) for book in codebooks]
        self.doubles = [(2 * book).astype(np.float32) for book in codebooks]

    @staticmethod
    def fitted(sample: np.ndarray, lists: int) -> Quantiser:
        centroids = lloyd(sample, lists)
        nearest = np.concatenate([squared_distances(sample[i : i + 4096], centroids).argmin(axis=1) for i in range(0, len(sample), 4096)])
        rest = sample - centroids[nearest]
        dim = sample.shape[1]
        parts = np.array_split(np.arange(dim), max(1, math.ceil(dim / PART_DIMS)))
        some = rest[:: max(1, len(rest) // 16_384)]
        return Quantiser(centroids, parts, [lloyd(some[:, p], CODES) for p in parts])

    def assign(self, x: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(list, code, length of what the code leaves out, flat probes, number of probes) of each row; its own list is no probe."""
        far = squared_distances(x, self.centroids)
        own = far.argmin(axis=1)
        rest = x - self.centroids[own]
        codes = np.zeros((len(x), len(self.parts)), np.uint8)
        off = np.zeros(len(x))
        for m, (part, book) in enumerate(zip(self.parts, self.codebooks)):
            codes[:, m] = squared_distances(rest[:, part], book).argmin(axis=1)
            off += ((rest[:, part] - book[codes[:, m]]) ** 2).sum(axis=1)
        # the distance to the plane between both centroids, times twice the distance of the centroids
        ahead = far - far[np.arange(len(x)), own][:, None]
        near = ahead <= (radius + SLACK) * self.between[own] + SLACK
        near[np.arange(len(x)), own] = False
        return own, codes, np.sqrt(off), np.nonzero(near)[1], near.sum(axis=1)

    def tables(self, queries: np.ndarray, cell: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """The squared lengths of the queries' residuals, and for each subspace what an entry of its codebook (row) adds for each query
        (column), so that their sum is the squared distance."""
        rest = (queries - self.centroids[cell]).astype(np.float32)
        return (rest * rest).sum(axis=1), [square - double @ rest[:, p].T for p, square, double in zip(self.parts, self.squares, self.doubles)]


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Places of pairs that connect the same of ``n`` nodes as all pairs do, one less than each component has nodes."""
    label, left, chosen = np.arange(n), np.arange(len(a)), []
    while True:
        la, lb = label[a[left]], label[b[left]]
        open_ = la != lb
        left, la, lb = left[open_], la[open_], lb[open_]
        if not len(left):
            return np.concatenate([np.zeros(0, np.int64), *chosen])
        # every root hooks to a smaller one, by one pair
        roots, first = np.unique(np.maximum(la, lb), return_index=True)
        chosen.append(left[first])
        parent = np.arange(n)
        parent[roots] = np.minimum(la, lb)[first]
        while (parent[parent] != parent).any():
            parent = parent[parent]
        label = parent[label]


def _vectors(rows: pa.Table) -> np.ndarray:
    flat = rows["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(rows.num_rows, -1)


class Members:
    """The vectors of one list that are in a task."""

    def __init__(self, rows: pa.Table, vectors: np.ndarray, at: np.ndarray):
        self.vectors, self.at = vectors[at], at
        self.rep, self.weight, self.off = (rows[c].to_numpy()[at] for c in ("rep", "weight", "off"))
        rows = rows.take(pa.array(at))
        self.codes = np.frombuffer(b"".join(rows["code"].to_pylist()), np.uint8).reshape(len(at), -1)
        probes = rows["probes"].combine_chunks()
        self.probe_of = np.repeat(np.arange(len(at)), probes.value_lengths().to_numpy(zero_copy_only=False))
        self.probe_to = probes.flatten().to_numpy(zero_copy_only=False)

    def look_into(self, lists: int) -> np.ndarray:
        """Whether each member looks into each list."""
        out = np.zeros((len(self.at), lists), bool)
        out[self.probe_of, self.probe_to] = True
        return out


def _cell_links(queries: np.ndarray, reps: np.ndarray, own: np.ndarray, members: Members, cell: int, quantiser: Quantiser, threshold: float, radius: float):
    """(places of queries, places of members) of the linked pairs among those given, some queries at a time."""
    reach = ((radius + SLACK + members.off) ** 2 + TABLE_SLACK).astype(np.float32)
    looks = members.look_into(len(quantiser.centroids))
    for lo in range(0, len(queries), TOGETHER):
        part = queries[lo : lo + TOGETHER]
        # a code is a row of the table, so what is looked up for all queries lies side by side
        lengths, tables = quantiser.tables(part, cell)
        far = np.tile(lengths, (len(members.at), 1))
        for m, table in enumerate(tables):
            far += table[members.codes[:, m]]
        y, x = np.nonzero(far <= reach[:, None])
        home = own[lo + x]
        # members that look into the query's own list find the pair there, and two of one list meet once
        kept = np.where(home == cell, reps[lo + x] < members.rep[y], (home < cell) | ~looks[y, home])
        x, y = x[kept], y[kept]
        rows, some = np.unique(x), np.unique(y)
        if 8 * len(x) > len(rows) * len(some):
            # so many candidates that one product of matrices costs less than the pairs
            near = np.zeros((len(part), len(members.at)), bool)
            near[x, y] = True
            linked = (part[rows] @ members.vectors[some].T >= threshold) & near[np.ix_(rows, some)]
            x, y = np.nonzero(linked)
            x, y = rows[x], some[y]
        else:
            linked = np.einsum("ij,ij->i", part[x], members.vectors[y]) >= threshold
            x, y = x[linked], y[linked]
        if len(x):
            yield lo + x, y


def compare(queries: pa.Table, members: pa.Table, quantiser: Quantiser, threshold: float, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows linked with each query and each member, and a forest of links as places (query, member)."""
    q, d = unit(_vectors(queries)), unit(_vectors(members))
    q_rep, q_n, q_own, d_own = queries["rep"].to_numpy(), queries["weight"].to_numpy(), queries["own"].to_numpy(), members["own"].to_numpy()
    cells = queries["cells"].combine_chunks()
    asker = np.repeat(np.arange(len(q)), cells.value_lengths().to_numpy(zero_copy_only=False))
    asked = cells.flatten().to_numpy(zero_copy_only=False)
    count_q, count_d, left, right = np.zeros(len(q), np.int64), np.zeros(len(d), np.int64), [], []
    for cell in np.unique(d_own):
        at, there = asker[asked == cell], Members(members, d, np.flatnonzero(d_own == cell))
        for x, y in _cell_links(q[at], q_rep[at], q_own[at], there, int(cell), quantiser, threshold, radius):
            np.add.at(count_q, at[x], there.weight[y])
            np.add.at(count_d, there.at[y], q_n[at[x]])
            nodes, (a, b) = np.unique(x), (np.searchsorted(np.unique(x), x), np.searchsorted(np.unique(y), y))
            kept = forest(a, b + len(nodes), len(nodes) + len(np.unique(y)))
            left.append(at[x[kept]])
            right.append(there.at[y[kept]])
    left, right = (np.concatenate([np.zeros(0, np.int64), *s]) for s in (left, right))
    kept = forest(left, right + len(q), len(q) + len(d))
    return count_q, count_d, np.column_stack([left[kept], right[kept]])


def chained(centroids: np.ndarray) -> np.ndarray:
    """The lists in an order in which neighbours are near: from each to the nearest one that is left."""
    far = squared_distances(centroids, centroids)
    left, order = np.ones(len(centroids), bool), [0]
    left[0] = False
    while left.any():
        order.append(int(np.where(left, far[order[-1]], np.inf).argmin()))
        left[order[-1]] = False
    return np.array(order)


def packed(order: np.ndarray, members: np.ndarray, asked: np.ndarray, n: int, list_rows: int, query_rows: int) -> list[tuple[int, int, int, int]]:
    """(list, bin, parts, blocks): neighbouring lists share a bin of at most ``list_rows`` members; a longer list has a bin of its own, in
    parts. The queries that a bin may get are dealt to blocks of some ``query_rows``."""
    bins: list[list[int]] = []
    total = int(members.sum())
    # bins of about one size
    room = min(list_rows, math.ceil(1.1 * total / max(1, math.ceil(total / list_rows))))
    size = room + 1
    for cell in order[members[order] > 0]:
        if size + members[cell] > room:
            bins.append([])
            size = 0
        bins[-1].append(int(cell))
        size += int(members[cell])
    out = []
    for i, cells in enumerate(bins):
        parts = max(1, math.ceil(int(members[cells].sum()) / list_rows))
        blocks = max(1, math.ceil(min(n, int(asked[cells].sum())) / query_rows))
        out += [(cell, i, parts, blocks) for cell in cells]
    return out


def _links(different: DataFrame, n: int, threshold: float, rows_per_list: int, list_rows: int, query_rows: int) -> DataFrame:
    """(rep, other, n), stored: with ``other``, a link; without, ``n`` rows that ``rep`` is linked with. All vectors have one length."""
    radius = math.sqrt(max(0.0, 2 - 2 * threshold))
    lists = min(MOST_LISTS, 1 << int(math.log2(max(1.0, 4 * math.sqrt(n / rows_per_list)))))
    share = min(1.0, TRAIN_ROWS / n)
    sample = different.filter(F.pmod(F.xxhash64("rep", F.lit("sample")), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).select("rep", "v").toArrow()
    quantiser = Quantiser.fitted(unit(_vectors(sample.sort_by("rep"))), lists)
    spark = different.sparkSession
    known = spark.sparkContext.broadcast((quantiser.centroids, quantiser.parts, quantiser.codebooks))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quantiser = Quantiser(*known.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                rows = pa.Table.from_batches([batch.slice(lo, 1024)])
                own, codes, off, probes, sizes = quantiser.assign(unit(_vectors(rows)), radius)
                lists = pa.ListArray.from_arrays(np.append(0, np.cumsum(sizes)).astype(np.int32), pa.array(probes.astype(np.int32)))
                found = [pa.array(own.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(off), lists]
                yield pa.RecordBatch.from_arrays([*[rows[c].combine_chunks() for c in ("rep", "weight", "v")], *found], names)

    names = ["rep", "weight", "v", "own", "code", "off", "probes"]
    v_type = different.schema["v"].dataType.simpleString()
    schema = f"rep long, weight long, v {v_type}, own int, code binary, off double, probes array<int>"
    indexed = materialize(map_batches(different.select("rep", "weight", "v"), assign, schema, BATCH_BYTES), "indexed")
    sizes = np.zeros((2, len(quantiser.centroids)), np.int64)
    asks = indexed.select(F.explode(F.concat(F.array("own"), "probes")).alias("cell"))
    # a row for each list, ``MOST_LISTS`` at most
    for place, cells in enumerate((indexed.select(F.col("own").alias("cell")), asks)):
        for r in cells.groupBy("cell").agg(F.count("*").alias("n")).collect():
            sizes[place, r["cell"]] = r["n"]
    bins = packed(chained(quantiser.centroids), sizes[0], sizes[1], n, list_rows, query_rows)
    bin_of, part_of, block_of = (np.full(len(quantiser.centroids), -1) for _ in range(3))
    for cell, *rest in bins:
        bin_of[cell], part_of[cell], block_of[cell] = rest

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A query once for each bin that it looks into, with its lists there."""
        for batch in batches:
            probes = batch.column("probes")
            row = np.repeat(np.arange(batch.num_rows), probes.value_lengths().to_numpy(zero_copy_only=False))
            row = np.concatenate([np.arange(batch.num_rows), row])
            cell = np.concatenate([batch.column("own").to_numpy(), probes.flatten().to_numpy(zero_copy_only=False)])
            filled = bin_of[cell] >= 0
            row, cell = row[filled], cell[filled]
            order = np.lexsort((bin_of[cell], row))
            row, cell = row[order], cell[order]
            first = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(bin_of[cell], prepend=-1) != 0))
            lists = pa.ListArray.from_arrays(np.append(first, len(row)).astype(np.int32), pa.array(cell.astype(np.int32)))
            row, cell = row[first], cell[first]
            block = mixed(batch.column("rep").to_numpy()[row].view(np.uint64), 0) % block_of[cell].astype(np.uint64)
            found = [pa.array(x.astype(np.int32)) for x in (bin_of[cell], block, part_of[cell])]
            taken = [batch.column(c).take(pa.array(row)) for c in ("rep", "weight", "v", "own")]
            yield pa.RecordBatch.from_arrays([*found, *taken, lists], ["bin", "a", "parts", "rep", "weight", "v", "own", "cells"])

    schema = f"bin int, a int, parts int, rep long, weight long, v {v_type}, own int, cells array<int>"
    asking = map_batches(indexed.select("rep", "weight", "v", "own", "probes"), deal, schema, BATCH_BYTES)
    queries = asking.select(
        "bin", "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("b"), "rep", "weight", "v", "own", "cells",
        F.lit(None).cast("binary").alias("code"), F.lit(None).cast("double").alias("off"), F.lit(None).cast("array<int>").alias("probes"),
    )
    blocks = F.broadcast(spark.createDataFrame(bins, "own int, bin int, parts int, blocks int"))
    members = indexed.join(blocks, "own").select(
        "bin", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("a"), F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int").alias("b"),
        "rep", "weight", "v", "own", F.lit(None).cast("array<int>").alias("cells"), "code", "off", "probes",
    )

    def search(rows: pa.Table) -> pa.Table:
        asking = pc.is_valid(rows["cells"])
        queries, members = rows.filter(asking), rows.filter(pc.invert(asking))
        if not (queries.num_rows and members.num_rows):
            return pa.table({"rep": pa.array([], pa.int64()), "other": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        count_q, count_d, pairs = compare(queries, members, Quantiser(*known.value), threshold, radius)
        q_rep, d_rep = queries["rep"].to_numpy(), members["rep"].to_numpy()
        some_q, some_d = np.flatnonzero(count_q), np.flatnonzero(count_d)
        rep = np.concatenate([q_rep[some_q], d_rep[some_d], q_rep[pairs[:, 0]]])
        counts = len(some_q) + len(some_d)
        other = np.concatenate([np.zeros(counts, np.int64), d_rep[pairs[:, 1]]])
        is_count = np.arange(len(rep)) < counts
        n = np.concatenate([count_q[some_q], count_d[some_d], np.zeros(len(pairs), np.int64)])
        return pa.table({"rep": pa.array(rep), "other": pa.array(other, mask=is_count), "n": pa.array(n)})

    found = queries.unionByName(members).groupBy("bin", "a", "b").applyInArrow(search, "rep long, other long, n long")
    return materialize(found, "found")


def near_copies(
    df: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vec_col: str = "embedding", rows_per_list: int = ROWS_PER_LIST,
    list_rows: int = LIST_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """One row per row of ``df``: vec_id, n_links (other rows linked directly), component_id (the smallest id that links reach, its
    own included), kept (whether that is its own)."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is a cosine above 0")
    v, inf = F.col(vec_col), F.lit(float("inf"))
    good = v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < inf)) & F.exists(v, lambda c: c != 0)
    rows = df.select(F.col(id_col).alias("vec_id"), F.when(good, v).alias("v"))
    grouped = rows.filter("v IS NOT NULL").groupBy("v").agg(F.count("*").alias("weight"), F.min("vec_id").alias("low"))
    different = materialize(grouped.withColumn("rep", F.monotonically_increasing_id()), "different")
    sizes = different.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy("dim").toLocalIterator()
    found: DataFrame | None = None
    for dim, n in [(r["dim"], r["n"]) for r in sizes]:
        part = _links(different.filter(F.size("v") == dim), n, threshold, rows_per_list, list_rows, query_rows)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return df.select(
            F.col(id_col).alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col(id_col).alias("component_id"), F.lit(True).alias("kept")
        )
    edges = found.filter("other IS NOT NULL").select(F.col("rep").alias("a"), F.col("other").alias("b"))
    reached = components(edges).withColumnRenamed("id", "rep")
    counts = found.filter("other IS NULL").groupBy("rep").agg(F.sum("n").alias("n"))
    linked = different.join(reached, "rep", "left").select("rep", "v", "weight", "low", F.coalesce("component", "rep").alias("component"))
    lows = linked.groupBy("component").agg(F.min("low").alias("component_id"))
    classes = linked.join(lows, "component").join(counts, "rep", "left").select(
        "v", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id"
    )
    classes = materialize(classes, "classes")
    out = rows.join(classes, "v", "left")
    smallest = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), smallest.alias("component_id"), F.col("vec_id").eqNullSafe(smallest).alias("kept")
    )
