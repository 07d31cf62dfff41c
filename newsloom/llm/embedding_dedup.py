"""Near-duplicate vectors by spherical-cap filters."""

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import sorted_groups, store
from newsloom.llm.components import components

MIN_COSINE = 0.9
# Filters that two vectors right at the threshold are expected to share.
SHARED = 7.0
# Vectors that a filter is expected to hold. Those that are alone in a filter are left out there
# before any vector is sent, so that less than one saves more than it costs.
FILLED = 0.5
# Of a hundred pairs right at the threshold, how many may share no filter.
MISSED = 0.015
# Codes that the filters are counted for at first; each has its own rotation. Directions of one
# code are not independent, so that many small codes miss fewer pairs than few large ones, and
# what a code finds is measured: on so many codes and simulated pairs.
CODES = 32
_TRIED_CODES = 16
_TRIED_PAIRS = 500
# Codewords of a block above which a code gets one more block.
MOST_WORDS = 2000
# Fewer dimensions are filled up with zeros, which leaves cosines as they are.
LEAST_DIMS = 16
# Members of a filter that are compared with each other in one go; more go in pairs of blocks.
BLOCK = 2048
_SMALL = 32
_PAIRS = 1 << 17


@dataclass(frozen=True)
class Code:
    """Random product codes on the sphere, of `dims` dimensions."""

    dims: int
    level: float
    blocks: int
    words: int
    seed: int
    codes: int = CODES

    def parts(self) -> list[tuple[np.ndarray, list[np.ndarray]]]:
        """Per code a rotation and the unit codewords of each block."""
        made = []
        for code in range(self.codes):
            rng = np.random.default_rng([self.seed, code, self.dims])
            rotation, _ = np.linalg.qr(rng.standard_normal((self.dims, self.dims)))
            words = []
            for width in _widths(self.dims, self.blocks):
                drawn = rng.standard_normal((self.words, width))
                words.append(drawn / np.linalg.norm(drawn, axis=1, keepdims=True))
            made.append((rotation.astype(np.float32), [w.astype(np.float32) for w in words]))
        return made

    def decode(self, vectors: np.ndarray, parts: list) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) of each filter direction whose inner product with the row's unit
        vector is `level` at least.

        A direction is one codeword of each block, all scaled alike. Blocks are gone through
        one by one; a partial direction goes on only while the best of the blocks to come
        could lift it to the level.
        """
        rows, filters = [], []
        for code, (rotation, words) in enumerate(parts):
            turned = vectors @ rotation
            scores, at = [], 0
            for w in words:
                scores.append(turned[:, at : at + w.shape[1]] @ w.T / np.float32(math.sqrt(self.blocks)))
                at += w.shape[1]
            best = [s.max(axis=1) for s in scores]
            row = np.arange(len(vectors))
            number = np.zeros(len(vectors), np.int64)
            total = np.zeros(len(vectors), np.float32)
            for b, s in enumerate(scores):
                to_come = sum(best[b + 1 :], np.zeros(len(vectors), np.float32))
                found = []
                for i in range(0, len(row), 4096):
                    r = row[i : i + 4096]
                    sums = total[i : i + 4096, None] + s[r]
                    k, j = np.nonzero(sums >= (self.level - to_come[r])[:, None])
                    found.append((r[k], number[i : i + 4096][k] * self.words + j, sums[k, j]))
                if not found:
                    break
                row, number, total = (np.concatenate(x) for x in zip(*found, strict=True))
            rows.append(row)
            filters.append(number * self.codes + code)
        return np.concatenate(rows), np.concatenate(filters)


def _widths(dims: int, blocks: int) -> list[int]:
    return [dims // blocks + (b < dims % blocks) for b in range(blocks)]


def _shares(dims: int, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(levels, share of the sphere in a cap of the level, share in the caps of two vectors)."""
    grid = np.linspace(-1, 1, 801)
    x, y = np.meshgrid(grid, grid)
    inside = np.clip(1 - x * x - y * y, 0, None)
    density = inside ** ((dims - 4) / 2)
    density /= density.sum()
    first = x
    second = cosine * x + math.sqrt(1 - cosine * cosine) * y
    levels = np.linspace(0, 0.95, 191)
    order_one, order_two = first.ravel(), np.minimum(first, second).ravel()

    def tail(values: np.ndarray) -> np.ndarray:
        order = np.argsort(values)
        sums = np.concatenate([np.cumsum(density.ravel()[order][::-1])[::-1], [0.0]])
        return sums[np.searchsorted(values[order], levels)]

    return levels, tail(order_one), tail(order_two)


def found_by_each(code: Code, cosine: float, pairs: int = _TRIED_PAIRS, seed: int = 5) -> np.ndarray:
    """Which simulated pairs right at the threshold share a filter in each code: (pairs, codes)."""
    rng = np.random.default_rng([seed, code.dims])
    x, z = rng.standard_normal((2, pairs, code.dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= np.einsum("ij,ij->i", z, x)[:, None] * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    both = np.concatenate([x, cosine * x + math.sqrt(1 - cosine * cosine) * z]).astype(np.float32)
    found = np.zeros((pairs, code.codes), bool)
    for c, part in enumerate(code.parts()):
        row, name = code.decode(both, [part])
        key = name * pairs + row % pairs
        found[np.intersect1d(key[row < pairs], key[row >= pairs]) % pairs, c] = True
    return found


def choose_code(
    n: int, dims: int, cosine: float = MIN_COSINE, shared: float = SHARED, missed: float = MISSED, seed: int = 11
) -> Code:
    """A code for `n` vectors: filters narrow enough that each holds about FILLED of vectors
    without neighbours, and as many codes as it takes for a share of at most `missed` of the
    pairs at the threshold to share no filter.

    CODES codes would have filters enough for `shared` common ones if directions were
    independent. They are not, the less the more blocks a code has: what one code finds
    is measured on simulated pairs. Codes have their own rotations, so that what several
    miss is what one misses, multiplied.
    """
    dims = max(dims, LEAST_DIMS)
    levels, one, two = _shares(dims, cosine)
    at = int(np.argmin(np.abs(np.log(np.maximum(one, 1e-300) / min(0.05, FILLED / max(n, 1))))))
    filters = shared / max(two[at], 1e-15)
    blocks = 2
    while (words := math.ceil((filters / CODES) ** (1 / blocks))) > MOST_WORDS:
        blocks += 1
    tried = Code(dims, float(levels[at]), blocks, max(2, words), seed, _TRIED_CODES)
    hit = found_by_each(tried, cosine).mean()
    hit = min(max(hit, 1e-4), 1 - 1e-9)
    return replace(tried, codes=max(1, math.ceil(math.log(missed) / math.log1p(-hit))))


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision. Scaled first, so that no square over- or underflows."""
    wide = vectors.astype(np.float64)
    wide = wide / np.abs(wide).max(axis=1, keepdims=True)
    return wide / np.linalg.norm(wide, axis=1, keepdims=True)


class _Lists:
    """The rows of a column of lists without nulls."""

    def __init__(self, column: pa.Array):
        self.sizes = column.value_lengths().to_numpy(zero_copy_only=False)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = column.flatten().to_numpy(zero_copy_only=False)

    def rows(self, at: np.ndarray) -> np.ndarray:
        """Rows of equal length as a matrix."""
        return self.flat[self.starts[at][:, None] + np.arange(self.sizes[at[0]])]


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: not null, not zero, all components finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def _memberships(nodes: DataFrame, codes: dict[int, Code]) -> DataFrame:
    """(node, filters: sorted array<bigint>)."""
    numbers = {dims: k for k, dims in enumerate(sorted(codes))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = {}
        for batch in batches:
            ids, lists = batch.column(0).to_numpy(), _Lists(batch.column(1))
            for dims in np.unique(lists.sizes).tolist():
                code = codes[dims]
                if dims not in parts:
                    parts = {dims: code.parts()}
                own = np.flatnonzero(lists.sizes == dims)
                for i in range(0, len(own), 1024):
                    some = own[i : i + 1024]
                    unit = _unit(lists.rows(some))
                    unit = np.pad(unit, ((0, 0), (0, code.dims - dims))).astype(np.float32)
                    row, name = code.decode(unit, parts[dims])
                    name = name * len(numbers) + numbers[dims]
                    order = np.lexsort((name, row))
                    cuts = np.searchsorted(row[order], np.arange(len(some) + 1))
                    filters = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(name[order], pa.int64()))
                    yield pa.RecordBatch.from_arrays([pa.array(ids[some]), filters], ["node", "filters"])

    return nodes.select("node", "embedding").mapInArrow(run, "node bigint, filters array<bigint>")


class _Piece:
    """Some filters with all of their members, and the links between these."""

    def __init__(self, piece: pa.Table, bounds: np.ndarray, cosine: float):
        self.bounds, self.cosine = bounds, cosine
        self.node = piece.column("node").to_numpy()
        self.weight = piece.column("weight").to_numpy()
        self.filter = piece.column("filter").to_numpy()
        self.part = piece.column("part").to_numpy()
        self.mixed = piece.column("x").to_numpy() != piece.column("y").to_numpy()
        self.vectors = _Lists(piece.column("embedding").combine_chunks())
        self.earlier = self._earlier(_Lists(piece.column("filters").combine_chunks()))
        self.left: list[np.ndarray] = []
        self.right: list[np.ndarray] = []

    def _earlier(self, lists: _Lists) -> np.ndarray:
        """A row of bits per member: which of the filters before its own it is in. Bits are
        numbered within a group of members, over the filters that two or more of them share."""
        row = np.repeat(np.arange(len(self.node)), lists.sizes)
        before = lists.flat < self.filter[row]
        row, name = row[before], lists.flat[before]
        group = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))[row]
        order = np.lexsort((name, group))
        row, name, group = row[order], name[order], group[order]
        new = np.ones(len(row), bool)
        new[1:] = (name[1:] != name[:-1]) | (group[1:] != group[:-1])
        number = np.cumsum(new) - 1
        often = np.bincount(number, minlength=1) > 1
        shared = often[number]
        # Place of a shared filter among those of its group.
        rank = (np.cumsum(often) - often)[number[shared]]
        row, group = row[shared], group[shared]
        first = np.full(len(self.bounds), len(often), np.int64)
        np.minimum.at(first, group, rank)
        bit = rank - first[group]
        words = np.zeros((len(self.node), int(bit.max(initial=0)) // 64 + 1), np.uint64)
        np.bitwise_or.at(words, (row, bit // 64), np.uint64(1) << (bit % 64).astype(np.uint64))
        return words

    def keep(self, a: np.ndarray, b: np.ndarray) -> None:
        """Pairs that are near; of two blocks, only those across."""
        across = ~self.mixed[a] | (self.part[a] != self.part[b])
        self.left.append(a[across])
        self.right.append(b[across])

    def small(self, size: int, starts: np.ndarray) -> None:
        """Filters of `size` members. All members of a filter have the same dimensions."""
        i, j = np.triu_indices(size, 1)
        step = max(1, _PAIRS // len(i))
        for dims in np.unique(self.vectors.sizes[starts]):
            alike = starts[self.vectors.sizes[starts] == dims]
            for k in range(0, len(alike), step):
                own = alike[k : k + step]
                rows = (own[:, None] + np.arange(size)).ravel()
                unit = _unit(self.vectors.rows(rows)).reshape(len(own), size, -1)
                near = np.einsum("nid,njd->nij", unit, unit)[:, i, j] >= self.cosine
                n, p = np.nonzero(near)
                self.keep(own[n] + i[p], own[n] + j[p])

    def large(self, start: int, end: int) -> None:
        unit = _unit(self.vectors.rows(np.arange(start, end)))
        for a in range(0, len(unit), 512):
            near = unit[a : a + 512] @ unit[a:].T >= self.cosine
            i, j = np.nonzero(np.triu(near, 1))
            self.keep(start + a + i, start + a + j)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.diff(self.bounds)
        for size in range(2, _SMALL + 1):
            starts = self.bounds[:-1][sizes == size]
            if len(starts):
                self.small(size, starts)
        for i in np.flatnonzero(sizes > _SMALL):
            self.large(self.bounds[i], self.bounds[i + 1])
        none = [np.zeros(0, np.int64)]
        return np.concatenate(self.left or none), np.concatenate(self.right or none)

    def first_shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the filter that a pair was found in is the first of those it shares."""
        out = np.ones(len(a), bool)
        for k in range(0, len(a), _PAIRS):
            out[k : k + _PAIRS] = ~(self.earlier[a[k : k + _PAIRS]] & self.earlier[b[k : k + _PAIRS]]).any(axis=1)
        return out


def _spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(root, node) links that join what the pairs join, fewer than nodes."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        after = root.copy()
        np.minimum.at(after, root[a], low)
        np.minimum.at(after, root[b], low)
        after = after[after]
        if (after == root).all():
            return nodes[root[root != np.arange(len(nodes))]], nodes[root != np.arange(len(nodes))]
        root = after


def _links(members: DataFrame, cosine: float) -> DataFrame:
    """(u, v, links): links of a spanning forest (links null), and per vector how many others
    it is linked to (v null), each pair counted in the first filter it shares."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, bounds in sorted_groups(batches, ["filter", "x", "y"], rows=1 << 15):
            found = _Piece(piece, bounds, cosine)
            a, b = found.links()
            if not len(a):
                continue
            u, v = _spanning(found.node[a], found.node[b])
            own = found.first_shared(a, b)
            a, b = a[own], b[own]
            nodes, at = np.unique(np.concatenate([found.node[a], found.node[b]]), return_inverse=True)
            others = np.concatenate([found.weight[b], found.weight[a]])
            links = np.zeros(len(nodes), np.int64)
            np.add.at(links, at, others)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([u, nodes])),
                    pa.array(v.tolist() + [None] * len(nodes), pa.int64()),
                    pa.array([None] * len(u) + links.tolist(), pa.int64()),
                ],
                ["u", "v", "links"],
            )

    keys = ["filter", "x", "y"]
    return members.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "u bigint, v bigint, links bigint")


def near_duplicates(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    cosine: float = MIN_COSINE,
    shared: float = SHARED,
    block: int = BLOCK,
    seed: int = 11,
    missed: float = MISSED,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Vectors of equal components are one node with a count, so that copies are not compared.
    Each node goes to all filter directions near it; within a filter all is verified by the
    cosine in double precision, and nothing below `cosine` is linked. A link is counted in
    the first filter that both ends share. As many codes are used as it takes for `missed` of
    the pairs right at the threshold to share no filter, which is measured on simulated pairs
    for the number and length of the vectors; nearer pairs share more. A filter with more than `block` vectors is compared in pairs of blocks.

    Vectors that are null or zero, or hold null or non-finite components, link with nothing,
    nor do vectors of different length. Rows of equal vec_id are vectors of their own; a
    null vec_id is never the smallest. No rows give no rows.
    """
    kind = vectors.schema[embedding].dataType.simpleString()
    wanted = F.col(embedding) if kind == "array<float>" else F.col(embedding).cast("array<double>")
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), wanted.alias("embedding"))
    rows = rows.withColumn("ok", F.coalesce(usable(F.col("embedding")), F.lit(False)))
    rows = rows.withColumns({"h1": F.xxhash64("embedding"), "h2": F.xxhash64(F.lit(1), F.reverse("embedding"))})
    grouped = rows.where("ok").groupBy("h1", "h2").agg(
        F.count("*").alias("weight"), F.min("vec_id").alias("low"), F.first("embedding").alias("embedding")
    )
    nodes = store(grouped.withColumn("node", F.monotonically_increasing_id()), "nodes")
    sizes = nodes.groupBy(F.size("embedding").alias("dims")).count().collect()
    codes = {r["dims"]: choose_code(r["count"], r["dims"], cosine, shared, missed, seed) for r in sizes}
    members = store(_memberships(nodes, codes), "members")
    counts = members.select(F.explode("filters").alias("filter")).groupBy("filter").agg(F.count("*").alias("n"))
    live = store(counts.where("n > 1").select("filter", F.ceil(F.col("n") / block).cast("int").alias("parts")), "live")
    shared_ones = members.select("node", F.explode("filters").alias("filter")).join(live, "filter")
    lists = shared_ones.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("filter", "parts"))).alias("own"))
    sent = nodes.select("node", "weight", "embedding").join(lists, "node").select(
        "node", "weight", "embedding", F.col("own.filter").alias("filters"), F.explode("own").alias("one")
    )
    part = F.pmod(F.xxhash64("node"), F.col("one.parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("one.parts") - 1))
    placed = sent.withColumn("part", part).withColumn("other", other).select(
        F.col("one.filter").alias("filter"), F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y"),
        "part", "node", "weight", "embedding", "filters",
    )
    found = store(_links(placed, cosine), "links")
    linked = found.where("v IS NULL").groupBy(F.col("u").alias("n1")).agg(F.sum("links").alias("links"))
    roots = components(found.where("v IS NOT NULL").select("u", "v"))
    rooted = (
        nodes.select("node", "h1", "h2", "weight", "low")
        .join(linked, F.col("node") == F.col("n1"), "left")
        .join(roots.select(F.col("node").alias("n2"), "root"), F.col("node") == F.col("n2"), "left")
        .select("node", "h1", "h2", "low", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "node").alias("root"))
    )
    rooted = store(rooted, "rooted")
    lows = store(rooted.groupBy(F.col("root").alias("r")).agg(F.min("low").alias("component_id")), "lows")
    labels = store(
        rooted.join(lows, F.col("root") == F.col("r")).select(F.col("h1").alias("l1"), F.col("h2").alias("l2"), "n_links", "component_id"),
        "labels",
    )
    same = F.col("ok") & (F.col("h1") == F.col("l1")) & (F.col("h2") == F.col("l2"))
    joined = rows.select("vec_id", "ok", "h1", "h2").join(labels, same, "left")
    component = F.when(F.col("ok"), F.col("component_id")).otherwise(F.col("vec_id"))
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
