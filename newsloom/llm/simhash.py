"""SimHash near-duplicates by deletion-variant signatures."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.common import (
    added_columns,
    one_per_key,
    row_keys,
    sorted_groups,
    store,
    texts_of,
    unused_names,
)
from newsloom.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 3
# Fingerprints that are compared with each other in one go; larger groups go in blocks.
BLOCK = 8192
_HASHES = 1 << 15


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a text, as a signed number.

    A-Z in small letters, words cut at ASCII white space, shingles with repeats (the whole
    sequence where it is shorter), XXH64 with seed 42. A bit is 1 if more than half of the
    hashes have it. Without words all bits are 0.
    """
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles = [words]
    else:
        shingles = zip(*[words[i:] for i in range(shingle_words)])
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(b" ".join(s), 42) for s in shingles), "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _HASHES):
        bits = np.unpackbits(hashes[at : at + _HASHES].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    packed = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(packed.view("<i8")[0])


def add_fingerprint(
    documents: DataFrame, name: str, text: str = "text", shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """All rows and columns, with the fingerprint of `text` in the bigint column `name`."""
    at = documents.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = pa.array([fingerprint(b, shingle_words) for b in texts_of(batch.column(at))], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, prints], [*batch.schema.names, name])

    return documents.mapInArrow(run, added_columns(documents, f"`{name}` bigint"))


def _bits_apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    # As unsigned numbers, since bits of a negative one are counted in its absolute value.
    return np.bitwise_count((a ^ b).view(np.uint64))


def chains(prints: np.ndarray, max_bits: int, groups: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links (smaller, larger) that join whatever is connected by pairs within `max_bits`.

    Each search starts at one fingerprint and takes up what is near, then what is near to
    that. It compares only with what no search has reached, so a dense group costs little,
    and there are fewer links than fingerprints. With `groups`, searches start from all
    fingerprints of a group at once, since these are known to be connected.
    """
    if groups is None:
        prints = np.sort(prints)
    left = np.arange(len(prints))
    starts, ends = [], []
    while len(left) > 1:
        root = left[0]
        if groups is None:
            todo, left = [root], left[1:]
        else:
            own = groups[left] == groups[root]
            todo, left = list(left[own]), left[~own]
        while todo and len(left):
            near = _bits_apart(prints[left], prints[todo.pop()]) <= max_bits
            if not near.any():
                continue
            found = left[near]
            if groups is not None:
                found = left[whole := np.isin(groups[left], groups[found])]
                left = left[~whole]
            else:
                left = left[~near]
            starts.extend([root] * len(found))
            ends.extend(found)
            todo.extend(found)
    return prints[np.array(starts, int)], prints[np.array(ends, int)]


def _variants(max_bits: int) -> tuple[int, int, int]:
    """(segments, bits of a segment, places with a wildcard in all).

    Of s segments, one differs by at most max_bits // s bits; the fewest segments for which
    that is at most one bit are taken.
    """
    segments = (max_bits + 2) // 2
    width = -(-64 // segments)
    return segments, width, 64


def _add_keys(prints: DataFrame, max_bits: int) -> DataFrame:
    """A row (place, rest, fp) for each place of a wildcard: rest is the segment of the place
    with that bit cleared. Fingerprints that differ in at most `max_bits` bits share a key."""
    _, width, places = _variants(max_bits)
    segment = f"shiftrightunsigned(fp, cast(p div {width} as int) * {width})"
    mask = f"(shiftleft(1L, least({width}, 64 - cast(p div {width} as int) * {width})) - 1L)"
    rest = f"{segment} & {mask} & ~shiftleft(1L, p % {width})"
    if width == 64:
        rest = "fp & ~shiftleft(1L, p)"
    return prints.select("fp", F.explode(F.expr(f"transform(sequence(0, {places - 1}), p -> struct(p as place, {rest} as rest))")).alias("k")).select("k.*", "fp")


def _hot_keys(prints: DataFrame, max_bits: int, block: int) -> DataFrame:
    """(place, rest, blocks) of each key that may have more than `block` fingerprints.

    A key's fingerprints have one of two values in its segment, so it is enough to count
    values: one row per segment instead of one per place. There are few of them: a value
    counts from half a block on.
    """
    segments, width, _ = _variants(max_bits)
    values = prints.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(s).alias("s"),
                        F.expr(
                            "fp" if width == 64 else f"shiftrightunsigned(fp, {s * width}) & (shiftleft(1L, {min(width, 64 - s * width)}) - 1L)"
                        ).alias("v"),
                    )
                    for s in range(segments)
                ]
            )
        ).alias("x")
    ).select("x.*")
    hot = values.groupBy("s", "v").agg(F.count("*").alias("n")).where(F.col("n") * 2 > block)
    spread = hot.select(
        F.explode(F.expr(f"sequence(s * {width}, least((s + 1) * {width}, 64) - 1)")).alias("place"), "v", "n"
    ).select("place", F.expr(f"v & ~shiftleft(1L, place % {width})").alias("rest"), "n")
    # The other value of a key may have missed the count by a little.
    return spread.groupBy("place", "rest").agg(
        F.ceil((F.sum("n") + block / 2) / block).cast("int").alias("blocks")
    )


def _links_in_groups(keyed: DataFrame, keys: list[str], max_bits: int, grouped: bool = False) -> DataFrame:
    """(u, v) links within the groups of `keys`, each group's rows in one task and in turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, bounds in sorted_groups(batches, keys):
            prints = piece.column("fp").to_numpy()
            roots = piece.column("root").to_numpy() if grouped else None
            sizes = np.diff(bounds)
            pairs = bounds[:-1][sizes == 2]
            us, vs = [], []
            if roots is None and len(pairs):
                a, b = prints[pairs], prints[pairs + 1]
                near = _bits_apart(a, b) <= max_bits
                us.append(a[near])
                vs.append(b[near])
            for i in np.flatnonzero(sizes > (1 if grouped else 2)):
                at = slice(bounds[i], bounds[i + 1])
                u, v = chains(prints[at], max_bits, None if roots is None else roots[at])
                us.append(u)
                vs.append(v)
            if us:
                yield pa.RecordBatch.from_pydict({"u": np.concatenate(us), "v": np.concatenate(vs)})

    placed = keyed.repartition(*keys).sortWithinPartitions(*keys)
    return placed.mapInArrow(run, "u bigint, v bigint")


def link_fingerprints(prints: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """(node, root) of the fingerprints (fp bigint, distinct) that have any link; root is the
    smallest of those reachable over links of at most `max_bits` bits.

    Keys with one wildcard bring together what is near; within a key all is verified. A key
    with more than `block` fingerprints is dealt to blocks by hash; after a first round
    joins what each block holds, only those blocks of a key are paired that are not yet one
    component. Nothing is capped.
    """
    hot = store(_hot_keys(prints, max_bits, block), "hot")
    keyed = _add_keys(prints, max_bits)
    if hot.isEmpty():
        return components(_links_in_groups(keyed, ["place", "rest"], max_bits))
    keyed = keyed.join(hot, ["place", "rest"], "left")
    part = F.coalesce(F.pmod(F.xxhash64("fp"), F.col("blocks")), F.lit(0)).cast("int")
    keyed = keyed.withColumn("part", part)
    first = store(
        _links_in_groups(keyed.select("place", "rest", "part", "fp"), ["place", "rest", "part"], max_bits), "links"
    )
    roots = store(components(first), "roots")
    split = keyed.where("blocks > 1").join(roots, F.col("fp") == F.col("node"), "left")
    split = split.select("place", "rest", "blocks", "part", "fp", F.coalesce("root", "fp").alias("root"))
    open_keys = split.groupBy("place", "rest").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
    split = split.join(store(open_keys.select("place", "rest"), "open"), ["place", "rest"])
    other = F.explode(F.expr("filter(sequence(0, blocks - 1), b -> b <> part)"))
    paired = split.select("place", "rest", "part", "fp", "root", other.alias("other")).select(
        "place", "rest", F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y"), "fp", "root"
    )
    second = _links_in_groups(paired, ["place", "rest", "x", "y"], max_bits, grouped=True)
    return components(first.unionAll(second))


def near_duplicates(
    documents: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    block: int = BLOCK,
) -> DataFrame:
    """(doc_id, fp, component_id) of every row; component_id is the smallest doc_id reachable.

    Rows of equal fingerprint are one node, counted map-side. A null text is an empty one,
    and empty texts have fingerprint 0 and are linked like any other. Repeated rows are
    returned as often as they come. A null doc_id takes part and is never the smallest;
    a component of nothing else has component_id null. No rows give no rows.
    """
    slim = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    found = add_fingerprint(slim, "fp", "text", shingle_words).select("doc_id", "fp")
    rows = store(found, "prints")
    nodes = store(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "nodes")
    linked = store(link_fingerprints(nodes.select("fp"), max_bits, block), "linked")
    rooted = nodes.join(linked, F.col("fp") == F.col("node"), "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    lows = store(rooted.groupBy(F.col("root").alias("r")).agg(F.min("low").alias("component_id")), "lows")
    labels = store(rooted.join(lows, F.col("root") == F.col("r")).select(F.col("fp").alias("label"), "component_id"), "labels")
    return rows.join(labels, F.col("fp") == F.col("label"), "left").select("doc_id", "fp", "component_id")


def drop_near_duplicates(
    documents: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    block: int = BLOCK,
) -> DataFrame:
    """One row of each component of `near_duplicates`, with all columns of `documents`.

    That with the smallest doc_id stays; null comes last. Rows that agree in doc_id and text
    are one, and any of them stays. The choice is made on narrow rows; texts are exchanged
    once, by the key that they are then joined on. What stays grows with the input, so that
    it is never broadcast.
    """
    k1, k2 = keys = unused_names(documents, "k1", "k2")
    keyed = documents.withColumns(dict(zip(keys, row_keys(F.col(doc_id), F.col(text)), strict=True)))
    slim = keyed.select(
        F.col(k1).alias("k1"), F.col(k2).alias("k2"), F.col(doc_id).cast("bigint").alias("id"),
        F.col(text).cast("string").alias("text"),
    )
    rows = store(add_fingerprint(slim, "fp", "text", shingle_words).drop("text"), "prints")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "k1", "k2")).alias("first")
    nodes = store(rows.groupBy("fp").agg(first), "nodes")
    linked = store(link_fingerprints(nodes.select("fp"), max_bits, block), "linked")
    kept = (
        nodes.join(linked, F.col("fp") == F.col("node"), "left")
        .groupBy(F.coalesce("root", "fp"))
        .agg(F.min("first").alias("first"))
        .select(F.col("first.k1").alias(k1), F.col("first.k2").alias(k2))
    )
    kept = store(kept, "kept")
    return one_per_key(keyed, keys).join(kept.hint("merge"), keys, "left_semi").select(*documents.columns)
