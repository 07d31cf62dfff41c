"""Fixed-size batches, and batches within a token budget."""

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.operators.positions import group_positions, positions_joined
from newsloom.session import store

# Rows per request file, and tokens per embedding call.
BATCH_ROWS = 200
TOKEN_BUDGET = 8000
# Rows that one task folds over.
BLOCK_ROWS = 100_000
# Blocks that one task chains.
CHAIN_BLOCKS = 1_000

PIECE = ["__from", "__to", "__slope", "__opens"]


def assign_batches(
    df: DataFrame, order_by: Sequence[str], keys: Sequence[str] = (), size: int = BATCH_ROWS
) -> DataFrame:
    """Add `pos` and `batch_no` = pos // size, over the whole table or per group.

    `order_by` (with `keys`) must identify a row.
    """
    placed = positions_joined(df, order_by, keys)
    return placed.withColumn("batch_no", F.floor(F.col("pos") / size).cast("bigint"))


def token_chunks(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    tokens: str = "token_count",
    budget: int = TOKEN_BUDGET,
    count_opener: bool = False,
    block_rows: int = BLOCK_ROWS,
    chain_blocks: int = CHAIN_BLOCKS,
) -> DataFrame:
    """Add `chunk_no`: rows of a group are taken in order, and a row that lifts the running
    token count over `budget` opens the next chunk. A null count is none. All columns go through
    the fold: hand in keys, order and counts, and join texts to the result.

    The count then starts at 0, without the row that opened the chunk; that is how the
    calls have always been cut. With `count_opener` it starts at that row's tokens, no
    chunk exceeds the budget unless a single row does, and chunk 0 is never empty.

    The fold is sequential, yet no task folds over a whole group. What a block of rows does
    to the running count is a function that falls into few pieces, since counts that pass
    the budget at the same row go on alike. Blocks find their pieces in parallel, stretches
    of blocks join theirs to one function in parallel, the few stretches of a group are
    chained, then the blocks of each stretch, and blocks number their rows in parallel.
    """
    keys, names = list(keys), df.columns
    # Sampled before it is sorted by range; the tokens should be counted once.
    placed = group_positions(store(df, "counted"), keys, order_by, pos="__pos").withColumn(
        "__block", F.floor(F.col("__pos") / block_rows).cast("bigint")
    )
    slim_keys = [f"__k{i}" for i in range(len(keys))]
    placed = placed.select(
        "*",
        *[F.col(k).alias(name) for k, name in zip(keys, slim_keys)],
        F.coalesce(F.col(tokens).cast("bigint"), F.lit(0)).alias("__tokens"),
    )
    # Read twice below; its positions should be computed once.
    placed = store(placed, "placed")
    slim = placed.select(*slim_keys, "__block", "__pos", "__tokens")
    key_ddl = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in slim.schema if f.name in slim_keys)

    def pieces(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__pos")
        fresh = count_opener and pdf["__block"].iloc[0] == 0
        table = block_pieces(pdf["__tokens"].to_numpy(), budget, count_opener, fresh)
        table["__block"] = pdf["__block"].iloc[0]
        return with_keys(table, pdf)

    def with_keys(table: pd.DataFrame, pdf: pd.DataFrame) -> pd.DataFrame:
        for k in slim_keys:
            table[k] = pdf[k].iloc[0]
        return table

    def join_up(pdf: pd.DataFrame) -> pd.DataFrame:
        table = join_pieces(pdf, "__block")
        table["__stretch"] = pdf["__stretch"].iloc[0]
        return with_keys(table, pdf)

    def chain_stretches(pdf: pd.DataFrame) -> pd.DataFrame:
        return with_keys(chain(pdf, "__stretch", 0, 0), pdf)

    def chain_within(pdf: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        running, opened = int(start["__running"].iloc[0]), int(start["__opened"].iloc[0])
        return with_keys(chain(pdf, "__block", running, opened), pdf)

    def number(pdf: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__pos")
        fresh = count_opener and pdf["__block"].iloc[0] == 0
        chunk = number_block(
            pdf["__tokens"].to_numpy(), budget, count_opener, int(start["__running"].iloc[0]), fresh
        )
        out = pdf[names].copy()
        out["chunk_no"] = chunk + int(start["__opened"].iloc[0])
        return out

    per_block = slim.groupBy(*slim_keys, "__block").applyInPandas(
        pieces, f"{key_ddl}__block bigint, __from bigint, __to bigint, __slope bigint, __opens bigint"
    )
    # One row per piece: a few dozen for each block of `block_rows` rows.
    per_block = store(
        per_block.withColumn("__stretch", F.floor(F.col("__block") / chain_blocks).cast("bigint")),
        "pieces",
    )
    stretch = [*slim_keys, "__stretch"]
    joined = per_block.groupBy(*stretch).applyInPandas(
        join_up, f"{key_ddl}__stretch bigint, __from bigint, __to bigint, __slope bigint, __opens bigint"
    )
    stretch_starts = joined.groupBy(*slim_keys).applyInPandas(
        chain_stretches, f"{key_ddl}__stretch bigint, __running bigint, __opened bigint"
    )
    starts = (
        per_block.groupBy(*stretch)
        .cogroup(stretch_starts.groupBy(*stretch))
        .applyInPandas(chain_within, f"{key_ddl}__block bigint, __running bigint, __opened bigint")
    )
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return (
        placed.groupBy(*slim_keys, "__block")
        .cogroup(starts.groupBy(*slim_keys, "__block"))
        .applyInPandas(number, f"{columns}, chunk_no bigint")
    )


def _next_openers(tokens: np.ndarray, budget: int, count_opener: bool) -> np.ndarray:
    """For each row that opens a chunk, the row that opens the one after (n if none)."""
    total = np.cumsum(tokens)
    # Tokens counted before the rows of the new chunk.
    base = total - tokens if count_opener else total
    return np.maximum(
        np.searchsorted(total, base + budget, side="right"), np.arange(1, len(tokens) + 1)
    )


def block_pieces(
    tokens: np.ndarray, budget: int, count_opener: bool, fresh: bool = False
) -> pd.DataFrame:
    """What a block does to the running count it starts with, by pieces.

    A start count of at least `__from` (and below the next piece's) opens `__opens` chunks
    and leaves the block at `__to`, plus the start count itself where `__slope` is 1.
    A `fresh` block begins its group: its first row sits in chunk 0 whatever its size.
    """
    n = len(tokens)
    total = np.cumsum(tokens)
    following = _next_openers(tokens, budget, count_opener)
    memo: dict[int, tuple[int, int]] = {}

    def run_from(opener: int) -> tuple[int, int]:
        path = []
        while opener < n and opener not in memo:
            path.append(opener)
            opener = int(following[opener])
        if opener < n:
            end, opens = memo[opener]
        else:
            last = path[-1]
            end, opens = int(total[-1] - total[last]), 0
            if count_opener:
                end += int(tokens[last])
        for row in reversed(path):
            opens += 1
            memo[row] = (end, opens)
        return memo[path[0]] if path else (end, opens)

    if fresh:
        end, opens = run_from(0)
        return pd.DataFrame([(0, end, 0, opens - 1)], columns=PIECE)

    # A start count s first passes the budget at the first row with s + total > budget.
    out = []
    quiet_to = budget - int(total[-1])
    if quiet_to >= 0:
        out.append((0, int(total[-1]), 1, 0))
    reached = 0 if quiet_to < 0 else quiet_to + 1
    last_row = int(np.searchsorted(total, budget, side="right"))
    for row in range(min(last_row, n - 1), -1, -1):
        low = max(budget - int(total[row]) + 1, 0)
        high = budget - (int(total[row - 1]) if row else -(1 << 60))
        if high < max(low, reached):
            continue
        end, opens = run_from(row)
        out.append((max(low, reached), end, 0, opens))
        reached = high + 1
    return pd.DataFrame(out, columns=PIECE)


def apply_piece(table: pd.DataFrame, running: int) -> tuple[int, int]:
    """(running count after, chunks opened) of the function `table`, sorted by `__from`."""
    at = int(np.searchsorted(table["__from"].to_numpy(), running, side="right")) - 1
    _, to, slope, opens = (int(v) for v in table[PIECE].iloc[at])
    return to + running * slope, opens


def join_pieces(pieces: pd.DataFrame, part: str) -> pd.DataFrame:
    """The pieces of all `part`s, one after the other, as one function."""
    whole = [(0, 0, 1, 0)]
    for _, table in pieces.sort_values([part, "__from"]).groupby(part, sort=True):
        froms = table["__from"].to_numpy()
        after = []
        for n, (low, to, slope, opens) in enumerate(whole):
            if not slope:
                end, more = apply_piece(table, to)
                after.append((low, end, 0, opens + more))
                continue
            # The start count passes on, shifted by `to`, and may meet several pieces.
            high = whole[n + 1][0] + to if n + 1 < len(whole) else None
            for i, (f, t, s, o) in enumerate(table[PIECE].to_numpy().tolist()):
                following = froms[i + 1] if i + 1 < len(froms) else None
                if (high is not None and f >= high) or (following is not None and following <= low + to):
                    continue
                after.append((max(low, f - to), t + (to if s else 0), s, opens + o))
        # Neighbours that have come to the same result are one piece.
        whole = [p for n, p in enumerate(after) if n == 0 or p[1:] != after[n - 1][1:]]
    return pd.DataFrame(whole, columns=PIECE)


def chain(pieces: pd.DataFrame, part: str, running: int, opened: int) -> pd.DataFrame:
    """Running count and chunks opened before each `part`, from those before the first."""
    out = []
    for number, table in pieces.sort_values([part, "__from"]).groupby(part, sort=True):
        out.append((number, running, opened))
        running, opens = apply_piece(table, running)
        opened += opens
    return pd.DataFrame(out, columns=[part, "__running", "__opened"])


def number_block(
    tokens: np.ndarray, budget: int, count_opener: bool, running: int, fresh: bool
) -> np.ndarray:
    """Chunks opened up to and with each row of a block."""
    n = len(tokens)
    opens = np.zeros(n, dtype=np.int64)
    following = _next_openers(tokens, budget, count_opener)
    if fresh:
        row = int(following[0])
    else:
        row = int(np.searchsorted(np.cumsum(tokens), budget - running, side="right"))
    while row < n:
        opens[row] = 1
        row = int(following[row])
    return np.cumsum(opens)
