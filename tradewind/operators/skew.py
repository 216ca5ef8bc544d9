"""Left joins of several branches on one key, safe when one key holds or makes much of the data.

Adaptive execution splits a hot key only on the preserved side of an outer join, and looks at input rows
only. So the rows of each key are counted in every input first (key columns alone, reduced in each
task); keys whose joined rows pass a limit are joined on a salted grid, the rest by the plain chain.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from tradewind.operators.copies import COPIES, pack_copies, unpack_copies
from tradewind.session import stored

HOT_ROWS = 1_000_000  # rows of one key that a single task should hold or make at most
KEYS_TO_BROADCAST = 100_000
PACK_ROWS = 500  # right rows of a cell that travel, and are joined, as one
PART_ROWS = 250_000  # input rows that a task sorts and joins, whatever number of shuffle partitions the session has


def hot_keys(tables: Mapping[str, DataFrame], key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``key, rows`` of the keys whose join makes at least ``hot_rows`` rows; ``rows`` has the rows in each table."""
    return _key_rows(tables, key).where(_made() >= hot_rows)


def _key_rows(tables, key):
    """``key, rows`` of all keys. NULL joins nothing and is no key."""
    names, tagged = list(tables), None
    for i, df in enumerate(tables.values()):
        part = df.where(F.col(key).isNotNull()).select(F.col(key), F.lit(i).alias("__table"))
        tagged = part if tagged is None else tagged.unionByName(part)
    counts = F.array(*[F.count_if(F.col("__table") == i) for i in range(len(names))])
    return tagged.groupBy(key).agg(counts.alias("rows"))


def _made():
    """Rows that the join makes of a key: a table without it counts as one row, as in a left join."""
    return F.aggregate("rows", F.lit(1.0), lambda product, n: product * F.greatest(n, F.lit(1)))


def _hot_and_rest(tables, key, hot_rows):
    """``key, rows`` of the hot keys of the first table, and with NULL as key of all other keys together."""
    hot = F.when((_made() >= hot_rows) & (F.col("rows")[0] > 0), F.col(key))
    sums = F.array(*[F.sum(F.col("rows")[i]) for i in range(len(tables))])
    return _key_rows(tables, key).groupBy(hot.alias(key)).agg(sums.alias("rows"))


def left_join_all(
    base: DataFrame,
    branches: Mapping[str, DataFrame],
    key: str,
    *,
    unique_rows: bool = False,
    hot_rows: int = HOT_ROWS,
    probe: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """``base`` left-joined with each of ``branches`` on ``key``.

    ``unique_rows`` drops equal rows of every input first; as the output keeps all columns of all
    inputs, this equals a distinct over the (much larger) output. ``probe`` names narrower frames with
    the same keys as the branches (and as ``base``), for a cheaper look at the key counts; they may hold more rows.
    """
    # A row without a key matches nothing; kept, all of them would travel to one task.
    branches = {name: branch.where(F.col(key).isNotNull()) for name, branch in branches.items()}
    # Only keys of the base are in the result.
    found = stored(_hot_and_rest({"base": base, **(probe or branches)}, key, hot_rows))
    hot = found.where(F.col(key).isNotNull())
    keys, rows = found.agg(F.count(key), F.sum(F.aggregate("rows", F.lit(0).cast("bigint"), lambda a, b: a + b))).first()
    parts = max(base.sparkSession.sparkContext.defaultParallelism, math.ceil((rows or 0) / PART_ROWS))
    if not keys:
        return _chain(base, branches, key, unique_rows, parts)
    if keys <= KEYS_TO_BROADCAST:  # beyond it, adaptive execution splits the side with a hot key
        hot = F.broadcast(hot)
    without, of = (lambda df, how=how: df.join(hot.select(key), key, how) for how in ("left_anti", "left_semi"))
    cold = _chain(without(base), {n: without(b) for n, b in branches.items()}, key, unique_rows, parts)
    salted = _salted_chain(of(base), {n: of(b) for n, b in branches.items()}, key, unique_rows, hot, hot_rows)
    return cold.unionByName(salted.select(*cold.columns))


def _chain(base, branches, key, unique_rows, parts):
    """All sides are hash-partitioned by ``key`` once; the joins after the first move no left rows."""

    def by_key(df):
        return df.repartition(parts, F.col(key)).distinct() if unique_rows else df

    joined = by_key(base)
    for branch in branches.values():
        joined = joined.join(by_key(branch), key, "left")
    return joined


def _salted_chain(base, branches, key, unique_rows, hot, hot_rows):
    """Joins of the hot keys' rows only. Equal rows travel as one row with a count."""

    def packed(df):
        counted = pack_copies(df)
        return counted.withColumn(COPIES, F.lit(1).cast("bigint")) if unique_rows else stored(counted)

    joined, branches = packed(base), {name: packed(branch) for name, branch in branches.items()}
    if not unique_rows:  # rows of the result have at most so many copies
        found = [df.agg(F.max(COPIES)).first()[0] or 1 for df in (joined, *branches.values())]
        most = math.prod(found)
    left_rows = F.col("rows")[0].cast("double")
    for i, branch in enumerate(branches.values(), start=1):
        right_rows = F.col("rows")[i].cast("double")
        left_parts, right_parts = grid(left_rows, right_rows, hot_rows)
        parts = hot.select(
            key, left_parts.alias("__n_left"), right_parts.alias("__n_right"), (right_rows > 0).alias("__matched"),
            right_rows.alias("__right_rows"),
        )
        joined = _grid_join(joined, branch, key, parts)
        left_rows = left_rows * F.greatest(right_rows, F.lit(1.0))
    return joined.drop(COPIES) if unique_rows else unpack_copies(joined, most=most)


def grid(left_rows, right_rows, hot_rows):
    """Parts of the left and of the right rows of a key, so that no cell of the grid makes more than ``hot_rows``.

    Both sides get parts of the square root of that; a side that is smaller stays whole, and the other one's
    parts follow from what they make with it. A side without rows makes what a single row makes.
    """
    side = float(math.isqrt(hot_rows))
    right = F.greatest(right_rows, F.lit(1.0))
    made = left_rows * right
    few_left, few_right = left_rows <= side, right <= side
    left_parts = F.when(few_right, F.ceil(made / hot_rows)).when(few_left, 1).otherwise(F.ceil(left_rows / side))
    right_parts = F.when(few_right, 1).when(few_left, F.ceil(made / hot_rows)).otherwise(F.ceil(right / side))
    return F.greatest(left_parts, F.lit(1)).cast("int"), F.greatest(right_parts, F.lit(1)).cast("int")


def _grid_join(left, right, key, parts):
    """Spread each key over a grid: left rows by one salt, right rows by the other.

    Rows are distinct here, so a hash of the row is an even salt and stays the same when a task is
    run again. A left row meets every right row of its key exactly once. Where the key has right
    rows, a grid cell without any yields an extra unmatched row, which is dropped. The right rows of a cell
    are joined some ``PACK_ROWS`` at a time, as an array: what is made for each row of the result is the row alone.
    """

    def own(df, n):
        return F.pmod(F.xxhash64(*df.columns), F.col(n)).cast("int")

    def every(n):
        return F.sequence(F.lit(0), F.col(n) - 1)

    columns = [c for c in right.columns if c not in (key, COPIES)]
    packed = F.struct(*columns, F.col(COPIES).alias("__right_copies"))
    in_cell = F.greatest(F.col("__right_rows"), F.lit(1.0)) / F.col("__n_right")
    spread_left = (
        left.join(parts, key)
        .withColumn("__a", own(left, "__n_left"))
        .withColumn("__b", F.explode(F.when(F.col("__matched"), every("__n_right")).otherwise(F.array(F.lit(0)))))
        .drop("__n_left", "__n_right", "__right_rows")
    )
    spread_right = (
        right.join(parts, key)
        .withColumn("__b", own(right, "__n_right"))
        .withColumn("__pack", F.pmod(F.xxhash64(*right.columns, F.lit(1)), F.ceil(in_cell / PACK_ROWS)))
        .groupBy(key, "__b", "__pack", "__n_left")
        .agg(F.collect_list(packed).alias("__rows"))
        .withColumn("__a", F.explode(every("__n_left")))
        .drop("__n_left", "__pack")
    )
    return (
        spread_left.join(spread_right, [key, "__a", "__b"], "left")
        .where(F.col("__rows").isNotNull() | ~F.col("__matched"))
        .select(*left.columns, F.inline_outer("__rows"))
        .withColumn(COPIES, F.col(COPIES) * F.coalesce(F.col("__right_copies"), F.lit(1)))
        .drop("__right_copies")
    )
