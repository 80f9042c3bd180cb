"""Surrogate keys 1..n without ever sorting a whole table in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.runtime import durable

# A block holds at most 2**18 distinct ids, a group at most 2**23 blocks, and
# the 64-bit range at most 2**23 groups. A block is the work of one task: small
# ones share out evenly.
_BLOCK_BITS = 18
_GROUP_BITS = 23

#: Rows of one block that a task may sort; blocks beyond are folded and sliced.
SORTED_ROWS = 1 << 22
#: Numbers that one row of copies is spelled out to at once.
_SPELLED = 1 << 16

_ROW_BITS = 33  # monotonically_increasing_id: partition above, row below


def dense_key(df: DataFrame, id_col: str, key_col: str) -> DataFrame:
    """Number the rows 1..n in order of a *unique* whole-number id.

    ``row_number() over (order by id)`` would pull the table into one task.
    Here ids are cut into blocks of 2**18 consecutive values. As ids are
    unique, no block exceeds 2**18 rows however they are distributed, so each
    window below has a proven bound, and the result depends on the ids alone:
    nothing is sampled, and a lost executor recomputes the same keys.
    """
    block, group, rows, base = "_block", "_group", "_rows", "_base"
    rows_in = df.withColumn(block, F.shiftright(F.col(id_col), _BLOCK_BITS))

    # Both steps below start from the same count per block. Stating what their
    # joins imply (no NULL block or group) keeps the two plans equal, so that
    # Spark shuffles for it once.
    blocks = (
        rows_in.where(F.col(block).isNotNull())
        .groupBy(block)
        .agg(F.count(F.lit(1)).alias(rows))
        .withColumn(group, F.shiftright(F.col(block), _GROUP_BITS))
        .where(F.col(group).isNotNull())
    )
    groups = (
        blocks.groupBy(group)
        .agg(F.sum(rows).alias(rows))
        .select(group, _sum_before(rows, Window.orderBy(group)).alias(base))
    )
    offsets = blocks.join(groups, group).select(
        block,
        (F.col(base) + _sum_before(rows, Window.partitionBy(group).orderBy(block))).alias(base),
    )

    in_block = F.row_number().over(Window.partitionBy(block).orderBy(id_col))
    return (
        rows_in.withColumn(key_col, in_block.cast("long"))
        .join(offsets, block)
        .withColumn(key_col, F.col(key_col) + F.col(base))
        .select(F.col(key_col), *df.columns)
    )


def ordered_key(
    df: DataFrame,
    id_col: str,
    key_col: str,
    per_id_col: str | None = None,
    counted: DataFrame | None = None,
    sorted_rows: int = SORTED_ROWS,
) -> DataFrame:
    """Number the rows 1..n in order of a number that may repeat, written nowhere on the way.

    A histogram comes first: how many rows each block of 2**18 consecutive ids
    has. ``counted``, if it has the same ids, is counted instead of ``df``, so a
    narrow scan does where ``df`` is much work. The rows then move once, by block,
    and are numbered inside their blocks from the histogram's offsets. Rows of one
    id follow each other in order of their other columns, equal rows in any order.
    ``per_id_col`` gets the number of rows that share the id; it costs no further
    shuffle. Ids must not be NULL.

    Ids that repeat can make a block of any size. If one exceeds ``sorted_rows``,
    equal rows are folded to one with a count first, and all blocks are cut into
    slices by a hash of the row, so rows of one id come in order of their slices;
    the copies are spelled out in pieces at the end. The keys depend on the rows
    alone in either case.
    """
    block = F.shiftright(F.floor(F.col(id_col)).cast("long"), _BLOCK_BITS)
    ids = (df if counted is None else counted).where(F.col(id_col).isNotNull())
    histogram = durable(ids.groupBy(block.alias("_block")).agg(F.count(F.lit(1)).alias("_rows")), "histogram")
    largest = histogram.agg(F.max("_rows")).first()[0] or 0
    rest = [c for c in df.columns if c != id_col]
    if largest > sorted_rows:
        return _sliced_key(df, id_col, key_col, per_id_col, block, -(-largest // (1 << _BLOCK_BITS)))
    inside = Window.partitionBy("_block").orderBy(id_col, *rest)
    numbered = df.withColumn("_block", block).withColumn("_place", F.row_number().over(inside).cast("long"))
    if per_id_col:
        same = Window.partitionBy("_block", id_col)
        numbered = numbered.withColumn(per_id_col, F.count(F.lit(1)).over(same))
    extra = [per_id_col] if per_id_col else []
    return numbered.join(_offsets(histogram, "_block"), "_block").select(
        (F.col("_base") + F.col("_place")).alias(key_col), *df.columns, *extra
    )


def _sliced_key(df: DataFrame, id_col: str, key_col: str, per_id_col: str | None, block: Column, slices: int) -> DataFrame:
    folded = (
        df.groupBy(*df.columns)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .withColumn("_block", block)
        .withColumn("_slice", F.pmod(F.xxhash64(*df.columns), F.lit(slices).cast("long")))
    )
    cells = durable(folded.groupBy("_block", "_slice").agg(F.sum("_copies").alias("_rows")), "histogram")
    rest = [c for c in df.columns if c != id_col]
    inside = Window.partitionBy("_block", "_slice").orderBy(id_col, *rest)
    numbered = folded.withColumn("_place", _sum_before("_copies", inside)).join(
        _offsets(cells, "_block", "_slice"), ["_block", "_slice"]
    )
    extra = []
    if per_id_col:
        repeated = (
            folded.groupBy(F.col(id_col).alias("_id"))
            .agg(F.sum("_copies").alias("_same"))
            .where(F.col("_same") > 1)
        )
        numbered = numbered.join(repeated, F.col(id_col) == F.col("_id"), "left").withColumn(
            per_id_col, F.coalesce("_same", F.lit(1).cast("long"))
        )
        extra = [per_id_col]
    first = F.col("_base") + F.col("_place")
    pieces = numbered.select(
        *df.columns,
        *extra,
        first.alias("_first"),
        "_copies",
        F.explode(F.expr(f"sequence(0, (_copies - 1) div {_SPELLED})")).alias("_piece"),
    ).repartition("_first", "_piece")
    last = f"least(_copies, (_piece + 1) * {_SPELLED}) - 1"
    return pieces.withColumn("_copy", F.explode(F.expr(f"sequence(_piece * {_SPELLED}, {last})"))).select(
        (F.col("_first") + F.col("_copy") + 1).alias(key_col), *df.columns, *extra
    )


def _offsets(cells: DataFrame, *order: str) -> DataFrame:
    """(order, _base): rows in the cells before each one; ``order`` begins with a block."""
    grouped = cells.withColumn("_group", F.shiftright(order[0], _GROUP_BITS))
    groups = (
        grouped.groupBy("_group")
        .agg(F.sum("_rows").alias("_rows"))
        .select("_group", _sum_before("_rows", Window.orderBy("_group")).alias("_before"))
    )
    inside = Window.partitionBy("_group").orderBy(*order)
    return grouped.join(groups, "_group").select(
        *order, (F.col("_before") + _sum_before("_rows", inside)).alias("_base")
    )


def dense_index(df: DataFrame, order_by: list[str | Column], index_col: str) -> DataFrame:
    """Number the rows 1..n in any order, given as columns that end unique.

    One range shuffle sorts the rows; being unique, the order splits anywhere,
    so equal leading values cannot pile up in one task. The numbered rows are
    written once (see :func:`durable`) and the row count of each written
    partition, one small row per task, gives the offsets.
    """
    return _number(df.orderBy(*order_by), df.columns, index_col)


def load_order_index(df: DataFrame, index_col: str) -> DataFrame:
    """Number the rows 1..n in the order they are produced, without a shuffle."""
    return _number(df, df.columns, index_col)


def _number(df: DataFrame, columns: list[str], index_col: str) -> DataFrame:
    part, row, base = "_part", "_row", "_base"
    position = F.monotonically_increasing_id()
    written = durable(
        df.withColumn("_position", position).select(
            *columns,
            F.shiftright("_position", _ROW_BITS).alias(part),
            F.col("_position").bitwiseAND((1 << _ROW_BITS) - 1).alias(row),
        ),
        "numbered",
    )
    # One row per written partition: the window and the broadcast are bounded by
    # the number of tasks that wrote, and the numbered rows are not shuffled.
    offsets = (
        written.groupBy(part)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(part, _sum_before("_rows", Window.orderBy(part)).alias(base))
    )
    return written.join(F.broadcast(offsets), part).select(
        (F.col(base) + F.col(row) + 1).alias(index_col), *columns
    )


def _sum_before(rows: str, window) -> Column:
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(rows).over(before), F.lit(0))
