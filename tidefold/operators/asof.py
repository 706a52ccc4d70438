"""As-of join: the latest earlier row of the other side."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidefold.operators.skew import PIECE_ROWS, as_number, hot_ranges, piece_of, share_of, shares


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    values: Sequence[str],
    tie_break: Sequence[str] = (),
    piece_rows: int | None = PIECE_ROWS,
) -> DataFrame:
    """Add to each left row ``values`` of the latest right row with ``right_time <= left_time``.

    Both sides are put into one sorted run per key and the last right row is carried forward:
    linear in the rows, no pairs. A key with more than ``piece_rows`` rows is cut into pieces of equal
    numbers of rows along time; each piece starts from the last right row of the pieces before it. Where one time
    fills pieces by itself, its left rows are dealt to shares, which all start from the last right row up to that
    time. Among right rows of one time the largest ``tie_break`` counts. A NULL key matches nothing, so
    such rows pass by the sort.
    """
    keys = list(on)
    rest = [c for c in left.columns if c not in on]
    taken = F.struct(
        F.col(right_time).alias("_t"),
        *(F.col(c).alias(f"_tie{i}") for i, c in enumerate(tie_break)),
        *(F.col(c).alias(f"_v{i}") for i, c in enumerate(values)),
    )
    keyed = reduce(and_, (F.col(k).isNotNull() for k in keys))
    right_rows = right.filter(keyed & F.col(right_time).isNotNull()).select(
        *keys, F.col(right_time).alias("_at"), F.lit(0).alias("_side"), taken.alias("_right")
    )
    timed = keyed & F.col(left_time).isNotNull()
    left_rows = left.filter(timed).select(
        *keys, F.col(left_time).alias("_at"), F.lit(1).alias("_side"), F.struct(*rest).alias("_left")
    )
    run = left_rows.unionByName(right_rows, allowMissingColumns=True)

    if piece_rows is None:
        run = run.withColumns({"_piece": F.lit(0), "_share": F.lit(0)})
    else:
        axis = left.filter(timed).select(*keys, as_number(left, left_time).alias("_axis")).unionByName(
            right.filter(keyed).select(*keys, as_number(right, right_time).alias("_axis"))
        )
        # Fewer rows than all rows / piece_rows; most tables have none.
        hot = hot_ranges(axis, keys, "_axis", piece_rows)
        at = as_number(run, "_at")
        hashed = [c for c in rest if not any(t in left.schema[c].dataType.simpleString() for t in ("map<", "variant"))]
        row = F.struct(F.col("_side"), *(F.col("_left").getField(c) for c in hashed))
        run = run.join(hot, keys, "left").withColumns({"_piece": piece_of(at), "_share": F.coalesce(share_of(at, row), F.lit(0))})

    so_far = (
        Window.partitionBy(*keys, "_piece", "_share")
        .orderBy("_at", "_side", "_right")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # Right rows of a time that is dealt out are all in what its shares start from.
    found = run.filter((F.col("_side") == 1) | (F.col("_share") == 0))
    found = found.withColumn("_found", F.last("_right", ignorenulls=True).over(so_far))
    found = found.filter(F.col("_side") == 1)

    if piece_rows is not None:
        dealt = F.col("_share") > 0
        order = Window.partitionBy(*keys).orderBy("_piece", F.asc_nulls_first("_tied"))
        before = order.rowsBetween(Window.unboundedPreceding, -1)
        up_to = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        # One row per piece of a hot key, and one per time that is dealt out.
        carried = (
            run.filter(F.col("_cuts").isNotNull())
            .withColumns({"_tied": F.when(dealt, F.col("_at")), "_shares": shares(at)})
            .groupBy(*keys, "_piece", "_tied")
            .agg(F.max("_right").alias("_last"), F.max("_shares").alias("_shares"))
            .withColumn("_carry", F.when(F.col("_tied").isNull(), F.max("_last").over(before)).otherwise(F.max("_last").over(up_to)))
            .select(*keys, "_piece", "_tied", "_carry", F.explode("_shares").alias("_share"))
        ).alias("c")
        # The time is compared beside the keys, not as one of them: the rows stay where the window has put them.
        place = [F.col(f"f.{k}") == F.col(f"c.{k}") for k in (*keys, "_piece", "_share")]
        same = F.col("c._tied").isNull() | (F.col("c._tied") == F.col("f._at"))
        found = found.alias("f").join(carried, reduce(and_, place) & same, "left")
        found = found.select("f.*", F.col("c._carry")).withColumn("_found", F.greatest("_found", "_carry"))
    matched = found.select(
        *(c if c in on else F.col("_left").getField(c).alias(c) for c in left.columns),
        *(F.col("_found").getField(f"_v{i}").alias(c) for i, c in enumerate(values)),
    )
    alone = left.filter(~timed).select(
        *left.columns, *(F.lit(None).cast(right.schema[c].dataType).alias(c) for c in values)
    )
    return matched.unionAll(alone)
