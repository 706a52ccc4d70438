"""Change data capture: from message batches to latest-state tables.

A batch is reduced to one change row per key in one aggregation: the latest plain columns and,
per rule, its value and whether the batch touched it. A change row with an untouched rule
leaves that column of the state alone; a touched one sets it, also to NULL.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefold.operators.latest import latest_keep_ties, latest_per_key
from tidefold.spec import Cdc, Rule


def _order(cdc: Cdc) -> Column:
    return F.col(cdc.order) if isinstance(cdc.order, str) else cdc.order


def _decider(rule: Rule, trigger: str, *order: str) -> Column:
    """The latest (order, value) among the rows that a rule listens to, NULL without any."""
    value = F.col(rule.column)
    if rule.clear_on:
        cleared = F.lit(rule.clear_value)
        value = F.when(F.col(trigger).isin(*rule.clear_on), cleared).otherwise(value)
    listens = F.col(trigger).isin(*rule.set_on, *rule.clear_on)
    return F.max(F.when(listens, F.struct(*order, value.alias("_value"))))


def conditional_latest(
    batch: DataFrame, keys: Sequence[str], order: str, trigger: str, rule: Rule
) -> DataFrame:
    """One rule alone: per key its value and whether any row decided it."""
    decided = batch.filter(F.col(order).isNotNull()).groupBy(*keys).agg(
        _decider(rule, trigger, order).alias("_d")
    )
    return decided.select(
        *keys, F.col("_d._value").alias(rule.column), F.col("_d").isNotNull().alias(rule.flag)
    )


def _with_ruled(batch: DataFrame, cdc: Cdc) -> DataFrame:
    missing = [c for c in cdc.ruled if c not in batch.columns]
    return batch.withColumns({c: F.lit(None).cast("string") for c in missing}) if missing else batch


def transform(batch: DataFrame, cdc: Cdc, per: Sequence[str] = ()) -> DataFrame:
    """Reduce a batch to one change row per key, or per key and ``per`` for several batches."""
    batch = _with_ruled(batch, cdc)
    groups = [*cdc.key, *per]
    plain = [c for c in batch.columns if c not in (*groups, *cdc.ruled)]
    ordered = batch.withColumn("_order", _order(cdc)).filter(F.col("_order").isNotNull())
    reduced = ordered.groupBy(*groups).agg(
        F.max(F.struct("_order", *plain)).alias("_row"),
        *(_decider(r, cdc.trigger, "_order").alias(f"_{r.column}") for r in cdc.rules),
    )

    def output(name: str) -> Column:
        if name in groups:
            return F.col(name)
        if name in cdc.ruled:
            return F.col(f"_{name}").getField("_value").alias(name)
        return F.col("_row").getField(name).alias(name)

    flags = [F.col(f"_{r.column}").isNotNull().alias(r.flag) for r in cdc.rules]
    return reduced.select(*(output(c) for c in batch.columns), *flags)


def stamp_changes(changes: DataFrame, cdc: Cdc) -> DataFrame:
    """A change is as recent as its insert, and made by the user who inserted it."""
    return changes.withColumns(
        {cdc.updated: F.col(cdc.inserted), cdc.update_user: F.col(cdc.insert_user)}
    )


def high_water(state: DataFrame, column: str) -> Column:
    """The largest ``column`` of the state as a scalar sub-query; nothing is collected."""
    return state.select(F.max(column)).scalar()


def incremental_since(changes: DataFrame, state: DataFrame, cdc: Cdc) -> DataFrame:
    """Leave out changes older than the state's latest update; keep all if there is none."""
    mark = high_water(state, cdc.updated)
    return changes.filter(mark.isNull() | (F.col(cdc.inserted) >= mark))


def _merged(state: DataFrame, changes: DataFrame, cdc: Cdc, how: str) -> DataFrame:
    old = state.select(
        *cdc.key, F.struct(*(c for c in state.columns if c not in cdc.key)).alias("_old")
    )
    new = changes.select(
        *cdc.key, F.struct(*(c for c in changes.columns if c not in cdc.key)).alias("_new")
    )
    has_old, has_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    flag = {r.column: r.flag for r in cdc.rules}

    def merged(name: str) -> Column:
        if name in cdc.key:
            return F.col(name)
        before, after = F.col("_old").getField(name), F.col("_new").getField(name)
        if name == cdc.inserted:
            return F.when(has_old, before).otherwise(after).alias(name)
        changed = has_new
        if name in flag:
            changed = has_new & (~has_old | F.col("_new").getField(flag[name]))
        return F.when(changed, after).otherwise(before).alias(name)

    return old.join(new, list(cdc.key), how).select(*(merged(c) for c in state.columns))


def merge(state: DataFrame, changes: DataFrame, cdc: Cdc) -> DataFrame:
    """The whole new state: both sides have one row per key, so no key can be heavy."""
    return _merged(state, changes, cdc, "full_outer")


def changed_rows(state: DataFrame, changes: DataFrame, cdc: Cdc) -> DataFrame:
    """Only the merged rows whose key is in ``changes``: what a mirror has to replace."""
    return _merged(state, changes, cdc, "right_outer")


def fold(changes: DataFrame, cdc: Cdc, sequence: str) -> DataFrame:
    """Merge numbered change rows of every key in one aggregation.

    Equals merging them one after the other in the order of ``sequence``. A stored state takes
    part as change rows with all flags set and the lowest number.
    """
    flags = [r.flag for r in cdc.rules]
    plain = [c for c in changes.columns if c not in (*cdc.key, *cdc.ruled, *flags, sequence)]
    folded = changes.groupBy(*cdc.key).agg(
        F.max(F.struct(sequence, *plain)).alias("_row"),
        F.min(F.struct(sequence, cdc.inserted)).alias("_first"),
        *(
            F.max(F.when(F.col(r.flag), F.struct(sequence, r.column))).alias(f"_{r.column}")
            for r in cdc.rules
        ),
    )

    def output(name: str) -> Column:
        if name in cdc.key:
            return F.col(name)
        if name in cdc.ruled:
            return F.col(f"_{name}").getField(name).alias(name)
        return F.col("_first" if name == cdc.inserted else "_row").getField(name).alias(name)

    return folded.select(*(output(c) for c in changes.columns if c not in (*flags, sequence)))


def split_insert_update(
    changes: DataFrame, state: DataFrame, keys: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Changes of new keys, and changes of keys the state has."""
    known = state.select(*keys)
    return changes.join(known, list(keys), "left_anti"), changes.join(known, list(keys), "left_semi")


def upsert_latest(
    state: DataFrame, batch: DataFrame, keys: Sequence[str], order: str
) -> DataFrame:
    """Last write wins: the batch's latest row per key replaces the state's row."""
    new = latest_per_key(batch, keys, order).select(*state.columns)
    return replace_keys(state, new, keys)


def replace_keys(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All target rows of other keys plus ``rows``."""
    return delete_by_keys(target, rows, keys).unionByName(rows.select(*target.columns))


def replace_by_key(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order: str
) -> DataFrame:
    """Children of a key are replaced as a set by the batch's latest rows, ties included.

    Keys the batch does not mention keep their rows.
    """
    kept = delete_by_keys(target, batch.filter(F.col(order).isNotNull()), keys)
    return kept.unionByName(latest_children(batch, keys, order).select(*target.columns))


def latest_children(batch: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The batch's latest rows per key, ties included, copies once.

    Copies are dropped last, where only the latest rows are left to compare.
    """
    return latest_keep_ties(batch, keys, order).distinct()


def delete_by_keys(target: DataFrame, doomed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in ``doomed``.

    The key side is not made distinct: an aggregation between shuffle and join would keep AQE from
    splitting the rows of a hot key, or of NULL, and such a join needs no distinct keys.
    """
    return target.join(doomed.select(*keys), list(keys), "left_anti")


def append_new_only(
    batch: DataFrame, target: DataFrame, keys: Sequence[str], pruned_by: str | None = None
) -> DataFrame:
    """Batch rows whose key the target does not have yet, each once. NULLs equal each other.

    Given ``pruned_by``, one of the keys, only target rows between the batch's smallest and largest
    value are read: files and row groups of other ranges are skipped, and no equal key can be.
    """
    if pruned_by and pruned_by not in keys:
        raise ValueError("only a key may decide what is read: another column could hide a repeat")
    hashed = F.xxhash64(*keys).alias("_hash")
    delivered = batch.select(hashed, *batch.columns)
    seen = target
    if pruned_by:
        low, high = ends_of(batch, pruned_by)
        # Two scans, because each condition by itself skips files and row groups.
        ranged = target.filter((F.col(pruned_by) >= low) & (F.col(pruned_by) <= high))
        seen = ranged.unionByName(target.filter(F.col(pruned_by).isNull()))
    # One long per row decides what of the target can matter; the keys themselves decide below.
    near = seen.select(hashed, *keys).join(delivered.select("_hash"), "_hash", "left_semi")
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"n.{c}")) for c in ("_hash", *keys)]
    fresh = delivered.alias("d").join(near.alias("n"), reduce(and_, same), "left_anti")
    # Copies are dropped last, among the new rows only.
    return fresh.drop("_hash").dropDuplicates(list(keys))


def ends_of(df: DataFrame, column: str) -> tuple[Column, Column]:
    """The smallest and the largest value as scalar sub-queries that reach a scan's filters.

    They differ in form, because the optimizer joins two like ones into a struct, which no scan can use.
    """
    return df.select(F.min(column)).scalar(), df.select(column).orderBy(F.desc(column)).limit(1).scalar()
