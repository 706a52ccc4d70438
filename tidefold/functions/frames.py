"""Typing, projecting, checking and stamping whole frames."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefold.spec import RENAMED, TableSpec


def cast_present(df: DataFrame, columns: Iterable[str], to: str) -> DataFrame:
    """Cast the listed columns that the frame has; what cannot be cast becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast(to) for c in columns if c in df.columns})


def type_columns(
    df: DataFrame,
    timestamps: Iterable[str] = (),
    keys: Iterable[str] = ("pat_enc_csn_id", "hsp_acct_id"),
) -> DataFrame:
    return cast_present(cast_present(df, timestamps, "timestamp"), keys, "decimal(18,0)")


def require_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    return df.na.drop(subset=list(keys))


def rejected(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """The rows that ``require_keys`` leaves out, for a quarantine table."""
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    return df.filter(~present)


def drop_all_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    return df.na.drop("all", subset=list(columns or df.columns))


def prepare_append(df: DataFrame, user: str | Column | None = None) -> DataFrame:
    """Drop empty rows and the update columns and stamp the writing user."""
    kept = drop_all_null(df).drop("row_updt_tsp", "update_user_id", "updt_user_id")
    return kept.withColumn("insert_user_id", _user(user))


def _user(user: str | Column | None) -> Column:
    if user is None:
        return F.current_user()
    return F.lit(user) if isinstance(user, str) else user


def audit_stamp(
    df: DataFrame,
    as_of: Column | None = None,
    user: str | Column | None = None,
    enqueued: str | None = None,
) -> DataFrame:
    """Insert time and user; the update columns start out equal to them."""
    now = F.current_timestamp() if as_of is None else as_of
    stamps = {
        "row_insert_tsp": now,
        "row_updt_tsp": now,
        "insert_user_id": _user(user),
        "updt_user_id": _user(user),
    }
    if enqueued:
        stamps["msg_enqueued_tsp"] = F.col(enqueued)
    return df.withColumns(stamps)


def rename_old(df: DataFrame) -> DataFrame:
    """Columns of the earlier table generation under their present names."""
    return df.withColumnsRenamed({old: new for old, new in RENAMED.items() if old in df.columns})


def add_null_column(df: DataFrame, name: str, to: str) -> DataFrame:
    return df.withColumn(name, F.lit(None).cast(to))


def conform(df: DataFrame, spec: TableSpec, enforce: bool = True) -> DataFrame:
    """The table's columns in the table's order and types; missing ones are NULL, and so are values
    that do not fit their type.

    With ``enforce``, rows without a required column are left out, because a file table
    does not check NOT NULL itself.
    """
    have = set(df.columns)
    shaped = df.selectExpr(
        *(
            f"TRY_CAST({f'`{f.name}`' if f.name in have else 'NULL'} AS {f.dataType.simpleString()}) AS `{f.name}`"
            for f in spec.schema
        )
    )
    return require_keys(shaped, spec.required) if enforce and spec.required else shaped
