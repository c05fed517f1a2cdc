"""Small helpers over column names, roles and types."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Roles:
    """What each column of a table is used for."""

    key: str
    label: str | None = None
    numeric: tuple[str, ...] = field(default=())
    categorical: tuple[str, ...] = field(default=())

    @classmethod
    def of(cls, df: DataFrame, key: str, label: str | None = None) -> Roles:
        """Roles from the schema: numbers are numeric, strings and booleans categorical."""
        free = [f for f in df.schema.fields if f.name not in (key, label)]
        return cls(
            key,
            label,
            tuple(f.name for f in free if isinstance(f.dataType, T.NumericType)),
            tuple(f.name for f in free if isinstance(f.dataType, (T.StringType, T.BooleanType))),
        )


def col(name: str) -> Column:
    """Column by its literal name (dots and spaces allowed)."""
    return F.col("`" + name.replace("`", "``") + "`")


def listed(names: str | Sequence[str] | None) -> list[str]:
    if names is None:
        return []
    return [names] if isinstance(names, str) else list(names)


def require(df: DataFrame, names: Iterable[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")


def melt(df: DataFrame, names: Sequence[str], ids: Sequence[str] = (), as_type: str = "double") -> DataFrame:
    """Long form (ids..., column_name, value) without missing values."""
    flat = df.select(*[col(i) for i in ids], *[col(n).cast(as_type).alias(n) for n in names])
    return flat.unpivot(
        [col(i) for i in ids], [col(n) for n in names], "column_name", "value"
    ).filter(F.col("value").isNotNull())


def one_row_to_long(row: DataFrame, names: Sequence[str], stats: Sequence[str]) -> DataFrame:
    """Turn a one-row aggregate with columns 'name|stat' into one row per name."""
    items = [
        F.struct(F.lit(n).alias("column_name"), *[col(f"{n}|{s}").alias(s) for s in stats])
        for n in names
    ]
    return row.select(F.inline(F.array(*items)))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing numbers are NULL everywhere; NaN read from a source becomes NULL."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(
        *[F.nanvl(col(n), F.lit(None).cast("double")).alias(n) if n in floats else col(n) for n in df.columns]
    )
