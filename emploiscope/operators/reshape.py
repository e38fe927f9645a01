"""Renaming, filtering and reshaping of landed tables."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Exactly the mapped columns, renamed, in the mapping's order."""
    return df.select(*(F.col(f"`{source}`").alias(target) for source, target in mapping.items()))


def keep_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose ``column`` is one of ``values``; pushed down to Parquet scans."""
    return df.filter(F.col(f"`{column}`").isin(*values))


def keep_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    return df.filter(F.col(column).startswith(prefix))


def project_paths(
    df: DataFrame, paths: Mapping[str, str], types: Mapping[str, DataType], keep: Sequence[str] = ()
) -> DataFrame:
    """Columns from dotted paths into nested JSON text (``company.display_name``).

    ``df`` holds top-level fields as text (``scan_json_text``). A missing level, a missing
    leaf or a scalar where an object is expected gives NULL. Each top-level field is parsed
    once. ``types`` names the target types of columns that are not text; the columns of
    ``keep`` stay as they are.
    """
    def field(path: str) -> str:
        """What is parsed for ``path``: its top-level field, once for all paths into it.

        A path running through another path's leaf needs another shape and is parsed alone.
        """
        through_leaf = any("." in other and path.startswith(f"{other}.") for other in paths)
        return path if through_leaf else path.split(".")[0]

    shapes: dict[str, StructType] = {}
    for path, target in paths.items():
        _, *rest = path.split(".")
        if rest:
            leaf = types.get(target, StringType())
            leaf = leaf if isinstance(leaf, ArrayType) else StringType()
            shapes[field(path)] = _with_leaf(shapes.get(field(path), StructType()), rest, leaf)
    # With an option set, Spark keeps one parse per field instead of one per leaf.
    parsed = {name: F.from_json(F.col(name.split(".")[0]), shape, {"mode": "PERMISSIVE"}) for name, shape in shapes.items()}

    def value(path: str, target: str) -> Column:
        root, *rest = path.split(".")
        column = parsed[field(path)] if rest else F.col(root)
        for name in rest:
            column = column[name]
        dtype = types.get(target, StringType())
        if isinstance(dtype, ArrayType):
            return (column if rest else F.from_json(column, dtype)).alias(target)
        return column.cast(dtype).alias(target)

    return df.select(*(value(path, target) for path, target in paths.items()), *keep)


def _with_leaf(shape: StructType, path: Sequence[str], leaf: DataType) -> StructType:
    name, *rest = path
    kept = [f for f in shape if f.name != name]
    current = next((f.dataType for f in shape if f.name == name), StructType())
    return StructType([*kept, StructField(name, _with_leaf(current, rest, leaf) if rest else leaf)])


def unpivot_years(
    df: DataFrame,
    dimensions: Sequence[str],
    first_measure: tuple[str, str],
    second_measure: tuple[str, str],
    year_column: str = "annee",
) -> DataFrame:
    """Two wide families of yearly columns as one row per year.

    Each measure is ``(column prefix, output name)``. Years come from the first family;
    the second is paired by year, NULL where it has no column. A row stays unless both
    measures are NULL. It is a map-only step: nothing is shuffled.
    """
    (prefix, first_name), (other_prefix, second_name) = first_measure, second_measure
    years = [m.group(1) for m in (re.fullmatch(re.escape(prefix) + r"(\d{4})", c) for c in df.columns) if m]
    if not years:
        raise ValueError(f"No column named {prefix}YYYY. Available columns: {sorted(df.columns)}")

    def measure(name: str) -> Column:
        return F.col(name).cast("bigint") if name in df.columns else F.lit(None).cast("bigint")

    rows = [
        F.struct(
            F.lit(int(year)).cast("bigint").alias(year_column),
            measure(prefix + year).alias(first_name),
            measure(other_prefix + year).alias(second_name),
        )
        for year in years
    ]
    long = df.select(*dimensions, F.inline(F.array(*rows)))
    return long.filter(F.col(first_name).isNotNull() | F.col(second_name).isNotNull())
