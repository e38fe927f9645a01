"""Reading landed files: format by extension, typed JSON, Parquet, header checks."""

from __future__ import annotations

from collections.abc import Iterable
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

FORMAT_BY_EXTENSION = {".json": "json", ".jsonl": "json", ".parquet": "parquet"}


def source_format(path: str) -> str:
    """``json`` or ``parquet`` from the extension, case-insensitive; anything else is an error."""
    extension = PurePosixPath(path).suffix.lower()
    if extension not in FORMAT_BY_EXTENSION:
        raise ValueError(f"No reader for {path!r}: expected one of {', '.join(FORMAT_BY_EXTENSION)}")
    return FORMAT_BY_EXTENSION[extension]


def scan(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Read a landed file by its extension.

    JSON with ``schema`` is read as typed (see ``scan_json``); without one Spark infers the
    types, which costs another pass over the files. Parquet carries its own schema; a given
    one only selects and casts.
    """
    if source_format(path) == "parquet":
        df = spark.read.parquet(path)
        return df if schema is None else df.select(*(F.col(f.name).cast(f.dataType) for f in schema))
    return spark.read.json(path) if schema is None else scan_json(spark, path, schema)


def scan_json_text(spark: SparkSession, path: str, columns: Iterable[str]) -> DataFrame:
    """Newline JSON with each named top-level field as text; other fields are dropped.

    Nested values keep their JSON text, so a scalar where an object is expected stays
    readable. Only a line that is not JSON fails the scan.
    """
    schema = StructType([StructField(name, StringType()) for name in columns])
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def scan_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Newline JSON with explicit types: unknown fields dropped, missing ones NULL.

    Leaves are parsed as text and cast, in one pass, so quoted numbers are accepted
    (``"0"`` into an integer column). Other text in a typed column fails under ANSI mode; so
    do a line that is not JSON and a scalar where the schema has an object or an array.
    """
    text = spark.read.schema(_as_text(schema)).option("mode", "FAILFAST").json(path)
    return text.select(*(retype(F.col(f.name), f.dataType).alias(f.name) for f in schema))


def _as_text(dtype: DataType) -> DataType:
    """The same shape with STRING leaves."""
    if isinstance(dtype, StructType):
        return StructType([StructField(f.name, _as_text(f.dataType)) for f in dtype])
    if isinstance(dtype, ArrayType):
        return ArrayType(_as_text(dtype.elementType))
    return StringType()


def retype(value: Column, dtype: DataType) -> Column:
    """Cast the leaves of a text-leaved nested value, keeping NULL structs NULL."""
    if _as_text(dtype) == dtype:
        return value
    if isinstance(dtype, StructType):
        fields = [retype(value[f.name], f.dataType).alias(f.name) for f in dtype]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(dtype, ArrayType):
        return F.transform(value, lambda item: retype(item, dtype.elementType))
    return value.cast(dtype)


def require_columns(df: DataFrame, expected: Iterable[str]) -> DataFrame:
    """``df`` unchanged, or an error naming the missing and the available columns."""
    missing = [name for name in expected if name not in df.columns]
    if missing:
        raise ValueError(f"Missing columns: {missing}. Available columns: {sorted(df.columns)}")
    return df
