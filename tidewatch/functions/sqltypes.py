"""Spark column types to SQL Server column types."""

from __future__ import annotations

from pyspark.sql.types import DataType, DecimalType, StructType

# The original type map; every other type becomes DEFAULT.
COMPAT_TYPES = {
    "int": "INT",
    "string": "NVARCHAR(255)",
    "timestamp": "DATETIME",
    "double": "FLOAT",
    "boolean": "BIT",
    "decimal": "DECIMAL(18,2)",
}
COMPAT_DEFAULT = "NVARCHAR(255)"

TYPES = {
    "tinyint": "SMALLINT",
    "smallint": "SMALLINT",
    "int": "INT",
    "bigint": "BIGINT",
    "string": "NVARCHAR(MAX)",
    "timestamp": "DATETIME2",
    "timestamp_ntz": "DATETIME2",
    "date": "DATE",
    "float": "REAL",
    "double": "FLOAT",
    "boolean": "BIT",
    "binary": "VARBINARY(MAX)",
}
DEFAULT = "NVARCHAR(MAX)"


def sql_type(dtype: DataType, compat: bool = False) -> str:
    """The target type. `compat` keeps the original map, in which decimals,
    floats and long integers fall to text and text is cut at 255."""
    name = dtype.simpleString()
    if compat:
        return COMPAT_TYPES.get(name, COMPAT_DEFAULT)
    if isinstance(dtype, DecimalType):
        return f"DECIMAL({dtype.precision},{dtype.scale})"
    return TYPES.get(name, DEFAULT)


def column_types(schema: StructType, compat: bool = False) -> list[tuple[str, str]]:
    return [(field.name, sql_type(field.dataType, compat)) for field in schema.fields]


def create_table(schema: StructType, table: str, compat: bool = False) -> str:
    """The CREATE TABLE text for `schema`; brackets in names are doubled."""

    def quote(name: str) -> str:
        return "[" + name.replace("]", "]]") + "]"

    columns = ", ".join(f"{quote(name)} {kind}" for name, kind in column_types(schema, compat))
    return f"CREATE TABLE {quote(table)} ({columns})"
