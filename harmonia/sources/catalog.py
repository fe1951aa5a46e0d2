"""Catalog listings and user SQL scripts."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SQL_TYPES = {
    T.LongType: ("BIGINT", 64), T.IntegerType: ("INTEGER", 32), T.ShortType: ("SMALLINT", 16),
    T.ByteType: ("TINYINT", 8), T.DoubleType: ("DOUBLE", 53), T.FloatType: ("FLOAT", 24),
    T.StringType: ("VARCHAR", None), T.BooleanType: ("BOOLEAN", None), T.TimestampType: ("TIMESTAMP WITH TIME ZONE", None),
    T.TimestampNTZType: ("TIMESTAMP", None), T.DateType: ("DATE", None),
}


def sql_type(dt: T.DataType) -> tuple[str, int | None]:
    for cls, v in _SQL_TYPES.items():
        if isinstance(dt, cls):
            return v
    if isinstance(dt, T.DecimalType):
        return f"DECIMAL({dt.precision},{dt.scale})", dt.precision
    if isinstance(dt, T.ArrayType):
        return sql_type(dt.elementType)[0] + "[]", None
    return dt.simpleString().upper(), None


def data_dictionary(spark: SparkSession, tables: dict[str, DataFrame], schema: str = "main") -> DataFrame:
    """One row per column: schema, table, column, ordinal, type, char length, numeric precision,
    nullability, default; staging schemas excluded; sorted.  Built from table schemas (metadata)."""
    rows = []
    for name, df in tables.items():
        sch, _, tbl = name.rpartition(".")
        sch = sch or schema
        if sch.startswith("staging_"):
            continue
        for i, f in enumerate(df.schema.fields, start=1):
            typ, prec = sql_type(f.dataType)
            rows.append((sch, tbl, f.name, i, typ, None, prec, "YES" if f.nullable else "NO", None))
    out = spark.createDataFrame(rows, "table_schema string, table_name string, column_name string, "
                                      "ordinal_position int, data_type string, character_maximum_length int, "
                                      "numeric_precision int, is_nullable string, column_default string")
    return out.orderBy("table_schema", "table_name", "ordinal_position")


#: Quoted text, quoted names and comments are single tokens, so a ';' in them ends nothing.
_TOKEN = re.compile(r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`(?:[^`]|``)*`|(?P<comment>--[^\n]*|/\*.*?\*/)|(?P<end>;)|[^;'"`/-]+|.""", re.DOTALL)


def statements(sql_text: str) -> list[str]:
    """The statements of a script, without those that are blank or comments alone."""
    out, parts, some = [], [], False
    for token in _TOKEN.finditer(sql_text + ";"):
        if token["end"]:
            out += ["".join(parts).strip()] if some else []
            parts, some = [], False
            continue
        parts.append(token[0])
        some = some or not (token["comment"] or token[0].isspace())
    return out


def run_script(spark: SparkSession, sql_text: str, views: dict[str, DataFrame]) -> DataFrame | None:
    """Run the statements of a script with the inputs as temporary views; the result of the last statement is
    returned, None for a script without any.  A temporary view of the user's with the name of an input is put back afterwards; names
    that were free keep the input, so that views made by the script go on working."""
    taken = {name for name in views if spark.sql(f"SHOW VIEWS LIKE '{name}'").where(F.col("isTemporary")).head(1)}
    before = {name: spark.table(f"`{name}`") for name in taken}
    try:
        for name, df in views.items():
            df.createOrReplaceTempView(name)
        out = None
        for s in statements(sql_text):
            out = spark.sql(s)
        return out
    finally:
        for name, df in before.items():
            df.createOrReplaceTempView(name)


def run_script_folder(spark: SparkSession, folder: str, views: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Run every ``*.sql`` file of a folder, on any store Spark reads, in name order (post-processing scripts); returns the
    result of each script's last statement, keyed by file name.  The texts of the scripts come to the
    driver; the statements run on the cluster."""
    files = (spark.read.text(folder, wholetext=True, pathGlobFilter="*.sql")
             .select(F.col("_metadata.file_name").alias("name"), "value").collect())
    return {f["name"]: run_script(spark, f["value"], views) for f in sorted(files, key=lambda f: f["name"])}
