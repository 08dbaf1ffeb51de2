"""CSV exports of tables: header line, quotes doubled within quotes, maps and arrays as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from corpusloom.sources.schemas import SCHEMAS

_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "false", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
_nested = lambda kind: isinstance(kind, (MapType, ArrayType))


def write_csv(df: DataFrame, path: str) -> None:
    """`df` as CSV files under `path`. Line breaks in texts are written as the two signs `\\n`, so that a file can be split, nulls as `\\N`."""
    cell = lambda f: F.to_json(f.name) if _nested(f.dataType) else F.replace(F.replace(f.name, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")) if isinstance(f.dataType, StringType) else F.col(f.name)
    df.select(*[cell(f).alias(f.name) for f in df.schema.fields]).write.options(**_OPTIONS, emptyValue='""', nullValue="\\N", timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path)


def read_csv(spark: SparkSession, path: str, name: str, escaped: bool = True, rename: dict[str, str] | None = None) -> DataFrame:
    """The table `name` from CSV files under `path`, columns met by the header in the order of the schema.

    `escaped`: texts and nulls are as write_csv() writes them; else an empty cell is null. `rename`: columns of the files by their name in the schema.
    """
    fields = SCHEMAS[name].fields
    names = rename or {}
    flat = StructType([StructField(names.get(f.name, f.name), StringType() if _nested(f.dataType) else f.dataType) for f in fields])
    rows = spark.read.options(**_OPTIONS, enforceSchema="false", nullValue="\\N" if escaped else "", timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]").schema(flat).csv(path)

    def cell(f):
        c = F.col(names.get(f.name, f.name))
        if _nested(f.dataType):
            return F.from_json(c, f.dataType.simpleString())
        if escaped and isinstance(f.dataType, StringType):
            # a doubled backslash first, by way of a sign that no text has
            return F.replace(F.replace(F.replace(c, F.lit("\\\\"), F.lit("\x00")), F.lit("\\n"), F.lit("\n")), F.lit("\x00"), F.lit("\\"))
        return c

    return rows.select(*[cell(f).alias(f.name) for f in fields])
