"""Reading files of one table whose schemas differ: groups of equal schema, one scan each, brought to common columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Footers read at the same time.
READERS = 8
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def file_schemas(spark: SparkSession, files: Sequence[str], skip_corrupt: bool = False) -> dict[str, T.StructType]:
    """The schema of every file, or of every folder that one writer filled, from a footer each.

    Unreadable ones raise, or are left out with ``skip_corrupt``.
    """
    def one(path: str) -> T.StructType | None:
        try:
            return spark.read.option("recursiveFileLookup", True).parquet(path).schema
        except Exception as error:
            if skip_corrupt:
                return None
            raise ValueError(f"cannot read the schema of {path}: {error}") from error

    with ThreadPoolExecutor(READERS) as pool:
        found = dict(zip(files, pool.map(one, files)))
    return {path: schema for path, schema in found.items() if schema is not None}


def common_type(types: Sequence[T.DataType]) -> T.DataType:
    """The narrowest type that holds all: of whole numbers the widest, with other numbers a double, of times with and
    without a zone the one without; anything else that differs becomes text."""
    distinct = list(dict.fromkeys(types))
    if len(distinct) == 1:
        return distinct[0]
    if all(isinstance(t, WHOLE) for t in distinct):
        return max(distinct, key=lambda t: WHOLE.index(type(t)))
    if all(isinstance(t, T.NumericType) for t in distinct):
        return T.DoubleType()
    if all(isinstance(t, (T.TimestampType, T.TimestampNTZType)) for t in distinct):
        return T.TimestampNTZType()
    return T.StringType()


def common_schema(
    schemas: Mapping[str, T.StructType], required: Sequence[str] = (), spelled: Sequence[str] = ()
) -> T.StructType:
    """All columns of all files, without regard to case, in order of first appearance.

    A name is spelled as in ``required`` or ``spelled``, else as in the first file. Columns of no type of their own
    (null throughout) take that of the other files. A file without a required column raises and is named.
    """
    names = {n.lower(): n for n in (*required, *spelled)}
    types: dict[str, list[T.DataType]] = {}
    for path, schema in schemas.items():
        have = {f.name.lower(): f for f in schema.fields}
        lost = [n for n in required if n.lower() not in have]
        if lost:
            raise ValueError(f"{path} has no column {', '.join(lost)}")
        if len(have) < len(schema.fields):
            raise ValueError(f"{path} has columns whose names differ in case only")
        for key, f in have.items():
            names.setdefault(key, f.name)
            types.setdefault(key, [])
            if not isinstance(f.dataType, T.NullType):
                types[key].append(f.dataType)
    return T.StructType([T.StructField(names[k], common_type(t) if t else T.StringType()) for k, t in types.items()])


def read_united(
    spark: SparkSession, files: Sequence[str], required: Sequence[str] = (), spelled: Sequence[str] = (),
    skip_corrupt: bool = False, extra: Mapping[str, F.Column] | None = None,
) -> DataFrame:
    """All rows of all files under their common schema; columns a file lacks are null.

    ``extra`` are columns made where a file is scanned, such as its own name. Files of equal schema are one scan, so
    that a folder without differences is read as if there were no such step.
    """
    schemas = file_schemas(spark, files, skip_corrupt)
    if not schemas:
        raise ValueError(f"none of {len(files)} files can be read")
    target = common_schema(schemas, required, spelled)
    groups: dict[str, list[str]] = {}
    for path, schema in schemas.items():
        groups.setdefault(schema.json(), []).append(path)
    parts = []
    for paths in groups.values():
        schema = schemas[paths[0]]
        have = {f.name.lower(): f.name for f in schema.fields}
        columns = [
            (F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.fields
        ]
        reader = spark.read.option("recursiveFileLookup", True).option("ignoreCorruptFiles", skip_corrupt)
        parts.append(reader.schema(schema).parquet(*paths).select(
            *columns, *[c.alias(n) for n, c in (extra or {}).items()]))
    return reduce(DataFrame.unionByName, parts)
