"""Reading landed files: Parquet whose schema drifts between files, and CSV with malformed rows."""

from __future__ import annotations

import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.config import ConfigError

SOURCE_FILE = "_source_file"
RESCUED = "_rescued_data"


def literal_path(path: str) -> str:
    """A path as Spark's reader takes it literally, with pattern characters escaped."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


# From narrow to wide: every value of a type on the left is one of each type to its right. A bigint is not always a
# double, and clock times and instants differ by the session's zone; such values are looked at one by one.
WIDENING = (
    (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    (T.ByteType, T.ShortType, T.IntegerType, T.DoubleType),
    (T.FloatType, T.DoubleType),
    (T.DateType, T.TimestampNTZType),
    (T.DateType, T.TimestampType),
)
# Decimal digits that hold every value of a whole-number type.
DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
# Footers read at a time while files are sorted by schema; each is read by a task.
FOOTERS_AT_ONCE = 16


def widens(stored: T.DataType, declared: T.DataType) -> bool:
    """Whether every stored value can be read as the declared type without a look at it."""
    if stored == declared or isinstance(stored, T.NullType):
        return True
    if isinstance(declared, T.DecimalType) and type(stored) in DIGITS:
        return declared.precision - declared.scale >= DIGITS[type(stored)]
    if isinstance(stored, T.DecimalType) and isinstance(declared, T.DecimalType):
        whole = declared.precision - declared.scale >= stored.precision - stored.scale
        return whole and declared.scale >= stored.scale
    for line in WIDENING:
        if type(stored) in line and type(declared) in line:
            return line.index(type(stored)) < line.index(type(declared))
    return False


def common_type(types: Sequence[T.DataType], name: str) -> T.DataType:
    """One type that can hold the values of all `types`; values that it cannot hold after all are an error when read."""
    known = list(dict.fromkeys(t for t in types if not isinstance(t, T.NullType)))
    if len(known) < 2:
        return known[0] if known else T.NullType()
    widest = [t for t in known if all(widens(other, t) for other in known)]
    if widest:
        return widest[0]
    if all(isinstance(t, T.DecimalType) or type(t) in DIGITS for t in known):
        scale = max(getattr(t, "scale", 0) for t in known)
        whole = max(t.precision - t.scale if isinstance(t, T.DecimalType) else DIGITS[type(t)] for t in known)
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    elif all(isinstance(t, T.NumericType) and not isinstance(t, T.DecimalType) for t in known):
        return T.DoubleType()
    elif all(isinstance(t, T.DateType | T.TimestampType | T.TimestampNTZType) for t in known):
        return T.TimestampNTZType()
    elif all(isinstance(t, T.StructType) for t in known):
        return common_schema(known, f"{name}.")
    elif all(isinstance(t, T.ArrayType) for t in known):
        return T.ArrayType(common_type([t.elementType for t in known], f"{name}[]"))
    raise ConfigError(f"column '{name}' comes as {' and as '.join(t.simpleString() for t in known)}")


def common_schema(schemas: Sequence[T.StructType], prefix: str = "") -> T.StructType:
    """All columns of `schemas`, in the order and spelling of their first appearance, each with one type."""
    found: dict[str, list[T.StructField]] = {}
    for schema in schemas:
        for field in schema:
            found.setdefault(field.name.lower(), []).append(field)
    return T.StructType(
        [T.StructField(f[0].name, common_type([g.dataType for g in f], prefix + f[0].name)) for f in found.values()]
    )


def lossless(stored: T.StructField, declared: T.DataType) -> Column:
    """A stored column as its declared type. A value that would change, say 1.7 as a whole number, is an error."""
    return _as_declared(F.col(f"`{stored.name}`"), stored.dataType, declared, stored.name)


def _as_declared(value: Column, stored: T.DataType, declared: T.DataType, name: str) -> Column:
    if widens(stored, declared):
        return value if stored == declared else value.cast(declared)
    if isinstance(stored, T.StructType) and isinstance(declared, T.StructType):
        fields = _fields(value, stored, declared, f"{name}.")
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(stored, T.ArrayType) and isinstance(declared, T.ArrayType):
        return F.transform(value, lambda e: _as_declared(e, stored.elementType, declared.elementType, f"{name}[]"))
    read = value.try_cast(declared)
    kept = read.isNotNull()
    if not isinstance(stored, T.StringType):
        kept = kept & F.coalesce(read.try_cast(stored) == value, F.lit(False))
    if isinstance(stored, T.IntegralType) and isinstance(declared, T.FractionalType):
        # The largest bigint becomes 2^63 as a double, which comes back as the largest bigint.
        kept = kept & (read.cast("double") < float(1 << 63))
    drift = f"column '{name}' is declared {declared.simpleString()}, which cannot hold the stored value "
    return F.when(kept | value.isNull(), read).otherwise(
        F.raise_error(F.concat(F.lit(drift), value.cast("string"))).cast(declared)
    )


def _fields(value: Column, stored: T.StructType, declared: T.StructType, prefix: str) -> list[Column]:
    """Fields of a struct column, found by name in any letter case: the declared ones and then any others."""
    own = {f.name.lower(): f for f in stored}
    names = {f.name.lower() for f in declared}

    def field(f: T.StructField) -> Column:
        found = own.get(f.name.lower())
        if found is None:
            return F.lit(None).cast(f.dataType).alias(f.name)
        return _as_declared(value.getField(found.name), found.dataType, f.dataType, prefix + f.name).alias(f.name)

    others = [value.getField(f.name).alias(f.name) for f in stored if f.name.lower() not in names]
    return [*[field(f) for f in declared], *others]


def conform(df: DataFrame, declared: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Declared columns first, with their declared types (null when absent), then any new ones, then `keep`."""
    stored = {f.name.lower(): f for f in df.schema}
    names = {f.name.lower() for f in declared} | set(keep)

    def column(field: T.StructField):
        found = stored.get(field.name.lower())
        if found is None:
            return F.lit(None).cast(field.dataType).alias(field.name)
        return lossless(found, field.dataType).alias(field.name)

    new = [F.col(f"`{f.name}`") for f in df.schema if f.name.lower() not in names]
    return df.select(*[column(f) for f in declared], *new, *keep)


def schema_groups(spark: SparkSession, paths: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """Files that can be read together, with the columns of each group.

    Each footer is read once, by a task. Files of one schema are one group, and so are groups that have no column of
    the same name under two types or spellings: their number is that of the conflicting schemas, not of the files.
    """
    with ThreadPoolExecutor(FOOTERS_AT_ONCE) as pool:
        schemas = list(pool.map(lambda p: spark.read.parquet(literal_path(p)).schema, paths))
    alike: dict[str, tuple[T.StructType, list[str]]] = {}
    for schema, path in zip(schemas, paths):
        alike.setdefault(schema.json(), (schema, []))[1].append(path)
    groups: list[tuple[dict[str, T.StructField], list[str]]] = []
    for schema, files in alike.values():
        own = {f.name.lower(): f for f in schema}
        for known, members in groups:
            both = known.keys() & own.keys()
            if all((known[c].name, known[c].dataType) == (own[c].name, own[c].dataType) for c in both):
                known.update(own)
                members.extend(files)
                break
        else:
            groups.append((own, list(files)))
    return [(T.StructType(list(known.values())), members) for known, members in groups]


def read_landed(spark: SparkSession, paths: Sequence[str], declared: T.StructType) -> DataFrame:
    """Read Parquet files as stored and bring them to the declared types; new columns are kept.

    Files whose types cannot be read together (say int and double for one column) are grouped by their schema and
    read once for each group. A new column gets one type that holds all its values.
    """

    def read(files: Sequence[str]) -> DataFrame:
        found = spark.read.option("mergeSchema", True).parquet(*[literal_path(p) for p in files])
        return found.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))

    try:
        return conform(read(paths), declared, [SOURCE_FILE])
    except (PySparkException, Py4JJavaError) as error:
        if len(paths) == 1 or "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
    groups = schema_groups(spark, paths)
    names = {f.name.lower() for f in declared}
    new = [T.StructType([f for f in schema if f.name.lower() not in names]) for schema, _ in groups]
    every = T.StructType([*declared.fields, *common_schema(new).fields])
    return reduce(DataFrame.unionByName, [conform(read(files), every, [SOURCE_FILE]) for _, files in groups])


def read_rescued_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, rescued: str = RESCUED
) -> DataFrame:
    """CSV with a header. A line that does not fit the schema is kept whole in the `rescued` column.

    Without a schema it is inferred, as for small reference files. Text such as `N/A` stays text. Columns are found
    by the names in each file's header, in any order and letter case. Declared ones that a file lacks are null;
    values of others are kept in `rescued` as JSON.
    """
    if schema is None:
        schema = spark.read.option("header", True).option("inferSchema", True).csv(path).schema
    # One line for each file: reference data is a few files.
    lines = spark.read.text(path).where(F.col("_metadata.file_block_start") == 0)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), "value", F.monotonically_increasing_id().alias("at"))
    headers = lines.groupBy("file").agg(F.min_by("value", "at").alias("header")).collect()
    files: dict[str, list[str]] = {}
    for row in sorted(headers, key=lambda r: r["file"]):
        files.setdefault(row["header"], []).append(literal_path(row["file"]))
    parts = [_rescued_csv(spark, group, schema, rescued) for group in files.values()]
    if not parts:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(rescued, T.StringType())]))
    return reduce(DataFrame.unionByName, parts)


def _rescued_csv(spark: SparkSession, files: list[str], schema: T.StructType, rescued: str) -> DataFrame:
    """Files with one header, by its names."""
    declared = {f.name.lower(): f for f in schema}
    header = spark.read.option("header", True).csv(files[:1]).columns
    fields = [T.StructField(c, declared[c.lower()].dataType if c.lower() in declared else T.StringType()) for c in header]
    rows = (
        spark.read.schema(T.StructType([*fields, T.StructField(rescued, T.StringType())]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", rescued)
        .csv(files)
    )
    stored = {c.lower(): c for c in header}

    def column(f: T.StructField):
        found = stored.get(f.name.lower())
        return (F.lit(None).cast(f.dataType) if found is None else F.col(f"`{found}`")).alias(f.name)

    more = [F.col(f"`{c}`") for c in header if c.lower() not in declared]
    kept = F.col(rescued)
    if more:
        surplus = F.when(F.coalesce(*more).isNotNull(), F.to_json(F.struct(*more)))
        kept = F.coalesce(kept, surplus)
    return rows.select(*[column(f) for f in schema], kept.alias(rescued))


def load_reference_csv(spark: SparkSession, path: str, table: str, schema: T.StructType | None = None) -> bool:
    """Create `table` from a CSV file unless it exists. Returns whether it was created."""
    if spark.catalog.tableExists(table):
        return False
    read_rescued_csv(spark, path, schema).write.saveAsTable(table)
    return True
