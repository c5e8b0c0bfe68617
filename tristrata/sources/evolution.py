"""Layers whose files disagree about the type of a column."""

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
#: Digits that the values of a whole type need.
DIGITS = dict(zip(WHOLE, (3, 5, 10, 20), strict=True))


def wider(one: T.DataType, other: T.DataType) -> T.DataType | None:
    """The least type that holds every value of both exactly; None if there is none."""
    if one == other:
        return one
    for a, b in ((one, other), (other, one)):
        if isinstance(a, T.NullType):
            return b
        if a in DIGITS and b in DIGITS:
            return max(a, b, key=WHOLE.index)
        if isinstance(b, T.DoubleType) and (isinstance(a, T.FloatType) or DIGITS.get(a, 99) <= 10):
            return b
        if isinstance(b, T.FloatType) and DIGITS.get(a, 99) <= 5:
            return b
        if isinstance(b, T.DecimalType) and (a in DIGITS or isinstance(a, T.DecimalType)):
            digits, scale = (a.precision, a.scale) if isinstance(a, T.DecimalType) else (DIGITS[a], 0)
            scales = max(scale, b.scale)
            whole = max(digits - scale, b.precision - b.scale)
            return T.DecimalType(whole + scales, scales) if whole + scales <= 38 else None
        if isinstance(a, T.DateType) and isinstance(b, T.TimestampNTZType):
            return b
    return None


def common_schema(schemas: list[T.StructType]) -> T.StructType | None:
    """All columns of ``schemas`` in order of appearance, each of its least common type."""
    types: dict[str, T.DataType] = {}
    for schema in schemas:
        for field in schema:
            found = wider(types.get(field.name, field.dataType), field.dataType)
            if found is None:
                return None
            types[field.name] = found
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


#: How a failure to merge footers arrives: on the driver, or from the job that merges them.
FAILURES = (PySparkException, Py4JJavaError)


def is_conflict(error: Exception) -> bool:
    return "CANNOT_MERGE_SCHEMA" in str(error)


def groups_of_files(
    spark: SparkSession, path: str, files: list[str]
) -> list[tuple[list[str], T.StructType]]:
    """Files in order, in groups whose footers merge, with the merged schema of each group.

    Where the footers of ``files`` do not merge, either half is looked at alone: a change of type
    between two loads costs as many reads of footers as it takes to halve down to it.
    """
    try:
        reader = spark.read.option("basePath", path).option("mergeSchema", True)
        return [(files, reader.parquet(*files).schema)]
    except FAILURES as e:
        if not is_conflict(e) or len(files) == 1:
            raise
    middle = len(files) // 2
    found = groups_of_files(spark, path, files[:middle]) + groups_of_files(spark, path, files[middle:])
    joined = [found[0]]
    for group, schema in found[1:]:
        if joined[-1][1] == schema:
            joined[-1] = (joined[-1][0] + group, schema)
        else:
            joined.append((group, schema))
    return joined


def read_conflicting(
    spark: SparkSession, path: str, partition_types: dict[str, T.DataType] | None = None
) -> DataFrame | None:
    """A layer whose files differ in types: files grouped by schema, each group cast to the least
    common types, and united. None where a pair of types has none.

    Files are taken in order of writing, in which types change seldom.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    order = listed.select("path").orderBy("modificationTime", "path")
    found = groups_of_files(spark, path, [r["path"] for r in order.collect()])
    given = {c: t for c, t in (partition_types or {}).items()}
    schemas = [
        T.StructType([T.StructField(f.name, given.get(f.name, f.dataType)) for f in schema])
        for _, schema in found
    ]
    common = common_schema(schemas)
    if common is None:
        return None

    def read(files: list[str], schema: T.StructType) -> DataFrame:
        group = spark.read.option("basePath", path).schema(schema).parquet(*files)
        return group.select(
            *(F.col(f"`{f.name}`").cast(common[f.name].dataType).alias(f.name) for f in schema)
        )

    parts = [read(files, schema) for (files, _), schema in zip(found, schemas, strict=True)]
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return whole.select(*(f"`{c}`" for c in common.names))
