"""Series tables: CSV, Parquet, JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.missing import nan_to_null
from tideline.spec import SeriesSpec

# Cell texts that mean "missing" in an input file.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Cell texts of true/false columns.
TRUTH_TEXTS = ("True", "TRUE", "true", "False", "FALSE", "false")

# Timestamps in text files: written to the microsecond, read with any fraction.
_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
_TIME_INPUT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]"


def series_schema(spec: SeriesSpec) -> T.StructType:
    """Declared types of a raw series file: timestamp, sensors and target."""
    fields = []
    if spec.time_col:
        fields.append(T.StructField(spec.time_col, T.TimestampNTZType()))
    fields += [T.StructField(c, T.DoubleType()) for c in (*spec.sensors, spec.target)]
    fields += [T.StructField(c, T.StringType()) for c in spec.categoricals]
    return T.StructType(fields)


# The low 33 bits of monotonically_increasing_id number the rows of a task.
_ROW_BITS = (1 << 33) - 1


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    multiline: bool = False,
    file_order: str | None = None,
) -> DataFrame:
    """CSV with a header row.

    With a schema the files are read once and columns are bound by name; a cell
    that is neither missing nor of the declared type fails the job.  Without
    one, columns of numbers and of true/false are found by another pass over
    the files; timestamps stay text.  A row with a wrong number of cells and a
    file whose header differs from that of the others fail the job.

    ``multiline`` reads line breaks inside quotes; a file is then one task, so
    keep the files small.  ``file_order`` names a further column that sorts the
    rows as they stand in the files, files by name (D2).
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multiline)
    checked = reader.option("mode", "FAILFAST").option("enforceSchema", False).option("columnPruning", False)
    texts = checked.csv(path)
    place = []
    if file_order:
        row = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)).alias("row")
        block = F.col("_metadata.file_block_start").alias("block")
        place.append(F.struct(F.col("_metadata.file_path").alias("file"), block, row).alias(file_order))
    types = {f.name: f.dataType for f in schema} if schema is not None else _number_types(texts)
    absent = [c for c in types if c not in texts.columns]
    if absent:
        raise KeyError(f"columns not in the file: {absent}")
    text = T.StringType()
    return texts.select(*[(_untouched(c) if t == text else _present(c).cast(t)).alias(c) for c, t in types.items()], *place)


def _untouched(name: str) -> Column:
    """The cell as it stands in the file, NULL where it means "missing"."""
    return F.when(_present(name).isNotNull(), F.col(f"`{name}`"))


def _present(name: str) -> Column:
    """The cell's text, NULL where it means "missing"."""
    text = F.trim(F.col(f"`{name}`"))
    return F.when(~text.isin(*MISSING_TEXTS), text)


def _number_types(texts: DataFrame) -> dict[str, T.DataType]:
    """BIGINT for whole numbers and BOOLEAN for true/false, both without gaps, DOUBLE for other numbers, else STRING."""
    cells = [_present(c) for c in texts.columns]
    counts = [F.count(F.lit(1)).alias("n")]
    for i, cell in enumerate(cells):
        counts += [
            F.count(cell).alias(f"present{i}"),
            F.count(cell.try_cast("double")).alias(f"numbers{i}"),
            F.count(cell.try_cast("bigint")).alias(f"whole{i}"),
            F.count_if(cell.isin(*TRUTH_TEXTS)).alias(f"truths{i}"),
        ]
    found = texts.agg(*counts).first()
    types: dict[str, T.DataType] = {}
    for i, name in enumerate(texts.columns):
        if found["n"] and found[f"truths{i}"] == found["n"]:
            types[name] = T.BooleanType()
        elif found[f"numbers{i}"] < found[f"present{i}"]:
            types[name] = T.StringType()
        elif found[f"whole{i}"] == found["n"]:
            types[name] = T.LongType()
        else:
            types[name] = T.DoubleType()
    return types


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """S3: one CSV part per task, each with a header."""
    writer = df.write.mode(mode).option("header", True).option("escape", '"')
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.option("timestampNTZFormat", _TIME_FORMAT).csv(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """One JSON object per line."""
    reader = spark.read.option("timestampNTZFormat", _TIME_INPUT)
    return (reader if schema is None else reader.schema(schema)).json(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """S4."""
    df.write.mode(mode).option("timestampNTZFormat", _TIME_FORMAT).json(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet, the default format: pruned columns, pushed filters."""
    return nan_to_null(spark.read.parquet(path))


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: tuple[str, ...] = ()) -> None:
    """Parquet, optionally partitioned."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)
