"""Table readers: file or folder resolution, CSV / gz CSV / Parquet, NULL tokens,
timestamp coercion and required-column checks (schema only, no job)."""

from __future__ import annotations

import csv
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens import config as C

CSV_DIALECT = {"quote": '"', "escape": '"'}

# Target types of the known input columns (anything else is kept as read).
ADMISSIONS_TYPES: dict[str, str] = {
    "subject_id": "bigint",
    "hadm_id": "bigint",
    "admission_type": "string",
    "admission_location": "string",
    "discharge_location": "string",
    "insurance": "string",
    "language": "string",
    "marital_status": "string",
    "race": "string",
    "hospital_expire_flag": "int",
}
PATIENTS_TYPES: dict[str, str] = {
    "subject_id": "bigint",
    "gender": "string",
    "anchor_age": "int",
    "anchor_year": "int",
}


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs_and_path(spark, path)
    return bool(fs.exists(hpath))


def _is_table_path(spark: SparkSession, path: str) -> bool:
    """A table is a file, or a folder Spark wrote, named with a supported suffix."""
    return any(path.endswith(ext) for ext in C.SUPPORTED_TABLE_EXTENSIONS) and path_exists(spark, path)


def resolve_table_path(spark: SparkSession, source: str, basename: str) -> str:
    """``source`` itself when it names a table, else the first of
    ``<basename>.csv.gz``, ``.csv``, ``.parquet`` inside the folder ``source``."""
    source = str(source).rstrip("/")
    if not path_exists(spark, source):
        raise FileNotFoundError(f"no table or folder at {source}")
    if _is_table_path(spark, source):
        return source
    fs, hpath = _fs_and_path(spark, source)
    if fs.getFileStatus(hpath).isDirectory():
        for ext in C.SUPPORTED_TABLE_EXTENSIONS:
            candidate = f"{source}/{basename}{ext}"
            if path_exists(spark, candidate):
                return candidate
        tried = ", ".join(f"{basename}{ext}" for ext in C.SUPPORTED_TABLE_EXTENSIONS)
        raise FileNotFoundError(f"folder {source} holds none of {tried}")
    return source


def _null_tokens_to_null(df: DataFrame) -> DataFrame:
    tokens = list(C.CSV_NULL_TOKENS)
    exprs = {
        f.name: F.when(F.col(f.name).isin(tokens), F.lit(None).cast("string")).otherwise(F.col(f.name))
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType)
    }
    return df.withColumns(exprs) if exprs else df


# No separator and no quote: the whole line is the value.
WHOLE_LINES = {"sep": "\x01", "quote": "\x00", "escape": "\x00", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _split_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with one record per line, all columns as text: files stay splittable.  A line
    whose quotes do not pair up is part of a longer record, and a line may have too many
    fields; both raise instead of shifting or cutting columns (missing fields are NULL).
    The first line of every part file is its header, which names the columns; a data row
    equal to it is kept."""
    head = next((r["value"] for r in spark.read.text(path).where(F.trim("value") != "").take(1)), None)  # one line
    if head is None:
        return spark.createDataFrame([], T.StructType([]))
    names = next(csv.reader([head.lstrip("\ufeff")]))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    line = F.when(quotes % 2 == 0, F.col("value")).otherwise(
        F.raise_error(F.lit(f"{path}: a quoted value spans lines; read this file with multi_line=True"))
    )
    # Lines as a CSV of one column: Spark itself leaves out the first line of each file.
    lines = spark.read.schema("value string").options(header=True, enforceSchema=True, **WHOLE_LINES).csv(path)
    beyond = "_".join(["beyond", *names])
    ddl = f"{_ddl(schema)}, `{beyond.replace('`', '``')}` STRING"
    parsed = lines.where(F.trim("value") != "").select(F.from_csv(line, ddl, CSV_DIALECT).alias("r"))
    checked = F.when(F.col("r").getField(beyond).isNull(), F.col("r")).otherwise(
        F.raise_error(F.lit(f"{path}: a line has more than {len(names)} fields"))
    )
    return parsed.select(checked.alias("r")).select("r.*").drop(beyond)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` STRING" for f in schema.fields)


def read_table(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Read by suffix.  CSV is read as text (no inference pass) with ``"`` as quote and
    escape and the NULL tokens normalized; ``multi_line`` allows line breaks inside quoted
    values, at the price of one task per file.  gz CSV cannot be split, so it is spread over
    the cluster after reading."""
    if path.endswith(".csv.gz") or path.endswith(".csv"):
        if multi_line:
            df = spark.read.options(**CSV_DIALECT, header=True, multiLine=True).csv(path)
        else:
            df = _split_csv(spark, path)
        df = _null_tokens_to_null(df)
        if path.endswith(".gz"):
            df = df.repartition(spark.sparkContext.defaultParallelism)
        return df
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    raise ValueError(f"no reader for {path}: tables end in .csv, .csv.gz or .parquet")


def nan_to_null(df: DataFrame) -> DataFrame:
    """Floating NaN becomes NULL (Spark orders NaN above every number and NaN > 7 is true)."""
    exprs = {
        f.name: F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(exprs) if exprs else df


def _typed(name: str, target: str):
    """The column as ``target``; text that is no such value becomes NULL.  Whole numbers
    may be written with a fraction point (``65.0``), as nullable integers often are."""
    direct = F.expr(f"try_cast(`{name.replace('`', '``')}` AS {target})")
    if target not in ("int", "bigint"):
        return direct
    number = F.expr(f"try_cast(`{name.replace('`', '``')}` AS DOUBLE)")
    whole = F.when(number == F.floor(number), number)
    return F.coalesce(direct, whole.try_cast(target))


def coerce_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """The known columns that are present in their types (bad values become NULL)."""
    exprs = {
        name: _typed(name, target)
        for name, target in types.items()
        if name in df.columns and df.schema[name].dataType.simpleString() != target
    }
    return df.withColumns(exprs) if exprs else df


def coercion_report(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """column, n_values, n_lost: how many non-NULL values :func:`coerce_types` turns NULL."""
    present = [(n, t) for n, t in types.items() if n in df.columns]
    rows = F.array(*[
        F.struct(
            F.lit(n).alias("column"),
            F.count(F.col(n)).alias("n_values"),
            F.count_if(F.col(n).isNotNull() & _typed(n, t).isNull()).alias("n_lost"),
        )
        for n, t in present
    ])
    return df.agg(rows.alias("r")).select(F.inline("r"))


def parse_datetime_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Present columns become TIMESTAMP_NTZ; unparseable text becomes NULL.

    Unlike pandas, which infers one format from the first value, every value is parsed
    on its own (a date-only value after a date-time one is kept)."""
    exprs = {}
    for name in columns:
        if name not in df.columns:
            continue
        dtype = df.schema[name].dataType
        if isinstance(dtype, T.TimestampNTZType):
            continue
        if isinstance(dtype, (T.TimestampType, T.DateType)):
            exprs[name] = F.col(name).cast("timestamp_ntz")
        else:
            exprs[name] = F.expr(f"try_cast(`{name}` AS TIMESTAMP_NTZ)")
    return df.withColumns(exprs) if exprs else df


def validate_required_columns(df: DataFrame, required: Iterable[str], name: str) -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"table {name!r} lacks {', '.join(missing)}; it has {', '.join(df.columns)}")


def prepare_admissions(df: DataFrame) -> DataFrame:
    df = parse_datetime_columns(coerce_types(nan_to_null(df), ADMISSIONS_TYPES), C.ADMISSION_TIMESTAMP_COLUMNS)
    validate_required_columns(df, C.REQUIRED_ADMISSIONS_COLUMNS, "admissions")
    return df


def prepare_patients(df: DataFrame) -> DataFrame:
    df = coerce_types(nan_to_null(df), PATIENTS_TYPES)
    validate_required_columns(df, C.REQUIRED_PATIENTS_COLUMNS, "patients")
    return df


def load_admissions(spark: SparkSession, source: str, multi_line: bool = False) -> DataFrame:
    return prepare_admissions(read_table(spark, resolve_table_path(spark, source, C.ADMISSIONS_TABLE_BASENAME), multi_line))


def load_patients(spark: SparkSession, source: str, multi_line: bool = False) -> DataFrame:
    return prepare_patients(read_table(spark, resolve_table_path(spark, source, C.PATIENTS_TABLE_BASENAME), multi_line))


def load_core_admissions_dataset(spark: SparkSession, admissions_source: str, patients_source: str) -> DataFrame:
    """Admissions left-joined to one demographic row per patient (no cohort filtering)."""
    from staylens.operators.cohort import merge_admissions_patients

    return merge_admissions_patients(load_admissions(spark, admissions_source), load_patients(spark, patients_source))


def load_cohort(spark: SparkSession, path: str) -> DataFrame:
    """Reload a cohort written by the batch job (Parquet or CSV by suffix)."""
    df = read_table(spark, path)
    df = parse_datetime_columns(coerce_types(df, {**ADMISSIONS_TYPES, **PATIENTS_TYPES, "age_at_admit": "int", "los_days": "double"}), ("admittime", "dischtime"))
    validate_required_columns(df, ("los_days",), "cohort")
    return df
