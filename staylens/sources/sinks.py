"""Writers: one table by path suffix, or a set of report tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def save_dataframe(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write ``df`` as CSV (with header) or Parquet chosen by the path suffix.

    Spark writes a folder of part files under ``path``; nothing is funnelled through one
    task.  Any other suffix is an error."""
    if path.endswith((".csv", ".csv.gz")):
        # Full microsecond timestamps (the CSV default keeps milliseconds only); quotes are
        # doubled and blanks kept, as the reader expects.
        (
            df.write.mode(mode)
            .options(header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
            .option("compression", "gzip" if path.endswith(".gz") else "none")
            .option("timestampNTZFormat", TIMESTAMP_FORMAT)
            .option("timestampFormat", TIMESTAMP_FORMAT)
            .csv(path)
        )
    elif path.endswith(".parquet"):
        df.write.mode(mode).parquet(path)
    else:
        raise ValueError(f"no writer for {path}: tables end in .csv, .csv.gz or .parquet")
    return path


def save_report_tables(tables: Mapping[str, DataFrame], folder: str, fmt: str = "parquet", mode: str = "overwrite") -> dict[str, str]:
    """Write each named table to ``<folder>/<name>.<fmt>``; returns name -> path."""
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"Unsupported report format: {fmt}")
    out = {}
    for name, df in tables.items():
        out[name] = save_dataframe(df, f"{folder.rstrip('/')}/{name}.{fmt}", mode)
    return out
