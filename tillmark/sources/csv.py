"""Sales files in CSV: delimiter, column checks and a scan that drops personal names."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark import schema
from tillmark.operators.sampling import first_rows

# Texts that stand for a missing value.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def _open(read, path: str | Sequence[str]) -> DataFrame:
    try:
        return read(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no sales file at {path}; check the path and put the file there first") from error
        raise


def detect_separator(spark: SparkSession, path: str | Sequence[str]) -> str:
    """";" if the header line holds more of them than commas, else ","."""
    header = _open(spark.read.text, path).first()
    line = header["value"] if header else ""
    return ";" if line.count(";") > line.count(",") else ","


def missing_columns(columns: Sequence[str]) -> list[str]:
    """Expected columns that are absent, in file order; a warning for the caller, not an error."""
    return [c for c in schema.expected_columns() if c not in columns]


def read_sales_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    n_rows: int | None = None,
    multi_line: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """All columns as text under their file names, without the personal names; a warning names absent expected ones.

    Plain files are split by Spark (``spark.sql.files.maxPartitionBytes``). A gzip file is one
    split, so its rows are spread after the read. ``multi_line`` allows line breaks in quotes at
    the price of one split per file.
    """
    separator = detect_separator(spark, path)
    reader = (
        spark.read.option("header", True)
        .option("sep", separator)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("multiLine", multi_line)
    )
    df = _open(reader.csv, path).drop(*schema.PERSONAL_COLUMNS)
    absent = missing_columns(df.columns)
    if absent:
        warnings.warn(f"columns not in {path}: {', '.join(absent)}", stacklevel=2)
    df = first_rows(df, n_rows)
    paths = [path] if isinstance(path, str) else list(path)
    # a gzip file is one split: few of them are dealt out to all cores, many already are
    cores = spark.sparkContext.defaultParallelism
    if partitions or (all(".gz" in p for p in paths) and len(df.inputFiles()) < cores):
        df = df.repartition(partitions or cores)
    named = [F.when(~F.col(f"`{c}`").isin(*MISSING_TEXTS), F.col(f"`{c}`")).alias(c) for c in df.columns]
    return df.select(*named)


def write_sales_csv(df: DataFrame, path: str, separator: str = ";", compression: str = "none") -> None:
    """Sales lines under their file names, quoted."""
    schema.to_file_names(df).write.options(header=True, sep=separator, quoteAll=True, compression=compression).csv(path)


def union_all(pieces: Sequence[DataFrame]) -> DataFrame:
    """Rows of all same-schema pieces."""
    out = pieces[0]
    for piece in pieces[1:]:
        out = out.unionByName(piece)
    return out
