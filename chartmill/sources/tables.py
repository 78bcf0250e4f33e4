"""Tables, metrics and models on storage."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartmill.functions import col_of, to_number

# The text cells that the reference's CSV reader takes as missing by default.
DEFAULT_NA_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

_NO_TOKEN = "\u0001"


def read_table_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    na_tokens: Iterable[str] = (),
    keep_default_na: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header, and a per-call list of cells that mean missing.

    Cells are read as text, missing tokens become null, and numbers are cast to the schema's types;
    a cell that is no number becomes null. Without a schema all columns stay text.
    """
    tokens = list(dict.fromkeys([*(DEFAULT_NA_TOKENS if keep_default_na else []), *na_tokens]))
    reader = spark.read.options(
        header=True, multiLine=multi_line, escape='"', nullValue=_NO_TOKEN, emptyValue="", enforceSchema=True
    )
    if schema is not None:
        reader = reader.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]))
    text = reader.csv(path)
    out = []
    for f in schema.fields if schema is not None else text.schema.fields:
        # The reader gives null for an empty cell, whatever the options say.
        cell = col_of(f.name) if "" in tokens else F.coalesce(col_of(f.name), F.lit(""))
        if tokens:
            cell = F.when(~cell.isin(*tokens), cell)
        if isinstance(f.dataType, T.NumericType):
            kind = f.dataType.simpleString()
            cell = to_number(cell) if kind == "double" else to_number(cell, kind)
        elif not isinstance(f.dataType, T.StringType):
            cell = cell.try_cast(f.dataType)
        out.append(cell.alias(f.name))
    return text.select(*out)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    """Save a table. Parquet keeps types and the text ``None``; CSV does not."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.format(fmt).save(path)


def _file_system(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a finished table lies at the path; a write that broke off does not count."""
    fs, where = _file_system(spark, path)
    return bool(fs.exists(spark._jvm.org.apache.hadoop.fs.Path(where, "_SUCCESS")))


def cached_table(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], force: bool = False
) -> DataFrame:
    """The table stored at the path; built and stored first if it is missing or ``force`` is set."""
    if force or not table_exists(spark, path):
        write_table(build(), path)
    return spark.read.parquet(path)


def versions(spark: SparkSession, base: str) -> list[int]:
    """Numbers of the finished versions under a base folder, rising."""
    fs, where = _file_system(spark, base)
    if not fs.exists(where):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()]
    numbers = [n.removeprefix("version=") for n in names if n.startswith("version=")]
    return sorted(int(n) for n in numbers if n.isdigit() and table_exists(spark, f"{base}/version={n}"))


def _taken(spark: SparkSession, base: str) -> list[int]:
    fs, where = _file_system(spark, base)
    if not fs.exists(where):
        return []
    names = [s.getPath().getName().removeprefix("version=") for s in fs.listStatus(where)]
    return [int(n) for n in names if n.isdigit()]


def write_versioned(df: DataFrame, base: str) -> int:
    """Save as the next free version and return its number. Never overwrites one."""
    number = max(_taken(df.sparkSession, base), default=0) + 1
    df.write.mode("errorifexists").parquet(f"{base}/version={number}")
    return number


def latest_version(spark: SparkSession, base: str) -> DataFrame:
    """The version with the highest number."""
    known = versions(spark, base)
    if not known:
        raise FileNotFoundError(f"no version under {base}")
    return spark.read.parquet(f"{base}/version={known[-1]}")


def write_metrics(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def save_model(model: PipelineModel, path: str) -> None:
    """Store a fitted model; its feature list is part of it."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_or_train(path: str, train: Callable[[], PipelineModel], spark: SparkSession) -> PipelineModel:
    """The stored model, trained and stored first if there is none."""
    if not table_exists(spark, f"{path}/metadata"):
        save_model(train(), path)
    return load_model(path)


def model_features(model: PipelineModel) -> list[str]:
    """Names of the columns a stored model reads."""
    return list(model.stages[0].getInputCols())
