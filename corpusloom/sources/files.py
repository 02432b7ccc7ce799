"""Readers of files: separated tables, spreadsheets, bulk JSON, folders, and the registry of sources."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from corpusloom.functions import urls

#: Separators by extension; other extensions mean a comma.
SEPARATORS = {".csv": ",", ".tsv": "\t", ".psv": "|", ".pipe": "|"}
TABLE_KINDS = {".csv": "csv", ".tsv": "csv", ".psv": "csv", ".pipe": "csv", ".xls": "xls", ".xlsx": "xls"}


def table_kind(path: Column) -> Column:
    """csv, xls or null by the extension, in any case."""
    ext = urls.extension(path)
    out = F.lit(None).cast("string")
    for e, kind in TABLE_KINDS.items():
        out = F.when(ext == e, kind).otherwise(out)
    return out


def read_separated(spark: SparkSession, path: str, separator: str | None = None, encodings: tuple[str, ...] = ("UTF-8", "ISO-8859-1"), schema: str | None = None) -> DataFrame:
    """A separated file with a header; the separator follows from the extension, bytes that aren't UTF-8 lead to Latin-1.

    Without a schema types are inferred, which reads the file twice; production loads should name one.
    """
    sep = separator or next((s for e, s in SEPARATORS.items() if path.lower().endswith(e)), ",")
    encoding = encodings[0]
    if len(encodings) > 1 and not spark.read.text(path).where(~F.is_valid_utf8("value")).limit(1).isEmpty():
        encoding = encodings[1]
    reader = spark.read.option("sep", sep).option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("encoding", encoding)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


class _Sheets(DataSourceReader):
    def __init__(self, options):
        self.options = options

    def partitions(self):
        return [InputPartition(s) for s in self.options.get("sheets", "0").split(",")]

    def read(self, partition):
        import pandas as pd  # an engine for the format must be installed

        sheet = int(partition.value) if partition.value.isdigit() else partition.value
        frame = pd.read_excel(self.options["path"], sheet_name=sheet, dtype=str)
        for n, row in enumerate(frame.itertuples(index=False)):
            yield (str(partition.value), n, {str(c): None if v != v else v for c, v in zip(frame.columns, row, strict=True)})


class SpreadsheetSource(DataSource):
    """Spreadsheets by sheet, one partition each: spark.dataSource.register(SpreadsheetSource), then format('sheets')."""

    @classmethod
    def name(cls) -> str:
        return "sheets"

    def schema(self) -> str:
        return "sheet string, row_no int, cells map<string,string>"

    def reader(self, schema) -> DataSourceReader:
        return _Sheets(self.options)


def read_bulk_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Documents of JSON files whose root is an array; those without id or sections are passed over."""
    reader = spark.read.option("multiLine", True)
    docs = (reader.schema(schema) if schema else reader).json(path)
    return docs.where(F.col("id").isNotNull() & F.col("sections").isNotNull())


def read_folder(spark: SparkSession, path: str, extensions: tuple[str, ...] = ("*",), sidecar: DataFrame | None = None, with_content: bool = False) -> DataFrame:
    """Files below a folder (or in an object store) with name, size and time; a sidecar's columns, by file name, win.

    Without `with_content` no file is opened: the column is pruned from the scan.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    out = files.select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("filename"), F.col("length").alias("n_bytes"), F.col("modificationTime").alias("modified_at"), *(["content"] if with_content else []))
    if "*" not in extensions:
        out = out.where(urls.extension(F.col("path")).isin(*[e.lower() for e in extensions]))
    return out if sidecar is None else out.join(sidecar, "filename", "left")


def read_jdbc(spark: SparkSession, url: str, table: str, columns: list[str], where: str | None = None, key: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 16) -> DataFrame:
    """A database table; columns and condition are pushed down, a numeric key splits the scan."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if key and bounds:
        reader = reader.option("partitionColumn", key).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", partitions)
    df = reader.load().select(*columns)
    return df.where(where) if where else df


_SOURCES: dict[str, Callable[..., DataFrame]] = {}


def source(name: str):
    """Registers a function (spark, **settings) -> DataFrame as a source under a name."""

    def take(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        _SOURCES[name.lower()] = f
        return f

    return take


def open_source(spark: SparkSession, name: str, **settings) -> DataFrame:
    try:
        return _SOURCES[name.lower()](spark, **settings)
    except KeyError:
        raise ValueError(f"no source {name!r}; there are {sorted(_SOURCES)}") from None


source("csv")(read_separated)
source("bulk_json")(read_bulk_json)
source("folder")(read_folder)
source("database")(read_jdbc)
