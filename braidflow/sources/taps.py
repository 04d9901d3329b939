"""Taps: where a flow reads and writes, by format, with sink modes, numbers of parts and traps for unreadable records."""

from __future__ import annotations

import posixpath
import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from enum import Enum

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, _parse_datatype_string

from braidflow.fields import FieldError, col, distinct, typed
from braidflow.operators.traps import Trapped
from braidflow.plans.config import Config, Layer


class SinkMode(Enum):
    """What a sink does with what is there: fail, delete it before the flow starts, or add to it."""

    KEEP = "errorifexists"
    REPLACE = "overwrite"
    UPDATE = "append"


@dataclass(frozen=True)
class Tap:
    """A location on any file system that Spark knows, in one of Spark's formats, with its options.

    ``source`` is a class of the user's own that Spark reads and writes by (a Python data source); ``format`` is then its
    name. ``layer`` has settings that hold while this tap is read or written in a flow.
    """

    path: str
    format: str = "parquet"
    options: dict = field(default_factory=dict)
    schema: str | StructType | None = None
    mode: SinkMode = SinkMode.KEEP
    parts: int | None = None
    partition_by: Sequence[str] = ()
    max_records_per_file: int = 0
    source: type | None = None
    layer: Layer | None = None

    def _format(self, spark: SparkSession) -> str:
        if self.source is None:
            return self.format
        spark.dataSource.register(self.source)
        return self.source.name()

    def read(self, spark: SparkSession) -> DataFrame:
        reader = spark.read.format(self._format(spark)).options(**self.options)
        if self.schema is not None:
            reader = reader.schema(self.schema)
        return reader.load(self.path)

    def stream(self, spark: SparkSession) -> DataFrame:
        """The location as an unbounded source of files."""
        if self.schema is None:
            raise FieldError("a streamed source needs a schema")
        return spark.readStream.format(self._format(spark)).options(**self.options).schema(self.schema).load(self.path)

    def prepared(self, df: DataFrame) -> DataFrame:
        """The rows dealt into as many parts as asked for, so that what comes before keeps its own number of tasks."""
        if self.parts is None:
            return df
        if self.parts < 1:
            raise FieldError(f"{self.parts} parts")
        return df.repartition(self.parts)

    def write(self, df: DataFrame, *, ordered: bool = False) -> None:
        """Write the rows. ``ordered``: they come in the order to be kept, so their parts are left as they are."""
        writer = (df if ordered else self.prepared(df)).write.format(self._format(df.sparkSession)).options(**self.options).mode(self.mode.value)
        if self.max_records_per_file:
            writer = writer.option("maxRecordsPerFile", self.max_records_per_file)
        (writer.partitionBy(*self.partition_by) if self.partition_by else writer).save(self.path)

    def place(self, spark: SparkSession | None = None) -> str:
        """Where this is, written one way: without a slash at the end, up to the first wildcard, and with a session as a
        full address of its file system."""
        plain = re.split(r"/[^/]*[*?\[{]", self.path)[0].rstrip("/") or "/"
        if spark is not None:
            path = spark._jvm.org.apache.hadoop.fs.Path(plain)
            return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/")
        scheme, _, rest = plain.rpartition("://")
        rest = posixpath.normpath(rest.removeprefix("file:"))
        return rest if scheme in ("", "file") else f"{scheme}://{rest}"

    def _hadoop(self, spark: SparkSession):
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(spark._jsc.hadoopConfiguration()), path

    def exists(self, spark: SparkSession) -> bool:
        files, path = self._hadoop(spark)
        return files.exists(path)

    def delete(self, spark: SparkSession) -> bool:
        files, path = self._hadoop(spark)
        return files.delete(path, True)

    def statistics(self, spark: SparkSession) -> dict[str, int]:
        """Bytes, files and the latest change, in milliseconds, without reading a row."""
        files, path = self._hadoop(spark)
        if not files.exists(path):
            return {"bytes": 0, "files": 0, "modified": 0}
        summary = files.getContentSummary(path)
        return {"bytes": summary.getLength(), "files": summary.getFileCount(), "modified": files.getFileStatus(path).getModificationTime()}


def parquet(path: str, **options) -> Tap:
    return Tap(path, "parquet", **options)


def orc(path: str, **options) -> Tap:
    return Tap(path, "orc", **options)


@dataclass(frozen=True)
class TextLine(Tap):
    """Lines of text as one field; written from ``source_fields``, joined by tabs."""

    format: str = "text"
    name: str = "line"
    source_fields: Sequence[str] | None = None

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.format("text").options(**self.options).load(self.path).select(F.col("value").alias(self.name))

    def write(self, df: DataFrame, *, ordered: bool = False) -> None:
        names = self.source_fields or df.columns
        line = F.concat_ws("\t", *[F.coalesce(col(c).cast("string"), F.lit("")) for c in names]).alias("value")
        super().write(df.select(line), ordered=ordered)


@dataclass(frozen=True)
class TextDelimited(Tap):
    """Delimited text: fields by schema, by header with a type for each name, or inferred.

    ``resolver`` maps names from the header to types; unknown names stay text. ``skip_header`` and ``write_header`` are
    for the two directions. A record that does not parse is null in its fields; ``read_trapped`` puts it aside.
    """

    format: str = "csv"
    delimiter: str = ","
    quote: str = '"'
    skip_header: bool = False
    write_header: bool = False
    resolver: dict | None = None
    null_value: str = ""

    def _options(self, header: bool) -> dict:
        return {"sep": self.delimiter, "quote": self.quote, "escape": self.quote, "header": str(header).lower(), "nullValue": self.null_value, **self.options}

    def read(self, spark: SparkSession) -> DataFrame:
        reader = spark.read.options(**self._options(self.skip_header or self.resolver is not None))
        if self.schema is not None:
            return reader.schema(self.schema).csv(self.path)
        df = reader.option("inferSchema", str(self.resolver is None).lower()).csv(self.path)
        return typed(df, **{c: k for c, k in self.resolver.items() if c in df.columns}) if self.resolver else df

    def read_trapped(self, spark: SparkSession, reason: str = "trap_record") -> Trapped:
        """The records that fit the schema, and those that do not: their text beside the fields that could be read."""
        if self.schema is None:
            raise FieldError("a trap needs a schema to hold records against")
        schema = _parse_datatype_string(self.schema) if isinstance(self.schema, str) else self.schema
        wide = StructType([*schema.fields, StructField(reason, StringType())])
        both = spark.read.options(**self._options(self.skip_header)).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", reason).schema(wide).csv(self.path)
        # Spark refuses to read a record's text alone, so that depends on a field, of which it takes nothing.
        beside = F.substring(F.coalesce(col(schema.fields[0].name).cast("string"), F.lit("")), 1, 0)
        bad = both.withColumn(reason, F.concat(col(reason), beside))
        return Trapped(both.where(col(reason).isNull()).drop(reason), bad.where(col(reason).isNotNull()))

    def write(self, df: DataFrame, *, ordered: bool = False) -> None:
        writer = (df if ordered else self.prepared(df)).write.options(**self._options(self.write_header)).mode(self.mode.value)
        (writer.partitionBy(*self.partition_by) if self.partition_by else writer).csv(self.path)


@dataclass(frozen=True)
class Partitioned(Tap):
    """A folder for each value of ``partition_by``, fields or ``expressions`` (SQL by name, which become fields of the folders).

    Rows are dealt by those first; ``spread`` cuts each value's rows over that many tasks, by a hash of the row, for values
    that hold much of the data. A task that has rows of many values all the same holds up to ``open_files`` files open
    and sorts its rows beyond that.
    """

    spread: int = 1
    expressions: dict = field(default_factory=dict)
    open_files: int = 0

    def prepared(self, df: DataFrame) -> DataFrame:
        if not self.partition_by:
            raise FieldError("no fields to partition by")
        distinct([*df.columns, *self.expressions])
        df = df.withColumns({n: F.expr(e) if isinstance(e, str) else e for n, e in self.expressions.items()})
        by: list[Column] = list(map(col, self.partition_by))
        if self.spread > 1:
            hashed = [col(f.name) for f in df.schema if "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]
            by.append(F.pmod(F.xxhash64(*hashed), F.lit(self.spread)))
        return df.repartition(*by)

    def write(self, df: DataFrame, *, ordered: bool = False) -> None:
        limit = Config({"spark.sql.maxConcurrentOutputFileWriters": str(self.open_files)}) if self.open_files else Config()
        with limit.held(df.sparkSession):
            super().write(df, ordered=ordered)
