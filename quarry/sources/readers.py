"""Readers for the document and CSV inputs.

A declared schema is the default: it avoids the extra inference pass and
lets Spark read only the fields it needs.  A file of multi-line JSON is read
by one task, so large inputs should come as many bounded documents (each is held
as a whole) or as JSON lines (``multi_line=False``), which Spark splits freely.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import write_table
from quarry.sources import schemas

SchemaLike = T.StructType | str | None

#: Ends no record: a JSON text holds no raw control character.
_NO_LINE_END = "\x1e" * 8


def read_json(spark: SparkSession, path: str, schema: SchemaLike = None,
              multi_line: bool = True, sampling_ratio: float | None = None,
              timestamp_format: str | None = None) -> DataFrame:
    """JSON documents with an inferred (``schema=None``), coded or DDL schema.

    With ``multi_line`` a file is one document, read as one long line: Spark's own
    ``multiLine`` parses the open file and goes back to it for every number that
    the schema wants as text (measured: 105 times the bytes of 2.7 MB documents).
    """
    reader = spark.read.option("multiLine", multi_line)
    if timestamp_format:
        reader = reader.option("timestampFormat", timestamp_format)
    if schema is None:
        if sampling_ratio is not None:
            reader = reader.option("samplingRatio", sampling_ratio)
        if not multi_line:
            return reader.json(path)
        schema = reader.json(path).schema
    if multi_line:
        reader = reader.option("multiLine", False).option("lineSep", _NO_LINE_END)
    return reader.schema(schema).json(path)


def read_event_docs(spark: SparkSession, path: str, form: str = "structtype",
                    multi_line: bool = True, sampling_ratio: float | None = None) -> DataFrame:
    """The nested event document in one of the four schema forms.

    ``infer`` | ``structtype`` | ``ddl`` | ``dataclass``.  Use
    ``multi_line=False`` when each document is one line (JSON Lines): Spark
    splits files at line boundaries then.
    """
    if form == "infer":
        # inference is an extra pass over the input; sample it on big inputs
        return read_json(spark, path, None, multi_line=multi_line, sampling_ratio=sampling_ratio)
    if form == "structtype":
        return read_json(spark, path, schemas.EVENT_DOC_SCHEMA, multi_line=multi_line)
    if form == "ddl":
        return read_json(spark, path, schemas.EVENT_DOC_DDL, multi_line=multi_line)
    if form == "dataclass":
        return read_json(spark, path, schemas.schema_of(schemas.EventsAgg), multi_line=multi_line)
    raise ValueError(f"unknown schema form {form!r}")


def read_series_docs(spark: SparkSession, path: str, multi_line: bool = False,
                     timestamp_format: str | None = None) -> DataFrame:
    return read_json(spark, path, schemas.SERIES_DOC_SCHEMA, multi_line=multi_line,
                     timestamp_format=timestamp_format)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str,
             header: bool = True, sep: str = ",") -> DataFrame:
    return (spark.read.schema(schema)
            .option("header", header).option("sep", sep)
            .csv(path))


#: Holds the text of a record that did not fit the schema.
CORRUPT = "_corrupt"


@dataclasses.dataclass
class Checked:
    """Records read permissively, in one table with ``_file`` (where it stood),
    ``_corrupt`` (its text, unless it is good) and ``_kind``:

    * ``good``: fits the schema;
    * ``bad_field``: well-formed, but fields do not fit: they are null, the others hold;
    * ``broken``: no record at all; every field is null.
    """
    table: DataFrame

    def _fields(self) -> list[str]:
        return [f"`{c}`" for c in self.table.columns if c not in (CORRUPT, "_file", "_kind")]

    def good(self) -> DataFrame:
        return self.table.where("_kind = 'good'").select(*self._fields())

    def surviving(self) -> DataFrame:
        """Every record that is one, with null for the fields that did not fit."""
        return self.table.where("_kind <> 'broken'").select(*self._fields())

    def rejects(self) -> DataFrame:
        """(file, kind, raw) of all that is not good."""
        return self.table.where("_kind <> 'good'").select(
            F.col("_file").alias("file"), F.col("_kind").alias("kind"), F.col(CORRUPT).alias("raw"))

    def counts(self) -> DataFrame:
        return self.table.groupBy(F.col("_kind").alias("kind")).agg(F.count("*").alias("n"))


def _checked(rows: DataFrame, well_formed) -> Checked:
    bad = F.col(CORRUPT).isNotNull()
    kind = F.when(~bad, "good").when(well_formed, "bad_field").otherwise("broken")
    # written once: every view reads the same parse, and Spark refuses queries of the corrupt column alone
    return Checked(write_table(rows.select("*", F.col("_metadata.file_path").alias("_file"), kind.alias("_kind")), "checked"))


def _with_corrupt(schema: T.StructType | str) -> T.StructType:
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    return T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])


def read_json_checked(spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False,
                      **options) -> Checked:
    """JSON records of which some may be corrupt; none stops the read and none is lost."""
    rows = (spark.read.schema(_with_corrupt(schema)).option("mode", "PERMISSIVE").option("multiLine", multi_line)
            .option("columnNameOfCorruptRecord", CORRUPT).options(**options).json(path))
    return _checked(rows, F.try_parse_json(CORRUPT).isNotNull())


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True,
                     sep: str = ",", **options) -> Checked:
    """CSV records of which some may be corrupt: ``broken`` ones have too few or too many fields."""
    fields = _with_corrupt(schema)
    rows = (spark.read.schema(fields).option("mode", "PERMISSIVE").option("header", header).option("sep", sep)
            .option("columnNameOfCorruptRecord", CORRUPT).options(**options).csv(path))
    names = [f.name for f in fields][:-1]
    as_text = ", ".join(f"`{n}` STRING" for n in names) + ", _more STRING"
    # as text every field fits, so only a missing or a further one is null
    text = F.from_csv(F.col(CORRUPT), F.lit(as_text), {"sep": sep, "nullValue": "\u0000"})
    whole = F.col("_text._more").isNull() & F.lit(True)
    for n in names:
        whole = whole & F.col(f"_text.`{n}`").isNotNull()
    checked = _checked(rows.withColumn("_text", text), whole)
    return Checked(checked.table.drop("_text"))
