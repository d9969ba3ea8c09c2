"""Input schemas, in the three declared forms (code, DDL text, class).

Fixed values: the field names and types below are the input formats that the
analytics must read, so they are stated exactly as the documents carry them.
"""

from __future__ import annotations

import dataclasses
import datetime as _dt
import typing

from pyspark.sql import types as T

# --- fixed values: nested event document, in three forms --------------------
# description, events[ categories[ id, title ], closed, description,
#   geometry[ coordinates[string], date, magnitudeUnit, magnitudeValue, type ],
#   id, link, sources[ id, url ], title ], link, title
# The class form has no Event.description, a FLOAT magnitude and numeric
# coordinates (polygon coordinates then read as NULL).

EVENT_DOC_SCHEMA = T.StructType([
    T.StructField("description", T.StringType()),
    T.StructField("events", T.ArrayType(T.StructType([
        T.StructField("categories", T.ArrayType(T.StructType([
            T.StructField("id", T.StringType()),
            T.StructField("title", T.StringType()),
        ]))),
        T.StructField("closed", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("geometry", T.ArrayType(T.StructType([
            T.StructField("coordinates", T.ArrayType(T.StringType())),
            T.StructField("date", T.DateType()),
            T.StructField("magnitudeUnit", T.StringType()),
            T.StructField("magnitudeValue", T.DoubleType()),
            T.StructField("type", T.StringType()),
        ]))),
        T.StructField("id", T.StringType()),
        T.StructField("link", T.StringType()),
        T.StructField("sources", T.ArrayType(T.StructType([
            T.StructField("id", T.StringType()),
            T.StructField("url", T.StringType()),
        ]))),
        T.StructField("title", T.StringType()),
    ]))),
    T.StructField("link", T.StringType()),
    T.StructField("title", T.StringType()),
])

EVENT_DOC_DDL = (
    "description STRING, "
    "events ARRAY<STRUCT<categories: ARRAY<STRUCT<id: STRING, title: STRING>>, closed: STRING, "
    "description: STRING, geometry: ARRAY<STRUCT<coordinates: ARRAY<STRING>, date: DATE, "
    "magnitudeUnit: STRING, magnitudeValue: DOUBLE, type: STRING>>, id: STRING, link: STRING, "
    "sources: ARRAY<STRUCT<id: STRING, url: STRING>>, title: STRING>>, "
    "link STRING, title STRING"
)


@dataclasses.dataclass
class Category:
    id: str
    title: str


@dataclasses.dataclass
class Source:
    id: str
    url: str


@dataclasses.dataclass
class Geometry:
    magnitudeValue: T.FloatType
    magnitudeUnit: str
    date: _dt.date
    type: str
    coordinates: list[float]


@dataclasses.dataclass
class Event:
    id: str
    title: str
    link: str
    closed: str
    categories: list[Category]
    sources: list[Source]
    geometry: list[Geometry]


@dataclasses.dataclass
class EventsAgg:
    title: str
    description: str
    link: str
    events: list[Event]

# --- end of fixed values -----------------------------------------------------


_PY_TYPES = {
    str: T.StringType(),
    int: T.LongType(),
    float: T.DoubleType(),
    bool: T.BooleanType(),
    bytes: T.BinaryType(),
    _dt.date: T.DateType(),
    _dt.datetime: T.TimestampType(),
}


def _spark_type(tp) -> T.DataType:
    if isinstance(tp, T.DataType):
        return tp
    if isinstance(tp, type) and issubclass(tp, T.DataType):
        return tp()
    if dataclasses.is_dataclass(tp):
        return schema_of(tp)
    origin = typing.get_origin(tp)
    args = typing.get_args(tp)
    if origin in (list, tuple, typing.Sequence) and args:
        return T.ArrayType(_spark_type(args[0]))
    if origin is dict and len(args) == 2:
        return T.MapType(_spark_type(args[0]), _spark_type(args[1]))
    if origin is typing.Union:
        inner = [a for a in args if a is not type(None)]
        if len(inner) == 1:
            return _spark_type(inner[0])
    if tp in _PY_TYPES:
        return _PY_TYPES[tp]
    raise TypeError(f"no Spark type for {tp!r}")


def schema_of(cls) -> T.StructType:
    """Derive a (nullable) StructType from a dataclass, recursively.

    Field order is declaration order.  A field annotated with a Spark type
    class (e.g. ``T.FloatType``) keeps that exact type.
    """
    hints = typing.get_type_hints(cls)
    return T.StructType([
        T.StructField(f.name, _spark_type(hints[f.name]), True)
        for f in dataclasses.fields(cls)
    ])


# --- fixed values: time-series document -------------------------------------
SERIES_DOC_SCHEMA = T.StructType([
    T.StructField("COD", T.StringType()),
    T.StructField("Nombre", T.StringType()),
    T.StructField("T3_Unidad", T.StringType()),
    T.StructField("T3_Escala", T.StringType()),
    T.StructField("MetaData", T.ArrayType(T.StructType([
        T.StructField("Id", T.IntegerType()),
        T.StructField("Variable", T.StructType([
            T.StructField("Id", T.IntegerType()),
            T.StructField("Nombre", T.StringType()),
            T.StructField("Codigo", T.StringType()),
        ])),
        T.StructField("Nombre", T.StringType()),
        T.StructField("Codigo", T.StringType()),
    ]))),
    T.StructField("Data", T.ArrayType(T.StructType([
        T.StructField("Fecha", T.TimestampType()),
        T.StructField("T3_TipoDato", T.StringType()),
        T.StructField("T3_Periodo", T.StringType()),
        T.StructField("Anyo", T.ShortType()),
        T.StructField("Valor", T.FloatType()),
    ]))),
])

# --- fixed values: daily prices CSV (header, comma) -------------------------
PRICES_CSV_SCHEMA = T.StructType([
    T.StructField("Date", T.DateType()),
    T.StructField("Open", T.FloatType()),
    T.StructField("High", T.FloatType()),
    T.StructField("Low", T.FloatType()),
    T.StructField("Close", T.FloatType()),
    T.StructField("Volume", T.IntegerType()),
    T.StructField("Name", T.StringType()),
])

# --- fixed values: satellite telemetry CSV (header, comma) ------------------
TELEMETRY_CSV_SCHEMA = T.StructType([
    T.StructField("Name", T.StringType()),
    T.StructField("Timestamp", T.IntegerType()),
    T.StructField("FloatValue", T.FloatType()),
    T.StructField("IntegerValue", T.IntegerType()),
    T.StructField("Parameter", T.StringType()),
    T.StructField("Satellite", T.StringType()),
    T.StructField("ShortDesc", T.StringType()),
    T.StructField("Units", T.StringType()),
])

# --- fixed values: polled datapoint rows ------------------------------------

# Wire form of one payload: [{"<yyyy-MM-dd'T'HH:mm:ss>": <integer>}, ...]
PAYLOAD_WIRE_TYPE = "array<map<string,bigint>>"
PAYLOAD_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def prune(schema: T.StructType, paths: list[str]) -> T.StructType:
    """Keep only the dotted ``paths`` (arrays are walked through).

    JSON is row text: Spark cannot prune nested fields of arrays for it, so
    a job that needs four leaves of a wide document passes this narrow schema
    and the parser skips everything else.
    """
    tree: dict = {}
    for path in paths:
        node = tree
        for part in path.split("."):
            node = node.setdefault(part, {})

    def walk(dt: T.DataType, node: dict) -> T.DataType:
        if not node:
            return dt
        if isinstance(dt, T.ArrayType):
            return T.ArrayType(walk(dt.elementType, node), dt.containsNull)
        if isinstance(dt, T.StructType):
            missing = set(node) - set(dt.fieldNames())
            if missing:
                raise ValueError(f"no field(s) {sorted(missing)} in {dt.simpleString()}")
            return T.StructType([T.StructField(f.name, walk(f.dataType, node[f.name]), f.nullable)
                                 for f in dt.fields if f.name in node])
        raise ValueError(f"cannot select inside {dt.simpleString()}")

    return walk(schema, tree)
