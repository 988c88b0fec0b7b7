"""Payload codec: value bytes <-> typed columns, with bad records flagged.

JSON uses ``from_json`` / ``to_json``; Avro uses Spark's ``from_avro`` /
``to_avro``, which need the spark-avro package on the classpath.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT_COL = "__corrupt"
BAD_COL = "is_bad"


class MissingConnectorError(RuntimeError):
    """A Spark package (Kafka, Avro) needed for this call is not on the classpath."""


def _avro_functions():
    try:
        from pyspark.sql.avro import functions as avro
    except ImportError as exc:  # pragma: no cover - shipped with pyspark
        raise MissingConnectorError("pyspark.sql.avro is not importable") from exc
    return avro


# Avro's names of the record types that payloads use.
AVRO_TYPES = {
    "int": "int", "bigint": "long", "smallint": "int", "tinyint": "int", "double": "double", "float": "float",
    "string": "string", "boolean": "boolean", "binary": "bytes",
}


def avro_schema_of(schema: T.StructType, name: str = "record") -> str:
    """A flat Avro record schema (JSON text) of ``schema``; every field may be null."""
    unknown = [f.name for f in schema.fields if f.dataType.simpleString() not in AVRO_TYPES]
    if unknown:
        raise ValueError(f"no Avro type for fields {unknown}; give avro_schema")
    fields = [{"name": f.name, "type": ["null", AVRO_TYPES[f.dataType.simpleString()]], "default": None} for f in schema.fields]
    return json.dumps({"type": "record", "name": name, "fields": fields})


def connector_checked(build, fmt: str):
    """Build a projection; map Spark's "Avro not loaded" error to ours."""
    try:
        return build()
    except Exception as exc:
        if fmt == "avro" and "AVRO_NOT_LOADED" in str(exc):
            raise MissingConnectorError("Avro payloads need the spark-avro package (spark.jars.packages)") from exc
        raise


def decode_column(value: Column, schema: T.StructType, fmt: str = "json", avro_schema: str | None = None) -> Column:
    """A struct column: the decoded fields plus ``__corrupt`` (raw text of bad JSON)."""
    if fmt == "json":
        with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT_COL, T.StringType(), True)])
        return F.from_json(
            value.cast("string"),
            with_corrupt,
            {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL},
        )
    if fmt == "avro":
        return _avro_functions().from_avro(value, avro_schema or avro_schema_of(schema), {"mode": "PERMISSIVE"})
    raise ValueError(f"unknown payload format {fmt!r}")


def decode_payload(
    df: DataFrame,
    schema: T.StructType,
    fmt: str = "json",
    value_col: str = "value",
    keep: list[str] | tuple[str, ...] = (),
    avro_schema: str | None = None,
    required: list[str] | tuple[str, ...] = (),
) -> DataFrame:
    """Decode ``value_col`` into the columns of ``schema``.

    Returns ``keep`` columns, the decoded columns, and ``is_bad``: true when the payload is missing,
    empty or blank, does not parse, holds anything after its record, has no field of the schema, or
    lacks one of ``required``.  No row is dropped; a bad one has no fields.  ``avro_schema`` is the writer's schema (default:
    derived from ``schema``).
    """
    value = F.col(value_col)
    if fmt == "json":  # one parse: the record as the only element of an array, nothing before or after it
        text = F.concat(F.lit('{"__r":['), value.cast("string"), F.lit("]}"))
        wrapped = T.StructType([T.StructField("__r", T.ArrayType(schema)), T.StructField(CORRUPT_COL, T.StringType(), True)])
        parsed = F.from_json(text, wrapped, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL})
    else:
        parsed = decode_column(value, schema, fmt, avro_schema)
    # Parse once.  Filters on the result (e.g. NOT is_bad) would otherwise be
    # pushed below the projection with the parse inlined into them, running
    # it two or three times per row; a one-row ``inline`` is a Generate node
    # that predicates referencing its output cannot cross.
    once = F.struct(value.isNull().alias("__missing"), parsed.alias("__p"))
    staged = connector_checked(lambda: df.select(*keep, F.inline(F.array(once))), fmt)
    record = F.get("__p.__r", 0) if fmt == "json" else F.col("__p")
    bad = F.col("__missing")
    if fmt == "json":
        bad = bad | F.col(f"__p.{CORRUPT_COL}").isNotNull() | (F.coalesce(F.size("__p.__r"), F.lit(0)) != 1)
    fields = {f.name: record[f.name] for f in schema.fields}
    bad = bad | reduce(lambda a, b: a & b, [c.isNull() for c in fields.values()], F.lit(True))
    bad = reduce(lambda a, b: a | b, [fields[c].isNull() for c in required], bad)
    flagged = staged.select(*keep, "__p", bad.alias(BAD_COL))
    return flagged.select(*keep, *[F.when(~F.col(BAD_COL), c).alias(n) for n, c in fields.items()], BAD_COL)


def encode_column(cols: list[str], fmt: str = "json", avro_schema: str | None = None) -> Column:
    record = F.struct(*[F.col(c) for c in cols])
    if fmt == "json":
        return F.to_json(record).cast("binary")
    if fmt == "avro":
        avro = _avro_functions()
        return avro.to_avro(record, avro_schema) if avro_schema else avro.to_avro(record)
    raise ValueError(f"unknown payload format {fmt!r}")


def encode_payload(
    df: DataFrame,
    cols: list[str],
    fmt: str = "json",
    keep: list[str] | tuple[str, ...] = (),
    out_col: str = "value",
    avro_schema: str | None = None,
) -> DataFrame:
    """Encode ``cols`` into one bytes column ``out_col``; ``keep`` columns pass through."""
    return connector_checked(lambda: df.select(*keep, encode_column(cols, fmt, avro_schema).alias(out_col)), fmt)
