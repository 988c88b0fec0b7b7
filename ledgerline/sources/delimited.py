"""Delimited text tables (read side; the writer is in ``sinks.tables``).

The plain form has one record per line: fields apart by ``|``, NULL as ``\\N``, and backslash escapes for a
backslash, a separator and line ends inside a field.  It splits like any text file, an empty text differs
from NULL, and files without escapes, as other tools write them, read as they are.  The quoted form is CSV.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Field separator, NULL mark, quote/escape character of the quoted form, and the NTZ
# timestamp layout (microseconds kept) of the quoted form.
DELIMITER = "|"
NULL_MARK = "\\N"
QUOTE = '"'
TIMESTAMP_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

CSV_OPTIONS = {
    "sep": DELIMITER,
    "quote": QUOTE,
    "escape": QUOTE,
    "header": "false",
    "timestampNTZFormat": TIMESTAMP_NTZ_FORMAT,
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

# While a line is read, these stand for an escaped backslash and an escaped separator.
_BACKSLASH, _SEPARATOR = "\x01", "\x02"
_ESCAPES = (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), (_BACKSLASH, "\\1"), (_SEPARATOR, "\\2"))


def _replace(col: Column, old: str, new: str) -> Column:
    return F.replace(col, F.lit(old), F.lit(new))


def escaped_line(schema: T.StructType, sep: str = DELIMITER) -> Column:
    """A record as one line of text."""
    def field(f: T.StructField) -> Column:
        text = F.col(f"`{f.name}`").cast("string")
        if isinstance(f.dataType, T.StringType):
            text = reduce(lambda c, e: _replace(c, *e), _ESCAPES, text)
            text = _replace(text, sep, "\\" + sep)
        return F.coalesce(text, F.lit(NULL_MARK))

    nested = [f.name for f in schema.fields if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))]
    if nested:
        raise ValueError(f"no text form for columns {nested}")
    return F.concat_ws(sep, *[field(f) for f in schema.fields])


def _read_plain(spark: SparkSession, path: str, schema: T.StructType, sep: str) -> DataFrame:
    line = _replace(_replace(F.col("value"), "\\\\", _BACKSLASH), "\\" + sep, _SEPARATOR)
    n = len(schema.fields)
    fields = F.split(line, "\\Q" + sep + "\\E", -1)
    wrong = F.raise_error(F.concat(F.lit(f"a line of {path} has not {n} fields: "), F.substring("value", 1, 200)))
    rows = spark.read.text(path, lineSep="\n").select("value", fields.alias("__fields"))
    rows = rows.select(F.when(F.size("__fields") == n, F.col("__fields")).otherwise(wrong.cast("array<string>")).alias("__fields"))

    def unescaped(piece: Column) -> Column:
        for plain, code in (("\n", "\\n"), ("\r", "\\r"), (_BACKSLASH, "\\1")):
            piece = _replace(piece, code, plain)
        return _replace(_replace(piece, _SEPARATOR, sep), "\\2", _SEPARATOR)

    def field(i: int, f: T.StructField) -> Column:
        raw = F.get("__fields", F.lit(i))
        text = F.array_join(F.transform(F.split(raw, _BACKSLASH, -1), unescaped), "\\")
        return F.when(raw != NULL_MARK, text.cast(f.dataType)).alias(f.name)

    return rows.select(*[field(i, f) for i, f in enumerate(schema.fields)])


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = DELIMITER, quoted: bool = False) -> DataFrame:
    """A delimited text table with an explicit schema (no inference); a line with another number of
    fields, or a field that is not of its type, fails the read.

    With ``quoted``, the CSV form: ``multiLine`` lets quoted fields hold newlines, so each file is one task.
    """
    if not quoted:
        return _read_plain(spark, path, schema, sep)
    return (
        spark.read.options(**{**CSV_OPTIONS, "sep": sep})
        .option("multiLine", "true")
        .option("mode", "FAILFAST")
        .schema(schema)
        .csv(path)
    )
