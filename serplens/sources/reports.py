"""CSV reports, JSON rows and the import of keyed metadata files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from serplens import schemas
from serplens.sources import splits

#: Line breaks and U+0000 in a text and how they are written, the escape character first.
_ESCAPES = (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\0", "\\0"))
#: Spaces around a text are part of it.
_AS_IS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
#: What no text reads as: an unquoted empty field takes this value and becomes null.
_NULL = "\0null\0"


def with_report_headers(df: DataFrame) -> DataFrame:
    """Columns renamed to the headers of the published reports."""
    grain = "query" if "query" in df.columns else "page"
    headers = schemas.REPORT_HEADERS | {"position": schemas.POSITION_HEADERS[grain]}
    return df.withColumnsRenamed({c: headers[c] for c in df.columns if c in headers})


def without_report_headers(schema: T.StructType) -> T.StructType:
    """``schema`` under the published headers, in order, for reading a report back."""
    grain = "query" if "query" in schema.names else "page"
    headers = schemas.REPORT_HEADERS | {"position": schemas.POSITION_HEADERS[grain]}
    return T.StructType([
        T.StructField(headers.get(f.name, f.name), f.dataType) for f in schema.fields
    ])


def _escaped(value: Column) -> Column:
    for plain, written in _ESCAPES:
        value = F.replace(value, F.lit(plain), F.lit(written))
    return value


def _unescaped(value: Column) -> Column:
    """Undo ``_escaped``: doubled escape characters part the text, what is between them holds no others."""
    (backslash, _), *others = _ESCAPES

    def piece(part: Column) -> Column:
        for plain, written in others:
            part = F.replace(part, F.lit(written), F.lit(plain))
        return part

    return F.array_join(F.transform(F.split(value, r"\\\\", -1), piece), backslash)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header and doubled quotes, one part file per partition.

    Line breaks inside texts are written as ``\\n`` and ``\\r``, a backslash as
    two, so that a record is a line and large files can be split.
    """
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    df.select(*(_escaped(F.col(c)).alias(c) if c in texts else F.col(c) for c in df.columns)) \
        .write.mode(mode).options(header=True, escape='"', **_AS_IS).csv(path)


def _integer(text: Column, name: str) -> Column:
    """Exact value of an integer written as ``12`` or ``12.0``; anything else fails the job."""
    decimal = text.try_cast("decimal(38,10)")
    exact = F.coalesce(text.try_cast("bigint"), F.when(decimal == F.floor(decimal), decimal.try_cast("bigint")))
    wrong = F.raise_error(F.concat(F.lit(f"{name} is no integer: "), text))
    return F.when((text.isNull()) | (text == ""), None).when(exact.isNull(), wrong).otherwise(exact)


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             multi_line: bool = False, escaped: bool = True) -> DataFrame:
    """CSV with a header, a byte-order mark or not; empty text stays text.

    ``null`` and ``NA`` are ordinary text. Integers are read exactly and may be
    written as ``12.0``; a malformed one raises. For files of other tools:
    ``multi_line`` reads quoted line breaks, at the price of writing the lines once
    more, and ``escaped=False`` takes backslashes as they are.
    """
    integral = [f.name for f in schema.fields if isinstance(f.dataType, T.LongType)]
    as_written = T.StructType([
        T.StructField(f.name, T.StringType() if f.name in integral else f.dataType)
        for f in schema.fields
    ])
    options = {"escape": '"', "nullValue": _NULL, "emptyValue": ""} | _AS_IS
    if multi_line:
        record = F.regexp_replace("value", r"\r\z", "")
        df = splits.csv_records(spark, path).where("record > 1").select(record.alias("value")).where("value != ''") \
            .select(F.from_csv("value", as_written.toDDL(), options | {"multiLine": "true", "lineSep": "\n"}).alias("v")).select("v.*")
    else:
        df = spark.read.schema(as_written).options(header=True, **options).csv(path)

    def value(f: T.StructField) -> Column:
        if f.name in integral:
            return _integer(F.col(f.name), f.name)
        return _unescaped(F.col(f.name)) if escaped and isinstance(f.dataType, T.StringType) else F.col(f.name)

    return df.select(*(value(f).alias(f.name) for f in schema.fields))


def write_rows(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON Lines, one object per row; NULL fields stay visible."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def read_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def import_keyed_json(spark: SparkSession, path: str, values: T.StructType, indented: bool = True) -> DataFrame:
    """Rows of a ``{path: {...}}`` file, keyed by ``path``.

    Such files are written with an indent of two, and a JSON text holds no raw
    line break: so the end of an entry, with its comma, separates records, and a
    file of any size is split between tasks. ``indented=False`` reads files of any
    layout, without line breaks too, by their brackets. A record that is no JSON
    fails the job.
    """
    strict = {"mode": "FAILFAST"}
    if indented:
        record = F.col("value")
        opened = record.startswith("{")
        closed = record.rlike(r"\n\}\s*$") | (opened & ~record.startswith("{\n"))
        whole = F.concat(F.when(opened, "").otherwise("{"), record, F.when(closed, "").otherwise("}}"))
        records = spark.read.option("lineSep", "\n  },\n").text(path).where(F.trim("value") != "")
    else:
        whole = F.concat(F.lit("{"), "value", F.lit("}"))
        records = splits.json_entries(spark, path)
    entries = records.select(F.explode(F.from_json(whole, "map<string,string>", strict)).alias("path", "value"))
    return entries.select("path", F.from_json("value", values, strict).alias("v")).select("path", "v.*")
