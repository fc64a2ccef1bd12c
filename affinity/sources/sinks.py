"""Sinks: tab-delimited text (the reference's default store) and Parquet.

Writes always replace the target. The old output stays until the new one is complete
(``affinity.resume.replace_outputs``), so a failed write changes nothing.

Text keeps every value: a row is a line of tab-separated fields; in a field a backslash is
written ``\\b``, a tab ``\\t``, a line feed ``\\n`` and a carriage return ``\\r``, and NULL is
``\\N``. Nothing is trimmed or quoted. Reading fails on a line with another number of fields
and on a value that is not of the declared type.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinity.resume import replace_outputs

# Fixed values of the text format. Encoding goes down the list, decoding up.
ESCAPES = (("\\", "\\b"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"))
NULL = "\\N"


def _replace(c: Column, pairs) -> Column:
    return reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), pairs, c)


def _replace_output(df: DataFrame, path: str, write) -> None:
    base, _, name = path.rstrip("/").rpartition("/")
    replace_outputs(df.sparkSession, base, {name: lambda p: write(df, p)})


def store_text(df: DataFrame, path: str) -> None:
    _replace_output(df, path, write_text)


def store_parquet(df: DataFrame, path: str) -> None:
    _replace_output(df, path, write_parquet)


def write_text(df: DataFrame, path: str) -> None:
    fields = [F.coalesce(_replace(F.col(f"`{c}`").cast("string"), ESCAPES), F.lit(NULL)) for c in df.columns]
    df.select(F.concat_ws("\t", *fields).alias("value")).write.mode("overwrite").text(path, lineSep="\n")


def load_text(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    fields = F.split("value", "\t", -1)
    n = F.size(fields)
    wrong = F.raise_error(F.concat(F.lit(f"{path}: expected {len(schema)} fields, found "), n.cast("string")))
    lines = spark.read.text(path, lineSep="\n").select(
        F.when(n == len(schema), fields).otherwise(wrong.cast("array<string>")).alias("f")
    )

    def value(i: int, field: T.StructField) -> Column:
        raw = F.get("f", F.lit(i))
        text = F.when(raw != NULL, _replace(raw, [(b, a) for a, b in reversed(ESCAPES)]))
        typed = text if field.dataType == T.StringType() else text.try_cast(field.dataType)
        bad = F.raise_error(F.concat(F.lit(f"{path}: {field.name} is no {field.dataType.simpleString()}: "), text))
        checked = F.when(text.isNotNull() & typed.isNull(), bad.cast(field.dataType)).otherwise(typed)
        return checked.alias(field.name)

    return lines.select(*(value(i, f) for i, f in enumerate(schema)))


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
