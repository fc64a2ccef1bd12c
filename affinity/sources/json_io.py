"""JSON-lines sources with declared schemas (no inference) and the signal projections.

A line that is no JSON object of the schema ends the read, unless a ``Quarantine`` is given: then bad
lines are stored with their file, counted, and left out, and only too many of them are an error.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PURCHASE_SCHEMA = T.StructType(
    [
        T.StructField("row_id", T.IntegerType()),
        T.StructField("movie_id", T.StringType()),
        T.StructField("movie_name", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("purchase_price", T.IntegerType()),
    ]
)

WISHLIST_SCHEMA = T.StructType(
    [
        T.StructField("row_id", T.IntegerType()),
        T.StructField("movie_id", T.StringType()),
        T.StructField("movie_name", T.StringType()),
        T.StructField("user_id", T.StringType()),
    ]
)

INVENTORY_SCHEMA = T.StructType(
    [
        T.StructField("genres", T.ArrayType(T.StringType())),
        T.StructField("movie_title", T.StringType()),
        T.StructField("stock", T.LongType()),
    ]
)

# Signal weights of the example job.
PURCHASE_WEIGHT = 1.0
WISHLIST_WEIGHT = 0.5


@dataclass(frozen=True)
class Quarantine:
    """Where bad lines go, and how many are too many.

    path        folder of the bad lines, one sub-folder a source (Parquet: file, line)
    max_lines   bad lines of a source that are still accepted
    max_share   bad lines of a source as a share of its lines that are still accepted
    Both bounds hold.
    """

    path: str
    max_lines: int = 1000
    max_share: float = 0.01


class TooManyBadLines(ValueError):
    """A source has more bad lines than its quarantine accepts; they are stored."""


_PARSED = "parsed"
_BAD = "bad_line"


def read_json_lines(
    spark: SparkSession, path: str, schema: T.StructType, quarantine: Quarantine | None = None, name: str = "lines"
) -> DataFrame:
    """A line that is no JSON object of the schema fails the read, rather than vanish later as
    a row of NULLs. Missing fields are NULL and unknown ones are ignored.

    With a ``quarantine`` the lines are read once to store and count the bad ones, under ``name``, before anything
    uses the good ones; blank lines are none. Bad are broken JSON, values of other types, and lines that
    hold something other than one object.
    """
    if quarantine is None:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    lines = parsed_lines(spark, path, schema)
    counts = Observation()
    total, bad = F.count(F.lit(1)).alias("total"), F.count_if(F.col(_BAD)).alias("bad")
    folder = f"{quarantine.path.rstrip('/')}/{name}"
    stored = lines.observe(counts, total, bad).where(_BAD).select("file", "line")
    stored.write.mode("overwrite").parquet(folder)
    found, of = counts.get["bad"], counts.get["total"]
    if found > quarantine.max_lines or found > quarantine.max_share * of:
        raise TooManyBadLines(f"{found} of {of} lines of {path} are bad; see {folder}")
    return lines.where(~F.col(_BAD)).select(*(F.col(_PARSED)[f].alias(f) for f in schema.names))


def parsed_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(file, line, parsed, bad_line) of every line that is not blank."""
    corrupt = "__corrupt"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    text = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    parsed = F.from_json("line", T.StructType([*schema, T.StructField(corrupt, T.StringType())]), options)
    is_object = F.ltrim("line").startswith("{")
    rows = text.where(F.trim("line") != "").withColumn(_PARSED, parsed)
    return rows.withColumn(_BAD, F.col(_PARSED).isNull() | F.col(_PARSED)[corrupt].isNotNull() | ~is_object)


def load_purchases(spark: SparkSession, path: str, quarantine: Quarantine | None = None) -> DataFrame:
    return read_json_lines(spark, path, PURCHASE_SCHEMA, quarantine, "purchases")


def load_wishlists(spark: SparkSession, path: str, quarantine: Quarantine | None = None) -> DataFrame:
    return read_json_lines(spark, path, WISHLIST_SCHEMA, quarantine, "wishlists")


def load_inventory(spark: SparkSession, path: str, quarantine: Quarantine | None = None) -> DataFrame:
    return read_json_lines(spark, path, INVENTORY_SCHEMA, quarantine, "inventory")


def purchase_signals(purchases: DataFrame, weight: float = PURCHASE_WEIGHT) -> DataFrame:
    return purchases.select(
        F.col("user_id").alias("user"), F.col("movie_name").alias("item"), F.lit(float(weight)).alias("weight")
    )


def wishlist_signals(wishlists: DataFrame, weight: float = WISHLIST_WEIGHT) -> DataFrame:
    return wishlists.select(
        F.col("user_id").alias("user"), F.col("movie_name").alias("item"), F.lit(float(weight)).alias("weight")
    )


def inventory_metadata(inventory: DataFrame) -> DataFrame:
    """(item = title, metadata_field = one genre per row) from the array column."""
    return inventory.select(
        F.col("movie_title").alias("item"), F.explode("genres").alias("metadata_field")
    )


def inventory_in_stock(inventory: DataFrame) -> DataFrame:
    """Distinct titles with stock > 0: the natural ``dest_items`` of the shipped data."""
    return inventory.where(F.col("stock") > 0).select(F.col("movie_title").alias("item")).distinct()
