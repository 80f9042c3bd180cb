"""CSV and text files, and constant rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone import schemas

CORRUPT = "_corrupt_record"


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    """A CSV file with a header, typed by ``schema``; nothing is inferred.

    Fields are matched by position after the header; a value that does not fit
    its type becomes NULL and the line is kept in ``_corrupt_record``. An empty
    field is NULL, a quoted empty field the empty text. With ``multi_line``, quoted
    fields may hold line breaks; a file is then read by one task.
    """
    loose = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(loose)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", "\u0000")
        .csv(path)
    )


def write_csv(df: DataFrame, path: str, multi_line: bool = False) -> None:
    """CSV with a header and no index column; text is kept as it is.

    A line break in a text can only be read back with ``multi_line``; without
    it, such a text stops the write.
    """
    if not multi_line:
        df = df.withColumns(
            {
                f.name: F.when(
                    F.col(f.name).rlike(r"[\r\n]"),
                    F.raise_error(F.lit(f"a line break in {f.name} needs multi_line")).cast("string"),
                ).otherwise(F.col(f.name))
                for f in df.schema.fields
                if isinstance(f.dataType, T.StringType)
            }
        )
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def stage_skins(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return _staged(read_csv(spark, path, schemas.STG_SKINS, multi_line))


def stage_players(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return _staged(read_csv(spark, path, schemas.STG_PLAYERS, multi_line))


def stage_sales(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return _staged(read_csv(spark, path, schemas.STG_SALES, multi_line))


def _staged(df: DataFrame) -> DataFrame:
    return df.withColumn("loaded_at", F.current_timestamp())


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: its path as ``doc_id`` and its whole text."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("doc_id"), F.col("value").alias("text")
    )


def read_in_pieces(spark: SparkSession, path: str, end: str, starts: str) -> DataFrame:
    """(doc_id, piece, text): documents cut at places that no match of a pattern crosses.

    A file of any size is read by many tasks: ``end`` separates its records, as a
    line break would. A record begins a piece if its beginning matches ``starts``;
    others are joined to the piece before, across tasks if need be. Piece numbers
    ascend in the order of the text. Put together, the pieces are the document,
    whose path is ``doc_id``. Files are UTF-8; a task holds its part of a file and
    no more, and a piece is one row.
    """
    records = spark.read.option("lineSep", end).text(path).select(
        F.col("_metadata.file_path").alias("doc_id"),
        F.col("_metadata.file_size").alias("_size"),
        F.col("_metadata.file_block_start").alias("_part"),
        F.monotonically_increasing_id().alias("_place"),  # in order of the text within a part
        F.col("value").alias("_record"),
    )
    inside = Window.partitionBy("doc_id", "_part")
    counted = (
        records.withColumn("_starts", F.col("_record").rlike(starts).cast("long"))
        .withColumn("_piece", F.sum("_starts").over(inside.orderBy("_place")))
        .withColumn("_last", F.max("_place").over(inside) == F.col("_place"))
    )
    parts = counted.groupBy("doc_id", "_part", "_size").agg(
        F.max("_piece").alias("_pieces"),
        F.sum(F.octet_length("_record") + len(end.encode())).alias("_bytes"),
    )
    # A row for each part of a file: what came before it, and whether the file ends
    # with the last part's last record rather than with an ``end`` behind it.
    of_file = Window.partitionBy("doc_id")
    before = of_file.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "doc_id",
        "_part",
        F.coalesce(F.sum("_pieces").over(before), F.lit(0)).alias("_before"),
        ((F.max("_part").over(of_file) == F.col("_part")) & (F.sum("_bytes").over(of_file) > F.col("_size"))).alias("_open"),
    )
    closing = F.when(F.col("_open") & F.col("_last"), "").otherwise(F.lit(end))
    ordered = F.array_sort(F.collect_list(F.struct("_part", "_place", F.concat("_record", closing).alias("_text"))))
    return (
        counted.join(parts, ["doc_id", "_part"])
        .groupBy("doc_id", (F.col("_before") + F.col("_piece")).alias("piece"))
        .agg(F.array_join(F.transform(ordered, lambda r: r["_text"]), "").alias("text"))
    )


def constant_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A few rows given in code."""
    return spark.createDataFrame(list(rows), schema)
