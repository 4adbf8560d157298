"""File sources (S1-S5) and sinks (K1-K3), all through DataFrameReader/Writer.

Schemas are given, never inferred, except where the caller asks for the
reference's numeric-CSV inference (S5).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.sources.shared import write_shared

# The JSON document layout and the census table layout.
DOCUMENT_SCHEMA = "id string, title string, text string"
CENSUS_SCHEMA = ("age double, workclass string, fnlwgt double, education string, "
                 "education_num double, marital_status string, occupation string, "
                 "relationship string, race string, sex string, capital_gain double, "
                 "capital_loss double, hours_per_week double, native_country string, "
                 "income string")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per text line, column ``value``. Splits follow
    ``spark.sql.files.maxPartitionBytes`` (128 MB by default)."""
    return spark.read.text(path)


def read_json_documents(spark: SparkSession, path: str, multiline: bool = True,
                        schema: str = DOCUMENT_SCHEMA) -> DataFrame:
    """A JSON array of ``{id, title, text}`` (``multiline=True``, one
    task per file) or JSON lines (``multiline=False``, splittable). Escapes
    such as ``\\n`` are decoded by the JSON reader."""
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def read_csv_ddl(spark: SparkSession, path: str, schema: str = CENSUS_SCHEMA,
                 trim: bool = True) -> DataFrame:
    """Headerless CSV with a DDL schema; ``trim`` drops the blank after
    each comma that the census file carries."""
    return (spark.read.schema(schema)
            .option("ignoreLeadingWhiteSpace", trim).option("ignoreTrailingWhiteSpace", trim)
            .csv(path))


def number_rows(rows: DataFrame, id_col: str = "id") -> DataFrame:
    """rows of a file source with their place in it as ``id_col``: 0 to n - 1, files in order of
    path, lines in order within a file, however the files are split among tasks.

    One job counts the rows of every file split and the running count over them (one row a
    split) is written; the rows then add their split's offset to their place in the split.
    Files must not change in between."""
    at = F.monotonically_increasing_id()                 # grows by one within a split
    placed = rows.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block"),
                         at.alias("_at"))
    splits = placed.groupBy("_path", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.orderBy("_path", "_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets, _ = write_shared(splits.select("_path", "_block", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")),
                              "splits")
    return (placed.join(offsets, ["_path", "_block"])
            .select((F.col("_before") + F.col("_at") - F.col("_first")).alias(id_col), *rows.columns))


def read_vectors_csv(spark: SparkSession, path: str, schema: str | None = None,
                     id_col: str = "id", vec_col: str = "vector") -> DataFrame:
    """Headerless numeric CSV -> ``(id bigint, vector array<double>)``.

    Without ``schema`` the column types are inferred (an extra pass, as the
    reference does). The row id is the line's place in the files, see ``number_rows``."""
    reader = spark.read
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    raw = reader.csv(path)
    vec = F.array(*[F.col(c).cast("double") for c in raw.columns])
    return number_rows(raw, id_col).select(id_col, vec.alias(vec_col))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1: headerless CSV directory."""
    df.write.mode(mode).csv(path)


def write_lines(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    """K2: one text line per row, fields joined by ``sep``."""
    df.select(F.concat_ws(sep, *[F.col(c).cast("string") for c in df.columns]).alias("value")) \
        .write.mode(mode).text(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object a line, as ``read_json_documents(multiline=False)`` reads them."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_tsv(df: DataFrame, path: str) -> None:
    """K3: tab-separated key/value lines; refuses an existing directory."""
    df.write.mode("errorifexists").option("sep", "\t").csv(path)
