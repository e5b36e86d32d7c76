"""Reading landed CSV and Parquet inputs with explicit columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Headers of the landed files.
CHART_COLUMNS = {
    "1Date": "date",
    "Song": "title",
    "Artist": "artist",
    "Peak Position": "peak_pos",
    "Weeks in Charts": "weeks_on_chart",
}
SNAPSHOT_COLUMNS = {"week_date": "date", "title": "title", "artist": "artist",
                    "peak_pos": "peak_pos", "weeks_on_chart": "weeks_on_chart"}
PLAYLIST_COLUMNS = {"Track Name": "title", "Artist Name(s)": "artists"}
EXPORT_SYNONYMS = {
    "uri": ("Track URI",),
    "title": ("Track Name",),
    "artist": ("Artist Name(s)",),
    "duration_ms": ("Duration (ms)", "Track Duration (ms)"),
    "release_date": ("Release Date", "Album Release Date"),
}
EXPORT_REQUIRED = ("uri", "title", "artist")
#: Holds the whole line of a CSV row with fewer or more cells than the header, else null.
RESCUED = "rescued"


def file_order() -> Column:
    """Row order of a file scan: by file name, place of the split in the file, and place in the split."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def read_text_columns(
    spark: SparkSession, path: str, parquet: bool = False, multi_line: bool = True, rescue: bool = False
) -> DataFrame:
    """A header CSV (all columns as text, no inference pass) or a Parquet table, with ``ord``.

    Only empty cells are null: texts such as ``NA`` stay text.  ``multi_line`` reads
    quoted line breaks; files known to have none can be split without it.  Rows with too few
    cells get nulls for the others, and cells beyond the header have no column; ``rescue``
    adds ``rescued``, which keeps such rows' lines, so that nothing is lost without a trace.
    """
    if parquet:
        return spark.read.parquet(path).withColumn("ord", file_order())

    def reader() -> DataFrameReader:
        return spark.read.options(header=True, quote='"', escape='"', multiLine=multi_line)

    df = reader().csv(path)
    if rescue:
        if RESCUED in df.columns:
            raise ValueError(f"the header has a column {RESCUED} of its own")
        schema = T.StructType([*df.schema.fields, T.StructField(RESCUED, T.StringType())])
        cells = [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]
        df = reader().options(mode="PERMISSIVE", columnNameOfCorruptRecord=RESCUED).schema(schema).csv(path)
        # A scan of fewer columns takes no line for malformed: the test, which always holds, brings in all of them.
        df = df.withColumn(RESCUED, F.when(F.length(F.concat_ws("", *cells)) >= 0, F.col(RESCUED)))
    return df.withColumn("ord", file_order())


def carried(df: DataFrame) -> list[str]:
    """The columns of a row's place and of its rescued line, as far as there are any."""
    return [c for c in ("ord", RESCUED) if c in df.columns]


def pick(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Prune to the named columns and rename them; ``ord`` and ``rescued`` are kept when present."""
    return df.select(*[F.col(f"`{src}`").alias(dst) for src, dst in columns.items()], *carried(df))


def to_number(c: Column, kind: str = "int") -> Column:
    """Numeric coercion, exact where the text is a whole number; anything that is not a number becomes null."""
    # A failed cast costs an exception: texts without a digit are no number, and those with a point are no whole one.
    is_text, text = F.typeof(c) == "string", c.cast("string")
    may_be = ~is_text | F.rlike(text, F.lit("[0-9]"))
    may_be_whole = may_be & (~is_text | ~F.contains(text, F.lit(".")))
    return F.coalesce(F.when(may_be_whole, c.try_cast(kind)), F.when(may_be, c.try_cast("double").try_cast(kind)))


def whole_number(df: DataFrame, col: str) -> Column:
    """``col`` as int: numbers keep their type's cast, text is coerced."""
    if dict(df.dtypes)[col] in ("tinyint", "smallint", "int", "bigint"):
        return F.col(col).try_cast("int")
    return to_number(F.col(col))


DATE_FORMATS = ("M/d/yyyy", "yyyy/M/d", "MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy", "d MMM yyyy")


def calendar_date(df: DataFrame, col: str, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """``col`` as date: a date or timestamp column as it is; text is read as ISO, else by the first format that fits."""
    if dict(df.dtypes)[col] in ("date", "timestamp", "timestamp_ntz"):
        return F.col(col).cast("date")
    text = F.trim(F.col(col).cast("string"))

    def read(form: str) -> Column:
        # A failed parse costs an exception, so a format is tried only on texts that hold its separator.
        mark = next((m for m in ("/", " ") if m in form), "")
        return F.when(F.contains(text, F.lit(mark)), F.try_to_date(text, form))

    return F.coalesce(F.try_to_date(text), *map(read, formats))


def empty(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
