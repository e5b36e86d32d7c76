"""What the operators of this subpackage share: table access, folds, bounded samples, Arrow mapping."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evergreen.session import materialize

ARROW = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<string>": pa.list_(pa.string()),
    "array<int>": pa.list_(pa.int32()),
    "array<long>": pa.list_(pa.int64()),
    "array<binary>": pa.list_(pa.binary()),
}

BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = "8m"


def bounded_batches(df: DataFrame) -> DataFrame:
    """Limit a batch's bytes, unless the session has a limit of its own.

    A batch is held several times at once, before and after Python and as Python
    objects, and by rows alone 10,000 long texts would make one.
    """
    conf = df.sparkSession.conf
    if BATCH_LIMIT not in conf.getAll:
        conf.set(BATCH_LIMIT, BATCH_BYTES)
    return df


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def in_fold(modulus: int, remainder: int, key: str = "doc_id") -> Column:
    """Whether crc32 of the key as text leaves ``remainder``; null keys give null."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % modulus == remainder


def map_rows(
    df: DataFrame, make: Callable[[], Callable[..., list]], fields: list[tuple[str, str]]
) -> DataFrame:
    """Run Python over Arrow batches.

    ``make()`` is called once per task and returns a function from the batch's
    columns (as lists) to the output columns (as lists, in the order of ``fields``).
    """
    schema = pa.schema([(n, ARROW[t]) for n, t in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            if batch.num_rows:
                columns = work(*(c.to_pylist() for c in batch.columns))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, f.type) for v, f in zip(columns, schema, strict=True)], schema=schema
                )

    return bounded_batches(df).mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in fields))


def gather_rows(
    df: DataFrame,
    make: Callable[[], tuple[Callable[..., bool], Callable[[], list]]],
    fields: list[tuple[str, str]],
    rows: int | None = None,
) -> DataFrame:
    """``map_rows`` for functions that add up a task's batches.

    ``make()`` is called once per task and returns ``add``, which takes a batch's columns
    and says whether enough is held to hand it on, and ``take``, which returns the output
    columns of what is held and starts anew.  ``rows`` lets ``add`` see at most that many rows
    at once, for functions that hold much more than a batch's bytes.
    """
    schema = pa.schema([(n, ARROW[t]) for n, t in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        add, take = make()

        def held() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [v if isinstance(v, pa.Array) else pa.array(v, f.type) for v, f in zip(take(), schema, strict=True)],
                schema=schema,
            )

        for batch in batches:
            for at in range(0, batch.num_rows, rows or batch.num_rows or 1):
                if add(*(c.to_pylist() for c in batch.slice(at, rows).columns)):
                    yield held()
        yield held()

    return bounded_batches(df).mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in fields))


def bounded_sample(rows: DataFrame, label: str, bound: int, key: str = "doc_id") -> DataFrame:
    """About ``bound`` rows per value of ``label``, picked by the hash of ``key``; all of them, if fewer.

    The counts cover all rows; a hash threshold per label then picks rows where
    they lie, so no sort and no single task is involved.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    unit = F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1 << 30))
    keep = F.lit(False)
    for value, n in counts.items():
        share = F.lit(1 << 30 if n <= bound else int((1 << 30) * bound / n))
        keep = F.when(F.col(label).eqNullSafe(F.lit(value)), unit < share).otherwise(keep)
    return rows.filter(keep)


def small_table(df: DataFrame, name: str, tasks: int = 8) -> DataFrame:
    """A bounded sample as a written table that is read by few tasks, so that what the tasks send stays bounded."""
    return materialize(df, name).coalesce(tasks)


def keep_rows(df: DataFrame, column: str, make: Callable[[], Callable[[list], list]]) -> DataFrame:
    """The rows, with all their columns, for which Python finds the column's value worth keeping."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(work(batch.column(column).to_pylist()), pa.bool_()))

    return bounded_batches(df).mapInArrow(run, df.schema)
