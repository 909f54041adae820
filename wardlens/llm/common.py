"""What the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: A word: a run of bytes without ASCII white space.  ``bytes.split()`` cuts at the same bytes.
WORD = r"[^\x20\x09-\x0D]+"

#: Slices that a key's rows are dealt over before they are ranked or summed.
SLICES = 512


#: Rows of texts that a worker turns into Python objects at once; Spark's batches hold 10,000.
AT_ONCE = 1000

_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this library to the executors' Python, as ``--py-files`` would, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def text_bytes(name: str) -> Column:
    """A text column as UTF-8 bytes; NULL is the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")


def word_count(name: str) -> Column:
    """Number of words in a text column, 0 for NULL."""
    return F.coalesce(F.regexp_count(F.col(name).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def unused(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that the table does not have."""
    while name in df.columns:
        name += "_"
    return name


def quoted(name: str) -> str:
    """A column's name as a reference to it, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of a Spark one; for the driver, as parsing it needs a session."""
    return to_arrow_schema(StructType.fromDDL(ddl))


def sliced(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``rows`` rows; the worker keeps no room for what was read."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        del batch
    pa.default_memory_pool().release_unused()


def map_batches(
    df: DataFrame,
    fn: Callable[[pa.RecordBatch], dict[str, object] | None],
    schema: str,
    at_once: int | None = None,
) -> DataFrame:
    """Apply ``fn`` to each Arrow batch; it returns the columns of the result, or None for no rows.

    With ``at_once`` it gets at most so many rows, which bounds the Python objects it makes.
    """
    target = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, at_once) if at_once else batches:
            columns = fn(batch)
            if columns is not None:
                arrays = [
                    c if isinstance(c, pa.Array) else pa.array(c, target.field(n).type)
                    for n, c in ((n, columns[n]) for n in target.names)
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return df.mapInArrow(run, schema)


def placed_in_keys(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rank: str,
    weight: str | None = None,
    start: str | None = None,
    slice_by: Column | None = None,
) -> DataFrame:
    """Number each key's rows from 0 in a shuffled order, without gathering a key in one task.

    A row's slice comes from a hash of ``order``; rows are numbered within (key, slice), and each
    slice starts after the rows of the slices before it.  With ``slice_by``, a prefix of ``order``
    that takes some hundreds of values or more, the numbers follow ``order`` as a whole.
    ``order`` should identify a row: rows equal in it may swap numbers.  With ``weight`` (a long column without NULLs) ``start`` is the
    running total of it before the row.  NULL keys are a key like any other.
    """
    spots = [F.col(k) for k in keys]
    if slice_by is None:
        slice_by = F.pmod(F.xxhash64(*order, F.lit(7)), F.lit(SLICES)).cast("int")
    sliced = df.withColumn("_slice", slice_by)
    size = F.col(weight) if weight else F.lit(0)
    totals = sliced.groupBy(*keys, "_slice").agg(
        F.count("*").alias("_rows"), F.sum(size).cast("long").alias("_sum")
    )
    earlier = Window.partitionBy(*spots).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)),
        F.col("_slice").alias("_s"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_sum_before"),
    )
    same = F.col("_slice") == F.col("_s")
    for i, key in enumerate(keys):
        same = same & F.col(key).eqNullSafe(F.col(f"_k{i}"))
    inside = Window.partitionBy(*spots, "_slice").orderBy(*order)
    out = sliced.join(offsets, same).withColumn(
        rank, (F.row_number().over(inside) - 1 + F.col("_rows_before")).cast("long")
    )
    if start:
        running = inside.rowsBetween(Window.unboundedPreceding, -1)
        out = out.withColumn(
            start, (F.coalesce(F.sum(size).over(running), F.lit(0)) + F.col("_sum_before")).cast("long")
        )
    return out.select(*df.columns, rank, *([start] if start else []))
