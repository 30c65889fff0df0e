"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.shared import shared_dir, spread

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only; every other character stays. Null stays null.

    ``lower`` is the fast path for texts that are pure ASCII, where both agree.
    """
    ascii_only = F.octet_length(col) == F.length(col)
    return F.when(ascii_only, F.lower(col)).otherwise(F.translate(col, _UPPER, _UPPER.lower()))


_REMEMBERED: list[Callable[[], None]] = []


def remembers(forget: Callable[[], None]) -> Callable[[], None]:
    """Register how to drop what a module remembers from task to task in a worker."""
    _REMEMBERED.append(forget)
    return forget


def give_back(keep: Callable[[], None] | None = None) -> None:
    """Drop what other operators remember here, and return freed memory to the system. Python workers are reused from
    task to task, and what is kept of one task would count against the executor in the next. ``keep`` is what the caller
    goes on with."""
    import pyarrow as pa

    for forget in _REMEMBERED:
        if forget is not keep:
            forget()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


_OPEN: list[list[Staged]] = []


@contextmanager
def dropping() -> Iterator[None]:
    """Delete, at the end, the tables of all that was staged inside; what is still to be read must be written by then."""
    made: list[Staged] = []
    _OPEN.append(made)
    try:
        yield
    finally:
        _OPEN.remove(made)
        for staged in made:
            staged.drop()


class Staged:
    """Intermediate tables as Parquet in the shared folder. They cut the lineage, so that a lost executor costs
    no more than the tasks after the last table, and each is read more than once without being made again."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/pairscore-{uuid.uuid4().hex}"
        self.n = 0
        for made in _OPEN:
            made.append(self)

    def keep(self, df: DataFrame, codec: str = "zstd", dictionary: bool = True, by: str | None = None) -> DataFrame:
        """``dictionary`` False spares the attempt to encode columns of values that do not repeat; rows of different values
        in the column ``by`` are in different files, so that a read of one of them passes the others over."""
        self.n += 1
        path = f"{self.root}/{self.n}"
        writer = df.write.option("compression", codec).option("parquet.enable.dictionary", str(dictionary).lower())
        (writer.partitionBy(by) if by else writer).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        """Delete the tables made so far; for a caller that has used them up."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def map_text(df: DataFrame, column: str, keep: list[str], fields: str, make, remembered: Callable[[], None] | None = None) -> DataFrame:
    """``keep`` of each row, untouched, and ``fields`` (a DDL string) from its text in ``column``. ``make()`` is called
    once a task and returns a function from a list of texts (None for null) to one list of values per field; what it has
    ``remembered`` from earlier tasks stays."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    made = StructType.fromDDL(fields)
    schema = StructType([df.schema[c] for c in keep] + made.fields)
    types = [f.type for f in to_arrow_schema(made)]
    read = list(dict.fromkeys([*keep, column]))

    def run(batches):
        give_back(remembered)
        fn = make()
        for b in batches:
            values = fn(b.column(read.index(column)).to_pylist())
            arrays = [b.column(read.index(c)) for c in keep] + [pa.array(v, t) for v, t in zip(values, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, [f.name for f in schema.fields])

    return spread(df.select(*read)).mapInArrow(run, schema)
