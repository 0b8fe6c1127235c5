"""What the operators of this subpackage share: input, scratch tables, Arrow maps."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..config import prepare_session, run_dir

#: Words of the contracts: runs of characters other than ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


#: Whole texts cross to Python in batches of this many bytes: one batch is held
#: on either side of the pipe for each running task.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare_session(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> Column:
    """A column by its whole name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


class Scratch:
    """Intermediate tables of one run, in the cluster's shared folder.

    A written table cuts the lineage: a lost executor costs the tasks it ran,
    not the steps before.  ``drop`` removes the folder through Hadoop's
    FileSystem once a result no longer reads it.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.dir = run_dir(spark, name)

    def path(self, name: str) -> str:
        return f"{self.dir}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.read(name, df.schema)

    def read(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        r = self.spark.read
        return (r.schema(schema) if schema is not None else r).parquet(self.path(name))

    def drop(self, name: str | None = None) -> None:
        sc = self.spark.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(self.path(name) if name else self.dir)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def map_arrow(df: DataFrame, columns: list, fields: list[T.StructField],
              fn: Callable[[Iterator[pa.RecordBatch]], Iterator[list]]) -> DataFrame:
    """``mapInArrow`` over chosen columns; ``fn`` yields one list of arrays per batch.

    Only the named columns cross to Python, so other columns of the input,
    whatever their names, cannot clash.
    """
    schema = T.StructType(fields)
    arrow = to_arrow_schema(schema)

    def run(batches):
        for arrays in fn(batches):
            yield pa.RecordBatch.from_arrays(
                [a if isinstance(a, (pa.Array, pa.ChunkedArray)) and a.type == f.type
                 else pa.array(a, type=f.type) if not isinstance(a, pa.Array) else a.cast(f.type)
                 for a, f in zip(arrays, arrow, strict=True)], schema=arrow)

    return df.select(*columns).mapInArrow(run, schema)


def append_arrow(df: DataFrame, text_col: str, fields: list[T.StructField],
                 fn: Callable[[pa.Array], list]) -> DataFrame:
    """All columns of ``df`` plus those ``fn`` computes from the text column.

    No shuffle and no join: each row keeps its place.  Columns travel under
    positional names, so a clash with an existing column is impossible; the
    new columns replace input columns of the same name.
    """
    names = df.columns
    at = names.index(text_col)
    inner = df.toDF(*[f"c{i}" for i in range(len(names))])
    new = [T.StructField(f"n{i}", f.dataType) for i, f in enumerate(fields)]

    def run(batches):
        for b in batches:
            yield [*b.columns, *fn(b.column(at))]

    out = map_arrow(inner, list(inner.columns), [*inner.schema.fields, *new], run)
    fresh = {f.name for f in fields}
    return out.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names) if n not in fresh],
                      *[F.col(f"n{i}").alias(f.name) for i, f in enumerate(fields)])


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Consecutive rows with equal values in the first ``keys`` columns, as tables.

    The partition must be sorted by them.  Holds one group and one batch.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if b.num_rows == 0:
            continue
        cols = [b.column(i).to_pylist() for i in range(keys)]
        start = 0
        for r in range(b.num_rows):
            key = tuple(c[r] for c in cols)
            if key != last:
                if r > start:
                    held.append(b.slice(start, r - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, last = [], r, key
        held.append(b.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def field(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind)


LONG, INT, DOUBLE, STRING, BOOL, BINARY = (T.LongType(), T.IntegerType(), T.DoubleType(),
                                           T.StringType(), T.BooleanType(), T.BinaryType())
