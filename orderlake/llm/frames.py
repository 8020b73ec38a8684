"""Small helpers shared by the operators: column handling and tables that cut a lineage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from orderlake.llm.text import slices
from orderlake.session import scratch_root


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` less the columns an operator is about to add, whatever their case."""
    gone = {n.lower() for n in names}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in gone])


def unused_name(name: str, taken: Iterable[str]) -> str:
    """``name``, or as it becomes a column name that is not ``taken``, whatever their case."""
    gone = {c.lower() for c in taken}
    while name.lower() in gone:
        name += "_"
    return name


def privately(df: DataFrame) -> tuple[DataFrame, list[str], Callable[[str], str]]:
    """``df`` under column names of our own, these names, and which of them a column has; so none can clash."""
    names = [f"c{i}" for i in range(len(df.columns))]
    mine = dict(zip(df.columns, names, strict=True))
    return df.toDF(*names), names, mine.__getitem__


def extended(df: DataFrame, added: str) -> T.StructType:
    return T.StructType(df.schema.fields + T.StructType.fromDDL(added).fields)


def with_columns(batch: pa.RecordBatch, drop: Iterable[str], **added: pa.Array) -> pa.RecordBatch:
    """``batch`` less some columns, with others at its end."""
    gone = set(drop)
    kept = [(n, batch.column(i)) for i, n in enumerate(batch.schema.names) if n not in gone]
    return pa.RecordBatch.from_arrays([c for _, c in kept] + list(added.values()), [n for n, _ in kept] + list(added))


def appended(
    df: DataFrame, read: Sequence[str], compute: Callable[..., list[pa.Array]], added: str, sliced: bool = False
) -> DataFrame:
    """``df`` with the columns ``added``, which ``compute`` makes of the Arrow columns ``read``, batch by batch.

    Columns travel under private names, so that theirs may be spelled in any way. ``sliced`` bounds the bytes of the
    first column read that are handled at once.
    """
    fields = T.StructType.fromDDL(added).fields
    replaced = {f.name.lower() for f in fields}
    places = [df.columns.index(c) for c in read]
    kept = [i for i, c in enumerate(df.columns) if c.lower() not in replaced]
    names = [f"c{i}" for i in range(len(df.columns))]
    out_names = [names[i] for i in kept] + [f"a{i}" for i in range(len(fields))]
    out_fields = [df.schema.fields[i] for i in kept] + fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, names[places[0]]) if sliced else batches:
            made = compute(*[batch.column(i) for i in places])
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), *made], out_names)

    schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(out_names, out_fields, strict=True)])
    return df.toDF(*names).mapInArrow(run, schema).toDF(*[f.name for f in out_fields])


#: Whether Spark deletes the shuffle files of a query when it ends, and not some time after its plan is garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(df: DataFrame, name: str, release: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends there, and lost executors do not matter.

    ``release`` gives back the disk of its shuffles at once: for large ones that more large ones follow.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/llm/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    if release:
        spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if release:
            spark.conf.set(_CLEANUP, before) if before is not None else spark.conf.unset(_CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete the files of a frame made by ``table``; nothing may read it any more."""
    jvm = df.sparkSession.sparkContext._jvm
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
