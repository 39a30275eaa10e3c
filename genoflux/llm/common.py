"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Code points of text that a Python task holds decoded at a time; a longer
#: text forms a slice of its own.
SLICE_CHARS = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ship_package(spark: SparkSession) -> None:
    """Give the executors this package (once per application), as
    ``--py-files`` would: Python tasks import it by name, wherever the
    driver found it."""
    sc = spark.sparkContext
    if getattr(sc, "_genoflux_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="genoflux-"), "genoflux.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("genoflux", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._genoflux_shipped = True


def small_batches(spark: SparkSession) -> None:
    """What every operator with Python tasks needs: the package on the
    executors, and Arrow batches of a bounded size (a batch is held several
    times over: JVM, Arrow, Python).  The two settings hold for the session
    from then on; plans read them when they run, after the operator has
    returned its frame, so they cannot be kept to the call."""
    _ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, a null text as the empty one;
    whatever else the input carries cannot clash with derived names."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"),
                       F.coalesce(docs[text_col], F.lit("")).alias("text"))


def hand_back() -> None:
    """Return freed memory to the system.  A Python worker stays between
    tasks, beside the JVM of its executor; what its allocators keep for later
    would count against the executor for as long."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def slices(batches: Iterator[pa.RecordBatch], text: str = "text",
           limit: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about ``limit`` bytes of text:
    bounds what a task holds as Python strings, whatever the batch size."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(batch.schema.get_field_index(text)))
        start = held = 0
        for i, n in enumerate(sizes.to_pylist()):
            if held and held + (n or 0) > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n or 0
        yield batch.slice(start)
    hand_back()


def map_text(df: DataFrame, function: Callable[[list, list[str]], dict], schema: str,
             arrow_schema: pa.Schema) -> DataFrame:
    """``mapInArrow`` over (doc_id, text): ``function`` gets the ids and the
    texts of a bounded slice and returns the output columns."""
    small_batches(df.sparkSession)

    def run(batches):
        for b in slices(batches):
            out = function(b.column(0).to_pylist(), b.column(1).to_pylist())
            yield pa.RecordBatch.from_pydict(out, schema=arrow_schema)
    return df.select("doc_id", "text").mapInArrow(run, schema)
