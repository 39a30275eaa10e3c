"""The versioned snapshot archive: copy-on-write publishing with a safe commit.

Layout under ``root``::

    attempts/<version>-<token>/   everything one writer wrote: data/, index/,
                                  removed/, files/, hashes/, lineages/
    _manifest/<version>.json      the commit: which of those make up a version

*Commit.*  Every attempt writes to a folder of its own and touches no other.
The manifest is written aside and renamed to its final name last, a rename
that fails if the name exists (atomic on HDFS; an object store needs its
conditional put).  Of two writers of one version one fails, and the other's
rows are whole.  All readers start from the manifest, so no part of an
uncommitted attempt can be read.

*Copy on write.*  A version lists its data files, and an id-to-file index is
written beside them (from ``_metadata.file_name`` of the written rows, two
narrow columns).  A refresh looks up the files of the ids that are no longer
unchanged.  Files without one are carried over by name; of a file that lost
less than ``REWRITE_SHARE`` of its rows since it was written, the lost
(id, file) pairs are recorded as removed; only the others are read and
rewritten, together with the new rows.  Wide rows of kept files are neither
read nor shuffled, and what a refresh writes follows what moved.

The driver sees the list of files and a few numbers, as it does for any scan.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.diff import UNCHANGED, ids_with_status
from ..operators.sets import union_all
from ..session import cut_lineage, maybe_broadcast
from .writers import write_line_list, write_ndjson, write_parquet

#: A file is rewritten once so much of it is gone.
REWRITE_SHARE = 0.2


# --- files -----------------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def _create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Put ``text`` at ``path`` unless something is there (False then)."""
    jvm = spark.sparkContext._jvm
    aside = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
    fs, jaside = _fs(spark, aside)
    out = fs.create(jaside, False)
    out.write(bytearray(text.encode()))
    out.close()
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    final = fs.makeQualified(jvm.org.apache.hadoop.fs.Path(path))
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), conf).rename(
            fs.makeQualified(jaside), final, options)
    except Exception as e:
        fs.delete(jaside, False)
        if "FileAlreadyExists" in str(e):
            return False
        raise
    return True


def read_manifest(spark: SparkSession, root: str, version: str) -> dict:
    fs, path = _fs(spark, f"{root.rstrip('/')}/_manifest/{version}.json")
    if not fs.exists(path):
        raise FileNotFoundError(f"no committed version {version} under {root}")
    stream = fs.open(path)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def latest_version(spark: SparkSession, root: str) -> str | None:
    """Highest committed version under ``root``."""
    fs, path = _fs(spark, f"{root.rstrip('/')}/_manifest")
    if not fs.exists(path):
        return None
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    versions = [int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()]
    return str(max(versions)) if versions else None


# --- parts of a version ----------------------------------------------------

def _load(spark: SparkSession, paths: list[str], fmt: str, schema: T.StructType) -> DataFrame:
    reader = spark.read.schema(schema)
    if fmt == "json":
        reader = reader.option("mode", "FAILFAST")
    return reader.format(fmt).load(paths)


def _schema(manifest: dict) -> T.StructType:
    return T.StructType.fromJson(manifest["schema"])


def files_of(spark: SparkSession, root: str, version: str) -> DataFrame:
    """(file, path, bytes, rows, gone) of a version's data files; ``gone`` of
    a file's rows are removed."""
    return spark.read.parquet(f"{root.rstrip('/')}/{read_manifest(spark, root, version)['files']}")


def _removed(spark: SparkSession, root: str, manifest: dict, files: DataFrame) -> DataFrame | None:
    """(id, file) pairs removed from the version's files."""
    if not manifest["removed"]:
        return None
    pairs = spark.read.parquet(*[f"{root}/{p}" for p in manifest["removed"]])
    return pairs.join(maybe_broadcast(files.select("file")), "file", "left_semi").select("id", "file")


def _minus(rows: DataFrame, id_col: str, removed: DataFrame | None) -> DataFrame:
    """Scanned rows without the removed (id, file) pairs."""
    if removed is None:
        return rows
    named = rows.withColumn("__file", F.col("_metadata.file_name"))
    gone = maybe_broadcast(removed.select(F.col("id").alias("__id"), F.col("file").alias("__of")))
    return named.join(gone, (F.col("__file") == F.col("__of")) & named[id_col].eqNullSafe(F.col("__id")),
                      "left_anti").drop("__file")


def read_snapshot(spark: SparkSession, root: str, version: str, part: str = "data") -> DataFrame:
    """One published part (``data``, ``hashes``, ``lineages``) of a version."""
    root = root.rstrip("/")
    m = read_manifest(spark, root, version)
    if part not in m["parts"]:
        raise FileNotFoundError(f"version {version} under {root} has no {part}")
    if part == "lineages":
        return spark.read.text(f"{root}/{m['parts'][part]}")
    if part != "data":
        return spark.read.parquet(f"{root}/{m['parts'][part]}")
    files = spark.read.parquet(f"{root}/{m['files']}")
    paths = [f"{root}/{r['path']}" for r in files.select("path").collect()]
    if not paths:
        return spark.createDataFrame([], _schema(m))
    return _minus(_load(spark, paths, m["format"], _schema(m)), m["id_col"], _removed(spark, root, m, files))


# --- publishing ------------------------------------------------------------

class _Attempt:
    """What one writer of a version has written."""

    def __init__(self, spark: SparkSession, root: str, version: str | None, id_col: str | None,
                 fmt: str, compression: str | None):
        self.spark, self.root, self.id_col = spark, root.rstrip("/"), id_col
        self.version = version or str(int(time.time()))
        fs, path = _fs(spark, f"{self.root}/_manifest/{self.version}.json")
        if fs.exists(path):
            raise FileExistsError(f"snapshot version {self.version} already published under {root}")
        self.folder = f"attempts/{self.version}-{uuid.uuid4().hex[:12]}"
        self.fmt, self.compression = fmt, compression
        self.parts: dict[str, str] = {}

    def path(self, part: str) -> str:
        return f"{self.root}/{self.folder}/{part}"

    def write_data(self, data: DataFrame) -> DataFrame:
        if self.fmt == "json":
            write_ndjson(data, self.path("data"), self.compression)
        else:
            write_parquet(data, self.path("data"))
        self.parts["data"] = f"{self.folder}/data"
        return _load(self.spark, [self.path("data")], self.fmt, data.schema)

    def write_index(self, written: DataFrame) -> list[str]:
        if self.id_col is None:
            return []
        write_parquet(written.select(F.col(self.id_col).alias("id"),
                                     F.col("_metadata.file_name").alias("file")), self.path("index"))
        return [f"{self.folder}/index"]

    def new_files(self, written: DataFrame) -> DataFrame:
        at = F.col("_metadata.file_name")
        return written.groupBy(at.alias("file")).agg(
            F.max("_metadata.file_size").alias("bytes"), F.count(F.lit(1)).alias("rows")).select(
            "file", F.concat(F.lit(f"{self.folder}/data/"), "file").alias("path"), "bytes", "rows",
            F.lit(0).cast("long").alias("gone"))

    def write_sides(self, written: DataFrame, hashes, lineages):
        if hashes is not None:
            write_parquet(hashes, self.path("hashes"))
            self.parts["hashes"] = f"{self.folder}/hashes"
        if callable(lineages):
            lineages = lineages(written)
        if lineages is not None:
            write_line_list(lineages, self.path("lineages"))
            self.parts["lineages"] = f"{self.folder}/lineages"

    def commit(self, schema: T.StructType, files: DataFrame, index: list[str], removed: list[str],
               previous: str | None) -> str:
        write_parquet(files.coalesce(1), self.path("files"))  # a row a file
        manifest = {"version": self.version, "published_at": int(time.time()), "format": self.fmt,
                    "schema": json.loads(schema.json()), "id_col": self.id_col, "parts": self.parts,
                    "files": f"{self.folder}/files", "index": index, "removed": removed, "previous": previous}
        if not _create_once(self.spark, f"{self.root}/_manifest/{self.version}.json", json.dumps(manifest)):
            raise FileExistsError(f"snapshot version {self.version} was published by another writer under {self.root}")
        return self.version


def publish_snapshot(spark: SparkSession, root: str, data: DataFrame,
                     lineages: DataFrame | Callable[[DataFrame], DataFrame] | None = None,
                     hashes: DataFrame | None = None, version: str | None = None, fmt: str = "parquet",
                     compression: str | None = None, id_col: str | None = None) -> str:
    """Write a whole snapshot as a version (default: epoch seconds) and
    commit it: data (Parquet, or NDJSON with ``fmt='json'`` and a text
    codec), hashes (Parquet) and lineages (text).  An existing version fails
    the job.  ``lineages`` is a DataFrame or a function of the *written* data.
    With ``id_col`` the id-to-file index is written, and the next version can
    be published by ``publish_refresh``."""
    a = _Attempt(spark, root, version, id_col, fmt, compression)
    written = a.write_data(data)
    index = a.write_index(written)
    a.write_sides(written, hashes, lineages)
    return a.commit(data.schema, a.new_files(written), index, [], None)


def publish_refresh(spark: SparkSession, root: str, previous: str, diff: DataFrame, new_rows: DataFrame,
                    lineages: DataFrame | Callable[[DataFrame], DataFrame] | None = None,
                    hashes: DataFrame | None = None, version: str | None = None,
                    compression: str | None = None, rewrite_share: float = REWRITE_SHARE) -> str:
    """Publish the next version: the rows of ``previous`` whose id is
    unchanged in ``diff`` (a row with a null or unknown id goes) and
    ``new_rows``.  ``lineages`` may be a function of the rows *written* here,
    the new ones and those of rewritten files."""
    m = read_manifest(spark, root, previous)
    if m["id_col"] is None:
        raise ValueError(f"version {previous} under {root} has no index of its ids")
    a = _Attempt(spark, root, version, m["id_col"], m["format"], compression)
    files = spark.read.parquet(f"{a.root}/{m['files']}")
    removed = _removed(spark, a.root, m, files)
    index = spark.read.parquet(*[f"{a.root}/{p}" for p in m["index"]])
    live = index.join(maybe_broadcast(files.select("file")), "file", "left_semi").select("id", "file")
    if removed is not None:
        r = maybe_broadcast(removed.select(F.col("id").alias("__id"), F.col("file").alias("__of")))
        live = live.join(r, live["id"].eqNullSafe(F.col("__id")) & (live["file"] == F.col("__of")), "left_anti")
    # narrow tables only: ids and file names
    still = ids_with_status(diff, (UNCHANGED,)).hint("merge")  # most of the ids, many times the size of their files
    gone = cut_lineage(live.join(still, "id", "left_anti").distinct(), "gone-ids")
    lost = live.join(maybe_broadcast(gone.select("file").distinct()), "file", "left_semi").join(
        maybe_broadcast(gone.withColumnsRenamed({"id": "__id", "file": "__of"})),
        F.col("id").eqNullSafe(F.col("__id")) & (F.col("file") == F.col("__of"))).groupBy("file").agg(
        F.count(F.lit(1)).alias("now"))
    state = cut_lineage(files.join(lost, "file", "left").withColumn("now", F.coalesce("now", F.lit(0))).withColumn(
        "rewrite", (F.col("now") > 0) & (F.col("gone") + F.col("now") >= rewrite_share * F.col("rows"))), "file-state")
    rewrite = state.where("rewrite")
    paths = [f"{a.root}/{r['path']}" for r in rewrite.select("path").collect()]
    merged = union_all([spark.createDataFrame([], _schema(m)), new_rows])
    if paths:
        out = gone if removed is None else gone.unionByName(removed)
        kept = _minus(_load(spark, paths, a.fmt, _schema(m)), a.id_col, out.join(
            maybe_broadcast(rewrite.select("file")), "file", "left_semi").select("id", "file"))
        merged = union_all([kept, new_rows])
    written = a.write_data(merged)
    indexed = a.write_index(written)
    parts = list(m["removed"])
    marked = state.where("not rewrite and now > 0").select("file")
    if not marked.isEmpty():
        write_parquet(gone.join(maybe_broadcast(marked), "file", "left_semi").select("id", "file"), a.path("removed"))
        parts.append(f"{a.folder}/removed")
    a.write_sides(written, hashes, lineages)
    carried = state.where("not rewrite").select("file", "path", "bytes", "rows", (F.col("gone") + F.col("now")).alias("gone"))
    return a.commit(merged.schema, carried.unionByName(a.new_files(written)), [*m["index"], *indexed], parts, previous)


def written_bytes(spark: SparkSession, root: str, version: str) -> tuple[int, int]:
    """(bytes of the data files this version wrote, bytes of all its files)."""
    root = root.rstrip("/")
    m = read_manifest(spark, root, version)
    files = spark.read.parquet(f"{root}/{m['files']}")
    own = F.sum(F.when(F.col("path").startswith(m["parts"]["data"] + "/"), F.col("bytes")))
    r = files.agg(F.coalesce(own, F.lit(0)).alias("own"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("all")).first()
    return r["own"], r["all"]
