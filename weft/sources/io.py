"""Sources and sinks S1-S6, S9."""

from __future__ import annotations

import bz2
import datetime as _dt
import gzip
import re
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.functions.vectors import decode_vector, encode_vector
from weft.operators.side import open_folder
from weft.session import ship_package, spread, write_measured

CHUNK_CSV_SCHEMA = "text string, chunk_size int"
# Both whitespace flags are needed: Spark's CSV writer trims by default and
# chunk texts may start or end with a space.
_CSV_WRITE = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
_CSV_READ = {"header": "true", "multiLine": "true", "escape": '"'}


# What Hadoop's codecs compress, by the file's extension; None: in frames of Hadoop's own.
_UNPACK = {".gz": gzip.decompress, ".bz2": bz2.decompress, ".deflate": zlib.decompress, ".zst": None, ".lz4": None, ".snappy": None}
# Bytes and rows of the batches in which file texts leave a task.
_TEXT_BYTES, _TEXT_ROWS = 4 << 20, 1000
# Bytes of repeated names that are broadcast to the rows.
_REPEATED_BYTES = 16 << 20
# Most tasks that read files.
_READERS = 10_000


def read_whole_text(spark: SparkSession, path: str, nested: bool = False) -> DataFrame:
    """One row per file (newlines kept): ``path``, ``text``. ``nested`` reads the
    files of all folders below ``path`` and takes no columns from folder names: the
    driver lists ``path`` itself, tasks list and read what stands below each of its
    entries, so that neither its memory nor the number of tasks grows with the files.
    (A pattern, or a store that Arrow cannot open, is listed by Spark.)"""
    found = _folder(spark, path) if nested and not re.search(r"[*?{}\[\]\\]", path) else None
    if found is None:
        return spark.read.text(path, wholetext=True, recursiveFileLookup=nested).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    uri, entries = found
    ship_package(spark)

    def task(batches):
        system, folder = open_folder(uri)
        paths, texts, size = [], [], 0
        for batch in batches:
            for name in batch.column(0).to_pylist():
                for file in _files(system, f"{folder}/{name}"):
                    paths.append(_spark_path(uri, file[len(folder):]))
                    texts.append(_content(system, file))
                    size += len(texts[-1])
                    if size >= _TEXT_BYTES or len(texts) >= _TEXT_ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(texts, pa.binary())], names=["path", "text"])
                        paths, texts, size = [], [], 0
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(texts, pa.binary())], names=["path", "text"])

    names = spark.createDataFrame([(x,) for x in entries], "name string").coalesce(1).repartition(max(1, min(len(entries), _READERS)))
    return names.mapInArrow(task, "path string, text binary").select("path", F.col("text").cast("string").alias("text"))


def _folder(spark: SparkSession, path: str) -> tuple[str, list[str]] | None:
    """The URI of a folder and the names in it; None if it is none, or in a store that Arrow cannot open."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toUri().toString()
    try:
        system, folder = open_folder(uri)
    except pa.ArrowInvalid:  # no file system of Arrow's has this scheme
        return None
    if system.get_file_info(folder).type != fs.FileType.Directory:
        return None
    return uri, [x.base_name for x in _listed(system, folder)]


def _listed(system, folder: str) -> list:
    """What stands in a folder, without the names that Spark's readers pass over."""
    return [x for x in system.get_file_info(fs.FileSelector(folder)) if not _hidden(x.base_name)]


def _hidden(name: str) -> bool:
    if name.startswith(("_metadata", "_common_metadata")):
        return False
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _files(system, path: str):
    """The files at or below ``path``, one folder listed at a time; empty ones are no rows of Spark's."""
    top = system.get_file_info(path)
    if top.type == fs.FileType.File:
        if top.size:
            yield path
        return
    folders = [path]
    while folders:
        for x in _listed(system, folders.pop()):
            if x.type == fs.FileType.Directory:
                folders.append(x.path)
            elif x.size:
                yield x.path


def _content(system, file: str) -> bytes:
    with system.open_input_stream(file, compression=None) as f:
        body = f.read()
    end = file[file.rfind(".") :]
    if end not in _UNPACK:
        return body
    if _UNPACK[end] is None:
        raise ValueError(f"{file}: files compressed as {end} can only be read with nested=False")
    return _UNPACK[end](body)


def _spark_path(uri: str, below: str) -> str:
    """A file's path as Spark gives it: a URI, ``file:/`` with one slash."""
    root = "file:" + uri[len("file://") :] if uri.startswith("file:///") else uri
    return root + re.sub(r"""[\x00-\x20"#%<>?\[\\\]^`{|}\x7f-\x9f]|\s""", lambda m: quote(m[0], safe=""), below)


def write_whole_text(df: DataFrame, path: str, name_col: str, text_col: str = "text") -> None:
    """The files that S1 reads: one per value of ``name_col``, named ``name_col=value``,
    a line for each of its rows, in a folder for each task. Tasks write the files
    themselves: Hadoop's local file system starts several processes for every file
    and folder it makes. A file takes its name when it is whole; a task that is
    run again replaces it."""
    spark = df.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toUri().toString()
    system, folder = open_folder(uri)
    system.create_dir(folder)
    ship_package(spark)

    def task(batches):
        system, folder = open_folder(uri)
        own, mark, n, name, out = f"{folder}/part-{TaskContext.get().partitionId():05d}", uuid.uuid4().hex, 0, None, None

        def close():
            out.close()
            system.move(f"{own}/.{mark}", f"{own}/{name}")

        for batch in batches:
            if not n:
                system.create_dir(own)
            for value, text in zip(batch.column(0), batch.column(1)):
                value = f"{name_col}={value.as_py()}"
                if value != name:
                    if out:
                        close()
                    name, out, n = value, system.open_output_stream(f"{own}/.{mark}", compression=None), n + 1
                out.write((text.as_py() or b"") + b"\n")
        if out:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["files"])

    # what Spark's writer names partitions: escaped, and a name for NULL
    name = F.coalesce(F.url_encode(F.col(name_col).cast("string")), F.lit("__HIVE_DEFAULT_PARTITION__"))
    rows = spread(df).select(name.alias("name"), F.col(text_col).cast("string").cast("binary").alias("text"))
    # only the rows of names that come again have to meet: the other texts are not shuffled
    again, sizes = write_measured(rows.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("name"), "repeated")
    if sizes["rows"]:
        few = sizes["bytes"] <= _REPEATED_BYTES
        met = (rows.join(F.broadcast(again), "name", "left_semi") if few else rows).repartition("name").sortWithinPartitions("name")
        rows = rows.join(F.broadcast(again), "name", "left_anti").unionByName(met) if few else met
    rows.mapInArrow(task, "files long").agg(F.sum("files")).collect()


def write_chunks_csv(chunks: DataFrame, path: str, columns=("text", "chunk_size"), mode: str = "errorifexists") -> None:
    """Chunk text and size (optionally ids) as CSV with a header, lossless for quotes, commas, newlines and edge spaces."""
    chunks.select(*columns).write.mode(mode).options(**_CSV_WRITE).csv(path)


def read_chunks_csv(spark: SparkSession, path: str, schema: str = CHUNK_CSV_SCHEMA) -> DataFrame:
    """S3: explicit schema, never inference (texts like ``NA`` or ``123`` stay text)."""
    return spark.read.options(**_CSV_READ).schema(schema).csv(path)


def write_embeddings(df: DataFrame, path: str, vec_col: str = "embedding", fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Parquet keeps ``array<double>``; CSV stores the vector as JSON text."""
    if fmt == "parquet":
        df.write.mode(mode).parquet(path)
    else:
        df.withColumn(vec_col, encode_vector(vec_col)).write.mode(mode).options(**_CSV_WRITE).csv(path)


def read_embeddings_csv(spark: SparkSession, path: str, schema: str, vec_col: str = "embedding") -> DataFrame:
    """Decode the vector text with ``from_json`` (malformed → NULL)."""
    return read_chunks_csv(spark, path, schema).withColumn(vec_col, decode_vector(vec_col))


def new_run_id() -> str:
    """``%Y%m%d_%H%M%S`` + ``_`` + 8 hex characters."""
    return f"{_dt.datetime.now().strftime('%Y%m%d_%H%M%S')}_{uuid.uuid4().hex[:8]}"


def write_run(df: DataFrame, path: str, run_id: str, mode: str = "append") -> None:
    """Runs share one table, partitioned by ``run_id`` (pruned on read)."""
    df.withColumn("run_id", F.lit(run_id)).write.mode(mode).partitionBy("run_id").parquet(path)


def write_plans(plans: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """The assembled plans; ``text`` writes only the rendered report."""
    if fmt == "text":
        plans.select("report").write.mode(mode).text(path)
    else:
        plans.write.mode(mode).parquet(path)
