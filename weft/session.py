"""Session helpers: building a local session for tests/bench and resolving the
shared checkpoint folder used to cut lineage in iterative operators."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, app: str = "weft") -> SparkSession:
    """A local session for tests and the bench. On a cluster, build your own
    session; the library only reads settings from it."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only a local-mode session without the
    setting (tests, the bench) gets a fresh scratch folder of its own; on a
    cluster a missing setting is an error, because a machine-local folder is not
    visible to other executors and does not survive their loss."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS/S3) before running iterative operators")
        conf = tempfile.mkdtemp(prefix="weft-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf)
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder for written
    intermediate tables (never a machine-local temp folder on a cluster)."""
    base = checkpoint_dir(spark)
    # grouped per application: one folder to drop once the run's results are used
    return os.path.join(base, "tables", spark.sparkContext.applicationId, f"{name}-{uuid.uuid4().hex[:12]}")


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder
    and read it back: one computation, no lineage behind it, and the data
    survives executor loss (unlike a local checkpoint or a cache)."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition only when a scan has fewer partitions than the
    session can run at once (e.g. one small file). On a cluster reading many
    files this is a no-op, so no shuffle is added where the scan already
    parallelises. An input that shuffles has its partitions sized by AQE: it is
    left as it is, since asking for their number would run its stages."""
    if df.isStreaming or df._jdf.queryExecution().executedPlan().getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        return df
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < want:
        return df.repartition(want)
    return df


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``weft`` importable in Python workers (like ``--py-files``): zip
    the package once per SparkContext and add it with ``addPyFile``."""
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import shutil

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out_dir = tempfile.mkdtemp(prefix="weft-pyfiles-")
    archive = shutil.make_archive(os.path.join(out_dir, "weft"), "zip", root_dir=os.path.dirname(pkg_dir), base_dir="weft")
    sc.addPyFile(archive)
    _SHIPPED.add(key)


# Bound on the bytes of any table this library broadcasts (checked, not assumed).
MAX_BROADCAST_BYTES = 256 << 20
# Bound on the bytes of keys and answers that meet requests in a broadcast: one call
# has several such tables, and each passes through the driver.
ANSWER_BYTES = 16 << 20


def row_bytes(df: DataFrame):
    """An estimate of one row's payload from above: string and binary lengths,
    8 bytes per scalar or element of an array of scalars, twice the JSON text of
    other nested values, as a column."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, (T.NumericType, T.BooleanType, T.DatetimeType)):
            parts.append(F.coalesce(F.size(c), F.lit(0)) * 8 + 16)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            # nested values: their text form, twice over for offsets
            parts.append(F.coalesce(F.octet_length(F.to_json(F.struct(c.alias("v")))), F.lit(0)) * 2)
        else:
            parts.append(F.lit(8))
    total = F.lit(0).cast("long")
    for p_ in parts:
        total = total + p_.cast("long")
    return total


def table_size(df: DataFrame) -> tuple[int, int]:
    """(rows, estimated bytes) of ``df`` with one aggregate job."""
    from pyspark.sql import functions as F

    r = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("b")).first()
    return int(r["n"]), int(r["b"])


def write_measured(df: DataFrame, name: str = "stage", path: str | None = None, **counts) -> tuple[DataFrame, dict]:
    """``cut_lineage`` that also counts while it writes: the table read back,
    and ``rows``, ``bytes`` (as ``row_bytes``) and the sums of ``counts``
    (name = numeric column), without a job of their own."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    seen = Observation(f"written-{uuid.uuid4().hex[:12]}")
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in counts.items()]
    df.observe(seen, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes"), *sums).write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    found = dict(seen.get)
    if "rows" not in found:  # an input known to be empty is not observed
        found = out.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_bytes(out)), F.lit(0)).alias("bytes"), *sums).first().asDict()
    return out, {k: int(v) for k, v in found.items()}


def broadcast_measured(df: DataFrame, sizes: dict, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``broadcast_if_small`` of a table measured by ``write_measured``."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if sizes["rows"] <= max_rows and sizes["bytes"] <= max_bytes else df


def broadcast_if_small(df: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast-hint ``df`` only after checking it has at most ``max_rows``
    rows and ``max_bytes`` estimated bytes; above that, leave it to a shuffle
    join. The check is one aggregate job over the (small, usually aggregated
    or materialised) side."""
    from pyspark.sql import functions as F

    n, b = table_size(df)
    if n <= max_rows and b <= max_bytes:
        return F.broadcast(df)
    return df
