"""What the operators share: storage that every machine sees, ranks, state of a worker."""

from __future__ import annotations

import atexit
import ctypes
import gc
import re
import shutil
import sys
import tempfile
import uuid

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


#: Rows of a batch that become Python objects at once.
ROWS = 512
#: The temporary folder of this driver process.
_FOLDER: dict[str, str] = {}


def by_value(module: str) -> None:
    """Ship the module's functions to executors whole, so these need not have the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def per_worker(key: tuple, build):
    """``build()`` once in each Python worker process; later tasks there get the same object,
    until a task asks for another one: a worker holds one at a time."""
    kept = vars(sys).setdefault("_lotwise_worker", {})
    if key not in kept:
        release_worker()
        kept[key] = build()
    return kept[key]


def release_worker() -> None:
    """Drop what ``per_worker`` holds; for tasks of a stage that needs their memory otherwise.
    What earlier tasks of the process left free goes back to the system: the executor's other
    worker and its JVM have the same limit."""
    vars(sys).setdefault("_lotwise_worker", {}).clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    # Other C libraries than glibc have no such call.
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def in_parts(batches, rows: int = ROWS):
    """The batches of a task in slices. A batch has up to 64 MB, and its texts as Python
    objects have as much again, or up to four times that where they are not Latin."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Where it is unset, a temporary one for a session
    in one process (tests), and an error for a cluster, whose machines would not see it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        if "shared" not in _FOLDER:
            _FOLDER["shared"] = _temporary()
        root = _FOLDER["shared"]
    return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}"


def _temporary() -> str:
    folder = tempfile.mkdtemp(prefix="lotwise-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it from there: cuts lineage, and a lost executor loses
    nothing of it. The files stay in the shared folder under the application's id."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores before those that ``df`` has columns of."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if it has no more than ``rows`` rows, which is counted."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def with_fields(df: DataFrame, made: str, drop: tuple[str, ...] = ()) -> StructType:
    """Schema of ``df`` without ``drop`` and with the fields of a DDL string."""
    return StructType([f for f in df.schema if f.name not in drop] + StructType.fromDDL(made).fields)


def numbered(df: DataFrame, groups: list[str], key: list[str], buckets: int | None = None) -> DataFrame:
    """Add ``rank`` (from 0, gapless, in each group) and ``position`` (the same over all rows,
    groups in their order) to rows without such columns or ones that begin with ``_n_``.
    The groups must have a bounded number, their sizes need not: each is cut into hash buckets in proportion to its size, so that no task orders more
    than about 1/``buckets`` of the rows. ``key`` must be unique; ``df`` is read three times."""
    buckets = buckets or 16 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = df.groupBy(*groups).agg(F.count("*").alias("_n_size"))
    share = F.ceil(F.col("_n_size") * F.lit(float(buckets)) / F.sum("_n_size").over(Window.partitionBy()))
    cut = sizes.select(*groups, share.cast("int").alias("_n_cuts"))
    # At most one row a group: broadcast whatever the size of the data.
    cut_rows = _same(df, F.broadcast(cut), groups).withColumn("_n_cut", F.expr(f"pmod(xxhash64({', '.join(key)}), _n_cuts)"))
    counts = cut_rows.groupBy(*groups, "_n_cut").agg(F.count("*").alias("_n_rows"))
    before = Window.orderBy(*groups, "_n_cut").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy(*groups).orderBy("_n_cut").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *groups,
        "_n_cut",
        F.coalesce(F.sum("_n_rows").over(before), F.lit(0)).alias("_n_before"),
        F.coalesce(F.sum("_n_rows").over(within), F.lit(0)).alias("_n_within"),
    )
    place = F.row_number().over(Window.partitionBy(*groups, "_n_cut").orderBy(*key)) - 1
    # At most ``buckets`` rows and one for each group.
    joined = _same(cut_rows.withColumn("_n_place", place), F.broadcast(starts), [*groups, "_n_cut"])
    return joined.select(
        *df.columns,
        (F.col("_n_within") + F.col("_n_place")).cast("long").alias("rank"),
        (F.col("_n_before") + F.col("_n_place")).cast("long").alias("position"),
    )


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> DataFrame:
    """Inner join on equal columns, where null equals null."""
    other = right.select(*(F.col(n).alias(f"_n_r_{n}") if n in names else F.col(n) for n in right.columns))
    on = None
    for n in names:
        same = left[n].eqNullSafe(other[f"_n_r_{n}"])
        on = same if on is None else on & same
    return left.join(other, on).drop(*(f"_n_r_{n}" for n in names))


by_value(__name__)
