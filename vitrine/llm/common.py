"""What the operators share: tables, the shared folder, lineage cuts and Arrow helpers."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import ship


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; a temporary one only where it is unset
    and the session is local."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        set_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        where = set_dir.get().rsplit("/", 1)[0] if set_dir.isDefined() else None
    if not where:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        where = tempfile.mkdtemp(prefix="vitrine-")
        spark.conf.set("spark.checkpoint.dir", where)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(where)
    return where


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that :func:`scratch_path` named."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


#: Whether a query's shuffle files go at its end; else they stay until the driver happens to collect its garbage.
SWEEP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Frames made within leave no shuffle files behind. Only for frames that are run once: another run of the same frame would miss them."""
    before = spark.conf.get(SWEEP, None)
    spark.conf.set(SWEEP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SWEEP) if before is None else spark.conf.set(SWEEP, before)


def cut(df: DataFrame) -> DataFrame:
    """The rows, written once to the shared folder: later jobs don't recompute them, and a lost executor takes none of them along. The shuffle files
    behind them go."""
    shared_dir(df.sparkSession)
    with swept(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # the frame itself may have been run before, or be run again


#: Bytes of an Arrow batch that goes to a Python worker, unless the session sets it: with long texts a batch has fewer rows.
ARROW_BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


#: The large models of this worker, by what made them, and those that the task at hand has asked for.
_models: dict[tuple, object] = {}
_asked: set[tuple] = set()


def held(load: Callable, *args) -> object:
    """``load(*args)``, kept by a Python worker for later tasks of the same operator. A worker serves all operators of a session: the first task of
    one that doesn't ask for the model drops it, else its tables stand beside whatever comes later."""
    key = (load, *args)
    _asked.add(key)
    if key not in _models:
        _models[key] = load(*args)
    return _models[key]


def started(make: Callable[[], Callable]) -> Callable:
    """What ``make`` gives at the start of a task; models that it hasn't asked for go, and their memory goes back."""
    _asked.clear()
    f = make()
    if gone := _models.keys() - _asked:
        for key in gone:
            del _models[key]
        gc.collect()
        pa.default_memory_pool().release_unused()
    return f


def scan(df: DataFrame, inputs: list[str], outputs: str, make: Callable[[], Callable[..., list]], keep: list[str] | None = None) -> DataFrame:
    """Appends columns that a Python function makes from whole Arrow columns, batch by batch, without a shuffle.

    ``make`` runs once per task and returns ``f(*columns) -> list of arrays``, given the ``inputs`` as Arrow arrays.
    ``keep`` names the columns that pass through (all of them by default; their values never become Python objects). An
    output replaces a kept column of its name.
    """
    ship(df.sparkSession)
    if df.sparkSession.conf.get(ARROW_BATCH[0], None) is None:
        df.sparkSession.conf.set(*ARROW_BATCH)
    added = T._parse_datatype_string(outputs)
    names = [c for c in (df.columns if keep is None else keep) if c not in added.names]
    fed = df.select(*dict.fromkeys([*names, *inputs]))
    schema = T.StructType([*[df.schema[c] for c in names], *added.fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = None
        for b in batches:
            f = f or started(make)
            new = f(*[b.column(b.schema.get_field_index(c)) for c in inputs])
            kept = [b.column(b.schema.get_field_index(c)) for c in names]
            cols = [c if c.type == t.type else c.cast(t.type) for c, t in zip([*kept, *[n if isinstance(n, pa.Array) else pa.array(n, t.type) for n, t in zip(new, list(arrow)[len(names) :])]], arrow)]
            yield pa.RecordBatch.from_arrays(cols, schema=pa.schema([pa.field(t.name, t.type) for t in arrow]))

    return fed.mapInArrow(run, schema)


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 of a string column without decoding it."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


#: A key with more than this share of all rows is hot; there are fewer than its inverse.
HOT_SHARE = 1 / 1000


def hot_keys(many: DataFrame, key: str) -> DataFrame:
    """The keys that more than ``HOT_SHARE`` of the rows have: at most 1000."""
    counts = many.groupBy(key).agg(F.count("*").alias("n"))
    total = many.count()
    return cut(counts.where(F.col("n") > total * HOT_SHARE).select(key))


def join_hot(many: DataFrame, one: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """The inner join of ``many`` with ``one``, which has narrow rows, one for each key: rows of ``hot`` keys stay where they are, the others are shuffled."""
    if hot.isEmpty():
        return many.join(one, key)
    beside = F.broadcast(cut(one.join(F.broadcast(hot), key, "left_semi")))  # at most 1000 rows
    return many.join(beside, key).unionByName(many.join(F.broadcast(hot), key, "left_anti").join(one, key))
