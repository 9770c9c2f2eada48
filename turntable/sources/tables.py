"""Table reads and writes, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException, ParseException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from turntable.errors import PathNotFound, QueryError, TurntableError, WriteError


def read_table(spark: SparkSession, path: str, schema: StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """Load a table. `fmt="avro"` reads Avro files or globs where the session has that source."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.load(path)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            raise PathNotFound(f"{path} does not exist") from err
        raise QueryError(f"cannot read {path}: {err}") from err


def _write(df: DataFrame, path: str, mode: str) -> None:
    try:
        df.write.mode(mode).parquet(path)
    except PySparkException as err:
        raise WriteError(f"cannot write {path}: {err}") from err


def overwrite(df: DataFrame, path: str) -> None:
    """Replace the table at `path`. `df` must not read from `path`."""
    _write(df, path, "overwrite")


def append(df: DataFrame, path: str) -> None:
    """Add rows to the table at `path`, creating it if absent."""
    _write(df, path, "append")


def sorted_by(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Globally ordered for a write: one range per output file.

    Give enough keys to make rows distinct, so that a hot leading key spreads over several files.
    """
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def write_ranking_csv(df: DataFrame, path: str, order: Sequence[str | Column], mode: str = "errorifexists") -> None:
    """Headerless CSV in `order` over part files. Lost tasks are retried by Spark."""
    try:
        sorted_by(df, *order).write.mode(mode).csv(path)
    except PySparkException as err:
        raise WriteError(f"cannot write {path}: {err}") from err


def run_sql(spark: SparkSession, text: str, args: dict | None = None, **tables: DataFrame) -> DataFrame:
    """Run SQL with named parameters (`:name`) over DataFrames named in braces (`{name}`)."""
    try:
        return spark.sql(text, args=args, **tables)
    except ParseException as err:
        raise QueryError(f"cannot parse\n{text}\n{err}") from err
    except AnalysisException as err:
        raise QueryError(f"cannot analyse\n{text}\n{err}") from err
    except PySparkException as err:
        raise QueryError(f"cannot run\n{text}\n{err}") from err


#: Temporary scratch folders of local sessions, by application.
_own_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the session's `spark.checkpoint.dir`.

    Only a local session may go without the setting; it then gets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or _own_roots.get(spark.sparkContext.applicationId)
    root = root or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise TurntableError("set spark.checkpoint.dir to a folder that every executor can reach")
    root = _own_roots[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="turntable-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def _application_root(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/turntable/{spark.sparkContext.applicationId}"


_open_scopes = threading.local()


def scratch_path(spark: SparkSession) -> str:
    """A new path below the innermost scratch scope of this thread, or below this application's folder in the scratch root."""
    scopes = getattr(_open_scopes, "paths", [])
    return f"{scopes[-1] if scopes else _application_root(spark)}/{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there, wherever Spark keeps it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


@contextmanager
def scratch_scope(spark: SparkSession, checkpoints: bool = False) -> Iterator[None]:
    """Own the scratch tables that this thread writes inside, and with `checkpoints` what Spark checkpoints: all go at the end.

    For jobs whose results are written elsewhere before the block ends. A frame that still reads a scratch table must
    not leave it. Checkpoints belong to the whole application, so of several jobs at a time one may own them.
    """
    path = f"{_application_root(spark)}/scope-{uuid.uuid4().hex}"
    scopes = _open_scopes.__dict__.setdefault("paths", [])
    scopes.append(path)
    if checkpoints:
        spark.sparkContext.setCheckpointDir(f"{path}/checkpoints")
    try:
        yield
    finally:
        scopes.remove(path)
        if checkpoints:
            # Spark keeps an own folder below the one it is given; later checkpoints must not go to one that is gone.
            spark.sparkContext.setCheckpointDir(scratch_root(spark))
        drop_path(spark, path)


def materialise(df: DataFrame) -> DataFrame:
    """`df` written once to the scratch folder and read back.

    Cuts lineage without depending on executor-local blocks, fixes the outcome of nondeterministic
    steps, and gives later joins the true size of the table.
    """
    path = scratch_path(df.sparkSession)
    _write(df, path, "errorifexists")
    return df.sparkSession.read.schema(df.schema).parquet(path)
