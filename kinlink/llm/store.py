"""Tables that cut lineage, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}
#: Tables written since each tidy() call that is under way began.
_OPEN: list[list[DataFrame]] = []


def shared_dir(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir. Where it is unset a temporary folder serves on one machine; on a cluster that is an error, as executors would not share it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="kinlink-")
    return _OWN[app]


def cut(df: DataFrame) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back, so that a lost executor never replays more than this."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/kinlink/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._kinlink_path = path
    if _OPEN:
        _OPEN[-1].append(out)
    return out


def drop(df: DataFrame) -> None:
    """Delete a table that cut() wrote and that nothing will read again."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._kinlink_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def tidy(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """f with its result written and every other table that it cut dropped, so that only the result stays in the shared folder."""

    @wraps(f)
    def run(*args, **kwargs) -> DataFrame:
        made: list[DataFrame] = []
        out = None
        _OPEN.append(made)
        try:
            out = cut(f(*args, **kwargs))
        finally:
            _OPEN.pop()
            for table in made:
                if table is not out:
                    drop(table)
        if _OPEN:
            _OPEN[-1].append(out)
        return out

    return run


def batches_of(rows: int) -> Callable[[Callable[..., DataFrame]], Callable[..., DataFrame]]:
    """A decorator: while f (whose first argument is a DataFrame) runs, executors send Python so many rows at a time at most, so that long texts take less memory. The session's setting stands again afterwards."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"

    def held(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @wraps(f)
        def run(df: DataFrame, *args, **kwargs) -> DataFrame:
            conf = df.sparkSession.conf
            before = conf.get(key)
            conf.set(key, str(rows if int(before) <= 0 else min(rows, int(before))))
            try:
                return f(df, *args, **kwargs)
            finally:
                conf.set(key, before)

        return run

    return held
