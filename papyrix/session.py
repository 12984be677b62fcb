"""Session defaults, and tables in the shared folder that cut a plan in two."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """For tests and benchmarks; on a cluster the submitted configuration holds."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def spread(rows: DataFrame) -> DataFrame:
    """A table just read, dealt to all cores if its files have fewer splits than there are cores, as one file of one row
    group has. Large inputs have more and stay as they are."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def for_long_texts(spark: SparkSession, rows: int = 500) -> None:
    """Rows that go to Python at once, for the whole session; applications set it, operators don't. Each running task holds
    several copies of a batch, inside and outside the JVM."""
    if not 0 < int(spark.conf.get(ARROW_ROWS)) <= rows:
        spark.conf.set(ARROW_ROWS, str(rows))


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; a temporary one only on a local master without that setting."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        shared = _temporary()
    return shared.rstrip("/")


@lru_cache(maxsize=1)
def _temporary() -> str:
    folder = tempfile.mkdtemp(prefix="papyrix-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch(spark: SparkSession) -> str:
    """Where this application's intermediate tables go. Nothing there is needed once the application has ended."""
    return f"{shared_folder(spark)}/papyrix-{spark.sparkContext.applicationId}"


def cut(df: DataFrame) -> DataFrame:
    """The rows, written as Parquet to the shared folder and read again: what comes after neither repeats what came
    before nor depends on the executors that did it, reads only the columns it needs, and knows the table's real size."""
    path = f"{scratch(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows that may be broadcast: with keys and a few numbers some MB.
SMALL = 100_000


def if_small(table: DataFrame, rows: int = SMALL) -> DataFrame:
    """A narrow table that cut() gave, marked for broadcast if its number of rows, which is in the files' footers, is
    within the bound; else as it is, and the join shuffles it."""
    return F.broadcast(table) if table.count() <= rows else table
