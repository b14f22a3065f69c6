"""Triplet text files as a stream, appended to a parquet cell log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..model import I, J, V, TileMatrix, TileVector
from ..session import scratch_path
from ..sources.relation import from_relation, vector_from_relation
from ..sources.text import MATRIX_SCHEMA, VECTOR_SCHEMA


#: Column that keeps the text of a line that is no cell (NULL for cells).
BAD = "bad_line"


def _reader(spark: SparkSession, schema: str, delim: str):
    """A malformed line is kept as text in column ``bad_line``; nothing is dropped."""
    return (spark.readStream.schema(f"{schema}, {BAD} string").option("sep", delim)
            .option("header", "false").option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", BAD))


def read_text_stream(spark: SparkSession, path: str, delim: str = ",",
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``(i, j, v)`` frame over triplet files arriving in ``path``."""
    r = _reader(spark, MATRIX_SCHEMA, delim)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.csv(path)


def read_text_vector_stream(spark: SparkSession, path: str, delim: str = ",",
                            max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``(i, v)`` frame over pair files arriving in ``path``."""
    r = _reader(spark, VECTOR_SCHEMA, delim)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.csv(path)


def append_cells_log(stream: DataFrame, log_path: str, checkpoint: str | None = None,
                     available_now: bool = True) -> StreamingQuery:
    """Append the stream's cells to a parquet log (file sink: exactly once).

    Lines that are no cells (malformed, or with an empty field) go to the log as well, with
    their text in ``bad_line``: ``rejected_lines`` lists them, the matrix leaves them out.
    ``checkpoint`` defaults to a fresh folder under the session's shared
    ``spark.checkpoint.dir``; pass a stable path to resume a stream.  With ``available_now``
    the query processes what is there and stops.
    """
    spark = stream.sparkSession
    cols = [c for c in (I, J, V) if c in stream.columns]
    empty = F.greatest(*[F.col(c).isNull().cast("int") for c in cols]) == 1
    text = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    bad = F.col(BAD) if BAD in stream.columns else F.lit(None).cast("string")
    clean = stream.select(*cols, F.when(empty, F.coalesce(bad, text)).otherwise(bad).alias(BAD))
    w = (clean.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-ckpt")))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start(log_path)


def _log(spark: SparkSession, log_path: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, {BAD} string").parquet(log_path)


def rejected_lines(spark: SparkSession, log_path: str) -> DataFrame:
    """The logged lines that are no cells, as one column ``bad_line``."""
    return spark.read.schema(f"{BAD} string").parquet(log_path).where(F.col(BAD).isNotNull())


def load_cells_log(spark: SparkSession, log_path: str, shape: tuple[int, int],
                   tile: tuple[int, int] = (512, 512)) -> TileMatrix:
    """The matrix accumulated so far: all logged updates summed per ``(i, j)``."""
    log = _log(spark, log_path, MATRIX_SCHEMA).where(F.col(BAD).isNull())
    return from_relation(log, I, J, V, shape=shape, tile=tile)


def load_vector_log(spark: SparkSession, log_path: str, n: int, tile: int = 1024) -> TileVector:
    log = _log(spark, log_path, VECTOR_SCHEMA).where(F.col(BAD).isNull())
    return vector_from_relation(log, I, V, n=n, tile=tile)
