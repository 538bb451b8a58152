"""Drop-folder ingestion as a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from adloom.session import move_folder
from adloom.sources.delimited import described, read_delimited, store_lines

#: Characters with which Spark's file stream takes a name for a pattern and reads other files again.
PATTERN = r"[*?\[\]{}]"

#: Files of a micro-batch unless the caller says otherwise.
MAX_FILES = 1000


def ingest_folder(
    spark: SparkSession,
    src: str,
    schema: T.StructType,
    out: str,
    checkpoint: str,
    archive: str | None = None,
    sep: str = ",",
    skip_rows: int = 0,
    max_files: int = MAX_FILES,
    rejects: str | None = None,
) -> StreamingQuery:
    """Append every file not yet seen in ``src`` to the Parquet table ``out``, then stop.

    The checkpoint remembers taken files. The stream itself reads each file, whatever its
    name, once; its lines are stored with their file and place, and all else works on them.
    A micro-batch of at most ``max_files`` files is written beside the table and, when whole,
    put into its own folder (``batch=<n>``), so one that is run again after a failure adds no
    row twice. A name that Spark would take for a pattern (``* ? [ ] { }``) ends the run with an
    error. ``archive`` moves a file away one run after it was read. Files begin with
    ``skip_rows`` preamble lines and a header; short lines and bad values give nulls. Lines
    with too many fields, counted while the rows are written, go to the table ``rejects`` or,
    without one, end the run with an error before its batch shows.
    """
    reader = spark.readStream.format("text").option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)

    def take(batch: DataFrame, number: int) -> None:
        lines = store_lines(batch)
        doubled = lines.files.filter(F.col("file_path").rlike(PATTERN)).first()
        if doubled is not None:
            raise ValueError(f"{doubled['file_path']}: Spark takes this name for a pattern; rename the file")
        found = read_delimited(spark, lines, schema, sep, skip_rows)
        seen, taken = Observation(), f"{out}/_taking-{number}"
        found.counting_rows(seen).drop("file_path").write.mode("overwrite").parquet(taken)
        if seen.get["rejects"]:
            if not rejects:
                wrong = found.rejects.first()
                raise ValueError(f"{wrong['file_path']}: {wrong['reason']}: {wrong['line'][:200]}")
            found.rejects.write.mode("overwrite").parquet(f"{rejects}/batch={number}")
        move_folder(spark, taken, f"{out}/batch={number}")

    query = (
        described(reader.load(src))
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
