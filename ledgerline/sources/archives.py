"""Zip archives → member lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import text
from ledgerline.workspace import Workspace

LINES = "path string, member string, line_no long, line binary"

# Bytes of an empty zip file.
SMALLEST_ZIP = 22
# Most tasks one expansion is spread over; beyond that, a task takes several members.
MAX_TASKS = 10_000


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Path and length of every file below ``path`` that is not empty. Contents are not read."""
    return spark.read.format("binaryFile").load(path).select("path", "length")


def list_members(archives: DataFrame) -> DataFrame:
    """``(path, member)`` of every zip file among the paths. What is no zip file is skipped."""

    def read_names(batches):
        import zipfile

        import pyarrow as pa
        from pyarrow import fs

        for batch in batches:
            for path, place in zip(batch.column("path").to_pylist(), batch.column("place").to_pylist()):
                system, inner = fs.FileSystem.from_uri(place)
                with system.open_input_file(inner) as raw:
                    if raw.size() >= SMALLEST_ZIP and zipfile.is_zipfile(raw):
                        names = zipfile.ZipFile(raw).namelist()
                        yield pa.RecordBatch.from_pydict({"path": [path] * len(names), "member": names})

    return archives.select("path", _place()).mapInArrow(read_names, "path string, member string")


def expand(archives: DataFrame, space: Workspace | None = None) -> DataFrame:
    """Every line of every member of every zip file, undecoded, as ``(path, member, line_no, line)``.

    Members go to tasks of their own. A task opens its path itself and inflates the member as a stream, so
    memory does not grow with the member, and the 2 GiB limit of a binary value does not apply. One member is
    one stream and so one task; ``repartition`` what comes out if few are large.
    """

    def read_lines(batches):
        import zipfile

        import pyarrow as pa
        from pyarrow import fs

        block = 4 << 20

        def lines_of(stream):
            """Lists of complete lines, whatever the block boundaries."""
            tail = []
            while data := stream.read(block):
                first, *more = data.split(b"\n")
                tail.append(first)
                if more:
                    *complete, rest = more
                    yield [b"".join(tail), *complete]
                    tail = [rest]
            if last := b"".join(tail):
                yield [last]

        for batch in batches:
            for row in batch.to_pylist():
                system, inner = fs.FileSystem.from_uri(row["place"])
                done = 0
                with (
                    system.open_input_file(inner) as raw,
                    zipfile.ZipFile(raw) as archive,
                    archive.open(row["member"]) as stream,
                ):
                    for lines in lines_of(stream):
                        n = len(lines)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([row["path"]] * n, pa.string()),
                                pa.array([row["member"]] * n, pa.string()),
                                pa.array(range(done, done + n), pa.int64()),
                                pa.array(lines, pa.binary()),
                            ],
                            names=["path", "member", "line_no", "line"],
                        )
                        done += n

    # Kept, so that every archive's directory is read once.
    space = space or Workspace(archives.sparkSession, "members")
    members = space.keep(list_members(archives), "members")
    # A number of its own for each member: by size, Spark would put these short rows into one task.
    tasks = max(1, min(members.count(), MAX_TASKS))
    return members.select("path", _place(), "member").repartition(tasks).mapInArrow(read_lines, LINES)


def _place():
    """The path the way a task opens it: a plain one on a file system all machines share, else a URI.

    Tasks open archives with pyarrow: plain paths, ``s3:``, ``gs:`` and ``hdfs:`` work, with the credentials that pyarrow
    finds on the machine; any other scheme fails the task with a message that names it.
    """
    plain = F.regexp_replace("path", "^file:/+", "/")
    return F.regexp_replace(plain, "^s3[an]://", "s3://").alias("place")


def route(lines: DataFrame) -> DataFrame:
    """Lines of each archive's own member, the one named like the archive without its suffix; others are
    dropped. ``dataset`` is what follows the member name's last dot."""
    file_name = F.element_at(F.split("path", "/"), -1)
    return lines.where(F.col("member") == text.strip_suffix(file_name)).withColumn(
        "dataset", F.element_at(F.split("member", r"\."), -1)
    )


def land(routed: DataFrame, path: str) -> None:
    """Write routed lines back as raw text, one ``dataset=<SUFFIX>`` folder each, in one pass over the archives.

    The bytes are written as they are: the text writer does not re-encode.
    """
    (
        routed.select(F.col("line").cast("string").alias("value"), "dataset")
        .write.mode("overwrite")
        .partitionBy("dataset")
        .text(path)
    )
