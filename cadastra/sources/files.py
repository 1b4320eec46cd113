"""Single delivered files: their list, their first lines, and what is damaged."""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import urlsplit

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

OPEN_AT_ONCE = 16  # files whose first line is read at the same time
_ALONE = str(1 << 40)  # opening a file is priced higher than any partition: no two share one
_STEP = 1 << 20


def _one_file_per_task(spark: SparkSession) -> SparkSession:
    """A session of its own (same context, its own SQL settings) in which every file is a partition and a batch."""
    side = spark.newSession()
    side.conf.set("spark.sql.files.openCostInBytes", _ALONE)
    side.conf.set("spark.sql.files.maxPartitionBytes", _ALONE)
    side.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    return side


def list_files(spark: SparkSession, glob: str) -> list[str]:
    """The files a path pattern matches, empty ones included (none if nothing matches)."""
    try:
        return sorted(spark.read.format("text").load(glob).inputFiles())
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def _first_line(spark: SparkSession, conf, file: str) -> bytes | None:
    hadoop = spark._jvm.org.apache.hadoop
    path = hadoop.fs.Path(spark._jvm.java.net.URI.create(file))
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        line = hadoop.io.Text()
        got = hadoop.util.LineReader(codec.createInputStream(stream) if codec else stream).readLine(line)
        return bytes(line.copyBytes()) if got else None
    except Py4JJavaError:  # nothing readable at its start
        return None
    finally:
        stream.close()


def first_lines(spark: SparkSession, files: Sequence[str]) -> dict[str, bytes]:
    """First line of every file, as bytes; a file without one (empty, or damaged from its start) is left out.

    As with the footers of columnar files, the driver opens each file and reads
    one buffer of it, several files at once: what is read does not grow with
    the files, only with their number.
    """
    if not files:
        return {}
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    with ThreadPoolExecutor(OPEN_AT_ONCE) as pool:
        lines = pool.map(lambda f: _first_line(spark, conf, f), files)
        return {f: line for f, line in zip(files, lines) if line is not None}


def _fault(data: bytes) -> str | None:
    """Why a gzip file cannot be read to its end; None if it can."""
    view, at = memoryview(data), 0
    while at < len(view):
        member = zlib.decompressobj(wbits=31)
        try:
            while not member.eof:
                if at >= len(view):
                    return "the file ends before its data"
                member.decompress(view[at : at + _STEP])
                at += min(_STEP, len(view) - at)
        except zlib.error as e:
            return str(e)
        at -= len(member.unused_data)
    return None


def gzip_faults(spark: SparkSession, files: Sequence[str]) -> dict[str, str]:
    """``{path: fault}`` of the files that cannot be unpacked; one file is in a task's memory at a time."""
    if not files:
        return {}

    def test(batches):
        for batch in batches:
            found = [(p.as_py(), _fault(c.as_py())) for p, c in zip(batch.column(0), batch.column(1))]
            found = [f for f in found if f[1] is not None]
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.string()) for i in range(2)],
                                             names=["path", "fault"])

    whole = _one_file_per_task(spark).read.format("binaryFile").load(list(files))
    found = whole.select(F.col("_metadata.file_path").alias("path"), "content").mapInArrow(test, "path string, fault string")
    named = {urlsplit(f).path: f for f in files}  # sources differ in how they write the scheme
    return {named[urlsplit(r["path"]).path]: r["fault"] for r in found.collect()}
