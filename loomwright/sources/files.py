"""A sink that writes one file for each row, and the layouts of segment, discarded, part and enhanced files.

``spark.dataSource.register(RowFiles)`` makes it known; ``write_files`` does
so. A file is written under a temporary name and renamed once it is whole, so
that tasks that are killed, repeated or run twice leave whole files only, and
no list of files passes the driver: ``listed`` finds them again in tasks. Any
file system that pyarrow knows will do.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import Row, StructType

from loomwright.functions.tables import spread, written
from loomwright.functions.text import safe_stem

#: Folders that many files are dealt over, and entries of a folder that a task hands on at once.
FOLDERS, MOST_ENTRIES = 4096, 10_000


@lru_cache(maxsize=16)
def _system(root: str):
    """The file system of a folder, and its path there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)


@dataclass
class Written(WriterCommitMessage):
    n: int


class RowFiles(DataSource):
    """Rows ``path`` (relative) and ``content`` as files under the folder that is saved to; option ``job`` names the temporary folder."""

    @classmethod
    def name(cls) -> str:
        return "row_files"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if not {"path", "content"} <= set(schema.names):
            raise ValueError("rows need the columns path and content")
        return _Writer(self.options["path"], self.options.get("job") or uuid.uuid4().hex, overwrite)


class _Writer(DataSourceWriter):
    def __init__(self, root: str, job: str, overwrite: bool):
        self.root, self.staging, self.overwrite = root, f"_temporary-{job}", overwrite

    def _files(self):
        return _system(self.root)

    def write(self, rows: Iterator[Row]) -> Written:
        files, root = self._files()
        n, made = 0, set()
        temporary = f"{root}/{self.staging}"
        files.create_dir(temporary)
        for row in rows:
            parts = row["path"].split("/")
            if row["path"].startswith("/") or ".." in parts:
                raise ValueError(f"unsafe path {row['path']}")
            folder = "/".join([root, *parts[:-1]])
            if folder not in made:
                files.create_dir(folder)
                made.add(folder)
            half = f"{temporary}/{uuid.uuid4().hex}"
            with files.open_output_stream(half) as out:
                out.write(bytes(row["content"]))
            files.move(half, f"{root}/{row['path']}")
            n += 1
        return Written(n)

    def _clean(self) -> None:
        files, root = self._files()
        if files.get_file_info(f"{root}/{self.staging}").is_file or files.get_file_info(f"{root}/{self.staging}").type.name == "Directory":
            files.delete_dir(f"{root}/{self.staging}")

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        files, root = self._files()
        self._clean()
        files.create_dir(root)
        with files.open_output_stream(f"{root}/_SUCCESS"):
            pass

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._clean()


def write_files(rows: DataFrame, root: str, overwrite: bool = False) -> None:
    """Writes ``path, content`` rows under ``root``. A path that two rows share, or without ``overwrite`` one that is there already, is refused before anything is written."""
    twice = rows.groupBy("path").count().where("count > 1").select("path").limit(1).collect()
    if twice:
        raise FileExistsError(f"two rows are to be written to {twice[0]['path']}")
    if not overwrite and (there := _there(rows, root)):
        raise FileExistsError(f"{root}/{there} is there already")
    spark = rows.sparkSession
    spark.dataSource.register(RowFiles)
    rows.select("path", "content").write.format("row_files").mode("append").option("job", uuid.uuid4().hex).save(root)


def _there(rows: DataFrame, root: str) -> str | None:
    """A path of ``rows`` that is a file under ``root``, or None."""
    from pyspark.errors import AnalysisException

    try:
        files = rows.sparkSession.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select(F.col("path").alias("_p"))
    except AnalysisException:  # no such folder
        return None
    mark = root.split("://")[-1].removeprefix("file:").rstrip("/")
    known = files.select(F.substring_index("_p", f"{mark}/", -1).alias("_p"))
    found = rows.join(known, F.col("path") == F.col("_p")).select("path").limit(1).collect()
    return found[0]["path"] if found else None


def in_folders(files: DataFrame) -> DataFrame:
    """``files`` with their ``path`` in one of FOLDERS folders, by a hash of it: none has more files than a task can list, and equal paths stay equal."""
    folder = F.lpad(F.lower(F.hex(F.pmod(F.xxhash64("path"), F.lit(FOLDERS)))), len(f"{FOLDERS - 1:x}"), "0")
    return files.withColumn("path", F.concat_ws("/", folder, "path"))


def listed(spark: SparkSession, root: str) -> DataFrame:
    """``path`` (relative) and ``length`` of the files under ``root``, but for names with ``_`` or ``.`` in front, as Spark's readers skip them.

    A folder is listed in a task, all of one depth at once, so the driver
    holds neither files nor folders.
    """

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, top = _system(root)
        for batch in batches:
            for folder in batch.column("folder").to_pylist():
                found = files.get_file_info(fs.FileSelector(f"{top}/{folder}".rstrip("/")))
                kept = [x for x in found if x.base_name[:1] not in ("_", ".")]
                for k in range(0, len(kept), MOST_ENTRIES):
                    some = kept[k : k + MOST_ENTRIES]
                    paths = pa.array([f"{folder}/{x.base_name}".lstrip("/") for x in some], pa.string())
                    yield pa.record_batch([paths, pa.array([x.size if x.is_file else None for x in some], pa.int64())], ["path", "length"])

    folders, found = spark.range(1).select(F.lit("").alias("folder")), []
    while not found or not folders.isEmpty():
        here = written(spread(folders, "folder").mapInArrow(entries, "path string, length long"))
        found.append(here.where("length is not null"))
        folders = here.where("length is null").select(F.col("path").alias("folder"))
    return reduce(DataFrame.union, found)


def content_of(path: str, root: str) -> bytes:
    """What the file at a relative path under ``root`` holds."""
    files, top = _system(root)
    with files.open_input_stream(f"{top}/{path}") as f:
        return f.read()


def _utf8(text: Column) -> Column:
    return F.encode(F.coalesce(text, F.lit("")), "UTF-8")


def segment_files(segments: DataFrame, digits: int = 4) -> DataFrame:
    """``path, content`` of segments (source_id, segment_index, status, wav, transcript, meta as JSON text), by source.

    Kept ones give ``audios/n.wav`` and ``transcripts/n.txt``; others
    ``discarded_audios/n.wav`` with its text and its ``meta`` beside it.
    Segments without sound have no audio file.
    """
    source = safe_stem(F.col("source_id").cast("string"))
    stem = F.concat(source, F.lit("_"), F.lpad(F.col("segment_index").cast("string"), digits, "0"))
    kept = F.col("status") == "kept"

    def file(folder: str, ending: str, content: Column, when: Column) -> Column:
        return F.when(when, F.struct(F.concat_ws("/", source, F.lit(folder), F.concat(stem, F.lit(ending))).alias("path"), content.alias("content")))

    sound, text = F.col("wav").isNotNull(), _utf8(F.col("transcript"))
    files = F.array_compact(
        F.array(
            file("audios", ".wav", F.col("wav"), kept & sound), file("transcripts", ".txt", text, kept),
            file("discarded_audios", ".wav", F.col("wav"), ~kept & sound), file("discarded_audios", ".txt", text, ~kept), file("discarded_audios", ".json", _utf8(F.col("meta")), ~kept),
        )
    )
    return segments.select(F.inline(files))


def trace_files(traces: DataFrame) -> DataFrame:
    """``path, content`` of the trace of each phase (source_id, phase, and any columns): one JSON array a source and phase, in the order of ``at``."""
    fields = [c for c in traces.columns if c not in ("source_id", "phase", "at")]
    record = F.struct("at", F.to_json(F.struct(*fields)).alias("j"))
    source = safe_stem(F.col("source_id").cast("string"))
    grouped = traces.groupBy("source_id", "phase").agg(F.array_sort(F.collect_list(record)).alias("r"))
    text = F.concat(F.lit("["), F.array_join(F.transform("r", lambda r: r["j"]), ",\n"), F.lit("]"))
    return grouped.select(F.concat_ws("/", source, F.lit("traces"), F.concat("phase", F.lit(".json"))).alias("path"), _utf8(text).alias("content"))


def part_name() -> Column:
    """The file name of a part (stem, part_index, part_count): the stem alone where there is one part."""
    number = F.lpad((F.col("part_index") + 1).cast("string"), 3, "0")
    return F.concat(F.when(F.col("part_count") == 1, F.col("stem")).otherwise(F.concat("stem", F.lit("_part"), number)), F.lit(".wav"))


def part_files(parts: DataFrame) -> DataFrame:
    """``path, content`` of the parts of long files (stem, part_index, part_count, wav), named by :func:`part_name`."""
    return parts.select(part_name().alias("path"), F.col("wav").alias("content"))


def enhanced_files(outputs: DataFrame) -> DataFrame:
    """``path, content`` of a model's outputs (stem, speaker, n_speakers, wav): ``_s1``, ``_s2`` behind the stem where there are several speakers."""
    name = F.when(F.col("n_speakers") == 1, F.col("stem")).otherwise(F.concat("stem", F.lit("_s"), F.col("speaker").cast("string")))
    return outputs.select(F.concat(name, F.lit(".wav")).alias("path"), F.col("wav").alias("content"))
