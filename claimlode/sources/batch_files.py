"""Batch files: one metadata file and one vector file per batch number, and the parquet layout.

Vector (.npy) files of older runs are read in place, in slices of bounded size by byte offset, so that a large
file keeps many tasks busy and no task holds it whole. Metadata (.csv) files are read one task per file, since
quoted line breaks hide where a row starts. The position of a row is its line in the file. New data
lives in parquet with text and vector on one row.
"""

from __future__ import annotations

import io
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.csv as pacsv
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows per Arrow batch that a file reader hands on.
READ_ROWS = 10_000
# Bytes of a vector file that one task reads.
SLICE_BYTES = 64 << 20
# Bytes of slices, and slices, that one task takes one after the other; a slice costs an opened file.
TASK_BYTES = 64 << 20
TASK_SLICES = 512
# Fixed value: the number just before the file ending is the batch number.
BATCH_NUMBER_PATTERN = r"(\d+)\.[^.]*$"


def _batch_number() -> Column:
    number = F.regexp_extract(F.col("_metadata.file_name"), BATCH_NUMBER_PATTERN, 1)
    return F.nullif(number, F.lit("")).cast("int").alias("batch_id")


def _files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return files.select(_batch_number(), "content")


def matrix_header(file: pa.NativeFile) -> tuple[int, tuple[int, int], bool, np.dtype]:
    """(byte at which the values start, shape, whether columns come first, type) of a dense matrix file."""
    head = io.BytesIO(file.read_at(min(file.size(), 4096), 0))
    version = np.lib.format.read_magic(head)
    read = np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0
    shape, by_column, kind = read(head)
    if len(shape) != 2 or kind.hasobject:
        raise ValueError(f"not a dense matrix: shape {shape}, type {kind}")
    return head.tell(), shape, by_column, kind


def matrix_batches(number: int | None, matrix: np.ndarray, first: int) -> Iterator[pa.RecordBatch]:
    """Rows (batch_id, pos, embedding) of a part of a matrix that starts at row ``first``."""
    for start in range(0, len(matrix), READ_ROWS):
        part = np.asarray(matrix[start : start + READ_ROWS], np.float32)
        ends = np.arange(len(part) + 1, dtype=np.int32) * part.shape[1]
        at = first + start
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([number] * len(part), pa.int32()),
                pa.array(np.arange(at, at + len(part))),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(part.ravel())),
            ],
            names=["batch_id", "pos", "embedding"],
        )


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the place in it; local paths may hold any character."""
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def ranged_access(path: str) -> bool:
    """Whether the tasks can read byte ranges of files below ``path`` themselves, not only through Spark."""
    try:
        located(path)
    except (pa.ArrowInvalid, OSError):
        return False
    return True


VECTOR_SCHEMA = "batch_id int, pos bigint, embedding array<float>"


def read_vector_batches(
    spark: SparkSession, path: str, pattern: str = "*.npy", slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """Rows (batch_id, pos, embedding) of dense matrix files, as float32.

    Files are cut into slices of ``slice_bytes``; a task opens the file, reads its header and the rows that start
    in its slice. Small slices share a task. Only names and sizes of the files are listed beforehand. Where the tasks have no
    access to byte ranges (a store that only Spark knows) each file is read whole by one task.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    listed = files.select("path", "length", _batch_number())
    first = listed.select("path").first()
    if first is None or not ranged_access(first["path"]):
        return _whole_vector_files(spark, path, pattern)
    cuts = F.sequence(F.lit(0).cast("bigint"), F.floor((F.greatest("length", F.lit(1)) - 1) / slice_bytes))
    slices = listed.select("path", "length", "batch_id", F.explode(cuts).alias("cut"))
    n_slices, n_bytes = slices.agg(F.count("*"), F.sum(F.least("length", F.lit(slice_bytes)))).first()
    tasks = max(spark.sparkContext.defaultParallelism, -(-n_slices // TASK_SLICES), -(-n_bytes // TASK_BYTES))
    # A given number of partitions is not merged by the adaptive planner, to which these rows look tiny.
    slices = slices.drop("length").repartition(min(n_slices, tasks), "path", "cut")

    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, number, cut in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                system, place = located(name)
                with system.open_input_file(place) as file:
                    begin, (rows, width), by_column, kind = matrix_header(file)
                    if by_column:  # no row lies in one piece: the first slice reads all
                        if cut == 0:
                            yield from matrix_batches(number, np.load(io.BytesIO(file.read_at(file.size(), 0))), 0)
                        continue
                    size = width * kind.itemsize
                    # the rows whose first byte lies in the slice
                    low, high = (min(rows, max(0, -(-((cut + i) * slice_bytes - begin) // max(size, 1)))) for i in (0, 1))
                    if high > low:
                        values = np.frombuffer(file.read_at((high - low) * size, begin + low * size), kind)
                        yield from matrix_batches(number, values.reshape(-1, width), low)

    return slices.mapInArrow(parse, VECTOR_SCHEMA)


def _whole_vector_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                matrix = np.load(io.BytesIO(content.as_buffer()), allow_pickle=False)
                yield from matrix_batches(number, matrix, 0)

    return _files(spark, path, pattern).mapInArrow(parse, VECTOR_SCHEMA)


def read_metadata_batches(
    spark: SparkSession,
    path: str,
    pattern: str = "*.csv",
    columns: tuple[str, ...] = ("patent_id", "cleaned_claim"),
) -> DataFrame:
    """Rows (batch_id, pos, columns...) of metadata files; all columns are text."""
    wanted = list(columns)

    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                table = pacsv.read_csv(
                    pa.BufferReader(content.as_buffer()),
                    parse_options=pacsv.ParseOptions(newlines_in_values=True),
                    convert_options=pacsv.ConvertOptions(
                        include_columns=wanted,
                        column_types={name: pa.string() for name in wanted},
                    ),
                )
                start = 0
                for part in table.combine_chunks().to_batches(max_chunksize=READ_ROWS):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(part), number, np.int32)),
                            pa.array(np.arange(start, start + len(part))),
                            *part.columns,
                        ],
                        names=["batch_id", "pos", *wanted],
                    )
                    start += len(part)

    text = ", ".join(f"{name} string" for name in wanted)
    return _files(spark, path, pattern).mapInArrow(parse, f"batch_id int, pos bigint, {text}")


def write_batches(df: DataFrame, path: str, batch: str = "batch_id") -> None:
    """One folder per batch; writing a batch again replaces just that batch.

    The rebalance hint puts a batch into one file unless it is large: then the adaptive planner
    cuts it by size.
    """
    (
        df.hint("rebalance", F.col(batch))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(batch)
        .parquet(path)
    )


def write_batch_files(meta: DataFrame, vectors: DataFrame, path: str) -> None:
    """The older layout: ``batch_<n>.csv`` and ``batch_<n>.npy`` per batch number below ``path``, rows by ``pos``.

    A file is written whole by one task, so a batch has to fit into one: as many rows as a batch of the
    embedding job. ``meta`` holds batch_id, pos and text columns, ``vectors`` batch_id, pos and embedding. The tasks
    must be able to open ``path``. A batch written again replaces itself.
    """
    columns = [name for name in meta.columns if name not in ("batch_id", "pos")]
    located(path)  # fails here rather than in the tasks

    def sink(number: int, ending: str) -> pa.NativeFile:
        system, place = located(path)
        system.create_dir(place, recursive=True)
        return system.open_output_stream(f"{place}/batch_{number}.{ending}")

    def put_text(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("pos")
        number = rows.column("batch_id")[0].as_py()
        with sink(number, "csv") as out:
            pacsv.write_csv(rows.select(columns), out, pacsv.WriteOptions(quoting_style="all_valid"))
        return pa.table({"batch_id": pa.array([number], pa.int32()), "rows": pa.array([rows.num_rows], pa.int64())})

    def put_matrix(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("pos")
        number, values = rows.column("batch_id")[0].as_py(), rows.column("embedding").combine_chunks()
        matrix = values.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(len(values), -1)
        content = io.BytesIO()
        np.save(content, matrix, allow_pickle=False)
        with sink(number, "npy") as out:
            out.write(content.getvalue())
        return pa.table({"batch_id": pa.array([number], pa.int32()), "rows": pa.array([len(values)], pa.int64())})

    schema = "batch_id int, rows bigint"
    for rows, put in ((meta.select("batch_id", "pos", *columns), put_text), (vectors.select("batch_id", "pos", "embedding"), put_matrix)):
        rows.groupBy("batch_id").applyInArrow(put, schema).agg(F.sum("rows")).collect()
