"""Length-delimited binary record files of token ids, with a separate offset index.

A record is: length of the payload (u64), masked checksum of those 8 bytes (u32), the payload, masked checksum of
the payload (u32). A payload is: has-id (u8), bytes per token (u8), six zero bytes, the document id (i64), the
token ids. All numbers are little-endian. A checksum is CRC-32, rotated right by 15 bits plus a constant, so that a
checksum stored inside checksummed data does not cancel. ``<file>.idx`` holds each record's byte offset (u64) and a
last one for the end of the file, so records can be read in any order.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldstay.llm.storage import freeing_shuffles, map_arrow, materialise, slots_for
from fieldstay.llm.tokens import REMEMBERED, binary_slices, encoder
from fieldstay.llm.words import batches_of

# The mask of record-file checksums.
MASK_DELTA = 0xA282EAD8
HEAD = struct.Struct("<QI")
PAYLOAD = struct.Struct("<BB6xq")


def masked(data) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join([size, struct.pack("<I", masked(size)), payload, struct.pack("<I", masked(payload))])


def unframe(data, at: int = 0) -> tuple[memoryview, int]:
    """The payload at byte ``at`` and the byte after its record; raises on a wrong checksum."""
    view = memoryview(data)
    size, check = HEAD.unpack_from(view, at)
    if masked(view[at : at + 8]) != check:
        raise ValueError(f"damaged record length at byte {at}")
    end = at + HEAD.size + size
    if end + 4 > len(view):
        raise ValueError(f"record at byte {at} is cut off")
    payload = view[at + HEAD.size : end]
    if masked(payload) != struct.unpack_from("<I", view, end)[0]:
        raise ValueError(f"damaged record at byte {at}")
    return payload, end + 4


def pack_record(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    head = PAYLOAD.pack(doc_id is not None, width, doc_id or 0)
    return frame(head + ids.astype(f"<u{width}").tobytes())


def unpack_record(payload) -> tuple[int | None, np.ndarray]:
    known, width, doc_id = PAYLOAD.unpack_from(payload)
    return (doc_id if known else None), np.frombuffer(payload, f"<u{width}", offset=PAYLOAD.size).astype("<u4")


def put(store: fs.FileSystem, source: str, target: str) -> None:
    """Rename to the final name; what an earlier attempt of the task left there is replaced."""
    if store.get_file_info(target).type != fs.FileType.NotFound:
        store.delete_file(target)
    store.move(source, target)


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text",
    end_id: int | None = 1, by_word: bool = True, remembered: int = REMEMBERED,
) -> DataFrame:
    """Encode every whole text (null: empty) and write the ids in ascending order of the id (nulls first, equal ids
    in the order of their texts' hash) as record files in ``folder``, a folder all executors reach by ``pyarrow.fs``.

    Returns the manifest ``(file_no, file, records, tokens, base)``: ``base`` counts the tokens of all files before.
    Rows are exchanged once, by range of the id; a task streams its range into one file under a name of its own
    attempt and renames it when whole, so a retried or doubled task cannot leave a mixture. No rows: no files.
    """
    spark = docs.sparkSession

    def run(batches):
        task = TaskContext.get()
        number, attempt = task.partitionId(), task.taskAttemptId()
        store, root = fs.FileSystem.from_uri(folder)
        coder = encoder(tokenizer, end_id, by_word, remembered)
        name, own = f"part-{number:06d}", f"{root}/.part-{number:06d}-{attempt}"
        records = tokens = at = 0
        data = index = None
        for whole in batches:
            for batch in batches_of(whole, "text", 1 << 22):
                if data is None:
                    data, index = store.open_output_stream(own), store.open_output_stream(f"{own}.idx")
                ids, offsets = coder.encode(batch.column(1))
                starts, framed = [], []
                for i, doc_id in enumerate(batch.column(0).to_pylist()):
                    starts.append(at)
                    framed.append(pack_record(doc_id, ids[offsets[i] : offsets[i + 1]], coder.width))
                    at += len(framed[-1])
                data.write(b"".join(framed))
                index.write(np.asarray(starts, "<u8").tobytes())
                records, tokens = records + len(framed), tokens + len(ids)
        if data is not None:
            index.write(np.asarray([at], "<u8").tobytes())
            data.close()
            index.close()
            put(store, f"{own}.idx", f"{root}/{name}.idx")
            put(store, own, f"{root}/{name}")
            yield pa.RecordBatch.from_pydict(
                {"file_no": pa.array([number], pa.int64()), "file": [name], "records": pa.array([records], pa.int64()), "tokens": pa.array([tokens], pa.int64())}
            )

    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("tag"))
    # A number of their own deals out many rows with one id and text.
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange(slots_for(spark), "id", "tag", "row").sortWithinPartitions("id", "tag", "row")
    with freeing_shuffles(spark):
        manifest = materialise(
            map_arrow(ordered.select("id", "text"), run, "file_no long, file string, records long, tokens long"), "manifest"
        )
    # One row a file, so a single window is small.
    return manifest.withColumn("base", F.coalesce(F.sum("tokens").over(Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))


def read_token_files(manifest: DataFrame, folder: str, *, step_bytes: int = 1 << 22) -> DataFrame:
    """``(id, start, n_tokens, ids)`` of every record: ``start`` counts the tokens of all records before it, ``ids``
    is binary (little-endian unsigned 32-bit). Lengths and checksums are verified; a damaged record fails the read.
    A file is read in steps of about ``step_bytes`` along its index.
    """

    def run(batches):
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_stream(f"{root}/{row['file']}.idx") as f:
                    index = np.frombuffer(f.read(), "<u8").astype(np.int64)
                if len(index) != row["records"] + 1:
                    raise ValueError(f"{row['file']}: the index has {len(index) - 1} records, not {row['records']}")
                at, start = 0, row["base"]
                with store.open_input_file(f"{root}/{row['file']}") as f:
                    while at < row["records"]:
                        to = max(at + 1, int(np.searchsorted(index, index[at] + step_bytes, "right")) - 1)
                        to = min(to, row["records"])
                        data = f.read_at(int(index[to] - index[at]), int(index[at]))
                        names, parts = [], []
                        for i in range(at, to):
                            doc_id, ids = unpack_record(unframe(data, int(index[i] - index[at]))[0])
                            names.append(doc_id)
                            parts.append(ids)
                        sizes = np.array([len(p) for p in parts], np.int64)
                        bounds = np.concatenate([[0], np.cumsum(sizes)])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(names, pa.int64()), pa.array(start + bounds[:-1]), pa.array(sizes), binary_slices(np.concatenate(parts), bounds)],
                            names=["id", "start", "n_tokens", "ids"],
                        )
                        start, at = start + int(bounds[-1]), to

    dealt = manifest.select("file_no", "file", "records", "base").repartition(slots_for(manifest.sparkSession), "file_no")
    return map_arrow(dealt, run, "id long, start long, n_tokens long, ids binary")


def read_record(folder: str, file: str, number: int) -> tuple[int | None, np.ndarray]:
    """One record by its number, through the index: two small reads."""
    store, root = fs.FileSystem.from_uri(folder)
    with store.open_input_file(f"{root}/{file}.idx") as f:
        at, end = np.frombuffer(f.read_at(16, 8 * number), "<u8").astype(int)
    with store.open_input_file(f"{root}/{file}") as f:
        return unpack_record(unframe(f.read_at(int(end - at), int(at)))[0])


def delete_token_files(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
