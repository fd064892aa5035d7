"""Token ids as length-delimited binary records with an offset index.

A record is: payload length (u32), masked crc32 of those four bytes (u32), payload, masked crc32 of the
payload (u32), and a newline. The payload is the document id (i64), a flag that it is present (u8), the
width of an id in bytes (u8) and the ids. All numbers are little-endian; ids take two bytes where the
vocabulary has at most 65,536. A checksum is masked by rotating it right by 15 bits and adding a constant,
so that checksums of data that hold checksums stay sound. Files follow ascending document id, and so do
the records in a file. Spark's own writer commits the files, so a lost executor or a repeated task leaves
no partial file behind. The index, a Parquet table beside them, has the file, offset and length of every
record, so a shuffled read fetches single records.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from valuemark.llm.common import fresh_path, table, task_count, texts
from valuemark.llm.encoders import encoder

# Fixed values of the record format.
MASK_DELTA = 0xA282EAD8
HEADER, LEAD, TRAILER = "<II", "<qBB", "<I"
HEADER_SIZE, LEAD_SIZE, TRAILER_SIZE = 8, 10, 4
TERMINATOR = b"\n"

BATCH_BYTES = 8 << 20
#: A row a file, about 100 bytes; with more files the starts are joined by exchange.
FILES_TO_BROADCAST = 50_000
#: Bytes of a file that one task of a shuffled read seeks in.
FETCH_SPAN = 4 << 20


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes, width: int) -> bytes:
    """One record from ids as little-endian unsigned 32-bit numbers."""
    body = ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()
    payload = struct.pack(LEAD, doc_id or 0, doc_id is not None, width) + body
    size = struct.pack("<I", len(payload))
    return b"".join((size, struct.pack("<I", masked(size)), payload, struct.pack("<I", masked(payload)), TERMINATOR))


def spans(content: bytes) -> Iterator[tuple[int, int]]:
    """Offset and length of each record of a file, by its length fields."""
    at = 0
    while at < len(content):
        size, crc = struct.unpack_from(HEADER, content, at)
        if crc != masked(content[at : at + 4]):
            raise ValueError(f"record at byte {at}: its length does not match its checksum")
        length = HEADER_SIZE + size + TRAILER_SIZE + len(TERMINATOR)
        if at + length > len(content):
            raise ValueError(f"record at byte {at}: the file ends within it")
        yield at, length
        at += length


def unframe(record: bytes) -> tuple[int | None, bytes]:
    """Document id and ids (little-endian unsigned 32-bit) of a record, after checking its payload."""
    payload = record[HEADER_SIZE : -TRAILER_SIZE - len(TERMINATOR)]
    if struct.unpack_from(TRAILER, record, HEADER_SIZE + len(payload))[0] != masked(payload):
        raise ValueError("a payload does not match its checksum")
    doc_id, present, width = struct.unpack_from(LEAD, payload)
    body = payload[LEAD_SIZE :]
    return doc_id if present else None, body if width == 4 else np.frombuffer(body, "<u2").astype("<u4").tobytes()


def write_token_records(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 0, file_bytes: int = 16 << 20) -> None:
    """Encode every whole text, append ``end_id`` and write records under ``path``/records, the index under ``path``/index.

    Null texts count as empty (a record of the end id alone); rows that repeat a document id stay separate
    records; null ids come first. An empty table gives no record.
    """
    spark = docs.sparkSession
    rows = texts(docs)
    total = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    ordered = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(task_count(spark, total, file_bytes), "doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def records(batches):
        enc = encoder(tokenizer)
        width = 2 if max(enc.library.get_vocab_size(), (end_id or 0) + 1) <= 1 << 16 else 4
        end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        for b in batches:
            out, held = [], 0
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                out.append(frame(doc_id, enc.ids(text) + end, width)[: -len(TERMINATOR)])  # the writer ends every row with it
                held += len(out[-1])
                if held > BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
                    out, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    ordered.drop("tie").mapInArrow(records, "record binary").select(F.col("record").cast("string")).write.option("compression", "none").text(f"{path}/records")

    def entries(batches):
        for b in batches:
            for file, content in zip(b.column("path").to_pylist(), b.column("content")):
                data = memoryview(content.as_buffer())
                found = [(at, length, *struct.unpack_from(LEAD, data, at + HEADER_SIZE)) for at, length in spans(data)]
                at, length, ids, present, width = map(np.array, zip(*found)) if found else [np.zeros(0, np.int64)] * 5
                n = (length - HEADER_SIZE - LEAD_SIZE - TRAILER_SIZE - len(TERMINATOR)) // np.maximum(width, 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file.rsplit("/", 1)[-1]] * len(found), pa.string()), pa.array(at.astype("i8")), pa.array(length.astype("i8")), pa.array(ids.astype("i8"), mask=present == 0), pa.array(n.astype("i8"))],
                    ["file", "offset", "length", "doc_id", "n_tokens"],
                )

    _files(spark, path).mapInArrow(entries, "file string, offset long, length long, doc_id long, n_tokens long").write.parquet(f"{path}/index")


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(f"{path}/records").select("path", "content")


def read_token_records(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all records before it, over the files in order), n_tokens and ids (binary, little-endian u32)."""

    def parsed(batches):
        for b in batches:
            for file, content in zip(b.column("path").to_pylist(), b.column("content")):
                data, name = memoryview(content.as_buffer()), file.rsplit("/", 1)[-1]
                before, rows, held = 0, [], 0
                for at, length in spans(data):
                    doc_id, ids = unframe(bytes(data[at : at + length]))
                    rows.append((name, doc_id, before, len(ids) // 4, ids))
                    before += len(ids) // 4
                    held += len(ids)
                    if held > BATCH_BYTES:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)

    kinds = [("file", pa.string()), ("doc_id", pa.int64()), ("before", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]

    def _batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*rows), kinds)], [n for n, _ in kinds])

    read = _files(spark, path).mapInArrow(parsed, "file string, doc_id long, before long, n_tokens long, ids binary")
    starts = file_starts(spark, path)
    if spark.read.parquet(f"{path}/index").agg(F.count_distinct("file")).first()[0] <= FILES_TO_BROADCAST:
        starts = F.broadcast(starts)
    return read.join(starts, "file").select("doc_id", (F.col("file_start") + F.col("before")).alias("start"), "n_tokens", "ids")


def file_starts(spark: SparkSession, path: str) -> DataFrame:
    """Ids before each file: one row a file."""
    totals = spark.read.parquet(f"{path}/index").groupBy("file").agg(F.sum("n_tokens").alias("total"))
    part = F.regexp_extract("file", r"part-(\d+)", 1).cast("long")
    order = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("file", F.coalesce(F.sum("total").over(order), F.lit(0)).alias("file_start"))


def fetch(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """doc_id and ids of the records of the document ids in ``wanted`` (null matches null): a shuffled read by the index.

    Tasks seek to each record's offset and read its bytes alone. Where the folder lies in a store that only
    Spark opens, the files that hold a wanted record are read through Spark and cut.
    """
    index = spark.read.parquet(f"{path}/index")
    ids = wanted.select(F.col("doc_id").cast("long").alias("wanted")).distinct()
    places = index.join(ids, index.doc_id.eqNullSafe(F.col("wanted"))).select("file", "offset", "length")
    root = f"{path}/records"

    def sought(batches):
        name, file = None, None
        for b in batches:
            got = []
            for row in b.to_pylist():
                if row["file"] != name:
                    name, file = row["file"], store.open_input_file(f"{folder}/{row['file']}")
                file.seek(row["offset"])
                got.append(unframe(file.read(row["length"])))
            yield _records(got)

    def cut(batches):
        for b in batches:
            for content, found in zip(b.column("content"), b.column("places").to_pylist()):
                data = memoryview(content.as_buffer())
                yield _records([unframe(bytes(data[p["offset"] : p["offset"] + p["length"]])) for p in found])

    try:
        store, folder = pyarrow.fs.FileSystem.from_uri(root if "://" in root else root.replace("file:", ""))
    except (OSError, ValueError):  # no client for this kind of store
        by_file = places.groupBy("file").agg(F.collect_list(F.struct("offset", "length")).alias("places"))
        files = _files(spark, path).withColumn("file", F.element_at(F.split("path", "/"), -1))
        return files.join(by_file, "file").select("content", "places").mapInArrow(cut, "doc_id long, ids binary")
    dealt = places.repartition("file", F.floor(F.col("offset") / FETCH_SPAN)).sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(sought, "doc_id long, ids binary")


def _records(got: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.binary())], ["doc_id", "ids"])


def op9_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = fresh_path(spark, "token-records")
    write_token_records(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), 0)
    return read_token_records(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
