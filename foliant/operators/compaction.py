"""Consolidation of tiny files of JSON records by byte-level concatenation."""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import strict_json
from ..session import cut

BOM = b"\xef\xbb\xbf"
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
#: A flat object of one line, a whole string, or a single byte that matters for boundaries. A raw line end can't occur in a JSON string.
TOKEN = re.compile(rb'\{(?:[^"{}\[\]\r\n]|"(?:[^"\\\r\n]|\\[^\r\n])*+")*+\}|"(?:[^"\\\r\n]|\\[^\r\n])*"|[{}\[\]:,]|[\r\n]+|[^\s"{}\[\]:,]+')


def record_spans(content: bytes) -> Iterator[tuple[int, int]]:
    """Byte spans of the objects of a file, one per line or in arrays, found by brackets alone.

    A record cut off at a line end is left out: a line end at which an object begins where the open record allows none
    closes that record. An object that begins a line right after a colon, or in the first column after a bracket, is a value of the open
    record only if that record ends; if it doesn't, reading goes back to it. Byte order marks, line ends, commas and the
    brackets of arrays lie between spans.
    """
    at, base = 0, []
    while at >= 0:
        again = -1
        start, stack, last, fresh = -1, list(base), b"", True
        for m in TOKEN.finditer(content, at):
            t = m[0]
            head = t[:1]
            if head == b"{" or t == b"[":
                own = last == b":" or last == b"[" or last == b"," and stack[-1:] == [b"["]
                if start >= 0 and not own:  # the open record was cut off
                    if again >= 0:
                        break
                    start, stack = -1, stack[:1] if stack[:1] == [b"["] else []
                if start >= 0 and fresh and again < 0 and head == b"{" and (last == b":" or last == b"[" and content[m.start() - 1 : m.start()] in (b"\r", b"\n")):
                    again, base = m.start(), stack[:1] if stack[:1] == [b"["] else []
                outer = start < 0 and (not stack or stack == [b"["])
                if len(t) > 1:
                    if outer:
                        yield m.span()
                    t = b"}"
                else:
                    if t == b"{" and outer:
                        start = m.start()
                    stack.append(t)
            elif t == b"}" or t == b"]":
                if stack and stack[-1] == (b"{" if t == b"}" else b"["):
                    stack.pop()
                    if t == b"}" and start >= 0 and (not stack or stack == [b"["]):
                        yield start, m.end()
                        start, again = -1, -1
                elif again >= 0:
                    break
                else:
                    start, stack = -1, []
            elif head == b"\r" or head == b"\n":
                fresh = True
                continue
            last, fresh = t, False
        at = again if start >= 0 else -1


def fingerprint(record: bytes) -> bytes | None:
    """128 bits of a record's parsed fields and values, 1754.0 being 1754 and true not 1; None if it isn't a readable object. Equal
    bytes have equal fingerprints: of those that come again soon, only one copy is parsed."""
    return _parsed(record) if len(record) > 4096 else _known(record)


_ENCODER = json.JSONEncoder(sort_keys=True, separators=(",", ":"))


def _parsed(record: bytes) -> bytes | None:
    try:
        text = _ENCODER.encode(strict_json.loads(record, whole=True))
    except ValueError:
        return None
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


_known = lru_cache(maxsize=1 << 14)(_parsed)


SPANS = pa.schema([("file_id", pa.int64()), ("record_no", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()), ("crc", pa.int64()), ("same", pa.binary())])


def record_index(files: DataFrame, file_id: str, content: str) -> DataFrame:
    """One row per readable record: its span, checksum and fingerprint. Null and empty files have none."""

    def scan(batches):
        for batch in batches:
            out = []
            for fid, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                n = 0
                for a, b in record_spans(data):
                    same = fingerprint(data[a:b])
                    if same is not None:
                        out.append((fid, n, a, b, zlib.crc32(data[a:b]), same))
                        n += 1
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else [[]] * len(SPANS), SPANS, strict=True)], schema=SPANS)

    kind = "file_id long, record_no long, start long, stop long, crc long, same binary"
    return files.select(F.col(file_id).cast("long"), F.col(content).cast("string")).mapInArrow(scan, kind)


def redundant_copies(index: DataFrame) -> DataFrame:
    """`file_id, record_no` of each copy but the smallest (file_id, record_no) of equal records.

    The firsts are pre-aggregated before the shuffle; the join back keeps the records on its left, where adaptive
    execution may split the partition of a record that fills a third of the files.
    """
    firsts = index.groupBy("same").agg(F.min(F.struct("file_id", "record_no")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    return index.join(firsts, "same").where(F.struct("file_id", "record_no") != F.col("first")).select("file_id", "record_no")


def bundles(files: DataFrame, file_id: str, content: str, target_bytes: int = 128 << 20) -> DataFrame:
    """Few files that hold every readable record once, one a line: `bundle_id, n_records, n_bytes, crc32, content`.

    Files are put into bundles by the running sum of the bytes kept, in the order of their numbers and in two levels: within
    the ranges of a range partitioning, and over these. A bundle exceeds `target_bytes` by one file at most. Records are copied as bytes and held against
    the length and checksum taken when they were found; a difference ends the job. No files give no bundles.
    """
    index = cut(record_index(files, file_id, content))
    kept = index.join(redundant_copies(index), ["file_id", "record_no"], "left_anti")
    pieces = kept.groupBy("file_id").agg(F.sort_array(F.collect_list(F.struct("record_no", "start", "stop", "crc"))).alias("pieces"), F.sum(F.col("stop") - F.col("start") + 1).alias("size"))
    pieces = cut(pieces.repartitionByRange("file_id").withColumn("range", F.spark_partition_id()))
    ranges = pieces.groupBy("range").agg(F.sum("size").alias("range_size"))  # one row for each partition
    ranges = ranges.select("range", (F.sum("range_size").over(Window.orderBy("range")) - F.col("range_size")).alias("base"))
    within = Window.partitionBy("range").orderBy("file_id")
    placed = pieces.join(F.broadcast(ranges), "range").withColumn("bundle_id", F.floor((F.col("base") + F.sum("size").over(within) - F.col("size")) / F.lit(target_bytes)).cast("long"))
    data = files.select(F.col(file_id).cast("long").alias("file_id"), F.encode(F.col(content).cast("string"), "UTF-8").alias("data"))
    joined = placed.select("file_id", "bundle_id", "pieces").join(data, "file_id")
    kind = "bundle_id long, n_records long, n_bytes long, crc32 long, content binary"
    return joined.repartition("bundle_id").sortWithinPartitions("bundle_id", "file_id").mapInPandas(_concatenate, kind)


WRITTEN = "bundle_id long, path string, n_records long, n_bytes long, crc32 long, n_frames long, file_bytes long"


def write_bundles(made: DataFrame, folder: str, frames: bool = False, frame_bytes: int = 1 << 20) -> DataFrame:
    """`bundles` as files of a shared folder, and a row for each: `bundle_id, path, n_records, n_bytes, crc32, n_frames, file_bytes`.

    A file holds a bundle's lines as they are, or as complete zstandard frames of about `frame_bytes` of whole lines each,
    joined. Files are written under another name and moved, so that a task that runs again leaves the same. The folder is a
    path or URI of a file system that pyarrow knows.
    """

    def run(batches):
        for batch in batches:
            rows = []
            for bundle, n, size, crc, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                parts = list(_parts(content, frame_bytes))
                body = join_frames([_compressor().compress(p) for p in parts]) if frames else join_lines(parts)
                fs, root = _file_system(folder)
                path = f"{root}/bundle-{bundle:08}.jsonl{'.zst' if frames else ''}"
                temporary = f"{root}/.{uuid.uuid4().hex}"
                with fs.open_output_stream(temporary) as f:
                    f.write(body)
                fs.move(temporary, path)
                rows.append((bundle, path, n, size, crc, len(parts) if frames else 0, len(body)))
            yield pa.record_batch([pa.array(c, pa.string() if k == 1 else pa.int64()) for k, c in enumerate(zip(*rows, strict=True) if rows else [[]] * 7)], names=[x.split()[0] for x in WRITTEN.split(", ")])

    _file_system(folder)[0].create_dir(_file_system(folder)[1])
    return cut(made.select("bundle_id", "n_records", "n_bytes", "crc32", "content").mapInArrow(run, WRITTEN))


def read_bundles(written: DataFrame) -> DataFrame:
    """The records of written bundles, `bundle_id, record`; a file whose length or checksum isn't that of its bundle ends the job."""

    def run(batches):
        for batch in batches:
            for bundle, path, n, size, crc, frames, _ in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fs, at = _file_system(path)
                with fs.open_input_file(at) as f:
                    body = f.read()
                if frames:
                    body = _decompressed(body)
                lines = body.split(b"\n")[:-1]
                if (len(body), zlib.crc32(body), len(lines)) != (size, crc, n):
                    raise ValueError(f"{path} is not what was written")
                yield pa.record_batch([pa.array([bundle] * n, pa.int64()), pa.array([x.decode("utf-8", "surrogatepass") for x in lines], pa.string())], names=["bundle_id", "record"])

    return written.mapInArrow(run, "bundle_id long, record string")


def _parts(content: bytes, size: int) -> Iterator[bytes]:
    """Contents in parts of whole lines, of a size or up to the first line end beyond it."""
    at = 0
    while at < len(content):
        end = content.find(b"\n", min(len(content), at + size) - 1) + 1 or len(content)
        yield content[at:end]
        at = end


def _file_system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if re.match(r"[a-z0-9]+:", path) else (fs.LocalFileSystem(), path)


def _compressor():
    import zstandard

    return zstandard.ZstdCompressor(write_checksum=True)


def _decompressed(body: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().stream_reader(body, read_across_frames=True).read()


def _concatenate(frames):
    import pandas as pd

    def done(bundle, out, n):
        body = b"".join(out)
        return pd.DataFrame([(bundle, n, len(body), zlib.crc32(body), body)], columns=["bundle_id", "n_records", "n_bytes", "crc32", "content"])

    now, out, n = None, [], 0
    for frame in frames:
        for bundle, data, pieces in zip(frame["bundle_id"], frame["data"], frame["pieces"], strict=True):
            if bundle != now:
                if out:
                    yield done(now, out, n)
                now, out, n = bundle, [], 0
            for p in pieces:
                record = data[p["start"] : p["stop"]]
                if len(record) != p["stop"] - p["start"] or zlib.crc32(record) != p["crc"]:
                    raise ValueError(f"a record of bundle {bundle} is not what was read before")
                out.append(record.replace(b"\r", b" ").replace(b"\n", b" ") + b"\n")  # line ends are blanks between a record's fields
                n += 1
    if out:
        yield done(now, out, n)


def join_frames(frames: list[bytes]) -> bytes:
    """Complete zstandard frames after each other, which is a valid file of the joined contents; empty ones are left out."""
    import zstandard

    for f in frames:
        if f and (f[:4] != ZSTD_MAGIC or not zstandard.get_frame_parameters(f).has_checksum and zstandard.frame_content_size(f) < 0):
            raise ValueError("not a zstandard frame with a checksum or a length")
        if f:
            d = zstandard.ZstdDecompressor().decompressobj()
            d.decompress(f)
            if not d.eof or d.unused_data:
                raise ValueError("not one complete zstandard frame")
    return b"".join(frames)


def join_lines(parts: list[bytes]) -> bytes:
    """Newline-delimited contents after each other: byte order marks dropped, line ends made one, a last line closed."""
    lines = (line for p in parts for line in p.removeprefix(BOM).replace(b"\r\n", b"\n").replace(b"\r", b"\n").split(b"\n"))
    return b"".join(line + b"\n" for line in lines if line.strip())
