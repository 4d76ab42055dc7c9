"""Media columns: storing bytes as media, and finding out what stored bytes are.

Signature sniffing: an Aho-Corasick automaton finds all magic bytes of a blob in one pass; a validator of
each format then confirms structure and length at that place. What holds at the start of the blob decides its type and
corrects the declared one; what holds further inside is carved out as embedded media. Validators share what they find out about a blob
(where end marks stand, where chains of parts lead), so that many magic bytes in one long blob aren't checked to its end again and again.

Results for edge cases: a null blob or text counts as empty; an empty or unknown blob is ``application/octet-stream``
with no parts; magic bytes whose structure doesn't hold are no media. Rows are independent, so equal blobs get equal
results, also where ids repeat or are null; an empty table gives an empty one; other columns, whatever their names, are ignored. Features
are made of whole numbers until they are written, so no worker's arithmetic shows.
"""

from __future__ import annotations

import hashlib
import math
import re
import struct
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkweave.llm.common import bounded_batches, shared_dir, table

UNKNOWN = "application/octet-stream"
BLOCK = 64
RATE = 8000

# Magic bytes of media formats, with how far into the format they stand.
MAGIC = {
    b"RIFF": ("riff", 0),
    b"\x89PNG\r\n\x1a\n": ("png", 0),
    b"GIF87a": ("gif", 0),
    b"GIF89a": ("gif", 0),
    b"\xff\xd8\xff": ("jpeg", 0),
    b"BM": ("bmp", 0),
    b"%PDF-": ("pdf", 0),
    b"PK\x03\x04": ("zip", 0),
    b"\x1f\x8b\x08": ("gzip", 0),
    b"OggS": ("ogg", 0),
    b"fLaC": ("flac", 0),
    b"ftyp": ("mp4", 4),
}


class Blob:
    """Bytes, with what is known about them so far."""

    def __init__(self, data: bytes):
        self.data = data
        self.marks: dict[bytes, list[int]] = {}
        self.ends: dict[str, dict[int, int | None]] = {}

    def after(self, mark: bytes, at: int) -> int:
        """Where the first mark from a place on stands; the blob's length if there is none."""
        if mark not in self.marks:
            self.marks[mark] = [m.start() for m in re.finditer(re.escape(mark), self.data)]
        places = self.marks[mark]
        k = bisect_left(places, at)
        return places[k] if k < len(places) else len(self.data)

    def end(self, kind: str, at: int, step: Callable[[int], tuple[int, bool] | None]) -> int | None:
        """Where a chain of parts ends; None if it breaks. step gives the place after a part, and whether it was the last; None: no
        part. Chains that meet share their end."""
        known = self.ends.setdefault(kind, {})
        path = []
        while at not in known:
            path.append(at)
            part = step(at)
            if part is None:
                known[at] = None
            elif part[1]:
                known[at] = part[0]
            else:
                at = part[0]
        for p in path:
            known[p] = known[at]
        return known[at]


def _riff(b: Blob, at: int) -> tuple[str, int] | None:
    d = b.data
    if len(d) < at + 12:
        return None
    size = struct.unpack_from("<I", d, at + 4)[0] + 8
    kind = {b"WAVE": "audio/wav", b"WEBP": "image/webp", b"AVI ": "video/x-msvideo"}.get(d[at + 8 : at + 12])
    if kind is None or at + size > len(d):
        return None
    chunk = at + 12
    while chunk + 8 <= at + size:
        n = struct.unpack_from("<I", d, chunk + 4)[0]
        chunk += 8 + n + n % 2
    return (kind, size) if chunk in (at + size, at + size + 1) else None


def _png(b: Blob, at: int) -> tuple[str, int] | None:
    d = b.data

    def chunk(p: int) -> tuple[int, bool] | None:
        if p + 12 > len(d):
            return None
        end = p + 12 + struct.unpack_from(">I", d, p)[0]
        if end > len(d) or zlib.crc32(d[p + 4 : end - 4]) != struct.unpack_from(">I", d, end - 4)[0]:
            return None
        return end, d[p + 4 : p + 8] == b"IEND"

    end = b.end("png", at + 8, chunk)
    return ("image/png", end - at) if end else None


def _gif(b: Blob, at: int) -> tuple[str, int] | None:
    d = b.data
    colors = lambda flags: 3 << (flags & 7) + 1 if flags & 128 else 0

    def piece(p: int) -> tuple[int, bool] | None:
        return None if p >= len(d) else (p + 1 + d[p], not d[p])

    def block(p: int) -> tuple[int, bool] | None:
        if p >= len(d):
            return None
        if d[p] == 0x3B:
            return p + 1, True
        if d[p] == 0x21:
            data = p + 2
        elif d[p] == 0x2C and p + 10 < len(d):
            data = p + 11 + colors(d[p + 9])
        else:
            return None
        end = b.end("gif data", data, piece)
        return None if end is None else (end, False)

    end = b.end("gif", at + 13 + colors(d[at + 10]), block) if len(d) >= at + 13 else None
    return ("image/gif", end - at) if end else None


def _jpeg(b: Blob, at: int) -> tuple[str, int] | None:
    d = b.data

    def segment(p: int) -> tuple[int, bool] | None:
        if p + 4 > len(d) or d[p] != 0xFF or d[p + 1] in (0, 0xD9, 0xFF) or (n := struct.unpack_from(">H", d, p + 2)[0]) < 2:
            return None
        if d[p + 1] != 0xDA:
            return p + 2 + n, False
        # picture data: up to a marker that is neither a stuffed byte nor a restart
        m = MARKER.search(d, p + 2 + n)
        if m is None:
            return None
        return (m.start() + 2, True) if d[m.start() + 1] == 0xD9 else (m.start(), False)

    end = b.end("jpeg", at + 2, segment)
    return ("image/jpeg", end - at) if end else None


MARKER = re.compile(rb"\xff[^\x00\xd0-\xd7]", re.S)


def _bmp(b: Blob, at: int) -> tuple[str, int] | None:
    if len(b.data) < at + 26:
        return None
    size, spare, pixels, header = struct.unpack_from("<IIII", b.data, at + 2)
    return ("image/bmp", size) if not spare and header in (12, 40, 108, 124) and 14 + header <= pixels <= size <= len(b.data) - at else None


def _pdf(b: Blob, at: int) -> tuple[str, int] | None:
    end = b.after(b"%%EOF", at)
    return ("application/pdf", end + 5 - at) if b.after(b"startxref", at) < end < len(b.data) else None


def _zip(b: Blob, at: int) -> tuple[str, int] | None:
    d, end = b.data, b.after(b"PK\x05\x06", at)
    if end + 22 > len(d):
        return None
    size, start, note = struct.unpack_from("<IIH", d, end + 12)
    return ("application/zip", end + 22 + note - at) if start + size == end - at and end + 22 + note <= len(d) and d[at + start : at + start + 4] in (b"PK\x01\x02", b"PK\x05\x06") else None


def _gzip(b: Blob, at: int) -> tuple[str, int] | None:
    d, z = b.data, zlib.decompressobj(31)
    try:
        for k in range(at, len(d), 1 << 16):
            part = d[k : k + (1 << 16)]
            while part:
                z.decompress(part, 1 << 20)
                part = z.unconsumed_tail
            if z.eof:
                return "application/gzip", min(k + (1 << 16), len(d)) - len(z.unused_data) - at
    except zlib.error:
        pass
    return None


def _ogg(b: Blob, at: int) -> tuple[str, int] | None:
    d = b.data

    def page(p: int) -> tuple[int, bool] | None:
        if d[p : p + 4] != b"OggS" or p + 27 > len(d) or d[p + 4]:
            return None
        n = d[p + 26]
        end = p + 27 + n + sum(d[p + 27 : p + 27 + n])
        return None if p + 27 + n > len(d) or end > len(d) else (end, bool(d[p + 5] & 4))

    end = b.end("ogg", at, page) if d[at + 5 : at + 6] and d[at + 5] & 2 else None  # the first page of a stream says so
    return ("audio/ogg", end - at) if end else None


def _flac(b: Blob, at: int) -> tuple[str, int] | None:
    d = b.data
    if len(d) < at + 8 or d[at + 4] & 127 or int.from_bytes(d[at + 5 : at + 8], "big") != 34:
        return None

    def block(p: int) -> tuple[int, bool] | None:
        return None if p + 4 > len(d) else (p + 4 + int.from_bytes(d[p + 1 : p + 4], "big"), d[p] >= 128)

    end = b.end("flac", at + 4, block)
    return ("audio/flac", len(d) - at) if end and d[end : end + 1] == b"\xff" else None


def _mp4(b: Blob, at: int) -> tuple[str, int] | None:
    d = b.data

    def box(p: int, until: bytes) -> tuple[int, bool] | None:
        if p + 8 > len(d):
            return None
        n, kind = struct.unpack_from(">I", d, p)[0], d[p + 4 : p + 8]
        return None if n < 8 or p + n > len(d) or not kind.isalnum() else (p + n, kind == until)

    if b.end("mp4 movie", at, lambda p: box(p, b"moov")) is None:
        return None
    end = b.end("mp4", at, lambda p: box(p, b"") or (p, True))
    return "video/mp4", end - at


VALID: dict[str, Callable[[Blob, int], tuple[str, int] | None]] = {
    "riff": _riff, "png": _png, "gif": _gif, "jpeg": _jpeg, "bmp": _bmp, "pdf": _pdf, "zip": _zip, "gzip": _gzip, "ogg": _ogg, "flac": _flac, "mp4": _mp4,
}


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for magic, (name, into) in MAGIC.items():
        a.add_word(magic.decode("latin-1"), (name, into + len(magic)))
    a.make_automaton()
    return a


def sniff(blob: bytes) -> tuple[str, list[tuple[int, int, str]]]:
    """The type of a blob, and (offset, length, type) of the media inside it, the leftmost first and none
    overlapping. Media that fill the blob from its start are no part."""
    kind, parts, end, b = UNKNOWN, [], 0, Blob(blob)
    places = sorted({(stop + 1 - into, name) for stop, (name, into) in _automaton().iter(blob.decode("latin-1"))})
    for at, name in places:
        if at < 0 or at and at < end:
            continue
        if found := VALID[name](b, at):
            if at == 0:
                kind = found[0]
                if found[1] < len(blob):
                    end = found[1]
            else:
                parts.append((at, found[1], found[0]))
                end = at + found[1]
    return kind, parts


def sniff_media(df: DataFrame, blob_col: str, declared_col: str, id_col: str) -> DataFrame:
    """(id, declared, detected, corrected, parts array<struct<offset, length, type, sha256>>) for every row. A declared
    type is corrected where another one is confirmed, or where it can't be confirmed."""
    bounded_batches(df.sparkSession)
    kind = df.select(id_col).schema[0].dataType
    part = pa.list_(pa.struct([("offset", pa.int64()), ("length", pa.int64()), ("type", pa.string()), ("sha256", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            types, parts = [], []
            for blob in b.column(2).to_pylist():
                blob = blob or b""
                t, found = sniff(blob)
                types.append(t)
                parts.append([{"offset": o, "length": n, "type": k, "sha256": hashlib.sha256(blob[o : o + n]).hexdigest()} for o, n, k in found])
            wrong = [d != t for d, t in zip(b.column(1).to_pylist(), types)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(types, pa.string()), pa.array(wrong, pa.bool_()), pa.array(parts, part)], ["id", "declared", "detected", "corrected", "parts"])

    schema = f"id {kind.simpleString()}, declared string, detected string, corrected boolean, parts array<struct<offset: long, length: long, type: string, sha256: string>>"
    return df.select(F.col(id_col).alias("id"), F.col(declared_col).cast("string").alias("declared"), F.col(blob_col).cast("binary").alias("blob")).mapInArrow(run, schema).withColumnRenamed("id", id_col)


def _le32(n: Column) -> Column:
    """A number as four bytes, the lowest first."""
    h = F.lpad(F.hex(n.cast("long")), 8, "0")
    return F.unhex(F.concat(*(F.substring(h, k, 2) for k in (7, 5, 3, 1))))


def _bytes(b: bytes) -> Column:
    return F.unhex(F.lit(b.hex()))


def as_wav(payload: Column) -> Column:
    """A payload as the 8-bit samples of a mono WAV file."""
    n = F.octet_length(payload)
    fmt = b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, RATE, RATE, 1, 8) + b"data"
    return F.concat(_bytes(b"RIFF"), _le32(n + 36), _bytes(fmt), _le32(n), payload)


def padded(text: Column, block: int = BLOCK) -> Column:
    """UTF-8 with bytes 0 up to a positive multiple of ``block``."""
    raw = F.coalesce(text, F.lit("")).cast("binary")
    n = F.octet_length(raw)
    want = F.greatest(F.ceil(n / block), F.lit(1)) * block
    return F.concat(raw, F.unhex(F.repeat(F.lit("00"), (want - n).cast("int"))))


def store_texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Writes every text as a WAV file's bytes with a declared type, as a table in the shared folder; returns the table as
    it is read back. The declared type is a guess from the text's checksum, often wrong, as declarations are."""
    spark = df.sparkSession
    raw = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    guess = F.element_at(F.array(*map(F.lit, ("audio/wav", "image/png", "text/plain", UNKNOWN))), (F.crc32(F.coalesce("text", F.lit(""))) % 4 + 1).cast("int"))
    path = shared_dir(spark)
    raw.select("id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), guess.alias("declared"), as_wav(padded(F.col("text"))).alias("media")).write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def media_digests(stored: DataFrame) -> DataFrame:
    """Reads stored WAV files back: sniffs them, takes the samples out and describes them."""
    bounded_batches(stored.sparkSession)
    kind = stored.schema["id"].dataType

    def describe(declared: str, blob: bytes) -> tuple:
        found, parts = sniff(blob)
        if found != "audio/wav":
            raise ValueError(f"stored as audio/wav, read back as {found}")
        rate, bits = struct.unpack_from("<I", blob, 24)[0], struct.unpack_from("<H", blob, 34)[0]
        payload = blob[44 : 44 + struct.unpack_from("<I", blob, 40)[0]]
        x = np.frombuffer(payload, np.uint8)
        squares = int((np.square(x.astype(np.int32) - 128)).sum(dtype=np.int64))
        feature = f"{found};declared={declared};corrected={int(found != declared)};rate={rate};bits={bits};frames={len(x)};zeros={len(x) - np.count_nonzero(x)};mean={int(x.sum(dtype=np.int64)) / len(x):.4f};rms={math.sqrt(squares / len(x)):.3f};embedded={','.join(f'{k}@{o}+{n}' for o, n, k in parts)}"
        return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-BLOCK:]), len(blob), hashlib.sha256(blob).hexdigest(), feature

    names = {"payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "media_sha256": pa.string(), "feature": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [describe(d, m) for d, m in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            cols = zip(*rows) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c, t) for c, t in zip(cols, names.values()))], ["id", "n_bytes", *names])

    return stored.select("id", "n_bytes", "declared", "media").mapInArrow(run, f"id {kind.simpleString()}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def op1_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_digests(store_texts(table(spark, sf_dir, "documents"), "doc_id", "text")).withColumnRenamed("id", "doc_id")
