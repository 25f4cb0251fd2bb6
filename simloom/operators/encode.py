"""The encoder seam: items to vectors, one Arrow batch at a time.

``encode`` runs a function ``batch -> matrix`` inside ``mapInArrow``; the function
is made once per worker task, so a model is loaded once, not per batch.  No
weights are shipped; ``hashed_features`` is a deterministic stand-in that maps
equal items to equal vectors.  Image decoding and preprocessing are functions
that an image encoder composes with.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks.writers import resize

#: Layout of a joint vector: intermediate features, then the final embedding.
MID, FINAL = 25088, 512


def decode_ppm(content: bytes) -> np.ndarray | None:
    """H x W x 3 bytes of a binary PPM image, None if it is not one."""
    head = content[:64].split(maxsplit=4)
    if len(head) < 4 or head[0] != b"P6" or not all(x.isdigit() for x in head[1:4]):
        return None
    width, height, top = (int(x) for x in head[1:4])
    start = content.index(head[3], content.index(head[2], content.index(head[1]) + len(head[1])) + len(head[2])) + len(head[3]) + 1
    size = width * height * 3
    if top != 255 or len(content) - start < size or size == 0:
        return None
    return np.frombuffer(content, np.uint8, size, start).reshape(height, width, 3)


def decode_bmp(content: bytes) -> np.ndarray | None:
    """H x W x 3 bytes of an uncompressed 24- or 32-bit BMP image, None if it is not one."""
    if len(content) < 54 or content[:2] != b"BM":
        return None
    start, head, width, height, _, depth, packed = struct.unpack_from("<IIiiHHI", content, 10)
    if head < 40 or width <= 0 or height == 0 or depth not in (24, 32) or packed != 0:
        return None
    row = (width * depth // 8 + 3) // 4 * 4
    if len(content) - start < row * abs(height):
        return None
    grid = np.frombuffer(content, np.uint8, row * abs(height), start).reshape(abs(height), row)
    pixels = grid[:, : width * depth // 8].reshape(abs(height), width, depth // 8)[:, :, 2::-1]
    return pixels[::-1] if height > 0 else pixels


def decode_png(content: bytes) -> np.ndarray | None:
    """H x W x 3 bytes of an 8-bit, not interlaced PNG image (grey, colour or palette; alpha is left out), else None."""
    if content[:8] != b"\x89PNG\r\n\x1a\n":
        return None
    at, data, palette, head = 8, [], None, None
    while at + 12 <= len(content):
        size, kind = struct.unpack_from(">I4s", content, at)
        body = content[at + 8 : at + 8 + size]
        if kind == b"IHDR" and size == 13:
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"PLTE":
            palette = np.frombuffer(body[: size // 3 * 3], np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            data.append(body)
        at += 12 + size
    channels = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
    if head is None or head[2] != 8 or head[3] not in channels or head[6] != 0 or head[0] * head[1] == 0:
        return None
    width, height, count = head[0], head[1], channels[head[3]]
    try:
        raw = zlib.decompress(b"".join(data))
    except zlib.error:
        return None
    line = width * count
    if len(raw) < height * (line + 1):
        return None
    rows = np.frombuffer(raw, np.uint8, height * (line + 1)).reshape(height, line + 1)
    out = np.zeros((height + 1, line + count), np.uint8)  # a row above and a pixel to the left are zero
    for y in range(height):
        kind, now, above = rows[y, 0], rows[y, 1:], out[y, count:]
        if kind == 0:
            out[y + 1, count:] = now
        elif kind == 1:
            out[y + 1, count:] = np.cumsum(now.reshape(width, count), axis=0, dtype=np.uint8).ravel()
        elif kind == 2:
            out[y + 1, count:] = now + above
        elif kind in (3, 4):
            this, over = out[y + 1].astype(np.int32), out[y].astype(np.int32)
            for x in range(count, line + count):
                a, b, c = int(this[x - count]), int(over[x]), int(over[x - count])
                if kind == 3:
                    guess = (a + b) // 2
                else:
                    pa_, pb, pc = abs(b - c), abs(a - c), abs(a + b - 2 * c)
                    guess = a if pa_ <= pb and pa_ <= pc else b if pb <= pc else c
                this[x] = (int(now[x - count]) + guess) & 255
            out[y + 1] = this
        else:
            return None
    pixels = out[1:, count:].reshape(height, width, count)
    if head[3] == 3:
        if palette is None or pixels.max() >= len(palette):
            return None
        return palette[pixels[:, :, 0]]
    return np.repeat(pixels[:, :, :1], 3, axis=2) if count < 3 else pixels[:, :, :3]


def decode_image(content: bytes) -> np.ndarray | None:
    """H x W x 3 bytes of a PPM, BMP or PNG image, None if it is none of these.

    JPEG and WebP need an image library; whoever has one passes its own function.
    """
    for decode in (decode_ppm, decode_bmp, decode_png):
        pixels = decode(content)
        if pixels is not None:
            return pixels
    return None


def read_files(items: DataFrame, path: str = "path") -> DataFrame:
    """``items`` with the column content: the bytes of the file at each path.  A file that is not there fails the job."""
    at = items.columns.index(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from ..sources.readers import _open

        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part, held = batch.slice(lo, 256), []
                for name in part.column(at).to_pylist():
                    system, place = _open(name)
                    with system.open_input_file(place) as file:
                        held.append(file.read())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(held, pa.binary())], [*part.schema.names, "content"])

    return items.mapInArrow(run, T.StructType([*items.schema.fields, T.StructField("content", T.BinaryType())]))


def preprocess(pixels: np.ndarray, size: int = 112) -> np.ndarray:
    """3 x size x size floats in -1..1: scaled to 0..1, resized bilinearly, then (x - 0.5) / 0.5."""
    if pixels.shape[:2] != (size, size):
        pixels = resize(pixels, size)
    return (pixels.transpose(2, 0, 1).astype(np.float32) / 255 - 0.5) / 0.5


def hashed_features(dim: int = FINAL, seed: int = 5) -> Callable[[list], np.ndarray]:
    """A stand-in encoder: pseudo-random directions out of a hash of the item, with equal items alike."""

    def run(items: list) -> np.ndarray:
        out = np.empty((len(items), dim), np.float32)
        for i, item in enumerate(items):
            data = item if isinstance(item, bytes) else str(item).encode("utf-8", "surrogatepass")
            digest = hashlib.blake2b(data, digest_size=8, salt=seed.to_bytes(8, "little")).digest()
            out[i] = np.random.default_rng(int.from_bytes(digest, "little")).standard_normal(dim)
        return out

    return run


def normalised(matrix: np.ndarray) -> np.ndarray:
    """Rows over their length; zero rows stay zero."""
    norm = np.sqrt((matrix.astype(np.float64) ** 2).sum(1, keepdims=True))
    return (matrix / np.where(norm == 0, 1, norm)).astype(np.float32)


def encode(
    items: DataFrame,
    make: Callable[[], Callable[[list], np.ndarray]],
    key: str = "data_index",
    content: str = "content",
    dim: int = FINAL,
    normalise: bool = True,
    final: int = FINAL,
    batch: int = 1024,
) -> DataFrame:
    """(data_index, embedding): vectors of ``dim`` floats of every item.

    With ``normalise`` the last ``final`` entries (all of a plain vector) are
    scaled to length one; the leading ones of a joint vector stay as they are.
    An item that the encoder cannot read, or a wrong shape, fails the job, and so
    do null items: skipping would break the pairing of vectors and paths.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        for rows in batches:
            for lo in range(0, rows.num_rows, batch):
                part = rows.slice(lo, batch)
                model = model or make()
                values = part.column(1).to_pylist()
                if any(v is None for v in values):
                    raise ValueError("an item has no content")
                matrix = np.asarray(model(values), np.float32)
                if matrix.shape != (len(values), dim):
                    raise ValueError(f"the encoder gave {matrix.shape} for {len(values)} items of {dim} entries")
                if normalise:
                    cut = max(0, dim - final)
                    matrix = np.concatenate([matrix[:, :cut], normalised(matrix[:, cut:])], axis=1)
                yield pa.record_batch([part.column(0), pa.array(list(matrix), pa.list_(pa.float32()))], ["data_index", "embedding"])

    source = items.select(F.col(key).cast("long").alias("data_index"), F.col(content))
    return source.mapInArrow(run, "data_index long, embedding array<float>")


def split_joint(df: DataFrame, vector: str = "embedding", final: int = FINAL) -> DataFrame:
    """Adds ``mid`` and ``final`` of a joint vector."""
    size = F.size(vector)
    return df.withColumn("mid", F.slice(vector, F.lit(1), size - final)).withColumn(
        "final", F.slice(vector, size - final + 1, F.lit(final))
    )
