"""Pixel statistics of images: mean, standard deviation and variance of the Laplacian."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Image source modes and their names.
MODES = {0: "L", 16: "RGB", 24: "RGBA"}


_STATS = T.StructType([T.StructField(n, T.DoubleType()) for n in ("mean", "stdev", "blur")])


def _pixel_udf():
    """The statistics as a UDF. Its helpers are nested, so that it travels to the workers whole."""

    def grey_of(height: int, width: int, channels: int, data) -> np.ndarray:
        pixels = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)
        if channels == 1:
            return pixels[:, :, 0]
        # Rec. 601 luma in 16-bit fixed point; the image source stores blue first.
        blue, green, red = (pixels[:, :, i].astype(np.uint32) for i in range(3))
        return ((red * 19595 + green * 38470 + blue * 7471 + 0x8000) >> 16).astype(np.uint8)

    def laplacian(grey: np.ndarray) -> np.ndarray:
        # Four neighbours, clipped to a byte; border pixels are kept as they are.
        if min(grey.shape) < 3:
            return grey
        out = grey.copy()
        g = grey.astype(np.int16)
        edge = g[:-2, 1:-1] + g[2:, 1:-1] + g[1:-1, :-2] + g[1:-1, 2:] - 4 * g[1:-1, 1:-1]
        out[1:-1, 1:-1] = np.clip(edge, 0, 255)
        return out

    def moments(counts: np.ndarray) -> tuple[float, float]:
        # Mean and population variance from the histogram, exact up to the last division.
        counts = [int(c) for c in counts]
        n = sum(counts)
        total = sum(i * c for i, c in enumerate(counts))
        squares = sum(i * i * c for i, c in enumerate(counts))
        return total / n, (n * squares - total * total) / (n * n)

    def one(h, w, c, data):
        if data is None or not (h > 0 and w > 0):
            return None, None, None
        h, w, c = int(h), int(w), int(c)
        # By bands of rows with a neighbour on each side: what is held next to the image does not grow with it.
        step = max(1, 4_000_000 // w)
        plain, edges = np.zeros(256, np.int64), np.zeros(256, np.int64)
        for top in range(0, h, step):
            first, rows = max(top - 1, 0), min(top + step + 1, h) - max(top - 1, 0)
            grey = grey_of(rows, w, c, memoryview(data)[first * w * c:(first + rows) * w * c])
            own = slice(top - first, top - first + min(step, h - top))
            plain += np.bincount(grey[own].ravel(), minlength=256)
            edges += np.bincount(laplacian(grey)[own].ravel(), minlength=256)
        mean, variance = moments(plain)
        return mean, variance**0.5, moments(edges)[1]

    @F.pandas_udf(_STATS)
    def pixel_stats(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for columns in batches:
            yield pd.DataFrame([one(*row) for row in zip(*columns)], columns=["mean", "stdev", "blur"])

    return pixel_stats


def image_features(images: DataFrame) -> DataFrame:
    """``path, decoded, width, height, image_mode, mean, stdev, blur`` from the image source.

    Images that could not be decoded have a height of -1; those of a format without a decoder
    here count as not inspected.
    """
    mode = F.lit(None).cast("string")
    for code, name in MODES.items():
        mode = F.when(F.col("image.mode") == code, name).otherwise(mode)
    i = images.select(
        "path", (F.col("image.height") > 0).alias("decoded"), "image.width", "image.height",
        mode.alias("image_mode"), F.col("image.nChannels").alias("channels"), "image.data",
    )
    stats = i.withColumn("p", _pixel_udf()("height", "width", "channels", "data"))
    known = F.col("decoded")
    return stats.select(
        "path", "decoded", F.when(known, F.col("width")).alias("width"),
        F.when(known, F.col("height")).alias("height"), "image_mode",
        "p.mean", "p.stdev", "p.blur",
    )


def _size_udf():
    """Width and height from an image's header. Its helpers are nested, so that it travels to the workers whole."""

    def tiff(data):
        order = "<" if data[:2] == b"II" else ">"
        place, = struct.unpack_from(order + "I", data, 4)
        count, = struct.unpack_from(order + "H", data, place)
        found = {}
        for i in range(count):
            tag, kind = struct.unpack_from(order + "HH", data, place + 2 + 12 * i)
            if tag in (256, 257):
                found[tag], = struct.unpack_from(order + ("H" if kind == 3 else "I"), data, place + 10 + 12 * i)
        return found[256], found[257]

    def jpeg(data):
        place = 2
        while data[place] == 0xFF:
            marker, length = data[place + 1], struct.unpack_from(">H", data, place + 2)[0]
            if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                height, width = struct.unpack_from(">HH", data, place + 5)
                return width, height
            place += 2 + length
        return None, None

    def one(data):
        try:
            if data[:8] == b"\x89PNG\r\n\x1a\n":
                return struct.unpack_from(">II", data, 16)
            if data[:2] == b"BM":
                width, height = struct.unpack_from("<ii", data, 18)
                return abs(width), abs(height)
            if data[:4] in (b"II*\x00", b"MM\x00*"):
                return tiff(data)
            if data[:2] == b"\xff\xd8":
                return jpeg(data)
        except (struct.error, IndexError, KeyError, TypeError):
            pass  # a damaged header: the decoder will say so
        return None, None

    @F.pandas_udf("width INT, height INT")
    def size(contents: pd.Series) -> pd.DataFrame:
        sizes = [tuple(None if s is None else min(s, 2**31 - 1) for s in one(c)) for c in contents]
        return pd.DataFrame(sizes, columns=["width", "height"], dtype="object")

    return size


def image_size(content: str):
    """``width, height`` of a PNG, JPEG, BMP or TIFF file by its header, without decoding it; else NULLs."""
    return _size_udf()(content)
