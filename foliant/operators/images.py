"""Images as rows `height, width, n_channels, data` through the kernels, in Arrow batches; every row stays in its task.

`data` holds rows of grey levels or of blue, green and red. Null and wrongly sized data give null results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from ..functions import kernels as k

FEATURES = "hash long, inner_hash long, crc long, n_black long, n_components long"


def decode(height: int, width: int, channels: int, data: bytes | None) -> np.ndarray | None:
    if data is None or pd.isna(height) or pd.isna(width) or pd.isna(channels):
        return None
    height, width, channels = int(height), int(width), int(channels)
    if len(data) != height * width * channels or not len(data):
        return None
    a = np.frombuffer(data, np.uint8)
    return a.reshape(height, width) if channels == 1 else a.reshape(height, width, channels)


def _map(df: DataFrame, keep: list[str], schema: str, names: list[str], f: Callable[[np.ndarray, dict], tuple]) -> DataFrame:
    kinds = dict(df.dtypes)
    full = ", ".join(f"{c} {kinds[c]}" for c in keep) + ", " + schema

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            columns = {c: frame[c].tolist() for c in frame.columns}
            out = []
            for values in zip(*columns.values(), strict=True):
                r = dict(zip(columns, values, strict=True))
                img = decode(r["height"], r["width"], r["n_channels"], r["data"])
                out.append(f(img, r) if img is not None else (None,) * len(names))
            made = pd.concat([frame[keep].reset_index(drop=True), pd.DataFrame(out, columns=names)], axis=1)
            for n, kind in (x.split() for x in schema.split(", ")):
                if kind == "long":
                    made[n] = made[n].astype("Int64")
            yield made

    return df.mapInPandas(run, full)


def features(df: DataFrame, keep: list[str], border: float = 0.0) -> DataFrame:
    """Hashes, checksum, black pixels and connected parts of each image."""

    def of(img: np.ndarray, _: dict) -> tuple:
        g = k.gray(img)
        return k.phash(g, border=border), k.phash(g, border=border, median_of="inner"), k.checksum(g), k.black_pixels(g), k.components(k.binarize(g) == 0)

    return _map(df, keep, FEATURES, [x.split()[0] for x in FEATURES.split(", ")], of)


def align(df: DataFrame, keep: list[str], factor: float = 1.5, threshold: float = 0.7) -> DataFrame:
    """`found, shift_x, shift_y, score` of templates (`t_height, t_width, t_data`, grey) near a box (`left, top`) of a page.

    The template is looked for in the box enlarged by a factor; below the threshold nothing is found and the shift is 0.
    """

    def of(img: np.ndarray, r: dict) -> tuple:
        t = decode(r["t_height"], r["t_width"], 1, r["t_data"])
        if t is None:
            return False, 0.0, 0.0, 0.0
        dx, dy = int(t.shape[1] * (factor - 1) / 2), int(t.shape[0] * (factor - 1) / 2)
        x0, y0 = max(0, int(r["left"]) - dx), max(0, int(r["top"]) - dy)
        found, x, y, score = k.locate(k.crop(k.gray(img), (x0, y0, r["left"] + t.shape[1] + dx, r["top"] + t.shape[0] + dy)), t, threshold)
        return found, float(x0 + x - r["left"]) if found else 0.0, float(y0 + y - r["top"]) if found else 0.0, score

    return _map(df, keep, "found boolean, shift_x double, shift_y double, score double", ["found", "shift_x", "shift_y", "score"], of)


def censor(df: DataFrame, keep: list[str], striped: bool = False) -> DataFrame:
    """Images with the quadrilaterals of `quads` (arrays of four points) filled with black, or striped; grey levels or colours stay
    elsewhere. Images without quads pass as they are."""

    def of(img: np.ndarray, r: dict) -> tuple:
        quads = r["quads"]
        for q in [] if quads is None else quads:
            pts = np.array([(p["x"], p["y"]) for p in q])
            img = k.stripes(img, pts) if striped else k.fill(img, pts)
        return (np.ascontiguousarray(img).tobytes(),)

    return _map(df, keep, "censored binary", ["censored"], of)


def _levels(a: np.ndarray) -> str:
    return ",".join(str(int(v)) for v in np.asarray(a).ravel())


MEASURES = "n_black long, binary string, row_sums string, column_sums string, small string, patch string, inner string, masked string"


def measures(df: DataFrame, keep: list[str], box: tuple[int, int, int, int], size: int, border: float, black: int = 10, threshold: int = 128) -> DataFrame:
    """Plain measures of grey images, lists of levels as texts: black pixels, the image in black and white, sums of rows and columns,
    the image as `size` by `size` means in thousandths, the part in a box, the part within a border, and what a quadrilateral of the box holds."""

    def of(img: np.ndarray, _: dict) -> tuple:
        g = k.gray(img)
        x0, y0, x1, y1 = box
        quad = np.array([(x0, y0), (x1, y0), (x1, y1), (x0, y1)])
        small = np.rint(k.resize_area(g, size, size) * 1000)
        return k.black_pixels(g, black), _levels(k.binarize(g, threshold)), _levels(g.astype(int).sum(1)), _levels(g.astype(int).sum(0)), _levels(small), _levels(k.crop(g, box)), _levels(k.crop_borders(g, border)), _levels(k.crop_masked(g, quad))

    return _map(df, keep, MEASURES, [x.split()[0] for x in MEASURES.split(", ")], of)


COMPARED = "ncc double, row_ncc double, column_ncc double, black_near boolean, decision boolean, n_passed long"


def compared(df: DataFrame, keep: list[str], tests: int = k.TESTS) -> DataFrame:
    """Regions held against those of a template (`t_height, t_width, t_data`, grey) of the same size: correlations, whether as much is
    black, how many of the five tests of a region hold, and the decision."""

    def of(img: np.ndarray, r: dict) -> tuple:
        a, b = k.gray(img), decode(r["t_height"], r["t_width"], 1, r["t_data"])
        if b is None or a.shape != b.shape:
            return (None,) * 6
        ok, got = k.region_matches(a, b, tests)
        passed = (got["crc"] == 1) + (got["hash"] <= k.HASH_MOST) + (got["ncc"] >= k.NCC_LEAST) + (got["edges"] >= k.EDGE_LEAST) + (min(got["rows"], got["columns"]) >= k.PROFILE_LEAST)
        near = k.blank_matches(k.black_pixels(a, 100), k.black_pixels(b, 100), 0, 1)
        return k.ncc(a, b), k.profile_ncc(k.profile(a, 1), k.profile(b, 1)), k.profile_ncc(k.profile(a, 0), k.profile(b, 0)), bool(near), bool(ok), int(passed)

    return _map(df, keep, COMPARED, [x.split()[0] for x in COMPARED.split(", ")], of)


def located(df: DataFrame, keep: list[str], threshold: float = 0.7) -> DataFrame:
    """`found, x, y, score` of the place in each image that correlates best with a template (`t_height, t_width, t_data`, grey)."""

    def of(img: np.ndarray, r: dict) -> tuple:
        t = decode(r["t_height"], r["t_width"], 1, r["t_data"])
        if t is None:
            return None, None, None, None
        found, x, y, score = k.locate(k.gray(img), t, threshold)
        return bool(found), x, y, score

    return _map(df, keep, "found boolean, x long, y long, score double", ["found", "x", "y", "score"], of)
