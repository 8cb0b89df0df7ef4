"""Boxes and image sizes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

# Bounds and grid of the size that the page model takes.
MAX_SIZE = (3072, 2048)
MIN_SIZE = (1792, 28)
GRID = 28


def parse_bbox(raw: Column) -> Column:
    """Four integers of "x0 y0 x1 y1", or null if it isn't that."""
    parts = F.split(raw, " ", -1)
    numbers = F.transform(parts, lambda p: F.when(p.rlike(r"^[+-]?\d+$"), p.try_cast("int")))
    return F.when((F.size(parts) == 4) & ~F.exists(numbers, lambda n: n.isNull()), numbers)


def pixel_bbox(raw: Column, width: Column, height: Column, scale: int = 1000) -> Column:
    """Box in pixels: scaled from the grid, cut towards zero, low sides at least 0 and high sides within the page."""
    box = F.coalesce(parse_bbox(raw), F.array(F.lit(0), F.lit(0), F.lit(scale), F.lit(scale)))
    across, down = width.cast("double") / scale, height.cast("double") / scale
    part = lambda k, factor: (F.get(box, F.lit(k)) * factor).cast("int")
    return F.array(F.greatest(F.lit(0), part(0, across)), F.greatest(F.lit(0), part(1, down)), F.least(part(2, across), width.cast("int")), F.least(part(3, down), height.cast("int")))


def has_area(bbox: Column) -> Column:
    """Whether a box can be drawn or cropped."""
    return (F.get(bbox, F.lit(2)) > F.get(bbox, F.lit(0))) & (F.get(bbox, F.lit(3)) > F.get(bbox, F.lit(1)))


def fitted_sizes(width: np.ndarray, height: np.ndarray, max_size: tuple[int, int] = MAX_SIZE, min_size: tuple[int, int] = MIN_SIZE, grid: int = GRID) -> tuple[np.ndarray, np.ndarray]:
    """Sizes on the grid within the pixel bounds, all images at once.

    Sides are scaled to the bounds and rounded to whole cells, halves to even. While an image is still too large, it
    loses the row or column whose loss keeps its proportions best, the row on ties. Empty images keep their size.
    """
    w, h = np.asarray(width, np.float64), np.asarray(height, np.float64)
    usable = (w > 0) & (h > 0)
    safe_w, safe_h = np.where(usable, w, 1), np.where(usable, h, 1)
    pixels, most, least = safe_w * safe_h, max_size[0] * max_size[1], min_size[0] * min_size[1]
    scale = np.where(pixels > most, (most / pixels) ** 0.5, np.where(pixels < least, (least / pixels) ** 0.5, 1.0))
    across = np.maximum(1, np.rint(safe_w * scale / grid)).astype(np.int64)
    down = np.maximum(1, np.rint(safe_h * scale / grid)).astype(np.int64)
    cells = most // (grid * grid)
    # A strip one cell wide has only one way to shrink.
    down = np.where((across == 1) & (down > cells), max(cells, 1), down)
    across = np.where((down == 1) & (across > cells), max(cells, 1), across)
    ratio = safe_w / safe_h
    while (over := (across * down * grid * grid > most) & (across * down > 1)).any():
        with np.errstate(divide="ignore", invalid="ignore"):
            narrower = np.abs((across - 1) / down - ratio)
            lower = np.abs(across / np.maximum(down - 1, 1e-12) - ratio)
        column = over & (down > 1) & (across > 1) & (narrower < lower) | over & (down == 1)
        row = over & ~column
        across, down = across - column, down - row
    return np.where(usable, across * grid, w).astype(np.int64), np.where(usable, down * grid, h).astype(np.int64)


_SIZE = StructType([StructField("width", IntegerType()), StructField("height", IntegerType())])


@F.pandas_udf(_SIZE)
def fit_to_grid(width: pd.Series, height: pd.Series) -> pd.DataFrame:
    """Size that an image of the given size is brought to for the model; null sizes come out null."""
    known = (width.notna() & height.notna()).to_numpy()
    w, h = fitted_sizes(width.fillna(0).to_numpy(), height.fillna(0).to_numpy())
    out = pd.DataFrame({"width": pd.array(w, "Int32"), "height": pd.array(h, "Int32")})
    out.loc[~known] = pd.NA
    return out


def upscaled_size(width: Column, height: Column, min_dim: int = 1536) -> Column:
    """Size of a loaded image: the shorter side at least ``min_dim``, sides cut to whole pixels."""
    shorter = F.least(width, height)
    factor = F.lit(float(min_dim)) / F.nullif(shorter, F.lit(0))
    small = (shorter < min_dim) & (shorter > 0)
    side = lambda x: F.when(small, (x * factor).cast("int")).otherwise(x.cast("int"))
    return F.struct(side(width).alias("width"), side(height).alias("height"))


def render_scale(width: Column, height: Column, dpi: int = 192, min_dim: int = 1024) -> Column:
    """Scale at which a page of the given size in points is rendered; null for a page without area."""
    shorter = F.least(width, height)
    return F.when(shorter > 0, F.greatest(F.lit(float(min_dim)) / F.nullif(shorter, F.lit(0)) * 72, F.lit(float(dpi))) / 72)
