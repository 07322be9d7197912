"""Boxes, tiles and vision token counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GRID = 999.0
TILE, BASE, PATCH, DOWNSAMPLE = 640, 1024, 16, 4


def rescale(value: Column, size: Column) -> Column:
    """A grid coordinate in pixels, cut toward zero; values off the grid pass through."""
    return (value / F.lit(GRID) * size).cast("int")


def width(box: Column) -> Column:
    return box["x2"] - box["x1"]


def height(box: Column) -> Column:
    return box["y2"] - box["y1"]


def area(box: Column) -> Column:
    return width(box) * height(box)


def center_y(box: Column) -> Column:
    return (box["y1"] + box["y2"]) / 2


def clamp(value: Column, size: Column) -> Column:
    return F.greatest(F.lit(0), F.least(value, size))


def clamped(box: Column, w: Column, h: Column) -> Column:
    """A box cut to the page."""
    return F.struct(clamp(box["x1"], w).alias("x1"), clamp(box["y1"], h).alias("y1"), clamp(box["x2"], w).alias("x2"), clamp(box["y2"], h).alias("y2"))


def tile_grids(low: int = 2, high: int = 6) -> list[tuple[int, int]]:
    """Every grid of low to high tiles, by number of tiles, then columns."""
    return sorted(((i, j) for i in range(1, high + 1) for j in range(1, high + 1) if low <= i * j <= high), key=lambda g: (g[0] * g[1], g[0]))


def tile_plan(w: Column, h: Column, low: int = 2, high: int = 6, tile: int = TILE) -> Column:
    """struct(cols, rows) of the grid nearest in aspect ratio; of equal ones a later one needs half its area covered."""
    grids = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in tile_grids(low, high)])
    aspect, pixels = w.cast("double") / h, w.cast("double") * h
    start = F.struct(F.lit(float("inf")).alias("diff"), F.lit(1).alias("cols"), F.lit(1).alias("rows"))

    def choose(best: Column, grid: Column) -> Column:
        diff = F.abs(aspect - grid["i"].cast("double") / grid["j"])
        covers = pixels > F.lit(0.5 * tile * tile) * grid["i"] * grid["j"]
        better = (diff < best["diff"]) | ((diff == best["diff"]) & covers)
        return F.when(better, F.struct(diff.alias("diff"), grid["i"].alias("cols"), grid["j"].alias("rows"))).otherwise(best)

    return F.aggregate(grids, start, choose, lambda s: F.struct(s["cols"].alias("cols"), s["rows"].alias("rows")))


def crop_grid(w: Column, h: Column, low: int = 2, high: int = 6, tile: int = TILE) -> Column:
    """tile_plan, or a single tile for pages that fit into one."""
    single = F.struct(F.lit(1).alias("cols"), F.lit(1).alias("rows"))
    return F.when((w <= TILE) & (h <= TILE), single).otherwise(tile_plan(w, h, low, high, tile))


def tile_boxes(grid: Column, tile: int = TILE) -> Column:
    """Boxes of a grid's tiles on the resized page, row by row."""
    cols = grid["cols"]

    def box(n: Column) -> Column:
        x, y = (n % cols) * tile, F.floor(n / cols).cast("int") * tile
        return F.struct(x.alias("x1"), y.alias("y1"), (x + tile).alias("x2"), (y + tile).alias("y2"))

    return F.transform(F.sequence(F.lit(0), cols * grid["rows"] - 1), box)


def has_thumbnail(grid: Column, use_thumbnail: bool = False) -> Column:
    """Whether a whole-page tile is added."""
    return F.lit(use_thumbnail) & (grid["cols"] * grid["rows"] != 1)


def side(size: int) -> int:
    """Vision tokens along one side of a view."""
    return -(-(size // PATCH) // DOWNSAMPLE)


def vision_tokens(grid: Column, base: int = BASE, tile: int = TILE) -> Column:
    """Tokens of the global view, of the tiles if more than one, and of the separator."""
    b, t = side(base), side(tile)
    local = (grid["rows"] * t) * (grid["cols"] * t + 1)
    return (F.lit(b * (b + 1) + 1) + F.when((grid["cols"] > 1) | (grid["rows"] > 1), local).otherwise(0)).cast("int")


def largest_view(base: int = BASE, tile: int = TILE) -> tuple[int, int]:
    """The page size with most vision tokens."""
    return (2048, 2048) if (tile, base) == (1024, 1280) else (1280, 1280)


def projector_flops(tokens: Column, inputs: int = 2048, outputs: int = 1280) -> Column:
    """Floating point operations of a linear projector over tokens."""
    return tokens.cast("long") * (2 * inputs * outputs)


def banned(ids: Column, n: int, window: int, allowed: list[int] | None = None) -> Column:
    """Last tokens of earlier n-grams whose prefix ends the sequence, sorted, without the allowed ones.

    Only n-grams that begin in the last `window` tokens count; for n = 1 nothing is banned.
    """
    none = F.array().cast("array<int>")
    if n < 2:
        return none
    size = F.size(ids)
    prefix = F.slice(ids, size - (n - 2), F.lit(n - 1))
    starts = F.sequence(F.greatest(F.lit(0), size - window), size - n)
    hits = F.filter(starts, lambda i: F.slice(ids, i + 1, F.lit(n - 1)) == prefix)
    found = F.array_sort(F.array_distinct(F.transform(hits, lambda i: F.get(ids, i + n - 1))))
    kept = F.array_except(found, F.array(*[F.lit(a) for a in allowed or []]).cast("array<int>"))
    return F.when((size < n) | (size - n < F.greatest(F.lit(0), size - window)), none).otherwise(kept)
