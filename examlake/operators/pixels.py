"""Pixel gates over decoded images (S11, I1-I12, J13, W14, G11): NumPy reductions in tasks, one image at a time."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Kinds of drawings that checks are for, or not for.
AXES, FILLED = ("function", "bar", "scatter", "distribution", "regression_plot", "pie"), ("heatmap",)
GRAPHS, SPARSE = ("networkx", "graphviz"), ("geometry", "venn", "table", "circuit", "fallback")


def images(spark: SparkSession, folder: str) -> DataFrame:
    """(path, size, height, width, channels, pixels) of the images in a folder (S11, S10): what is no image has height
    -1. The file's size comes from its listing; each file is decoded in a task."""
    found = spark.read.format("image").option("dropInvalid", False).load(folder).select("image.*")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{png,jpg,jpeg,webp}").load(folder).select("path", F.col("length").alias("size"))
    key = lambda c: F.regexp_replace(c, "^file:/+", "/")
    return files.select(key("path").alias("path"), "size").join(found.select(key("origin").alias("path"), "height", "width", F.col("nChannels").alias("channels"), F.col("data").alias("pixels")), "path", "left")


def runs(hits: np.ndarray) -> np.ndarray:
    """(start, end) of each stretch of hits in a row."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hits.astype(np.int8), [0]])))
    return edge.reshape(-1, 2)


def labelled(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, boxes) of four-connected regions: the runs of each row as (y, x0, x1, region), and for each region its
    size, centre and box. Runs of neighbouring rows that touch are one region, by union-find."""
    found, up, last = [], [], []

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for y in range(len(mask)):
        now = []
        for a, z in runs(mask[y]):
            i = len(up)
            up.append(i)
            for b, w, j in last:
                if b < z and a < w:
                    up[root(i)] = root(j)
            now.append((a, z, i))
            found.append((y, a, z, i))
        last = now
    rows = np.array([(y, a, z, root(i)) for y, a, z, i in found], np.int64).reshape(-1, 4)
    out = []
    for region in np.unique(rows[:, 3]):
        y, a, z = rows[rows[:, 3] == region, :3].T
        n = (z - a).sum()
        out.append((n, (y * (z - a)).sum() / n, ((a + z - 1) / 2 * (z - a)).sum() / n, y.min(), a.min(), y.max(), z.max() - 1))
    return rows, np.array(out, float).reshape(-1, 7)


def overlapping(boxes: np.ndarray, least: float = 0.30) -> int:
    """Pairs of boxes (y0, x0, y1, x1) that share over least of the smaller one (J13): a sweep down the picture, in
    which a box meets those that begin before it ends."""
    y0, x0, y1, x1 = boxes[np.argsort(boxes[:, 0], kind="stable")].T
    area, ends, pairs = (y1 - y0) * (x1 - x0), np.searchsorted(y0, y1), 0
    for i, end in enumerate(ends):
        j = slice(i + 1, max(i + 1, end))
        tall = np.minimum(y1[i], y1[j]) - y0[j]
        wide = np.minimum(x1[i], x1[j]) - np.maximum(x0[i], x0[j])
        smaller = np.minimum(area[i], area[j])
        pairs += int(((tall > 0) & (wide > 0) & (smaller > 0) & (tall * wide > least * smaller)).sum())
    return pairs


def close(centres: np.ndarray, least: float) -> int:
    """Pairs of centres nearer than least (J13), by the same sweep."""
    y, x = centres[np.argsort(centres[:, 0], kind="stable")].T
    ends = np.searchsorted(y, y + least, "right")
    return sum(int((np.hypot(y[i + 1 : end] - y[i], x[i + 1 : end] - x[i]) < least).sum()) for i, end in enumerate(ends))


def generated_issues(a: np.ndarray, size: int) -> list[str]:
    """Checks of a generated image."""
    h, w = a.shape[:2]
    grey, step = a.astype(np.float32).mean(2), max(1, min(w, h) // 160)
    white, black = (a > 245).all(2).mean(), (a < 10).all(2).mean()
    content = (a < 235).any(2)
    filled, colours = content.mean(), len(np.unique(a[::step, ::step].reshape(-1, 3) // 16, axis=0))
    edge = float(np.abs(np.diff(grey, axis=1)).mean() + np.abs(np.diff(grey, axis=0)).mean()) / 2
    y, x = np.flatnonzero(content.any(1)), np.flatnonzero(content.any(0))
    box = (y[-1] - y[0] + 1) * (x[-1] - x[0] + 1) / (h * w) if len(y) else None
    checks = {
        "resolution": w < 512 or h < 512, "white": white > 0.985 or (a < 240).any(2).mean() < 0.006, "black": black > 0.985 or (a > 20).any(2).mean() < 0.006,
        "flat": a.reshape(-1, 3).std(0).mean() < 3.0 or grey.std() < 3.0, "empty": filled < 0.015, "full": filled > 0.92, "tiny": box is not None and box < 0.05, "no_content": box is None,
        "few_colours": colours < 6, "small_file": (size < 8000 and (filled < 0.03 or colours < 12)) or (8000 <= size < 20000 and filled < 0.015), "smooth": edge < 0.8, "noise": edge > 45,
    }
    return [k for k, bad in checks.items() if bad]


def blank(a: np.ndarray, size: int) -> bool:
    """Hardly any pixel that is not white, in a small file or with few colours."""
    step = max(1, len(a) // 100)
    return bool((a < 240).any(2).mean() < 0.01 and (size < 10000 or len(np.unique(a[::step, ::step].reshape(-1, 3), axis=0)) < 30))


def occluded(a: np.ndarray) -> str | None:
    """Rows of writing too near, blocks too dense unless coloured, boxes that overlap, or centres too near (I4)."""
    h, w = a.shape[:2]
    dark = a.mean(2) < 80
    rows = [r for r in runs(dark.sum(1) / w > 0.05) if r[1] - r[0] > 3]
    if sum(b[0] - t[1] < 2 for t, b in zip(rows, rows[1:], strict=False)) >= 3:
        return "rows_overlap"
    sums = np.pad(dark.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    y, x = np.arange(0, h - 50, 25), np.arange(0, w - 50, 25)
    if len(y) and len(x):
        block = sums[np.ix_(y + 50, x + 50)] - sums[np.ix_(y, x + 50)] - sums[np.ix_(y + 50, x)] + sums[np.ix_(y, x)]
        if (block > 0.70 * 2500).mean() > 0.05:
            inks = a[dark].astype(int)
            coloured = len(inks) > 100 and (np.ptp(inks, axis=1) > 30).mean() > 0.50
            return None if coloured else "blocks_dense"
    _, regions = labelled(dark)
    letters = regions[(regions[:, 0] > 100) & (regions[:, 0] < 5000)]
    if len(letters) < 3:
        return None
    inside = letters[(letters[:, 1] > 0.12 * h) & (letters[:, 1] < 0.85 * h) & (letters[:, 2] > 0.12 * w)]
    if overlapping(inside[:, 3:7]) >= 2:
        return "boxes_overlap"
    return "centres_close" if close(inside[:, 1:3], 0.02 * min(w, h)) >= 4 else None


def clipped(a: np.ndarray) -> list[str]:
    """Edges with too much ink in the outermost five pixels."""
    edges = {"top": (a[:5], 0.20), "left": (a[:, :5], 0.20), "right": (a[:, -5:], 0.20), "bottom": (a[-5:], 0.35)}
    return [k for k, (part, most) in edges.items() if (part.mean(2) < 100).mean() > most]


def garbled(a: np.ndarray) -> bool:
    """Far more short strokes in sampled columns than letters make: boxes in place of glyphs."""
    dark, columns = a.mean(2) < 80, range(0, a.shape[1], max(1, a.shape[1] // 50))
    strokes = 0
    for x in columns:
        r = runs(dark[:, x])
        r = r[r[:, 1] < len(dark)]  # a stroke that reaches the last row is not counted
        strokes += int(((r[:, 1] - r[:, 0] >= 8) & (r[:, 1] - r[:, 0] <= 20)).sum())
    return strokes > 12 * len(columns)


def small_content(a: np.ndarray) -> bool:
    """What is drawn spans less than 15 per cent of the picture."""
    drawn = (a < 235).any(2)
    y, x = np.flatnonzero(drawn.any(1)), np.flatnonzero(drawn.any(0))
    return not len(y) or (y[-1] - y[0]) * (x[-1] - x[0]) < 0.15 * drawn.size


def middle(a: np.ndarray) -> np.ndarray:
    y, x = int(len(a) * 0.12), int(a.shape[1] * 0.12)
    return a[y : len(a) - y, x : a.shape[1] - x]


def empty_frame(a: np.ndarray) -> bool:
    """A white middle without data: neither white, nor lines, nor grid (I8)."""
    c = middle(a).astype(np.int16)
    if not c.size:
        return False
    white, mean = (c > 245).all(2), c.mean(2)
    grid = (np.ptp(c, axis=2) < 20) & (mean > 140) & (mean < 240)
    return bool(white.mean() > 0.85 and (~white & ~(c < 40).all(2) & ~grid).mean() < 0.005)


def empty_heatmap(a: np.ndarray) -> bool:
    """The left four fifths of the middle have hardly any colour and are white."""
    c = middle(a)
    body = c[:, : int(c.shape[1] * 0.80)].astype(np.int16)
    return bool(body.size and (np.ptp(body, axis=2) > 30).mean() < 0.02 and (body > 240).all(2).mean() > 0.90)


def sparse_graph(a: np.ndarray) -> bool:
    """Hardly anything drawn."""
    return bool((a < 235).any(2).mean() < 0.005)


def layout_issues(a: np.ndarray) -> list[str]:
    """Crowding (I12, I5), each with its severity: inked edges, rows too near, dense cells of a grid of four by four,
    crowded title and caption."""
    h, w = a.shape[:2]
    grey = a.mean(2)
    edges = {"top": a[:3], "bottom": a[-3:], "left": a[:, :3], "right": a[:, -3:]}
    out = [f"medium:edge_clipping:{k}" for k, part in edges.items() if (part < 200).any(2).mean() > 0.15]
    rows = runs((grey < 80).sum(1) / w > 0.05)
    out += [f"high:text_overlap:{t[0]}" for t, b in zip(rows, rows[1:], strict=False) if b[0] - t[1] < 3 and t[1] - t[0] > 5]
    ch, cw = h // 4, w // 4
    out += [f"low:overcrowded:{x},{y}" for y in range(4) for x in range(4) if ch and cw and (grey[y * ch : (y + 1) * ch, x * cw : (x + 1) * cw] < 200).mean() > 0.6]
    for name, part in (("title", grey[: int(h * 0.1)]), ("caption", grey[int(h * 0.85) :])):
        out += [f"medium:{name}_crowded"] if part.size and (part < 200).mean() > 0.5 else []
    return out


def drawn_issues(a: np.ndarray, size: int, engine: str, plot: str, kind: str) -> list[str]:
    """The checks that a drawing of this kind is put to."""
    filled = plot in FILLED or kind in FILLED
    checks = {
        "blank": lambda: blank(a, size), "occluded": lambda: not filled and occluded(a), "clipped": lambda: clipped(a), "garbled": lambda: garbled(a),
        "small_content": lambda: engine not in GRAPHS + SPARSE and small_content(a), "empty_frame": lambda: (plot in AXES or (engine == "matplotlib" and plot not in FILLED)) and empty_frame(a),
        "empty_heatmap": lambda: filled and empty_heatmap(a), "sparse_graph": lambda: engine in GRAPHS and sparse_graph(a),
    }
    return [k for k, check in checks.items() if check()]


def array(pixels: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Height by width by three; one channel stands for all three, a fourth is left out."""
    a = np.frombuffer(pixels, np.uint8).reshape(height, width, channels)
    return np.repeat(a, 3, axis=2) if channels == 1 else a[:, :, :3]


def pixel_gate(rows: DataFrame, generated: Column | None = None) -> DataFrame:
    """rows with issues, layout and passed.

    rows: path, size, height, width, channels, pixels, and engine, plot_type, diagram_type (null where not known).
    Files under 2000 bytes, or that are no image, fail at once. generated: which rows a model has drawn."""
    made = generated if generated is not None else F.coalesce(F.col("diagram_type") == "image_prompt", F.lit(False))
    text = lambda c: F.lower(F.coalesce(c, F.lit("")))

    @F.pandas_udf("issues array<string>, layout array<string>")
    def run(pixels: pd.Series, size: pd.Series, height: pd.Series, width: pd.Series, channels: pd.Series, engine: pd.Series, plot: pd.Series, kind: pd.Series, made: pd.Series) -> pd.DataFrame:
        out = []
        for p, s, h, w, c, e, t, k, g in zip(pixels, size, height, width, channels, engine, plot, kind, made, strict=True):
            if s < 2000:
                out.append((["too_small"], []))
            elif p is None or not h > 0:
                out.append((["no_image"], []))
            else:
                a = array(p, int(h), int(w), int(c))
                out.append((generated_issues(a, int(s)) if g else drawn_issues(a, int(s), e, t, k), layout_issues(a)))
        return pd.DataFrame(out, columns=["issues", "layout"])

    found = run("pixels", "size", F.coalesce("height", F.lit(-1)), F.coalesce("width", F.lit(-1)), F.coalesce("channels", F.lit(0)), text("engine"), text("plot_type"), text("diagram_type"), made)
    return rows.withColumn("_r", found).withColumns({"issues": F.col("_r.issues"), "layout": F.col("_r.layout"), "passed": F.size("_r.issues") == 0}).drop("_r")


def file_sane(size: Column, mean: Column | None = None, least: int = 1024, dark: float = 3.0, bright: float = 254.0) -> Column:
    """Whether a rendered file holds enough bytes to be an image and, where its mean brightness is given, is neither all
    but white nor all but black (G11). A file without a size is none."""
    large = F.coalesce(size, F.lit(0)) >= least
    return large if mean is None else large & F.coalesce(mean.between(dark, bright), F.lit(False))
