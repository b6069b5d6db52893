"""Pixel gates on arrays drawn for each rule."""

import numpy as np

from examlake.operators import pixels as P


def white(h=600, w=600):
    return np.full((h, w, 3), 255, np.uint8)


def test_labels_against_flood_fill():
    mask = np.random.default_rng(3).random((40, 50)) < 0.45
    seen, sizes = np.zeros_like(mask), []
    for y, x in zip(*np.nonzero(mask)):
        if seen[y, x]:
            continue
        todo, n = [(y, x)], 0
        seen[y, x] = True
        while todo:
            i, j = todo.pop()
            n += 1
            for a, b in ((i + 1, j), (i - 1, j), (i, j + 1), (i, j - 1)):
                if 0 <= a < 40 and 0 <= b < 50 and mask[a, b] and not seen[a, b]:
                    seen[a, b] = True
                    todo.append((a, b))
        sizes.append(n)
    _, regions = P.labelled(mask)
    assert sorted(regions[:, 0].astype(int)) == sorted(sizes)


def test_generated():
    assert "white" in P.generated_issues(white(), 9000) and "black" in P.generated_issues(np.zeros((600, 600, 3), np.uint8), 9000)
    a = white()
    a[50:550:10, 40:560] = (20, 60, 90)
    a[40:560, 60:540:40] = (200, 30, 30)
    a[100:200, 100:300] = np.linspace(0, 230, 200, dtype=np.uint8)[None, :, None]
    assert P.generated_issues(a, 90000) == [] and "resolution" in P.generated_issues(a[:400, :400], 90000)
    assert "small_file" in P.generated_issues(np.where(a < 255, 0, 255).astype(np.uint8), 5000)


def test_drawn():
    a = white()
    assert P.blank(a, 5000) and P.sparse_graph(a) and P.small_content(a) and P.empty_frame(a) and P.empty_heatmap(a)
    framed = a.copy()
    framed[[80, 520], 80:520] = 0
    framed[80:520, [80, 519]] = 0
    assert P.empty_frame(framed) and not P.small_content(framed)
    filled = framed.copy()
    filled[120:480, 120:480] = (200, 40, 40)
    assert not P.empty_frame(filled) and not P.empty_heatmap(filled) and not P.blank(filled, 50000)
    assert P.clipped(np.zeros((100, 100, 3), np.uint8)) == ["top", "left", "right", "bottom"] and P.clipped(a) == []
    boxes = a.copy()
    for y in range(10, 590, 24):
        boxes[y : y + 12] = 0
    assert P.garbled(boxes) and not P.garbled(a)
    assert P.drawn_issues(a, 5000, "networkx", "", "") == ["blank", "sparse_graph"] and "empty_frame" in P.drawn_issues(framed, 50000, "matplotlib", "bar", "")


def test_occluded():
    a = white()
    for y in (100, 105, 110, 115):  # lines one pixel apart
        a[y : y + 4, 50:550] = 0
    assert P.occluded(a) == "rows_overlap"
    dense = white()
    dense[100:500, 100:500] = 0
    assert P.occluded(dense) == "blocks_dense"
    dense[100:500, 100:500] = (70, 0, 0)
    assert P.occluded(dense) is None
    spots = white()
    for k in range(5):
        spots[200 : 200 + 12, 100 + 14 * k : 100 + 14 * k + 12] = 0
    assert P.occluded(spots) is None and P.occluded(white()) is None
    assert P.overlapping(np.array([[0, 0, 10, 10], [5, 0, 15, 10], [40, 40, 50, 50]], float)) == 1 and P.close(np.array([[0, 0], [0, 3], [90, 9]], float), 4) == 1


def test_layout():
    a = white()
    a[:60] = 0
    got = P.layout_issues(a)
    assert "medium:edge_clipping:top" in got and "medium:title_crowded" in got and P.layout_issues(white()) == []
