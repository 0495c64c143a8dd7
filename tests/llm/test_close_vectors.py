"""Close vectors of odd magnitudes, with repeated and null ids and clashing columns."""

from __future__ import annotations

import numpy as np
import pytest

from kinetable.llm import covertree

COLUMNS = "vec_id long, embedding array<double>, label int, key string, cell string, n_links long"


@pytest.mark.parametrize("cell", [4, 512])
def test_magnitudes_and_ids(spark, cell):
    rng = np.random.default_rng(4)
    rows, scales = [], [1.0, 1e200, 1e-200, 1e300, 5e-324 * 2**60, 1e-100, 1e100]
    directions = rng.normal(size=(6, 5))
    for place, direction in enumerate(directions):
        for number, scale in enumerate(scales):
            moved = direction / np.linalg.norm(direction) + 0.02 * rng.normal(size=5)
            rows.append((10 * place + number, (moved * scale).tolist(), place % 2, "k", "c", 7))
    rows += [
        (3, rows[3][1], 0, "k", "c", 7),
        (None, rows[0][1], 0, "k", "c", 7),
        (None, None, 0, "k", "c", 7),
        (200, [0.0] * 5, 0, "k", "c", 7),
        (201, [1e300, 0.0, 0.0, 0.0, 1.0], 5, "k", "c", 7),
        (202, [1e-300, 0.0, 0.0, 0.0, 0.0], 5, "k", "c", 7),
        (203, [], 5, "k", "c", 7),
    ]
    frame = spark.createDataFrame(rows, COLUMNS)
    settings = covertree.Settings(cell=cell)
    found = covertree.close_vectors(frame, settings).collect()

    units = []
    for _, vector, *_ in rows:
        if vector is None or not vector or not any(vector):
            units.append(None)
            continue
        scaled = np.array(vector) / np.abs(vector).max()
        units.append(scaled / np.linalg.norm(scaled))
    linked = {
        (i, j)
        for i in range(len(rows))
        for j in range(len(rows))
        if i != j and units[i] is not None and units[j] is not None
        and rows[i][2] == rows[j][2] and units[i] @ units[j] >= 0.93
    }
    names = list(range(len(rows)))
    for _ in rows:
        for i, j in linked:
            names[i] = names[j] = min(names[i], names[j])
    expected = []
    for i, row in enumerate(rows):
        group = [rows[j][0] for j in range(len(rows)) if names[j] == names[i]]
        known = [one for one in group if one is not None]
        name = min(known) if known else None
        expected.append((row[0], sum(a == i for a, _ in linked), name, row[0] == name))
    assert len(linked) > 200
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
