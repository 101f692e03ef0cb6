"""Whitening against numpy on all rows."""

import numpy as np
import pytest

from tallyframe.llm import catalog, whitening
from tallyframe.llm.whitening import whitened_vectors

FOLDER = "/root/testdata/sf0.01"
KIND = "vec_id long, embedding array<double>, label int, x array<int>, part string, place string, `index` string, n string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, [1], "p", "q", "i", "n") for i, v in rows], KIND)


def whole_numbers(rows):
    usable = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    return [i for i, _ in usable], np.array(
        [np.floor(64 * np.array(v, float)).astype(np.int64) + 1_000_000 for _, v in usable]
    )


def check(rows, found, components=16):
    """Rows of the result against numpy; vec_id must be unique in ``rows``."""
    ids, x = whole_numbers(rows)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    kept = min(components, int((values > values[0] * 1e-11).sum()))
    white = ((n * x - sums) / n) @ axes[:, :kept] / np.sqrt(values[:kept])
    assert len(found) == kept * len(ids)
    table = {(row["vec_id"], row["component"]): row for row in found}
    got = np.array([[table[i, k + 1]["whitened"] for k in range(kept)] for i in ids])
    signs = np.sign((got * white).sum(axis=0))
    assert np.abs(got - white * signs).max() < 1e-7
    deviations = [sum(int(v) ** 2 for v in n * row - sums) for row in x]
    assert [table[i, 1]["deviation"] for i in ids] == deviations
    assert {row["n"] for row in found} == {n}
    shares = [table[ids[0], k + 1]["explained"] for k in range(kept)]
    assert np.allclose(shares, values[:kept] / np.trace(covariance), rtol=1e-9)
    assert len({row["identity_error"] for row in found}) == 1 and 0 <= found[0]["identity_error"] < 1e-9


def test_query_on_its_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(rows, catalog.op12_whitening(spark, FOLDER).collect())


def test_awkward_rows_and_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 1000)  # 25 rows of 5 entries to a block
    chance = np.random.default_rng(7)
    mix = chance.normal(size=(5, 5))
    rows = [(i, [float(c) for c in mix @ chance.normal(size=5)]) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]  # a third of all rows are copies
    rows += [(5001, None), (5002, []), (5003, [1.0, None, 2.0, 3.0, 4.0]), (5004, [float("nan")] * 5),
             (5005, [float("inf"), 0.0, 0.0, 0.0, 0.0])]
    found = whitened_vectors(frame(spark, rows).repartition(5)).collect()
    check(rows, found)
    same = [r["whitened"] for r in found if r["component"] == 2 and (r["vec_id"] >= 1000 or r["vec_id"] == 0)]
    assert len(same) == 201 and max(same) - min(same) < 1e-12


def test_fewer_directions_and_repeated_ids(spark):
    rows = [(k, [k / 8.0, k / 4.0, 1.0]) for k in range(10)]  # all on one line
    found = whitened_vectors(frame(spark, rows)).collect()
    check(rows, found)
    assert {row["component"] for row in found} == {1} and abs(found[0]["explained"] - 1) < 1e-9
    twice = whitened_vectors(frame(spark, rows + [(3, rows[3][1]), (None, rows[4][1])])).collect()
    assert sum(row["vec_id"] == 3 for row in twice) == 2 and sum(row["vec_id"] is None for row in twice) == 1
    two = whitened_vectors(frame(spark, [(k, [float(k % 3), float(k % 5)]) for k in range(15)]), components=1)
    assert {row["component"] for row in two.collect()} == {1}


def test_no_rows_and_errors(spark):
    assert whitened_vectors(frame(spark, [])).count() == 0
    assert whitened_vectors(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    assert whitened_vectors(frame(spark, [(1, None)])).columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error",
    ]
    with pytest.raises(ValueError, match="several dimensions"):
        whitened_vectors(frame(spark, [(1, [1.0]), (2, [1.0, 2.0])]))
    with pytest.raises(Exception, match="too large"):
        whitened_vectors(frame(spark, [(1, [1e300, 1.0]), (2, [1.0, 2.0])])).collect()
