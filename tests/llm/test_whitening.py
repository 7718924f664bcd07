"""Whitening against numpy and exact integers."""

import numpy as np
import pytest

from tripmart.llm import whitening
from tripmart.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>"


def plain(vectors: dict[int, list], components: int = 4):
    """vec_id -> (deviation, whitened), shares, n; by numpy over the distinct vectors."""
    x = {k: [int(np.floor(256 * float(np.float32(c)))) for c in v] for k, v in vectors.items()}
    fit = sorted({tuple(v) for v in x.values()})
    n, sums = len(fit), np.array(fit, dtype=object).sum(axis=0)
    centred = np.array(fit, dtype=float) - np.array([float(s) / n for s in sums])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    total = np.trace(centred.T @ centred / n)
    rows = {
        k: (
            sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True)),
            (np.array(v) - np.array([float(s) / n for s in sums])) @ axes / np.sqrt(values),
        )
        for k, v in x.items()
    }
    return rows, values / total, n


def check(result, vectors):
    rows, shares, n = plain(vectors)
    found = {}
    for row in result:
        assert row.n == n and row.deviation == rows[row.vec_id][0]
        assert abs(row.explained / shares[row.component - 1] - 1) < 1e-9
        assert row.identity_error < 1e-9
        found[row.vec_id, row.component] = row.whitened
    assert len(found) == len(result) == len(rows) * len(shares)
    for k in range(1, len(shares) + 1):
        mine = np.array([found[i, k] for i in rows])
        other = np.array([rows[i][1][k - 1] for i in rows])
        assert min(np.abs(mine - other).max(), np.abs(mine + other).max()) < 1e-8


def test_query_against_numpy(spark):
    folder = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    check(QUERIES["op12_embedding_whitening"](spark, folder).collect(),
          {row.vec_id: row.embedding for row in table})


@pytest.mark.parametrize("block", [(16 << 20, 1024), (8 * 3 * 256, 3)])
def test_blocks_repeats_and_dropped_rows(spark, monkeypatch, block):
    monkeypatch.setattr(whitening, "BLOCK_BYTES", block[0])
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", block[1])
    rng = np.random.default_rng(7)
    good = {k: [float(c) for c in rng.normal(0, 0.2, 7) * range(1, 8)] for k in range(600)}
    good |= {k: good[3] for k in range(600, 1100)}
    bad = [(-1, None), (-2, [None] * 7), (-3, [float("nan")] * 7), (-4, [1.0] * 6 + [float("inf")])]
    table = spark.createDataFrame([*good.items(), *bad], SCHEMA)
    check(whitening.whitened(table).collect(), good)


def test_degenerate_tables(spark):
    def run(rows, schema=SCHEMA):
        return whitening.whitened(spark.createDataFrame(rows, schema)).collect()

    assert run([]) == run([(1, None)]) == run([(1, [])]) == []
    one = run([(None, [0.5, -0.5]), (None, [0.5, -0.5])])
    assert len(one) == 4 and {(r.n, r.deviation, r.whitened, r.explained) for r in one} == {(1, 0, 0.0, 0.0)}
    line = run([(1, [0.0, 1.0]), (2, [0.0, 2.0]), (3, [0.0])])
    by = {(r.vec_id, r.component): r for r in line}
    assert by[3, 1].deviation == (3 * 0 - 768) ** 2
    assert by[1, 2].whitened == 0.0 and by[1, 2].explained == 0.0 and by[1, 1].explained == 1.0
    assert by[1, 1].identity_error < 1e-12 and abs(abs(by[2, 1].whitened) - 1.5**0.5) < 1e-12


def test_large_values_and_clashing_columns(spark):
    rows = [(1, [1e9, 0.0], 1, "a"), (2, [-1e9, 1.0], 2, "b"), (3, [5.0, 2.0], 3, "c")]
    table = spark.createDataFrame(rows, f"{SCHEMA}, digest int, x string")
    found = {r.vec_id: r.deviation for r in whitening.whitened(table).collect()}
    x = {k: [int(np.floor(256 * float(np.float32(c)))) for c in v] for k, v, *_ in rows}
    sums = [sum(v[i] for v in x.values()) for i in range(2)]
    exact = {k: sum((3 * a - s) ** 2 for a, s in zip(v, sums, strict=True)) for k, v in x.items()}
    assert found == {k: v if v < 2**63 else None for k, v in exact.items()}
