"""The search of count vectors against brute force, and the document queries against their SQL."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from simloom import queries
from simloom.operators import count_search, knn

DIM = 24


def counts(seed=5):
    """Families of like rows, one of many equal rows, a row of large counts and one of a single word."""
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 30, (12, DIM)) * (rng.random((12, DIM)) < 0.5)
    rows = np.maximum(0, np.repeat(base, 9, axis=0) + rng.integers(-1, 2, (108, DIM)))
    rows = np.concatenate([rows, np.repeat(base[:1], 70, axis=0), rows[:2] * 100_003, np.eye(DIM, dtype=np.int64)[:1]])
    return rows[rows.sum(1) > 0]


def table(spark, matrix, ids):
    row, place = np.nonzero(matrix)
    code = count_search.packed(row, place, matrix[row, place], len(matrix))
    return spark.createDataFrame([(int(i), c) for i, c in zip(ids, code.to_pylist())], "id long, code binary").repartition(3)


def brute(matrix, ids, k, least):
    length = np.sqrt((matrix.astype(float) ** 2).sum(1)) + 1e-12
    dot = np.array([[float(sum(int(x) * int(y) for x, y in zip(a, b))) for b in matrix] for a in matrix])
    sim = np.floor(dot / np.multiply.outer(length, length) * 1e6 + 0.5) / 1e6
    out = set()
    for a, q in enumerate(ids):
        order = sorted(range(len(ids)), key=lambda b: (ids[b] != q, -sim[a, b], ids[b]))
        out |= {(int(q), rk, int(ids[b]), sim[a, b]) for rk, b in enumerate(order[:k], 1) if sim[a, b] >= least}
    return out


@pytest.mark.parametrize(("k", "block"), [(5, 16), (300, 50), (40, None)])
def test_lists_of_counts_equal_brute_force(spark, monkeypatch, k, block):
    monkeypatch.setattr(count_search, "ROWS", 8)
    monkeypatch.setattr(count_search, "COLUMNS", 16)
    monkeypatch.setattr(count_search, "HELD", 50)
    matrix = counts()
    ids = np.random.default_rng(1).permutation(1000)[: len(matrix)]
    found = count_search.counted_topk(table(spark, matrix, ids), k, 0.9, DIM, block)
    assert {tuple(r) for r in found.collect()} == brute(matrix, ids, k, 0.9)


def test_tiles_of_a_block_pair_miss_nothing(monkeypatch):
    """As a worker runs it, where a patch of this process holds: small tiles, hot rows, early pruning."""
    for name, value in (("ROWS", 8), ("COLUMNS", 16), ("HELD", 50), ("BASIS", 4)):
        monkeypatch.setattr(count_search, name, value)
    matrix = counts(6)
    ids = np.random.default_rng(2).permutation(1000)[: len(matrix)].astype(np.int64)
    row, place = np.nonzero(matrix)
    whole = pa.table({"id": ids, "code": count_search.packed(row, place, matrix[row, place], len(matrix))})
    parts = [whole.slice(0, 80), whole.slice(80)]
    for k in (3, 1000):
        found = []
        for one, two in ((parts[0], None), (parts[1], None), tuple(parts)):
            found += list(count_search.block_pair(one, two, DIM, k, 0.9))
        got = {}
        for q, n, sim in zip(*(np.concatenate(x) for x in zip(*found))):
            got.setdefault(q, []).append((q != n, -sim, n))
        got = {(int(q), rk, int(n), -s) for q, hits in got.items() for rk, (_, s, n) in enumerate(sorted(hits)[:k], 1)}
        assert got == brute(matrix, ids, k, 0.9)


def test_repeated_ids_add_up_and_nulls_raise(spark):
    matrix = np.array([[1, 2] + [0] * 22, [300, 0] + [0] * 22, [301, 2] + [0] * 22])
    found = count_search.counted_topk(table(spark, matrix, [7, 7, 9]), 5, 0.999, DIM)
    assert {(r["q"], r["n"]) for r in found.collect()} == {(7, 7), (7, 9), (9, 7), (9, 9)}
    assert count_search.counted_topk(table(spark, matrix, [1, 2, 3]).limit(0), 5, 0.9, DIM).count() == 0
    with pytest.raises(ValueError):
        count_search.counted_topk(spark.createDataFrame([(None, b"")], "id long, code binary"), 5, 0.9, DIM)


def documents():
    """Texts with near copies, more equal ones than a list holds, long ones, and rows that are none."""
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(300)] + ["Ärger", "x,", "a\tb", "ÉTÉ"]
    texts = [" ".join(rng.choice(words, 60)) for _ in range(40)]
    texts += [t + " extra" for t in texts[:20]] + [texts[0] + "\n more"] * 15 + [texts[1].upper()] * 130 + ["one " * 900 + "two", "one " * 500, "ONE"]
    rows = [(int(i), t) for i, t in zip(rng.permutation(5000), texts)]
    return rows + [(6001, None), (6002, " \t "), (6003, ""), (None, texts[2])]


def same_as_sql(spark, tmp_path, name):
    duckdb = pytest.importorskip("duckdb")
    ids, texts = zip(*documents())
    pq.write_table(pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts)}), tmp_path / "documents.parquet")
    session = duckdb.connect()
    session.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet'")
    want = sorted(session.execute(queries.oracle_sql()[name]).fetchall())
    got = sorted(tuple(r) for r in queries.queries()[name](spark, str(tmp_path)).collect())
    assert got == want and len(want) > 100


def dense_search(*args, **kwargs):
    raise AssertionError("all pairs of dense vectors are searched")


def test_component_removal_of_documents_equals_its_sql(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(knn, "exact_topk", dense_search)
    same_as_sql(spark, tmp_path, "dedup_component_documents")


def test_greedy_removal_of_documents_equals_its_sql(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(knn, "exact_topk", dense_search)
    same_as_sql(spark, tmp_path, "dedup_greedy_documents")
