import numpy as np
import pytest

from odometer.llm.ann import nearest_neighbours

SCHEMA = "vec_id long, embedding array<float>, cls int"


def brute(rows, nearest, step=20):
    fine = []
    for k, (i, v) in enumerate(rows):
        if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v):
            fine.append((k, i, np.array(v, np.float32).astype(float)))
    out = []
    for k, i, v in fine:
        if i % step == 0:
            rest = sorted((-float(w @ v), j) for m, j, w in fine if m != k)
            out += [(i, n + 1, j, round(-s, 9)) for n, (s, j) in enumerate(rest[:nearest])]
    return out


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1) for i, v in rows], schema)


def found(df, **options):
    rows = nearest_neighbours(df, **options).collect()
    return [(r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in rows]


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    return rng.normal(size=(3000, 12)) * rng.uniform(0.5, 2, size=(3000, 1))


def test_small_tables_are_exact(spark, vectors):
    rows = [(i, v.tolist()) for i, v in enumerate(vectors[:90])]
    rows += [(100, None), (120, [0.0] * 12), (140, [float("nan")] * 12), (160, [float("inf")] + [1.0] * 11), (180, [None] + [1.0] * 11), (None, rows[0][1])]
    assert sorted(found(table(spark, rows))) == sorted(brute(rows, 20))
    few = rows[:5]
    assert sorted(found(table(spark, few))) == sorted(brute(few, 20))
    assert found(table(spark, rows[:1])) == [] and found(table(spark, [])) == []


def test_ties_and_a_hot_vector(spark, vectors):
    hot = vectors[0].tolist()
    rows = [(i, hot if i % 3 else v.tolist()) for i, v in enumerate(vectors[:240])]
    assert sorted(found(table(spark, rows), nearest=7)) == sorted(brute(rows, 7))


def test_rows_that_share_an_id(spark):
    """Each query leaves out its own row, not the first with its id."""
    rows = [(20, [1.0, 0.0]), (20, [3.0, 0.0]), (20, [1.0, 0.0]), (21, [0.5, 1.0]), (40, [3.0, 0.0])]
    want = sorted(brute(rows, 20))
    assert sorted(found(table(spark, rows))) == want
    assert (20, 1, 20, 3.0) in want and (20, 1, 20, 9.0) not in want and (20, 1, 40, 9.0) in want
    many = [(20, [2.0, 1.0])] * 30 + [(7, [2.0, 1.0])] * 3 + rows
    assert sorted(found(table(spark, many))) == sorted(brute(many, 20))


def test_recall_with_vectors_of_one_length(spark, vectors):
    unit = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(unit)]
    # The share alone, without the least number of candidates.
    got = found(table(spark, rows), least=1)
    assert len(got) == 150 * 20
    want = {(q, j) for q, _, j, _ in brute(rows, 20)}
    assert len({(q, j) for q, _, j, _ in got} & want) / len(want) >= 0.9
    for q, n, j, s in got[:50]:
        assert abs(s - float(unit[q].astype(float) @ unit[j].astype(float))) < 1e-9


def test_recall_with_vectors_of_any_length(spark, vectors):
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    got = found(table(spark, rows, "vec_id long, embedding array<double>, cls int"), quota=8.0)
    want = {(q, j) for q, _, j, _ in brute(rows, 20)}
    assert len({(q, j) for q, _, j, _ in got} & want) / len(want) >= 0.9


@pytest.mark.parametrize("lengths", ["uniform", "lognormal", "one far longer"])
def test_recall_with_mixed_lengths_by_the_defaults(spark, lengths):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(8000, 32))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    if lengths == "uniform":
        v *= rng.uniform(0.5, 2, size=(8000, 1))
    elif lengths == "lognormal":
        v *= rng.lognormal(0, 1, size=(8000, 1))
    else:
        v[1] *= 1e6
    v = v.astype(np.float32).astype(float)
    got = found(table(spark, [(i, x.tolist()) for i, x in enumerate(v)]), query_step=100)
    scores = v[::100] @ v.T
    scores[np.arange(80), np.arange(0, 8000, 100)] = -np.inf
    want = {(q * 100, int(j)) for q, best in enumerate(np.argsort(-scores, axis=1)[:, :20]) for j in best}
    assert len(got) == 80 * 20 and len({(q, j) for q, _, j, _ in got} & want) / len(want) >= 0.9


def test_many_vectors_that_tie_at_the_last_place(spark):
    signs = np.random.default_rng(8).choice([-1.0, 1.0], size=(900, 12))
    rows = [(i, v.tolist()) for i, v in enumerate(signs)]
    assert sorted(found(table(spark, rows))) == sorted(brute(rows, 20))


def test_each_component_count_is_an_index_of_its_own(spark, vectors):
    rows = [(i, v.tolist()[: 7 if i % 3 == 1 else 12]) for i, v in enumerate(vectors[:400])]
    rows += [(1000, [1.0] * 13), (1001, [])]
    want = [r for size in (7, 12) for r in brute([(i, v) for i, v in rows if len(v) == size], 20)]
    assert len(want) == 20 * 20 and sorted(found(table(spark, rows))) == sorted(want)
