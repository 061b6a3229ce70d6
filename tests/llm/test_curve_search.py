import numpy as np

from tillspark.llm import curve_search as C


def brute(rows, every=50, k=5):
    ids = np.array([i for i, _ in rows])
    v = np.array([x for _, x in rows], float)
    out = {}
    for q in range(len(ids)):
        if ids[q] % every == 0:
            score = C.cosine(np.broadcast_to(v[q], v.shape), v)
            order = [j for j in np.lexsort((ids, -np.round(score, 12))) if ids[j] != ids[q]][:k]
            out[ids[q]] = [(ids[j], score[j]) for j in order]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, None if x is None else list(map(float, x)), 0) for i, x in rows],
                                 "vec_id bigint, embedding array<float>, label int")


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def f32(x):
    return np.asarray(x, np.float32)


def test_curve_steps_to_neighbours():
    cells = np.array([(a, b, c) for a in range(8) for b in range(8) for c in range(8)])
    keys = C.hilbert_keys(cells, 3)
    path = cells[np.argsort(keys)]
    assert len(set(keys)) == 512 and (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_recall_and_exact_scores(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK", 100)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 24))
    rows = [(i, f32(centres[i % 40] + 0.3 * rng.normal(size=24))) for i in range(3000)]
    want, got = brute(rows), answers(C.nearest(frame(spark, rows)))
    assert set(got) == set(want)
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want]
    assert np.mean(hits) / 5 >= 0.9
    v = dict(rows)
    for q, found in got.items():
        assert len(found) == 5 and q not in {i for i, _ in found}
        for i, s in found:
            a, b = v[q].astype(float), v[i].astype(float)
            assert abs(s - a @ b / np.linalg.norm(a) / np.linalg.norm(b)) < 1e-12


def test_common_vector_ties_and_unusable_rows(spark):
    rng = np.random.default_rng(2)
    hot = f32(rng.normal(size=6))
    rows = [(i, hot if i % 3 == 0 else f32(rng.normal(size=6))) for i in range(600)]
    bad = [(1000, None), (1050, np.zeros(6)), (1100, [1, 2, np.nan, 1, 1, 1]), (1150, [np.inf, 1, 1, 1, 1, 1]), (1200, [1, 2])]
    got, want = answers(C.nearest(frame(spark, rows + bad))), brute(rows)
    assert set(got) == set(want)
    assert [i for i, _ in got[0]] == [3, 6, 9, 12, 15] and [i for i, _ in got[150]] == [0, 3, 6, 9, 12]
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want]) / 5 >= 0.9


def test_few_rows_repeats_and_empty(spark):
    rows = [(0, f32([1, 0])), (1, f32([1, 1])), (2, f32([0, 1])), (2, f32([0, 1]))]
    got = answers(C.nearest(frame(spark, rows)))
    assert [i for i, _ in got[0]] == [1, 2]
    assert C.nearest(frame(spark, rows[:0])).collect() == [] and C.nearest(frame(spark, rows[1:])).collect() == []
