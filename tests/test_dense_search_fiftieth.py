"""The dense search by every fiftieth vector, against brute force."""

import numpy as np

from quillspark.queries import QUERIES


def test_every_fiftieth_vector_asks(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    asked = {r.vec_id: np.array(r.embedding, dtype=float) for r in rows if r.vec_id % 50 == 0}
    points = [(r.vec_id, np.array(r.embedding, dtype=float)) for r in rows if r.label in (1, 2, 3, 4)]
    cosine = lambda a, b: round(float(a @ b) / (np.linalg.norm(a) * np.linalg.norm(b)), 12)
    got = {}
    for r in QUERIES["top01_dense_search_fiftieth"](spark, folder).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.id, r.score))
    assert set(got) == set(asked) and len(asked) >= 10
    for name, found in got.items():
        best = sorted((-cosine(asked[name], e), i) for i, e in points)[:20]
        assert [(k, i) for k, i, _ in sorted(found)] == [(k, i) for k, (_, i) in enumerate(best, 1)]
        assert all(abs(s + c) < 1e-5 for (_, _, s), (c, _) in zip(sorted(found), best, strict=True))
