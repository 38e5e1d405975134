import zlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from quillspark.llm.toxicity import INDUCED, LEXICONS, PATTERNS, VOTERS, LabelModel, Reader, drop_toxic, fit_classifier, score_of, score_toxicity


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    found = score_toxicity(docs, labels)
    assert found.count() == docs.count()
    rows = found.join(labels, "doc_id").toPandas()
    assert all(rows.held_out == [zlib.crc32(str(d).encode()) % 3 == 1 for d in rows.doc_id])
    assert ((rows.score >= 0.7) == (rows.predicted == 1)).all() and rows.score.between(0, 1).all()
    held = rows[rows.held_out]
    rank, good = held.score.rank(), held.toxic == 1
    area = (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert area > 0.93
    assert (held[held.toxic == 0].predicted == 1).mean() < 0.05


def test_label_model_finds_accuracies_and_dependence():
    draw = np.random.default_rng(1)
    label = draw.random(20_000) < 0.2
    fire = lambda hit, miss: np.where(label, draw.random(20_000) < hit, draw.random(20_000) < miss)
    votes = np.stack([fire(0.9, 0.05), fire(0.7, 0.02), fire(0.5, 0.3), fire(0.8, 0.01)], axis=1).astype(int)
    votes = np.concatenate([votes, votes[:, 2:3]], axis=1)[:, [0, 1, 2, 4, 3]]  # the fourth copies the third
    given = np.where(draw.random(20_000) < 0.1, label, -1).astype(int)
    model = LabelModel().fit(votes, given, np.ones(20_000))
    assert abs(model.prior - 0.2) < 0.02
    assert model.parent[3] == 2 or model.parent[2] == 3
    assert abs(model.chance[0, 1].mean() - 0.9) < 0.06
    assert ((model.posterior(votes, np.full(20_000, -1)) > 0.5) == label).mean() > 0.97


def test_defined_cases(spark):
    rows = [(1, "you idiot moron scum trash pathetic loser", "x"), (1, "you idiot moron scum trash pathetic loser", "x"), (2, None, "x"), (3, "", "x"), (None, "fine", "x"), (4, "a " * 100_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _bad string")
    labels = spark.createDataFrame([(1, 1), (1, None), (2, 0), (3, 7), (None, 1), (99, 0)], "doc_id long, toxic int")
    found = [tuple(r) for r in score_toxicity(docs, labels).collect()]
    assert len(found) == 6 and all(0 <= r[2] <= 1 for r in found)
    assert score_toxicity(docs.limit(0), labels).count() == 0
    none = labels.where(F.lit(False))
    scores = {r.doc_id: r.score for r in score_toxicity(docs, none).collect()}
    assert scores[1] > 0.7 > scores[4]
    kept = drop_toxic(docs, none)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {2, 3, 4, None}


def plain_posterior(model, row, label):
    """Product of the model's chances for both labels, term by term."""
    mass = []
    for y in (0, 1):
        p = model.prior if y else 1 - model.prior
        for j, fires in enumerate(row):
            parent = model.parent[j]
            chance = model.chance[j][y][row[parent] if parent >= 0 else 0]
            p *= chance if fires else 1 - chance
        if label >= 0:
            p *= model.given[y] if label == 1 else 1 - model.given[y]
        mass.append(p)
    return mass[1] / sum(mass)


def test_posterior_against_plain_products():
    draw = np.random.default_rng(4)
    votes, given, count = draw.integers(0, 2, (300, 6)), draw.integers(-1, 2, 300), draw.integers(1, 50, 300).astype(float)
    model = LabelModel().fit(votes, given, count)
    want = [plain_posterior(model, row, label) for row, label in zip(votes.tolist(), given.tolist(), strict=True)]
    assert np.allclose(model.posterior(votes, given), want, atol=1e-9)
    # Counted patterns are the same as their rows one by one.
    rows = np.repeat(np.arange(300), count.astype(int))
    single = LabelModel().fit(votes[rows], given[rows], np.ones(len(rows)))
    assert np.allclose(single.posterior(votes, given), model.posterior(votes, given), atol=1e-6) and single.parent == model.parent


def test_classifier_against_plain_gradient_steps():
    draw = np.random.default_rng(5)
    rows = [(sorted(draw.choice(12, draw.integers(0, 6), replace=False).tolist()), float(draw.random())) for _ in range(200)]
    table = np.zeros((200, 13))
    for k, (columns, _) in enumerate(rows):
        table[k, columns] = 1 / np.sqrt(max(len(columns), 1))
    table[:, 12] = 1
    target, weights = np.array([y for _, y in rows]), np.zeros(13)
    for _ in range(20_000):
        slope = table.T @ (1 / (1 + np.exp(-table @ weights)) - target) / 200
        slope[:12] += 3e-4 * weights[:12]
        weights -= 2.0 * slope
    found = fit_classifier(rows, 12)
    assert np.allclose(1 / (1 + np.exp(-table @ found)), 1 / (1 + np.exp(-table @ weights)), atol=0.02)
    assert all(abs(score_of(columns, found) - 1 / (1 + np.exp(-table[k] @ found))) < 1e-9 for k, (columns, _) in enumerate(rows))


def test_several_texts_of_one_id_teach_once(spark):
    docs = spark.createDataFrame([(2, f"text number {k} is clean") for k in range(40)] + [(3, "you scum trash idiot")], "doc_id long, text string")
    labels = spark.createDataFrame([(2, 0), (3, 1)], "doc_id long, toxic int")
    assert score_toxicity(docs, labels, fit_rows=2).count() == 41


def test_stage_on_held_out_labels(spark):
    """Of the labels that nothing was learned from, the stage drops what is toxic and keeps what is clean."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    kept = {r.doc_id for r in drop_toxic(docs, labels).select("doc_id").collect()}
    rows = [r for r in labels.join(docs.select("doc_id"), "doc_id", "left_semi").collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    toxic, clean = [r.doc_id not in kept for r in rows if r.toxic == 1], [r.doc_id in kept for r in rows if r.toxic == 0]
    assert len(toxic) > 20 and np.mean(toxic) >= 0.8 and np.mean(clean) >= 0.98


def test_terms_of_one_family_belong_to_one_voter_that_counts_shares():
    reader = Reader(["trash", "tras*", "scum", "tra*", "scu*"])
    assert reader.voter == [0, 0, 1, 0, 1]
    first, size = len(LEXICONS) + len(PATTERNS), len(VOTERS)
    assert first + INDUCED == size
    assert reader.read("a trash can")[0] >> first & 3 == 1 and reader.read("trash and scum")[0] >> first & 3 == 3
    # One hit in a long text is chance; as many as one in two hundred are not.
    assert reader.read("word " * 900 + "trash")[0] >> first == 0
    assert reader.read("word " * 900 + "trash " * 5)[0] >> first == 1
    votes, features = reader.read("trash " * 3 + "x" * 10)
    assert max(features) < reader.size and features == sorted(set(features)) and votes < 1 << size
    assert reader.read(None) == reader.read("") == (0, [])


def informative(draw, rows):
    """Labels, votes of eight voters of which the last two say nothing, and labels given for a tenth."""
    label = draw.random(rows) < 0.15
    rates = [(0.6, 0.02), (0.5, 0.01), (0.7, 0.1), (0.4, 0.03), (0.5, 0.05), (0.6, 0.08), (0.3, 0.3), (0.0, 0.0)]
    votes = np.stack([np.where(label, draw.random(rows) < hit, draw.random(rows) < miss) for hit, miss in rates], axis=1).astype(int)
    return label, votes, np.where(draw.random(rows) < 0.1, label, -1).astype(int)


def test_silent_and_even_voters_are_left_out_and_none_decides_alone():
    label, votes, given = informative(np.random.default_rng(8), 20_000)
    model = LabelModel().fit(votes, given, np.ones(20_000))
    assert model.used == [0, 1, 2, 3, 4, 5] and (model.chance[6:] == 0.5).all()
    assert all(model.parent[k] in (-1, *model.used) for k in range(8))
    assert model.chance[:, 1].max() < 0.9 and abs(model.chance[0, 1].mean() - 0.6) < 0.08
    blind = model.posterior(votes, np.full(20_000, -1))
    # Ablation: the model ranks better than the number of votes and than any single voter.
    area = lambda s: (lambda r: (r[label].sum() - label.sum() * (label.sum() + 1) / 2) / (label.sum() * (~label).sum()))(pd.Series(s).rank().to_numpy())
    assert area(blind) > area(votes.sum(axis=1)) and all(area(blind) > area(votes[:, k]) + 0.1 for k in range(8))
    rows = votes[:50].tolist()
    want = [plain_posterior(model, row, y) for row, y in zip(rows, given[:50].tolist(), strict=True)]
    assert np.allclose(model.posterior(votes[:50], given[:50]), want, atol=1e-9)


def test_without_labels_every_voter_that_fires_is_used():
    label, votes, _ = informative(np.random.default_rng(9), 5_000)
    model = LabelModel().fit(votes, np.full(5_000, -1), np.ones(5_000))
    assert model.used == list(range(7))
    assert ((model.posterior(votes, np.full(5_000, -1)) > 0.5) == label).mean() > 0.9
    silent = LabelModel().fit(np.zeros((3, 4), dtype=int), np.full(3, -1), np.ones(3))
    assert silent.used == [] and len(silent.posterior(np.zeros((3, 4), dtype=int), np.full(3, -1))) == 3
