import random
import zlib

import numpy as np
import pytest

from meterflow.llm import boosted_trees as bt
from meterflow.llm import document_statistics as ds
from meterflow.llm import quality_model as qm
from tests.llm.conftest import prose


def junk(seed):
    rng = random.Random(seed)
    word = prose(seed, 1)
    return rng.choice([f"{word} " * 60, " | ".join(prose(seed, 60).split()), prose(seed, 60).upper().replace(" ", "!! ")])


@pytest.fixture
def labelled(spark, table, odd_rows):
    rows = [(1000 + i, prose(i, 90) + "." if i % 3 else junk(i)) for i in range(240)]
    labels = [(1000 + i, int(i % 3 > 0), 0) for i in range(240)] + [(1001, None, 0), (9, 1, 0), (None, 1, 0)]
    return table(rows + odd_rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_held_out_quality(labelled):
    docs, labels = labelled
    rows = {r.doc_id: r for r in qm.quality_scores(docs, labels).collect()}
    held = [i for i in range(1000, 1240) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 30
    assert all(rows[i].held_out for i in held) and not rows[None].held_out
    right = sum(rows[i].predicted == int((i - 1000) % 3 > 0) for i in held)
    assert right / len(held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows.values())


def test_rows_and_columns_stay(labelled):
    docs, labels = labelled
    assert qm.quality_scores(docs, labels).count() == docs.count()
    kept = qm.good_documents(docs, labels)
    assert kept.columns == docs.columns
    good = {1000 + i for i in range(240) if i % 3}
    ids = [r.doc_id for r in kept.collect()]
    assert len(good & set(ids)) > 0.97 * len(good)
    assert len([i for i in ids if i is not None and 1000 <= i < 1240 and i not in good]) < 5


def test_no_labels_reject_nothing(labelled):
    docs, labels = labelled
    assert {r.score for r in qm.quality_scores(docs, labels.limit(0)).collect()} == {1.0}
    assert qm.good_documents(docs, labels.limit(0)).count() == docs.count()
    assert qm.quality_scores(docs.limit(0), labels).count() == 0


def test_flat_trees_walk_like_nested_conditions():
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(500, 4)).astype(np.float32)
    labels = ((rows[:, 0] > 0.3) ^ (rows[:, 2] > 0)).astype(float)
    trees = bt.train(rows, labels, bt.Boosting(trees=30, depth=3))
    assert ((trees.probabilities(rows) > 0.5) == labels).mean() > 0.97

    def plain(row):
        total = trees.base
        for feature, threshold, leaf in zip(trees.feature, trees.threshold, trees.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
            total += leaf[node - len(feature)]
        return total

    assert np.allclose(trees.margins(rows[:50]), [plain(row) for row in rows[:50]])


def test_constant_columns_and_one_class():
    rows = np.ones((50, 2), np.float32)
    assert bt.train(rows, np.ones(50)).probabilities(rows).min() > 0.99


@pytest.mark.parametrize("text", ["", " \n ", "x", "!!!", "a\x1cb", "😀 😀", "wort " * 5000])
def test_statistics_are_finite(text):
    values = ds.statistics(text)
    assert len(values) == len(ds.NAMES) and np.isfinite(values).all()


def test_statistics_by_hand():
    s = dict(zip(ds.NAMES, ds.statistics("AB ab ab | x1!\nAB ab ab | x1!\n")))
    assert s["all_upper"] == pytest.approx(0.2) and s["adjacent"] == pytest.approx(0.2)
    assert s["repeated_lines"] == pytest.approx(0.5) and s["barred"] == pytest.approx(0.2)
    assert s["distinct"] == pytest.approx(0.4) and s["upper"] == pytest.approx(4 / 30)


def test_splits_are_the_best_of_all():
    """The first tree's root against every feature and threshold, the sums taken row by row."""
    from meterflow.llm.boosted_trees import Boosting, edges_of, train

    how = Boosting(trees=1, depth=1, bins=16, least=1.0)
    for seed in range(25):
        rng = np.random.default_rng(seed)
        x = np.round(rng.normal(size=(120, 4)), 1).astype(np.float32)
        y = (x[:, seed % 4] + rng.normal(scale=0.7, size=120) > 0.3).astype(float)
        trees = train(x, y, how)
        p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        slope, curve = y - p, np.full(120, p * (1 - p))

        def gain(left):
            if curve[left].sum() < how.least or curve[~left].sum() < how.least:
                return 0.0
            part = lambda rows: slope[rows].sum() ** 2 / (curve[rows].sum() + how.shrink)
            return part(left) + part(~left) - part(np.ones(120, bool))

        best = max(gain(x[:, f] <= t) for f in range(4) for t in edges_of(x[:, f], how.bins))
        chosen = x[:, trees.feature[0, 0]] <= trees.threshold[0, 0]
        assert gain(chosen) == pytest.approx(best, rel=1e-6)
        for leaf, rows in ((0, chosen), (1, ~chosen)):
            want = how.rate * slope[rows].sum() / (curve[rows].sum() + how.shrink)
            assert trees.leaf[0, leaf] == pytest.approx(want)
