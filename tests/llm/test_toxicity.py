import random
from zlib import crc32

import numpy as np
import pytest
import zstandard

from meterflow.llm import compression_distance as cd
from meterflow.llm import queries, toxicity
from tests.llm.conftest import prose

WORDS = [b"snarlbeast", b"grubface", b"wretchling", b"foulmouth"]


def written(seed, words, toxic=False):
    rng = random.Random(seed)
    found = prose(seed, words).split()
    for at in range(0, len(found), 15) if toxic else ():
        found.insert(at, rng.choice(WORDS).decode())
    return " ".join(found)


@pytest.fixture(scope="module")
def contents():
    ordinary = [w for seed in range(300) for w in cd.windows(written(seed, 60))]
    return cd.train(ordinary, {word: 30 for word in WORDS})


def test_windows_hold_every_word():
    for text in (None, "", " \n", "a", "A b c d e f g", "é" * 2000, prose(3, 500)):
        joined = b" ".join(cd.windows(text)).split()
        if text and "é" in text:
            assert b"".join(joined) == text.encode() and max(map(len, cd.windows(text))) <= cd.WINDOW_BYTES
        else:
            assert joined == (text or "").lower().encode().split()


def test_gains_are_differences_of_frame_lengths(contents):
    """Against one call per window and a size that only the frames themselves give."""
    cut = cd.windows(written(7, 400, toxic=True)) + [b"", b" "]
    gains = cd.Gains(contents)
    plain = [len(gains.ordinary.compress(w)) - len(gains.toxic.compress(w)) for w in cut]
    assert gains.of(cut).tolist() == np.clip(plain, cd.LEAST_GAIN, cd.MOST_GAIN).tolist()
    dictionary = zstandard.ZstdCompressionDict(contents[1], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    reader = zstandard.ZstdDecompressor(dict_data=dictionary, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
    assert all(reader.decompress(gains.toxic.compress(w), max_output_size=1000) == w for w in cut if w)


def test_toxic_words_gain(contents):
    gains = cd.Gains(contents)
    clean = gains.of(cd.windows(written(1000, 600)))
    found = gains.of([b" ab " + word + b" cd " for word in WORDS])
    assert (found >= 3).all() and np.mean(clean >= 3) < 0.02


def test_heaviest_run():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 30):
        weights = rng.normal(-0.3, 1, n)
        sums = [weights[i:j].sum() for i in range(n) for j in range(i + 1, n + 1)]
        assert cd.heaviest_run(weights) == pytest.approx(max([0.0, *sums]))


def labelled(spark, table, n=400, words=80):
    rows = [(i, written(i, words, toxic=i % 4 == 0), "en", "a") for i in range(n)]
    docs = table(rows)
    labels = spark.createDataFrame([(i, int(i % 4 == 0), 1) for i in range(n)], "doc_id bigint, toxic int, quality int")
    return docs, labels


def test_held_out_documents(spark, table):
    docs, labels = labelled(spark, table)
    rows = toxicity.toxicity_scores(docs, labels).collect()
    assert len(rows) == 400
    for r in rows:
        assert r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == (r.doc_id % 4 == 0) for r in held]) > 0.97


def test_learns_nothing_from_held_out_labels(spark, table):
    docs, labels = labelled(spark, table, 120)
    turned = labels.collect()
    turned = [(r.doc_id, 1 - r.toxic if crc32(str(r.doc_id).encode()) % 5 == 0 else r.toxic, 0) for r in turned]
    other = spark.createDataFrame(turned, labels.schema)
    runs = [sorted(map(tuple, toxicity.toxicity_scores(docs, mark).collect())) for mark in (labels, other)]
    assert runs[0] == runs[1]


def test_copies_teach_no_words(spark, table):
    """Forty copies of one toxic text do not make its ordinary words toxic."""
    same = written(5000, 60, toxic=True)
    rows = [(i, same if i < 40 else written(i, 60, toxic=i % 4 == 0), "en", "a") for i in range(300)]
    labels = spark.createDataFrame([(i, int(i < 40 or i % 4 == 0), 1) for i in range(300)], "doc_id bigint, toxic int, quality int")
    sample = toxicity._sampled(table(rows), labels, toxicity.Sample())
    found = toxicity._toxic_words(toxicity._training_windows(sample, 200), toxicity.Sample())
    assert set(found) == set(WORDS)


def test_odd_rows(spark, table, odd_rows):
    docs, labels = labelled(spark, table, 200)
    odd = table(odd_rows)
    marks = labels.unionByName(spark.createDataFrame([(None, 1, 1), (7, None, 1), (8, 1, 1), (8, 0, 1)], labels.schema))
    both = docs.filter("doc_id > 200 or doc_id < 0").unionByName(odd).unionByName(docs.filter("doc_id > 110"))
    rows = toxicity.toxicity_scores(both, marks).collect()
    assert len(rows) == both.count()
    texts = {r.doc_id: r.text for r in odd.collect()}
    empty = {r.score for r in rows if r.doc_id in (1, 2, 3) and r.doc_id in texts}
    assert len(empty) == 1 and empty.pop() < 0.5
    assert len({r.score for r in rows if r.doc_id in (6, 7)}) == 1


@pytest.mark.parametrize("marks", [[], [(1, 1, 1)], [(1, 0, 1), (2, 0, 1)], [(None, None, None)]])
def test_too_few_labels(spark, table, odd_rows, marks):
    labels = spark.createDataFrame(marks, "doc_id bigint, toxic int, quality int")
    rows = toxicity.toxicity_scores(table(odd_rows), labels).collect()
    assert [r.score for r in rows] == [0.0] * len(odd_rows)
    assert toxicity.toxicity_scores(table(odd_rows).limit(0), labels).count() == 0


def test_query_on_given_tables(spark):
    from tests.conftest import SMALL

    rows = {r.doc_id: r for r in queries.op13_toxicity(spark, SMALL).collect()}
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").collect()
    assert np.mean([rows[r.doc_id].predicted == r.toxic for r in labels]) > 0.8
