import random
import zlib

import pytest

from meterflow.llm import language_id as li
from meterflow.llm import suffix_automaton as sa


def text_of(lang, seed, words=80):
    syllables = {"xx": ["ba", "ko", "ti"], "yy": ["sch", "ung", "er"], "zz": ["eau", "que", "oi"]}[lang]
    rng = random.Random(f"{lang}{seed}")
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(words)).capitalize() + "."


def plain_phrases(sample: list[int], text: list[int]) -> int:
    """Greedy parse of a whole text into longest substrings of the sample; an unknown symbol ends its phrase."""
    joined = "".join(map(chr, sample))
    total, current = 0, ""
    for symbol in "".join(map(chr, text)):
        if current + symbol in joined:
            current += symbol
        else:
            total += 1
            current = symbol if symbol in joined else ""
    return total + bool(current)


def test_parse_against_substring_search():
    rng = random.Random(2)
    samples = [[rng.randint(1, 4) for _ in range(300)], [rng.randint(1, 3) for _ in range(50)]]
    tables, roots, base = [], [], 0
    for sample in samples:
        tables.append(sa.parse_table(sample, 6, base))
        roots.append(base)
        base += len(tables[-1])
    import numpy as np

    texts = [[rng.randint(1, 5) for _ in range(n)] for n in (0, 1, 5, 511, 512, 513, 1500)]
    # Phrases that run over the ends of several pieces, and texts whose pieces never meet their first walk.
    texts += [samples[0][:200] * 9, [1] * 2000, ([1, 2] * 300 + [3]) * 4, samples[1] * 30]
    found = sa.phrases(np.concatenate(tables), np.array(roots, np.int32), [np.array(t, np.uint8) for t in texts])
    assert found.tolist() == [[plain_phrases(s, t) for s in samples] for t in texts]


@pytest.mark.parametrize("piece", [1, 2, 7, 64])
def test_pieces_do_not_matter(piece, monkeypatch):
    import numpy as np

    rng = random.Random(piece)
    sample = [rng.randint(1, 3) for _ in range(400)]
    table, roots = sa.parse_table(sample, 5, 0), np.zeros(1, np.int32)
    texts = [[rng.randint(1, 4) if rng.random() < 0.05 else sample[(i + k) % 400] for i in range(k * 13)] for k in range(40)]
    texts = [np.array(t, np.uint8) for t in texts]
    monkeypatch.setattr(sa, "PIECE", piece)
    monkeypatch.setattr(sa, "ABREAST", 5)
    monkeypatch.setattr(sa, "LOOK", 3)
    assert sa.phrases(table, roots, texts)[:, 0].tolist() == [plain_phrases(sample, t.tolist()) for t in texts]


def test_automaton_accepts_exactly_the_substrings():
    word = [1, 2, 1, 1, 2, 2, 1, 2, 1]
    after = sa.transitions(word)

    def accepts(w):
        state = 0
        for symbol in w:
            if symbol not in after[state]:
                return False
            state = after[state][symbol]
        return True

    substrings = {tuple(word[i:j]) for i in range(len(word)) for j in range(i, len(word) + 1)}
    rng = random.Random(0)
    for _ in range(2000):
        w = tuple(rng.randint(1, 2) for _ in range(rng.randint(0, 6)))
        assert accepts(w) == (w in substrings)


@pytest.fixture
def labelled(table, odd_rows):
    rows = [(i, text_of(lang, i), lang, "s") for i, lang in enumerate(["xx", "yy", "zz"] * 40, start=1000)]
    rows += [(5000 + i, text_of(lang, i + 500), None, "s") for i, lang in enumerate(["xx", "yy", "zz"])]
    odd = [(i, t, None, s) for i, t, _, s in odd_rows]
    return table(rows + odd), {r[0]: r[2] for r in rows}


def test_held_out_accuracy(labelled):
    docs, langs = labelled
    rows = {r.doc_id: r for r in li.predicted_languages(docs).collect() if r.doc_id is not None}
    held = [i for i in rows if rows[i].held_out]
    assert all((zlib.crc32(str(i).encode()) % 5 == 0) == rows[i].held_out for i in rows)
    known = [i for i in held if langs.get(i)]
    assert len(known) > 10 and all(rows[i].lang_pred == langs[i] for i in known)
    assert [rows[5000 + i].lang_pred for i in range(3)] == ["xx", "yy", "zz"]
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_odd_texts_are_undetermined(labelled):
    docs, _ = labelled
    rows = li.predicted_languages(docs).collect()
    assert len(rows) == docs.count()
    by_id = {r.doc_id: r for r in rows}
    for doc_id in (1, 2, 3):
        assert (by_id[doc_id].lang_pred, by_id[doc_id].score) == ("und", 0.0)
    assert by_id[8].lang_pred != "und" and by_id[100].lang_pred in {"xx", "yy", "zz"}
    assert sorted(r.lang_pred == "und" for r in rows if r.doc_id is None) == [False, True]


def test_stage_keeps_known_languages(labelled):
    docs, langs = labelled
    kept = li.in_known_language(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert set(langs) <= ids and not ids & {1, 2, 3}


def test_labels_are_no_input(labelled):
    docs, _ = labelled
    from pyspark.sql import functions as F

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    other = docs.withColumn("lang", F.when(held, "xx").otherwise(F.col("lang"))).withColumn("source", F.lit(None).cast("string"))
    a, b = ({r.doc_id: (r.lang_pred, r.score) for r in li.predicted_languages(d).collect()} for d in (docs, other))
    assert a == b


def test_nothing_to_learn_from(table):
    rows = li.predicted_languages(table([(1, "some text", None, None)])).collect()
    assert [(r.lang_pred, r.score) for r in rows] == [("und", 0.0)]
    assert li.predicted_languages(table([]).limit(0)).count() == 0


def test_texts_that_begin_alike(table):
    """Languages whose texts share their first 1,100 characters differ only further on; copies take no one's place."""
    shared = text_of("xx", 1, 400)[:1100]
    rows = [(i, shared + " " + text_of(lang, i, 150), lang, "s") for i, lang in enumerate(["yy", "zz"] * 100)]
    rows += [(1000 + i, shared, "yy", "s") for i in range(300)] + [(2000 + i, "12 34", "zz", "s") for i in range(300)]
    found = {r.doc_id: r for r in li.predicted_languages(table(rows)).collect()}
    held = [row for row in rows[:200] if found[row[0]].held_out]
    assert len(held) > 25 and all(found[i].lang_pred == lang for i, _, lang, _ in held)
