import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from meterflow.llm import doc_fingerprints as df
from tests.llm.conftest import prose


def plain_rows(docs):
    """Next documents in the order of ids, equal ids in any order."""
    out = []
    for i, (doc_id, text) in enumerate(docs):
        following = docs[(i + 1) % len(docs)][1]
        n = len(text) // 2
        changed = text[: len(text) - n] + following[:n]
        code, other, after = df.fingerprint(text), df.fingerprint(changed), df.fingerprint(following)
        out.append(
            (doc_id, len(text), sha256(changed.encode()).hexdigest(), f"{code:016x}", f"{other:016x}",
             1 - bin(code ^ other).count("1") / 64, 1 - bin(code ^ after).count("1") / 64)
        )
    return out


@pytest.mark.parametrize("n", [1, 2, 60])
def test_against_plain_order(table, n):
    docs = [(i * 7 % 101, prose(i, i % 23)) for i in range(n)]
    found = df.document_fingerprints(table(docs).repartition(3)).collect()
    assert sorted(tuple(r)[:7] for r in found) == sorted(plain_rows(sorted(docs)))


def test_odd_rows(table, odd_rows):
    rows = df.document_fingerprints(table(odd_rows)).collect()
    assert Counter(r.doc_id for r in rows) == Counter(row[0] for row in odd_rows)
    by_text = {}
    for r, text in ((r, row[1] or "") for row in odd_rows for r in rows if r.doc_id == row[0] and r.n_chars == len(row[1] or "")):
        by_text.setdefault(text, set()).add(r.fingerprint)
    assert all(len(prints) == 1 for prints in by_text.values())
    assert by_text[""] == {"0" * 16}
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[6].near_next == 1.0 and by_id[50].n_near >= 2 and by_id[6].n_near is None
    assert df.document_fingerprints(table([]).limit(0)).count() == 0


def test_repeated_rows_follow_each_other(table):
    rows = df.document_fingerprints(table([(1, "a b c")] * 5 + [(2, "d e f g")])).collect()
    assert sorted(r.near_next == 1.0 for r in rows) == [False, False, True, True, True, True]


def test_one_id_for_most_rows(table):
    docs = [(7, prose(i, 4)) for i in range(200)] + [(i, prose(i, 5)) for i in range(10)]
    found = df.document_fingerprints(table(docs).repartition(5)).collect()
    assert Counter(r.doc_id for r in found) == Counter(i for i, _ in docs)
    assert Counter(r.n_chars for r in found) == Counter(len(text) for _, text in docs)


def test_likeness_follows_the_text(table):
    docs = [(i, prose(i, 300)) for i in range(40)]
    rows = df.document_fingerprints(table(docs)).collect()
    assert np.mean([r.near_edited for r in rows]) > np.mean([r.near_next for r in rows]) + 0.1


def test_frequent_terms_weigh_more():
    text = prose(1, 50)
    repeated = text + " alpha beta" * 40
    assert df.likeness(df.fingerprint(repeated), df.fingerprint("alpha beta")) > df.likeness(
        df.fingerprint(text), df.fingerprint("alpha beta")
    )


@pytest.mark.parametrize("blocks", [4, 5, 6])
def test_every_near_pair_meets_in_one_table_only(blocks):
    """The table that counts a pair is the only one in which it agrees in the key and differs where it has to."""
    layout = df.Layout(blocks)
    rng = random.Random(blocks)
    assert sum(layout.block(n)[1] for n in range(blocks)) == 64

    def permuted(code, table):
        out = 0
        for number, place in layout.places(table).items():
            low, width = layout.block(number)
            out |= (code >> low & (1 << width) - 1) << place
        return out

    for _ in range(300):
        a = rng.getrandbits(64)
        b = a ^ sum(1 << bit for bit in rng.sample(range(64), rng.randint(0, 3)))
        tables = []
        for t in range(len(layout.tables)):
            apart = permuted(a, t) ^ permuted(b, t)
            if apart >> 64 - layout.key_bits(t) == 0 and all(apart >> int(s) & int(m) for s, m in layout.differing(t)):
                tables.append(t)
        assert len(tables) == 1


@pytest.mark.parametrize(("part", "blocks"), [(3, 4), (100_000, 4), (3, 5), (100_000, 6)])
def test_search_counts_all_neighbours_once(spark, monkeypatch, part, blocks):
    """Brute force over all pairs, also with keys dealt out in small parts and with the tables of larger corpora."""
    monkeypatch.setattr(df, "PART", part)
    monkeypatch.setattr(df, "BLOCKS", ((1 << 62, blocks),))
    monkeypatch.setattr(df, "PAIRS", 50)
    rng = random.Random(6)
    center = rng.getrandbits(64)
    codes = {center ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(300)}
    codes |= {rng.getrandbits(64) for _ in range(100)} | {0, 2**64 - 1}
    rows = [(c - (1 << 64) if c >> 63 else c, i % 4 + 1) for i, c in enumerate(sorted(codes))]
    frame = spark.createDataFrame(rows, "code bigint, n bigint")
    asked = frame.filter("code % 3 = 0")
    found = {r.code: r.n_near for r in df.near_counts(frame, asked).collect()}
    for code in (r.code for r in asked.collect()):
        want = sum(n for other, n in rows if ((code ^ other) % 2**64).bit_count() <= 3)
        assert found[code] == want
