import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from meterflow.llm import simhash_dedup as sd
from meterflow.llm.components import components
from meterflow.llm.gray_index import GrayIndex, gray_rank
from tests.llm.conftest import prose


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(codes, radius):
    root = list(range(len(codes)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(codes))]


@pytest.mark.parametrize("text", ["", " \n", "a", "A b", "a b c", "a b c d", "É À b\x0bc\x1cd e", prose(3, 900)])
def test_fingerprint(text):
    assert sd.fingerprint(text) == plain_fingerprint(text)


def test_gray_rank_inverts_the_gray_code():
    numbers = np.arange(5000, dtype=np.uint64)
    assert (gray_rank(numbers ^ (numbers >> np.uint64(1))) == numbers).all()


@pytest.mark.parametrize("shape", ["random", "cluster", "chain"])
def test_index_finds_all_components(shape):
    rng = random.Random(shape)
    center = rng.getrandbits(64)
    if shape == "random":
        codes = {rng.getrandbits(12) << 20 for _ in range(600)}
    elif shape == "cluster":
        codes = {center ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 5))) & (2**64 - 1) for _ in range(700)}
    else:
        codes, code = set(), center
        for _ in range(200):
            code ^= 7 << rng.randrange(61)
            codes.add(code)
    codes = np.array(sorted(codes), np.uint64)
    group = (codes % np.uint64(3)).astype(int)
    order = np.lexsort((gray_rank(codes), group))
    codes, group = codes[order], group[order]
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    found = GrayIndex(codes, starts).components(3)
    for g in set(group):
        at = np.flatnonzero(group == g)
        want = plain_components([int(c) for c in codes[at]], 3)
        assert [int(x) for x in found[at]] == [int(at[w]) for w in want]


def test_links_connect_what_is_near(spark, table, monkeypatch):
    """Also with groups so small that they are split at every depth."""
    monkeypatch.setattr(sd, "GROUP_LIMIT", 4)
    rng = random.Random(5)
    codes = {rng.getrandbits(64) for _ in range(50)}
    for code in list(codes)[:25]:
        for _ in range(6):
            codes.add(code ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))))
    codes = sorted(codes)
    df = spark.createDataFrame([(c - (1 << 64) if c >> 63 else c,) for c in codes], "code bigint")
    found = {r.node % 2**64: r.root % 2**64 for r in components(sd.near_links(df)).collect()}
    want = plain_components(codes, 3)
    members, groups = Counter(), {}
    for code, w in zip(codes, want):
        groups.setdefault(w, set()).add(code)
        members[found.get(code, code)] += 1
    assert sorted(members.values()) == sorted(len(g) for g in groups.values())
    for group in groups.values():
        assert len({found.get(code, code) for code in group}) == 1


def test_components_of_stars_chains_and_loops(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 150)] + [(7, 7), (None, 3), (30, 0)]
    df = spark.createDataFrame(links + links, "a bigint, b bigint")
    found = {r.node: r.root for r in components(df).collect()}
    assert found == {i: 0 for i in range(1, 31)} | {i: 100 for i in range(101, 150)}
    assert components(df.limit(0)).count() == 0


def test_odd_rows(table, odd_rows):
    rows = sd.near_duplicates(table(odd_rows)).collect()
    assert Counter(r.doc_id for r in rows) == Counter(row[0] for row in odd_rows)
    codes = [plain_fingerprint(row[1]) for row in odd_rows]
    want = plain_components(codes, 3)
    least = {}
    for row, w in zip(odd_rows, want):
        if row[0] is not None:
            least[w] = min(least.get(w, row[0]), row[0])
    expected = Counter((row[0], f"{c:016x}", least.get(w)) for row, c, w in zip(odd_rows, codes, want))
    assert Counter(tuple(r) for r in rows) == expected


def test_one_of_each_group_stays(table, odd_rows):
    docs = table(odd_rows)
    kept = sd.one_of_each_group(docs)
    assert kept.columns == docs.columns
    groups = {r.fingerprint for r in sd.near_duplicates(docs).collect()}
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len({r.component_id for r in sd.near_duplicates(docs).collect()}) <= len(groups)
    assert 4 in ids and 5 not in ids and 6 in ids and 7 not in ids and ids.count(4) == 1


def test_empty_table(table):
    docs = table([]).limit(0)
    assert sd.near_duplicates(docs).count() == 0
    assert sd.one_of_each_group(docs).count() == 0
