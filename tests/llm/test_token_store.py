import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from meterflow.llm import token_store as ts
from meterflow.llm import word_tokens as wt
from meterflow.llm.word_tokens import WordTokens
from tests.llm.conftest import prose


@pytest.fixture(scope="module")
def tokens():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as definition:
        return WordTokens(definition.read())


def library_ids(tokens, text):
    return tokens.library.encode(text, add_special_tokens=False).ids


def test_ids_as_the_library(tokens):
    rng = random.Random(4)
    parts = [chr(c) for c in range(0x180)] + ["<|endoftext|>", "'s", "'LL", "</w>", "ς", "Σ", "é", "中", " ", "the", "The"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(2000)] + [prose(2, 3000), "ab" * 9000]
    for text, ids in zip(texts, tokens.encode(texts)):
        assert ids.tolist() == library_ids(tokens, text), repr(text)


def test_round_trip_of_odd_rows(table, odd_rows, tokens):
    docs = table(odd_rows + [(1000 - i, prose(i, 40)) for i in range(300)])
    store = ts.write_store(docs, tokens, 2)
    rows = sorted(ts.read_store(store, with_ids=True).collect(), key=lambda r: r.start)
    start = 0
    ids_of = {}
    for doc_id, text in ((r.doc_id, r.text) for r in docs.collect()):
        ids_of.setdefault(doc_id, []).append(library_ids(tokens, text or "") + [2])
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in docs.collect()), key=lambda i: (i is None, i))
    for r in rows:
        assert r.start == start and r.n_tokens == len(r.ids) and r.ids in ids_of[r.doc_id]
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        start += r.n_tokens
    assert sum(r.ids for r in store.manifest.collect()) == start


def test_slices_and_single_documents(table, tokens, monkeypatch):
    monkeypatch.setattr(ts, "SLICE_DOCS", 7)
    docs = table([(i, prose(i, i % 9)) for i in range(100)])
    store = ts.write_store(docs, tokens, 2)
    rows = sorted(ts.read_store(store).collect())
    assert [r.doc_id for r in rows] == list(range(100))
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows])[:-1].tolist()
    shard = min(store.manifest.collect(), key=lambda r: r.shard)
    layout = store.layout()
    slices = sum(-(-r.docs // 7) for r in store.manifest.collect())
    tasks = ts.read_store(store).select(F.spark_partition_id().alias("p")).distinct().count()
    assert slices >= 14 and tasks >= slices / 2
    for place in (0, shard.docs - 1):
        assert ts.read_document(shard.path, place, layout).tolist() == library_ids(tokens, prose(place, place % 9)) + [2]


def test_other_dictionary_is_refused(table, tokens):
    store = ts.write_store(table([(1, "a b c")]), tokens, 2)
    shard = store.manifest.first()
    with pytest.raises(ValueError, match="not a shard"):
        ts.read_document(shard.path, 0, ts.Layout(store.layout().id_bytes, b"another"))


def test_dictionary_of_many_and_of_few_samples():
    rng = random.Random(1)
    samples = [np.array(rng.choices(range(200), k=200), "<u2").tobytes() for _ in range(500)]
    assert 0 < len(ts.train_dictionary(samples)) <= ts.DICTIONARY_BYTES
    assert ts.train_dictionary([]) == b""


def test_empty_table(table, tokens):
    store = ts.write_store(table([]).limit(0), tokens, 2)
    assert store.manifest.count() == 0 and ts.read_store(store).count() == 0


def test_names_of_added_tokens_as_the_plain_library(tokens):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    texts = ["hello <|endoftext|> world", "<|startoftext|>a", "A<|EndOfText|>b", "x <|endoftext|", "é <|endoftext|> 中"]
    texts += [content.join("ab") for content in (t.content for t in plain.get_added_tokens_decoder().values())]
    for text, ids in zip(texts, tokens.encode(texts)):
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids, text
    assert 49407 in next(iter(tokens.encode(texts[:1])))


def test_a_repeated_word_is_split_once(tokens):
    fresh, seen = WordTokens(tokens.definition), []
    split = fresh._split
    fresh.__dict__["_split"] = lambda text: seen.append(text) or split(text)
    texts = [f"Don't panic, {prose(i % 10, 30)}\n\n{prose(i % 7, 30)}!" for i in range(300)]
    for text, ids in zip(texts * 2, fresh.encode(texts * 2), strict=True):
        assert ids.tolist() == library_ids(tokens, text)
    assert sum(map(len, seen)) <= sum(map(len, {word for text in texts for word in text.lower().split()}))


@pytest.mark.parametrize("together", [1, 50, 10**6])
def test_columns_in_parts_as_the_library(tokens, monkeypatch, together):
    monkeypatch.setattr(wt, "TOGETHER", together)
    monkeypatch.setattr(wt, "REMEMBERED", 20)
    few = WordTokens(tokens.definition)
    odd = ["", None, " ", "\t\n\r", "x\x1cy", "a\x0bb", "a\xa0b", "a b", "é", "<|EndOfText|>a", "a''s'll'LL", "ŉ ſ ŀ ß", "x" * 70]
    texts = [None, *odd, prose(1, 60), *odd[::-1], "ab1-é'" * 40, *[prose(i, 9).title() for i in range(30)]]
    column = pa.array(["left out", *texts, "left out"])
    for some in (column[1:-1], pa.array([None], pa.string()), pa.array([], pa.string()), pa.array(odd[8:10])):
        want = [library_ids(tokens, text or "") for text in some.to_pylist()]
        assert [ids.tolist() for ids in few.encode_column(some)] == want
        assert [ids.tolist() for ids in few.encode(text or "" for text in some.to_pylist())] == want
