from collections import Counter
from hashlib import sha256

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from meterflow.llm import queries, simhash_dedup
from tests.conftest import SMALL

DIGESTS = {
    "op1_simhash_near_dedup": {"doc_id", "fingerprint", "component_id"},
    "op2_language_id": {"doc_id", "held_out", "lang_pred", "score"},
    "op3_mixing_sources": {"doc_id", "size", "source_size", "target", "taken"},
    "op4_quality_classifier": {"doc_id", "held_out", "score", "predicted"},
    "op5_byte_bpe": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op6_warc": {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"},
    "op7_token_ids": {"doc_id", "start", "n_tokens", "ids_crc32"},
    "op8_license_scan": {"doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"},
    "op9_document_fingerprints": {
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    },
    "op10_repetition_rules": {
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
    },
    "op12_conversation_repair": {
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256",
    },
    "op13_toxicity": {"doc_id", "held_out", "score", "predicted"},
}
#: Tables other than documents, with their ids.
TABLES = {"op6_warc": ("pages", "page_id"), "op12_conversation_repair": ("conversations", "conv_id")}


@pytest.mark.parametrize("name", list(DIGESTS))
def test_query_covers_its_whole_table(spark, name):
    assert name in __spark_entry__.queries()
    found = queries.QUERIES[name](spark, SMALL)
    assert DIGESTS[name] <= set(found.columns)
    table, key = TABLES.get(name, ("documents", "doc_id"))
    ids = [r[0] for r in spark.read.parquet(f"{SMALL}/{table}.parquet").select(key).collect()]
    ids = set(ids) if table == "conversations" else ids
    assert Counter(r[0] for r in found.select(key).collect()) == Counter(ids)


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SMALL)
        if name != "encode":
            assert docs.columns == columns
            docs = corpus_pipeline.stored(docs, f"test-{name}")
            ids = {r.doc_id for r in docs.select("doc_id").collect()}
            assert ids <= {r.doc_id for r in before.select("doc_id").collect()}
            sizes.append(docs.count())
        if name == "near_dedup":
            prints = [r.fingerprint for r in simhash_dedup.near_duplicates(docs).collect()]
            assert all((int(a, 16) ^ int(b, 16)).bit_count() > 3 for i, a in enumerate(prints) for b in prints[:i])
        if name == "encode":
            texts = Counter(sha256(r.text.encode()).hexdigest() for r in before.collect())
            assert Counter(r.decoded_sha256 for r in docs.collect()) == texts
    assert [name for name, _ in corpus_pipeline.STAGES] == ["languages", "quality", "near_dedup", "mix", "encode"]
    assert sizes[0] >= sizes[1] >= sizes[2] >= sizes[3] > 0


def test_run_is_registered(spark):
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert rows and all(r.n_tokens == len(r.ids) for r in rows)


@pytest.mark.parametrize("name", [name for name in queries.SQL if name != "op3_mixing_sources"])
def test_query_same_as_its_sql(spark, name):
    """Names and values, on a whole table; `op3` has a test of its own, which rounds nothing away."""
    connection = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMALL}/{table}.parquet')")
    want = connection.execute(queries.SQL[name])
    names = sorted(column[0] for column in want.description)
    found = queries.QUERIES[name](spark, SMALL)
    assert sorted(found.columns) == names
    rows = [dict(zip([column[0] for column in want.description], row)) for row in want.fetchall()]
    assert Counter(tuple(r[n] for n in names) for r in found.collect()) == Counter(tuple(r[n] for n in names) for r in rows)
