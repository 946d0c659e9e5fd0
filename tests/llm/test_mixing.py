from collections import Counter

import duckdb
import pytest

from meterflow.llm import mixing, queries
from tests.llm.conftest import prose


def plain_targets(sizes):
    """Shares by weight, capped at twice the size, the excess shared again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, open_, target = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        share = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if share * weight[s] > 2 * sizes[s]}
        if not full:
            return target | {s: share * weight[s] for s in open_}
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def rows_for(counts, words=30):
    rows, doc_id = [], 0
    for source, n in counts.items():
        for _ in range(n):
            doc_id += 1
            rows.append((doc_id, prose(doc_id, doc_id * 7 % words), "en", source))
    return rows


@pytest.mark.parametrize("counts", [{"a": 50, "b": 5, "c": 20, None: 8, "é": 3, "z": 90}, {"only": 9}, {"a": 1, "b": 200}])
def test_targets_and_taken_words(table, counts):
    plan = mixing.mix_plan(table(rows_for(counts))).collect()
    sizes = Counter()
    for r in plan:
        sizes[r.source] += r.size
    want = plain_targets(sizes)
    taken = Counter()
    for r in plan:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.taken_1 + r.taken_2
        assert r.due_1 is None or 0 <= r.due_1 <= 1
        taken[r.source] += r.taken
    longest = Counter()
    for r in plan:
        assert r.taken in (0, r.size, 2 * r.size)
        longest[r.source] = max(longest[r.source], r.size)
    assert all(abs(taken[s] - want[s]) <= 0.5 + longest[s] / 2 for s in sizes)


def test_query_same_as_sql(spark, table, odd_rows, tmp_path):
    docs = table(odd_rows + [(i + 1000, *row[1:]) for i, row in enumerate(rows_for({"a": 9, "b": 30, None: 4}))])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    found = queries.op3_mixing_sources(spark, str(tmp_path))
    want = connection.execute(queries.SQL["op3_mixing_sources"])
    assert found.columns == [column[0] for column in want.description]
    assert Counter(map(tuple, found.collect())) == Counter(want.fetchall())


def test_many_sources_of_one_document_are_taken_whole_or_not(table):
    rows = [(i, prose(i, 20 + i), "en", f"s{i:02d}") for i in range(60)]
    texts = {row[0]: row[1] for row in rows}
    mixed = mixing.mixed_documents(table(rows)).collect()
    assert mixed and all(r.text == texts[r.doc_id] for r in mixed)


def test_schedule_moves_heavy_sources_forward(table):
    plan = mixing.mix_plan(table(rows_for({"a": 300, "b": 300, "c": 300}))).collect()

    def mean_due(source):
        parts = [(r.taken_1, r.due_1) for r in plan if r.source == source and r.taken_1]
        parts += [(r.taken_2, r.due_2) for r in plan if r.source == source and r.taken_2]
        return sum(w * d for w, d in parts) / sum(w for w, _ in parts)

    assert mean_due("a") < mean_due("b") < mean_due("c")


def test_mixture_holds_what_the_plan_takes(table, odd_rows):
    docs = table(odd_rows + rows_for({"a": 40, "b": 5}))
    texts = {(r.doc_id, r.source, r.text, r.n_chars) for r in docs.collect()}
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    rows = mixed.collect()
    assert {(r.doc_id, r.source, r.text, r.n_chars) for r in rows} <= texts
    assert len(rows) == sum((r.taken_1 > 0) + (r.taken_2 > 0) for r in mixing.mix_plan(docs).collect())


def test_reruns_agree(table, odd_rows):
    docs = table(odd_rows)
    runs = [sorted(map(str, mixing.mix_plan(d).collect())) for d in (docs, docs.repartition(7))]
    assert runs[0] == runs[1]


def test_no_words_and_no_rows(table):
    rows = mixing.mix_plan(table([(1, None, None, None), (2, " ", None, "s")])).collect()
    assert [(r.size, r.target, r.taken) for r in rows] == [(0, 0.0, 0)] * 2
    assert mixing.mixed_documents(table([(1, None, None, None)])).count() == 0
    assert mixing.mix_plan(table([]).limit(0)).count() == 0


def test_main_path_is_native(table):
    plan = mixing.mixed_documents(table(rows_for({"a": 3})))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_query_returns_due_times_in_order(spark):
    """Against bisection on the integral of the schedules, source by source."""
    import hashlib

    from meterflow.llm.queries import op3_mixing_sources
    from tests.conftest import SMALL

    rows = op3_mixing_sources(spark, SMALL).collect()
    found = {r.doc_id: r for r in rows}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "source").collect()
    assert len(rows) == len(docs) == len(found)
    sources = sorted({d.source for d in docs}, key=str.encode)
    for place, source in enumerate(sources):
        begin, end = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))[place % 3]
        ids = [d.doc_id for d in docs if d.source == source]
        before = 0
        for doc_id in sorted(ids, key=lambda i: hashlib.md5(str(i).encode()).hexdigest()):
            r = found[doc_id]
            for n, due in enumerate((r.due_1, r.due_2)):
                start = before + n * r.source_size
                assert (due is not None) == (2 * (round(r.target) - start) >= r.size > 0)
                if due is not None:
                    low, high = 0.0, 1.0
                    for _ in range(60):
                        t = (low + high) / 2
                        done = (begin * t + (end - begin) * t * t / 2) / ((begin + end) / 2)
                        low, high = (t, high) if done < start / r.target else (low, t)
                    assert due == pytest.approx(low, abs=1e-6)
            before += r.size
    order = [(r.due_1 is None, r.due_1 or 0.0, r.doc_id) for r in rows]
    assert order == sorted(order)
