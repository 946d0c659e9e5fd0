import random
import re
from collections import Counter
from functools import lru_cache
from hashlib import sha256
from zlib import crc32

import duckdb
import pytest

from meterflow.llm import coalescing_viterbi as viterbi
from meterflow.llm import conversations as cv
from meterflow.llm import queries
from meterflow.llm.common import prepare

SCHEMA = "conv_id bigint, turn bigint, role string, text string, kind int, fault string, first int, place bigint, c int, d string"
WORD = re.compile(r"[^\x20\x09-\x0D]")


def plain_repair(rows):
    """`(cost, letters, repaired rows)` from the last row backwards; rows are `(role, text, fault)`."""

    @lru_cache(None)
    def best(i, state, inserts):
        ways = []
        step = lambda cost, letter, out, rest: ways.append((cost + rest[0], letter + rest[1], out + rest[2]))
        if i == len(rows) and state in ("", "a"):
            ways.append((0, "", ()))
        if inserts < 3:
            to, role = ("a", "assistant") if state == "u" else ("u", "user")
            step(5, "I", ((role, ""),), best(i, to, inserts + 1))
        if i < len(rows):
            role, text, fault = rows[i]
            step(2, "D", (), best(i + 1, state, 0))
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                to = "a" if state == "u" else "u"
                if role[:1] == to:
                    step(extra, "K", ((role, text),), best(i + 1, to, 0))
                step(extra + 1, "R", (({"a": "assistant", "u": "user"}[to], text),), best(i + 1, to, 0))
                if role[:1] == "s" and state == "":
                    step(extra, "K", ((role, text),), best(i + 1, "s", 0))
        return min(ways, key=lambda way: way[:2]) if ways else (10**6, "", ())

    return best(0, "", 0)


def viterbi_repair(rows):
    letters, out, most = [], [], [0]

    def sink(letter, role, text):
        letters.append(letter)
        if role is not None:
            out.append((role, text))

    search = viterbi.Repair(sink)
    for role, text, fault in rows:
        search.row(role, text, fault in ("blank", "duplicate"), fault == "truncated")
        most[0] = max(most[0], max(node.depth for _, node in search.survivors.values()) - search.root.depth)
    search.finish()
    return (search.cost, "".join(letters), tuple(out)), most[0]


@pytest.mark.parametrize("seed", range(6))
def test_cheapest_repair(seed):
    rng = random.Random(seed)
    roles = [["user", "assistant"], ["user", "assistant", "system"], ["tool"], ["s", "u", "a", "", "x"], ["user"], ["system"]][seed]
    for _ in range(400):
        rows = [(rng.choice(roles), f"t{i}", rng.choice(["", "", "", "truncated", "blank", "duplicate"])) for i in range(rng.randint(0, 14))]
        assert viterbi_repair(rows)[0] == plain_repair(tuple(rows))


def test_open_edits_stay_few():
    rng = random.Random(1)
    rows = [(rng.choice(["user", "assistant"]), "t", rng.choice(["", "", "truncated", "blank"])) for _ in range(20_000)]
    _, most = viterbi_repair(rows)
    assert most < 200


@pytest.mark.parametrize("role", ["tool", "system", "user"])
def test_rows_that_settle_late(role):
    """Every row leaves the parity open, so ties are compared over thousands of open edits."""
    rows = [(role, "t", "")] * 101
    assert viterbi_repair(rows)[0] == plain_repair(tuple(rows))
    (cost, letters, out), _ = viterbi_repair([(role, "t", "")] * 30_000)
    assert len(letters) >= 30_000 and len(out) % 2 == (role == "system" and out[0][0] == "system") and cost > 0


def plain_digest(rows):
    """The contract, conversation by conversation."""
    groups = {}
    for conv_id, turn, role, text, *_ in rows:
        groups.setdefault(conv_id, [])
        shown = lambda x: " " if x is None else str(x)
        kind = crc32(f"{shown(conv_id)}:{shown(turn)}".encode()) % 20
        role, text = shown(role), shown(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        groups[conv_id] += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = Counter()
    for conv_id, kept in groups.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, marked = set(), []
        for _, role, text in kept:
            words = WORD.findall(text)
            fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else ""
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = [t for t, _, _ in kept if t is not None]
        cost, letters, repaired = plain_repair(tuple(marked))
        faults = Counter(fault for _, _, fault in marked)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        digest = sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
        out[(conv_id, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, letters, digest)] += 1
    return out


def odd_conversations():
    rng = random.Random(4)
    rows = []
    for conv in range(120):
        for turn in range(rng.randint(1, 12)):
            text = rng.choice(["Hello.", "Yes!", "no end", "", " \t\n", "été ?\x0b", "Fine. ", f"t{turn}.", "x\x1c"])
            rows.append((conv, turn * rng.choice([1, 1, 2]), rng.choice(["user", "assistant", "system", "tool"]), text))
    rows += [(None, t, "user", f"n{t}.") for t in range(9)] + [(500, None, "user", "Same."), (500, None, "user", "Same.")]
    rows += [(501, None, None, None), (502, 5, None, "Text."), (503, 5, "user", None), (504, -7, "", "Neg."), (504, 9, "user", "a" * 100_000 + ".")]
    rows += [(505, 3, "user", "Tie."), (505, 3, "assistant", "Tie."), (505, 3, "assistant", "Tie."), (505, None, "user", "First.")]
    rows += [(c, 0, "user", "Alone.") for c in range(1000, 1060)]
    return [(*row, 1, "f", 2, 3, 4, "d") for row in rows]


def test_query_against_contract_and_sql(spark, tmp_path):
    prepare(spark)
    rows = odd_conversations()
    spark.createDataFrame(rows, SCHEMA).repartition(7).write.parquet(f"{tmp_path}/conversations.parquet")
    found = queries.op12_conversation_repair(spark, str(tmp_path))
    ours = Counter(map(tuple, found.collect()))
    assert ours == plain_digest(rows)
    assert any(r.audit == "" for r in found.collect())
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    want = connection.execute(queries.SQL["op12_conversation_repair"])
    assert [column[0] for column in want.description] == found.columns
    assert Counter(want.fetchall()) == ours


def test_repaired_rows(spark):
    prepare(spark)
    rows = cv.damaged(spark.createDataFrame(odd_conversations(), SCHEMA))
    texts = {}
    for r in sorted(cv.repaired_conversations(rows).collect(), key=lambda r: r.place):
        lines = texts.setdefault(r.conv_id, [])
        assert len(lines) == r.place
        lines.append(f"{r.role}:{r.text}")
    for r in cv.conversation_repairs(rows).collect():
        assert sha256("\n".join(texts.get(r.conv_id, [])).encode()).hexdigest() == r.repaired_sha256


def test_empty_table(spark, tmp_path):
    prepare(spark)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert queries.op12_conversation_repair(spark, str(tmp_path)).collect() == []
