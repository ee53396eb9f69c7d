import hashlib
import random
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from compare import differences
from tidemark.llm import chat as C

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(turns, budget, history_tokens, history_turns, block_turns):
    """The windows of one conversation, turn by turn: (block, repeats, own turns)."""
    cost = lambda t: -(-len(t[2].encode()) // C.CHARS_PER_TOKEN) + C.TURN_TOKENS
    turns = sorted(((n, r or "", t or "") for n, r, t in turns), key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
    block = lambda t: -(1 << 62) if t[0] is None else t[0] // block_turns
    system = next((k for k, t in enumerate(turns) if t[1] == "system"), None)
    made = []
    for b in sorted({block(t) for t in turns}):
        here = [k for k, t in enumerate(turns) if block(t) == b]
        lead = [k for k, t in enumerate(turns) if t[0] is not None and block(t) == b - 1 and t[0] % block_turns >= block_turns - history_turns]
        s = cost(turns[system]) if system is not None and block(turns[system]) <= b else 0
        room = max(budget - s, budget // 2)
        cell = (room - history_tokens) // 2
        groups, at = {}, 0
        for k in here:
            big = cost(turns[k]) > cell
            groups.setdefault((at // cell, big), []).append(k)
            at += cost(turns[k])
        for own in groups.values():
            left = max(0, min(history_tokens, room - sum(cost(turns[k]) for k in own)))
            history, spent = [], 0
            for k in [k for k in lead + here if k < own[0]][::-1][:history_turns]:
                spent += cost(turns[k])
                if spent > left:
                    break
                history.insert(0, k)
            repeats = [k for k in history if k != system]
            if system is not None and system < own[0]:
                repeats.insert(0, system)
            made.append((b, [turns[k][1:] for k in repeats], [turns[k][1:] for k in own]))
    return made


def told(spark, rows, **limits):
    found = defaultdict(list)
    out = C.windows(spark.createDataFrame(rows, SCHEMA).repartition(5), **limits)
    back = out.select("*", C.read_back(F.col("text")).alias("turns"), C.under_mask(F.col("text"), F.col("loss")).alias("learn"))
    for r in back.collect():
        turns = [tuple(t) for t in r.turns]
        found[r.conv_id].append((r.block, r.window, turns[: r.n_repeated], turns[r.n_repeated :], r.learn, r.n_tokens))
    return {k: sorted(v, key=lambda w: w[:2]) for k, v in found.items()}


@pytest.mark.parametrize("budget,history_tokens,history_turns,block_turns", [(64, 16, 3, 8), (200, 50, 2, 1000), (48, 0, 0, 5), (120, 30, 6, 7)])
def test_against_turn_by_turn(spark, budget, history_tokens, history_turns, block_turns):
    rng = random.Random(budget)
    rows = []
    for c in range(40):
        for n in range(rng.randrange(1, 60)):
            role = "system" if n == 0 and c % 2 or n == 9 and c % 5 == 0 else ("user", "assistant")[n % 2]
            rows.append((c, n, role, rng.choice("aé<|\\>\n") * rng.choice([0, 1, 10, 40, 90, 400])))
    limits = dict(budget=budget, history_tokens=history_tokens, history_turns=history_turns, block_turns=block_turns)
    got = told(spark, rows, **limits)
    for c in range(40):
        want = plain([r[1:] for r in rows if r[0] == c], **limits)
        assert [(w[0], w[2], w[3]) for w in got[c]] == want
        assert [t for w in got[c] for t in w[4]] == [r[3] for r in rows if r[0] == c and r[2] == "assistant"]
        for w in got[c]:
            system = [r[3] for r in rows if r[0] == c and r[2] == "system"]
            within = w[5] <= budget or len(w[3]) == 1 or system and -(-len(system[0].encode()) // 4) + C.TURN_TOKENS > budget // 2
            assert within


def test_control_strings_read_back(spark):
    texts = ["<|end|>\n", "<|start|>user<|message|>", "\\", "\\\\<|", "<\\|", "<\\\\|", "a<", "|end|>\n", "<" * 5 + "|" * 5, "\x00\n\r", "\\### Assistant: </turn> ok", "𝄞<|é"]
    rows = [(1, k, "assistant<|\\" if k % 3 else "assistant", t) for k, t in enumerate(texts)]
    got = told(spark, rows, budget=32, history_tokens=8)
    assert [t for w in got[1] for t in w[3]] == [r[2:] for r in rows]
    assert [t for w in got[1] for t in w[4]] == [r[3] for r in rows if r[2] == "assistant"]


def test_edge_cases(spark):
    long = "word " * 200_000
    rows = [(1, None, "user", None), (1, None, None, "x"), (1, 0, "assistant", ""), (1, 0, "assistant", ""), (None, 3, "system", "s"), (None, 4, "assistant", "a"), (2, 0, "assistant", long), (3, -5, "user", "below"), (3, 300, "assistant", "far"), (4, 0, "system", "only")]
    got = told(spark, rows)
    assert [t for w in got[1] for t in w[3]] == [("", "x"), ("user", ""), ("assistant", ""), ("assistant", "")]
    assert [t for w in got[1] for t in w[4]] == ["", ""]
    assert [w[2:5] for w in got[None]] == [([], [("system", "s"), ("assistant", "a")], ["a"])]
    assert got[2][0][4] == [long] and got[2][0][5] > C.BUDGET
    assert [w[3] for w in got[3]] == [[("user", "below")], [("assistant", "far")]]
    assert [w[3] for w in got[4]] == [[("system", "only")]]
    assert C.windows(spark.createDataFrame([], SCHEMA)).count() == 0
    clash = spark.createDataFrame([(1, 0, "user", "a", "x", 7, 9, 2)], SCHEMA + ", `text.x` string, kind int, cost int, n long")
    assert C.windows(clash, tokens="n").first().n_tokens == 2 + C.TURN_TOKENS
    with pytest.raises(ValueError):
        C.windows(clash, budget=100, history_tokens=50)


def test_query_on_long_conversations(spark, tmp_path):
    """Conversations over several blocks, windows and system turns, against the SQL and a plain digest."""
    rng = random.Random(5)
    rows = []
    for c in range(12):
        for n in range(rng.choice([3, 250, 700])):
            role = "system" if n == (0 if c % 3 else 300) else ("user", "assistant")[n % 2]
            rows.append((c, n, role, None if rng.random() < 0.05 else "".join(rng.choice("ab é<|\\") for _ in range(rng.choice([5, 400, 6000])))))
    spark.createDataFrame(rows, SCHEMA).repartition(7).write.parquet(f"{tmp_path}/conversations.parquet")
    query = C.op11_chat_format(spark, str(tmp_path))
    got = query.toPandas()
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    assert not differences(query, con, C.ORACLE_SQL["op11_chat_format"])
    for r in got.itertuples():
        if r.conv_id >= 0:
            own = [x for x in rows if x[0] == r.conv_id]
            assert r.turns_sha256 == hashlib.sha256("".join(f"{x[2]}\n{x[3] or ''}\n" for x in own).encode()).hexdigest()
            assert r.loss_sha256 == hashlib.sha256("".join(x[3] or "" for x in own if x[2] == "assistant").encode()).hexdigest()


def test_native_plan(spark, sf):
    plan = C.op11_chat_format(spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
