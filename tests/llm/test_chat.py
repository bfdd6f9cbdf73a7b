from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import chat

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def conversations(spark):
    return spark.read.parquet(f"{SF}/conversations.parquet")


def plain_viterbi(chain, symbols):
    score, back = chain.start + chain.show[:, symbols[0]], []
    for s in symbols[1:]:
        through = score[:, None] + chain.move
        back.append(through.argmax(axis=0))
        score = through.max(axis=0) + chain.show[:, s]
    states = [int(score.argmax())]
    for came in reversed(back):
        states.append(int(came[states[-1]]))
    return states[::-1]


def segments(chain, lines):
    """Role, begins, number of lines of each turn, by one pass over all lines."""
    states = plain_viterbi(chain, [chat.symbol(x) for x in lines])
    out = []
    for i, s in enumerate(states):
        role, begins = chat.STATES[s]
        if begins or not out:
            out.append([role, i, 0])
        out[-1][2] += 1
    return [tuple(x) for x in out]


def merged(rows):
    out = []
    for r in sorted(rows, key=lambda r: r["order"]):
        if r["begins"] or not out:
            out.append([r["role"], r["order"], 0])
        out[-1][2] += r["n_lines"]
    return [tuple(x) for x in out]


def test_markers():
    assert chat.marker("User: hello") == ("user", "hello")
    assert chat.marker("### Answer: yes") == ("assistant", "yes")
    assert chat.marker("**Human:** x")[0] == "user" and chat.marker("[System]: x") == ("system", "x")
    assert chat.marker("Usually: no") == ("none", "Usually: no") and chat.marker(None) == ("none", "")


@pytest.mark.parametrize("bits", [(8, 6), (2, 1)])
def test_blocks_give_the_result_of_one_pass(spark, conversations, monkeypatch, bits):
    monkeypatch.setattr(chat, "BLOCK_BITS", bits[0])
    monkeypatch.setattr(chat, "FAN_BITS", bits[1])
    chain = chat.fit(chat.transcript_lines(conversations))
    draw = np.random.default_rng(2)
    starts = ["User: ", "Assistant: ", "System: ", "", "", "", "A: ", "Q: "]
    texts = {7: [starts[draw.integers(8)] + "some words here" + "?" * int(draw.integers(2)) for _ in range(300)], 8: ["x"], 9: ["", None, "User: a"]}
    rows = [(c, i, line) for c, lines in texts.items() for i, line in enumerate(lines)]
    lines = spark.createDataFrame(rows, "conv long, order long, line string").repartition(5)
    got = chat.turns(lines, chain).collect()
    for c, lines in texts.items():
        assert merged(r for r in got if r["conv"] == c) == segments(chain, lines)


def test_recovered_roles(conversations):
    found = chat.recover(conversations)
    truth = conversations.select("conv_id", "turn", F.col("role").alias("truth"))
    met = truth.join(found.where("begins AND line = 0"), ["conv_id", "turn"], "left")
    right = met.where("role = truth").count() / met.count()
    assert right >= 0.88  # one turn in seven has no marker
    marked = met.where("rendered LIKE '<|%|>%'").collect()
    assert all(r["rendered"].startswith(f"<|{r['role']}|>\n") for r in marked)


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "hi?"), (None, 1, "assistant", None), (1, 0, "user", "same"), (1, 0, "user", "same"), (1, None, "robot", "x\n\ny"),
        (2, 0, None, ""), (3, 0, "user", "word " * 50_000), (3, 1, "assistant", "a\n" * 3000),
    ]
    table = spark.createDataFrame([(*r, 1, "z") for r in rows], "conv_id long, turn long, role string, text string, conv int, line string")
    got = chat.recover(table).collect()
    assert {r["conv_id"] for r in got} == {None, 1, 2, 3}
    assert sum(r["n_lines"] for r in got) == sum(len((t or "").split("\n")) for _, _, _, t in rows)
    assert chat.recover(table.limit(0)).count() == 0


def test_turns_are_whole(spark, conversations, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK_BITS", 2)
    monkeypatch.setattr(chat, "FAN_BITS", 1)
    monkeypatch.setattr(chat, "PART", 200, raising=False)
    chain = chat.fit(chat.transcript_lines(conversations))
    texts = {5: ["User: why?", *[f"line {i} of a long turn" for i in range(70)], "Assistant: so", "and so", None, "User: x"], None: ["User: a"] * 9}
    rows = [(c, i, line) for c, lines in texts.items() for i, line in enumerate(lines)]
    lines = spark.createDataFrame(rows, "conv long, order long, line string")
    results, before = [], spark.conf.get("spark.sql.shuffle.partitions")
    for n in (1, 7):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got = chat.turns(lines.repartition(n), chain).orderBy("conv", "order").collect()
        results.append(got)
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]
    for c, written in texts.items():
        whole = {}
        for r in results[0]:
            if r["conv"] == c:
                assert r["begins"] == (r["part"] == 0) == r["rendered"].startswith("<|")
                if r["begins"]:
                    whole[r["order"]] = []
                whole[max(whole)].append(r)
        expected = segments(chain, written)
        assert [(p[0]["role"], at, sum(r["n_lines"] for r in p)) for at, p in whole.items()] == expected
        for role, at, n in expected:
            rest = [x or "" for x in written[at : at + n]]
            assert "\n".join(r["rendered"] for r in whole[at]) == "\n".join([f"<|{role}|>", chat.marker(rest[0])[1], *rest[1:]])
            chars, sizes = 0, {}
            for line in rest:
                sizes[chars // 200] = sizes.get(chars // 200, 0) + 1
                chars += len(line) + 1
            assert [(r["part"], r["n_lines"]) for r in whole[at]] == list(sizes.items())
