"""Transcripts: the model against brute force over all paths, parts against the whole, and accuracy."""

import itertools

import numpy as np
import pyarrow.parquet as pq
import pytest

from murmur.llm import chat
from murmur.llm.queries import op8_chat_format

LABELLED = [
    [("system", "System: be brief"), ("user", "User: how far is it?\nand why"), ("assistant", "Assistant: Ten miles.\nmore"), ("user", "User: thanks")],
    [("user", "Q: what now?"), ("assistant", "\nA: Nothing.")],
    [("user", "hello there, what is it?"), ("assistant", "\nIt is late."), ("user", "\nand then?")],
] * 5


@pytest.fixture(scope="module")
def model():
    return chat.fit(LABELLED)


def test_viterbi_is_the_best_path(model):
    text = "User: a\nb?\n\nAssistant: c\n- d"
    scores = model.scores([chat.features(x, g) for x, g in chat.lines(text)])
    path, score = chat.viterbi(model, scores, model.start)

    def value(p):
        return model.start[p[0]] + scores[0, p[0]] + sum(model.move[a, b] + scores[i + 1, b] for i, (a, b) in enumerate(zip(p, p[1:])))

    best = max(itertools.product(range(chat.N), repeat=len(scores)), key=value)
    assert np.isclose(score, value(best)) and path == list(best)
    ways = chat.summary(model, scores)
    assert np.isclose((model.start[:, None] + ways).max(), score)


@pytest.mark.parametrize(
    "line,kind",
    [("User: x", 2), ("[assistant] x", 3), ("<|system|> x", 1), ("Q: x", 2), ("Bob: x", 4), ("no marker here", 0), ("", 0), ("**Human:** x", 2)],
)
def test_markers(line, kind):
    assert chat.marker(line.replace("**", ""))[0] == kind


def turns(df):
    return sorted((r.conv_id, r.part, r.turn, r.role, r.text, r.continued) for r in df.collect())


def test_parts_equal_the_whole(spark, model):
    lines = ["User: how is it?", "b", "Assistant: Fine.", "so", "- one", "User: and", "who?", "Assistant: me", "", "x"] * 3
    whole = spark.createDataFrame([(1, 0, "\n".join(lines))], "conv_id long, part long, text string")
    cut = spark.createDataFrame([(1, i, "\n".join(lines[i : i + 4])) for i in range(0, len(lines), 4)], "conv_id long, part long, text string")
    a, b = turns(chat.parse(whole, model)), turns(chat.parse(cut, model))
    joined = []
    for _, _, _, role, text, continued in b:
        if continued:
            joined[-1] = (joined[-1][0], joined[-1][1] + "\n" + text)
        else:
            joined.append((role, text))
    squeeze = lambda t: "\n".join(x for x in t.split("\n") if x)
    assert [(r, squeeze(t)) for *_, r, t, _ in a] == [(r, squeeze(t)) for r, t in joined]
    shown = chat.render(chat.parse(cut, model)).orderBy("part", "turn").collect()
    assert "".join(r.rendered for r in shown).count("<|end|>") == len(joined)


def test_odd_rows(spark, model):
    rows = [(1, 0, None), (2, 0, ""), (3, 0, "\n \n"), (None, 0, "User: x"), (4, None, "User: thanks"), (4, None, "User: thanks"), (5, 0, "User: " + "long " * 50000), (6, 0, "Bob: hi")]
    df = spark.createDataFrame(rows, "conv_id long, part long, text string").selectExpr("*", "'x' AS role", "1 AS place")
    got = turns(chat.parse(df, model))
    assert [g[0] for g in got] == [4, 4, 5, 6] and got[1][3] == got[2][3] == "user" and got[2][4] == ("long " * 50000).strip()
    assert chat.parse(spark.createDataFrame([], "conv_id long, part long, text string"), model).collect() == []


def test_unlabelled_model_still_parses(spark):
    df = spark.createDataFrame([(1, 0, "User: x")], "conv_id long, part long, text string")
    assert chat.parse(df, chat.fit([])).count() == 1


def test_query_recovers_the_turns(spark):
    d = "/root/testdata/sf0.01"
    got = {}
    for r in sorted(op8_chat_format(spark, d).collect(), key=lambda r: (r.conv_id, r.part, r.turn)):
        got.setdefault(r.conv_id, []).append((r.role, r.rendered))
    want = {}
    for r in sorted(pq.read_table(f"{d}/conversations.parquet").to_pylist(), key=lambda r: (r["conv_id"], r["turn"])):
        want.setdefault(r["conv_id"], []).append(r["role"])
    right = sum([r for r, _ in got.get(i, [])] == w for i, w in want.items())
    assert set(got) == set(want) and right >= 0.85 * len(want)
