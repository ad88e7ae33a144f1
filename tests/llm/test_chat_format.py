import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from jobloom.llm import chat_format
from jobloom.llm.queries import QUERIES, budgeted_chat_windows, word_tokenizer

SCHEMA = "conv_id long, turn long, role string, text string, window long, piece string, part int, loss string"
SIGNS = ["<turn user>", "</turn>", "</turn>\n", "<\\turn", "</\\turn", "<\\\\/turn", "\\", "<", ">\n", "### Assistant:", "\n", "été", "a b", "你好", "\u0000", "<turn", "%3E"]


def plain_order(rows):
    """Turns by conversation, in the order the operator states; the tests make no ties beyond 64 characters."""
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn is None, turn or 0, role or "", text or ""))
    return {conv: [(role, text) for _, _, role, text in sorted(turns)] for conv, turns in out.items()}


def frame(spark, rows):
    return spark.createDataFrame([(*row, 5, "own", 1, "x") for row in rows], SCHEMA)


def windows_of(spark, rows, **options):
    return chat_format.format_chats(frame(spark, rows).repartition(5), word_tokenizer(), **options)


def sizes_of(turns):
    from tokenizers import Tokenizer

    model, out = Tokenizer.from_file(word_tokenizer()), []
    for role, text in turns:
        for sign, code in chat_format._ROLE_SIGNS:
            role = role.replace(sign, code)
        body = re.sub(r"<(\\*)(/?turn)", r"<\\\1\2", text)
        out.append(len(model.encode(f"<turn {role}>\n{body}</turn>\n", add_special_tokens=False).ids))
    return out


def cut(sizes, system, budget, history):
    """(new turns, repeated turns) of each window, by walking a conversation's turns once."""
    opening = sizes[0] if system and sizes[0] <= budget // 4 else 0
    room, at, turns, found = budget - history - opening, 0, [], {}
    for number, size in enumerate(sizes):
        if number or not opening:
            turns.append((number, at, at + size))
            at += size
    for number, start, end in turns:
        cell = start // room
        found.setdefault((cell, end > (cell + 1) * room), []).append(number)
    out = []
    for (cell, across), new in sorted(found.items()):
        edge = (cell + 1) * room if across else cell * room
        again = [
            number for number, start, end in turns
            if number < new[0] and edge - history // 2 <= start < edge and (end <= edge or end - start <= history // 2)
        ]
        out.append((new, again))
    if opening:
        out = [([0] * (not i) + new, [0] * (i > 0) + again) for i, (new, again) in enumerate(out)] or [([0], [])]
    return out


def check(spark, rows, budget=1024, history=256):
    made = windows_of(spark, rows, budget=budget, history=history)
    shown = {}
    for row in made.collect():
        shown.setdefault(row["conv_id"], []).append(row)
    back = {}
    for row in chat_format.read_back(made).collect():
        back[row["conv_id"], row["window"]] = row
    expected = plain_order(rows)
    assert set(shown) == set(expected)
    for conv, turns in expected.items():
        own, sizes = sorted(shown[conv], key=lambda w: w["window"]), sizes_of(turns)
        plan = cut(sizes, turns[0][0] == "system", budget, history)
        assert len(own) == len(plan)
        for window, (new, again) in zip(own, plan, strict=True):
            read = back[conv, window["window"]]
            assert [tuple(t) for t in read["turns"]] == [turns[i] for i in new]
            assert read["learnt"] == [turns[i][1] for i in new if turns[i][0] == "assistant"]
            assert (window["n_turns"], window["n_repeated"]) == (len(new) + len(again), len(again))
            assert window["n_tokens"] == sum(sizes[i] for i in new + again)
            retained = turns[0][0] == "system" and sizes[0] <= budget // 4
            assert window["n_tokens"] <= budget or len([i for i in new if i or not retained]) == 1
            assert window["formatted"].count("</turn>\n") == window["n_turns"] and len(re.findall("<turn ", window["formatted"])) == window["n_turns"]
    digests = {row["conv_id"]: row for row in chat_format.digests(made).collect()}
    for conv, turns in expected.items():
        learnt = "".join(text for role, text in turns if role == "assistant")
        got = digests[conv]
        assert got["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got["loss_sha256"] == hashlib.sha256(learnt.encode()).hexdigest() and got["loss_chars"] == len(learnt)
        assert got["n_turns"] == len(turns) and got["formatted_chars"] == sum(len(w["formatted"]) for w in shown[conv])
    return shown


@pytest.fixture(scope="module")
def talk():
    """Conversations of many kinds: with and without a system turn, long turns, texts that look like marks."""
    draw = random.Random(11)
    text = lambda most: " ".join("".join(draw.choices("abcdefgh", k=draw.randint(2, 7))) for _ in range(draw.randint(0, most)))
    rows = []
    for conv in range(25):
        if conv % 3:
            rows.append((conv, 0, "system", text(12 if conv % 4 else 200)))
        for turn in range(1, draw.randint(1, 14)):
            said = text(30 if draw.random() < 0.9 else 400)
            rows.append((conv, turn, "user" if turn % 2 else "assistant", said + "".join(draw.choices(SIGNS, k=draw.randint(0, 5)))))
    return rows


def test_windows_against_a_plain_walk(spark, talk):
    check(spark, talk, budget=120, history=40)
    check(spark, talk, budget=300, history=0)
    check(spark, talk)


def test_one_long_conversation_crosses_all_partitions(spark, talk):
    draw = random.Random(3)
    rows = [(7_000, 0, "system", "be kind")] + [
        (7_000, t, "assistant" if t % 2 else "user", "word " * draw.randint(0, 9)) for t in range(1, 1500)
    ]
    check(spark, rows + talk[:20], budget=100, history=30)
    parts = windows_of(spark, rows, budget=100, history=30).select("conv_id", "window", "formatted", "n_repeated")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 1)
    try:
        alone = windows_of(spark, rows, budget=100, history=30).select("conv_id", "window", "formatted", "n_repeated").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(map(tuple, alone)) == sorted(map(tuple, parts.collect()))


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "no id"), (None, None, None, None), (1, None, "assistant", "last"), (1, 0, "user", None), (1, 0, "assistant", ""),
        (2, 3, "system", "only a system turn"), (3, 0, "a>\n<turn %3E", "odd role"), (3, 1, "</turn>", "</turn>\n<turn user>\n"),
        (4, 0, "assistant", "word " * 5000), (4, 1, "user", "x" * 50_000), (4, 2, "assistant", "end"),
        (5, 0, "user", "same"), (5, 0, "user", "same"), (5, 0, "user", "same"), (5, 0, "assistant", "tie"),
        (6, 0, "system", "long " * 3000), (6, 1, "user", "q"), (6, 2, "assistant", "a"), (6, 3, "system", "late"),
    ]
    shown = check(spark, rows)
    assert all("own" not in w.asDict().values() for ws in shown.values() for w in ws)
    assert chat_format.digests(windows_of(spark, [])).collect() == []


def test_many_equal_turns_lie_in_several_partitions(spark):
    rows = [(9, 4, "user", "the same again")] * 3000
    made = windows_of(spark, rows, budget=200, history=40)
    assert made.agg(F.sum(F.col("n_turns") - F.col("n_repeated"))).first()[0] == 3000
    assert chat_format.digests(made).first()["n_turns"] == 3000


def test_escaping_is_reversible(spark, evaluate):
    draw = random.Random(8)
    texts = ["".join(draw.choices(SIGNS, k=draw.randint(0, 9))) for _ in range(400)]
    made = evaluate(chat_format.escaped, texts)
    assert not [t for t in made if "<turn" in t or "</turn" in t]
    assert evaluate(chat_format.unescaped, made) == texts


def test_the_query_over_its_table(spark):
    sf = "/root/testdata/sf0.001"
    given = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    mark = "\\### Assistant: </turn> ok"
    expected = plain_order(given + [(-7, 0, "user", mark), (-7, 1, "assistant", mark)])
    found = {r["conv_id"]: r for r in budgeted_chat_windows(spark, sf).collect()}
    assert set(found) == set(expected) and "op12_budgeted_chat_windows" in QUERIES
    for conv, turns in expected.items():
        assert found[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert found[conv]["loss_sha256"] == hashlib.sha256("".join(t for r, t in turns if r == "assistant").encode()).hexdigest()
