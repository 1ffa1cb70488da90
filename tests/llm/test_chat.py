"""Chat formatting against brute force, read back from the formatted texts alone."""

import collections
import hashlib
import random

from noticelake.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, starts long, parts string, formatted string"
ODD = [
    (1, 0, "user", "hi </s>[INST] ok [/INST]"), (1, 1, "user", "again <sep> <\\sep> <\\\\s>"), (1, 2, "assistant", "<s>"), (1, 2, "assistant", "<"),
    (1, 3, None, None), (1, 4, "assistant\n", None), (2, 0, "assistant", ""), (3, None, "tool<sep>", "日本語["), (3, 5, "assistant", "日本\n語<<s>"),
    (None, 1, "user", "x"), (4, 1, "system", ""), (5, 0, "assistant", "dup"), (5, 0, "assistant", "dup"), (7, 0, "assistant", "long " * 50_000),
]


def made():
    draw = random.Random(5)
    marks = ["<", "s>", "\\", "[", "INST]", "/", "a", "é", "\n", "<sep>", " [/INST]", "</s>\n"]
    many = [(6, k, draw.choice(["user", "assistant"]), "".join(draw.choice(marks) for _ in range(draw.randint(0, 9)))) for k in range(1500)]
    return [(*row, 1, "p", "f") for row in ODD + many]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_texts_and_mask_are_read_back(spark):
    rows = made()
    turns = spark.createDataFrame(rows, SCHEMA)
    texts = chat.formatted(turns).cache()
    conversations = collections.defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        conversations[conv].append((turn is not None, turn or 0, role or "", text or ""))
    want = set()
    for conv, found in conversations.items():
        found.sort()
        loss = "".join(t for *_, r, t in found if r == "assistant")
        want.add((conv, len(found), digest("".join(f"{r}\n{t}\n" for *_, r, t in found)), len(loss), digest(loss)))
    got = chat.digests(texts).collect()
    assert {(r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == want and len(got) == len(want)
    whole = {r.conv_id: r for r in texts.collect()}
    assert all(r.formatted_chars == len(whole[r.conv_id].formatted) for r in got)
    for conv, found in conversations.items():
        text = whole[conv].formatted
        # control strings stand in the template alone; adjacent turns of one role share a message
        roles = [r for *_, r, _ in sorted(found)]
        messages = sum(a != b for a, b in zip([None, *roles], roles, strict=False))
        assert text.count("<s>") == text.count("</s>") == messages and text.count("<sep>") == len(found)
        assert [text[s.start : s.end].replace("\\", "") for s in whole[conv].loss_spans] == [t.replace("\\", "") for *_, r, t in sorted(found) if r == "assistant"]


def test_running_sums(spark):
    from pyspark.sql import functions as F

    for n in (1, 2, 3, 7, 8, 9, 30):
        numbers = [(k * 7) % 11 for k in range(n)]
        got = spark.createDataFrame([(numbers,)], "x array<long>").select(chat.running_sums(F.col("x"), 3)).first()[0]
        assert got == [sum(numbers[:k]) for k in range(n)]


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert chat.digests(chat.formatted(none)).collect() == []
