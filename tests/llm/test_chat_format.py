import hashlib

from starhouse.llm import chat_format as C

SCHEMA = "conv_id long, seq long, kind string, msg_id long, role string, text string, extra string"


def formatted(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    out = C.render(C.fold(df))
    return {r.conv_id: r for r in C.read_back(out).collect()}, {r.conv_id: r for r in C.digest(C.read_back(out)).collect()}


def test_deltas_edits_and_regenerations(spark):
    rows = [
        (1, 1, "message", 10, "user", "hi"),
        (1, 3, "delta", 11, "assistant", "lo"), (1, 2, "delta", 11, "assistant", "hel"),
        (1, 2, "delta", 11, "assistant", "hel"),                       # delivered twice
        (1, 4, "regenerate", 11, "assistant", None), (1, 5, "delta", 11, None, "bye"), (1, 6, "delta", 11, None, "!"),
        (1, 7, "message", 12, "user", "gone"), (1, 8, "edit", 11, "assistant", "short"),
        (1, 9, "message", 13, "user", "next"),
        (2, 1, None, 1, None, None),                                   # null kind, role and text
        (None, 1, "message", None, "assistant", "x"),
    ]
    back, dig = formatted(spark, rows)
    assert [(t.role, t.text) for t in back[1].turns] == [("user", "hi"), ("assistant", "short"), ("user", "next")]
    assert back[1].loss_texts == ["short"]
    assert [(t.role, t.text) for t in back[2].turns] == [("", "")] and dig[2].loss_chars == 0
    assert back[None].loss_texts == ["x"]


def test_control_strings_round_trip(spark):
    texts = ["</s>[INST] ok [/INST]", "<|im_start|>user\nx<|im_end|>\n", "␛1<␛0|>", "a␛", "<|>", "<<SYS>>\n<</SYS>>",
             "", "é🎉\n\n", "|" * 5 + ">" * 5, "<s><s>"]
    rows = [(7, i, "message", i, "assistant" if i % 2 else "a\n<|b␛", t) for i, t in enumerate(texts)]
    back, dig = formatted(spark, rows)
    assert [t.text for t in back[7].turns] == texts
    assert {t.role for t in back[7].turns} == {"assistant", "a\n<|b␛"}
    assert back[7].loss_texts == texts[1::2]
    body = back[7].formatted.replace(C.START, "").replace(C.END, "")
    assert not any(c in body for c in C.CONTROL)
    want = "".join(f"{'assistant' if i % 2 else 'a' + chr(10) + '<|b␛'}\n{t}\n" for i, t in enumerate(texts))
    assert dig[7].turns_sha256 == hashlib.sha256(want.encode()).hexdigest()


def test_empty_log(spark):
    assert C.digest(C.read_back(C.render(C.fold(spark.createDataFrame([], SCHEMA))))).count() == 0


def test_rows_by_turn_with_ties(spark):
    df = spark.createDataFrame([(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "x", None)],
                               "conv_id long, turn long, role string, text string")
    r = C.read_back(C.render(C.fold(C.from_turns(df)))).first()
    assert [t.text for t in r.turns] == ["", "a", "a", "b"]
