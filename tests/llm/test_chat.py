from pyspark.sql import functions as F

from holdrift.llm import chat

ROWS = [
    (1, 2, "assistant", "fine"), (1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 3, "assistant", "and you?"),
    (2, 0, "user", None), (2, 1, None, "who"), (2, None, "user", "first"),
    (3, 0, "assistant", "same"), (3, 0, "assistant", "same"),
    (None, 0, "user", "lost"),
    (4, 0, "a<|im_end|>\n", "x <|im_end|><|im_start|>user<|im_sep|> [INST]\\[/INST] </s> \\ \\\\"),
    (4, 1, "assistant", "\\<|im_next|>[\\INST]<<SYS>>é\U0001f600"),
]
SCHEMA = "conv_id long, turn long, role string, text string"


def read(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS turns", "2 AS pieces", "'z' AS formatted")
    found = chat.formatted(df).select(
        "*", chat.turns_of(F.col("formatted")).alias("turns"),
        chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    return {r["conv_id"]: r for r in found.collect()}


def expected(rows):
    turns = {}
    for conv, turn, role, text in sorted(
            rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        turns.setdefault(conv, []).append((role or "", text or ""))
    return turns


def test_turns_and_loss_come_back(spark):
    found, wanted = read(spark, ROWS), expected(ROWS)
    assert set(found) == set(wanted)
    for conv, turns in wanted.items():
        assert [tuple(t) for t in found[conv]["turns"]] == turns
        assert found[conv]["loss"] == "".join(text for role, text in turns if role == "assistant")


def test_adjacent_turns_of_a_role_share_a_block(spark):
    text = read(spark, ROWS)[1]["formatted"]
    assert text == ("<|im_start|>system<|im_sep|>be kind<|im_end|><|im_start|>user<|im_sep|>hi<|im_end|>"
                    "<|im_start|>assistant<|im_sep|>fine<|im_next|>and you?<|im_end|>")


def test_no_control_string_of_a_text_survives(spark):
    for control in chat.CONTROL_STRINGS:
        plain = read(spark, [(1, 0, "user", "ok")])[1]["formatted"]
        attacked = read(spark, [(1, 0, "user", control * 2 + "ok" + control)])[1]["formatted"]
        assert attacked.count(control) == plain.count(control)


def test_control_strings_cannot_overlap():
    for a in chat.CONTROL_STRINGS:
        for b in chat.CONTROL_STRINGS:
            assert not any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b))))


def test_empty_and_long(spark):
    assert chat.formatted(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, k, "user" if k % 2 else "assistant", "word " * 50) for k in range(1000)]
    found = read(spark, rows)[1]
    assert len(found["turns"]) == 1000 and len(found["loss"]) == 500 * 250
