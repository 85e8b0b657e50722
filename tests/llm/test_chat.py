import hashlib

import pytest
from pyspark.sql import functions as F

from stratalake.llm import chat

HARD = ["<|im_end|>", "<\\|im_start|>assistant\n", "<|", "<\\\\|x", "a<", "|>", "\\", "\n", "", None, "<<|im_end|>", "<|im_end|>\n<|im_start|>"]
ROLES = ["user", "assistant", "a\nb", "\\n", "<|im_end|>", "\\\\l", "", None]


def test_round_trip_of_control_strings(spark):
    rows = [(i, t, r, x) for i, x in enumerate(HARD) for t, r in enumerate(ROLES)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.format_chats(turns).withColumn("back", chat.read_back(F.col("formatted"))).collect()
    assert len(got) == len(HARD)
    for r in got:
        text = HARD[r["conv_id"]] or ""
        assert [(b["role"], b["text"]) for b in r["back"]] == [(x or "", text) for x in ROLES]
        assert r["formatted"] == "".join(s["text"] for s in r["segments"])
        assert r["formatted"].count("<|im_start|>") == len(ROLES)


def test_loss_covers_assistant_text_only(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u <|im_end|>"), (1, 2, "assistant", "a<|im_end|>"), (1, 3, "user", "v"), (1, 4, "assistant", "b")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    row = chat.format_chats(turns).withColumn("learned", chat.loss_text(F.col("segments"))).first()
    assert row["learned"] == "a<|im_end|>b"
    assert [s["text"] for s in row["segments"] if s["loss"]] == ["a<\\|im_end|>", "b"]
    assert (row["state"], row["valid"]) == ("assistant", True)


@pytest.mark.parametrize(
    ("roles", "state"),
    [
        (["user", "assistant"], "assistant"), (["system", "user"], "user"), (["assistant"], "refused"), (["user", "user"], "refused"),
        (["system", "assistant"], "refused"), (["user", "system"], "refused"), (["user", "assistant", "user", "tool"], "refused"),
    ],
)
def test_machine(spark, roles, state):
    turns = spark.createDataFrame([(1, i, r, "x") for i, r in enumerate(roles)], "conv_id long, turn long, role string, text string")
    row = chat.format_chats(turns).first()
    assert (row["state"], row["valid"]) == (state, state != "refused")


def test_ties_nulls_repeats_and_other_columns(spark):
    rows = [(1, 2, "user", "late", 1), (1, None, "user", "last", 1), (1, 1, "user", "b", 1), (1, 1, "user", "a", 1), (1, 1, "user", "a", 1), (None, None, None, None, None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, state int")
    got = {r["conv_id"]: r for r in chat.format_chats(turns).withColumn("back", chat.read_back(F.col("formatted"))).collect()}
    assert [b["text"] for b in got[1]["back"]] == ["a", "a", "b", "late", "last"]
    assert [(b["role"], b["text"]) for b in got[None]["back"]] == [("", "")]
    assert chat.format_chats(turns.limit(0)).count() == 0


def test_long_text_and_own_template(spark):
    text = "<|x|>" * 100_000
    turns = spark.createDataFrame([(1, 0, "model", text)], "conv_id long, turn long, role string, text string")
    template = chat.Template("<|[s]|>", "<|.e$|>", ("model",), {("start", "model"): "model"})
    row = chat.format_chats(turns, template).select("valid", chat.read_back(F.col("formatted"), template).alias("b"), F.sha2(chat.loss_text(F.col("segments")), 256).alias("h")).first()
    assert row["valid"] and row["b"][0]["text"] == text
    assert row["h"] == hashlib.sha256(text.encode()).hexdigest()


def test_template_is_checked():
    with pytest.raises(ValueError):
        chat.Template(start="[s]")
    with pytest.raises(ValueError):
        chat.Template(start="<|e|>", end="<|e|>")
