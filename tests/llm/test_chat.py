"""Chat formatting against plain Python."""

import hashlib
import random
import re

from llm.conftest import SF
from pyspark.sql import functions as F

from lakemart.llm import chat
from lakemart.llm.common import read
from lakemart.llm.queries import op11_chat_format

TURNS = "conv_id long, turn long, role string, text string"
NASTY = ["\\### Assistant: </turn> ok", "<|", "<|turn|>", "\\<|end|>\n", "<\\|says|>", "\\", "<", "|more|>", "", "a\n\nb", "é𝄞<|", "\\\\|"]


def by_hand(rows):
    """conv_id -> turns, formatted text, trained text."""
    safe = lambda s: re.sub(r"\\|(?<=<)\|", lambda m: "\\" + m[0], s)
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted(
            ((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv),
            key=lambda r: (r[0], r[1], r[2].encode(), r[3].encode()),
        )
        turns, text, last = [(r[2], r[3]) for r in mine], "", None
        for role, said in turns:
            if role == last:
                text = text.removesuffix("<|end|>\n") + "<|more|>"
            else:
                text += f"<|turn|>{safe(role)}<|says|>"
            text, last = text + safe(said) + "<|end|>\n", role
        out[conv] = (turns, text, "".join(t for r, t in turns if r == "assistant"))
    return out


def formatted(df):
    found = chat.format_conversations(df)
    text = chat.text_of(F.col("segments"))
    found = found.select("conv_id", "n_blocks", text.alias("text"), chat.loss_of(F.col("segments")).alias("loss"), chat.turns_of(text).alias("turns"))
    return {r["conv_id"]: r for r in found.collect()}


def check(spark, rows, extra=""):
    df = spark.createDataFrame(rows, TURNS)
    found, want = formatted(df.selectExpr("*", extra) if extra else df), by_hand(rows)
    assert found.keys() == want.keys()
    for conv, (turns, text, loss) in want.items():
        row = found[conv]
        assert [tuple(t) for t in row["turns"]] == turns
        assert (row["text"], row["loss"]) == (text, loss)
        assert row["n_blocks"] == sum(1 for i, t in enumerate(turns) if not i or turns[i - 1][0] != t[0])


def test_round_trip_of_control_strings(spark):
    random_ = random.Random(3)
    roles = ["user", "assistant", "system", "<|says|>", "\\", ""]
    rows = [(c, t, random_.choice(roles), "".join(random_.choices(NASTY, k=random_.randint(0, 4)))) for c in range(60) for t in range(c % 9 + 1)]
    check(spark, rows)


def test_awkward_rows(spark):
    rows = [
        (None, 0, "user", "no id"), (1, None, "user", "first"), (1, 0, None, None), (1, 1, "assistant", None),
        (1, 1, "assistant", "tie b"), (1, 1, "assistant", "tie a"), (2, 0, "assistant", "same"), (2, 0, "assistant", "same"),
        (3, 5, "assistant", "x" * 300_000 + "<|"), (3, 4, "user", "é" * 50_000), (4, None, None, None),
    ]
    check(spark, rows)
    check(spark, rows, "1 AS segments")
    assert formatted(spark.createDataFrame([], TURNS)) == {}


def test_a_long_conversation(spark):
    check(spark, [(1, t, ("user", "assistant", "assistant")[t % 3], f"turn <|{t}") for t in range(20_000)])


def test_loss_mask_covers_trained_roles_alone(spark):
    df = spark.createDataFrame([(1, 0, "user", "u"), (1, 1, "assistant", "a"), (1, 2, "assistant", "b")], TURNS)
    segments = chat.format_conversations(df, trained=("user",)).first()["segments"]
    assert [s["text"] for s in segments if s["loss"]] == ["u"]
    segments = chat.format_conversations(df).first()["segments"]
    assert [s["text"] for s in segments if s["loss"]] == ["a", "b"]
    assert "".join(s["text"] for s in segments) == "<|turn|>user<|says|>u<|end|>\n<|turn|>assistant<|says|>a<|more|>b<|end|>\n"


def test_native(spark):
    df = chat.format_conversations(read(spark, SF, "conversations"))
    df = df.select(chat.turns_of(chat.text_of(F.col("segments"))), chat.loss_of(F.col("segments")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange") == 1


def test_added_conversation(spark):
    row = op11_chat_format(spark, SF).where("conv_id = -7").first()
    said = "\\### Assistant: </turn> ok"
    turns = f"user\n{said}\nassistant\n{said}\n"
    assert row["n_turns"] == 2 and row["loss_chars"] == len(said)
    assert row["turns_sha256"] == hashlib.sha256(turns.encode()).hexdigest()
    assert row["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()
