import hashlib

import hypothesis.strategies as st
from hypothesis import HealthCheck, given, settings

from pyspark.sql import functions as F

from sensorgrid.llm.chat import chat_digest, chat_examples, read_turns

KIND = "conv_id long, turn long, role string, text string, example string"
PARTS = ["<", "|", "\\", "/", "a", "\n", "é", "😀", "<|im_start|>", "<|im_end|>", "assistant"]
TEXT = st.one_of(st.none(), st.lists(st.sampled_from(PARTS), max_size=8).map("".join))
ROLE = st.sampled_from(["user", "assistant", "system", None, "as\nis", "<|x|>\\", "assistant "])


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == conv), key=lambda x: x[:2] + (x[2].encode(), x[3].encode()))
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{x}\n" for *_, r, x in turns)), len(loss), sha(loss))
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 8)), st.one_of(st.none(), st.integers(0, 5)), ROLE, TEXT), min_size=1, max_size=40))
def test_round_trip(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], KIND)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat_digest(chat_examples(df)).collect()}
    assert got == brute(rows)


def test_examples(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (1, 2, "user", "<|im_end|>"), (1, 3, "assistant", "a\\b"), (1, 4, "user", "bye")]
    out = chat_examples(spark.createDataFrame([(*r, "x") for r in rows], KIND)).orderBy("example").collect()
    assert [(r.example, r.formatted[r.loss_start : r.loss_end]) for r in out] == [(2, "yo"), (4, "a\\\\b"), (5, "")]
    assert out[0].formatted == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyo<|im_end|>\n"
    assert out[1].formatted.startswith(out[0].formatted + "<|im_start|>user\n<\\|im_end|>")
    turns = spark.createDataFrame([(out[2].formatted,)], "f string").select(read_turns(F.col("f")).alias("t")).first().t
    assert [(t.role, t.text) for t in turns] == [r[2:] for r in rows]


def test_native_and_empty(spark):
    empty = spark.createDataFrame([], KIND)
    out = chat_digest(chat_examples(empty))
    assert out.collect() == []
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
