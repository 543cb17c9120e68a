"""Chat formatting: read back from the output, against a plain version."""

import hashlib
import random

import pytest

from placeflow.llm import chat
from placeflow.llm.oracle import ORACLE
from tests.oracle_compare import compare, duck_con


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(rows):
    """conv_id -> digests, from the rows alone."""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == conv))
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        out[conv] = (len(turns), sha("".join(f"{t[2]}\n{t[3]}\n" for t in turns)), len(loss), sha(loss))
    return out


def digests(df):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"])
            for r in chat.read_back(chat.segments(df)).collect()}


def hostile(n=400):
    rng = random.Random(9)
    bits = [*chat.TEMPLATE.marks, "\\", "[", "]", "<", ">", "/", "INST", "s>", "\n", "x", "😀", ""]
    roles = ["system", "user", "assistant", "tool", "", None, "[INST]", "a\nb"]
    rows = []
    for i in range(n):
        text = None if rng.random() < 0.05 else "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))
        rows.append((rng.choice([1, 2, 3, None, 7, 8]), rng.choice([None, *range(60)]), rng.choice(roles), text))
    return rows + rows[:5]


def test_texts_and_masks_survive(spark):
    rows = hostile()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumnRenamed("turn", "turn")
    assert digests(df) == plain(rows)


def test_escape_is_reversible():
    t = chat.TEMPLATE
    for _, _, role, text in hostile():
        escaped = t.escape(text or "")
        assert t.unescape(escaped) == (text or "")
        assert not any(m in escaped for m in t.marks)


def test_conversations_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert digests(df) == plain(rows)


def test_turn_order():
    def machine(*roles):
        m = chat.Formatter(chat.TEMPLATE)
        for r in roles:
            m.turn(r, "x")
        return m.bad

    assert machine("system", "user", "assistant", "user") is None
    assert machine("assistant") == 0 and machine("user", "user") == 1
    assert machine("user", "assistant", "system") == 2 and machine("user", "tool", "user") == 1


def test_only_trained_texts_are_under_the_loss(spark):
    rows = [(1, 0, "system", "a"), (1, 1, "user", "b</s>"), (1, 2, "assistant", "c[/ANS]"), (1, 3, "assistant", "d")]
    segs = chat.segments(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).orderBy("seg").collect()
    assert [chat.TEMPLATE.unescape(s["text"]) for s in segs if s["loss"]] == ["c[/ANS]", "d"]
    assert segs[0]["text"] == "<s>" and segs[-1]["text"] == "</s>" and segs[-1]["bad_turn"] == 3 and not segs[-1]["valid"]


def test_overlapping_marks_are_refused():
    with pytest.raises(ValueError):
        chat.Template("<s>", "s>x", {"user": chat.Role("[U]", "[/U]", ("",))}, chat.Role("[R]", "[/R]", ()), "[:]")


def test_empty_and_extra_columns(spark):
    schema = "conv_id long, turn long, role string, text string, seg long, loss boolean, valid string"
    assert chat.segments(spark.createDataFrame([], schema)).count() == 0
    df = spark.createDataFrame([(5, 0, "user", "x" * 3_000_000, 1, True, "v")], schema)
    assert digests(df) == plain([(5, 0, "user", "x" * 3_000_000)])


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf_dir, name):
    import __spark_entry__ as entry
    problems, n = compare(entry.queries()[name](spark, sf_dir), duck_con(sf_dir), ORACLE[name])
    assert not problems and n
