import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventsieve.llm import chat

BITS = st.lists(st.sampled_from([*chat.CONTROLS, "\\", "<", "[", "s>", "a", "\n", " ", "é", "/s>", "INST]"]), max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "</s>"]), BITS), max_size=6))
def test_turns_read_back(turns):
    render = chat.compile_template()
    out, said = "", ""
    for k, (role, text) in enumerate(turns):
        for part, loss in render(role, text, k == 0):
            out += part
            said += chat.unescape(part) if loss else ""
    assert list(chat.read_turns(out)) == turns
    assert said == "".join(t for r, t in turns if r == "assistant")


def test_template_language():
    folded = chat.fold(chat.parse("{% if 'a' == 'b' %}no{% else %}x{{ 'y' + 'z' }}{% endif %}!"))
    assert folded == ("block", ("show", ("const", "xyz!")))
    render = chat.compile_template("{% if first and not message.role == 'user' %}A{% elif message.role != 'user' or first %}B{% else %}C{% endif %}")
    assert [render(r, "", f)[0][0] for r, f in (("x", True), ("x", False), ("user", True), ("user", False))] == ["A", "B", "B", "C"]
    for bad in ("{{ message.__class__ }}", "{{ open }}", "{{ 'a' | upper }}", "{% for x %}", "{% if first %}", "{{ first", "{{ (first }}", "{% generation %}x"):
        if bad == "{{ first":
            assert chat.compile_template(bad)("", "", True) == [(bad, False)]
            continue
        with pytest.raises(chat.TemplateError):
            chat.compile_template(bad)


def test_digests_of_odd_conversations(spark):
    rows = [(1, 1, "assistant", "yes </s>", "c"), (1, 0, "user", "<s>[INST]", "c"), (None, 0, "user", "n", None), (2, 0, None, None, "c"),
            (2, None, "assistant", "first", "c"), (3, 5, "assistant", "same", "c"), (3, 5, "assistant", "same", "c"), (2**60 + 1, 0, "tool", "x" * 100_000, "c")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    got = {r["conv_id"]: r for r in chat.digests(chat.format_turns(df)).collect()}
    turns = {1: [("user", "<s>[INST]"), ("assistant", "yes </s>")], None: [("user", "n")], 2: [("assistant", "first"), ("", "")],
             3: [("assistant", "same")] * 2, 2**60 + 1: [("tool", "x" * 100_000)]}
    assert set(got) == set(turns)
    for conv, want in turns.items():
        r, loss = got[conv], "".join(t for role, t in want if role == "assistant")
        assert r["n_turns"] == len(want) and r["loss_chars"] == len(loss)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in want).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.digests(chat.format_turns(df.limit(0))).count() == 0


def test_a_hot_conversation_is_rendered_before_the_shuffle(spark):
    """Rendering and reading back keep the input's partitions, whatever conversation their rows are of."""
    turns = [("user" if k % 2 == 0 else "assistant", f"turn {k} [INST]") for k in range(400)]
    rows = [(7, k, *t) for k, t in enumerate(turns)] + [(c, 0, "user", "u") for c in range(100, 150)] + [(None, k, "tool", "t") for k in range(9)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(16)
    read = chat.read_back(chat.format_turns(df))
    assert read.rdd.getNumPartitions() == 16
    per_task = [r["count"] for r in read.filter("conv = '7'").groupBy(F.spark_partition_id()).count().collect()]
    assert len(per_task) == 16 and max(per_task) <= 2 * 400 / 16
    got = {r["conv_id"]: r for r in chat.digests(chat.format_turns(df)).collect()}
    assert len(got) == 52 and got[7]["n_turns"] == 400 and got[None]["n_turns"] == 9
    assert got[7]["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
    assert got[7]["loss_chars"] == sum(len(t) for r, t in turns if r == "assistant")


def test_first_marks_one_row_of_each_conversation(spark):
    rows = [(1, 1, "user", "b"), (1, 0, "user", "a"), (None, 3, "x", "n"), (None, None, "x", "m"), (2, 0, "y", "same"), (2, 0, "y", "same")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    got = chat.format_turns(df, "{% if first %}^{% endif %}{{ message.text }}").collect()
    assert sorted((str(r["conv_id"]), r["formatted"]) for r in got) == [
        ("1", "^a"), ("1", "b"), ("2", "^same"), ("2", "same"), ("None", "^m"), ("None", "n")]
    assert chat.format_turns(df.limit(0), "{% if first %}^{% endif %}").count() == 0
