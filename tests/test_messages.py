"""Messages held in a table, against every message tried on every line."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from veriframe.operators import messages as m

MESSAGE, LINE = "message string", "m string, n int"


def frames(spark, lines, messages):
    return spark.createDataFrame([(x, k) for k, x in enumerate(lines)], LINE), spark.createDataFrame([(x,) for x in messages], MESSAGE)


def compared(spark, lines, messages):
    """Hits per message and messages per line, as found and by brute force."""
    frame, wanted = frames(spark, lines, messages)
    hits = {r.message: r.hits for r in m.message_hits_from(frame, "m", wanted).collect()}
    held = {r.n: r.messages for r in m.lines_with_messages(frame, "m", wanted).collect()}
    known, texts = {x for x in messages if x is not None}, [(k, x) for k, x in enumerate(lines) if x is not None]
    by_line = {k: sum(x in text for x in known) for k, text in texts}
    return (hits, held), ({x: sum(x in text for _, text in texts) for x in known}, {k: n for k, n in by_line.items() if n})


def test_against_brute_force(spark):
    draw = random.Random(5)
    text = lambda size: "".join(draw.choice("ab. %") for _ in range(size))
    lines = [text(draw.randint(0, 40)) for _ in range(120)] + ["same line here"] * 60 + [None]
    found, wanted = compared(spark, lines, [text(draw.randint(1, 7)) for _ in range(80)] + ["same line", "none at all", "same line"])
    assert found == wanted


def test_odd_messages(spark):
    lines = ["", None, "a.b (c) [d", "axb\nnext", "é😀 wide 😀😀 signs", "😀", "100% of 'rows'", "back\\slash $1"]
    found, wanted = compared(spark, lines, ["", None, "a.b", "(c) [", "b\nne", "😀", "😀 w", "😀😀 s", "é😀 wide", "\\s", "$1", "% of '", "zzzz", "x"])
    assert found == wanted and found[0][""] == 7


def test_a_message_across_pieces_of_a_long_text(spark):
    size = m.PIECE
    long = "x" * (size - 3) + "needle in hay" + "y" * (2 * size) + "needle"
    found, wanted = compared(spark, [long, long, "needle"], ["needle", "needle in", "xneed", "x" * (size - 3) + "n", "yy" * size + "ne", "in hay!"])
    assert found == wanted


def test_blocks_of_the_index(spark, monkeypatch):
    monkeypatch.setattr(m, "BLOCK_BYTES", 200)
    lines = [f"task {k} of run {k % 7} ended" for k in range(60)]
    found, wanted = compared(spark, lines, [f"task {k} of" for k in range(20)] + ["of run 3", "n 5", "ended", "task"])
    assert found == wanted


def test_nothing_to_find(spark):
    for lines, messages in [(["a"], []), ([], ["abcde", "b", ""]), (["a"], [None]), ([None], [""]), (["abc"], [""])]:
        found, wanted = compared(spark, lines, messages)
        assert found == wanted
    frame, wanted = frames(spark, ["abc"], ["xyz", "q"])
    assert {r.status for r in m.message_hits_from(frame, "m", wanted).collect()} == {"fail"}
    assert {r.status for r in m.message_hits_from(frame, "m", frames(spark, [], ["xyz", "ab"])[1]).collect()} == {"pass"}


def test_other_columns_stay(spark):
    frame = spark.createDataFrame([("some text", 1, 2, 3)], "m string, _key int, key int, rows int")
    row = m.lines_with_messages(frame, "m", spark.createDataFrame([("text",)], MESSAGE)).first()
    assert (row._key, row.key, row.rows, row.messages) == (1, 2, 3, 1)


def test_ten_thousand_messages_join_on_grams(spark):
    lines = spark.range(2_000).select(F.concat(F.lit("event "), "id", F.lit(" of "), F.col("id") * 7).alias("m"))
    messages = spark.range(10_000).select(F.concat(F.lit("event "), "id", F.lit(" of")).alias("message"))
    found = m.message_hits_from(lines, "m", messages)
    assert found.where("hits = 1").count() == 2_000 and found.count() == 10_000


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_plan_is_an_equal_join(spark, threshold):
    frame, wanted = frames(spark, ["abc def", "ghi"], ["bc d", "hi", ""])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for df in (m.message_hits_from(frame, "m", wanted), m.lines_with_messages(frame, "m", wanted)):
            text = df._jdf.queryExecution().executedPlan().toString()
            assert "NestedLoop" not in text and "Cartesian" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
