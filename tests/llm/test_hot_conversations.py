"""Conversations many of whose turns share a number."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayscope.llm import chat


def test_blocks_and_parts_of_a_hot_conversation_are_bounded(spark, monkeypatch):
    texts = [f"text {i:05}" for i in range(3500)]
    rows = [(None, None if i % 2 else 3, "user", t) for i, t in enumerate(texts)] + [(1, 0, "user", "x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = chat.ordered_turns(frame)
    assert turns.groupBy("conv_id", "_block").count().agg(F.max("count")).first()[0] <= 1000
    want = "".join(f"<|user|>\n{t}<|end|>\n" for t in texts[1::2] + texts[::2])
    for size, parts in ((1 << 26, 2), (20_000, 4)):
        monkeypatch.setattr(chat, "PART_BYTES", size)
        found = sorted((r.part, r.n_turns, r.text) for r in chat.format_chats(frame).where("conv_id is null").collect())
        assert [p for p, _, _ in found] == list(range(parts)) and sum(n for _, n, _ in found) == 3500
        assert "".join(t for _, _, t in found) == want
