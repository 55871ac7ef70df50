"""Token ids, packing and chat formatting."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from stayscope.llm import chat, packing
from stayscope.llm.tokens import WordTokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def words():
    return WordTokenizer(PATH, cache_words=50)


def test_cached_words_give_the_tokenizers_ids(words):
    pick = random.Random(1)
    signs = [chr(i) for i in range(1, 0x250)] + list("'<|>́ẞİΣK中😀  ") + ["<|endoftext|>", "'s", "'LL", *"     "]
    for _ in range(4000):
        text = "".join(pick.choice(signs) for _ in range(pick.randint(0, 30)))
        assert words.ids(text) == words.encode(text), repr(text)


def test_nnls_meets_its_optimality_conditions():
    pick = np.random.default_rng(2)
    for _ in range(20):
        a, b = pick.random((12, 30)), pick.random(12) * 5
        x = packing.nnls(a, b)
        gradient = a.T @ (a @ x - b)
        assert (x >= 0).all() and gradient.min() > -1e-6 and np.abs(gradient[x > 1e-9]).max(initial=0) < 1e-6


def test_plan_fills_whole_windows_with_documents_there_are():
    bins, pick = 16, np.random.default_rng(3)
    for _ in range(20):
        histogram = {b: int(n) for b, n in enumerate(pick.integers(0, 50, bins + 1)) if b and n}
        places = packing.plan(histogram, bins)
        used, filled, ranks = Counter(), Counter(), defaultdict(list)
        for b, lo, hi, sequence, _ in places:
            used[b] += hi - lo
            ranks[b].append((lo, hi))
            for i in range(hi - lo):
                filled[sequence + i] += b
        assert all(used[b] <= histogram[b] for b in used) and set(filled.values()) <= {bins}
        for spans in ranks.values():
            spans.sort()
            assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert packing.plan({}, 16) == [] and packing.plan({3: 5}, 16) == []


def check_pieces(pieces, documents, words, window):
    """Every id of every document lies in one piece; sequences have no gaps; returns the padding's share."""
    left = defaultdict(list)
    for doc_id, text in documents:
        left[doc_id].append(words.encode(text or "") + (2).to_bytes(4, "little"))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.length > 0 and len(p.ids) == 4 * p.length
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert set(by_doc) == set(left)
    for doc_id, texts in left.items():
        want = Counter(t for ids in texts for t in np.frombuffer(ids, "<u4").tolist())
        got = Counter(t for p in by_doc[doc_id] for t in np.frombuffer(bytes(p.ids), "<u4").tolist())
        assert want == got
        if len(texts) == 1:
            parts = sorted(by_doc[doc_id], key=lambda p: p.start)
            assert b"".join(bytes(p.ids) for p in parts) == texts[0]
            assert all(p.doc_tokens == len(texts[0]) // 4 for p in parts)
    total = padding = 0
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
        total += window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding / max(total, 1)


def test_packing_awkward_documents(spark, messy, empty, words):
    found = packing.packed_ids(messy, PATH, window=256, unit=4).collect()
    check_pieces(found, [(r.doc_id, r.text) for r in messy.collect()], words, 256)
    assert packing.packed_ids(empty, PATH).count() == 0


def test_packing_many_documents_of_one_length(spark, words):
    docs = [(i, "a b c d e f g h i j" if i % 3 else " ".join("xyz" for _ in range(i % 61))) for i in range(900)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = packing.packed_ids(frame, PATH, window=64, unit=1)
    assert check_pieces(found.collect(), docs, words, 64) < 0.02
    tokens = {i: words.encode(t) + (2).to_bytes(4, "little") for i, t in docs}
    for r in packing.piece_digests(frame, PATH).collect():  # whole windows of 4096 here
        assert r.ids_crc32 == zlib.crc32(tokens[r.doc_id][4 * r.start : 4 * (r.start + r.length)])
    whole = packing.sequences(frame, PATH, window=64, unit=1).collect()
    assert sum(len(r.ids) for r in whole) == sum(map(len, tokens.values()))


def chats_by_hand(rows, block=1000):
    convs = defaultdict(set)
    for conv, turn, role, text in rows:
        convs[conv].add((turn, role or "", text or ""))
    ordered = {c: sorted(t, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])) for c, t in convs.items()}
    logs = {c: tuple((r, x) for _, r, x in t) for c, t in ordered.items()}
    prefixes = {log[:k] for log in logs.values() for k in range(1, len(log))}
    out = {}
    for log in set(logs.values()) - prefixes:
        same = [c for c, other in logs.items() if other == log]
        keep = min((c for c in same if c is not None), default=None)
        out[keep] = (len(same), "".join(f"<|{r}|>\n{x}<|end|>\n" for r, x in log))
    return out


def test_chats(spark):
    pick = random.Random(4)
    rows = []
    for conv in range(60):
        base, n = conv % 7, pick.randint(1, 9)
        rows += [(conv, t, "user" if t % 2 == 0 else None, f"turn {t} of {base if t < 5 else conv}") for t in range(n)]
    rows += rows[:40] + [(None, 0, "user", "x"), (None, 1, None, None), (99, None, "user", None), (99, 0, "user", ""), (99, 0, "user", "")]
    rows += [(100, t, "user", f"long {t}") for t in range(2500)] + [(101, t, "user", f"long {t}") for t in range(1200)]
    rows += [(1000 + i, 0, "user", "hello") for i in range(300)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("k", F.lit("clash"))
    got = defaultdict(list)
    for r in chat.format_chats(frame).collect():
        got[r.conv_id].append((r.part, r.copies, r.text))
    joined = {c: (parts[0][1], "".join(p[2] for p in sorted(parts))) for c, parts in got.items()}
    assert joined == chats_by_hand(rows)
    assert len(got[100]) == 3 and 101 not in got
    plan = chat.format_chats(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_no_chats(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_chats(frame).count() == 0
