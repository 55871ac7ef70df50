"""The pipeline over a small corpus: what each stage decides takes effect and is no more than its own."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

import corpus_pipeline

SYLLABLES = "ba be bi bo bu da de di do du ka ke ki ko ku la le li lo lu".split()


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Documents with rejects, copies, near copies and several sources, and their labels."""
    pick, rows, labels = random.Random(1), [], []

    def words(n):
        return ["".join(pick.choices(SYLLABLES, k=pick.randint(1, 3))) for _ in range(n)]

    for i in range(400):
        w = words(pick.randint(30, 120))
        bad = i % 6 == 0
        rows.append((i, " | ".join(w) if bad else " ".join(w) + ".", "en", f"s{i % 4}", 0))
        labels.append((i, int(not bad), 0))
    good = [r for r in rows if r[0] % 6]
    rows += [(1000 + i, r[1].capitalize(), "en", "s9", 0) for i, r in enumerate(good[:30])]
    rows += [(2000 + i, r[1] + " extra", "en", None, 0) for i, r in enumerate(good[40:70])]
    rows += [(3000, None, None, None, None), (3001, "", "en", "s1", 0)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages(spark, corpus, tmp_path):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    columns, kept = docs.columns, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, corpus).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        kept[name] = docs.collect()
        if i < 4:
            assert docs.columns == columns
    after = [{r.doc_id for r in rows} for rows in kept.values()]
    assert all(b <= a for a, b in zip(after, after[1:], strict=False))
    clean = {i for i in range(400) if i % 6}
    assert clean <= after[0] and not {i for i in range(400) if i % 6 == 0} & after[0]
    assert {1000 + i for i in range(30)} <= after[1] and len(clean & after[1]) == len(clean) - 30
    assert not {2000 + i for i in range(30)} & after[2] and after[2] >= (clean & after[1])
    words = Counter()
    for r in kept["n-gram Jaccard join"]:
        words[r.source] += len((r.text or "").split())
    mixed = Counter()
    for r in kept["mixing sources to target weights"]:
        mixed[r.source] += len(r.text.split())
    assert abs(sum(mixed.values()) - sum(words.values())) <= len(words)
    lengths = defaultdict(int)
    for r in kept["packing"]:
        lengths[r.sequence_id] += r.length
    assert max(lengths.values()) <= 4096 and len(lengths) - 1 <= sum(lengths.values()) / 4096


def test_run_is_registered_and_repeatable(spark, corpus):
    import __spark_entry__ as driver

    assert driver.queries()["pipeline"] is corpus_pipeline.run
    one, two = (corpus_pipeline.run(spark, corpus).drop("ids") for _ in range(2))
    keys = ["doc_id", "start", "length", "ids_crc32"]
    assert one.count() == two.count()
    assert Counter(one.groupBy("doc_id").sum("length").collect()) == Counter(two.groupBy("doc_id").sum("length").collect())
    assert set(keys) <= set(one.columns)
