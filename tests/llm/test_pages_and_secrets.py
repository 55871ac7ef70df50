"""Main text of pages and secrets in texts."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayscope.llm import pages, secrets

SYLLABLES = "ba be bi bo bu da de di do du ka ke ki ko ku la le li lo lu".split()


def prose(pick, n):
    return " ".join("".join(pick.choices(SYLLABLES, k=pick.randint(1, 3))) for _ in range(n)) + "."


def page(pick):
    body = [prose(pick, pick.randint(10, 60)) for _ in range(pick.randint(1, 6))]
    links = "".join(f'<li><a href="#">{prose(pick, 1)}</a></li>' for _ in range(5))
    source = (
        f"<html><head><title>t</title><script>var a='</p>';</script></head><body><nav><ul>{links}</ul></nav>"
        f'<div class="ad">{prose(pick, 8)}</div><article><h1>{body[0][:20]}</h1>'
        + "".join(f"<p>{t}</p>" for t in body)
        + f"</article><footer>&copy; {prose(pick, 6)}</footer></body></html>"
    )
    return source, " ".join([" ".join(body[0][:20].split()), *body])


@pytest.fixture(scope="module")
def extractor():
    pick = random.Random(1)
    return pages.fit([page(pick)[0] for _ in range(60)])


def test_articles_of_pages_not_seen(extractor):
    pick = random.Random(2)
    made = [page(pick) for _ in range(60)]
    got = extractor.texts([m[0] for m in made])
    assert sum(g == m[1] for g, m in zip(got, made, strict=True)) >= 57


def test_article_without_telling_elements(extractor):
    pick = random.Random(3)
    text, more = prose(pick, 50), prose(pick, 40)
    source = f"""<body><div class="site-menu"><a href=a>ba</a> <a href=b>be</a> <a href=c>bi</a></div>
      <div id="content"><h1>Ka ki ko</h1><p>{text} &amp; done</p><p>{more}</p></div>
      <div id="comments"><div class="comment"><p>{prose(pick, 9)}</p></div><div class="comment"><p>{prose(pick, 7)}</p></div></div>
      <form><p>{prose(pick, 4)}</p><input></form><div class="footer">&copy; {prose(pick, 5)}</div></body>"""
    assert extractor.texts([source])[0] == f"Ka ki ko {text} & done {more}"


@pytest.mark.parametrize(
    "source", ["", " ", "<", "<p", "</p></div>", "<script>x", "<!-- open", "<div " * 50, "<div>" * 3000 + "x", "&#xFFFFFFF;&nbsp;", "<a b='c>d</a>", "<table><tr><td>a<td>b<tr><td>c", "<P>a<BR/>b<LI>c"]
)
def test_broken_pages_do_not_fail(extractor, source):
    assert isinstance(extractor.texts([source])[0], str)


def test_blocks_and_white_space():
    found = pages.parse("<div> a  <b>b</b>\n<i>c</i><br>d<p>e&nbsp;&lt;f<p>g<span>h</span></div>i")
    assert pages.joined(found, [True] * len(found.nodes)) == "a b c d e <f gh i"


def test_decoding_is_the_best_consistent_choice():
    pick = np.random.default_rng(5)
    for _ in range(60):
        n = int(pick.integers(1, 7))
        parents = [-1] + [int(pick.integers(0, i)) for i in range(1, n)]
        nodes = [pages.Node("div", p, 0, 0) for p in parents]
        found = pages.Page(nodes, [(i, i, False, "x") for i in range(n)])
        keep = pick.random(n) * 0.9
        drop = (1 - keep) * pick.random(n)
        both = np.clip(1 - keep - drop, 0.02, 1)
        logs = np.log(np.clip(np.column_stack([keep, drop, both]), 1e-4, 1))
        best, want = -np.inf, None
        for states in itertools.product(range(3), repeat=n):
            leaf = [i not in parents for i in range(n)]
            if any(states[i] == 2 and leaf[i] for i in range(n)):
                continue
            if any(states[p] < 2 and states[i] != states[p] for i, p in enumerate(parents) if p >= 0):
                continue
            total = sum(logs[i, s] for i, s in enumerate(states))
            if total > best:
                best, want = total, [s == 0 or (s == 2 and logs[i, 0] > logs[i, 1]) for i, s in enumerate(states)]
        assert pages.decode(found, keep, drop).tolist() == want


def test_pages_query_shape(spark):
    pick = random.Random(6)
    rows = [(i, f"u{i}", page(pick)[0], "clash") for i in range(20)] + [(20, None, None, None), (None, "u", "", ""), (3, "u3", "<p>x", "")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = pages.extract(frame, ["page_id", "url"]).collect()
    assert len(out) == len(rows) and all(r.n_chars == len(r.text) for r in out)
    assert [r.text for r in out if r.page_id == 20 or r.page_id is None] == ["", ""]
    assert pages.extract(frame.where("false"), ["page_id"]).count() == 0


def base_by_hand(text):
    kinds = [
        (r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A, lambda m: len(m[2]) >= 12),
        (r"AKIA[A-Z0-9]+", 0, lambda m: len(m[0]) >= 18),
        (r"[0-9a-f]+", 0, lambda m: len(m[0]) >= 16),
    ]
    return sorted((m.start(), k, m.end()) for k, (p, flags, fits) in enumerate(kinds) for m in re.finditer(p, text, flags) if fits(m))


def test_base_spans_by_hand():
    pick = random.Random(7)
    parts = ["password", "Passwd", "SECRET", "tok", "token", "api_key", "APIKEY", "=", ":", " ", '"', "'", "AKIA", "ABCDEF0123456789", "0123456789abcdef",
             "deadbeef", "Zz9/+_.=-", "ſ", "K", "é", "\n", "x" * 11, "y" * 13]
    for _ in range(5000):
        text = "".join(pick.choices(parts, k=pick.randint(1, 14)))
        assert secrets.base_spans(text) == base_by_hand(text), repr(text)


def found_literals(text):
    return [text[a:b] for a, _, b in secrets.literal_spans(text)]


def test_literals_reach_sensitive_names():
    assert found_literals('x = "Zx81kQpLr8vTq2"\ny = x\nDB_PASSWORD = y') == ["Zx81kQpLr8vTq2"]
    assert found_literals('a = "9fKq2LmX"\nsecretKey = a + "Tz8Wq1Yv"') == ["9fKq2LmX", "Tz8Wq1Yv"]
    assert found_literals('{"user": {"accessKey": "AbC9x0Lq7Rt2Vw8P"}}') == ["AbC9x0Lq7Rt2Vw8P"]
    assert found_literals("private_key: Qm9vTzR4LxP2\ncolour: Qm9vTzR4LxP2") == ["Qm9vTzR4LxP2"]
    assert found_literals('name = "Zx81kQpLr8vTq2"\nurl: http://a.b/c') == []
    assert found_literals('password = "changeme_please"\ntoken = "${TOKEN_VALUE}"\nsecret = "short"') == []
    assert found_literals("a = b\nb = a\ntoken = a") == []


def test_secrets_of_awkward_documents(spark, messy, empty):
    long = "a = 1; " * 20_000 + 'token = "Abcdefgh12345678"'
    docs = messy.withColumn("spans", F.lit(1)).unionByName(
        messy.limit(1).withColumns({"text": F.lit(long), "spans": F.lit(2), "doc_id": F.lit(2**60 + 1)})
    )
    rows = {r.doc_id: r for r in secrets.find_secrets(docs).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    assert rows[3].base_sha256 == nothing and rows[3].spans == "" and rows[3].n_assign == 0
    r = rows[2**60 + 1]
    start = long.index("token")
    want = f"assign:{start}:{len(long) - 1}"
    assert r.n_assign == 1 and r.spans == want and r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
    assert secrets.find_secrets(docs).count() == docs.count()
    assert secrets.find_secrets(empty).count() == 0
