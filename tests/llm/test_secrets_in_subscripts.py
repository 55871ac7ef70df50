"""Secrets assigned to subscripts and in triple quotes."""

from __future__ import annotations

import pytest

from stayscope.llm import secrets

SECRET = "Zx81kQpLr8vTq2Wm"


@pytest.mark.parametrize(
    "form",
    ['cfg["password"] = "%s"', "os.environ['DB_PASSWORD'] = '%s'", 'headers["Authorization"] = "%s"', 'a["b"][ "apiKey" ] := "%s"',
     'password = """%s"""', "password = r'''%s'''", 'secret = """\n  %s\n"""', 'secret = """\\\n%s"""', 'a["token"] = x\nx = """%s"""'],
)
def test_literal_of_a_secret(form):
    text = form % SECRET
    assert [text[a:b] for a, _, b in secrets.literal_spans(text)] == [SECRET]
    assert f"{text.index(SECRET)}:{text.index(SECRET) + len(SECRET)}" in secrets.scan_text(text)[4]


@pytest.mark.parametrize(
    "text", [f'cfg["colour"] = "{SECRET}"', f'password = """{SECRET}', 'password = """"""', 'token = """one two\nthree four"""', "password = '''\n'''", "a[] = 1", 'x = "\\' * 50]
)
def test_none(text):
    assert secrets.literal_spans(text) == []
