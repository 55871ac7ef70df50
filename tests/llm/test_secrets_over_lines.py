"""Literals on later lines, in brackets and calls, in rows and in attributes; time that grows with the text alone."""

from __future__ import annotations

import random
import time

import pytest

from stayscope.llm import secrets

KEY = "Zx81kQpLr8vTq2"


@pytest.mark.parametrize(
    "text",
    [
        'password =\n  "{}"', 'password = \\\n  "{}"', 'password = (\n  "{}"\n)', 'pwd = [  # note\n  "{}",\n]', "pwd := f(g('{}'), 1)",
        'password = os.getenv("X", "{}")', 'password = os.environ.get("SERVICE_PASSWORD_NAME", "{}")', 'pwd = get("a") or "{}"',
        'pwd = process.env.PWD_NAME || "{}"', 'db_password, user = "{}", "u"', 'user, db_password = "u", "{}"', 'let user, pwd = "u", "{}"',
        'connect(host, db_pwd="{}", port=5)', 'x = dict(pwd=["{}", "a"])', '{{"pwd": ["{}"], "u": 1}}', '<add key="Password" value="{}"/>',
        "<setting value='{}' name='db.pwd'></setting>", 'part = ("{}")\nuser, pwd = ("u", part)\npwd = part',
    ],
)
def test_literals_of_telling_names(text):
    text = text.format(KEY)
    assert [text[a:b] for a, _, b in secrets.literal_spans(text)] == [KEY]


@pytest.mark.parametrize(
    "text",
    [
        "", "pwd", "pwd =", "pwd = (", "pwd = f(", "pwd = (((", 'pwd = ["', "a, pwd = b", "pwd = )", '<add key="pwd"/>', '<add value="{}"/>',
        'pwd = os.environ["{}"', 'password, user = f("a"), "{}"', 'pwd = "u", "{}"', 'pwd = getenv("SERVICE_PASSWORD_NAME")', 'x = ["{}"]',
        'pwd = f(x="{}")', "said:\n\n{}",
    ],
)
def test_what_is_no_secret_of_such_a_name(text):
    assert secrets.literal_spans(text.format(KEY)) == []


@pytest.mark.parametrize(
    "part",
    [f'password = "{KEY}"\n', 'x = ("a=(", ', "x=(", "(", "a, ", "pwd = '''", '<a b="c" ', 'pwd = "a" + ', "=", '"ab", ', "# c\n", 'x = f("a", ',
     "a, b = ", "a, b = c, d; ", "<", "${", "pwd = [\n"],
)
def test_time_grows_with_the_text_alone(part):
    took = []
    for size in (100_000, 400_000):
        text = 'pwd = ("' + part * (size // len(part))
        start = time.process_time()
        secrets.scan_text(text)
        took.append(time.process_time() - start)
    assert took[1] < 10 * took[0] + 1


def test_no_span_inside_a_base_span():
    pick = random.Random(4)
    parts = [f'password="{KEY}" ', f"AKIA{'Q' * 16} ", "0123456789abcdef0 ", f'pwd = "{KEY}" ', 'auth = "a-b-c-1-2-3-4" ', "text\n", f"salt = '{'0a' * 12}' "]
    for _ in range(200):
        text = "".join(pick.choices(parts, k=pick.randint(0, 12)))
        base = secrets.base_spans(text)
        want = base + [s for s in secrets.literal_spans(text) if not any(b[0] <= s[0] and s[2] <= b[2] for b in base)]
        assert secrets.scan_text(text)[4] == ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(want))
