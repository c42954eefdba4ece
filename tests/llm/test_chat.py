"""Templates, and conversations read back."""

import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from rolodeck.llm import chat as C

PARTS = st.sampled_from([*C.CONTROLS, "\\", "<", "[", "s>", "INST]", " ", "a", "é", "\n"])
TEXTS = st.lists(PARTS, max_size=12).map("".join)


@given(TEXTS)
def test_escape_is_reversible(text):
    assert C.unescape(C.escape(text)) == text
    assert not any(c in C.escape(text) for c in C.CONTROLS)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "[ROLE]"]), TEXTS), max_size=6))
def test_round_trip(turns):
    text, spans = C.compile_template(C.DEFAULT_TEMPLATE)([{"role": r, "text": t} for r, t in turns])
    assert C.read_back(text) == turns
    assert [C.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


@pytest.mark.parametrize(
    "template, want",
    [
        ("{{ 'a' ~ 1 + 2 }}", None),
        ("{{ 'a' ~ 'b' | upper }}", "aB"),
        ("{% if 1 == 2 %}x{% elif not false %}y{% else %}z{% endif %}", "y"),
        ("{% for m in messages %}{{ loop.index }}{{ m.text }}{% if not loop.last %},{% endif %}{% endfor %}", "1p,2q"),
        ("{% set n = 'v' %}{{ n }}{# no #}{{ missing }}{{ messages[1].text }}{{ messages[9].text }}", "vq"),
        ("{{ 'q' in messages[1].text and messages | length >= 2 or false }}", "True"),
    ],
)
def test_language(template, want):
    messages = [{"role": "user", "text": "p"}, {"role": "user", "text": "q"}]
    if want is None:
        with pytest.raises(C.TemplateError):
            C.compile_template(template)
    else:
        assert C.compile_template(template)(messages)[0] == want


def test_constants_are_folded():
    assert C.fold(C.parse("a{{ 'b' ~ 'c' }}{% if true %}d{% else %}{{ x }}{% endif %}")) == [C.Text("abcd")]


@pytest.mark.parametrize("template", ["{{ x.__class__ }}", "{{ f() }}", "{% if x %}", "{{ 1 | nothing }}", "{% for x %}{% endfor %}", "{% import os %}", "{{ }}", "{{ 'a }}"])
def test_sandbox(template):
    with pytest.raises(C.TemplateError):
        C.compile_template(template)


def test_names_reach_no_attributes():
    assert C.compile_template("{{ x.real }}{{ x['real'] }}")([], x=5)[0] == ""


def test_tables(spark):
    rows = [(1, 1, "assistant", "b", 0), (1, 0, "user", "a", 0), (2, None, None, None, 0), (2, 0, "tool", "t", 0), (3, 0, "user", "same", 0), (3, 0, "user", "same", 0), (None, 0, "user", "x", 0), (4, 0, "assistant", "y" * 100_000, 0)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, id int")
    got = {r.conv_id: r for r in C.conversation_digests(C.format_conversations(df)).collect()}
    digest = lambda *turns: hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    assert {k: r.n_turns for k, r in got.items()} == {1: 2, 2: 2, 3: 2, None: 1, 4: 1}
    assert got[1].turns_sha256 == digest(("user", "a"), ("assistant", "b")) and got[1].loss_chars == 1
    assert got[2].turns_sha256 == digest(("", ""), ("tool", "t")) and got[2].loss_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[4].loss_chars == 100_000
    assert C.conversation_digests(C.format_conversations(df.limit(0))).count() == 0
