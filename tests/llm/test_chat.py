"""Op 8: compiler, sandbox, exact round trips, awkward rows."""
import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from metroscope.llm import chat as C
from metroscope.llm import templates as T

RENDER = T.compile_template(C.TEMPLATE, C.CONTROLS)


def text(template, **names):
    return "".join(p for p, _ in T.compile_template(template, C.CONTROLS)(names))


@pytest.mark.parametrize("template,want", [
    ("a{# note #}b", "ab"),
    ("{{ 'x' ~ 1 + 2 }}", "x3"),
    ("{{ n + 1 }}", "4"),
    ("{% if n > 2 and not flag %}big{% elif n == 2 %}two{% else %}small{% endif %}", "big"),
    ("{% for m in ms %}{{ loop.index }}{{ m.a }}{% if not loop.last %},{% endif %}{% endfor %}", "1x,2y"),
    ("{% set k = 'q' %}{{ k | upper }}{{ 'é ' | trim | length }}", "Q1"),
    ("{{ missing }}{{ m.none }}|", "|"),
    ("{{ '\\n' }}{{ \"it's\" }}", "\nit's"),
    ("{% for m in ms %}{% set last = m.a %}{% endfor %}{{ 'x' in 'xy' }}", "True"),
])
def test_language(template, want):
    assert text(template, n=3, flag=False, ms=[{"a": "x"}, {"a": "y"}]) == want


@pytest.mark.parametrize("template", [
    "{{ m.__class__() }}", "{{ x[0] }}", "{% import os %}", "{{ 'a' * 9 }}", "{% for x %}{% endfor %}", "{% if x %}", "{{ a b }}",
    "{{ x | nosuch }}", "{{ (((x }}", "{% endfor %}", "{{ " + "(" * 60 + "x" + ")" * 60 + " }}", "x" * 30_000, "{{ 'a' + 1 }}"])
def test_sandbox_refuses(template):
    with pytest.raises(T.TemplateError):
        T.compile_template(template, C.CONTROLS)


def test_python_attributes_are_not_reachable():
    assert text("{{ m.__class__ }}{{ m.keys }}", m={"a": 1}) == ""


def test_constants_are_folded():
    functions = T._functions(C.CONTROLS)
    tree = T.fold(T.parse("{% set a = 'x' ~ 1 %}p{{ a }}{% if 1 > 2 %}no{% elif 'u' == 'u' %}yes{% endif %}{{ a | upper }}"), functions)
    assert tree == (T.Text("px1yesX1"),)
    tree = T.fold(T.parse("{% for m in ms %}{% if false %}x{% endif %}{{ m.a }}{% endfor %}"), functions)
    assert tree == (T.For("m", T.Name("ms"), (T.Output(T.Field(T.Name("m"), "a")),)),)
    # a name set twice is not a constant
    assert text("{% set a = 1 %}{% if n %}{% set a = 2 %}{% endif %}{{ a }}", n=True) == "2"


def test_loops_are_lazy():
    def endless():
        while True:
            yield {"role": "user", "text": "x"}

    pieces = RENDER({"messages": endless()})
    assert [next(pieces) for _ in range(1000)]


PARTS = ["<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "\\", "<", "/s>", "[", "INST] ", " ", "a", "é", "\n", "[/", "s>", "🎉"]
TURNS = st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "<s>x", "\\[ROLE]"]),
                           st.lists(st.sampled_from(PARTS), max_size=8).map("".join)), max_size=6)


@settings(max_examples=400, deadline=None)
@given(TURNS)
def test_round_trip(turns):
    messages = [{"role": r, "text": t} for r, t in turns]
    back = list(C.read_back(RENDER({"messages": messages})))
    assert [(r, t) for r, t, _ in back] == turns
    assert [m for _, _, m in back if m is not None] == [t for r, t in turns if r == "assistant"]


def test_query_digests(spark, sf):
    from metroscope.llm.queries import QUERIES

    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    said = "</s>[INST] ok [/INST]"
    rows += [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    got = {r.conv_id: r for r in QUERIES["op8_chat_template"](spark, sf).collect()}
    assert got.keys() == {r[0] for r in rows}
    for conv, r in got.items():
        own = sorted((x for x in rows if x[0] == conv), key=lambda x: x[1])
        loss = "".join(x[3] or "" for x in own if x[2] == "assistant")
        sha = hashlib.sha256("".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in own).encode()).hexdigest()
        out = "".join(p for p, _ in RENDER({"messages": [{"role": x[2] or "", "text": x[3] or ""} for x in own]}))
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) == (
            len(own), sha, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(out))


def test_formatted_text_and_spans(spark):
    turns = [(1, 0, "user", "hi <s>"), (1, 1, "assistant", "yo"), (1, 2, "assistant", ""), (2, 0, None, None)]
    got = {r.conv_id: r for r in C.format_conversations(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect()}
    assert got[1].formatted == "<s>[INST] hi \\<s> [/INST]<s>yo</s><s></s>"
    spans = [(s.start, s.end) for s in got[1].loss_spans]
    assert [got[1].formatted[a:b] for a, b in spans] == ["yo", ""]
    assert got[2].formatted == "<s>[ROLE][/ROLE]</s>" and got[2].loss_spans == []


def test_awkward_rows(spark):
    rng = random.Random(1)
    long = "word " * 200_000
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "assistant", "b"), (2, None, None, None), (None, 1, "user", "n"),
            (3, 0, "assistant", long), (4, 0, "user", "")] + [(9, i, rng.choice(["user", "assistant"]), f"t{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as n_turns", "'x' as formatted")
    got = {r.conv_id: r for r in C.digests(df).collect()}
    assert {k: r.n_turns for k, r in got.items()} == {1: 3, 2: 1, None: 1, 3: 1, 4: 1, 9: 3000}
    assert got[3].loss_chars == len(long) and got[4].loss_chars == 0
    assert got[1].turns_sha256 == hashlib.sha256(b"assistant\nb\nuser\na\nuser\na\n").hexdigest()
    assert C.digests(df.limit(0)).count() == 0 and C.format_conversations(df.limit(0)).count() == 0


def _compiled(source):
    return T.compile_template(source, T.Controls(("[INST]",)))


def _rendered(source, **names):
    return "".join(t for t, _ in _compiled(source)(names))


def test_the_sandbox_is_bounded():
    """Texts that double, chains of thousands, numbers and values without meaning: TemplateError, or done."""
    doubling = "{% set a0 = 'ab' %}" + "".join(f"{{% set a{i + 1} = a{i} ~ a{i} %}}" for i in range(22)) + "{{ a22 }}"
    for source in (doubling, doubling.replace("~", "+"), "{{ x" + ".a" * 3000 + " }}", "{{ x" + "|trim" * 3000 + " }}", "{{ 1" + " == 1" * 3000 + " }}",
                   "{{ " + "(" * 3000 + "1" + ")" * 3000 + " }}", "{{ " + "9" * 5000 + " }}", "{{ 'a' < 1 }}", "{{ 1|length }}", "{{ 1 in 2 }}", "{{ 'a' + 1 }}"):
        with pytest.raises(T.TemplateError):
            _compiled(source)
    assert _rendered("{{ " + "not " * 3000 + "x }}", x=1) == "True" and _rendered("{{ " + "not " * 2999 + "x }}", x=1) == "False"
    assert _rendered("{{ x" + " + 1" * 3000 + " }}", x=1) == "3001" and _rendered("{{ 1" + " + 1" * 3000 + " }}") == "3001"
    assert _rendered("{{ x" + " ~ 'b'" * 2000 + " }}", x="a") == "a" + "b" * 2000
    assert _rendered("{{ x" + " and y" * 2000 + " }}", x=1, y=0) == "0" and _rendered("{{ 0" + " or x" * 2000 + " }}", x="") == ""
    # growth that only the data decides ends while rendering
    grow = _compiled("{% set a = x %}{% for m in ms %}{% set x = x ~ x %}{{ x|length }}{% endfor %}")
    assert "".join(t for t, _ in grow({"x": "ab", "ms": [1, 2]})) in ("44", "48")
    runaway = _compiled("{{ x" + " ~ x" * 70 + " }}")
    with pytest.raises(T.TemplateError):
        list(runaway({"x": "y" * (1 << 20)}))
    with pytest.raises(T.TemplateError):
        list(_compiled("{{ x < 1 }}")({"x": "text"}))


def test_flat_chains_mean_what_nested_ones_did():
    assert _rendered("{{ a and b and c }}|{{ a or b or c }}|{{ a and 1 and b }}|{{ 1 and a or 'z' }}", a="", b=2, c=3) == "|2||z"
    assert _rendered("{{ 1 + 2 ~ 3 + 4 }}{{ 'a' ~ 1 ~ x ~ 'b' ~ 'c' }}{{ 1 + x + 2 }}", x=5) == "37a15bc8"
    assert _rendered("{{ not x == 1 }}{{ not not x }}", x=1) == "FalseTrue"
