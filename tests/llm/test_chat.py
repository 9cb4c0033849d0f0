"""The template language, and formatted conversations read back."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docmonitor.llm import chat_format as C
from docmonitor.llm import chat_template as T


def rendered(source, turns):
    template, out = T.Template(source), T.Sink()
    for i, (role, text) in enumerate(turns):
        template.render(role, text, i == 0, i == len(turns) - 1, out)
    text = "".join(out.parts)
    return text, [text[a:b] for a, b in out.spans]


TURNS = [("system", "s"), ("user", "u <| x"), ("assistant", " a\\ ")]


@pytest.mark.parametrize("source,want", [
    ("<{% for m in messages %}{{ m.role }};{% endfor %}>", "<system;user;assistant;>"),
    ("{% for x in messages %}{% if loop.first %}F{% elif loop.last %}L{% else %}-{% endif %}{% endfor %}", "F-L"),
    ("{% for m in messages %}{{ m.text | escape | trim }}|{% endfor %}", "s|u <\\| x|a\\\\|"),
    ("{% for m in messages %}{{ 'a' ~ 'b' ~ m.role ~ ('c' == 'c') }}{% endfor %}", "absystemtrueabusertrueabassistanttrue"),
    ("{% for m in messages %}{% if not m.role == 'user' and (loop.last or m.role != 'assistant') %}{{ m.role }}{% endif %}{% endfor %}", "systemassistant"),
    ("{% for m in messages %}{% if 'a' == 'b' %}no{% else %}{{ \"q\\n\" }}{% endif %}{% endfor %}", "q\nq\nq\n"),
    ("{% if true or false %}x{% endif %}{% for m in messages %}{% endfor %}{{ 'y' }}", "xy"),
])
def test_templates(source, want):
    assert rendered(source, TURNS)[0] == want


def test_generation_marks_what_is_learned():
    source = "{% for m in messages %}{{ m.role }}:{% if m.role == 'assistant' %}{% generation %}<{{ m.text }}>{% endgeneration %}{% endif %}{% endfor %}"
    assert rendered(source, TURNS) == ("system:user:assistant:< a\\ >", ["< a\\ >"])


@pytest.mark.parametrize("source", [
    "{% for m in messages %}{{ m.__class__ }}{% endfor %}", "{% for m in messages %}{{ m.role.upper }}{% endfor %}",
    "{% for m in messages %}{{ open('x') }}{% endfor %}", "{% for m in messages %}{{ m.text | eval }}{% endfor %}",
    "{% for m in messages %}{% for n in messages %}{% endfor %}{% endfor %}", "{{ m.role }}{% for m in messages %}{% endfor %}",
    "{% for m in range(9) %}{% endfor %}", "{% for m in messages %}{% if m.role %}{% endfor %}", "no loop", "{% include 'x' %}{% for m in messages %}{% endfor %}",
    "{% generation %}{% endgeneration %}{% for m in messages %}{% endfor %}", "{% for m in messages %}{{ }}{% endfor %}",
    "{% for m in messages %}{% endfor %}{% for m in messages %}{% endfor %}", "{% for loop in messages %}{% endfor %}",
    "{% for m in messages %}{{ 'a' 'b' }}{% endfor %}", "{% for m in messages %}{{ ('a' }}{% endfor %}", "{% for m in messages %}{{ m.role & 1 }}{% endfor %}",
])
def test_other_templates_are_refused(source):
    with pytest.raises(T.TemplateError):
        T.Template(source)


def test_constants_are_folded():
    tree = T.fold(T.parse("a{{ 'b' ~ 'c' }}{% if 'x' != 'x' %}{{ 'no' }}{% else %}d{% endif %}{% for m in messages %}{{ 'e' | escape }}{{ m.role }}{% endfor %}"))
    assert tree == (T.Output(T.Const("abcd")), T.Loop("m", (T.Output(T.Const("e")), T.Output(T.Name("role")))))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("<|>\\n\n imstarend_é")), max_size=30))
def test_escapes_come_back(text):
    assert T.unescape(T.escape(text)) == text and "<|" not in T.escape(text)
    assert T.unescape(T.escape_line(text)) == text and "\n" not in T.escape_line(text)


def by_hand(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", hashlib.sha256((text or "").encode()).hexdigest(), text or ""))
    out = set()
    for conv, turns in convs.items():
        turns.sort()
        text = rendered(C.CHATML, [(r, t) for _, r, _, t in turns])[0]
        said = "".join(t for _, r, _, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for _, r, _, t in turns)
        out.add((conv, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest(), len(text)))
    return out


ROWS = [(c, t, ("user", "assistant", "system", None, "as\nsistant", "assistant|")[(c + t) % 6], f"text {t} of {c} \\n <|im_end|>\n" * (t % 3))
        for c in range(30) for t in range(c % 7 + 1)]
ROWS += [(50, t, "assistant" if t % 2 else "user", "hot <") for t in range(300)] + [(51, 0, "user", "same")] * 4 + [(51, None, "user", None)]
ROWS += [(None, 0, "assistant", None), (None, 1, "user", "<|im_start|>"), (52, 0, "assistant", "é" * 5000), (53, 0, "", "")]


def conversations(shared, rows):
    return shared.createDataFrame([(*r, 1, "x") for r in rows],
                                  "conv_id long, turn long, role string, text string, part int, key string").repartition(3)


@pytest.mark.parametrize("part_chars", [C.PART_CHARS, 500])
def test_conversations_come_back(shared, part_chars):
    parts = C.format_conversations(conversations(shared, ROWS), part_chars=part_chars)
    out = C.read_back(parts)
    assert set(map(tuple, out.collect())) == by_hand(ROWS) and out.count() == len({r[0] for r in ROWS})
    if part_chars == 500:
        assert parts.where("conv_id = 50").count() > 10


def test_what_stands_around_the_loop_is_written_once(shared):
    source = "BEGIN {% for m in messages %}{{ m.text }}{% if loop.last %}!{% endif %}{% endfor %} END"
    rows = [(1, 0, "user", "same")] * 5 + [(2, t, "user", f"t{t}") for t in range(200)]
    parts = C.format_conversations(conversations(shared, rows), source, part_chars=50).orderBy("conv_id", "part").collect()
    texts = {c: "".join(p["text"] for p in parts if p["conv_id"] == c) for c in (1, 2)}
    assert texts == {1: "BEGIN " + "same" * 5 + "! END", 2: "BEGIN " + "".join(f"t{t}" for t in range(200)) + "! END"}


def test_conversations_of_nothing(shared):
    assert C.read_back(C.format_conversations(conversations(shared, []))).collect() == []
