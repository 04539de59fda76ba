"""Chat formatting: round trip, spans, templates that look back or rewrite."""

import hashlib
from collections import defaultdict

import pytest
from hypothesis import given
from hypothesis import strategies as st

from fleetlens.llm import chat

CONVS = "conv_id long, turn long, role string, text string, segment string, starts string"
T = chat.InstTemplate()


def digest(turns):
    return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


def check(frame):
    groups = defaultdict(list)
    for r in frame.collect():
        groups[r["conv_id"]].append((r["turn"] is None, r["turn"] or 0, r["role"] or "", r["text"] or ""))
    formatted = chat.format_conversations(frame)
    rows = chat.read_back(formatted).collect()
    assert len(rows) == len(groups)
    size = defaultdict(int)
    for r in formatted.collect():
        size[r["conv_id"]] += len(r["text"])
        assert r["rewrites_from"] is None
    for r in rows:
        turns = [(x[2], x[3]) for x in sorted(groups[r["conv_id"]])]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"], r["formatted_chars"]) == (
            len(turns), digest(turns), len(loss), hashlib.sha256(loss.encode()).hexdigest(), size[r["conv_id"]])


def test_conversations(spark):
    check(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet"))


def test_odd_rows(spark):
    own = "</s>[INST] ok [/INST]"
    rows = [(-7, 0, "user", own), (-7, 1, "assistant", own), (1, 0, None, None), (1, 0, "assistant", ""),
            (1, 0, "assistant", ""), (1, None, "tool\n[ROLE]", "<\\/s> <\\\\/s>[\\INST]"), (None, 2, "system", "x"),
            (None, 1, "user", "é\n"), (2, 5, "assistant", " </s> "), (3, 1, "user", "z" * 200_000)]
    rows += [(4, i, ("user", "assistant")[i % 2], f"turn {i} </s>") for i in range(300)]
    check(spark.createDataFrame([r + ("s", "t") for r in rows], CONVS))
    assert chat.read_back(chat.format_conversations(spark.createDataFrame([], CONVS))).count() == 0


def test_long_conversations_come_in_segments(spark):
    turns = [("user" if i % 2 else "assistant", f"text {i}") for i in range(300)]
    segments = [s for s, _ in chat.render_turns(T, iter(turns))]
    assert len(segments) == -(-300 // chat.SEGMENT)
    assert "".join(s.text for s in segments) == T.render(turns)
    loss = [T.unescape(s.text[a:b]) for s in segments for a, b in zip(s.loss_starts, s.loss_ends)]
    assert loss == [t for r, t in turns if r == "assistant"]


class Numbered(chat.InstTemplate):
    """Looks back to the start: every turn carries its number."""

    def render(self, turns):
        return "".join(f"{i}:{r}:{t};" for i, (r, t) in enumerate(turns))


class Forgetful(chat.InstTemplate):
    """Rewrites history: older assistant texts are dropped."""

    def render(self, turns):
        return "".join(f"[{r}]{'' if r == 'assistant' and i < len(turns) - 2 else t};" for i, (r, t) in enumerate(turns))


def test_templates_that_look_back_are_rendered_from_the_start():
    turns = [("user", str(i)) for i in range(200)]
    segments = [s for s, _ in chat.render_turns(Numbered(), iter(turns))]
    assert "".join(s.text for s in segments) == Numbered().render(turns)


class Reminding:
    """Repeats the first turn at every turn ending in 5."""

    def render(self, turns):
        return "".join(f"{r}:{t}" + (f"({turns[0][1]})" if i % 10 == 5 else "") + ";" for i, (r, t) in enumerate(turns))


class Bounded:
    """Drops old texts beyond 100 turns."""

    def render(self, turns):
        return "".join(f"{r}:{'' if len(turns) > 100 and i < len(turns) - 100 else t};"
                       for i, (r, t) in enumerate(turns))


class Pairs(chat.InstTemplate):
    """Declares that a turn looks one turn back."""
    look_back = 1

    def render(self, turns):
        return "".join(f"{t}<{turns[i - 1][0] if i else ''}>" for i, (_, t) in enumerate(turns))


def test_black_boxes_are_rendered_from_the_start_at_any_length():
    turns = [(("user", "assistant")[i % 2], f"text {i}") for i in range(150)]
    found = list(chat.render_turns(Reminding(), iter(turns)))
    assert len(found) == 3 and all(r is None for _, r in found)
    assert "".join(s.text for s, _ in found) == Reminding().render(turns)
    loss = [s.text[a:b] for s, _ in found for a, b in zip(s.loss_starts, s.loss_ends)]
    assert loss == [t for r, t in turns if r == "assistant"]
    (segment, rewrites), = chat.render_turns(Bounded(), iter(turns))
    assert rewrites == 100 and segment.text == Bounded().render(turns)  # the 101st turn
    found = list(chat.render_turns(Bounded(), iter(turns[:100])))
    assert all(r is None for _, r in found) and "".join(s.text for s, _ in found) == Bounded().render(turns[:100])


def test_declared_look_back():
    turns = [(("user", "assistant", "tool")[i % 3], f"text {i}") for i in range(200)]
    found = list(chat.render_turns(Pairs(), iter(turns)))
    assert len(found) == 4 and "".join(s.text for s, _ in found) == Pairs().render(turns)
    liar = type("Liar", (Forgetful,), {"look_back": 3})()
    with pytest.raises(ValueError):
        list(chat.render_turns(liar, iter(turns)))
    assert chat.declared_look_back(T) == 0 and chat.declared_look_back(Numbered()) is None


def test_templates_that_rewrite_history_are_found():
    turns = [("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")]
    (segment, rewrites), = chat.render_turns(Forgetful(), iter(turns))
    assert rewrites == 3 and segment.text == Forgetful().render(turns) and not segment.loss_starts
    (segment, rewrites), = chat.render_turns(Forgetful(), iter(turns[:3]))
    assert rewrites is None


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "a\nb", "[ROLE]"]),
                          st.text(st.sampled_from("<>/s\\[]INSTROLEY ab\n")))))
def test_any_text_comes_back(turns):
    assert T.parse(T.render(turns)) == turns


@pytest.mark.parametrize("text", T.CONTROLS)
def test_no_control_string_is_left_in_a_text(text):
    assert not any(c in T.escape(f"x{text}\\{text}") for c in T.CONTROLS)
