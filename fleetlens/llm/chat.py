"""Chat formatting by incremental rendering of a black-box template.

A template is anything with ``render(turns) -> str`` for a list of (role,
text).  Each conversation is rendered turn by turn: where the output of a
prefix starts with the output of the prefix before, the rest is the turn's
span.  Where it does not, the template rewrites history: the conversation is
marked so from that turn on and has no spans there.  The text's place within
its turn is found the same way, from two renderings that differ in the text.

A template may declare ``look_back``, in the class that defines ``render``: a
turn's output depends on so many turns before it and never changes theirs.
Its conversations are rendered in segments of ``SEGMENT`` turns, each started
anew from that context, in memory for one segment; if it rewrites a turn of a
segment all the same, that is an error.  Any other template is a black box: every prefix is
rendered from the start, whatever the length, so a rewrite of any earlier turn
is found.  That takes time with the square of the turns and memory for the
conversation.  A conversation is a stream of rows in one task; its output is a
row per segment.

Defined results: a NULL text or role is empty; rows without a conversation id
form one conversation; turns without a number come last; rows of one turn
number follow in the order of role and text; repeated rows are repeated turns;
extra columns are not read; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import bounded_batches

SEGMENT = 64  # turns

FORMATTED = ("conv_id bigint, segment int, text string, starts array<int>, ends array<int>, "
             "loss_starts array<int>, loss_ends array<int>, rewrites_from bigint")


class InstTemplate:
    """Turns marked by ``[INST]`` and ``</s>``.  Control strings inside a text
    get a backslash behind their first character (one more, if there are some
    already), so no text can open or close a turn and the text comes back."""

    # The control strings of the format.
    CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "<<SYS>>", "<</SYS>>")
    BEGIN = "<s>"
    look_back = 0

    def __init__(self):
        parts = "|".join(re.escape(c[0]) + r"\\*" + re.escape(c[1:]) for c in self.CONTROLS)
        self._plain = re.compile(parts)
        self._marks = {"system": ("<<SYS>>\n", "\n<</SYS>>\n"), "user": ("[INST] ", " [/INST]"),
                       "assistant": (" ", " </s>")}

    def escape(self, text: str) -> str:
        return self._plain.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)

    def unescape(self, text: str) -> str:
        return self._plain.sub(lambda m: m[0][0] + m[0][2:] if m[0][1] == "\\" else m[0], text)

    def render(self, turns: list[tuple[str, str]]) -> str:
        out = [self.BEGIN]
        for role, text in turns:
            if role in self._marks:
                head, tail = self._marks[role]
            else:
                head, tail = f"[ROLE] {self.escape(json.dumps(role))}\n", " [/ROLE]"
            out += [head, self.escape(text), tail]
        return "".join(out)

    def parse(self, text: str) -> list[tuple[str, str]]:
        """The turns of an output, its beginning mark or not."""
        at, turns = len(self.BEGIN) if text.startswith(self.BEGIN) else 0, []
        while at < len(text):
            for role, (head, tail) in self._marks.items():
                if text.startswith(head, at):
                    break
            else:
                line = text.index("\n", at)
                role = json.loads(self.unescape(text[at + len("[ROLE] "):line]))
                head, tail = text[at:line + 1], " [/ROLE]"
            end = text.index(tail, at + len(head))
            turns.append((role, self.unescape(text[at + len(head):end])))
            at = end + len(tail)
        return turns


@dataclass
class Segment:
    """Output of some turns in a row; spans count within ``text``."""

    text: str = ""
    starts: list[int] = field(default_factory=list)
    ends: list[int] = field(default_factory=list)
    loss_starts: list[int] = field(default_factory=list)
    loss_ends: list[int] = field(default_factory=list)


def _content(template, before: list, role: str, turn: str, offset: int) -> tuple[int, int]:
    """Where a turn's text lies within its output ``turn``, which begins at
    ``offset``: what two renderings of other texts have in common is not it."""
    a, b = template.render([*before, (role, "0")])[offset:], template.render([*before, (role, "1")])[offset:]
    head = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    tail = next((i for i, (x, y) in enumerate(zip(reversed(a), reversed(b))) if x != y), len(a) - head)
    return head, max(head, len(turn) - tail)


def declared_look_back(template) -> int | None:
    """``look_back`` as declared together with ``render`` or by a subclass
    after it; a subclass that renders in its own way declares its own."""
    for cls in type(template).__mro__:
        if "look_back" in vars(cls):
            return cls.look_back
        if "render" in vars(cls):
            return None
    return None


def render_turns(template, turns: Iterator[tuple[str, str]], loss_roles=("assistant",)) -> Iterator[tuple[Segment, int | None]]:
    """Segments of one conversation, and the turn (from 0) from which the
    template rewrote history (None: never)."""
    look_back = declared_look_back(template)
    recent: list[tuple[str, str]] = []
    held: list[Segment] = []  # of a black box: a later turn may rewrite them
    before = template.render([])
    segment, done = Segment(before), 0
    rewrites = None
    for number, (role, text) in enumerate(turns):
        if rewrites is not None:
            recent.append((role, text))
            continue
        if done >= SEGMENT:
            if look_back is None:
                held.append(segment)
            else:
                yield segment, None
                recent = recent[len(recent) - look_back:] if look_back else []
                before = template.render(recent)
            segment, done = Segment(), 0
        output = template.render([*recent, (role, text)])
        if not output.startswith(before):
            if look_back is not None:
                raise ValueError(f"the template declares a look-back of {look_back}, but turn {number} rewrites others")
            rewrites = number
            recent.append((role, text))
            continue
        last = output[len(before):]
        at = len(segment.text)
        segment.starts.append(at)
        segment.ends.append(at + len(last))
        if role in loss_roles:
            head, end = _content(template, recent, role, last, len(before))
            segment.loss_starts.append(at + head)
            segment.loss_ends.append(at + end)
        segment.text += last
        recent.append((role, text))
        before, done = output, done + 1
    if rewrites is not None:  # the whole output as it is, without spans
        held, segment = [], Segment(template.render(recent))
    for s in [*held, segment]:
        yield s, rewrites


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


def _groups(rows: Iterator[tuple]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """Consecutive rows of one first value, as a stream each."""
    from itertools import groupby
    return groupby(rows, key=lambda r: r[0])


def _tables(rows: Iterator[tuple], schema: pa.Schema, size: int = 512) -> Iterator[pa.RecordBatch]:
    rows = iter(rows)
    while part := [r for _, r in zip(range(size), rows)]:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)


_FORMATTED = pa.schema([("conv_id", pa.int64()), ("segment", pa.int32()), ("text", pa.string()),
                        *((c, pa.list_(pa.int32())) for c in ("starts", "ends", "loss_starts", "loss_ends")),
                        ("rewrites_from", pa.int64())])


def format_conversations(turns: DataFrame, template=None, *, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per segment of each conversation (:data:`FORMATTED`)."""
    template = template or InstTemplate()
    ordered = (bounded_batches(turns).select(F.col(conv_col).cast("bigint").alias("conv_id"), F.col(turn_col).alias("turn"),
                            F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                            F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
               .repartition("conv_id")
               .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_last(), "role", "text")
               .select("conv_id", "role", "text"))

    def rows(batches):
        for conv, group in _groups(_rows(batches)):
            for k, (s, rewrites) in enumerate(render_turns(template, ((r[1], r[2]) for r in group))):
                yield conv, k, s.text, s.starts, s.ends, s.loss_starts, s.loss_ends, rewrites

    return ordered.mapInArrow(lambda batches: _tables(rows(batches), _FORMATTED), FORMATTED)


_DIGESTS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                      ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def read_back(formatted: DataFrame, template: InstTemplate | None = None) -> DataFrame:
    """Figures of each conversation, from its formatted segments alone: the
    turns parsed out of the text, and the text under the loss spans."""
    template = template or InstTemplate()
    ordered = (formatted.select("conv_id", "segment", "text", "loss_starts", "loss_ends")
               .repartition("conv_id").sortWithinPartitions("conv_id", "segment"))

    def rows(batches):
        for conv, group in _groups(_rows(batches)):
            all_turns, loss = hashlib.sha256(), hashlib.sha256()
            n_turns = loss_chars = chars = 0
            for _, _, text, starts, ends in group:
                for role, content in template.parse(text):
                    all_turns.update(f"{role}\n{content}\n".encode())
                    n_turns += 1
                for a, b in zip(starts, ends):
                    content = template.unescape(text[a:b])
                    loss.update(content.encode())
                    loss_chars += len(content)
                chars += len(text)
            yield conv, n_turns, all_turns.hexdigest(), loss_chars, loss.hexdigest(), chars

    return ordered.mapInArrow(lambda batches: _tables(rows(batches), _DIGESTS),
                              "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                              "loss_sha256 string, formatted_chars bigint")
