"""Chat formatting by incremental black-box rendering.

A template is any function from a list of turns to a text. It is rendered on
successive turn prefixes, and consecutive outputs are compared: what the longer
output adds behind the shorter one is the span of the new turn. If the shorter
output is not a prefix of the longer one, the template rewrites history; this
is reported, and the spans of the earlier turns are cut back to what stayed.

Conversations are streamed in turn order. A black-box template is rendered on
whole prefixes whatever their length, as it may look at any turn before: memory
is a conversation's output, work grows with the square of its turns, and every
rewrite is seen. A template declared local to its turns (``turn_local``) gives a
turn the same span after one turn of context as after all; its prefixes grow to
``WINDOW`` turns, and a longer conversation goes on with its last turn as the
beginning of the next window, so work and memory per turn are bounded. The
declaration is checked on that turn.

Cases: a null text or role is an empty one; turns with the same number are
ordered by role and text and kept all; rows of a null conversation form one
conversation; an empty table gives no row; any control string inside a text or
a role is escaped and read back as it was.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.llm.rows import quoted

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]
#: Turns of a template local to its turns that are rendered as one growing prefix.
WINDOW = 128

# The control strings of the template.
HEAD, TAIL = "### ", "</turn>"


# -- the template ----------------------------------------------------------
def escape(text: str) -> str:
    """A backslash goes before every backslash and into every control string."""
    return text.replace("\\", "\\\\").replace(HEAD, "#\\## ").replace(TAIL, "<\\/turn>")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


def marked(turns: list[Turn]) -> str:
    """``### Role:`` line, escaped text, ``</turn>`` line, for each turn."""
    return "".join(f"{HEAD}{escape(role).replace(':', chr(92) + ':')}:\n{escape(text)}{TAIL}\n" for role, text in turns)


def turn_local(template: Template) -> Template:
    """Declare that a template gives each turn a span that no turn but the one before it bears on."""
    template.turn_local = True
    return template


turn_local(marked)

PIECE = re.compile(re.escape(HEAD) + r"((?:[^\\:]|\\.)*):\n(.*)" + re.escape(TAIL) + "\n", re.S)


def read_marked(span: str) -> tuple[str, str, int, int]:
    """Role and text of a turn's span, and where its escaped text begins and ends in it."""
    piece = PIECE.fullmatch(span)
    if piece is None:
        raise ValueError("not the span of one turn")
    return unescape(piece[1]), unescape(piece[2]), piece.start(2), piece.end(2)


# -- spans -----------------------------------------------------------------
def common_prefix(a: str, b: str) -> int:
    if b.startswith(a):
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid - 1)
    return low


@dataclass
class Rendering:
    """Output so far, of a window if the template is local, where each of its turns begins, and what was seen."""
    template: Template
    window: int = WINDOW
    turns: list[Turn] = field(default_factory=list)
    starts: list[int] = field(default_factory=list)
    output: str = ""
    carried: int = 0
    rewritten: int = 0

    def add(self, turn: Turn) -> None:
        self.turns.append(turn)
        longer = self.template(self.turns)
        kept = common_prefix(self.output, longer)
        if kept < len(self.output):
            self.rewritten += 1
            self.starts = [min(s, kept) for s in self.starts]
        self.starts.append(kept)
        self.output = longer

    def full(self) -> bool:
        return getattr(self.template, "turn_local", False) and len(self.turns) >= self.window

    def spans(self) -> list[str]:
        """Spans of this window's own turns."""
        ends = [*self.starts[1:], len(self.output)]
        return [self.output[a:b] for a, b in zip(self.starts, ends)][self.carried:]

    def restarted(self) -> "Rendering":
        """The next window: it begins with the last turn."""
        last = self.spans()[-1]
        fresh = Rendering(self.template, self.window, carried=1, rewritten=self.rewritten)
        fresh.add(self.turns[-1])
        fresh.rewritten += not fresh.output.endswith(last)
        return fresh


def render(turns: list[Turn], template: Template = marked, window: int = WINDOW) -> tuple[list[str], int]:
    """Spans of all turns and how many turns rewrote what stood before them."""
    now, spans = Rendering(template, window), []
    for turn in turns:
        if now.full():
            spans += now.spans()
            now = now.restarted()
        now.add(turn)
    return spans + now.spans(), now.rewritten


# -- conversations ---------------------------------------------------------
class Digest:
    """Reads back one conversation's spans; keeps sums and digests only."""

    def __init__(self, read, train_role):
        self.read, self.train_role = read, train_role
        self.n, self.loss, self.size = 0, 0, 0
        self.turns, self.masked = hashlib.sha256(), hashlib.sha256()

    def take(self, span: str) -> None:
        role, text, start, end = self.read(span)
        self.n += 1
        self.size += len(span)
        self.turns.update(f"{role}\n{text}\n".encode())
        if role == self.train_role:
            under_mask = unescape(span[start:end])
            self.loss += len(under_mask)
            self.masked.update(under_mask.encode())


def _ordered(df: DataFrame, conv_col, turn_col, role_col, text_col) -> DataFrame:
    rows = df.select(F.col(quoted(conv_col)).alias("conv"), F.col(quoted(turn_col)).alias("turn"),
                     F.coalesce(F.col(quoted(role_col)).cast("string"), F.lit("")).alias("role"),
                     F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit("")).alias("text"))
    return rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch.column(i).to_pylist() for i in range(4)])


def format_turns(df: DataFrame, template: Template = marked, window: int = WINDOW, conv_col: str = "conv_id",
                 turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv, turn, role, formatted, rewritten``: each turn's span of the output, in order within a conversation.

    ``rewritten`` counts the turns so far that changed the output before them.
    """
    source = _ordered(df, conv_col, turn_col, role_col, text_col)

    def run(batches):
        def pieces():
            conv, now, held = object(), None, []
            for c, turn, role, text in _turns(batches):
                if c != conv or now.full():
                    if now is not None:
                        yield from zip(held, now.spans(), [now.rewritten] * len(held))
                    now, held, conv = (Rendering(template, window) if c != conv else now.restarted()), [], c
                now.add((role, text))
                held.append((c, turn, role))
            if now is not None:
                yield from zip(held, now.spans(), [now.rewritten] * len(held))

        rows = [[] for _ in range(5)]
        for (c, turn, role), span, rewritten in pieces():
            for column, value in zip(rows, (c, turn, role, span, rewritten)):
                column.append(value)
            if len(rows[0]) >= 1000:
                yield batch_of(rows)
                rows = [[] for _ in range(5)]
        yield batch_of(rows)

    kinds = [source.schema[c].dataType.simpleString() for c in ("conv", "turn")]

    def batch_of(rows):
        types = [pa.int64() if k == "bigint" else pa.int32() if k == "int" else pa.string() for k in kinds]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(rows, [*types, pa.string(), pa.string(), pa.int64()])],
            names=["conv", "turn", "role", "formatted", "rewritten"])

    return source.mapInArrow(run, f"conv {kinds[0]}, turn {kinds[1]}, role string, formatted string, rewritten long")


def format_conversations(df: DataFrame, template: Template = marked, read=read_marked, train_role: str = "assistant",
                         window: int = WINDOW, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation, read back from the formatted output.

    ``conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars,
    rewritten``: digests of all roles and texts and of the text under the loss
    mask, which covers the texts of ``train_role``.
    """
    source = _ordered(df, conv_col, turn_col, role_col, text_col)
    kind = source.schema["conv"].dataType.simpleString()
    own = {"bigint": pa.int64(), "int": pa.int32()}.get(kind, pa.string())
    types = [own, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewritten"]

    def run(batches):
        done = []

        def flush(now, digest):
            for span in now.spans():
                digest.take(span)

        conv, now, digest = object(), None, None
        for c, _, role, text in _turns(batches):
            if now is not None and (c != conv or now.full()):
                flush(now, digest)
            if c != conv:
                if now is not None:
                    done.append((conv, digest, now.rewritten))
                conv, now, digest = c, Rendering(template, window), Digest(read, train_role)
            elif now.full():
                now = now.restarted()
            now.add((role, text))
            if len(done) >= 1000:
                yield batch_of(done)
                done = []
        if now is not None:
            flush(now, digest)
            done.append((conv, digest, now.rewritten))
        yield batch_of(done)

    def batch_of(done):
        rows = [(c, d.n, d.turns.hexdigest(), d.loss, d.masked.hexdigest(), d.size, r) for c, d, r in done]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    return source.mapInArrow(run, f"conv {kind}, n_turns long, turns_sha256 string, loss_chars long, "
                                  "loss_sha256 string, formatted_chars long, rewritten long")
