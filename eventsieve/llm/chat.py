"""Chat formatting with a compiled template language.

A template is text with ``{{ expression }}`` and ``{% statement %}`` parts. Statements are ``if``,
``elif``, ``else``, ``endif``, ``generation`` and ``endgeneration``; expressions are strings,
``message.role``, ``message.text``, ``first``, ``==``, ``!=``, ``not``, ``and``, ``or``, ``+`` and
the filter ``| escape``. The source is parsed to a syntax tree, constants are folded (branches that
can't run go, neighbouring constants join), and the tree becomes Python closures. Nothing else can
be named, so a template can't reach the interpreter.

A conversation is rendered turn by turn. A turn gives its formatted text and the spans of that text
between generation markers; these spans are the loss mask. Turns are read back from the formatted
text alone.

Control strings inside texts and roles are escaped: a backslash goes after the first character of a
control string, and a control string that already has backslashes there gets one more, so escaping
is reversible.

Turns are rendered and read back where they are read, before any shuffle, so a conversation of any
length is spread over all tasks. Only a template that names ``first`` needs to know each conversation's
first row; it is found by an aggregate and joined back on row numbers, which spread as well. What a
conversation's digests take is then sorted by turn and streamed: that task holds one batch at a time and
does nothing but hash, which can't be split, since a SHA-256 reads its bytes in order.

Defined results: a null text is empty and a null role is the empty role; a null conv_id is a
conversation of its own; turns of equal number go by role, then text; repeated rows are repeated
turns; a null turn comes first; an empty table gives an empty result. Other columns are left alone.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, staged

#: The control strings of the default template.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<ROLE>>", "<</ROLE>>")
TEMPLATE = (
    "{% if message.role == 'user' %}<s>[INST]{{ message.text | escape }}[/INST]"
    "{% elif message.role == 'assistant' %}{% generation %}{{ message.text | escape }}{% endgeneration %}</s>"
    "{% elif message.role == 'system' %}<<SYS>>{{ message.text | escape }}<</SYS>>"
    "{% else %}<<ROLE>>{{ message.role | escape }}<</ROLE>>{{ message.text | escape }}</s>{% endif %}"
)

_BODY = "|".join(re.escape(c[1:]) for c in sorted(CONTROLS, key=len, reverse=True))
_CONTROL = re.compile(rf"([<\[])(\\*)(?={_BODY})")
_ESCAPED = re.compile(rf"([<\[])\\(\\*)(?={_BODY})")


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


# --- template language: tokens, tree, folding, closures ---------------------------------------

_PARTS = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_TOKENS = re.compile(r"\s*(?:('[^']*'|\"[^\"]*\")|([A-Za-z_][\w.]*)|(==|!=|[+|()]))")
NAMES = ("message.role", "message.text", "first")
Node = tuple


class TemplateError(ValueError):
    """The template names or does something that the language doesn't have."""


class _Expression:
    """Recursive descent over one expression: or, and, not, comparison, +, filter."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.strip()
        while at < len(source):
            m = _TOKENS.match(source, at)
            if not m:
                raise TemplateError(f"can't read {source[at:]!r}")
            self.tokens.append(m.group().strip())
            at = m.end()
        self.at = 0

    def take(self, *wanted: str) -> str | None:
        if self.at < len(self.tokens) and (not wanted or self.tokens[self.at] in wanted):
            self.at += 1
            return self.tokens[self.at - 1]
        return None

    def parse(self) -> Node:
        node = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at]!r}")
        return node

    def either(self) -> Node:
        node = self.both()
        while self.take("or"):
            node = ("or", node, self.both())
        return node

    def both(self) -> Node:
        node = self.negated()
        while self.take("and"):
            node = ("and", node, self.negated())
        return node

    def negated(self) -> Node:
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self) -> Node:
        node = self.joined()
        while op := self.take("==", "!="):
            node = (op, node, self.joined())
        return node

    def joined(self) -> Node:
        node = self.filtered()
        while self.take("+"):
            node = ("+", node, self.filtered())
        return node

    def filtered(self) -> Node:
        node = self.single()
        while self.take("|"):
            if (name := self.take()) != "escape":
                raise TemplateError(f"no filter {name!r}")
            node = ("escape", node)
        return node

    def single(self) -> Node:
        token = self.take()
        if token is None:
            raise TemplateError("an expression ends too early")
        if token == "(":
            node = self.either()
            if not self.take(")"):
                raise TemplateError("a bracket isn't closed")
            return node
        if token[0] in "'\"":
            return ("const", token[1:-1])
        if token not in NAMES:
            raise TemplateError(f"no name {token!r}")
        return ("name", token)


def parse(source: str) -> Node:
    """The syntax tree of a template: ("block", parts...)."""
    parts, at = [], 0
    for m in _PARTS.finditer(source):
        if m.start() > at:
            parts.append(("text", source[at : m.start()]))
        if m.group(1) is not None:
            parts.append(("show", _Expression(m.group(1)).parse()))
        else:
            word, _, rest = m.group(2).strip().partition(" ")
            parts.append(("mark", word, rest))
        at = m.end()
    if at < len(source):
        parts.append(("text", source[at:]))
    node, left = _block(parts, ())
    if left:
        raise TemplateError(f"unexpected {left[0][1]!r}")
    return node


def _block(parts: list, ends: tuple[str, ...]) -> tuple[Node, list]:
    out = []
    while parts:
        p, rest = parts[0], parts[1:]
        if p[0] == "text":
            out.append(("show", ("const", p[1])))
        elif p[0] == "show":
            out.append(p)
        elif p[1] in ends:
            return ("block", *out), parts
        elif p[1] == "if":
            node, rest = _if(p[2], rest)
            out.append(node)
        elif p[1] == "generation":
            body, rest = _block(rest, ("endgeneration",))
            rest = rest[1:] if rest else _missing("endgeneration")
            out.append(("generation", body))
        else:
            raise TemplateError(f"no statement {p[1]!r}")
        parts = rest
    return (("block", *out), []) if not ends else _missing(ends[-1])


def _missing(word: str):
    raise TemplateError(f"{word!r} is missing")


def _if(test: str, parts: list) -> tuple[Node, list]:
    body, parts = _block(parts, ("elif", "else", "endif"))
    mark, parts = parts[0], parts[1:]
    other: Node = ("block",)
    if mark[1] == "elif":
        node, parts = _if(mark[2], parts)
        other = ("block", node)
    elif mark[1] == "else":
        other, parts = _block(parts, ("endif",))
        parts = parts[1:]
    return ("if", _Expression(test).parse(), body, other), parts


def fold(node: Node) -> Node:
    """The same tree with constants worked out, dead branches gone and neighbouring texts joined."""
    kind, *inner = node
    if kind in ("const", "name"):
        return node
    if kind == "block":
        out: list[Node] = []
        for part in map(fold, inner):
            for p in part[1:] if part[0] == "block" else (part,):
                if p[0] == out[-1][0] == "show" and p[1][0] == out[-1][1][0] == "const" if out else False:
                    out[-1] = ("show", ("const", out[-1][1][1] + p[1][1]))
                elif p != ("show", ("const", "")):
                    out.append(p)
        return ("block", *out)
    if kind == "if":
        test = fold(inner[0])
        if test[0] == "const":
            return fold(inner[1] if test[1] else inner[2])
        return ("if", test, fold(inner[1]), fold(inner[2]))
    folded = tuple(map(fold, inner))
    if kind not in ("show", "generation") and all(x[0] == "const" for x in folded):
        return ("const", _value((kind, *folded))(None))
    return (kind, *folded)


def _value(node: Node) -> Callable:
    """Closure from a turn (role, text, first) to the expression's value."""
    kind, *inner = node
    if kind == "const":
        return lambda turn, v=inner[0]: v
    if kind == "name":
        return lambda turn, k=NAMES.index(inner[0]): turn[k]
    f = [_value(x) for x in inner]
    return {
        "or": lambda turn: f[0](turn) or f[1](turn),
        "and": lambda turn: f[0](turn) and f[1](turn),
        "not": lambda turn: not f[0](turn),
        "==": lambda turn: f[0](turn) == f[1](turn),
        "!=": lambda turn: f[0](turn) != f[1](turn),
        "+": lambda turn: f[0](turn) + f[1](turn),
        "escape": lambda turn: escape(f[0](turn)),
    }[kind]


def _writer(node: Node) -> Callable:
    """Closure that appends a node's output to a list of (text, inside generation) parts."""
    kind, *inner = node
    if kind == "show":
        value = _value(inner[0])
        return lambda turn, out, gen: out.append((value(turn), gen))
    if kind == "generation":
        body = _writer(inner[0])
        return lambda turn, out, gen: body(turn, out, True)
    if kind == "if":
        test, yes, no = _value(inner[0]), _writer(inner[1]), _writer(inner[2])
        return lambda turn, out, gen: (yes if test(turn) else no)(turn, out, gen)
    writers = [_writer(x) for x in inner]

    def block(turn, out, gen):
        for w in writers:
            w(turn, out, gen)

    return block


def compile_template(source: str = TEMPLATE) -> Callable[[str, str, bool], list[tuple[str, bool]]]:
    """(role, text, first) -> parts of the formatted turn, each with its place in the loss mask."""
    write = _writer(fold(parse(source)))

    def render(role: str, text: str, first: bool) -> list[tuple[str, bool]]:
        out: list[tuple[str, bool]] = []
        write((role, text, first), out, False)
        return out

    return render


# --- reading back ------------------------------------------------------------------------------

_TURN = re.compile(
    r"<s>\[INST\](?P<user>.*?)\[/INST\]|<<SYS>>(?P<system>.*?)<</SYS>>"
    r"|<<ROLE>>(?P<role>.*?)<</ROLE>>(?P<other>.*?)</s>|(?P<assistant>.*?)</s>", re.S)


def read_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of every turn of a text made by the default template."""
    at = 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError("not a formatted conversation")
        kind = m.lastgroup
        yield (unescape(m["role"]) if kind == "other" else kind), unescape(m[kind])
        at = m.end()


# --- Spark -------------------------------------------------------------------------------------

SCHEMA = "conv_id long, turn long, formatted string, loss array<struct<start:int,end:int>>"
#: A turn as it reads back: its text under the loss mask is null where that is the whole text.
READ = "conv string, turn long, part int, role string, said string, loss string, chars long"


def _names(node: Node) -> set[str]:
    """The names that a folded tree asks for."""
    kind, *inner = node
    if kind == "name":
        return {inner[0]}
    return set().union(*[_names(x) for x in inner if isinstance(x, tuple)])


def _with_first(rows: DataFrame) -> DataFrame:
    """``rows`` with ``first``: true for one row of each conversation, the least by turn, role and text."""
    rows = staged(rows.withColumn("_id", F.monotonically_increasing_id()), "chat-turns")
    least = rows.groupBy("conv_id").agg(F.min(F.struct("turn", "role", "text", "_id")).alias("_m"))
    least = staged(least.select("_m._id", F.lit(True).alias("_first")), "chat-first")
    return rows.join(least, "_id", "left").withColumn("first", F.coalesce("_first", F.lit(False))).drop("_id", "_first")


def format_turns(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """One row per turn: the formatted text, and the spans of it under the loss mask. The turns' texts, by
    turn (then role and text as they read back), are the formatted conversation."""
    small_batches(conversations.sparkSession)
    rows = conversations.select(
        F.col("conv_id").cast("string").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    if "first" in _names(fold(parse(template))):
        rows = _with_first(rows)
    else:
        rows = rows.withColumn("first", F.lit(False))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        render = compile_template(template)
        for batch in batches:
            texts, masks = [], []
            for role, text, first in zip(batch["role"], batch["text"], batch["first"]):
                at, spans, out = 0, [], []
                for part, loss in render(role, text, bool(first)):
                    if loss:
                        spans.append({"start": at, "end": at + len(part)})
                    at += len(part)
                    out.append(part)
                texts.append("".join(out))
                masks.append(spans)
            # ids travel as text, so null stays apart from numbers
            ids = pd.Series([None if c is None else int(c) for c in batch["conv_id"]], dtype="Int64")
            turns = pd.Series(batch["turn"].to_numpy(), dtype="Int64")
            yield pd.DataFrame({"conv_id": ids, "turn": turns, "formatted": texts, "loss": masks})

    return rows.mapInPandas(run, SCHEMA)


def read_back(formatted: DataFrame) -> DataFrame:
    """The turns of ``format_turns`` (default template), read from the formatted text and the mask alone."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for conv, turn, text, spans in zip(batch["conv"], batch["turn"], batch["formatted"], batch["loss"]):
                masked = "".join([unescape(text[s["start"] : s["end"]]) for s in spans])
                for k, (role, said) in enumerate(read_turns(text)):
                    loss, chars = ("", 0) if k else (masked, len(text))  # a row is one turn; both are the row's
                    out.append((conv, turn, k, role, said, None if loss == said else loss, chars))
            frame = pd.DataFrame(out, columns=["conv", "turn", "part", "role", "said", "loss", "chars"])
            frame["turn"] = pd.Series([None if pd.isna(t) else int(t) for t in frame["turn"]], dtype="Int64")
            yield frame

    rows = formatted.select(F.col("conv_id").cast("string").alias("conv"), "turn", "formatted", "loss")
    return rows.mapInPandas(run, READ)


@dataclass
class _Digest:
    """What is kept of one conversation while its turns stream by."""

    conv: object
    n: int = 0
    loss: int = 0
    chars: int = 0

    def __post_init__(self):
        self.turns, self.mask = hashlib.sha256(), hashlib.sha256()

    def row(self) -> tuple:
        return self.conv, self.n, self.turns.hexdigest(), self.loss, self.mask.hexdigest(), self.chars


DIGEST = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame([r[1:] for r in rows], columns=DIGEST[1:])
    out.insert(0, "conv_id", pd.Series([None if r[0] is None else int(r[0]) for r in rows], dtype="Int64"))
    return out


def digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, of its turns as they read back."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now: _Digest | None = None
        for batch in batches:
            done = []
            for conv, role, said, loss, chars in zip(*[batch[c] for c in ("conv", "role", "said", "loss", "chars")]):
                if now is None or now.conv != conv:
                    if now is not None:
                        done.append(now.row())
                    now = _Digest(conv)
                loss = said if loss is None else loss
                now.n += 1
                now.turns.update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                now.loss += len(loss)
                now.mask.update(loss.encode("utf-8", "surrogatepass"))
                now.chars += int(chars)
            if done:
                yield _frame(done)
        if now is not None:
            yield _frame([now.row()])

    turns = read_back(formatted).repartition("conv").sortWithinPartitions("conv", "turn", "role", "said", "part")
    return turns.mapInPandas(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
