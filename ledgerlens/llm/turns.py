"""Conversation structure repair: cheapest edits that make a conversation's roles a sentence.

The roles of a conversation are parsed by an LR automaton of the role grammar that tolerates faults:
before and instead of each row it may insert, rerole or delete. Alternatives are kept in a
graph-structured stack, whose nodes are (state, node below). After each row equal tops are merged,
and the one with the smallest (cost, audit) stays, so a conversation of any length has as many live
tops as the grammar has stacks.

Rows are examined without their texts: blank, duplicate and truncated are flags, and two texts are
told apart by SHA-256. Conversations are sorted streams inside a task, so neither their rows nor
their texts are ever held together; what grows with a conversation is its audit, one letter an
edit. A second stream takes audits and texts side by side and gives the repaired rows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerlens.session import materialise

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
NAMES = {"u": "user", "a": "assistant"}
SPACES = " \t\n\x0b\x0c\r"
# Sentences: nothing, or a user and an assistant in turn, after at most one system message.
GRAMMAR = (
    ("Talk", ""),
    ("Talk", ("Turns",)),
    ("Turns", ("Asked", "a")),
    ("Asked", ("u",)),
    ("Asked", ("s", "u")),
    ("Asked", ("Turns", "u")),
)
_TAIL = 4096  # letters of an audit that alternatives carry by themselves


class Parser:
    """LR(0) automaton of a grammar and the nodes of its graph-structured stack."""

    def __init__(self, grammar=GRAMMAR):
        self.rules = [(left, tuple(right)) for left, right in grammar]
        self.start = self.rules[0][0]
        self.names = {left for left, _ in self.rules}
        self.terminals = {x for _, right in self.rules for x in right} - self.names
        begin = self._closed({(i, 0) for i, (left, _) in enumerate(self.rules) if left == self.start})
        self.states, self.goto = [begin], {}
        for state in self.states:  # grows
            for symbol in sorted(self.names | self.terminals):
                items = {(i, dot + 1) for i, dot in state if self.rules[i][1][dot : dot + 1] == (symbol,)}
                if not items and not (state is begin and symbol == self.start):
                    continue
                items = self._closed(items)
                if items not in self.states:
                    self.states.append(items)
                self.goto[self.states.index(state), symbol] = self.states.index(items)
        self._nodes: dict = {}
        self._moves: dict = {}
        self.bottom = self._push(0, None)

    def _closed(self, items: set) -> frozenset:
        out, todo = set(items), list(items)
        while todo:
            i, dot = todo.pop()
            for k, (left, _) in enumerate(self.rules):
                if self.rules[i][1][dot : dot + 1] == (left,) and (k, 0) not in out:
                    out.add((k, 0))
                    todo.append((k, 0))
        return frozenset(out)

    def _push(self, state: int, below):
        return self._nodes.setdefault((state, below), (state, below))

    def _reduced(self, node) -> list:
        """The node and what reductions make of it."""
        out = [node]
        for node in out:  # grows
            for i, dot in self.states[node[0]]:
                left, right = self.rules[i]
                if dot < len(right):
                    continue
                base = node
                for _ in right:
                    base = base[1]
                to = self.goto.get((base[0], left))
                made = None if to is None else self._push(to, base)
                if made is not None and made not in out:
                    out.append(made)
        return out

    def accepts(self, node) -> bool:
        whole = self._push(self.goto[0, self.start], self.bottom)
        return whole in self._reduced(node)

    def moves(self, node, terminal: str) -> list:
        """Tops after a terminal: those that can go on, or else those that end a sentence."""
        if (node, terminal) not in self._moves:
            tops = []
            for top in self._reduced(node):
                to = self.goto.get((top[0], terminal))
                if to is not None:
                    tops += self._reduced(self._push(to, top))
            going = [t for t in tops if any((t[0], x) in self.goto for x in self.terminals)]
            self._moves[node, terminal] = going or [t for t in tops if self.accepts(t)]
        return self._moves[node, terminal]


class _Piece:
    """A part of an audit that several alternatives share."""

    __slots__ = ("before", "letters")

    def __init__(self, before, letters):
        self.before, self.letters = before, letters


def _letters(piece, tail: str = "") -> str:
    out = [tail]
    while piece is not None:
        out.append(piece.letters)
        piece = piece.before
    return "".join(reversed(out))


class Repair:
    """Cheapest repair of one conversation, fed row by row."""

    def __init__(self, parser: Parser):
        self.parser = parser
        self._steps: dict = {}
        self.clear()

    def clear(self) -> None:
        # Top of the stack: (cost, shared part of the audit, the rest).
        self.tops = {self.parser.bottom: (0, None, "")}
        self._order: dict = {}
        self._insert()
        self.rows = 0

    def _less(self, a: tuple, b: tuple) -> bool:
        if a[0] != b[0]:
            return a[0] < b[0]
        if a[1] is b[1]:
            return a[2] < b[2]
        # Shared parts that differ in a letter both have stay in that order whatever follows.
        key = a[1], b[1]
        if key not in self._order:
            x, y = _letters(a[1]), _letters(b[1])
            n = min(len(x), len(y))
            self._order[key] = (x > y) - (x < y) if x[:n] != y[:n] else 0
        return self._order[key] < 0 if self._order[key] else _letters(*a[1:]) < _letters(*b[1:])

    def _insert(self) -> None:
        todo = list(self.tops)
        while todo:
            top = todo.pop()
            cost, piece, tail = self.tops[top]
            for role in NAMES:
                for to in self.parser.moves(top, role):
                    new = cost + INSERT, piece, tail + "I"
                    if to not in self.tops or self._less(new, self.tops[to]):
                        self.tops[to] = new
                        todo.append(to)

    def _options(self, top, initial: str, doomed: bool, cut: bool) -> list:
        """(new top, cost, letter) of what may become of a row."""
        key = top, initial, doomed, cut
        if key not in self._steps:
            out, extra = [(top, DELETE, "D")], TRUNCATED if cut else 0
            if not doomed:
                if initial in self.parser.terminals:
                    out += [(to, KEEP + extra, "K") for to in self.parser.moves(top, initial)]
                out += [(to, REROLE + extra, "R") for role in NAMES for to in self.parser.moves(top, role)]
            self._steps[key] = out
        return self._steps[key]

    def add(self, initial: str, doomed: bool, cut: bool) -> None:
        tops: dict = {}
        for top, (cost, piece, tail) in self.tops.items():
            for to, more, letter in self._options(top, initial, doomed, cut):
                new = cost + more, piece, tail + letter
                if to not in tops or self._less(new, tops[to]):
                    tops[to] = new
        self.tops = tops
        self._insert()
        self.rows += 1
        if self.rows % _TAIL == 0:
            self._share()

    def _share(self) -> None:
        """What the audits of alternatives have in common becomes a part they share; a rest that
        stays long becomes a part of its own."""
        for piece in list({id(p): p for _, p, _ in self.tops.values()}.values()):
            mine = [top for top, (_, p, _) in self.tops.items() if p is piece]
            common = commonprefix([self.tops[top][2] for top in mine])
            part = _Piece(piece, common) if len(common) >= _TAIL // 4 else piece
            for top in mine:
                cost, _, tail = self.tops[top]
                tail = tail if part is piece else tail[len(common) :]
                self.tops[top] = (cost, _Piece(part, tail), "") if len(tail) > 2 * _TAIL else (cost, part, tail)

    def best(self) -> tuple[int, str]:
        done = None
        for top, state in self.tops.items():
            if self.parser.accepts(top) and (done is None or self._less(state, done)):
                done = state
        return done[0], _letters(*done[1:])


def _turn_rows(messages: DataFrame, conv: str, turn: str, role: str, text: str, here: str | None) -> DataFrame:
    body = F.coalesce(F.col(text).cast("string"), F.lit(" "))
    return messages.select(
        F.col(conv).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
        body.alias("text"),
        F.sha2(body, 256).alias("digest"),
        (F.lit(True) if here is None else F.coalesce(F.col(here), F.lit(False))).alias("here"),
    )


_ORDER = ("here", "turn", "role", "digest")


def _streamed(rows: DataFrame, *order) -> DataFrame:
    """Rows of a conversation together and in order: sorted on disk by one task each."""
    return rows.repartition("conv").sortWithinPartitions("conv", *(F.col(c).asc_nulls_first() for c in order))


def _columns(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(c.to_pylist() for c in batch.columns), strict=True)


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


class _Audit:
    """Counts and repair of the conversation that streams by."""

    def __init__(self, conv, repair: Repair):
        self.conv, self.repair = conv, repair
        repair.clear()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.least = self.most = self.before = None

    def add(self, turn, initial: str, blank: bool, seen: int, cut: bool) -> None:
        self.illegal += self.before is not None and self.before + initial not in ("su", "ua", "au")
        self.before = initial
        if turn is not None:
            self.turns += turn != self.most
            self.least, self.most = turn if self.least is None else self.least, turn
        copy = not blank and seen > 1
        cut = cut and not blank and not copy
        self.blank += blank
        self.duplicate += copy
        self.truncated += cut
        self.repair.add(initial, blank or copy, cut)

    def row(self) -> tuple:
        cost, audit = self.repair.best()
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


def audits(
    messages: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    here: str | None = None,
) -> DataFrame:
    """One row per conversation: its id, ``gaps``, ``blank``, ``duplicate``, ``truncated``,
    ``illegal``, ``cost`` (longs) and ``audit``, the initials of the cheapest edits in order (Keep,
    Rerole, Delete, Insert; the least string of equally cheap ones).

    Rows stand by turn, null ones first; of one turn by role and then by SHA-256 of the text. A null
    role or text counts as one space. A row's first fault counts: blank; role and text seen earlier
    in the conversation; last character no mark. Blank and repeated rows must be deleted, and
    truncated ones that stay cost more. An empty role has no initial: such a row is kept under no
    role of its own, and makes its neighbours illegal. Rows with a null conversation are one
    conversation. With ``here`` (a boolean column) rows where it is not true are not there, but
    their conversation is: one without rows has zeros and an empty audit. Very long texts and very
    long conversations are streamed. Empty tables give no rows, other columns are not read."""
    rows = _turn_rows(messages, conv, turn, role, text, here)
    bare = F.rtrim("text", F.lit(SPACES))
    # One copy of a role and text comes first, however many there are: a running number, not a list.
    copies = Window.partitionBy("conv", "here", "role", "digest").orderBy(F.col("turn").asc_nulls_first())
    flagged = rows.select(
        "conv", "turn", "role", "digest", "here", F.substring("role", 1, 1).alias("initial"),
        (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    ).withColumn("seen", F.row_number().over(copies))
    ordered = _streamed(flagged, *_ORDER, "seen").select("conv", "here", "turn", "initial", "blank", "seen", "cut")
    schema = T.StructType(
        [T.StructField(conv, ordered.schema["conv"].dataType), *(T.StructField(c, T.LongType()) for c in COUNTS), T.StructField("audit", T.StringType())]
    )
    arrow = to_arrow_schema(schema)

    def run(batches):
        repair, now, done = Repair(Parser()), None, []
        for batch in batches:
            for key, there, *row in _columns(batch):
                if now is None or key != now.conv:
                    if now is not None:
                        done.append(now.row())
                    now = _Audit(key, repair)
                if there:
                    now.add(*row)
            yield _batch(done, arrow)
            done = []
        if now is not None:
            yield _batch([now.row()], arrow)

    return ordered.mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def repaired(
    messages: DataFrame,
    audited: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    here: str | None = None,
) -> DataFrame:
    """The rows of the repaired conversations: id, ``position`` (from 0), ``role``, ``text``,
    ``edit`` (K, R or I) and ``turn`` (of the row it was; null for an inserted one, whose text is
    empty). ``audited`` comes from ``audits`` of the same rows. A conversation's rows follow each
    other in order inside a partition; one that ends empty has none."""
    rows = _turn_rows(messages, conv, turn, role, text, here).where("here")
    plans = audited.select(F.col(conv).alias("conv"), F.lit(False).alias("here"), F.col("audit").alias("text"))
    both = rows.unionByName(plans, allowMissingColumns=True)
    ordered = _streamed(both, *_ORDER).select("conv", "here", "turn", "role", "text")
    schema = T.StructType(
        [
            T.StructField(conv, ordered.schema["conv"].dataType),
            T.StructField("position", T.LongType()),
            T.StructField("role", T.StringType()),
            T.StructField("text", T.StringType()),
            T.StructField("edit", T.StringType()),
            T.StructField("turn", T.LongType()),
        ]
    )
    arrow = to_arrow_schema(schema)

    def run(batches):
        state = None
        for batch in batches:
            out = []
            for key, is_row, at, name, body in _columns(batch):
                if not is_row:
                    state = _Replay(key, body)
                    out += state.inserted()
                else:
                    out += state.edited(at, name, body)
                    out += state.inserted()
            yield _batch(out, arrow)

    return ordered.mapInArrow(run, schema)


class _Replay:
    """Applies an audit to the rows that stream by. An edit's role follows from its place, as users
    and assistants alternate after a system message."""

    def __init__(self, conv, audit: str):
        self.conv, self.audit = conv, audit
        self.at = self.position = 0
        self.system = False

    def _made(self, role, body, letter, turn) -> tuple:
        self.position += 1
        return self.conv, self.position - 1, role, body, letter, turn

    def _next_role(self) -> str:
        return NAMES["ua"[(self.position - self.system) % 2]]

    def inserted(self) -> Iterator[tuple]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield self._made(self._next_role(), "", "I", None)

    def edited(self, turn, role: str, body: str) -> Iterator[tuple]:
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self.system |= self.position == 0 and role[:1] == "s"
            yield self._made(role, body, "K", turn)
        elif letter == "R":
            yield self._made(self._next_role(), body, "R", turn)


def digests(fixed: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(id, sha256) of each repaired conversation's ``role:text`` lines, read in the order in which
    ``repaired`` gives them: one digest in memory."""
    schema = T.StructType([fixed.schema[conv], T.StructField("sha256", T.StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches):
        key = sha = None
        for batch in batches:
            done = []
            for conv_id, position, role, body in _columns(batch):
                line = f"{role}:{body}".encode()
                if position == 0:
                    if sha is not None:
                        done.append((key, sha.hexdigest()))
                    key, sha = conv_id, hashlib.sha256(line)
                else:
                    sha.update(b"\n" + line)
            yield _batch(done, arrow)
        if sha is not None:
            yield _batch([(key, sha.hexdigest())], arrow)

    return fixed.select(conv, "position", "role", "text").mapInArrow(run, schema)


def repair_digests(messages: DataFrame, conv: str = "conv_id", here: str | None = None, **columns: str) -> DataFrame:
    """``audits`` with ``repaired_sha256``, the digest of the repaired ``role:text`` lines."""
    audited = materialise(audits(messages, conv, here=here, **columns))
    lines = digests(repaired(messages, audited, conv, here=here, **columns), conv).withColumnRenamed(conv, "__conv")
    joined = audited.join(lines, F.col(conv).eqNullSafe(F.col("__conv")), "left")
    empty = hashlib.sha256().hexdigest()
    return joined.select(conv, *COUNTS, "audit", F.coalesce("sha256", F.lit(empty)).alias("repaired_sha256"))


def damaged(
    messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The rows with faults by checksum of ``conv:turn``, one in twenty each: dropped (``here`` is
    false), emptied, without marks, repeated, given to the user. Nulls are one space first."""

    def filled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.crc32(F.encode(F.concat(filled(conv), F.lit(":"), filled(turn)), "utf-8")) % 20
    body = F.when(fault == 1, "").when(fault == 2, F.translate(filled(text), ".!?", "")).otherwise(filled(text))
    copies = F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return messages.select(
        F.col(conv),
        F.col(turn),
        F.when(fault == 4, "user").otherwise(filled(role)).alias(role),
        body.alias(text),
        (fault != 0).alias("here"),
        F.explode(copies).alias("copy"),
    ).drop("copy")
