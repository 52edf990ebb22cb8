"""Structure repair of conversations by a Viterbi search whose survivors coalesce.

A repaired conversation has roles ``(s?(ua)+)?`` by their initials, and a search over the
automaton of that pattern finds the cheapest edits. Rows are read in order, each once. Per
state the cheapest way so far survives, as a leaf of a tree of back pointers. A node counts
its references, from children and from survivors: a way that no state needs any more is
freed at once, and while the root has one child only, all survivors agree on that edit and
it is given out. So only the edits and rows are held on which the survivors still differ.

Among ways of equal cost the one with the least edit initials wins. Two tied ways are
compared from the node on that they share, over everything that is not given out yet.
Ways over the same rows cost the same only if neither begins with the other (an insertion
more is five more), so their order is final.

Spark finds repeated rows, brings each conversation into one task and sorts it there.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Costs of edits; every row that is kept although it is cut off adds ``TRUNCATED``.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: States in which a conversation may end.
FINAL = (EMPTY, ASSISTANT)
#: Role that leads from a state to a state.
STEPS = {
    (EMPTY, SYSTEM): "system",
    (EMPTY, USER): "user",
    (SYSTEM, USER): "user",
    (ASSISTANT, USER): "user",
    (USER, ASSISTANT): "assistant",
}
#: Only these roles can be given to a row or be inserted.
GIVEN = ("user", "assistant")
LEGAL = ("su", "ua", "au")
#: Rows, and bytes of text, of a batch that a task gives back.
BATCH_ROWS, BATCH_BYTES = 10_000, 8 << 20
#: Faults of a row; the first that holds counts.
SOUND, BLANK, DUPLICATE, CUT_OFF = range(4)


class Edit(NamedTuple):
    initial: str
    #: The role that the row gets, where it gets one.
    role: str | None = None


KEEP, DROP = Edit("K"), Edit("D")


def _moves(initial: str, fault: int) -> tuple:
    """Per state, the edits (cost, edit, next state) of a row."""
    moves = []
    for state in range(4):
        own = [(DELETE, DROP, state)]
        if fault in (SOUND, CUT_OFF):
            extra = TRUNCATED if fault == CUT_OFF else 0
            for (start, stop), role in STEPS.items():
                if start == state and role[0] == initial:
                    own.append((extra, KEEP, stop))
                elif start == state and role in GIVEN:
                    own.append((extra + REROLE, Edit("R", role), stop))
        moves.append(tuple(own))
    return tuple(moves)


MOVES = {(i, f): _moves(i, f) for i in ("s", "u", "a", "") for f in range(4)}
INSERTIONS = [
    (start, stop, Edit("I", role)) for (start, stop), role in STEPS.items() if role in GIVEN
]


class BackPointers:
    """Tree of edits. A node is [parent, edit, depth, references, children], the last as the
    exclusive or of their numbers: of a single child that is its number."""

    def __init__(self):
        self.nodes: dict[int, list] = {0: [None, None, 0, 0, 0]}
        self.root, self.last = 0, 0

    def add(self, parent: int, edit: Edit) -> int:
        self.last += 1
        up = self.nodes[parent]
        up[3] += 1
        up[4] ^= self.last
        self.nodes[self.last] = [parent, edit, up[2] + 1, 0, 0]
        return self.last

    def hold(self, node: int) -> None:
        self.nodes[node][3] += 1

    def release(self, node: int) -> None:
        """Take a survivor's reference away, and free what nothing refers to any more."""
        held = self.nodes[node]
        held[3] -= 1
        while not held[3] and node != self.root:
            del self.nodes[node]
            up = self.nodes[held[0]]
            up[3] -= 1
            up[4] ^= node
            node, held = held[0], up

    def settled(self) -> Iterator[Edit]:
        """Give out the edits that all survivors share; the root moves on."""
        while True:
            references, child = self.nodes[self.root][3:]
            if references != 1 or not child:
                return
            del self.nodes[self.root]
            self.root = child
            self.nodes[child][0] = None
            yield self.nodes[child][1]

    def less(self, a: int, edit_a: Edit, b: int, edit_b: Edit) -> bool:
        """Whether the initials up to ``a`` and its next edit come before those of ``b``."""
        nodes = self.nodes
        of_a, of_b = [edit_a.initial], [edit_b.initial]
        while a != b:
            if nodes[a][2] >= nodes[b][2]:
                of_a.append(nodes[a][1].initial)
                a = nodes[a][0]
            else:
                of_b.append(nodes[b][1].initial)
                b = nodes[b][0]
        return of_a[::-1] < of_b[::-1]


class Search:
    """Cheapest edits of one conversation, row by row."""

    def __init__(self):
        self.tree = BackPointers()
        self.heads: dict[int, tuple[int, int]] = {}
        self.tree.hold(0)
        self.heads[EMPTY] = (0, 0)
        self._insert()

    def _insert(self) -> None:
        """Go on from every state by insertions, while that is better."""
        tree, heads = self.tree, self.heads
        better = True
        while better:
            better = False
            for start, stop, edit in INSERTIONS:
                if start not in heads:
                    continue
                cost, node = heads[start]
                cost += INSERT
                held = heads.get(stop)
                if held and held[0] < cost:
                    continue
                if held and held[0] == cost:
                    parent, last = tree.nodes[held[1]][:2]
                    if last is None or not tree.less(node, edit, parent, last):
                        continue
                new = tree.add(node, edit)
                tree.hold(new)
                heads[stop] = (cost, new)
                if held:
                    tree.release(held[1])
                better = True
        # What an empty or system start can still do, an assistant's turn can for 2 or 0 more.
        for state, more in ((EMPTY, DELETE), (SYSTEM, 0)):
            if state in heads and heads[state][0] > heads[ASSISTANT][0] + more:
                tree.release(heads.pop(state)[1])

    def row(self, initial: str, fault: int) -> Iterator[Edit]:
        """Take the next row; give out what is settled."""
        moves = MOVES[initial if initial in ("s", "u", "a") else "", fault]
        tree = self.tree
        best: dict[int, tuple[int, int, Edit]] = {}
        for state, (cost, node) in self.heads.items():
            for more, edit, stop in moves[state]:
                held = best.get(stop)
                total = cost + more
                if (
                    held is None
                    or total < held[0]
                    or (total == held[0] and tree.less(node, edit, held[1], held[2]))
                ):
                    best[stop] = (total, node, edit)
        heads = {}
        for stop, (cost, node, edit) in best.items():
            new = tree.add(node, edit)
            tree.hold(new)
            heads[stop] = (cost, new)
        for _, node in self.heads.values():
            tree.release(node)
        self.heads = heads
        self._insert()
        return tree.settled()

    def end(self) -> tuple[int, Iterator[Edit]]:
        """Cost of the cheapest whole way, and its edits that are not given out yet."""
        tree = self.tree
        ends = [self.heads.pop(s) for s in FINAL if s in self.heads]
        cost, node = ends[0]
        for other_cost, other in ends[1:]:
            if other_cost < cost or (
                other_cost == cost and tree.less(other, KEEP, node, KEEP)
            ):
                cost, node = other_cost, other
        tree.hold(node)
        for _, left in [*ends, *self.heads.values()]:
            tree.release(left)
        self.heads = {}
        return cost, tree.settled()


class Repaired(NamedTuple):
    """An edit, and the row that it is about; an inserted row has no turn."""

    edit: str
    turn: int | None
    role: str
    text: str


class Conversation:
    """Edits and counts of one conversation, whose rows come in order."""

    def __init__(self):
        self.search = Search()
        self.waiting: deque[tuple] = deque()
        self.last: tuple | None = None
        self.faults = [0, 0, 0, 0]
        self.illegal = self.distinct = self.cost = 0
        self.least = self.most = None

    def _about(self, edits: Iterable[Edit]) -> Iterator[Repaired]:
        for edit in edits:
            if edit.initial == "I":
                yield Repaired("I", None, edit.role, "")
            else:
                turn, role, text = self.waiting.popleft()
                yield Repaired(edit.initial, turn, edit.role or role, text)

    def row(
        self, turn: int | None, role: str, text: str, blank: bool, repeated: bool, cut: bool
    ) -> Iterator[Repaired]:
        """Take a row; ``repeated`` if an earlier turn had its role and text."""
        row = (turn, role, text)
        repeated = repeated or row == self.last
        fault = BLANK if blank else DUPLICATE if repeated else CUT_OFF if cut else SOUND
        self.faults[fault] += 1
        if self.last is not None and self.last[1][:1] + role[:1] not in LEGAL:
            self.illegal += 1
        if turn is not None:
            if self.least is None:
                self.least = turn
            self.distinct += turn != self.most
            self.most = turn
        self.last = row
        self.waiting.append(row)
        return self._about(self.search.row(role[:1], fault))

    def end(self) -> Iterator[Repaired]:
        self.cost, edits = self.search.end()
        return self._about(edits)

    def counts(self) -> tuple[int, ...]:
        """Gaps, blank, duplicate, truncated, illegal, cost."""
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.distinct
        return (gaps, *self.faults[1:], self.illegal, self.cost)


def _ordered(df: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows with their faults, each conversation sorted within one partition."""
    rows = df.select(
        F.col(f"`{conversation}`").alias("conversation"),
        F.col(f"`{turn}`").cast("bigint").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    # 128 bits of role and text stand for them; only those found twice come back.
    keyed = rows.withColumns(
        {f"h{seed}": F.xxhash64(F.lit(seed), "role", "text") for seed in (1, 2)}
    )
    order = F.struct(F.col("turn").isNotNull(), "turn")
    several = (
        keyed.groupBy("conversation", "h1", "h2")
        .agg(F.count(F.lit(1)).alias("copies"), F.min(order).alias("first"))
        .where("copies > 1")
        .select(*[F.col(c).alias(f"of_{c}") for c in ("conversation", "h1", "h2")], "first")
    )
    same = F.col("conversation").eqNullSafe(F.col("of_conversation"))
    same &= (F.col("h1") == F.col("of_h1")) & (F.col("h2") == F.col("of_h2"))
    space = r"\x20\x09-\x0D"
    return (
        keyed.join(several, same, "left")
        .select(
            "conversation",
            "turn",
            "role",
            "text",
            (~F.col("text").rlike(f"[^{space}]")).alias("blank"),
            F.coalesce(order > F.col("first"), F.lit(False)).alias("repeated"),
            F.col("text").rlike(rf"[^{space}.!?][{space}]*\z").alias("cut"),
        )
        .repartition("conversation")
        .sortWithinPartitions(
            "conversation", F.col("turn").asc_nulls_first(), "role", "text"
        )
    )


def _conversations(batches) -> Iterator[tuple[object, Conversation, Repaired | None]]:
    """Edits as they settle; after the last one of a conversation comes None."""
    known, at, conversation = False, None, None
    for batch in batches:
        for key, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if not known or key != at:
                if known:
                    yield from ((at, conversation, edit) for edit in conversation.end())
                    yield at, conversation, None
                known, at, conversation = True, key, Conversation()
            for edit in conversation.row(*row):
                yield at, conversation, edit
    if known:
        yield from ((at, conversation, edit) for edit in conversation.end())
        yield at, conversation, None


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def out() -> pa.RecordBatch:
        arrays = [pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    for row in rows:
        held.append(row)
        size += len(row[-1])
        if len(held) == BATCH_ROWS or size >= BATCH_BYTES:
            yield out()
            held, size = [], 0
    if held:
        yield out()


def repair(
    df: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Rows (``conversation``, place, edit, turn, role, text): the edits of every conversation.

    ``edit`` is K (kept), R (role changed), D (deleted) or I (inserted, without turn and
    text); ``role`` is the new one. Without the rows D, by ``place``, the rows of a
    conversation are its repaired form.

    Rows go by turn, null first, then by role and text. A row without a character but white
    space, or with the role and text of an earlier one, has to be deleted; one whose last
    such character does not end a sentence costs more if it stays. A null role or text is
    an empty one, a null conversation is one of its own, an empty table gives an empty
    result, and other columns of any name are left out. A conversation is read by one task
    in order; the task holds the rows that are not settled, not the conversation.
    """
    ordered = _ordered(df, conversation, turn, role, text)
    kind = ordered.schema["conversation"].dataType.simpleString()

    def task(batches) -> Iterator[pa.RecordBatch]:
        first = next(iter_batches := iter(batches), None)
        if first is None:
            return
        schema = pa.schema(
            [
                ("conversation", first.schema.field("conversation").type),
                ("place", pa.int64()),
                ("edit", pa.string()),
                ("turn", pa.int64()),
                ("role", pa.string()),
                ("text", pa.string()),
            ]
        )

        def rows() -> Iterator[tuple]:
            place = 0
            for key, _, edit in _conversations(_chained(first, iter_batches)):
                if edit is None:
                    place = 0
                    continue
                yield (key, place, edit.edit, edit.turn, edit.role, edit.text)
                place += 1

        yield from _batches(rows(), schema)

    edits = ordered.mapInArrow(
        task, f"conversation {kind}, place bigint, edit string, turn bigint, role string, text string"
    )
    return edits.withColumnRenamed("conversation", conversation)


def _chained(first, rest) -> Iterator[pa.RecordBatch]:
    yield first
    yield from rest


def report(
    df: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per conversation about what ``repair`` gives for it.

    ``gaps`` (turns missing between the first and last, nulls left out), ``blank``,
    ``duplicate``, ``truncated`` (rows by their first fault), ``illegal`` (neighbours whose
    roles may not follow each other), ``cost``, ``audit`` (initials of the edits) and
    ``repaired_sha256`` (of the repaired ``role:text``, joined by line feeds). The edits are
    hashed as they settle. Odd input as in ``repair``.
    """
    ordered = _ordered(df, conversation, turn, role, text)
    kind = ordered.schema["conversation"].dataType.simpleString()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")

    def task(batches) -> Iterator[pa.RecordBatch]:
        first = next(iter_batches := iter(batches), None)
        if first is None:
            return
        schema = pa.schema(
            [
                ("conversation", first.schema.field("conversation").type),
                *[(c, pa.int64()) for c in counts],
                ("repaired_sha256", pa.string()),
                ("audit", pa.string()),
            ]
        )

        def rows() -> Iterator[tuple]:
            digest, audit, between = hashlib.sha256(), [], ""
            for key, held, edit in _conversations(_chained(first, iter_batches)):
                if edit is None:
                    yield (key, *held.counts(), digest.hexdigest(), "".join(audit))
                    digest, audit, between = hashlib.sha256(), [], ""
                    continue
                audit.append(edit.edit)
                if edit.edit != "D":
                    digest.update(f"{between}{edit.role}:{edit.text}".encode())
                    between = "\n"

        yield from _batches(rows(), schema)

    numbers = ", ".join(f"{c} bigint" for c in counts)
    reports = ordered.mapInArrow(
        task, f"conversation {kind}, {numbers}, repaired_sha256 string, audit string"
    )
    return reports.withColumnRenamed("conversation", conversation)
