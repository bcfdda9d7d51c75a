"""Conversations repaired by the cheapest edits, found in linear space.

After the edits the roles of a conversation read ``(s?(ua)+)?`` by their initials. What is read so far is
one of four states: nothing, a system turn, a user turn, an assistant turn. Hirschberg's method
finds the edits: cost vectors over the states run forward and backward, meet in the middle
of the conversation, and tell the state in which the best edits pass it; both halves follow
alike. Conversations are cut into chunks, whose transfer costs give the states at their
borders first, so that a conversation of any length is solved by many tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagestrata.llm.common import BLANKS, stored

#: Turns of a chunk.
CHUNK = 1024
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a turn is put in, by the state before.
_NEXT = (USER, USER, ASSISTANT, USER)
_NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Turns put in at the end of a conversation, by its last state.
_END = ("", "II", "I", "")
#: What a turn is to the edits: the initial of its role (s, u, a, other), plus ``_CUT`` if it is
#: truncated; or one that has to go.
_INITIALS = "sua"
_CUT, _GONE = 4, 8
_FAR = 1 << 60


def _moves(code: int) -> list[dict[int, tuple[int, str]]]:
    """From each state, the states that a turn of ``code`` can lead to: the least cost and the edits in
    order, turns put in first. Of equal costs the first edits in order of code points."""
    table: list[dict[int, tuple[int, str]]] = []
    for start in range(4):
        best: dict[int, tuple[int, str]] = {}
        state, before = start, ""
        for _ in range(3):
            options = [(state, DELETE, "D")]
            if code != _GONE:
                extra = TRUNCATED if code >= _CUT else 0
                role = (SYSTEM, USER, ASSISTANT, None)[code % _CUT]
                fits = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}[state]
                options.append((_NEXT[state], REROLE + extra, "R"))
                if role in fits:
                    options.append((role, KEEP + extra, "K"))
            for to, cost, edit in options:
                found = (cost + INSERT * len(before), before + edit)
                best[to] = min(found, best.get(to, found))
            state, before = _NEXT[state], before + "I"
        table.append(best)
    return table


_MOVES = [_moves(code) for code in range(_GONE + 1)]
_LINKS = [[(s, t, *m) for s, to in enumerate(moves) for t, m in to.items()] for moves in _MOVES]


def forward(codes: bytes, cost: list[int], rank: list[int]) -> tuple[list[int], list[int]]:
    """The least cost of reaching each state after ``codes``, and the rank of the edits that do,
    in order of code points, given both for the states before.

    Edits up to a turn end with that turn's own edit, which is never ``I``. So none begins with
    all of another, and which comes first is decided for good, whatever follows.
    """
    for code in codes:
        new: list[tuple[int, int, str] | None] = [None] * 4
        for s, t, more, edits in _LINKS[code]:
            if cost[s] < _FAR:
                found = (cost[s] + more, rank[s], edits)
                if new[t] is None or found < new[t]:
                    new[t] = found
        order = sorted((x[1:], t) for t, x in enumerate(new) if x is not None)
        cost = [x[0] if x else _FAR for x in new]
        rank = [0] * 4
        for i, (_, t) in enumerate(order):
            rank[t] = i
    return cost, rank


def backward(codes: bytes, cost: list[int]) -> list[int]:
    """The least cost from each state before ``codes``, given those after."""
    for code in reversed(codes):
        cost = [min([more + cost[t] for t, (more, _) in to.items()], default=_FAR) for to in _MOVES[code]]
    return cost


def crossing(ahead: list[int], rank: list[int], behind: list[int]) -> int:
    """The state in which the cheapest edits pass a border; of several the first in order."""
    return min(range(4), key=lambda s: (ahead[s] + behind[s], rank[s]))


def edits(codes: bytes, entry: int, leave: int) -> list[str]:
    """For each turn its edits, turns put in before it included, between two known states."""
    if len(codes) == 1:
        return [_MOVES[codes[0]][entry][leave][1]]
    middle = len(codes) // 2
    ahead, rank = forward(codes[:middle], _only(entry), [0] * 4)
    state = crossing(ahead, rank, backward(codes[middle:], _only(leave)))
    return edits(codes[:middle], entry, state) + edits(codes[middle:], state, leave)


def _only(state: int) -> list[int]:
    return [0 if s == state else _FAR for s in range(4)]


def _end_cost() -> list[int]:
    return [INSERT * len(x) for x in _END]


def with_faults(turns: DataFrame) -> DataFrame:
    """The rows of ``turns`` (``conv_id``, ``turn``, ``role``, ``text``), equal ones as one row, in order:
    with ``copies``, ``digest`` (of the text), ``place`` (a number that grows in the order of
    conversations and their turns) and ``fault`` (blank, duplicate, truncated or NULL).

    NULL roles and texts are one blank. Turns are ordered by ``turn``, NULL first, then role and digest.
    """
    blank = F.lit(" ")
    rows = (
        turns.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"))
        .groupBy("conv_id", "turn", "role", "text")
        .agg(F.count("*").alias("copies"))
        .withColumn("digest", F.sha2("text", 256))
    )
    rows = stored(rows)
    # The first of the rows with the same role and text, as a row, so that the join has no frequent key.
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = rows.groupBy("conv_id", "role", "digest").agg(F.min(when).alias("w"))
    first = first.select(
        F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest"),
        F.col("w.turn").alias("_turn"),
    )
    same = (
        rows["conv_id"].eqNullSafe(first["_conv"]) & rows["turn"].eqNullSafe(first["_turn"])
        & (rows["role"] == first["_role"]) & (rows["digest"] == first["_digest"])
    )
    end = F.rtrim("text", F.lit(BLANKS))
    fault = (
        F.when(end == "", "blank")
        .when(F.col("_digest").isNull(), "duplicate")
        .when(~F.right(end, F.lit(1)).isin(".", "!", "?"), "truncated")
    )
    order = ["conv_id", "turn", "role", "digest"]
    marked = rows.join(first, same, "left").select(*rows.columns, fault.alias("fault"))
    ordered = marked.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(ordered.withColumn("place", F.monotonically_increasing_id()))


def with_edits(rows: DataFrame) -> DataFrame:
    """``rows`` (of ``with_faults``) with ``edits``, their edits' initials, turns put in before them
    included; ``roles``, that each edit gives a turn that stays (NULL: none, or its own); and for the
    last row of a conversation the turns to put in behind it (``behind``: ``I`` or ``II``)."""
    initial = F.coalesce(F.nullif(F.instr(F.lit(_INITIALS), F.substring("role", 1, 1)), F.lit(0)), F.lit(4)) - 1
    initial = F.when(F.col("role") == "", 3).otherwise(initial)
    code = (
        F.when(F.col("fault").isin("blank", "duplicate"), _GONE)
        .when(F.col("fault") == "truncated", initial + _CUT)
        .otherwise(initial)
    )
    # A chunk is as many rows as stand in a row, of one conversation.
    chunk = F.shiftright("place", CHUNK.bit_length() - 1)
    turn = F.struct("place", code.cast("int").alias("code"))
    chunks = stored(
        rows.groupBy("conv_id", chunk.alias("chunk"))
        .agg(F.array_sort(F.collect_list(turn)).alias("turns"))
        .select("conv_id", F.col("turns")[0]["place"].alias("first"), F.col("turns.place").alias("places"), F.col("turns.code").alias("codes"))
    )
    costs = chunks.select("conv_id", "first", "codes").mapInArrow(
        _transfers, "conv_id long, first long, cost array<long>, rank array<int>"
    )
    # Forward and backward along the chunks of each conversation, of which a task holds one.
    reached = costs.repartition("conv_id").sortWithinPartitions("conv_id", "first").mapInArrow(
        _reached, "conv_id long, first long, cost array<long>, ahead array<long>, rank array<int>"
    )
    states = reached.sortWithinPartitions("conv_id", F.desc("first")).mapInArrow(
        _crossed, "first long, entry int, leave int, last boolean"
    )
    solved = chunks.drop("conv_id").join(stored(states), "first").mapInArrow(
        _solved, "place long, edits string, roles array<string>, behind string"
    )
    return rows.join(solved, "place")


def repair_turns(turns: DataFrame) -> DataFrame:
    """``turns`` (``conv_id``, ``turn``, ``role``, ``text``) with the cheapest edits made.

    Returns a row per turn that is left or put in: ``conv_id``, ``place`` and ``part`` (which order a
    conversation's turns), ``turn`` (NULL if put in), ``role``, ``text``, ``edit`` (``K``, ``R`` or ``I``).

    Blank turns and turns whose role and text stood earlier in the conversation are deleted. To keep a
    turn costs nothing, to make it a user's or assistant's 1, to delete it 2, to put in an
    empty one 5; a truncated one, which does not end with a full stop, question or exclamation mark,
    costs 5 more if it stays. The roles left read ``(s?(ua)+)?`` by their initials. Of
    equally cheap edits, those whose initials come first in order of code points are made.

    NULL roles and texts are one blank. NULL ids are one conversation. Turns are ordered
    by ``turn``, NULL first, then role and sha256 of the text. Extra columns are not
    read. No rows give no rows.
    """
    rows = with_edits(with_faults(turns))
    whole = F.concat("edits", F.coalesce("behind", F.lit("")))
    n = F.length(whole)
    added = F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.struct(
            i.alias("part"), F.substring(whole, i, F.lit(1)).alias("edit"), F.get("roles", i - 1).alias("new")
        ),
    )
    put_in = F.col("x.edit") == "I"
    return rows.withColumn("x", F.explode(added)).filter(F.col("x.edit") != "D").select(
        "conv_id", "place", "x.part",
        F.when(~put_in, F.col("turn")).alias("turn"),
        F.coalesce("x.new", "role").alias("role"),
        F.when(put_in, "").otherwise(F.col("text")).alias("text"),
        "x.edit",
    )


def repair_digests(turns: DataFrame) -> DataFrame:
    """What ``repair_turns`` finds and does, a row per conversation of ``turns``: ``conv_id``, ``gaps`` (turn
    numbers missing between the least and the largest), ``blank``, ``duplicate``, ``truncated`` (the first
    fault of each row), ``illegal`` (roles in a row whose initials are not su, ua or au), ``cost``, ``audit``
    (initials of the edits) and ``repaired_sha256`` (of ``role:text``, newline-joined).

    Each conversation streams through one task for its digest, its audit being all that is held.
    """
    rows = with_edits(with_faults(turns))
    columns = ["conv_id", "turn", "role", "text", "copies", "fault", "edits", "roles", "behind"]
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "place").select(*columns)
    return ordered.mapInArrow(
        _digests,
        "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
        "audit string, repaired_sha256 string",
    )


def _transfers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each chunk the costs from each state to each, and the ranks of the edits from a state."""
    known = lru_cache(1 << 14)(_transfer)
    for batch in batches:
        found = [known(bytes(codes)) for codes in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([c for c, _ in found], pa.list_(pa.int64())),
             pa.array([r for _, r in found], pa.list_(pa.int32()))],
            names=["conv_id", "first", "cost", "rank"],
        )


def _transfer(codes: bytes) -> tuple[list[int], list[int]]:
    parts = [forward(codes, _only(s), [0] * 4) for s in range(4)]
    return [c for cost, _ in parts for c in cost], [r for _, rank in parts for r in rank]


def _reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each chunk the costs and ranks of the states at its end, from the conversation's start."""
    conv: object = _reached
    ahead, rank = _only(START), [0] * 4
    for batch in batches:
        out: list[tuple] = []
        for conv_id, cost, ranks in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
            if conv_id != conv:
                conv, ahead, rank = conv_id, _only(START), [0] * 4
            best: list[tuple] = []
            for t in range(4):
                ways = [(ahead[s] + cost[4 * s + t], rank[s], ranks[4 * s + t]) for s in range(4)]
                best.append(min(w if w[0] < _FAR else (_FAR, 9, 9) for w in ways))
            order = sorted((x[1:], t) for t, x in enumerate(best))
            ahead, rank = [x[0] for x in best], [0] * 4
            for i, (_, t) in enumerate(order):
                rank[t] = i
            out.append((ahead, rank))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2),
             pa.array([a for a, _ in out], pa.list_(pa.int64())), pa.array([r for _, r in out], pa.list_(pa.int32()))],
            names=["conv_id", "first", "cost", "ahead", "rank"],
        )


def _crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each chunk, the last of a conversation first, the states at both of its borders."""
    conv: object = _crossed
    held: tuple | None = None
    behind: list[int] = []
    for batch in batches:
        out: list[tuple] = []
        for conv_id, first, cost, ahead, rank in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            last = conv_id != conv
            if last:
                if held:
                    out.append((held[0], START, *held[1:]))
                conv, behind = conv_id, _end_cost()
            state = crossing(ahead, rank, behind)
            if not last:
                out.append((held[0], state, *held[1:]))
            held = (first, state, last)
            behind = [min(cost[4 * s + t] + behind[t] for t in range(4)) for s in range(4)]
        if out:
            yield _states(out)
    if held:
        yield _states([(held[0], START, *held[1:])])


def _states(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int32(), pa.int32(), pa.bool_()]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["first", "entry", "leave", "last"])


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # Short conversations are much alike.
    known = lru_cache(1 << 14)(edits)
    for batch in batches:
        names = ["places", "codes", "entry", "leave", "last"]
        columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names]
        out: list[tuple] = []
        for places, codes, entry, leave, last in zip(*columns, strict=True):
            solve = known if len(codes) <= 16 else edits
            found = solve(bytes(codes), entry, leave)
            state = entry
            for i, (place, own, code) in enumerate(zip(places, found, codes, strict=True)):
                behind = _END[leave] if last and i + 1 == len(places) else None
                roles: list[str | None] = []
                for edit in own + (behind or ""):
                    if edit == "K":
                        state = (SYSTEM, USER, ASSISTANT)[code % _CUT]
                    elif edit != "D":
                        state = _NEXT[state]
                    roles.append(_NAMES[state] if edit in "IR" else None)
                out.append((place, own, roles, behind))
        types = [pa.int64(), pa.string(), pa.list_(pa.string()), pa.string()]
        arrays = [pa.array([row[i] for row in out], t) for i, t in enumerate(types)]
        yield pa.RecordBatch.from_arrays(arrays, names=["place", "edits", "roles", "behind"])


_LEGAL = {"su", "ua", "au"}


class _Conversation:
    """What is known of a conversation whose rows come in order."""

    def __init__(self):
        self.turns: list[int] = []  # least, largest, how many
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.cost = 0
        self.initial: str | None = None
        self.audit: list[str] = []
        self.sha = hashlib.sha256()
        self.begun = False

    def add(self, turn, role, text, copies, fault, own, roles, behind) -> None:
        if turn is not None:
            if not self.turns:
                self.turns = [turn, turn, 1]
            elif turn != self.turns[1]:
                self.turns[1:] = turn, self.turns[2] + 1
        if fault:
            self.faults[fault] += 1
        self.faults["blank" if fault == "blank" else "duplicate"] += copies - 1
        initial = role[:1]
        self.illegal += self.initial is not None and self.initial + initial not in _LEGAL
        self.illegal += (copies - 1) * (initial * 2 not in _LEGAL)
        self.initial = initial
        for i, edit in enumerate(own + (behind or "")):
            if i == len(own):
                self._copies(copies)
            self.audit.append(edit)
            self.cost += {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}[edit]
            self.cost += TRUNCATED * (fault == "truncated" and edit in "KR")
            if edit != "D":
                self.sha.update(b"\n" * self.begun)
                self.sha.update(f"{roles[i] or role}:".encode())
                self.sha.update(b"" if edit == "I" else text.encode())
                self.begun = True
        if not behind:
            self._copies(copies)

    def _copies(self, copies: int) -> None:
        self.audit.append("D" * (copies - 1))
        self.cost += DELETE * (copies - 1)

    def row(self, conv_id) -> tuple:
        gaps = self.turns[1] - self.turns[0] + 1 - self.turns[2] if self.turns else 0
        return (conv_id, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest())


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv: object = _digests
    now: _Conversation | None = None
    for batch in batches:
        out: list[tuple] = []
        for conv_id, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if conv_id != conv:
                if now:
                    out.append(now.row(conv))
                conv, now = conv_id, _Conversation()
            now.add(*row)
        if out:
            yield _rows(out)
    if now:
        yield _rows([now.row(conv)])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    types = [pa.int64()] * 7 + [pa.string()] * 2
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=names)


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` (``conv_id``, ``turn``, ``role``, ``text``) with faults, by a checksum of id and turn:
    rows lost, emptied, without full stops, repeated, or with the role user. NULLs are one blank."""

    def known(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(known("text"), "[.!?]", "")).otherwise(known("text"))
    role = F.when(kind == 4, "user").otherwise(known("role"))
    times = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = conversations.filter(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times))
    return rows.drop("col")
