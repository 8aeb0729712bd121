"""Repair of the structure of conversations at the least cost.

A conversation, its rows in order of turn (nulls first; rows of one turn by
role and then a hash of the text; equal rows are interchangeable), shall have
roles whose initials read ``(s?(ua)+)?``. Each row's first fault counts: blank
(no character but white space, [\\x20\\x09-\\x0D]), duplicate (role and text seen
in an earlier row), truncated (the last such character is none of ``.!?``).
Edits and costs (fixed values): Keep 0, Rerole to user or assistant 1, Delete 2
(blank and duplicate rows must go), Insert an empty user or assistant row 5; a
truncated row that stays adds 5. The audit is the edits' initials in order, of
the cheapest edits the ASCII-least.

The audit is found by dynamic programming over the rows with four states (what
the roles so far end in). The best audit of each state is a node of a tree of
``Audits``: audits share their beginnings, an extension is one node. Two audits
of equal cost are compared at the end of their longest common prefix, which is
searched with binary-lifting ancestors and rolling hashes and then verified. Two
different audits of one state and one cost are never prefixes of each other:
what one has more would be inserts, which cost.

Scale. Rows are dealt by range of (conversation, turn, ...), so the rows of a
task are whole conversations but for the first and the last, and a conversation
with a third of all rows takes a third of the tasks. Conversations that end in
the task are repaired there. The others, and those longer than PIECE_ROWS rows
or PIECE_BYTES, are cut into pieces: first occurrences of their rows are found
by a keyed aggregate, each piece gives the best audit for every state it may
begin and end in, and these are chained per conversation by the same rules. The
audit and the hash of a conversation are single values, so chaining holds about
16 bytes for each row of the longest conversation, and its repaired text
streams through one task, piece by piece.

Rows: null roles and texts count as one space; a null conversation id is a
conversation of its own; a null turn comes first and is no turn for the gaps.
Texts of any length are taken whole. An empty table gives no rows. Columns
other than the four named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import bounded_batches, lookup_split, shuffle_partitions, store
from tillroll.llm.oracles import CRC_TABLE, crc32

PIECE_ROWS = 2048
PIECE_BYTES = 8 << 20

# White space, ends of sentences, costs.
SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

# States: nothing yet, after the system row, after a user row, after an assistant row.
NONE, SYSTEM, USER, ASSISTANT = STATES = range(4)
_KEPT = {("s", NONE): SYSTEM, ("u", NONE): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
_WANTED = {NONE: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_LEGAL = {"su", "ua", "au"}
_PRIME = 10 ** 18 + 9


class Audits:
    """Byte strings that share their beginnings. A node is its parent's string
    and some bytes more; node 0 is the empty string."""

    def __init__(self):
        self.text, self.begin, self.end, self.hash = [b""], [0], [0], [0]
        self.up: list[list[int]] = [[]]  # the ancestors 1, 2, 4, ... nodes before

    def add(self, parent: int, text: bytes) -> int:
        self.text.append(text)
        self.begin.append(self.end[parent])
        self.end.append(self.end[parent] + len(text))
        self.hash.append(self._extend(self.hash[parent], text))
        up, at = [parent], parent
        while len(self.up[at]) >= len(up):
            at = self.up[at][len(up) - 1]
            up.append(at)
        self.up.append(up)
        return len(self.text) - 1

    @staticmethod
    def _extend(value: int, text: bytes) -> int:
        return (value * pow(256, len(text), _PRIME) + int.from_bytes(text, "big")) % _PRIME

    def _at(self, node: int, depth: int) -> int:
        """The ancestor (or ``node``) that holds byte ``depth`` - 1."""
        for k in range(len(self.up[node]) - 1, -1, -1):
            up = self.up[node]
            if k < len(up) and self.end[up[k]] >= depth:
                node = up[k]
        return node

    def _prefix_hash(self, node: int, depth: int) -> int:
        x = self._at(node, depth)
        if self.end[x] == depth:
            return self.hash[x]
        return self._extend(self.hash[self.up[x][0]], self.text[x][:depth - self.begin[x]])

    def _bytes(self, node: int, low: int, high: int) -> bytes:
        parts, x = [], self._at(node, high)
        while high > low:
            parts.append(self.text[x][max(low - self.begin[x], 0):high - self.begin[x]])
            high = max(low, self.begin[x])
            x = self.up[x][0] if self.up[x] else x
        return b"".join(reversed(parts))

    def string(self, node: int) -> bytes:
        return self._bytes(node, 0, self.end[node])

    def _verified(self, a: int, b: int, depth: int) -> bool:
        """Whether the first ``depth`` bytes are the same: compared back to a shared node."""
        a, b = self._at(a, depth), self._at(b, depth)
        while depth and a != b:
            start = max(self.begin[a], self.begin[b])
            if self.text[a][start - self.begin[a]:depth - self.begin[a]] != \
                    self.text[b][start - self.begin[b]:depth - self.begin[b]]:
                return False
            depth = start
            if depth:
                a, b = self._at(a, depth), self._at(b, depth)
        return True

    def common(self, a: int, b: int) -> int:
        """Length of the longest common prefix."""
        limit = min(self.end[a], self.end[b])
        if self._prefix_hash(a, limit) == self._prefix_hash(b, limit):
            depth = limit
        else:
            # the highest ancestor of a that is no beginning of b
            x = self._at(a, limit)
            for k in range(len(self.up[x]) - 1, -1, -1):
                up = self.up[x]
                if k < len(up) and self.hash[up[k]] != self._prefix_hash(b, self.end[up[k]]):
                    x = up[k]
            depth = self.begin[x]
            mine = self.text[x][:limit - depth]
            for p, q in zip(mine, self._bytes(b, depth, depth + len(mine))):
                if p != q:
                    break
                depth += 1
        if not self._verified(a, b, depth):  # a collision of hashes
            depth = next((i for i, (p, q) in enumerate(zip(self.string(a), self.string(b))) if p != q), limit)
        return depth

    def less(self, a: int, b: int) -> bool:
        depth = self.common(a, b)
        if depth == min(self.end[a], self.end[b]):
            return self.end[a] < self.end[b]
        return self._bytes(a, depth, depth + 1) < self._bytes(b, depth, depth + 1)


class _Best:
    """The best (cost, node) of each state, fed with candidates."""

    def __init__(self, audits: Audits):
        self._audits, self.of = audits, {}

    def offer(self, state: int, cost: int, parent: int, text: bytes) -> None:
        known = self.of.get(state)
        if known is not None and known[0] < cost:
            return
        node = self._audits.add(parent, text) if text else parent
        if known is None or cost < known[0] or self._audits.less(node, known[1]):
            self.of[state] = (cost, node)


def _insert(best: _Best) -> dict[int, tuple[int, int]]:
    """One or two inserted rows; more come back to a state at a higher cost."""
    for state in (NONE, SYSTEM, ASSISTANT, USER):
        if state in best.of:
            cost, node = best.of[state]
            best.offer(_WANTED[state], cost + INSERT, node, b"I")
    return best.of


def transitions(rows: Sequence[tuple[str, str]], start: int, audits: Audits, last: bool) -> dict[int, tuple[int, int]]:
    """For rows (initial of the role, fault) and the state before them: the
    least cost and its least audit by the state after them. Inserts come before
    a row, and after the last one if it ends the conversation."""
    best = _Best(audits)
    best.of = {start: (0, 0)}
    for initial, fault in rows:
        before, best = _insert(best), _Best(audits)
        for state, (cost, node) in before.items():
            best.offer(state, cost + DELETE, node, b"D")
            if fault in ("blank", "duplicate"):
                continue
            stays = cost + (TRUNCATED if fault == "truncated" else 0)
            if (initial, state) in _KEPT:
                best.offer(_KEPT[initial, state], stays, node, b"K")
            best.offer(_WANTED[state], stays + REROLE, node, b"R")
    return _insert(best) if last else best.of


def _accepted(audits: Audits, of: dict[int, tuple[int, int]]) -> tuple[int, int]:
    best = _Best(audits)
    for state in (NONE, ASSISTANT):
        if state in of:
            best.offer(0, *of[state], b"")
    return best.of[0]


def edited(rows: Sequence[tuple[str, str]], audit: bytes, state: int) -> Iterator[str]:
    """The repaired lines of rows (role, text) by an audit that begins in ``state``."""
    left = iter(rows)
    for edit in audit.decode():
        if edit == "I":
            state = _WANTED[state]
            yield f"{_ROLE[state]}:"
            continue
        role, text = next(left)
        if edit == "K":
            state = _KEPT[role[:1], state]
            yield f"{role}:{text}"
        elif edit == "R":
            state = _WANTED[state]
            yield f"{_ROLE[state]}:{text}"


def end_state(rows: Sequence[str], audit: bytes, state: int) -> int:
    left = iter(rows)
    for edit in audit.decode():
        initial = "" if edit == "I" else next(left)
        if edit != "D":
            state = _KEPT[initial, state] if edit == "K" else _WANTED[state]
    return state


def text_fault(text: str) -> str:
    inside = text.strip(SPACE)
    return "blank" if not inside else "" if inside[-1] in ENDS else "truncated"


def _illegal(initials: Sequence[str]) -> int:
    return sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))


def repair_one(rows: Sequence[tuple[int | None, str, str]]) -> dict:
    """Figures, audit and hash of one conversation, its rows (turn, role, text) in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        fault = text_fault(text)
        faults.append("duplicate" if fault != "blank" and (role, text) in seen else fault)
        seen.add((role, text))
    initials = [role[:1] for _, role, _ in rows]
    audits = Audits()
    cost, node = _accepted(audits, transitions(list(zip(initials, faults)), NONE, audits, True))
    audit = audits.string(node)
    lines = "\n".join(edited([r[1:] for r in rows], audit, NONE)) if rows else ""
    turns = sorted({t for t, _, _ in rows if t is not None})
    return {"gaps": turns[-1] - turns[0] + 1 - len(turns) if turns else 0,
            **{k: faults.count(k) for k in ("blank", "duplicate", "truncated")},
            "illegal": _illegal(initials), "cost": cost, "audit": audit.decode() if rows else "",
            "repaired_sha256": hashlib.sha256(lines.encode()).hexdigest()}


_FIGURES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_RESULT = ", ".join(f"{c} long" for c in _FIGURES) + ", audit string, repaired_sha256 string"
_RESULT_ARROW = [(c, pa.int64()) for c in _FIGURES] + [("audit", pa.string()), ("repaired_sha256", pa.string())]


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           times: str | None = None) -> DataFrame:
    """Per conversation: ``conv``, gaps (turns missing between the least and
    the greatest), blank, duplicate, truncated, illegal (neighbours whose
    initials are none of su, ua, au), cost, audit, repaired_sha256 (of the lines
    ``role:text``, joined by line feeds).

    ``times`` names a column with how often a row stands; 0 leaves the row out
    but not its conversation.
    """
    bounded_batches(df.sparkSession)
    kind = dict(df.select(F.col(f"`{conv}`").alias("c")).dtypes)["c"]
    rows = df.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
        *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))],
        (F.lit(1) if times is None else F.col(f"`{times}`")).cast("int").alias("times"))
    # the last column only spreads equal rows; it decides nothing
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", F.xxhash64("text"), "spread"]
    dealt = (rows.withColumn("spread", F.monotonically_increasing_id())
             .repartitionByRange(shuffle_partitions(df.sparkSession), *order).sortWithinPartitions(*order)
             .drop("spread"))
    done = store(dealt.mapInArrow(_repair_task, f"conv {kind}, piece long, place long, turn long, role string, "
                                                f"text string, {_RESULT}"), "audit")
    columns = ["conv", *_FIGURES, "audit", "repaired_sha256"]
    whole = done.where(F.col("piece").isNull()).select(*columns)
    pieces = done.where(F.col("piece").isNotNull()).select("conv", "piece", "place", "turn", "role", "text")
    return whole.unionByName(_chained(pieces, kind).select(*columns)).withColumnRenamed("conv", conv)


def _repair_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of the conversations that lie in this task; rows of the others,
    by piece, with one row of place -1 for each piece."""
    piece = TaskContext.get().partitionId() << 32
    held: list[tuple] = []  # rows (turn, role, text) of the current conversation
    now, size, first, cut, out, schema = None, 0, True, False, [], None

    def emit(whole: bool):
        nonlocal piece, held, size
        if whole:
            out.append({"conv": now, **repair_one(held)})
        else:
            out.append({"conv": now, "piece": piece, "place": -1})
            out.extend({"conv": now, "piece": piece, "place": i, "turn": t, "role": r, "text": x}
                       for i, (t, r, x) in enumerate(held))
            piece += 1
        held, size = [], 0

    started = False
    for batch in batches:
        if schema is None:
            schema = pa.schema([("conv", batch.schema.field("conv").type), ("piece", pa.int64()), ("place", pa.int64()),
                                ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), *_RESULT_ARROW])
        for conv, turn, role, text, times in zip(*(c.to_pylist() for c in batch.columns)):
            if started and conv != now:
                emit(whole=not (first or cut))
                first, cut = False, False
            now, started = conv, True
            for _ in range(times):
                if len(held) >= PIECE_ROWS or size + len(text) > PIECE_BYTES and held:
                    emit(whole=False)
                    cut = True
                held.append((turn, role, text))
                size += len(text)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
            out.clear()
    if started:
        emit(whole=False)
        yield pa.RecordBatch.from_pylist(out, schema)


_PIECE = ("key string, piece long, n long, blank long, duplicate long, truncated long, illegal long, "
          "first string, last string, low long, high long, turns long, "
          "best array<struct<start:int,stop:int,cost:long,audit:string>>")


def _chained(pieces: DataFrame, kind: str) -> DataFrame:
    """Results of the conversations that lie in several tasks or pieces."""
    # a key that is never null and tells a null id from any text
    keyed = pieces.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit("null")))
    rows = keyed.where(F.col("place") >= 0).withColumn(
        "same", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))
    firsts = (rows.groupBy("key", "same").agg(F.min(F.struct("piece", "place")).alias("before"),
                                              F.count(F.lit(1)).alias("copies")).where("copies > 1"))
    marked = lookup_split(rows, firsts, ["key", "same"], "copies", rows.count(),
                          F.xxhash64("piece", "place")).withColumn(
        "again", F.coalesce(F.struct("piece", "place") > F.col("before"), F.lit(False)))
    marked = store(marked.select("key", "piece", "place", "turn", "role", "text", "again"), "marked")
    parts = store(marked.groupBy("key", "piece").applyInArrow(_summarise, _PIECE), "pieces")
    chain = store(parts.groupBy("key").applyInArrow(_chain, "key string, piece long, state int, part string, "
                                                    + ", ".join(f"{c} long" for c in _FIGURES) + ", audit string"),
                  "chain")
    lines = (marked.select("key", "piece", "place", "role", "text").groupBy("key", "piece")
             .cogroup(chain.where("piece is not null").select("key", "piece", "state", "part").groupBy("key", "piece"))
             .applyInArrow(_edited_piece, "key string, piece long, lines string"))
    hashes = (lines.repartition(shuffle_partitions(pieces.sparkSession), "key").sortWithinPartitions("key", "piece")
              .mapInArrow(_hash_lines, "key string, repaired_sha256 string"))
    ids = keyed.where(F.col("place") < 0).groupBy("key").agg(F.first("conv").alias("conv"))
    figures = chain.where("piece is null").select("key", *_FIGURES, "audit")
    zero = F.lit(0).cast("long")
    return ids.join(figures, "key", "left").join(hashes, "key", "left").select(
        "conv", *[F.coalesce(c, zero).alias(c) for c in _FIGURES], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def _ordered(table: pa.Table, by: str) -> list[dict]:
    return table.sort_by(by).to_pylist()


def _summarise(table: pa.Table) -> pa.Table:
    """Figures of a piece and its best audits by the state before and after it."""
    rows = _ordered(table, "place")
    faults = []
    for r in rows:
        fault = text_fault(r["text"])
        faults.append("duplicate" if fault != "blank" and r["again"] else fault)
    initials = [r["role"][:1] for r in rows]
    best = []
    for start in STATES:
        audits = Audits()
        of = transitions(list(zip(initials, faults)), start, audits, False)
        best += [{"start": start, "stop": stop, "cost": cost, "audit": audits.string(node).decode()}
                 for stop, (cost, node) in of.items()]
    turns = sorted({r["turn"] for r in rows if r["turn"] is not None})
    out = {"key": rows[0]["key"], "piece": rows[0]["piece"], "n": len(rows),
           **{k: faults.count(k) for k in ("blank", "duplicate", "truncated")}, "illegal": _illegal(initials),
           "first": initials[0], "last": initials[-1], "low": turns[0] if turns else None,
           "high": turns[-1] if turns else None, "turns": len(turns), "best": best}
    entry = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
    return pa.Table.from_pylist([out], pa.schema([
        ("key", pa.string()), *[(c, pa.int64()) for c in ("piece", "n", "blank", "duplicate", "truncated", "illegal")],
        ("first", pa.string()), ("last", pa.string()), ("low", pa.int64()), ("high", pa.int64()),
        ("turns", pa.int64()), ("best", pa.list_(entry))]))


def _chain(table: pa.Table) -> pa.Table:
    """The audit of a conversation from those of its pieces: one row for each
    piece with the state before it and its part of the audit, and one (piece
    null) with the figures."""
    pieces = _ordered(table, "piece")
    audits, steps = Audits(), []
    now = {NONE: (0, 0)}
    for p in pieces:
        best = _Best(audits)
        for e in p["best"]:
            if e["start"] in now:
                cost, node = now[e["start"]]
                best.offer(e["stop"], cost + e["cost"], node, e["audit"].encode())
        now = best.of
        steps.append(now)
    tail = _Best(audits)
    tail.of = dict(now)
    cost, node = _accepted(audits, _insert(tail))
    # back along the tree: where the audit passed from piece to piece
    whole, out, end = audits.string(node), [], audits.end[node]
    chosen = node
    ends = []
    for of in reversed(steps):
        while chosen not in {n for _, n in of.values()}:
            chosen = audits.up[chosen][0]
        ends.append((audits.end[chosen], next(s for s, (_, n) in of.items() if n == chosen)))
        chosen = audits.up[chosen][0]
    ends = ends[::-1]
    low, state = 0, NONE
    for k, (p, (high, after)) in enumerate(zip(pieces, ends)):
        high = end if k == len(pieces) - 1 else high
        out.append({"key": p["key"], "piece": p["piece"], "state": state, "part": whole[low:high].decode()})
        low, state = high, after
    dated = [p for p in pieces if p["turns"]]
    turns = sum(p["turns"] for p in dated) - sum(a["high"] == b["low"] for a, b in zip(dated, dated[1:]))
    out.append({"key": pieces[0]["key"], "gaps": dated[-1]["high"] - dated[0]["low"] + 1 - turns if dated else 0,
                **{k: sum(p[k] for p in pieces) for k in ("blank", "duplicate", "truncated")},
                "illegal": sum(p["illegal"] for p in pieces) + sum(
                    a["last"] + b["first"] not in _LEGAL for a, b in zip(pieces, pieces[1:])),
                "cost": cost, "audit": whole.decode()})
    return pa.Table.from_pylist(out, pa.schema([
        ("key", pa.string()), ("piece", pa.int64()), ("state", pa.int32()), ("part", pa.string()),
        *[(c, pa.int64()) for c in _FIGURES], ("audit", pa.string())]))


def _edited_piece(rows: pa.Table, part: pa.Table) -> pa.Table:
    """The repaired lines of a piece, each ended by a line feed."""
    p = part.to_pylist()[0]
    lines = edited([(r["role"], r["text"]) for r in _ordered(rows, "place")], p["part"].encode(), p["state"])
    return pa.table({"key": pa.array([p["key"]], pa.string()), "piece": pa.array([p["piece"]], pa.int64()),
                     "lines": pa.array(["".join(x + "\n" for x in lines)], pa.string())})


def _hash_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the lines of each key, joined by line feeds: one key after the other."""
    now, digest, open_ = None, None, ""

    def result() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"key": pa.array([now], pa.string()),
                                           "repaired_sha256": pa.array([digest.hexdigest()], pa.string())})

    for batch in batches:
        for key, lines in zip(batch.column("key").to_pylist(), batch.column("lines").to_pylist()):
            if key != now:
                if digest is not None:
                    yield result()
                now, digest, open_ = key, hashlib.sha256(), ""
            if lines:
                digest.update((open_ + lines[:-1]).encode())
                open_ = "\n"
    if digest is not None:
        yield result()


def damaged(df: DataFrame) -> DataFrame:
    """``conversations`` with planted faults, by the CRC-32 of ``conv_id:turn``
    modulo 20 (nulls: one space); ``times`` is how often a row stands."""
    space = F.lit(" ")
    key = F.concat(*[F.coalesce(F.col(c).cast("string"), space) if c != ":" else F.lit(c)
                     for c in ("conv_id", ":", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    return df.select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"))


def repaired_conversations(conversations: DataFrame) -> DataFrame:
    return repair(damaged(conversations), times="times")


def _edit(state: str, cost: str, initial: str, line: str | None = None) -> str:
    """SQL: the candidate that follows ``state`` by an edit."""
    lines = f"{state}.lines" + (f" || chr(10) || {line}" if line else "")
    return f"struct_pack(cost := {state}.cost + {cost}, audit := {state}.audit || '{initial}', lines := {lines})"


def _least(*candidates: str) -> str:
    return f"list_min([{', '.join(candidates)}])"


def _oracle() -> str:
    never = 10 ** 9
    nothing = f"struct_pack(cost := CAST({never} AS BIGINT), audit := '', lines := '')"
    empty = "struct_pack(cost := CAST(0 AS BIGINT), audit := '', lines := '')"

    def keep(state, initial):
        return _edit(state, f"stay + CASE WHEN left(role, 1) = '{initial}' THEN 0 ELSE {never} END", "K",
                     "role || ':' || text")

    def rerole(state, role):
        return _edit(state, f"stay + {REROLE}", "R", f"'{role}:' || text")

    def delete(state):
        return _edit(state, str(DELETE), "D")

    def insert(state, role):
        return _edit(state, str(INSERT), "I", f"'{role}:'")

    u_open = _least("u", insert("n", "user"), insert("s", "user"), insert("a", "user"))
    a_open = _least("a", insert("u", "assistant"))
    return f"""
WITH RECURSIVE {CRC_TABLE},
source AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32(
      "(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS k
  FROM conversations, crc),
after AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
         CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE k WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM source),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g') AS bare
  FROM after),
judged AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS earlier
  FROM placed),
rows_ AS (
  SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN {never} WHEN fault = 'truncated' THEN {TRUNCATED} ELSE 0 END AS stay
  FROM judged),
walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, {empty} AS n, {nothing} AS s, {nothing} AS u, {nothing} AS a
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, {delete("n")} AS n, {_least(delete("s"), keep("n", "s"))} AS s,
         {_least(delete("u"), keep("n", "u"), keep("s", "u"), keep("a", "u"),
                 rerole("n", "user"), rerole("s", "user"), rerole("a", "user"))} AS u,
         {_least(delete("a"), keep("u", "a"), rerole("u", "assistant"))} AS a
  FROM (SELECT * EXCLUDE (a), {a_open} AS a FROM (
    SELECT conv_id, i, role, text, stay, n, s, a, {u_open} AS u FROM (
      SELECT r.conv_id, r.i, r.role, r.text, r.stay, w.n, w.s, w.u, w.a
      FROM walk w JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1)))),
ended AS (
  SELECT conv_id, i AS rows_in, list_min([n, a_end]) AS best FROM (
    SELECT *, {_least("a", insert("u_end", "assistant"))} AS a_end FROM (
      SELECT *, {u_open} AS u_end, row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) AS last FROM walk)
    WHERE last = 1)),
figures AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (earlier || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows_ GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.cost AS cost, best.audit AS audit,
       sha256(substr(best.lines, 2)) AS repaired_sha256
FROM ended e LEFT JOIN figures f ON e.conv_id IS NOT DISTINCT FROM f.conv_id"""


ORACLE = _oracle()
