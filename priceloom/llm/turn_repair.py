"""Repairing the structure of conversations by the cheapest edits.

A repaired conversation is empty, or an optional system turn followed by pairs of a user and an assistant
turn. Rows are kept (K), given another role (R) or deleted (D), and empty turns are inserted (I). What an
edit costs depends on a row's symbol alone, its role and its fault, and on how far the turns before it have
come: nothing, after the system turn, after a user turn, after an assistant turn. So each symbol is a 4 x 4
min-plus matrix, and a run of equal symbols is a power of it, put together from cached binary powers.

Matrices are associative, which distributes the work: the rows are sorted over all tasks, without texts,
and cut into blocks of at most 4,096; every block becomes one matrix. Per conversation only these are
chained, backwards, which tells each block the cost of what follows it. Then every block unrolls its own
choices, for each state it may be entered in, and the last pass, which reads a conversation's rows in order
and one at a time, picks the one that came true.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from priceloom.llm.text import fold_text
from priceloom.session import settle

KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
_NEVER = 1 << 60
_BLOCK_BITS = 12
#: States: nothing yet, after a system turn, after a user turn, after an assistant turn.
_NOTHING, _SYSTEM, _USER, _ASSISTANT = range(4)
_ENDS = (_NOTHING, _ASSISTANT)
#: What an inserted or rerolled turn becomes in each state, and the state after it.
_TURN = ("user", "user", "assistant", "user")
_AFTER = (_USER, _USER, _ASSISTANT, _USER)
#: A row's symbol: a digit. 0-3 a sound row of role s, u, a, other; 4-7 the same, truncated; 8 must go.
_GONE = 8


def _kept(symbol: int, state: int) -> int | None:
    """The state after keeping a row of ``symbol``, if that is allowed."""
    role = symbol % 4
    if role == 0:
        return _SYSTEM if state == _NOTHING else None
    if role == 1:
        return _USER if state != _USER else None
    return _ASSISTANT if role == 2 and state == _USER else None


def _moves(symbol: int, state: int) -> list[tuple[int, str, int]]:
    """(cost, letters, next state) of each way past one row, inserts in front of it included."""
    found = []
    for inserts in range(3):  # a third one comes back to where the first led
        before, spent = "I" * inserts, INSERT * inserts
        found.append((spent + DELETE, before + "D", state))
        if symbol != _GONE:
            cut = CUT if symbol >= 4 else 0
            found.append((spent + REROLE + cut, before + "R", _AFTER[state]))
            after = _kept(symbol, state)
            if after is not None:
                found.append((spent + KEEP + cut, before + "K", after))
        state = _AFTER[state]
    return found


_MOVES = [[_moves(symbol, state) for state in range(4)] for symbol in range(9)]
#: Inserts that close a conversation, from each state.
_CLOSING = ("", "II", "I", "")
CLOSED = tuple(INSERT * len(c) for c in _CLOSING)

Matrix = tuple[tuple[int, ...], ...]
Costs = tuple[int, ...]
_IDENTITY: Matrix = tuple(tuple(0 if i == j else _NEVER for j in range(4)) for i in range(4))


def _product(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(_NEVER, *(a[i][k] + b[k][j] for k in range(4))) for j in range(4)) for i in range(4))


def _before(m: Matrix, costs: Costs) -> Costs:
    """Costs from each state before ``m`` on, given those after it."""
    return tuple(min(row[j] + costs[j] for j in range(4)) for row in m)


@lru_cache(maxsize=None)
def _doubled(symbol: int, level: int) -> Matrix:
    """The matrix of 2 ** level rows of one symbol."""
    if level:
        half = _doubled(symbol, level - 1)
        return _product(half, half)
    rows = []
    for state in range(4):
        row = [_NEVER] * 4
        for cost, _, after in _MOVES[symbol][state]:
            row[after] = min(row[after], cost)
        rows.append(tuple(row))
    return tuple(rows)


def runs(symbols: str) -> list[tuple[int, int]]:
    """(symbol, length) of each run of equal symbols."""
    return [(int(symbol), sum(1 for _ in same)) for symbol, same in groupby(symbols)]


@lru_cache(maxsize=1 << 14)
def _power(symbol: int, count: int) -> Matrix:
    out, level = _IDENTITY, 0
    while count:
        if count & 1:
            out = _product(out, _doubled(symbol, level))
        count, level = count >> 1, level + 1
    return out


def transition(symbols: str) -> Matrix:
    """The matrix of a sequence of rows."""
    out = _IDENTITY
    for symbol, count in runs(symbols):
        out = _product(out, _power(symbol, count))
    return out


@lru_cache(maxsize=1 << 16)
def _step(symbol: int, state: int, after: Costs) -> tuple[str, int]:
    """Letters and next state at one row: the cheapest way on, of equals the least in ASCII.

    No way's letters begin another's, so what follows decides nothing between equals.
    """
    _, letters, then = min((cost + after[nxt], letters, nxt) for cost, letters, nxt in _MOVES[symbol][state])
    return letters, then


@lru_cache(maxsize=1 << 12)
def _walk(symbol: int, count: int, state: int, after: Costs) -> tuple[str, int]:
    """The same for a run: its halves by cached powers, the later one first known by its costs."""
    if count == 1:
        return _step(symbol, state, after)
    level = (count - 1).bit_length() - 1
    late = 1 << level  # the rest, at most as long, comes first
    middle = _relative(_before(_doubled(symbol, level), after))
    letters, state = _walk(symbol, count - late, state, middle)
    more, state = _walk(symbol, late, state, after)
    return letters + more, state


def _relative(costs: Costs) -> Costs:
    """Only differences decide; the least becomes zero, so that few different ones occur."""
    least = min(costs)
    return tuple(c - least for c in costs)


def unroll(symbols: str, after: Costs) -> tuple[list[str], list[int]]:
    """For each state before ``symbols``: the letters of the best way through, and the state at its end."""
    parts, ahead = runs(symbols), [_relative(after)]
    for symbol, count in reversed(parts[1:]):
        ahead.append(_relative(_before(_power(symbol, count), ahead[-1])))
    ahead.reverse()
    texts, ends = [], []
    for state in range(4):
        out = []
        for (symbol, count), costs in zip(parts, ahead, strict=False):
            letters, state = _walk(symbol, count, state, costs)
            out.append(letters)
        texts.append("".join(out))
        ends.append(state)
    return texts, ends


# --- tables ------------------------------------------------------------------------------------------

_BLANKS = " \t\n\x0b\x0c\r"


def _read(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with planted faults, by crc32 of ``conv_id:turn`` modulo 20.

    0 drops the row, 1 empties its text, 2 removes its sentence marks, 3 repeats it, 4 makes it a user's.
    Nulls of a role, a text or in the key count as one space. Other columns go.
    """
    kind = fold_text(F.concat(_read("conv_id"), F.lit(":"), _read("turn")), 20)
    base = rows.select("conv_id", "turn", _read("role").alias("role"), _read("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
    return base.where("kind <> 0").select(
        "conv_id", "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_again"),
    ).drop("_again")


def _order(rows: DataFrame) -> DataFrame:
    """The four columns, and what sorts rows of one turn: role, the text's first 64 characters, a digest of both."""
    whole = rows.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), _read("role").alias("role"), _read("text").alias("text")
    )
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    return whole.withColumns({"head": F.substring("text", 1, 64), "digest": digest})


_SORT = ["conv_id", "turn", "role", "head", "digest"]


def _symbol() -> Column:
    """The row's symbol unless it is a duplicate."""
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    bare = F.rtrim(F.col("text"), F.lit(_BLANKS))
    cut = ~F.substring(bare, -1, 1).isin(".", "!", "?")
    return F.when(bare == "", _GONE).when(cut, role + 4).otherwise(role)


_BLOCK = "conv_id long, block long, symbols string, costs array<long>, blank long, duplicate long, truncated long, illegal long, first string, last string"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for conv, block, entries in zip(*(batch.column(n).to_pylist() for n in range(3)), strict=True):
            firsts = {e["seq"] for e in entries if e["symbol"] is None}
            rows = sorted((e["seq"], e["symbol"], e["initial"]) for e in entries if e["symbol"] is not None)
            blank = sum(s == _GONE for _, s, _ in rows)
            marks = [_GONE if seq not in firsts else s for seq, s, _ in rows]
            symbols = "".join(map(str, marks))
            roles = [i for _, _, i in rows]
            illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:], strict=False))
            out.append((conv, block, symbols, [c for row in transition(symbols) for c in row], blank,
                        marks.count(_GONE) - blank, sum(4 <= m < 8 for m in marks), illegal, roles[0], roles[-1]))
        yield _batch(out, _BLOCK)


_FIGURES = ["cost", "blank", "duplicate", "truncated", "illegal"]
_CHAINED = "conv_id long, block long, after array<long>, " + ", ".join(f"{c} long" for c in _FIGURES)


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of each conversation, last one first: the costs after it; the counts at its first block."""
    for batch in batches:
        for conv, blocks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            out, after = [], CLOSED
            for b in reversed(blocks):
                m = tuple(tuple(b["costs"][4 * i : 4 * i + 4]) for i in range(4))
                out.append((conv, b["block"], list(after), None, None, None, None, None))
                after = _before(m, after)
            sums = [sum(b[n] for b in blocks) for n in ("blank", "duplicate", "truncated", "illegal")]
            sums[3] += sum(a["last"] + b["first"] not in ("su", "ua", "au") for a, b in zip(blocks, blocks[1:], strict=False))
            out[-1] = (*out[-1][:3], after[_NOTHING], *sums)
            yield _batch(out, _CHAINED)


_UNROLLED = "conv_id long, block long, letters array<string>, ends array<int>, " + ", ".join(f"{c} long" for c in _FIGURES)


def _unrolled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for conv, block, symbols, after, *counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            out.append((conv, block, *unroll(symbols, tuple(after)), *counts))
        yield _batch(out, _UNROLLED)


_KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
_KINDS |= {f"array<{name}>": pa.list_(kind) for name, kind in _KINDS.items()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [column.split() for column in schema.split(", ")]
    cells = list(zip(*rows, strict=True)) or [[] for _ in fields]
    arrays = [pa.array(cell, _KINDS[kind]) for cell, (_, kind) in zip(cells, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def plan(rows: DataFrame) -> DataFrame:
    """(conv_id, block, letters, ends, cost, blank, duplicate, truncated, illegal): blocks in order.

    ``letters`` and ``ends`` hold, for each state before the block, its edits and the state after them. The
    figures of the whole conversation stand at its first block. No text is shuffled.
    """
    ordered = _order(rows).select(*_SORT, _symbol().alias("symbol"), F.substring("role", 1, 1).alias("initial"))
    # Sorted over all tasks: a conversation may lie in many, and the number grows along it.
    ordered = ordered.repartitionByRange(*_SORT).sortWithinPartitions(*_SORT)
    ordered = settle(ordered.select("conv_id", "digest", "symbol", "initial", F.monotonically_increasing_id().alias("seq")), "turns")
    # A blank row is blank however often it occurs; of others all but the first are duplicates.
    firsts = ordered.groupBy("conv_id", "digest").agg(F.min("seq").alias("seq"))
    entry = F.struct("seq", "symbol", "initial")
    marks = firsts.select("conv_id", "seq", F.lit(None).cast("int").alias("symbol"), F.lit(None).cast("string").alias("initial"))
    both = ordered.select("conv_id", "seq", "symbol", "initial").unionByName(marks)
    cut = both.groupBy("conv_id", F.shiftright("seq", _BLOCK_BITS).alias("block")).agg(F.collect_list(entry).alias("entries"))
    blocks = settle(cut.mapInArrow(_blocks, _BLOCK), "blocks")
    told = F.struct(*[F.col(c) for c in blocks.columns if c not in ("conv_id", "symbols")])
    chained = blocks.groupBy("conv_id").agg(F.sort_array(F.collect_list(told)).alias("blocks")).mapInArrow(_chain, _CHAINED)
    rows_of = blocks.select(F.col("conv_id").alias("_conv"), F.col("block").alias("_block"), "symbols")
    same = (F.col("block") == F.col("_block")) & F.col("conv_id").eqNullSafe(F.col("_conv"))
    whole = chained.join(rows_of, same).select("conv_id", "block", "symbols", "after", *_FIGURES)
    return settle(whole.mapInArrow(_unrolled, _UNROLLED), "edits")


def _streamed(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """Each conversation's blocks of edits, then its rows, both in order; texts move here and nowhere else."""
    text = _order(rows).select(*_SORT, "text", F.lit(1).alias("kind"))
    plans = edits.select("conv_id", "block", "letters", "ends", F.lit(0).alias("kind"))
    both = plans.unionByName(text, allowMissingColumns=True).repartition("conv_id")
    return both.sortWithinPartitions("conv_id", "kind", "block", *_SORT[1:]).select(
        "conv_id", "kind", "letters", "ends", "role", "text"
    )


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, letter, role, text), one edit at a time; an ``E`` ends each conversation, with its audit."""
    conv, started, audit, state, at, letters = None, False, [], _NOTHING, 0, ""

    def inserted():
        nonlocal state, at
        while at < len(letters) and letters[at] == "I":
            role, state, at = _TURN[state], _AFTER[state], at + 1
            yield conv, "I", role, ""

    for batch in batches:
        for start in range(0, batch.num_rows, 256):  # long texts: some at a time
            for now, kind, choices, ends, role, text in zip(*(c.to_pylist() for c in batch.slice(start, 256).columns), strict=True):
                if started and now != conv:
                    yield from inserted()
                    yield conv, "E", letters, ""
                    audit, state, at, letters = [], _NOTHING, 0, ""
                conv, started = now, True
                if kind == 0:
                    audit.append(choices[state])
                    state = ends[state]
                    continue
                if not letters:
                    letters, state = "".join(audit) + _CLOSING[state], _NOTHING
                yield from inserted()
                letter, at = letters[at], at + 1
                if letter == "K":
                    state = {"s": _SYSTEM, "u": _USER, "a": _ASSISTANT}[role[0]]
                    yield conv, "K", role, text
                elif letter == "R":
                    role, state = _TURN[state], _AFTER[state]
                    yield conv, "R", role, text
                else:
                    yield conv, "D", role, text
    if started:
        yield from inserted()
        yield conv, "E", letters, ""


def repaired_turns(rows: DataFrame, edits: DataFrame | None = None) -> DataFrame:
    """(conv_id, place, edit, role, text): every edit of every conversation, in order.

    ``edit`` is K, R, D or I; deleted rows show what was deleted, the others make up the repaired
    conversation. A conversation streams through one task, a row at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held, place = [], 0, 0
        for conv, letter, role, text in _edited(batches):
            if letter == "E":
                place = 0
                continue
            out.append((conv, place, letter, role, text))
            place, held = place + 1, held + len(text)
            if len(out) >= 2_000 or held > 1 << 22:
                yield _batch(out, schema)
                out, held = [], 0
        yield _batch(out, schema)

    schema = "conv_id long, place long, edit string, role string, text string"
    return _streamed(rows, plan(rows) if edits is None else edits).mapInArrow(run, schema)


def audits(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """(conv_id, audit, repaired_sha256): the edits' letters, and a digest of the repaired ``role:text`` lines.

    The lines go into the digest one by one, so a long conversation needs no more memory than its audit.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, digest, between = [], hashlib.sha256(), b""
        for conv, letter, role, text in _edited(batches):
            if letter == "E":
                out.append((conv, role, digest.hexdigest()))
                digest, between = hashlib.sha256(), b""
                if len(out) == 2_000:
                    yield _batch(out, schema)
                    out = []
            elif letter != "D":
                digest.update(between + f"{role}:{text}".encode())
                between = b"\n"
        yield _batch(out, schema)

    schema = "conv_id long, audit string, repaired_sha256 string"
    return _streamed(rows, edits).mapInArrow(run, schema)


def repair(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """One row per conversation: gaps, faults, the cost of repair, its audit and a digest of what comes out.

    ``rows`` are (conv_id, turn, role, text); a null role or text counts as one space, other columns are
    ignored. They are taken by turn, nulls first; rows of one turn by role, the text's first 64 characters and
    a digest of both, and equal rows are interchangeable. A row's first fault counts: blank, duplicate (role
    and text seen before) or truncated (its last character that is not blank ends no sentence). A role without
    characters has no initial and cannot be kept. ``conversations`` (conv_id) adds those without rows: zeros, an
    empty audit and the digest of nothing. A null conv_id is a conversation like others; empty tables give none.
    """
    edits = plan(rows)
    count = lambda c: F.coalesce(F.max(c), F.lit(0)).cast("long")
    gaps = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    parts = [
        rows.groupBy("conv_id").agg(F.coalesce(gaps, F.lit(0)).alias("gaps")),
        edits.where("cost IS NOT NULL").select("conv_id", *_FIGURES),
        audits(rows, edits),
    ]
    if conversations is not None:
        parts.append(conversations.select(F.col("conv_id").cast("long")).distinct())
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    nothing = hashlib.sha256().hexdigest()
    return whole.groupBy("conv_id").agg(
        count("gaps").alias("gaps"), *[count(c).alias(c) for c in _FIGURES],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(nothing)).alias("repaired_sha256"),
    )
