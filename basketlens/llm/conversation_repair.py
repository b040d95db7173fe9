"""Repair of the turn structure of conversations at least cost, by Four-Russians block tables.

A conversation is well formed if its roles read: perhaps a system turn, then user and assistant in turn, ending with the
assistant; or nothing at all. Rows can be kept, given another role or deleted, and empty turns can be put in; the cheapest
such edits are a shortest path through four states. What the rest of a conversation costs from each state is a vector of
four numbers. Less its minimum, only few vectors occur. Their transitions under all blocks of four row symbols are
computed once; a conversation is then read from its end block by block, one look-up each. The vectors within the blocks
are expanded backward from their right ends, and the edits are read off forward: at every step the first letter in ASCII
order that still leads to the least cost, which gives the least string of edits among the cheapest.

Rows get a place in the order of all conversations by a range-partitioned sort, and are dealt to tasks in fragments of
``fragment_rows`` places, so a conversation of any length is cut. What a fragment does to a vector is a matrix of
sixteen numbers; where a conversation spans several fragments, their matrices give the vector at each cut, and then their
maps of states the state at each cut. All fragments are traced at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.plans.numbering import number_rows
from basketlens.plans.workspace import written

FRAGMENT_ROWS = 65_536
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
# States: nothing yet, after the system turn, after a user, after an assistant. A conversation may end in the first and last.
_STATES = 4
_START, _SYSTEM, _USER, _ASSISTANT = range(_STATES)
_NEXT = {_START: _USER, _SYSTEM: _USER, _USER: _ASSISTANT, _ASSISTANT: _USER}
# Symbols of rows: to be deleted, then by initial s, u, a, other, and the same for truncated ones; the last fills blocks up.
_INITIALS = "sua"
_GONE, _FILL, _SYMBOLS = 0, 9, 10
_BLOCK = 4
_NEVER = 1 << 40
_BLANK = r"[^\x20\x09-\x0D]"
_CUT_OFF = r"[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*\z"


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` (conv_id, turn, role, text) with faults, by the CRC-32 of ``conv_id:turn`` modulo 20.

    0 drops the row, 1 empties its text, 2 takes out its ``.!?``, 3 repeats it, 4 makes its role user. A null role or text, and a
    null in the key, is one space first.
    """
    space = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    kind = F.crc32(key) % 20
    text = F.coalesce("text", space)
    rows = conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("_copy"),
        kind.alias("_kind"),
    )
    return rows.where("_kind != 0").drop("_copy", "_kind")


# ---- tables ---------------------------------------------------------------------------------------------


def _with_inserts(v: list[int]) -> tuple[int, ...]:
    """The vector if turns may be put in first."""
    user = min(v[_USER], INSERT + v[_ASSISTANT])
    out = [min(v[q], INSERT + user) for q in range(_STATES)]
    out[_USER] = user
    out[_ASSISTANT] = min(v[_ASSISTANT], INSERT + v[_USER])
    return tuple(min(x, _NEVER) for x in out)


def _moves(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) of a row, in ASCII order of the edits."""
    moves = [("D", DELETE, state)]
    if symbol != _GONE:
        extra, initial = (TRUNCATED if symbol > 4 else 0), (symbol - 1) % 4
        to = (_SYSTEM, _USER, _ASSISTANT, None)[initial]
        if to == _NEXT[state] or to == _SYSTEM and state == _START:
            moves.append(("K", KEEP + extra, to))
        moves.append(("R", REROLE + extra, _NEXT[state]))
    return moves


def _before(symbol: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """The vector before a row, from that after it."""
    best = [min(cost + after[to] for _, cost, to in _moves(symbol, q)) for q in range(_STATES)]
    return _with_inserts(best)


def _normal(v: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    least = min(v)
    return tuple(_NEVER if x >= _NEVER else x - least for x in v), least


class Tables:
    """All normalised vectors, their transitions by symbols and by blocks, and the edits that they lead to."""

    def __init__(self) -> None:
        never = [_NEVER] * _STATES
        accept = _with_inserts([0, _NEVER, _NEVER, 0])
        ends = [_with_inserts(never[:q] + [0] + never[q + 1 :]) for q in range(_STATES)]
        self.vectors: list[tuple[int, ...]] = []
        self.number: dict[tuple[int, ...], int] = {}
        self.accept, *self.ends = (self._numbered(_normal(v)[0]) for v in [accept, *ends])
        step, cost = [], []
        done = 0
        while done < len(self.vectors):
            to, less = zip(*(_normal(_before(s, self.vectors[done])) for s in range(_FILL)))
            step.append([*map(self._numbered, to), done])
            cost.append([*less, 0])
            done += 1
        self.step, self.cost = np.array(step), np.array(cost, np.int64)
        self.value = np.array(self.vectors, np.int64)
        # One look-up per block: the transitions of its last symbol, then those of the symbols before.
        v = np.arange(done)[:, None]
        self.block, self.block_cost = np.broadcast_to(v, (done, 1)), np.zeros((done, 1), np.int64)
        for _ in range(_BLOCK):
            # The symbol that stands first is the highest digit of a code.
            here, paid = self.block[:, None, :], self.block_cost[:, None, :]
            symbols = np.arange(_SYMBOLS)[None, :, None]
            self.block, self.block_cost = (
                self.step[here, symbols].reshape(done, -1),
                (paid + self.cost[here, symbols]).reshape(done, -1),
            )
        self.inserts: list[str] = [""]
        self.edit = np.full((done, _SYMBOLS, _STATES), "", dtype="U1")
        self.insert = np.zeros((done, _SYMBOLS, _STATES), np.int64)
        self.to = np.broadcast_to(np.arange(_STATES), (done, _SYMBOLS, _STATES)).copy()
        for i in range(done):
            for s in range(_FILL):
                for q in range(_STATES):
                    self._decide(i, s, q)

    def _numbered(self, v: tuple[int, ...]) -> int:
        if v not in self.number:
            self.number[v] = len(self.vectors)
            self.vectors.append(v)
        return self.number[v]

    def _decide(self, i: int, symbol: int, state: int) -> None:
        after = self.vectors[i]
        now, at, put = _before(symbol, after), state, ""
        if now[state] >= _NEVER:
            return
        while True:
            fits = [m for m in _moves(symbol, at) if m[1] + after[m[2]] == now[at]]
            if fits and fits[0][0] == "D" or INSERT + now[_NEXT[at]] != now[at]:
                break
            at = _NEXT[at]
            put += "ua"[at == _ASSISTANT]
        if put not in self.inserts:
            self.inserts.append(put)
        self.edit[i, symbol, state], _, self.to[i, symbol, state] = fits[0]
        self.insert[i, symbol, state] = self.inserts.index(put)


@cache
def tables() -> Tables:
    return Tables()


class Runs:
    """Rows of several conversations' fragments, filled up at their fronts to whole blocks; the longest first."""

    def __init__(self, symbols: np.ndarray, starts: np.ndarray) -> None:
        ends = np.append(starts[1:], len(symbols))
        self.order = np.argsort(starts - ends, kind="stable")
        starts, sizes = starts[self.order], (ends - starts)[self.order]
        self.n_blocks = -(-sizes // _BLOCK)
        self.first = np.cumsum(self.n_blocks) - self.n_blocks
        place = np.repeat((self.first + self.n_blocks) * _BLOCK - sizes - starts, sizes)
        rows = np.concatenate([np.arange(s, s + n) for s, n in zip(starts.tolist(), sizes.tolist())])
        #: Where each row stands among the filled up rows.
        self.place = np.empty(len(symbols), np.int64)
        self.place[rows] = rows + place
        self.symbols = np.full(int(self.n_blocks.sum()) * _BLOCK, _FILL)
        self.symbols[self.place] = symbols
        # How many runs have a block t, as the longest come first.
        self.active = np.searchsorted(-self.n_blocks, -np.arange(int(self.n_blocks.max())), side="left")

    def backward(self, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """From the vector at the end of each run: the one after each row, the one before the run, and the cost between."""
        t = tables()
        blocks = self.symbols.reshape(-1, _BLOCK)
        codes = blocks @ (_SYMBOLS ** np.arange(_BLOCK - 1, -1, -1))
        now, paid = right.copy(), np.zeros(len(right), np.int64)
        ends = np.empty(len(blocks), np.int64)
        for k, active in enumerate(self.active.tolist()):
            block = self.first[:active] + self.n_blocks[:active] - 1 - k
            ends[block] = now[:active]
            paid[:active] += t.block_cost[now[:active], codes[block]]
            now[:active] = t.block[now[:active], codes[block]]
        after = np.empty_like(blocks)
        after[:, -1] = ends
        for i in range(_BLOCK - 1, 0, -1):
            after[:, i - 1] = t.step[after[:, i], blocks[:, i]]
        return after.ravel(), now, paid

    def forward(self, after: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """From the state before each run: that before each row, and the one at the end."""
        t = tables()
        states, now = np.empty(len(self.symbols), np.int64), state.copy()
        for k, active in enumerate(self.active.tolist()):
            for i in range(_BLOCK):
                at = (self.first[:active] + k) * _BLOCK + i
                states[at] = now[:active]
                now[:active] = t.to[after[at], self.symbols[at], now[:active]]
        return states, now


def _by_run(
    solve: Callable[[pa.RecordBatch, Runs], pa.RecordBatch],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (frag, run, _pos, symbol, …) come sorted by fragment and place; ``run`` numbers conversations; whole runs are solved."""

    def solved(rows: pa.RecordBatch) -> pa.RecordBatch:
        marks = [rows.column(c).to_numpy() for c in ("_frag", "_run")]
        new = np.ones(len(rows), bool)
        new[1:] = np.any([m[1:] != m[:-1] for m in marks], axis=0)
        return solve(rows, Runs(rows.column("_symbol").to_numpy().astype(np.int64), np.flatnonzero(new)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.RecordBatch | None = None
        for batch in batches:
            if rest is not None:
                batch = pa.concat_batches([rest, batch])
            if not len(batch):
                continue
            same = (batch.column("_run").to_numpy() == batch.column("_run")[-1].as_py()) & (
                batch.column("_frag").to_numpy() == batch.column("_frag")[-1].as_py()
            )
            cut = int(np.flatnonzero(~same).max()) + 1 if not same.all() else 0
            rest = batch.slice(cut)
            if cut:
                yield solved(batch.slice(0, cut))
        if rest is not None:
            yield solved(rest)

    return run


def _first_of(rows: pa.RecordBatch, runs: Runs, column: str) -> np.ndarray:
    """A column's value per run, in the order of ``runs``."""
    first = np.empty(len(runs.order), np.int64)
    by_place = np.argsort(runs.place, kind="stable")
    starts = np.searchsorted(runs.place[by_place], runs.first * _BLOCK)
    first[:] = rows.column(column).to_numpy()[by_place[starts]]
    return first


def _matrix(rows: pa.RecordBatch, runs: Runs) -> pa.RecordBatch:
    """What each run costs from each state at its front to each state at its end."""
    t, out = tables(), []
    for end in t.ends:
        _, number, paid = runs.backward(np.full(len(runs.order), end))
        out.append(np.minimum(t.value[number] + paid[:, None], _NEVER))
    flat = np.stack(out, axis=2).reshape(len(runs.order), -1)
    return pa.RecordBatch.from_arrays(
        [pa.array(_first_of(rows, runs, c)) for c in ("_run", "_frag")] + [pa.array(flat.tolist(), pa.list_(pa.int64()))],
        ["_run", "_frag", "matrix"],
    )


def _state_map(rows: pa.RecordBatch, runs: Runs) -> pa.RecordBatch:
    """The state at the end of each run, for each at its front."""
    after, _, _ = runs.backward(_first_of(rows, runs, "_right"))
    ends = [runs.forward(after, np.full(len(runs.order), q))[1] for q in range(_STATES)]
    return pa.RecordBatch.from_arrays(
        [pa.array(_first_of(rows, runs, c)) for c in ("_run", "_frag")]
        + [pa.array(np.stack(ends, axis=1).tolist(), pa.list_(pa.int64()))],
        ["_run", "_frag", "states"],
    )


def _edits(rows: pa.RecordBatch, runs: Runs) -> pa.RecordBatch:
    t = tables()
    after, _, _ = runs.backward(_first_of(rows, runs, "_right"))
    before, ends = runs.forward(after, _first_of(rows, runs, "_state"))
    at = (after[runs.place], runs.symbols[runs.place], before[runs.place])
    edit, to = t.edit[at], t.to[at]
    put = np.array(t.inserts, dtype="U8")[t.insert[at]]
    # A conversation that ends in the wrong state gets turns after its last row.
    trailing = np.full(len(rows), "", dtype="U2")
    last = _first_of(rows, runs, "_last")
    final = np.empty(len(runs.symbols), np.int64)
    final[runs.place] = np.arange(len(rows))
    trailing[final[(runs.first + runs.n_blocks) * _BLOCK - 1]] = np.where(
        last == 1, np.array(["", "ua", "a", ""])[ends], ""
    )
    role = np.where(edit == "R", np.where(to == _USER, "user", "assistant"), "")
    cost = np.select([edit == "D", edit == "R"], [DELETE, REROLE], KEEP) + INSERT * (np.char.str_len(put) + np.char.str_len(trailing))
    cost = cost + np.where((edit != "D") & (at[1] > 4), TRUNCATED, 0)
    return pa.RecordBatch.from_arrays(
        [rows.column("_pos"), pa.array(put), pa.array(edit), pa.array(role), pa.array(trailing), pa.array(cost.astype(np.int64))],
        ["_pos", "before", "edit", "new_role", "after", "cost"],
    )


# ---- over fragments -------------------------------------------------------------------------------------


def _right_vectors(fragments: list) -> list[tuple[int, int, int]]:
    """(fragment, vector at its end, whether it is the last) from the matrices of one conversation, by fragment."""
    t, out, last = tables(), [], True
    v = np.array(t.vectors[t.accept])
    for frag, matrix in reversed(fragments):
        v = v - v.min()
        out.append((int(frag), t.number[tuple(v.tolist())], int(last)))
        v, last = (np.array(matrix).reshape(_STATES, _STATES) + v).min(axis=1), False
    return out


def _start_states(fragments: list) -> list[tuple[int, int]]:
    """(fragment, state at its front) from the maps of one conversation, by fragment."""
    out, state = [], _START
    for frag, states in fragments:
        out.append((int(frag), state))
        state = int(states[state])
    return out


def _per_conversation(
    told: DataFrame, column: str, combine: Callable[[list], list[tuple]], fields: list[str]
) -> DataFrame:
    """``combine`` over each conversation's fragments in order; what is gathered is a few numbers per fragment."""
    parts = told.groupBy("_run").agg(F.sort_array(F.collect_list(F.struct("_frag", column))).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (mark, *row)
                for mark, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for row in combine([(p["_frag"], p[column]) for p in parts])
            ]
            columns = list(zip(*rows)) if rows else [[] for _ in range(len(fields) + 1)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["_run", *fields])

    return parts.mapInArrow(run, ", ".join(f"{c} long" for c in ["_run", *fields]))


def _sorted(rows: DataFrame) -> DataFrame:
    return rows.repartition("_frag").sortWithinPartitions("_frag", "_pos")


def _traced(symbols: DataFrame) -> DataFrame:
    """(_pos, before, edit, new_role, after, cost) of every row of ``symbols`` (_pos, _frag, _run, _symbol), a stored table."""
    t = tables()
    spans = symbols.groupBy("_run").agg(F.min("_frag").alias("low"), F.max("_frag").alias("high"))
    spans = written(spans.where("low < high").select("_run"), "cut-conversations")
    alone = symbols.withColumns({"_right": F.lit(t.accept), "_state": F.lit(_START), "_last": F.lit(1)})
    columns = ["_pos", "_frag", "_run", "_symbol", "_right", "_state", "_last"]
    if not spans.isEmpty():
        cut = written(symbols.join(spans, "_run"), "cut-rows")
        matrices = _sorted(cut).mapInArrow(_by_run(_matrix), "_run long, _frag long, matrix array<long>")
        rights = _per_conversation(matrices, "matrix", _right_vectors, ["_frag", "_right", "_last"])
        cut = written(cut.join(written(rights, "right-vectors"), ["_run", "_frag"]), "cut-rows")
        maps = _sorted(cut).mapInArrow(_by_run(_state_map), "_run long, _frag long, states array<long>")
        states = _per_conversation(maps, "states", _start_states, ["_frag", "_state"])
        cut = cut.join(written(states, "start-states"), ["_run", "_frag"])
        whole = alone.join(spans, "_run", "left_anti")
        alone = whole.select(*columns).unionByName(cut.select(*columns))
    schema = "_pos long, before string, edit string, new_role string, after string, cost long"
    typed = alone.select(*[F.col(c).cast("long").alias(c) for c in columns])
    return _sorted(typed).mapInArrow(_by_run(_edits), schema)


def _symbol(blank_or_seen: Column, truncated: Column) -> Column:
    initial = F.instr(F.lit(_INITIALS), F.substring("role", 1, 1))
    initial = F.when((F.length("role") == 0) | (initial == 0), 4).otherwise(initial)
    return F.when(blank_or_seen, _GONE).otherwise(initial + F.when(truncated, 4).otherwise(0))


def repair(conversations: DataFrame, fragment_rows: int = FRAGMENT_ROWS) -> DataFrame:
    """Every row of ``conversations`` (conv_id, turn, role, text) in order, with its fault and its edit.

    Adds ``place`` (in the order of all conversations), ``fault`` (blank, duplicate, truncated or null: the first that holds),
    ``illegal`` (whether it cannot follow the row before it), ``before`` and ``after`` (initials of empty turns put in beside it),
    ``edit`` (K, R or D), ``new_role`` (of a row that is kept) and ``cost``. Rows go by turn, nulls first, then role and text; equal rows
    are copies of each other. A null role or text counts as one space. A null conv_id is a conversation like any other. Other
    columns are not read; no rows give none.
    """
    space = F.lit(" ")
    rows = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text")
    )
    # Equal rows of a hot conversation are told apart by chance, so that the sort can cut between them.
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text"), F.asc("_chance")]
    placed = number_rows(rows.withColumn("_chance", F.rand(12)), order, "_pos").drop("_chance")
    blank = ~F.col("text").rlike(_BLANK)
    narrow = placed.select(
        "conv_id", "_pos", "role", F.unhex(F.sha2("text", 256)).alias("_mark"), blank.alias("_blank"),
        F.col("text").rlike(_CUT_OFF).alias("_cut_off"),
    )
    narrow = written(narrow, "narrow-rows")
    seen = narrow.groupBy("conv_id", "role", "_mark").agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("n"))
    seen = seen.where("n > 1").drop("n").select(*[F.col(c).alias(f"s_{c}") for c in ("conv_id", "role", "_mark")], "_first")
    same = [F.col(c).eqNullSafe(F.col(f"s_{c}")) for c in ("conv_id", "role", "_mark")]
    again = narrow.join(seen, same[0] & same[1] & same[2]).where("_pos > _first").select("_pos", F.lit(True).alias("_seen"))
    # A conversation is numbered by the place of its first row.
    runs = narrow.groupBy("conv_id").agg(F.min("_pos").alias("_run")).withColumnRenamed("conv_id", "r_conv_id")
    told = narrow.join(again, "_pos", "left").join(runs, F.col("conv_id").eqNullSafe(F.col("r_conv_id")))
    gone = F.col("_blank") | F.coalesce("_seen", F.lit(False))
    fault = F.when(F.col("_blank"), "blank").when(F.col("_seen"), "duplicate").when(F.col("_cut_off"), "truncated")
    told = written(
        told.select(
            "_pos", "_run", F.floor(F.col("_pos") / fragment_rows).alias("_frag"), _symbol(gone, F.col("_cut_off")).alias("_symbol"),
            fault.alias("fault"), F.substring("role", 1, 1).alias("_initial"),
        ),
        "row-symbols",
    )
    earlier = told.select((F.col("_pos") + 1).alias("_pos"), F.col("_run").alias("_run_before"), F.col("_initial").alias("_initial_before"))
    pair = F.concat("_initial_before", "_initial")
    illegal = (F.col("_run") == F.col("_run_before")) & ~pair.isin("su", "ua", "au")
    edits = _traced(told.select("_pos", "_frag", "_run", "_symbol"))
    joined = told.join(earlier, "_pos", "left").select("_pos", "fault", F.coalesce(illegal, F.lit(False)).alias("illegal"))
    joined = written(joined.join(edits, "_pos"), "row-edits")
    new_role = F.when(F.col("edit") == "R", F.col("new_role")).when(F.col("edit") == "K", F.col("role"))
    return placed.join(joined, "_pos").select(
        "conv_id", F.col("_pos").alias("place"), "turn", "role", "text", "fault", "illegal", "before", "edit",
        new_role.alias("new_role"), "after", "cost",
    )


def repaired_turns(repaired: DataFrame) -> DataFrame:
    """(conv_id, place, nth, role, text): the turns of the repaired conversations, from what :func:`repair` returns."""

    def empty(initials: str) -> Column:
        each = F.filter(F.split(initials, ""), lambda c: c != "")
        return F.transform(each, lambda c: F.struct(F.when(c == "u", "user").otherwise("assistant").alias("role"), F.lit("").alias("text")))

    own = F.when(F.col("edit") != "D", F.array(F.struct(F.col("new_role").alias("role"), "text")))
    turns = F.concat(empty("before"), F.coalesce(own, F.array().cast("array<struct<role:string,text:string>>")), empty("after"))
    rows = repaired.select("conv_id", "place", F.posexplode(turns).alias("nth", "turn"))
    return rows.select("conv_id", "place", "nth", "turn.role", "turn.text")


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, text, before, edit, new_role, after) come sorted; a conversation's turns run through its hash."""
    conv, audit, digest, filled = None, None, None, False
    for batch in batches:
        out: list[tuple] = []
        for row in batch.to_pylist():
            if audit is None or row["conv_id"] != conv:
                if audit is not None:
                    out.append((conv, "".join(audit), digest.hexdigest()))
                conv, audit, digest, filled = row["conv_id"], [], hashlib.sha256(), False
            turns = [f"{'user' if c == 'u' else 'assistant'}:" for c in row["before"]]
            if row["edit"] != "D":
                turns.append(f"{row['new_role']}:{row['text']}")
            turns += [f"{'user' if c == 'u' else 'assistant'}:" for c in row["after"]]
            audit.append("I" * len(row["before"]) + row["edit"] + "I" * len(row["after"]))
            for turn in turns:
                digest.update((("\n" if filled else "") + turn).encode())
                filled = True
        yield _digests(out, batch.schema.field("conv_id").type)
    if audit is not None:
        yield _digests([(conv, "".join(audit), digest.hexdigest())], batch.schema.field("conv_id").type)


def _digests(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    types = [kind, pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["conv_id", "audit", "sha256"])


def audits(repaired: DataFrame) -> DataFrame:
    """(conv_id, audit, sha256): the edits of each conversation as one string, and the hash of its repaired ``role:text`` lines.

    From what :func:`repair` returns. One string and one hash go over a whole conversation in order, so a task reads it
    through, a row at a time; of its texts it keeps nothing.
    """
    columns = ["conv_id", "place", "text", "before", "edit", "new_role", "after"]
    rows = repaired.select(*columns).repartition("conv_id").sortWithinPartitions("place")
    kind = repaired.schema["conv_id"].dataType.simpleString()
    return rows.mapInArrow(_digested, f"conv_id {kind}, audit string, sha256 string")
