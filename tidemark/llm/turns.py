"""Repair of conversation structure: turns aligned to the alternating grammar ``(s?(ua)+)?``.

Target alignment. Every feasible length of the alternating string is a target of its own,
and all of them are suffixes of ``...uaua``; so one Wagner-Fischer table from the end
(rows left by target letters left) holds the costs of all lengths. A Ukkonen band
limits it: a cell whose offset alone needs more inserts or deletes than an incumbent
repair costs lies on no cheapest path. A leading ``s`` can only be a kept turn, with
everything before it deleted, so it is one more value per row.

The audits of all cheapest lengths are traced back together: at each step the least
letter any of them can take is taken, and only those that took it go on.

Long conversations are aligned in blocks of turns. At a border only the cheapest cost of
each class of lengths counts (none left, odd, even), so a block's table is the only one
in memory; borders are found from the end, audits from the start.

Spark sorts the turns of a conversation; a task streams over them and holds one byte per
turn. The texts are hashed in a second pass that streams too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

#: Turns of one block.
BLOCK = 256
#: Costs of the edits.
REROLE, DELETE, INSERT = 2, 3, 2
_NONE = 1 << 28
_KINDS = {"u": 0, "a": 1, "s": 2, "o": 3}
_ROLES = ("user", "assistant")
#: Turns of a conversation whose repair is remembered, as many others look alike.
_SHORT = 64

_WHITE = " \t\n\x0b\x0c\r"


class _Rows:
    """Undeleted turns of a code string: kind, truncation, and how many forced deletes stand before each."""

    def __init__(self, codes: str) -> None:
        raw = np.frombuffer(codes.encode("ascii"), np.uint8)
        at = np.flatnonzero(raw != ord("-"))
        lookup = np.full(256, 3, np.int8)
        for letter, kind in _KINDS.items():
            lookup[ord(letter)] = lookup[ord(letter.upper())] = kind
        self.kind = lookup[raw[at]]
        self.cut = (raw[at] < ord("a")).astype(np.int32)
        self.forced = np.diff(np.concatenate([[-1], at, [len(raw)]])) - 1
        self.count = len(at)


def _incumbent(kind: np.ndarray, cut: np.ndarray) -> int:
    """Cost of a plain repair from the end: a turn of the wrong role gets one inserted behind it, any other a new role."""
    cost, due = int(cut.sum()), 1
    for k in kind[::-1].tolist():
        if k >= 2:
            cost += REROLE
        elif k != due:
            cost += INSERT
            due ^= 1
        due ^= 1
    return cost


def _table(kind: np.ndarray, cut: np.ndarray, ends: tuple[int, int, int]) -> tuple[np.ndarray, int]:
    """Costs from the end: row ``i`` for the last ``i`` turns; column ``d`` for ``d + i + low`` letters left."""
    n = len(kind)
    # any class of lengths is at most two inserts away from the cheapest one
    most = _incumbent(kind, cut) + 2 * INSERT
    low, high = -(most // DELETE) - 2, most // INSERT + 3
    width = high - low + 1
    table = np.full((n + 1, width), _NONE, np.int32)
    letters = np.arange(low, high + 1)
    table[0, -low : 3 - low] = ends
    _insert(table[0], letters)
    table[0, : -low] = _NONE
    for i in range(1, n + 1):
        left, before = letters + i, table[i - 1]
        k = int(kind[n - i])
        # an odd number of letters left starts with an assistant, an even one with a user
        change = (left & 1 if k == 0 else 1 - (left & 1) if k == 1 else 1) * REROLE
        row = before + (change + int(cut[n - i]))
        row[:-1] = np.minimum(row[:-1], before[1:] + DELETE)
        row[left < 0] = _NONE
        _insert(row, letters)
        row[left < 0] = _NONE
        table[i] = np.minimum(row, _NONE)
    return table, low


def _insert(row: np.ndarray, letters: np.ndarray) -> None:
    """Inserts cost the same each, so the best of all cells to the left is a running minimum."""
    np.minimum.accumulate(row - INSERT * letters, out=row)
    row += (INSERT * letters).astype(np.int32)


def _classes(table: np.ndarray, low: int, i: int) -> tuple[int, int]:
    """Cheapest cost of row ``i`` over odd lengths and over even ones from two on."""
    zero = -i - low  # column of no letters left
    row = table[i]
    odd, even = row[max(zero + 1, (zero + 1) % 2) :: 2], row[max(zero + 2, zero % 2) :: 2]
    return int(odd.min(initial=_NONE)), int(even.min(initial=_NONE))


def repair(codes: str, block: int = BLOCK) -> tuple[int, str]:
    """Cheapest cost and its least audit.

    A code per turn: the initial of its role (``o`` for any other than s, u, a), in upper
    case if truncated, ``-`` if it must be deleted.
    """
    rows = _Rows(codes)
    n = rows.count
    starts = list(range(0, n, block))
    borders: dict[int, tuple[int, int, int]] = {n: (0, INSERT, 2 * INSERT)}
    lead = np.full(n + 1, _NONE, np.int64)  # cheapest with a kept system turn here or later, all before it deleted
    kept: tuple[np.ndarray, int] | None = None
    for start in reversed(starts):
        stop = min(n, start + block)
        ends = borders[stop]
        table, low = kept = _table(rows.kind[start:stop], rows.cut[start:stop], ends)
        for at in range(stop - 1, start - 1, -1):
            lead[at] = lead[at + 1] + DELETE
            if rows.kind[at] == 2:
                even = _classes(table, low, stop - at - 1)[1] if at + 1 < stop else ends[2]
                lead[at] = min(lead[at], rows.cut[at] + even)
        borders[start] = (ends[0] + DELETE * (stop - start), *_classes(table, low, stop - start))
    none, _, even = borders[0]
    best = int(min(none, even, lead[0]))
    allowed = {c for c, v in ((0, none), (2, even)) if v == best}
    audit: list[str] = []
    leading = bool(lead[0] == best)
    for start in starts:
        stop = min(n, start + block)
        ends = borders[stop]
        if len(starts) > 1:
            kept = _table(rows.kind[start:stop], rows.cut[start:stop], ends)
        allowed, leading = _trace(rows, start, stop, ends, borders[start], kept, allowed, leading, lead, audit)
    audit.append("D" * int(rows.forced[n]) + "I" * min(allowed, default=0))
    return best + DELETE * int(rows.forced.sum()), "".join(audit)


def _trace(rows, start, stop, ends, begin, kept, allowed, leading, lead, audit) -> tuple[set[int], bool]:
    """Letters of one block; the classes of lengths (0, 1 odd, 2 even) that stay in the race behind it.

    All repairs in the race took the same letters, so they stand at the same turn; they
    differ in the letters left, of which ``cells`` is the set.
    """
    table, low = kept
    size = stop - start

    def cost(i: int, j: int) -> int:
        if j == 0:
            return ends[0] + DELETE * i
        d = j - i - low
        return int(table[i, d]) if 0 <= d < table.shape[1] else _NONE

    def tied(i: int, classes: set[int], value: dict[int, int]) -> set[int]:
        row = table[i]
        found = {0} if 0 in classes else set()
        for d in np.flatnonzero(row < _NONE).tolist():
            j = d + i + low
            c = 2 - (j & 1) if j > 0 else 0
            if j > 0 and c in classes and row[d] == value[c]:
                found.add(j)
        return found

    cells = tied(size, allowed, {1: begin[1], 2: begin[2]})
    for at in range(start, stop):
        i, k, extra = stop - at, int(rows.kind[at]), int(rows.cut[at])
        audit.append("D" * int(rows.forced[at]))
        while True:
            moves: dict[str, set[int]] = {}
            for j in cells:
                now = cost(i, j)
                if cost(i - 1, j) + DELETE == now:
                    moves.setdefault("D", set()).add(j)
                if j and cost(i, j - 1) + INSERT == now:
                    moves.setdefault("I", set()).add(j - 1)
                same = k == (1 if j & 1 else 0)
                if j and cost(i - 1, j - 1) + extra + (0 if same else REROLE) == now:
                    moves.setdefault("K" if same else "R", set()).add(j - 1)
            even = (_classes(table, low, i - 1)[1] if i > 1 else ends[2]) if leading and k == 2 else _NONE
            later = leading and lead[at + 1] + DELETE == lead[at]
            found = leading and k == 2 and extra + even == lead[at]
            least = min([*moves, *(["D"] if later else []), *(["K"] if found else [])])
            audit.append(least)
            cells = moves.get(least, set())
            leading_on = later and least == "D"
            if found and least == "K":
                cells = cells | (tied(i - 1, {2}, {2: even}) if i > 1 else {2})
            if least == "I":
                leading = False
                continue
            leading = bool(leading_on)
            break
    if stop == rows.count:  # letters left are inserted: the fewest give the least audit
        return cells, leading
    return {0 if j == 0 else 2 - (j & 1) for j in cells}, leading


short_repair = lru_cache(maxsize=20000)(repair)


def repaired_roles(audit: str) -> Iterator[str | None]:
    """Role of each step of an audit, of turns and inserts; None of a deleted turn."""
    undeleted = len(audit) - audit.count("D")
    system, place = undeleted % 2, 0
    for letter in audit:
        if letter == "D":
            yield None
            continue
        yield "system" if system and place == 0 else _ROLES[(place - system) % 2]
        place += 1


def damaged(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``conv, turn, role, text, copies`` after the damage; a dropped row has no copies."""
    blank = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    fate = F.pmod(F.crc32(F.concat(blank(conv_col), F.lit(":"), blank(turn_col)).cast("binary")), F.lit(20))
    text = blank(text_col)
    return turns.select(
        F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
        F.when(fate == 4, "user").otherwise(blank(role_col)).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("copies"),
    )


def _coded(rows: DataFrame) -> DataFrame:
    """Narrow rows: group key, order columns, a code letter and the first turn of repeated texts."""
    end = F.right(F.rtrim(F.col("text"), F.lit(_WHITE)), F.lit(1))
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    narrow = rows.select(
        group_key(F.col("conv")).alias("key"), "conv", "turn", "role", F.sha2(F.col("text").cast("binary"), 256).alias("digest"), "copies",
        F.when(end == "", "-").when(end.isin(".", "!", "?"), letter).otherwise(F.upper(letter)).alias("code"), letter.alias("letter"),
    ).withColumn("digest", F.unhex("digest"))
    # null turns come first, like in the order of the rows
    seen = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("at"))
    twice = (
        narrow.where("copies > 0 and code <> '-'").groupBy("key", "role", "digest")
        .agg(F.min(seen).alias("first"), F.sum("copies").alias("n")).where("n > 1").drop("n")
    )
    found = narrow.join(written(twice, "repeated"), ["key", "role", "digest"], "left")
    return found.withColumn("later", F.col("first").isNotNull() & (F.struct(F.col("turn").isNotNull(), F.col("turn")) > F.col("first")))


def group_key(conv: Column) -> Column:
    """A text per conversation, never null."""
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit(""))


class _Open:
    """Counts of the conversation a task is in."""

    def __init__(self, key: str, conv) -> None:
        self.key, self.conv = key, conv
        self.codes = bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.turn = self.last = self.run = None

    def add(self, turn, role, digest, code: str, letter: str, later: bool, copies: int) -> None:
        if turn is not None and copies:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.turn
            self.high = self.turn = turn
        for _ in range(copies):
            again = later or self.run == (turn, role, digest)
            self.run = (turn, role, digest)
            if self.last is not None and self.last + letter not in ("su", "ua", "au"):
                self.illegal += 1
            self.last = letter
            if code == "-":
                self.blank += 1
            elif again:
                self.duplicate += 1
            elif code.isupper():
                self.truncated += 1
            self.codes += b"-" if again else code.encode()

    def result(self) -> tuple:
        codes = self.codes.decode()
        cost, audit = short_repair(codes) if len(codes) <= _SHORT else repair(codes)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return self.key, self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def audits(rows: DataFrame) -> DataFrame:
    """One row per conversation: ``key, conv``, its counts and the audit, from coded rows."""
    kind = rows.schema["conv"].dataType
    order = ["key", F.col("turn").asc_nulls_first(), "role", "digest"]
    fields = ["key", "conv", "turn", "role", "digest", "code", "letter", "later", "copies"]
    sorted_rows = rows.select(*fields).repartition("key").sortWithinPartitions(*order)
    schema = f"key string, conv {kind.simpleString()}, {', '.join(f'{c} long' for c in _COUNTS)}, audit string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: _Open | None = None
        done: list[tuple] = []
        arrow = None
        for batch in batches:
            arrow = batch.schema.field("conv").type
            for key, conv, turn, role, digest, code, letter, later, copies in zip(*(batch.column(f).to_pylist() for f in fields)):
                if at is None or at.key != key:
                    if at is not None:
                        done.append(at.result())
                    at = _Open(key, conv)
                at.add(turn, role, digest, code, letter, later, copies)
            if len(done) >= 500:
                yield _batch(done, arrow)
                done = []
        if at is not None:
            done.append(at.result())
        if done:
            yield _batch(done, arrow)

    return sorted_rows.mapInArrow(run, schema)


def _batch(rows: list[tuple], conv) -> pa.RecordBatch:
    kinds = [pa.string(), conv, *[pa.int64()] * len(_COUNTS), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["key", "conv", *_COUNTS, "audit"])


class _Hash:
    """Digest of a conversation's repaired turns, fed in order."""

    def __init__(self, audit: str) -> None:
        self.sha, self.first, self.audit = hashlib.sha256(), True, audit
        self.steps = zip(audit, repaired_roles(audit))

    def write(self, role: str, text: str) -> None:
        self.sha.update(("" if self.first else "\n").encode() + f"{role}:{text}".encode())
        self.first = False

    def turn(self, role: str, text: str) -> None:
        """The next turn, after what the audit inserts before it."""
        for letter, target in self.steps:
            if letter == "I":
                self.write(target, "")
                continue
            if letter != "D":
                self.write(role if letter == "K" else target, text)
            return

    def end(self) -> str:
        for _, target in self.steps:
            self.write(target, "")
        return self.sha.hexdigest()


def repair_conversations(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", damage: bool = True
) -> DataFrame:
    """One row per conversation: its id, ``gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    With ``damage`` the rows are damaged first, as the contract says. Rows are taken by turn
    (nulls first); rows that share a turn by role, then by the SHA-256 of their text. A
    null role or text counts as one space; a null conversation id is a conversation of
    its own. A row repeated with the same turn is a duplicate of the first. An empty
    role has no initial and fits no letter. A conversation of which nothing is left has
    zeros, an empty audit and the digest of the empty string. Empty tables give no rows;
    other columns are left out and may have any name. Texts and conversations may be of
    any length: a task holds a byte per turn and one batch of texts.
    """
    if damage:
        rows = damaged(turns, conv_col, turn_col, role_col, text_col)
    else:
        blank = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
        rows = turns.select(
            F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"), blank(role_col).alias("role"),
            blank(text_col).alias("text"), F.lit(1).alias("copies"),
        )
    found = written(audits(_coded(rows)), "audits")
    kind = rows.schema["conv"].dataType.simpleString()
    heads = found.select("*", F.lit(0).alias("part"))
    texts = rows.where("copies > 0").select(
        group_key(F.col("conv")).alias("key"), "turn", "role", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
        "text", "copies", F.lit(1).alias("part"),
    )
    both = heads.unionByName(texts, allowMissingColumns=True).repartition("key")
    both = both.sortWithinPartitions("key", "part", F.col("turn").asc_nulls_first(), "role", "digest").drop("digest", "turn")
    out = ["conv", *_COUNTS, "audit"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head: tuple | None = None
        state: _Hash | None = None
        done: list[tuple] = []
        arrow = None
        for batch in batches:
            arrow = batch.schema.field("conv").type
            heads_ = zip(*(batch.column(c).to_pylist() for c in out))
            for row, part, role, text, copies in zip(heads_, *(batch.column(c).to_pylist() for c in ("part", "role", "text", "copies"))):
                if part == 0:
                    if head is not None:
                        done.append((*head, state.end()))
                    head, state = row, _Hash(row[-1])
                    continue
                for _ in range(copies):
                    state.turn(role, text)
            if len(done) >= 500:
                yield _results(done, arrow, [conv_col, *out[1:]])
                done = []
        if head is not None:
            done.append((*head, state.end()))
        if done:
            yield _results(done, arrow, [conv_col, *out[1:]])

    columns = ", ".join(f"{c} long" for c in _COUNTS)
    return both.mapInArrow(run, f"`{conv_col}` {kind}, {columns}, audit string, repaired_sha256 string")


def _results(rows: list[tuple], conv, names: list[str]) -> pa.RecordBatch:
    kinds = [conv, *[pa.int64()] * len(_COUNTS), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [*names, "repaired_sha256"])
