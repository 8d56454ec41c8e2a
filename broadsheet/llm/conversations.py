"""Repair of conversation structure: the cheapest edits after which the roles read system?, then user and assistant in turn.

One row of a conversation is one symbol, and a run of symbols is a DAG: a node is (rows consumed, state of the role
grammar), an edge is an edit. An edge's weight is one integer: the high digits carry its cost, and the low digits, of a
fixed width, carry the letter of the edit at its place in the audit, with zeros after the end. So the least integer is the
cheapest path and, among equally cheap ones, the one whose audit is least in ASCII; nothing else decides.

A run is solved from its last row to its first for every pair of states it may begin and end in, which gives a 4 x 4 table
of integers. Two tables of neighbouring runs join by min over the state between them: audits of equal cost over the same
rows are never prefixes of each other (the longer would have more insertions, hence a higher cost), so the integer order of
the parts is the order of the whole. A long conversation is thus solved in pieces by many tasks.

Work is laid out as: a narrow table without texts (one row for all copies of a row) finds duplicates by an aggregate and a
join; range partitions in conversation order solve their pieces; texts meet the joined pieces once, sorted, one
conversation after the other, and are read as a stream. Only the audit of one conversation, which is a cell of the result,
is held as a whole.

Defined cases: nulls in role and text read as one space; a null turn comes first; rows of one turn go by role, then by
digest of the text; rows with a null conv_id are one conversation; repeated rows are duplicates; an empty table gives none.
Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.llm.words import slices
from broadsheet.session import stored

# Costs and letters of the edits; digits of the letters rise with their ASCII codes, 0 is the end.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
LETTERS = " DIKR"
D, I, K, R = 1, 2, 3, 4
BITS = 3  # of one digit
EMPTY, SYSTEM, USER, ASSISTANT = range(4)  # what the repaired roles so far end in
ENDS = (EMPTY, ASSISTANT)
KEEPS = {"s": {EMPTY: SYSTEM}, "u": {EMPTY: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "x": {}}
GIVEN = {EMPTY: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}  # the role that an insertion or a new role gives
CHUNK = 24  # rows solved at once
NAMES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = ("su", "ua", "au")

Table = tuple[int, tuple[int | None, ...]]  # digits of a letter field, weight from state x to state y at 4 x + y


def _least(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else min(a, b)


def _before(letter: int, cost: int, weight: int | None, digits: int) -> int | None:
    """The weight of a path with one more edit in front."""
    if weight is None:
        return None
    field = digits * BITS
    return ((weight >> field) + cost << field) | letter << field - BITS | (weight & (1 << field) - 1) >> BITS


def _with_insertions(after: list[int | None], digits: int) -> list[int | None]:
    """Weights from before any insertions; three in a row would come back to a state at a cost, so two are enough."""
    now = after
    for _ in range(2):
        now = [_least(after[x], _before(I, INSERT, now[GIVEN[x]], digits)) for x in range(4)]
    return now


def _edges(symbol: str) -> list[tuple[int, int, int, int]]:
    """(state, next state, letter, cost) of the edits that consume a row."""
    edges = [(x, x, D, DELETE) for x in range(4)]
    if symbol != "d":
        more = TRUNCATED if symbol.isupper() else 0
        edges += [(x, y, R, REROLE + more) for x, y in GIVEN.items()]
        edges += [(x, y, K, KEEP + more) for x, y in KEEPS[symbol.lower()].items()]
    return edges


def _tight(table: Table) -> Table:
    """The same weights with a letter field no wider than the longest audit."""
    digits, weights = table
    spare = min((_blank(w, digits) for w in weights if w is not None), default=0)
    if not spare:
        return table
    field, less = digits * BITS, spare * BITS
    return digits - spare, tuple(None if w is None else (w >> field << field - less) | (w & (1 << field) - 1) >> less for w in weights)


def _blank(weight: int, digits: int) -> int:
    """Zero digits at the end of the letter field."""
    letters = weight & (1 << digits * BITS) - 1
    return digits if not letters else ((letters & -letters).bit_length() - 1) // BITS


@lru_cache(100_000)
def solved(symbols: str) -> Table:
    """The table of a short run of rows. Symbols: s, u, a, x for the role's initial, upper case where truncated, d where
    the row has to go."""
    digits = 3 * len(symbols)
    columns = []
    for end in range(4):
        now: list[int | None] = [0 if x == end else None for x in range(4)]
        for symbol in reversed(symbols):
            best: list[int | None] = [None] * 4
            for x, y, letter, cost in _edges(symbol):
                best[x] = _least(best[x], _before(letter, cost, now[y], digits))
            now = _with_insertions(best, digits)
        columns.append(now)
    return _tight((digits, tuple(columns[y][x] for x in range(4) for y in range(4))))


def _tail() -> Table:
    """After the last row: insertions only, up to an end of the grammar (kept in the column of EMPTY)."""
    now = _with_insertions([0 if x in ENDS else None for x in range(4)], 2)
    return 2, tuple(now[x] if y == EMPTY else None for x in range(4) for y in range(4))


def joined(left: Table, right: Table) -> Table:
    """The table of two neighbouring runs."""
    (a, first), (b, second) = left, right
    digits = a + b
    field, fa, fb = digits * BITS, a * BITS, b * BITS
    heads = [None if w is None else (w >> fa, w & (1 << fa) - 1, _blank(w, a) * BITS) for w in first]
    tails = [None if w is None else (w >> fb, w & (1 << fb) - 1) for w in second]
    out: list[int | None] = []
    for x in range(4):
        for z in range(4):
            best = None
            for y in range(4):
                head, tail = heads[4 * x + y], tails[4 * y + z]
                if head is not None and tail is not None:
                    best = _least(best, head[0] + tail[0] << field | head[1] << fb | tail[1] << head[2])
            out.append(best)
    return _tight((digits, tuple(out)))


def joined_all(tables: list[Table]) -> Table:
    """Neighbours joined pair by pair, so that every digit is copied only as often as the tree is deep."""
    while len(tables) > 1:
        tables = [joined(*tables[k:k + 2]) if k + 1 < len(tables) else tables[k] for k in range(0, len(tables), 2)]
    return tables[0] if tables else (0, tuple(0 if x == y else None for x in range(4) for y in range(4)))


def run_table(symbols: str) -> Table:
    return joined_all([solved(symbols[k:k + CHUNK]) for k in range(0, len(symbols), CHUNK)])


def audit_of(table: Table) -> tuple[int, str]:
    """Cost and letters of the best path from the empty state to an end."""
    digits, weights = joined(table, (_tail()))
    return _spelled(weights[4 * EMPTY + EMPTY], digits)


_DIGITS = str.maketrans("01234", LETTERS)


def _spelled(weight: int, digits: int) -> tuple[int, str]:
    field = digits * BITS
    letters = weight & (1 << field) - 1
    return weight >> field, format(letters, f"0{max(digits, 1)}o").translate(_DIGITS).rstrip() if digits else ""


def _packed(table: Table) -> list[bytes | None]:
    digits, weights = table
    return [None if w is None else w.to_bytes((w.bit_length() + 7) // 8 + 1, "big") for w in weights]


def _unpacked(digits: int, weights: list[bytes | None]) -> Table:
    return digits, tuple(None if w is None else int.from_bytes(w, "big") for w in weights)


# Column expressions

def text_of(column: Column) -> Column:
    """A value as text, a null as one space."""
    return F.coalesce(column.cast("string"), F.lit(" "))


def _is_blank(text: Column) -> Column:
    return ~text.rlike(r"[^\x20\x09-\x0D]")


def _is_truncated(text: Column) -> Column:
    """The last character that is not blank is no `.`, `!` or `?`."""
    last = F.substring(F.rtrim(text, F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    return ~last.isin(".", "!", "?")


def _rows(conversations: DataFrame) -> DataFrame:
    text = text_of(F.col("text"))
    return conversations.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
                                text_of(F.col("role")).alias("role"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("digest"))


ORDER = ("turn", "role", "digest")  # nulls first


def _symbols(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, digest, symbol, n, fault): one row for all copies of a row; `symbol` is that of the first copy,
    the others are duplicates."""
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    narrow = rows.select("conv", *ORDER, _is_blank(F.col("text")).alias("blank"), _is_truncated(F.col("text")).alias("truncated"))
    narrow = narrow.groupBy("conv", *ORDER).agg(F.count(F.lit(1)).alias("n"), F.first("blank").alias("blank"), F.first("truncated").alias("truncated"))
    narrow = stored(narrow.withColumn("initial", initial), "conversation-rows")
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = narrow.groupBy("conv", "role", "digest").agg(F.min(place).alias("f")).select(
        F.col("conv").alias("f_conv"), F.col("role").alias("f_role"), F.col("digest").alias("f_digest"), F.col("f.turn").alias("f_turn"))
    same = F.col("conv").eqNullSafe(F.col("f_conv")) & (F.col("role") == F.col("f_role")) & (F.col("digest") == F.col("f_digest"))
    first = F.col("turn").eqNullSafe(F.col("f_turn"))
    fault = F.when(F.col("blank"), "blank").when(~first, "duplicate").when(F.col("truncated"), "truncated")
    symbol = F.when(F.col("blank") | ~first, "d").when(F.col("truncated"), F.upper("initial")).otherwise(F.col("initial"))
    return narrow.join(firsts, same).select("conv", *ORDER, "n", "initial", symbol.alias("symbol"), fault.alias("fault"))


_PIECE = T.StructType([
    T.StructField("conv", T.LongType()), T.StructField("piece", T.IntegerType()), T.StructField("digits", T.IntegerType()),
    T.StructField("weights", T.ArrayType(T.BinaryType())), T.StructField("counts", T.ArrayType(T.LongType())),
    T.StructField("turns", T.ArrayType(T.LongType())), T.StructField("initials", T.StringType())])


class _Piece:
    """Rows of one conversation in one range partition, taken in order."""

    def __init__(self, conv: int | None):
        self.conv, self.symbols, self.tables = conv, "", []
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.distinct = 0
        self.first = self.last = None
        self.initials = ""

    def add(self, turn, initial: str, symbol: str, fault: str | None, n: int) -> None:
        if turn is not None:
            self.first = turn if self.first is None else self.first
            self.distinct += turn != self.last
            self.last = turn
        self.illegal += (bool(self.initials) and self.initials[-1] + initial not in LEGAL) + n - 1
        self.initials = (self.initials or initial)[0] + initial
        if fault:
            self.faults[fault] += 1
        self.symbols += symbol
        if n > 1:  # copies of a blank row are blank, all others duplicates
            self.faults["blank" if fault == "blank" else "duplicate"] += n - 1
            self._many(n - 1)
        if len(self.symbols) >= 64 * CHUNK:
            self._solve()

    def _many(self, n: int) -> None:
        while n:
            take = min(n, 64 * CHUNK)
            self.symbols += "d" * take
            n -= take
            if n:
                self._solve()

    def _solve(self) -> None:
        """Pieces of about equal size are joined as they come, like the carries of a counter."""
        if self.symbols:
            table, self.symbols = run_table(self.symbols), ""
            size = 1
            while self.tables and self.tables[-1][0] <= size:
                before, left = self.tables.pop()
                table, size = joined(left, table), size + before
            self.tables.append((size, table))

    def row(self, piece: int) -> dict:
        self._solve()
        digits, weights = joined_all([t for _, t in self.tables])
        return {"conv": self.conv, "piece": piece, "digits": digits, "weights": _packed((digits, weights)),
                "counts": [*self.faults.values(), self.illegal, self.distinct], "turns": [self.first, self.last], "initials": self.initials}


def _pieces(symbols: DataFrame) -> DataFrame:
    """One row for each conversation and range partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, out = None, []
        for part in slices(batches, 2048):
            conv, turn, initial, symbol, fault, n, place = (c.to_pylist() for c in part.columns)
            for k in range(part.num_rows):
                if piece is None or piece.conv != conv[k]:
                    if piece is not None:
                        out.append(piece.row(at))
                    piece, at = _Piece(conv[k]), place[k]
                piece.add(turn[k], initial[k], symbol[k], fault[k], n[k])
            if len(out) >= 1024:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        if piece is not None:
            out.append(piece.row(at))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    schema = pa.schema([("conv", pa.int64()), ("piece", pa.int32()), ("digits", pa.int32()), ("weights", pa.list_(pa.binary())),
                        ("counts", pa.list_(pa.int64())), ("turns", pa.list_(pa.int64())), ("initials", pa.string())])
    ordered = (symbols.repartitionByRange("conv", *ORDER).sortWithinPartitions("conv", *ORDER)
               .select("conv", "turn", "initial", "symbol", "fault", "n", F.spark_partition_id().alias("place")))
    return ordered.mapInArrow(run, _PIECE)


class _Conversation:
    """The joined pieces of one conversation, then its texts as a stream."""

    def __init__(self, conv: int | None):
        self.conv, self.pieces = conv, []
        self.audit = None

    def settle(self) -> None:
        parts = self.pieces
        table = joined_all([_unpacked(p["digits"], p["weights"]) for p in parts])
        self.cost, self.audit = audit_of(table)
        sums = [sum(p["counts"][k] for p in parts) for k in range(5)]
        self.blank, self.duplicate, self.truncated, self.illegal, distinct = sums
        spans = [p["turns"] for p in parts if p["turns"][0] is not None]
        distinct -= sum(a[1] == b[0] for a, b in zip(spans, spans[1:]))
        self.illegal += sum(a["initials"][-1] + b["initials"][0] not in LEGAL for a, b in zip(parts, parts[1:]))
        self.gaps = _long(spans[-1][1] - spans[0][0] + 1 - distinct) if spans else 0
        self.pieces, self.at, self.state, self.place = [], 0, EMPTY, 0
        self.sha = hashlib.sha256()

    def lines(self, turn=None, role: str | None = None, text: str | None = None) -> Iterator[tuple]:
        """(place, turn, role, text, edit) of the repaired rows up to and with the given row; without one, those after the
        last row."""
        while self.at < len(self.audit):
            letter = self.audit[self.at]
            if role is None and letter != "I":
                raise ValueError(f"conversation {self.conv}: rows and audit differ")
            self.at += 1
            if letter == "I":
                self.state = GIVEN[self.state]
                yield self._line(None, NAMES[self.state], "", letter)
                continue
            if letter == "R":
                self.state = GIVEN[self.state]
                yield self._line(turn, NAMES[self.state], text, letter)
            elif letter == "K":
                self.state = KEEPS[role[0]][self.state]
                yield self._line(turn, role, text, letter)
            return

    def _line(self, turn, role: str, text: str, letter: str) -> tuple:
        if self.place:
            self.sha.update(b"\n")
        self.sha.update(role.encode())
        self.sha.update(b":")
        self.sha.update(text.encode())
        self.place += 1
        return self.conv, self.place, turn, role, text, letter

    def report(self) -> tuple:
        return (self.conv, self.gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, self.audit, self.sha.hexdigest())


def _long(n: int) -> int:
    """Wrapped to 64 bits, as Spark's own arithmetic does."""
    return (n + 2**63) % 2**64 - 2**63


_REPORT = "conv long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_TURN = "conv long, place long, turn long, role string, text string, edit string"


def _arrow(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in schema.split(", "))])


def _walk(conversations: DataFrame, turns: bool) -> DataFrame:
    rows = _rows(conversations)
    pieces = _pieces(stored(_symbols(rows), "conversation-symbols"))
    pieces = pieces.withColumns({"turn": F.lit(None).cast("long"), "role": F.lit(None).cast("string"), "digest": F.lit(None).cast("binary"),
                                 "text": F.lit(None).cast("string")})
    blank = {"piece": "int", "digits": "int", "weights": "array<binary>", "counts": "array<bigint>", "turns": "array<bigint>", "initials": "string"}
    texts = rows.withColumns({name: F.lit(None).cast(kind) for name, kind in blank.items()})
    both = pieces.unionByName(texts).repartition("conv").sortWithinPartitions("conv", F.col("piece").asc_nulls_last(), *ORDER)
    schema = _arrow(_TURN if turns else _REPORT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out, held = None, [], 0

        def ended() -> list[tuple]:
            last = list(now.lines())
            return last if turns else [now.report()]

        for part in slices(batches):
            for row in part.to_pylist():
                if row["piece"] is not None:
                    if now is None or now.audit is not None or now.conv != row["conv"]:
                        if now is not None:
                            out += ended()
                        now = _Conversation(row["conv"])
                    now.pieces.append(row)
                    continue
                if now.audit is None:
                    now.settle()
                lines = list(now.lines(row["turn"], row["role"], row["text"]))
                if turns:
                    out += lines
                    held += len(row["text"])
                if len(out) >= 1024 or held > 1 << 22:
                    yield _batch(out, schema)
                    out, held = [], 0
        if now is not None:
            out += ended()
        if out:
            yield _batch(out, schema)

    select = ["conv", "piece", "digits", "weights", "counts", "turns", "initials", "turn", "role", "text"]
    return both.select(*select).mapInArrow(run, _TURN if turns else _REPORT).withColumnRenamed("conv", "conv_id")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def repaired(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, turn, role, text, edit): the repaired conversations, places from 1 in each; `edit` is K for a kept
    row, R for one with a new role and I for an inserted one, whose turn is null and text empty."""
    return _walk(conversations, turns=True)


def reports(conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of each conversation; the digest is
    that of the lines `role:text` of its repaired rows."""
    return _walk(conversations, turns=False)


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with the faults that crc32 of `conv_id:turn` modulo 20 plants: 0 drops a row, 1 empties its text, 2 takes its
    `.`, `!` and `?` out, 3 repeats it, 4 gives it the role user. Nulls read as one space."""
    key = F.concat_ws(":", text_of(F.col("conv_id")), text_of(F.col("turn")))
    rows = conversations.select("conv_id", "turn", "role", "text", (F.crc32(key.cast("binary")) % 20).alias("fault")).filter("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return (rows.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copy"))
            .drop("copy"))


NO_ROWS = hashlib.sha256().hexdigest()


def damage_reports(conversations: DataFrame) -> DataFrame:
    """The report of every conversation after the planted damage; zeros, an empty audit and the digest of nothing where no
    row is left."""
    ids = conversations.select(F.col("conv_id").cast("long").alias("original")).distinct()
    found = reports(damaged(conversations))
    filled = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return (ids.join(found, F.col("original").eqNullSafe(F.col("conv_id")), "left")
            .select(F.col("original").alias("conv_id"), *filled, F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.lit(NO_ROWS)).alias("repaired_sha256")))
