"""Repair of the structure of conversations by lazy weighted determinisation.

Role initials should be an optional system turn and pairs of a user's and an assistant's: ``(s?(ua)+)?``. Edits have costs. What the rows from
some place on cost at least, from each state of that pattern, is a vector; less its minimum it is a state of a deterministic automaton that reads
the rows from the last to the first. States and transitions are made when they first occur and kept in a table, so that a scan of the
table gives the cost. From the first row on, a trace takes the least edit in ASCII order among the arcs that are tight: the audit.

Rows are sorted over the cluster by conversation and turn, and packed in pieces of a bounded size. A conversation within one piece is repaired
where it is. One of many pieces is repaired piece by piece: each tells what it makes of every state, these are put together piece by piece,
and each is traced on its own. Only the hash of the repaired text, which is sequential by its nature, reads a long conversation in one task,
as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from .common import cut_lineage, new_folder, pick, table

#: Rows and characters of a piece.
PIECE_ROWS, PIECE_CHARS = 1024, 1 << 20
_SPACE = " \t\n\x0b\x0c\r"
#: States of the pattern: nothing yet, after s, after u, after a. Where a user's or an assistant's turn leads, and what it is.
_START, _S, _U, _A = range(4)
_NEXT = (_U, _U, _A, _U)
_ROLE = ("user", "user", "assistant", "user")
_KEEP = ({"s": _S, "u": _U}, {"u": _U}, {"a": _A}, {"u": _U})
_DELETE, _INSERT, _REROLE = 3, 2, 2
_END = (0, 4, 2, 0)
#: A row that must go; of others the initial (s, u, a or any other) and whether it is truncated.
_GONE = 0
_INITIALS = "sua"
_LONG = (1 << 63) - 1


def letter(initial: str, truncated: bool) -> int:
    place = _INITIALS.find(initial) if initial else -1
    return 1 + 2 * (place if place >= 0 else 3) + truncated


class Automaton:
    """The deterministic states made so far, the transitions between them and the edits that they call for."""

    def __init__(self) -> None:
        self.vectors: list[tuple[int, ...]] = [_END]
        self.numbers = {_END: 0}
        self.steps: dict[tuple[int, int], tuple[int, int]] = {}
        self.edits: dict[tuple[int, int, int], tuple[str, int]] = {}

    @staticmethod
    def _arcs(row: int, state: int) -> Iterator[tuple[str, int, int]]:
        """Edits that take the row, in ASCII order: name, cost, state behind."""
        yield "D", _DELETE, state
        if row != _GONE:
            initial, truncated = "sua-"[(row - 1) // 2], (row - 1) % 2
            if initial in _KEEP[state]:
                yield "K", truncated, _KEEP[state][initial]
            yield "R", _REROLE + truncated, _NEXT[state]

    def step(self, state: int, row: int) -> tuple[int, int]:
        """From the state behind a row to that before it, and the cost."""
        found = self.steps.get((state, row))
        if found is None:
            behind = self.vectors[state]
            costs = [min(cost + behind[to] for _, cost, to in self._arcs(row, q)) for q in range(4)]
            for _ in range(3):
                costs = [min(costs[q], _INSERT + costs[_NEXT[q]]) for q in range(4)]
            least = min(costs)
            vector = tuple(c - least for c in costs)
            if vector not in self.numbers:
                self.numbers[vector] = len(self.vectors)
                self.vectors.append(vector)
            found = self.steps[state, row] = (self.numbers[vector], least)
        return found

    def edit(self, state: int, row: int, q: int) -> tuple[str, int]:
        """The least tight edit at a row, from a pattern state, before the deterministic state behind the row; and the pattern state that follows."""
        found = self.edits.get((state, row, q))
        if found is None:
            before, least = self.step(state, row)
            cost, behind = self.vectors[before][q] + least, self.vectors[state]
            tight = [(name, to) for name, c, to in self._arcs(row, q) if c + behind[to] == cost]
            if self.vectors[before][q] == _INSERT + self.vectors[before][_NEXT[q]]:
                tight.append(("I", _NEXT[q]))
            found = self.edits[state, row, q] = min(tight)
        return found

    def all_states(self) -> int:
        """Makes every state that any rows lead to. There are few: costs in a vector differ by a few edits at most."""
        done = 0
        while done < len(self.vectors):
            for row in range(9):
                self.step(done, row)
            done += 1
        return done


@lru_cache(maxsize=1)
def automaton() -> Automaton:
    """The table of this process."""
    return Automaton()


@lru_cache(maxsize=1)
def whole_automaton() -> Automaton:
    """All states, numbered alike in every process."""
    made = Automaton()
    made.all_states()
    return made


def faults(roles: list[str], texts: list[str], seen: set[bytes]) -> tuple[list[int], list[int]]:
    """The letter of each row, and how many are blank, duplicates and truncated. seen: marks of rows before, which grow."""
    rows, counts = [], [0, 0, 0]
    for role, text in zip(roles, texts, strict=True):
        bare, mark = text.rstrip(_SPACE), row_mark(role, text)
        if not bare:
            counts[0] += 1
            rows.append(_GONE)
        elif mark in seen:
            counts[1] += 1
            rows.append(_GONE)
        else:
            truncated = bare[-1] not in ".!?"
            counts[2] += truncated
            rows.append(letter(role[:1], truncated))
        seen.add(mark)
    return rows, counts


def row_mark(role: str, text: str) -> bytes:
    return xxhash.xxh3_128_digest(f"{len(role)}:{role}{text}".encode())


def illegal_pairs(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials[:-1], initials[1:], strict=True))


def scanned(table: Automaton, rows: list[int], state: int) -> tuple[list[int], int]:
    """The states behind each row and before the first, and the cost."""
    states, cost = [state], 0
    for row in reversed(rows):
        state, least = table.step(state, row)
        states.append(state)
        cost += least
    states.reverse()
    return states, cost


def traced(table: Automaton, rows: list[int], states: list[int], q: int) -> tuple[str, int]:
    """The audit of these rows from a pattern state on, and the pattern state behind them."""
    audit = []
    for i, row in enumerate(rows):
        while True:
            name, q = table.edit(states[i + 1], row, q)
            audit.append(name)
            if name != "I":
                break
    return "".join(audit), q


def closing(q: int) -> str:
    """The inserts behind the last row."""
    return "I" * (_END[q] // _INSERT)


def applied(audit: str, roles: list[str], texts: list[str], q: int) -> Iterator[str]:
    """The repaired lines that an audit makes of rows, from a pattern state on."""
    at = 0
    for name in audit:
        if name == "I":
            yield f"{_ROLE[q]}:"
            q = _NEXT[q]
            continue
        role, text = roles[at], texts[at]
        at += 1
        if name == "K":
            yield f"{role}:{text}"
            q = _KEEP[q][role[0]]
        elif name == "R":
            yield f"{_ROLE[q]}:{text}"
            q = _NEXT[q]


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and gone (the row is dropped) after the damage by crc32 of ``conv_id:turn``. Nulls are one space, also in that text."""
    blank = F.lit(" ")
    rows = pick(conversations, "conv_id", "turn", "role", "text")
    dealt = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank)).cast("binary")) % 20
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), blank).alias("role"), F.coalesce(F.col("text").cast("string"), blank).alias("text"), dealt.alias("dealt"))
    text = F.when(F.col("dealt") == 1, "").when(F.col("dealt") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("dealt") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("dealt") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("dealt") == 0).alias("gone"), F.explode(copies).alias("copy")).drop("copy")


_PIECE = "part int, number int, whole boolean, turns array<long>, roles array<string>, texts array<string>"


def pieces(rows: DataFrame, most_rows: int = PIECE_ROWS, most_chars: int = PIECE_CHARS) -> DataFrame:
    """Rows in order (conversation, turn, role, text; nulls first), in pieces of a conversation each. whole: no other piece has any of it.

    Rows that are gone only tell that there is a conversation.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        held: list[tuple] = []  # rows of the present piece
        chars, conv = 0, None
        made: list[dict] = []

        def close(ends: bool) -> None:
            nonlocal held, chars, number
            if held:
                kept = [r for r in held if not r[3]]
                made.append({"conv_id": conv, "part": part, "number": number, "whole": first_piece and ends and not touches, "turns": [r[0] for r in kept], "roles": [r[1] for r in kept], "texts": [r[2] for r in kept]})
                number += 1
            held, chars = [], 0

        first_piece, touches = True, True  # the first conversation of a partition may have begun in another
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "gone")]
            for now, *row in zip(*columns, strict=True):
                if held and now != conv:
                    close(True)
                    first_piece, touches = True, False
                elif held and (len(held) >= most_rows or chars + len(row[2]) > most_chars):
                    close(False)
                    first_piece = False
                conv = now
                held.append(row)
                chars += len(row[2])
            if made:
                yield pa.RecordBatch.from_pylist(made, schema=kinds)
                made = []
        touches = True  # the last may go on in the next
        close(True)
        yield pa.RecordBatch.from_pylist(made, schema=kinds)

    kind = rows.schema["conv_id"].dataType
    strings = pa.list_(pa.string())
    kinds = pa.schema([("conv_id", to_arrow_type(kind)), ("part", pa.int32()), ("number", pa.int32()), ("whole", pa.bool_()), ("turns", pa.list_(pa.int64())), ("roles", strings), ("texts", strings)])
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A range boundary need not tell long texts apart to the end; rows are in their full order within a partition.
    in_order = rows.repartitionByRange(parts, "conv_id", "turn", "role", F.substring("text", 1, 64)).sortWithinPartitions("conv_id", "turn", "role", "text")
    return in_order.mapInArrow(run, f"conv_id {kind.simpleString()}, {_PIECE}")


_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string, n_rows long"


def _gaps(least: int | None, most: int | None, different: int) -> int:
    return 0 if least is None else min(most - least + 1 - different, _LONG)


def repaired_whole(turns: list[int | None], roles: list[str], texts: list[str]) -> tuple:
    """The columns of the result for a conversation that is here whole."""
    rows, counts = faults(roles, texts, set())
    made = automaton()
    states, cost = scanned(made, rows, 0)
    audit, q = traced(made, rows, states, _START)
    audit += closing(q)
    known = [t for t in turns if t is not None]
    lines = "\n".join(applied(audit, roles, texts, _START))
    # The cost of the vector from the start, not only of its least state.
    cost += made.vectors[states[0]][_START]
    return (_gaps(min(known, default=None), max(known, default=None), len(set(known))), *counts, illegal_pairs([r[:1] for r in roles]), cost, audit, hashlib.sha256(lines.encode()).hexdigest(), len(rows))


def _arrow(names: str) -> list[tuple[str, pa.DataType]]:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}
    return [(c.split(" ")[0], kinds[c.split(" ")[1]]) for c in names.split(", ")]


def _mapped(rows: DataFrame, keep: list[str], names: str, each) -> DataFrame:
    """Columns kept and those that a function makes of each row (by name); rows of which it makes None go."""
    schema = StructType([*rows.select(*keep).schema.fields, *StructType.fromDDL(names).fields])
    made = _arrow(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                own = batch.slice(lo, 256)
                found = [each(row) for row in own.to_pylist()]
                some = pa.array([i for i, x in enumerate(found) if x is not None], pa.int32())
                columns = list(zip(*(x for x in found if x is not None), strict=True)) or [[] for _ in made]
                yield pa.RecordBatch.from_arrays([*(own.column(c).take(some) for c in keep), *(pa.array(c, k) for c, (_, k) in zip(columns, made, strict=True))], names=[*keep, *(n for n, _ in made)])

    return rows.mapInArrow(run, schema)


_FACTS = "n_rows long, blank long, duplicate long, truncated long, illegal long, first string, last string, least long, most long, different long, to array<int>, costs array<int>"


def _facts(row: dict) -> tuple:
    """What a piece adds to its conversation, and where it leads from every state behind it."""
    rows, counts = faults(row["roles"], row["texts"], set(row["seen"] or ()))
    made = whole_automaton()
    ends = [scanned(made, rows, state) for state in range(len(made.vectors))]
    known = [t for t in row["turns"] if t is not None]
    initials = [r[:1] for r in row["roles"]]
    return (len(rows), *counts, illegal_pairs(initials), initials[0] if initials else None, initials[-1] if initials else None, min(known, default=None), max(known, default=None), len(set(known)), [s[0] for s, _ in ends], [c for _, c in ends])


def _joined(facts: list[dict]) -> tuple[tuple, list[int]]:
    """Of the facts of a conversation's pieces, in order: its counts, and the state behind each piece."""
    total = {c: sum(f[c] for f in facts) for c in ("n_rows", "blank", "duplicate", "truncated", "illegal")}
    some = [f for f in facts if f["n_rows"]]
    total["illegal"] += sum(illegal_pairs([a["last"], b["first"]]) for a, b in zip(some[:-1], some[1:], strict=True))
    timed = [f for f in some if f["different"]]
    different = sum(f["different"] for f in timed) - sum(a["most"] == b["least"] for a, b in zip(timed[:-1], timed[1:], strict=True))
    gaps = _gaps(timed[0]["least"] if timed else None, timed[-1]["most"] if timed else None, different)
    state, cost, behind = 0, 0, []
    for f in reversed(facts):
        behind.append(state)
        state, cost = f["to"][state], cost + f["costs"][state]
    cost += whole_automaton().vectors[state][_START]
    return (gaps, total["blank"], total["duplicate"], total["truncated"], total["illegal"], cost, total["n_rows"]), behind[::-1]


def _repaired_pieces(cut: DataFrame) -> DataFrame:
    """The result of conversations in several pieces: conv_id, part, number, turns, roles, texts."""
    kind = cut.schema["conv_id"].dataType.simpleString()
    at = ["conv", "part", "number"]
    cut = cut.withColumn("conv", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")))
    # Rows seen in an earlier piece: each piece tells its different rows once.
    marks = _mapped(cut, at, "marks array<string>", lambda row: (sorted({row_mark(a, b).hex() for a, b in zip(row["roles"], row["texts"], strict=True)}),))
    marks = marks.select(*at, F.explode("marks").alias("mark"))
    order = F.struct("part", "number")
    earlier = marks.groupBy("conv", "mark").agg(F.min(order).alias("first"), F.count("*").alias("n")).filter("n > 1")
    seen = marks.join(earlier, ["conv", "mark"]).filter(order > F.col("first")).groupBy(*at).agg(F.collect_list(F.unhex("mark")).alias("seen"))
    cut = cut_lineage(cut.join(seen, at, "left"))
    facts = _mapped(cut, ["conv", "conv_id", "part", "number"], _FACTS, _facts)

    def put(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: (r["part"], r["number"]))
        total, behind = _joined(rows)
        columns = [group.column("conv_id").slice(0, 1).take(pa.array([0] * len(rows))), [r["conv"] for r in rows], [r["part"] for r in rows], [r["number"] for r in rows], behind, *([v] * len(rows) for v in total)]
        return pa.Table.from_arrays([columns[0], *(pa.array(c, k) for c, (_, k) in zip(columns[1:], _arrow(put_names), strict=True))], names=["conv_id", *(n for n, _ in _arrow(put_names))])

    totals = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, n_rows long"
    put_names = f"conv string, part int, number int, behind int, {totals}"
    # A row of a few numbers for each thousand rows of a conversation.
    placed = cut_lineage(facts.groupBy("conv").applyInArrow(put, f"conv_id {kind}, {put_names}"))
    cut = cut.join(placed.select(*at, "behind"), at)

    def leads(row: dict) -> tuple:
        rows, _ = faults(row["roles"], row["texts"], set(row["seen"] or ()))
        states, _ = scanned(whole_automaton(), rows, row["behind"])
        return ([traced(whole_automaton(), rows, states, q)[1] for q in range(4)],)

    def begin(group: pa.Table) -> pa.Table:
        rows, q = sorted(group.to_pylist(), key=lambda r: (r["part"], r["number"])), _START
        starts = []
        for row in rows:
            starts.append(q)
            q = row["leads"][q]
        last = [""] * (len(rows) - 1) + [closing(q)]
        columns = [[r[c] for r in rows] for c in at] + [starts, last]
        return pa.Table.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, _arrow(begin_names), strict=True)], names=[n for n, _ in _arrow(begin_names)])

    begin_names = "conv string, part int, number int, start int, closing string"
    begun = cut_lineage(_mapped(cut, at, "leads array<int>", leads).groupBy("conv").applyInArrow(begin, begin_names))

    def repair(row: dict) -> tuple:
        rows, _ = faults(row["roles"], row["texts"], set(row["seen"] or ()))
        states, _ = scanned(whole_automaton(), rows, row["behind"])
        audit, _ = traced(whole_automaton(), rows, states, row["start"])
        audit += row["closing"]
        lines = list(applied(audit, row["roles"], row["texts"], row["start"]))
        return audit, "\n".join(lines), len(lines)

    made = _mapped(cut.join(begun, at), at, "audit string, repaired string, lines int", repair)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, sha, any_line = None, [], hashlib.sha256(), False

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in (conv, "".join(audit), sha.hexdigest())], names=["conv", "audit", "repaired_sha256"])

        for batch in batches:
            for now, edits, text, lines in zip(*(batch.column(c).to_pylist() for c in ("conv", "audit", "repaired", "lines")), strict=True):
                if now != conv:
                    if conv is not None:
                        yield out()
                    conv, audit, sha, any_line = now, [], hashlib.sha256(), False
                audit.append(edits)
                if lines:
                    sha.update(("\n" if any_line else "").encode() + text.encode())
                    any_line = True
        if conv is not None:
            yield out()

    parts = int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashes = made.repartition(parts, "conv").sortWithinPartitions("conv", "part", "number").mapInArrow(hashed, "conv string, audit string, repaired_sha256 string")
    names = [c.split(" ")[0] for c in totals.split(", ")]
    totals_of = placed.groupBy("conv").agg(F.first("conv_id").alias("conv_id"), *(F.first(c).alias(c) for c in names))
    return totals_of.join(hashes, "conv").drop("conv")


def repaired(conversations: DataFrame, most_rows: int = PIECE_ROWS, most_chars: int = PIECE_CHARS) -> DataFrame:
    """A row for each conv_id (null is one) of rows (conv_id, turn, role, text, gone): gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256, n_rows.

    Rows of one turn go by role and text. A role is judged by its initial, and kept as it is. Without rows all is zero or empty.
    """
    spark = conversations.sparkSession
    folder = new_folder(spark, "conversation-pieces")
    pieces(conversations, most_rows, most_chars).write.parquet(folder)
    cut = spark.read.parquet(folder)
    names = ["conv_id", *(c.split(" ")[0] for c in _RESULT.split(", "))]
    whole = _mapped(cut.filter("whole"), ["conv_id"], _RESULT, lambda row: repaired_whole(row["turns"], row["roles"], row["texts"]))
    rest = _repaired_pieces(cut.filter("NOT whole").drop("whole"))
    return whole.select(*names).unionByName(rest.select(*names))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repaired(damaged(table(spark, sf_dir, "conversations")))
    return found.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def _sql() -> str:
    """The query's result in SQL: the damage, the faults, and the cheapest edits from each row on by recursion, from the last row to the first."""
    space = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    keep = ["CASE WHEN initial = 's' THEN v1 WHEN initial = 'u' THEN v2 END", "CASE WHEN initial = 'u' THEN v2 END", "CASE WHEN initial = 'a' THEN v3 END", "CASE WHEN initial = 'u' THEN v2 END"]
    put = lambda v, cost, name, line: f"{{'cost': {v}.cost + {cost}, 'audit': '{name}' || {v}.audit, 'lines': {line}}}"

    def taken(q: int) -> str:
        delete = put(f"v{q}", 3, "D", f"v{q}.lines")
        rerole = f"CASE WHEN NOT gone THEN {put(f'v{_NEXT[q]}', '2 + short', 'R', f'''list_prepend('{_ROLE[q]}:' || text, v{_NEXT[q]}.lines)''')} END"
        kept = f"CASE WHEN NOT gone AND ({keep[q]}) IS NOT NULL THEN {put(f'({keep[q]})', 'short', 'K', f'''list_prepend(role || ':' || text, ({keep[q]}).lines)''')} END"
        return f"list_min([x FOR x IN [{delete}, {kept}, {rerole}] IF x IS NOT NULL]) AS v{q}"

    def inserted(q: int) -> str:
        n = _NEXT[q]
        return f"list_min([v{q}, {put(f'v{n}', 2, 'I', f'''list_prepend('{_ROLE[q]}:', v{n}.lines)''')}]) AS v{q}"

    each = lambda f: ", ".join(f(q) for q in range(4))
    ends = ["{'cost': 0, 'audit': '', 'lines': []::VARCHAR[]}", "{'cost': 4, 'audit': 'II', 'lines': ['user:', 'assistant:']}", "{'cost': 2, 'audit': 'I', 'lines': ['assistant:']}", "{'cost': 0, 'audit': '', 'lines': []::VARCHAR[]}"]
    kind = "STRUCT(cost BIGINT, audit VARCHAR, lines VARCHAR[])"
    return f"""
WITH RECURSIVE crc AS (
    SELECT [list_reduce(list_prepend(n, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) FOR n IN range(256)] AS bits
),
named AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations
),
dealt AS (
    SELECT conv_id, turn, role, text, xor(4294967295, list_reduce(list_prepend(4294967295, [ord(name[i]) FOR i IN range(1, length(name) + 1)]), lambda c, b: xor(bits[(xor(c, b) & 255) + 1], c >> 8))) % 20 AS k
    FROM named, crc
),
damaged AS (
    SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM dealt, (SELECT unnest([1, 2]) AS copy) WHERE k <> 0 AND (copy = 1 OR k = 3)
),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, rtrim(text, {space}) AS bare FROM numbered
),
rows AS (
    SELECT conv_id, turn, i, role, text, left(role, 1) AS initial, bare = '' AS blank, bare <> '' AND again AS duplicate, bare <> '' AND NOT again AND right(bare, 1) NOT IN ('.', '!', '?') AS truncated,
        left(role, 1) || lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) NOT IN ('su', 'ua', 'au') AS illegal
    FROM placed
),
counted AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal
    FROM rows GROUP BY conv_id
),
best AS (
    SELECT conv_id, n AS i, {each(lambda q: f"{ends[q]}::{kind} AS v{q}")} FROM counted
    UNION ALL
    SELECT conv_id, i, {each(inserted)} FROM (SELECT conv_id, i, {each(inserted)} FROM (SELECT conv_id, i, {each(inserted)} FROM (
        SELECT conv_id, i - 1 AS i, {each(taken)} FROM (SELECT b.conv_id, b.i, b.v0, b.v1, b.v2, b.v3, r.initial, r.role, r.text, r.blank OR r.duplicate AS gone, r.truncated::BIGINT AS short FROM best b JOIN rows r ON b.conv_id IS NOT DISTINCT FROM r.conv_id AND b.i = r.i))))
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
    coalesce(v0.cost, 0) AS cost, coalesce(v0.audit, '') AS audit, sha256(coalesce(array_to_string(v0.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN counted d ON c.conv_id IS NOT DISTINCT FROM d.conv_id LEFT JOIN best b ON c.conv_id IS NOT DISTINCT FROM b.conv_id AND b.i = 0
"""


OP12_SQL = _sql()
