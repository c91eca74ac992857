"""Conversation structure repair by depth-first branch-and-bound (operator 13).

A sound conversation has the role initials ``(s?(ua)+)?``: nothing, or an optional system turn
and whole user-assistant pairs. Each row may be kept (free), given the role user or assistant
(3), or deleted (4; a must for blank and duplicate rows), and an empty user or assistant turn
may be inserted anywhere (3); a truncated row that stays adds 3. Sought are the cheapest edits,
and of these the ones whose initials (D, I, K, R) are least as text.

1. Faults are found by Spark: rows alike in all columns are one with a count, duplicates are the
   rows behind the first of equal role and text, by one more aggregate.
2. Rows are dealt by conversation, sorted, and streamed through the search; the task holds
   ``segment`` rows at a time. The search is depth-first over nodes (row, role state) with an
   explicit stack. Suffix bounds give the least cost of the rows left from each state. A partial
   repair goes no further if its cost and bound pass the incumbent (cost, initials), or if its
   node's dominance table has one that is cheaper, or as cheap with lesser initials. The search
   ends when the stack is empty: then no repair is better than the incumbent. Which role an insertion or a new role gives follows from
   the state, so cost and initials name one repair.
3. Of a conversation longer than a segment, the best repair up to the segment's end is kept for
   each role state (the dominance table of those nodes), with its running SHA-256, and the next
   segment goes on from all of them: the result is that of one search over the whole. The hash
   of a repaired conversation is sequential, so one task must read a conversation's rows; it
   keeps a segment and the edits' initials, which the result holds as well.

Defined results: null roles and texts are one space, a null conv_id is a conversation of its
own and a null turn sorts first and is in no gap; a row of another role than s, u or a (or of
an empty role, which has no initial) can't be kept; rows of one turn are taken in the order of
role and text; texts of any length are hashed whole; a conversation without rows (all dropped)
has zeros, empty initials and the hash of the empty text; an empty table gives an empty result.
Only the four columns of a conversation are read, so other columns of any name do not matter.
"""

from __future__ import annotations

import hashlib
import os
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arcash.llm.common import Scratch, read, ship

ship(__name__)

# Role states of a repaired prefix: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, PAIRED = range(4)
WANTED = ("u", "u", "a", "u")                  # the initial that may be put next
AFTER = (USER, USER, PAIRED, USER)             # the state it leads to
ENDS = (START, PAIRED)                         # a repaired conversation may end here
ROLE = {"u": "user", "a": "assistant"}
DELETE, INSERT, RENAME, TRUNCATED = 4, 3, 3, 3
NEVER = 1 << 60                                # more than any repair costs


class Turn(NamedTuple):
    initial: str
    must_go: bool
    truncated: bool


class Label(NamedTuple):
    """A repaired segment: the cost so far, its edits, and the state it started from."""

    cost: int
    audit: str
    origin: int


def edits(turn: Turn | None, state: int):
    """(initial, cost, rows taken, state after) of each edit at a node."""
    yield "I", INSERT, 0, AFTER[state]
    if turn is None:
        return
    yield "D", DELETE, 1, state
    if turn.must_go:
        return
    stay = TRUNCATED * turn.truncated
    if turn.initial == WANTED[state]:
        yield "K", stay, 1, AFTER[state]
        return
    yield "R", RENAME + stay, 1, AFTER[state]
    if turn.initial == "s" and state == START:
        yield "K", stay, 1, SYSTEM


def suffix_bounds(turns: list[Turn], ends) -> list[list[int]]:
    """For each row and role state the least that the rows left can cost on the way to ``ends``."""
    bounds = [[0 if state in ends else NEVER for state in range(4)]]
    for turn in (None, *reversed(turns)):
        after = bounds[-1]
        here = list(after) if turn is None else [
            min((price + after[to] for _, price, taken, to in edits(turn, state) if taken), default=NEVER)
            for state in range(4)]
        for _ in range(2):                             # two insertions reach whatever insertions can
            here = [min(here[state], INSERT + here[AFTER[state]]) for state in range(4)]
        bounds.append(here)
    return bounds[:0:-1]


def search(turns: list[Turn], starts: dict[int, tuple], ends) -> Label | None:
    """The best label behind ``turns`` in one of the states ``ends``, from (cost, audit) by state."""
    n, bound = len(turns), suffix_bounds(turns, ends)
    shared = len(os.path.commonprefix([audit for _, audit in starts.values()]))
    heads = {state: audit[shared:] for state, (_, audit) in starts.items()}
    seen: list[dict] = [{} for _ in range(n + 1)]      # dominance tables: state -> (cost, audit)
    best, incumbent = None, (NEVER - 1, "")
    stack = sorted(((cost + bound[0][state], heads[state], cost, 0, state, state)
                    for state, (cost, _) in starts.items()), reverse=True)
    while stack:
        least, audit, cost, at, state, origin = stack.pop()
        if least > incumbent[0] or (least == incumbent[0] and audit > incumbent[1][:len(audit)]):
            continue
        table = seen[at]
        if state in table and table[state] <= (cost, audit):
            continue
        table[state] = (cost, audit)
        if at == n and state in ends and (cost, audit) < incumbent:
            best, incumbent = Label(cost, audit[len(heads[origin]):], origin), (cost, audit)
        # the edit of the least bound is tried first, of equal ones the least initial
        stack += sorted(((cost + price + bound[at + taken][after], audit + letter, cost + price, at + taken, after, origin)
                         for letter, price, taken, after in edits(turns[at] if at < n else None, state)), reverse=True)
    return best


class Repair:
    """Streams one conversation through the search, a segment at a time."""

    def __init__(self, segment: int):
        self.segment = segment
        self.turns: list[Turn] = []
        self.rows: list[tuple[str, str]] = []
        # state -> (cost, audit, running hash, whether anything was hashed)
        self.best = {START: (0, "", hashlib.sha256(), False)}

    def add(self, turn: Turn, role: str, text: str) -> None:
        if len(self.turns) == self.segment:
            self.advance([(state,) for state in range(4)])
        self.turns.append(turn)
        self.rows.append((role, text))

    def advance(self, goals) -> None:
        """The best repair up to here for each goal (a group of end states)."""
        starts = {state: b[:2] for state, b in self.best.items()}
        found = {goal[0]: search(self.turns, starts, goal) for goal in goals}
        self.best = {state: self._extended(label) for state, label in found.items() if label}
        self.turns, self.rows = [], []

    def _extended(self, label: Label) -> tuple:
        _, audit, digest, started = self.best[label.origin]
        digest, state, at = digest.copy(), label.origin, 0
        for letter in label.audit:
            turn = None if letter == "I" else self.turns[at]
            role, text = ("", "") if letter == "I" else self.rows[at]
            at += letter != "I"
            if letter == "D":
                continue
            if letter == "K" and turn.initial == "s":
                state = SYSTEM
            else:
                role = role if letter == "K" else ROLE[WANTED[state]]
                state = AFTER[state]
            digest.update((("\n" if started else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
            started = True
        return label.cost, audit + label.audit, digest, started

    def finish(self) -> tuple[int, str, str]:
        self.advance([ENDS])
        cost, audit, digest, _ = self.best[ENDS[0]]
        return cost, audit, digest.hexdigest()


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, m) after the damage that each row's hash asks for; rows alike
    are one with their number ``m``, 0 if they were dropped."""
    blank = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(name.cast("binary")) % 20
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("m")) \
        .groupBy("conv_id", "turn", "role", "text").agg(F.sum("m").alias("m"))


def undamaged(rows: DataFrame) -> DataFrame:
    """The same form of rows that are taken as they are."""
    blank = F.lit(" ")
    return rows.select("conv_id", "turn", F.coalesce("role", blank).alias("role"),
                       F.coalesce("text", blank).alias("text")) \
        .groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("m"))


FIGURES = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
           "audit string, repaired_sha256 string")
SPACE = " \t\n\x0b\f\r"


def marked_rows(rows: DataFrame) -> DataFrame:
    """``rows`` with ``last`` (the last character that is not white space; empty for a blank row)
    and ``repeats`` (its role and text occur at an earlier turn)."""
    # turns are compared with the unknown one first
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    first = rows.where("m > 0").groupBy("conv_id", "role", "digest").agg(
        F.min(turn).alias("first"), F.count(F.lit(1)).alias("turns")).where("turns > 1") \
        .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("g"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("g"))
    later = F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    return rows.join(first, same, "left").select(
        "conv_id", "turn", "role", "text", "m", later.alias("repeats"),
        F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1)).alias("last"))


def repair_rows(scratch: Scratch, rows: DataFrame, segment: int) -> DataFrame:
    """One report per conv_id of ``rows(conv_id, turn, role, text, m)``."""
    rows = scratch.cut(rows.withColumn("digest", F.sha2("text", 256)), "rows")
    names = ["conv_id", *[c.split()[0] for c in FIGURES.split(", ")]]

    def stream(batches):
        key, state = None, None
        kind = None

        def report(out):
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], kind if i == 0 else pa.string() if i > 6 else pa.int64())
                 for i in range(len(names))], names)

        for batch in batches:
            out, kind = [], batch.schema.field("conv_id").type
            for conv, *row in zip(*(batch.column(c).to_pylist() for c in
                                    ("conv_id", "turn", "role", "text", "m", "repeats", "last"))):
                if state is None or conv != key:
                    if state is not None:
                        out.append((key, *state.result()))
                    key, state = conv, Conversation(segment)
                state.add(*row)
            yield report(out)
        if state is not None:
            yield report([(key, *state.result())])

    id_type = rows.schema["conv_id"].dataType.simpleString()
    return marked_rows(rows).repartition("conv_id") \
        .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text") \
        .mapInArrow(stream, f"conv_id {id_type}, {FIGURES}")


class Conversation:
    """The figures of one conversation, from its rows in order."""

    def __init__(self, segment: int):
        self.repair = Repair(segment)
        self.low = self.high = self.last_turn = None
        self.distinct = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before = None

    def add(self, turn, role: str, text: str, m: int, repeats: bool, last: str) -> None:
        for i in range(m):
            if turn is not None and turn != self.last_turn:
                self.low = turn if self.low is None else self.low
                self.high = self.last_turn = turn
                self.distinct += 1
            blank = last == ""
            twice = not blank and (repeats or i > 0)
            cut = not (blank or twice) and last not in ".!?"
            self.blank += blank
            self.duplicate += twice
            self.truncated += cut
            initial = role[:1]
            if self.before is not None:
                self.illegal += self.before + initial not in ("su", "ua", "au")
            self.before = initial
            self.repair.add(Turn(initial, blank or twice, cut), role, text)

    def result(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, *self.repair.finish()


def repair_conversations(rows: DataFrame, damage: bool = False, segment: int = 256) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 for each
    conversation of ``rows(conv_id, turn, role, text)``.

    damage: first damage the rows by their hashes (``damaged``); segment: rows a search holds.
    """
    scratch = Scratch(rows.sparkSession, "conversations")
    return repair_rows(scratch, damaged(rows) if damage else undamaged(rows), segment)


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The damaged ``conversations``, each with its faults and its cheapest repair."""
    return repair_conversations(read(spark, sf_dir, "conversations"), damage=True)


def oracle_sql() -> str:
    """DuckDB: CRC-32 by its table, then the four role states' best (cost, initials, rows) row by row."""
    def best(*options):
        return f"list_sort([{', '.join(options)}], 'ASC', 'NULLS LAST')[1]"

    def label(v, cost, letter, *put):
        rows = f"list_concat({v}.o, [{put[0]}])" if put else f"{v}.o"
        return f"case when {v} is not null then {{'c': {v}.c + {cost}, 'a': {v}.a || '{letter}', 'o': {rows}}} end"

    def stay(v, initial, name):
        keep = label(v, "cut", "K", "role || ':' || text")
        new = label(v, "cut + 3", "R", f"'{name}:' || text")
        return f"case when must then null when left(role, 1) = '{initial}' then {keep} else {new} end"

    def insert(v, name):
        return label(v, 3, "I", f"'{name}:'")

    system = f"case when not must and left(role, 1) = 's' then {label('v0', 'cut', 'K', chr(39).join(['role || ', ':', ' || text']))} end"
    delete = [label(f"v{i}", 4, "D") for i in range(4)]
    users = [stay(v, "u", "user") for v in ("v0", "v1", "v3")]
    return f"""
with recursive bits as (select i, list_reduce(list_prepend(i, range(8)),
   lambda c, j: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) v from range(256) t(i)),
 tab as (select list(v order by i) t from bits),
 keyed as (select conv_id, turn, coalesce(role, ' ') role, coalesce(text, ' ') text,
   xor(list_reduce(list_prepend(4294967295, list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' ||
     coalesce(turn::varchar, ' '), ''), lambda x: ord(x)::bigint)),
     lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % 20 kind from conversations, tab),
 rows_ as (select conv_id, turn, case when kind = 4 then 'user' else role end role,
   case when kind = 1 then '' when kind = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end text
  from keyed, range(case kind when 0 then 0 when 3 then 2 else 1 end)),
 numbered as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) i,
   right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) last,
   lag(left(role, 1)) over (partition by conv_id order by turn nulls first, role, text) prev from rows_),
 faults as (select conv_id, i, turn, role, text, last = '' blank, last <> '' and copy > 1 twice,
   last <> '' and copy = 1 and last not in ('.', '!', '?') cutoff,
   prev is not null and prev || left(role, 1) not in ('su', 'ua', 'au') wrong
  from (select *, row_number() over (partition by conv_id, role, text order by i) copy from numbered)),
 step as (select conv_id, i, role, text, blank or twice must, case when cutoff then 3 else 0 end cut from faults),
 walk as (
  select conv_id, 0::bigint i, {{'c': 0, 'a': '', 'o': []::varchar[]}} v0,
    null::struct(c integer, a varchar, o varchar[]) v1, {{'c': 3, 'a': 'I', 'o': ['user:']}} v2,
    {{'c': 6, 'a': 'II', 'o': ['user:', 'assistant:']}} v3 from (select distinct conv_id from conversations)
  union all
  select conv_id, i, n0, n1, u, {best('n3', insert('u', 'assistant'))} from (
   select *, {best('n2', insert('n0', 'user'), insert('n1', 'user'), insert('n3', 'user'))} u from (
    select s.conv_id, s.i, {delete[0]} n0, {best(delete[1], system)} n1, {best(delete[2], *users)} n2,
     {best(delete[3], stay('v2', 'a', 'assistant'))} n3
    from walk w join step s on s.conv_id is not distinct from w.conv_id and s.i = w.i + 1))),
 done as (select conv_id, arg_max({best('v0', 'v3')}, i) r from walk group by conv_id),
 figures as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) gaps,
   count(*) filter (blank) blank, count(*) filter (twice) duplicate, count(*) filter (cutoff) truncated,
   count(*) filter (wrong) illegal from faults group by conv_id)
select d.conv_id, coalesce(gaps, 0)::bigint gaps, coalesce(blank, 0)::bigint blank,
 coalesce(duplicate, 0)::bigint duplicate, coalesce(truncated, 0)::bigint truncated,
 coalesce(illegal, 0)::bigint illegal, r.c::bigint "cost", r.a audit,
 sha256(coalesce(array_to_string(r.o, chr(10)), '')) repaired_sha256
from done d left join figures f on d.conv_id is not distinct from f.conv_id
"""
