"""Conversation structure repair by lazy weighted determinisation.

The cheapest edits that give the role initials ``(s?(ua)+)?`` are the cheapest path through a weighted
automaton of four states (nothing yet, after s, after u, after a). Rows are scanned from the last to
the first: the vector of the four states' costs to the end, less its minimum, is a state of a
deterministic automaton, whose transitions by row symbol are made when they are first met and kept in a
table, so a scan costs one look-up a row. The trace goes the other way, from the first row on: of the
arcs that are tight (their cost is what the vectors differ by) it takes the letter that sorts first.
"""

from __future__ import annotations

import functools
import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .scratch import table
from .token_counts import small_batches

#: Costs of the edits (fixed values), and of a truncated row that stays.
REROLE, DELETE, INSERT, STAYS = 3, 4, 3, 3
#: States: nothing yet, after s, after u, after a. The role that may be set or inserted next, by state, and the state after it.
NEXT_ROLE, NEXT = ("user", "user", "assistant", "user"), (2, 2, 3, 2)
#: Where a kept row leads, by state and initial (s, u, a, other); None: it can't stay.
KEPT = ((1, 2, None, None), (None, 2, None, None), (None, None, 3, None), (None, 2, None, None))
#: Costs of the states at the end of a conversation: insertions up to an ending that is allowed.
AT_END = (0, 2 * INSERT, INSERT, 0)
#: Row symbols: 0 has to go, else 1 + 2 * initial + truncated.
SYMBOLS = 9
#: Bits of a row's marks; the initial's number stands above them.
BLANK, AGAIN, TRUNCATED, INITIAL = 1, 2, 4, 3
INITIALS = ("s", "u", "a")
LEGAL = {(0, 1), (1, 2), (2, 1)}


class Automaton:
    """The deterministic automaton, as far as rows have needed it."""

    def __init__(self):
        self.vectors: list[tuple[int, ...]] = []
        self.number: dict[tuple[int, ...], int] = {}
        self.to: list[int] = []
        self.weight: list[int] = []
        self.choice: list[list[tuple[str, int]] | None] = []
        self.start = self.state(AT_END)

    def state(self, vector: tuple[int, ...]) -> int:
        if vector not in self.number:
            self.number[vector] = len(self.vectors)
            self.vectors.append(vector)
            self.to += [-1] * SYMBOLS
            self.weight += [0] * SYMBOLS
            self.choice += [None] * SYMBOLS
        return self.number[vector]

    @staticmethod
    def arcs(symbol: int, q: int) -> list[tuple[str, int, int]]:
        """Edits of a row in state ``q``: letter, cost, state after it."""
        out = [("D", DELETE, q)]
        if symbol:
            initial, truncated = divmod(symbol - 1, 2)
            if (to := KEPT[q][initial]) is not None:
                out.append(("K", STAYS * truncated, to))
            out.append(("R", REROLE + STAYS * truncated, NEXT[q]))
        return out

    def make(self, at: int) -> None:
        """Fills entry ``at`` of the tables: the step from a state (of the rows behind) over a symbol."""
        state, symbol = divmod(at, SYMBOLS)
        after = self.vectors[state]
        cost = [min(c + after[to] for _, c, to in self.arcs(symbol, q)) for q in range(4)]
        for _ in range(4):
            cost = [min(c, INSERT + cost[NEXT[q]]) for q, c in enumerate(cost)]
        best = []
        for q in range(4):
            edits, now = "", q
            while True:
                tight = [(letter, to) for letter, c, to in self.arcs(symbol, now) if c + after[to] == cost[now]]
                if INSERT + cost[NEXT[now]] == cost[now]:
                    tight.append(("I", NEXT[now]))
                letter, to = min(tight)
                edits, now = edits + letter, to
                if letter != "I":
                    break
            best.append((edits, now))
        least = min(cost)
        self.to[at], self.weight[at], self.choice[at] = self.state(tuple(c - least for c in cost)), least, best

    def scan(self, symbols: bytearray) -> tuple[int, array]:
        """Cost of the cheapest repair, and the table entry of each row."""
        state, total, to, weight = self.start, 0, self.to, self.weight
        entries = array("i", bytes(4 * len(symbols)))
        for i in range(len(symbols) - 1, -1, -1):
            at = state * SYMBOLS + symbols[i]
            if to[at] < 0:
                self.make(at)
            entries[i], state, total = at, to[at], total + weight[at]
        return total + self.vectors[state][0], entries


@functools.cache
def automaton() -> Automaton:
    return Automaton()


class Repair:
    """One conversation: first the marks of its rows, then the rows themselves, each in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.symbols, self.entries = conv_id, bytearray(), None
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = self.turns = 0
        self.before = self.least = self.most = self.last = None
        self.row, self.state = 0, 0

    def mark(self, turn: int | None, marks: int, digest: bytes) -> None:
        initial = marks >> INITIAL
        if self.before is not None and (self.before, initial) not in LEGAL:
            self.illegal += 1
        if turn is not None and turn != self.most:
            self.least, self.most, self.turns = turn if self.least is None else self.least, turn, self.turns + 1
        # rows of one turn, role and text stand next to each other; other repetitions are marked
        again, self.before, self.last = marks & AGAIN or self.last == (turn, digest), initial, (turn, digest)
        if marks & BLANK:
            self.blank += 1
        elif again:
            self.duplicate += 1
        elif marks & TRUNCATED:
            self.truncated += 1
        self.symbols.append(0 if marks & BLANK or again else 1 + 2 * initial + bool(marks & TRUNCATED))

    def settle(self) -> None:
        if self.entries is None:
            self.cost, self.entries = automaton().scan(self.symbols)

    def edits(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """Letter, role and text of the next row's edits; a deleted row has those that it had."""
        self.settle()
        letters, after = automaton().choice[self.entries[self.row]][self.state]
        for letter in letters:
            if letter == "I":
                yield letter, NEXT_ROLE[self.state], ""
                self.state = NEXT[self.state]
            else:
                yield letter, NEXT_ROLE[self.state] if letter == "R" else role, text
        self.row, self.state = self.row + 1, after

    def end(self) -> Iterator[tuple[str, str, str]]:
        self.settle()
        for _ in range(AT_END[self.state] // INSERT):
            yield "I", NEXT_ROLE[self.state], ""
            self.state = NEXT[self.state]

    @property
    def gaps(self) -> int:
        return 0 if self.most is None else self.most - self.least + 1 - self.turns


def prepared(turns: DataFrame) -> DataFrame:
    """Each row twice in the order that ``walk`` needs: its marks, without the text, and itself.

    Conversations are dealt to tasks and sorted there by Spark, which spills. In a conversation all
    marks stand before all rows, both by turn (nulls first), role and text (its first 40 characters
    and then its digest). Whether role and text were seen in an earlier turn comes from an aggregation, so a
    conversation or a text with a third of all rows gathers nowhere. Rows whose ``keep`` is false only make their conversation known.
    """
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), text.alias("text"), "keep")
    digest = F.unhex(F.md5(F.concat(F.hex("role"), F.lit(" "), "text").cast("binary")))
    rows = rows.select("*", F.left("text", F.lit(40)).alias("front"), digest.alias("digest"))
    inked = F.rtrim(F.regexp_replace("text", r"[\x09-\x0D]", " "))
    initial = F.left("role", F.lit(1))
    number = F.coalesce(*[F.when(initial == x, F.lit(k)) for k, x in enumerate(INITIALS)], F.lit(len(INITIALS)))
    marks = F.when(inked == "", BLANK).otherwise(F.when(~F.right(inked, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(0)) + F.lit(1 << INITIAL) * number
    order = ["conv_id", "turn", "role", "front", "digest"]
    marked = rows.select(*order, F.when(F.col("keep"), marks).otherwise(-1).cast("int").alias("marks"))
    many = marked.where("marks >= 0").groupBy("conv_id", "digest").agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("n")).where("n > 1")
    many = many.select(F.col("conv_id").alias("c"), F.col("digest").alias("d"), F.col("first.turn").alias("first_turn"))
    again = marked.join(many, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")), "left")
    later = (F.col("marks") >= 0) & F.col("d").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first_turn"))
    again = again.select(*order, (F.col("marks") + F.when(later, AGAIN).otherwise(0)).alias("marks"), F.lit(None).cast("string").alias("text"))
    whole = rows.where("keep").select(*order, F.lit(None).cast("int").alias("marks"), "text")
    both = again.unionByName(whole)
    kind = F.col("marks").isNull()
    return both.repartition("conv_id").sortWithinPartitions("conv_id", kind, *order[1:]).select("conv_id", "turn", "marks", "digest", "role", "text")


def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Repair, tuple[str, str, str] | None]]:
    """Each edit in order with its conversation; None at the conversation's end. Five bytes a row of one conversation are held."""
    now = None
    for b in batches:
        for conv_id, turn, marks, digest, role, text in zip(*(c.to_pylist() for c in b.columns)):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    yield from ((now, e) for e in now.end())
                    yield now, None
                now = Repair(conv_id)
            if marks is None:
                for e in now.edits(role, text):
                    yield now, e
            elif marks >= 0:
                now.mark(turn, marks, digest)
    if now is not None:
        yield from ((now, e) for e in now.end())
        yield now, None


def batched(rows: Iterator[tuple], types: pa.Schema, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches of about ``size`` bytes."""
    held, room = [], size
    for r in rows:
        held.append(r)
        room -= 64 + sum(len(x) for x in r if isinstance(x, str))
        if room <= 0:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types.types)], schema=types)
            held, room = [], size
    columns = list(zip(*held)) if held else [()] * len(types)
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.types)], schema=types)


def repaired(turns: DataFrame) -> DataFrame:
    """Every edit of every conversation: conv_id, place (from 0), edit (K, R, D or I), role and text.

    The repaired conversation is what has no D, by place. ``turns`` has conv_id, turn, role, text and
    keep (boolean; rows that aren't kept are left out); other columns go. Null roles and texts are one
    space; null conv_ids are a conversation. Repeated rows are rows, and duplicates but for the first.
    Conversations without rows have no edits; an empty table gives none.
    """
    types = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        place = 0
        for conversation, edit in walk(batches):
            if edit is None:
                place = 0
            else:
                yield conversation.conv_id, place, *edit
                place += 1

    small_batches(turns.sparkSession)
    return prepared(turns).mapInArrow(lambda b: batched(rows(b), types), "conv_id long, place long, edit string, role string, text string")


def reports(turns: DataFrame) -> DataFrame:
    """A row a conversation: its faults, the cost and letters of the repair and the digest of what is left.

    Takes what ``repaired`` takes. SHA-256 takes its input in order, so one conversation's rows stream
    through one task. A conversation of which no row is kept has zeros, no letters and the digest of nothing.
    """
    longs = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    types = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in longs], ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        letters, digest, glue = [], hashlib.sha256(), b""
        for c, edit in walk(batches):
            if edit is None:
                yield c.conv_id, *[getattr(c, k) for k in longs], "".join(letters), digest.hexdigest()
                letters, digest, glue = [], hashlib.sha256(), b""
                continue
            letters.append(edit[0])
            if edit[0] != "D":
                digest.update(glue + f"{edit[1]}:{edit[2]}".encode())
                glue = b"\n"

    small_batches(turns.sparkSession)
    return prepared(turns).mapInArrow(lambda b: batched(rows(b), types), "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")


def damaged(turns: DataFrame) -> DataFrame:
    """``conversations`` with one row in four damaged, by crc32 of conv_id:turn (nulls: one space)."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), (F.crc32(name.cast("binary")) % 20).alias("way"))
    text = F.when(F.col("way") == 1, "").when(F.col("way") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("way") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", F.when(F.col("way") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("way") != 0).alias("keep"), copies.alias("copy")).drop("copy")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports(damaged(table(spark, sf_dir, "conversations")))


SQL = r"""
WITH RECURSIVE t AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
h AS (SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(k) + 1), lambda i: CAST(ord(k[i]) AS BIGINT))),
        lambda c, x: list_reduce(list_prepend(xor(c, x), range(8)), lambda d, e: xor(d >> 1, 3988292384 * (d & 1)))), 4294967295) % 20 AS way FROM t),
r0 AS (SELECT conv_id, turn, CASE WHEN way = 4 THEN 'user' ELSE role END AS role, CASE way WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE WHEN way = 3 THEN [0, 1] ELSE [0] END) AS copy FROM h WHERE way <> 0),
r1 AS (SELECT *, left(role, 1) AS ini, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(text, 40), md5(hex(role) || ' ' || text)) AS i,
        regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS ink FROM r0),
r12 AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again FROM r1),
r2 AS (SELECT *, lag(ini) OVER (PARTITION BY conv_id ORDER BY i) AS ini0, CASE WHEN ink = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN ink NOT IN ('.', '!', '?') THEN 'truncated' END AS fault FROM r12),
n AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (i > 1 AND ini0 || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM r2 GROUP BY conv_id),
d AS (SELECT conv_id, n AS i, [{'c': 0, 'e': ''}, {'c': 6, 'e': 'II'}, {'c': 3, 'e': 'I'}, {'c': 0, 'e': ''}] AS v FROM n
      UNION ALL
      SELECT conv_id, i, [list_min([b[1], {'c': b[3].c + 3, 'e': 'I' || b[3].e}, {'c': b[4].c + 6, 'e': 'II' || b[4].e}]), list_min([b[2], {'c': b[3].c + 3, 'e': 'I' || b[3].e}, {'c': b[4].c + 6, 'e': 'II' || b[4].e}]),
                          list_min([b[3], {'c': b[4].c + 3, 'e': 'I' || b[4].e}]), list_min([b[4], {'c': b[3].c + 3, 'e': 'I' || b[3].e}])]
      FROM (SELECT d.conv_id, d.i - 1 AS i, list_transform([1, 2, 3, 4], lambda q: list_min(list_filter([{'c': v[q].c + 4, 'e': 'D' || v[q].e},
              CASE WHEN goes AND q = 1 AND ini = 's' THEN {'c': v[2].c + x, 'e': 'K' || v[2].e} END, CASE WHEN goes AND q <> 3 AND ini = 'u' THEN {'c': v[3].c + x, 'e': 'K' || v[3].e} END,
              CASE WHEN goes AND q = 3 AND ini = 'a' THEN {'c': v[4].c + x, 'e': 'K' || v[4].e} END,
              CASE WHEN goes THEN {'c': v[CASE WHEN q = 3 THEN 4 ELSE 3 END].c + 3 + x, 'e': 'R' || v[CASE WHEN q = 3 THEN 4 ELSE 3 END].e} END], lambda y: y IS NOT NULL))) AS b
            FROM d JOIN (SELECT *, coalesce(fault, '') NOT IN ('blank', 'duplicate') AS goes, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS x FROM r2) r ON r.conv_id IS NOT DISTINCT FROM d.conv_id AND r.i = d.i)),
best AS (SELECT conv_id, v[1].c AS cost, v[1].e AS audit FROM d WHERE i = 0),
steps AS (SELECT conv_id, p, audit[p] AS e, length(replace(left(audit, p), 'I', '')) AS i, length(replace(left(audit, p), 'D', '')) AS o FROM (SELECT *, unnest(range(1, length(audit) + 1)) AS p FROM best)),
made AS (SELECT s.*, role, text, max(CASE WHEN s.o = 1 AND e = 'K' AND ini = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY s.conv_id) AS sys FROM steps s LEFT JOIN r2 ON r2.conv_id IS NOT DISTINCT FROM s.conv_id AND r2.i = s.i),
texts AS (SELECT conv_id, sha256(string_agg(CASE WHEN e = 'K' THEN role ELSE CASE WHEN (o - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY p)) AS sha FROM made WHERE e <> 'D' GROUP BY conv_id)
SELECT CAST(a.conv_id AS BIGINT) AS conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN texts ON texts.conv_id IS NOT DISTINCT FROM a.conv_id
"""
