"""Conversation repair: the cheapest edits that make a dialogue well formed, by a dynamic program over shared audits."""

from __future__ import annotations

import hashlib
import re
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import query, table
from millrace.llm.sharding import _crc_table

#: Rows of conversations that leave a task in one batch.
OUT_ROWS = 1000
_PRIME, _BASE = (1 << 61) - 1, 0x1F3D5B79
_OVER = pow(_BASE - 1, -1, _PRIME)
_LETTERS = {"D": 1, "I": 2, "K": 3, "R": 4}
_MARKS = re.compile(r"[^\x20\x09-\x0D]")

#: Costs of the edits, and what an undeleted truncated row adds.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: From any state each other one can be matched for two inserts and a deletion, so dearer states never win.
SLACK = 2 * INSERT + DELETE

# States of role initials (s?(ua)+)?: 0 nothing yet, 1 after s, 2 after u, 3 after a; 0 and 3 may end.
_NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_WANTED = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
_END = (0, 3)


class Audits:
    """Audit strings as linked nodes that share their prefixes; node 0 is the empty string.

    A node adds a run of one letter to its parent. It holds its ancestors at distances 2 ** j for every
    2 ** j that divides its depth (two on average), from which any ancestor is reached in logarithmically many
    steps, the length of its string and a rolling hash of it.
    """

    def __init__(self):
        self.letter, self.size, self.hash, self.depth = [""], array("q", [0]), array("q", [0]), array("q", [0])
        self.up, self.at = array("q", [0]), array("q", [0, 1])

    def add(self, parent: int, letter: str, times: int = 1) -> int:
        node, depth = len(self.letter), self.depth[parent] + 1
        self.letter.append(letter)
        self.size.append(self.size[parent] + times)
        self.hash.append(_extend(self.hash[parent], letter, times))
        self.depth.append(depth)
        self.up.append(parent)
        j, above = 1, parent
        while depth % (1 << j) == 0:
            above = self.up[self.at[above] + j - 1]
            self.up.append(above)
            j += 1
        self.at.append(len(self.up))
        return node

    def parent(self, node: int) -> int:
        return self.up[self.at[node]]

    def holder(self, node: int, place: int) -> int:
        """The ancestor (or the node itself) whose run holds the first ``place`` letters' last one."""
        while True:
            for i in range(self.at[node + 1] - 1, self.at[node] - 1, -1):
                if self.size[self.up[i]] >= place and self.up[i] != node:
                    node = self.up[i]
                    break
            else:
                return node

    def prefix_hash(self, node: int, place: int) -> int:
        if not place:
            return 0
        holder = self.holder(node, place)
        above = self.parent(holder)
        return _extend(self.hash[above], self.letter[holder], place - self.size[above])

    def common(self, a: int, b: int) -> int:
        """Length of the longest common prefix: a search on hashes, then the letters that they call equal are verified."""
        low, high = 0, min(self.size[a], self.size[b])
        while low < high:
            mid = (low + high + 1) // 2
            if self.prefix_hash(a, mid) == self.prefix_hash(b, mid):
                low = mid
            else:
                high = mid - 1
        return self._verified(a, b, low)

    def _verified(self, a: int, b: int, place: int) -> int:
        """The first ``place`` letters run by run from the end, until both strings share their nodes."""
        least, here = place, place
        while here:
            a, b = self.holder(a, here), self.holder(b, here)
            if a == b:
                break
            start = max(self.size[self.parent(a)], self.size[self.parent(b)])
            if self.letter[a] != self.letter[b]:
                least = start
            here = start
        return least

    def at_place(self, node: int, last: str, place: int) -> str:
        """Letter number ``place`` of the node's string with ``last`` added; empty beyond it."""
        if place >= self.size[node]:
            return last if place == self.size[node] else ""
        return self.letter[self.holder(node, place + 1)]

    def less(self, a: int, last_a: str, b: int, last_b: str) -> bool:
        """Whether one string with a letter added comes before another one."""
        if a == b:
            return last_a < last_b
        place = self.common(a, b)
        while True:  # at most one step further than the shorter string
            one, other = self.at_place(a, last_a, place), self.at_place(b, last_b, place)
            if one != other or not one:
                return one < other
            place += 1

    def text(self, node: int) -> str:
        runs = []
        while node:
            above = self.parent(node)
            runs.append(self.letter[node] * (self.size[node] - self.size[above]))
            node = above
        return "".join(reversed(runs))


def _extend(value: int, letter: str, times: int) -> int:
    """Rolling hash with ``times`` letters more."""
    if times == 1:
        return (value * _BASE + _LETTERS[letter]) % _PRIME
    power = pow(_BASE, times, _PRIME)
    return (value * power + _LETTERS[letter] * (power - 1) * _OVER) % _PRIME


class Dialogue:
    """One conversation, row by row in order: its faults, and per state the cheapest audit with the hash of what it leaves.

    A state is (cost, node of its audit, digest of the repaired rows or None). Rows that must go are only counted; they
    join all audits alike when another row comes, before any insertion, as D comes before I.
    """

    def __init__(self):
        self.audits = Audits()
        self.states: dict[int, tuple] = {0: (0, 0, None)}
        self.gone = self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.low = self.high = self.last = self.initial = None

    def row(self, turn, role: str, text: str, repeated: bool) -> None:
        if turn is not None:
            self.distinct += turn != self.last
            self.low = turn if self.low is None else self.low
            self.high = self.last = turn
        if self.initial is not None:
            self.illegal += self.initial + role[:1] not in ("su", "ua", "au")
        self.initial = role[:1]
        if not _MARKS.search(text):
            self.blank += 1
        elif repeated:
            self.duplicate += 1
        else:
            torn = text.rstrip(" \t\n\x0b\x0c\r")[-1] not in ".!?"
            self.truncated += torn
            self._edit(role, text, TRUNCATED * torn)
            return
        self.gone += 1

    def _best(self, found: dict, state: int, cost: int, node: int, letter: str) -> bool:
        """Whether an edit is the best so far of those that lead to ``state``."""
        old = found.get(state)
        return old is None or cost < old[0] or (cost == old[0] and self.audits.less(node, letter, old[1], old[2]))

    def _settle(self) -> None:
        """The deletions that wait, then insertions wherever they help."""
        if self.gone:
            self.states = {s: (cost + DELETE * self.gone, self.audits.add(node, "D", self.gone), digest) for s, (cost, node, digest) in self.states.items()}
            self.gone = 0
        changed = list(self.states)
        while changed:
            state = changed.pop()
            cost, node, digest = self.states[state]
            role, target = _WANTED[state]
            old = self.states.get(target)
            if old is None or cost + INSERT < old[0] or (cost + INSERT == old[0] and self.audits.less(node, "I", old[1], "")):
                self.states[target] = (cost + INSERT, self.audits.add(node, "I"), _added(digest, role, ""))
                changed.append(target)

    def _edit(self, role: str, text: str, torn: int) -> None:
        self._settle()
        found: dict[int, tuple] = {}
        for state, (cost, node, _) in self.states.items():
            wanted, target = _WANTED[state]
            kept = _NEXT.get((state, role[:1]))
            edits = [(state, cost + DELETE, "D", None), (target, cost + REROLE + torn, "R", wanted)]
            if kept is not None:
                edits.append((kept, cost + KEEP + torn, "K", role))
            for to, price, letter, said in edits:
                if self._best(found, to, price, node, letter):
                    found[to] = (price, node, letter, state, said)
        bound = min(f[0] for f in found.values()) + SLACK
        self.states = {
            to: (price, self.audits.add(node, letter), self.states[state][2] if said is None else _added(self.states[state][2], said, text))
            for to, (price, node, letter, state, said) in found.items()
            if price <= bound
        }
        if len(self.audits.letter) > 1 << 16 and len({s[1] for s in self.states.values()}) < len(self.audits.letter) >> 4:
            self._compact()

    def _compact(self) -> None:
        """Forget the nodes that no state's audit holds any more, once they are many."""
        old, keep = self.audits, set()
        for _, node, _ in self.states.values():
            while node and node not in keep:
                keep.add(node)
                node = old.parent(node)
        self.audits, moved = Audits(), {0: 0}
        for node in sorted(keep):
            above = old.parent(node)
            moved[node] = self.audits.add(moved[above], old.letter[node], old.size[node] - old.size[above])
        self.states = {s: (cost, moved[node], digest) for s, (cost, node, digest) in self.states.items()}

    def result(self) -> tuple:
        """(gaps, blank, duplicate, truncated, illegal, cost, audit, sha256 of the repaired rows)."""
        self._settle()
        ends = [self.states[s] for s in _END if s in self.states]
        best = ends[0]
        for other in ends[1:]:
            if other[0] < best[0] or (other[0] == best[0] and self.audits.less(other[1], "", best[1], "")):
                best = other
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        digest = best[2] or hashlib.sha256()
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, best[0], self.audits.text(best[1]), digest.hexdigest()


def _added(digest, role: str, text: str):
    fresh = hashlib.sha256() if digest is None else digest.copy()
    fresh.update(f"{'' if digest is None else chr(10)}{role}:{text}".encode())
    return fresh


_COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def _repaired(kind: str):
    """Rows of a partition, sorted by conversation and order, to one row per conversation."""

    def run(batches):
        done, talk, name, started, marked, before = [], None, None, False, None, None
        for batch in batches:
            kinds = batch.column(0).type
            for conv, turn, role, digest, what, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not started or conv != name:
                    if started:
                        done.append((name, *talk.result()))
                    talk, name, started, marked, before = Dialogue(), conv, True, None, None
                    if len(done) >= OUT_ROWS:
                        yield _out(done, kinds)
                        done = []
                here = (turn, role, digest)
                if what == 0:
                    marked = here
                elif what == 1:
                    talk.row(turn, role, text, here in (marked, before))
                    before = here
        if started:
            done.append((name, *talk.result()))
            yield _out(done, kinds)

    def _out(rows, kinds):
        types = [kinds, *[pa.int64()] * 6, pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["conv", *_COLUMNS])

    return run, f"conv {kind}, " + ", ".join(f"{c} {'long' if i < 6 else 'string'}" for i, c in enumerate(_COLUMNS))


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", there: str | None = None) -> DataFrame:
    """One row per conversation: (conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256).

    Rows are taken by turn, nulls first, then role and sha256 of role and text. Each has one fault
    at most: blank, a repetition of an earlier role and text, or truncated (no ``.!?`` at its end). Edits keep, rerole, delete
    or insert rows so that role initials read ``(s?(ua)+)?``; blank and repeated rows must be deleted. The cheapest edits win, of
    those the one with the least audit.

    The dynamic program reads a conversation as a stream and keeps four states at most, each with its cost, the node of its
    audit in :class:`Audits` and a running digest of the rows it leaves, so texts are never held; a run of rows that
    must go is one node. Repetitions across turns are found by a join on digests, beside each other they are seen in the stream.

    Hot conversations: a digest of all repaired rows in order is one sequential computation by its definition, so a
    conversation is one task's stream, however long; the task holds a few dozen bytes per row of audit, never rows.

    Defined cases: a null role or text is one space; a null conversation is one of its own; a role other than
    s..., u..., a... (the empty one too) cannot stay as it is; rows whose ``there`` column is false only name their conversation, which gives
    zeros and the digest of nothing if it has no others; an empty table gives no rows; other columns are ignored.
    """
    kind = dict(rows.dtypes)[conv]
    own = rows.select(
        rows[conv].alias("conv"), rows[turn].cast("long").alias("turn"), F.coalesce(rows[role].cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(rows[text].cast("string"), F.lit(" ")).alias("text"), (F.coalesce(rows[there], F.lit(False)) if there else F.lit(True)).alias("there"),
    )
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    keyed = own.where("there").select("conv", "turn", "role", digest.alias("digest"))
    groups = keyed.groupBy("conv", "digest").agg(F.min("turn").alias("low"), F.max("turn").alias("high"), F.expr("bool_or(turn IS NULL)").alias("unnumbered"))
    again = groups.where("low < high OR (unnumbered AND low IS NOT NULL)").select(F.col("conv").alias("c"), F.col("digest").alias("d"), "low", "unnumbered")
    later = keyed.join(again, keyed["conv"].eqNullSafe(again["c"]) & (keyed["digest"] == again["d"]) & keyed["turn"].isNotNull() & (again["unnumbered"] | (keyed["turn"] > again["low"])))
    marks = later.select("conv", "turn", "role", "digest", F.lit(0).alias("what"), F.lit(None).cast("string").alias("text")).distinct()
    stays, absent = F.col("there"), F.lit(None)
    stream = own.select(
        "conv", F.when(stays, F.col("turn")).otherwise(absent).alias("turn"), F.when(stays, F.col("role")).otherwise(F.lit("")).alias("role"),
        F.when(stays, digest).otherwise(F.lit("")).alias("digest"), F.when(stays, F.lit(1)).otherwise(F.lit(2)).alias("what"), F.when(stays, F.col("text")).otherwise(absent).alias("text"),
    )
    order = [F.asc_nulls_first(c) for c in ("conv", "turn", "role", "digest", "what")]
    run, schema = _repaired(kind)
    return stream.unionByName(marks).repartition("conv").sortWithinPartitions(*order).mapInArrow(run, schema).withColumnRenamed("conv", conv)


def damage(rows: DataFrame) -> DataFrame:
    """Conversations with the contract's faults by crc32 of ``conv_id:turn`` modulo 20; a dropped row stays as one that is not ``there``."""

    def plain(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.pmod(F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")), F.lit(20))
    marked = rows.select("conv_id", "turn", plain("role").alias("role"), plain("text").alias("text"), fault.alias("fault"))
    hit = F.col("fault")
    text = F.when(hit == 1, F.lit("")).when(hit == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(hit == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return marked.select("conv_id", "turn", F.when(hit == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), (hit != 0).alias("there"), copies.alias("copy")).drop("copy")


def _least(*cells: str) -> str:
    return f"list_min([{', '.join(cells)}])"


def _said(cell: str, cost, letter: str, role: str | None, text: str = "''") -> str:
    """A cell after an edit; ``role`` is an SQL expression."""
    out = f"{cell}.out" if role is None else f"CASE WHEN {cell}.n = 0 THEN '' ELSE {cell}.out || chr(10) END || {role} || ':' || {text}"
    return f"CASE WHEN {cell} IS NULL THEN NULL ELSE {{'cost': {cell}.cost + {cost}, 'audit': {cell}.audit || '{letter}', 'n': {cell}.n + {int(role is not None)}, 'out': {out}}} END"


_INSERTED = f"""
  SELECT conv_id, i, a0 AS c0, a1 AS c1, {_least("b2", _said("b3", 5, "I", "'user'"))} AS c2, b3 AS c3 FROM (
    SELECT *, {_least("a3", _said("b2", 5, "I", "'assistant'"))} AS b3 FROM (
      SELECT *, {_least("a2", *(_said(f"a{s}", 5, "I", "'user'") for s in (0, 1, 3)))} AS b2 FROM step))
"""


def _edited(state: int, role: str, sources: tuple) -> str:
    """SQL of a state after one row: deleted, kept from ``sources`` when the initial is right, reroled from them."""
    gone = _said(f"c{state}", 2, "D", None)
    kept = [f"CASE WHEN NOT gone AND substr(role, 1, 1) = '{role[0]}' THEN {_said(f'c{s}', 'torn', 'K', 'role', 'text')} END" for s in sources]
    anew = [f"CASE WHEN NOT gone THEN {_said(f'c{s}', '1 + torn', 'R', chr(39) + role + chr(39), 'text')} END" for s in sources if role != "system"]
    return f"{_least(gone, *kept, *anew)} AS a{state}"


# A recursive statement: one step per row, with the cheapest (cost, audit) of each state and the rows it leaves.
SQL = rf"""
WITH RECURSIVE crc(tbl) AS (SELECT {_crc_table()}::BIGINT[]
), named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    hex(encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))) AS h FROM conversations
), keyed AS (
  SELECT * EXCLUDE h, xor(4294967295::BIGINT, list_reduce(
    list_prepend(4294967295::BIGINT, [CAST('0x' || h[2 * j + 1:2 * j + 2] AS BIGINT) FOR j IN range(len(h) // 2)]),
    lambda a, b: xor(a >> 8, tbl[1 + (xor(a, b) & 255)]))) % 20 AS f FROM named, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
    CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM keyed, (VALUES (1), (2)) AS t(copy) WHERE f <> 0 AND (copy = 1 OR f = 3)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(CAST(len(role) AS VARCHAR) || ':' || role || text)) AS i FROM damaged
), faults AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth, lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS prior, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS is_blank, NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS is_torn FROM placed
), ready AS (
  SELECT *, nth > 1 AS is_again, is_blank OR nth > 1 AS gone, CASE WHEN is_torn THEN 5 ELSE 0 END AS torn FROM faults
), dp AS (
  SELECT conv_id, 0::BIGINT AS i, {{'cost': 0::BIGINT, 'audit': '', 'n': 0, 'out': ''}} AS c0, CAST(NULL AS STRUCT(cost BIGINT, audit VARCHAR, n INTEGER, "out" VARCHAR)) AS c1,
    {{'cost': 5::BIGINT, 'audit': 'I', 'n': 1, 'out': 'user:'}} AS c2, {{'cost': 10::BIGINT, 'audit': 'II', 'n': 2, 'out': 'user:' || chr(10) || 'assistant:'}} AS c3
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT * FROM (WITH step AS (
    SELECT dp.conv_id, r.i, {_said("c0", 2, "D", None)} AS a0, {_edited(1, "system", (0,))}, {_edited(2, "user", (0, 1, 3))}, {_edited(3, "assistant", (2,))}
    FROM dp JOIN ready r ON r.conv_id IS NOT DISTINCT FROM dp.conv_id AND r.i = dp.i + 1) {_INSERTED})
), sums AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (is_blank) AS blank,
    count(*) FILTER (NOT is_blank AND is_again) AS duplicate, count(*) FILTER (NOT is_blank AND NOT is_again AND is_torn) AS truncated,
    count(*) FILTER (prior IS NOT NULL AND substr(prior, 1, 1) || substr(role, 1, 1) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM ready GROUP BY conv_id
), ends AS (
  SELECT dp.conv_id, list_min([c0, c3]) AS c, s.* EXCLUDE (conv_id, n) FROM dp LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM dp.conv_id WHERE dp.i = coalesce(s.n, 0)
)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, c.cost AS cost, c.audit AS audit, sha256(c.out) AS repaired_sha256
FROM ends
"""


@query("op12_audit_repair", SQL)
def op12(spark, folder):
    return repair(damage(table(spark, folder, "conversations", "conv_id", "turn", "role", "text")), there="there")
