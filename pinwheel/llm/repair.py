"""Conversation structure repair by survivor-coalescence Viterbi decoding.

A conversation is in order if the first letters of its roles read ``s?(ua)+`` (a system turn
at most, then user and assistant in turn) or if it is empty. Each row has a fault: blank (no
character but ASCII white space), duplicate (role and text seen earlier in the conversation)
or truncated (its last such character doesn't end a sentence). Edits: Keep costs 0, Rerole to
user or assistant 1, Delete 2 (the only one allowed for blank and duplicate rows), Insert an
empty user or assistant turn anywhere 5; a truncated row that isn't deleted adds 5. The
cheapest edits win, ties go to the ASCII-least sequence of initials.

Decoding: the pattern's automaton has four states (start, after system, after user, after
assistant), and every state keeps its best path so far, a leaf of a tree of backpointers
whose nodes count their references. When a row is done, paths that no state continues are
freed; as soon as all survivors share the first edges of the tree, these are emitted and
forgotten, so memory holds the unresolved rows only. Two paths to one state at equal cost
differ at some edit (a longer one has more insertions, hence a higher cost), so comparing the
unresolved initials decides a tie for good: what has been emitted is common to both. A state
that another one reaches at a strictly lower cost, whatever follows (``BRIDGE``), is dropped,
which keeps the unresolved part short.

Spark deals conversations to tasks by id and sorts each by turn; repeated rows are marked by
a window over (conversation, digest of role and text) before. A task reads its rows as a
stream: one conversation, however long, passes in order through one task (the digest of its
repaired text is sequential), but nothing of it is held except unresolved rows, the digest
and one initial per edit.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pinwheel.llm.common import slices

START, SYSTEM, USER, ASSISTANT = range(4)
NAMES = {USER: "user", ASSISTANT: "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: State after a turn whose role has this initial.
GOES = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
#: A user or assistant turn that can come next.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: BRIDGE[p][q]: whatever follows, going on from q costs at most so much more than from p
#: (insertions lead from q to p; a kept system turn is deleted instead).
BRIDGE = {
    START: {SYSTEM: 2 * INSERT + DELETE, USER: INSERT + DELETE, ASSISTANT: DELETE},
    SYSTEM: {START: 0, USER: INSERT, ASSISTANT: 0},
    USER: {START: INSERT, SYSTEM: INSERT, ASSISTANT: INSERT},
    ASSISTANT: {START: 0, SYSTEM: 2 * INSERT, USER: INSERT},
}
BLANK, DUPLICATE, CUT = "blank", "duplicate", "truncated"


class _Node:
    """An edit: its initial, the turn it leaves (None if deleted), its predecessor, and how many
    later edits and survivors hold on to it."""
    __slots__ = ("initial", "turn", "parent", "refs")

    def __init__(self, initial, turn, parent):
        self.initial, self.turn, self.parent, self.refs = initial, turn, parent, 0
        if parent is not None:
            parent.refs += 1


class Decoder:
    """Repairs one conversation; ``emit(initial, turn)`` gets every edit as soon as it is certain."""

    def __init__(self, emit):
        self.emit, self.longest = emit, 0
        self.root = _Node("", None, None)
        self.survivors = {START: (0, self.root)}
        self.root.refs = 1
        self._insertions(self.survivors)

    def _unresolved(self, node) -> list[_Node]:
        path = []
        while node is not self.root:
            path.append(node)
            node = node.parent
        return path[::-1]

    def _offer(self, to: dict, state: int, cost: int, initial: str, turn, parent: _Node) -> None:
        """Let ``state`` be reached by an edit after ``parent``, if that is the best way so far."""
        old = to.get(state)
        if old is not None and old[0] <= cost:
            if old[0] < cost:
                return
            mine = [n.initial for n in self._unresolved(parent)] + [initial]
            if [n.initial for n in self._unresolved(old[1])] <= mine:
                return
        node = _Node(initial, turn, parent)
        node.refs = 1
        to[state] = (cost, node)
        if old is not None:
            self._release(old[1])

    def _release(self, node) -> None:
        while node is not None:
            node.refs -= 1
            if node.refs:
                return
            node = node.parent

    def _insertions(self, to: dict) -> None:
        for state in (START, SYSTEM, ASSISTANT):
            if state in to:
                cost, node = to[state]
                self._offer(to, USER, cost + INSERT, "I", ("user", ""), node)
        cost, node = to[USER]
        self._offer(to, ASSISTANT, cost + INSERT, "I", ("assistant", ""), node)

    def row(self, role: str, text: str, fault: str | None) -> None:
        to: dict = {}
        extra = TRUNCATED if fault == CUT else 0
        for state, (cost, node) in self.survivors.items():
            self._offer(to, state, cost + DELETE, "D", None, node)
            if fault in (BLANK, DUPLICATE):
                continue
            kept = GOES[state].get(role[:1])
            if kept is not None:
                self._offer(to, kept, cost + KEEP + extra, "K", (role, text), node)
            new = NEXT[state]
            self._offer(to, new, cost + REROLE + extra, "R", (NAMES[new], text), node)
        self._insertions(to)
        for state in list(to):
            if any(to[q][0] + more < to[state][0] for q, more in BRIDGE[state].items() if q in to):
                self._release(to.pop(state)[1])
        for _, node in self.survivors.values():
            self._release(node)
        self.survivors = to
        self._coalesce()

    def _coalesce(self) -> None:
        ends = {id(node) for _, node in self.survivors.values()}
        if self.root.refs > 1 or id(self.root) in ends:
            return
        path = self._unresolved(next(iter(self.survivors.values()))[1])
        self.longest = max(self.longest, len(path))
        for node in path:
            self.emit(node.initial, node.turn)
            node.parent, self.root = None, node
            if node.refs > 1 or id(node) in ends:
                return

    def finish(self) -> int:
        """Emit what is left; the cost of all edits."""
        ends = [(cost, [n.initial for n in self._unresolved(node)], node)
                for state, (cost, node) in self.survivors.items() if state in (START, ASSISTANT)]
        cost, _, node = min(ends, key=lambda e: e[:2])
        for n in self._unresolved(node):
            self.emit(n.initial, n.turn)
        return cost


# ---- rows and their faults, in DataFrame expressions ----

def damage(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """``conv``, ``turn``, ``role``, ``text``, ``copy``: rows damaged by crc32(``conv:turn``) mod 20
    (0 drops the row: copy 0; 1 empties the text, 2 removes its ``.!?``, 3 repeats the row, 4
    makes it the user's). Null roles and texts are one space, as are nulls in the hashed text."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank(conv_col), F.lit(":"), blank(turn_col)).cast("binary")) % 20
    rows = conversations.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), blank(role_col).alias("role"),
                                blank(text_col).alias("text"), kind.alias("kind"))
    copies = F.when(F.col("kind") == 0, F.array(F.lit(0))).when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select(
        "conv", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") < 2, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(copies).alias("copy"))


def whole(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """The rows as they are, in the form of ``damage``."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return conversations.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), blank(role_col).alias("role"),
                                blank(text_col).alias("text"), F.lit(1).alias("copy"))


def with_faults(rows: DataFrame) -> DataFrame:
    """Add ``fault``: blank, duplicate, truncated or null; the first that holds."""
    solid = r"[^\x20\x09-\x0D]"
    digest = F.when(F.col("copy") > 0, F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary")))
    same = W.partitionBy("conv", "digest").orderBy(F.col("turn").asc_nulls_first(), "copy")
    marked = rows.withColumn("digest", digest).withColumn("place", F.row_number().over(same))
    fault = F.when(F.col("copy") == 0, F.lit(None).cast("string")) \
        .when(~F.col("text").rlike(solid), F.lit(BLANK)) \
        .when(F.col("place") > 1, F.lit(DUPLICATE)) \
        .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), F.lit(CUT))
    return marked.withColumn("fault", fault).drop("digest", "place")


def _in_order(faulty: DataFrame) -> DataFrame:
    return faulty.repartition("conv").sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text", "copy")


def _conversations(batches):
    """(conv, iterator over its rows) for each conversation of a sorted stream of batches; rows
    are (turn, role, text, copy, fault)."""
    from itertools import groupby

    def rows():
        for batch in batches:
            for piece in slices(batch, "text"):
                yield from zip(*(piece.column(k).to_pylist() for k in range(6)))
    for conv, group in groupby(rows(), key=lambda r: r[0]):
        yield conv, (r[1:] for r in group)


def _decoded(batches, edits: bool):
    """Per conversation its report, or with ``edits`` one row per edit; in batches of 1,000 rows."""
    def report(conv, rows):
        audit, sha, first = [], hashlib.sha256(), True

        def emit(initial, turn):
            nonlocal first
            audit.append(initial)
            if turn is not None:
                sha.update((("" if first else "\n") + turn[0] + ":" + turn[1]).encode("utf-8", "surrogatepass"))
                first = False
        decoder, count, illegal, before = Decoder(emit), dict.fromkeys((BLANK, DUPLICATE, CUT), 0), 0, None
        low = high = last = None
        distinct = 0
        for turn, role, text, copy, fault in rows:
            if not copy:
                continue
            if turn is not None:
                distinct += turn != last
                low, high, last = turn if low is None else low, turn, turn
            if fault:
                count[fault] += 1
            if before is not None:
                illegal += before + role[:1] not in ("su", "ua", "au")
            before = role[:1]
            decoder.row(role, text, fault)
        cost = decoder.finish()
        gaps = 0 if low is None else high - low + 1 - distinct
        yield conv, gaps, count[BLANK], count[DUPLICATE], count[CUT], illegal, cost, "".join(audit), sha.hexdigest()

    def listed(conv, rows):
        out = []
        decoder, place = Decoder(lambda initial, turn: out.append((initial, turn))), 0
        for _, role, text, copy, fault in rows:
            if copy:
                decoder.row(role, text, fault)
                for initial, turn in out:
                    yield conv, place, initial, *(turn or (None, None))
                    place += 1
                out.clear()
        decoder.finish()
        for initial, turn in out:
            yield conv, place, initial, *(turn or (None, None))
            place += 1

    held = []
    for conv, rows in _conversations(batches):
        for row in (listed if edits else report)(conv, rows):
            held.append(row)
            if len(held) == 1000:
                yield held
                held = []
    if held:
        yield held


def _decode(faulty: DataFrame, edits: bool, schema: str) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for rows in _decoded(batches, edits):
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    return _in_order(faulty).select("conv", "turn", "role", "text", "copy", "fault").mapInArrow(run, schema)


def repair_edits(rows: DataFrame) -> DataFrame:
    """``conv``, ``place``, ``edit`` (K, R, D or I), ``role`` and ``text`` (null if deleted): the
    cheapest edits of every conversation of ``rows`` (from ``whole`` or ``damage``), in order.

    Rows with equal turns stand in the order of role and text. Conversations without rows have
    no edits. An empty table gives no rows. Rows with a null conversation id form one. An empty
    role has no initial, so it can't be kept.
    """
    kind = rows.schema["conv"].dataType.simpleString()
    return _decode(with_faults(rows), True, f"conv {kind}, place long, edit string, role string, text string")


def repair_report(rows: DataFrame) -> DataFrame:
    """Per conversation of ``rows``: ``conv_id``, gaps, blank, duplicate, truncated, illegal, cost
    (longs), audit, repaired_sha256.

    Edge cases as in ``repair_edits``; a conversation that lost all rows has zeros, an empty
    audit and the digest of the empty string. Null turns come first and count in no gap.
    """
    kind = rows.schema["conv"].dataType.simpleString()
    schema = (f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
              "audit string, repaired_sha256 string")
    return _decode(with_faults(rows), False, schema)


# ---- the same in SQL: rows one after the other, best paths of the four states as structs ----

def oracle_sql() -> str:
    """DuckDB SQL for ``repair_report(damage(conversations))``."""
    def way(state, cost, initial, role, text):
        turn = "''" if initial == "D" else f"(CASE WHEN {state}.t IS NULL THEN '' ELSE {state}.t || chr(10) END) || {role} || ':' || {text}"
        kept = f"{state}.t" if initial == "D" else turn
        return f"struct_pack(c := {state}.c + {cost}, a := {state}.a || '{initial}', t := {kept})"

    def best(options):
        return f"list_sort(list_filter([{', '.join(options)}], lambda o: o.c IS NOT NULL))[1]"

    ok, extra = "ok", "x"
    # s0 .. s3 are the four states' best paths; d* after the row, e* after insertions.
    def step(q):
        opts = [way(f"s{q}", 2, "D", "", "")]
        for p, letter in ((START, "s"), (START, "u"), (SYSTEM, "u"), (USER, "a"), (ASSISTANT, "u")):
            if GOES[p][letter] == q:
                opts.append(f"CASE WHEN {ok} AND role[1:1] = '{letter}' THEN {way(f's{p}', extra, 'K', 'role', 'txt')} END")
        for p in range(4):
            if NEXT[p] == q:
                opts.append(f"CASE WHEN {ok} THEN {way(f's{p}', f'1 + {extra}', 'R', repr(NAMES[q]), 'txt')} END")
        return best(opts)

    none = "struct_pack(c := CAST(NULL AS BIGINT), a := CAST(NULL AS VARCHAR), t := CAST(NULL AS VARCHAR))"
    ins = {2: best(["d2"] + [way(f"d{p}", 5, "I", "'user'", "''") for p in (0, 1, 3)]), 3: best(["d3", way("e2", 5, "I", "'assistant'", "''")])}
    fix = lambda x: f"coalesce({x}, {none})"
    return f"""
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
r AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS txt,
    xor(list_reduce(list_concat([4294967295], list_transform(string_split(
      coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda ch: CAST(ord(ch) AS BIGINT))),
      lambda c, b: xor(c >> 8, tab.t[CAST((xor(c, b) & 255) + 1 AS INTEGER)])), 4294967295) % 20 AS kind
  FROM conversations, tab),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(txt, '.!?', '') ELSE txt END AS txt,
    unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM r WHERE kind <> 0),
f AS (
  SELECT *, row_number() OVER w AS i, role[1:1] AS ini, lag(role[1:1]) OVER w AS prev,
    CASE WHEN NOT regexp_matches(txt, '[^\\x20\\x09-\\x0D]') THEN 'blank'
         WHEN row_number() OVER (PARTITION BY conv_id, role, txt ORDER BY turn NULLS FIRST, copy) > 1 THEN 'duplicate'
         WHEN NOT regexp_matches(txt, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' END AS fault
  FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, txt, copy)),
n AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (i > 1 AND prev || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv_id),
z AS (SELECT struct_pack(c := CAST(0 AS BIGINT), a := '', t := CAST(NULL AS VARCHAR)) AS s0, {none} AS none),
v AS (
  SELECT c.conv_id, CAST(0 AS BIGINT) AS i, s0, none AS s1, struct_pack(c := CAST(5 AS BIGINT), a := 'I', t := 'user:') AS s2,
    struct_pack(c := CAST(10 AS BIGINT), a := 'II', t := 'user:' || chr(10) || 'assistant:') AS s3
  FROM (SELECT DISTINCT conv_id FROM conversations) c, z
  UNION ALL
  SELECT conv_id, i, d0, d1, e2, {fix(ins[3])}
  FROM (SELECT *, {fix(ins[2])} AS e2
    FROM (SELECT conv_id, i, {fix(step(0))} AS d0, {fix(step(1))} AS d1, {fix(step(2))} AS d2, {fix(step(3))} AS d3
      FROM (SELECT v.conv_id, f.i, s0, s1, s2, s3, role, txt, coalesce(fault, '') NOT IN ('blank', 'duplicate') AS ok,
              CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS x
            FROM v JOIN f ON v.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = v.i + 1)))),
e AS (
  SELECT v.conv_id, coalesce(n.gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, {best(['s0', 's3'])} AS w
  FROM v LEFT JOIN n ON v.conv_id IS NOT DISTINCT FROM n.conv_id WHERE v.i = coalesce(n.n, 0))
SELECT conv_id, CAST(gaps AS BIGINT) AS gaps, CAST(blank AS BIGINT) AS blank, CAST(duplicate AS BIGINT) AS duplicate,
  CAST(truncated AS BIGINT) AS truncated, CAST(illegal AS BIGINT) AS illegal, CAST(w.c AS BIGINT) AS cost, w.a AS audit,
  sha256(coalesce(w.t, '')) AS repaired_sha256
FROM e"""
