"""Repair of a conversation's structure at least cost, by cost layers over the grammar's states.

A conversation's rows, in order, must give role initials ``(s?(ua)+)?``. Edits: Keep a row, Rerole it to user or
assistant, Delete it (blank rows and rows seen before must go), Insert an empty turn; a truncated row that stays costs
as much as a rerole on top.

Layer c holds, for every place between rows, the bitset of grammar states from which the rows after it can be
repaired for c or less, as the errors of approximate matching are taken up layer by layer. Each layer follows from the
four layers before it and, from the last row to the first, from itself. The first layer whose bitset at the first place holds the start
state gives the cost. Walking from there and taking at each step the first of D, I, K, R that stays inside the layers
gives the least audit: an audit's beginning fixes the state, so one walk is enough.

From any state every other one can be matched for ``SPREAD`` at most (two inserts and one delete), so a place's
bitset is full that many layers after it first held a state, and empty before; a layer only works on the places
between. The whole is linear in the number of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
SPREAD = 2 * INSERT + DELETE
START, SYSTEM, USER, ASSISTANT, ALL = 1, 2, 4, 8, 15
#: Row codes: kind of role (0 u, 1 a, 2 s, 3 other), plus CUT where truncated; GONE must be deleted.
CUT, GONE = 4, 8
KINDS = {"u": 0, "a": 1, "s": 2}
BLANK = " \t\n\x0b\x0c\r"
#: Sequences of row codes whose repair a worker remembers.
REMEMBERED = 50_000
_remembered: dict[bytes, tuple[int, str]] = {}


def _before(states: int) -> int:
    """States from which one turn of user or assistant leads into one of these."""
    return (START | SYSTEM | ASSISTANT if states & USER else 0) | (USER if states & ASSISTANT else 0)


BEFORE = [_before(x) for x in range(16)]
#: By kind of role: states from which keeping such a row leads into one of these.
KEPT = [[START | SYSTEM | ASSISTANT if x & USER else 0 for x in range(16)], [USER if x & ASSISTANT else 0 for x in range(16)], [START if x & SYSTEM else 0 for x in range(16)], [0] * 16]
NEXT = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
KEEP_TO = [NEXT | {USER: 0}, {START: 0, SYSTEM: 0, ASSISTANT: 0, USER: ASSISTANT}, {START: SYSTEM, SYSTEM: 0, ASSISTANT: 0, USER: 0}, dict.fromkeys(NEXT, 0)]


class Layers:
    """The cost layers of one sequence of row codes, up to the first one that accepts."""

    def __init__(self, codes: bytes):
        self.codes, n = codes, len(codes)
        self.bits: list[bytearray] = []
        self.top: list[int] = []
        first, top = [-1] * (n + 1), n
        while not self.at(len(self.bits) - 1, 0) & START:
            c = len(self.bits)
            while top > 0 and 0 <= first[top] <= c - SPREAD:
                top -= 1
            self._add(c, n, top, first)
        self.cost = len(self.bits) - 1

    def at(self, c: int, t: int) -> int:
        if c < 0:
            return 0
        if t > self.top[c]:
            return ALL
        k = self.top[c] - t
        bits = self.bits[c]
        return bits[k] if k < len(bits) else 0

    def _add(self, c: int, n: int, top: int, first: list[int]) -> None:
        here, at, codes = bytearray(), self.at, self.codes
        self.bits.append(here)
        self.top.append(top)
        after = ALL
        for t in range(top, -1, -1):
            x = at(c - 1, t) | BEFORE[at(c - INSERT, t)]
            if t == n:
                x |= START | ASSISTANT
            else:
                x |= at(c - DELETE, t + 1)
                code = codes[t]
                if code < GONE:
                    more = TRUNCATED if code & CUT else 0
                    x |= KEPT[code & 3][at(c - more, t + 1) if more else after] | BEFORE[at(c - REROLE - more, t + 1)]
            if not x:
                break
            if first[t] < 0:
                first[t] = c
            here.append(x)
            after = x

    def audit(self) -> str:
        """The least string of edits among the cheapest."""
        at, codes, n = self.at, self.codes, len(self.codes)
        t, c, state, out = 0, self.cost, START, []
        while t < n or c:
            code = codes[t] if t < n else GONE
            more = TRUNCATED if code & CUT else 0
            if t < n and at(c - DELETE, t + 1) & state:
                out.append("D")
                t, c = t + 1, c - DELETE
            elif at(c - INSERT, t) & NEXT[state]:
                out.append("I")
                c, state = c - INSERT, NEXT[state]
            elif code < GONE and at(c - more, t + 1) & KEEP_TO[code & 3][state]:
                out.append("K")
                t, c, state = t + 1, c - more, KEEP_TO[code & 3][state]
            else:
                out.append("R")
                t, c, state = t + 1, c - REROLE - more, NEXT[state]
        return "".join(out)


def cheapest(codes: bytes) -> tuple[int, str]:
    """Cost and audit of a sequence of row codes; a worker remembers what short ones came to."""
    found = _remembered.get(codes)
    if found is None:
        layers = Layers(codes)
        found = layers.cost, layers.audit()
        if len(codes) <= 64:
            if len(_remembered) >= REMEMBERED:
                _remembered.clear()
            _remembered[codes] = found
    return found


class Conversation:
    """Rows of one conversation in order, as they arrive."""

    def __init__(self, conv_id):
        self.conv_id, self.rows, self.codes, self.seen = conv_id, [], bytearray(), set()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turns, self.last, self.least, self.most = 0, None, None, None
        self.initial = None

    def add(self, turn, role: str, text: str) -> None:
        if turn is not None:
            if self.last is None or turn != self.last:
                self.turns += 1
            self.last = self.most = turn
            self.least = turn if self.least is None else self.least
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        said, code = text.rstrip(BLANK), KINDS.get(initial, 3)
        key = hashlib.sha256(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass")).digest()
        if not said:
            self.blank, code = self.blank + 1, GONE
        elif key in self.seen:
            self.duplicate, code = self.duplicate + 1, GONE
        elif said[-1] not in ".!?":
            self.truncated, code = self.truncated + 1, code | CUT
        self.seen.add(key)
        self.codes.append(code)
        self.rows.append((role, text) if code < GONE else None)

    def done(self) -> tuple:
        cost, audit = cheapest(bytes(self.codes))
        out, state, rows = [], START, iter(self.rows)
        for edit in audit:
            row = next(rows) if edit != "I" else None
            if edit == "D":
                continue
            state = NEXT[state] if edit in "IR" else KEEP_TO[KINDS[row[0][:1]]][state]
            out.append(row if edit == "K" else ("user" if state == USER else "assistant", row[1] if row else ""))
        gaps = 0 if self.most is None else self.most - self.least + 1 - self.turns
        return self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit, [{"role": r, "text": x} for r, x in out]


SHAPE = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string()), ("repaired", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))])


def repair(rows: DataFrame) -> DataFrame:
    """One row for each conversation: conv_id, gaps in its turns, rows by their first fault (blank, duplicate, truncated),
    illegal neighbours, cost, audit and the repaired turns as an array of (role, text).

    ``rows``: conv_id, turn, role, text, and ``gone``: rows for which it is true only name their conversation. Nulls in role and text count as one
    blank; a null turn comes first and a null conv_id is a conversation of its own; rows of equal turn are taken by role,
    then text. Without rows the counts are zero and the audit is empty; an empty table gives no rows. Other columns are
    ignored.

    Conversations are streamed in sorted order; a task holds one conversation at a time, as it would one document.
    """
    taken = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), F.coalesce("gone", F.lit(False)).alias("gone"))
    dealt = taken.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ready, size = None, [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*ready), SHAPE)], schema=SHAPE)

        for b in batches:
            for conv, turn, role, text, gone in zip(*(b.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "gone"))):
                if now is None or now.conv_id != conv:
                    if now is not None:
                        ready.append(now.done())
                        if size > 4_000_000 or len(ready) >= 5000:
                            yield batch()
                            ready, size = [], 0
                    now = Conversation(conv)
                if not gone:
                    now.add(turn, role, text)
                    size += len(text)
        if now is not None:
            ready.append(now.done())
            yield batch()

    return dealt.mapInArrow(run, "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired array<struct<role:string,text:string>>")


def damaged(rows: DataFrame) -> DataFrame:
    """Rows as the contract damages them, by the checksum of ``conv_id:turn``; dropped ones stay as ``gone``, without text."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = (F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20).cast("int")
    told = rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    said = F.when(F.col("kind") <= 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return told.select("conv_id", "turn", role.alias("role"), said.alias("text"), (F.col("kind") == 0).alias("gone"), F.explode(times).alias("copy")).drop("copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``conversations``, damaged and repaired."""
    fixed = repair(damaged(table(spark, sf_dir, "conversations")))
    joined = F.array_join(F.transform("repaired", lambda x: F.concat(x["role"], F.lit(":"), x["text"])), "\n")
    return fixed.withColumn("repaired_sha256", F.sha2(joined, 256)).drop("repaired")


def _sql() -> str:
    """The same rows by the plain recurrence from each conversation's last row to its first: per grammar state the least key of cost and audit."""
    put = lambda k, more, edit: f"lpad(CAST(CAST(substr({k}, 1, 9) AS BIGINT) + {more} AS VARCHAR), 9, '0') || '{edit}' || substr({k}, 10)"
    cut = f"CASE WHEN cut THEN {TRUNCATED} ELSE 0 END"

    def step(own: str, next_state: str, kept: dict[str, str]) -> str:
        keep = " ".join(f"WHEN initial = '{c}' THEN {put(to, cut, 'K')}" for c, to in kept.items())
        return f"least({put(own, DELETE, 'D')}, CASE WHEN NOT gone THEN {put(next_state, f'{REROLE} + {cut}', 'R')} END, CASE WHEN gone THEN NULL {keep} END)"

    insert = lambda k: put(k, INSERT, "I")
    return f"""
WITH RECURSIVE tab AS (SELECT list(v ORDER BY i) AS tab FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM (SELECT unnest(range(0, 256)) AS i))),
raw AS (SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS cid, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
hashed AS (SELECT raw.*, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(name) + 1), lambda i: CAST(ord(substr(name, i, 1)) AS BIGINT))), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind FROM raw, tab),
rows AS (SELECT cid, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN replace(replace(replace(text, '.', ''), '!', ''), '?', '') ELSE text END AS text, unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy FROM hashed WHERE kind <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY turn NULLS FIRST, role, text) AS n, substr(role, 1, 1) AS initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said FROM rows),
seen AS (SELECT *, row_number() OVER (PARTITION BY cid, role, text ORDER BY n) > 1 AS again, lag(initial) OVER (PARTITION BY cid ORDER BY n) AS before FROM placed),
coded AS (SELECT cid, n, turn, role, text, initial, said = '' AS blank, said <> '' AND again AS twice, said <> '' AND NOT again AND right(said, 1) NOT IN ('.', '!', '?') AS cut, said = '' OR again AS gone, before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au') AS illegal FROM seen),
counts AS (SELECT cid, max(n) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE twice) AS duplicate, count(*) FILTER (WHERE cut) AS truncated, count(*) FILTER (WHERE illegal) AS illegal FROM coded GROUP BY cid),
best AS (
  SELECT cid, n AS t, '000000000' AS v0, '000000006II' AS vs, '000000003I' AS vu, '000000000' AS va FROM counts
  UNION ALL
  SELECT cid, t, least(b0, {insert("wu")}), least(bs, {insert("wu")}), wu, wa FROM (
    SELECT *, least(bu, {insert("ba")}) AS wu, least(ba, {insert("bu")}) AS wa FROM (
      SELECT x.cid, x.t - 1 AS t, {step("v0", "vu", {"u": "vu", "s": "vs"})} AS b0, {step("vs", "vu", {"u": "vu"})} AS bs, {step("vu", "va", {"a": "va"})} AS bu, {step("va", "vu", {"u": "vu"})} AS ba
      FROM best x JOIN coded r ON r.cid = x.cid AND r.n = x.t
    )
  )
),
told AS (SELECT cid, CAST(substr(v0, 1, 9) AS BIGINT) AS cost, substr(v0, 10) AS audit FROM best WHERE t = 0),
edits AS (SELECT cid, i, substr(audit, i, 1) AS edit FROM (SELECT *, unnest(range(1, length(audit) + 1)) AS i FROM told)),
numbered AS (SELECT *, count(*) FILTER (WHERE edit <> 'I') OVER w AS n, count(*) FILTER (WHERE edit <> 'D') OVER w AS place FROM edits WINDOW w AS (PARTITION BY cid ORDER BY i ROWS UNBOUNDED PRECEDING)),
kept AS (SELECT e.cid, e.i, e.edit, e.place, CASE WHEN e.edit <> 'I' THEN r.role END AS role, CASE WHEN e.edit = 'I' THEN '' ELSE r.text END AS text, max(CASE WHEN e.place = 1 AND e.edit = 'K' AND r.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.cid) AS first FROM numbered e LEFT JOIN coded r ON r.cid = e.cid AND r.n = e.n WHERE e.edit <> 'D'),
fixed AS (SELECT cid, string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - first) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY i) AS repaired FROM kept GROUP BY cid)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT cid, conv_id FROM raw) c LEFT JOIN counts USING (cid) LEFT JOIN told USING (cid) LEFT JOIN fixed USING (cid)
"""


QUERIES = {"op12_conversation_repair": op12_conversation_repair}
ORACLE = {"op12_conversation_repair": _sql()}
