"""Conversation structure repair with Four-Russians block tables.

A conversation should read ``(s?(ua)+)?`` in its roles' initials. The cheapest edits towards that
are a path through four states (nothing yet, after the system turn, after a user turn, after an
assistant turn). Seen from a place in the conversation, what is left to pay from each state is a
vector of four costs that differ by a few units only, so after its minimum is taken off there are
few different vectors. The table holds, for each of them and each block of four row symbols, the
vector before the block and what was taken off. A conversation is then costed from its end in
blocks, one lookup each. The edits are read from its beginning: each block is expanded backward
from the vector behind it, and the least letter that stays on a cheapest path is taken, so ties
go to the least text. Expansions are kept by (block, vector behind, state before).

Edits: K keeps a row, R gives it the role user or assistant, D deletes it, I inserts an empty
user or assistant turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import crc32_sql, stored

BLOCK = 4          # rows of a block
RUN = 12           # rows are gathered in runs of 2^RUN
INSERT, REROLE, DELETE, CUT = 2, 2, 3, 1   # costs; CUT is added for a truncated row that stays
BLANKS = " \t\n\x0b\x0c\r"
STOPS = ".!?"

# A row's symbol: a letter for its role's initial (s, u, a or another) and its fault (none, blank, duplicate, truncated).
SYMBOLS = "ABCDEFGHIJKLMNOP"
INITIALS = "sua"
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
# For the costs: 0 must go, 1 + 2 * initial + truncated can stay, 9 is no row at all.
_DIGITS = str.maketrans(SYMBOLS, "".join("0" if f in (BLANK, DUPLICATE) else str(1 + 2 * i + (f == TRUNCATED)) for i in range(4) for f in range(4)))
_NO_ROW = 9

START, SYSTEM, USER, ASSISTANT = range(4)
_KEPT = [{START: SYSTEM}, {START: USER, SYSTEM: USER, ASSISTANT: USER}, {USER: ASSISTANT}, {}]   # initial -> state -> next
_GIVEN = [USER, USER, ASSISTANT, USER]                                                          # next after a given role
_END = (0, 2 * INSERT, INSERT, 0)


def _choices(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits that use up a row."""
    out = [("D", DELETE, state)]
    if symbol:
        initial, cut = divmod(symbol - 1, 2)
        if state in _KEPT[initial]:
            out.append(("K", CUT * cut, _KEPT[initial][state]))
        out.append(("R", REROLE + CUT * cut, _GIVEN[state]))
    return out


def _before(symbol: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs left before a row, given those after it; turns may be inserted first."""
    if symbol == _NO_ROW:
        return after
    costs = [min(c + after[to] for _, c, to in _choices(symbol, q)) for q in range(4)]
    for _ in range(3):
        costs = [min(c, INSERT + costs[_GIVEN[q]]) for q, c in enumerate(costs)]
    return tuple(costs)


class Tables:
    """All normalised vectors, and for (vector behind, block) the vector before it and the cost taken off."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        self.vectors = [_END]
        ids, steps, taken = {_END: 0}, [], []
        while len(steps) < len(self.vectors):
            here, off = [], []
            for symbol in range(10):
                v = _before(symbol, self.vectors[len(steps)])
                low = min(v)
                v = tuple(c - low for c in v)
                if v not in ids:
                    ids[v] = len(self.vectors)
                    self.vectors.append(v)
                here.append(ids[v])
                off.append(low)
            steps.append(here)
            taken.append(off)
        one, cost = np.array(steps), np.array(taken)
        to, add = one, cost
        for _ in range(block - 1):   # one more row in front of every block
            to, add = (np.stack([one[to, s] for s in range(10)], axis=1).reshape(len(one), -1),
                       np.stack([add + cost[to, s] for s in range(10)], axis=1).reshape(len(one), -1))
        self.to, self.add = to.tolist(), add.tolist()
        self.kept: dict[tuple[str, int, int], tuple[str, int]] = {}

    def expand(self, block: str, behind: int, state: int) -> tuple[str, int]:
        """The least letters through a block on a cheapest path, and the state after it."""
        key = (block, behind, state)
        if key not in self.kept:
            rows = [int(d) for d in block]
            costs = [self.vectors[behind]]
            for symbol in reversed(rows):
                costs.append(_before(symbol, costs[-1]))
            costs.reverse()
            letters = []
            for at, symbol in enumerate(rows):
                while symbol != _NO_ROW:
                    left = costs[at][state]
                    fits = [(x, to, True) for x, c, to in _choices(symbol, state) if c + costs[at + 1][to] == left]
                    if INSERT + costs[at][_GIVEN[state]] == left:
                        fits.append(("I", _GIVEN[state], False))
                    letter, state, used = min(fits)
                    letters.append(letter)
                    if used:
                        break
            self.kept[key] = ("".join(letters), state)
        return self.kept[key]

    def repair(self, symbols: str) -> tuple[int, str]:
        """(cost, edits) of a conversation's symbols."""
        digits = symbols.translate(_DIGITS)
        digits = str(_NO_ROW) * (-len(digits) % self.block) + digits
        blocks = [digits[i:i + self.block] for i in range(0, len(digits), self.block)]
        behind, cost = [0], 0
        for b in reversed(blocks):
            code, v = int(b), behind[-1]
            cost += self.add[v][code]
            behind.append(self.to[v][code])
        cost += self.vectors[behind.pop()][START]
        letters, state = [], START
        for b, v in zip(blocks, reversed(behind)):
            part, state = self.expand(b, v, state)
            letters.append(part)
        letters.append("I" * (_END[state] // INSERT))
        return cost, "".join(letters)


@cache
def tables() -> Tables:
    return Tables()


def split_edits(edits: str, sizes: list[int]) -> list[str]:
    """The edits cut behind the last row of each run; inserted turns go before the row they precede, or to the last run."""
    uses = np.flatnonzero(np.frombuffer(edits.encode(), dtype=np.uint8) != ord("I")) + 1
    cuts = [0, *[int(uses[n - 1]) if n else 0 for n in np.cumsum(sizes)[:-1]], len(edits)]
    return [edits[a:b] for a, b in zip(cuts, cuts[1:])]


def illegal_pairs(symbols: str) -> int:
    """Neighbouring rows whose initials are none of su, ua, au."""
    kinds = np.frombuffer(symbols.encode(), dtype=np.uint8).astype(int) - ord(SYMBOLS[0])
    pair = kinds[:-1] // 4 * 4 + kinds[1:] // 4
    return int((~np.isin(pair, [0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 1])).sum())


_AUDIT = "struct<blank: bigint, duplicate: bigint, truncated: bigint, illegal: bigint, cost: bigint, audit: string, edits: array<string>>"


def _audit(runs: pd.Series) -> pd.DataFrame:
    out = []
    for parts in runs:
        symbols = "".join(parts)
        cost, edits = tables().repair(symbols)
        faults = np.bincount((np.frombuffer(symbols.encode(), dtype=np.uint8) - ord(SYMBOLS[0])) % 4, minlength=4)
        out.append((*faults[1:].tolist(), illegal_pairs(symbols), cost, edits, split_edits(edits, [len(p) for p in parts])))
    return pd.DataFrame(out, columns=["blank", "duplicate", "truncated", "illegal", "cost", "audit", "edits"])


def _same(cols: list[str], prefix: str) -> Column:
    return reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(prefix + c)) for c in cols])


class Repair:
    """The audit of every conversation, and its repaired turns.

    ``turns`` has conv_id, turn, role and text, and may have ``copies``, a column that says how
    often a row stands there (0: not at all, but its conversation is still reported). NULL
    roles and texts are one space; a NULL conv_id is one conversation. Rows go by turn (NULL
    first), those of one turn by role, then by the text's MD5. A row whose role and text an
    earlier one has is a duplicate, also if that one was blank or goes. Only the first
    character of a role counts; a role without one cannot stay. Other columns are not read; an empty table
    gives no rows.

    Equal rows are counted before they are shuffled, rows without their texts are dealt by
    ranges of (conv_id, turn, ...), so that a conversation of any size is spread, and gathered
    as one letter each, so a task holds about as much of a conversation as its audit is long.
    Texts are shuffled once, and stream through a task in order.
    """

    def __init__(self, turns: DataFrame, copies: str | None = None):
        text = F.coalesce("text", F.lit(" "))
        self.rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"),
                                 F.unhex(F.md5(text)).alias("h"), (F.col(copies) if copies else F.lit(1)).cast("bigint").alias("n"))
        key = ["conv_id", "turn", "role", "h"]
        said = F.rtrim("text", F.lit(BLANKS))
        light = stored(self.rows.select(*key, "n", said.alias("said")).select(
            *key, "n", (F.col("said") == "").alias("blank"), (~F.right("said", F.lit(1)).isin(*STOPS)).alias("cut"))
            .groupBy(*key).agg(F.sum("n").alias("n"), F.min("blank").alias("blank"), F.min("cut").alias("cut")), "turns", compression="zstd")
        firsts = (light.where("n > 0").groupBy("conv_id", "role", "h")
                  .agg(F.min(F.struct(F.col("turn").isNotNull().alias("k"), "turn")).alias("t"))
                  .select(F.col("conv_id").alias("f_conv_id"), F.col("t.turn").alias("f_turn"), F.col("role").alias("f_role"),
                          F.col("h").alias("f_h"), F.lit(True).alias("first")))
        initial = F.instr(F.lit(INITIALS), F.substring("role", 1, 1)) - 1
        initial = F.when((F.col("role") != "") & (initial >= 0), initial).otherwise(len(INITIALS))

        def letter(fault: Column) -> Column:
            return F.substr(F.lit(SYMBOLS), initial * 4 + fault + 1, F.lit(1))
        head = F.when(F.col("blank"), BLANK).when(F.col("first").isNull(), DUPLICATE).when(F.col("cut"), TRUNCATED).otherwise(NONE)
        rest = F.when(F.col("blank"), BLANK).otherwise(DUPLICATE)
        marked = light.join(firsts, _same(key, "f_"), "left").select(
            *key, F.when(F.col("n") > 0, F.concat(letter(head), F.repeat(letter(rest), (F.col("n") - 1).cast("int"))))
            .otherwise("").alias("letters"))
        placed = stored(marked.repartitionByRange(*key).sortWithinPartitions(*key).withColumn("seq", F.monotonically_increasing_id()),
                        "letters", compression="zstd")
        runs = (placed.groupBy("conv_id", F.shiftright("seq", RUN).alias("run"))
                .agg(F.sort_array(F.collect_list(F.struct("seq", "letters", "turn", "role", "h"))).alias("rows"))
                .select("conv_id", "run", F.array_join("rows.letters", "").alias("letters"), F.col("rows")[0].alias("at")))
        whole = (runs.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("run", "letters", "at"))).alias("runs")))
        spans = (light.where("n > 0").groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy(F.col("conv_id").alias("g_conv_id"))
                 .agg((F.max("turn").cast("decimal(38,0)") - F.min("turn") + 1 - F.count("turn")).try_cast("bigint").alias("gaps")))
        #: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, runs (edits and the first row's key of each run)
        audited = whole.withColumn("a", F.pandas_udf(_audit, _AUDIT)(F.col("runs.letters")))
        audited = (audited.join(spans, _same(["conv_id"], "g_"), "left")
                   .select("conv_id", F.coalesce("gaps", F.lit(0)).cast("bigint").alias("gaps"), "a.*", F.col("runs.at").alias("at")))
        self.audits = stored(audited, "audits", compression="zstd")

    def turns(self) -> DataFrame:
        """(conv_id, at, role, text): the repaired conversations; their rows are together and in order."""
        kind = self.rows.schema["conv_id"].dataType
        edits = (self.audits.select("conv_id", F.explode(F.arrays_zip("edits", "at")).alias("e"))
                 .select("conv_id", "e.at.turn", "e.at.role", "e.at.h", F.lit(0).alias("kind"), F.col("e.edits").alias("text"), F.lit(0).cast("bigint").alias("n")))
        rows = self.rows.where("n > 0").select("conv_id", "turn", "role", "h", F.lit(1).alias("kind"), "text", "n")
        order = ["conv_id", "turn", "role", "h", "kind"]
        stream = (edits.union(rows).repartition("conv_id").sortWithinPartitions(*order)
                  .select(F.col("conv_id").cast("string"), "kind", "role", "text", "n"))  # pandas would turn ids beside a NULL into floats

        def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            conv, edits, place, state, at = None, "", 0, START, 0
            out: list[tuple] = []

            def given() -> None:
                nonlocal place, state, at
                while place < len(edits) and edits[place] == "I":
                    state = _GIVEN[state]
                    out.append((conv, at, "user" if state == USER else "assistant", ""))
                    place, at = place + 1, at + 1
            begun = False
            for batch in batches:
                for c, kind, role, text, n in zip(batch["conv_id"], batch["kind"], batch["role"], batch["text"], batch["n"]):
                    if kind == 0:
                        given()   # turns inserted at the end of the run before
                        if not begun or c != conv:
                            conv, state, at, begun = c, START, 0, True
                        edits, place = text, 0
                        continue
                    for _ in range(n):
                        given()
                        letter, place = edits[place], place + 1
                        if letter == "D":
                            continue
                        if letter == "R":
                            state = _GIVEN[state]
                            role = "user" if state == USER else "assistant"
                        else:
                            state = _KEPT[INITIALS.index(role[0])][state]
                        out.append((conv, at, role, text))
                        at += 1
                if out:
                    yield pd.DataFrame(out, columns=["conv_id", "at", "role", "text"])
                    out.clear()
            given()
            if out:
                yield pd.DataFrame(out, columns=["conv_id", "at", "role", "text"])
        return (stream.mapInPandas(apply, "conv_id string, at bigint, role string, text string")
                .select(F.col("conv_id").cast(kind).alias("conv_id"), "at", "role", "text"))

    def digests(self) -> DataFrame:
        """Per conversation its audit and the SHA-256 of its repaired ``role:text`` lines.

        The hash of a conversation can only be taken in order: it streams through one task.
        """
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            conv, said = None, None
            for batch in batches:
                done = []
                for c, at, role, text in zip(batch["conv_id"], batch["at"], batch["role"], batch["text"]):
                    if at == 0:
                        if said:
                            done.append((conv, said.hexdigest()))
                        conv, said = c, hashlib.sha256()
                    else:
                        said.update(b"\n")
                    said.update(f"{role}:{text}".encode())
                if done:
                    yield pd.DataFrame(done, columns=["c", "repaired_sha256"])
            if said:
                yield pd.DataFrame([(conv, said.hexdigest())], columns=["c", "repaired_sha256"])
        kind = self.rows.schema["conv_id"].dataType
        hashed = (self.turns().withColumn("conv_id", F.col("conv_id").cast("string")).mapInPandas(run, "c string, repaired_sha256 string")
                  .withColumn("c", F.col("c").cast(kind)))
        return (self.audits.join(hashed, self.audits["conv_id"].eqNullSafe(hashed["c"]), "left")
                .select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: rows damaged by the CRC-32 of ``conv_id:turn`` modulo 20 (NULLs: one space).

    0 drops a row, 1 empties its text, 2 takes its stops out, 3 repeats it, 4 makes it a user's.
    """
    def said(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    return (turns.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), code.alias("code"))
            .select("conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text", f"[{STOPS}]", ""))
                    .otherwise(F.col("text")).alias("text"),
                    F.when(F.col("code") == 0, 0).when(F.col("code") == 3, 2).otherwise(1).alias("copies")))


def oracle(table: str = "conversations") -> str:
    """DuckDB SQL for the audit and digests of the damaged ``table``: a plain search row by row over the four states."""
    blanks = " || ".join(f"chr({ord(b)})" for b in BLANKS)
    stops = ", ".join(f"'{c}'" for c in STOPS)
    ops = [f"({i}, {q}, '{x}', {c}, {to})" for i in range(4) for q in range(4) for x, c, to in _choices(1 + 2 * i, q)]
    inserts = [f"({q}, {k}, {to})" for q in range(4) for k, to in enumerate((q, _GIVEN[q], _GIVEN[_GIVEN[q]]))]
    ends = [f"({q}, {_END[q] // INSERT})" for q in range(4)]
    role = "CASE WHEN {q} = 2 THEN 'user' ELSE 'assistant' END"
    return f"""
WITH RECURSIVE given AS (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS s,
                                dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS conv FROM {table}),
keys AS (SELECT DISTINCT s FROM given),{crc32_sql('crc', 'keys')},
hurt AS (
  SELECT conv, turn, CASE WHEN crc % 20 = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
         CASE crc % 20 WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[{STOPS}]', '', 'g') ELSE coalesce(text, ' ') END AS text, crc % 20 AS code
  FROM given JOIN crc USING (s) WHERE crc % 20 <> 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, md5(text)) AS i,
         CASE WHEN role = '' THEN 3 ELSE (instr('{INITIALS}', substr(role, 1, 1)) + 3) % 4 END AS initial, rtrim(text, {blanks}) AS said
  FROM (SELECT * FROM hurt UNION ALL SELECT * FROM hurt WHERE code = 3)),
faults AS (
  SELECT *, CASE WHEN said = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 THEN 2
                 WHEN right(said, 1) NOT IN ({stops}) THEN 3 ELSE 0 END AS fault,
         lead(initial) OVER (PARTITION BY conv ORDER BY i) AS next_initial
  FROM ranked),
ops(initial, q, op, cost, q2) AS (VALUES {', '.join(ops)}),
ins(q, k, q2) AS (VALUES {', '.join(inserts)}),
ends(q, k) AS (VALUES {', '.join(ends)}),
paths(conv, i, q, cost, audit, said) AS (
  SELECT DISTINCT conv, CAST(0 AS BIGINT), 0, 0, '', '' FROM given
  UNION ALL
  SELECT conv, i, q, cost, audit, said FROM (
    SELECT f.conv, f.i, o.q2 AS q, p.cost + {INSERT} * n.k + o.cost + CASE WHEN f.fault = 3 AND o.op <> 'D' THEN {CUT} ELSE 0 END AS cost,
           p.audit || repeat('I', n.k) || o.op AS audit,
           p.said || CASE WHEN n.k > 0 THEN chr(10) || {role.format(q='(SELECT q2 FROM ins z WHERE z.q = p.q AND z.k = 1)')} || ':' ELSE '' END
                  || CASE WHEN n.k > 1 THEN chr(10) || {role.format(q='n.q2')} || ':' ELSE '' END
                  || CASE o.op WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || f.role || ':' || f.text
                     ELSE chr(10) || {role.format(q='o.q2')} || ':' || f.text END AS said,
           row_number() OVER (PARTITION BY f.conv, o.q2 ORDER BY p.cost + {INSERT} * n.k + o.cost + CASE WHEN f.fault = 3 AND o.op <> 'D' THEN {CUT} ELSE 0 END,
                              p.audit || repeat('I', n.k) || o.op) AS best
    FROM paths p JOIN faults f ON f.conv = p.conv AND f.i = p.i + 1 JOIN ins n ON n.q = p.q
    JOIN ops o ON o.initial = f.initial AND o.q = n.q2 AND (f.fault NOT IN (1, 2) OR o.op = 'D')) WHERE best = 1),
done AS (
  SELECT conv, cost + {INSERT} * e.k AS cost, audit || repeat('I', e.k) AS audit,
         said || CASE WHEN p.q = 1 THEN chr(10) || 'user:' ELSE '' END || CASE WHEN e.k > 0 THEN chr(10) || 'assistant:' ELSE '' END AS said
  FROM paths p JOIN ends e ON e.q = p.q
  WHERE i = coalesce((SELECT max(i) FROM faults f WHERE f.conv = p.conv), 0)
  QUALIFY row_number() OVER (PARTITION BY conv ORDER BY cost + {INSERT} * e.k, audit || repeat('I', e.k)) = 1),
counts AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 1) AS blank, count(*) FILTER (WHERE fault = 2) AS duplicate, count(*) FILTER (WHERE fault = 3) AS truncated,
         count(*) FILTER (WHERE next_initial IS NOT NULL AND (initial, next_initial) NOT IN ((0, 1), (1, 2), (2, 1))) AS illegal
  FROM faults GROUP BY conv)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, cost, audit, sha256(substr(said, 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv, conv_id FROM given) JOIN done USING (conv) LEFT JOIN counts USING (conv)"""
