import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import SF

from tidewater.llm import conversation_repair as R
from tidewater.llm import queries as Q

GOOD = re.compile("(s?(ua)+)?")
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def exhaustive(rows):
    """Cheapest and least edits of (initial, fault) rows by trying every edit sequence with few inserts."""
    best = None
    per_row = [[("D", 3, "")] + ([] if f in (1, 2) else
               [("K", f == 3, i), ("R", 2 + (f == 3), "u"), ("R", 2 + (f == 3), "a")]) for i, f in rows]
    inserts = [[("I", 2, x) for x in p] for n in range(3) for p in itertools.product("ua", repeat=n)]
    for ops in itertools.product(*per_row):
        for gaps in itertools.product(inserts, repeat=len(rows) + 1):
            seq = [e for g, o in zip(gaps, ops) for e in [*g, o]] + list(gaps[-1])
            if GOOD.fullmatch("".join(e[2] for e in seq)):
                cand = (sum(e[1] for e in seq), "".join(e[0] for e in seq))
                best = min(best, cand) if best else cand
    return best


def plain(rows):
    """The same by a search row by row, with the repaired roles: (cost, edits, initials)."""
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    force = {"": "u", "s": "u", "u": "a", "a": "u"}

    def grow(front):
        for _ in range(3):
            for q, (c, e, r) in list(front.items()):
                n = (c + 2, e + "I", r + force[q])
                if force[q] not in front or n < front[force[q]]:
                    front[force[q]] = n
        return front
    front = grow({"": (0, "", "")})
    for i, f in rows:
        new = {}
        for q, (c, e, r) in front.items():
            out = [(q, (c + 3, e + "D", r))]
            if f not in (1, 2):
                out.append((force[q], (c + 2 + (f == 3), e + "R", r + force[q])))
                if i in step[q]:
                    out.append((i, (c + (f == 3), e + "K", r + i)))
            for q2, n in out:
                if q2 not in new or n < new[q2]:
                    new[q2] = n
        front = grow(new)
    return min(front[q] for q in ("", "a") if q in front)


def code(rows):
    return "".join(R.SYMBOLS["suax".index(i) * 4 + f] for i, f in rows)


ROW = st.tuples(st.sampled_from("suax"), st.sampled_from([0, 0, 0, 1, 2, 3]))


@settings(max_examples=40, deadline=None)
@given(st.lists(ROW, max_size=2))
def test_plain_search_matches_every_edit_sequence(rows):
    assert plain(rows)[:2] == exhaustive(rows)


@settings(max_examples=400, deadline=None)
@given(st.lists(ROW, max_size=40), st.integers(1, 4))
def test_block_tables_match_plain_search(rows, block):
    tables = TABLES.setdefault(block, R.Tables(block))
    cost, edits = tables.repair(code(rows))
    assert (cost, edits) == plain(rows)[:2]
    cuts = sorted(random.Random(len(rows)).choices(range(len(rows) + 1), k=2))
    sizes = [b - a for a, b in zip([0, *cuts], [*cuts, len(rows)])]
    parts = R.split_edits(edits, sizes)
    assert "".join(parts) == edits and [len(p.replace("I", "")) for p in parts] == sizes


TABLES: dict = {}


def test_few_vectors():
    assert len(R.tables().vectors) < 60 and len(R.tables().to[0]) == 10 ** R.BLOCK


def hurt(rows):
    out = []
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if k:
            x = "" if k == 1 else re.sub("[.!?]", "", x) if k == 2 else x
            out += [(c, t, "user" if k == 4 else r, x)] * (2 if k == 3 else 1)
    return out


def brute(rows, convs):
    out = []
    for conv in convs:
        mine = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).digest()))
        seen, marks = set(), []
        for _, role, text in mine:
            i = role[:1] if role[:1] in ("s", "u", "a") else "x"
            said = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            f = 1 if not said else 2 if (role, text) in seen else 3 if said[-1] not in ".!?" else 0
            seen.add((role, text))
            marks.append((i, f))
        cost, edits, initials = plain(marks)
        lines, row, place = [], iter(mine), 0
        for e in edits:
            if e != "I":
                _, role, text = next(row)
            if e == "D":
                continue
            role = {"u": "user", "a": "assistant"}[initials[place]] if e in "IR" else role
            lines.append(f"{role}:{'' if e == 'I' else text}")
            place += 1
        turns = [r[0] for r in mine if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults = [f for _, f in marks]
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marks, marks[1:]))
        out.append((conv, gaps, faults.count(1), faults.count(2), faults.count(3), illegal, cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def some_rows():
    rng = random.Random(4)
    texts = ["Fine.", "Yes!", "cut off", "", " \n\t ", "Again?  \n", None, "é日. no", "dots. in. it."]
    roles = ["user", "assistant", "system", "tool", None, "", "User", "umpire"]
    rows = [(c, t, rng.choice(roles[:2] if rng.random() < .7 else roles), rng.choice(texts) if rng.random() < .5 else f"Text {rng.randrange(99)}.")
            for c in range(60) for t in range(rng.randrange(1, 9))]
    rows += [(None, t, rng.choice(roles), "No id.") for t in (None, 0, 0, 5)]
    rows += [(-3, None, "user", "Null turn."), (-3, None, "user", "Null turn."), (-4, 2**62, "user", "Far."), (-4, -2**62, "assistant", "Off.")]
    rows += [(-5, t, ("user", "assistant")[t % 2], f"Long talk {t % 50}" + "." * (t % 3 > 0)) for t in range(700)]
    rows += [(-6, 0, "user", "One text that fills the table.")] * 500
    rows += [(-7, 0, "assistant", "w " * 200000 + "."), (-8, 1, "system", "Only.")]
    rows += [(90 + c, 0, "user", "x.") for c in range(60)]   # some of them lose their only row
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("run", [2, 12])
def test_repair_matches_brute_force(spark, monkeypatch, run):
    monkeypatch.setattr(R, "RUN", run)
    rows = some_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).selectExpr("*", "1 AS n", "2 AS h", "3 AS code", "4 AS copies")
    got = sorted((tuple(r) for r in R.Repair(R.damaged(df), "copies").digests().collect()), key=str)
    assert got == brute(hurt(rows), {r[0] for r in rows})
    assert any(r[7] == "" for r in got)


def test_undamaged_turns_and_repaired_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Yes"), (1, 3, "user", "So?"), (2, 0, "tool", "?")]
    made = R.Repair(spark.createDataFrame(rows, SCHEMA))
    assert sorted((r["conv_id"], r["cost"], r["audit"]) for r in made.audits.collect()) == [(1, 6, "KDKKI"), (2, 3, "D")]
    assert [tuple(r) for r in made.turns().collect()] == [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes"), (1, 2, "user", "So?"), (1, 3, "assistant", "")]
    assert R.Repair(spark.createDataFrame([], SCHEMA)).digests().collect() == []


def test_query_and_sql_match_brute_force(spark, tmp_path):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = brute(hurt(rows), {r[0] for r in rows})
    assert sorted((tuple(r) for r in Q.op13_conversation_repair(spark, SF).collect()), key=str) == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    assert sorted(con.execute(R.oracle()).fetchall(), key=str) == want
    odd = [r for r in some_rows() if r[0] not in (-7, -6, -5, -4)]   # and on odd rows
    spark.createDataFrame(odd, SCHEMA).write.parquet(str(tmp_path / "odd"))
    con.execute(f"CREATE VIEW odd AS SELECT * FROM '{tmp_path}/odd/*.parquet'")
    assert sorted(con.execute(R.oracle("odd")).fetchall(), key=str) == brute(hurt(odd), {r[0] for r in odd})
