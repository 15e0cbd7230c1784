"""Conversation repair against SQL, against trying all edits, and cut into stretches against whole."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest
from helpers import assert_matches_sql, canonical, duck, spark_rows

from trailweave.llm import conversation_repair as repair
from trailweave.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string, cost string"
QUERY = "op12_conversation_repair"


def every_repair(turns: str, most_inserts: int = 2):
    """(cost, audit) of every sequence of edits, tried one by one."""
    gaps = ["".join(p) for n in range(most_inserts + 1) for p in itertools.product("ua", repeat=n)]
    options = []
    for turn in turns:
        own = [("D", "", 4)]
        if turn != "x":
            more = 3 if turn.isupper() else 0
            own += [("K", turn.lower(), more), ("R", "u", 3 + more), ("R", "a", 3 + more)]
        options.append(own)
    for inserted in itertools.product(gaps, repeat=len(turns) + 1):
        for edits in itertools.product(*options):
            roles = inserted[0] + "".join(e[1] + g for e, g in zip(edits, inserted[1:], strict=True))
            if re.fullmatch("(s?(ua)+)?", roles):
                audit = "I" * len(inserted[0]) + "".join(e[0] + "I" * len(g) for e, g in zip(edits, inserted[1:], strict=True))
                yield sum(e[2] for e in edits) + 3 * audit.count("I"), audit


@pytest.mark.parametrize("turns", ["", "s", "S", "u", "A", "xx", "ou", "sU", "as", "uu", "sua", "uxa", "aua", "Oou", "uss", "AUx"])
def test_cheapest_of_all_edits(turns):
    assert repair.best(repair.search(turns)) == min(every_repair(turns))


def test_cheapest_of_all_edits_at_random():
    r = random.Random(3)
    for _ in range(40):
        turns = "".join(r.choice("suaoxSUAO") for _ in range(r.randrange(1, 5)))
        assert repair.best(repair.search(turns)) == min(every_repair(turns, 1 if len(turns) > 3 else 2)), turns


def test_stretches_join_to_the_whole():
    r = random.Random(4)
    for _ in range(200):
        turns = "".join(r.choice("suaoxSUAO") for _ in range(r.randrange(0, 25)))
        cuts = [0, *sorted(r.randrange(len(turns) + 1) for _ in range(4)), len(turns)]
        parts = [turns[a:b] for a, b in itertools.pairwise(cuts)]
        assert repair.joined([repair.search(p) for p in parts]) == repair.search(turns)


def plain(rows):
    """The contract row by row, in plain Python: rows are (conv_id, turn, role, text)."""
    said = {}
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        own = said.setdefault(conv_id, [])
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            own += [(turn is not None, turn or 0, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for conv_id, own in said.items():
        own.sort()
        turns, seen, counts = "", set(), {"x": 0, "d": 0, "t": 0}
        for _, _, role, text in own:
            words = re.findall(r"[^\x20\x09-\x0D]", text)
            if not words:
                counts["x"], turns = counts["x"] + 1, turns + "x"
            elif (role, text) in seen:
                counts["d"], turns = counts["d"] + 1, turns + "x"
            else:
                cut = words[-1] not in ".!?"
                counts["t"] += cut
                kind = role[:1] if role[:1] in ("s", "u", "a") else "o"
                turns += kind.upper() if cut else kind
            seen.add((role, text))
        # the best way to each state after each row, in order of the rows
        ways = {"": (0, "", [])}
        legal = ["", "s", "su", "sua", "u", "ua", "uau", "suau"]

        def after(state, initial):
            grown = state + initial
            return {"sua": "sua", "suau": "su", "uau": "u"}.get(grown, grown) if grown in legal else None

        def settle(ways):
            again = True
            while again:
                again = False
                for state, (cost, audit, lines) in list(ways.items()):
                    for initial, role in (("u", "user"), ("a", "assistant")):
                        to = after(state, initial)
                        new = (cost + 3, audit + "I", [*lines, f"{role}:"])
                        if to is not None and (to not in ways or new[:2] < ways[to][:2]):
                            ways[to], again = new, True
            return ways

        for kind, (_, _, role, text) in zip(turns, own, strict=True):
            fresh = {}
            for state, (cost, audit, lines) in settle(ways).items():
                options = [("D", state, 4, [])]
                if kind != "x":
                    more = 3 if kind.isupper() else 0
                    options.append(("K", after(state, role[:1]) if role[:1] in ("s", "u", "a") else None, more, [f"{role}:{text}"]))
                    for initial, name in (("u", "user"), ("a", "assistant")):
                        options.append(("R", after(state, initial), 3 + more, [f"{name}:{text}"]))
                for edit, to, price, added in options:
                    new = (cost + price, audit + edit, lines + added)
                    if to is not None and (to not in fresh or new[:2] < fresh[to][:2]):
                        fresh[to] = new
            ways = fresh
        cost, audit, lines = min((w for s, w in settle(ways).items() if s in ("", "ua", "sua")), key=lambda w: w[:2])
        numbers = [t for there, t, *_ in own if there]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        yield conv_id, gaps, counts["x"], counts["d"], counts["t"], illegal, cost, audit, digest


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def random_rows(seed: int, n: int):
    r = random.Random(seed)
    texts = ["Yes.", "no", " ", "", None, "What? ", "a.b", "x\n", "é!", " "]
    return [
        (r.choice([None, 1, 2, 3, 4, 5, -6]), r.choice([None, *range(-2, 9)]),
         r.choice(["user", "user", "assistant", "assistant", "system", "tool", "", None, "User"]), r.choice(texts), "x")
        for _ in range(n)
    ]


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_whole_table_against_sql_and_plainly(spark, sf):
    con = duck(f"/root/testdata/sf{sf}")
    found = queries.QUERIES[QUERY](spark, f"/root/testdata/sf{sf}")
    assert_matches_sql(found, con, queries.ORACLE_SQL[QUERY])
    rows = con.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    assert spark_rows(found) == canonical(COLUMNS, plain(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_odd_rows_against_sql_and_plainly(spark, tmp_path, seed):
    rows = random_rows(seed, 90)
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "conversations"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations/*.parquet'")
    found = repair.damaged_and_repaired(spark.read.parquet(str(tmp_path / "conversations")))
    assert_matches_sql(found, con, queries.ORACLE_SQL[QUERY])
    assert spark_rows(found) == canonical(COLUMNS, plain([r[:4] for r in rows]))


def test_no_rows_and_rows_that_all_go(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.damaged_and_repaired(empty).collect() == []
    gone = next(n for n in range(1000) if zlib.crc32(f"{n}:0".encode()) % 20 == 0)
    row = repair.damaged_and_repaired(spark.createDataFrame([(gone, 0, "user", "Hi.", "")], SCHEMA)).first()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_a_conversation_of_many_stretches(spark, monkeypatch):
    """Long by turn numbers, by turns without a number and by repeated rows: cut, joined and hashed as one."""
    r = random.Random(7)
    roles = ["user", "assistant", "system", "tool"]
    rows = [(1, t * 30, r.choice(roles), r.choice(["Yes.", "no", f"text {t}.", f"open {t}"]), "") for t in range(3000)]
    rows += [(2, None, r.choice(roles), f"said {t}.", "") for t in range(700)]
    rows += [(3, 5, "user", "Again.", "")] * 600 + [(3, 6, "assistant", "Fine.", "")] + [(None, 1, "user", "Hi.", "")]
    rows += [(4, t, r.choice(roles), f"{t}.", "") for t in range(300)]
    monkeypatch.setattr(repair, "FAN", 8)
    found = repair.damaged_and_repaired(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert spark_rows(found) == canonical(COLUMNS, plain([r[:4] for r in rows]))


def test_repaired_turns_are_what_is_hashed(spark):
    rows = repair.damaged(spark.createDataFrame(random_rows(5, 60), SCHEMA))
    digests = {r.conv_id: r.repaired_sha256 for r in repair.repairs(rows).collect()}
    lines = {c: [] for c in digests}
    for r in sorted(repair.repaired_turns(rows).collect(), key=lambda r: r.place):
        lines[r.conv_id].append(f"{r.role}:{r.text}")
    assert {c: hashlib.sha256("\n".join(own).encode()).hexdigest() for c, own in lines.items()} == digests
