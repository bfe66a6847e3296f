"""Repairs of conversations against a search through all edits."""

from __future__ import annotations

import functools
import hashlib
import itertools
import random
import re
import zlib

import pytest

from basketry.llm import queries, structure

VISIBLE = re.compile(r"[^\x20\x09-\x0D]")


def plain_damage(rows):
    """(conv, turn, role, text) after damage, each row as often as it then occurs."""
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def options(state, mark, must, cut):
    """(letter, cost, state after, role or None) of the edits of a row."""
    follow = {0: "su", 1: "u", 2: "a", 3: "u"}[state]
    after = {"s": 1, "u": 2, "a": 3}
    yield "D", 4, state, None
    if not must:
        if mark in tuple(follow):
            yield "K", cut, after[mark], "own"
        for name in ("user", "assistant"):
            if name[0] in follow:
                yield "R", 3 + cut, after[name[0]], name


def cheapest(marks):
    """(cost, audit, roles of what stays) by recursion over rows and states."""

    @functools.cache
    def go(at, state, inserted):
        found = []
        if at == len(marks) and state in (0, 3):
            found.append((0, "", ()))
        if at < len(marks):
            for letter, cost, after, role in options(state, *marks[at]):
                rest = go(at + 1, after, 0)
                if rest:
                    kept = ((at, role),) if role else ()
                    found.append((cost + rest[0], letter + rest[1], kept + rest[2]))
        if inserted < 3:
            for name in ("user", "assistant"):
                if name[0] in {0: "u", 1: "u", 2: "a", 3: "u"}[state]:
                    rest = go(at, 2 if name == "user" else 3, inserted + 1)
                    if rest:
                        found.append((3 + rest[0], "I" + rest[1], ((None, name),) + rest[2]))
        return min(found, key=lambda x: x[:2]) if found else None

    return go(0, 0, 0)


def plainly(rows):
    """The digest of one conversation's rows after damage."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3].encode()))
    seen, marks, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    for _, _, role, text in rows:
        shown = VISIBLE.findall(text)
        blank, again = not shown, (role, text) in seen
        cut = not blank and not again and shown[-1] not in ".!?"
        fault = "blank" if blank else "duplicate" if again else "truncated" if cut else None
        if fault:
            counts[fault] += 1
        marks.append((role[:1], blank or again, 3 if cut else 0))
        seen.add((role, text))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[2][:1] + b[2][:1] for a, b in itertools.pairwise(rows)]
    cost, audit, kept = cheapest(tuple(marks))
    lines = [
        f"{name}:" if at is None else f"{rows[at][2] if name == 'own' else name}:{rows[at][3]}"
        for at, name in kept
    ]
    return (
        gaps,
        *counts.values(),
        sum(pair not in ("su", "ua", "au") for pair in pairs),
        cost,
        audit,
        hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def expected(rows):
    by_conv = {row[0]: [] for row in rows}
    for row in plain_damage(rows):
        by_conv[row[0]].append(row)
    return {conv: plainly(some) for conv, some in by_conv.items()}


def found(df):
    rows = df.collect()
    assert len({row["conv_id"] for row in rows}) == len(rows)
    return {row["conv_id"]: tuple(row[c] for c in COLUMNS) for row in rows}


def made(dice, convs):
    texts = ["Yes.", "No!", "cut", " ", "", None, "a\nb?", "x.", "y", "É.", "tab\t", "end. \n"]
    roles = ["user", "assistant", "system", "tool", None, "", "User", "support"]
    weights = [8, 8, 3, 1, 1, 1, 1, 1]
    return [
        (conv, dice.choice([k, k, k, None, 2]), dice.choices(roles, weights)[0], dice.choice(texts))
        for conv in convs
        for k in range(dice.randint(1, 9))
    ]


SCHEMA = "conv_id long, turn long, role string, text string"


def test_repairs_match_a_search_of_all_edits(spark):
    rows = made(random.Random(12), [None, *range(400)])
    turns = spark.createDataFrame(rows, SCHEMA).repartition(7)
    got = found(structure.digests(structure.damaged(turns), turns, "copies"))
    want = expected(rows)
    assert got.keys() == want.keys()
    for conv in want:
        assert got[conv] == want[conv], conv


def test_runs_and_ranges_do_not_show(spark, monkeypatch):
    monkeypatch.setattr(structure, "RUN", 3)
    dice = random.Random(5)
    rows = made(dice, range(30))
    rows += [(7, None, "user", "Same."), (7, None, "user", "Same.")] * 20
    rows += [(-1, k, dice.choice(["user", "assistant"]), f"{k // 3}.") for k in range(300)]
    turns = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(structure.digests(structure.damaged(turns), turns, "copies")) == expected(rows)


def test_automaton_makes_each_node_once():
    dice = random.Random(3)
    reverse = sorted({"".join(dice.choices("suaoSUAOx", k=dice.randint(0, 7))) for _ in range(3000)})
    automaton = structure.Automaton()
    for one in reverse:
        automaton.read(one)
        marks = tuple((c.lower(), c == "x", 3 if c.isupper() else 0) for c in one[::-1])
        assert automaton.best() == cheapest(marks)[:2]
    assert automaton.made == len({one[:k] for one in reverse for k in range(1, len(one) + 1)})


def test_repaired_turns_follow_the_grammar(spark):
    rows = made(random.Random(8), range(60))
    done = structure.repairs(structure.damaged(spark.createDataFrame(rows, SCHEMA)), "copies")
    runs = sorted(done.turns.collect(), key=lambda r: (r["conv_id"], r["seq"]))
    by_conv = {}
    for run in runs:
        by_conv.setdefault(run["conv_id"], []).extend(t["role"][:1] for t in run["turns"])
    assert by_conv
    for initials in by_conv.values():
        assert re.fullmatch("(s?(ua)+)?", "".join(initials))


def test_long_text_and_other_columns(spark):
    rows = [(1, 1, "user", "x" * 3_000_000 + "."), (1, 2, "assistant", "ok.")]
    rows += [(1, k, "user", f"{'y' * 400_000}{k}.") for k in range(3, 9)]
    turns = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as seq", "2 as audit")
    assert found(structure.digests(structure.damaged(turns), turns, "copies")) == expected(rows)
    empty = structure.digests(structure.damaged(turns.limit(0)), turns.limit(0), "copies")
    assert empty.collect() == [] and empty.columns == ["conv_id", *COLUMNS]


def test_clashing_column_is_not_read(spark):
    rows = [(1, 1, "user", "a."), (1, 2, "assistant", "b.")]
    turns = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "5 as copies")
    assert structure.digests(turns).collect()[0]["audit"] == "KK"


def test_extreme_turns(spark):
    rows = [(1, -(1 << 63), "user", "a."), (1, (1 << 63) - 1, "assistant", "b.")]
    turns = spark.createDataFrame(rows, SCHEMA)
    assert structure.digests(turns).collect()[0]["gaps"] == structure.LARGEST


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_matches_on_the_given_table(spark, sf):
    folder = f"/root/testdata/{sf}"
    rows = spark.read.parquet(f"{folder}/conversations.parquet")
    rows = [tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.QUERIES["op12_structure_repair"](spark, folder)) == expected(rows)
