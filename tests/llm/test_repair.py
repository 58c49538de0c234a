import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from transit_prices.llm import repair
from transit_prices.llm.queries import op11_repair

WORD = re.compile(r"[^\x20\x09-\x0D]")
PATTERN = re.compile(r"(s?(ua)+)?\Z")
SCHEMA = "conv_id long, turn long, role string, text string, key string, part int, gone string, seq string"


def damaged(rows):
    for conv, turn, role, text in rows:
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        role, text = (" " if x is None else x for x in (role, text))
        hit = zlib.crc32(name.encode()) % 20
        if hit == 0:
            continue
        if hit == 1:
            text = ""
        if hit == 2:
            text = re.sub("[.!?]", "", text)
        if hit == 4:
            role = "user"
        yield from [(conv, turn, role, text)] * (2 if hit == 3 else 1)


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        marks = WORD.findall(text)
        out.append("blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def by_table(rows):
    """Least (cost, audit, repaired) from every vertex of the lattice, from the end backwards."""
    faults = faults_of(rows)
    best = {3: (0, "", ()), 0: (0, "", ())}

    def with_inserts(at):
        for _ in range(4):  # an insertion leads from one state to another of four
            for q, to, role in ((0, 2, "user"), (1, 2, "user"), (3, 2, "user"), (2, 3, "assistant")):
                if to in at:
                    new = (at[to][0] + 3, "I" + at[to][1], (role + ":",) + at[to][2])
                    if q not in at or new < at[q]:
                        at[q] = new
        return at

    best = with_inserts(best)
    for (role, text), fault in zip(rows[::-1], faults[::-1]):
        at = {}
        extra = 3 if fault == "truncated" else 0
        for q in range(4):
            ways = [(4, "D", q, None)]
            if fault not in ("blank", "duplicate"):
                to = {"s": 1 if q == 0 else None, "u": 2 if q != 2 else None, "a": 3 if q == 2 else None}.get(role[:1])
                if to is not None:
                    ways.append((extra, "K", to, role))
                ways.append((3 + extra, "R", 3 if q == 2 else 2, "assistant" if q == 2 else "user"))
            for cost, letter, to, said in ways:
                if to in best:
                    left = best[to]
                    new = (left[0] + cost, letter + left[1], left[2] if said is None else (f"{said}:{text}",) + left[2])
                    if q not in at or new[:2] < at[q][:2]:
                        at[q] = new
        best = with_inserts(at)
    return best[0]


def by_trial(rows):
    """All scripts of up to two insertions between rows, judged by the pattern."""
    faults = faults_of(rows)
    found = None
    choices = [["D"] if f in ("blank", "duplicate") else ["K", "Ru", "Ra", "D"] for f in faults]
    inserts = ["", "u", "a", "ua", "au"]
    for script in itertools.product(*choices):
        for added in itertools.product(inserts, repeat=len(rows) + 1):
            audit, roles, cost = "", "", 0
            for i in range(len(rows) + 1):
                audit, roles, cost = audit + "I" * len(added[i]), roles + added[i], cost + 3 * len(added[i])
                if i < len(rows):
                    step = script[i]
                    audit += step[0]
                    cost += {"K": 0, "R": 3, "D": 4}[step[0]] + (3 if step != "D" and faults[i] == "truncated" else 0)
                    roles += "" if step == "D" else rows[i][0][:1] if step == "K" else step[1]
            if PATTERN.match(roles) and (found is None or (cost, audit) < found):
                found = (cost, audit)
    return found


def expected(table):
    groups = defaultdict(list)
    for r in table:
        groups[r[0]]
    for r in damaged(table):
        groups[r[0]].append(r[1:])
    out = {}
    for conv, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        said = [r[1:] for r in rows]
        faults = faults_of(said)
        turns = [r[0] for r in rows if r[0] is not None]
        cost, audit, text = by_table(said)
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(said[:-1], said[1:])]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
                     faults.count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                     hashlib.sha256("\n".join(text).encode()).hexdigest())
    return out


def made(rng, conv, n, roles=("user", "assistant", "system", "tool", None, "")):
    says = ["Yes.", "no", "", " \n", "What? ", "a b c!", None, "é。", "Yes."]
    return [(conv, None if rng.random() < 0.05 else i // rng.choice([1, 1, 2]), rng.choice(roles if rng.random() < 0.3 else ("user", "assistant")), rng.choice(says) if rng.random() < 0.6 else f"{i} words.") for i in range(n)]


def test_search_equals_trial_and_table():
    rng = random.Random(4)
    for _ in range(60):
        rows = [(r or " ", t or " ") for _, _, r, t in made(rng, 0, rng.randrange(0, 4))]
        steps = list(zip(faults_of(rows), [r[:1] for r, _ in rows]))
        assert repair.cheapest(steps) == by_trial(rows) == by_table(rows)[:2]
    for _ in range(300):
        rows = [(r or " ", t or " ") for _, _, r, t in made(rng, 0, rng.randrange(0, 40))]
        steps = list(zip(faults_of(rows), [r[:1] for r, _ in rows]))
        cost, audit, text = by_table(rows)
        assert repair.cheapest(steps) == (cost, audit)
        assert repair.repaired(audit, [(r.encode(), t.encode()) for r, t in rows]) == [t.encode() for t in text]


def rows_of(df):
    return {r["conv_id"]: tuple(r)[1:9] for r in df.collect()}


@pytest.mark.parametrize("segment", [512, 7])
def test_conversations(spark, segment):
    """Nulls, ties, repeated rows, a conversation that holds a third of all rows; with
    segments of seven rows the longer ones are chained."""
    rng = random.Random(segment)
    table = [r for conv in [*range(40), None, -3] for r in made(rng, conv, rng.randrange(1, 12))]
    table += made(rng, 77, 200) + [(5, 1, "user", "Hi."), (5, 1, "user", "Hi."), (6, None, None, None)]
    table += [(88, i, "user", "the same.") for i in range(60)]
    rng.shuffle(table)
    frame = spark.createDataFrame([(*r, "x", 1, "y", None) for r in table], SCHEMA).repartition(5)
    assert rows_of(repair.repair(frame, segment=segment)) == expected(table)


def test_empty_table(spark):
    assert repair.repair(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query(spark):
    table = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(op11_repair(spark, "/root/testdata/sf0.01")) == expected(table)
