"""Conversation structure repair: cheapest edits by bidirectional Dijkstra.

The edit lattice of n rows has a vertex per (rows read, state of the role pattern
``(s?(ua)+)?``). Edges keep, rerole or delete the next row, or insert an empty turn. A
forward heap from the start and a reverse heap from the ends meet; the search goes on until
no pair of entries can reach the least cost any more, so every cheapest path has been seen
by both sides, and the least concatenation of the two audits wins. At one vertex a path
that is as cheap as another is never its beginning (what follows would be insertions,
which cost), so the lesser half of an audit belongs to the lesser whole.

Rows are range-partitioned and sorted by conversation and turn, and each task walks through
its rows. A conversation that lies inside one partition and has no more than ``SEGMENT`` rows is
repaired there. The few at the borders, and long ones, are cut into segments: each segment's
cheapest edits between any two states form a small table, the tables of a conversation are
chained, and the chosen edits go back to the segments. So a conversation with a third of all
rows is spread over tasks; only its chain of tables (16 costs and audits a segment) and, as the
hash is sequential, the stream of its repaired text pass through one task, the latter in
pieces.

Defined results: a null conversation id is a conversation; null turns come first and
do not count for gaps; null roles and texts count as one blank; rows of one turn are ordered by
role, then text (bytes); repeated rows are rows; texts of any length count whole; a conversation
all of whose rows were dropped has zeros, an empty audit and the hash of the empty text;
gaps beyond 64 bits wrap around; an empty table gives no rows; other columns do not matter.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, written

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Rows that are repaired in one piece, at most.
SEGMENT = 512
#: Parts of a role and text that very many rows of a conversation share.
SALTS = 16
BLANKS = b" \t\n\x0b\x0c\r"
FAULTS = ("blank", "duplicate", "truncated")
LEGAL = ("su", "ua", "au")
#: States of the pattern: start, after s, after u, after a. The next state of each letter.
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
STATES, ENDS = range(4), (0, 3)
#: The letter that the pattern wants in each state, and what it is written as.
WANTED = ("u", "u", "a", "u")
SPELLED = {"u": b"user", "a": b"assistant"}


# ---------------------------------------------------------------- the search


def _edges(fault: str | None, initial: str):
    """Edges that read a row: (state, next state, cost, letter)."""
    extra = TRUNCATED if fault == "truncated" else 0
    for q in STATES:
        yield q, q, DELETE, "D"
        if fault in ("blank", "duplicate"):
            continue
        if (q, initial) in NEXT:
            yield q, NEXT[q, initial], KEEP + extra, "K"
        yield q, NEXT[q, WANTED[q]], REROLE + extra, "R"


_INSERTS = [(q, NEXT[q, WANTED[q]], INSERT, "I") for q in STATES]
_CACHE: dict = {}


def _ways(fault: str | None, initial: str):
    """Edges by the state they leave, and by the state they enter."""
    key = (fault, initial if initial in "sua" else "?")
    if key not in _CACHE:
        out, into = [[] for _ in STATES], [[] for _ in STATES]
        for a, b, cost, letter in _edges(*key):
            out[a].append((b, cost, letter))
            into[b].append((a, cost, letter))
        _CACHE[key] = out, into
    return _CACHE[key]


def cheapest(rows: list[tuple[str | None, str]], start: int = 0, ends: tuple = ENDS) -> tuple[int, str] | None:
    """(cost, audit) of the cheapest edits of ``rows`` (fault, role's initial) from state
    ``start`` into one of ``ends``; of equally cheap ones the least audit. None: no way."""
    n = len(rows)
    ways = [_ways(*r) for r in rows]
    # labels: vertex -> (cost, audit); entries (cost, rows read, vertex): at equal cost a vertex
    # comes after all that may still shorten its audit, because only reading a row is free
    label = [{(0, start): (0, "")}, {(n, q): (0, "") for q in ends}]
    heap = [[(0, 0, (0, start))], [(0, 0, (n, q)) for q in ends]]
    settled: list[set] = [set(), set()]
    best = min((label[0][v][0] for v in label[1] if v in label[0]), default=None)
    while heap[0] and heap[1]:
        if best is not None and heap[0][0][0] + heap[1][0][0] > best:
            break
        side = 0 if heap[0][0][0] <= heap[1][0][0] else 1
        cost, _, v = heapq.heappop(heap[side])
        if v in settled[side]:
            continue
        settled[side].add(v)
        i, q = v
        audit = label[side][v][1]
        if side == 0:
            steps = [((i, b), c, x) for a, b, c, x in _INSERTS if a == q]
            if i < n:
                steps += [((i + 1, b), c, x) for b, c, x in ways[i][0][q]]
        else:
            steps = [((i, a), c, x) for a, b, c, x in _INSERTS if b == q]
            if i:
                steps += [((i - 1, a), c, x) for a, c, x in ways[i - 1][1][q]]
        for w, c, x in steps:
            if w in settled[side]:
                continue
            new = (cost + c, audit + x if side == 0 else x + audit)
            if w not in label[side] or new < label[side][w]:
                label[side][w] = new
                heapq.heappush(heap[side], (new[0], w[0] if side == 0 else n - w[0], w))
                if w in label[1 - side] and (best is None or new[0] + label[1 - side][w][0] < best):
                    best = new[0] + label[1 - side][w][0]
    if best is None:
        return None
    meets = [v for v in label[0] if v in label[1] and label[0][v][0] + label[1][v][0] == best]
    return best, min(label[0][v][1] + label[1][v][1] for v in meets)


def repaired(audit: str, rows: list[tuple[bytes, bytes]], start: int = 0) -> list[bytes]:
    """``role:text`` of the rows that the audit leaves or inserts."""
    out, state, at = [], start, 0
    for step in audit:
        if step == "D":
            at += 1
            continue
        role, text = (b"", b"") if step == "I" else rows[at]
        letter = _initial(role) if step == "K" else WANTED[state]
        if step != "K":
            role = SPELLED[letter]
        state = NEXT[state, letter]
        at += step != "I"
        out.append(role + b":" + text)
    return out


def _initial(role: bytes) -> str:
    return role.decode("utf-8", "replace")[:1]


def _fault(text: bytes, again: bool) -> str | None:
    left = text.strip(BLANKS)
    if not left:
        return "blank"
    if again:
        return "duplicate"
    return None if left[-1:] in (b".", b"!", b"?") else "truncated"


def _facts(turns: list[int | None], initials: list[str], faults: list[str | None]) -> dict:
    """Counts of sorted rows; ``distinct`` counts turns."""
    known = [t for t in turns if t is not None]
    return {f: faults.count(f) for f in FAULTS} | {
        "illegal": sum(a + b not in LEGAL for a, b in zip(initials[:-1], initials[1:])),
        "low": known[0] if known else None, "high": known[-1] if known else None,
        "distinct": sum(a != b for a, b in zip(known[:-1], known[1:])) + bool(known),
    }


def _gaps(low: int | None, high: int | None, distinct: int) -> int:
    wide = 0 if low is None else high - low + 1 - distinct
    return (wide + (1 << 63)) % (1 << 64) - (1 << 63)


# ------------------------------------------------------------------ on Spark


def _names(schema: str) -> list[str]:
    return [c.split()[0].strip("`") for c in schema.split(", ")]


def damage(rows: DataFrame) -> DataFrame:
    """Rows (key, turn, role, text, gone) of (conv, turn, role, text): every 20th row each
    is dropped (``gone``), emptied, robbed of its stops, repeated or given to the user."""
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    hit = F.crc32(F.concat_ws(":", blank(F.col("conv")), blank(F.col("turn"))).cast("binary")) % 20
    text = F.when(hit == 1, "").when(hit == 2, F.regexp_replace(blank(F.col("text")), "[.!?]", "")).otherwise(blank(F.col("text")))
    times = F.when(hit == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return _keyed(rows).select(
        "key", "turn", F.when(hit == 4, "user").otherwise(blank(F.col("role"))).alias("role"), text.alias("text"),
        (hit == 0).alias("gone"), F.explode(times).alias("copy"),
    ).drop("copy")


def _keyed(rows: DataFrame) -> DataFrame:
    """With the id as a text that is never null ('' for null)."""
    return rows.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit("")))


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
#: What the walk writes: results (part is null), or rows of conversations at borders and long ones.
WALKED = f"key string, {RESULT}, part int, seq long, turn long, role binary, text binary, gone boolean"


def repair(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           damaged: bool = True, segment: int = SEGMENT) -> DataFrame:
    """Rows (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256), one per conversation; ``damaged``: damage the rows first."""
    kind = conversations.schema[conv_col].dataType
    rows = pick(conversations, conv=conv_col, turn=turn_col, role=role_col, text=text_col).withColumn("turn", F.col("turn").cast("long"))
    if damaged:
        rows = damage(rows)
    else:
        rows = _keyed(rows).select("key", "turn", *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")), F.lit(False).alias("gone"))
    rows = rows.select("key", "turn", F.col("role").cast("binary").alias("role"), F.col("text").cast("binary").alias("text"), "gone")
    # equal rows may be dealt anyhow, so the last key only keeps very many of them apart
    rows = rows.withColumn("spread", F.monotonically_increasing_id() % 1024)
    order = ["key", F.col("turn").asc_nulls_first(), "role", "text"]
    dealt = rows.repartitionByRange(*order, "spread").sortWithinPartitions(*order).drop("spread")
    walked = written(dealt.withColumn("part", F.spark_partition_id()).mapInArrow(_walk(segment), WALKED))
    results = _names(RESULT)
    found = walked.where("part is null").select("key", *results).unionByName(_long(walked.where("part is not null"), segment).select("key", *results))
    conv = F.when(F.col("key") == "", None).otherwise(F.substring("key", 2, 1 << 30)).cast(kind)
    return found.select(conv.alias(conv_col), *results)


ARROW = {"string": pa.string(), "binary": pa.binary(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}


def _walk(segment: int):
    """Repair the conversations that lie inside the partition; pass on the rows of the
    first and the last one, and of any with more than ``segment`` rows."""
    schema = pa.schema([(name, ARROW[c.split()[1]]) for name, c in zip(_names(WALKED), WALKED.split(", "))])

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in schema], schema=schema)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        key, run, seq, whole = None, [], 0, False

        def passed(rows: list[dict]) -> None:
            nonlocal seq
            out.extend(r | {"seq": seq + i} for i, r in enumerate(rows))
            seq += len(rows)

        for batch in batches:
            for r in batch.to_pylist():
                if r["key"] != key:
                    if whole:
                        out.append({"key": key} | _whole(run))
                    else:
                        passed(run)
                    # the first conversation may have begun in the partition before
                    whole, key, run = key is not None, r["key"], []
                run.append(r)
                if len(run) > segment:
                    passed(run)
                    whole, run = False, []
            if len(out) > 2000:
                yield batch_of(out)
                out.clear()
        passed(run)
        if out:
            yield batch_of(out)

    return walk


def _whole(rows: list[dict]) -> dict:
    """The result of one conversation from all its sorted rows."""
    rows = [r for r in rows if not r["gone"]]
    seen, faults = set(), []
    for r in rows:
        said = (r["role"], r["text"])
        faults.append(_fault(r["text"], said in seen))
        seen.add(said)
    initials = [_initial(r["role"]) for r in rows]
    facts = _facts([r["turn"] for r in rows], initials, faults)
    cost, audit = cheapest(list(zip(faults, initials)))
    text = b"\n".join(repaired(audit, [(r["role"], r["text"]) for r in rows]))
    return {k: facts[k] for k in (*FAULTS, "illegal")} | {
        "gaps": _gaps(facts["low"], facts["high"], facts["distinct"]), "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256(text).hexdigest(),
    }


# ------------------------------------------------- long ones and those at borders

SEGMENTS = "key string, part int, segment long, n long, blank long, duplicate long, truncated long, illegal long, low long, high long, `distinct` long, first string, last string, costs array<long>, audits array<string>"
CHOSEN = f"key string, part int, segment long, start int, edits string, {RESULT}"


PIECE = "key string, part int, segment long, piece binary"


def _long(rows: DataFrame, segment: int) -> DataFrame:
    """Results of conversations whose rows lie in several segments (key, part, segment)."""
    there = rows.where("not gone").select("key", "part", "seq", F.floor(F.col("seq") / segment).alias("segment"), "turn", "role", "text")
    # a row is a duplicate if its role and text have an earlier place in the conversation
    said = there.select("key", F.sha2(F.concat(F.sha2("role", 256), F.sha2("text", 256)), 256).alias("said"), "part", "seq")
    firsts = said.groupBy("key", "said").agg(F.min(F.struct("part", "seq")).alias("at"), F.count("*").alias("n")).where("n > 1")
    firsts = firsts.select("key", "said", "at", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    again = said.withColumn("salt", (F.col("seq") % SALTS).cast("int")).join(firsts, ["key", "said", "salt"]).where(F.struct("part", "seq") != F.col("at"))
    marked = written(there.join(again.select("key", "part", "seq", F.lit(True).alias("again")), ["key", "part", "seq"], "left"))
    tables = written(marked.groupBy("key", "part", "segment").applyInPandas(_table, SEGMENTS))
    chosen = written(tables.groupBy("key").applyInPandas(_chain, CHOSEN))
    # the chosen edits of every segment, as text; then one stream a conversation
    edits = chosen.where("segment is not null").select("key", "part", "segment", "start", "edits")
    pieces = marked.groupBy("key", "part", "segment").cogroup(edits.groupBy("key", "part", "segment")).applyInPandas(_edited, PIECE)
    stream = pieces.where("piece is not null").repartition("key").sortWithinPartitions("key", "part", "segment").select("key", "piece")
    hashes = stream.mapInArrow(_hashed, "key string, hash string")
    totals = chosen.where("segment is null").drop("repaired_sha256")
    empty = rows.select("key").distinct()
    nothing = hashlib.sha256(b"").hexdigest()
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", *FAULTS, "illegal", "cost")]
    return empty.join(totals, "key", "left").join(hashes, "key", "left").select(
        "key", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("hash", F.lit(nothing)).alias("repaired_sha256"))


def _frame(schema: str, rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=_names(schema), dtype=object)


def _known(value):
    return None if pd.isna(value) else int(value)


def _table(rows: pd.DataFrame) -> pd.DataFrame:
    """One segment: its counts, and its cheapest edits between any two states."""
    rows = rows.sort_values("seq")
    initials = [_initial(bytes(r)) for r in rows["role"]]
    faults = [_fault(bytes(t), pd.notna(a)) for t, a in zip(rows["text"], rows["again"])]
    steps = list(zip(faults, initials))
    ways = [cheapest(steps, a, (b,)) for a in STATES for b in STATES]
    facts = _facts([_known(t) for t in rows["turn"]], initials, faults)
    return _frame(SEGMENTS, [{c: rows[c].iloc[0] for c in ("key", "part", "segment")} | facts | {
        "n": len(rows), "first": initials[0], "last": initials[-1],
        "costs": [-1 if w is None else w[0] for w in ways], "audits": ["" if w is None else w[1] for w in ways],
    }])


def _chain(tables: pd.DataFrame) -> pd.DataFrame:
    """One conversation from its segments' tables: the cheapest way through their states.
    A row per segment with its edits, and one (no segment) with the result."""
    tables = tables.sort_values(["part", "segment"])
    every = tables.to_dict("records")
    # per state: cost, audit so far, states passed
    ways = {0: (0, "", (0,))}
    for t in every:
        after: dict = {}
        for a, (cost, audit, path) in ways.items():
            for b in STATES:
                c = int(t["costs"][a * 4 + b])
                if c >= 0:
                    new = (cost + c, audit + t["audits"][a * 4 + b], (path, b))
                    if b not in after or new[:2] < after[b][:2]:
                        after[b] = new
        ways = after
    cost, audit, path = min((ways[q] for q in ENDS if q in ways), key=lambda w: w[:2])
    states = []
    while len(path) == 2:
        path, last = path
        states.append(last)
    states = [0, *states[::-1]]
    illegal = sum(int(t["illegal"]) for t in every) + sum(a["last"] + b["first"] not in LEGAL for a, b in zip(every[:-1], every[1:]))
    low = high = None
    distinct = 0
    for t in every:
        if _known(t["low"]) is not None:
            distinct += int(t["distinct"]) - (high == int(t["low"]))
            low, high = int(t["low"]) if low is None else low, int(t["high"])
    key = every[0]["key"]
    out = [{"key": key, "part": t["part"], "segment": t["segment"], "start": a, "edits": t["audits"][a * 4 + b]} for t, a, b in zip(every, states[:-1], states[1:])]
    out.append({"key": key, "gaps": _gaps(low, high, distinct), "illegal": illegal, "cost": cost, "audit": audit} | {f: sum(int(t[f]) for t in every) for f in FAULTS})
    return _frame(CHOSEN, out)


def _edited(rows: pd.DataFrame, edits: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("seq")
    left = repaired(edits["edits"].iloc[0], [(bytes(a), bytes(b)) for a, b in zip(rows["role"], rows["text"])], int(edits["start"].iloc[0]))
    piece = b"\n".join(left) if left else None
    return _frame(PIECE, [{c: rows[c].iloc[0] for c in ("key", "part", "segment")} | {"piece": piece}])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces of conversations: one hash each, piece after piece."""
    key, digest = None, None
    for batch in batches:
        done = []
        for k, piece in zip(*(batch.column(i).to_pylist() for i in range(2))):
            if k != key:
                if key is not None:
                    done.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256(piece)
            else:
                digest.update(b"\n" + piece)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*done)], names=["key", "hash"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.string()), pa.array([digest.hexdigest()], pa.string())], names=["key", "hash"])
