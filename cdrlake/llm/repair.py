"""Repair of conversations whose turns do not fit the order system? (user assistant)+.

Each turn may be kept, given another role or deleted, and empty turns may be inserted; the
cheapest edits win, and of equally cheap ones those whose initials come first in ASCII.
A depth-first branch-and-bound with an explicit stack finds them.  Its lower bound of what
a suffix still costs is exact for every state of the pattern, from one backward sweep;
partial edits that a table of each node's best (cost) dominates, or that cannot beat the
incumbent (cost, audit), are dropped, and an empty stack proves that the incumbent is best.

Distribution.  Turns are ranged by conversation, turn, role and hash of the text, and each
task cuts its sorted rows into segments of bounded size.  Segments that are whole
conversations are solved on the spot.  A conversation that reaches over several segments
(the first and last of a task, or a very long one) is never held in one task: repeated turns
are found by a join on hashes, every segment gives its table of costs between states, a
stream over those tables from the end gives the bounds, all segments are solved in parallel
for each state they can be entered in, and a stream in order picks the entered one, hashes
the repaired text and puts the audit together.  Streams hold one segment and the audit.

Defined results: null texts and roles are one space, so that a null text is blank.  Null
turns come first; rows of equal turn are in the order of role and of their text's md5.  A
null conversation id is a conversation like others.  Repeated rows are duplicates.  A very
long text is in one task's memory alone.  Other columns are not read, and their names cannot
clash.  No rows, no conversations.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import batch, hot_join, saved, ship

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
#: turns and characters of a segment at most (one turn more, if that is longer)
ROWS, CHARS = 4_096, 4_000_000

# States: nothing yet, after a leading system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: state after a user or assistant turn that fits, and its role
_NEXT = (USER, USER, ASSISTANT, USER)
_ROLE = ("user", "user", "assistant", "user")
#: state after a kept turn of a role initial
_KEPT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: cost of the turns still missing at the end of a conversation
FINAL = (0, 2 * INSERT_COST, INSERT_COST, 0)
_NEVER = 1 << 60

_BLANK, _DUPLICATE, _TRUNCATED, _SOUND = "b", "d", "t", "-"
_LEGAL = {"su", "ua", "au"}


def fault_of(text: str) -> str:
    """Blank, truncated or sound; what was seen before is not known here."""
    last = text.rstrip(" \t\n\v\f\r")[-1:]
    return _BLANK if not last else _SOUND if last in ".!?" else _TRUNCATED


def suffix_bounds(initials: str, faults: str, end: tuple | list) -> list[tuple[int, int, int, int]]:
    """Least cost from each state before each turn to the end, where the states cost ``end``."""
    here = tuple(end)
    out = [here]
    for initial, fault in zip(reversed(initials), reversed(faults)):
        forced, late = fault in (_BLANK, _DUPLICATE), TRUNCATED_COST if fault == _TRUNCATED else 0
        cost = [DELETE_COST + x for x in here]
        if not forced:
            for q in range(4):
                kept = _KEPT[q].get(initial)
                cost[q] = min(cost[q], REROLE_COST + late + here[_NEXT[q]], _NEVER if kept is None else late + here[kept])
        for _ in range(2):  # a third inserted turn in a row only comes back to a state
            cost = [min(x, INSERT_COST + cost[_NEXT[q]]) for q, x in enumerate(cost)]
        here = tuple(cost)
        out.append(here)
    out.reverse()
    return out


def search(initials: str, faults: str, bounds: list[tuple], start: int, last: bool) -> tuple[int, str, int]:
    """Cheapest edits from state ``start``, of equal ones the ASCII-least: (cost, audit, state they end in).

    ``bounds`` are those of :func:`suffix_bounds`; ``last`` tells whether turns may be inserted behind the last one.
    """
    n = len(initials)
    best, incumbent = _NEVER, None
    reached: dict[tuple[int, int], int] = {}
    # a node: cost so far, turn, state, and its path as (edit, path before)
    stack = [(bounds[0][start], 0, 0, start, None)]
    while stack:
        bound, cost, at, q, path = stack.pop()
        if bound >= best or reached.get((at, q), _NEVER) <= cost:
            continue
        reached[at, q] = cost
        if at == n and (not last or q in (START, ASSISTANT)):
            best, incumbent = bound, (cost, path, q)
            continue
        steps = []
        if at < n:
            late = TRUNCATED_COST if faults[at] == _TRUNCATED else 0
            steps.append((cost + DELETE_COST, at + 1, q, DELETE))
            if faults[at] in (_TRUNCATED, _SOUND):
                kept = _KEPT[q].get(initials[at])
                if kept is not None:
                    steps.append((cost + late, at + 1, kept, KEEP))
                steps.append((cost + REROLE_COST + late, at + 1, _NEXT[q], REROLE))
        if at < n or last:
            steps.append((cost + INSERT_COST, at, _NEXT[q], INSERT))
        nodes = [(c + bounds[i][state], c, i, state, (edit, path)) for c, i, state, edit in steps]
        # the most promising one is taken first, of equal ones the ASCII-least edit
        stack += sorted((x for x in nodes if x[0] < best), key=lambda x: (x[0], x[4][0]), reverse=True)
    cost, path, q = incumbent
    edits = []
    while path is not None:
        edit, path = path
        edits.append(edit)
    return cost, "".join(reversed(edits)), q


def applied(audit: str, roles: list[str], texts: list[str], start: int) -> Iterator[tuple[str, str]]:
    """Role and text of the turns that the edits leave."""
    rows, q = zip(roles, texts), start
    for edit in audit:
        if edit == INSERT:
            yield _ROLE[q], ""
            q = _NEXT[q]
            continue
        role, text = next(rows)
        if edit == KEEP:
            yield role, text
            q = _KEPT[q][role[:1]]
        elif edit == REROLE:
            yield _ROLE[q], text
            q = _NEXT[q]


def tally(turns: list[int | None], initials: list[str], faults: str) -> dict:
    """Counts of a segment's turns, and what is needed to add those of the next one."""
    known = [t for t in turns if t is not None]
    return {
        "blank": faults.count(_BLANK), "duplicate": faults.count(_DUPLICATE), "truncated": faults.count(_TRUNCATED),
        "illegal": sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:])),
        "low": min(known, default=None), "high": max(known, default=None), "kinds": len(set(known)),
        "first": initials[0] if initials else None, "last": initials[-1] if initials else None,
    }


def add(a: dict, b: dict) -> dict:
    """The tally of two segments in a row; turns do not fall."""
    if b["first"] is None:
        return a
    if a["first"] is None:
        return b
    out = {k: a[k] + b[k] for k in ("blank", "duplicate", "truncated", "illegal", "kinds")}
    out["illegal"] += a["last"] + b["first"] not in _LEGAL
    out["kinds"] -= a["high"] is not None and a["high"] == b["low"]
    out["low"] = b["low"] if a["low"] is None else a["low"]
    out["high"] = a["high"] if b["high"] is None else b["high"]
    return out | {"first": a["first"], "last": b["last"]}


def gaps(t: dict) -> int:
    return 0 if t["low"] is None else t["high"] - t["low"] + 1 - t["kinds"]


_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_TALLY = [(c, pa.int64()) for c in (*_COUNTS, "low", "high", "kinds")] + [("first", pa.string()), ("last", pa.string())]
_TALLY_DDL = "blank long, duplicate long, truncated long, illegal long, low long, high long, kinds long, first string, last string"
_PLACE = [("part", pa.int32()), ("chunk", pa.int64())]
#: one row a segment; the conversation's result stands in its last one
_RESULT = [
    *_PLACE, ("is_last", pa.bool_()), ("gaps", pa.int64()), *((c, pa.int64()) for c in (*_COUNTS, "cost")), ("audit", pa.string()),
    ("repaired_sha256", pa.string()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
]
_RESULT_DDL = (
    "part int, chunk long, is_last boolean, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string, roles array<string>, texts array<string>"
)


def _segments(rows: DataFrame, id_ddl: str, id_type: pa.DataType) -> DataFrame:
    """Segments of the ordered turns; those that are whole conversations have their result already."""
    schema = pa.schema(
        [("conv_id", id_type), ("is_open", pa.bool_()), ("turns", pa.list_(pa.int64())), ("faults", pa.string()),
         ("keys", pa.list_(pa.binary())), *_RESULT]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, chunk = TaskContext.get().partitionId(), 0
        conv, cut, first = None, False, True
        turns, roles, texts, keys, size, begun = [], [], [], [], 0, False
        ready = {f.name: [] for f in schema}

        def close(is_open: bool) -> None:
            nonlocal chunk, turns, roles, texts, keys, size
            row = dict.fromkeys(ready) | {"conv_id": conv, "part": part, "chunk": chunk, "is_open": is_open}
            if is_open:
                row |= {"turns": turns, "roles": roles, "texts": texts, "keys": keys, "faults": "".join(map(fault_of, texts))}
            else:
                row |= _solved(turns, roles, texts, keys)
            for name, value in row.items():
                ready[name].append(value)
            chunk += 1
            turns, roles, texts, keys, size = [], [], [], [], 0

        held = 0
        for b in batches:
            for name, turn, role, text, copies, key in zip(*(b.column(i).to_pylist() for i in range(6))):
                if begun and name != conv:
                    close(first or cut)
                    first = cut = False
                elif begun and (len(turns) >= ROWS or size >= CHARS):
                    cut = True
                    close(True)
                conv, begun = name, True
                for _ in range(copies):
                    turns.append(turn)
                    roles.append(role)
                    texts.append(text)
                    keys.append(key)
                size += len(text)
                held += len(text)
            if held >= CHARS and ready["part"]:
                yield batch(schema, **ready)
                ready, held = {f.name: [] for f in schema}, size
        if begun:
            close(True)
            yield batch(schema, **ready)

    return rows.mapInArrow(run, f"conv_id {id_ddl}, is_open boolean, turns array<long>, faults string, keys array<binary>, {_RESULT_DDL}")


def _digest(turns: list[tuple[str, str]]) -> str:
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode("utf-8", "surrogatepass")).hexdigest()


def _solved(turns: list, roles: list[str], texts: list[str], keys: list[bytes]) -> dict:
    """The result of a whole conversation."""
    seen: set[bytes] = set()
    faults = []
    for text, key in zip(texts, keys):
        fault = fault_of(text)
        faults.append(_DUPLICATE if fault != _BLANK and key in seen else fault)
        seen.add(key)
    faults, initials = "".join(faults), [r[:1] for r in roles]
    codes = "".join(i or " " for i in initials)
    t = tally(turns, initials, faults)
    cost, audit, _ = search(codes, faults, suffix_bounds(codes, faults, FINAL), START, True)
    left = list(applied(audit, roles, texts, START))
    return {c: t[c] for c in _COUNTS} | {
        "is_last": True, "gaps": gaps(t), "cost": cost, "audit": audit, "repaired_sha256": _digest(left),
        "roles": [r for r, _ in left], "texts": [x for _, x in left],
    }


def _ordered(df: DataFrame, *order) -> DataFrame:
    """Segments by conversation, each conversation's in one task and in order."""
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def _over_segments(pieces: DataFrame, id_ddl: str, id_type: pa.DataType) -> DataFrame:
    """The results of the conversations whose segments ``pieces`` has."""
    # turns seen before, in whichever segment
    places = pieces.select("part", "chunk", F.posexplode("keys").alias("at", "key"))
    spot = F.struct("part", "chunk", "at")
    first = places.groupBy("key").agg(F.min(spot).alias("f"), F.count("*").alias("n")).filter("n > 1").drop("n")
    again = hot_join(places, first, ["key"], ["part", "chunk", "at"]).filter(spot > F.col("f"))
    again = again.groupBy("part", "chunk").agg(F.collect_list("at").alias("again"))  # ROWS of them at most
    narrow = pieces.select("conv_id", "part", "chunk", "turns", "faults", F.transform("roles", lambda r: F.substring(r, 1, 1)).alias("initials"))
    states = pa.schema(
        [("conv_id", id_type), *_PLACE, ("faults", pa.string()), ("codes", pa.string()), ("costs", pa.list_(pa.int64())), *_TALLY]
    )

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = {f.name: [] for f in states}
            for r in b.to_pylist():
                faults = list(r["faults"])
                for at in r["again"] or ():
                    if faults[at] != _BLANK:
                        faults[at] = _DUPLICATE
                faults, codes = "".join(faults), "".join(i or " " for i in r["initials"])
                ends = [suffix_bounds(codes, faults, [0 if q == to else _NEVER for q in range(4)])[0] for to in range(4)]
                row = {k: r[k] for k in ("conv_id", "part", "chunk")} | tally(r["turns"], r["initials"], faults)
                row |= {"faults": faults, "codes": codes, "costs": [ends[to][q] for q in range(4) for to in range(4)]}
                for name in out:
                    out[name].append(row[name])
            yield batch(states, **out)

    ddl = f"conv_id {id_ddl}, part int, chunk long, faults string, codes string, costs array<long>, {_TALLY_DDL}"
    known = saved(narrow.join(again, ["part", "chunk"], "left").select(*narrow.columns, "again").mapInArrow(tables, ddl), "segment-costs")

    # from each conversation's end: what the segments behind a segment cost from each state
    ending = pa.schema([*_PLACE, ("behind", pa.list_(pa.int64())), ("is_last", pa.bool_())])

    def backwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, behind, begun = None, None, False
        for b in batches:
            out = {f.name: [] for f in ending}
            for name, part, chunk, costs in zip(*(b.column(i).to_pylist() for i in range(4))):
                last = not begun or name != conv
                conv, begun = name, True
                behind = list(FINAL) if last else behind
                for field, value in zip(out, (part, chunk, behind, last)):
                    out[field].append(value)
                behind = [min(costs[4 * q + to] + behind[to] for to in range(4)) for q in range(4)]
            yield batch(ending, **out)

    ends = _ordered(known.select("conv_id", "part", "chunk", "costs"), F.desc("part"), F.desc("chunk"))
    ends = ends.mapInArrow(backwards, "part int, chunk long, behind array<long>, is_last boolean")

    # all segments in parallel, for each state they can be entered in
    choice = pa.schema([*_PLACE, ("is_last", pa.bool_()), ("audits", pa.list_(pa.string())), ("exits", pa.list_(pa.int32())), ("spent", pa.list_(pa.int64()))])

    def choices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = {f.name: [] for f in choice}
            for part, chunk, codes, faults, behind, last in zip(*(b.column(i).to_pylist() for i in range(6))):
                bounds = suffix_bounds(codes, faults, behind)
                found = [search(codes, faults, bounds, q, last) for q in range(4)]
                for field, value in zip(out, (part, chunk, last, [x[1] for x in found], [x[2] for x in found], [x[0] for x in found])):
                    out[field].append(value)
            yield batch(choice, **out)

    chosen = known.select("part", "chunk", "codes", "faults").join(ends, ["part", "chunk"]).select("part", "chunk", "codes", "faults", "behind", "is_last")
    chosen = chosen.mapInArrow(choices, "part int, chunk long, is_last boolean, audits array<string>, exits array<int>, spent array<long>")
    tallies = known.select("part", "chunk", *(c for c, _ in _TALLY))
    whole = pieces.select("conv_id", "part", "chunk", "roles", "texts").join(chosen, ["part", "chunk"]).join(tallies, ["part", "chunk"])
    result = pa.schema([("conv_id", id_type), *_RESULT])

    def forwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, q, cost, audits, total, digest, some = None, START, 0, [], None, hashlib.sha256(), False
        fresh = True
        for b in batches:
            for r in b.to_pylist():
                if fresh:
                    conv, q, cost, audits, total, digest, some = r["conv_id"], START, 0, [], None, hashlib.sha256(), False
                own = {c: r[c] for c, _ in _TALLY}
                total = own if total is None else add(total, own)
                left = list(applied(r["audits"][q], r["roles"], r["texts"], q))
                audits.append(r["audits"][q])
                cost += r["spent"][q]
                q = r["exits"][q]
                for role, text in left:
                    digest.update((("\n" if some else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
                    some = True
                fresh = r["is_last"]
                row = dict.fromkeys(result.names) | {"conv_id": conv, "part": r["part"], "chunk": r["chunk"], "is_last": fresh}
                row |= {"roles": [x for x, _ in left], "texts": [x for _, x in left]}
                if fresh:
                    row |= {c: total[c] for c in _COUNTS}
                    row |= {"gaps": gaps(total), "cost": cost, "audit": "".join(audits), "repaired_sha256": digest.hexdigest()}
                yield batch(result, **{k: [v] for k, v in row.items()})

    return _ordered(whole, "part", "chunk").mapInArrow(forwards, f"conv_id {id_ddl}, {_RESULT_DDL}")


def damaged(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, copies) with a twentieth of the rows each dropped, emptied, unpunctuated, repeated or given the role user."""
    plain = rows.select(
        F.col(f"`{conv_id}`").alias("conv_id"), F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"),
    )
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(name.cast("binary")) % 20
    return plain.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind <= 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def repair(turns: DataFrame) -> DataFrame:
    """Repaired conversations of ``turns`` (conv_id, turn, role, text, copies), in segments.

    ``copies`` says how often a row stands there; 0 keeps the conversation in the result
    without the row.  ``roles`` and ``texts`` are the segment's repaired turns; counts,
    cost, audit and hash are those of the whole conversation, in its last segment.
    """
    spark = ship(turns.sparkSession)
    id_type = turns.schema["conv_id"].dataType
    ddl, arrow = id_type.simpleString(), to_arrow_type(id_type)
    # the key tells conversations apart, so that a turn is only compared with its own
    marked = F.concat(F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")), F.lit("\0"), F.col("role"), F.lit("\0"))
    key = F.unhex(F.md5(F.concat(marked.cast("binary"), F.col("text").cast("binary"))))
    own = turns.select("conv_id", "turn", "role", "text", "copies", key.alias("key"))
    ranged = own.repartitionByRange("conv_id", "turn", "role", "key").sortWithinPartitions("conv_id", "turn", "role", "key")
    cut = saved(_segments(ranged, ddl, arrow), "segments")
    columns = ["conv_id", *(c for c, _ in _RESULT)]
    # a task's first and last conversation may be whole all the same
    return cut.filter("NOT is_open").select(*columns).union(_over_segments(cut.filter("is_open"), ddl, arrow).select(*columns))


def repaired_turns(solved: DataFrame) -> DataFrame:
    """(conv_id, part, chunk, place, role, text) of every repaired turn; part, chunk and place give its order."""
    return solved.select("conv_id", "part", "chunk", F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "t")).select(
        "conv_id", "part", "chunk", "place", F.col("t.roles").alias("role"), F.col("t.texts").alias("text")
    )


def conversation_repair(rows: DataFrame) -> DataFrame:
    """Faults, cost, audit and hash of every conversation after damage and repair."""
    solved = repair(damaged(rows)).filter("is_last")
    return solved.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
