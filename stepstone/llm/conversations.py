"""Conversation structure repair as a lightest derivation, by Knuth's agenda.

An item (k, q) says: the first k rows are edited and the roles so far bring the role pattern to state q.  A deduction applies one
edit to an item.  Its weight (cost, edits so far) never falls and keeps the order of what it is applied to, so the
agenda finalises each item when it is first popped, with the cheapest edits and, among these, the least text of initials.
(Two derivations of one item with equal cost are never prefixes of each other: what one adds could only be inserts, which
cost.)  For the same reason derivations of neighbouring stretches may be joined end to end.

Rows are put in order by ranges, so a conversation may lie in many tasks.  Each is cut into segments of a bounded number of
rows; a segment that does not begin its conversation is derived from every state, and a conversation's segments are joined.
A SHA-256 over a repaired conversation can only be taken front to back, so its lines meet in one task at the end, which
streams them.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from stepstone.llm.registry import query
from stepstone.session import cut

#: Rows of a segment as a power of two.
SEGMENT_BITS = 9
SPACES = " \t\n\x0b\f\r"
KEEP_COST, REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 1, 2, 5, 5

#: The role pattern: one system row or none, then pairs of user and assistant.
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
STATES = (START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT)
FINAL = (START, AFTER_ASSISTANT)
#: State that a kept row leads to, by state and the row's role initial.
KEEP = {(START, "s"): AFTER_SYSTEM, (AFTER_USER, "a"): AFTER_ASSISTANT} | {(q, "u"): AFTER_USER for q in (START, AFTER_SYSTEM, AFTER_ASSISTANT)}
#: The role that an inserted or re-roled row gets, and the state it leads to.
NEXT = {q: ("user", AFTER_USER) for q in (START, AFTER_SYSTEM, AFTER_ASSISTANT)} | {AFTER_USER: ("assistant", AFTER_ASSISTANT)}
LEGAL = {"su", "ua", "au"}

#: A unit of a segment is a row that may be edited freely, (initial, truncated), or a number of rows that have to be deleted.
Unit = tuple[str, bool] | int


def deductions(unit: Unit | None, state: int) -> Iterator[tuple[int, str, bool, int]]:
    """(cost, initial, whether the unit is used up, next state) of every edit; ``unit`` is None after the last one."""
    yield INSERT_COST, "I", False, NEXT[state][1]
    if isinstance(unit, int):
        yield DELETE_COST * unit, "D", True, state  # one initial stands for the rows, all derivations have it
    elif unit is not None:
        initial, truncated = unit
        more = TRUNCATED_COST if truncated else 0
        yield DELETE_COST, "D", True, state
        yield REROLE_COST + more, "R", True, NEXT[state][1]
        if (state, initial) in KEEP:
            yield KEEP_COST + more, "K", True, KEEP[state, initial]


def derive(units: list[Unit], start: int) -> dict[int, tuple[int, str]]:
    """Lightest (cost, edits) from ``start`` before the first unit to every state that can be reached after the last."""
    agenda: list[tuple[int, str, int, int]] = [(0, "", 0, start)]
    done: set[tuple[int, int]] = set()
    goals: dict[int, tuple[int, str]] = {}
    while agenda:
        cost, edits, k, state = heapq.heappop(agenda)
        if (k, state) in done:
            continue
        done.add((k, state))
        unit = units[k] if k < len(units) else None
        if unit is None:
            goals[state] = cost, edits
        for more, initial, used, following in deductions(unit, state):
            if (k + used, following) not in done:
                heapq.heappush(agenda, (cost + more, edits + initial, k + used, following))
    return goals


def join_spans(before: dict[int, tuple[int, str]], spans: dict[int, dict[int, tuple[int, str]]]) -> dict[int, tuple[int, str, int]]:
    """Lightest (cost, edits, middle state) to each state by way of every middle state."""
    out: dict[int, tuple[int, str, int]] = {}
    for middle, (cost, edits) in before.items():
        for state, (more, further) in spans.get(middle, {}).items():
            found = cost + more, edits + further, middle
            if state not in out or found[:2] < out[state][:2]:
                out[state] = found
    return out


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n) after the stated damage, n rows alike in one; a null in a row counts as one space."""
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(plain("text"), ".!?", "")).otherwise(plain("text"))
    picked = rows.where(kind != 0).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.when(kind == 4, "user").otherwise(plain("role")).alias("role"), text.alias("text"), F.when(kind == 3, 2).otherwise(1).alias("n"),
    )
    return picked.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))


def in_order(rows: DataFrame, bits: int = SEGMENT_BITS) -> DataFrame:
    """The written rows with their place in the order of (conversation, turn, role, text), nulls first, and their segment."""
    keys = ["conv_id", "turn", "role"]
    spread = rows.repartitionByRange(*keys, F.left("text", F.lit(1024))).sortWithinPartitions(*keys, "text")
    numbered = spread.withColumn("place", F.monotonically_increasing_id())
    return cut(numbered.withColumn("segment", F.shiftright("place", bits)), "conversation-rows")


LONG, TEXT = pa.int64(), pa.string()
SPAN = pa.struct([("start", pa.int32()), ("state", pa.int32()), ("cost", LONG), ("edits", TEXT)])
COUNTS = ("blank", "duplicate", "truncated", "illegal")
SEGMENTS = pa.schema([
    ("conv_id", LONG), ("segment", LONG), ("first_place", LONG), ("units", pa.list_(pa.int32())), ("spans", pa.list_(SPAN)),
    *((c, LONG) for c in COUNTS), ("first_initial", TEXT), ("last_initial", TEXT), ("first_turn", LONG), ("last_turn", LONG), ("turns", LONG),
])
TOTALS = ("gaps", *COUNTS, "cost")
PARTS = pa.schema([("conv_id", LONG), ("segment", LONG), ("first_place", LONG), ("edits", pa.list_(TEXT)), *((c, LONG) for c in TOTALS)])
REPAIRS = pa.schema([("conv_id", LONG), *((c, LONG) for c in TOTALS), ("audit", TEXT), ("repaired_sha256", TEXT)])


def segment_of(key: dict, rows: list[dict], firsts: set[int], bits: int) -> dict:
    """Spans and counts of the rows of one conversation in one segment; ``firsts`` are places where a role and text are new."""
    out = dict.fromkeys(COUNTS, 0) | {"units": [], "first_place": rows[0]["place"], "first_initial": rows[0]["initial"], "last_initial": rows[-1]["initial"]}
    units: list[Unit] = []
    before = None
    for row in rows:
        initial, n = row["initial"], row["n"]
        own: list[Unit] = []
        if row["blank"]:
            out["blank"] += n
            own.append(n)
        else:
            again = n - (row["place"] in firsts)
            out["duplicate"] += again
            if again < n:
                out["truncated"] += row["truncated"]
                own.append((initial, row["truncated"]))
            if again:
                own.append(again)
        out["illegal"] += (before is not None and before + initial not in LEGAL) + (n - 1) * (initial + initial not in LEGAL)
        out["units"].append(len(own))
        units += own
        before = initial
    turns = [r["turn"] for r in rows if r["turn"] is not None]
    out |= {"first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None, "turns": len(set(turns))}
    # a conversation that does not begin with the segment begins inside of it
    inside = rows[0]["place"] & ((1 << bits) - 1)
    starts = [START] if inside else STATES
    out["spans"] = [{"start": p, "state": q, "cost": c, "edits": e} for p in starts for q, (c, e) in derive(units, p).items()]
    return key | out


def per_row(edits: str, units: list[int]) -> list[str]:
    """The edits of each row of a segment: inserts go with the row that follows, and at the end with the last row."""
    out, at = [], 0
    for n in units:
        begin = at
        while n:
            n -= edits[at] != "I"
            at += 1
        out.append(edits[begin:at])
    out[-1] += edits[at:]
    return out


def conversation_of(segments: list[dict]) -> list[dict]:
    """Edits of the rows of each segment of one conversation, with the conversation's counts and cost."""
    reached: dict[int, tuple[int, str]] = {START: (0, "")}
    ways = []
    for segment in segments:
        spans: dict[int, dict[int, tuple[int, str]]] = {}
        for s in segment["spans"]:
            spans.setdefault(s["start"], {})[s["state"]] = s["cost"], s["edits"]
        joined = join_spans(reached, spans)
        ways.append((spans, {state: middle for state, (*_, middle) in joined.items()}))
        reached = {state: (cost, edits) for state, (cost, edits, _) in joined.items()}
    state = min((q for q in FINAL if q in reached), key=reached.__getitem__)
    totals = {c: sum(s[c] for s in segments) for c in COUNTS} | {"cost": reached[state][0]}
    turned = [s for s in segments if s["turns"]]
    distinct = sum(s["turns"] for s in turned)
    for before, after in zip(segments, segments[1:], strict=False):
        totals["illegal"] += before["last_initial"] + after["first_initial"] not in LEGAL
    distinct -= sum(b["last_turn"] == a["first_turn"] for b, a in zip(turned, turned[1:], strict=False))
    totals["gaps"] = turned[-1]["last_turn"] - turned[0]["first_turn"] + 1 - distinct if turned else 0
    out = []
    for segment, (spans, middles) in zip(reversed(segments), reversed(ways), strict=True):
        edits = spans[middles[state]][state][1]
        state = middles[state]
        out.append({f: segment[f] for f in ("conv_id", "segment", "first_place")} | {"edits": per_row(edits, segment["units"])} | totals)
    return out


class Repair:
    """A conversation's repaired lines, hashed one by one, and its edits with an initial for each row."""

    def __init__(self, row: dict):
        self.row = {c: row[c] for c in ("conv_id", *TOTALS)}
        self.state, self.digest, self.audit, self.lines = START, hashlib.sha256(), [], 0

    def _line(self, role: str, text: str) -> None:
        self.digest.update(("\n" * (self.lines > 0) + role + ":" + text).encode())
        self.lines += 1

    def add(self, row: dict) -> None:
        left, used = row["n"], sum(e != "I" for e in row["edits"])
        for edit in row["edits"]:
            if edit == "I":
                role, self.state = NEXT[self.state]
                self._line(role, "")
                self.audit.append("I")
                continue
            used -= 1
            if edit == "D":
                count = 1 if used else left  # the last unit of rows alike stands for those that are left
                self.audit.append("D" * count)
                left -= count
                continue
            if edit == "R":
                role, self.state = NEXT[self.state]
            else:
                role, self.state = row["role"], KEEP[self.state, row["role"][:1]]
            self._line(role, row["text"])
            self.audit.append(edit)
            left -= 1

    def result(self) -> dict:
        return self.row | {"audit": "".join(self.audit), "repaired_sha256": self.digest.hexdigest()}


def _batches(rows: Iterator[dict], schema: pa.Schema, most: int = 4096) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):  # few rows at a time as Python objects
            yield from batch.slice(at, 256).to_pylist()


def _by_conversation(rows: DataFrame, order: str) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", order)


def segments(ordered: DataFrame, bits: int = SEGMENT_BITS) -> DataFrame:
    """Counts and lightest derivations of every (conversation, segment)."""
    cleaned = F.rtrim("text", F.lit(SPACES))
    row = F.struct("place", "turn", F.left("role", F.lit(1)).alias("initial"), (cleaned == "").alias("blank"), (~F.right(cleaned, F.lit(1)).isin(".", "!", "?")).alias("truncated"), "n")
    # equal role and text, wherever they are in the conversation: the first place is the one that is no duplicate
    first = ordered.groupBy("conv_id", "role", F.sha2("text", 256)).agg(F.min("place").alias("first"))
    first = first.select("conv_id", F.shiftright("first", bits).alias("segment"), "first")
    both = ordered.select("conv_id", "segment", row.alias("row")).unionByName(first, allowMissingColumns=True)
    groups = both.groupBy("conv_id", "segment").agg(F.array_sort(F.collect_list("row")).alias("rows"), F.collect_list("first").alias("firsts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (segment_of({"conv_id": g["conv_id"], "segment": g["segment"]}, g["rows"], set(g["firsts"]), bits) for g in _rows(batches))
        yield from _batches(found, SEGMENTS, 256)

    return groups.mapInArrow(run, from_arrow_schema(SEGMENTS))


def parts(of_segments: DataFrame) -> DataFrame:
    """The edits chosen for the rows of every (conversation, segment)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[dict]:
            for _, group in groupby(_rows(batches), key=lambda r: r["conv_id"]):
                yield from conversation_of(list(group))

        yield from _batches(found(), PARTS, 256)

    return _by_conversation(of_segments, "segment").mapInArrow(run, from_arrow_schema(PARTS))


def repair(rows: DataFrame, bits: int = SEGMENT_BITS) -> DataFrame:
    """Damage the conversations as stated and repair each at the least cost; one row for every ``conv_id`` of ``rows``.

    Rows with equal turns are in the order of role, then text.  A null ``conv_id`` is a conversation of its own.  A role that
    is empty has no initial and can't be kept.  Rows alike in all columns are edited together, so the copies of one row never
    meet in one task.  Conversations whose rows are all dropped have zeros, an empty audit and the hash of nothing.
    """
    ordered = in_order(damaged(rows), bits)
    chosen = cut(parts(cut(segments(ordered, bits), "conversation-segments")), "conversation-parts").withColumnsRenamed({"conv_id": "of", "segment": "in"})
    edits = F.element_at("edits", (F.col("place") - F.col("first_place") + 1).cast("int")).alias("edits")
    edited = ordered.join(chosen, (F.col("segment") == F.col("in")) & F.col("conv_id").eqNullSafe(F.col("of")))
    lines = edited.select("conv_id", "place", "role", "text", "n", edits, *TOTALS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[dict]:
            for _, group in groupby(_rows(batches), key=lambda r: r["conv_id"]):
                row = next(group)
                mended = Repair(row)
                mended.add(row)
                for row in group:
                    mended.add(row)
                yield mended.result()

        yield from _batches(found(), REPAIRS)

    repaired = _by_conversation(lines, "place").mapInArrow(run, from_arrow_schema(REPAIRS)).withColumnRenamed("conv_id", "of")
    every = rows.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    nothing = {c: F.lit(0) for c in TOTALS} | {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256(b"").hexdigest())}
    return every.join(repaired, F.col("conv_id").eqNullSafe(F.col("of")), "left").select("conv_id", *(F.coalesce(c, v).alias(c) for c, v in nothing.items()))


@query("op12_repair_agenda")
def repair_agenda(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
