"""Structure repair of conversations: faults are told, and the cheapest edits make roles alternate.

Rows are put in turn order, each gets its first fault (blank, duplicate, truncated), and roles and
faults become a string of symbols, for which ``repair_grammar`` finds the cheapest edits: one
grammar for each chunk of conversations, whose rules are evaluated once for all of them.

Two ways to the same result:

* A conversation of up to LONG rows and LONG_BYTES of text goes to one task by one shuffle. The
  task reads its conversations as a stream and holds one chunk of them.
* The rows of longer ones are dealt by range of (conversation, turn, role, text) and cut into
  segments. A text seen earlier is found by the least turn of its digest. A segment's transfer
  matrix does not depend on what is around it; a stream over the matrices of a conversation, some
  hundred bytes for a segment, tells in which state each segment begins and ends, and the segments
  then spell out their edits in parallel.

``repair`` gives pieces: counts add up over the pieces of a conversation, audits and messages
follow on. Only ``whole``, which joins the audits and takes the digest, streams a conversation
through one task; a digest is sequential by nature, and its memory is one piece.

Defined results: a null role or text is one space, so a null text is blank; a null conversation is a
conversation; null turns come first; rows of one turn are ordered by role and text, and equal
rows are duplicates; an empty role has no initial and is illegal; a conversation without any row
left has zeros, no audit and no messages; other columns are not read; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_type

from tidegrid.llm.repair_grammar import (
    DELETE, DOOMED, ENDING, ENDING_COST, INFINITE, INSERT, KEEP, START, WANTED, Grammar, after, symbol)
from tidegrid.llm.shipping import ship
from tidegrid.session import materialize

LONG = 2000
LONG_BYTES = 8 << 20
CHUNK_ROWS = 20_000
CHUNK_BYTES = 4 << 20
SEGMENT_ROWS = 1024
SEGMENT_BYTES = 1 << 20

# What is blank, what ends a sentence, pairs of initials that may stand side by side.
WHITE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
LEGAL = frozenset(("su", "ua", "au"))
ROLES = {"u": "user", "a": "assistant"}
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")

_ORDER = ("conv", "turn", "role", "text")
_MESSAGE = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def damaged(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """(conv, turn, role, text, copies): the rows with faults put in by a hash of their place.

    Of twenty rows one is dropped (no copies), one loses its text, one its sentence ends, one is
    there twice and one becomes the user's.
    """
    space = F.lit(" ")
    conv, at = F.col(f"`{conversation}`"), F.col(f"`{turn}`")
    name = F.concat(F.coalesce(conv.cast("string"), space), F.lit(":"), F.coalesce(at.cast("string"), space))
    kind = F.crc32(name.cast("binary")) % 20
    rows = df.select(conv.alias("conv"), at.alias("turn"),
                     F.coalesce(F.col(f"`{role}`").cast("string"), space).alias("role"),
                     F.coalesce(F.col(f"`{text}`").cast("string"), space).alias("text"), kind.alias("kind"))
    kind, said = F.col("kind"), F.col("text")
    return rows.select(
        "conv", "turn", F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(kind <= 1, F.lit("")).when(kind == 2, F.translate(said, ENDS, "")).otherwise(said).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


class _Faults:
    """Symbols and counts of a run of rows of one conversation, in order."""

    def __init__(self):
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.symbols = bytearray()
        self.first = self.last = None
        self.kept: list[tuple[str, str]] = []  # rows that need not go
        self.size = 0

    def add(self, role: str, text: str, seen: bool) -> None:
        initial = role[:1]
        if self.last is None:
            self.first = initial
        else:
            self.counts["illegal"] += self.last + initial not in LEGAL
        self.last = initial
        bare = text.rstrip(WHITE)
        fault = "blank" if not bare else "duplicate" if seen else "truncated" if bare[-1] not in ENDS else None
        if fault:
            self.counts[fault] += 1
        if fault in ("blank", "duplicate"):
            self.symbols.append(DOOMED)
        else:
            self.symbols.append(symbol(role, fault is not None))
            self.kept.append((role, text))
            self.size += len(text)


def messages(audit: str, symbols: bytes, kept: list[tuple[str, str]], state: int) -> list[dict[str, str]]:
    """The messages that the edits leave, from a state."""
    out, rows, at = [], iter(kept), 0
    for letter in audit:
        role, text = ROLES[WANTED[state]], ""
        initial = WANTED[state]
        if letter != INSERT:
            doomed = symbols[at] == DOOMED
            at += 1
            row = None if doomed else next(rows)
            if letter == DELETE:
                continue
            text = row[1]
            if letter == KEEP:
                role, initial = row[0], row[0][:1]
        out.append({"role": role, "text": text})
        state = after(state, initial)
    return out


def _read(batches: Iterable[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns))


def _short(schema: pa.Schema):
    """Whole conversations, from rows sorted by conversation and turn."""
    def finished(held: list) -> pa.RecordBatch:
        strings = [bytes(faults.symbols) for _, faults, _ in held]
        grammar = Grammar(strings)
        best = [grammar.best(own) for own in strings]
        audits = grammar.audits([(own, START, end) for own, (_, end) in zip(strings, best)])
        rows = []
        for (conv, faults, gaps), own, (cost, end), audit in zip(held, strings, best, audits):
            audit += ENDING[end]
            rows.append({"conv": conv, "piece": 0, "alone": True, "gaps": gaps, **faults.counts, "cost": cost,
                         "audit": audit, "messages": messages(audit, own, faults.kept, START)})
        return pa.RecordBatch.from_pylist(rows, schema=schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, size, faults, name = [], 0, 0, None, None
        turns: list[int] = []
        seen: set[tuple[str, str]] = set()

        def close() -> None:
            known = set(turns)
            held.append((name, faults, max(known) - min(known) + 1 - len(known) if known else 0))

        for conv, turn, role, text, copies in _read(batches, *_ORDER, "copies"):
            if faults is None or conv != name:
                if faults is not None:
                    close()
                    if rows >= CHUNK_ROWS or size >= CHUNK_BYTES:
                        yield finished(held)
                        held.clear()
                        rows = size = 0
                name, faults, turns, seen = conv, _Faults(), [], set()
            rows += copies
            size += len(text)
            if copies and turn is not None:
                turns.append(turn)
            for _ in range(copies):
                faults.add(role, text, (role, text) in seen)
                seen.add((role, text))
        if faults is not None:
            close()
            yield finished(held)
    return run


def _segments(schema: pa.Schema):
    """Segments of long conversations, from a range of their rows in order."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, faults, number, before = None, None, -1, None

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{
                "conv": name[0], "part": name[1], "segment": number, "symbols": bytes(faults.symbols),
                "first": faults.first, "last": faults.last, **faults.counts,
                "kept": [{"role": r, "text": t} for r, t in faults.kept]}], schema=schema)

        for part, conv, turn, role, text, copies, later in _read(batches, "part", *_ORDER, "copies", "later"):
            if name != (conv, part):
                if faults is not None:
                    yield closed()
                name, faults, number, before = (conv, part), None, -1, None
            for _ in range(copies):
                if faults is not None and (len(faults.symbols) >= SEGMENT_ROWS or faults.size >= SEGMENT_BYTES):
                    yield closed()
                    faults = None
                if faults is None:
                    faults, number = _Faults(), number + 1
                faults.add(role, text, later or (turn, role, text) == before)
                before = (turn, role, text)
        if faults is not None:
            yield closed()
    return run


def _matrices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        strings = batch.column("symbols").to_pylist()
        grammar = Grammar(strings)
        roots = [grammar.root[own] for own in strings]
        flat = [pa.array(list(m[roots].reshape(-1, 16)), pa.list_(pa.int64())) for m in (grammar.costs, grammar.order)]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("conv", "part", "segment", "first", "last")), *flat],
            names=["conv", "part", "segment", "first", "last", "costs", "order"])


def _states(schema: pa.Schema):
    """For each segment its states, from a conversation's matrices in order."""
    def finished(conv, held: list, middles: list, costs: np.ndarray, order: np.ndarray) -> pa.RecordBatch:
        end = int(np.argmin((costs + ENDING_COST) * 8 + order))
        total, leaves = int(costs[end] + ENDING_COST[end]), end
        rows = []
        for i in range(len(held) - 1, -1, -1):
            enters = int(middles[i][leaves])
            part, segment, first, last = held[i]
            rows.append({"conv": conv, "part": part, "segment": segment, "piece": i, "enters": enters,
                         "leaves": leaves, "ends": i == len(held) - 1, "cost": total if i == 0 else 0,
                         "joint": int(i > 0 and held[i - 1][3] + first not in LEGAL)})
            leaves = enters
        return pa.RecordBatch.from_pylist(rows, schema=schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held, middles = None, [], []
        costs = order = None
        for conv, part, segment, first, last, c, o in _read(
                batches, "conv", "part", "segment", "first", "last", "costs", "order"):
            if not held or conv != name:
                if held:
                    yield finished(name, held, middles, costs, order)
                name, held, middles = conv, [], []
                costs, order = np.array([0, INFINITE, INFINITE, INFINITE]), np.zeros(4, np.int64)
            c, o = np.array(c).reshape(4, 4), np.array(o).reshape(4, 4)
            total = costs[:, None] + c
            middle = np.argmin(total * 8 + order[:, None], axis=0)
            key = order[middle] * 8 + o[middle, np.arange(4)]
            costs = np.minimum(total[middle, np.arange(4)], INFINITE)
            key = np.where(costs < INFINITE, key, 64)
            order = (key[:, None] > key[None, :]).sum(axis=1)
            held.append((part, segment, first, last))
            middles.append(middle.astype(np.int8))
        if held:
            yield finished(name, held, middles, costs, order)
    return run


def _spelled(schema: pa.Schema):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A few segments at a time: their texts and messages are held.
            for start in range(0, batch.num_rows, 16):
                part = batch.slice(start, 16).to_pylist()
                grammar = Grammar([r["symbols"] for r in part])
                audits = grammar.audits([(r["symbols"], r["enters"], r["leaves"]) for r in part])
                rows = []
                for r, audit in zip(part, audits):
                    audit += ENDING[r["leaves"]] if r["ends"] else ""
                    kept = [(m["role"], m["text"]) for m in r["kept"]]
                    rows.append({**{c: r[c] for c in ("conv", "piece", "blank", "duplicate", "truncated", "cost")},
                                 "alone": False, "gaps": r["gaps"] if r["piece"] == 0 else 0,
                                 "illegal": r["illegal"] + r["joint"], "audit": audit,
                                 "messages": messages(audit, r["symbols"], kept, r["enters"])})
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return run


def _joined_on(rows: DataFrame, keys: tuple[str, ...], other: DataFrame, how: str = "inner") -> DataFrame:
    """A join by equal keys, nulls being equal; the keys are the rows'."""
    other = other.withColumnsRenamed({c: f"_{c}" for c in keys})
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return rows.join(other, same, how).drop(*(f"_{c}" for c in keys))


def _long_pieces(rows: DataFrame, schema: pa.Schema, conv: pa.DataType) -> DataFrame:
    """Pieces of the conversations that are too long for one task."""
    rows = rows.where("copies > 0")
    turns = rows.where("turn IS NOT NULL").groupBy("conv", "turn").agg(F.lit(1).alias("one"))
    gaps = turns.groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).cast("long").alias("gaps"))
    digest = F.sha2(F.col("text").cast("binary"), 256)
    at = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    told = rows.withColumns({"digest": digest, "at": at})
    firsts = told.groupBy("conv", "role", "digest").agg(F.min("at").alias("least"))
    told = _joined_on(told, ("conv", "role", "digest"), firsts).select(
        *_ORDER, "copies", (F.col("at") > F.col("least")).alias("later"))
    ordered = told.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER).withColumn(
        "part", F.spark_partition_id())
    place = [pa.field("conv", conv), pa.field("part", pa.int32()), pa.field("segment", pa.int64())]
    counts = [pa.field(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal")]
    edges = [pa.field("first", pa.string()), pa.field("last", pa.string())]
    kind = pa.schema([*place, pa.field("symbols", pa.binary()), *edges, *counts, pa.field("kept", _MESSAGE)])
    segments = materialize(ordered.mapInArrow(_segments(kind), from_arrow_schema(kind)), "repair-segments")
    matrix = pa.list_(pa.int64())
    kind = pa.schema([*place, *edges, pa.field("costs", matrix), pa.field("order", matrix)])
    matrices = segments.select("conv", "part", "segment", "first", "last", "symbols").mapInArrow(
        _matrices, from_arrow_schema(kind))
    kind = pa.schema([*place, *(pa.field(c, pa.int64()) for c in ("piece", "enters", "leaves", "cost", "joint")),
                      pa.field("ends", pa.bool_())])
    states = materialize(matrices.repartition("conv").sortWithinPartitions("conv", "part", "segment").mapInArrow(
        _states(kind), from_arrow_schema(kind)), "repair-states")
    found = _joined_on(segments, ("conv", "part", "segment"), states)
    found = _joined_on(found, ("conv",), gaps, "left").withColumn(
        "gaps", F.coalesce("gaps", F.lit(0).cast("long")))
    return found.mapInArrow(_spelled(schema), from_arrow_schema(schema))


def repair(rows: DataFrame) -> DataFrame:
    """Pieces (conv, piece, alone, gaps, blank, duplicate, truncated, illegal, cost, audit, messages)
    of repaired conversations, from rows as ``damaged`` gives them. ``alone``: the only piece."""
    ship(rows.sparkSession)
    conv = to_arrow_type(rows.schema["conv"].dataType)
    schema = pa.schema([
        pa.field("conv", conv), pa.field("piece", pa.int64()), pa.field("alone", pa.bool_()),
        *(pa.field(c, pa.int64()) for c in COUNTS), pa.field("audit", pa.string()), pa.field("messages", _MESSAGE)])
    sizes = materialize(rows.groupBy("conv").agg(
        F.sum("copies").alias("rows"), F.sum(F.octet_length("text") * F.col("copies")).alias("bytes")), "repair-sizes")
    too_long = sizes.where((F.col("rows") > LONG) | (F.col("bytes") > LONG_BYTES)).select("conv")
    short = _joined_on(rows, ("conv",), too_long, "left_anti").repartition("conv").sortWithinPartitions(*_ORDER)
    pieces = short.mapInArrow(_short(schema), from_arrow_schema(schema))
    if too_long.limit(1).count():
        pieces = pieces.unionByName(_long_pieces(
            _joined_on(rows, ("conv",), too_long, "left_semi"), schema, conv))
    return materialize(pieces, "repair-pieces")


def _joined(schema: pa.Schema):
    """One row for each conversation of several pieces, from its pieces in order."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, audit, state, begun = None, [], None, False

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(
                [{**row, "audit": "".join(audit), "repaired_sha256": state.hexdigest()}], schema=schema)

        for conv, *counts, own, said in _read(batches, "conv", *COUNTS, "audit", "messages"):
            if row is None or row["conv"] != conv:
                if row is not None:
                    yield closed()
                row, audit, state, begun = {"conv": conv, **dict.fromkeys(COUNTS, 0)}, [], hashlib.sha256(), False
            for name, n in zip(COUNTS, counts):
                row[name] += n
            audit.append(own)
            for message in said:
                state.update(f"{chr(10) if begun else ''}{message['role']}:{message['text']}".encode())
                begun = True
        if row is not None:
            yield closed()
    return run


def whole(pieces: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) for each conversation."""
    lines = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["text"])), "\n")
    single = pieces.where("alone").select(
        "conv", *COUNTS, "audit", F.sha2(lines.cast("binary"), 256).alias("repaired_sha256"))
    conv = to_arrow_type(pieces.schema["conv"].dataType)
    schema = pa.schema([pa.field("conv", conv), *(pa.field(c, pa.int64()) for c in COUNTS),
                        pa.field("audit", pa.string()), pa.field("repaired_sha256", pa.string())])
    several = pieces.where("NOT alone").repartition("conv").sortWithinPartitions("conv", "piece").mapInArrow(
        _joined(schema), from_arrow_schema(schema))
    return single.unionByName(several)
