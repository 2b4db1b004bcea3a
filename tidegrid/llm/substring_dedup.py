"""Removal of repeated passages: fixed-block anchors, extended to maximal exact repeats.

A passage repeats if a window of ``window`` words occurs at two places, in one row or in two.
Every such window holds a whole block of ``(window + 1) // 2`` words that begins at a multiple
of that length. So:

1. Index: the non-overlapping blocks of all rows. Probe: every rolling window of that length.
   Both go as hashes to shards, each distinct hash once for each chunk of rows, and each chunk
   hears which of its hashes are anchors (an indexed block seen at another place too) and which
   merely occur again.
2. A chunk extends its anchors to both sides as long as the rolling windows go on occurring
   again. Runs that reach ``window`` words are candidates for maximal repeats.
3. The full windows of the candidates are counted in the same way, now by 64-bit hash, and
   words under a window that occurs twice are removed.

No pairs of places are made, so a passage that a third of all rows share costs a message entry
for each chunk. Chunks are bounded by ``chunks.CHUNK_BYTES``, shards by SHARD_HASHES.

Routing: with more than ``2 ** FAN_DIGITS`` shards, messages go over relays. A chunk writes to
ranges of shards; a relay joins what some ``2 ** FAN_DIGITS`` chunks wrote to one range, writes
to finer ranges, and hands the replies back. So a chunk or relay never writes more messages than
that, and their number grows with the input and the number of levels (its logarithm), not with
chunks times shards.

Defined results: a null text has no words and stays null; a text shorter than the window loses
nothing; of repeated rows every copy loses the common words; words are compared as they are.
Rows without a repeat keep their text as it is, the others the rest of their words joined by
one space. Columns of the input with the name of a result column are replaced. An empty table
gives an empty result. The input must be a stored table, or else give the same rows when it is
read again; otherwise the job ends with an error.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tidegrid.llm import chunks
from tidegrid.llm.shipping import ship
from tidegrid.llm.words import flat, rolling, word_hashes
from tidegrid.session import materialize

WINDOW = 35
SHARD_HASHES = 4_000_000
FAN_DIGITS = 8

_MESSAGE = "shard int, chunk long, n long, hashes binary, twice binary, indexed binary"
_REPLY = "shard int, chunk long, n long, again binary, anchor binary"
_PAYLOAD = "chunk long, payload binary"
_RESULT = [
    StructField("n_words", LongType()), StructField("n_removed", LongType()),
    StructField("kept", StringType()), StructField("removed_spans", ArrayType(ArrayType(LongType()))),
]


def _levels(digits: int) -> list[int]:
    """Binary digits of the ranges of shards that each level writes to; the last are the shards."""
    steps = -(-digits // FAN_DIGITS)
    return [-(-digits * (i + 1) // steps) for i in range(steps)]


def _ranges(values: np.ndarray, digits: int) -> tuple[np.ndarray, np.ndarray]:
    """The ranges of shards that ascending hashes fall into, and where each begins and ends."""
    numbers, begins = np.unique(values >> np.uint64(64 - digits), return_index=True)
    return numbers.astype(np.int64), np.append(begins, len(values))


def _messages(values, many, indexed, sender: int, digits: int, kind: type, shift: int) -> list[dict]:
    """One message for each range of shards that has some of the ascending hashes.

    The last ``shift`` bits are not told, and of the rest those that ``kind`` can hold.
    """
    numbers, edges = _ranges(values, digits)
    told = (values >> np.uint64(shift)).astype(kind)
    return [{"shard": shard, "chunk": sender, "n": high - low, "hashes": chunks.coded(told[low:high]),
             "twice": chunks.bits(many[low:high]), "indexed": chunks.bits(indexed[low:high])}
            for shard, low, high in zip(numbers.tolist(), edges[:-1].tolist(), edges[1:].tolist())]


_MESSAGE_ARROW = pa.schema([("shard", pa.int32()), ("chunk", pa.int64()), ("n", pa.int64()),
                            ("hashes", pa.binary()), ("twice", pa.binary()), ("indexed", pa.binary())])
_REPLY_ARROW = pa.schema([("shard", pa.int32()), ("chunk", pa.int64()), ("n", pa.int64()),
                          ("again", pa.binary()), ("anchor", pa.binary())])


def _probe_hashes(hashes, first, block):
    """Distinct rolling hashes of a chunk, which occur twice in it, which are indexed blocks."""
    places, found = rolling(hashes, first, block)
    values, counts = np.unique(found, return_counts=True)
    row_start = np.repeat(first[:-1], np.diff(first))[places] if len(places) else places
    indexed = np.zeros(len(values), bool)
    indexed[np.searchsorted(values, found[(places - row_start) % block == 0])] = True
    return places, found, values, counts > 1, indexed


def _probes(text: str, block: int, digits: int, kind: type, shift: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks.pieces(batches, text):
            name, _ = chunks.digest(table)
            hashes, first = word_hashes(table.column(text))
            _, _, values, many, indexed = _probe_hashes(hashes, first, block)
            rows = _messages(values, many, indexed, name, digits, kind, shift)
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _MESSAGE_ARROW)
    return run


def _joined(table: pa.Table, kind: type, shift: int = 0):
    """The hashes of messages: number in each message, distinct values, the place of each hash
    among them, and which values occur twice and which are indexed."""
    sizes = table.column("n").to_pylist()
    hashes = np.concatenate([chunks.decoded(x, kind) for x in table.column("hashes").to_pylist()])
    twice, indexed = (np.concatenate([chunks.from_bits(x, n) for x, n in zip(table.column(c).to_pylist(), sizes)])
                      for c in ("twice", "indexed"))
    order = np.argsort(hashes, kind="stable")
    ascending = hashes[order]
    heads = np.flatnonzero(np.append(True, ascending[1:] != ascending[:-1]))
    total = np.add.reduceat(1 + twice[order].astype(np.int64), heads)
    known = np.logical_or.reduceat(indexed[order], heads)
    at = np.empty(len(hashes), np.int64)
    at[order] = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(hashes))))
    return sizes, ascending[heads] << kind(shift), at, total > 1, known


def _replies(messages: pa.Table, sizes: list[int], again: np.ndarray, anchor: np.ndarray) -> pa.Table:
    """A reply to each message that has a hash which occurs again."""
    edges = np.cumsum([0, *sizes])
    rows = [{"shard": s, "chunk": c, "n": n, "again": chunks.bits(again[a:b]), "anchor": chunks.bits(anchor[a:b])}
            for s, c, n, a, b in zip(messages.column("shard").to_pylist(), messages.column("chunk").to_pylist(),
                                     sizes, edges, edges[1:])
            if again[a:b].any()]
    return pa.Table.from_pylist(rows, _REPLY_ARROW)


def _answers(kind: type):
    """For every message of a shard: which of its hashes occur again, and which are anchors."""
    def run(table: pa.Table) -> pa.Table:
        sizes, _, at, again, known = _joined(table, kind)
        return _replies(table, sizes, again[at], (again & known)[at])
    return run


def _relay(digits: int, kind: type, shift: int):
    """Messages of many senders to one range of shards, joined and sent on to finer ranges."""
    def run(table: pa.Table) -> pa.Table:
        _, values, _, many, known = _joined(table, np.uint64, shift)
        relay = table.column("relay")[0].as_py()
        return pa.Table.from_pylist(_messages(values, many, known, relay, digits, kind, shift), _MESSAGE_ARROW)
    return run


def _hand_back(digits: int, shift: int):
    """The replies to a relay, as replies to the messages that it had joined."""
    def run(own: pa.Table, replies: pa.Table) -> pa.Table:
        if not replies.num_rows:
            return _REPLY_ARROW.empty_table()
        sizes, values, at, _, _ = _joined(own, np.uint64, shift)
        again, anchor = _told(replies, values, digits)
        return _replies(own, sizes, again[at], anchor[at])
    return run


def _exchange(messages: DataFrame, levels: list[int], relays: list[int], exact: bool, name: str) -> DataFrame:
    """The replies of the shards to messages, over relays where there are levels between."""
    sent = []
    for digits, senders in zip(levels[1:], relays):
        own = materialize(messages.withColumn("relay", F.pmod("chunk", F.lit(senders).cast("long"))), f"{name}-sent")
        sent.append((own, digits))
        messages = own.groupBy("relay", "shard").applyInArrow(
            _relay(digits, *_form(levels, digits, exact)), _MESSAGE)
    replies = materialize(messages.groupBy("shard").applyInArrow(
        _answers(_form(levels, levels[-1], exact)[0]), _REPLY), name)
    for level, (own, digits) in reversed(list(enumerate(sent))):
        theirs = replies.withColumns({"relay": F.col("chunk"), "range": F.shiftright("shard", digits - levels[level])})
        replies = materialize(
            own.groupBy("relay", "shard").cogroup(theirs.groupBy("relay", "range")).applyInArrow(
                _hand_back(digits, _form(levels, digits, exact)[1]), _REPLY), f"{name}-told")
    return replies


def _form(levels: list[int], digits: int, exact: bool) -> tuple[type, int]:
    """How hashes travel to ranges of so many digits: all 64 bits if ``exact``, else those of the
    shard and 32 more, of which a shard needs but the 32."""
    if exact:
        return np.uint64, 0
    return (np.uint32 if digits == levels[-1] else np.uint64), 32 - levels[-1]


def _told(replies: pa.Table, values: np.ndarray, digits: int) -> tuple[np.ndarray, np.ndarray]:
    """The answers for all ascending hashes of a sender; no reply means that none occurs again."""
    numbers, edges = _ranges(values, digits)
    again, anchor = np.zeros(len(values), bool), np.zeros(len(values), bool)
    for row in replies.to_pylist():
        at = np.searchsorted(numbers, row["shard"])
        if at == len(numbers) or numbers[at] != row["shard"] or edges[at + 1] - edges[at] != row["n"]:
            raise ValueError("the input gave other rows when it was read again; store it first")
        low, high = edges[at], edges[at + 1]
        again[low:high] = chunks.from_bits(row["again"], row["n"])
        anchor[low:high] = chunks.from_bits(row["anchor"], row["n"])
    return again, anchor


def _candidates(hashes, first, replies, window, block, digits):
    """Full windows under an extended anchor: their places and hashes."""
    places, found, values, _, _ = _probe_hashes(hashes, first, block)
    again, anchor = _told(replies, values, digits)
    at = np.searchsorted(values, found)
    goes_on = np.zeros(len(hashes) + 1, np.int64)
    anchored = np.zeros(len(hashes) + 1, np.int64)
    goes_on[places + 1] = again[at]
    anchored[places + 1] = anchor[at]
    goes_on, anchored = np.cumsum(goes_on), np.cumsum(anchored)
    full, full_hashes = rolling(hashes, first, window)
    span = window - block + 1
    chosen = (goes_on[full + span] - goes_on[full] == span) & (anchored[full + span] > anchored[full])
    return full[chosen], full_hashes[chosen]


def _extend(text: str, window: int, block: int, digits: int):
    def run(own: pa.Table, replies: pa.Table) -> pa.Table:
        chunks.give_back()
        rows = []
        if replies.num_rows and own.num_rows:
            name = own.column("chunk")[0].as_py()
            hashes, first = word_hashes(chunks.unpacked(own.column("payload")[0].as_py()).column(text))
            _, found = _candidates(hashes, first, replies, window, block, digits)
            values, counts = np.unique(found, return_counts=True)
            many = (counts > 1) | (own.num_rows > 1)
            rows = _messages(values, many, np.ones(len(values), bool), name, digits, np.uint64, 0)
        elif replies.num_rows:
            raise ValueError("the input gave other rows when it was read again; store it first")
        return pa.Table.from_pylist(rows, _MESSAGE_ARROW)
    return run


def _cut(text: str, window: int, block: int, digits: int, schema: pa.Schema):
    def run(own: pa.Table, replies: pa.Table) -> pa.Table:
        chunks.give_back()
        first_round = replies.filter(pc.equal(replies.column("round"), 1))
        second_round = replies.filter(pc.equal(replies.column("round"), 2))
        done = []
        for payload in own.column("payload").to_pylist():
            table = chunks.unpacked(payload)
            hashes, first = word_hashes(table.column(text))
            covered = np.zeros(len(hashes) + 1, np.int64)
            if second_round.num_rows:
                places, found = _candidates(hashes, first, first_round, window, block, digits)
                values = np.unique(found)
                again, _ = _told(second_round, values, digits)
                places = places[again[np.searchsorted(values, found)]]
                np.add.at(covered, places, 1)
                np.add.at(covered, places + window, -1)
            done.append(_rest(table, text, first, np.cumsum(covered)[:-1] > 0, schema))
        return pa.concat_tables(done) if done else schema.empty_table()
    return run


def _rest(table: pa.Table, text: str, first, gone, schema: pa.Schema) -> pa.Table:
    data, offsets = flat(table.column(text))
    raw, is_null = data.tobytes(), table.column(text).is_null().to_pylist()
    lost = np.concatenate([[0], np.cumsum(gone)])
    removed = lost[first[1:]] - lost[first[:-1]]
    kept, spans = [], []
    for i, n in enumerate(removed.tolist()):
        own = raw[offsets[i]:offsets[i + 1]]
        if not n:
            kept.append(None if is_null[i] else own.decode())
            spans.append([])
            continue
        marks = gone[first[i]:first[i + 1]]
        kept.append(b" ".join(compress(own.split(), (~marks).tolist())).decode())
        edges = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
        spans.append(edges.reshape(-1, 2).tolist())
    extra = {"n_words": np.diff(first), "n_removed": removed, "kept": kept, "removed_spans": spans}
    columns = [pa.chunked_array([pa.array(extra[f.name], f.type)]) if f.name in extra
               else table.column(f.name).cast(f.type) for f in schema]
    return pa.table(columns, schema=schema)


def remove_repeats(df: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of ``df`` with ``n_words``, ``n_removed``, ``kept`` (the text without repeated
    passages) and ``removed_spans`` (first and last word, exclusive, of each removed run)."""
    spark = ship(df.sparkSession)
    block = (window + 1) // 2
    names = {f.name for f in _RESULT}
    result = StructType([f for f in df.schema.fields if f.name not in names] + _RESULT)
    size = df.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    digits = chunks.shard_bits(size // 6, SHARD_HASHES, int(spark.conf.get("spark.sql.shuffle.partitions")))

    levels = _levels(digits)
    relays = [-(-size // (chunks.CHUNK_BYTES << FAN_DIGITS * i)) + 1 for i in range(1, len(levels))]

    def payloads(batches):
        for table in chunks.pieces(batches, text):
            name, payload = chunks.digest(table)
            yield pa.RecordBatch.from_pylist([{"chunk": name, "payload": payload}],
                                             pa.schema([("chunk", pa.int64()), ("payload", pa.binary())]))

    packed = df.mapInArrow(payloads, _PAYLOAD).groupBy("chunk")
    probes = df.mapInArrow(_probes(text, block, levels[0], *_form(levels, levels[0], False)), _MESSAGE)
    anchors = _exchange(probes, levels, relays, False, "repeat-anchors")
    windows = packed.cogroup(anchors.groupBy("chunk")).applyInArrow(
        _extend(text, window, block, levels[0]), _MESSAGE)
    repeats = _exchange(windows, levels, relays, True, "repeat-windows")
    told = anchors.withColumn("round", F.lit(1)).unionByName(repeats.withColumn("round", F.lit(2)))
    schema = to_arrow_schema(result)
    return packed.cogroup(told.groupBy("chunk")).applyInArrow(
        _cut(text, window, block, levels[0], schema), result)

