"""Best-fit packing of token sequences: hierarchical, by residuals.

1. Every partition tokenizes its rows, cuts those longer than a sequence, and packs the pieces
   best-fit, longest first, into bins (at most LOCAL_ITEMS at a time).
2. Bins that are nearly full (at most ``slack`` tokens missing) are sequences. The underfull bins
   are the items of the next round: they are dealt out to fewer groups, packed best-fit, and so
   on, up a tree. The number of groups follows the number of underfull bins, so a task packs some
   MERGE_ITEMS items however many there are. The tree ends with a round of one group, or when a
   round no longer saves bins (as when all are over half full): all that is left is a sequence.
3. Each piece's place is its place in its bin plus the bin's place in the bins above.

Only underfull bins are shuffled. Every round is stored, so a lost executor repeats a task.

Defined results: a null text counts as empty; an empty text is its end token alone; a text of any
length is cut into pieces of ``capacity`` tokens, the last one shorter; repeated rows are packed
each; ids may be null or repeated; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from tidegrid.llm import chunks
from tidegrid.llm.shipping import ship
from tidegrid.llm.words import hashed_words
from tidegrid.session import materialize

CAPACITY = 4096
END_TOKEN = 1
SLACK = 1
LOCAL_ITEMS = 200_000
MERGE_ITEMS = 100_000
LEAST_GAIN = 0.002
TEXT_BYTES = 4 << 20
CACHED_PARTS = 400_000
CACHED_WORDS = 200_000

_PIECE = "piece int, start long, length long, ids_crc32 long, bin long, bin_offset long, bin_load long"
_MOVE = "bin long, into long, at long, load long"


class Tokens:
    """Token ids of texts. Each distinct white-space-separated part of a batch is looked up once.

    The tokenizer's rules never reach across white space, so a text's ids are those of its parts,
    and a part's ids are those of the words it is split into. New parts of Latin-1 characters,
    on which normalisation only means lower case, are split here and their words are given to
    the tokenizer's model; all other new parts go through the whole tokenizer. Parts are told
    apart by 64-bit hashes.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        rules = json.loads(self.tokenizer.to_str())
        self.split = None
        if _is_simple(rules):
            self.split = regex.compile(rules["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        self.special = [t["content"] for t in rules["added_tokens"]]
        self.parts: dict[int, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        return np.array(found.ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        shown = word.encode().decode("latin-1").translate(_SHOWN)
        ids = np.array([t.id for t in self.tokenizer.model.tokenize(shown)], "<u4").tobytes()
        if len(self.words) < CACHED_WORDS:
            self.words[word] = ids
        return ids

    def _part(self, name: int, part: str) -> bytes:
        if self.split is None or max(part) > "\xff" or any(s in part for s in self.special):
            ids = self._whole(part)
        else:
            known = self.words.get
            ids = b"".join(known(w) or self._word(w) for w in self.split(part.lower()))
        if len(self.parts) < CACHED_PARTS:
            self.parts[name] = ids
        return ids

    def ids(self, column: pa.Array) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text of a column."""
        data, starts, ends, hashes, first = hashed_words(column)
        names, index, place = np.unique(hashes, return_index=True, return_inverse=True)
        names = names.tolist()
        found = list(map(self.parts.get, names))
        for i in [i for i, ids in enumerate(found) if ids is None]:
            at = index[i]
            found[i] = self._part(names[i], data[starts[at]:ends[at]].tobytes().decode())
        sizes = np.array([len(ids) // 4 for ids in found], np.int64)
        distinct = np.frombuffer(b"".join(found), "<u4")
        counts = sizes[place]
        before = np.concatenate([[0], np.cumsum(counts)])
        shift = (np.cumsum(sizes) - sizes)[place] - before[:-1]
        ids = distinct[np.repeat(shift, counts) + np.arange(before[-1])]
        for a, b in zip(before[first[:-1]].tolist(), before[first[1:]].tolist()):
            yield ids[a:b].tobytes()


def _is_simple(rules: dict) -> bool:
    """Whether the tokenizer only composes, lowers, splits by a pattern and merges bytes."""
    normalizers = [n["type"] for n in (rules["normalizer"] or {}).get("normalizers", [])]
    steps = (rules["pre_tokenizer"] or {}).get("pretokenizers", [])
    return (normalizers == ["NFC", "Replace", "Lowercase"]
            and [s["type"] for s in steps] == ["Split", "ByteLevel"]
            and "Regex" in steps[0]["pattern"] and steps[0]["invert"] and steps[0]["behavior"] == "Removed"
            and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"])


def _shown_bytes() -> dict[int, int]:
    """The printable character by which byte-level models show each byte."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: b if b in plain else next(others) for b in range(256)}


_SHOWN = _shown_bytes()


@functools.lru_cache(maxsize=2)
def _tokens(path: str) -> Tokens:
    return Tokens(path)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit, longest first: the bin of each item, its place there, and the bins' loads."""
    order = np.argsort(-sizes, kind="stable")
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    loads: list[int] = []
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has room for r more
    for i, size in zip(order.tolist(), sizes[order].tolist()):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = with_room[room].pop()
            if not with_room[room]:
                rooms &= ~(1 << room)
        else:
            room, b = capacity, len(loads)
            loads.append(0)
        bins[i], offsets[i] = b, loads[b]
        loads[b] += size
        if room > size:
            with_room[room - size].append(b)
            rooms |= 1 << (room - size)
    return bins, offsets, np.array(loads, np.int64)


def _pieces(path: str, end_token: int, capacity: int):
    end = np.array([end_token], "<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, n_bins, part = [], 0, 0, None
        for table in chunks.pieces(batches, "text", TEXT_BYTES):
            part = table.column("part")[0].as_py() if part is None else part
            rows, numbers = [], []
            tokens = _tokens(path).ids(table.column("text"))
            for row, ids in enumerate(tokens):
                ids += end
                for piece, start in enumerate(range(0, len(ids) // 4, capacity)):
                    own = ids[4 * start:4 * (start + capacity)]
                    rows.append(row)
                    numbers.append((piece, start, len(own) // 4, zlib.crc32(own)))
            held.append((table.column("id").combine_chunks().take(pa.array(rows, pa.int64())), numbers))
            size += len(numbers)
            if size >= LOCAL_ITEMS:
                out, n_bins = _packed(held, capacity, part, n_bins)
                yield out
                held, size = [], 0
        if size:
            yield _packed(held, capacity, part, n_bins)[0]
    return run


def _packed(held: list, capacity: int, part: int, n_bins: int) -> tuple[pa.RecordBatch, int]:
    numbers = np.array([x for _, own in held for x in own], np.int64)
    bins, offsets, loads = best_fit(numbers[:, 2], capacity)
    batch = pa.RecordBatch.from_arrays([
        pa.concat_arrays([ids for ids, _ in held]), pa.array(numbers[:, 0].astype(np.int32)),
        *(pa.array(numbers[:, k]) for k in (1, 2, 3)),
        pa.array((part << 32) + n_bins + bins), pa.array(offsets), pa.array(loads[bins]),
    ], names=["id", "piece", "start", "length", "ids_crc32", "bin", "bin_offset", "bin_load"])
    return batch, n_bins + len(loads)


def _merger(capacity: int):
    """Packs the items of each group; a bin is named after its first item."""
    schema = pa.schema([("bin", pa.int64()), ("into", pa.int64()), ("at", pa.int64()), ("load", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("load", "descending"), ("bin", "ascending")])
        names, sizes = table.column("bin").to_numpy(), table.column("load").to_numpy()
        bins, offsets, loads = best_fit(sizes, capacity)
        first = np.full(len(loads), -1, np.int64)
        first[bins[::-1]] = names[::-1]
        return pa.table([pa.array(names), pa.array(first[bins]), pa.array(offsets), pa.array(loads[bins])],
                        schema=schema)
    return run


def pack(df: DataFrame, tokenizer: str, text: str = "text", id_column: str = "doc_id",
         capacity: int = CAPACITY, end_token: int = END_TOKEN, slack: int = SLACK) -> DataFrame:
    """A row (id, piece, start, length, ids_crc32, sequence_id, offset) for every piece.

    ``tokenizer`` is the path of a tokenizer file that all executors have.
    """
    ship(df.sparkSession)
    source = df.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text"),
                       F.spark_partition_id().alias("part"))
    kind = source.schema["id"].dataType.simpleString()
    pieces = materialize(source.mapInArrow(
        _pieces(tokenizer, end_token, capacity), f"id {kind}, {_PIECE}"), "pack-pieces")

    items = pieces.where((F.col("bin_offset") == 0) & (F.col("bin_load") < capacity - slack)).select(
        "bin", F.col("bin_load").alias("load"))
    n = items.count()
    rounds = []
    while n > 1:
        groups = -(-n // MERGE_ITEMS)
        group = F.pmod(F.xxhash64("bin", F.lit(len(rounds))), F.lit(groups)).alias("group")
        moved = materialize(items.select(group, "bin", "load").groupBy("group").applyInArrow(
            _merger(capacity), _MOVE), "pack-round")
        rounds.append(moved)
        items = moved.where((F.col("bin") == F.col("into")) & (F.col("load") < capacity - slack)).select(
            "bin", "load")
        left = moved.where("bin = into").count()
        if groups == 1 or left > n * (1 - LEAST_GAIN):
            break
        n = items.count()
    if not rounds:
        return pieces.select("id", "piece", "start", "length", "ids_crc32",
                             F.col("bin").alias("sequence_id"), F.col("bin_offset").alias("offset"))

    above = rounds[-1].select("bin", "into", "at")
    for moved in reversed(rounds[:-1]):
        up = above.select(F.col("bin").alias("into"), F.col("into").alias("top"), F.col("at").alias("top_at"))
        above = materialize(moved.select("bin", "into", "at").join(up, "into", "left").select(
            "bin", F.coalesce("top", "into").alias("into"),
            (F.col("at") + F.coalesce("top_at", F.lit(0))).alias("at")), "pack-places")
    return pieces.join(above, "bin", "left").select(
        "id", "piece", "start", "length", "ids_crc32", F.coalesce("into", "bin").alias("sequence_id"),
        (F.col("bin_offset") + F.coalesce("at", F.lit(0))).alias("offset"))
