"""Byte-level BPE: texts to token ids and back, merges found by segment trees.

A text is cut at its added tokens and split into pieces by the tokenizer's pattern; the bytes of a
piece are its first symbols. A segment tree over the places of a piece holds, for each pair of
adjacent symbols, the pair's rank in the merge list with its place behind it. The root is then the
leftmost pair of the lowest rank: it is merged, and the three places whose pairs change (the pair
itself, the one before it, and the symbol that went) are updated up to the root, until the root
holds no pair. A piece of n bytes takes n log n steps, also one of a million letters.

Small trees are grown side by side, as rows of one array for each size; a piece of more than
WIDE bytes has a tree of its own. Each distinct piece of a chunk is merged once.

Scale: rows are independent, so there is no shuffle. A task holds one chunk of texts (or one
text), and remembers some CACHED pieces.

Defined results: a null text counts as empty and has no ids; ids that the vocabulary lacks, and
nulls among ids, decode to nothing; null ids decode to the empty text; bytes that are no UTF-8
decode to replacement characters. Repeated rows and null ids are handed on, an empty table gives
an empty result, other columns are not read. A tokenizer file of another kind raises ValueError.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidegrid.llm import chunks
from tidegrid.llm.shipping import ship

TEXT_BYTES = 2 << 20
CACHED = 500_000
WIDE = 64
FOREST_CELLS = 1 << 18
DECODED_IDS = 1 << 20

# The letters, numbers and white space among the first 256 characters, of which the
# pattern of byte-level tokenizers is made. For texts with others the library splits, because
# which of them are letters depends on its version of Unicode.
_L, _N, _S = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", r"0-9\xb2\xb3\xb9\xbc-\xbe", r"\t-\r \x85\xa0"
_PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_BEYOND = re.compile(r"[^\x00-\xff]")
_PART = re.compile(r"(?<=\S)(?= )")

_NO_PAIR = np.iinfo(np.int64).max
_PLACE_BITS = 32


def byte_names() -> list[str]:
    """The printable character by which byte-level vocabularies show each byte."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class Merges:
    """Ranks of pairs of symbol ids, and the symbol each pair becomes."""

    def __init__(self, pairs: list[tuple[int, int, int]]):
        keys = np.array([a << _PLACE_BITS | b for a, b, _ in pairs], np.int64)
        self.table = {key: (rank, pairs[rank][2]) for rank, key in enumerate(keys.tolist())}
        order = np.argsort(keys)
        self.keys, self.ranks = np.append(keys[order], _NO_PAIR), np.append(order, 0)
        self.merged = np.array([m for _, _, m in pairs] or [0], np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of neighbours; no pair where either is missing (-1) or no rule has them."""
        pairs = np.where((left < 0) | (right < 0), -1, left << _PLACE_BITS | np.maximum(right, 0))
        at = np.searchsorted(self.keys, pairs)
        return np.where(self.keys[at] == pairs, self.ranks[at], _NO_PAIR)

    def forest(self, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Merge the pieces in the rows of ``symbols`` (-1 beyond each one's size) to the end.

        A row of ``tree`` is the segment tree of one piece. What is left of a piece are the symbols
        that are not -1, in their order.
        """
        n, width = symbols.shape
        places = np.arange(width)
        tree = np.full((n, 2 * width), _NO_PAIR, np.int64)
        ranks = self.pair_ranks(symbols, np.pad(symbols, ((0, 0), (0, 1)), constant_values=-1)[:, 1:])
        tree[:, width:] = np.where(ranks == _NO_PAIR, _NO_PAIR, ranks << _PLACE_BITS | places)
        for node in range(width - 1, 0, -1):
            np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1], out=tree[:, node])
        after = np.broadcast_to(places + 1, symbols.shape).copy()
        before = np.broadcast_to(places - 1, symbols.shape).copy()

        def symbol(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
            inside = (at >= 0) & (at < sizes[rows])
            return np.where(inside, symbols[rows, np.clip(at, 0, width - 1)], -1)

        def update(rows: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
            node = at + width
            tree[rows, node] = value
            while node[0] > 1:
                node = node >> 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

        def new_pair(rows: np.ndarray, at: np.ndarray) -> None:
            rank = self.pair_ranks(symbols[rows, at], symbol(rows, after[rows, at]))
            update(rows, at, np.where(rank == _NO_PAIR, _NO_PAIR, rank << _PLACE_BITS | at))

        rows = np.flatnonzero(tree[:, 1] != _NO_PAIR)
        while len(rows):
            root = tree[rows, 1]
            at = root & ((1 << _PLACE_BITS) - 1)
            gone = after[rows, at]
            symbols[rows, at] = self.merged[root >> _PLACE_BITS]
            symbols[rows, gone] = -1
            after[rows, at] = after[rows, gone]
            follows = after[rows, at] < sizes[rows]
            before[rows[follows], after[rows, at][follows]] = at[follows]
            update(rows, gone, np.full(len(rows), _NO_PAIR))
            new_pair(rows, at)
            left = before[rows, at]
            has = left >= 0
            if has.any():
                new_pair(rows[has], left[has])
            rows = rows[tree[rows, 1] != _NO_PAIR]
        return symbols

    def single(self, symbols: list[int]) -> list[int]:
        """The same for one long piece, on plain lists."""
        n = len(symbols)
        width = 1 << max(0, n - 1).bit_length()
        tree = [_NO_PAIR] * (2 * width)
        get = self.table.get
        for at in range(n - 1):
            found = get(symbols[at] << _PLACE_BITS | symbols[at + 1])
            if found:
                tree[width + at] = found[0] << _PLACE_BITS | at
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def update(at: int, value: int) -> None:
            node = at + width
            tree[node] = value
            while node > 1:
                node >>= 1
                a, b = tree[2 * node], tree[2 * node + 1]
                tree[node] = a if a < b else b

        def new_pair(at: int) -> None:
            found = get(symbols[at] << _PLACE_BITS | symbols[after[at]]) if after[at] < n else None
            update(at, found[0] << _PLACE_BITS | at if found else _NO_PAIR)

        while tree[1] != _NO_PAIR:
            at = tree[1] & ((1 << _PLACE_BITS) - 1)
            gone = after[at]
            symbols[at] = get(symbols[at] << _PLACE_BITS | symbols[gone])[1]
            symbols[gone] = -1
            after[at] = after[gone]
            if after[at] < n:
                before[after[at]] = at
            update(gone, _NO_PAIR)
            new_pair(at)
            if before[at] >= 0:
                new_pair(before[at])
        return [s for s in symbols if s >= 0]


class Codec:
    """A byte-level BPE tokenizer file, as functions on columns of texts and ids."""

    def __init__(self, path: str):
        from tokenizers import pre_tokenizers
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        model, split = rules["model"], rules["pre_tokenizer"] or {}
        if (model["type"] != "BPE" or split.get("type") != "ByteLevel" or split["add_prefix_space"]
                or not split.get("use_regex", True) or rules["normalizer"] or rules["post_processor"]
                or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix",
                                              "ignore_merges", "byte_fallback", "unk_token"))
                or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in rules["added_tokens"])):
            raise ValueError(f"{path} is no plain byte-level BPE tokenizer")
        vocabulary, names = model["vocab"], byte_names()
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merges = Merges([(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in pairs])
        self.byte_ids = np.array([vocabulary[name] for name in names], np.int64)
        byte_of = {name: bytes([b]) for b, name in enumerate(names)}
        self.added = {t["content"]: t["id"] for t in rules["added_tokens"]}
        shown = {i: b"".join(byte_of[c] for c in token) for token, i in vocabulary.items()}
        shown.update((i, token.encode()) for token, i in self.added.items())
        # All tokens' bytes, and where each begins; the last one is empty and stands for unknown ids.
        self.n_ids = max(shown) + 1
        own = [shown.get(i, b"") for i in range(self.n_ids + 1)]
        self.spelled = np.frombuffer(b"".join(own), np.uint8)
        self.lengths = np.array([len(x) for x in own], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        by_length = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile(f"({'|'.join(map(re.escape, by_length))})") if by_length else None
        self.library_split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
        self.known: dict[str, bytes] = {}

    def _pieces(self, text: str) -> list[str]:
        if not _BEYOND.search(text):
            return _PIECE.findall(text)
        # A part starts at a space that follows no white space: the pattern never looks across.
        pieces = []
        for part in _PART.split(text):
            if _BEYOND.search(part):
                pieces += [part[a:b] for _, (a, b) in self.library_split(part)]
            else:
                pieces += _PIECE.findall(part)
        return pieces

    def pieces(self, text: str) -> list[str]:
        """The pieces of a text in order; an added token is a piece."""
        if not self.cut or not self.cut.search(text):
            return self._pieces(text)
        pieces = []
        for place, segment in enumerate(self.cut.split(text)):
            pieces += [segment] if place % 2 else self._pieces(segment)
        return pieces

    def _learn(self, new: set[str]) -> None:
        """Merge pieces that are not known yet, each once."""
        by_width: dict[int, list[tuple[str, bytes]]] = {}
        for piece in new:
            if piece in self.added:
                self.known[piece] = np.array([self.added[piece]], "<i4").tobytes()
            else:
                raw = piece.encode()
                by_width.setdefault(1 << max(0, len(raw) - 1).bit_length(), []).append((piece, raw))
        for width, own in by_width.items():
            if width > WIDE:
                for piece, raw in own:
                    ids = self.merges.single(self.byte_ids[np.frombuffer(raw, np.uint8)].tolist())
                    self.known[piece] = np.array(ids, "<i4").tobytes()
                continue
            for start in range(0, len(own), most := max(1, FOREST_CELLS // width)):
                block = own[start:start + most]
                sizes = np.array([len(raw) for _, raw in block])
                symbols = np.full((len(block), width), -1, np.int64)
                symbols[np.arange(width) < sizes[:, None]] = self.byte_ids[
                    np.frombuffer(b"".join(raw for _, raw in block), np.uint8)]
                symbols = self.merges.forest(symbols, sizes)
                kept = symbols >= 0
                flat, upto = symbols[kept].astype("<i4").tobytes(), (4 * np.cumsum(kept.sum(axis=1))).tolist()
                for (piece, _), a, b in zip(block, [0, *upto], upto):
                    self.known[piece] = flat[a:b]

    def encode(self, texts: list[str | None]) -> pa.Array:
        """Lists of ids."""
        pieces = [self.pieces(text or "") for text in texts]
        if len(self.known) > CACHED:
            self.known.clear()
        known = self.known
        self._learn({piece for own in pieces for piece in own if piece not in known})
        found = [b"".join([known[piece] for piece in own]) for own in pieces]
        upto = np.cumsum([0, *(len(ids) // 4 for ids in found)])
        values = pa.array(np.frombuffer(b"".join(found), "<i4"), pa.int32())
        return pa.ListArray.from_arrays(pa.array(upto, pa.int32()), values)

    def decode(self, ids: pa.Array) -> pa.Array:
        """Texts of lists of ids."""
        counts = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
        flat = pc.fill_null(pc.list_flatten(ids), -1).to_numpy(zero_copy_only=False)
        flat = np.where((flat >= 0) & (flat < self.n_ids), flat, self.n_ids)
        upto = np.concatenate([[0], np.cumsum(counts)])
        texts: list[pa.Array] = []
        at = 0
        while at < len(counts):
            end = max(at + 1, int(np.searchsorted(upto, upto[at] + DECODED_IDS, "right")) - 1)
            own = flat[upto[at]:upto[end]]
            lengths = self.lengths[own]
            ends = np.concatenate([[0], np.cumsum(lengths)])
            raw = self.spelled[np.repeat(self.begins[own] - ends[:-1], lengths) + np.arange(ends[-1])]
            edges = ends[upto[at:end + 1] - upto[at]]
            texts.append(_texts(raw, edges))
            at = end
        return pa.concat_arrays(texts) if texts else pa.array([], pa.string())


def _texts(raw: np.ndarray, edges: np.ndarray) -> pa.Array:
    """UTF-8 between edges as strings, with replacement characters for what is none."""
    data = raw.tobytes()
    inner = raw[edges[:-1][edges[:-1] < len(raw)]]
    try:
        data.decode()
        whole = not ((inner & 0xC0) == 0x80).any()
    except UnicodeDecodeError:
        whole = False
    if whole:
        return pa.StringArray.from_buffers(
            len(edges) - 1, pa.py_buffer(edges.astype(np.int32).tobytes()), pa.py_buffer(data))
    return pa.array([data[a:b].decode("utf-8", "replace") for a, b in zip(edges[:-1], edges[1:])], pa.string())


@functools.lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def _encoder(path: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks.pieces(batches, "text", TEXT_BYTES):
            texts = [None if raw is None else raw.decode("utf-8", "replace")
                     for raw in table.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [table.column("id").combine_chunks(), codec(path).encode(texts)], names=["id", "ids"])
    return run


def _decoder(path: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("ids"), codec(path).decode(batch.column("ids"))],
                names=["id", "ids", "text"])
    return run


def encode(df: DataFrame, tokenizer: str, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(id, ids) for every row. ``tokenizer`` is the path of a file that all executors have."""
    ship(df.sparkSession)
    source = df.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").cast("binary").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(_encoder(tokenizer), f"id {kind}, ids array<int>")


def decode(df: DataFrame, tokenizer: str, ids: str = "ids", id_column: str = "id") -> DataFrame:
    """(id, ids, text) for every row of ids."""
    ship(df.sparkSession)
    source = df.select(F.col(f"`{id_column}`").alias("id"),
                       F.coalesce(F.col(f"`{ids}`").cast("array<int>"), F.array().cast("array<int>")).alias("ids"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(_decoder(tokenizer), f"id {kind}, ids array<int>, text string")
