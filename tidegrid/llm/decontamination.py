"""Benchmark passages in texts: SimHash of item-sized windows, a Hamming index, exact similarity.

A window of as many words as an item has (lower case, without punctuation) leaks the item if the
weighted Jaccard similarity of their ``n``-word shingles, each weighing as often as it occurs, is
``threshold`` or more. For every length among the items:

1. Windows. Window and item have equally many shingle places, so ``2 t / (1 + t)`` of a leaking
   window's places must hold shingles that the benchmark has at all. Windows below this bound
   cannot leak and get no fingerprint; no window is skipped otherwise, whatever its place.
2. SimHash: 64 signed sums over the shingles of the window.
3. Multi-index Hamming: fingerprints are cut into blocks of BLOCK_BITS. The radius follows from the
   number of places: a window that shares just enough of them lies beyond it with a probability
   of MISS at most. The blocks' own radii are as large as it takes that two fingerprints within
   the radius meet in some block, so all of them are found; a block lists its distinct values
   and the items of each. Some 9 % of unrelated windows and items meet, by the longest items.
   The radius supposes that no shingle repeats. Where one does, in the window or an item of the
   length, the items are looked up by shingle instead, which is exact.
4. The exact weighted similarity of what is left. For each text and item the best window counts.

A text shorter than an item is one window of all its words. Of ``a`` and ``b`` shingle places
``t (a + b) / (1 + t)`` must be shared; the items that share as many are looked up by shingle,
and the exact similarity decides, without fingerprints.

Items go to the tasks in groups of MOST_BYTES or so, counting ITEM_BYTES for each item and
CHARACTER_BYTES for each byte of its text: what text, shingles and index need. There is one pass
over the texts for each group, so what is broadcast has a fixed bound whatever the benchmark's size.

Defined results: null texts and items without a word leak nothing; an item of fewer than ``n``
words is one shingle, and a text of fewer words than a shingle holds none; repeated rows and items are reported each; of
equally good windows the first counts; empty tables give empty results. Other columns are not
read (``clean`` hands them on).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, functions as F

from tidegrid.llm import chunks
from tidegrid.llm.shipping import ship
from tidegrid.llm.words import NON_WORD, rolling, word_hashes

N_WORDS = 5
THRESHOLD = 0.8
MISS = 0.001
BLOCK_BITS = (21, 21, 22)
TEXT_BYTES = 4 << 20
MOST_BYTES = 128 << 20
ITEM_BYTES = 256
CHARACTER_BYTES = 16
SLAB = 1 << 20

_HIT = "item_id {item}, start long, n_words long, similarity double, hamming int"


def simhash(places: np.ndarray) -> np.ndarray:
    """64 signs for each row of a matrix of shingle hashes, as 8 bytes."""
    out = np.empty((len(places), 8), np.uint8)
    step = max(1, (1 << 16) // max(1, places.shape[1]))
    for low in range(0, len(places), step):
        part = np.ascontiguousarray(places[low:low + step])
        signs = np.unpackbits(part.view(np.uint8).reshape(*part.shape, 8), axis=2)
        out[low:low + step] = np.packbits(2 * signs.sum(axis=1, dtype=np.int64) > places.shape[1], axis=1)
    return out


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int32)


def in_blocks(prints: np.ndarray) -> list[np.ndarray]:
    """The value of each block of fingerprints."""
    whole, ends = prints.view(np.uint64)[:, 0], np.cumsum(BLOCK_BITS)
    return [(whole >> np.uint64(end - size) & np.uint64((1 << size) - 1)).astype(np.uint32)
            for size, end in zip(BLOCK_BITS, ends.tolist())]


def least_shared(a, b, threshold: float):
    """How many places two sets of ``a`` and ``b`` places must share to be similar enough."""
    return np.ceil(threshold / (1 + threshold) * (a + b) - 1e-9)


def _binomial(n: int, p: float) -> np.ndarray:
    """Probabilities of 0 to n successes."""
    logs = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, n + 1)))])
    k = np.arange(n + 1)
    return np.exp(logs[n] - logs - logs[::-1] + k * np.log(p) + (n - k) * np.log1p(-p))


@lru_cache(100_000)
def radius(width: int, shared: int) -> int:
    """Distance that fingerprints of ``width`` shingles, ``shared`` of them equal, pass with a
    probability of MISS at most."""
    if shared >= width:
        return 0
    own = _binomial(width - shared, 0.5)
    at_least = np.append(np.cumsum(own[::-1])[::-1], 0.0)
    needed = width // 2 + 1 - np.arange(shared + 1)
    one = at_least[np.clip(needed, 0, width - shared + 1)]
    differ = float((_binomial(shared, 0.5) * 2 * one * (1 - one)).sum())
    beyond = 1 - np.cumsum(_binomial(64, min(max(differ, 1e-12), 0.5)))
    return int(np.argmax(beyond <= MISS))


def repeats_before(own: np.ndarray) -> np.ndarray:
    """For every place the first later one that ends a repetition: of a shingle from there on."""
    order = np.argsort(own, kind="stable")
    again = np.full(len(own) + 1, np.iinfo(np.int64).max)
    equal = own[order[1:]] == own[order[:-1]]
    again[order[:-1][equal]] = order[1:][equal]
    return np.minimum.accumulate(again[::-1])[::-1]


class _Length:
    """The items of one number of words: shingles, fingerprints, and the block index."""

    def __init__(self, n_words: int, n: int, threshold: float, items: list[tuple[int, np.ndarray]]):
        self.n_words, self.n = n_words, min(n, n_words)
        self.names = np.array([i for i, _ in items])
        places = np.array([s for _, s in items])
        width = places.shape[1]
        self.least = int(np.ceil(2 * threshold / (1 + threshold) * width - 1e-9))
        self.sorted = np.sort(places, axis=1)
        self.repeats = bool((self.sorted[:, 1:] == self.sorted[:, :-1]).any())
        order = np.argsort(places, axis=None, kind="stable")
        self.shingles, self.item_of = places.ravel()[order], (order // width).astype(np.int32)
        self.prints = simhash(places)
        self.radius = radius(width, self.least)
        self.blocks = []
        for block, values in enumerate(in_blocks(self.prints)):
            near = (self.radius - len(BLOCK_BITS) + 1 + block) // len(BLOCK_BITS)
            if near >= 0:  # the blocks' radii, and one less than there are blocks, make up the radius
                order = np.argsort(values, kind="stable").astype(np.int32)
                known, begins = np.unique(values[order], return_index=True)
                self.blocks.append((block, near, known, np.append(begins, len(values)), order))

    def sharing(self, window: np.ndarray, least: int) -> np.ndarray:
        """The items that have ``least`` places or more with shingles of the window."""
        values = np.unique(window)
        low, high = np.searchsorted(self.shingles, values, "left"), np.searchsorted(self.shingles, values, "right")
        found = [self.item_of[a:b] for a, b in zip(low, high) if b > a]
        return np.flatnonzero(np.bincount(np.concatenate(found)) >= least) if found else np.empty(0, np.int64)

    def meeting(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows and items that are near each other in some block."""
        found, own = [], in_blocks(prints)
        for block, near, known, begins, order in self.blocks:
            window, value = np.nonzero(np.bitwise_count(own[block][:, None] ^ known[None]) <= near)
            sizes = begins[value + 1] - begins[value]
            at = np.arange(sizes.sum()) + np.repeat(begins[value] - np.cumsum(sizes) + sizes, sizes)
            found.append(np.repeat(window, sizes) * len(self.names) + order[at])
        return np.divmod(np.unique(np.concatenate(found)), len(self.names))

    def candidates(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows and items whose fingerprints lie within the radius."""
        windows, items, step = [], [], max(1, SLAB // len(self.names))
        for low in range(0, len(prints), step):
            window, item = self.meeting(prints[low:low + step])
            close = hamming(prints[window + low], self.prints[item]) <= self.radius
            windows.append(window[close] + low)
            items.append(item[close])
        return (np.concatenate(windows), np.concatenate(items)) if windows else (np.empty(0, int), np.empty(0, int))


def weighted_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two arrays of shingles, by number of occurrences."""
    values, counts = np.unique(a, return_counts=True)
    others, weights = np.unique(b, return_counts=True)
    at = np.minimum(np.searchsorted(values, others), len(values) - 1)
    shared = int(np.minimum(counts[at], weights)[values[at] == others].sum())
    return shared / (len(a) + len(b) - shared)


class Items:
    """A group of benchmark items, ready to be looked for."""

    def __init__(self, texts: list[str], n: int, threshold: float):
        self.threshold = threshold
        hashes, first = word_hashes(pa.array(texts, pa.string()), NON_WORD, lower=True)
        counts = np.diff(first)
        by_length: dict[int, list] = {}
        for i, m in enumerate(counts.tolist()):
            if m:
                _, own = rolling(hashes[first[i]:first[i + 1]], np.array([0, m]), min(n, m))
                by_length.setdefault(m, []).append((i, own))
        self.lengths = [_Length(m, n, threshold, items) for m, items in sorted(by_length.items())]
        self.known = {size: np.unique(np.concatenate([x.sorted.ravel() for x in self.lengths if x.n == size]))
                      for size in {x.n for x in self.lengths}}

    def leaks(self, column) -> dict[tuple[int, int], tuple[float, int, int, int]]:
        """(row, item) -> (similarity, -start, words, Hamming distance) of the best window."""
        hashes, first = word_hashes(column, NON_WORD, lower=True)
        best: dict[tuple[int, int], tuple[float, int, int, int]] = {}
        for size, known in self.known.items():
            lengths = [x for x in self.lengths if x.n == size]
            places, found = rolling(hashes, first, size)
            low_bits = np.zeros(1 << 20, bool)
            low_bits[known & np.uint64((1 << 20) - 1)] = True
            maybe = np.flatnonzero(low_bits[found & np.uint64((1 << 20) - 1)])
            maybe = maybe[np.isin(found[maybe], known)]
            has = np.bincount(np.searchsorted(first, places[maybe], "right") - 1, minlength=len(first) - 1)
            bounds = np.searchsorted(places, first)
            own = np.diff(bounds)
            widest = max(x.sorted.shape[1] for x in lengths)
            short = (own > 0) & (own < widest) & (has >= least_shared(own, own + 1, self.threshold))
            for row in np.flatnonzero(short | (has >= min(x.least for x in lengths))).tolist():
                self._row(row, found[bounds[row]:bounds[row + 1]], lengths, known, best)
        return best

    def _row(self, row: int, own: np.ndarray, lengths, known, best) -> None:
        hits = np.concatenate([[0], np.cumsum(np.isin(own, known))])
        again = repeats_before(own)
        for x in lengths:
            width = x.n_words - x.n + 1
            if len(own) < width:
                self._short(row, own, int(hits[-1]), x, best)
                continue
            starts = np.flatnonzero(hits[width:] - hits[:-width] >= x.least)
            step = max(1, SLAB // width)
            for low in range(0, len(starts), step):
                self._windows(row, own, starts[low:low + step], again, x, best)

    def _windows(self, row: int, own: np.ndarray, starts: np.ndarray, again: np.ndarray, x: _Length, best) -> None:
        width = x.n_words - x.n + 1
        windows = np.lib.stride_tricks.sliding_window_view(own, width)[starts]
        prints = simhash(windows)
        exact = (again[starts] < starts + width) | x.repeats
        plain = np.flatnonzero(~exact)
        window, item = x.candidates(prints[plain])
        pairs = list(zip(plain[window].tolist(), item.tolist()))
        for w in np.flatnonzero(exact).tolist():
            pairs.extend((w, i) for i in x.sharing(windows[w], x.least).tolist())
        for w, i in pairs:
            similarity = weighted_similarity(x.sorted[i], windows[w])
            if similarity >= self.threshold - 1e-12:
                key = (row, int(x.names[i]))
                new = (similarity, -int(starts[w]), x.n_words, int(hamming(prints[w], x.prints[i])))
                best[key] = max(best.get(key, new), new)

    def _short(self, row: int, own: np.ndarray, known: int, x: _Length, best) -> None:
        """A text with fewer words than the items of ``x``: all of it is the window."""
        least = int(least_shared(len(own), x.sorted.shape[1], self.threshold))
        if known < least or len(own) < least:
            return
        own_print = simhash(own[None])[0]
        for i in x.sharing(own, least):
            similarity = weighted_similarity(x.sorted[i], own)
            if similarity >= self.threshold - 1e-12:
                key = (row, int(x.names[i]))
                new = (similarity, 0, len(own) + x.n - 1, int(hamming(own_print, x.prints[i])))
                best[key] = max(best.get(key, new), new)


def _groups(benchmark: DataFrame, text: str, item_column: str) -> Iterator[list[Row]]:
    """The items in groups of bounded size, split by hash so that none passes through whole."""
    rows = benchmark.select(F.col(item_column).alias("item"), F.col(text).alias("text")).where("text IS NOT NULL")
    cost = F.sum(F.octet_length("text").cast("long") * CHARACTER_BYTES + ITEM_BYTES)
    n_groups = (rows.agg(cost.alias("n")).first()["n"] or 0) // MOST_BYTES + 1
    group = F.pmod(F.xxhash64("item", "text"), F.lit(n_groups))
    for g in range(n_groups):
        yield rows.where(group == g).orderBy("item", "text").collect()


def leaks(df: DataFrame, benchmark: DataFrame, text: str = "text", id_column: str = "doc_id",
          item_column: str = "item_id", item_text: str = "text", n: int = N_WORDS,
          threshold: float = THRESHOLD) -> DataFrame:
    """A row (id, item_id, start, n_words, similarity, hamming) for each text and item it leaks.

    ``start`` is the first word of the best window, ``hamming`` the distance of fingerprints.
    """
    ship(df.sparkSession)
    source = df.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    item_type = benchmark.schema[item_column].dataType.simpleString()
    schema = f"id {source.schema['id'].dataType.simpleString()}, {_HIT.format(item=item_type)}"
    found = None
    for rows in _groups(benchmark, item_text, item_column):
        part = source.mapInArrow(_finder(rows, n, threshold), schema)
        found = part if found is None else found.unionByName(part)
    return found


def _finder(rows: list[Row], n: int, threshold: float):
    names, texts = [r["item"] for r in rows], [r["text"] for r in rows]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(texts, n, threshold)
        for table in chunks.pieces(batches, "text", TEXT_BYTES):
            hits = sorted(items.leaks(table.column("text")).items())
            ids = table.column("id").combine_chunks()
            yield pa.RecordBatch.from_arrays([
                ids.take(pa.array([k[0] for k, _ in hits], pa.int64())),
                pa.array([names[k[1]] for k, _ in hits]) if hits else pa.array([], pa.int64()),
                pa.array([-v[1] for _, v in hits], pa.int64()), pa.array([v[2] for _, v in hits], pa.int64()),
                pa.array([v[0] for _, v in hits], pa.float64()), pa.array([v[3] for _, v in hits], pa.int32()),
            ], names=["id", "item_id", "start", "n_words", "similarity", "hamming"])
    return run


def clean(df: DataFrame, benchmark: DataFrame, text: str = "text", item_column: str = "item_id",
          item_text: str = "text", n: int = N_WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df`` that leak no item, as they are. Needs no shuffle."""
    ship(df.sparkSession)
    for rows in _groups(benchmark, item_text, item_column):
        df = df.mapInArrow(_cleaner([r["text"] for r in rows], text, n, threshold), df.schema)
    return df


def _cleaner(texts: list[str], text: str, n: int, threshold: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(texts, n, threshold)
        for table in chunks.pieces(batches, text, TEXT_BYTES):
            keep = np.ones(table.num_rows, bool)
            keep[[row for row, _ in items.leaks(table.column(text))]] = False
            yield from table.filter(pa.array(keep)).to_batches()
    return run
