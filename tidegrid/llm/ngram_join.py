"""Similarity self-join of texts on word n-grams: MinHash banding, then exact verification.

Two rows are linked if the Jaccard similarity of their sets of ``n`` consecutive words (lower
case, without punctuation) is ``threshold`` or more. Rows of the same words form one text and
are linked to each other; only one of them takes part in the rest. ``banding`` chooses bands
and rows for the recall wanted at the threshold. Texts are shuffled on their band hashes;
buckets of one text are dropped; larger ones are dealt out as cells, each for two blocks of at
most some BLOCK texts, and every pair of a cell that shares no earlier band is verified on the
full n-gram sets. A cell gives one row for each text that has links (their number, and an edge
to the least text it hangs together with), never a row for a pair. A text shorter than ``n``
words has one n-gram, all its words.

Defined results: a row without a word (null or empty text among them) is linked to nothing and
is a class of its own; repeated rows count as copies; a null id is allowed, a class takes the
least id that is not null; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidegrid.llm import chunks
from tidegrid.llm.components import components
from tidegrid.llm.shipping import ship
from tidegrid.llm.words import NON_WORD, _window_sums, mixed, shingles, word_hashes
from tidegrid.session import materialize

N_WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9999
MOST_HASHES = 80
BLOCK = 512
TEXT_BYTES = 4 << 20
SET_MASK = np.uint64((1 << 48) - 1)

_SIGNED = "uid long, uid2 long, key1 long, key2 long, n_words long, bands array<long>"
_MEETS = "band int, bucket long, i int, j int, block int, node long"
_MEETING = pa.schema([("band", pa.int32()), ("bucket", pa.int64()), ("i", pa.int32()), ("j", pa.int32()),
                      ("block", pa.int32()), ("node", pa.int64())])
_LINKS = "node long, least long, links long"
_LINKED = pa.schema([("node", pa.int64()), ("least", pa.int64()), ("links", pa.int64())])


def banding(threshold: float, recall: float, most_hashes: int) -> tuple[int, int]:
    """Bands and rows: the most rows whose bands, for the recall wanted, need no more hashes."""
    chosen = (1, 1)
    for rows in range(1, most_hashes + 1):
        meets = threshold ** rows
        bands = 1 if meets >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-meets))
        if bands * rows <= most_hashes or rows == 1:
            chosen = (bands, rows)
    return chosen


def _factors(n: int) -> np.ndarray:
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _band_hashes(found: np.ndarray, first: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band hashes of every row that has shingles, taken a block of shingles at a time."""
    filled = np.flatnonzero(np.diff(first))
    out = np.empty((len(filled), bands), np.uint64)
    factors = _factors(bands * rows)
    at = 0
    while at < len(filled):
        low = first[filled[at]]
        upto = max(at + 1, int(np.searchsorted(first[filled + 1], low + (1 << 17), "right")))
        part = found[low:first[filled[upto - 1] + 1]]
        heads = first[filled[at:upto]] - low
        for band in range(bands):
            total = np.zeros(upto - at, np.uint64)
            for row in range(rows):
                least = np.minimum.reduceat(part * factors[band * rows + row], heads)
                total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + least)
            out[at:upto, band] = total
        at = upto
    return out


def _keys(hashes: np.ndarray, first: np.ndarray) -> list[pa.Array]:
    """Two 64-bit names of the words of every row, which tell texts apart; 0 without words."""
    filled = np.flatnonzero(np.diff(first))
    found = []
    for base in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB):
        key = np.zeros(len(first) - 1, np.uint64)
        key[filled] = _window_sums(hashes, first[filled], first[filled + 1], base)
        found.append(pa.array(key.view(np.int64)))
    return found


def _signer(text: str, n: int, bands: int, rows: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks.pieces(batches, text, TEXT_BYTES):
            hashes, first = word_hashes(table.column(text), NON_WORD, lower=True)
            counts = np.diff(first)
            signed = _band_hashes(*shingles(hashes, first, n), bands, rows).view(np.int64)
            lists = np.concatenate([[0], np.cumsum(np.where(counts > 0, bands, 0))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                *(table.column(c).combine_chunks() for c in ("id", "uid", "uid2")), *_keys(hashes, first),
                pa.array(counts.astype(np.int64)), pa.ListArray.from_arrays(pa.array(lists), pa.array(signed.ravel())),
            ], names=["id", "uid", "uid2", "key1", "key2", "n_words", "bands"])
    return run


def _sets(text: str, n: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks.pieces(batches, text, TEXT_BYTES):
            hashes, words = word_hashes(table.column(text), NON_WORD, lower=True)
            found, first = shingles(hashes, words, n)
            found &= SET_MASK
            blocks = [chunks.coded(np.unique(found[a:b])) for a, b in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays(
                [*_keys(hashes, words), pa.array(blocks, pa.binary())], names=["key1", "key2", "grams"])
    return run


def _shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets, by products of blocks of the incidence matrix."""
    values = np.concatenate(sets)
    owners = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owners = values[order], owners[order]
    heads = np.append(True, values[1:] != values[:-1])
    ids = np.cumsum(heads) - 1
    often = np.bincount(ids)[ids] > 1
    ids, owners = ids[often], owners[often]
    counts = np.zeros((len(sets), len(sets)), np.int64)
    if not len(ids):
        return counts
    ids = np.cumsum(np.append(True, ids[1:] != ids[:-1])) - 1
    for low in range(0, int(ids[-1]) + 1, 8192):
        a, b = np.searchsorted(ids, [low, low + 8192])
        part = np.zeros((len(sets), min(8192, int(ids[-1]) + 1 - low)), np.float32)
        part[owners[a:b], ids[a:b] - low] = 1
        counts += np.rint(part @ part.T).astype(np.int64)
    return counts


def _due(cell: list[dict]) -> np.ndarray:
    """Which pairs of a cell meet here first: they share its band and none before it."""
    bands = np.array([r["bands"] for r in cell])
    band, first, second = cell[0]["band"], cell[0]["i"], cell[0]["j"]
    due = np.zeros((len(cell), len(cell)), bool)
    for x in range(len(cell)):
        due[x] = (bands[x] == bands).argmax(axis=1) == band
    if first != second:
        block = np.array([r["block"] for r in cell])
        due &= block[:, None] != block[None, :]
    np.fill_diagonal(due, False)
    return due


def _meet(cell: list[dict]) -> Iterator[dict]:
    """The texts of a cell that have a pair to verify in it."""
    for x in np.flatnonzero(_due(cell).any(axis=1)).tolist():
        yield {k: cell[x][k] for k in ("band", "bucket", "i", "j", "block", "node")}


def _verify(cell: list[dict], threshold: float) -> Iterator[dict]:
    """Links of the texts of one cell: how many rows each is linked to, and an edge."""
    due = _due(cell)
    sets = [chunks.decoded(r["grams"], np.uint64) for r in cell]
    sizes = np.array([len(s) for s in sets])
    shared = _shared_counts(sets)
    linked = due & (shared >= threshold * (sizes[:, None] + sizes[None, :] - shared) - 1e-9)
    copies = np.array([r["copies"] for r in cell])
    nodes = np.array([r["node"] for r in cell])
    label = nodes.copy()
    hangs = linked.any(axis=1)
    while True:
        seen = np.where(linked, label[None, :], np.iinfo(np.int64).max).min(axis=1)
        new = np.minimum(label, seen)
        if (new == label).all():
            break
        label = new
    for x in np.flatnonzero(hangs).tolist():
        yield {"node": int(nodes[x]), "least": int(label[x]), "links": int(copies[linked[x]].sum())}


def _by_cell(work, schema: pa.Schema):
    """Runs ``work`` on each cell of partitions that are sorted by cell."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, cell, out = None, [], []
        for batch in batches:
            for row in batch.to_pylist():
                key = (row["band"], row["bucket"], row["i"], row["j"])
                if key != name:
                    if len(cell) > 1:
                        out.extend(work(cell))
                    name, cell = key, []
                cell.append(row)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if len(cell) > 1:
            out.extend(work(cell))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    return run


def row_names(text: str, id_column: str) -> tuple[Column, Column]:
    """Two 64-bit names of a row, which together are the same for repeated rows only."""
    own = F.col(id_column), F.col(text)
    return F.xxhash64(*own), F.xxhash64(F.lit(1), *reversed(own))


def with_uid(df: DataFrame, text: str, id_column: str) -> DataFrame:
    """(uid, uid2, id, text)"""
    uid, uid2 = row_names(text, id_column)
    return df.select(uid.alias("uid"), uid2.alias("uid2"), F.col(id_column).alias("id"), F.col(text).alias("text"))


def ngram_join(df: DataFrame, text: str = "text", id_column: str = "doc_id", n: int = N_WORDS,
               threshold: float = THRESHOLD, recall: float = RECALL,
               most_hashes: int = MOST_HASHES) -> DataFrame:
    """One row (uid, uid2, id, class_id, root, copies, n_links) for each row of ``df``.

    Texts are told apart by 128 bits of their words and numbered, so no two share a number. ``root``
    is the number of one text of the class (null without words), ``class_id`` is the least id of all rows that hang together by links, ``copies`` the number
    of rows with the same words, ``n_links`` the number of rows that this one is linked to.
    """
    spark = ship(df.sparkSession)
    bands, rows = banding(threshold, recall, most_hashes)
    source = with_uid(df, text, id_column)

    id_type = source.schema["id"].dataType.simpleString()
    signed = materialize(source.mapInArrow(
        _signer("text", n, bands, rows), f"id {id_type}, {_SIGNED}"), "ngram-signatures")
    worded = signed.where("n_words > 0")
    texts = materialize(worded.groupBy("key1", "key2").agg(
        F.min("uid").alias("uid"), F.count("*").alias("copies")).withColumn(
        "node", F.monotonically_increasing_id()), "ngram-texts")
    nodes = (worded.select("uid", "key1", "key2", "bands").join(texts, ["uid", "key1", "key2"])
             .select("node", "copies", "bands").dropDuplicates(["node"]))
    nodes = materialize(nodes, "ngram-nodes")

    banded = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    shared = banded.groupBy("band", "bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = materialize(banded.join(shared, ["band", "bucket"]), "ngram-buckets")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    cells = (members.withColumn("block", F.pmod(F.xxhash64("node", "band"), blocks).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .select("band", "bucket", F.least("block", "other").alias("i"),
                     F.greatest("block", "other").alias("j"), "block", "node"))
    key = ["band", "bucket", "i", "j"]

    def in_cells(rows: DataFrame) -> DataFrame:
        return rows.repartition(*key).sortWithinPartitions(*key, "node")

    # Most texts of a bucket met in an earlier band; the n-gram sets travel to the first only.
    due = materialize(in_cells(cells.join(nodes.select("node", "bands"), "node")).mapInArrow(
        _by_cell(_meet, _MEETING), _MEETS), "ngram-meetings")
    wanted = materialize(due.select("node").distinct().join(texts, "node"), "ngram-wanted")
    # The number of texts wanted grows with the data, hence no broadcast at any size. A row is found
    # by its uid, and whatever other row has the same falls out by the names of its words.
    grams = (source.select("uid", "text").join(wanted.select("uid").hint("merge"), "uid", "left_semi")
             .mapInArrow(_sets("text", n), "key1 long, key2 long, grams binary")
             .join(wanted.select("node", "key1", "key2").hint("merge"), ["key1", "key2"])
             .select("node", "grams").dropDuplicates(["node"]))
    full = due.join(nodes.join(grams, "node"), "node")
    links = materialize(in_cells(full).mapInArrow(
        _by_cell(lambda cell: _verify(cell, threshold), _LINKED), _LINKS), "ngram-links")

    roots = components(links.select(F.col("node").alias("a"), F.col("least").alias("b")))
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    groups = (texts.join(roots, "node", "left").join(counts, "node", "left")
              .select("key1", "key2", "copies", F.coalesce("root", "node").alias("root"),
                      (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    groups = materialize(groups, "ngram-groups")
    known = (signed.select("id", "uid", "uid2", "key1", "key2", "n_words")
             .join(groups, ["key1", "key2"], "left")
             .select("id", "uid", "uid2", F.when(F.col("n_words") > 0, F.col("root")).alias("root"),
                     F.when(F.col("n_words") > 0, F.col("copies")).otherwise(1).alias("copies"),
                     F.when(F.col("n_words") > 0, F.col("n_links")).otherwise(0).alias("n_links")))
    known = materialize(known, "ngram-rows")
    least = known.where("root IS NOT NULL").groupBy("root").agg(F.min("id").alias("least"))
    return known.join(materialize(least, "ngram-classes"), "root", "left").select(
        "uid", "uid2", "id", F.coalesce("least", "id").alias("class_id"), "root", "copies", "n_links")


def distinct_documents(df: DataFrame, text: str = "text", id_column: str = "doc_id", **options) -> DataFrame:
    """One row of each class of ``ngram_join``: the one with the least id (then uid), as it is.

    Rows that do not link to anything stay, also if they have no words; of rows that are equal
    in id and text one stays.
    """
    joined = ngram_join(df, text, id_column, **options)
    same = joined.where("n_links > 0").groupBy("root", "uid", "uid2", "id").agg(F.count("*").alias("n"))
    best = same.groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "uid", "uid2", "n")).alias("best")).select(
        "best.uid", "best.uid2", "best.n")
    kept = joined.where("n_links = 0").select("uid", "uid2", F.lit(1).alias("n")).distinct().unionByName(best)
    kept = materialize(kept.select(*[F.col(c).alias(f"_kept_{c}") for c in kept.columns]), "ngram-kept")
    rows = (df.withColumns(dict(zip(("_row_uid", "_row_uid2"), row_names(text, id_column))))
            .join(kept.hint("merge"), (F.col("_row_uid") == F.col("_kept_uid"))  # grows with the rows
                  & (F.col("_row_uid2") == F.col("_kept_uid2"))))
    rows = rows.where("_kept_n = 1").unionByName(
        rows.where("_kept_n > 1").dropDuplicates(["_row_uid", "_row_uid2"]))
    return rows.select(*[rows[f"`{c}`"] for c in df.columns])
