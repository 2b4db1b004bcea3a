"""Language identification with error-correcting output codes.

Every language has a codeword. For each bit of the codewords a binary classifier tells the
languages with a one from those with a zero, by the bytes of the text: the log ratio of smoothed
frequencies of hashed byte n-grams, averaged over the languages on either side. The language
whose codeword has the least loss, logistic and weighted by how far apart the two sides of each
bit are, is the answer; answers that hardly beat the next one are flagged as ambiguous.

Training reads whole texts of a sample of labelled rows, MOST_ROWS in the mean, drawn by hash;
counts are summed by Spark, and the model has (languages x ORDERS x BUCKETS) numbers, which is
all that reaches the driver. Prediction reads every whole text and needs no shuffle.

Defined results: a null text, or one without a letter, is ``und`` with score 0, and so is any
text if nothing is labelled; with one language that is the answer; a null label never trains;
repeated rows are answered alike; extra columns are handed on, and those with the name of a
result column are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from tidegrid.llm import chunks
from tidegrid.llm.shipping import ship
from tidegrid.llm.words import NON_WORD, flat

ORDERS = (2, 3, 4)
BUCKETS = 1 << 16
MOST_ROWS = 20_000
SMOOTHING = 0.5
EVIDENCE = 0.25  # share of an n-gram's log ratio that counts: neighbours overlap
CLEAR = 0.1  # lead over the next language below which an answer is ambiguous
UNDETERMINED = "und"
_BLOCK = 1 << 19

_RESULT = [StructField("lang_pred", StringType()), StructField("score", DoubleType()),
           StructField("ambiguous", BooleanType())]

_FOLD = np.where(NON_WORD, 32, np.arange(256)).astype(np.uint8)
_FOLD[48:58] = 32


def codebook(n: int) -> np.ndarray:
    """A codeword of ones and minus ones for each of n languages.

    All splits of the languages in two, for up to seven of them; a fixed pseudo-random choice
    of 15 splits for each doubling beyond.
    """
    if n < 2:
        return np.ones((n, 1))
    if n <= 7:
        columns = [(0, *rest) for rest in itertools.product((0, 1), repeat=n - 1) if any(rest)]
    else:
        draw, columns = np.random.default_rng(n), []
        while len(columns) < 15 * int(np.ceil(np.log2(n))):
            column = draw.integers(0, 2, n)
            if 0 < column.sum() < n:
                columns.append(tuple(column))
    return 2.0 * np.array(columns).T - 1


def _grams(data: np.ndarray, order: int, low: int, high: int) -> np.ndarray:
    """Buckets of the n-grams that begin at data[low:high]; those past the end hold zeros."""
    value = np.zeros(high - low, np.uint64)
    for k in range(order):
        part = data[low + k:high + k].astype(np.uint64)
        value[:len(part)] |= part << np.uint64(8 * k)
    value *= np.uint64(0x9E3779B97F4A7C15)
    return (value >> np.uint64(48)).astype(np.int64)


def _folded(column) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = flat(column, lower=True)
    return _FOLD[data], offsets


def _within(offsets: np.ndarray, low: int, high: int, order: int) -> np.ndarray:
    """Which n-grams that begin at low to high end in the row in which they begin."""
    at = np.arange(low, high)
    return offsets[np.searchsorted(offsets, at, "right")] - at >= order


def _counter(text: str, lang: str):
    schema = pa.schema([("lang", pa.string()), ("feature", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for name in pc.unique(table.column(lang)).to_pylist():
                data, offsets = _folded(table.filter(pc.equal(table.column(lang), name)).column(text))
                total = totals.setdefault(name, np.zeros(len(ORDERS) * BUCKETS, np.int64))
                for i, order in enumerate(ORDERS):
                    for low in range(0, len(data), _BLOCK):
                        high = min(low + _BLOCK, len(data))
                        grams = _grams(data, order, low, high)[_within(offsets, low, high, order)]
                        total[i * BUCKETS:(i + 1) * BUCKETS] += np.bincount(grams, minlength=BUCKETS)
        for name, total in totals.items():
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(used), pa.string()), pa.array(used), pa.array(total[used])], schema=schema)
    return run


class Model:
    """Codewords, the classifier of each bit, and the weight of each bit."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        if not languages:
            return
        self.code = codebook(len(languages))
        share = counts.reshape(len(languages), len(ORDERS), BUCKETS) + SMOOTHING
        share = (share / share.sum(axis=2, keepdims=True)).reshape(len(languages), -1)
        sides = [np.stack([share[self.code[:, b] == s].mean(axis=0) if (self.code[:, b] == s).any()
                           else share.mean(axis=0) for b in range(self.code.shape[1])]) for s in (1, -1)]
        ratio = np.log(sides[0]) - np.log(sides[1])
        apart = ((sides[0] - sides[1]) * ratio).sum(axis=1) + 1e-9
        self.bit_weights = apart / apart.sum()
        self.ratios = np.ascontiguousarray((EVIDENCE * ratio.T).astype(np.float32))

    def margins(self, column) -> np.ndarray:
        """The classifiers' log ratios for every text."""
        data, offsets = _folded(column)
        found = np.zeros((len(offsets) - 1, self.ratios.shape[1]))
        for i, order in enumerate(ORDERS):
            for low in range(0, len(data), _BLOCK):
                high = min(low + _BLOCK, len(data))
                values = self.ratios[i * BUCKETS + _grams(data, order, low, high)]
                values[~_within(offsets, low, high, order)] = 0
                rows = np.flatnonzero((offsets[:-1] < high) & (offsets[1:] > low))
                heads = np.maximum(offsets[rows], low) - low
                found[rows] += np.add.reduceat(values, heads, axis=0, dtype=np.float64)
        return found

    def predict(self, column: pa.ChunkedArray) -> tuple[list[str], np.ndarray, np.ndarray]:
        lettered = pc.match_substring_regex(pc.fill_null(column.cast(pa.large_string()), ""), r"\p{L}")
        lettered = lettered.to_numpy()
        if not self.languages:
            return [UNDETERMINED] * len(column), np.zeros(len(column)), np.zeros(len(column), bool)
        margins = self.margins(column)
        loss = np.zeros((len(column), len(self.languages)))
        for word, i in zip(self.code, range(len(self.languages))):
            loss[:, i] = np.logaddexp(0, -word * margins) @ self.bit_weights
        chance = np.exp(loss.min(axis=1, keepdims=True) - loss)
        chance /= chance.sum(axis=1, keepdims=True)
        best = chance.argmax(axis=1)
        score = chance.max(axis=1)
        lead = score - np.sort(chance, axis=1)[:, -2] if len(self.languages) > 1 else score
        names = [self.languages[b] if known else UNDETERMINED for b, known in zip(best, lettered)]
        return names, np.where(lettered, score, 0.0), (lead < CLEAR) & lettered


def train(df: DataFrame, labelled: Column, text: str = "text", lang: str = "lang",
          key: str = "doc_id", most_rows: int = MOST_ROWS) -> Model:
    """A model of the rows for which ``labelled`` holds; ``key`` and text draw the sample."""
    spark = ship(df.sparkSession)
    rows = df.where(labelled & F.col(lang).isNotNull() & F.col(text).isNotNull())
    n = rows.count()
    if n > most_rows:
        draw = F.pmod(F.xxhash64(key, text), F.lit(1 << 30)) / (1 << 30)
        rows = rows.where(draw < most_rows / n)
    counts = (rows.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
              .mapInArrow(_counter("text", "lang"), "lang string, feature long, n long")
              .groupBy("lang", "feature").agg(F.sum("n").alias("n")))
    found = counts.toArrow()
    names = found.column("lang").to_pylist()
    languages = sorted(set(names))
    place = {name: i for i, name in enumerate(languages)}
    matrix = np.zeros((len(languages), len(ORDERS) * BUCKETS))
    matrix[[place[x] for x in names], found.column("feature").to_numpy()] = found.column("n").to_numpy()
    return Model(languages, matrix)


def identify(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``df`` with ``lang_pred``, ``score`` (0 to 1) and ``ambiguous``."""
    spark = ship(df.sparkSession)
    names = {f.name for f in _RESULT}
    result = StructType([f for f in df.schema.fields if f.name not in names] + _RESULT)
    schema = to_arrow_schema(result)
    shared = spark.sparkContext.broadcast(model)  # its size is fixed by the constants above

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks.pieces(batches, text, 2 << 20):
            predicted, score, ambiguous = shared.value.predict(table.column(text))
            extra = {"lang_pred": pa.array(predicted, pa.string()), "score": pa.array(score),
                     "ambiguous": pa.array(ambiguous)}
            columns = [extra[f.name] if f.name in extra else table.column(f.name).combine_chunks().cast(f.type)
                       for f in schema]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
    return df.mapInArrow(run, result)
