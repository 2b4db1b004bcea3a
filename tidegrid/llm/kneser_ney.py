"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model's symbols are characters: code points up to 2,045 as they are (controls as a space), all
others by hash on 2,046 more, and a mark for the end of a text. A symbol is predicted from the
ORDER - 1 before it. Texts of trusted rows give the counts of the highest order; lower orders
count the distinct symbols that precede. Each order has its own three discounts.

1. Texts are dealt to buckets by hash of id and text, compressed, and meet the trusted ids there.
   Each bucket tells its distinct n-grams and how often trusted texts have them.
2. Spark sums the counts over the buckets and joins n-grams, contexts and suffixes, order by
   order, into a table of the probabilities of all n-grams of the corpus. Nothing is broadcast.
3. Each bucket gets the probabilities of its own n-grams and scores its texts.
4. A row is kept if its perplexity lies between the LOW and HIGH quantiles of the trusted rows of
   its language.

No text is judged by a model that has seen it: texts belong to FOLDS folds by a hash, copies to the
same, and a text is scored by the model of the trusted texts of the other folds, trusted or not. So a
trusted row that is held out fares like one that is not.

All texts are read whole; what is gathered grows with the buckets, hence with the input. A hot id
is dealt over SALTS buckets.

Defined results: a null text counts as empty, and an empty text is its end mark; a null or
unknown language, or one without trusted rows, sets no thresholds and its rows are kept; a null id
is never trusted; repeated rows are scored each, and count each if trusted; without trusted rows in other folds
all symbols are equally likely; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from tidegrid.llm import chunks
from tidegrid.llm.shipping import ship
from tidegrid.session import materialize

ORDER = 4
BITS = 12
SYMBOLS = 1 << BITS
BUCKET_BYTES = 32 << 20
PIECE_BYTES = 16 << 20
SALTS = 8
LOW, HIGH = 0.001, 0.995
ACCURACY = 100_000

FOLDS = 2

_PAYLOAD = "bucket long, payload binary"
_N = [f"n{fold}" for fold in range(FOLDS)]
_GRAMS = ", ".join(["bucket long, gram long", *(f"{n} long" for n in _N)])


def fold_of(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) % FOLDS


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Key of the n-gram that ends with each symbol, and the number of symbols before each text."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    symbols = np.where(points < 32, np.uint64(32), points)
    far = points > 2045
    spread = (points[far] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
    symbols[far] = 2046 + spread % np.uint64(2046)
    sizes = np.array([len(t) for t in texts], np.int64)
    pad = ORDER - 1
    # each text: pads (0), its symbols, its end (1)
    first = np.concatenate([[0], np.cumsum(sizes + 1)])
    padded = np.zeros(int(first[-1]) + pad * len(texts), np.uint64)
    text_of = np.repeat(np.arange(len(texts)), sizes)
    places = np.arange(len(points)) + text_of * (pad + 1) + pad
    padded[places] = symbols + np.uint64(2)
    ends = first[1:] - 1 + pad * np.arange(1, len(texts) + 1)
    padded[ends] = 1
    told = np.sort(np.concatenate([places, ends]))
    key = np.zeros(len(told), np.uint64)
    for back in range(pad, -1, -1):
        key = (key << np.uint64(BITS)) | padded[told - back]
    return key.view(np.int64), first


def _parts(column: pa.ChunkedArray, most: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    """A text column in runs of some ``most`` characters: the first row and the texts."""
    texts, held, size, begun = [t or "" for t in column.to_pylist()], [], 0, 0
    for i, t in enumerate(texts):
        held.append(t)
        size += len(t)
        if size >= most:
            yield begun, held
            held, size, begun = [], 0, i + 1
    if held:
        yield begun, held


def _packer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("bucket", pa.int64()), ("payload", pa.binary())])
    for table in chunks.pieces(batches, "text", PIECE_BYTES):
        buckets = table.column("bucket").to_numpy()
        order = np.argsort(buckets, kind="stable")
        table, buckets = table.drop_columns(["bucket"]).take(pa.array(order)), buckets[order]
        heads = np.flatnonzero(np.append(True, buckets[1:] != buckets[:-1]))
        for a, b in zip(heads, np.append(heads[1:], len(buckets))):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as out:
                out.write_table(table.slice(a, b - a).combine_chunks())
            payload = zstandard.compress(sink.getvalue(), 9)
            yield pa.RecordBatch.from_pylist([{"bucket": int(buckets[a]), "payload": payload}], schema)


def _merged(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    names, place = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
    counts = np.concatenate([c for _, c in found], axis=1)
    return names, np.stack([np.bincount(place, own, len(names)) for own in counts]).astype(np.int64)


def _count(own: pa.Table, trusted: pa.Table) -> pa.Table:
    """Distinct n-grams of a bucket, and for each fold how often trusted texts of the others have them."""
    known = set(trusted.column("id").to_pylist())
    total: list[tuple[np.ndarray, np.ndarray]] = []
    for payload in own.column("payload").to_pylist():
        table = chunks.unpacked(payload)
        ids = table.column("id").to_pylist()
        for begun, texts in _parts(table.column("text")):
            keys, first = ngrams(texts)
            fold = np.array([fold_of(t) if i in known else -1 for i, t in zip(ids[begun:], texts)])
            names, place = np.unique(keys, return_inverse=True)
            counted = [np.repeat((fold >= 0) & (fold != k), np.diff(first)) for k in range(FOLDS)]
            total.append((names, np.stack([np.bincount(place, c, len(names)) for c in counted])))
            if len(total) > 16:
                total = [_merged(total)]
    schema = pa.schema([("bucket", pa.int64()), ("gram", pa.int64()), *((n, pa.int64()) for n in _N)])
    if not total:
        return schema.empty_table()
    names, counts = _merged(total)
    bucket = own.column("bucket")[0].as_py()
    return pa.table([pa.array(np.full(len(names), bucket)), pa.array(names), *map(pa.array, counts)], schema=schema)


def _scorer(schema: pa.Schema):
    def run(own: pa.Table, known: pa.Table) -> pa.Table:
        grams = known.column("gram").to_numpy()
        order = np.argsort(grams)
        grams, logs = grams[order], np.stack([known.column(f"log_{n}").to_numpy()[order] for n in _N])
        done = [schema.empty_table()]
        for payload in own.column("payload").to_pylist():
            table = chunks.unpacked(payload)
            n, total = np.zeros(table.num_rows, np.int64), np.zeros(table.num_rows)
            for begun, texts in _parts(table.column("text")):
                keys, first = ngrams(texts)
                place = np.minimum(np.searchsorted(grams, keys), max(0, len(grams) - 1))
                if not len(grams) or (grams[place] != keys).any():
                    raise ValueError("the input gave other rows when it was read again; store it first")
                n[begun:begun + len(texts)] = np.diff(first)
                fold = np.repeat([fold_of(t) for t in texts], np.diff(first))
                total[begun:begun + len(texts)] = np.add.reduceat(logs[fold, place], first[:-1])
            done.append(pa.table([table.column("id"), table.column("lang"), pa.array(n),
                                  pa.array(np.exp(-total / n))], schema=schema))
        return pa.concat_tables(done)
    return run


def _suffix(column: str, order: int) -> Column:
    return F.col(column).bitwiseAND(F.lit((1 << (BITS * order)) - 1))


def _discounts(counts: DataFrame) -> list[float]:
    """The three discounts of an order, from how many n-grams occur one to four times."""
    n = counts.agg(*(F.coalesce(F.sum((F.col("n") == k).cast("long")), F.lit(0)).alias(f"n{k}")
                     for k in (1, 2, 3, 4))).first()
    found = []
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    for k in (1, 2, 3):
        d = k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else 0.5 * k
        found.append(min(max(d, 0.0), float(k)))
    return found


def probabilities(counts: DataFrame) -> DataFrame:
    """(gram, log_p) for all n-grams of ``counts`` (gram, n): n is the trusted count, or 0."""
    tables = {ORDER: counts.where("n > 0").select("gram", "n")}
    for k in range(ORDER - 1, 0, -1):
        tables[k] = materialize(tables[k + 1].groupBy(_suffix("gram", k).alias("gram")).agg(
            F.count("*").alias("n")), f"kn-counts-{k}")
    asked = {ORDER: counts.select("gram")}
    for k in range(ORDER - 1, 0, -1):
        asked[k] = materialize(asked[k + 1].select(_suffix("gram", k).alias("gram")).distinct(), f"kn-asked-{k}")

    lower = None
    for k in range(1, ORDER + 1):
        d1, d2, d3 = _discounts(tables[k])
        n = F.col("n")
        discount = F.when(n == 1, d1).when(n == 2, d2).otherwise(d3)
        context = F.shiftright("gram", BITS) if k > 1 else F.lit(0).cast("long")
        contexts = tables[k].groupBy(context.alias("context")).agg(
            F.sum("n").alias("total"), F.sum(discount).alias("freed"))
        found = (asked[k].join(tables[k], "gram", "left").withColumn("context", context)
                 .join(contexts, "context", "left"))
        if lower is None:
            found = found.withColumn("p_low", F.lit(1.0 / SYMBOLS))
        else:
            found = found.withColumn("suffix", _suffix("gram", k - 1)).join(
                lower.select(F.col("gram").alias("suffix"), F.col("p").alias("p_low")), "suffix")
        seen = F.coalesce(F.greatest(n - discount, F.lit(0.0)), F.lit(0.0))
        p = F.coalesce(seen / F.col("total") + F.col("freed") / F.col("total") * F.col("p_low"), F.col("p_low"))
        lower = materialize(found.select("gram", p.alias("p")), f"kn-p-{k}")
    return lower.select("gram", F.log("p").alias("log_p"))


def score(df: DataFrame, trusted: DataFrame, text: str = "text", id_column: str = "doc_id",
          lang: str = "lang", trusted_id: str = "doc_id") -> DataFrame:
    """(id, lang, n_symbols, perplexity, low, high, keep) for every row of ``df``."""
    ship(df.sparkSession)
    size = df.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    buckets = F.lit(size // BUCKET_BYTES + 2)
    source = df.select(F.col(id_column).alias("id"), F.col(lang).cast("string").alias("lang"),
                       F.col(text).cast("string").alias("text"))
    salt = F.pmod(F.xxhash64("text"), F.lit(SALTS))
    packed = source.withColumn("bucket", F.pmod(F.xxhash64("id", salt), buckets)).mapInArrow(
        _packer, _PAYLOAD).groupBy("bucket")
    salts = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    ids = trusted.select(F.col(trusted_id).cast(source.schema["id"].dataType).alias("id")).where(
        "id IS NOT NULL").distinct()
    by_bucket = ids.select("id", F.explode(salts).alias("salt")).select(
        F.pmod(F.xxhash64("id", "salt"), buckets).alias("bucket"), "id").distinct()

    told = materialize(packed.cogroup(by_bucket.groupBy("bucket")).applyInArrow(_count, _GRAMS), "kn-grams")
    counts = materialize(told.groupBy("gram").agg(*[F.sum(n).alias(n) for n in _N]), "kn-counts")
    replies = told.select("bucket", "gram")
    for n in _N:
        logs = probabilities(counts.select("gram", F.col(n).alias("n"))).withColumnRenamed("log_p", f"log_{n}")
        replies = replies.join(logs, "gram")
    result = StructType([source.schema["id"], source.schema["lang"], StructField("n_symbols", LongType()),
                         StructField("perplexity", DoubleType())])
    scores = materialize(packed.cogroup(replies.groupBy("bucket")).applyInArrow(
        _scorer(to_arrow_schema(result)), result), "kn-scores")

    limits = scores.join(ids, "id", "left_semi").where("lang IS NOT NULL").groupBy("lang").agg(
        F.percentile_approx("perplexity", [LOW, HIGH], ACCURACY).alias("q"))
    limits = materialize(limits.select("lang", F.col("q")[0].alias("low"), F.col("q")[1].alias("high")), "kn-limits")
    return scores.join(limits, "lang", "left").select(
        "id", "lang", "n_symbols", "perplexity", "low", "high",
        F.coalesce(F.col("perplexity").between(F.col("low"), F.col("high")), F.lit(True)).alias("keep"))
