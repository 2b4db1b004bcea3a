"""Conversations in reply order, without quotations.

1. Every message is parsed into its own lines and quoted lines, by depth of ``>`` marks. What
   introduces a quotation goes with it: a line like "... wrote:", or up to three lines of one paragraph
   that end in a colon and hold a mail address or the numbers of a date.
2. Quoted lines of one level that follow each other are a passage. It is normalised (white space
   over line ends, case) and every window of WORDS words, or all of a shorter passage, is hashed,
   and every single line. They are joined to the windows and lines of the own texts of the same
   conversation, of which only the sizes asked for there are made: each finds the latest earlier
   message that has it. The message that the outermost quotation shares most characters with,
   counted window by window, is the parent; without a match it is the message before.
3. Messages that follow each other without going back form a run. A run that quotes an earlier
   message hangs below it. ``place`` numbers a conversation depth first: a run, then the runs that
   go back into it, those that go back least first.

"Latest earlier" is found in buckets of SPAN turns and then across the buckets, so a conversation,
or a line, that a third of all rows share is many small groups, and no pairs of messages are made.
The runs of all conversations that have several are one list of steps into and out of each, which
``list_rank`` gives places: what is stored grows with the runs, however deep they nest. Messages
are numbered after one sort by ranges, equal ones by a number of their own, so neither a
conversation nor a turn (or the lack of one) meets in one task.

Nothing is taken out of a message for which no original was found: its text stays whole, marks
and all, as a prompt or a shell session may look like a quotation.

Defined results: a null or empty text stays as it is and quotes nothing; a message of found quotations
only has an empty text; a null conversation is one conversation; messages without a turn come
last; messages of the same turn stand next to each other, by role and text, have one parent and
never quote each other; repeated rows get a place each; an empty table gives an empty result;
extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tidegrid.llm.list_rank import places
from tidegrid.llm.prefix_trie import numbered
from tidegrid.llm.shipping import ship
from tidegrid.session import materialize

SPAN = 1024
PLACE_SPAN = 1 << 16
WORDS = 5
SALTS = 64
NO_TURN = (1 << 62)
INTRODUCTION_LINES = 3
OWNED = 50_000

_MARKS = re.compile(r"\s*((?:>\s?)+)(.*)", re.S)
_INTRODUCTION = re.compile(r".*\b(?:wrote|writes|said|schrieb|a écrit|escribió)\s*:\s*", re.I | re.S)
_DATED = re.compile(r"\S@\S|\d\D+\d+\D+\d")
_WORD = re.compile(r"[\u2e80-\u9fff\uac00-\ud7af\uf900-\ufaff]|[^\s\u2e80-\u9fff\uac00-\ud7af\uf900-\ufaff]+")
_UNIT = StructType([StructField("level", LongType()), StructField("words", LongType()),
                    StructField("hash", LongType()), StructField("size", LongType())])


def _hashed(line: str) -> int:
    return xxhash.xxh64_intdigest(line.encode("utf-8", "surrogatepass")) - (1 << 63)


def _line(line: str) -> tuple[int, int]:
    plain = " ".join(line.split()).lower()
    return _hashed(plain), len(plain) + 1  # a whole line goes before as many words elsewhere


def _windows(text: str, n: int) -> Iterator[tuple[int, int]]:
    """(hash, size) of every window of ``n`` words; an ideograph is a word."""
    words = _WORD.findall(text.lower())
    for p in range(len(words) - n + 1):
        window = " ".join(words[p:p + n])
        yield _hashed(f"\0{n}\0{window}"), len(window)


def own_units(text: str, sizes: Iterable[int]) -> set[int]:
    """Hashes of the windows of so many words, and for size 0 of the lines, of an own text."""
    found = {h for n in sizes if n for h, _ in _windows(text, n)}
    if 0 in sizes:
        found.update(_line(line)[0] for line in text.split("\n") if line.strip())
    return found


def _introduction(own: list[str]) -> int:
    """How many of the last lines introduce a quotation."""
    if not own or not own[-1].rstrip().endswith(":"):
        return 0
    lines: list[str] = []
    for line in reversed(own[-INTRODUCTION_LINES:]):
        if not line.strip():
            break
        lines.insert(0, line)
        if _DATED.search(" ".join(lines)):
            return len(lines)
    return int(_INTRODUCTION.fullmatch(own[-1]) is not None)


def parsed(text: str) -> tuple[str, list[tuple[int, int, int, int]]]:
    """The text without quotations, and (level, words, hash, size) of what is quoted; lines have 0 words."""
    own: list[str] = []
    passages: list[tuple[int, list[str]]] = []
    quoted, level = False, 0
    for line in text.split("\n"):
        found = _MARKS.fullmatch(line)
        if found:
            while not quoted and own and not own[-1].strip():
                own.pop()
            if not quoted:
                del own[len(own) - _introduction(own):]
            if found[2].strip():
                if level != found[1].count(">"):
                    level = found[1].count(">")
                    passages.append((level, []))
                passages[-1][1].append(found[2])
            quoted = True
        else:
            quoted, level = False, 0
            own.append(line)
    units: list[tuple[int, int, int, int]] = []
    for level, lines in passages:
        units.extend((level, 0, *_line(line)) for line in lines)
        passage = "\n".join(lines)
        n = min(WORDS, len(_WORD.findall(passage)))
        units.extend((level, n, *unit) for unit in _windows(passage, n))
    return ("\n".join(own).strip() if passages or len(own) < text.count("\n") + 1 else text), units


def _parser(schema: pa.Schema):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(None, []) if t is None else parsed(t) for t in batch.column("text").to_pylist()]
            bodies = pa.array([b for b, _ in found], pa.string())
            texts = batch.column("text").to_pylist()
            whole = pa.array([t if t != b else None for t, (b, _) in zip(texts, found)], pa.string())
            units = pa.array([[dict(zip(_UNIT.names, x)) for x in own] for _, own in found],
                             schema.field("units").type)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("conv_id", "conv", "turn", "at", "role")] + [bodies, whole, units],
                schema=schema)
    return run


def _owner(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in held], kind) for i, kind in enumerate((pa.string(), pa.int64(), pa.int64()))],
            names=["conv", "at", "hash"])

    held: list[tuple] = []
    for batch in batches:
        for conv, at, text, sizes in zip(*(batch.column(c).to_pylist() for c in ("conv", "at", "text", "sizes"))):
            held += [(conv, at, unit) for unit in sorted(own_units(text, sizes))]
            if len(held) >= OWNED:
                yield out(held)
                held = []
    if held:
        yield out(held)


def latest(rows: DataFrame, keys: list[str], at: str, value: Column, name: str, own: bool) -> DataFrame:
    """Adds the largest ``value`` among the rows of the same keys at a smaller (or equal) ``at``.

    ``value`` has to grow with ``at``. Buckets of SPAN keep hot keys apart.
    """
    rows = rows.withColumn("_value", value).withColumn("_bucket", F.floor(F.col(at) / SPAN))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(at).rangeBetween(
        Window.unboundedPreceding, 0 if own else -1)
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = (rows.groupBy(*keys, "_bucket").agg(F.max("_value").alias("_value"))
               .select(*keys, "_bucket", F.max("_value").over(before).alias("_carried")))
    found = rows.withColumn("_inside", F.max("_value").over(inside)).join(carried, [*keys, "_bucket"])
    return found.withColumn(name, F.greatest("_inside", "_carried")).drop(
        "_value", "_bucket", "_inside", "_carried")


def linked(messages: DataFrame) -> DataFrame:
    """(conv, at, link): the earlier message that a message quotes, if one is found."""
    units = materialize(messages.select("conv", "at", F.explode("units").alias("unit")).select("conv", "at", "unit.*"),
                        "quote-units")
    salts = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    sizes = units.groupBy("conv").agg(F.collect_set("words").alias("sizes"))
    asked = messages.where("text IS NOT NULL").select(
        "conv", "at", "text", F.pmod(F.xxhash64("at", "text"), F.lit(SALTS)).alias("salt")).join(
        sizes.withColumn("salt", F.explode(salts)), ["conv", "salt"]).select("conv", "at", "text", "sizes")
    own = asked.mapInArrow(_owner, "conv string, at long, hash long").join(
        units.select("conv", "hash").distinct(), ["conv", "hash"], "left_semi")
    seen = units.select("conv", "hash", "at", "level", "size", F.lit(False).alias("original")).unionByName(
        own.select("conv", "hash", "at", F.lit(None).cast("long").alias("level"),
                   F.lit(None).cast("long").alias("size"), F.lit(True).alias("original")))
    seen = seen.groupBy("conv", "hash", "at").agg(
        F.max("original").alias("original"), F.min("level").alias("level"), F.max("size").alias("size"))
    found = latest(seen, ["conv", "hash"], "at", F.when(F.col("original"), F.col("at")), "source", own=False)
    votes = found.where("level IS NOT NULL AND source IS NOT NULL").groupBy("conv", "at", "level", "source").agg(
        F.sum("size").alias("size"))
    best = F.max(F.struct((-F.col("level")).alias("near"), "size", "source")).alias("best")
    return votes.groupBy("conv", "at").agg(best).select("conv", "at", F.col("best.source").alias("link"))


def _tour(runs: DataFrame) -> DataFrame:
    """Steps into (2 no) and out of (2 no + 1) each numbered run as a linked list, depth first."""
    kids = runs.where("hangs").groupBy("conv", "above").agg(F.min("no").alias("first"), F.count("*").alias("n"))
    runs = materialize(runs.join(kids.withColumnRenamed("above", "run"), ["conv", "run"], "left"), "quote-hanging")
    n_roots = runs.where("NOT hangs").count()
    near = [F.col("mixed").alias("a"), F.col("run").alias("b")]
    out = F.col("no") * 2 + 1
    down = runs.select((F.col("no") * 2).alias("element"), F.coalesce(F.col("first") * 2, out).alias("next"), *near)
    last = runs.where("n > 0").select((F.col("first") + F.col("n") - 1).alias("no"), out.alias("up"))
    ends = ~F.col("hangs") & (F.col("no") == n_roots - 1)
    up = runs.join(last, "no", "left").select(
        out.alias("element"),
        F.when(ends, F.lit(-1).cast("long")).otherwise(F.coalesce("up", F.col("no") * 2 + 2)).alias("next"), *near)
    return down.unionByName(up)


def preorder(runs: DataFrame) -> DataFrame:
    """(conv, run, rank, depth) of the runs of conversations with several: ranks ascend depth first.

    Takes (conv, run, link, above): the message a run quotes and the run it is in, null for the first.
    """
    several = runs.groupBy("conv").agg(F.count("*").alias("n")).where("n > 1").select("conv")
    forest = runs.join(several, "conv", "left_semi").select(
        "conv", "run", "above", F.col("above").isNotNull().alias("hangs"), (-F.col("link")).alias("back"),
        F.xxhash64("conv").alias("mixed"))
    order = ["hangs", "mixed", "conv", "above", "back", "run"]
    forest = numbered(forest, order, [], [F.col(c) for c in order], "quote-runs")
    forest = materialize(forest.withColumnRenamed("place", "no"), "quote-runs")

    steps = places(_tour(forest)).select(
        "element", "place", F.floor(F.col("place") / PLACE_SPAN).alias("span"),
        F.when(F.col("element") % 2 == 0, 1).otherwise(-1).cast("long").alias("deeper"))
    steps = materialize(steps, "quote-steps")
    before = (Window.unboundedPreceding, -1)
    carried = materialize(steps.groupBy("span").agg(F.sum("deeper").alias("deeper")).select(
        "span", F.coalesce(F.sum("deeper").over(Window.orderBy("span").rowsBetween(*before)), F.lit(0)).alias("carried")),
        "quote-spans")
    inside = F.sum("deeper").over(Window.partitionBy("span").orderBy("place").rowsBetween(*before))
    ranks = steps.withColumn("inside", F.coalesce(inside, F.lit(0))).join(carried, "span").where(
        "element % 2 = 0").select(F.shiftright("element", 1).alias("no"), F.col("place").alias("rank"),
                                  (F.col("carried") + F.col("inside")).alias("depth"))
    return forest.join(ranks, "no").select("conv", "run", "rank", "depth")


def reply_ordered(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, parent_turn, quotes, depth, place) for every message."""
    ship(df.sparkSession)
    source = df.select(
        F.col(conversation).alias("conv_id"),
        F.coalesce(F.concat(F.lit("c"), F.col(conversation).cast("string")), F.lit("-")).alias("conv"),
        F.col(turn).alias("turn"), F.coalesce(F.col(turn).cast("long"), F.lit(NO_TURN)).alias("at"),
        F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text"))
    kind = StructType([*(source.schema[c] for c in ("conv_id", "conv", "turn", "at", "role")),
                       StructField("text", StringType()), StructField("whole", StringType()),
                       StructField("units", ArrayType(_UNIT))])
    messages = materialize(source.mapInArrow(_parser(to_arrow_schema(kind)), kind), "quote-messages")

    turns = messages.select("conv", "at").distinct()
    turns = latest(turns, ["conv"], "at", F.col("at"), "before", own=False).join(
        linked(messages), ["conv", "at"], "left")
    goes_back = F.col("link").isNotNull() & (F.col("link") != F.col("before"))
    turns = turns.withColumn("begins", F.when(goes_back | F.col("before").isNull(), F.col("at")))
    turns = materialize(latest(turns, ["conv"], "at", F.col("begins"), "run", own=True), "quote-turns")

    runs = turns.where("begins IS NOT NULL").select("conv", "run", "link")
    targets = turns.select("conv", F.col("at").alias("link"), F.col("run").alias("above"))
    ranks = materialize(preorder(runs.join(targets, ["conv", "link"], "left")), "quote-ranks")

    rows = messages.join(turns.select("conv", "at", "before", "link", "run"), ["conv", "at"]).join(
        ranks, ["conv", "run"], "left")
    zero = F.lit(0).cast("long")
    rows = materialize(rows.withColumns({
        "rank": F.coalesce("rank", zero), "depth": F.coalesce("depth", zero),
        "tie": F.monotonically_increasing_id()}), "quote-rows")
    order = ["conv", "rank", "at", "role", "text", "tie"]
    placed = numbered(rows, order, ["conv"], [F.col(c) for c in (
        "conv", "conv_id", "turn", "role", "text", "whole", "before", "link", "depth")], "quote-placed")
    parent = F.coalesce("link", "before")
    text_left = F.when(F.col("link").isNull(), F.coalesce("whole", "text")).otherwise(F.col("text"))
    return placed.select(
        "conv_id", "turn", "role", text_left.alias("text"),
        F.when(parent < NO_TURN, parent).alias("parent_turn"), F.col("link").isNotNull().alias("quotes"),
        "depth", "place")
