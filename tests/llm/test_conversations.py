"""Conversation repair, prefix trie and byte-level BPE against brute force."""

import collections
import functools
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm_helpers import SF, documents, prose, words  # noqa: F401
from tidegrid.llm import bpe, conversation_repair, list_rank, prefix_trie, queries, repair_grammar

CONVERSATION = "conv_id long, turn long, role string, text string"
BYTE_BPE = public_tokenizers.path(queries.BYTE_TOKENIZER)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def by_turn(row):
    return (row[1] is not None, row[1] or 0, row[2] or "", row[3] or "")


@pytest.fixture
def odd(spark, prose):  # noqa: F811
    rows = [(None, 1, "user", "No number."), (None, None, "assistant", "x."), (7, None, None, None),
            (7, 1, "user", prose(5000, 1)), (8, 3, "", ""), (9, -4, "system", "a. "), (9, 9, "tool", "b"),
            (9, 9, "tool", "b"), (9, 9, "tool", "a"), (60, 0, "user", "Hi."), (61, 5, "assistant", "Own."),
            (62, 5, "assistant", "Own."), (63, 1, "user", "été"), (63, 2, "assistant", "日本.")]
    rows += [(80, t, "user" if t % 2 else "assistant", f"{t % 5}.") for t in range(300)]
    return rows, spark.createDataFrame(rows, CONVERSATION).withColumns(
        {"conv": F.lit("x"), "place": F.lit(1), "no": F.lit(2)})


# -- repair --------------------------------------------------------------------------------

def cheapest(rows):
    """(cost, audit) by trying every edit of every row, the rest being solved first."""
    follows = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
    found = {}
    for i in range(len(rows), -1, -1):
        for inserted in range(4, -1, -1):
            for state in range(4):
                wanted = "a" if state == 2 else "u"
                options = [(0, "")] if i == len(rows) and state in (0, 3) else []
                if inserted < 4:
                    cost, audit = found[i, inserted + 1, follows[state, wanted]] if (
                        i, inserted + 1, follows[state, wanted]) in found else (10**9, "")
                    options.append((cost + 2, "I" + audit))
                if i < len(rows):
                    initial, fault = rows[i]
                    cost, audit = found[i + 1, 0, state]
                    options.append((cost + 3, "D" + audit))
                    if fault not in ("blank", "duplicate"):
                        extra = fault == "truncated"
                        if (state, initial) in follows:
                            cost, audit = found[i + 1, 0, follows[state, initial]]
                            options.append((cost + extra, "K" + audit))
                        cost, audit = found[i + 1, 0, follows[state, wanted]]
                        options.append((cost + 2 + extra, "R" + audit))
                found[i, inserted, state] = min(options) if options else (10**9, "")
    return found[0, 0, 0]


def expected_repair(table):
    groups = collections.defaultdict(list)
    for conv, turn, role, text in table:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        groups[conv]
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        groups[conv] += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, rows in groups.items():
        rows.sort(key=by_turn)
        turns = {r[1] for r in rows if r[1] is not None}
        seen, faults = set(), []
        for _, _, role, text in rows:
            own = re.sub(r"[\x20\x09-\x0D]+$", "", text)
            faults.append("blank" if not own else "duplicate" if (role, text) in seen
                          else "truncated" if own[-1] not in ".!?" else None)
            seen.add((role, text))
        cost, audit = cheapest([(r[2][:1], f) for r, f in zip(rows, faults)])
        state, at, lines = 0, 0, []
        for letter in audit:
            wanted = "a" if state == 2 else "u"
            row = None
            if letter != "I":
                row = rows[at]
                at += 1
            if letter == "D":
                continue
            initial = row[2][0] if letter == "K" else wanted
            role = row[2] if letter == "K" else {"u": "user", "a": "assistant"}[wanted]
            lines.append(f"{role}:{row[3] if row else ''}")
            state = {"s": 1, "u": 2, "a": 3}[initial]
        count = collections.Counter(faults)
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:])]
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, count["blank"], count["duplicate"],
                     count["truncated"], sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                     sha("\n".join(lines)))
    return out


def repaired(df):
    columns = [*conversation_repair.COUNTS, "audit", "repaired_sha256"]
    return {r["conv"]: tuple(r[c] for c in columns) for r in conversation_repair.whole(
        conversation_repair.repair(conversation_repair.damaged(df))).collect()}


def test_repair_of_the_whole_table(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    found = queries.op11_conversation_repair(spark, SF)
    rows = {r["conv_id"]: tuple(r)[1:] for r in found.collect()}
    assert rows == expected_repair(table) and found.columns[1:] == [*conversation_repair.COUNTS, "audit", "repaired_sha256"]


@pytest.mark.parametrize("long", [2000, 3, 0])
def test_repair_of_odd_rows_short_or_long(odd, monkeypatch, long):
    table, df = odd
    monkeypatch.setattr(conversation_repair, "LONG", long)
    # Workers get the package as it is, so a small segment has to be part of the function shipped.
    assert repaired(df) == expected_repair(table)


def test_segments_of_any_size_give_the_same(odd):
    """The stream over matrices, called as a task would call it."""
    table, _ = odd
    rows = [("user" if i % 3 else "assistant", i % 7 != 0) for i in range(200)]
    string = bytes(repair_grammar.symbol(r, t) if i % 11 else repair_grammar.DOOMED for i, (r, t) in enumerate(rows))
    grammar = repair_grammar.Grammar([string])
    cost, end = grammar.best(string)
    audit = grammar.audits([(string, 0, end)])[0] + repair_grammar.ENDING[end]
    for size in (1, 2, 7, 64):
        parts = [string[p:p + size] for p in range(0, len(string), size)]
        own = repair_grammar.Grammar(parts)
        batch = pa.RecordBatch.from_pylist([
            {"conv": 1, "part": 0, "segment": i, "symbols": s, "first": "u", "last": "a"} for i, s in enumerate(parts)])
        kind = pa.schema([("conv", pa.int64()), ("part", pa.int64()), ("segment", pa.int64()), ("piece", pa.int64()),
                          ("enters", pa.int64()), ("leaves", pa.int64()), ("ends", pa.bool_()), ("cost", pa.int64()),
                          ("joint", pa.int64())])
        states = [r for b in conversation_repair._states(kind)(conversation_repair._matrices([batch]))
                  for r in b.to_pylist()]
        states.sort(key=lambda r: r["segment"])
        spelled = own.audits([(s, r["enters"], r["leaves"]) for s, r in zip(parts, states)])
        assert "".join(spelled) + repair_grammar.ENDING[states[-1]["leaves"]] == audit
        assert sum(r["cost"] for r in states) == cost


def test_repair_of_nothing(spark):
    assert repaired(spark.createDataFrame([], CONVERSATION)) == {}


# -- trie ----------------------------------------------------------------------------------

def expected_trie(table):
    own = collections.defaultdict(list)
    for row in table:
        own[row[0]].append((row[0], row[1], row[2] or "", row[3] or ""))
    turns = {c: [r[2:] for r in sorted(rows, key=by_turn)] for c, rows in own.items()}
    built = {}
    for c, rows in turns.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 4
        built[c] = (turns.get(c - c % 20, [])[:h] if c is not None else []) + rows[h:]
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, rows in built.items():
        for d in range(len(rows) + 1):
            members[tuple(rows[:d])].append(c)
        ends[tuple(rows)].append(c)

    def least(node):
        return min((c for c in members[node] if c is not None), default=None)
    kids = collections.defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    sums = {}
    for node in sorted(members, key=len, reverse=True):
        saved = (len(members[node]) - 1) * (len(words(node[-1][1])) if node else 0)
        below = [sums[k] for k in kids[node]]
        sums[node] = (sum(b[0] for b in below) if below else 1, saved + sum(b[1] for b in below))
    return sorted(((least(n), len(n), least(n[:-1]) if n else None, len(m), len(kids[n]), *sums[n],
                    sha(",".join(map(str, sorted(c for c in ends[n] if c is not None))))) for n, m in members.items()),
                  key=str)


def test_trie_of_the_whole_table(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    found = sorted((tuple(r) for r in queries.op12_prefix_trie(spark, SF).collect()), key=str)
    assert found == expected_trie(table)


@pytest.mark.parametrize("span", [prefix_trie.SPAN, 4])
def test_trie_of_odd_rows(spark, odd, monkeypatch, span):
    table, df = odd
    monkeypatch.setattr(prefix_trie, "SPAN", span)
    monkeypatch.setattr(prefix_trie, "PLACE_SPAN", 8 * span)
    found = sorted((tuple(r) for r in prefix_trie.prefix_trie(df).collect()), key=str)
    assert found == expected_trie(table)


def test_trie_of_nothing(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], CONVERSATION)).count() == 0


@pytest.mark.parametrize("last, chunk", [(list_rank.LAST, list_rank.CHUNK), (40, 64), (40, 1)])
def test_places_in_a_list(spark, monkeypatch, last, chunk):
    """In few rounds, in many, and by doubling when chunks find no links."""
    order = np.random.default_rng(3).permutation(700).tolist()
    links = spark.createDataFrame(
        [(e, f, i // 9, 0) for i, (e, f) in enumerate(zip(order, [*order[1:], -1]))],
        "element long, next long, a long, b long").repartition(5)
    monkeypatch.setattr(list_rank, "LAST", last if chunk > 1 else 1)
    monkeypatch.setattr(list_rank, "CHUNK", chunk)
    found = {r["element"]: r["place"] for r in list_rank.places(links).collect()}
    assert found == {e: i for i, e in enumerate(order)}


# -- byte-level BPE ------------------------------------------------------------------------

@functools.cache
def library():
    return Tokenizer.from_file(BYTE_BPE)


def test_ids_and_texts_of_the_whole_table(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = queries.op13_bpe(spark, SF).toPandas()
    assert sorted(found.doc_id) == sorted(texts)
    for r in found.itertuples():
        ids = library().encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(",".join(map(str, ids))))
        assert r.decoded_sha256 == sha(library().decode(ids, skip_special_tokens=False))


def test_odd_texts(prose):  # noqa: F811
    draw = np.random.default_rng(1)
    texts = ["it's I'LL don't", "<|endoftext|> x <|endoftext|><|endoftext|>  y", "½ ²x\x1cy\x85z\xa0a", "a\xa0 b\xa0  c",
             "  x  y \n z\n\n w  ", "日本語 ΑΣ İ 　 x", "", "\x00\x01", "a" * 3000, "ab" * 40, "\t\t a", prose(2000, 5)]
    alphabet = list(" \n\t\xa0ab'sé1.,<|>endoftext日\x1c  ")
    texts += ["".join(draw.choice(alphabet, 40)) for _ in range(500)]
    codec = bpe.Codec(BYTE_BPE)
    ids = [e.ids for e in library().encode_batch(texts, add_special_tokens=False)]
    assert codec.encode(texts).to_pylist() == ids
    assert codec.decode(pa.array(ids)).to_pylist() == [library().decode(i, skip_special_tokens=False) for i in ids]


def test_any_ids_decode_as_in_the_library():
    draw = np.random.default_rng(2)
    ids = draw.integers(0, 50_400, (300, 9)).tolist()
    assert bpe.codec(BYTE_BPE).decode(pa.array(ids)).to_pylist() == [
        library().decode(i, skip_special_tokens=False) for i in ids]


def test_single_trees_equal_the_forest(prose):  # noqa: F811
    codec = bpe.Codec(BYTE_BPE)
    for piece in (prose(9, 4).replace(" ", "")[:60], "aaaaaaaaaaaaa", "x", "the"):
        ids = codec.byte_ids[np.frombuffer(piece.encode(), np.uint8)].tolist()
        assert codec.merges.single(list(ids)) == codec.encode([piece]).to_pylist()[0]


def test_documents_with_nulls_and_repeats(spark, documents):  # noqa: F811
    table = documents((1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x")).withColumns(
        {"id": F.lit(9), "ids": F.lit("z")})
    coded = bpe.decode(bpe.encode(table, BYTE_BPE), BYTE_BPE)
    assert sorted((str(r["id"]), len(r["ids"]), r["text"]) for r in coded.collect()) == [
        ("1", 0, ""), ("2", 0, ""), ("3", 2, "a b"), ("3", 2, "a b"), ("None", 1, "x")]
    assert bpe.encode(table.where("false"), BYTE_BPE).count() == 0
    unknown = spark.createDataFrame([(1, [64, None, 999_999]), (2, None)], "id long, ids array<int>")
    assert sorted(r["text"] for r in bpe.decode(unknown, BYTE_BPE).collect()) == ["", "a"]


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        bpe.Codec(public_tokenizers.path(queries.TOKENIZER))
