"""Defined results of the operators: nulls, empty and long texts, ties, repeats, odd columns."""

import collections
import re
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_helpers import DOCUMENT, documents, grams, prose  # noqa: F401
from tidegrid.llm import (
    components, decontamination, html_text, kneser_ney, language_id, ngram_join, order_minhash, packing,
    queries, quotation, sharding, substring_dedup, words)
from tidegrid.session import materialize

TOKENIZER = public_tokenizers.path(queries.TOKENIZER)


@pytest.fixture
def odd(documents, prose):  # noqa: F811
    long = prose(30_000, 1)
    return documents(
        (1, None), (2, ""), (3, " \n\t"), (4, "..."), (5, prose(60, 2)), (5, prose(60, 2)), (None, prose(60, 2)),
        (6, long), (7, "word"), (None, None), (8, "été ß 日本語"))


def collected(df):
    return [r.asDict() for r in df.collect()]


def test_windows_are_hashed_alike_wherever_they_stand(prose):  # noqa: F811
    text = prose(50, 3)
    hashes, first = words.word_hashes(pa.array([f"x {text}", text, None, ""]))
    assert np.diff(first).tolist() == [51, 50, 0, 0]
    places, found = words.rolling(hashes, first, 35)
    assert np.array_equal(found[1:17], found[17:]) and places[-1] == 51 + 15
    alone, _ = words.word_hashes(pa.array(["a" * 600_000 + " b"]))
    assert len(alone) == 2 and alone[1] == words.word_hashes(pa.array(["b"]))[0][0]


def test_packing(spark, odd):
    found = collected(packing.pack(odd, TOKENIZER))
    lengths = {}
    for r in found:
        lengths.setdefault(r["id"], []).append(r["length"])
    assert len(found) == 11 - 1 + len(lengths[6]) and lengths[1] == lengths[2] == lengths[3] == [1]
    assert len(lengths[5]) == 2 and len(lengths[6]) > 10 and set(lengths[6][:-1]) | {4096} == {4096}
    assert packing.pack(spark.createDataFrame([], DOCUMENT), TOKENIZER).count() == 0


def test_best_fit_prefers_the_tightest_bin():
    bins, offsets, loads = packing.best_fit(np.array([6, 5, 4, 5, 3]), 10)
    assert sorted(loads.tolist()) == [3, 10, 10] and bins[0] == bins[2] and offsets[2] == 6


def test_underfull_bins_merge_over_rounds(spark, odd, monkeypatch):
    monkeypatch.setattr(packing, "MERGE_ITEMS", 4)
    rows = spark.range(400, numPartitions=16).select("id", F.lit("a b c d e f g").alias("text"))
    found = packing.pack(rows, TOKENIZER, id_column="id", capacity=40).toPandas()
    assert found.sequence_id.nunique() <= 400 // 5 + 2
    for _, sequence in found.sort_values("offset").groupby("sequence_id"):
        assert sequence.offset.tolist() == [0, *np.cumsum(sequence.length)[:-1]] and sequence.length.sum() <= 40


def test_tokens_equal_the_whole_tokenizer(prose):  # noqa: F811
    texts = ["it's I'LL don't", "<|endoftext|> x", "½ ²x\x1cy\x85z\xa0a", "日本語 ΑΣ İ", "", "\x00\x01", "a b", prose(500, 9)]
    tokens = packing.Tokens(TOKENIZER)
    expected = [e.ids for e in tokens.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in tokens.ids(pa.array(texts))] == expected


def test_equal_short_names_lose_no_row(spark, documents, prose, monkeypatch):  # noqa: F811
    """All rows get the same first name: links, classes and the rows that stay are as ever."""
    a, b, c = prose(80, 21), prose(80, 22), prose(80, 23)
    rows = [(1, a), (2, a + " tail"), (3, b), (4, b + " end"), (5, c), (6, "short"), (7, ""), (8, a), (8, a)]
    expected = sorted(map(str, collected(ngram_join.ngram_join(documents(*rows)).select(
        "id", "class_id", "copies", "n_links"))))
    names = ngram_join.row_names
    monkeypatch.setattr(ngram_join, "row_names", lambda *args: (F.lit(7).cast("long"), names(*args)[1]))
    joined = ngram_join.ngram_join(documents(*rows))
    assert sorted(map(str, collected(joined.select("id", "class_id", "copies", "n_links")))) == expected
    kept = collected(ngram_join.distinct_documents(documents(*rows)))
    assert sorted(r["doc_id"] for r in kept) == [1, 3, 5, 6, 7]


def test_ngram_join(spark, odd):
    found = ngram_join.ngram_join(odd).toPandas()
    assert len(found) == 11
    same = found[(found.id == 5) | (found.copies == 3)]
    assert len(same) == 3 and set(same.class_id) == {5} and set(same.n_links) == {2}
    assert (found[found.copies == 1].n_links == 0).all()
    kept = collected(ngram_join.distinct_documents(odd.withColumn("uid", F.lit(0)).withColumn("n", F.lit(1))))
    assert sorted(str(r["doc_id"]) for r in kept) == sorted(map(str, [1, 2, 3, 4, 5, 6, 7, None, 8]))
    assert ngram_join.ngram_join(spark.createDataFrame([], DOCUMENT)).count() == 0


def test_large_groups_of_near_copies_lose_no_link(spark, documents, prose, monkeypatch):  # noqa: F811
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    base = prose(120, 5).split()
    texts = [" ".join([*base[:i], f"new{i}", *base[i + 1:]]) for i in range(0, 120, 3)]
    found = ngram_join.ngram_join(documents(*enumerate(texts))).toPandas().set_index("id")
    sets = [grams(t) for t in texts]
    for i, own in enumerate(sets):
        links = sum(len(own & s) >= 0.8 * len(own | s) for j, s in enumerate(sets) if j != i)
        assert found.n_links[i] == links > 0
    assert set(found.class_id) == {0}


def test_bands_meet_the_recall():
    bands, rows = ngram_join.banding(0.8, 0.9999, 80)
    assert 1 - (1 - 0.8 ** rows) ** bands >= 0.9999 and bands * rows <= 80


def test_components_of_a_long_path(spark):
    edges = spark.range(60).selectExpr("id AS a", "id + 1 AS b").union(spark.createDataFrame([(100, 101)], "a long, b long"))
    found = {r["node"]: r["root"] for r in components.components(edges).collect()}
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert components.components(edges.limit(0)).count() == 0


def test_sharding(spark, odd):
    rows = sharding.with_shard(odd.select("doc_id", "lang"), "doc_id", [1.0, 2.0, 0.0])
    found = sharding.numbered(rows.unionByName(rows)).toPandas()
    assert len(found) == 22 and not (found.shard == 2).any()
    for _, shard in found.groupby("shard"):
        assert sorted(shard.slot) == list(range(len(shard)))
    big = sharding.with_shard(spark.range(20_000), "id", [1.0, 3.0]).groupBy("shard").count().toPandas().set_index("shard")
    assert abs(big["count"][1] - 15_000) < 400
    assert sharding.numbered(rows.limit(0)).count() == 0


def test_a_hot_key_is_numbered_in_parts(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SPLIT", 7)
    rows = sharding.with_shard(spark.range(100).selectExpr("id % 3 % 2 AS id"), "id", [1.0, 1.0])
    for _, shard in sharding.numbered(rows).toPandas().groupby("shard"):
        assert sorted(shard.slot) == list(range(len(shard)))


def test_sharding_runs_no_python(spark, odd):
    plan = odd.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    rows = sharding.numbered(sharding.with_shard(odd.select("doc_id"), "doc_id", [1.0, 1.0]))
    text = rows._jdf.queryExecution().explainString(plan)
    assert "Python" not in text and "Arrow" not in text


def test_quotations(spark):
    rows = [(1, 0, "u", "Hello there\nHow are you?"), (1, 1, "a", "Fine.\nAnd you?"), (1, 2, "u", "> fine.\nGood"),
            (1, 3, "a", "On Monday X wrote:\n> How are  you?\nreally"), (1, 4, "u", "thanks"), (1, 4, "u", "thanks"),
            (1, 5, "a", ">> Good\n> Fine.\nx"), (2, 0, "u", None), (None, None, None, "")]
    found = quotation.reply_ordered(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    first = found.where("conv_id = 1").orderBy("place").collect()
    assert [(r["turn"], r["parent_turn"], r["text"].split("\n")[-1]) for r in first] == [
        (0, None, "How are you?"), (1, 0, "And you?"), (2, 1, "Good"), (5, 1, "x"), (3, 0, "really"),
        (4, 3, "thanks"), (4, 3, "thanks")]
    assert [r["place"] for r in first] == list(range(7))
    others = found.where("conv_id IS NULL OR conv_id = 2").collect()
    assert sorted(str(r["text"]) for r in others) == ["", "None"] and {r["place"] for r in others} == {0}
    assert quotation.reply_ordered(spark.createDataFrame([], "conv_id long, turn int, role string, text string")).count() == 0


def test_quotations_across_buckets(spark, monkeypatch):
    monkeypatch.setattr(quotation, "SPAN", 4)
    rows = [(7, t, "u", f"line {t % 9}" if t % 5 else f"> line {(t // 5) % 9}\nown {t}") for t in range(40)]
    found = quotation.reply_ordered(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).collect()
    for r in found:
        t = r["turn"]
        quoted = [s for s in range(t) if s % 5 and t % 5 == 0 and s % 9 == (t // 5) % 9]
        assert r["parent_turn"] == (quoted[-1] if quoted else t - 1 if t else None)
    place = {r["turn"]: r["place"] for r in found}
    assert sorted(place.values()) == list(range(40)) and all(place[r["turn"]] > place.get(r["parent_turn"], -1) for r in found)


def depth_first(parents):
    """Places and depths of the messages of one conversation, from their parents, by hand."""
    run_of, runs = {}, {}
    for t, parent in parents.items():
        run_of[t] = run_of[parent] if t and parent == t - 1 else t
        runs.setdefault(run_of[t], []).append(t)
    below = {}
    for run in runs:
        if run:
            below.setdefault(run_of[parents[run]], []).append(run)
    found, todo = {}, [(0, 0)]
    while todo:
        run, depth = todo.pop()
        for t in runs[run]:
            found[t] = (len(found), depth)
        todo += [(r, depth + 1) for r in sorted(below.get(run, []), key=lambda r: (-parents[r], r), reverse=True)]
    return found


@pytest.mark.parametrize("small", [False, True])
def test_reply_order_of_many_quoting_messages(spark, monkeypatch, small):
    """Three thousand messages that quote any earlier one, nesting hundreds deep, against a plain walk."""
    draw = np.random.default_rng(5)
    rows, expected = [], {}
    for conv, n in ((1, 1500), (2, 900), (3, 1), (4, 599), (5, 2)):
        parents = {0: None}
        for t in range(1, n):  # conversation 4 nests as deep as it can, the others branch anywhere
            quotes = t % 2 == 0 if conv == 4 else draw.random() < 0.6
            parents[t] = (t - 2 if conv == 4 else int(draw.integers(0, t))) if quotes else t - 1
        rows += [(conv, t, "u", f"> word{conv} {p}\nword{conv} {t}" if p not in (None, t - 1) else f"word{conv} {t}")
                 for t, p in parents.items()]
        expected.update({(conv, t): (parents[t], *x) for t, x in depth_first(parents).items()})
    if small:
        monkeypatch.setattr(quotation, "PLACE_SPAN", 64)
        monkeypatch.setattr(quotation, "SPAN", 16)
    found = quotation.reply_ordered(spark.createDataFrame(
        rows, "conv_id long, turn int, role string, text string").repartition(3)).collect()
    assert {(r["conv_id"], r["turn"]): (r["parent_turn"], r["place"], r["depth"]) for r in found} == expected
    assert max(depth for _, _, depth in expected.values()) > 200


def test_a_hot_conversation_without_turns(spark):
    rows = [(None, None, "u", "same")] * 3000 + [(None, None, "a", f"> same\n{i}") for i in range(50)] + [(None, 1, "u", "x")]
    found = quotation.reply_ordered(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    told = sorted((r["place"], r["turn"], r["role"]) for r in found.collect())
    assert told == [(0, 1, "u"), *((p, None, "a") for p in range(1, 51)), *((p, None, "u") for p in range(51, 3051))]


def test_wrapped_and_partial_quotations_find_their_source(spark):
    long = "The harbour master asked for the list of all ships. It has to be sent before noon on Monday, please. Yes?"
    wrapped = "> The harbour master asked for the list\n> of all ships. It has to be sent\n> before noon on Monday, please. Yes?"
    rows = [(1, 0, "u", long), (1, 1, "a", "Which list do you mean, the one of all ships or another one?"),
            (1, 2, "u", "nothing to see"), (1, 3, "a", wrapped + "\ndone"), (1, 4, "u", "> It has to be sent\nwhy"),
            (1, 5, "a", "> the one of\n>   all ships\nboth"), (1, 6, "u", ">> which list do you mean,\n> why\nso"),
            (1, 7, "a", "> this was never said by anyone here\nhm"), (1, 8, "u", "我们明天早上去港口看船"),
            (1, 9, "a", "ok"), (1, 10, "u", "> 我们明天早上\n> 去港口看船\n好")]
    found = quotation.reply_ordered(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    assert {r["turn"]: (r["parent_turn"], r["quotes"]) for r in found.collect()} == {
        0: (None, False), 1: (0, False), 2: (1, False), 3: (0, True), 4: (0, True), 5: (1, True), 6: (4, True),
        7: (6, False), 8: (7, False), 9: (8, False), 10: (8, True)}
    assert {r["text"] for r in found.collect() if r["turn"] in (3, 10)} == {"done", "好"}


PAGE = """<html><body><div id="top-nav">Menu <a href=x>a</a></div><div class="content c12"><h1>Title</h1><p>One
 two &amp; three<p>Four <b>five</b>six<br>seven<div class="comments">Reader says hi</div><script>if (a < b) "</p>"</script>
<form>Name</form></div><aside>more</aside><!-- <p>no</p> --><footer>end</footer>"""


def test_main_text(spark):
    rows = [(1, "http://h.example/a", PAGE), (2, "http://h.example/b", PAGE.replace("c12", "c9")), (3, None, None),
            (4, "odd", ""), (None, "http://h.example/a", "plain < text"), (5, "http://h.example/c", "<p>cut <b")]
    found = {r["id"]: r["text"] for r in html_text.main_text(
        spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))).collect()}
    article = "Title One two & three Four fivesix seven"
    assert found == {1: article, 2: article, 3: "", 4: "", None: "plain < text", 5: "cut"}
    paths = html_text.consensus(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["host"]: r["paths"][0] for r in paths}["h.example"] == "/body/div.c.content"


@pytest.mark.parametrize("wrap", [
    "<body><div>Links <a>one</a> <a>two</a></div><article>%s</article></body>", "<main><div class=a>%s</div></main>",
    "<body><ul class=x><li><a>some other page</a></li></ul><div class=post>%s</div></body>", "<body>%s</body>", "%s"])
@pytest.mark.parametrize("inner", [
    "<h1>Title</h1><p>lead words</p><div class=body>{long}</div><p>end words</p>",
    "<h1>Title</h1><p>lead words</p><section>{long}</section><section>{long}</section>",
    "<h1>Title</h1><div class=intro>lead words</div><div class=body><div>{long}</div>after</div><div class=o>end</div>",
    "<h1>Title</h1><table><tr><td>{long}</td><td>cell</td></tr></table>end words",
    "<div class=one>{long} lead</div><div class=two>{long}</div>"])
def test_nothing_of_an_article_is_lost(wrap, inner):
    inner = inner.format(long="many words of text " * 9)
    found = html_text.blocks(wrap % inner)
    whole = " ".join(re.sub("<[^>]*>", " ", inner).split())
    assert html_text.extract(found, []) == whole
    assert html_text.extract(found, [html_text.own_path(found)[0]]) == whole
    for path in {c for b in found for c in b.containers}:
        assert html_text.extract(found, [path]) == whole


@pytest.mark.parametrize("page", [
    '<div class="content-sidebar-wrap"><h1>Title</h1><p>{long}</p></div>',
    '<div id="page" class="site has-sidebar"><article><h1>Title</h1><p>{long}</p></article></div>',
    '<div id="page" class="site with sidebar"><div><h1>Title</h1><p>{long}</p></div></div>',
    '<article class="post no-comments"><h1>Title</h1><p>{long}</p></article>',
    '<article><header class="entry-header"><h1>Title</h1></header><p>{long}</p></article>',
    '<article><div class="post-header"><h1>Title</h1></div><p>{long}</p></article>',
    '<div class="search-result">Title</div><div class="search-result">{long}</div><div class="search-result">x</div>',
    '<ul class="widget"><li>Title</li><li>{long}</li></ul>'])
def test_names_skip_no_page_or_article(page):
    text = html_text.extract(html_text.blocks(page.format(long="many words of text " * 9)), [])
    assert text.startswith("Title many words of text") and text.count("many words") == 9


def test_names_still_skip_what_stands_beside_an_article():
    page = f"<div class=ad>{'buy ' * 40}</div><article>short<div class=share>Tell</div></article><p id=cookies>ok"
    assert html_text.extract(html_text.blocks(page), []) == "short"
    page = f"<div><div class=sidebar>{'x ' * 40}</div><div>{'text ' * 50}</div><div class=comments>{'y ' * 50}</div></div>"
    assert html_text.extract(html_text.blocks(page), []).split() == ["text"] * 50


def test_articles_of_two_kinds_are_both_kept():
    page = f"<body><article class=a>{'one ' * 60}</article><article class=b>{'two ' * 40}</article><div>aside text</div>"
    assert html_text.extract(html_text.blocks(page), []).split() == ["one"] * 60 + ["two"] * 40


def test_perplexity_is_a_distribution_and_follows_the_formula(spark, documents, prose):  # noqa: F811
    rows = documents((1, "abab"), (2, "abac"), (3, None), (4, ""), (None, "zz"), (2, "abac"))
    trusted = spark.createDataFrame([(1,), (2,), (None,)], "doc_id long")
    found = kneser_ney.score(rows, trusted).toPandas()
    assert len(found) == 6 and found.n_symbols.sum() == 5 * 3 + 1 + 1 + 3
    assert found.perplexity.gt(1).all() and found[found.id == 2].perplexity.nunique() == 1
    keys = np.unique(np.concatenate([kneser_ney.ngrams([t])[0] for t in ("abab", "abac", "abac")]))
    context = int(kneser_ney.ngrams(["abab"])[0][3]) >> kneser_ney.BITS  # "aba"
    asked = [(context << kneser_ney.BITS) | s for s in range(kneser_ney.SYMBOLS)]
    counts = {int(k): 0 for k in asked}
    for text in ("abab", "abac", "abac"):
        for k in kneser_ney.ngrams([text])[0].tolist():
            counts[k] = counts.get(k, 0) + 1
    p = kneser_ney.probabilities(spark.createDataFrame(list(counts.items()), "gram long, n long")).toPandas()
    assert set(keys.tolist()) <= set(p.gram)
    assert np.exp(p[p.gram.isin(asked)].log_p).sum() == pytest.approx(1.0)
    assert kneser_ney.score(rows.limit(0), trusted).count() == 0
    assert kneser_ney.score(rows, trusted.limit(0)).toPandas().perplexity.max() == pytest.approx(kneser_ney.SYMBOLS)


def test_decontamination(spark, odd, prose):  # noqa: F811
    item, short = prose(40, 2), "word"
    near = " ".join(["zz"] + prose(60, 2).split()[1:])
    items = spark.createDataFrame([(1, item), (2, short), (3, None), (4, ""), (4, item)], "item_id long, text string")
    rows = odd.unionByName(odd.limit(0)).unionByName(spark.createDataFrame([(9, near, None, None, 0)], DOCUMENT))
    found = {(r["id"], r["item_id"]) for r in decontamination.leaks(rows, items).collect()}
    starts = prose(60, 2).startswith(item)
    expected = {(i, j) for i in (5, None, 9) for j in (1, 4)} if starts else set()
    assert found == expected | {(7, 2)}
    kept = collected(decontamination.clean(rows.withColumn("similarity", F.lit(1)), items))
    assert {r["doc_id"] for r in kept} == {1, 2, 3, 4, 6, 8, None} and kept[0]["similarity"] == 1
    assert decontamination.leaks(rows.limit(0), items).count() == decontamination.leaks(rows, items.limit(0)).count() == 0


def test_texts_shorter_than_an_item_leak_it_too(spark, prose, documents):  # noqa: F811
    item = prose(50, 11).split()
    others = [prose(n, n).split() for n in (12, 48, 49, 60)]
    repeated = "a b c d e f".split() * 4
    texts = [item[:48], item[1:], item[5:45], item[:39], item[:3], item[:-3] + ["zz"], others[0][:11], ["x"], [],
             others[3][4:], repeated[:22], repeated[:12], item + ["more"]]
    items = [item, *others, repeated, item[:6], item[:4]]
    found = {(r["id"], r["item_id"]): r for r in decontamination.leaks(
        documents(*((i, " ".join(t)) for i, t in enumerate(texts))),
        spark.createDataFrame([(j, " ".join(t)) for j, t in enumerate(items)], "item_id long, text string")).collect()}

    def counted(own, n):
        return collections.Counter(tuple(own[p:p + n]) for p in range(len(own) - n + 1))
    expected = {}
    for i, text in enumerate(texts):
        for j, own in enumerate(items):
            n, best = min(5, len(own)), 0.0
            for p in range(max(1, len(text) - len(own) + 1)):
                a, b = counted(text[p:p + len(own)], n), counted(own, n)
                best = max(best, (a & b).total() / max(1, (a | b).total()))
            if best >= 0.8:
                expected[i, j] = best
    assert {k: r["similarity"] for k, r in found.items()} == pytest.approx(expected) and (0, 0) in expected
    assert (found[0, 0]["start"], found[0, 0]["n_words"]) == (0, 48) and {(1, 0), (5, 0), (10, 5)} <= set(expected)


@pytest.mark.parametrize("places", [1, 9, 26, 46, 300])
def test_the_hamming_index_finds_all_within_the_radius(places):
    """All within the radius, few others, and nearly all windows that are just similar enough."""
    draw = np.random.default_rng(places)
    own = draw.integers(0, 1 << 64, (300, places), np.uint64)
    length = decontamination._Length(places + 4, 5, 0.8, list(enumerate(own)))
    prints = length.prints[draw.integers(0, 300, 500)] ^ np.packbits(draw.random((500, 64)) < draw.random((500, 1)) * 0.4, axis=1)
    near = decontamination.hamming(prints[:, None], length.prints[None]) <= length.radius
    found = np.zeros_like(near)
    found[length.candidates(prints)] = True
    assert (found == near).all() and near.any()
    other = decontamination.simhash(draw.integers(0, 1 << 64, (500, places), np.uint64))
    assert len(length.meeting(other)[0]) < 0.1 * 500 * 300
    windows = np.tile(own, (10, 1))
    changed = places - length.least
    windows[:, :changed] = draw.integers(0, 1 << 64, (3000, changed), np.uint64)
    pairs = set(zip(*map(np.ndarray.tolist, length.candidates(decontamination.simhash(windows)))))
    assert np.mean([(w, w % 300) in pairs for w in range(3000)]) > 0.99


def test_a_repeating_passage_leaks_whatever_its_fingerprint():
    """The shared words and one word that repeats: far apart by fingerprint, near by similarity."""
    words_of = [f"w{i}" for i in range(500)]
    items = decontamination.Items([" ".join(words_of), " ".join(words_of[:400] + ["x"] * 100)], 5, 0.65)
    texts = [words_of[:400] + ["z"] * 100, words_of[:400] + ["x"] * 100, words_of[:300]]
    found = items.leaks(pa.array([" ".join(["and", *t]) for t in texts]))
    assert {k: round(v[0], 6) for k, v in found.items()} == {
        (0, 0): round(396 / 596, 6), (1, 0): round(396 / 596, 6), (1, 1): 1.0, (0, 1): round(396 / 596, 6)}


def test_items_are_grouped_by_what_they_need(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "MOST_BYTES", 20 * decontamination.ITEM_BYTES)
    items = spark.range(200).selectExpr("id AS item_id", "concat('w', id) AS text")
    groups = list(decontamination._groups(items, "text", "item_id"))
    assert len(groups) > 10 and sorted(r["item"] for g in groups for r in g) == list(range(200))
    length = decontamination._Length(1, 5, 0.8, [(i, np.array([i], np.uint64)) for i in range(1000)])
    size = sum(a.nbytes for _, _, *arrays in length.blocks for a in arrays) + length.prints.nbytes
    assert size < 100 * 1000 and length.radius == 0


def test_languages(spark, documents, prose):  # noqa: F811
    rows = documents(*((i, " ".join(["the cat and dog"] * 9), "en") for i in range(20)),
                     *((20 + i, " ".join(["der hund und die katze"] * 9), "de") for i in range(20)),
                     (50, None, None), (51, "123 !!", "en"), (52, "the dog", None), (None, "die katze", "de"))
    model = language_id.train(rows, F.col("doc_id") < 40)
    found = {r["doc_id"]: r for r in language_id.identify(rows.withColumn("score", F.lit("x")), model).collect()}
    assert [found[i]["lang_pred"] for i in (0, 20, 50, 51, 52, None)] == ["en", "de", "und", "und", "en", "de"]
    assert all(0 <= r["score"] <= 1 for r in found.values()) and found[50]["score"] == 0
    nothing = language_id.train(rows, F.lit(False))
    assert {r["lang_pred"] for r in language_id.identify(rows, nothing).collect()} == {"und"}
    assert language_id.identify(rows.limit(0), model).count() == 0


@pytest.mark.parametrize("n", [2, 3, 4, 7, 8, 40])
def test_codewords_differ(n):
    code = language_id.codebook(n)
    assert len(np.unique(code, axis=0)) == n and (np.abs(code.sum(axis=0)) < n).all()


def test_substring_dedup(spark, odd, prose):  # noqa: F811
    found = collected(substring_dedup.remove_repeats(odd.withColumn("kept", F.lit(5)).withColumn("chunk", F.lit(6))))
    assert len(found) == 11 and {r["chunk"] for r in found} == {6}
    copies = [r for r in found if r["n_words"] == 60]
    assert [(r["n_removed"], r["kept"], r["removed_spans"]) for r in copies] == [(60, "", [[0, 60]])] * 3
    rest = {r["doc_id"]: r for r in found if r["n_words"] != 60 and r["doc_id"]}
    assert rest[1]["kept"] is None and rest[3]["kept"] == " \n\t" and rest[6]["n_removed"] == 0
    assert substring_dedup.remove_repeats(odd.limit(0)).count() == 0


def test_repeats_inside_one_text_and_shorter_ones(spark, documents, prose):  # noqa: F811
    a, b, c = prose(35, 11), prose(34, 12), prose(3, 13)
    rows = documents((1, f"{a} {c} {a} x"), (2, f"{b} u"), (3, f"v {b}"))
    found = {r["doc_id"]: r for r in substring_dedup.remove_repeats(rows).collect()}
    assert (found[1]["kept"], found[1]["removed_spans"]) == (f"{c} x", [[0, 35], [38, 73]])
    assert found[2]["n_removed"] == found[3]["n_removed"] == 0


@pytest.mark.parametrize("fan, digits", [(1, 3), (2, 5), (8, 10)])
def test_repeats_over_relays(spark, documents, prose, monkeypatch, fan, digits):  # noqa: F811
    """Any number of levels between chunks and shards gives the words that brute force removes."""
    passages = [prose(n, 100 + n) for n in (34, 35, 36, 60, 90)]
    texts = [f"{prose(5 + i % 7, i)} {passages[i % 5]} {prose(i % 40, 300 + i)} {passages[i % 3] if i % 4 else ''}"
             for i in range(60)] + [passages[4]] * 40 + [prose(80, 999), ""]
    rows = materialize(documents(*enumerate(texts), (None, None)).repartition(5), "texts")
    own = [t.split() for t in texts]
    seen = collections.Counter(tuple(w[p:p + 35]) for w in own for p in range(len(w) - 34))
    kept = [[w for p, w in enumerate(ws) if not any(
        seen[tuple(ws[q:q + 35])] > 1 for q in range(max(0, p - 34), min(p, len(ws) - 35) + 1))] for ws in own]
    monkeypatch.setattr(substring_dedup, "FAN_DIGITS", fan)
    monkeypatch.setattr(substring_dedup.chunks, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(substring_dedup.chunks, "shard_bits", lambda *_: digits)
    found = {r["doc_id"]: r for r in substring_dedup.remove_repeats(rows).collect()}
    assert [found[i]["kept"].split() for i in range(len(texts))] == kept and found[None]["kept"] is None
    assert len(found) == len(texts) + 1 and any(k != w for k, w in zip(kept, own))


def test_messages_follow_the_input_not_its_square():
    for digits in (1, 8, 9, 17, 24):
        levels = substring_dedup._levels(digits)
        steps = np.diff([0, *levels])
        assert levels[-1] == digits and steps.min() > 0 and steps.max() <= substring_dedup.FAN_DIGITS
    values = np.sort(np.random.default_rng(1).integers(0, 1 << 64, 5000, np.uint64))
    flags = np.zeros(5000, bool)
    sent = substring_dedup._messages(values, flags, flags, 1, 8, np.uint64, 15)
    assert len(sent) <= 256 and sum(m["n"] for m in sent) == 5000


def test_fingerprints(spark, odd):
    found = order_minhash.fingerprints(odd.withColumn("fingerprint", F.lit(1)))
    prints = {}
    for r in found.collect():
        prints.setdefault(r["text"] or "", set()).add(r["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())
    a, b = "abcdefghijklmnop" * 3, "qrstuvwxyzABCDEF" * 3
    swapped = order_minhash.likeness(order_minhash.signature(a + b), order_minhash.signature(b + a))
    assert swapped < 1 and order_minhash.likeness(order_minhash.signature(a), order_minhash.signature(a)) == 1
    edits = collected(order_minhash.with_edits(odd))
    assert len(edits) == 11 and all(0 <= r["near_edited"] <= 1 for r in edits)
    lone = collected(order_minhash.with_edits(odd.where("doc_id = 7")))
    assert lone[0]["near_next"] == 1 and order_minhash.with_edits(odd.limit(0)).count() == 0


LONG = "many words of text " * 9


@pytest.mark.parametrize("page, text", [
    (f'<div class="post">{LONG}</div><div id="comments">{"I beg to differ " * 60}</div>', LONG.strip()),
    (f'<article><h1>T</h1>{LONG}</article><div id="comments"><ol class="comment-list"><li><article class="comment-body">'
     f'{"I beg to differ " * 60}</article></li></ol></div>', f"T {LONG.strip()}"),
    (f'<article>{LONG}</article><article class="comment">no</article>', LONG.strip()),
    ('<div class="cookie-notice">We use cookies, as all do.</div>', ""), ('<div class="menu">Home Press</div>', ""),
    *[(f"<div><p>{LONG}</p></div><div class={name}>{'other things said ' * 30}</div>", LONG.strip()) for name in (
        "siteFooter", "mainMenu", "commentSection", "userComments", "cookieConsent", "ad", "newsletter-box")],
    *[(f"<div><p>{LONG}</p></div><div {how}>{'other things said ' * 30}</div>", LONG.strip()) for how in (
        "role=navigation", 'role="contentinfo"', "role=complementary", "hidden", 'style="display: none"')],
    (f'<div class="a hidden-gem" title="hidden x">{LONG}</div>', LONG.strip()),
    (f'<article class="post comments-open has-sidebar"><h1>T</h1>{LONG}</article>', f"T {LONG.strip()}"),
    (f'<div class="comment-free no-ads">{LONG}</div>', LONG.strip()),
    (f"<ul><li>{LONG}<li>two<li>three</ul><table><tr><td>a<td>b<tr><td>c</table>", f"{LONG.strip()} two three a b c"),
])
def test_boilerplate_of_any_size_goes(page, text):
    found = html_text.blocks(page)
    for paths in ([], [html_text.own_path(found)[0]]):
        assert html_text.extract(found, paths) == text


@pytest.mark.parametrize("page", [
    "<div>" * 200_000 + LONG, "<div class=a>x" * 70_000, "<ul>" + "<li>x" * 200_000, "<p><b>x" * 150_000, "</i>" * 250_000 + LONG,
    "<a href=x>" * 100_000 + LONG, "<div class=ad>" * 70_000 + LONG + "<h1>t</h1>", "<table>" + "<tr><td>x" * 100_000])
def test_a_page_takes_time_in_proportion(page):
    begun = time.perf_counter()
    found = html_text.blocks(page)
    path, _ = html_text.own_path(found)
    assert html_text.extract(found, [path]) or "class=ad" in page
    assert time.perf_counter() - begun < 10


def test_only_what_was_found_is_taken_out(spark):
    said = "The harbour master asked for the list of all ships."
    rows = [(1, 0, "u", said), (1, 1, "a", f"On 5 March 2015 at 10:15, Anna Bell <anna@harbour.example>\nwrote:\n> {said}\nDone."),
            (1, 2, "u", "Run this:\n>>> print(1)\nand tell me"), (1, 3, "a", "He always said:\n> nobody knows\nhm"),
            (1, 4, "u", f"Two things:\n\n> {said}\nyes"), (1, 5, "a", "> all of it\n> was never said")]
    found = {r["turn"]: r["text"] for r in quotation.reply_ordered(
        spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).collect()}
    assert found == {0: said, 1: "Done.", 2: rows[2][3], 3: rows[3][3], 4: "Two things:\nyes", 5: rows[5][3]}
