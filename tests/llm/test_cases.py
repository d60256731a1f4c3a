"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import base64
import hashlib
import re
import time
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sampleprep.llm import bm25, chat_format, common, exact_dedup, html_text, language_id, mixing, near_similarity, packing, simhash, toxicity, url_filter
from sampleprep.llm import queries as q
from sampleprep.llm.common import without
from sampleprep.llm.tokens import WordTokens

SCHEMA = "doc_id long, text string, lang string, source string, id long, row string, fp string, size string, text_hash string, node string, component_id string"
LONG = "lorem ipsum dolor sit amet " * 20_000


def rows(*texts, ids=None, sources=None):
    ids = range(len(texts)) if ids is None else ids
    sources = sources or ["s"] * len(texts)
    return [(i, x, None, s, 9, "r", "f", "z", "h", "n", "c") for i, x, s in zip(ids, texts, sources, strict=True)]


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, blank, tied, repeated and long rows."""
    made = rows(None, "", " \t\n", "same  text", "same text", "same\x0btext", LONG, "Same text", "same text", ids=[5, 3, 8, 4, 2, None, 7, 1, 2], sources=[None, "", "a", "a", "b", None, "b", "c", "b"])
    return spark.createDataFrame(made, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact_dedup(odd, empty):
    got = {(r.id, r.keep_id, r.group_size, r.kept, r.text_hash) for r in exact_dedup.exact_dedup(odd, hash_all=True).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    same = {(4, 2, 4, False, sha("same text")), (2, 2, 4, True, sha("same text")), (2, 2, 4, False, sha("same text")), (None, 2, 4, False, sha("same text"))}
    assert got == same | {(5, 3, 2, False, sha("")), (3, 3, 2, True, sha("")), (8, 8, 1, True, sha(" ")), (7, 7, 1, True, sha(LONG.strip() + " ")), (1, 1, 1, True, sha("Same text"))}
    kept = exact_dedup.drop_exact(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 7, 8]
    assert exact_dedup.exact_dedup(empty).count() == 0 and exact_dedup.drop_exact(empty).count() == 0


def test_exact_dedup_with_a_full_filter(odd):
    """A bitmap of one bit lets everything through; the result is the same."""
    full = {(r.id, r.keep_id, r.group_size) for r in exact_dedup.exact_dedup(odd, filter_bits=1).collect()}
    assert full == {(r.id, r.keep_id, r.group_size) for r in exact_dedup.exact_dedup(odd).collect()}


def test_simhash(odd, empty):
    got = {(r.id, r.component_id) for r in simhash.near_duplicates(odd).collect()}
    assert got == {(5, 3), (3, 3), (8, 3), (4, 1), (2, 1), (None, 1), (7, 7), (1, 1)}
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0


@pytest.mark.parametrize("most", [2, 5, 2000])
def test_links_of_long_lists(spark, most):
    """Lists over the bound take other ways; the links are those of all pairs."""
    rng = np.random.default_rng(3)
    base = [int(x) for x in rng.integers(0, 2**63, 6)]
    fps = {b ^ sum(1 << int(x) for x in rng.choice(64, int(rng.integers(0, 5)), replace=False)) for b in base for _ in range(12)}
    fps |= {base[0] ^ (1 << i) ^ (1 << j) for i in range(24) for j in range(i)}
    signed = {int(np.uint64(f).view(np.int64)) for f in fps}
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = {tuple(sorted((r.a, r.b))) for r in simhash.links(df, most_postings=most).collect()}
    order = sorted(signed)
    assert got == {(a, b) for k, b in enumerate(order) for a in order[:k] if ((a ^ b) & (2**64 - 1)).bit_count() <= 3}


def test_components_of_a_chain(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99), (7, 7)], "a long, b long")
    from sampleprep.llm.components import connected_components

    assert {r.node: r.root for r in connected_components(df).collect()} == {i: 0 for i in range(41)} | {99: 99, 100: 99}


def test_near_similarity(spark, odd, empty):
    rng = np.random.default_rng(0)
    base = [f"w{x}" for x in rng.integers(0, 5000, 300)]
    near = [*base]
    near[40], near[200] = "changed", "words"  # two of 300 words: similarity about 0.93
    other = [f"w{x}" for x in rng.integers(0, 5000, 300)]
    df = spark.createDataFrame(rows(" ".join(near), " ".join(base), " ".join(other), " ".join(base), ids=[9, 4, 6, None]), SCHEMA)
    kept = near_similarity.drop_near(df)
    assert kept.columns == df.columns
    assert sorted(kept.collect(), key=lambda r: (r.doc_id is None, r.doc_id))[0].doc_id == 4
    assert sorted(r.doc_id for r in kept.collect()) == [4, 6]
    assert sorted(r.doc_id for r in near_similarity.drop_near(odd).collect()) == [1, 3, 7]
    assert near_similarity.drop_near(empty).count() == 0
    assert sorted(r.doc_id for r in near_similarity.drop_near(df, most_postings=1).collect()) == [4, 6]


def test_near_similarity_decides_by_row(spark):
    """Rows of one id with different texts go and stay on their own; null ids take part."""
    words = [" ".join(f"{k}w{i}" for i in range(60)) for k in "abc"]
    near = words[0] + " end"
    df = spark.createDataFrame(rows(words[0], near, words[1], words[2], words[2], ids=[1, 2, 2, None, None]), SCHEMA)
    assert sorted(r.text for r in near_similarity.drop_near(df).collect()) == sorted(words)


def test_texts_are_not_shuffled(spark):
    """With repeated rows, too, texts cross no exchange but those of the rows that a bitmap takes for repeated ones."""
    made = [(i, " ".join(f"w{i % 50}x{k}" for k in range(9)), None, "s", 9, "r", "f", "z", "h", "n", "c") for i in [*range(60), 3, 3, 7]]
    df = spark.createDataFrame(made, SCHEMA)
    for drop in (exact_dedup.drop_exact, near_similarity.drop_near):
        kept = drop(df)
        assert kept.count() == len({r.doc_id for r in kept.collect()})
        plan = kept._jdf.queryExecution().optimizedPlan().toString().splitlines()
        shuffled = [k for k, line in enumerate(plan) if "Aggregate" in line and "text#" in line]
        # the one aggregate that carries texts stands over the bitmap's hits
        assert len(shuffled) == 1 and any("bitmap" in line and "Filter" in line for line in plan[shuffled[0] : shuffled[0] + 8])
    one = spark.createDataFrame([(k % 3, None if k % 3 == 0 else f"t{k % 3}", k) for k in range(90)], "doc_id long, text string, hit int")
    assert sorted(r.doc_id for r in common.once(one, one.select("doc_id").distinct(), {"doc_id": F.col("doc_id")}).collect()) == [0, 1, 2]
    assert common.once(one, one.where("doc_id = 2").select("doc_id"), {"doc_id": F.col("doc_id")}).count() == 61


@pytest.mark.parametrize("most", [1, 4, 7, 1000])
def test_query_blocks_are_bounded(spark, most):
    """Six hundred queries of one to nine terms: a block has at most the bound and one query above it."""
    vectors = spark.range(600).select(F.col("id").alias("row"), (F.col("id") % 9 + 1).alias("size"))
    blocks = bm25.in_blocks(vectors, most, ranges=8).groupBy("block").agg(F.sum("size").alias("size"), F.count("*").alias("n"), F.max("size").alias("largest")).collect()
    assert sum(b.n for b in blocks) == 600 and all(b.size < most + b.largest for b in blocks)


def test_rows_without_others(spark):
    """The same rows stay whether the others are broadcast or met by a bitmap and a shuffle."""
    df = spark.createDataFrame(rows("a", "b", "c", "a", ids=[1, 2, None, 3]), SCHEMA)
    gone = spark.createDataFrame([(1, "a"), (None, "c"), (3, "x")], "k long, x string")
    for most in (10, 0):
        left = without(df, gone, {"k": F.col("doc_id"), "x": F.col("text")}, most)
        assert left.columns == df.columns and sorted(r.doc_id for r in left.collect()) == [2, 3]


def components(df, texts, **options):
    """The smallest id of each text's group."""
    found = {r.id: r.keep.id for r in near_similarity.near_groups(df, bits=None, **options).collect()}
    return [found.get(i, i) for i in range(len(texts))]


def _varied(rng, base, n, changes):
    """n texts, each base with this many of its words changed, and their exact sets of shingles."""
    texts = []
    for _ in range(n):
        words = [*base]
        for k in rng.choice(len(words), changes, replace=False):
            words[k] = f"n{rng.integers(10**9)}"
        texts.append(words)
    return texts


def _exact_roots(texts, similarity=0.8):
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in texts]
    root = list(range(len(texts)))
    for b in range(len(texts)):
        for a in range(b):
            if root[a] != root[b] and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    return root


def test_near_similarity_is_exact_at_the_threshold(spark):
    rng = np.random.default_rng(12)
    texts = []
    for k in range(40):  # pairs of about 0.79 and of about 0.82
        base = [f"w{x}" for x in rng.integers(0, 5000, 300)]
        texts += [base, *_varied(rng, base, 1, 6 + k % 2)]
    want = _exact_roots(texts)
    assert 10 < sum(r != i for i, r in enumerate(want)) < 30
    df = spark.createDataFrame(rows(*(" ".join(w) for w in texts)), SCHEMA)
    assert components(df, texts) == want


def test_near_similarity_in_long_lists(spark):
    rng = np.random.default_rng(11)
    base = [f"w{x}" for x in rng.integers(0, 5000, 400)]
    # 60 variants of one text, under 0.8 of each other but sharing index keys, and a copy of each at 0.9
    apart = _varied(rng, base, 60, 12)
    texts = apart + [_varied(rng, w, 1, 3)[0] for w in apart]
    df = spark.createDataFrame(rows(*(" ".join(w) for w in texts)), SCHEMA)
    want = _exact_roots(texts)
    assert 20 < len(set(want)) < 62
    for most, block in ((32, 1024), (2, 16)):
        assert components(df, texts, most_postings=most, block_rows=block) == want


def test_packing(odd, empty):
    got = packing.pack(odd, q.tokenizer_path(), flush=2).collect()
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append(r)
    for members in by.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert sum(r.length == 1 for r in got) == 3  # the end id alone
    assert sum(r.doc_id == 2 for r in got) == 2 and sum(r.doc_id is None for r in got) == 1
    long = sorted((r.start, r.length) for r in got if r.doc_id == 7)
    assert [s for s, _ in long] == list(range(0, 2048 * len(long), 2048)) and all(n == 2048 for _, n in long[:-1])
    assert packing.pack(empty, q.tokenizer_path()).count() == 0


def test_best_fit():
    bins = packing.best_fit(np.array([5, 3, 7, 2, 2, 1]), 10)
    assert sorted(map(sorted, bins)) == [[0, 3, 4, 5], [1, 2]]
    assert packing.best_fit(np.array([], dtype=np.int64), 10) == []


def test_tokens_are_the_tokenizers():
    words = WordTokens(q.tokenizer_path(), keep=10)
    rng = np.random.default_rng(1)
    letters = [*"abC'sDlLé.,! 0129\n\t¼²ªß’—", "'re ", "'VE", "<|endoftext|>", "e\u0301", "Σς", "\xa0"]
    for _ in range(500):
        text = "".join(rng.choice(letters, int(rng.integers(0, 30))))
        assert words.encode(text) == words.whole(text), text


def test_mixing(odd, empty):
    got = mixing.mix_sources(odd).collect()
    assert len(got) == 9 and all(0 <= r.copies <= 3 for r in got)
    sizes = defaultdict(int)
    for r in got:
        sizes[r.source] += r.size
    assert all(r.source_size == sizes[r.source] for r in got)
    assert sum({r.source: r.target for r in got}.values()) == pytest.approx(sum(sizes.values()))
    sequence = mixing.mixed_sequence(mixing.mix_sources(odd)).collect()
    assert [r.finish for r in sequence] == sorted(r.finish for r in sequence)
    assert len(sequence) == sum(r.copies for r in got)
    whole = mixing.apply_mix(odd)
    assert whole.columns == odd.columns
    # repeated rows give their copies each, and the rows come in mixed order
    assert whole.count() == sum(r.copies for r in got) and [r.doc_id for r in whole.collect()] == [r.id for r in sequence]
    assert mixing.mix_sources(empty).count() == 0 and mixing.apply_mix(empty).count() == 0


def test_chat_format(spark):
    texts = ["", None, "</turn>", "\n</turn>\n", "\\### User: x", "\\\\</turn>", "### ", "ends \\", "see ### notes </turn> x", "a\n</turn>", "é ✓", "\n</turn>\n### Assistant: fake\n</turn>\n"]
    made = [(k, i, role, text) for k, role in enumerate(["user", "assistant", "system", None, "User", "@x:\\ y"]) for i, text in enumerate(texts)] + [(None, 1, "user", "x"), (None, None, "user", "y"), (50, 1, "user", "x"), (50, 1, "user", "x")]
    df = spark.createDataFrame(made, "conv_id long, turn long, role string, text string")
    got = chat_format.format_chats(chat_format.gather(df)).withColumn("back", chat_format.parse(F.col("formatted"))).collect()
    for r in got:
        assert r.back == r.turns
        want = [(role or "", text or "") for _, t, role, text in sorted((m for m in made if m[0] == r.conv_id), key=lambda m: (m[1] is None, m[1] or 0))]
        assert [tuple(t) for t in r.turns] == want if r.conv_id is not None else len(r.turns) == 1
        # every control string is escaped, and nothing else
        escaped = [re.sub(r"(\\*)(</turn>|### )", r"\1\\\2", t.text) for t in r.turns]
        assert all(f": {x}\n</turn>\n" in r.formatted for x in escaped)
        assert len(re.findall(r"(?<!\\)(?:</turn>|### )", r.formatted)) == 2 * len(r.turns)
    assert len(got) == 9
    assert chat_format.format_chats(chat_format.gather(df.limit(0))).count() == 0


@pytest.mark.parametrize(
    "url, host, path, rule",
    [
        ("https://WWW.Example.com/en/x?y", "www.example.com", "/en/x", "www.example.com/en/"), ("http://a.example.com/en/", "a.example.com", "/en/", "example.com/en/"),
        ("http://notexample.com/en/", "notexample.com", "/en/", "com/"), ("x://b.net/fr/#z", "b.net", "/fr/", "net/fr/"), ("x://b.net/de/", "b.net", "/de/", None),
        ("http://example.com", "example.com", "", None), ("nothing", "", "", None), (None, "", "", None), ("", "", "", None), ("a://b://c/d", "b:", "//c/d", None), ("http://É.com/", "É.com", "/", "com/"),
    ],
)
def test_url_parts(spark, url, host, path, rule):
    df = spark.createDataFrame([(url,)], "url string")
    h, p = url_filter.host_and_path(F.col("url"))
    found, _ = url_filter.rule_of(h, p)
    assert tuple(df.select(h, p, found).first()) == (host, path, rule)


def test_url_model(spark):
    model = url_filter.train(spark)
    urls = ["https://casino-bonus.example.org/win", "http://www.cheap-pills.example.net/de/1", "https://library.example.org/books", "http://blog.garden.example.net/de/4", None, "https://cheap-pills.shop.com/x"]
    df = spark.createDataFrame([(u, "mine", "x", "own") for u in urls], "url string, host string, features string, prediction string")
    judged = url_filter.filter_urls(df, model)
    got = {r.url: r for r in judged.collect()}
    assert [got[u].verdict for u in urls] == ["block", "block", "allow", "allow", got[None].verdict, "allow"]
    # the caller's columns stay, but for those of the result
    assert judged.columns == ["url", "features", "prediction", "host", "path", "rule", "verdict"] and {r.prediction for r in got.values()} == {"own"}
    assert url_filter.filter_urls(df.limit(0), model).count() == 0


def test_url_model_on_held_out_rows(spark):
    """Four folds, each judged by a model that never saw it."""
    accuracy, recall, precision = url_filter.held_out(spark)
    assert accuracy > 0.85 and recall > 0.8 and precision > 0.9


def test_language(spark, odd, empty, sf):
    docs = q.table(spark, sf, "documents")
    model = language_id.train(docs)
    found = {r.id: (r.lang_pred, r.score) for r in language_id.identify(odd, model).collect()}
    assert [found[i] for i in (5, 3, 8)] == [("und", 0.0)] * 3
    assert found[7][0] in model["labels"] and 0 < found[7][1] <= 1
    assert language_id.identify(empty, model).count() == 0
    assert language_id.train(odd) is None
    assert {r.lang_pred for r in language_id.identify(odd, None).collect()} == {"und"}
    assert {r.doc_id for r in language_id.keep_identified(odd, model).collect()} >= {7}
    assert not {r.doc_id for r in language_id.keep_identified(odd, model).collect()} & {5, 3, 8}
    held = q.op5_language_id(spark, sf).join(docs, "doc_id").where("held_out and lang is not null and n_chars > 100")
    assert held.where("lang = lang_pred").count() >= 0.97 * held.count()


def test_language_of_short_texts(spark):
    """Held-out texts under 100 and under 30 characters, by a model that never saw their fold."""
    docs = q.table(spark, "/root/testdata/sf0.1", "documents")
    model = language_id.train(docs.where(language_id.fold_of("doc_id", 4) != 2))
    short = docs.where((language_id.fold_of("doc_id", 4) == 2) & F.col("lang").isNotNull() & (F.length("text") < 100))
    found = short.join(language_id.identify(short, model).withColumnRenamed("id", "doc_id"), "doc_id").where("lang_pred <> 'und'").select("lang", "lang_pred", F.length("text").alias("n")).collect()
    right = lambda rows: sum(r.lang == r.lang_pred for r in rows) / len(rows)
    shortest = [r for r in found if r.n < 30]
    assert len(found) > 30 and right(found) > 0.9 and len(shortest) > 5 and right(shortest) > 0.75


@pytest.mark.parametrize("text, found", [(None, False), ("", False), ("12 ²½ _-", False), ("² a", True), ("é", True), ("中", True)])
def test_letters(text, found):
    assert language_id.has_letter(text) is found


def test_gradients():
    net = language_id.ByteCNN(["a", "b", "c"], length=12, dims=3, filters=4)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    x, y, w = np.random.default_rng(0).integers(0, 256, (5, 12)).astype(np.uint8), np.array([0, 1, 2, 1, 0]), np.full(5, 0.2)
    _, g = net._step(x, y, w)
    for name, at in (("out", (1, 2)), ("w3", (4, 1)), ("b2", (0,)), ("embed", (int(x[0, 3]), 1)), ("bias", (1,))):
        old, losses = net.weights[name][at], []
        for step in (1e-6, -1e-6):
            net.weights[name][at] = old + step
            losses.append(net._step(x, y, w)[0])
        net.weights[name][at] = old
        assert (losses[0] - losses[1]) / 2e-6 == pytest.approx(g[name][at], abs=1e-5)


def test_folded_tables_give_the_network():
    net = language_id.ByteCNN(["a", "b"], length=16)
    x = np.random.default_rng(0).integers(0, 256, (7, 16)).astype(np.uint8)
    model = {"labels": net.labels, "filters": net.filters, "weights": net.weights}
    got = language_id.probabilities(x, model, net.folded(), block=3)
    for k in range(2):
        loss, _ = net._step(x, np.full(7, k), np.ones(7))
        assert loss == pytest.approx(-np.log(got[:, k]).sum(), rel=1e-3)


PAGES = [
    ("<html><body><nav><a>Home</a></nav><div><p>One &amp; two<br>three  <b>bold</b><p>Four</div><footer>f</footer>", "One & two three bold\nFour"),
    ("<body><header>h</header><main><h1>T</h1><ul><li>a<li>b</ul></main><p>outside</p>", "T\na\nb"),
    ("<article><header>Title</header>text<aside>no</aside><form>q<input></form><script>1<2</script><style>x</style></article>", "Title\ntext"),
    ('<div class="cookie-notice">c</div><div id="comments"><p>nice</p></div><p class="lead">yes</p>', "yes"),
    ("<!-- <p>x</p> --><p>a</p><!-- open <p>b</p>", "a"),
    ('<article><h1>T</h1><section id="side-effects"><p>Nausea is common.</p></section></article>', "T\nNausea is common."), ('<article><p class="share-price">It fell.</p></article>', "It fell."),
    ('<article><p class="notice-period">Two months.</p></article>', "Two months."), ("<p><a href=/it's-ok>link</a> It isn't lost</p><p>next</p>", "link It isn't lost\nnext"),
    (f'<article><p>teaser</p></article><div class="story"><p>{"A story. " * 20}</p><p>more</p></div>', f'teaser\n{"A story. " * 20}'.strip() + "\nmore"), ('<a title="a > b" x=>c</a><p class=a=b>d</p>', "c\nd"),
    ('<div class="site-footer">f</div><div class="comment-list">x</div><div class="ad-slot-2">x</div><div class="read-more">y</div>', "y"),
    ("", ""), (None, ""), ("just text", "just text"), ("<p>a</p></div></b><p>b &lt;i&gt; &#233;", "a\nb <i> é"), ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"), ("a < b <c", "a < b"),
]


@pytest.mark.parametrize("page, want", PAGES)
def test_pages(page, want):
    assert html_text.main_text(page, None) == want


def test_wrapper(spark):
    page = lambda i: f"<html><body><div><p>Follow us on the channel</p><p>story {i} of the day</p></div><div class='x'><p>tail {i}</p></div></body></html>"
    made = [(i, "http://h.org/p", page(i)) for i in range(8)] + [(100 + i, "http://copy.org/", "<p>all the same</p>") for i in range(9)] + [(7, None, None), (7, "http://h.org/", ""), (None, "http://h.org/z", page(3))]
    df = spark.createDataFrame(made, "page_id long, url string, html string")
    got = html_text.extract(df).collect()
    assert len(got) == len(made)
    texts = {(r.page_id, r.url): r.text for r in got}
    assert all(texts[i, "http://h.org/p"] == f"story {i} of the day\ntail {i}" for i in range(8))
    assert texts[104, "http://copy.org/"] == "all the same" and texts[7, None] == "" and texts[7, "http://h.org/"] == ""
    shuffled = {(r.page_id, r.url): r.text for r in html_text.extract(df, broadcast_bytes=-1).collect()}
    assert shuffled == texts
    assert html_text.extract(df.limit(0)).count() == 0


def test_wrapper_counts_all_texts(spark):
    for n in (8, 12, 30):
        blocks = lambda i: "".join(f"<p>story {i} part {k}</p>" for k in range(n))  # noqa: B023, E731
        made = [(i, "http://h.org/p", f"<html><body><div>{blocks(i)}<p>Follow us on the channel</p></div></body></html>") for i in range(20)]
        got = html_text.extract(spark.createDataFrame(made, "page_id long, url string, html string")).collect()
        assert {r.page_id: r.text for r in got} == {i: "\n".join(f"story {i} part {k}" for k in range(n)) for i in range(20)}


def test_wrapper_alone_takes_out_what_returns(spark):
    """No telling element or class: constant notices and rotating menus go by the wrapper, varying blocks stay."""
    menus = [f"<div class='q1'><a>menu {k}</a><a>item {k}</a></div>" for k in range(3)]
    page = lambda i: f"<html><body><div class='q0'>We value you</div>{menus[i % 3]}<div class='q2'><p>story {i}</p><p>more {i}</p></div><div class='q3'>© site {i % 2}</div></body></html>"
    df = spark.createDataFrame([(i, "http://h.org/p", page(i)) for i in range(24)], "page_id long, url string, html string")
    for hints in (True, False):
        assert {r.page_id: r.text for r in html_text.extract(df, hints=hints).collect()} == {i: f"story {i}\nmore {i}" for i in range(24)}


def test_heaviest_increasing():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = int(rng.integers(0, 9))
        orders, weights = rng.permutation(n).tolist(), rng.integers(1, 5, n).tolist()
        got = html_text.heaviest_increasing(orders, weights)
        assert all(orders[a] < orders[b] for a, b in zip(got, got[1:], strict=False)) and got == sorted(set(got))
        some = [[k for k in range(n) if m >> k & 1] for m in range(1 << n)]
        rising = [c for c in some if all(orders[a] < orders[b] for a, b in zip(c, c[1:], strict=False))]
        assert sum(weights[k] for k in got) == max(sum(weights[k] for k in c) for c in rising)


def test_deep_and_long_pages(spark):
    """Markup of any depth and lists of any length, in seconds, and odd columns of the input."""
    deep = "<div>" * 5000 + "deep" + "</div>" * 5000
    inline = "<b>" * 20_000 + "thin" + "<p>after</p>" + "</i>" * 20_000
    wide = "".join(f"<p class='c{k}'>text {k} of @</p>" for k in range(20_000))
    mixed = "".join(f"<h2 class='a{k % 7}'>head {k} @</h2><p>text {k} of @</p>" for k in range(2000))
    back = "".join(f"<p class='c{k}'>text {k} of @</p>" for k in range(20_000, 0, -1))
    made = [(k, "http://h.org/", f"<html><body>{x.replace('@', str(5 * k + i))}<!-- {i} --></body></html>") for k, x in enumerate((deep, inline, wide, mixed, back)) for i in range(5)]
    df = spark.createDataFrame(made, "page_id long, url string, html string").withColumns({c: F.lit("x") for c in ("host", "wrapper", "text", "node", "h", "p")})
    start = time.monotonic()
    got = {r.page_id: r.text for r in html_text.extract(df).collect()}
    assert time.monotonic() - start < 60
    assert got[0] == "deep" and got[1] == "thin\nafter" and got[2].count("\n") == 19_999 and got[3].count("\n") == 3999 and got[4].startswith("text 20000 of 2")


@pytest.mark.parametrize("made", [
    "<blockquote>" * 100_000 + "x", "<ul><li>" * 50_000 + "x", "<table>" * 100_000 + "x", "<b><blockquote>" * 20_000 + "</b>" * 20_000 + "x", "<blockquote>" * 20_000 + "<li></li>" * 20_000 + "x",
    '<a href="' * 50_000 + "><p>x", "<a b='" * 30_001 + "><p>x", "<a" + " " * 500_000 + ">x", "<p>" + "<i>" * 50_000 + "x<p>y" * 10,
])
def test_any_nesting_is_linear(made):
    start = time.monotonic()
    nodes, blocks = html_text.parse(made)
    html_text.align(nodes, {n.path: (0.5, False, frozenset()) for n in nodes})
    assert time.monotonic() - start < 20 and blocks


def test_no_word_vanishes_and_no_text_is_slow():
    """Letters without a class stay, words of letters stay beside their restored form, and long texts end in seconds."""
    decoder = toxicity.Decoder(toxicity.language_model(np.ones(toxicity.CLASSES**4, np.int64)))
    for text in ("длинношеее животное и змееед", "日日日本 text", "Παααρα κάτι", "stuuupid www aaa", "смешaaaной þþþorn"):
        assert set(text.lower().split()) <= set(decoder.text(text).split())
    assert "смеш" in decoder.text("смешaa4ной") and "ной" in decoder.text("смешaa4ной")
    coded = base64.b64encode(np.random.default_rng(0).bytes(300_000)).decode()
    for text in ("ab" * 500_000, "a" * 1_000_000, "ab" * 100_000 + "aaa", "日本語文字" * 20_000, "日日日本" * 25_000 + " a1b", "ж" * 1_000_000 + " a1", coded, ("x" * 2 + "y") * 20_000 + " h4te", "a" + " " * 1_000_000 + "1"):
        start = time.monotonic()
        assert len(decoder.text(text)) > 1
        assert time.monotonic() - start < 30


def test_toxicity(spark, odd, empty, sf):
    docs, labels = q.table(spark, sf, "documents"), q.table(spark, sf, "labels")
    trained = toxicity.train(docs, docs.join(labels, "doc_id"))
    scored = {r.id: r.score for r in toxicity.score(odd, trained).collect()}
    assert all(0 <= s <= 1 for s in scored.values()) and scored[5] == scored[3]
    assert toxicity.score(empty, trained).count() == 0
    untrained = toxicity.train(empty, empty.withColumn("toxic", F.lit(1)))
    assert all(r.score < 1e-9 for r in toxicity.score(odd, untrained).collect())
    decoder = toxicity.Decoder(trained["model"])
    shown = {
        "idiot": ("1d10t", "i d i o t", "i_d_i_o_t", "i   d   i   o   t", "i|d|i|o|t", "id*ot"), "stupid": ("stuuuupid", "a s t u p i d man", "s\nt\nu\np\ni\nd", "stupid!!!"),
        "loser": ("l.o.s.e.r", "l0$3r"), "trash": ("tr@sh", "(trash)", "t-r-a-s-h"),
    }
    for word, ways in shown.items():
        for way in ways:
            assert word in decoder.text(f"the {way} of").split(), way
    # a long spaced-out text is decoded as one lattice, with gaps
    said = decoder.text(" ".join("the idiot and the stupid loser of trash".replace(" ", "") * 20)).replace(" ", "")
    assert "idiot" in said and "stupid" in said
    assert "strent" in decoder.text("strent###").split() and "onea" in decoder.text("onea***").split()
    assert decoder.text("The plain text, of 2024.").split() == ["the", "plain", "text", "of", "2024"]


def test_may_hide_agrees_with_the_pattern():
    rng = np.random.default_rng(2)
    letters = list("ab 1$.-éA|_\n")
    for _ in range(3000):
        text = "".join(rng.choice(letters, int(rng.integers(0, 14)))).lower()
        if toxicity._DISGUISED.search(text):
            assert toxicity._may_hide(text.encode("latin-1")), text


def brute_decode(model, token):
    """The likeliest reading by trying them all."""
    from itertools import product

    best = (-1e9, "")
    for made in product(*toxicity.Decoder.lattice(token)):
        text, cost = "".join(x for x, _ in made), sum(c for _, c in made)
        codes = [0, 0, 0, *(0 if x == " " else ord(x) - 96 for x in text + " ")]
        best = max(best, (cost + sum(float(model[tuple(codes[i : i + 4])]) for i in range(len(codes) - 3)), text.strip()))
    return best[1]


def test_viterbi_is_brute(spark):
    rng = np.random.default_rng(8)
    counts = rng.integers(0, 50, toxicity.CLASSES**4) * (rng.random(toxicity.CLASSES**4) < 0.02)
    model = toxicity.language_model(counts)
    decoder = toxicity.Decoder(model)
    for token in ("1d10t", "a s t u", "st*pid", "$h|t", "aaa!1", "x_y_z", "b**d", "s  o  0"):
        assert decoder.decode(token) == brute_decode(model, token)


def test_toxicity_on_held_out_labels(spark, sf):
    """The model never saw these labels: few clean documents are marked, most toxic ones are."""
    sf = sf.replace("0.001", "0.1")
    found = q.op8_toxicity(spark, sf).where("held_out").join(q.table(spark, sf, "labels"), "doc_id").groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in found}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.85 and n[1, 1] / (n[1, 1] + n.get((0, 1), 0)) > 0.97


def brute_bm25(texts, query, k):
    import math

    counts = {i: bm25.terms_of(x) for i, x in texts}
    mean = sum(c.total() for c in counts.values()) / len(counts)
    scores = []
    for i, c in counts.items():
        s = 0.0
        for term, n in bm25.terms_of(query).items():
            df = sum(term in x for x in counts.values())
            if term in c:
                s += n * math.log(1 + (len(counts) - df + 0.5) / (df + 0.5)) * c[term] * 2.2 / (c[term] + 1.2 * (0.25 + 0.75 * c.total() / mean))
        if s > 0:
            scores.append((-s, i))
    return sorted(scores)[:k]


def test_bm25(spark, odd, empty, sf, monkeypatch):
    monkeypatch.setattr(bm25, "SHARD", 48)
    docs = q.table(spark, sf, "documents").select("doc_id", "text").repartition(3)
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    asked = docs.where("doc_id % 40 = 0").select(F.col("doc_id").alias("query_id"), "text")
    got = defaultdict(list)
    for r in bm25.search(docs, asked, 5, block_terms=100).collect():
        got[r.query_id].append((r.rank, r.id, r.score))
    for i, text in texts:
        if i % 40 == 0:
            want = brute_bm25(texts, text, 5)
            assert [s for _, _, s in sorted(got[i])] == pytest.approx([-s for s, _ in want], rel=1e-5)
            assert got[i] and sorted(got[i])[0][0] == 1
    some = odd.select(F.col("doc_id").alias("query_id"), "text")
    assert {r.query_id for r in bm25.search(odd, some, 3).collect()} == {4, 2, None, 7, 1}
    assert bm25.search(empty, some, 3).count() == 0 and bm25.search(odd, some.limit(0), 3).count() == 0


def test_bm25_asks_each_row(spark):
    """Queries with one id are asked each; ids may be of other types."""
    asked = spark.createDataFrame([(7, "alpha"), (7, "gamma"), (8, "alpha alpha")], "query_id short, text string")
    for kind in ("string", "short", "date"):
        docs = spark.createDataFrame([(1, "alpha beta"), (2, "gamma"), (3, "gamma delta delta")], "n int, text string")
        docs = docs.select((F.date_add(F.lit("2020-01-01").cast("date"), F.col("n")) if kind == "date" else F.col("n").cast(kind)).alias("doc_id"), "text")
        one, two, three = (r.doc_id for r in docs.collect())
        got = sorted((r.query_id, r.rank, r.id) for r in bm25.search(docs, asked, 3).collect())
        assert got == sorted([(7, 1, one), (7, 1, two), (7, 2, three), (8, 1, one)])


def test_bm25_pruned_is_brute(spark, monkeypatch):
    """Blocks of two documents, few frequent terms: what pruning leaves out is never in the top k, ties included."""
    monkeypatch.setattr(bm25, "BLOCK", 2)
    rng = np.random.default_rng(4)
    texts = [(i, " ".join(f"w{min(int(x), 60)}" for x in rng.zipf(1.3, int(rng.integers(0, 30))))) for i in range(300)]
    texts += [(300 + i, texts[i][1]) for i in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(2)
    asked = spark.createDataFrame(texts[::7], "query_id long, text string")
    got = defaultdict(list)
    for r in bm25.search(docs, asked, 5, max_frequent=8).collect():
        got[r.query_id].append((r.rank, r.id, r.score))
    for i, text in texts[::7]:
        want = brute_bm25(texts, text, 5)
        assert [s for _, _, s in sorted(got[i])] == pytest.approx([-s for s, _ in want])
        tied = [-s for s, _ in want]
        exact = [(k, d) for k, (s, d) in enumerate(want) if sum(abs(s + t) < 1e-9 for t in tied) == 1]
        assert all(sorted(got[i])[k][1] == d for k, d in exact)
