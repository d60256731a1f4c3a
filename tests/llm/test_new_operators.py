"""License scans, spelling variants and embedding whitening against plain Python, and on odd inputs."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from sampleprep.llm import licenses, spelling, whitening
from sampleprep.llm import queries as q

TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, mark string, pos int, short string, spans string, n string, key string, copies int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, x, "m", 1, "s", "p", "n", "k", 2) for i, x in rows], DOCS)


# ---- licenses ------------------------------------------------------------------------------------------------------

PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def base_places(text):
    words = LICENSE_WORD.findall((text or "").translate(TO_LOWER))
    hits = []
    for phrase, label in PHRASES.items():
        split = phrase.split()
        hits += [(k, label) for k in range(len(words)) if words[k : k + len(split)] == split]
    starts = [k for k, _ in hits]
    return len(words), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in hits}))


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_license_query_has_all_base_places(spark, folder):
    sf = f"/root/testdata/{folder}"
    rows = q.op11_license_scan(spark, sf).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_places(docs[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert (r.score > 0) == (r.labels != "")


NOTICE = next(t for t in licenses.OWN if t.label == "mit").text


def varied_notice(drop=(), put=()):
    words = NOTICE.split()
    for k in put:
        words[k] = f"{words[k]} really"
    return " ".join(w for k, w in enumerate(words) if k not in drop)


def test_license_cases(spark):
    many = "MIT License; " * 3000
    texts = [
        (1, None), (2, ""), (3, " \n"), (4, "mit"), (5, "The MIT-LICENSE and mit license."), (6, "CC BY-NC-SA 4.0"), (7, f"Intro. {NOTICE} End."),
        (8, varied_notice(drop=(12, 30), put=(20, 40))), (9, varied_notice(drop=range(5, 45))), (10, many), (None, "apache license"), (5, "The MIT-LICENSE and mit license."),
        (5, "other text"), (11, "mıt license MIT LICENSE émit license mit licenses"), (12, "gnu general public public license gnu general public license"), (13, "x" * 3_000_000 + " cc by"),
    ]
    rows = licenses.scan_licenses(docs_of(spark, texts)).collect()
    assert len(rows) == len(texts)
    text_of = defaultdict(list)
    for i, x in texts:
        text_of[i].append(base_places(x)[:4])
    for r in rows:
        starts = [s["first"] for s in r.spans if s["base"]]
        assert (r.n_words, len(starts), min(starts, default=None), max(starts, default=None)) in text_of[r.id]
    labels = {r.id: sorted({s["label"] for s in r.spans if not s["base"]}) for r in rows if r.id != 5}
    assert labels[6] == ["cc-by-nc-sa"] and labels[7] == ["mit"] and labels[8] == ["mit"] and labels[9] == []
    spans = {r.id: r.spans for r in rows}
    assert [(s["first"], s["last"], s["share"]) for s in spans[7]] == [(1, len(LICENSE_WORD.findall(NOTICE)), 1.0)]
    assert 0.8 <= spans[8][0]["share"] < 1 and len(spans[10]) == 3000 and spans[None][0]["label"] == "apache"
    assert licenses.scan_licenses(docs_of(spark, [])).count() == 0


def test_license_hashes_are_only_candidates(spark, monkeypatch):
    """With hashes that all collide, the words still decide."""
    monkeypatch.setattr(licenses, "rolling", lambda hashes, k: np.zeros(max(0, len(hashes) - k + 1), dtype=np.int64))
    rows = licenses.votes(docs_of(spark, [(1, "a b c mit license")]), licenses.BASE, "doc_id", "text", (2, 4)).collect()
    assert {r.template for r in rows} >= {None, 1, 2, 3}
    held = licenses.verified("a b c MIT license", [{"template": k, "low": d, "high": d} for k in range(4) for d in range(5)], licenses.BASE, 8)
    assert [(s["label"], s["first"]) for s in held] == [("mit", 3)]


def test_common_words_are_the_longest():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = ([bytes([97 + int(x)]) for x in rng.integers(0, 4, int(rng.integers(0, 12)))] for _ in range(2))
        table = defaultdict(int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i, j] = table[i - 1, j - 1] + 1 if x == y else max(table[i - 1, j], table[i, j - 1])
        n, first, last = licenses.common_words(a, b)
        assert n == table[len(a) - 1, len(b) - 1] and (not n or (a[first] in b and a[last] in b))


def test_words_in_pieces(monkeypatch):
    text = "MIT licence, Étude 42 naïve—dash_under " * 50
    whole = licenses.word_hashes(text)
    monkeypatch.setattr(licenses, "_PIECE", 7)
    assert (licenses.word_hashes(text) == whole).all() and len(whole) == len(LICENSE_WORD.findall(text.translate(TO_LOWER)))


# ---- spelling ------------------------------------------------------------------------------------------------------


def brute_words(rows, least=7):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(TO_LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            n[word] += len(word) >= least
    return {w: k for w, k in n.items() if k >= 2}


def one_apart(a, b):
    a, b = sorted((a, b), key=len)
    if a == b or len(b) - len(a) > 1:
        return False
    at = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[at + 1 :] == b[at + 1 :] if len(a) == len(b) else a[at:] == b[at + 1 :]


def brute_variants(n, times=10):
    by_cut = defaultdict(set)
    for w in n:
        for cut in {w, *(w[:k] + w[k + 1 :] for k in range(len(w)))}:
            by_cut[cut].add(w)
    near = defaultdict(set)
    for group in by_cut.values():
        for a in group:
            near[a] |= {b for b in group if one_apart(a, b)}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best and n[best] >= times * n[w]:
            form[w] = best
    made = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        made.add((w, form.get(w), root, n[w], len(near[w]), n.get(form.get(w))))
    return made


def got_variants(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_spelling_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got_variants(q.op12_spelling_variants(spark, sf)) == brute_variants(brute_words(rows))


@pytest.mark.parametrize("most", [2, 64, 4096])
def test_spelling_buckets_of_any_size(spark, most):
    """Few letters and shared parts, so that buckets are dealt again down to one place; each pair is counted once."""
    rng = np.random.default_rng(5)
    words = {"".join("ab"[int(x)] for x in rng.integers(0, 2, int(rng.integers(1, 9)))) for _ in range(400)}
    words |= {"straße" + "".join("éab"[int(x)] for x in rng.integers(0, 3, 3)) for _ in range(40)} | {"z" * k for k in range(1, 40)}
    n = {w: int(10 ** rng.integers(0, 5)) + int(rng.integers(0, 3)) for w in words}
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    assert got_variants(spelling.group_variants(df, most_words=most)) == brute_variants(n)


def test_small_buckets_are_dealt_again(spark):
    words = [f"prefix{a}{b}{c}" for a in "abcdef" for b in "abcdef" for c in "abcdef"]
    df = spark.createDataFrame([(w, 1 + k) for k, w in enumerate(words)], "word string, n long")
    dealt = spelling.buckets(df, 64)
    assert dealt.where("b - a < 4").count() > 0
    assert dealt.groupBy("key").count().agg({"count": "max"}).first()[0] <= 64


def test_spelling_cases(spark):
    rows = [
        (1, None), (2, ""), (3, "short Words only 12345678"), (None, "Étudiant étudiant ÉTUDIANT"), (4, "testing testing Testing TESTING testing testing testing testing testing testing"),
        (5, "testin testingx testings testings testing"), (5, "testin testingx testings testings testing"), (7, "abcdefg×hijklmn÷"), (8, "abcdefg×hijklmn÷"),
    ]
    assert got_variants(spelling.group_variants(spelling.vocabulary(docs_of(spark, rows)))) == brute_variants(brute_words(rows))
    long = "abcdefghij" * 20_000
    n = {long: 5, long[:70_000] + "z" + long[70_000:]: 3, long[:-1]: 60, long[:100] + "zz" + long[102:]: 1}
    made = spelling.group_variants(spark.createDataFrame(list(n.items()), "word string, n long")).collect()
    assert {(len(r.word), r.n, r.n_near, r.form_n) for r in made} == {(200_000, 5, 2, 60), (200_001, 3, 1, None), (199_999, 60, 1, None), (200_000, 1, 0, None)}
    assert spelling.group_variants(spelling.vocabulary(docs_of(spark, []))).count() == 0


# ---- whitening -----------------------------------------------------------------------------------------------------


def brute_whitening(vectors, weights=None):
    x = np.floor(256 * np.array(vectors, dtype=float)).astype(np.int64)
    distinct, copies = np.unique(x, axis=0, return_counts=True)
    w = np.ones(len(distinct), dtype=np.int64) if weights is None else copies
    n, total = int(w.sum()), (distinct * w[:, None]).sum(0)
    centre = (n * distinct - total) / n
    v = (centre * w[:, None]).T @ centre / n
    e, axes = np.linalg.eigh(v)
    e, axes = e[::-1], axes[:, ::-1]
    k = min(4, len(e))
    white = ((n * x - total) / n) @ axes[:, :k] / np.sqrt(e[:k])
    return n, ((n * x - total) ** 2).sum(1), white, e[:k] / e.sum()


def hold(rows, vectors, weights=None):
    n, deviation, white, explained = brute_whitening(vectors, weights)
    k = white.shape[1]
    rows = sorted(rows, key=lambda r: (r[0], r.component))
    assert len(rows) == len(vectors) * k
    got = np.array([r.whitened for r in rows]).reshape(-1, k)
    signs = np.sign((got * white).sum(0))
    assert np.allclose(got, white * signs, atol=1e-8)
    assert {r.n for r in rows} == {n} and [r.deviation for r in rows[::k]] == deviation.tolist()
    assert np.allclose([r.explained for r in rows[:k]], explained, rtol=1e-9) and all(r.identity_error < 1e-9 for r in rows)
    assert len({r.identity_error for r in rows}) == 1


def test_whitening_query(spark, sf):
    table = sorted(spark.read.parquet(f"{sf}/embeddings.parquet").collect(), key=lambda r: r.vec_id)
    hold(q.op13_embedding_whitening(spark, sf).collect(), [r.embedding for r in table])


VECTORS = "vec_id long, embedding array<float>, x string, key string, copies int, weight int, component string, n string"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, "x", "k", 1, 2, "c", "n") for i, v in rows], VECTORS)


@pytest.mark.parametrize("weights", ["one", "copies"])
def test_whitening_weights(spark, weights):
    rng = np.random.default_rng(2)
    base = (rng.normal(size=(40, 6)) @ np.diag([3, 2, 1.5, 1, 0.5, 0.2])).astype(np.float32)
    picked = base[np.concatenate([np.arange(40), np.zeros(200, dtype=int), rng.integers(0, 40, 60)])]
    rows = whitening.whiten(vectors_of(spark, [(k, v.tolist()) for k, v in enumerate(picked)]), weights=weights).collect()
    hold(rows, picked, None if weights == "one" else "copies")


def test_whitening_cases(spark):
    nan, inf = float("nan"), float("inf")
    usable = [(1, [0.1, -0.2, 0.3]), (2, [0.5, 0.1, -0.0]), (3, [-1.0, 0.25, 7.0]), (None, [0.1, -0.2, 0.3]), (3, [2.0, 3.0, -4.0])]
    rows = [*usable, (4, None), (5, []), (6, [1.0, None, 2.0]), (7, [1.0, nan, 2.0]), (8, [1.0, inf, 2.0]), (9, [1.0, 2.0])]
    made = whitening.whiten(vectors_of(spark, rows)).collect()
    assert Counter((r.id, r.component) for r in made) == Counter((i, c) for i, _ in usable for c in (1, 2, 3))
    assert {r.n for r in made} == {4} and all(r.whitened is not None for r in made)
    one = whitening.whiten(vectors_of(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained) for r in one] == [(1, 0, None, 0.0)] * 4
    line = whitening.whiten(vectors_of(spark, [(k, [k * 0.5, k * 1.0]) for k in range(5)])).collect()
    assert {(r.component, r.whitened is None) for r in line} == {(1, False), (2, True)} and max(r.identity_error for r in line) < 1e-9
    assert whitening.whiten(vectors_of(spark, [])).count() == 0 and whitening.whiten(vectors_of(spark, [(1, None)])).count() == 0


def test_deviations_beyond_a_long(spark):
    far = [(1, [3e38, 0.0]), (2, [-3e38, 0.5]), (3, [0.0, 1.0])]
    made = {(r.id, r.component): r for r in whitening.whiten(vectors_of(spark, far)).collect()}
    assert made[1, 1].deviation is None and made[3, 1].n == 3
    sums = (10**15, -(10**15))
    x = np.array([[10**15, 5], [7, -(10**14)]])
    assert whitening.deviations(whitening.centred(x, 10**6, sums)) == [s if (s := sum((10**6 * int(v) - t) ** 2 for v, t in zip(r, sums, strict=True))) < 2**63 else None for r in x]
    exact = whitening.centred(np.array([[3, 4]]), 2**61, (1, 2))
    assert exact.tolist() == [[3 * 2**61 - 1, 4 * 2**61 - 2]]
