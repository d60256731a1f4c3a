"""Queries over the smallest tables against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from functools import cache
from html.parser import HTMLParser

import numpy as np
import pytest
import xxhash
from pyspark.ml.feature import HashingTF
from tokenizers import Tokenizer

from sampleprep.llm import bm25, html_text, url_filter
from sampleprep.llm import queries as q
from sampleprep.llm.common import table


@pytest.fixture(scope="module")
def docs(spark, sf):
    return {r.doc_id: r for r in table(spark, sf, "documents").collect()}


def test_packing(spark, sf, docs):
    rows = q.op1_best_fit_packing(spark, sf).collect()
    tokenizer = Tokenizer.from_file(q.tokenizer_path())
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    assert pieces.keys() == docs.keys()
    total = 0
    for i, d in docs.items():
        ids = tokenizer.encode(d.text or "", add_special_tokens=False).ids + [0]
        total += len(ids)
        got = sorted(pieces[i], key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length) for r in got] == [(k, s, min(2048, len(ids) - s)) for k, s in enumerate(range(0, len(ids), 2048))]
        assert [r.ids_crc32 for r in got] == [zlib.crc32(np.array(ids[s : s + 2048], dtype="<u4").tobytes()) for s in range(0, len(ids), 2048)]
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append(r)
    for members in by.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert len(by) <= -(-total // 2048) * 1.02 + 2


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps, bits=3):
    """{id: smallest id reached} by comparing all pairs."""
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, i in enumerate(ids):
        for j in ids[:n]:
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}


def test_simhash(spark, sf, docs):
    rows = q.op3_simhash(spark, sf).collect()
    fps = {i: brute_fingerprint(d.text) for i, d in docs.items()}
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{f:016x}" for i, f in fps.items()}
    assert {r.doc_id: r.component_id for r in rows} == components(fps)


def test_exact(spark, sf, docs):
    groups = defaultdict(list)
    for i, d in docs.items():
        groups[hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", d.text or "").encode()).hexdigest()].append(i)
    want = {(i, min(g), len(g), i == min(g), h) for h, g in groups.items() for i in g}
    assert {tuple(r) for r in q.op2_exact_dedup(spark, sf).collect()} == want


def brute_targets(sizes, weights=(1, 2, 3), cap=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    full, left = {}, float(sum(sizes.values()))
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in order if x not in full) for s in order if s not in full}
        over = [s for s in share if share[s] > cap * sizes[s]]
        if not over:
            return full | share
        for s in over:
            full[s] = cap * sizes[s]
            left -= full[s]


def test_mixing(spark, sf, docs):
    rows = q.op9_mix_sources(spark, sf).collect()
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", d.text or "")) for i, d in docs.items()}
    by = defaultdict(int)
    for i, d in docs.items():
        by[d.source] += size[i]
    targets, taken = brute_targets(by), defaultdict(int)
    assert {r.doc_id for r in rows} == docs.keys()
    for r in rows:
        source = docs[r.doc_id].source
        assert (r.size, r.source_size) == (size[r.doc_id], by[source])
        assert r.target == pytest.approx(targets[source])
        assert r.taken in {k * r.size for k in range(4)}
        taken[source] += r.taken
    longest = max(size.values())
    assert all(abs(taken[s] - targets[s]) <= 2 * longest for s in by)
    assert 0 <= sum(by.values()) - sum(taken.values()) <= longest
    again = {(r.doc_id, r.taken) for r in q.op9_mix_sources(spark, sf).collect()}
    assert again == {(r.doc_id, r.taken) for r in rows}


def naive_wrappers(pages):
    """By host the order, template flag and template texts of each path, and the common ones under None, counted in plain Python over all distinct pages."""
    shared = defaultdict(lambda: defaultdict(lambda: [0, 0.0, 0]))
    texts, total = defaultdict(lambda: defaultdict(int)), defaultdict(int)
    for host, page in {(h, p) for h, p in pages if p}:
        nodes, blocks = html_text.parse(page)
        found = {(n.path, t) for t, n, _, _ in blocks}
        total[host] += 1
        for node in nodes:
            told = shared[host][node.path]
            siblings = [*node.parent.children.values()] if node.parent else [node]
            told[0] += 1
            told[1] += (siblings.index(node) + 0.5) / len(siblings) if node.parent else 0
            told[2] += sum(path == node.path for path, _ in found)
        for key in found:
            texts[host][key] += 1
    facts = defaultdict(dict)
    for host, nodes in shared.items():
        for path, (n, order, told) in nodes.items():
            if n >= max(4, 0.01 * total[host]):
                here = {t: k for (p, t), k in texts[host].items() if p == path and k >= 2}
                always = {t for t, k in here.items() if k >= 0.4 * n}
                facts[path][host] = (n, round(order / n, 6), sum(here[t] for t in here.keys() - always), told - sum(here[t] for t in always), always)
    hosts = {h for by in facts.values() for h in by}
    made = {h: {} for h in [*hosts, None]}
    for path, by in facts.items():
        back, varying = sum(f[2] for f in by.values()), sum(f[3] for f in by.values())
        known = len(by) >= max(4, 0.01 * len(hosts))
        if known:
            made[None][path] = (round(sum(f[1] for f in by.values()) / len(by), 6), varying > 0 and back >= 0.5 * varying, set())
        for host, (n, order, b, v, always) in by.items():
            returns = b + 400 * back / varying >= 0.5 * (v + 400) if known and varying > 0 else n >= 8 and b >= 0.5 * v
            made[host][path] = (order, v > 0 and returns, always)
    return made


def naive_match(node, wrapper):
    """(weight, aligned places) of a subtree by the quadratic dynamic programme of simple tree matching."""
    ours = [c for c in node.children.values() if c.path in wrapper]
    theirs = sorted((c.path for c in ours), key=lambda p: wrapper[p][0])
    sub = {c.path: naive_match(c, wrapper) for c in ours}
    best = [[(0, ())] * (len(theirs) + 1) for _ in range(len(ours) + 1)]
    for i, c in enumerate(ours):
        for j, p in enumerate(theirs):
            met = best[i][j][0] + sub[p][0], best[i][j][1] + (p,)
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], met if c.path == p else (0, ()), key=lambda x: x[0])
    weight, paths = best[-1][-1]
    return weight + 1, {node.place}.union(*(sub[p][1] for p in paths))


def test_html_text(spark, sf):
    sf = sf.replace("0.001", "0.01")  # hosts of enough pages for a wrapper
    rows = table(spark, sf, "pages").collect()
    host = lambda url: re.match(r"(?s)(?:.*?://([^/?#]*))?", url or "")[1] or ""
    wrappers = naive_wrappers([(host(r.url).lower(), r.html) for r in rows])
    want, alone = {}, 0
    for r in rows:
        nodes, blocks = html_text.parse(r.html or "")
        told = {}
        for wrapper in (wrappers[None], wrappers.get(host(r.url).lower(), {})):
            told |= {p: wrapper[nodes[p].path] for p in naive_match(nodes[0], wrapper)[1] if nodes[p].path in wrapper}
        template = lambda b: b[1].place in told and (told[b[1].place][1] and not b[3] or b[0] in told[b[1].place][2])  # noqa: B023, E731
        kept = [b for b in blocks if not b[2]]
        kept = [b for b in kept if not template(b)] or kept
        inside, beside = sum(len(b[0]) for b in kept if b[3]), defaultdict(int)
        for b in kept:
            beside[b[1].parent.place] += 0 if b[3] else len(b[0])
        large = [p for p, n in beside.items() if n > max(inside, 100) and n == max(beside.values())][:1]
        if any(b[3] for b in kept):
            kept = [b for b in kept if b[3] or b[1].parent.place in large]
        want[r.page_id] = "\n".join(b[0] for b in kept)
        alone += sum(bool(template(b)) for b in blocks if b[2])
    got = {r.page_id: r.text for r in q.op6_html_text(spark, sf).collect()}
    assert got == want and alone > 0


class Articles(HTMLParser):
    """The texts of a page's article by the standard library's parser: a block ends where a block element begins or ends."""

    BLOCKS = {"article", "h1", "h2", "h3", "p", "ul", "ol", "li", "div", "section", "blockquote", "table", "tr", "td", "aside", "form", "nav", "footer", "header", "body"}
    SKIPPED = {"script", "style", "aside", "form", "nav", "footer"}

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.depth, self.skipped, self.parts, self.found, self.divs = 0, 0, [], [], []
        self.feed(page)
        self.close()
        self.end()

    def end(self):
        text = re.sub(r"\s+", " ", "".join(self.parts)).strip()
        self.found += [text] if text else []
        self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag in self.BLOCKS:
            self.end()
        self.depth += tag == "article"
        if tag == "div":
            self.divs.append(dict(attrs).get("class") in ("ad", "comments"))
            self.skipped += self.divs[-1]
        self.skipped += tag in self.SKIPPED
        if tag == "br":
            self.parts.append(" ")

    def handle_endtag(self, tag):
        if tag in self.BLOCKS:
            self.end()
        self.depth -= tag == "article"
        self.skipped -= tag in self.SKIPPED
        if tag == "div" and self.divs:
            self.skipped -= self.divs.pop()

    def handle_data(self, data):
        if self.depth and not self.skipped:
            self.parts.append(data)


def test_html_text_by_another_parser(spark, sf):
    """The given pages have one article each; the wrappers find it with the rules beside them and without."""
    pages = {r.page_id: r.html for r in table(spark, sf.replace("0.001", "0.1"), "pages").collect()}
    want = {k: "\n".join(Articles(h or "").found) for k, h in pages.items()}
    got = {r.page_id: r.text for r in q.op6_html_text(spark, sf.replace("0.001", "0.1")).collect()}
    assert got == want
    alone = {r.page_id: r.text for r in html_text.extract(table(spark, sf.replace("0.001", "0.1"), "pages"), hints=False).collect()}
    assert sum(alone[k] == want[k] for k in want) >= 0.95 * len(want)


def plain_url(url):
    """Host, path and the longest rule that fits, by string operations."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url[url.index("://") + 3 :]
    end = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:].split("?")[0].split("#")[0]
    fitting = [(len(h + p), h + p, act) for act, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fitting)[1:] if fitting else (None, None))


def test_url_filter(spark, sf):
    """Every page's host, path and rule; without a rule, the verdict of weights added up for its n-grams one by one."""
    model = url_filter.train(spark)
    place, weights = cache(HashingTF(numFeatures=model.numFeatures).indexOf), model.coefficients.toArray()
    found = {r.page_id: r for r in q.op4_url_filter(spark, sf).collect()}
    pages, judged = q.table(spark, sf, "pages").collect(), 0
    assert len(found) == len(pages)
    for page in pages:
        host, path, rule, action = plain_url(page.url)
        got = found[page.page_id]
        assert (got.host, got.path, got.rule) == (host, path, rule)
        if action is None:
            marked = f".{host}." if host else ""
            grams = {kind + text[i : i + n] for kind, text in (("h", marked), ("p", path)) for n in (3, 4) for i in range(len(text) - n + 1)}
            score = model.intercept + sum(weights[i] for i in {place(g) for g in grams})
            action, judged = "block" if 1 / (1 + math.exp(-score)) > model.getThreshold() else "allow", judged + 1
        assert got.verdict == action, page.url
    assert judged > 10


def test_topk_query(spark, sf, docs):
    """The registered query against a scan of all texts: the ten best scores of every query, and its rows where scores differ."""
    counts = {i: bm25.terms_of(r.text) for i, r in docs.items()}
    df = Counter(t for c in counts.values() for t in c)
    n, mean = len(counts), sum(c.total() for c in counts.values()) / len(counts)
    got = defaultdict(list)
    for r in q.op7_topk_bm25(spark, sf).collect():
        got[r.query_id].append((r["rank"], r.score, r.doc_id))
    for i in (i for i in counts if i % 20 == 0):
        want = []
        for d, c in counts.items():
            part = [m * math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * c[t] * 2.2 / (c[t] + 1.2 * (0.25 + 0.75 * c.total() / mean)) for t, m in counts[i].items() if t in c]
            if part:
                want.append((-math.fsum(part), d))
        want.sort()
        best = sorted(got.pop(i, []))
        assert [r for r, _, _ in best] == list(range(1, min(10, len(want)) + 1))
        assert [s for _, s, _ in best] == pytest.approx([-s for s, _ in want[:10]], rel=1e-9)
        scores = np.array([s for s, _ in want])
        for (_, _, d), (s, w) in zip(best, want, strict=False):
            assert d == w or (abs(scores - s) < 1e-9 * abs(s)).sum() > 1
    assert not got
