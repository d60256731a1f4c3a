"""The pipeline's stages on the smallest documents against plain Python."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as p
from sampleprep.llm import queries as q
from sampleprep.llm import simhash


@pytest.fixture(scope="module")
def steps(spark, sf, tmp_path_factory):
    """The rows after each stage, and those of run()."""
    docs, found = q.table(spark, sf, "documents"), []
    found.append(docs.collect())
    for name, stage in p.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "rows")
        out = stage(spark, docs, sf)
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        found.append(docs.collect())
    return found, p.run(spark, sf).collect()


def ids(rows):
    return [r.doc_id for r in rows]


def test_stages_are_named():
    assert [n for n, _ in p.STAGES] == ["language ID", "exact dedup", "near dedup", "mixing", "packing"]


def test_language(steps):
    before, after = steps[0][0], steps[0][1]
    gone = set(ids(before)) - set(ids(after))
    texts = {r.doc_id: r.text for r in before}
    assert not [i for i in gone if texts[i] and sum(c.isalpha() for c in texts[i]) > 200]
    assert len(gone) < 0.02 * len(before)


def test_exact(steps):
    first = {}
    for r in sorted(steps[0][1]):
        key = re.sub(r"[\x20\x09-\x0D]+", " ", r.text)
        first[key] = min(first.get(key, r.doc_id), r.doc_id)
    assert sorted(ids(steps[0][2])) == sorted(first.values())


def test_near(steps):
    before, after = steps[0][2], set(ids(steps[0][3]))
    sets, fps = {}, {}
    for r in before:
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text.lower())
        sets[r.doc_id] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}
        fps[r.doc_id] = simhash.fingerprint(r.text, 5)
    share = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    order = sorted(sets)
    near = defaultdict(set)
    for k, b in enumerate(order):
        for a in order[:k]:
            s = share(a, b)
            if s >= 0.7 or (fps[a] ^ fps[b]).bit_count() <= 3:
                near[a].add((b, s)), near[b].add((a, s))
    for i in order:
        if i not in after:
            assert near[i], i  # only what has a near copy goes
        assert not [j for j, s in near[i] if s >= 0.85 and i in after and j in after]  # one of each pair stays at most


def test_near_at_the_threshold(steps):
    before, after = steps[0][2], set(ids(steps[0][3]))
    sets, fps = {}, {}
    for r in before:
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text.lower())
        sets[r.doc_id] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}
        fps[r.doc_id] = simhash.fingerprint(r.text, 5)
    linked, order = defaultdict(set), sorted(sets)
    for k, b in enumerate(order):
        for a in order[:k]:
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) or (fps[a] ^ fps[b]).bit_count() <= 3:
                linked[a].add(b), linked[b].add(a)
    for i in order:
        assert i in after or linked[i], i
        assert i not in after or not linked[i] & after, i


def test_mixing_and_packing(steps):
    found, run = steps
    kept, mixed, packed = found[3], found[4], found[5]
    words = lambda rows: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in rows)
    assert set(ids(mixed)) <= set(ids(kept)) and max(Counter(ids(mixed)).values()) <= 3
    assert 0.9 * words(kept) <= words(mixed) <= words(kept)
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(ids(mixed))
    room = defaultdict(int)
    for r in packed:
        room[r.sequence_id] += r.length
    assert max(room.values()) <= 2048
    key = lambda rows: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert key(run) == key(packed)


#: Columns beside those of documents, with names that stages use inside.
EXTRA = ("id", "row", "mark", "node", "hash", "text_hash", "size", "keep", "rank", "piece", "Label")


@pytest.fixture(scope="module")
def odd(spark, sf, tmp_path_factory):
    """A folder with the documents and, among them, null, blank, repeated, copied and long ones, null ids and sources; and one with none."""
    docs = q.table(spark, sf, "documents")
    good = [r.text for r in docs.orderBy("doc_id").collect() if len(r.text) > 1500]
    # texts that no other row has
    own = [" ".join(reversed(t.split())) for t in good[:8]]
    words = own[3].split()
    near = " ".join([*words[:-1], "changed"])
    made = [
        (900_000, None, "en", "a", 0), (900_001, "", "en", "a", 0), (900_002, " \t\n", None, None, 3), (900_003, "123 456 -", "en", "a", 9),
        (900_010, own[0], None, "a", 1), (900_010, own[0], None, "a", 1), (900_011, own[0].replace(" ", " \n"), None, None, 1), (None, own[1], None, "b", 1),
        (900_012, own[2], "", "", 1), (900_013, own[3], None, "b", 1), (900_014, near, None, "b", 1), (900_015, " ".join(own[4:5] * 160), None, "b", 1),
    ]
    rows = docs.unionByName(spark.createDataFrame(made, docs.schema)).withColumns({c: F.lit(f"own {c}") for c in EXTRA})
    folders = [str(tmp_path_factory.mktemp(n)) for n in ("odd", "none")]
    rows.repartition(3).write.parquet(f"{folders[0]}/documents.parquet")
    rows.limit(0).write.parquet(f"{folders[1]}/documents.parquet")
    return folders


def test_odd_documents(spark, odd, tmp_path):
    """Stage by stage: columns stay, each decision takes effect, clean rows stay, and run() gives the last stage's rows."""
    docs, after = q.table(spark, odd[0], "documents"), []
    for k, (name, stage) in enumerate(p.STAGES):
        out = stage(spark, docs, odd[0])
        assert name == "packing" or out.columns == docs.columns
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        after.append(docs.collect())
    language, exact, near, mixed, packed = after
    known = {900_010, 900_011, 900_012, 900_013, 900_014, 900_015, None}
    mine = lambda rows: Counter(i for i in ids(rows) if i is None or i >= 900_000)
    assert mine(language) == Counter({i: 1 + (i == 900_010) for i in known})
    assert mine(exact) == Counter(known - {900_011})
    assert mine(near) == Counter(known - {900_011, 900_014})
    assert set(mine(mixed)) <= set(mine(near)) and {r.Label for r in mixed} == {"own Label"}
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(ids(mixed))
    key = lambda rows: Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert key(p.run(spark, odd[0]).collect()) == key(packed)


def test_no_documents(spark, odd):
    docs = q.table(spark, odd[1], "documents")
    for name, stage in p.STAGES:
        out = stage(spark, docs, odd[1])
        assert out.count() == 0 and (name == "packing" or out.columns == docs.columns)
    assert p.run(spark, odd[1]).count() == 0
