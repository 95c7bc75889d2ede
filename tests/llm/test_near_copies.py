"""The near-dedup stage against brute-force Jaccard."""

import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF
from tidegauge.llm import similar, simhash


def shingles(text, k=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def survivors(texts):
    """Smallest ids of the components of pairs with 5 |A and B| >= 4 |A or B|."""
    sets, root = {d: shingles(t) for d, t in texts.items()}, {d: d for d in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    near = 0
    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if 5 * min(len(x), len(y)) < 4 * max(len(x), len(y)):
            continue
        common = len(x & y)
        if 9 * common >= 4 * (len(x) + len(y)):
            near += x != y
            root[max(find(a), find(b))] = min(find(a), find(b))
    return {find(d) for d in texts}, near


def edited(rng, text, share):
    words = text.split()
    for i in rng.choice(len(words), int(share * len(words)), replace=False):
        words[i] = f"edit{rng.integers(1 << 40)}"
    return " ".join(words)


@pytest.mark.parametrize("partitions", [1, 7])
def test_stage_equals_brute_force(spark, docs, texts, partitions):
    """All documents, near copies planted on both sides of the bound, and a crowd with chains."""
    rng = np.random.default_rng(5)
    sources = [t for t in texts.values() if 80 <= len(t.split()) <= 1500][:40]
    cases, at = dict(texts), max(texts) + 1
    for k, text in enumerate(sources):
        cases[at + k] = edited(rng, text, rng.uniform(0.005, 0.04))
    at += len(sources)
    crowd = sources[0]
    for k in range(60):
        crowd = edited(rng, crowd, 0.01) if k % 3 else edited(rng, sources[0], 0.015)
        cases[at + k] = crowd
    for k in range(30):  # a common line in otherwise different texts
        cases[at + 100 + k] = " ".join(sources[1].split()[:40] + [f"own{k}x{i}" for i in range(k)])
    want, near = survivors(cases)
    assert near > 50
    schema = "doc_id long, text string"
    df = spark.createDataFrame(list(cases.items()), schema).repartition(partitions)
    got = [r.doc_id for r in corpus_pipeline.drop_near_copies(spark, df, SF).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_fingerprint_trees_of_groups(spark):
    """A forest per group: links within the radius only, and the components of all such links."""
    rng = np.random.default_rng(8)
    rows = []
    for h in range(12):
        prints = list(rng.integers(-(1 << 63), 1 << 63, 4))
        for _ in range(20):
            flips = sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 14), replace=False))
            prints.append(prints[rng.integers(len(prints))] ^ flips)
        rows += [(h, 1000 * h + int(v), int(p)) for v, p in zip(rng.permutation(len(prints)), prints)]
    got = simhash.group_links(spark.createDataFrame(rows + rows[:5], "h long, v long, print long"), 8).collect()
    prints = {v: p & (1 << 64) - 1 for _, v, p in rows}
    assert all(a < b and a // 1000 == b // 1000 and (prints[a] ^ prints[b]).bit_count() <= 8 for a, b in got)

    def components(pairs):
        root = {v: v for v in prints}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            root[max(find(a), find(b))] = min(find(a), find(b))
        return {v: find(v) for v in prints}

    near = [(a, b) for a, b in combinations(prints, 2) if a // 1000 == b // 1000 and (prints[a] ^ prints[b]).bit_count() <= 8]
    assert len(near) > 50 and components(got) == components(near)


def test_stage_looks_in_fingerprint_trees(spark, texts, monkeypatch):
    """The trees name nearly all near copies; what the radius leaves out is found all the same."""
    rng = np.random.default_rng(9)
    sources = [t for t in texts.values() if 80 <= len(t.split()) <= 1500][:40]
    cases = dict(enumerate(dict.fromkeys(sources)))
    for k, text in list(cases.items()):
        cases[1000 + k] = edited(rng, text, rng.uniform(0.005, 0.015))
    want, near = survivors(cases)
    df = spark.createDataFrame(list(cases.items()), "doc_id long, text string")
    named = []
    plain = simhash.group_links

    def spied(groups, radius):
        named.append(plain(groups, radius).distinct().count())
        return plain(groups, radius)

    monkeypatch.setattr(simhash, "group_links", spied)
    assert {r.doc_id for r in simhash.keep_one(df).collect()} == want
    assert near > 30 and named[0] >= 0.9 * near
    assert {r.doc_id for r in simhash.keep_one(df, radius=0).collect()} == want
    assert named[1] < named[0]


@pytest.mark.parametrize("most", [None, -1])  # no table has -1 bytes
def test_the_driver_gets_no_sketches(spark, texts, monkeypatch, most):
    """Broadcasts pass the driver: none is of sketches, which grow with the corpus, and with no bytes allowed there is none."""
    rng = np.random.default_rng(10)
    sources = [t for t in texts.values() if 80 <= len(t.split()) <= 1500][:30]
    cases = dict(enumerate(dict.fromkeys(sources)))
    for k, text in list(cases.items()):
        cases[1000 + k] = edited(rng, text, rng.uniform(0.005, 0.03))
    want, near = survivors(cases)
    sent, plain = [], F.broadcast
    monkeypatch.setattr(F, "broadcast", lambda df: sent.append(df.columns) or plain(df))
    if most is not None:
        monkeypatch.setattr(similar, "BROADCAST_BYTES", most)
        monkeypatch.setattr(simhash, "BROADCAST_BYTES", most)
    df = spark.createDataFrame([*cases.items(), (0, cases[0]), (2000, cases[1]), (None, None)], "doc_id long, text string")
    got = [r.doc_id for r in corpus_pipeline.drop_near_copies(spark, df, SF).collect()]
    assert near > 10 and sorted(got, key=lambda x: (x is None, x)) == [*sorted(want), None]
    assert not any("parity" in columns for columns in sent) and bool(sent) == (most is None)
