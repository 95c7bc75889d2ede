"""Hard negatives, personal data and importance resampling against plain versions."""

import hashlib
import math
import random
import re
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidegauge.llm import hard_negatives, importance, pii
from tidegauge.llm.queries import QUERIES

# --- hard negatives


def plain_mine(rows, is_anchor, positives, negatives, band):
    """Every anchor with every row."""
    usable = {(i, l, tuple(v)) for i, l, v in rows if i is not None and l is not None and v is not None
              and all(x is not None and math.isfinite(x) for x in v)}
    whole = [(i, l, [math.floor(256 * x) for x in v]) for i, l, v in usable]
    out = []
    for ai, al, av in whole:
        if not is_anchor(ai):
            continue
        scored = {(-sum(x * y for x, y in zip(av, v)), i, l == al) for i, l, v in whole if i != ai}
        near = sorted({(s, i) for s, i, same in scored if same})[:positives]
        for ps, pi in near:
            ok = sorted({(s, i) for s, i, same in scored if not same and band[0] * -ps <= 100 * -s <= band[1] * -ps})
            out += [(ai, pi, n + 1, ni, -ps, -ns) for n, (ns, ni) in enumerate(ok[:negatives])]
    return sorted(out)


VECTORS = "vec_id long, embedding array<float>, label int"


def mined(df, **kw):
    out = hard_negatives.mine(df, F.col("vec_id") % 5 == 0, **kw)
    return sorted(tuple(r) for r in out.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.mark.parametrize("dim,partitions,block", [(3, 1, 1 << 20), (64, 7, 40_000), (100, 3, 80_000)])
def test_mining_equals_brute_force(spark, dim, partitions, block):
    rng = np.random.default_rng(dim)
    centres = rng.normal(size=(6, dim))
    rows = [(i, (centres[i % 6] + 0.7 * rng.normal(size=dim)).astype(np.float32).tolist(), int(i % 4)) for i in range(240)]
    rows += [(1000 + i, rows[0][1], int(i % 3)) for i in range(30)]  # copies under other ids: ties
    rows += rows[:40]  # repeated rows
    rows += [(5, rows[9][1], 2), (None, rows[1][1], 1), (7001, None, 1), (7002, rows[1][1], None), (7003, [None] * dim, 1),
             (7005, [float("nan")] + [0.0] * (dim - 1), 1), (7010, [float("inf")] * dim, 2), (7015, [], 1), (7020, [0.5], 2),
             (-10, rows[3][1], 3), (7025, [0.0] * dim, 0)]
    df = spark.createDataFrame(rows, VECTORS).repartition(partitions)
    got = mined(df, block_bytes=block)
    assert got == plain_mine([(i, l, v) for i, v, l in rows], lambda i: i % 5 == 0, 5, 3, (50, 95))
    assert len({r[0] for r in got}) > 30


def test_interval_holds_the_score():
    rng = np.random.default_rng(0)
    for dim, size in ((5, 64), (64, 64), (130, 256)):
        v = rng.integers(-300, 300, (200, dim)) * (rng.random((200, 1)) < 0.9)
        a = np.concatenate([v[:20], rng.integers(-300, 300, (20, dim))])
        r = hard_negatives.rotated(v, size)
        rows = hard_negatives.Rows(np.arange(200), np.zeros(200, int), v, hard_negatives._bits(r > 0),
                                   np.sqrt((v * v).sum(1)), np.abs(r).sum(1) / np.sqrt(size))
        block = hard_negatives.Block.of(np.arange(40), np.zeros(40, int), a, size)
        low, high = hard_negatives.bounds(block, np.arange(40), rows)
        score = a @ v.T
        assert (low <= score).all() and (score <= high).all()
        # The intervals are of use: narrower than those of the lengths alone.
        assert (high - low).mean() < 0.9 * 2 * np.mean(block.length[:, None] * rows.length)


def test_mining_of_odd_tables(spark):
    none = spark.createDataFrame([], VECTORS)
    assert mined(none) == []
    assert mined(spark.createDataFrame([(5, None, None), (None, [1.0], 1)], VECTORS)) == []
    assert mined(spark.createDataFrame([(5, [], 1), (6, [], 1), (7, [], 2)], VECTORS)) == [(5, 6, 1, 7, 0, 0)]
    clash = spark.createDataFrame([(5, [1.0], 1, 1, "x"), (6, [1.0], 1, 2, "y"), (7, [0.75], 2, 3, "z")],
                                  VECTORS + ", anchor int, `a``b.v` string")
    assert mined(clash) == [(5, 6, 1, 7, 65536, 49152)]
    with pytest.raises(Exception, match="do not fit 64 bits"):
        mined(spark.createDataFrame([(5, [1e12], 1), (6, [1e12], 1), (7, [0.75], 2)], VECTORS))


# --- personal data

BASE = [(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda m: plain_luhn(re.sub("[ -]", "", m))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.findall("[0-9]", m)) <= 15)]


def plain_luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return 13 <= len(digits) <= 19 and total % 10 == 0


def plain_base(text):
    return [(k, *m.span()) for k, (p, ok) in enumerate(BASE) for m in re.finditer(p, text) if ok(m[0])]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["a", "b.c", "@", ".", "x.y", "-", " ", "+", "(", ")", "1", "0", "25", "255", "256", "4111 1111",
                                 "1111", "é", "one", " dot ", " at ", "[at]", "com", "\n", "O", "￼", "５", "а"]), max_size=40))
def test_base_rules_are_the_plain_patterns(parts):
    text = "".join(parts)
    assert [f[:3] for f in pii.find(text) if f[3]] == plain_base(text)
    # What the hints leave out is not there.
    assert pii.find(text, int(pii.hints_of(pa.array([text]))[0])) == pii.find(text)


def test_every_document_has_its_base_spans(spark, texts):
    for row in QUERIES["op12_pii"](spark, SF).collect():
        want = plain_base(texts[row.doc_id])
        base = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in want)
        assert row.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(w[0] == k for w in want) for k in range(4)]
        assert set(filter(None, base.split(","))) <= set(row.spans.split(","))


DISGUISED = [
    ("email", "jane.doe (at) example [dot] com"), ("email", "jane dot doe at mail dot example dot com"),
    ("email", "jane{at}example.org"), ("email", "jane @ example . org"), ("email", "ｊａｎｅ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
    ("email", "jаne@exаmple.com"), ("email", "ja​ne@exam­ple.com"), ("email", "jana arroba ejemplo punto es"),
    ("ip", "192[.]168[.]1[.]20"), ("ip", "192 dot 168 dot one dot 20"), ("ip", "١٩٢.١٦٨.١.٢٠"), ("ip", "one nine two dot one six eight dot one dot two"),
    ("card", "4111 1111 one one one one 1111"), ("card", "４１１１ １１１１ １１１１ １１１１"), ("card", "4O12 8888 8888 1881"),
    ("card", "vier eins eins eins 1111 1111 1111"), ("phone", "plus four nine one five one two three four five six"),
    ("phone", "+1 (217) 555-three two one two"), ("phone", "＋１ (217) 555‑3212"), ("phone", "+49 double five one 234 567")]


@pytest.mark.parametrize("kind,secret", DISGUISED)
def test_disguises_are_found_in_place(kind, secret):
    for before, after in (("", ""), ("Ask her: ", "! And then"), ("é ﬁ ½ the ", "\nat dot")):
        text = before + secret + after
        found = [(pii.KINDS[k], text[s:e]) for k, s, e, _ in pii.find(text, int(pii.hints_of(pa.array([text]))[0]))]
        assert (kind, secret) in found


@pytest.mark.parametrize("text", ["look at the dot matrix", "meet me at example.com", "one of two, three at most", "at 5 dot 6",
                                  "in 2010–2012", "he is at home dot dot dot", "", "un deux trois", "1.2.3", "point at com"])
def test_prose_is_left_alone(text):
    assert pii.find(text) == []


def test_spans_cover_no_more_than_the_disguise():
    rng = random.Random(3)
    for _ in range(200):
        kind, secret = rng.choice(DISGUISED)
        before = " ".join(rng.choice(["the", "é", "１", "ﬁne", "zwei", "at", "x"]) for _ in range(rng.randrange(6)))
        text = f"{before} :: {secret} ::"
        spans = [(s, e) for k, s, e, _ in pii.find(text) if pii.KINDS[k] == kind]
        assert (len(before) + 4, len(before) + 4 + len(secret)) in spans


def test_long_texts_take_linear_time():
    for piece in ("a", "1", "1.", "+(", "a@", "one ", "at dot ", " ", "@ a . ", "double ", "(at)", "é", "one dot "):
        pii.find(piece * 100_000)


def test_odd_rows(spark, odd, none):
    assert pii.scan(odd).count() == odd.count() and pii.scan(none).count() == 0
    clash = odd.withColumn("found", F.lit(1)).withColumn("a`b", F.lit("x")).withColumn("_text", F.lit(2))
    out = pii.redact(clash)
    assert out.columns == clash.columns and out.count() == odd.count() and out.where("text is null").count() == 0
    one = spark.createDataFrame([(1, "mail jane(at)example(dot)com or +1 (217) 555-3212.")], "doc_id long, text string")
    assert pii.redact(one).first().text == "mail [EMAIL] or [PHONE]."


# --- importance resampling

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text, runs):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return [" ".join(words[i:i + n]) for n in range(1, runs + 1) for i in range(len(words) - n + 1)], len(words)


def plain_resample(docs, target, percent, runs, least=20):
    bucket = lambda f: crc32(f.encode()) % 10000
    s, t = [0] * 10000, [0] * 10000
    for counts, rows in ((s, [x for _, x in docs]), (t, target)):
        for text in rows:
            for f in plain_features(text, runs)[0]:
                counts[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + 10000) / ((s[b] + 1) * (sum(t) + 10000)))) for b in range(10000)]
    out = []
    for i, text in docs:
        f, words = plain_features(text, runs)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(x)] for x in f) // len(f) if f else 0
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, words])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for n, r in enumerate(able[:len(able) * percent // 100]):
        r[4] = n + 1
    return sorted(map(str, (r[:5] for r in out)))


@pytest.mark.parametrize("runs,percent,partitions", [(1, 10, 5), (2, 37, 1), (1, 100, 3), (1, 0, 2)])
def test_resampling_equals_the_plain_version(spark, docs, texts, runs, percent, partitions):
    rows = list(texts.items())[:150] + [(None, "null id " * 30)] * 3 + [(9_000_001, None), (9_000_002, ""), (9_000_003, "Ünï-CODE " * 40)]
    rows += [(9_000_004, "the same words here " * 20)] * 25
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
    aim = spark.createDataFrame([(x,) for x in target], "text string")
    got = importance.resample(df, aim, percent=percent, runs=runs).select("doc_id", "n_features", "weight", "score", "rank")
    assert sorted(str(list(r)) for r in got.collect()) == plain_resample(rows, target, percent, runs)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.integers(-3, 3), min_size=1, max_size=60), st.data())
def test_cutoff_is_the_key_at_the_rank(spark, values, data):
    rank = data.draw(st.integers(1, len(values)))
    keys = [(v, 0, abs(v) % 2, 1) for v in values]
    df = spark.createDataFrame(keys, "a long, b long, c long, d long").repartition(3)
    want = sorted(keys)[rank - 1]
    assert importance.cutoff(df, rank) == (want, sum(k < want for k in keys))


def test_the_sample_follows_the_target(spark):
    rng = random.Random(0)
    words = {0: [f"alpha{i}" for i in range(50)], 1: [f"beta{i}" for i in range(50)]}
    rows = [(i, " ".join(rng.choice(words[i % 10 == 0]) for _ in range(60))) for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    aim = spark.createDataFrame([(" ".join(words[1] * 20),)], "text string")
    ranked = importance.resample(df, aim)
    kept = importance.drawn(df.withColumn("_won", F.lit(1)).withColumn("rank", F.lit("r")), ranked)
    assert kept.columns == ["doc_id", "text", "_won", "rank"] and kept.count() == 100
    # A tenth of the documents is like the target; most of the sample is.
    assert kept.where(F.col("doc_id") % 10 == 0).count() > 80


def test_resampling_of_odd_rows(spark, odd, none):
    aim = spark.createDataFrame([("one two",), (None,)], "text string")
    clash = odd.withColumn("score", F.lit("x")).withColumn("rank", F.lit(None).cast("string")).withColumn("text`s", F.lit(1))
    assert importance.resample(clash, aim, percent=50, least_words=1).count() == odd.count()
    assert importance.resample(none, aim).count() == 0
    assert importance.resample(odd, aim.where("false")).count() == odd.count()
    with pytest.raises(ValueError):
        importance.resample(odd, aim, percent=101)
