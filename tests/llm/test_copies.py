"""SimHash components, components of links, and line deduplication."""

import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tidegauge.llm import line_dedup, simhash
from tidegauge.llm.components import connected


def plain_print(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius=2):
    root = {d: d for d in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= radius:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {d: find(d) for d in prints}


@pytest.mark.parametrize("limit", [512, 1])
def test_components_equal_brute_force(docs, texts, limit):
    prints = {d: plain_print(t) for d, t in texts.items()}
    want = plain_components(prints)
    rows = simhash.components(docs, shard_limit=limit).collect()
    assert {r.doc_id: r.fingerprint & (1 << 64) - 1 for r in rows} == prints
    assert {r.doc_id: r.component_id for r in rows} == want
    assert len(set(want.values())) < len(want)


def test_links_of_crowded_fingerprints(spark):
    """Many fingerprints around a few centres, in shards that must be divided."""
    rng = np.random.default_rng(3)
    prints = set()
    for centre in rng.integers(0, 1 << 63, 4):
        for _ in range(150):
            v = int(centre)
            for b in rng.choice(64, rng.integers(0, 5), replace=False):
                v ^= 1 << int(b)
            prints.add(v)
    signed = [v - (1 << 64) if v >> 63 else v for v in prints]
    df = spark.createDataFrame([(v,) for v in signed], "v long")
    found = connected(simhash.links(df, shard_limit=4)).collect()
    got = {v: v for v in signed} | {r.node: r.root for r in found}
    want = plain_components({v: v & (1 << 64) - 1 for v in signed})
    assert {frozenset(k for k in got if got[k] == r) for r in set(got.values())} == {
        frozenset(k for k in want if want[k] == r) for r in set(want.values())}


def test_chains_and_stars(spark):
    n = 300
    chain = [(i, i + 1) for i in range(n)]
    star = [(10_000, 10_000 + i) for i in range(1, 200)]
    rows = connected(spark.createDataFrame([*chain, *star, (5, 5)], "a long, b long")).collect()
    assert {r.node: r.root for r in rows} == {i: 0 for i in range(n + 1)} | {10_000 + i: 10_000 for i in range(200)}


def test_tree_finds_all_in_radius():
    rng = np.random.default_rng(4)
    values = [int(v) for v in rng.integers(0, 1 << 12, 400)]
    tree = simhash.Tree()
    for i, v in enumerate(values):
        assert sorted(tree.add(v, 2)) == [j for j in range(i) if (values[j] ^ v).bit_count() <= 2]


def test_simhash_odd_rows(odd, none):
    rows = simhash.components(odd).collect()
    own = {(r.doc_id, r.fingerprint): r.component_id for r in rows}
    assert len(rows) == 10
    assert {c for (d, f), c in own.items() if f == 0} == {2}
    assert {c for (d, _), c in own.items() if d in (1, 5)} == {1}
    assert simhash.components(none).count() == 0
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id or 0, (r.text or "")[:8]) for r in kept.collect()) == [
        (0, "no id"), (1, "one two "), (2, ""), (4, "word0 an"), (7, "<|endoft")]
    assert simhash.keep_one(none).count() == 0


WORDS = [f"{a}{b}" for a in "bcdfghjklmnp" for b in ("ando", "eril", "ista", "omen", "ur", "ax")]


def prose(rng, n, line=12):
    words = rng.choice(WORDS, n)
    return "\n".join(" ".join(words[i:i + line]) for i in range(0, n, line))


def planted(rng):
    """Documents, the passage, and which of them hold it in the middle of a line."""
    passage = prose(rng, 60, 25)
    docs = {i: prose(rng, 200) for i in range(30)}
    for i in (3, 9, 11, 20):
        docs[i] = docs[i][:400] + " " + passage + " " + docs[i][400:]
    return docs, passage


@pytest.mark.parametrize("partitions", [1, 7])
def test_repeated_passages_go(spark, partitions):
    rng = np.random.default_rng(7)
    docs, passage = planted(rng)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(partitions)
    rows = {r.doc_id: r for r in line_dedup.dedup_lines(df).collect()}
    core = " ".join(passage.split()[12:48])
    for d, r in rows.items():
        gone = [docs[d][s.start:s.end] for s in r._removed]
        if d in (9, 11, 20):
            assert core in " ".join(" ".join(gone).split())
            assert len(" ".join(gone).split()) <= 62
            assert set(docs[d].split()) >= set(r.text.split())
        else:
            assert not gone and r.text == docs[d]


def test_only_repeats_are_removed(spark, docs, texts):
    rows = line_dedup.dedup_lines(docs.select("doc_id", "text")).collect()
    before, changed = [], 0
    for r in sorted(rows, key=lambda r: r.doc_id):
        text = texts[r.doc_id]
        for s in r._removed:
            part = " ".join(text[s.start:s.end].split())
            assert len(part.split()) >= line_dedup.MIN_WORDS
            own = " ".join(text[:s.end].split())
            # Every removed line run stands earlier: check its 12-word pieces.
            words = part.split()
            for i in range(0, len(words) - 12, 12):
                piece = " ".join(words[i:i + 12])
                assert any(piece in b for b in before) or own.count(piece) > 1
            changed += 1
        before.append(" ".join(text.split()))
    assert changed


def test_copies_lose_all_but_the_first(spark):
    text = prose(np.random.default_rng(8), 300)
    df = spark.createDataFrame([(i, text) for i in (5, 3, 9, 7)], "doc_id long, text string").repartition(4)
    rows = {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()}
    assert rows[3] == text and [len(rows[i].split()) for i in (5, 7, 9)] == [0, 0, 0]


def test_line_dedup_odd_rows(spark, odd, none):
    out = line_dedup.dedup_lines(odd)
    assert out.columns == [*odd.columns, "_removed"] and out.count() == 10
    texts = {(r.doc_id or 0): r.text for r in out.collect() if r.doc_id not in (None, 4)}
    assert texts == {1: "one two three four", 2: "", 3: "", 5: "one two three four", 6: " \n\t ", 7: "<|endoftext|> x"}
    assert line_dedup.dedup_lines(none).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(WORDS[:6]), max_size=30).map(" ".join), min_size=1, max_size=4))
def test_equal_slices_hash_alike_and_windows_have_a_fingerprint(texts):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    lines = line_dedup.Lines(data, offsets, line_dedup.Powers(line_dedup._BASE), line_dedup.Powers(line_dedup._WORD_BASE))
    seen = {}
    for i in range(len(lines.hash)):
        part = data[lines.start[lines.first[i]]:lines.end[lines.last[i]]].tobytes()
        assert seen.setdefault(part, lines.hash[i]) == lines.hash[i]
    chosen = set(line_dedup.fingerprints(lines).tolist())
    for d in range(len(texts)):
        low, high = lines.bounds[d], lines.bounds[d + 1] - line_dedup.GRAM + 1
        for i in range(low, high - line_dedup.WINDOW + 1):
            assert chosen & set(range(i, i + line_dedup.WINDOW))
        if low < high:
            assert chosen & set(range(low, high))


@pytest.mark.parametrize("partitions", [1, 7])
def test_variants_hide_no_exact_copy(spark, partitions):
    """An edited variant comes first, then two exact copies: the last goes as if there were no variant."""
    rng = np.random.default_rng(11)
    with_, without = {}, {}
    for k in range(120):
        passage = prose(rng, 55).split()
        variant = [f"x{rng.integers(1 << 30)}" if i % (15, 10, 25)[k % 3] == 7 else w for i, w in enumerate(passage)]
        for n, words in enumerate((variant, passage, passage)):
            at = 3 * k + n
            with_[at] = prose(rng, 60) + "\n" + " ".join(words) + "\n" + prose(rng, 60)
            if n:
                without[at] = with_[at]

    def removed(docs):
        df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(partitions)
        return {r.doc_id: {i for s in r._removed for i in range(s.start, s.end)}
                for r in line_dedup.dedup_lines(df).collect() if r.doc_id % 3 == 2}

    some, plain = removed(with_), removed(without)
    assert sum(map(bool, plain.values())) > 110
    assert all(some[d] >= plain[d] for d in plain)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 5), st.lists(st.integers(0, 2), min_size=12, max_size=12)),
                max_size=30))
def test_all_earlier_rows_are_compared(rows):
    """For each number of lines before, how many lines after one and the same earlier row has too."""
    half = line_dedup.REACH
    rows = sorted(rows, key=lambda r: r[:2])
    key, ident = (np.array([r[i] for r in rows], np.int64) for i in (0, 1))
    at = np.arange(len(rows))
    context = np.array([r[2] for r in rows], np.uint32).reshape(-1, 2, half)
    context = (context * np.cumprod(context != 0, axis=2)).astype(np.uint32).reshape(-1, 2 * half)

    def agree(a, b):
        n = 0
        while n < len(a) and a[n] == b[n] != 0:
            n += 1
        return n

    def windows(i, earlier):
        both = [(agree(context[i][:half], context[j][:half]), agree(context[i][half:], context[j][half:])) for j in earlier]
        best = {}
        for before in range(half + 1):
            after = max((r for l, r in both if l >= before), default=-1)
            if after >= 0 and after > max((r for l, r in both if l > before), default=-1):
                best[before] = after
        return best

    want = {}
    for i in range(len(rows)):
        earlier = [j for j in range(i) if key[j] == key[i]]
        if earlier:
            want[i] = windows(i, earlier)
    heads, later, packed, whole = line_dedup._resolve(key, ident, at, context, np.arange(len(rows)))
    assert {i: dict(line_dedup._windows(int(p))) for i, p in zip(later.tolist(), packed)} == want
    # The heads alone answer for all rows, whatever batch a later row comes in.
    for i, found in want.items():
        assert found == windows(i, [j for j in heads.tolist() if j < i and key[j] == key[i]])


def test_pieces_that_meet_by_chance_stay(spark):
    """Two unrelated passages of 20 words, each from another earlier document, side by side."""
    rng = np.random.default_rng(12)
    docs = {}
    for k in range(40):
        a, b = prose(rng, 20, 50), prose(rng, 20, 50)
        docs[3 * k] = prose(rng, 60) + " " + a + " " + prose(rng, 60)
        docs[3 * k + 1] = prose(rng, 60) + " " + b + " " + prose(rng, 60)
        docs[3 * k + 2] = prose(rng, 60) + " " + a + " " + b + " " + prose(rng, 60)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    assert [r.doc_id for r in line_dedup.dedup_lines(df).collect() if r._removed] == []


def repeated_words(docs, least):
    """Words of each document that are in a run of `least` words that begins at an earlier place."""
    seen, out = set(), {}
    for d in sorted(docs):
        words = docs[d].split()
        runs = [hash(tuple(words[i:i + least])) for i in range(len(words) - least + 1)]
        out[d] = {i + j for i, r in enumerate(runs) for j in range(least) if r in seen or r in runs[:i]} if set(
            runs) & seen or len(set(runs)) < len(runs) else set()
        seen |= set(runs)
    return out


def word_places(text, spans):
    places = [m.start() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    return {i for i, p in enumerate(places) if any(s.start <= p < s.end for s in spans)}


@pytest.mark.parametrize("partitions", [1, 7])
def test_deleted_words_are_in_a_run_of_one_earlier_place(spark, texts, partitions):
    """All documents against a brute-force search, with variants, stitched pieces and passages of 51 words."""
    rng = np.random.default_rng(13)
    docs, at = dict(texts), max(texts) + 1
    passages = [prose(rng, 51, int(rng.integers(8, 60))) for _ in range(60)]
    for k, passage in enumerate(passages):
        docs[at + 4 * k] = prose(rng, 40) + " " + passage + " " + prose(rng, 40)
        edited = passage.split()
        edited[25] = "edited"
        docs[at + 4 * k + 1] = prose(rng, 40) + " " + " ".join(edited) + "\n" + prose(rng, 40)
        docs[at + 4 * k + 2] = prose(rng, 40) + "\n" + passage + "\n" + prose(rng, 40)
        halves = passage.split()[:20] + passages[k - 1].split()[-20:]
        docs[at + 4 * k + 3] = prose(rng, 40) + " " + " ".join(halves) + " " + prose(rng, 40)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(partitions)
    want = repeated_words(docs, line_dedup.MIN_WORDS)
    found = total = caught = 0
    for r in line_dedup.dedup_lines(df).collect():
        gone = word_places(docs[r.doc_id], r._removed)
        assert gone <= want[r.doc_id], r.doc_id
        found, total = found + len(gone), total + len(want[r.doc_id])
        if r.doc_id >= at and (r.doc_id - at) % 4 == 2:
            caught += len(gone) > 40
        if r.doc_id >= at and (r.doc_id - at) % 4 in (0, 3):
            assert not gone
    # Words at the edges of a run stay where they are parts of lines.
    assert total > 2000 and found > 0.8 * total
    assert caught == 60


def test_line_dedup_keeps_columns_of_any_name(spark):
    text = prose(np.random.default_rng(14), 60)
    names = "doc long, xx long, _found string, _key int, _xx int, _removed string, `a``b.c` string, at int, windows int, row int, found int"
    df = spark.createDataFrame([(i, text, i, 2, "f", 3, 4, "r", "q", 5, 6, 7, 8) for i in range(3)], "doc_id long, text string, " + names)
    out = line_dedup.dedup_lines(df, removed_column="gone")
    assert out.columns == [*df.columns, "gone"]
    assert [(r.doc_id, r["a`b.c"], r._removed, r.doc, bool(r.gone)) for r in out.orderBy("doc_id").collect()] == [
        (0, "q", "r", 0, False), (1, "q", "r", 1, True), (2, "q", "r", 2, True)]
    assert line_dedup.dedup_lines(df).columns.count("_removed") == 1
    kept = simhash.keep_one(df.withColumn("_id", df.doc).withColumn("_own", df.doc).withColumn("_digest", df.doc))
    assert kept.columns == [*df.columns, "_id", "_own", "_digest"] and [r.doc_id for r in kept.collect()] == [0]
