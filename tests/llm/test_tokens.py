"""Encoding, packing, token files and token counts against the plain library."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidegauge.llm import packing, token_counts, token_files
from tidegauge.llm.encoding import Encoder
from tidegauge.llm.tables import text_of

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PLAIN = {p: Tokenizer.from_file(p) for p in (BYTE, WORD)}
ENCODERS = {p: Encoder(p) for p in (BYTE, WORD)}


def plain(path, text):
    return PLAIN[path].encode(text, add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("path", [BYTE, WORD])
@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list(
    "abC Z'sS\n\n  \t\r.,!<|>éñΣς12  　́\x1c\x85—…漢")), max_size=40), max_size=6))
def test_pieces_give_the_ids_of_whole_texts(path, texts):
    ids, offsets = ENCODERS[path].encode(pa.array(texts, pa.string()))
    assert [ids[s:e].tolist() for s, e in zip(offsets, offsets[1:])] == [plain(path, t) for t in texts]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_table_is_encoded_like_the_library(path, texts):
    own = [*texts.values(), "x<|endoftext|>y", "<|STARTOFTEXT|>", "a" * 3000]
    ids, offsets = ENCODERS[path].encode(pa.array(own))
    assert [ids[s:e].tolist() for s, e in zip(offsets, offsets[1:])] == [plain(path, t) for t in own]


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), min_size=1))
def test_plan_places_every_piece_once_without_gaps(histogram):
    slots, packs = packing.plan_packs(histogram, 64)
    taken, used = defaultdict(set), defaultdict(list)
    for s in slots:
        for i in range(s.packs * s.each):
            assert s.first_rank + i not in taken[s.length]
            taken[s.length].add(s.first_rank + i)
            used[s.first_pack + i // s.each].append((s.offset + i % s.each * s.length, s.length))
    assert {k: len(v) for k, v in taken.items()} == histogram
    assert sorted(used) == list(range(packs))
    for pieces in used.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64


def check_packed(rows, expected, capacity=2048):
    docs, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
        seqs[r.sequence_id].append((r.offset, r.length))
    assert set(docs) == set(expected)
    for d, ids in expected.items():
        at = 0
        for r in sorted(docs[d], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == crc(ids[at:at + r.length])
            at += r.length
        assert at == len(ids)
    for pieces in seqs.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(seqs)


def test_packing_of_a_table(docs, texts):
    rows = packing.pack_documents(docs, BYTE, with_ids=False).collect()
    expected = {d: [*plain(BYTE, t), 1] for d, t in texts.items()}
    n = check_packed(rows, expected)
    assert sum(map(len, expected.values())) > 0.97 * 2048 * n


def test_sequences_hold_the_ids(docs, texts):
    packed = packing.pack_documents(docs.where("doc_id < 40"), BYTE)
    found = packing.sequences(packed).collect()
    pieces = {(r.sequence_id, r.offset): r for r in packed.collect()}
    for s in found:
        at = 0
        for d, start in zip(s.doc_ids, s.starts):
            r = pieces[s.sequence_id, at]
            assert s.ids[at:at + r.length] == [*plain(BYTE, texts[d]), 1][start:start + r.length]
            at += r.length
        assert at == s.n_tokens and len(s.ids) == 2048


def test_packing_of_odd_rows(odd, none):
    rows = packing.pack_documents(odd, BYTE, with_ids=False).collect()
    ends = sorted((r.doc_id or 0, r.doc_tokens) for r in rows if r.start == 0)
    assert ends == sorted((r[0] or 0, len(plain(BYTE, r[1] or "")) + 1) for r in odd.select("doc_id", "text").collect())
    assert packing.pack_documents(none, BYTE).count() == 0


@pytest.mark.parametrize("bits", [1, 9, 13, 16, 17, 32])
def test_bits_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 5000, np.uint64).astype(np.uint32)
    data = token_files.pack_bits(ids, bits)
    assert len(data) == -(-5000 * bits // 8)
    assert (token_files.unpack_bits(data, 5000, bits) == ids).all()


def test_random_access_to_a_shard():
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 5000, n).astype(np.uint32) for n in (0, 1, 300, 8192, 77, 20_000)]
    shard = token_files.Shard(token_files.make_shard([1, None, 3, 4, 5, 6], docs, 13, 0, 0, block_ids=256) + b"\n")
    flat = np.concatenate(docs)
    assert shard.doc_ids.to_pylist() == [1, None, 3, 4, 5, 6]
    for s, e in ((0, len(flat)), (255, 257), (1000, 1001), (28_000, len(flat)), (5, 5)):
        assert (shard.ids(s, e) == flat[s:e]).all()
    assert (shard.document(4) == docs[4]).all()


@pytest.mark.parametrize("partitions,shard_ids", [(1, 1 << 21), (5, 4000)])
def test_token_files_of_a_table(spark, docs, texts, folder, partitions, shard_ids):
    token_files.write_token_files(docs, folder, WORD, partitions=partitions, shard_ids=shard_ids)
    rows = {r.doc_id: r for r in token_files.checksum(token_files.read_token_files(spark, folder)).collect()}
    start = 0
    for d in sorted(texts):
        ids = [*plain(WORD, texts[d]), 1]
        assert (rows[d].start, rows[d].n_tokens, rows[d].ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)


def test_token_files_of_odd_rows(spark, odd, none, folder):
    token_files.write_token_files(odd, folder, WORD, partitions=3)
    rows = token_files.read_token_files(spark, folder).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, None, 1, 1, 2, 3, 4, 5, 6, 7]
    starts = np.cumsum([0, *(r.n_tokens for r in rows)])
    assert [r.start for r in rows] == starts[:-1].tolist()
    token_files.write_token_files(none, folder + "0", WORD)
    assert token_files.read_token_files(spark, folder + "0").count() == 0


def test_counts_and_their_cache(spark, docs, odd, none, texts, folder):
    assert token_counts.token_counts(none, BYTE, folder).count() == 0
    first = token_counts.token_counts(docs, BYTE, folder)
    for r in first.collect():
        n = len(plain(BYTE, texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 512)

    def stored():
        return spark.read.option("recursiveFileLookup", "true").schema("_digest string").parquet(folder).count()

    assert stored() == docs.select(F.md5(text_of())).distinct().count()
    rows = token_counts.token_counts(docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text")), BYTE, folder)
    assert rows.count() == docs.count() + odd.count()
    # Only the texts that the first run had not seen were encoded.
    new = odd.select(text_of().alias("t")).join(docs.select(text_of().alias("t")), "t", "left_anti").distinct().count()
    assert stored() == docs.select(F.md5(text_of())).distinct().count() + new
    odd_rows = token_counts.token_counts(odd, BYTE, folder).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in odd_rows) == sorted(
        (r[0] or 0, len(plain(BYTE, r[1] or ""))) for r in odd.select("doc_id", "text").collect())
