"""The operators applied to the whole test tables, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tidegauge.llm import (decontaminate, hard_negatives, importance, line_dedup, packing, pii, quality, secrets, sharding, simhash,
                           token_counts, token_files, toxicity)
from tidegauge.llm.tables import kept_dir, prepare, table
from tidegauge.session import shared_dir

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
SHARDS = [f"shard-{i:02d}" for i in range(32)]
SLOTS = 4093


def _of_kind(kind):
    # One parameter only: Spark gives a second one the position of the element.
    return lambda x: x["kind"] == kind


def _count(spans, test):
    return F.size(F.filter(spans, test)).cast("long")


def op1_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    pieces = packing.encode_pieces(docs, public_tokenizers.path(BYTE_BPE))
    pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(pieces).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op2_token_files(spark, sf_dir):
    path = shared_dir(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path(WORD_BPE))
    return token_files.checksum(token_files.read_token_files(spark, path))


def op3_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE),
                                     kept_dir(spark, "token-counts"))


def op4_sharding(spark, sf_dir):
    return sharding.assign(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", SHARDS, SLOTS)


def op5_decontaminate(spark, sf_dir):
    return decontaminate.occurrences(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_secrets(spark, sf_dir):
    found = secrets.scan_paths(table(spark, sf_dir, "documents"), kept_dir(spark, "secret-ledger"))
    f = F.col("findings")
    counts = [_count(f, _of_kind(k)).alias(f"n_{secrets.RULES[k][0]}") for k in range(secrets.BASE_KINDS)]
    return found.select("doc_id", *counts, F.sha2(secrets.spans(f, base=True).cast("binary"), 256).alias("base_sha256"),
                        secrets.spans(f, base=False).alias("spans"))


def op7_simhash(spark, sf_dir):
    found = simhash.components(table(spark, sf_dir, "documents"))
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


def op8_line_dedup(spark, sf_dir):
    rows = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.withColumnRenamed("_removed", "removed")


def op9_quality(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op11_hard_negatives(spark, sf_dir):
    label = F.col("label").cast("long")
    rows = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives.mine(rows, F.col("vec_id") % 50 == 0)


def op12_pii(spark, sf_dir):
    found = F.col("found")
    own = F.filter(found, lambda x: x["base"])
    counts = [_count(own, _of_kind(k)).alias(f"n_{name}") for k, name in enumerate(pii.KINDS)]
    return pii.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", *counts, F.sha2(pii.listed(found, base=True).cast("binary"), 256).alias("base_sha256"),
        pii.listed(found, base=False).alias("spans"))


def op13_importance(spark, sf_dir):
    rows = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def _configured(build):
    return lambda spark, sf_dir: build(prepare(spark), sf_dir)


QUERIES = {f.__name__: _configured(f) for f in (
    op1_packing, op2_token_files, op3_token_counts, op4_sharding, op5_decontaminate, op6_secrets, op7_simhash,
    op8_line_dedup, op9_quality, op10_toxicity, op11_hard_negatives, op12_pii, op13_importance, pipeline)}

SQL: dict[str, str] = {}

# Turn t belongs to shard t % 32, which claims the first free slot of its permutation.
SQL["op4_sharding"] = f"""
with recursive shards as (
  select i as shard, ('0x' || substr(md5('offset shard-' || lpad(i::varchar, 2, '0')), 1, 15))::bigint % {SLOTS} as o,
    ('0x' || substr(md5('step shard-' || lpad(i::varchar, 2, '0')), 1, 15))::bigint % {SLOTS - 1} + 1 as s
  from range({len(SHARDS)}) r(i)),
lists as (select list(o order by shard) as os, list(s order by shard) as ss from shards),
turns as (
  select 0 as t, list_transform(range({SLOTS}), lambda x: -1) as owner from lists
  union all
  select t + 1, list_transform(range({SLOTS}), lambda x: case when x = slot then t % {len(SHARDS)} else owner[x + 1] end)
  from (select t, owner, list_filter(
          list_transform(range({SLOTS}), lambda j: (os[t % {len(SHARDS)} + 1] + j * ss[t % {len(SHARDS)} + 1]) % {SLOTS}),
          lambda x: owner[x + 1] < 0)[1] as slot from turns, lists where t < {SLOTS}) q),
final as (select owner from turns where t = {SLOTS}),
keyed as (select doc_id, ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 15))::bigint % {SLOTS} as slot from documents)
select doc_id, slot, owner[slot + 1]::integer as shard from keyed, final
"""

SQL["op9_quality"] = r"""
with docs as (select row_number() over () as r, doc_id, source, coalesce(text, '') as text from documents),
words as (select *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from docs),
windows as (
  select r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g
  from (select r, w, unnest(range(1, greatest(1, len(w) - 1))) as i from words) q),
repeated as (
  select r, count(*) as n from (
    select distinct r, unnest([i, i + 1, i + 2]) as at
    from (select *, count(*) over (partition by r, g) as c from windows) q where c > 1) q group by r),
base as (
  select words.r, doc_id, source, len(w)::bigint as n_words,
    len(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
    (len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
    (len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
      - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))))::bigint
      as n_dup_lines,
    coalesce(n, 0)::bigint as n_repeat_words
  from words left join repeated on words.r = repeated.r),
failed as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from base),
hosts as (select source, count(*)::double as n, count(*) filter (base_failed)::double as f from failed group by source),
total as (select sum(f) / sum(n) as m, sum(n) as nn, count(*)::double as h, sum(n * n) as n2, sum(f * f / n) as s from hosts),
prior as (
  select m, case when rho > 0 then least(1e6, greatest(2.0, 1 / rho - 1)) else 1e6 end as strength
  from (select m, case when m > 0 and m < 1 and nn - n2 / nn - (h - 1) <> 0
    then ((s - nn * m * m) / (m * (1 - m)) - (h - 1)) / (nn - n2 / nn - (h - 1)) end as rho from total) q),
verdicts as (select source, (f + m * strength) / (n + strength) > 0.5 as bad from hosts, prior)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and not bad as kept
from failed join verdicts on failed.source is not distinct from verdicts.source
"""

SQL["op11_hard_negatives"] = """
with e as (
  select vec_id, case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scores as (
  select a.vec_id as anchor_id, e.vec_id as id, a.label = e.label as same, list_dot_product(a.v, e.v)::bigint as score
  from e a join e on a.vec_id <> e.vec_id where a.vec_id % 50 = 0),
positives as (
  select * from (select *, row_number() over (partition by anchor_id order by score desc, id) as place
    from scores where same) q where place <= 5),
negatives as (
  select p.anchor_id, p.id as positive_id, n.id as negative_id, p.score as positive_score, n.score as negative_score,
    row_number() over (partition by p.anchor_id, p.id order by n.score desc, n.id)::integer as rank
  from positives p join scores n on n.anchor_id = p.anchor_id and not n.same
    and 50 * p.score <= 100 * n.score and 100 * n.score <= 95 * p.score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from negatives where rank <= 3
"""

# CRC-32 byte by byte, with the table made from its polynomial.
SQL["op13_importance"] = r"""
with recursive tab as (
  select i, i::bigint as c, 0 as step from range(256) r(i)
  union all
  select i, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, step + 1 from tab where step < 8),
crc as (select list(c order by i) as tab from tab where step = 8),
docs as (select row_number() over () as r, doc_id, true as ours,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
texts as (select r, ours, text from docs union all
  select 0, false, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') from benchmark),
words as (select r, ours, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as w from texts),
distinct_words as (select w, hex(encode(w)) as x from (select distinct w from words) q),
hashed as (
  select w, xor(list_reduce(list_prepend(4294967295::bigint,
      list_transform(range(len(x) // 2), lambda i: ('0x' || substr(x, 2 * i::integer + 1, 2))::bigint)),
    lambda c, b: xor(c >> 8, tab[xor(c & 255, b) + 1])), 4294967295) % 10000 as bucket
  from distinct_words, crc),
found as (select r, ours, bucket from words join hashed using (w)),
s as (select bucket, count(*) filter (ours) as s, count(*) filter (not ours) as t from found group by bucket),
total as (select coalesce(sum(s), 0)::double as ss, coalesce(sum(t), 0)::double as tt from s),
gain as (select bucket, floor(1000 * ln((t::double + 1) * (ss + 10000) / ((s::double + 1) * (tt + 10000))))::bigint as g
  from s, total),
sums as (select r, count(*)::bigint as n, sum(g)::bigint as g from found join gain using (bucket) where ours group by r),
scored as (
  select docs.r, doc_id, coalesce(n, 0)::bigint as n_features, coalesce(floor(g::double / n), 0)::bigint as weight,
    floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint + 0.5::double)
      / 4294967296::double)))::bigint as noise
  from docs left join sums using (r)),
ranked as (
  select *, weight + noise as score, row_number() over (partition by n_features >= 20
      order by weight + noise desc, doc_id nulls last, n_features) as place,
    count(*) filter (n_features >= 20) over () as many
  from scored)
select doc_id, n_features, weight, score,
  case when n_features >= 20 and place <= many * 10 // 100 then place end::bigint as rank from ranked
"""
