"""Stores by digest: what is shuffled, and what a second run finds."""

from conftest import SF
from pyspark.sql import functions as F

from tidegauge.llm import ledger, secrets, token_counts
from tidegauge.llm.tables import sampled
from tidegauge.llm.queries import QUERIES


def test_one_text_of_a_digest_is_sent_per_task(spark, folder):
    """The aggregate runs below the shuffle, and the join with what is stored above it."""
    rows = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("a copy of a text").alias("text")).repartition(8)
    seen = []

    def work(missing):
        seen.append(missing._jdf.queryExecution().executedPlan().toString())
        return missing.select("_digest", F.length("text").cast("long").alias("n"))

    keyed, found = ledger.resolve(rows, folder, "v", "_digest string, n long", work)
    assert found.count() == 1 and keyed.count() == 2000
    lines = [x for x in seen[0].splitlines() if "Exchange hashpartitioning" in x or "partial_first" in x]
    first = [i for i, x in enumerate(lines) if "partial_first" in x]
    text = [i for i, x in enumerate(lines) if "Exchange" in x]
    assert first and text and text[0] < first[0], seen[0]  # plans are printed from the top


def test_a_second_run_works_on_nothing(spark, docs, folder):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    first = sorted(map(tuple, token_counts.token_counts(docs, path, folder).collect()))
    stored = spark.read.option("recursiveFileLookup", "true").parquet(folder).count()
    assert sorted(map(tuple, token_counts.token_counts(docs, path, folder).collect())) == first
    assert spark.read.option("recursiveFileLookup", "true").parquet(folder).count() == stored
    more = docs.unionByName(docs.limit(3).withColumn("text", F.concat(F.lit("new "), "text")))
    token_counts.token_counts(more, path, folder).collect()
    assert spark.read.option("recursiveFileLookup", "true").parquet(folder).count() == stored + 3


def test_registered_scans_find_the_ledger_of_the_run_before(spark):
    first = sorted(map(str, QUERIES["op6_secrets"](spark, SF).collect()))
    assert sorted(map(str, QUERIES["op6_secrets"](spark, SF).collect())) == first


def test_counts_of_kinds(spark):
    for r in QUERIES["op6_secrets"](spark, "/root/testdata/sf0.01").collect():
        kinds = [s.split(":")[0] for s in r.spans.split(",")]
        assert [r.n_assign, r.n_access, r.n_hex] == [kinds.count(k) for k in ("assign", "access", "hex")]


def test_added_kinds():
    long = "A1b2" * 9
    texts = {f"x gh{c}_{long} y": [("github", 2)] for c in "pousr"} | {
        f"gh_{long} ghx_{long} ghp_{long[:35]}": [], "-----BEGIN RSA PRIVATE KEY-----": [("pem", 0)], "-----BEGIN PUBLIC KEY-----": [],
        "a xoxb-1234567890 b": [("slack", 2)], "xoxb-123456789": [], "xoxz-1234567890123": [],
        "t=eyJhbGciOiJI.eyJzdWIiOiIx.c2lnbmF0dXJl z": [("jwt", 2)], "eyJhbGciOiJI.eyJzdWIiOiIx": [], "eyJa.eyJb.c": []}
    for text, want in texts.items():
        found = secrets.find(text, list(range(secrets.BASE_KINDS, len(secrets.RULES))))
        assert [(secrets.RULES[k][0], s) for s, k, _ in found] == want, text
        for s, k, e in found:
            assert text[s:e] == text[s:].split(" ")[0] or k == 3


def test_bounded_samples_are_the_smallest_hashes(spark):
    rows = spark.range(5000).withColumn("x", F.col("id") * 2)
    want = [r.id for r in rows.orderBy(F.xxhash64("id"), "id").limit(100).collect()]
    got = sampled(rows, ["id"], 100, "sample")
    assert sorted(r.id for r in got.collect()) == sorted(want) and got.columns == rows.columns
    assert sampled(rows, ["id"], 9000, "sample").count() == 5000
