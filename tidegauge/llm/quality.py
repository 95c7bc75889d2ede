"""Quality rules of documents and of their hosts, with DataFrame functions only.

Base rules look at one text. Hosts are judged by the share of their documents that fail: the
shares of small hosts are shrunk towards the corpus by a beta prior whose mean and strength are
estimated from all hosts, and a host whose shrunk share is over `max_rate` loses all its documents.

Words are runs of characters other than the six ASCII white space ones.

Nulls: a null text is empty (and fails); a null host is one host; null ids stay. Repeated rows count
each. An empty table gives no rows. Texts are measured whole: three-word windows are sorted by a
hash with their place, so the work is n log n in the length. Only named columns are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.tables import stored, text_of

MIN_WORDS = 50
MAX_REPEATED = 50
MAX_RATE = 0.5
# The prior weighs as much as so many documents at least and at most. The least keeps one or two
# documents from condemning a host where hosts differ widely.
WEAKEST, STRONGEST = 2.0, 1e6

_SPACES = "\t\n\x0b\f\r "


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later expressions use without computing them again."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


# In a sorted window, the words' hash fills the high bits and the place the low `_b` bits.
_WINDOWS = """sort_array(case when size(_w) < 3 then cast(array() as array<bigint>) else transform(
    sequence(0, size(_w) - 3), i -> shiftleft(xxhash64(_w[i], _w[i + 1], _w[i + 2]), _b) | cast(i as bigint)) end)"""


def _equal(x: str, y: str) -> str:
    at = [f"cast({v} & (shiftleft(1L, _b) - 1) as int)" for v in (x, y)]
    words = " and ".join(f"_w[{at[0]} + {i}] = _w[{at[1]} + {i}]" for i in range(3))
    return f"shiftright({x}, _b) = shiftright({y}, _b) and {words}"


_REPEATED = f"""filter(_s, (x, k) -> (k > 0 and {_equal('x', '_s[k - 1]')})
    or (k < size(_s) - 1 and {_equal('x', '_s[k + 1]')}))"""
# Words covered by repeated windows: three each, less what the window before covers.
_COVERED = """aggregate(sort_array(transform(_r, x -> x & (shiftleft(1L, _b) - 1))),
    named_struct('at', -3L, 'n', 0L), (a, i) -> named_struct('at', i, 'n', a.n + least(3L, i - a.at)), a -> a.n)"""


def base_rules(docs: DataFrame, id_column: str = "doc_id", host_column: str = "source",
               text_column: str = "text") -> DataFrame:
    """doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(host_column).alias("host"),
                       text_of(text_column).alias("_t"))
    lines = F.filter(F.split("_t", "\n"), lambda x: F.length(F.translate(x, _SPACES, "")) > 0)
    rows = _once(rows, _w=F.array_remove(F.split("_t", r"[\x20\x09-\x0D]+"), ""), _l=lines)
    rows = rows.withColumn("_b", F.length(F.bin(F.size("_w"))))
    rows = _once(rows, _s=F.expr(_WINDOWS))
    rows = _once(rows, _r=F.expr(_REPEATED))
    n = F.size("_w").cast("long")
    out = rows.select(
        "doc_id", "host", n.alias("n_words"), F.length(F.translate("_t", _SPACES, "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.expr(_COVERED).alias("n_repeat_words"))
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                          | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")))


def host_verdicts(rules: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """host, n_docs, n_failed, rate (shrunk), host_bad."""
    hosts = rules.groupBy("host").agg(F.count("*").alias("n_docs"),
                                      F.sum(F.col("base_failed").cast("long")).alias("n_failed"))
    share = F.col("n_failed") / F.col("n_docs")
    total = hosts.agg(F.sum("n_docs").alias("_n"), F.sum("n_failed").alias("_f"), F.count("*").alias("_h"),
                      F.sum(F.col("n_docs").cast("double") * F.col("n_docs")).alias("_n2"),
                      F.sum(F.col("n_failed") * share).alias("_s"))
    m, n, h = F.col("_f") / F.col("_n"), F.col("_n").cast("double"), F.col("_h").cast("double")
    # Moments of the beta-binomial: the spread of shares beyond that of drawing documents.
    spread = F.try_divide(F.col("_s") - n * m * m, m * (1 - m)) - (h - 1)
    rho = F.try_divide(spread, n - F.col("_n2") / n - (h - 1))
    # Hosts that differ no more than chance makes them give no estimate: the strongest prior.
    strength = F.when(rho > 0, F.least(F.lit(STRONGEST), F.greatest(F.lit(WEAKEST), 1 / rho - 1))).otherwise(STRONGEST)
    prior = total.select(m.alias("_m"), strength.alias("_strength"))
    # One row.
    shrunk = hosts.join(F.broadcast(prior))
    rate = (F.col("n_failed") + F.col("_m") * F.col("_strength")) / (F.col("n_docs") + F.col("_strength"))
    return shrunk.select("host", "n_docs", "n_failed", rate.alias("rate"), (rate > max_rate).alias("host_bad"))


def judge(docs: DataFrame, id_column: str = "doc_id", host_column: str = "source", text_column: str = "text",
          max_rate: float = MAX_RATE) -> DataFrame:
    """The base rules of each row with the host's verdict and `kept`."""
    rules = stored(base_rules(docs, id_column, host_column, text_column), "rules")
    hosts = host_verdicts(rules, max_rate).select(F.col("host").alias("_host"), "rate", "host_bad")
    return rules.join(hosts, F.col("host").eqNullSafe(F.col("_host"))).drop("_host").withColumn(
        "kept", ~F.col("base_failed") & ~F.col("host_bad"))
