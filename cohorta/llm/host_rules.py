"""Quality rules per document, and verdicts on whole hosts from the rules' failure rates.

Everything is DataFrame functions. A document's own counts are computed in its row; only a few
numbers per document reach the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohorta.llm.common import SPACES, text_of
from cohorta.session import materialise

# The symbols that count, and the limits of the base rule.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def document_counts(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source",
                    text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, host and the counts of the base rule.

    Words are maximal runs without ASCII white space. Null and empty texts have no word and all
    counts 0. Repeated rows are counted each on their own. Only the three named columns are
    read, so further columns cannot clash.

    ``n_repeat_words`` marks the words in 3-word windows whose text occurs at least twice. A
    window is a 64-bit hash; its low bits and the window's position make one number, so one sort
    of numbers puts equal windows side by side.
    """
    trimmed = F.btrim(F.col("text"), F.lit(SPACES))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"),
                       text_of(text_col).alias("text"))
    rows = rows.withColumns({
        "w": F.split(trimmed, "[ \\t\\n\\x0B\\f\\r]+"),
        "lines": F.split("text", "\n"),
        "n_symbols": F.when(F.col("text").rlike("[#*$%&|<>]"),
                            F.length("text") - F.length(F.translate("text", SYMBOLS, "")))
        .otherwise(0).cast("long"),
    })
    # Equal lines are looked at one by one only where there are any.
    spoken = F.filter("lines", lambda x: F.btrim(x, F.lit(SPACES)) != "")
    rows = rows.withColumns({
        "word_chars": F.length(F.array_join("w", "")).cast("long"),
        "spoken": F.when(F.size(F.array_distinct("lines")) < F.size("lines"), spoken)})
    rows = rows.select(
        "doc_id", "host", "w", "word_chars", "n_symbols",
        F.when(F.col("word_chars") > 0, F.size("w")).otherwise(0).cast("long").alias("n_words"),
        F.coalesce(F.size("spoken") - F.size(F.array_distinct("spoken")), F.lit(0)).cast("long").alias("n_dup_lines"))
    rows = rows.withColumn("h", F.expr(
        "if(n_words < 3, array(), transform(sequence(0, cast(n_words - 3 as int)), "
        "i -> xxhash64(w[i], w[i + 1], w[i + 2])))"))
    # Most texts have no window twice; only the others are sorted. s: bits that hold a position.
    rows = rows.withColumn("s", F.when(F.size(F.array_distinct("h")) < F.size("h"), F.length(F.bin(F.col("n_words")))))
    rows = rows.withColumn("a", F.when(F.col("s").isNotNull(), F.expr(
        "sort_array(transform(h, (x, i) -> shiftleft(x, s) | cast(i as bigint)))")))
    same = ("shiftright(x, s) = shiftright(a[{j}], s) and "
            "h[cast(x & (shiftleft(1L, s) - 1) as int)] = h[cast(a[{j}] & (shiftleft(1L, s) - 1) as int)]")
    rows = rows.withColumn("p", F.when(F.col("s").isNotNull(), F.expr(
        "sort_array(transform(filter(a, (x, j) -> "
        f"(j > 0 and {same.format(j='j - 1')}) or (j < size(a) - 1 and {same.format(j='j + 1')})), "
        "x -> x & (shiftleft(1L, s) - 1)))")))
    repeats = F.when(F.col("s").isNotNull(), F.expr(
        "aggregate(transform(p, (x, k) -> if(k < size(p) - 1, least(3L, p[k + 1] - x), 3L)), 0L, (t, x) -> t + x)")
    ).otherwise(F.lit(0).cast("long"))
    return rows.select("doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       repeats.alias("n_repeat_words"))


def with_base_rule(counts: DataFrame) -> DataFrame:
    return counts.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


@dataclass
class BetaPrior:
    alpha: float
    beta: float


def beta_prior(hosts: DataFrame) -> BetaPrior:
    """Beta prior whose mean and variance are those of the hosts' failure rates.

    One row of sums reaches the driver. The variance is what lies above the binomial noise of the
    rates; without such (one host, equal rates) the prior weighs as much as 1,000,000 rows, so all
    hosts get the common rate. No rows: the prior is even.
    """
    rate = F.col("failed") / F.col("n")
    total, failed, square, noise = hosts.agg(
        F.sum("n"), F.sum("failed"), F.sum(F.col("n") * rate * rate), F.sum(rate * (1 - rate))).first()
    if not total:
        return BetaPrior(1.0, 1.0)
    mean = failed / total
    variance = max(square / total - mean * mean - noise / total, 0.0)
    spread = mean * (1 - mean)
    strength = min(max(spread / variance - 1, 1e-3), 1e6) if variance > 1e-12 * spread and spread > 0 else 1e6
    return BetaPrior(max(mean * strength, 1e-9), max((1 - mean) * strength, 1e-9))


def host_verdicts(judged: DataFrame, max_rate: float = 0.5) -> DataFrame:
    """One row per host: rows, failures, the shrunk rate, and whether the host is rejected.

    ``judged`` has ``host`` and ``base_failed``. Rows without a host belong to none.
    """
    hosts = (judged.filter(F.col("host").isNotNull()).groupBy("host")
             .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed")))
    prior = beta_prior(hosts)
    shrunk = (F.col("failed") + prior.alpha) / (F.col("n") + prior.alpha + prior.beta)
    return hosts.withColumn("host_rate", shrunk).withColumn("host_failed", shrunk > max_rate)


def host_rules(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text",
               max_rate: float = 0.5) -> DataFrame:
    """One row per input row with counts, the base rule, the host's rate and ``kept``.

    A document is kept if it passes the base rule and its host is not rejected. Documents without
    a host are judged by the base rule alone; an empty table gives no rows. The texts are read
    once: the counts are checkpointed, and host sums and verdicts work on them.
    """
    judged = materialise(with_base_rule(document_counts(docs, id_col, host_col, text_col)))
    hosts = host_verdicts(judged, max_rate).select(F.col("host").alias("_host"), "host_rate", "host_failed")
    return (judged.join(hosts, F.col("host") == F.col("_host"), "left").drop("_host")
            .withColumn("kept", ~F.col("base_failed") & ~F.coalesce(F.col("host_failed"), F.lit(False))))
