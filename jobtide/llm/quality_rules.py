"""Quality rules by document and by host.

Each document is measured by SQL functions and fails or passes a set of rules.  Rule failures are added up
by host (for ``documents`` the source), the failure rate of each host is shrunk by a beta prior fitted to all
hosts, and a host whose shrunk rate is above ``HOST_LIMIT`` is rejected with all its documents.  A host
with few documents is thereby judged mostly by what is usual, one with many by its own record.

Repeated words: a text is cut into windows of 8 words; each window's hash (64 bits, of the hashes of its words)
stands for it.  Only where a hash occurs twice are the windows sorted with their places, and the words they
cover added up; there is no shuffle for it and no step that grows faster than n log n.

Results for odd input: null or empty text has no words and fails; a null host is a host of its own; repeated rows
count each; an empty table gives an empty table; extra columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobtide.llm.tables import stored
from jobtide.operators.once import evaluate_once

BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
REPEATED_LIMIT = 30  # per cent of the words
SYMBOL_LIMIT = 30  # per cent of the characters in words
HOST_LIMIT = 0.5
LEAST_STRENGTH, MOST_STRENGTH = 2.0, 1000.0


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``measured``, a struct of n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words."""
    columns = docs.columns
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    step = evaluate_once(held, "words", F.filter(F.split("text", BLANK_RUN), lambda w: w != ""))
    n_words = F.size("words")
    step = evaluate_once(step, "hashes", F.transform("words", lambda w: F.xxhash64(w)))
    starts = F.sequence(F.lit(0), F.size("hashes") - WINDOW)
    windows = F.transform(starts, lambda i: F.xxhash64(*[F.get("hashes", i + k) for k in range(WINDOW)]))
    step = evaluate_once(step, "windows", F.when(F.size("hashes") >= WINDOW, windows))
    placed = F.sort_array(F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    step = evaluate_once(step, "placed", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), placed))

    def repeated(x: Column, k: Column) -> Column:
        before, after = F.get("placed", k - 1), F.get("placed", k + 1)
        return before["w"].eqNullSafe(x["w"]) | after["w"].eqNullSafe(x["w"])

    places = F.sort_array(F.transform(F.filter("placed", repeated), lambda x: x["i"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(0).alias("total"), F.lit(-WINDOW).alias("last")),
        lambda found, i: F.struct((found["total"] + F.least(F.lit(WINDOW), i - found["last"])).alias("total"), i.alias("last")),
        lambda found: found["total"],
    )
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    step = evaluate_once(step, "lines", lines)
    length = F.char_length("text")
    measured = F.struct(
        n_words.cast("bigint").alias("n_words"),
        F.char_length(F.translate("text", BLANKS, "")).cast("bigint").alias("word_chars"),
        (length - F.char_length(F.translate("text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"),
    )
    return step.select("row", measured.alias("measured"))


def failures(m: Column) -> dict[str, Column]:
    """The rules that a document can fail."""
    return {
        "short": m["n_words"] < LEAST_WORDS,
        "repeats": m["n_repeat_words"] * 100 > m["n_words"] * REPEATED_LIMIT,
        "symbols": m["n_symbols"] * 100 > m["word_chars"] * SYMBOL_LIMIT,
    }


def rejected_hosts(measured: DataFrame) -> DataFrame:
    """Hosts (column ``host``) with a shrunk failure rate above the limit in some rule, with these rates."""
    rules = failures(F.col("measured"))
    counts = [F.sum(failed.cast("bigint")).alias(name) for name, failed in rules.items()]
    hosts = stored(measured.groupBy("host").agg(F.count(F.lit(1)).alias("n"), *counts), "hosts")
    # the prior's mean is the overall rate, its strength follows from the spread of the hosts' rates
    moments = [F.sum("n").alias("n"), F.avg(1 / F.col("n")).alias("sampling")]
    for name in rules:
        moments += [F.sum(name).alias(name), F.var_samp(F.col(name) / F.col("n")).alias(f"{name}_spread")]
    prior = hosts.agg(*moments).first()
    rates = []
    for name in rules:
        mean = (prior[name] or 0) / prior["n"] if prior["n"] else 0.0
        spread = (prior[f"{name}_spread"] or 0.0) - mean * (1 - mean) * (prior["sampling"] or 0.0)
        strength = mean * (1 - mean) / spread - 1 if spread > 0 else MOST_STRENGTH
        strength = min(max(strength, LEAST_STRENGTH), MOST_STRENGTH)
        rates.append(((F.col(name) + mean * strength) / (F.col("n") + strength)).alias(f"{name}_rate"))
    return hosts.select("host", "n", *rates).where(F.greatest(*[f"{name}_rate" for name in rules]) > HOST_LIMIT)


def _judged(docs: DataFrame, kept_columns: list[str], text: str, host: str) -> DataFrame:
    """row (struct of the kept columns), measured, base_failed and kept."""
    measured = measure(docs.select(*[f"`{c}`" for c in dict.fromkeys([*kept_columns, text, host])]), text)
    narrow = F.struct(*[F.col("row").getField(c).alias(c) for c in kept_columns])
    measured = stored(measured.select(F.col("row").getField(host).alias("host"), "measured", narrow.alias("row")), "measured")
    bad = stored(rejected_hosts(measured).select(F.col("host").alias("bad host"), F.lit(True).alias("rejected")), "rejected")
    joined = measured.join(bad, F.col("host").eqNullSafe(F.col("bad host")), "left")
    rules = failures(F.col("measured"))
    base_failed = rules["short"] | rules["repeats"]
    return joined.select("row", "measured", base_failed.alias("base_failed"), (~base_failed & F.col("rejected").isNull()).alias("kept"))


def judge_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """doc_id, the measures, base_failed and kept of every document."""
    judged = _judged(docs, [doc_id], text, host)
    return judged.select(F.col("row").getField(doc_id).alias("doc_id"), "measured.*", "base_failed", "kept")


def good_documents(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The documents that pass, with all their columns."""
    return _judged(docs, docs.columns, text, host).where("kept").select("row.*")
