"""Host-level quality rules.

Each document is measured and judged by rules on its own words. Failures are
then counted by host (the ``source`` of ``documents``), each host's failure
rate is shrunk towards the rate of all hosts by a beta prior fitted to the
hosts themselves, and the verdict on the host comes back to its documents.

Only DataFrame functions. A document's measures never leave its row, so a very
long text costs no shuffle; host counts are combined before the shuffle, so a
host with a third of all rows is no single task's load.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.tables import sized, written

SPACE = r"\x20\x09-\x0D"
SYMBOLS = r"#*$%&|<>"
WINDOW = 3
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOL_PERCENT = 50
MAX_HOST_RATE = 0.8
BROADCAST_HOSTS = 100_000  # rejected hosts; a few MB at most

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RULES = {
    "base": "base_failed",
    "symbols": f"100 * n_symbols > {MAX_SYMBOL_PERCENT} * word_chars",
}


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once: a lambda's argument is never expanded in place."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _words(text: Column) -> Column:
    return F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "")


def _window_hashes(words: Column) -> Column:
    """Hashes of all three-word windows; none for fewer words."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    starts = F.slice(F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0))), 1, F.greatest(F.size(words) - WINDOW + 1, F.lit(0)))
    return _let(hashes, lambda h: F.transform(starts, lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(WINDOW)))))


def _repeat_words(windows: Column) -> Column:
    """Words inside windows that the text has twice or more; nothing is sorted if all windows differ."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    same = F.size(F.array_distinct(windows)) == F.size(windows)
    return F.when(same, F.lit(0)).otherwise(_let(_let(placed, _repeated), _covered))


def _repeated(placed: Column) -> Column:
    """Places, in order, of windows whose hash a neighbour in the sorted list shares."""

    def shared(p: Column, k: Column) -> Column:
        return F.coalesce(p["h"] == F.get(placed, k - 1)["h"], F.lit(False)) | F.coalesce(
            p["h"] == F.get(placed, k + 1)["h"], F.lit(False)
        )

    return F.sort_array(F.transform(F.filter(placed, shared), lambda p: p["i"]))


def _covered(places: Column) -> Column:
    """Words under windows at ``places``: each adds its words up to the next window."""
    adds = F.transform(places, lambda at, k: F.least(F.coalesce(F.get(places, k + 1) - at, F.lit(WINDOW)), F.lit(WINDOW)))
    return F.aggregate(adds, F.lit(0), lambda total, n: total + n)


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the five measures (long) and ``base_failed``; a null text has no words and fails.

    Columns of these names in the input are replaced. Rows are neither
    dropped nor merged.
    """
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    docs = docs.drop(*MEASURES, "base_failed")
    by_words = _let(
        _words(text),
        lambda w: F.struct(F.size(w).alias("n"), _let(_window_hashes(w), _repeat_words).alias("repeat")),
    )
    by_lines = _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    out = docs.withColumn("_by_words", by_words).withColumns(
        {
            "n_words": F.col("_by_words.n").cast("long"),
            "word_chars": F.length(F.regexp_replace(text, f"[{SPACE}]+", "")).cast("long"),
            "n_symbols": F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long"),
            "n_dup_lines": by_lines.cast("long"),
            "n_repeat_words": F.col("_by_words.repeat").cast("long"),
        }
    ).drop("_by_words")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed)


@dataclass(frozen=True)
class Prior:
    """Beta prior of a rule's failure rate over hosts; without spread between hosts, ``strength`` is infinite."""

    mean: float
    strength: float

    def shrunk(self, failed: Column, rows: Column) -> Column:
        if self.strength == float("inf"):
            return F.lit(self.mean)
        return (failed + F.lit(self.mean * self.strength)) / (rows + F.lit(self.strength))


def fit_prior(hosts: int, rows: int, failed: int, squares: float, spread: float) -> Prior:
    """By moments: what the hosts' rates spread beyond what their sizes explain sets the prior's strength.

    ``squares`` is the sum of squared host sizes, ``spread`` the sum over
    hosts of failed squared divided by rows.
    """
    if not rows or not hosts:
        return Prior(0.0, float("inf"))
    mean = failed / rows
    between = spread / rows - mean * mean - mean * (1 - mean) * (hosts - 1) / rows
    scale = 1 - squares / rows / rows
    if hosts < 2 or between <= 0 or scale <= 0 or not 0 < mean < 1:
        return Prior(mean, float("inf"))
    return Prior(mean, max(mean * (1 - mean) * scale / between - 1, 1.0))


def host_rates(judged: DataFrame, host: str) -> DataFrame:
    """``host, n_docs, <rule>_failed, <rule>_rate, rejected`` per host; null is a host of its own.

    ``judged`` has a boolean column per rule name. Sums over hosts reach the
    driver, never the hosts.
    """
    names = list(RULES)
    by_host = judged.groupBy(F.col(host).alias("host")).agg(
        F.count("*").alias("n_docs"), *(F.count_if(F.col(r)).alias(f"{r}_failed") for r in names)
    )
    by_host = written(by_host, "host-counts")
    n = F.col("n_docs")
    total = by_host.agg(
        F.count("*").alias("hosts"),
        F.sum("n_docs").alias("rows"),
        F.sum(n.cast("double") * n).alias("squares"),
        *(F.sum(f"{r}_failed").alias(f"{r}_failed") for r in names),
        *(F.sum(F.col(f"{r}_failed").cast("double") * F.col(f"{r}_failed") / n).alias(f"{r}_spread") for r in names),
    ).first()
    priors = {
        r: fit_prior(total["hosts"], total["rows"] or 0, total[f"{r}_failed"] or 0, total["squares"] or 0.0, total[f"{r}_spread"] or 0.0)
        for r in names
    }
    rated = by_host.withColumns({f"{r}_rate": p.shrunk(F.col(f"{r}_failed"), n).cast("double") for r, p in priors.items()})
    return rated.withColumn("rejected", F.greatest(*(f"{r}_rate" for r in names), F.lit(0.0)) > MAX_HOST_RATE)


def judge(docs: DataFrame, host: str = "source", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the measures, ``base_failed`` and ``kept``.

    ``kept`` is false for a document that fails itself or whose host's shrunk
    failure rate exceeds ``MAX_HOST_RATE`` for some rule. The measured table
    is written once and read twice: by the host counts and by the verdicts.
    Columns of the input with the names of the new ones are replaced.
    """
    keep = [c for c in keep or docs.columns if c not in (*MEASURES, "base_failed", "kept")]
    table = measured(docs).select(*keep, *([host] if host not in keep else []), *MEASURES, "base_failed")
    table = written(table, "host-measures")
    judged = table.select(F.col(host), *(F.expr(rule).alias(name) for name, rule in RULES.items()))
    bad = written(host_rates(judged, host).where("rejected").select(F.col("host").alias("_host"), F.lit(True).alias("_bad")), "rejected-hosts")
    # A small checked number of rejected hosts is broadcast; beyond it the join shuffles and adaptive execution splits a hot host.
    verdict = table.join(sized(bad, BROADCAST_HOSTS), F.col(host).eqNullSafe(F.col("_host")), "left")
    verdict = verdict.withColumn("kept", ~F.col("base_failed") & F.col("_bad").isNull())
    return verdict.select(*keep, *MEASURES, "base_failed", "kept")
