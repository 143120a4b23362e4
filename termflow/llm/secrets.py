"""Secret scans in DataFrame functions alone: rules, and two Markov models.

Three rules find assignments, access keys and hex digests. Beside them, runs of
token characters are scored with two character models, one of random strings
and one of ordinary identifiers, both first-order and learned from labelled
samples, over all texts of the corpus. A run is a secret when the log-likelihood
ratio of the two reaches ``threshold``. Positions count code points and an end is exclusive.

Positions come from the parts between the matches, so a scan is linear in the
text, also with very many matches. A cheap test of the whole text comes before
each rule and spares most texts the search.

Defined results: a null or empty text has no spans; overlapping spans of the
rules all stay; runs that overlap a rule's span add none; repeated rows have
equal results; with no samples of a label (no rule matches in the whole corpus)
every ratio is 0, no run is a secret and a warning is logged; other columns stay
as they are. With only a few matches in the whole corpus the model of random
strings is weak, and runs that are rare among the words can reach the threshold.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from termflow.llm.common import free_name, source, whole_text

logger = logging.getLogger(__name__)

# The rules.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: Runs that the models judge, and the characters that the models know.
RUN = r"[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
STATES = len(ALPHABET) + 1
MASK = "[SECRET]"
#: Counts that a character's own frequency weighs in a state.
BACK_OFF = 8
NO_SPANS = "array<struct<start:int,kind:int,end:int,value:string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def sums_before(sizes: Column, block: int = 256) -> Column:
    """For each element of a non-empty array the sum of those before it."""
    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0), lambda a, b: a + b)

    def of(x: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / block).cast("int")),
                             lambda b: F.slice(x, b * block + 1, F.lit(block)))
        return let(blocks, lambda parts: let(F.transform(parts, total), lambda sums: F.flatten(F.transform(
            parts, lambda part, b: let(total(F.slice(sums, F.lit(1), b)), lambda base: F.transform(
                part, lambda _, k: base + total(F.slice(part, F.lit(1), k))))))))

    return let(sizes, of)


def matches(text: Column, pattern: str, group: int) -> Column:
    """All matches of a text: parts between them, whole matches, the group's values."""
    return F.struct(F.split(text, pattern, -1).alias("parts"),
                    F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
                    F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"))


@dataclass(frozen=True)
class Rule:
    kind: int
    pattern: str
    group: int
    least: int  # characters of the group's value

    def possible(self, text: Column) -> Column:
        """Whether a text can have a match at all."""
        if self.kind == 0:
            return let(F.lower(text), lambda t: t.contains("passw") | t.contains("secret") | t.contains("token")
                       | t.contains("apikey") | t.contains("api_key"))
        if self.kind == 1:
            return text.contains("AKIA")
        return text.rlike(self.pattern)

    def spans(self, text: Column) -> Column:
        """The spans of a text, as structs of start, kind, end and value."""
        def of(m: Column) -> Column:
            sizes = F.transform(m["whole"], lambda w, i: F.length(w) + F.length(F.get(m["parts"], i)))
            return let(sums_before(sizes), lambda before: F.transform(m["whole"], lambda w, i: let(
                F.get(before, i) + F.length(F.get(m["parts"], i)), lambda start: F.struct(
                    start.alias("start"), F.lit(self.kind).alias("kind"), (start + F.length(w)).alias("end"),
                    F.get(m["value"], i).alias("value")))))

        found = F.when(self.possible(text), let(matches(text, self.pattern, self.group), lambda m: F.when(
            F.size(m["whole"]) > 0, F.filter(of(m), lambda s: F.length(s["value"]) >= self.least))))
        return F.coalesce(found, F.array().cast(NO_SPANS))

    def masked(self, text: Column, keep: Callable[[Column], Column]) -> Column:
        """The text with a mask for each match whose value ``keep`` doesn't hold for."""
        def of(m: Column) -> Column:
            return F.array_join(F.transform(m["parts"], lambda part, i: F.when(
                i == F.size(m["whole"]), part).otherwise(F.concat(part, F.when(
                    keep(F.get(m["value"], i)), F.get(m["whole"], i)).otherwise(MASK)))), "")

        return F.when(self.possible(text), let(matches(text, self.pattern, self.group), of)).otherwise(text)


# {16,} and {24,} find what the open-ended rules find with 20 and 24 characters or more.
RULES = (Rule(0, ASSIGN, 2, 6), Rule(1, ACCESS, 0, 20), Rule(2, HEX, 0, 24))
RUNS = Rule(3, RUN, 0, 20)


def states(token: Column) -> Column:
    """Each character's number in the alphabet; 0 for others."""
    return F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c))


def fit(samples: DataFrame) -> list[float]:
    """The log-likelihood ratio of each pair of characters, from samples with a
    column ``token`` and a ``label``, 1 for random strings and 0 for ordinary
    identifiers. The first character follows state 0. Null tokens and labels
    count for nothing. The result has ``STATES ** 2`` numbers, whatever the input."""
    tokens = samples.where("token IS NOT NULL AND label IS NOT NULL AND token <> ''").groupBy(
        (F.col("label") > 0).cast("int").alias("label"), "token").agg(F.count("*").alias("n"))
    pairs = tokens.select("label", "n", states(F.col("token")).alias("s")).select("label", "n", F.explode(F.transform(F.col("s"), lambda c, i: F.coalesce(
        F.get("s", i - 1), F.lit(0)) * STATES + c)).alias("pair"))
    counts = [[0] * STATES**2, [0] * STATES**2]
    for r in pairs.groupBy("label", "pair").agg(F.sum("n").alias("count")).collect():  # at most 2 * STATES ** 2 rows
        counts[r["label"]][r["pair"]] = r["count"]
    if not any(counts[0]) or not any(counts[1]):
        logger.warning("no samples of %s: no ratio is learned, the rules alone find secrets",
                     "random strings" if any(counts[0]) else "ordinary identifiers")
        return [0.0] * STATES**2
    single = [[sum(c[a * STATES + b] for a in range(STATES)) for b in range(STATES)] for c in counts]
    after = [[sum(c[a * STATES:(a + 1) * STATES]) for a in range(STATES)] for c in counts]

    def log_probability(label: int, pair: int) -> float:
        """A character after a state; rare states fall back on how frequent the character is."""
        state, char = divmod(pair, STATES)
        alone = (single[label][char] + 1) / (sum(single[label]) + STATES)
        return log((counts[label][pair] + BACK_OFF * alone) / (after[label][state] + BACK_OFF))

    return [log_probability(1, p) - log_probability(0, p) for p in range(STATES**2)]


def log_ratio(token: Column, ratios: list[float]) -> Column:
    """The log-likelihood ratio of a token."""
    table = F.split(F.lit(" ".join(f"{x:.9g}" for x in ratios)), " ").cast("array<double>")
    first = F.struct(F.lit(0).alias("prev"), F.lit(0.0).alias("sum"))
    return F.aggregate(states(token), first, lambda a, c: F.struct(
        c.alias("prev"), (a["sum"] + F.get(table, a["prev"] * STATES + c)).alias("sum")), lambda a: a["sum"])


def base_spans(text: Column) -> Column:
    return F.concat(*[r.spans(text) for r in RULES])


def scan(docs: DataFrame, ratios: list[float], text: str = "text", column: str = "spans",
         threshold: float = 20.0) -> DataFrame:
    """``docs`` with the spans of each text in order of start, then kind."""
    base, runs = free_name(docs, "base"), free_name(docs, "runs")
    out = docs.withColumn(base, base_spans(whole_text(text))).withColumn(runs, RUNS.spans(whole_text(text)))
    def added(b: Column, r: Column) -> Column:
        return F.filter(r, lambda s: ~F.exists(b, lambda x: (x["start"] < s["end"]) & (s["start"] < x["end"]))
                        & (log_ratio(s["value"], ratios) >= threshold))
    spans = F.when(F.size(base) + F.size(runs) > 0, F.array_sort(F.concat(F.col(base), added(F.col(base), F.col(runs)))))
    return out.withColumn(column, F.coalesce(spans, F.array().cast(NO_SPANS))).drop(base, runs)


def redact(docs: DataFrame, ratios: list[float], text: str = "text", threshold: float = 20.0) -> DataFrame:
    """``docs`` with a mask in place of each secret in its text."""
    column = whole_text(text)
    for rule in RULES:
        column = rule.masked(column, lambda v, rule=rule: F.length(v) < rule.least)
    column = RUNS.masked(column, lambda v: log_ratio(v, ratios) < threshold)
    return docs.withColumn(text, F.when(F.col(text).isNotNull(), column))


def samples(docs: DataFrame) -> DataFrame:
    """Labelled samples of a corpus: what the rules find in all its texts are random
    strings, the words of what is left ordinary identifiers."""
    def found(t: Column, rule: Rule) -> Column:
        values = F.regexp_extract_all(t, F.lit(rule.pattern), F.lit(rule.group))
        kept = F.filter(values, lambda v: F.length(v) >= max(rule.least, 16))
        return F.coalesce(F.when(rule.possible(t), kept), F.array().cast("array<string>"))

    def cleared(text: Column, rule: Rule) -> Column:
        return let(text, lambda t: F.when(rule.possible(t), F.regexp_replace(t, rule.pattern, " ")).otherwise(t))

    def words(t: Column) -> Column:
        for rule in RULES:
            t = cleared(t, rule)
        return F.regexp_extract_all(t, F.lit("[A-Za-z][A-Za-z0-9_-]{3,}"), F.lit(0))

    def labelled(tokens: Column, label: int) -> Column:
        return F.transform(tokens, lambda t: F.struct(t.alias("token"), F.lit(label).alias("label")))

    both = let(whole_text("text"), lambda t: F.concat(
        labelled(F.concat(*[found(t, r) for r in RULES]), 1), labelled(words(t), 0)))
    # explode_outer: explode would have the texts searched a second time, in a filter.
    return docs.select(F.explode_outer(both).alias("sample")).select("sample.token", "sample.label")


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document, by the rules and by the models."""
    docs = source(spark, sf_dir, "documents", "doc_id", "text")
    found = scan(docs, fit(samples(docs)))

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.get(F.array(*map(F.lit, KINDS)), s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def number(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", *[number(k).alias(f"n_{KINDS[k]}") for k in range(3)],
        F.sha2(listed(F.filter("spans", lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"))
