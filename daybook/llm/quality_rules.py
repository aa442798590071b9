"""Quality rules by weak supervision: votes, accuracies by expectation-maximisation, posterior.

Each rule votes good (1) or bad (-1) on a document, or abstains (0). Rules are
taken as independent given the hidden quality; the class prior and each rule's
accuracy on either class are estimated by EM, and a document's posterior
probability of being good replaces all-must-pass filtering.

All DataFrame functions. Statistics and votes of a document come from its own
row (no shuffle). EM never sees documents: it works on the histogram of vote
patterns, at most 3 ** (number of rules) rows whatever the table's size, one
aggregate a step; a step's estimates come back as one row.

Defined results: null and blank texts have no words, fail the base rule and are
not kept; their votes still count. An empty table gives no rows. A posterior
of exactly one half keeps the document. Without any vote the posterior is the
prior. Repeated rows are separate documents. A very long text is measured whole
and exactly: windows count as repeated by their words, not by a hash. Columns of the input named like an
output are replaced.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import BLANKS, bind, col, fresh, prepared_session, staged, table, words

STEPS, SETTLED = 25, 1e-6
#: A rule votes good on at least this share of the good documents that it votes on.
PRECISE = 0.98
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MEASURES = [*STATS, "n_lines", "capitals", "letters", "n_shouts"]


def repeated_words(w: Column, bits: Column | None = None) -> Column:
    """Words in ``w`` that lie in a 3-word window found twice or more in it.

    Each window is one long: the hash of its words above, its position in the
    low ``bits`` (as many as the text needs). After one sort of longs, windows
    with equal upper bits are neighbours. These few are sorted once more, by
    their words, as the upper bits of a long text's hashes can be equal by
    chance; positions covered by a repeated window are then counted from the
    gaps between its sorted starts.
    """
    n = F.size(w)
    bits = F.ceil(F.log2(F.greatest(n, F.lit(2)).cast("double") + 1)).cast("int") if bits is None else bits
    top = lambda x: F.call_function("shiftright", x, bits)
    place = lambda x: x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1)

    def beside(array: Column, same) -> Column:
        """The elements whose neighbour is the same."""
        near = lambda x, i: F.coalesce(same(F.get(array, i - 1)) == same(x), F.lit(False)) | F.coalesce(
            same(F.get(array, i + 1)) == same(x), F.lit(False)
        )
        return F.filter(array, near)

    def spelled(x: Column) -> Column:
        i = place(x).cast("int")
        return F.struct(F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("words"), place(x).alias("at"))

    def starts(packed: Column) -> Column:
        found = bind(F.sort_array(F.transform(beside(packed, top), spelled)), lambda s: beside(s, lambda x: x["words"]))
        return F.sort_array(F.transform(found, lambda x: x["at"]))

    def covered(s: Column) -> Column:
        gap = lambda x, i: F.least(F.lit(3).cast("long"), F.coalesce(F.get(s, i + 1) - x, F.lit(3).cast("long")))
        return F.aggregate(F.transform(s, gap), F.lit(0).cast("long"), lambda a, x: a + x)

    window = lambda i: F.call_function("shiftleft", F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)), bits).bitwiseOR(i.cast("long"))
    packed = F.sort_array(F.transform(F.sequence(F.lit(0), n - 3), window))
    return F.when(n < 4, F.lit(0).cast("long")).otherwise(bind(packed, lambda p: bind(starts(p), covered)))


def text_statistics(text: Column) -> Column:
    """Struct of the base statistics and of the further measures that the rules use."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    share = lambda m, n: F.when(n > 0, m / n).otherwise(F.lit(0.0))

    def measured(w: Column) -> Column:
        n = F.size(w).cast("long")
        joined = F.array_join(w, "")
        letters = F.length(F.regexp_replace(t, "[^\\p{L}]+", "")).cast("long")
        capitals = F.length(F.regexp_replace(t, "[^\\p{Lu}]+", "")).cast("long")
        return F.struct(
            n.alias("n_words"),
            F.length(joined).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(t, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            repeated_words(w).alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
            share(capitals, letters).alias("capitals"),
            share(letters, F.length(joined).cast("long")).alias("letters"),
            F.length(F.regexp_replace(t, "[^!?]+", "")).cast("long").alias("n_shouts"),
        )

    return bind(words(text), measured)


@dataclass(frozen=True)
class Rule:
    """``bad`` and ``good`` are conditions on the statistics struct; neither: the rule abstains."""

    name: str
    bad: str
    good: str


#: Limits of the rules, in units of the statistics.
RULES = [
    Rule("symbols", "n_symbols > 0.2 * n_words", "n_words >= 20 AND n_symbols < 0.05 * n_words"),
    Rule("symbol_share", "n_symbols > 0.05 * word_chars", "n_words >= 20 AND n_symbols < 0.01 * word_chars"),
    Rule("capitals", "capitals > 0.5", "n_words >= 20 AND capitals < 0.2"),
    Rule("letters", "letters < 0.75", "n_words >= 20 AND letters > 0.9"),
    Rule("shouts", "n_shouts > 0.2 * n_words", "n_words >= 20 AND n_shouts < 0.05 * n_words"),
    Rule("repeats", "n_repeat_words > 0.4 * n_words", "n_words >= 20 AND n_repeat_words < 0.15 * n_words"),
    Rule("lines", "n_lines >= 4 AND n_dup_lines > 0.3 * n_lines", "n_lines >= 4 AND n_dup_lines = 0"),
    Rule("word_length", "n_words >= 20 AND (word_chars < 2.5 * n_words OR word_chars > 20 * n_words)", "n_words >= 20 AND word_chars BETWEEN 3 * n_words AND 12 * n_words"),
]


def votes(stats: str, rules: list[Rule]) -> Column:
    """Array of the rules' votes on the statistics struct column ``stats``, in order."""
    # a lambda's variable stands for the struct, so that it is read and not computed anew for each rule
    holds = lambda condition: F.expr(f"exists(array(`{stats}`), s -> {of_struct('s', condition)})")
    return F.array(*[F.when(holds(r.bad), -1).when(holds(r.good), 1).otherwise(0).cast("tinyint") for r in rules])


def of_struct(variable: str, condition: str) -> str:
    """The condition with each statistic read from the struct ``variable``."""
    return re.sub(r"\b(" + "|".join(MEASURES) + r")\b", rf"{variable}.\1", condition)


def posterior(v: Column, prior: float, accuracy: list[tuple[float, float]]) -> Column:
    """P(good | votes); ``accuracy``: of each rule on good and on bad documents when it votes."""
    odds = F.lit(math.log(prior / (1 - prior)))
    for i, (on_good, on_bad) in enumerate(accuracy):
        odds = odds + F.when(v[i] == 1, F.lit(math.log(on_good / (1 - on_bad)))).when(
            v[i] == -1, F.lit(math.log((1 - on_good) / on_bad))
        ).otherwise(F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def estimate(patterns: DataFrame, n_rules: int, steps: int = STEPS) -> tuple[float, list[tuple[float, float]]]:
    """EM over the histogram ``patterns`` (v array, n long): class prior and accuracies.

    A rule looks for one kind of fault, so on a bad document it may well vote
    good: its accuracies on either class are free. Starts from a prior of 0.7
    and rules that are mostly right on good documents and find three of ten bad
    ones. Estimates are smoothed by one pseudo-vote each way and held to two
    bounds: a rule is right on ``PRECISE`` of the good documents it votes on
    (else EM would call the most frequent fault bad and the others good), and a
    bad vote is never likelier on good documents than on bad ones (else the
    classes could change places).
    """
    prior, accuracy = 0.7, [(PRECISE, 0.3)] * n_rules
    for _ in range(steps):
        p = posterior(F.col("v"), prior, accuracy)
        frame = patterns.select("v", "n", (F.col("n") * p).alias("g"))
        sums = [F.sum("n").alias("n"), F.sum("g").alias("g")]
        for i in range(n_rules):
            for name, vote in (("up", 1), ("down", -1)):
                hit = F.col("v")[i] == vote
                sums += [F.sum(F.when(hit, F.col("g")).otherwise(0.0)).alias(f"{name}_g{i}"), F.sum(F.when(hit, F.col("n") - F.col("g")).otherwise(0.0)).alias(f"{name}_b{i}")]
        got = frame.agg(*sums).first().asDict()
        if not got["n"]:
            return prior, accuracy
        before, total = prior, got["n"]
        prior = min(max((got["g"] + 1) / (total + 2), 1e-6), 1 - 1e-6)
        accuracy = []
        for i in range(n_rules):
            on_good = max(PRECISE, (got[f"up_g{i}"] + 1) / (got[f"up_g{i}"] + got[f"down_g{i}"] + 2))
            on_bad = (got[f"down_b{i}"] + 1) / (got[f"down_b{i}"] + got[f"up_b{i}"] + 2)
            accuracy.append((on_good, max(on_bad, 1 - on_good)))
        if abs(prior - before) < SETTLED:
            break
    return prior, accuracy


def judge_quality(docs: DataFrame, text: str = "text", keep: list[str] | None = None, rules: list[Rule] | None = None) -> DataFrame:
    """Append the base statistics, ``base_failed``, ``posterior`` and ``kept``.

    ``keep``: the input columns to return (default all). The kept columns and
    the votes are staged once; the histogram and the verdicts read that table.
    """
    rules = RULES if rules is None else rules
    prepared_session(docs.sparkSession)
    names = [*STATS, "base_failed", "posterior", "kept"]
    own = [c for c in (docs.columns if keep is None else keep) if c.lower() not in names]
    stats, v = fresh(docs, "quality_stats"), fresh(docs, "quality_votes")
    marked = docs.select(*[col(c) for c in own], text_statistics(col(text)).alias(stats))
    table_ = staged(marked.withColumn(v, votes(stats, rules)), "quality-votes")
    patterns = table_.groupBy(F.col(v).alias("v")).agg(F.count("*").alias("n")).checkpoint()
    prior, accuracy = estimate(patterns, len(rules))
    s = F.col(stats)
    failed = (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])
    p = posterior(F.col(v), prior, accuracy)
    return table_.select(
        *[col(c) for c in own], *[s[c].alias(c) for c in STATS], failed.alias("base_failed"), p.alias("posterior"),
        (~failed & (p >= 0.5)).alias("kept"),
    )


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
