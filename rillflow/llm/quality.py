"""Quality rules as weak supervision, by DataFrame functions alone.

Rules vote good (+1), bad (-1) or abstain (0) on counts taken from the whole text.
Expectation-maximisation estimates how accurate each rule is, on good documents and on those
with each defect, and how many documents of each class there are, from the number of documents
with each pattern of votes: at most 3 to the number of rules, however many documents there are.
(With one class of bad documents the estimate settles on the largest kind, whose many joint
votes outweigh those on the other kinds; hence one class for each defect.) The posterior probability of
being good then replaces the filter in which every rule must pass.

Rows: a null or empty text has no words, fails the base rules and is not kept; every row is
judged by itself, so repeated rows get the same verdict; a null ``doc_id`` is carried; an
empty table gives an empty result. ``with_counts`` and ``judge`` replace columns named like the added
ones; the stage leaves every column as it is, whatever its name. A text's words and window hashes
are held at once, about 100 bytes of memory a word.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.llm.common import let, set_aside, stored

SYMBOLS = "#*$%&|<>"
#: ASCII white space, the characters between words.
BLANKS = " \t\n\x0b\x0c\r"
WINDOW = 8
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
ADDED = (*COUNTS, "base_failed", "posterior", "kept")
MORE = ("__q_lines", "__q_upper", "__q_ends", "__q_marks")


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def _repeat_words(words: Column) -> Column:
    """Words inside a window of 8 words that occurs twice or more, the first one included.

    Window hashes are sorted with their places; equal neighbours are then compared word by
    word, so a clash of hashes adds nothing. Work per text is n log n in its words.
    """
    def covered(at: Column) -> Column:
        step = F.transform(at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW))))
        return F.aggregate(step, F.lit(0).cast("long"), lambda acc, x: acc + x)

    def repeated(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), (i + 1).alias("i"))))
        return let(placed, lambda s: let(F.sort_array(F.filter(
            F.transform(s, lambda x, k: F.when(_same(s, x, k - 1) | _same(s, x, k + 1), x["i"])),
            lambda p: p.isNotNull())), covered))

    def _same(s: Column, x: Column, k: Column) -> Column:
        y = F.when(k >= 0, F.get(s, k))
        return F.coalesce((y["h"] == x["h"]) & (F.slice(words, y["i"], WINDOW) == F.slice(words, x["i"], WINDOW)),
                          F.lit(False))

    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)),
                         lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    some = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), repeated(h)).otherwise(F.lit(0)))
    return F.when(F.size(words) > WINDOW, some).otherwise(F.lit(0)).cast("long")


def with_counts(docs: DataFrame) -> DataFrame:
    """Adds the counts the rules vote on, and ``base_failed``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    spaced = F.translate(text, BLANKS[1:], " " * (len(BLANKS) - 1))
    words = F.filter(F.split(spaced, " "), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: _without(x, BLANKS) != "")
    of_words = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeat_words(w).alias("r")))
    of_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"),
                                             F.size(F.array_distinct(x)).cast("long").alias("d")))
    size = F.length(text).cast("long")
    out = docs.drop(*ADDED).withColumns({
        "__q_words": of_words, "__q_line": of_lines,
        "word_chars": F.length(_without(text, BLANKS)).cast("long"),
        "n_symbols": size - F.length(_without(text, SYMBOLS)),
        "__q_upper": size - F.length(F.regexp_replace(text, r"\p{Lu}", "")),
        "__q_ends": size - F.length(_without(text, ".?;:")),
        "__q_marks": size - F.length(_without(text, "!")),
    })
    out = out.withColumns({
        "n_words": F.col("__q_words.n"), "n_repeat_words": F.col("__q_words.r"),
        "n_dup_lines": F.col("__q_line.n") - F.col("__q_line.d"), "__q_lines": F.col("__q_line.n"),
    }).drop("__q_words", "__q_line")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def _vote(value: Column, good: Column, bad: Column) -> Column:
    return F.when(value.isNull(), 0).when(bad, -1).when(good, 1).otherwise(0).cast("int")


#: The defect each rule looks for. Two or more rules look for each, so that one rule's slip is
#: outvoted by the others.
RULE_DEFECT = {"symbols": "noise", "symbol_share": "noise", "capitals": "shouting", "marks": "shouting",
               "repeats": "repetition", "lines": "repetition", "sentences": "structure",
               "word_length": "structure", "length": "structure"}


def rules() -> dict[str, Column]:
    """The rules by name: each votes on the counts of ``with_counts``."""
    per_word = lambda c: F.col(c) / F.when(F.col("n_words") > 0, F.col("n_words"))
    per_char = lambda c: F.col(c) / F.when(F.col("word_chars") > 0, F.col("word_chars"))
    lines = F.col("n_dup_lines") / F.when(F.col("__q_lines") > 0, F.col("__q_lines"))
    ends, mean = per_word("__q_ends"), per_word("word_chars")
    low = lambda v, good, bad: _vote(v, v < good, v > bad)
    votes = {
        "symbols": low(per_word("n_symbols"), 0.05, 0.25),
        "symbol_share": low(per_char("n_symbols"), 0.01, 0.05),
        "capitals": low(per_char("__q_upper"), 0.2, 0.5),
        "marks": low(per_word("__q_marks"), 0.05, 0.3),
        "repeats": low(per_word("n_repeat_words"), 0.1, 0.3),
        "lines": low(lines, 0.1, 0.3),
        "sentences": _vote(ends, (ends >= 0.02) & (ends <= 0.5), (ends < 0.005) | (ends > 1)),
        "word_length": _vote(mean, (mean >= 3) & (mean <= 11), (mean < 2) | (mean > 16)),
        "length": _vote(F.col("n_words"), F.col("n_words") >= 40, F.col("n_words") < 20),
    }
    return {k: votes[k] for k in RULE_DEFECT}


#: Starting chance that a rule's vote, if it votes, is bad: of any rule on a good document, and of
#: a rule on a document with the defect that the rule looks for.
ON_GOOD = 0.003
ON_DEFECT = 0.95
START_SHARE = 0.85
#: Made-up documents per class that hold the chances near the start where there are few.
HOLD = 5.0
#: A document with a defect gets bad votes of its rules at least as often, so that the defect
#: stays what it is.
LEAST_BAD = 0.5


def fit_label_model(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 50) -> list[tuple[float, list]]:
    """Classes of documents, the good ones first, then one for each defect: the class's share,
    and each rule's chance there that its vote is bad if it votes: the rule's accuracies.

    ``patterns`` has each pattern of votes with its number of documents. Votes count as
    independent given the class; abstaining tells nothing. No documents: the starting values.
    """
    defects = list(dict.fromkeys(RULE_DEFECT.values()))
    own = [None, *defects]
    start = [[ON_DEFECT if d == c else ON_GOOD for d in RULE_DEFECT.values()] for c in own]
    model = [(START_SHARE if c is None else (1 - START_SHARE) / len(defects), start[i]) for i, c in enumerate(own)]
    total = sum(n for _, n in patterns)
    for _ in range(rounds if total else 0):
        bad = [[HOLD * x for x in cls] for cls in start]
        cast = [[HOLD] * len(cls) for cls in start]
        size = [HOLD] * len(own)
        for votes, n in patterns:
            for c, p in enumerate(class_chances(votes, model)):
                size[c] += n * p
                for j, v in enumerate(votes):
                    cast[c][j] += n * p * (v != 0)
                    bad[c][j] += n * p * (v < 0)
        model = [(size[c] / sum(size),
                  [max(b / m, LEAST_BAD if d == own[c] else 0) for b, m, d in zip(bad[c], cast[c], RULE_DEFECT.values())])
                 for c in range(len(own))]
    return model


def class_chances(votes: tuple[int, ...], model: list) -> list[float]:
    """The posterior of every class, given the votes."""
    logs = [math.log(share) + sum(math.log(b if v < 0 else 1 - b) for v, b in zip(votes, bad) if v) for share, bad in model]
    top = max(logs)
    each = [math.exp(x - top) for x in logs]
    return [x / sum(each) for x in each]


def vote_patterns(counted: DataFrame) -> list[tuple[tuple[int, ...], int]]:
    """Documents per pattern of votes: a sum over all documents with at most 3^rules rows."""
    votes = rules()
    rows = counted.select(*[v.alias(k) for k, v in votes.items()]).groupBy(*votes).count().collect()
    return sorted((tuple(r[k] for k in votes), r["count"]) for r in rows)


def judge(counted: DataFrame, model: list, threshold: float = 0.5) -> DataFrame:
    """Adds ``posterior``, the chance of being good, and ``kept`` (false if the base rules failed)."""
    votes = [F.col(f"__q_vote_{k}") for k in RULE_DEFECT]
    good, *defects = model

    def against(defect) -> Column:  # the chance of the defect over that of being good
        ratio = F.lit(math.log(defect[0] / good[0]))
        for vote, d, g in zip(votes, defect[1], good[1]):
            ratio = ratio + F.when(vote < 0, math.log(d / g)).when(vote > 0, math.log((1 - d) / (1 - g))).otherwise(0.0)
        return F.exp(F.least(ratio, F.lit(500.0)))

    out = counted.withColumns({f"__q_vote_{k}": v for k, v in rules().items()})
    odds = sum((against(d) for d in defects), F.lit(0.0))
    out = out.withColumn("posterior", 1 / (1 + odds)).drop(*[f"__q_vote_{k}" for k in RULE_DEFECT])
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold)).drop(*MORE)


def op1_quality_rules(spark, sf_dir: str) -> DataFrame:
    """doc_id, the counts, base_failed, posterior and kept of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    counted = stored(with_counts(docs).drop("text"), "quality_counts")
    out = judge(counted, fit_label_model(vote_patterns(counted)))
    return out.select("doc_id", *COUNTS, "base_failed", "posterior", "kept")


def quality_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the rules keep, columns as given."""
    given, names = set_aside(docs, ("text",))
    counted = stored(with_counts(given), "quality_counts")
    return judge(counted, fit_label_model(vote_patterns(counted))).filter("kept").select(*names).toDF(*docs.columns)
