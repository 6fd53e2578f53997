"""Quality classifier: a sparse ensemble of rules over text statistics.

A random forest of shallow trees is grown on statistics of labelled texts. Every path from a root to a node is one
conjunctive rule. A logistic model with a lasso penalty weighs the rules (most weights become zero), and the rules
that remain are compiled into one Spark column expression, so scoring is a scan without Python or joins.

The forest and the weights are fitted on at most ``SAMPLE_ROWS`` labelled rows outside the held-out fold; the
statistics of a document come from its whole text. Inputs of a score: the text alone.

Defined results: a null text is empty and its statistics are 0; without labels of both kinds the score is the share of
label 1 (0.5 without any label); repeated rows get equal scores; an empty table gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderline.llm.common import SPACE_CLASS, read_table, texts, written
from tenderline.llm.labelled import SAMPLE_ROWS, held_out, label_sample, training_rows

TREES, DEPTH = 24, 3
LASSO = 0.002
SEED = 7
# Tasks of a step of fitting: the sample is bounded, and there are many short steps.
FIT_TASKS = 2


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def with_statistics(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` (doc_id, text, ...) with statistics of the text, and their names."""
    count = lambda pattern: F.regexp_count("text", F.lit(pattern)).cast("double")
    words = F.filter(F.split("text", f"{SPACE_CLASS}+"), lambda w: w != "")
    base = docs.withColumns(
        {
            "_words": words,
            "_lines": F.split("text", "\n"),
            "_chars": F.length("text").cast("double"),
            "_spaces": count(SPACE_CLASS),
        }
    )
    base = base.withColumns({"_n": F.size("_words").cast("double"), "_m": F.size("_lines").cast("double")})
    letters = F.col("_chars") - F.col("_spaces")
    of_words = lambda test: F.size(F.filter("_words", test)).cast("double")
    found = {
        "log_words": F.log1p("_n"),
        "word_length": _ratio(letters, F.col("_n")),
        "upper": _ratio(count(r"\p{Lu}"), letters),
        "symbols": _ratio(count(r"[#$%&*+=<>@^_~\\{}\[\]]"), letters),
        "marks": _ratio(count(r"[.,;:!?]"), letters),
        "shouts": _ratio(count(r"[!?]{2,}"), F.col("_n")),
        "bars": _ratio(count(r"\|"), F.col("_n")),
        "digits": _ratio(count(r"[0-9]"), letters),
        "distinct_words": _ratio(F.size(F.array_distinct("_words")).cast("double"), F.col("_n")),
        "distinct_lines": _ratio(F.size(F.array_distinct("_lines")).cast("double"), F.col("_m")),
        "line_words": F.log1p(_ratio(F.col("_n"), F.col("_m"))),
        "wordless": _ratio(of_words(lambda w: ~w.rlike(r"\p{L}")), F.col("_n")),
        "closed_lines": _ratio(F.size(F.filter("_lines", lambda x: x.rlike(r"[.!?][\"')]?\s*$"))).cast("double"), F.col("_m")),
    }
    return base.withColumns(found).drop("_words", "_lines", "_chars", "_spaces", "_n", "_m"), list(found)


Rule = tuple[tuple[int, bool, float], ...]


def tree_rules(tree_text: str) -> list[Rule]:
    """The rules of a tree from its printed form: for each node the conditions (feature, at most?, bound) above it."""
    rules, path = [], []
    for line in tree_text.splitlines():
        found = re.match(r"( +)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if found:
            del path[len(found[1]) - 2 :]
            path.append((int(found[2]), found[3] == "<=", float(found[4])))
            rules.append(tuple(sorted(_tightest(path))))
    return rules


def _tightest(path: list[tuple[int, bool, float]]) -> list[tuple[int, bool, float]]:
    """Of several bounds on one side of a feature, the one that counts."""
    best: dict[tuple[int, bool], float] = {}
    for feature, below, bound in path:
        old = best.get((feature, below), bound)
        best[feature, below] = min(old, bound) if below else max(old, bound)
    return [(f, b, x) for (f, b), x in best.items()]


def compiled(rule: Rule, names: list[str]) -> Column:
    found = F.lit(True)
    for feature, below, bound in rule:
        column = F.col(names[feature])
        found = found & ((column <= bound) if below else (column > bound))
    return found


def fit_rules(train: DataFrame, names: list[str]) -> tuple[list[tuple[Rule, float]], float] | float:
    """(rule, weight) pairs and the intercept; one constant score where there is nothing to learn."""
    seen = train.agg(F.avg("label"), F.min("label"), F.max("label")).first()
    if seen[0] is None or seen[1] == seen[2]:
        return 0.5 if seen[0] is None else float(seen[0])
    ready = written(train.select("label", array_to_vector(F.array(*names)).alias("x"), *names), "statistics").coalesce(FIT_TASKS)
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="x", numTrees=TREES, maxDepth=DEPTH, maxBins=64, subsamplingRate=0.7,
        featureSubsetStrategy="sqrt", seed=SEED,
    ).fit(ready)
    rules = list(dict.fromkeys(r for tree in forest.trees for r in tree_rules(tree.toDebugString)))
    if not rules:
        return float(seen[0])
    fires = F.array(*[compiled(r, names).cast("double") for r in rules])
    weights = LogisticRegression(labelCol="label", featuresCol="fires", elasticNetParam=1.0, regParam=LASSO, standardization=False)
    model = weights.fit(written(ready.select("label", array_to_vector(fires).alias("fires")), "rules").coalesce(FIT_TASKS))
    kept = [(r, float(w)) for r, w in zip(rules, model.coefficients, strict=True) if w]
    return kept, float(model.intercept)


def quality_scores(docs: DataFrame, labels: DataFrame, parts: int = 3, part: int = 1, most: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    rows = texts(docs)
    train, names = with_statistics(training_rows(rows, label_sample(labels, "quality", parts, part, most)))
    model = fit_rules(train, names)
    if isinstance(model, float):
        scored = rows.withColumn("score", F.lit(model))
    else:
        total = F.lit(model[1])
        for rule, weight in model[0]:
            total = total + F.when(compiled(rule, names), weight).otherwise(0.0)
        scored = with_statistics(rows)[0].withColumn("score", 1 / (1 + F.exp(-total)))
    return scored.select(
        "doc_id", held_out(parts, part).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op3_quality(spark, sf_dir: str) -> DataFrame:
    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
