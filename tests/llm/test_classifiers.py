"""The two classifiers against plain versions: rules and lasso weights, label model and linear weights, scores."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tenderline.llm.common import read_table, texts
from tenderline.llm.labelled import label_sample, training_rows
from tenderline.llm.quality import LASSO, compiled, fit_rules, op3_quality, quality_scores, tree_rules, with_statistics
from tenderline.llm.toxicity import _matrix, evidence, fit, label_model, linear, op6_toxicity, toxicity_scores
from tests.llm.conftest import SMALL

SPACE = "[\x20\x09-\x0d]"


def statistics(text):
    words = [w for w in re.split(f"{SPACE}+", text) if w]
    lines = text.split("\n")
    letters, n, m = len(text) - len(re.findall(SPACE, text)), len(words), len(lines)
    of = lambda part, whole: part / whole if whole > 0 else 0.0
    count = lambda pattern: len(re.findall(pattern, text))
    upper = sum(__import__("unicodedata").category(c) == "Lu" for c in text)
    return {
        "log_words": math.log1p(n),
        "word_length": of(letters, n),
        "upper": of(upper, letters),
        "symbols": of(count(r"[#$%&*+=<>@^_~\\{}\[\]]"), letters),
        "marks": of(count(r"[.,;:!?]"), letters),
        "shouts": of(count(r"[!?]{2,}"), n),
        "bars": of(count(r"\|"), n),
        "digits": of(count(r"[0-9]"), letters),
        "distinct_words": of(len(set(words)), n),
        "distinct_lines": of(len(set(lines)), m),
        "line_words": math.log1p(of(n, m)),
        "wordless": of(sum(not any(c.isalpha() for c in w) for w in words), n),
    }


@pytest.fixture(scope="module")
def quality_model(spark):
    docs, labels = read_table(spark, SMALL, "documents"), read_table(spark, SMALL, "labels")
    train, names = with_statistics(training_rows(texts(docs), label_sample(labels, "quality", 3, 1)))
    return train, names, fit_rules(train, names)


def test_statistics_equal_plain_ones(spark):
    rows = with_statistics(texts(read_table(spark, SMALL, "documents")))[0].collect()
    assert len(rows) > 100
    for row in rows:
        for name, value in statistics(row["text"]).items():
            assert math.isclose(row[name], value, rel_tol=1e-9, abs_tol=1e-12), name


def test_rules_fire_as_their_conditions_say(quality_model):
    train, names, (rules, _) = quality_model
    shown = train.select(*names, *[compiled(rule, names).alias(f"rule{k}") for k, (rule, _) in enumerate(rules)]).collect()
    assert rules
    for row in shown:
        for k, (rule, _) in enumerate(rules):
            assert row[f"rule{k}"] == all((row[names[f]] <= x) if below else (row[names[f]] > x) for f, below, x in rule)


def test_tree_paths():
    text = """DecisionTreeClassificationModel: depth=2
  If (feature 3 <= 0.5)
   If (feature 1 <= 2.0)
    Predict: 0.0
   Else (feature 1 > 2.0)
    Predict: 1.0
  Else (feature 3 > 0.5)
   Predict: 1.0
"""
    low = (3, True, 0.5)
    assert tree_rules(text) == [(low,), ((1, True, 2.0), low), ((1, False, 2.0), low), ((3, False, 0.5),)]


def test_weights_are_a_lasso_solution(quality_model):
    """Mean log loss plus LASSO times the absolute weights is least: the gradient says so for every kept rule."""
    train, names, (rules, intercept) = quality_model
    shown = train.select("label", *[compiled(rule, names).cast("double").alias(f"r{k}") for k, (rule, _) in enumerate(rules)]).collect()
    x = np.array([[row[f"r{k}"] for k in range(len(rules))] for row in shown])
    y, w = np.array([row["label"] for row in shown]), np.array([weight for _, weight in rules])
    rest = 1 / (1 + np.exp(-(x @ w + intercept))) - y
    slope = x.T @ rest / len(y)
    assert abs(rest.mean()) < 2e-3
    assert np.allclose(slope, -LASSO * np.sign(w), atol=2e-3)


def test_scores_are_the_compiled_rules(spark, quality_model):
    train, names, (rules, intercept) = quality_model
    rows = {r["doc_id"]: r["score"] for r in op3_quality(spark, SMALL).collect()}
    for row in with_statistics(texts(read_table(spark, SMALL, "documents")))[0].collect():
        total = intercept + sum(w for rule, w in rules if all((row[names[f]] <= x) if b else (row[names[f]] > x) for f, b, x in rule))
        assert math.isclose(rows[row["doc_id"]], 1 / (1 + math.exp(-total)), rel_tol=1e-9)


def plain_label_model(votes, labels, rounds=30):
    """The same estimates, one number at a time."""
    n, m = len(votes), len(votes[0])
    post = [0.1 + 0.8 * y if y is not None else (0.8 if any(v[:-1]) else 0.05) for v, y in zip(votes, labels)]
    told = [k for k in range(n) if labels[k] is not None]
    for _ in range(rounds):
        up, down = sum(post), sum(1 - p for p in post)
        hit = [(sum(post[k] * votes[k][j] for k in range(n)) + 0.5) / (up + 1) for j in range(m)]
        slip = [(sum((1 - post[k]) * votes[k][j] for k in range(n)) + 0.5) / (down + 1) for j in range(m)]
        right = (sum(post[k] * labels[k] for k in told) + 9) / (sum(post[k] for k in told) + 10)
        wrong = (sum((1 - post[k]) * labels[k] for k in told) + 1) / (sum(1 - post[k] for k in told) + 10)
        prior = min(max(sum(post) / n, 1e-4), 1 - 1e-4)
        rest = [[votes[k][j] - post[k] * hit[j] - (1 - post[k]) * slip[j] for j in range(m)] for k in range(n)]
        spread = [math.sqrt(sum(r[j] ** 2 for r in rest) / n) + 1e-9 for j in range(m)]
        shared = []
        for j in range(m):
            total = 1.0
            for i in range(m):
                c = sum(r[i] * r[j] for r in rest) / n / (spread[i] * spread[j]) - (1 if i == j else 0)
                total += min(max(c, 0), 1) ** 2
            shared.append(total)
        new = []
        for k in range(n):
            score = math.log(prior / (1 - prior))
            score += sum(votes[k][j] * (math.log(hit[j]) - math.log(slip[j])) / shared[j] for j in range(m))
            if labels[k] is not None:
                score += math.log(right / wrong) if labels[k] == 1 else math.log((1 - right) / (1 - wrong))
            new.append(1 / (1 + math.exp(-min(max(score, -30), 30))))
        done = max(abs(a - b) for a, b in zip(new, post)) < 1e-4
        post = new
        if done:
            break
    return post


def sample(n=240, seed=5):
    draw = random.Random(seed)
    truth = [int(draw.random() < 0.3) for _ in range(n)]
    rate = [(0.8, 0.05), (0.8, 0.05), (0.6, 0.1), (0.5, 0.02), (0.2, 0.3)]
    votes = []
    for y in truth:
        own = [int(draw.random() < r[1 - y]) for r in rate]
        own[1] = own[0]  # two voters that always agree
        votes.append([*own, int(not any(own))])
    labels = [y if draw.random() < 0.4 else None for y in truth]
    return votes, labels, truth


def test_label_model_equals_plain_one():
    votes, labels, truth = sample()
    got = label_model(np.array(votes, float), np.array([np.nan if y is None else y for y in labels], float))
    assert np.allclose(got, plain_label_model(votes, labels), atol=1e-6)
    assert got[np.array(truth) == 1].mean() > got[np.array(truth) == 0].mean() + 0.2


def test_linear_weights_are_a_ridge_solution():
    votes, labels, _ = sample(seed=6)
    x = np.array(votes, float)
    post = label_model(x, np.array([np.nan if y is None else y for y in labels], float))
    w, b = linear(x, post)
    rest = 1 / (1 + np.exp(-(x @ w + b))) - post
    assert np.allclose(x.T @ rest + w, 0, atol=1e-4) and abs(rest.sum()) < 1e-3


def test_toxicity_scores_are_the_voters_weights(spark):
    docs, labels = read_table(spark, SMALL, "documents"), read_table(spark, SMALL, "labels")
    model = fit(texts(docs), labels, 5, 0)
    assert model.stems and len(model.weights) == len(model.stems) + len(model.patterns) + 1
    scores = Counter()
    for row in op6_toxicity(spark, SMALL).collect():
        scores[row["doc_id"]] = row["score"]
    shown = texts(docs).withColumn("total", evidence(model)).collect()
    for row in shown:
        low = row["text"].lower()
        on = [w for s, w in zip(model.stems, model.weights) if re.search(r"(?<![^\W\d_])" + re.escape(s), low)]
        marks = [w for p, w in zip(model.patterns, model.weights[len(model.stems) :]) if _java(p).search(row["text"])]
        total = model.intercept + sum(on) + sum(marks) + (0 if on or marks else model.weights[-1])
        assert math.isclose(row["total"], total, rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(scores[row["doc_id"]], 1 / (1 + math.exp(-total)), rel_tol=1e-9)


def _java(pattern):
    import regex

    return regex.compile(pattern, regex.ASCII if "\\p{Lu}{4" in pattern else 0)


def test_votes_of_the_sample(spark):
    rows = spark.createDataFrame([("abx ab", 1.0), ("zz!!!", 0.0), ("", None)], "text string, label double")
    votes, labels = _matrix(rows, ["ab", "abx"], ["!{3,}"])
    by = sorted(map(tuple, np.column_stack([votes, np.nan_to_num(labels, nan=-1)]).tolist()))
    assert by == sorted([(1, 1, 0, 0, 1), (0, 0, 1, 0, 0), (0, 0, 0, 1, -1)])


@pytest.mark.parametrize("scores", [quality_scores, toxicity_scores])
def test_scores_ignore_everything_but_the_text(spark, scores):
    docs, labels = read_table(spark, SMALL, "documents"), read_table(spark, SMALL, "labels")
    other = docs.selectExpr("doc_id", "text", "'xx' as lang", "'yy' as source", "0 as n_chars", "1 as score")
    assert sorted(map(tuple, scores(docs, labels).collect())) == sorted(map(tuple, scores(other, labels).collect()))
