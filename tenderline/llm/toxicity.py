"""Toxicity by weak supervision: voters, a generative label model, a linear classifier on its posterior.

1. Voters. Stems (beginnings of words) that speak for the label in a bounded training sample, a short fixed lexicon and
   a few patterns. Each votes for a text or abstains; one more votes against texts on which all others abstain. All stems together are one regular expression over the text.
2. Label model. Which label a text has is hidden; voters (and, where given, the label itself, as one more voter) are
   noisy views of it. Expectation-maximisation estimates the prior and each voter's rates under both labels. The
   correlation of two voters' residuals shows how much they repeat each other; each voter's evidence is divided by the
   amount of agreement it shares, so ten forms of one stem count about once.
3. Classifier. A logistic model on the votes, fitted to the posterior labels with a ridge penalty, compiled into a
   column expression: scoring is one scan of whole texts in the JVM.

Fitting uses at most ``MOST`` labelled rows outside the held-out fold and as many rows without a label.
Inputs of a score: the text alone.

Defined results: a null text is empty, has no votes and is scored; without labels of both kinds the score is the share
of label 1 (0 without any label, so nothing is rejected); repeated rows get equal scores; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderline.llm.common import read_table, texts, written
from tenderline.llm.labelled import held_out, label_sample, training_rows

STEM_LENGTHS = range(3, 9)
CANDIDATES = 2_000
VOTERS = 96
# Bound of the labelled and of the unlabelled sample, in documents.
MOST = 10_000
# A stem has to occur in this many toxic texts of the sample, and its odds have to be this much above even.
LEAST_TEXTS, LEAST_LOG_ODDS = 3, 2.5
ROUNDS = 30
# Common insults and shouting.
LEXICON = (
    "idiot", "moron", "stupid", "loser", "scum", "trash", "clown", "pathetic", "worthless", "disgusting", "imbecile",
    "dumbass", "bastard", "asshole", "retard", "freak", "vermin", "shut up", "kill yourself", "go to hell",
)
PATTERNS = (r"!{3,}", r"\b\p{L}[*@#$]{2,}\p{L}", r"(?:\b\p{Lu}{4,}\b\W+){4}")


@dataclass
class Model:
    stems: list[str]
    patterns: list[str]
    weights: np.ndarray  # of the stems, then the patterns, then the voter for label 0 where no other votes
    intercept: float


def _tree(endings: list[str]) -> str:
    """A pattern for the longest of the strings, with common beginnings written once."""
    by_first: dict[str, list[str]] = {}
    for x in endings:
        if x:
            by_first.setdefault(x[0], []).append(x[1:])
    branches = "|".join(re.escape(c) + _tree(rest) for c, rest in sorted(by_first.items()))
    return f"(?:{branches})" + "?" * ("" in endings) if branches else ""


def _hits(stems: list[str]) -> Column:
    """All beginnings of words that are among the stems, the longest of each."""
    return F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(?<!\p{L})" + _tree(stems)), F.lit(0)))


def with_hits(rows: DataFrame, stems: list[str], patterns: list[str]) -> DataFrame:
    """``rows`` with what the voters see: ``_hits``, the stems found, and ``_marks``, the numbers of the patterns found."""
    hits = _hits(stems) if stems else F.array().cast("array<string>")
    marks = F.array(*[F.when(F.col("text").rlike(p), k) for k, p in enumerate(patterns)]).cast("array<int>")
    return rows.withColumn("_hits", hits).withColumn("_marks", F.array_compact(marks))


def evidence(model: Model) -> Column:
    """Intercept and the weights of all voters that fire. A stem fires for every longer stem that begins with it.

    One expression over the text in which every pattern stands once, outside the functions over the voters found: a filter on
    the score may move below a projection, and would take a pattern inside such a function along, once for each voter.
    """
    n = len(model.stems)
    begun = {s: [k for k, other in enumerate(model.stems) if s.startswith(other)] for s in model.stems}
    voters = F.array(*[F.when(F.col("text").rlike(p), n + k) for k, p in enumerate(model.patterns)]).cast("array<int>")
    if model.stems:
        known = F.create_map(*[x for s, own in begun.items() for x in (F.lit(s), F.array(*map(F.lit, own)))])
        stems = F.flatten(F.transform(_hits(model.stems), lambda hit: F.element_at(known, hit)))
        voters = F.concat(stems.cast("array<int>"), voters)
    weights = F.array(*[F.lit(float(w)) for w in model.weights])
    quiet = float(model.weights[-1])
    return F.aggregate(
        F.array_compact(F.array_distinct(voters)),
        F.struct(F.lit(0).alias("n"), F.lit(float(model.intercept)).alias("total")),
        lambda sum_, k: F.struct((sum_["n"] + 1).alias("n"), (sum_["total"] + F.get(weights, k)).alias("total")),
        lambda sum_: sum_["total"] + F.when(sum_["n"] == 0, quiet).otherwise(0.0),
    )


def candidate_stems(train: DataFrame) -> list[str]:
    """Stems of the labelled sample that speak for the label, best first."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{3,}"), F.lit(0)))
    stems = F.array_distinct(
        F.flatten(F.array(*[F.transform("words", lambda w, k=k: F.when(F.length(w) >= k, F.substring(w, 1, k))) for k in STEM_LENGTHS]))
    )
    counted = (
        train.select("label", words.alias("words"))
        .select("label", F.explode(stems).alias("stem"))
        .where(F.col("stem").isNotNull())
        .groupBy("stem")
        .agg(F.sum("label").alias("bad"), F.sum(1 - F.col("label")).alias("good"))
    )
    size = train.agg(F.sum("label"), F.sum(1 - F.col("label"))).first()
    odds = F.log((F.col("bad") + 0.5) / (size[0] + 1)) - F.log((F.col("good") + 0.5) / (size[1] + 1))
    best = (
        counted.withColumn("odds", odds)
        .where((F.col("bad") >= LEAST_TEXTS) & (F.col("odds") >= LEAST_LOG_ODDS))
        .orderBy(F.desc(F.col("odds") * F.col("bad")), F.desc(F.length("stem")), "stem")
        .limit(CANDIDATES)
    )
    return [r["stem"] for r in best.collect()]


def chosen(stems: list[str], votes: np.ndarray, labels: np.ndarray) -> list[str]:
    """Of stems that fire on the same texts the longest; then those that add most toxic texts, over and over."""
    kept, seen = [], set()
    for k in sorted(range(len(stems)), key=lambda k: (-len(stems[k]), stems[k])):
        mark = votes[:, k].tobytes()
        if mark not in seen:
            seen.add(mark)
            kept.append(k)
    bad = votes[labels == 1][:, kept] > 0
    good = (votes[labels == 0][:, kept] > 0).sum(0)
    found: list[int] = []
    for depth in range(1, 6):  # until every toxic text has up to five voters
        covered = bad[:, found].sum(1) if found else np.zeros(len(bad), int)
        while len(found) < VOTERS:
            gain = (bad & (covered < depth)[:, None]).sum(0) - 5.0 * good
            gain[found] = -1
            k = int(gain.argmax()) if len(gain) else -1
            if k < 0 or gain[k] < LEAST_TEXTS:
                break
            found.append(k)
            covered = covered + bad[:, k]
    return [stems[kept[k]] for k in found]


def label_model(votes: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Posterior of label 1 by row. ``labels``: 1, 0 or nan; a given label is one more voter, whose rates are estimated too."""
    given = ~np.isnan(labels)
    told = np.where(given, labels, 0.0)
    prior = told[given].mean()
    any_vote = votes[:, :-1].any(1)
    post = np.where(given, 0.1 + 0.8 * told, np.where(any_vote, 0.8, 0.05))
    correlation = np.eye(votes.shape[1])
    for _ in range(ROUNDS):
        weight = post.sum(), (1 - post).sum()
        hit = (post @ votes + 0.5) / (weight[0] + 1)
        slip = ((1 - post) @ votes + 0.5) / (weight[1] + 1)
        right = (post[given] @ told[given] + 9) / (post[given].sum() + 10), ((1 - post[given]) @ told[given] + 1) / ((1 - post[given]).sum() + 10)
        prior = np.clip(post.mean(), 1e-4, 1 - 1e-4)
        rest = votes - np.outer(post, hit) - np.outer(1 - post, slip)
        spread = np.sqrt((rest**2).mean(0)) + 1e-9
        correlation = (rest.T @ rest) / len(rest) / np.outer(spread, spread)
        shared = 1 + (np.clip(correlation - np.eye(len(correlation)), 0, 1) ** 2).sum(1)
        fired = (np.log(hit) - np.log(slip)) / shared
        score = np.log(prior / (1 - prior)) + votes @ fired  # who abstains says nothing
        p, q = right
        score += np.where(given, np.where(told == 1, np.log(p / q), np.log((1 - p) / (1 - q))), 0.0)
        new = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
        if np.abs(new - post).max() < 1e-4:
            return new
        post = new
    return post


def linear(votes: np.ndarray, post: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by Newton steps."""
    x = np.column_stack([votes, np.ones(len(votes))])
    w = np.zeros(x.shape[1])
    penalty = np.append(np.full(votes.shape[1], ridge), 1e-6)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(hessian, x.T @ (post - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def fit(rows: DataFrame, labels: DataFrame, parts: int, part: int, most: int = MOST) -> Model | float:
    sample = written(label_sample(labels, "toxic", parts, part, most), "label-sample")
    train = written(training_rows(rows, sample).dropDuplicates(["text", "label"]), "labelled-texts")
    seen = train.agg(F.avg("label"), F.min("label"), F.max("label")).first()
    if seen[0] is None or seen[1] == seen[2]:
        return float(seen[0] or 0.0)
    others = rows.select("doc_id").where("doc_id IS NOT NULL").join(F.broadcast(sample), "doc_id", "left_anti")
    picked = written(others.distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most), "unlabelled-sample")
    untold = written(training_rows(rows, picked), "unlabelled-texts").withColumn("label", F.lit(None).cast("double"))
    lexicon, patterns = list(LEXICON), list(PATTERNS)
    candidates = list(dict.fromkeys([*candidate_stems(train), *lexicon]))
    told = _matrix(train, candidates, [])
    stems = list(dict.fromkeys([*chosen(candidates, told[0][:, :-1], told[1]), *lexicon]))
    votes, given = _matrix(train.unionByName(untold), stems, patterns)
    post = label_model(votes, given)
    weights, intercept = linear(votes, post)
    return Model(stems, patterns, weights, intercept)


def _matrix(rows: DataFrame, stems: list[str], patterns: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Votes and labels of the bounded sample, as numbers on the driver."""
    found = with_hits(rows, stems, patterns).select("label", "_hits", "_marks").toArrow()
    labels = found.column("label").to_numpy(zero_copy_only=False).astype(float)
    votes = np.zeros((len(labels), len(stems) + len(patterns) + 1))
    number = {s: k for k, s in enumerate(stems)}
    lengths = sorted({len(s) for s in stems})
    for i, (hits, marks) in enumerate(zip(found.column("_hits").to_pylist(), found.column("_marks").to_pylist())):
        on = [number[h[:n]] for h in hits for n in lengths if n <= len(h) and h[:n] in number]
        votes[i, on + [len(stems) + k for k in marks] or [-1]] = 1
    return votes, labels


def scored(rows: DataFrame, model: Model | float) -> DataFrame:
    """``rows`` (with text) and their ``score``."""
    if isinstance(model, float):
        return rows.withColumn("score", F.lit(model))
    return rows.withColumn("score", 1 / (1 + F.exp(-evidence(model))))


def toxicity_scores(docs: DataFrame, labels: DataFrame, parts: int = 5, part: int = 0, most: int = MOST) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    rows = texts(docs)
    return scored(rows, fit(rows, labels, parts, part, most)).select(
        "doc_id", held_out(parts, part).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, parts: int = 5, part: int = 0, most: int = MOST) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    model = fit(texts(docs), labels, parts, part, most)
    names = docs.columns
    bare = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.coalesce("text", F.lit("")).alias("text"))
    return scored(bare, model).where("score < 0.5").select(*[F.col("_row").getField(c).alias(c) for c in names])


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    return toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
