"""Quality classifier: a sparse rule ensemble. Paths of boosted trees over
document statistics become conjunctive rules, a lasso logistic fit picks and
weights them, and the surviving rules are compiled into one Spark expression.

``quality_scores(docs, labels)`` returns one row per input row. Null and empty
text have zero statistics and get the score of that point. Without labels of
both classes there is no rule and every row gets the prior (0.5 with no label
at all). Texts of any length are counted whole; repeated rows each get a row (a labelled id counts
once in the fit); a score equal to the threshold predicts 1; an empty table gives no
rows. Only the id and the text are read, so extra columns are ignored."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm import trees
from lodestone.llm.common import held_out, label_sample, stash, training_rows
from lodestone.llm.statistics import FEATURES, document_counts, features

MAX_TRAIN_ROWS = 20_000          # labelled rows the ensemble is fitted on, at most
PREDICT_AT = 0.7
FOLDS, HELD_OUT = 4, 2           # rows with crc32(doc_id) mod 4 = 2 are never learned from

#: (feature, lower bound excluded, upper bound included)
Rule = tuple[tuple[str, float, float], ...]


@dataclass
class RuleModel:
    intercept: float
    rules: list[tuple[Rule, float]]


def tree_rules(grown: list[trees.Tree], names: list[str]) -> list[Rule]:
    """Every path from a root to another node, its bounds per feature merged; no rule twice."""
    found: dict[Rule, None] = {}
    for t in grown:
        todo = [(0, {})]
        while todo:
            node, box = todo.pop()
            if box:
                found.setdefault(tuple(sorted((f, lo, hi) for f, (lo, hi) in box.items())))
            f = int(t.feature[node])
            if f < 0:
                continue
            lo, hi = box.get(names[f], (-np.inf, np.inf))
            cut = float(t.threshold[node])
            todo.append((int(t.left[node]), {**box, names[f]: (lo, min(hi, cut))}))
            todo.append((int(t.right[node]), {**box, names[f]: (max(lo, cut), hi)}))
    return list(found)


def rule_matrix(rules: list[Rule], x: np.ndarray, names: list[str]) -> np.ndarray:
    out = np.ones((len(x), len(rules)))
    for k, rule in enumerate(rules):
        for f, lo, hi in rule:
            v = x[:, names.index(f)]
            out[:, k] *= (v > lo) & (v <= hi)
    return out


def lasso_logistic(r: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400):
    """(intercept, weights) by accelerated proximal gradient; the intercept is not penalised.
    Columns are scaled by their deviation, so rare rules are penalised alike."""
    scale = np.maximum(r.std(0), 1e-3)
    a = np.hstack([np.ones((len(r), 1)), (r - r.mean(0)) / scale])
    step = 4.0 * len(a) / np.linalg.norm(a, 2) ** 2
    w = np.zeros(a.shape[1])
    z, t = w.copy(), 1.0
    for _ in range(steps):
        v = z - step * (a.T @ (trees.sigmoid(a @ z) - y)) / len(a)
        v[1:] = np.sign(v[1:]) * np.maximum(np.abs(v[1:]) - step * penalty, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, w, t = v + (t - 1) / t2 * (v - w), v, t2
    weights = w[1:] / scale
    return float(w[0] - weights @ r.mean(0)), weights


def fit_rules(x: np.ndarray, y: np.ndarray, names: list[str], n_trees: int = 40, depth: int = 3,
              penalty: float = 0.005) -> RuleModel:
    base, grown = trees.boost(x, y, n_trees=n_trees, depth=depth, rate=0.2, subsample=0.6)
    rules = tree_rules(grown, names)
    if not rules:
        return RuleModel(base, [])
    intercept, w = lasso_logistic(rule_matrix(rules, x, names), y, penalty)
    return RuleModel(intercept, [(rules[k], float(w[k])) for k in np.flatnonzero(np.abs(w) > 1e-9)])


def compile_rules(model: RuleModel) -> Column:
    """The score as a Spark expression over the feature columns."""
    z = F.lit(model.intercept)
    for rule, weight in model.rules:
        on = None
        for f, lo, hi in rule:
            for c in ([F.col(f) > lo] if np.isfinite(lo) else []) + ([F.col(f) <= hi] if np.isfinite(hi) else []):
                on = c if on is None else on & c
        z = z + F.when(on, F.lit(weight)).otherwise(F.lit(0.0))
    return 1.0 / (1.0 + F.exp(-z))


def quality_scores(docs: DataFrame, labels: DataFrame, max_train_rows: int = MAX_TRAIN_ROWS,
                   predict_at: float = PREDICT_AT) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    stats = stash(document_counts(docs), "rule-ensemble").withColumns(features())
    x, y = training_rows(stats, label_sample(labels, "quality", FOLDS, HELD_OUT, max_train_rows), FEATURES)
    scored = stats.select("doc_id", held_out("doc_id", FOLDS, HELD_OUT).alias("held_out"),
                          compile_rules(fit_rules(x, y, FEATURES)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= predict_at).cast("int"))
