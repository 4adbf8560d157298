"""Quality rules: boosted trees over document statistics, flattened into node
arrays and scored over Arrow batches, with monotonic constraints.

``quality_rules(docs, labels)`` returns one row per input row. Rows with null
or empty text have zero counts and fail the base rule. Without labels of both
classes the model is constant and the base rule alone decides. Texts of any length are
counted whole; repeated rows each get a row; a probability equal to the cut keeps a
document; an empty table gives no rows. Only the id and the text are read, so extra
columns with any name are ignored."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm import trees
from lodestone.llm.common import label_sample, map_text, stash, training_rows
from lodestone.llm.statistics import FEATURES, document_counts, features

MAX_TRAIN_ROWS = 20_000          # labelled rows the model is fitted on, at most
MIN_WORDS = 20                   # base rule
MAX_REPEAT_PERCENT = 30          # base rule
KEEP_AT = 0.5                    # model probability of good quality that keeps a document
#: More of these can only lower the score.
DECREASING = ("f_symbols", "f_pipes", "f_bangs", "f_upper", "f_dup_lines", "f_repeat", "f_echo")


@dataclass
class FlatForest:
    """All trees in one set of node arrays; ``roots`` are the trees' first nodes."""
    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    @classmethod
    def of(cls, base: float, grown: list[trees.Tree]) -> "FlatForest":
        sizes = np.array([len(t.value) for t in grown], dtype=np.int64)
        roots = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int32) if grown else np.zeros(0, np.int32)

        def cat(name, shift=False):
            parts = [np.where(getattr(t, name) >= 0, getattr(t, name) + r, -1) if shift else getattr(t, name)
                     for t, r in zip(grown, roots, strict=True)]
            return np.concatenate(parts) if parts else np.zeros(0, np.int32)

        return cls(base, roots, cat("feature"), cat("threshold"), cat("left", True),
                   cat("right", True), cat("value"))

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1; every (row, tree) cursor steps at once."""
        if len(self.roots) == 0 or len(x) == 0:
            return np.full(len(x), trees.sigmoid(self.base))
        node = np.repeat(self.roots[None, :], len(x), 0)
        rows = np.arange(len(x))[:, None]
        while True:
            f = self.feature[node]
            inner = f >= 0
            if not inner.any():
                return trees.sigmoid(self.base + self.value[node].sum(1))
            go = x[rows, np.maximum(f, 0)] <= self.threshold[node]
            node = np.where(inner, np.where(go, self.left[node], self.right[node]), node)


def fit(stats: DataFrame, labels: DataFrame, max_train_rows: int = MAX_TRAIN_ROWS) -> FlatForest:
    sample = label_sample(labels, "quality", 1, 1, max_train_rows)       # remainder 1 of 1: none held out
    x, y = training_rows(stats, sample, FEATURES)
    mono = [-1 if f in DECREASING else 0 for f in FEATURES]
    return FlatForest.of(*trees.boost(x, y, n_trees=60, depth=3, monotone=mono))


def quality_rules(docs: DataFrame, labels: DataFrame, keep_at: float = KEEP_AT,
                  max_train_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, and the model's ``score``."""
    stats = stash(document_counts(docs), "quality-rules").withColumns(features())
    forest = fit(stats, labels, max_train_rows)
    keep = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                x = np.stack([part.column(c).to_numpy(zero_copy_only=False) for c in FEATURES], 1)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), pa.array(forest.score(x))], [*keep, "score"])

    scored = map_text(stats.select(*keep, *FEATURES), run,
                      ", ".join(f"{c} long" for c in keep) + ", score double")
    failed = (F.col("n_words") < MIN_WORDS) | \
        (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return scored.select(*keep, failed.alias("base_failed"),
                         (~failed & (F.col("score") >= keep_at)).alias("kept"), "score")
