"""Toxicity by weak supervision: lexicon and pattern voters, a generative label
model that estimates their reliabilities and correlations, and a linear
classifier trained on its posterior labels.

1. Lexicon: a fixed seed list, and word stems chosen from the labelled sample by
   weighted covering (a stem is worth its log odds times the toxic documents not
   yet covered, so a family of copies adds few).
2. Voters: one per stem, and patterns over hit counts, density, phrases and
   shouting. Each votes 1, -1 or abstains. The given label is one more voter.
3. Label model: expectation-maximisation over the sample's votes, started from the given
   label and the votes; the evidence of a voter is divided by its positive correlations
   with others, estimated before the first round and given the class in every later one.
4. Logistic regression on the posteriors, its scale set by the given labels;
   scored over Arrow batches.

Learning uses at most ``MAX_TRAIN_ROWS`` labelled documents outside the held-out
fold; scoring reads every whole text. Null and empty text have no hits and get
the score of that point; without labels the seed voters alone define the model.
Texts of any length are read whole; repeated rows each get a row (in the sample equal
texts count once); ties at the threshold count as toxic. An empty table gives no rows.
Only the id and the text are read."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from lodestone.llm.common import free_name, held_out, label_sample, map_text, stash, text_slices
from lodestone.llm.trees import sigmoid

MAX_TRAIN_ROWS = 12_000
FOLDS, HELD_OUT = 3, 1
PREDICT_AT = 0.7
LEARNED_STEMS = 60               # word stems taken from the labelled sample, at most
SCORE = "_toxicity"              # score column beside a caller's own columns
CANDIDATE_STEMS = 4000           # stems that compete for them
MIN_ODDS = 1.5                   # lower bound of a stem's log odds ratio
DENSITY_CUT = 0.01               # hits per word, where labels set no other
MIN_STEM, MAX_STEM = 4, 8
_WORD = re.compile(r"[^\W\d_]{4,40}")

# General insults, and hostile phrases.
SEED_WORDS = ("idiot", "idiots", "moron", "stupid", "loser", "scum", "trash", "pathetic", "worthless",
              "disgusting", "clown", "dumb", "imbecile", "bastard", "jerk", "freak",
              "idiota", "estupido", "estúpido", "imbécil", "basura", "idiote", "crétin", "débile", "ordure",
              "dumm", "dummkopf", "trottel", "abschaum", "arschloch")
PHRASES = ("shut up", "go to hell", "hate you", "drop dead", "kill yourself", "nobody likes you",
           "halt die klappe", "ferme ta gueule", "vete al infierno")


@dataclass
class ToxicModel:
    words: list[str]
    cut: float
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    intercept: float


def _stems(text: str) -> Counter:
    """How often each stem (the first 4 to 8 letters of a word, or the word) starts a word."""
    words = Counter(_WORD.findall((text or "").lower()))
    out = Counter()
    for w, n in words.items():
        for k in range(MIN_STEM, min(len(w), MAX_STEM) + 1):
            out[w[:k]] += n
        if len(w) > MAX_STEM:
            out[w] += n
    return out


def learn_stems(sample: DataFrame, limit: int = LEARNED_STEMS) -> list[str]:
    """Stems of the labelled sample (``text``, ``_y``), most useful first. Equal texts count once.

    Candidates are the most frequent stems of toxic documents. A stem is worth the lower bound
    of its log odds ratio (two standard errors; a document counts it twice at most) times the
    toxic documents with it that the stems before it have not covered."""
    texts = stash(sample.groupBy(F.md5("text").alias("_k")).agg(F.max("_y").alias("y"), F.first("text").alias("text")),
                  "toxic-texts")

    def toxic_stems(batches):
        for batch in batches:
            for part in text_slices(batch):
                seen = Counter(s for t in part.column(0).to_pylist() for s in _stems(t))
                yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
                                                 ["s", "n"])

    n1, n0 = texts.agg(F.coalesce(F.sum("y"), F.lit(0)), F.coalesce(F.sum(1 - F.col("y")), F.lit(0))).first()
    if not n1 or not n0:
        return []
    found = (map_text(texts.where("y = 1").select("text"), toxic_stems, "s string, n long")
             .groupBy("s").agg(F.sum("n").alias("n")).where(F.col("n") >= max(4, 0.02 * n1))
             .orderBy(F.desc("n"), "s").limit(CANDIDATE_STEMS).collect())
    names = [r.s for r in found]
    place = {s: i for i, s in enumerate(names)}

    def hits(batches):
        for batch in batches:
            for part in text_slices(batch):
                got = [[(place[s], min(n, 2)) for s, n in _stems(t).items() if s in place] for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([[i for i, _ in g] for g in got], pa.list_(pa.int16())),
                     pa.array([[n for _, n in g] for g in got], pa.list_(pa.int8()))], ["_k", "y", "i", "n"])

    rows = map_text(texts.select("_k", "y", "text"), hits, "_k string, y int, i array<short>, n array<byte>").toArrow().sort_by("_k")
    y = rows["y"].to_numpy() > 0
    # the hits as (doc, stem, times): a table of all documents by all stems would fill the driver
    lists = rows["i"].combine_chunks()
    stem, times = lists.flatten().to_numpy(), rows["n"].combine_chunks().flatten().to_numpy()
    doc = np.repeat(np.arange(len(y), dtype=np.int32), pa.compute.list_value_length(lists).to_numpy())
    p, q = (np.bincount(stem[on], times[on], len(names)) + 0.5 for on in (y[doc], ~y[doc]))
    odds = np.log(p / (n1 + 1)) - np.log(q / (n0 + 1)) - 2 * np.sqrt(1 / p + 1 / q)
    odds = np.where(odds > MIN_ODDS, odds, 0)
    on = y[doc] & (odds[stem] > 0)
    doc, stem, times = doc[on], stem[on], times[on]
    weight, chosen = np.ones(len(y)), []
    while len(chosen) < limit:
        gain = np.bincount(stem, weight[doc], len(names)) * odds
        k = int(np.argmax(gain)) if len(gain) else 0
        if len(gain) == 0 or gain[k] < 0.01 * y.sum():
            break
        chosen.append(names[k])
        of = stem == k
        weight[doc[of]] *= np.where(times[of] >= 2, 0.5, 0.75)
        odds[k] = 0
    return chosen


def lexicon(stems: list[str]) -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for i, w in enumerate([*stems, *PHRASES]):
        a.add_word(w, (i, len(w)))
    a.make_automaton()
    return a


EXTRA = 5                        # counts after those of the entries


def raw_counts(texts: list, automaton, n_entries: int) -> np.ndarray:
    """Per text: hits of each entry at the start of a word, then words hit (once each, however
    many stems fit), words, capitals, letters, marks."""
    out = np.zeros((len(texts), n_entries + EXTRA))
    first_phrase = n_entries - len(PHRASES)
    for i, text in enumerate(texts):
        if not text:
            continue
        low = text.lower()
        places = set()
        for end, (k, n) in automaton.iter(low):
            at = end - n
            if at < 0 or not low[at].isalnum():
                out[i, k] += 1
                if k < first_phrase:
                    places.add(at)
        solid = text.encode("ascii", "ignore")
        letters = len(solid)
        capitals = letters - len(solid.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
        out[i, -EXTRA:] = (len(places), len(text.split()), capitals, letters, text.count("!"))
    return out


def _parts(c: np.ndarray):
    k = c.shape[1] - EXTRA - len(PHRASES)
    total, n, capitals, letters, marks = c[:, -EXTRA:].T
    return c[:, :k], c[:, k:k + len(PHRASES)].sum(1), total, n, capitals, letters, marks


def density(c: np.ndarray) -> np.ndarray:
    """Words hit per word; a single hit counts as none."""
    _, _, total, n, *_ = _parts(c)
    return np.where(total >= 2, total / np.maximum(n, 1), 0.0)


def density_cut(c: np.ndarray, y: np.ndarray) -> float:
    """The density that splits the given labels with the fewest errors."""
    d = density(c)
    if (y > 0).sum() < 3 or (y <= 0).sum() < 3:
        return DENSITY_CUT
    order = np.argsort(d, kind="stable")
    d, pos = d[order], (y > 0)[order]
    errors = np.concatenate(([(~pos).sum()], (~pos).sum() + np.cumsum(np.where(pos, 1, -1))))  # rows before the cut are 0
    ok = np.concatenate(([False], d[1:] > d[:-1], [False]))
    if not ok.any():
        return DENSITY_CUT
    k = int(np.flatnonzero(ok)[np.argmin(errors[ok])])
    return float((d[k] + d[k - 1]) / 2)


def model_features(c: np.ndarray, cut: float) -> np.ndarray:
    """Linear classifier inputs: totals, density, phrases, shouting, then one flag per stem."""
    stems, phrases, total, n, capitals, letters, marks = _parts(c)
    d = density(c)
    return np.column_stack([np.minimum(total, 3), np.minimum(d / cut, 2), (d >= cut) * 1.0, np.minimum(phrases, 3),
                            capitals / np.maximum(letters, 1), np.minimum(marks / np.maximum(n, 1), 1),
                            (stems > 0) * 1.0])


def votes(c: np.ndarray, seeds: int, cut: float) -> np.ndarray:
    stems, phrases, total, n, capitals, letters, marks = _parts(c)
    d, kinds = density(c), (stems > 0).sum(1)
    patterns = [np.where(d >= cut, 1, -1),
                np.where(d >= 1.25 * cut, 1, np.where(d < 0.75 * cut, -1, 0)),
                np.where(total >= 3, 1, np.where(total == 0, -1, 0)),
                np.where((kinds >= 2) & (total >= 2), 1, 0),
                np.where(stems[:, :seeds].sum(1) >= 2, 1, 0), np.where(phrases > 0, 1, 0),
                np.where((capitals > 0.3 * np.maximum(letters, 1)) & (marks > 3), 1, 0),
                np.where((n >= 50) & (total == 0) & (phrases == 0), -1, 0)]
    return np.column_stack([*patterns, (stems > 0).astype(int)])


def _discounts(corr: np.ndarray, power: int) -> np.ndarray:
    """A voter's share of the evidence it gives together with the voters it goes along with: m
    copies of one voter get 1 / m each."""
    together = np.maximum(corr, 0) ** power
    np.fill_diagonal(together, 0)
    return 1 / (1 + together.sum(1))


def _correlation(v: np.ndarray, weights: list[np.ndarray]) -> np.ndarray:
    """Correlations of the voters within the classes whose row weights are given, pooled."""
    total = np.zeros((v.shape[1], v.shape[1]))
    for p in weights:
        mean = (p @ v) / max(p.sum(), 1e-9)
        r = (v - mean) * np.sqrt(p)[:, None]
        total += r.T @ r
    sd = np.sqrt(np.maximum(np.diag(total), 1e-9))
    return total / np.outer(sd, sd)


def label_model(v: np.ndarray, rounds: int = 30, anchor: np.ndarray | None = None) -> np.ndarray:
    """Posterior of class 1 for each row of votes in {-1, 0, 1}; each voter's table of vote given
    class is estimated with smoothing.

    Voters that repeat each other must not outvote the rest while nothing is known yet: the
    first posterior is the sum of votes after discounts from the plain correlations (in the
    fourth power, as voters that are merely right agree too), and of the ``anchor``, votes
    known to be better than chance, where there is one. From then on the discounts follow
    the squared correlations given the class, anew each round."""
    n, m = v.shape
    if n == 0:
        return np.zeros(0)
    onehot = np.stack([v == -1, v == 0, v == 1]).astype(float)          # 3 x n x m
    discount = _discounts(_correlation(v, [np.ones(n)]), 4)
    start = v @ discount + (2.0 * anchor if anchor is not None else 0.0)
    post = sigmoid(np.clip(start, -4, 4))
    for _ in range(rounds):
        logp = []
        for p in (1 - post, post):
            table = np.einsum("knm,n->km", onehot, p) + np.array([0.5, 1.0, 0.5])[:, None]
            logp.append(np.log(table / table.sum(0)))
        prior = np.clip(post.mean(), 1e-3, 1 - 1e-3)
        evidence = np.einsum("knm,km->nm", onehot, logp[1] - logp[0])
        discount = _discounts(_correlation(v, [1 - post, post]), 2)
        post = sigmoid(np.log(prior / (1 - prior)) + evidence @ discount)
    return post


def logistic(x: np.ndarray, target: np.ndarray, ridge: float = 1e-3, steps: int = 25, weight: np.ndarray | None = None):
    """(mean, scale, weights, intercept) by Newton steps on soft targets, rows counting by ``weight``."""
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-3)
    share = np.full(len(x), 1 / len(x)) if weight is None else weight / weight.sum()
    a = np.hstack([np.ones((len(x), 1)), (x - mean) / scale])
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        q = sigmoid(a @ w)
        grad = a.T @ ((q - target) * share) + ridge * np.r_[0, w[1:]]
        hess = (a * (q * (1 - q) * share)[:, None]).T @ a + ridge * np.eye(len(w))
        w = w - np.linalg.solve(hess, grad)
    return mean, scale, w[1:], float(w[0])


def fit(docs: DataFrame, labels: DataFrame, max_train_rows: int = MAX_TRAIN_ROWS) -> ToxicModel:
    """``docs`` has doc_id and text."""
    picked = label_sample(labels, "toxic", FOLDS, HELD_OUT, max_train_rows)
    sample = stash(docs.join(F.broadcast(picked), docs["doc_id"] == picked["_id"])
                   .where("text is not null").select("_id", "_y", "text"), "toxic-sample")
    seeds = list(SEED_WORDS)
    words = seeds + [w for w in learn_stems(sample) if w not in seeds]
    counted = sample.select("_id", "text", "_y")
    n = len(words) + len(PHRASES)

    def run(batches):
        automaton = lexicon(words)
        for batch in batches:
            for part in text_slices(batch):
                c = raw_counts(part.column(1).to_pylist(), automaton, n)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(list(c), pa.list_(pa.float64()))], ["_id", "_y", "c"])

    got = map_text(counted, run, "_id long, _y int, c array<double>").toPandas().sort_values("_id")
    if len(got) == 0:
        c = np.vstack([np.zeros((4 * n, n + EXTRA)), np.eye(n, n + EXTRA) * 3])      # no sample: the seed voters alone
        c[:, -4] = 60
        c[4 * n:, -EXTRA] = 3
        y = np.r_[-np.ones(4 * n), np.ones(n)]
    else:
        c, y = np.stack(got["c"].to_numpy()), np.where(got["_y"] > 0, 1, -1)
    cut = density_cut(c, y if len(got) else np.zeros(len(y)))
    post = label_model(np.column_stack([y, votes(c, len(seeds), cut)]).astype(int), anchor=y)
    x = model_features(c, cut)
    mean, scale, weights, intercept = logistic(x, post)
    if len(got) and len(set(y)) == 2:       # the score's scale, from the given labels
        z = intercept + ((x - mean) / scale) @ weights
        zm, zs, zw, z0 = logistic(np.clip(z, -8, 8)[:, None], (y > 0).astype(float))
        if zw[0] > 0:
            weights, intercept = weights * zw[0] / zs[0], z0 + (intercept - zm[0]) * zw[0] / zs[0]
    return ToxicModel(words, cut, mean, scale, weights, float(intercept))


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    max_train_rows: int = MAX_TRAIN_ROWS, predict_at: float = PREDICT_AT) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    model = fit(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), labels, max_train_rows)
    scored = score_text(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                                    F.col(text_col).cast("string").alias("text")), model, ["doc_id"])
    return scored.select("doc_id", held_out("doc_id", FOLDS, HELD_OUT).alias("held_out"),
                         F.col(SCORE).alias("score"), (F.col(SCORE) >= predict_at).cast("int").alias("predicted"))


def score_text(rows: DataFrame, model: ToxicModel, keep: list[str], text: str = "text", name: str = SCORE) -> DataFrame:
    """The columns ``keep`` and the score, in ``name``, for each row."""
    n = len(model.words) + len(PHRASES)
    schema = StructType([*(rows.schema[c] for c in keep), StructField(name, DoubleType())])

    def run(batches):
        automaton = lexicon(model.words)
        for batch in batches:
            for part in text_slices(batch, text):
                texts = part.column(part.schema.get_field_index(text)).to_pylist()
                x = (model_features(raw_counts(texts, automaton, n), model.cut) - model.mean) / model.scale
                score = sigmoid(model.intercept + x @ model.weights)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(part.schema.get_field_index(c)) for c in keep), pa.array(score)], [*keep, name])

    return map_text(rows, run, schema)


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               max_train_rows: int = MAX_TRAIN_ROWS, reject_at: float = PREDICT_AT) -> DataFrame:
    """``docs`` without the rows whose score reaches ``reject_at``."""
    model = fit(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), labels, max_train_rows)
    name = free_name(docs, SCORE)
    return score_text(docs, model, docs.columns, text_col, name).where(F.col(name) < reject_at).drop(name)
