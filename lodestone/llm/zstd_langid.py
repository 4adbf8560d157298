"""Language identification by compression: each language has a zstandard
raw-content dictionary of training text; a text belongs to the language whose
dictionary compresses it smallest.

Texts are lower-cased and runs of other characters than letters become one space,
so layout and symbols do not vote. Whole texts are scored, in independent chunks of ``CHUNK`` bytes (so that the
dictionary, not the text's own beginning, explains later parts), sizes summed.
Ties go to the language with more training rows, then by name. A narrow margin
sets ``rejected``; the best guess stays in ``lang_pred``. ``und`` with score 0
is returned for null text, text without a letter, and when no language was
learned. At most ``MAX_LANGUAGES`` languages are learned, the most frequent ones. Repeated
rows each get a row; texts of any length are scored whole; an empty table gives no rows.
Only the id, text and (to learn) language columns are read."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import fold, held_out, map_text, text_slices

FOLDS, HELD_OUT = 4, 2
SAMPLE_PER_LANG = 400            # training documents a language is expected to give
CHARS_PER_DOC = 512              # of each of them, from a place its id's hash chooses
MAX_LANGUAGES = 500              # learned; their dictionaries are broadcast, DICT_BYTES each
DICT_BYTES = 192 << 10
CHUNK = 2048
LEVEL = 6
MIN_MARGIN = 0.004               # of the best size; below it the guess is marked rejected


_OTHER = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    return _OTHER.sub(" ", text.lower())


def learn_dictionaries(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang",
                       per_lang: int = SAMPLE_PER_LANG) -> list[tuple[str, int, bytes]]:
    """(language, training rows, dictionary), the most frequent language first.

    Every training row counts; a row is sampled when the hash of its id falls under its
    language's rate, so the sample is bounded per language and independent of partitioning. Of
    a sampled text a stretch goes into the dictionary, each text's share in bytes alike, so nothing
    is cut off at the end."""
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
            .where(F.col("lang").isNotNull() & F.col("text").isNotNull()
                   & fold("id", FOLDS).isNotNull() & ~held_out("id", FOLDS, HELD_OUT)))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES).collect()
    rate = F.lit(float(per_lang)) / F.element_at(
        F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(float(r["n"])))]), F.col("lang")) \
        if counts else F.lit(0.0)
    unit = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
    start = F.pmod(F.xxhash64("id", F.lit("stretch")), F.greatest(F.length("text") - CHARS_PER_DOC, F.lit(0)) + 1) + 1
    sample = (rows.where(unit < rate).select("lang", "id", F.substring("text", start.cast("int"), F.lit(CHARS_PER_DOC)).alias("text"))
              .collect())
    out = []
    for r in counts:
        parts = sorted((s["id"], s["text"]) for s in sample if s["lang"] == r["lang"])
        share = DICT_BYTES // max(len(parts), 1) - 1
        raw = [letters(t).encode()[:share].decode("utf-8", "ignore") for _, t in parts]
        out.append((r["lang"], r["n"], "\n".join(raw).encode()))
    return out


def _compressors(learned):
    out = []
    for _, _, data in learned:
        if len(data) < 8:
            out.append(zstd.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False))
            continue
        d = zstd.ZstdCompressionDict(data, dict_type=zstd.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=LEVEL)
        out.append(zstd.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False,
                                       write_checksum=False, write_dict_id=False))
    return out


def sizes(text: str, compressors) -> np.ndarray:
    raw = letters(text).encode()
    chunks = [raw[i:i + CHUNK] for i in range(0, len(raw), CHUNK)]
    return np.array([sum(len(c.compress(x)) for x in chunks) for c in compressors], dtype=np.int64)


def _decide(text, names, compressors):
    if not names or not text or not any(map(str.isalpha, text)):
        return "und", 0.0, True
    s = sizes(text, compressors)
    best = int(np.argmin(s))                                   # the first of equals is the more frequent language
    gap = (s - s[best]).astype(np.float64)
    unit = 1.0 + 0.002 * s[best]
    score = 1.0 / np.exp(-np.minimum(gap / unit, 50)).sum()
    second = np.partition(gap, 1)[1] if len(gap) > 1 else np.inf
    return names[best], float(score), bool(second < max(2.0, MIN_MARGIN * s[best]))


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                       learned: list | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for every row. ``learned`` replaces the
    dictionaries learned from ``docs``."""
    learned = learn_dictionaries(docs, id_col, text_col, lang_col) if learned is None else learned
    names = [x[0] for x in learned]
    shared = docs.sparkSession.sparkContext.broadcast(learned)     # DICT_BYTES a language

    def run(batches):
        compressors = _compressors(shared.value)
        for batch in batches:
            for part in text_slices(batch):
                got = [_decide(t, names, compressors) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([g[0] for g in got], pa.string()),
                     pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.bool_())],
                    ["doc_id", "lang_pred", "score", "rejected"])

    out = map_text(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")),
                   run, "doc_id long, lang_pred string, score double, rejected boolean")
    return out.select("doc_id", held_out("doc_id", FOLDS, HELD_OUT).alias("held_out"), "lang_pred", "score", "rejected")
