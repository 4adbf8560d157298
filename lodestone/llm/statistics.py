"""Per-document counts, one pass over the bytes of each whole text.

Nulls count as empty text; empty text has zero everywhere. Input columns other
than the id and the text are not read, so clashing names do no harm; repeated
rows are counted each on its own."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import TextBytes, map_text, mix, text_slices

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
          "n_pipes", "n_bangs", "n_upper", "n_digits", "n_stops", "n_echo_words", "n_distinct"]
FEATURES = ["f_log_words", "f_word_len", "f_symbols", "f_pipes", "f_bangs", "f_upper", "f_digits", "f_stops",
            "f_dup_lines", "f_repeat", "f_echo", "f_distinct"]
SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)
WINDOW = 8                       # words in a repeat window


def _lut(chars: bytes) -> np.ndarray:
    t = np.zeros(256, dtype=bool)
    t[list(chars)] = True
    return t


_SYMBOLS, _PIPE, _BANG = _lut(b"#*$%&|<>"), _lut(b"|"), _lut(b"!?")
_UPPER, _DIGIT, _STOP = _lut(bytes(range(65, 91))), _lut(bytes(range(48, 58))), _lut(b".,;:")


def repeat_words(t: TextBytes, width: int = WINDOW) -> np.ndarray:
    """Words of each row that lie in a ``width``-word window found twice or more in that row."""
    row, h, at = t.windows(width)
    out = np.zeros(len(t.n_words), dtype=np.int64)
    if len(h) == 0:
        return out
    key = h ^ mix(row.astype(np.uint64))
    order = np.argsort(key, kind="stable")
    ks, rs = key[order], row[order]
    same = (ks[1:] == ks[:-1]) & (rs[1:] == rs[:-1])
    twice = np.zeros(len(h), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    begin = at[twice]
    cover = np.zeros(len(t.starts) + 1, dtype=np.int64)
    np.add.at(cover, begin, 1)
    np.add.at(cover, begin + width, -1)
    covered = np.concatenate(([0], np.cumsum(np.cumsum(cover[:-1]) > 0)))
    return covered[t.first[1:]] - covered[t.first[:-1]]


def _lines(t: TextBytes):
    """(lines with a word, those equal to an earlier one) for each row."""
    n, dup = np.zeros(len(t.n_words), np.int64), np.zeros(len(t.n_words), np.int64)
    for i in np.flatnonzero(t.n_words):
        lines = [x for x in t.row_bytes(i).split(b"\n") if x.strip()]   # bytes.strip: space, 0x09-0x0D
        n[i] = len(lines)
        if len(lines) > 1:
            dup[i] = len(lines) - len(set(lines))
    return n, dup


def count_batch(text: pa.Array) -> dict[str, np.ndarray]:
    t = TextBytes(text)
    h, rows = t.word_hash(), len(t.n_words)
    row = np.repeat(np.arange(rows), t.n_words)
    code_points = t.solid & ((t.buf & 0xC0) != 0x80)
    echo = np.zeros(len(h), dtype=bool)
    echo[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    bits = np.uint64(max(1, int(rows).bit_length()))          # distinct words: hash prefix beside the row
    key = np.sort((h >> bits << bits) | row.astype(np.uint64))
    new = np.ones(len(key), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    low = (np.uint64(1) << bits) - np.uint64(1)
    n_lines, n_dup = _lines(t)
    return {
        "n_words": t.n_words, "word_chars": t.per_row(code_points),
        "n_symbols": t.per_row(_SYMBOLS[t.buf]), "n_dup_lines": n_dup,
        "n_repeat_words": repeat_words(t), "n_lines": n_lines,
        "n_pipes": t.per_row(_PIPE[t.buf]), "n_bangs": t.per_row(_BANG[t.buf]),
        "n_upper": t.per_row(_UPPER[t.buf]), "n_digits": t.per_row(_DIGIT[t.buf]),
        "n_stops": t.per_row(_STOP[t.buf]),
        "n_echo_words": np.bincount(row[echo], minlength=rows),
        "n_distinct": np.bincount((key[new] & low).astype(np.int64), minlength=rows),
    }


def document_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``COUNTS`` of every row's whole text."""
    def run(batches):
        for batch in batches:
            for part in text_slices(batch):
                c = count_batch(part.column(1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c[k].astype(np.int64)) for k in COUNTS)],
                    ["doc_id", *COUNTS])

    return map_text(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                                F.col(text_col).cast("string").alias("text")), run, SCHEMA)


def _per(a: str, b: str) -> Column:
    return F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0))


def features() -> dict[str, Column]:
    """``FEATURES``, the statistics a model sees, as expressions over ``COUNTS``: ratios, log length."""
    return {
        "f_log_words": F.log1p("n_words"),
        "f_word_len": _per("word_chars", "n_words"),
        "f_symbols": _per("n_symbols", "n_words"),
        "f_pipes": _per("n_pipes", "n_words"),
        "f_bangs": _per("n_bangs", "n_words"),
        "f_upper": _per("n_upper", "word_chars"),
        "f_digits": _per("n_digits", "word_chars"),
        "f_stops": _per("n_stops", "n_words"),
        "f_dup_lines": _per("n_dup_lines", "n_lines"),
        "f_repeat": _per("n_repeat_words", "n_words"),
        "f_echo": _per("n_echo_words", "n_words"),
        "f_distinct": _per("n_distinct", "n_words"),
    }
