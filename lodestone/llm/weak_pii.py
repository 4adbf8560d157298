"""Personal data by weak supervision. Base spans (email, ip, card, phone) follow
fixed patterns and always stay; further candidates (secrets, account numbers,
national ids, national phone numbers, names) are voted on by pattern, gazetteer
and context labelers, and a span classifier decides.

One pass finds base spans and candidates with their votes; vote patterns are
counted over all documents (at most 3^voters patterns a kind, so the counts are
small); expectation-maximisation over the counts estimates every voter's
reliability for each kind; a logistic regression on the posteriors, patterns weighted by
their counts and the kind among its inputs, scores a candidate.

Offsets are code points, ends exclusive. Null and empty text have no spans. Only
the id and the text are read by ``find_pii``; ``redact`` keeps every column.
Repeated rows are each handled on their own; texts of any length are read whole; of
overlapping candidates the first kind in order wins. An empty table gives no rows."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import map_text, stash, text_slices
from lodestone.llm.trees import sigmoid
from lodestone.llm.weak_toxicity import logistic

BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("secret", "account", "national_id", "local_phone", "name")
KINDS = BASE_KINDS + MORE_KINDS
ACCEPT_AT = 0.5
LONG = 256                       # a longer candidate is not dropped for a span inside it

# Gazetteers and cue words.
GIVEN_NAMES = frozenset("""james mary john patricia robert jennifer michael linda david elizabeth william barbara
thomas susan sarah karen daniel nancy anna maria jose carlos antonio juan pedro lucia carmen jean pierre marie
claire sophie hans peter klaus ursula heidi wolfgang juergen sabine ahmed fatima mohammed wei li""".split())
CUES = {
    "secret": ("token", "secret", "password", "passwd", "pwd", "key", "credential"),
    "account": ("iban", "account", "konto", "cuenta", "compte", "bank"),
    "national_id": ("ssn", "social security", "passport", "dni", "national id"),
    "local_phone": ("phone", "call", "tel", "mobile", "fax", "telefon", "llame", "appelez"),
    "name": ("name", "mr", "mrs", "ms", "dr", "dear", "herr", "frau", "señor", "madame", "monsieur"),
    "email": ("mail", "contact", "write"), "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "karte", "tarjeta"), "phone": ("phone", "call", "tel", "mobile", "fax"),
}
DOUBT = ("version", "isbn", "sha", "commit", "checksum", "example", "sample", "section", "figure", "page")

# Characters of an IBAN by country.
IBAN_LENGTH = {"AT": 20, "BE": 16, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18, "FR": 27,
               "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21,
               "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27,
               "TR": 26}

_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9][0-9]*(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_CANDIDATES = {
    "secret": re.compile(r"(?:token|secret|passwo?r?d|pwd|api[_ -]?key|access[_ -]?key)\s{0,3}[:=]\s{0,3}"
                         r"[\"']?([^\s\"']{8,})|\b(AKIA[0-9A-Z]{16})\b|\b([0-9a-f]{32,})\b", re.I),
    "account": re.compile(r"\b([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?)\b"),
    "national_id": re.compile(r"(?<![0-9-])([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])"),
    "local_phone": re.compile(r"(?<![0-9+)-])(\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4})(?![0-9-])"),
    "name": re.compile(r"\b((?:Mr|Mrs|Ms|Dr|Herr|Frau|Madame|Monsieur)\.? [A-ZÀ-Þ][\w'-]{1,30}(?: [A-ZÀ-Þ][\w'-]{1,30})?"
                       r"|(?:" + "|".join(sorted(n.capitalize() for n in GIVEN_NAMES)) + r") [A-ZÀ-Þ][\w'-]{1,30})\b"),
}
_TITLE = re.compile(r"(?:Mr|Mrs|Ms|Dr|Herr|Frau|Madame|Monsieur)\.? ")
VOTERS = ("cue", "doubt", "assignment", "quoted", "check", "gazetteer", "monotonous", "shape")
#: Trust in the voters before any data, in log odds; a span without votes starts at ``BIAS``.
TRUST = np.array([1.5, 3.0, 1.0, 0.5, 2.0, 2.0, 2.0, 1.0])
BIAS = -1.2
#: Only texts with one of these can hold a candidate of the kind.
_DIGITS = re.compile(r"[0-9]")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The fixed patterns, leftmost and non-overlapping within a kind, by kind and start.

    Emails grow from each ``@``: any start inside the run of local characters before it
    succeeds or fails alike, so the run's start decides. Dotted numbers are cut into
    groups of four parts. Both read the text once, however long its runs are."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _EMAIL.match(text, start) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    if not _DIGITS.search(text):
        return out
    for m in _DOTTED.finditer(text):
        if m.group().count(".") < 3:
            continue
        parts, pos = m.group().split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = pos + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                out.append(("ip", pos, end))
            pos = end + 1
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = re.sub("[^0-9]", "", m.group())
            if 13 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def _entropy(s: str) -> float:
    n = len(s)
    return -sum(c / n * np.log2(c / n) for c in Counter(s).values())


def _iban_ok(s: str) -> bool:
    s = s.replace(" ", "")
    if IBAN_LENGTH.get(s[:2]) != len(s):
        return False
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1 if s.isalnum() and s.isascii() else False


def span_votes(text: str, kind: str, start: int, end: int) -> str:
    """One character per voter: + - or 0."""
    value, before = text[start:end], text[max(0, start - 40):start].lower()
    after = text[end:end + 20].lower()
    digits = sum(c.isdigit() for c in value)
    cue = any(c in before for c in CUES[kind])
    v = [
        "+" if cue else "0",                                                       # context: cue word before
        "-" if any(d in before for d in DOUBT) else "0",                           # context: doubt
        "+" if re.search(r"[:=]\s*[\"']?$", before) else "0",                      # context: assignment
        "+" if before[-1:] in "\"'(<" and before and after[:1] in "\"')>" and after else "0",   # context: quoted
        {"secret": "+" if _entropy(value) >= 3 else "-", "account": "+" if _iban_ok(value) else "-",
         "national_id": "-" if value[:3] in ("000", "666") or value[0] == "9" else "+"}.get(kind, "0"),   # checks
        "+" if kind == "name" and value.split()[0].strip(".").lower() in GIVEN_NAMES else "0",       # gazetteer
        "-" if len(set(value)) <= 3 else "0",                                      # pattern: monotonous
        "+" if kind in BASE_KINDS or (kind == "secret" and 0 < digits < len(value) and len(value) >= 20)
        or (kind == "local_phone" and digits == 10) or kind == "national_id" or (kind == "name" and _TITLE.match(value)) else
        ("-" if kind == "secret" and digits == 0 else "0"),                        # pattern: shape
    ]
    return "".join(v)


def candidates(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Further spans, kinds in order, none overlapping a base span or an earlier candidate."""
    return [x[:3] for x in _voted(text, taken)]


def _voted(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int, str]]:
    """The candidates with their vote patterns. A secret over ``LONG`` characters that overlaps
    other spans gives its parts between them, each with the votes of the whole."""
    out, used = [], sorted((s, e) for _, s, e in taken)
    has_digit = bool(_DIGITS.search(text))
    for kind in MORE_KINDS:
        if kind in ("account", "national_id", "local_phone") and not has_digit:
            continue
        for m in _CANDIDATES[kind].finditer(text):
            g = next(i for i, x in enumerate(m.groups(), 1) if x is not None)
            s, e = m.span(g)
            parts = [(s, e)]
            cuts = sorted((a, b) for a, b in used if a < e and b > s)
            if cuts:
                parts, at = [], s
                for a, b in cuts if e - s > LONG else ():
                    if a > at:
                        parts.append((at, a))
                    at = max(at, b)
                if e - s > LONG and at < e:
                    parts.append((at, e))
            if parts:
                votes = _pattern(kind, span_votes(text, kind, s, e))
                out += [(kind, a, b, votes) for a, b in parts]
                used += parts
    return out


def written(spans) -> str:
    order = {k: i for i, k in enumerate(KINDS)}
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (order[x[0]], x[1], x[2])))


def _pattern(kind: str, votes: str) -> str:
    return f"{kind}|{votes}"


def _examine(docs: DataFrame) -> DataFrame:
    """doc_id, counts, base spans written, and the patterns and spans of all candidates."""
    def run(batches):
        for batch in batches:
            for part in text_slices(batch):
                rows = []
                for text in part.column(1).to_pylist():
                    text = text or ""
                    base = base_spans(text)
                    more = _voted(text, base)
                    n = Counter(k for k, _, _ in base)
                    rows.append((*(n[k] for k in BASE_KINDS), written(base),
                                 [_pattern(k, span_votes(text, k, s, e)) for k, s, e in base],
                                 [written([x[:3]]) for x in more],
                                 [x[3] for x in more]))
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.string()),
                     *(pa.array(c, pa.list_(pa.string())) for c in cols[5:])],
                    ["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base", "base_patterns", "more", "patterns"])

    return map_text(docs, run, "doc_id long, " + ", ".join(f"n_{k} long" for k in BASE_KINDS)
                    + ", base string, base_patterns array<string>, more array<string>, patterns array<string>")


def _inputs(v: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Classifier inputs: every voter for and against, the kind, and the check by kind."""
    flags = np.stack([kind == k for k in range(len(KINDS))], axis=1)
    check = v[:, [VOTERS.index("check")]]
    more = flags[:, len(BASE_KINDS):]
    return np.column_stack([v == 1, v == -1, flags, (check == 1) & more, (check == -1) & more]).astype(float)


def fit(pattern_counts: list[tuple[str, int]]) -> dict[str, float]:
    """Score of every pattern, from how often each occurs. A voter's reliability is estimated for
    each kind, drawn towards the one over all kinds; spans of the fixed patterns are certain."""
    if not pattern_counts:
        return {}
    names = sorted(p for p, _ in pattern_counts)
    count = dict(pattern_counts)
    n = np.array([count[p] for p in names], dtype=float)
    kind = np.array([KINDS.index(p.split("|")[0]) for p in names])
    v = np.array([[{"+": 1, "-": -1}.get(c, 0) for c in p.split("|")[1]] for p in names])
    onehot = np.stack([v == -1, v == 0, v == 1]).astype(float)
    base = kind < len(BASE_KINDS)
    post = np.where(base, 0.99, sigmoid(2 * (BIAS + v @ TRUST)))
    kinds = [kind == k for k in range(len(KINDS))]
    for _ in range(30):
        logp = []
        for p in (1 - post, post):
            mass = p * n
            pooled = np.einsum("knm,n->km", onehot[:, ~base], mass[~base]) + 1.0
            pooled = pooled / pooled.sum(0)
            table = np.stack([np.einsum("knm,n->km", onehot[:, on], mass[on]) + 2 * pooled for on in kinds])
            logp.append(np.log(table / table.sum(1, keepdims=True)))
        prior = np.array([np.clip((post * n)[on].sum() / max(n[on].sum(), 1e-9), 0.1, 0.9) for on in kinds])[kind]
        evidence = np.einsum("knm,nkm->nm", onehot, (logp[1] - logp[0])[kind])
        # a voter is never trusted the wrong way round, nor without end, and silence says nothing
        evidence = np.where(v > 0, np.clip(evidence, 0.1 * TRUST, 2 * TRUST),
                            np.where(v < 0, np.clip(evidence, -2 * TRUST, -0.5 * TRUST), 0.0))
        silent = np.where((v != 0).any(1), 0.0, BIAS)
        post = np.where(base, 0.99, sigmoid(np.log(prior / (1 - prior)) + silent + evidence.sum(1)))
    x = _inputs(v, kind)
    mean, scale, w, b = logistic(x, post, ridge=1e-4, weight=np.maximum(n, n.sum() / len(n) / 10))
    return dict(zip(names, sigmoid(b + ((x - mean) / scale) @ w).tolist(), strict=True))


def _learn(examined: DataFrame) -> dict[str, float]:
    rows = (examined.select(F.explode(F.concat("base_patterns", "patterns")).alias("p"))
            .groupBy("p").agg(F.count("*").alias("n")).collect())
    return fit([(r.p, r.n) for r in rows])


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             accept_at: float = ACCEPT_AT) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    seen = stash(_examine(_narrow(docs, id_col, text_col)), "pii")
    good = sorted(p for p, s in _learn(seen).items() if s >= accept_at)
    on = F.filter(F.arrays_zip("more", "patterns"),
                  lambda c: c["patterns"].isin(good) if good else F.lit(False))
    added = F.array_join(F.transform(on, lambda c: c["more"]), ",")
    return seen.select("doc_id", *(f"n_{k}" for k in BASE_KINDS), F.sha2(F.col("base"), 256).alias("base_sha256"),
                       F.concat_ws(",", F.nullif("base", F.lit("")), F.nullif(added, F.lit(""))).alias("spans"))


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", accept_at: float = ACCEPT_AT) -> DataFrame:
    """``docs`` with every span of its text replaced by its kind in brackets. Patterns are
    learned over all of ``docs`` in one pass, spans are replaced in a second."""
    scores = _learn(_examine(_narrow(docs, id_col, text_col)))
    good = {p for p, s in scores.items() if s >= accept_at}
    names, at = docs.columns, docs.columns.index(text_col)

    def clean(text):
        if not text:
            return text
        spans = base_spans(text)
        spans += [(k, s, e) for k, s, e, p in _voted(text, spans) if p in good]
        out, done = [], 0
        for s, e, k in sorted((s, e, k) for k, s, e in spans):
            if s >= done:
                out += [text[done:s], f"[{k.upper()}]"]
            done = max(done, e)
        return "".join([*out, text[done:]]) if spans else text

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, text_col):
                new = pa.array([clean(t) for t in part.column(at).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*(part.columns[:at]), new, *(part.columns[at + 1:])], names)

    return map_text(docs, run, docs.schema)
