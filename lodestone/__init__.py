"""lodestone: batch text, number, vector and model operators on Spark DataFrames.

Every public operator takes DataFrames (plus plain parameters) and returns a
lazy DataFrame (or a small result object); Catalyst plans the work. See
README.md for the catalogue.
"""

from lodestone.session import checkpoint_dir, get_session

_EXPORTS = {
    "word_count": "lodestone.operators.text",
    "word_search": "lodestone.operators.text",
    "odd_primes_upto": "lodestone.operators.primes",
    "prime_filter": "lodestone.operators.primes",
    "top_primes": "lodestone.operators.primes",
    "parse_integers": "lodestone.operators.primes",
    "profile": "lodestone.operators.profile",
    "count_by": "lodestone.operators.profile",
    "order_statistics": "lodestone.operators.ranks",
    "percent_rank_filter": "lodestone.operators.ranks",
    "k_medoids": "lodestone.operators.kmedoids",
    "sample_rows": "lodestone.operators.sampling",
    "pick_rows": "lodestone.operators.sampling",
    "run_study": "lodestone.operators.model",
    "read_lines": "lodestone.sources.files",
    "read_json_documents": "lodestone.sources.files",
    "read_csv_ddl": "lodestone.sources.files",
    "read_vectors_csv": "lodestone.sources.files",
    "write_csv": "lodestone.sources.files",
    "write_lines": "lodestone.sources.files",
    "write_tsv": "lodestone.sources.files",
}

__all__ = ["get_session", "checkpoint_dir", *_EXPORTS]


def __getattr__(name):
    """Operators load on first use (keeps ``import lodestone`` light)."""
    if name in _EXPORTS:
        import importlib
        return getattr(importlib.import_module(_EXPORTS[name]), name)
    raise AttributeError(name)
