"""Column expressions: deterministic hashes and numeric helpers."""

from .hashing import TWO_POW_32, h32, hash_below, int_h32, order_key, other_h32, unit_hash
from .numeric import EPS, bce, clip01, is_numeric, predicted_class, relu, round6, safe_ratio, sigmoid

__all__ = [
    "TWO_POW_32", "h32", "hash_below", "int_h32", "order_key", "other_h32", "unit_hash",
    "EPS", "bce", "clip01", "is_numeric", "predicted_class", "relu", "round6", "safe_ratio", "sigmoid",
]
