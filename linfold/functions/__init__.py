from linfold.functions.exprs import key_hash, row_key, safe_ratio

__all__ = ["key_hash", "row_key", "safe_ratio"]
