"""Column expressions shared by the operators (all JVM-side built-ins)."""

from curata.functions.keyed import hash_uniform, hash_uniform_sql
from curata.functions.exprs import is_missing, safe_div, existing

__all__ = ["hash_uniform", "hash_uniform_sql", "is_missing", "safe_div", "existing"]
