from cohorta.functions.scalar import (
    age_years, log1p_columns, positive_probability, threshold_score, vector_has_nan,
)
from cohorta.functions.uniform import choice_index, hash_normal, hash_uniform

__all__ = [
    "age_years", "choice_index", "hash_normal", "hash_uniform", "log1p_columns",
    "positive_probability", "threshold_score", "vector_has_nan",
]
