"""Column functions and checks that the operators share."""

from .checks import PanelError, require, require_columns, violations
from .columns import distance_bin, finite, half_even_index, key_values, maf, percentile, ratio, recode, squared_correlation
from .random import P, with_uniforms

__all__ = ["P", "PanelError", "distance_bin", "finite", "half_even_index", "key_values", "maf", "percentile", "ratio", "recode", "require", "require_columns", "squared_correlation", "violations", "with_uniforms"]
