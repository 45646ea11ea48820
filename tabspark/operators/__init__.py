"""DataFrame-in, DataFrame-out operators."""

from .batches import assign_batches, batch_count, batch_counts, batch_profile, group_batches
from .categories import category_index, index_categories
from .columns import (column_dtype, columns_of_type, drop_columns, dtype_profile, dtype_table, feature_columns, modify_columns,
                      non_numeric_columns, numeric_columns, rename_columns, select_numeric)
from .encode import DEFAULT_STRING_MAP, encode_booleans, encode_strings, prepare, string_code, unknown_counts
from .metrics import (batch_metrics, classification_metrics, confusion_matrix, custom_metric, log_loss,
                      regression_metrics, score)
from .mlp import MLPModel, MLPSpec, OptimizerSpec, init_model
from .scoring import ensemble_predict, predict
from .profile import (class_balance, class_weights, collect_class_weights, correlation_matrix, describe_table,
                      drop_nulls, fill_nulls, histogram, label_profile, null_profile, parallel_coordinates,
                      row_count, scatter_pairs, size_estimate, summary_table, timed_count, unique_values)
from .ranking import global_rank
from .sampling import hash_sample, hash_side, hash_split, head_rows, random_sample, stratified_sample, train_val_split
from .scale import collect_stats, minmax_scale, scaling_stats, standardize
from .train import FitResult, evaluate, fit, history_frame, loss_curve, sync_gradient, weight_column

__all__ = [name for name in dir() if not name.startswith("_")]
