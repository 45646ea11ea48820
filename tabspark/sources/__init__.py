"""Readers and writers: tables, models, histories, run folders."""

from .runs import load_history, load_model, model_frame, run_dir, save_history, save_model, save_run
from .tables import get_table, load_table, read_parquet_table, to_pandas_small

__all__ = [
    "load_history", "load_model", "model_frame", "run_dir", "save_history", "save_model", "save_run",
    "get_table", "load_table", "read_parquet_table", "to_pandas_small",
]
