"""Composite plans: the training workflow and the driver's query set."""

from .workflow import (ScoringPipeline, TrainedWorkflow, load_workflow, save_workflow, score_model, train_ensemble,
                       train_workflow)

__all__ = ["ScoringPipeline", "TrainedWorkflow", "load_workflow", "save_workflow", "score_model", "train_ensemble",
           "train_workflow"]
