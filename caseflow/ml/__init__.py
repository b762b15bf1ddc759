"""Spark ML layer: features, classifiers and scoring metrics."""

from .evaluate import accuracy_metrics, attempts_histogram, attempts_needed, prediction_attempts
from .features import (assemble, index_categories, key_hash, one_hot, random_split,
                       split_by_key)
from .models import (KINDS, evaluate_labels, evaluate_model, feature_roles, model_frame, score,
                     train_model)

__all__ = ["accuracy_metrics", "attempts_histogram", "attempts_needed", "prediction_attempts",
           "assemble", "index_categories", "key_hash", "one_hot", "random_split", "split_by_key",
           "KINDS", "evaluate_labels", "evaluate_model", "feature_roles", "model_frame", "score",
           "train_model"]
