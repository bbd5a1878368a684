"""Errors raised by the jobs; the operators themselves stay lazy."""


class NewstapeError(Exception):
    """Base class."""


class LoadError(NewstapeError):
    """A source is missing, unreadable, or lacks required columns."""


class FeatureError(NewstapeError):
    """No feature row can be produced."""


class LabelError(NewstapeError):
    """No labelled row can be produced."""


class DataPreparationError(NewstapeError):
    """A dataset cannot be turned into a feature matrix."""


class ModelNotFoundError(NewstapeError):
    """No model is stored at the given path."""
