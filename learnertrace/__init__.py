"""Learner-behaviour features and stop-out modelling on Spark DataFrames."""

from learnertrace.sources.course import Course

__all__ = ["Course"]
