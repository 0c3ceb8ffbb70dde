"""Configurations of an experiment, and the experiment runs built from the operators."""
