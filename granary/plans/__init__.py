"""Whole stages built from the operators: silver, gold, modelling, analysis."""
