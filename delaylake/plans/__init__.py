"""Stages from raw files to models, composed of the operators."""
