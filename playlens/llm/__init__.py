"""Operators for preparing language-model training data on Spark.

Nothing outside this folder imports it, apart from the guarded entry module
and ``corpus_pipeline.py`` at the top.
"""
