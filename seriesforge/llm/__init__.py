"""Training-data preparation operators: DataFrame in, DataFrame out.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
