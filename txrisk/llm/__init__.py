"""Training-data operators (HTML extraction, dedup, decontamination, scoring, packing).

Self-contained: nothing outside ``txrisk.llm`` and ``corpus_pipeline.py`` imports it.
Each operator is a Spark job; numpy and Arrow run inside tasks only.
"""
