"""Training-data operators: chat formatting, language identification, deduplication, language-model
scoring, quality rules, extraction, licence scans, decontamination and source mixing.

Nothing outside this folder, ``tests/llm/`` and ``corpus_pipeline.py`` imports it.
"""
