"""Training-data operators: tokenising, near-duplicates, classifiers, PII, mixing, chat.

Nothing outside this folder imports it (only ``__spark_entry__.py``, guarded).
"""
