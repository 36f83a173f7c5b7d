"""Training-data operators: ten dealt operators over documents, embeddings and conversations.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it. Every operator takes a
DataFrame plus column names, selects only the columns it needs (so extra columns with clashing
names are harmless) and returns a DataFrame.
"""
