"""Operators that prepare text, embeddings and crawled pages for model training.

Nothing outside this folder imports it; ``queries.py`` holds the registered queries.
"""
