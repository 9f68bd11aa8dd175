"""Operators on training data: texts, token ids and embeddings."""
