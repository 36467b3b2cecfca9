"""Operators for training-data pipelines: tokens, mixing, neighbours, privacy, quality, language, chat, duplicates, hosts."""
