"""Training-data operators: search, chat rendering, decontamination, classifiers, tokenizers, extraction, deduplication."""
