"""Training-data operators: tokens, deduplication, decontamination, labelling and chat formatting."""
