"""Training-data operators: quality, search, chat formatting, deduplication, packing,
language, URL, mixing, toxicity, token counts, collocations and whitening. Nothing else in the library imports this package."""
