"""Training-data operators: token files, deduplication, classifiers, privacy,
decontamination, tokenisation, vector search and URL rules."""
