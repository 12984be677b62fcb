"""Training-data operators: near-duplicates, language, secrets, language models, web pages, mixtures."""
