"""Training-data operators: near-duplicates, PII, language, chat, archives,
tokens, packing, toxicity, embeddings and quality.  Nothing else in the
library imports this subpackage."""
