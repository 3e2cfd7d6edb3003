"""Documents, stored responses and stopword lists."""

from morphloom.sources.texts import documents, documents_from_strings, spread_small
from morphloom.sources.stored import responses
from morphloom.sources.wordlists import stopwords

__all__ = ["documents", "documents_from_strings", "responses", "spread_small", "stopwords"]
