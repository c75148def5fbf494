from termlode.operators.postings import doc_vectors, inverted_index, term_map
from termlode.operators.vectors import cosine, doc_norms, query_vector
from termlode.operators.vocabulary import collection_sizes, distinct_words, doc_freq, vocabulary
from termlode.operators.words import doc_lengths, term_counts, tokens

__all__ = [
    "collection_sizes",
    "cosine",
    "distinct_words",
    "doc_freq",
    "doc_lengths",
    "doc_norms",
    "doc_vectors",
    "inverted_index",
    "query_vector",
    "term_counts",
    "term_map",
    "tokens",
    "vocabulary",
]
