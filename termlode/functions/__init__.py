from termlode.functions.text import clean, doc_name, strip_prefix, word_array, word_counts
from termlode.functions.weights import idf, tf

__all__ = ["clean", "doc_name", "idf", "strip_prefix", "tf", "word_array", "word_counts"]
