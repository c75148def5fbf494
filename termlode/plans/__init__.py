from termlode.plans.batch import reject_invalid, search_batch
from termlode.plans.bounded import Impacts, load_impacts, search_top, write_impacts
from termlode.plans.growing import (
    add_documents,
    additions,
    documents_added,
    growing_norms,
    growing_vocabulary,
    load_growing,
)
from termlode.plans.index import build_index, index_corpus, store_vocabulary, weighted_counts
from termlode.plans.lists import load_lists, load_postings, write_postings
from termlode.plans.search import (
    query_matches,
    query_table,
    query_terms,
    query_words,
    search,
    search_documents,
    unmatched_terms,
)

__all__ = [
    "Impacts",
    "add_documents",
    "additions",
    "build_index",
    "documents_added",
    "growing_norms",
    "growing_vocabulary",
    "index_corpus",
    "load_growing",
    "load_impacts",
    "load_lists",
    "load_postings",
    "query_matches",
    "query_table",
    "query_terms",
    "query_words",
    "reject_invalid",
    "search",
    "search_batch",
    "search_documents",
    "search_top",
    "store_vocabulary",
    "unmatched_terms",
    "weighted_counts",
    "write_impacts",
    "write_postings",
]
