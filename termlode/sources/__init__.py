from termlode.sources.corpus import (
    clean_documents,
    corpus_from_table,
    in_collection,
    read_corpus,
    spread,
    write_corpus,
)
from termlode.sources.store import (
    delete_scratch,
    load_clean,
    load_index,
    load_norms,
    load_vocabulary,
    load_words,
    scratch_path,
    stored_collections,
    warm,
    write_beside,
    write_clean,
    write_index,
)

__all__ = [
    "clean_documents",
    "corpus_from_table",
    "delete_scratch",
    "in_collection",
    "load_clean",
    "load_index",
    "load_norms",
    "load_vocabulary",
    "load_words",
    "read_corpus",
    "scratch_path",
    "spread",
    "stored_collections",
    "warm",
    "write_beside",
    "write_clean",
    "write_corpus",
    "write_index",
]
