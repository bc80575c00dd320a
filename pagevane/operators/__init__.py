"""DataFrame -> DataFrame operators."""

from pagevane.operators.boilerplate import drop_site_blocks
from pagevane.operators.cells import CellModel, CellSearch, append_cells, train_cells
from pagevane.operators.embed import (
    HashingEncoder,
    dim_check,
    document_embeddings,
    embed_documents,
    embed_segments,
    encode_segments,
    hash_encode,
    mean_pool,
)
from pagevane.operators.extract import compute_once, extract_pages, page_key, with_headings
from pagevane.operators.fulltext import StoredSearch, search_postings
from pagevane.operators.index import index_batches, index_rows
from pagevane.operators.langmodel import (
    LanguageModel,
    language_scores,
    train_language_model,
    with_modelled_language,
)
from pagevane.operators.language import (
    classify_ngrams,
    corpus_profile,
    language_filter,
    train_ngram_profiles,
    with_language,
)
from pagevane.operators.messages import decode_messages, encode_messages, require_fields
from pagevane.operators.metrics import (
    metric_rollup,
    metric_total,
    route_metrics,
    running_total,
    stamp,
)
from pagevane.operators.nearest import (
    knn_exact,
    knn_lsh,
    knn_single,
    lsh_index,
    lsh_model,
)
from pagevane.operators.quantiles import merge_rollup, rank_of, sketch_rollup, with_quantiles
from pagevane.operators.search import bm25_search, keyword_lookup, postings
from pagevane.operators.segments import explode_segments, segment_counts, with_segments

__all__ = [
    "drop_site_blocks",
    "CellModel",
    "CellSearch",
    "HashingEncoder",
    "LanguageModel",
    "StoredSearch",
    "append_cells",
    "bm25_search",
    "classify_ngrams",
    "compute_once",
    "corpus_profile",
    "decode_messages",
    "dim_check",
    "document_embeddings",
    "embed_documents",
    "embed_segments",
    "encode_messages",
    "encode_segments",
    "explode_segments",
    "extract_pages",
    "hash_encode",
    "index_batches",
    "index_rows",
    "keyword_lookup",
    "knn_exact",
    "knn_lsh",
    "knn_single",
    "language_filter",
    "language_scores",
    "lsh_index",
    "lsh_model",
    "mean_pool",
    "merge_rollup",
    "metric_rollup",
    "metric_total",
    "page_key",
    "postings",
    "rank_of",
    "require_fields",
    "route_metrics",
    "running_total",
    "search_postings",
    "segment_counts",
    "sketch_rollup",
    "stamp",
    "train_cells",
    "train_language_model",
    "train_ngram_profiles",
    "with_headings",
    "with_language",
    "with_modelled_language",
    "with_quantiles",
    "with_segments",
]
