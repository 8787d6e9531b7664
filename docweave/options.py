"""Job options: the run parameters of a refresh or retrieval job."""

from __future__ import annotations

from dataclasses import dataclass, replace

# Fixed values that must equal the reference for equal results.
K_NEIGHBOURS = 20          # neighbours per question when count = 0
LIBRARY_DEFAULT_K = 4      # default k of the single-vector search call
TOP_DOCS = 10              # documents kept after the second ranking stage
MAX_PROMPT_TOKENS = 12000  # token budget of the documents part of a prompt
UPDATER_VERSION = "1.0"    # version of the updater written to tracking rows
NO_DOCS_TEXT = "No docs found for the question"
HEADER_KEYS = ("Header1", "Header2", "Header3")
IVF_LISTS = 100            # coarse lists of the list index
HNSW_M = 16                # graph index degree (links of a node; also the LSH band count)

RELEASE_MODE = "release"
REPOSITORY_MODE = "repository"


@dataclass(frozen=True)
class JobOptions:
    """All knobs of a refresh / retrieval job (environment values of the reference)."""

    web_path: str = "https://docs.example.org/"
    doc_path: str = "en/"
    main_dir: str = "docs/"
    ignore_files: tuple[str, ...] = ("source/d1",)
    ignore_rel_paths: tuple[str, ...] = ("out-prod/docs/p3/index.html",)
    asset_name: str = "large "
    product_name: str = "Docsite"
    batch_size: int = 100
    processing_mode: str = RELEASE_MODE
    updater_version: str = UPDATER_VERSION
    k_neighbours: int = K_NEIGHBOURS
    top_docs: int = TOP_DOCS
    max_prompt_tokens: int = MAX_PROMPT_TOKENS
    embed_dim: int = 64
    metric: str = "L2"
    split_on_h3: bool = False
    ivf_lists: int = IVF_LISTS
    ivf_nprobe: int = 8
    lsh_bands: int = HNSW_M
    lsh_bits: int = 4  # per band, at least; more as the table grows
    lsh_bucket_rows: int = 64  # rows an average bucket holds
    # with more than lsh_bits bits: chance that a neighbour of this centred cosine is
    # among the candidates, and near buckets searched per band for it at most
    lsh_cosine: float = 0.8
    lsh_hit_rate: float = 0.97
    lsh_probes: int = 1024
    # neighbour graph: neighbours a node keeps, bands of the first search, rounds of local
    # joins at most, share of links a round must improve to go on
    graph_degree: int = HNSW_M
    graph_bands: int = 4
    graph_rounds: int = 8
    graph_least_gain: float = 0.02
    # search: nodes a question keeps, nodes it opens a round, nodes all questions start from,
    # nodes beyond k that are scored again
    graph_beam: int = 128
    graph_width: int = 32
    graph_entries: int = 256
    graph_spare: int = 8
    # bytes of vectors (as doubles) in one block of questions or chunks
    knn_block_bytes: int = 64 << 20
    # digest tree of a snapshot: parts (read or skipped whole) and leaves of a part
    digest_parts: int = 256
    digest_leaves: int = 4096
    chunk_buckets: int = 64
    bucket_rows: int = 2_000_000  # rows a bucket of the chunk table should hold

    @property
    def scrub_phrase(self) -> str:
        return f"in {self.product_name}"

    def with_(self, **kw) -> "JobOptions":
        return replace(self, **kw)


DEFAULT = JobOptions()
