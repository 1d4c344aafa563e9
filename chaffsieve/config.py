"""Every threshold of the audit in one immutable object."""

from __future__ import annotations

from dataclasses import dataclass

# Spark's English stop-word list, as shipped with
# pyspark.ml.feature.StopWordsRemover.  Stated as text so that the SQL checks
# and the jobs use one list.
ENGLISH_STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he
    him his himself she her hers herself it its itself they them their theirs
    themselves what which who whom this that these those am is are was were be
    been being have has had having do does did doing a an the and but if or
    because as until while of at by for with about against between into through
    during before after above below to from up down in out on off over under
    again further then once here there when where why how all any both each few
    more most other some such no nor not only own same so than too very s t can
    will just don should now i'll you'll he'll she'll we'll they'll i'd you'd
    he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've
    you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't
    doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot
    could here's how's let's ought that's there's what's when's where's who's
    why's would
    """.split()
)

# Thresholds of the audit rules.
TERMINAL_PUNCT = (".", "!", "?", '"', ")", ":", "`")
CODE_MARKERS = ("```", "def ", "import ", "<html", "SELECT ", "{", ";")


@dataclass(frozen=True)
class AuditConfig:
    """Thresholds (they shape results) and sizing limits (they never do)."""

    # clustering
    k_min: int = 5
    k_max: int = 12
    seed: int = 42
    restarts: int = 10
    kmeans_max_iter: int = 300
    # Rows a fit may use; None fits on all.  Only ever set it on purpose.
    fit_sample: int | None = None
    # A fit ends when no centre moves farther.
    kmeans_tolerance: float = 1e-4
    # Seeds are drawn from about seed_factor * k points in each of seed_rounds rounds.
    seed_factor: int = 4
    seed_rounds: int = 5
    # Vectors wider than this are folded to fold_dims coordinates before a fit.
    fold_above: int = 4096
    fold_dims: int = 512
    embed_batch: int = 64
    # Buckets of hashed words.  Different words may share one; more buckets, fewer do.
    embed_dims: int = 1 << 16
    exemplars: int = 10
    exemplar_chars: int = 110

    # near duplicates
    duplicate_threshold: float = 0.90
    # Terms kept per group; None keeps all.
    max_features: int | None = 20_000
    min_df: int = 2
    stop_words: tuple[str, ...] = ENGLISH_STOP_WORDS

    # quality flags
    min_output_words: int = 15
    empty_output_words: int = 3
    repeat_ngram_n: int = 5
    repeat_ngram_min_count: int = 3
    terminal_punct: tuple[str, ...] = TERMINAL_PUNCT
    code_markers: tuple[str, ...] = CODE_MARKERS
    code_marker_min_hits: int = 2
    flag_penalty: int = 20
    low_adequacy_cutoff: int = 60

    # reports
    worst_per_cluster: int = 20
    review_rows: int = 20
    sample_csv_rows: int = 500
    load_batch: int = 1_000
    load_connections: int = 8

    # sizing limits: plans change beyond them, results do not
    broadcast_rows: int = 500_000
    broadcast_bytes: int = 64 << 20  # as stored; some times that in memory
    centroid_bytes: int = 64 << 20
    hot_rows: int = 100_000
    topk_salts: int = 64
    # Rows of a block of near-duplicate candidates, at least; a block has up to eight times as many.
    posting_block: int = 4_096
    # Accepted, but without effect: near duplicates need no signatures any more.
    signature_stop: int = 64
    signature_depth: int = 4
    inline_terms: int = 64
