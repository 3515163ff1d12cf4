"""Parameters and fixed values.

Every operator takes its knobs as explicit arguments; the defaults live here.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# These must equal the behaviour being re-implemented, so they
# are stated here plainly and in one place.
# ---------------------------------------------------------------------------
INGEST_DAYS = 7                    # recency window for posts, in days
MIN_SCORE = 3                      # inclusive score floor
CHUNK_SIZE_TOKENS = 600            # chunk size in "tokens" ...
CHUNK_OVERLAP_TOKENS = 80          # ... and overlap; one token = 4 characters
CHARS_PER_TOKEN = 4
TOPK_RETRIEVE = 200                # vector candidates per query
TOPN_RERANK = 25                   # reranked results kept per query
MAX_COMMENTS_PER_POST = 500        # slim comment cap per post (pre-order)
PAGES_PER_SUBREDDIT = 5
SAVE_FORMAT = "parquet"
MAX_RETRIES = 3
STALL_TIMEOUT_MINUTES = 30
CLEANUP_DAYS = 7
MAX_DISCOVERY_URLS = 100_000
POST_DETAIL_PRIORITY = 5
FIRST_PAGE_PRIORITY = 10           # listing page i (0-based) gets priority 10 - i
POSTS_PER_PAGE = 100
REQUEST_DELAY_SEC = 1.0
SORT_TYPES = ("new", "hot", "top")

PERMALINK_BASE = "https://reddit.com"
SITE_BASE = "https://www.reddit.com"
DELETED_AUTHOR = "[deleted]"
DELETED_BODIES = ("[deleted]", "[removed]")

# Job states and types.
JOB_PENDING = "pending"
JOB_IN_PROGRESS = "in_progress"
JOB_COMPLETED = "completed"
JOB_FAILED = "failed"
JOB_RETRY = "retry"
JOB_STATUSES = (JOB_PENDING, JOB_IN_PROGRESS, JOB_COMPLETED, JOB_FAILED, JOB_RETRY)
JOB_TYPES = ("subreddit_page", "post_detail", "comment_thread")

# Name / id validity patterns.
SUBREDDIT_NAME_PATTERN = r"\A[a-zA-Z0-9_]{3,21}\z"
POST_ID_PATTERN = r"\A[a-z0-9]{3,10}\z"

# Prompt templates (fixed text; {placeholders} are filled per query row).
SYSTEM_IDEAS = "You are a pragmatic product researcher."
PAIN_MINING_SYSTEM = (
    "You are an analyst extracting recurring user pains and unmet needs from Reddit snippets. "
    "Prefer concrete problems over vague complaints."
)
PAIN_MINING_USER = (
    "Given these snippets about {topic} (subreddits: {subs}, period: {period}), list the top pains as\n"
    "(pain -> why it's painful -> who feels it -> 1-2 short proof quotes with permalinks).\n"
    "Rules:\n1) Use only the provided snippets.\n2) Merge near-duplicates.\n"
    "3) Output 5-10 pains ranked by severity x frequency.\n\n"
    "Snippets:\n{snippets}"
)
IDEA_GEN_USER = (
    "Propose {n} Micro-SaaS ideas that directly solve the top pains. For each idea:\n"
    "- One-line value prop\n- Core feature set (must-have only)\n- MVP in 1 week (exact steps)\n"
    "- Who pays and why now\n- Moat angle (data, workflow lock-in, distribution)\n- Risks & obvious killers\n"
    "Use only the information consistent with the snippets below; avoid generic platitudes.\n\n"
    "Snippets:\n{snippets}"
)
SCORING_USER = (
    "Score each idea (0-5) on: Pain severity, Urgency, Frequency, Willingness-to-pay, Ease of building, "
    "Distribution advantage, Competitive crowding (reverse-scored). Return a table sorted by "
    "(Pain x WTP x Urgency) - Competition with one-sentence justification per score.\n\n"
    "Ideas:\n{ideas}"
)
DEFAULT_PERIOD = "last 14 days"
DEFAULT_SUBREDDITS = ("startups",)
DEFAULT_IDEAS = 5

# Characters Python's str.strip() removes (the Unicode White_Space set plus the
# ASCII separators 0x1c-0x1f): code points, and the same set as a string.
STRIP_CODEPOINTS = (
    list(range(0x09, 0x0E)) + list(range(0x1C, 0x21)) + [0x85, 0xA0, 0x1680]
    + list(range(0x2000, 0x200B)) + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
STRIP_CHARS = "".join(chr(c) for c in STRIP_CODEPOINTS)

# Hashed-term embedding: token = maximal run of letters/digits of lower(text);
# bucket = first 7 hex digits of md5(token) mod dims.
TOKEN_SPLIT = "[^\\p{L}\\p{N}]+"
HASH_DIMS = 256

# BM25 (Robertson & Zaragoza 2009) parameters.
BM25_K1 = 1.2
BM25_B = 0.75


@dataclass(frozen=True)
class ChunkSpec:
    size_tokens: int = CHUNK_SIZE_TOKENS
    overlap_tokens: int = CHUNK_OVERLAP_TOKENS

    @property
    def size(self) -> int:
        return self.size_tokens * CHARS_PER_TOKEN

    @property
    def step(self) -> int:
        return max(1, self.size - self.overlap_tokens * CHARS_PER_TOKEN)
