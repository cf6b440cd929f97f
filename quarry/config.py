"""Parameters and fixed values.

Values marked FIXED must equal the behaviour being reproduced; everything
else is a default that callers may override.
"""

# --- FIXED values ---------------------------------------------------------
# Image extensions and all accepted extensions of the folder ingest.
IMAGE_EXTS = (".png", ".jpg", ".jpeg", ".tiff", ".tif", ".bmp")
VALID_EXTS = (".pdf", ".docx") + IMAGE_EXTS
# Name of the archive folder that the folder walk skips.
ARCHIVE_DIR = "Processado"
# Version string stored in every extracted record.
RECORD_VERSION = "2.16.105"
# Embedding dimensions with a chunk-table partition of their own.
SUPPORTED_DIMS = (384, 768, 1024, 1536)
# Text-rank weights for D, C, B, A.
RANK_WEIGHTS = {"D": 0.1, "C": 0.2, "B": 0.4, "A": 1.0}
# Latency histogram bounds (seconds), +Inf is added on top.
LATENCY_BUCKETS = (0.01, 0.05, 0.1, 0.5, 1.0, 2.5, 5.0, 10.0, 30.0, 60.0)
# Metadata keys with an index of their own (copied to real columns).
HOT_META_KEYS = ("title", "author", "type", "__parent")
# Trigram similarity threshold.
TRIGRAM_THRESHOLD = 0.08
# Search defaults: k, pool multiplier, weights, minimum scores.
MATCH_COUNT = 5
POOL_MULTIPLIER = 10
WEIGHT_VEC = 0.6
WEIGHT_LEX = 0.4
HYBRID_MIN_SCORE = 0.1
PRECISE_MIN_COS_SIM = 0.80
PRECISE_MIN_SCORE = 0.50
# Minimum extracted text length and minimum paragraph length.
OCR_THRESHOLD = 100
MIN_PARAGRAPH_CHARS = 50
# Query-expansion breadth (synsets and lemmas per token).
EXPANSION_TOP_K = 5
# Approximate index parameters.
IVF_LISTS = 400
IVF_PROBES = 50
# --------------------------------------------------------------------------

# Defaults of our own.
PARAGRAPH_SEPARATOR = "\n\n"
CHUNK_JOINER = "\n\n"
MAX_TOKENS = 256
WINDOW_OVERLAP_RATIO = 0.25
