"""Fixed values.

Every constant here must hold exactly this value for results to come out
right: vocabularies, limits, message formats and prompts that other systems
read.  Nothing in this module is logic.
"""

# Document types and the file suffix each one requires.
DOCUMENT_TYPES = ["pdf", "docx", "txt"]
SUFFIX_TO_TYPE = {".pdf": "pdf", ".docx": "docx", ".txt": "txt"}

# Document categories.
CATEGORIES = ["policy", "course_catalog", "handbook", "scholarship", "general"]
DEFAULT_CATEGORY = "general"

# Keyword -> category, tried in this order.
CATEGORY_KEYWORDS = [
    ("graduation", "policy"),
    ("withdrawal", "policy"),
    ("attendance", "policy"),
    ("scholarship", "scholarship"),
    ("cs_program", "course_catalog"),
]

# Category -> uploader account.
UPLOADER_BY_CATEGORY = {
    "policy": "registrar_office_bot",
    "scholarship": "financial_aid_office_bot",
    "course_catalog": "cs_department_admin",
    "general": "campus_portal_uploader",
}
DEFAULT_UPLOADER = "campus_portal_uploader"

# Fixed value: 50 MB, inclusive.
MAX_FILE_SIZE_BYTES = 52428800

# Wording of contract rejections (printf style).
MSG_MISSING = "Field required"
MSG_EXTRA = "Extra inputs are not permitted"
MSG_STRING = "Input should be a valid string"
MSG_INT = "Input should be a valid integer"
MSG_INT_TEXT = "Input should be a valid integer, unable to parse string as an integer"
MSG_INT_FRACTION = "Input should be a valid integer, got a number with a fractional part"
MSG_INT_SIZE = "Unable to parse input string as an integer, exceeded maximum size"
MSG_UUID_TYPE = "UUID input should be a string, bytes or UUID object"
MSG_UUID_CHARACTER = "Input should be a valid UUID, invalid character: found `%s` at %d"
MSG_UUID_LENGTH = "Input should be a valid UUID, invalid length: found %d"
MSG_UUID_GROUPS = "Input should be a valid UUID, invalid group count: expected 5, found %d"
MSG_UUID_GROUP_LENGTH = "Input should be a valid UUID, invalid group length in group %d: expected %d, found %d"
MSG_DATETIME_TYPE = "Input should be a valid datetime"
MSG_DATETIME_SHORT = "Input should be a valid datetime or date, input is too short"
MSG_DATETIME_MONTH = "Input should be a valid datetime or date, month value is outside expected range of 1-12"
MSG_DATETIME_DAY = "Input should be a valid datetime or date, day value is outside expected range"
MSG_DATETIME_EXTRA = "Input should be a valid datetime or date, unexpected extra characters at the end of the input"
MSG_DATETIME_RANGE = "Input should be a valid datetime, dates after 9999 are not supported as unix timestamps"
MSG_DATETIME_YEAR = "Input should be a valid datetime, year 0 is out of range"
MSG_BLANK = "Value error, %s is required — cannot be blank"
MSG_NOT_BARE = "Value error, %s '%s' must be a bare filename, not a path"
MSG_EMPTY_UPLOAD = "Value error, file_size_bytes must be > 0 (got %s — empty upload)"
MSG_OVERSIZED = "Value error, file_size_bytes %s exceeds max allowed %d (50 MB) — reject oversized upload"
MSG_SUFFIX_UNSUPPORTED = "Value error, file_name '%s' has unsupported extension '%s' — only %s are accepted"
MSG_SUFFIX_MISMATCH = "Value error, declared file_type '%s' does not match the actual extension '%s' (expected '%s')"
MSG_FILE_MISSING = "Value error, file_path '%s' does not exist on disk"

# Where a rejection message is cut to form its reason key.
REASON_CUTS = [" (", " —"]

# Retrieval depth and scoring constants.
SENTENCES_PER_CHUNK = 4
OVERLAP_SENTENCES = 1
HYBRID_TOP_K = 6
RERANK_TOP_K = 3
RRF_K = 60
BM25_K1 = 1.5
BM25_B = 0.75
BM25_EPSILON = 0.25

# The answer given when the context holds none, and the prompt.
REFUSAL_TEXT = "I don't know based on the available university documents."
SYSTEM_PROMPT = (
    "You are a university knowledge assistant. Answer the student's question "
    "using ONLY the information in the CONTEXT below — never use outside "
    "knowledge, and never guess. Every factual claim in your answer must be "
    "traceable to one of the numbered sources. Cite the source you used with "
    "the format [Source N] after the relevant sentence.\n\n"
    "If the CONTEXT does not contain the answer, respond with EXACTLY this "
    "sentence and nothing else: "
    "\"I don't know based on the available university documents.\""
)
SOURCE_HEADER = "[Source %d: %s]\n%s"
USER_PROMPT = "CONTEXT:\n%s\n\nQUESTION: %s"

# States of a lineage event.
LINEAGE_START = "START"
LINEAGE_COMPLETE = "COMPLETE"
LINEAGE_FAIL = "FAIL"

# Fixed value: the smallest number of accepted events that lets a run go on.
MIN_ACCEPTED = 1
