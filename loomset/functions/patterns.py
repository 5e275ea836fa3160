"""Fixed patterns and word lists.

All entries below are fixed values: results depend on them literally. The
classes are spelled out with Unicode categories so that Java and RE2 read them
alike and both agree with Unicode-aware regular expressions.
"""

# whitespace: one character, a run of it, and a run of anything else
WS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
WS_RUN = WS + "+"
WORD_RUN = r"[^\s\x0b\x1c-\x1f\x85\p{Z}]+"
# what squeezing must change: runs of two or more, or a single one that is no plain space
WS_LOOSE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]{2,}|[\t\n\f\r\x0b\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
# the same characters one by one, for trimming without a regular expression
WS_CHARS = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
LINE_BREAKS = "\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
# one word character, a word token
W = r"[\p{L}\p{N}_]"
TOKEN = W + "+"
SENTENCE_END = r"[.!?]+"

# personal data
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
PHONES = (
    r"\b\d{3}[-.]?\d{3}[-.]?\d{4}\b",
    r"\(\d{3}\)\s*\d{3}[-.]?\d{4}",
    r"\+1[-.\s]?\d{3}[-.\s]?\d{3}[-.\s]?\d{4}",
)
SSN = r"\b\d{3}-?\d{2}-?\d{4}\b"

# dates that redaction must leave alone
DATES = (
    r"\b\d{1,2}[/-]\d{1,2}[/-]\d{2,4}\b",
    r"\b\d{4}[/-]\d{1,2}[/-]\d{1,2}\b",
    r"\b(?i:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[A-Za-z]*\s+\d{1,2},?\s+\d{4}\b",
)
ANY_DATE = "|".join(DATES)

# money
MONEY = (
    r"\$\s*(\d{1,3}(?:,\d{3})*(?:\.\d{2})?)\b",
    r"(\d{1,3}(?:,\d{3})*(?:\.\d{2})?)\s*(?i:dollars?)\b",
    r"USD\s*(\d{1,3}(?:,\d{3})*(?:\.\d{2})?)\b",
)

LIST_LINE = r"(?m)^\s*[•\-\*\d+\.]\s+"
ENGLISH_HINTS = ("the", "and", "or", "but", "in", "on", "at", "to", "for", "of", "with", "by")

# sections
HEADER_MARKS = (r"(?m)^\s*[A-Z\s]{10,}\s*$", r"(?m)^\s*\d{1,2}[/-]\d{1,2}[/-]\d{2,4}", r"(?m)^\s*Page\s+\d+")
FOOTER_MARKS = (r"(?i)Page\s+\d+\s*of\s*\d+", r"(?i)©\s*\d{4}", r"(?i)Confidential|Proprietary")

# clause breaks, in the order they are applied
CLAUSE_BREAKS = (r";\s+", r":\s+", r"—\s+", r"--\s+", r",\s+and\s+", r",\s+but\s+", r",\s+or\s+")

# style
BULLET_LINES = (r"(?m)^\s*[-•*]\s+", r"(?m)^\s*\d+\.\s+", r"(?m)^\s*[a-z]\)\s+")
FORMAL_WORDS = (
    "hereby", "whereas", "pursuant", "aforementioned", "shall",
    "agreement", "party", "obligations", "terms and conditions",
)
CASUAL_WORDS = (
    "you'll", "we'll", "can't", "won't", "let's", "hey", "awesome",
    "cool", "super", "amazing", "love", "excited",
)
SUBJECT_WORDS = ("the", "a", "an", "this", "that", "i", "you", "we", "they")
PASSIVE = r"\b(?:is|are|was|were|being|been)\s+[\p{L}\p{N}_]+ed\b"

# fragments that name something specific are dropped
FRAGMENT_SKIPS = (
    r"\b\d{4}-\d{2}-\d{2}\b",
    r"\$\d+",
    r"\b[A-Z][a-z]+ [A-Z][a-z]+\b",
    r"\b\d{3}[-.]?\d{3}[-.]?\d{4}\b",
)
FRAGMENT_MASKS = (
    (r"\b\d+\s*(?:months?|weeks?|days?)\b", "[TIME_PERIOD]"),
    (r"\b\d+\s*(?:posts?|videos?|stories?)\b", "[DELIVERABLE_COUNT]"),
)

KEYWORD_STOPS = (
    "that", "this", "with", "from", "they", "have", "been", "were", "said",
    "each", "which", "their", "time", "will", "about", "would", "there",
    "could", "other", "after", "first", "well", "year", "work", "such",
    "make", "even", "most", "some", "take", "than", "only", "think",
    "also", "people", "way", "may", "many", "much", "through", "back",
    "good", "very", "still", "should", "any", "our", "out", "up",
    "agreement", "party", "parties", "shall", "terms", "conditions",
)

# platform aliases used when a field value is looked up in a text
FIELD_ALIASES = (("instagram", ("instagram", "ig")), ("facebook", ("facebook", "fb")))
