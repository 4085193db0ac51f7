"""Fixed values.

Everything in this module must stay exactly as written: the header patterns, the cleaning and
splitting rules and the defaults below decide which results are produced, and the oracle SQL
embeds the same text. Change none of them to make a query look different.
"""

# ---------------------------------------------------------------------------------------------
# FIXED VALUES -- header patterns of a book file (group 1 is the extracted value).
# `\s*` may cross a newline, and the patterns are not anchored to the start of a line.
# ---------------------------------------------------------------------------------------------
TITLE_PATTERN = r"Title:\s*(.+?)(?:\r?\n)"
AUTHOR_PATTERN = r"Author:\s*(.+?)(?:\r?\n)"
RELEASE_DATE_PATTERN = r"Release Date:\s*(.+?)(?:\r?\n|\[)"
LANGUAGE_PATTERN = r"Language:\s*(.+?)(?:\r?\n)"
ENCODING_PATTERN = r"Character set encoding:\s*(.+?)(?:\r?\n)"
# Year taken from an already extracted release date (metadata profile).
YEAR_IN_DATE_PATTERN = r"(\d{4})"
# Year taken straight from the text, same line as the release-date label (influence network).
YEAR_IN_LINE_PATTERN = r"Release Date:.*?(\d{4})"
# Last path component of a book file.
FILE_NAME_PATTERN = r"([^/]+\.txt)$"

# ---------------------------------------------------------------------------------------------
# FIXED VALUES -- text rules.
# ---------------------------------------------------------------------------------------------
# Each run of characters that are neither ASCII letters nor whitespace becomes one space.
CLEAN_PATTERN = r"[^a-zA-Z\s]+"
# The same class spelled for the JVM: in Java regex \p{Alpha} is the POSIX class [a-zA-Z]
# (no UNICODE_CHARACTER_CLASS flag), so the matches are identical; java.util.regex evaluates
# this spelling about 6x faster than the two-range negated class. Tests assert equal output.
CLEAN_PATTERN_JAVA = r"[^\p{Alpha}\s]+"
# Optional mode: letters of every script stay (off by default).
CLEAN_PATTERN_UNICODE = r"[^\p{L}\s]+"
# Word-count delimiters: space, tab, newline, carriage return, form feed.
WORD_DELIMITERS = r"[ \t\n\r\f]+"
# Any of the three line endings ends a line.
LINE_BREAK_PATTERN = r"\r\n|\n|\r"

# ---------------------------------------------------------------------------------------------
# FIXED VALUES -- defaults of the original scripts.
# ---------------------------------------------------------------------------------------------
NUM_BOOKS = 50
NUM_FEATURES = 2000
TOP_K = 5
TIME_WINDOW = 10
TOP_AUTHORS_LIMIT = 10
REPORT_TOP = 5
REPORT_YEARS = 20
PREVIEW_ROWS = 20
METADATA_PREVIEW_ROWS = 10
HASH_SEED = 42

# ---------------------------------------------------------------------------------------------
# FIXED VALUES -- names of the job outputs.
# ---------------------------------------------------------------------------------------------
METADATA_OUTPUTS = ("metadata_extracted", "temporal_distribution", "language_statistics",
                    "encoding_distribution", "top_authors", "summary")
SIMILARITY_OUTPUTS = ("tfidf_vectors", "similarities", "top_similar", "summary")
NETWORK_OUTPUTS = ("influence_network", "author_metrics", "top_influential", "top_influenced", "summary")

# ---------------------------------------------------------------------------------------------
# FIXED VALUES -- Spark's default English stop-word list (pyspark.ml.feature.StopWordsRemover,
# loadDefaultStopWords("english")), 181 words, in Spark's order. Embedded so that the oracle
# SQL can state it without a running JVM; tests assert equality with Spark's own list.
# ---------------------------------------------------------------------------------------------
ENGLISH_STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours",
    "yourself", "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself",
    "it", "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "these", "those", "am", "is", "are", "was", "were", "be",
    "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by", "for",
    "with", "about", "against", "between", "into", "through", "during", "before", "after",
    "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over", "under",
    "again", "further", "then", "once", "here", "there", "when", "where", "why", "how", "all",
    "any", "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not",
    "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don",
    "should", "now", "i'll", "you'll", "he'll", "she'll", "we'll", "they'll", "i'd", "you'd",
    "he'd", "she'd", "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's", "we're",
    "they're", "i've", "we've", "you've", "they've", "isn't", "aren't", "wasn't", "weren't",
    "haven't", "hasn't", "hadn't", "don't", "doesn't", "didn't", "won't", "wouldn't", "shan't",
    "shouldn't", "mustn't", "can't", "couldn't", "cannot", "could", "here's", "how's", "let's",
    "ought", "that's", "there's", "what's", "when's", "where's", "who's", "why's", "would",
)
