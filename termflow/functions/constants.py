"""Fixed values. These must equal the original pipeline's for equal results."""

# Token filter: a term is longer than this many chars.
MIN_TERM_LENGTH = 3
# Number of least frequent terms removed from the vocabulary, and the lower
# bound on what must remain (a corpus with N - 20 <= 20 is too small).
TAIL_DROP = 20
# Topic model: topics, terms described per topic, scores published.
TOPIC_COUNT = 10
TERMS_PER_TOPIC = 10
TOP_SCORES = 10
# Arrival notice for a named document.
NOTICE_FORMAT = "New doc received: %s"
# Printed lines: a word count, and a described topic term (index, term, weight).
WORD_COUNT_FORMAT = "%s: %d"
TOPIC_TERM_FORMAT = "%d: %s : %f"
# Word-cloud size: base + weight * scale, truncated toward zero.
DISPLAY_BASE = 10
DISPLAY_SCALE = 1000
# Price positions: threshold on the delta percentage, and the labels.
POSITION_THRESHOLD = 0.01
POSITION_SELL = "sell"
POSITION_BUY = "buy"
POSITION_HOLD = "hold"
# Numeric LDA of the original job: topics.
NUMERIC_TOPIC_COUNT = 3
# Message topics of the original deployment: documents in (subscribed by a
# case-insensitive pattern), arrival notices and score messages out, prices.
DOC_TOPIC = "docs"
DOC_TOPIC_PATTERN = "(?i)docs"
NOTICE_TOPIC = "tcmeta"
SCORE_TOPIC = "tcdata"
PRICE_TOPIC = "prices"
