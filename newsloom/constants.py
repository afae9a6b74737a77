"""Fixed values.

Everything in this file has to equal the published behaviour for results to
match: default texts, truncation budgets and markers, prompts, error texts,
accepted status codes and formats. Nothing here is logic.
"""

# Defaults of an ingested article.
DEFAULT_TITLE = "No Title Provided"
DEFAULT_SOURCE_NAME = "Unknown Source"
FEED_FALLBACK_THRESHOLD = 150

# Sources used when no catalogue file exists.
DEFAULT_SOURCES = [
    {"name": "The Verge (Default)", "url": "https://www.theverge.com/rss/index.xml",
     "enabled": True, "tags": ["Tech"], "weight": 1.0},
    {"name": "TechCrunch (Default)", "url": "https://techcrunch.com/feed/",
     "enabled": True, "tags": ["Startups"], "weight": 1.5},
]

# The characters removed from both ends of a text (Unicode white space).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Relevance request.
RELEVANCE_TITLE_CHARS = 200
RELEVANCE_TEXT_CHARS = 3500
RELEVANCE_TEXT_MARKER = " [SUMMARY TRUNCATED]"
RELEVANCE_INSTRUCTION = (
    "You are an AI content filter. Determine whether the following article is primarily about "
    "artificial intelligence, machine learning, deep learning, neural networks, or related AI "
    "technologies."
)
RELEVANCE_QUESTION = "Respond only with 'yes' or 'no'."
RELEVANCE_SYSTEM_PROMPT = "You are a helpful assistant."

# Summary request and the texts stored in place of a summary.
SUMMARY_MAX_INPUT_CHARS = 7000
SUMMARY_TITLE_CHARS = 250
SUMMARY_TITLE_MARKER = "..."
SUMMARY_CONTENT_MARKER = " [CONTENT TRUNCATED]"
SUMMARY_HEAVY_CHARS = 100
SUMMARY_HEAVY_MARKER = " [CONTENT HEAVILY TRUNCATED]"
SUMMARY_DEFAULT_TITLE = "No Title"
SUMMARY_DEFAULT_CONTENT = "No content available for summarization."
SUMMARY_QUESTION = "Please provide a 1-2 sentence summary:"
SUMMARY_SYSTEM_PROMPT = (
    "You are an expert news summarizer. Your goal is to provide a concise and informative 1 to 2 "
    "sentence summary of the provided article content. Focus on the main topic and key takeaways."
)
SUMMARY_NO_CONTENT = "[Summary N/A - No content provided]"
SUMMARY_ERROR_PREFIX = "[Summary unavailable due to LLM error: "
SUMMARY_ERROR_SUFFIX = "]"

# Chat requests, retries and error texts.
PRIMARY_MODEL = "llama3-8b-8192"
FALLBACK_MODEL = "mistralai/mistral-7b-instruct"
TEMPERATURE = 0.7
MAX_RETRIES = 3
BASE_BACKOFF_SECONDS = 1.0
RETRY_HINT = "try again in "
RETRY_HINT_BUFFER_SECONDS = 0.5
RATE_LIMIT_STATUS = 429
SERVER_ERROR_STATUSES = (500, 502, 503, 504)
ERROR_ALL_FAILED = "Error: All LLM attempts failed (Groq and OpenRouter)."
ERROR_FALLBACK_FORMAT = "Error: OpenRouter fallback response format invalid for model {model}."
ERROR_FALLBACK_HTTP = "Error: OpenRouter fallback failed for model {model} with HTTP error {status}."
ERROR_FALLBACK_OTHER = "Error: OpenRouter fallback failed for model {model} with error: {error}"

# Queue sizes.
SUMMARY_QUEUE_LIMIT = 5
DIGEST_QUEUE_LIMIT = 10
DIGEST_SIZE = 5
INSERTED_SAMPLE_SIZE = 3

# Digest display.
DIGEST_TAGLINE = "AI highlights at a glance"
DATE_UNKNOWN = "N/A"
DATE_DISPLAY_FORMAT = "MMMM dd, yyyy"
HTML_ESCAPES = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&#34;"), ("'", "&#39;")]

# Hours east of UTC of the zone names allowed in RFC 822 dates.
RFC822_ZONES = {
    "UT": 0, "UTC": 0, "GMT": 0, "Z": 0,
    "AST": -4, "ADT": -3, "EST": -5, "EDT": -4, "CST": -6, "CDT": -5,
    "MST": -7, "MDT": -6, "PST": -8, "PDT": -7,
}
