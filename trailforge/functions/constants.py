"""They must be these for results to be right, and are listed in their natural order."""

# Query parameters that only track; case matters.
TRACKING_PARAMS = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "gclid", "fbclid")

# Text chunks: size, overlap, step = int(size * (1 - overlap)), least length.
CHUNK_SIZE, CHUNK_OVERLAP, CHUNK_STEP, MIN_CONTEXT = 8000, 0.12, 7040, 500
NEAR_DUP = 0.92
SLOP_SECONDS = 600

# Personal-data patterns in the order in which they are applied. (?U) makes \b, \d and \s Unicode-aware in Java.
PII_PATTERNS = (
    ("email", r"[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+"),
    ("phone", r"\b\+?\d{1,3}?[-.\s]?\(?\d{1,4}?\)?[-.\s]?\d{1,4}[-.\s]?\d{1,9}\b"),
    ("credit_card", r"\b(?:\d[ -]*?){13,16}\b"),
    ("ssn", r"\b\d{3}-\d{2}-\d{4}\b"),
    ("iban", r"\b[A-Z]{2}\d{2}[A-Z0-9]{1,30}\b"),
    ("jwt", r"eyJ[a-zA-Z0-9_-]{10,}\.[a-zA-Z0-9_-]{10,}\.[a-zA-Z0-9_-]{10,}"),
    ("stripe_key", r"\bsk_live_[a-zA-Z0-9]{24,}\b"),
    ("api_key", r"(?i)\b(?:api|secret|token|key|password)[=:][a-zA-Z0-9\-_]{16,}\b"),
    ("long_token", r"\b(?:[A-Za-z0-9]{32,})\b"),
    ("ip_with_creds", r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}:[^\s]+@"),
)
REDACTED = "[REDACTED]"

# Parts of host names that mark a domain as high-risk.
HIGH_RISK_WORDS = (
    "bank", "finance", "pay", "stripe", "paypal", "health", "insurance", "hr", "payroll", "aws", "azure", "gcp",
    "cloud", "admin", "dashboard", "pastebin", "gist", "dropbox", "box", "drive", "docs", "medical", "clinic", "hospital",
)

# Parts of host names by topic, and words of a text.
DEV_HOSTS = ("github", "stackoverflow", "readthedocs", "pkg.go.dev", "docs.", "developer.")
NEWS_HOSTS = ("nytimes", "cnn", "bbc", "reuters", "theguardian")
RESEARCH_HOSTS = ("arxiv", "nature", "sciencedirect", "acm", "ieee")
RESEARCH_TEXT = r"\b(research|study|experiment|paper|dataset)\b"
ERROR_TEXT = "error|exception|stack trace|code"

# Instructions of the direct conversion: two always, one for news and research, one for development.
TEMPLATES = (
    "Summarize the article in 3 bullets, each under 20 words.",
    "List 5 key takeaways, one per line, no fluff.",
    "Answer the question 'What is the core idea?' using only the provided context, one sentence.",
    "Explain the error and propose a 3-step fix, include a short code block if relevant.",
)

# Reasons, their topics, and the reasons that have an instruction of their own.
REASON_TOPIC = {
    "general": "general",
    "shorts/entertainment": "entertainment",
    "tutorial/learning": "education",
    "news/information": "news",
    "music/ambient": "music",
    "deep-dive/research": "research",
    "night_browsing": "general",
}
INSTRUCTION_REASONS = ("tutorial/learning", "music/ambient", "news/information", "deep-dive/research")

# Instruction wordings of the three layouts: short video, the four reasons above, any other.
WORDINGS = {
    "v1": (
        "Summarize this short video in one sentence.",
        "Explain step by step how to follow this tutorial or learning content.",
        "Describe the style, mood, and characteristics of this music or audio content.",
        "Summarize the key facts, events, or information presented.",
        "Write a detailed summary highlighting new knowledge, findings, or insights.",
        "Summarize the main idea and key points of this content.",
    ),
    "v2": (
        "Summarize in one sentence.",
        "Explain step by step how to follow this tutorial.",
        "Describe the style and mood of this music/audio.",
        "Summarize the key facts or event.",
        "Write a detailed summary highlighting new knowledge or findings.",
        "Summarize the main idea of this content.",
    ),
    "v3": (
        "Summarize in one sentence.",
        "Explain step by step how to follow this tutorial.",
        "Describe the style and mood of this music/audio.",
        "Summarize the key facts or event.",
        "Write a detailed summary highlighting new knowledge or findings.",
        "Summarize the main idea of this video.",
    ),
}

# Keys that an enriched event must have; layout B does without the transcript.
REQUIRED_A = (
    "browser", "profile", "url", "domain", "title", "visited_at_iso", "content_meta", "transcript_excerpt", "session_id",
    "time_of_day", "day_of_week", "duration_hint", "labels",
)
REQUIRED_B = tuple(k for k in REQUIRED_A if k != "transcript_excerpt")
SFT_KEYS = ("instruction", "context", "response", "meta")
SFT_META_KEYS = ("url", "title", "ts", "domain", "topic", "source_id", "chunk_id", "generated", "length_chars", "split_hint")
SPLITS = ("train", "val", "test")
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
SESSION_STREAMS = ("com.apple.corespotlight.domain", "com.apple.browser", "com.apple.Safari", "com.apple.Chrome", "com.apple.webkit")

# Model catalogue: size, name, parameters, memory in GB by precision, GPU, least GPU memory, LoRA rank and alpha, batch, accumulation.
MODELS = (
    ("7b", "meta-llama/Llama-2-7b-hf", 7_000_000_000, (28, 14, 7, 4), "NVIDIA RTX 3090 (24GB) or better", 16, 16, 32, 4, 4),
    ("13b", "meta-llama/Llama-2-13b-hf", 13_000_000_000, (52, 26, 13, 7), "NVIDIA A100 (40GB) or better", 24, 32, 64, 2, 8),
    ("70b", "meta-llama/Llama-2-70b-hf", 70_000_000_000, (280, 140, 70, 35), "Multiple A100 (80GB) or H100", 80, 64, 128, 1, 16),
)
PRECISIONS = ("fp32", "fp16", "int8", "int4")
