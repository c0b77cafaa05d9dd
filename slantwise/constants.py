"""Fixed values shared by the operators: class names, patterns and word lists."""

from __future__ import annotations

# Ordered class list. The signed score is p[last] - p[first].
CLASSES = ("left", "center", "right")

# Columns a document record must carry, and the ones it may carry.
REQUIRED_FIELDS = ("doc_id", "text")
OPTIONAL_FIELDS = ("title", "date", "source", "url", "subset_meta")

# Defaults of the processing steps.
MIN_CHARS = 50
MAX_CHARS = 50_000
MAX_FEATURES = 30_000
NGRAM_RANGE = (1, 3)
MIN_DF = 3
MAX_DF = 0.95
K_ANONYMITY = 30
CALIBRATION_BINS = 10
HISTOGRAM_BINS = 40
ENTROPY_EPSILON = 1e-10

# Unicode whitespace as Python's ``str.isspace`` sees it, in a spelling that
# means the same in java.util.regex and RE2. ``WS``/``NON_WS`` are one character.
WS = r"[\s\p{Z}\x0B\x1C-\x1F\x{85}]"
NON_WS = r"[^\s\p{Z}\x0B\x1C-\x1F\x{85}]"

# A token is a run of at least two word characters.
TOKEN = r"[\p{L}\p{N}_]{2,}"

# Text clean-up patterns. An address is removed together with the whole
# whitespace-free run around it, so the search is anchored at the start of a run.
URL = r"https?://" + NON_WS + "+"
EMAIL = r"(?<!" + NON_WS + ")" + NON_WS + "+@" + NON_WS + r"+\." + NON_WS + "+"

# Boilerplate phrases, in the order they are removed. ``[^\n]*`` runs to the end
# of the line.
BOILERPLATE = (
    r"(?i)subscribe to our newsletter[^\n]*",
    r"(?i)click here to read more[^\n]*",
    r"(?i)advertisement" + WS + "*",
    r"(?i)share this article[^\n]*",
    r"(?i)copyright \p{Nd}{4}[^\n]*",
    r"(?i)all rights reserved[^\n]*",
)

# HTML subtrees that never hold article text; of the raw ones all is text up to their end tag.
DROPPED_TAGS = ("script", "style", "nav", "footer", "header")
RAW_TAGS = ("script", "style")

# The rest of a tag up to its end: a quoted attribute may hold ``>``.
TAG_REST = r"""[^"'>]*(?:(?:"[^"]*"|'[^']*')[^"'>]*)*>"""
# One piece of markup: comment, declaration, raw element, tag, tag with an open quote.
MARKUP = (
    r"(?is)<!--.*?(?:-->|\z)|<[!?][^>]*>|</(?:[^A-Za-z>][^>]*)?>|"
    + "".join(rf"<{tag}(?:[\s/]{TAG_REST}|>).*?(?:</{tag}(?:[\s/][^>]*)?>|\z)|" for tag in RAW_TAGS)
    + rf"</?[A-Za-z]{TAG_REST}|</?[A-Za-z][^>]*>"
)

# Function words per language code used by the language detector.
FUNCTION_WORDS = {
    "de": ("der", "die", "das", "und", "ist", "nicht", "mit", "von", "für", "ein", "auf", "den", "sich", "auch"),
    "en": ("the", "of", "and", "to", "in", "is", "for", "with", "that", "on", "by", "are", "was", "this"),
    "es": ("el", "los", "las", "y", "que", "por", "para", "con", "una", "del", "es", "en", "se", "no"),
    "fr": ("le", "la", "les", "des", "et", "est", "dans", "pour", "que", "une", "du", "qui", "pas", "sur"),
}

# Spark's default English stop words (StopWordsRemover), in Spark's order.
STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him
    his himself she her hers herself it its itself they them their theirs
    themselves what which who whom this that these those am is are was were be been
    being have has had having do does did doing a an the and but if or because as
    until while of at by for with about against between into through during before
    after above below to from up down in out on off over under again further then
    once here there when where why how all any both each few more most other some
    such no nor not only own same so than too very s t can will just don should now
    i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm
    you're he's she's it's we're they're i've we've you've they've isn't aren't
    wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't
    shouldn't mustn't can't couldn't cannot could here's how's let's ought that's
    there's what's when's where's who's why's would
    """.split()
)

# Notes written on top of a labelling template; callers may pass their own.
TEMPLATE_HEADER = (
    "# How to fill in this sheet",
    "# Read the whole text before choosing; the publisher must not sway the choice.",
    "# Allowed values in the second column: {classes}.",
    "# Leave a row blank rather than guess. The last two columns may stay blank.",
)
