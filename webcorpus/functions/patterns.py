"""Regular expressions shared by the Spark columns and the DuckDB oracle SQL.

Every pattern here must mean the same thing in Java regex (Spark) and RE2
(DuckDB): no look-around, no back-references, code points written as
``\\x{....}``, and ``\\A`` / ``\\z`` instead of ``^`` / ``$`` where a line
terminator could sit at the end.  Replacement templates use ``{1}``, ``{2}``
for groups and are rendered as ``$1`` (Spark) or ``\\1`` (DuckDB).
"""

from __future__ import annotations

from html.entities import name2codepoint

# The characters Python's str.strip() / str.isspace() treat as
# whitespace, in code-point order.
WS = (r"[\t\n\x0B\f\r\x1C-\x1F \x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}"
      r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
# The same set without the newline (whitespace inside one line).
HS = (r"[\t\x0B\f\r\x1C-\x1F \x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}"
      r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
NON_WS = WS.replace("[", "[^", 1)

# Strip a whole string the way str.strip() does.
STRIP = r"\A" + WS + r"+|" + WS + r"+\z"

# Split text into lines, strip every line, drop empty lines, join with "\n" —
# written as one substitution over the whole text followed by STRIP.
LINE_TIDY = HS + r"*\n" + WS + r"*"

# Letters of scripts written without spaces (Thai to Tibetan, Myanmar, Khmer, kana
# and bopomofo, Han, half-width kana): each is a token of its own.
UNSPACED = (r"\x{0E00}-\x{0FFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{312F}\x{31A0}-\x{31BF}"
            r"\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{FF66}-\x{FF9D}\x{20000}-\x{3FFFF}")
# Default token counter (the BPE vocabulary is not available offline): runs of
# letters, letters of unspaced scripts, runs of up to three digits, runs of other
# non-space symbols.
TOKEN = r"[^\P{L}" + UNSPACED + r"]+|\p{L}|\p{N}{1,3}|[^\p{L}\p{N}" + WS[1:-1] + r"]+"

ANY_TAG = r"<[^>]*>"
LINK_END = r"</a\s*>"
# Marks the step of the chain that decodes entities.
ENTITIES = "entities"

# What follows "&" in an entity: a decimal, a hexadecimal or a named one.
ENTITY = r"\A(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,15});"
# The named entities of HTML 4; a no-break space becomes a space, as does &#160;.
NAMED_ENTITIES = {name: chr(point) for name, point in name2codepoint.items()}
NAMED_ENTITIES |= {"apos": "'", "nbsp": " "}
NO_BREAK_SPACE = "160"

# HTML → text rewrite chain, applied in this order.
_HEADINGS = [(r"(?i)<h%d\b[^>]*>" % n, "\n" + "#" * n + " ") for n in range(1, 7)]
CLEAN_STEPS: list[tuple[str, ...]] = [
    (r"(?s)<!--.*?-->", ""),
    (r"(?is)<head\b.*?</head\s*>", ""),
    (r"(?is)<script\b.*?</script\s*>", ""),
    (r"(?is)<style\b.*?</style\s*>", ""),
    (r"(?i)<(meta|link|img)\b[^>]*>", ""),
    (WS + "+", " "),
    *_HEADINGS,
    (r"(?i)</h[1-6]\s*>", "\n"),
    (r"(?i)<li\b[^>]*>", "\n* "),
    (r"(?i)</t[dh]\s*>\s*<t[dh]\b[^>]*>", " | "),
    (r"(?i)<tr\b[^>]*>", "\n"),
    (r'(?is)<a\b[^>]*\bhref\s*=\s*"([^"]*)"[^>]*>(.*?)</a\s*>', "[{2}]({1})"),
    (r"(?is)<a\b[^>]*\bhref\s*=\s*'([^']*)'[^>]*>(.*?)</a\s*>", "[{2}]({1})"),
    (r"(?is)<a\b[^>]*\bhref\s*=\s*([^\s\"'>]+)[^>]*>(.*?)</a\s*>", "[{2}]({1})"),
    (r"(?i)</?(p|div|br|article|section|nav|footer|header|ul|ol|table|blockquote|hr|li)\b[^>]*>",
     "\n"),
    (ANY_TAG, ""),
    (ENTITIES,),
    (LINE_TIDY, "\n"),
    (STRIP, ""),
]

TITLE = r"(?is)<title[^>]*>(.*?)</title>"
META_TAG = r"(?is)<meta\b[^>]*>"
META_IS_DESCRIPTION = r"(?is)\bname\s*=\s*[\"']?description[\"'\s/>]"
META_CONTENT = r"(?is)\bcontent\s*=\s*(?:\"([^\"]*)\"|'([^']*)')"

# Line kinds of the structure splitter.
UNDERLINE_EQ = r"\A={3,}\z"
UNDERLINE_DASH = r"\A-{3,}\z"
LIST_ITEM = r"\A([*+\-]|\p{Nd}+\.|[a-z]\))"
PARAGRAPH_BREAK = r"\n\n+"

# Fact sentences: split on runs of sentence punctuation; questions dropped by
# their (lower-cased) first word, as a prefix test.
SENTENCE_SPLIT = r"[.!?]+"
QUESTION_PREFIX = r"\A(what|how|why|when|where|who)"
SENTENCE_END = r"[.!?]\z"

# Authority (netloc) of a URL: what lies between "scheme://" and the path.
AUTHORITY = r"\A[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"
# Path, query and fragment after the authority (robots matching).
PATH_REST = r"\A[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(.*)\z"


def or_unclosed(pattern: str) -> str:
    """A pattern that deletes from an opener to the nearest closer, with a second
    branch (group 1): an opener that is never closed, with all that follows."""
    opener = pattern.split(".*?")[0] + ".*" if ".*?" in pattern else pattern.removesuffix(">")
    flags, _, opener = opener.rpartition(")") if opener.startswith("(?") else ("", "", opener)
    return f"{pattern}|({opener}" + r"\z)"


def spark_replacement(template: str) -> str:
    out = template.replace("\\", "\\\\").replace("$", "\\$")
    return out.replace("{1}", "$1").replace("{2}", "$2")


def duck_replacement(template: str) -> str:
    return template.replace("{1}", "\\1").replace("{2}", "\\2")


def sql_str(s: str) -> str:
    """A DuckDB string literal (no backslash escapes in standard strings)."""
    if "\n" in s:
        parts = s.split("\n")
        return " || chr(10) || ".join(sql_str(p) if p else "''" for p in parts)
    return "'" + s.replace("'", "''") + "'"
