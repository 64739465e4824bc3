"""Column expressions for review text.

Everything here returns a ``Column`` built from ``pyspark.sql.functions``
only, so it stays inside whole-stage codegen on the executors.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must stay exactly as written for parity)
# ---------------------------------------------------------------------------

# Token patterns.
WORD_OR_PUNCT = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"   # words and single punctuation marks
LETTER_DIGIT_RUN = r"[\p{L}\p{N}]+"                 # analysed index / query terms
SYMBOL_RUN = r"[^\p{L}\p{N}]+"                      # stripped from space tokens
SYMBOL_NOT_SPACE_RUN = r"[^\p{L}\p{N} ]+"           # the same, deleted from a text before it is split at spaces
QUERY_DELETE = r"[^a-zA-Z ]+"                       # deleted from neighbour query text
QUERY_DELETE_LOWER = r"[^a-z ]+"                    # the same of a lower-cased text, in a tenth of the time
NON_BLANK = r"[^\x00-\x20]"                         # survives a Java-style trim()

# English stop words removed by the neighbour analyser (classic 33-word set).
STOP_WORDS = [
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in",
    "into", "is", "it", "no", "not", "of", "on", "or", "such", "that", "the",
    "their", "then", "there", "these", "they", "this", "to", "was", "will", "with",
]

# Words that switch the negation flag on.
NEGATORS = ["no", "not"]

# Tag prefixes that make a token a content word.
CONTENT_TAG_PATTERN = r"^(JJ|RB|NN|V)"

# HTML clean-up, applied in this order.
HTML_COMMENT = r"(?is)<!--.*?-->"
HTML_SCRIPT_STYLE = r"(?is)<(script|style)\b.*?</(script|style)>"
# a "<" that opens no tag ("<3", "a < b") is text
HTML_TAG = r"(?s)<[a-zA-Z/!?][^>]*>"
# Character references decoded after tag removal, each once, so that "&amp;lt;"
# becomes "&lt;" and not "<": decimal, hexadecimal, and the names of HTML5.
HTML_NAMES = {name[:-1]: ch for name, ch in html5.items() if name.endswith(";")}
# Names that are read without a ";" too, also in front of other letters; longer ones first.
HTML_OPEN_NAMES = sorted((name for name in html5 if not name.endswith(";")), key=lambda name: (-len(name), name))
HTML_REFERENCE = (r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|(?:" + "|".join(sorted(HTML_NAMES, key=lambda name: (-len(name), name))) + ");|"
                  + "|".join(HTML_OPEN_NAMES) + ")")
# numbers that stand for other characters (windows-1252), as browsers read them
HTML_NUMBERS = {n: ord(bytes([n]).decode("cp1252")) for n in range(0x80, 0xA0) if n not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}


# ---------------------------------------------------------------------------
# Cleaning
# ---------------------------------------------------------------------------

def html_to_text(col: Column | str, sep: str = "") -> Column:
    """Visible text of an HTML string: comments, script and style removed,
    remaining tags replaced by ``sep`` (adjacent text nodes glued), entities
    decoded."""
    c = F.col(col) if isinstance(col, str) else col

    def without_tags(x: Column) -> Column:
        x = F.regexp_replace(x, HTML_COMMENT, "")
        x = F.regexp_replace(x, HTML_SCRIPT_STYLE, "")
        return F.regexp_replace(x, HTML_TAG, sep)

    # bound in lambdas, so that every step runs once a row, and only where the text has what the step looks for
    marked = F.contains(c, F.lit("<")) | F.contains(c, F.lit("&"))
    bare = F.transform(F.array(c), lambda x: F.when(F.contains(x, F.lit("<")), without_tags(x)).otherwise(x))
    whole = F.transform(bare, lambda x: F.when(F.contains(x, F.lit("&")), F.when(x.rlike(HTML_REFERENCE), decode_references(x)).otherwise(x)).otherwise(x))[0]
    return F.when(marked, whole).otherwise(c)


def decode_references(c: Column) -> Column:
    """Character references decoded; a name that HTML5 does not have stays, and
    so does a name that needs its ";" and has none."""
    names = F.create_map(*[F.lit(x) for kv in sorted(HTML_NAMES.items()) for x in kv])
    numbers = F.create_map(*[F.lit(x) for kv in sorted(HTML_NUMBERS.items()) for x in kv])

    def character(ref: Column) -> Column:
        hexadecimal = F.lower(F.substring(ref, 2, 1)) == "x"
        digits = F.ltrim(F.when(hexadecimal, F.substring(ref, 3, 1 << 30)).otherwise(F.substring(ref, 2, 1 << 30)), F.lit("0"))
        code = F.when(F.length(digits) > 8, F.lit(0)).otherwise(F.coalesce(F.conv(F.when(hexadecimal, digits).otherwise(F.conv(digits, 10, 16)), 16, 10).cast("long"), F.lit(0)))
        code = F.coalesce(numbers[code.cast("int")], code)
        bad = (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
        number = F.decode(F.unhex(F.lpad(F.hex(F.when(bad, F.lit(0xFFFD)).otherwise(code)), 8, "0")), "UTF-32")
        return F.when(F.substring(ref, 1, 1) == "#", number).otherwise(F.try_element_at(names, ref))

    between = F.split(c, HTML_REFERENCE, -1)
    refs = F.transform(F.regexp_extract_all(c, F.lit(HTML_REFERENCE), 1), lambda r: F.rtrim(r, F.lit(";")))
    return F.array_join(F.zip_with(between, F.transform(refs, character), lambda x, y: F.concat(x, F.coalesce(y, F.lit("")))), "")


def normalize_query_text(col: Column | str) -> Column:
    """Lower-case, then delete every character outside ``[a-zA-Z ]``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(F.lower(c), QUERY_DELETE_LOWER, "")


# ---------------------------------------------------------------------------
# Tokenizers (array-valued; explode at the call site)
# ---------------------------------------------------------------------------

def word_tokens(col: Column | str) -> Column:
    """Words (letter/digit runs) and single punctuation marks, in order."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_extract_all(c, F.lit(WORD_OR_PUNCT), 0)


def analyzed_terms(col: Column | str) -> Column:
    """Index/query analysis: lower-cased letter/digit runs."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_extract_all(F.lower(c), F.lit(LETTER_DIGIT_RUN), 0)


def space_split(col: Column | str) -> Column:
    """Split on the single space character (newlines stay inside pieces)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.split(c, " ")


def is_non_blank(col: Column | str) -> Column:
    """True when the token is not blank after a Java-style ``trim()``
    (which strips every char <= U+0020)."""
    c = F.col(col) if isinstance(col, str) else col
    return c.rlike(NON_BLANK)


def strip_symbols(col: Column | str) -> Column:
    """Keep only letters and digits of a token."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c, SYMBOL_RUN, "")


def split_length(col: Column | str) -> Column:
    """Number of pieces of a single-space split with trailing empty pieces
    dropped (leading and inner empty pieces still count)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.size(F.split(F.rtrim(c), " "))


def is_content_tag(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.rlike(CONTENT_TAG_PATTERN)


# ---------------------------------------------------------------------------
# Paths and ids
# ---------------------------------------------------------------------------

def id_from_path(col: Column | str) -> Column:
    """Base name of a path up to its first '.'."""
    c = F.col(col) if isinstance(col, str) else col
    return F.substring_index(F.element_at(F.split(c, "/"), -1), ".", 1)


def label_from_path(col: Column | str) -> Column:
    """Class from the parent directory of a path ('pos' or 'neg', also as a
    'label=pos' partition folder), else NULL."""
    c = F.col(col) if isinstance(col, str) else col
    parent = F.regexp_replace(F.element_at(F.split(c, "/"), -2), "^label=", "")
    return F.when(parent.isin("pos", "neg"), parent)


def zero_padded(col: Column | str, width: int = 5) -> Column:
    """Zero-padded decimal id (never truncates numbers wider than ``width``)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.format_string(f"%0{width}d", c)


# Note on generators: tokenizer arrays are exploded with the ``*_outer``
# variants followed by an explicit null filter.  For a plain ``explode`` the
# optimizer infers ``size(array) > 0`` and pushes it below joins, which
# evaluates the tokenizer regex a second time on every row.
