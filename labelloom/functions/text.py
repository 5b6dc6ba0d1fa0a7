"""Text column functions. All but entity decoding stay inside JVM expressions."""

from __future__ import annotations

import html

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: character classes and patterns that decide the cleaned text -------------------

# Everything str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
    "\u200a\u2028\u2029\u202f\u205f\u3000"
)
# Unicode word and space classes spelled out, because Java's \w and \s are ASCII-only.
_WORD = r"\p{L}\p{N}_"
_SPACE = r"\s\x0b\x1c-\x1f\x85\p{Z}"

TAG = r"<[^>]+>"
EMAIL = rf"(?U)\b[{_WORD}.+-]+@[{_WORD}-]+\.[{_WORD}.-]+\b"
URL = rf"https?://[^{_SPACE}]+|www\.[^{_SPACE}]+"
MENTION = rf"@[{_WORD}]+"
HASHTAG = rf"#([{_WORD}]+)"
DISALLOWED = rf"[^a-z0-9{_SPACE}!?']"
SPACES = rf"[{_SPACE}]+"
KEPT = r"[a-z0-9!?']+"
NOTHING = r"\A(?!)"
WORDS = r"([a-zA-Z']+)"

# --- building blocks -----------------------------------------------------------------------------


def strip(c: Column) -> Column:
    """Trim every Unicode space, not only U+0020."""
    return F.btrim(c, F.lit(WHITESPACE))


def fold_label(c: Column) -> Column:
    return F.lower(strip(c))


def has_text(c: Column) -> Column:
    """True for a non-null, non-blank text; never null."""
    return c.isNotNull() & (F.coalesce(F.length(strip(c)), F.lit(0)) > 0)


def null_to_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


# Rows go to Python by the hundred, not by the ten thousand of an Arrow batch, which long pages make as large as they like.
@F.udf(T.StringType(), useArrow=False)
def _decode_entities(value: str | None) -> str | None:
    return None if value is None else html.unescape(value)


def unescape_entities(c: Column) -> Column:
    """Decode HTML entities. Only texts with an ampersand cross into Python; the rest send nulls."""
    return F.coalesce(_decode_entities(F.when(F.contains(c, F.lit("&")), c)), c)


def squeeze(c: Column) -> Column:
    return strip(F.regexp_replace(c, SPACES, " "))


def clean(
    c: Column,
    *,
    lowercase: bool = True,
    drop_urls: bool = True,
    drop_mentions: bool = True,
    keep_hashtag_word: bool = True,
) -> Column:
    """Social-media cleaning. Step order matters: e-mails go before mentions, entities before tags.

    With ``lowercase=False`` the keep-set is still lowercase-only, so capitals are deleted.
    """
    base = unescape_entities(null_to_empty(c))
    seen = F.lower(base) if lowercase else base
    text = F.lower(strip(base)) if lowercase else strip(base)

    def when_present(text: Column, marks: tuple[str, ...], pattern: str, to: str = " ") -> Column:
        """Replace only where a mark occurs at all; other texts meet a pattern that ends at once."""
        where = base if len(marks) == 1 else seen
        present = F.contains(where, F.lit(marks[0]))
        for mark in marks[1:]:
            present = present | F.contains(where, F.lit(mark))
        return F.regexp_replace(text, F.when(present, F.lit(pattern)).otherwise(F.lit(NOTHING)), F.lit(to))

    text = when_present(text, ("<",), TAG)
    text = when_present(text, ("@",), EMAIL)
    if drop_urls:
        text = when_present(text, ("://", "www."), URL)
    if drop_mentions:
        text = when_present(text, ("@",), MENTION)
    text = when_present(text, ("#",), HASHTAG, " $1 " if keep_hashtag_word else " ")
    # Runs of kept characters, one space apart: the same as replacing what lies between them, at a sixth of its time.
    return F.array_join(F.regexp_extract_all(text, F.lit(KEPT), F.lit(0)), " ")


def normal_form(c: Column) -> Column:
    """Duplicate-check form: lowercase words of letters and apostrophes, one space apart."""
    return F.array_join(F.regexp_extract_all(F.lower(c), F.lit(WORDS), F.lit(1)), " ")


def word_array(c: Column) -> Column:
    """Words of a squeezed text; the empty text has none."""
    return F.filter(F.split(c, " "), lambda w: w != "")


def word_count(c: Column) -> Column:
    return F.size(word_array(c))


def sentence_case(c: Column) -> Column:
    """Upper-case the first visible character and leave the rest alone."""
    s = strip(c)
    return F.concat(F.upper(F.substring(s, 1, 1)), F.substr(s, F.lit(2)))


def fill_template(template: Column, opener: Column, middle: Column, ending: Column) -> Column:
    slots = {
        "{opener}": opener,
        "{middle}": middle,
        "{ending}": ending,
        "{opener_cap}": sentence_case(opener),
        "{middle_cap}": sentence_case(middle),
    }
    for slot, value in slots.items():
        template = F.replace(template, F.lit(slot), value)
    return template


def model_input(c: Column) -> Column:
    """Minimal clean-up for a sub-word model: trim only."""
    return strip(c)


def output_label(c: Column) -> Column:
    """Structured prediction with a folded label."""
    return F.struct(fold_label(c).alias("predicted_label"))


def null_tokens(c: Column, tokens: tuple[str, ...]) -> Column:
    """Cells that spell a missing value become null."""
    return F.when(~c.isin(*tokens), c)
