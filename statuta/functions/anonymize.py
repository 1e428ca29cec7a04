"""Anonymised text: era years and numbers are masked, article references are kept."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The eras, and every white-space code point below U+3100.
ERAS = ("令和", "平成", "昭和", "大正", "明治")
WHITE = r"[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{1C}-\x{1F}]"
ERA = rf"(?:{'|'.join(ERAS)}){WHITE}*\p{{Nd}}+{WHITE}*年"
ARTICLE = r"第\p{Nd}+[条項号]"
TOKEN = rf"{ERA}|{ARTICLE}|\p{{Nd}}+"

#: Personal data that bars a question's raw form from being stored; this list is our own.
PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "phone": r"(?<![\p{Nd}-])(?:\+81[- ]?|0)[0-9]{1,4}[- ][0-9]{1,4}[- ][0-9]{3,4}(?![\p{Nd}-])",
    "postal": r"〒\s*[0-9]{3}-?[0-9]{4}",
    "number": r"(?<!\p{Nd})[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}(?!\p{Nd})",
}


def anonymize(text: Column) -> Column:
    """Era years become [ERA][N]年, other numbers [N]; 第12条 and the like stay.  Null gives null.

    A number is part of an article reference only if the sign 第 stands right before it and 条, 項
    or 号 right behind it; the look-behind for digits keeps a number from being cut in two.
    """
    eras = F.regexp_replace(text, ERA, "[ERA][N]年")
    return F.regexp_replace(eras, r"(?<![第\p{Nd}])\p{Nd}+|(?<=第)\p{Nd}+(?![\p{Nd}条項号])", "[N]")


def token_counts(text: Column) -> Column:
    """Struct of the numbers of era years, article references and other numbers."""
    found = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    count = lambda test: F.size(F.filter(found, test)).cast("long")
    era = lambda x: x.rlike("年$")
    article = lambda x: x.rlike("^第")
    return F.struct(count(era).alias("eras"), count(article).alias("articles"), count(lambda x: ~era(x) & ~article(x)).alias("numbers"))


def has_pii(text: Column) -> Column:
    out = F.lit(False)
    for pattern in PII.values():
        out = out | text.rlike(pattern)
    return out


def stored_forms(text: Column, backfill: bool = False) -> tuple[Column, Column]:
    """What a question log keeps: raw unless it holds personal data, and the anonymised form where it does (or always)."""
    private = has_pii(text)
    return F.when(~private, text), F.when(private | F.lit(backfill), anonymize(text))


def escape_html(text: Column) -> Column:
    for old, new in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


#: The names under which other code knows the patterns, the detector and the anonymised form.
PATTERNS, detect_pii, anonymize_text = PII, has_pii, anonymize
