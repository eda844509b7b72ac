"""HTML to title, text and code blocks with built-in regex functions.

Well-formed pages are handled inside the JVM.  ``needs_tree`` marks the rest
(nested or unclosed regions, ``div`` regions, rare character references); only
those go to the small tree walk in ``html_tree``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..rules import UNTITLED
from .text import collapse_blanks, let, strip

# Dropped parts leave this empty tag behind, because they separate text nodes.
GAP = "<!>"

# One leading "<" for all alternatives, so that other characters fail at once.
_RAW_PARTS = (
    r"(?is)<(?:!--.*?-->"
    r"|script(?=[\s/>])[^>]*>.*?</script\s*>"
    r"|style(?=[\s/>])[^>]*>.*?</style\s*>)"
)
_CHROME_PARTS = (
    r"(?is)<(?:nav(?=[\s/>])[^>]*>.*?</nav\s*>"
    r"|footer(?=[\s/>])[^>]*>.*?</footer\s*>"
    r"|header(?=[\s/>])[^>]*>.*?</header\s*>)"
)
_LEFTOVER = r"(?i)<(?:/?(?:script|style|nav|footer|header)(?=[\s/>])|!--)"

# A tag with quoted attribute values, which may hold ">"; else up to the next ">".
_TAG = r"<[a-zA-Z/!?](?:(?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*>)"

# Elements that stand on lines of their own.
BLOCK_TAGS = (
    "address", "article", "aside", "blockquote", "caption", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "form",
    "h1", "h2", "h3", "h4", "h5", "h6", "hr", "li", "main", "ol", "p", "pre", "section", "summary", "table", "td", "th", "tr", "ul",
)
# Set at the edges of blocks and before a heading's level; no text holds these sequences.
_EDGE, _LEVEL = "\x01\uffff\x02", "\x01\uffff\x03"
_REST = r"(?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+>"

_REGION_DIV = (
    r"(?is)<div(?=[\s/>])[^>]*?\bclass\s*=\s*"
    r"(?:\"[^\"]*(?:content|docs|markdown)|'[^']*(?:content|docs|markdown)|[^\s\"'>]*(?:content|docs|markdown))"
)

# Character references replaced here; all others take the tree walk.
_REFERENCES = {
    "&nbsp;": " ",
    "&quot;": '"',
    "&apos;": "'",
    "&#39;": "'",
    "&copy;": "©",
    "&middot;": "·",
    "&ndash;": "–",
    "&mdash;": "—",
    "&lsquo;": "‘",
    "&rsquo;": "’",
    "&ldquo;": "“",
    "&rdquo;": "”",
    "&hellip;": "…",
}
_RARE_REFERENCE = r"&(?!(?:lt|gt|amp);)[#a-zA-Z]"


# Quotes or ">" inside an attribute's value: patterns over tags would end too early.
ODD_ATTRIBUTE = r"(?i)<[a-z][^<>]*=\s*(?:\"[^\"<>]*>|'[^'<>]*>|[^<>]*&(?:quot|apos|#39);)"


def drop_page_furniture(html: Column) -> Column:
    """Remove comments, scripts, styles, navigation, headers and footers."""
    return F.regexp_replace(F.regexp_replace(html, _RAW_PARTS, GAP), _CHROME_PARTS, GAP)


def replace_references(bare: Column) -> Column:
    """Replace the known character references; pages without any are only looked at once."""
    text = bare
    for reference, char in _REFERENCES.items():
        text = F.replace(text, F.lit(reference), F.lit(char))
    return F.when(bare.rlike(_RARE_REFERENCE), text).otherwise(bare)


def markup_references(text: Column) -> Column:
    # "&amp;" last, so that "&amp;lt;" ends as "&lt;".
    for reference, char in (("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        text = F.replace(text, F.lit(reference), F.lit(char))
    return text


def region_kind(bare: Column) -> Column:
    return (
        F.when(bare.rlike(r"(?i)<main(?=[\s/>])"), F.lit("main"))
        .when(bare.rlike(r"(?i)<article(?=[\s/>])"), F.lit("article"))
        .when(bare.rlike(_REGION_DIV), F.lit("div"))
        .when(bare.rlike(r"(?i)<body(?=[\s/>])"), F.lit("body"))
        .otherwise(F.lit("none"))
    )


def region_html(bare: Column, kind: Column) -> Column:
    return (
        F.when(kind == "main", F.regexp_extract(bare, r"(?is)<main(?=[\s/>])[^>]*>(.*?)</main\s*>", 1))
        .when(kind == "article", F.regexp_extract(bare, r"(?is)<article(?=[\s/>])[^>]*>(.*?)</article\s*>", 1))
        .when(kind == "body", F.regexp_extract(bare, r"(?is)<body(?=[\s/>])[^>]*>(.*)", 1))
    )


def spaced_text(region: Column) -> Column:
    """Text nodes joined by blanks, markup references still in place."""
    return F.regexp_replace(region, _TAG, " ")


def block_text(region: Column) -> Column:
    """A paragraph per block, with a blank line between two; headings are Markdown lines.

    Blanks inside a block, line breaks included, are one blank.  Empty blocks leave nothing.
    """
    names = "|".join(BLOCK_TAGS)
    headed = F.regexp_replace(region, rf"(?i)<h([1-6])(?=[\s/>]){_REST}", f"{_EDGE}{_LEVEL}$1")
    blocks = F.split(F.regexp_replace(headed, rf"(?i)</?(?:{names})(?=[\s/>]){_REST}", _EDGE), _EDGE)

    def written(block: Column) -> Column:
        level = F.when(block.startswith(_LEVEL), F.substring(block, 4, 1).cast("int"))
        text = F.when(level.isNotNull(), F.substring(block, 5, 2**31 - 1)).otherwise(block)
        clean = collapse_blanks(markup_references(F.regexp_replace(text, _TAG, " ")))
        return let(clean, lambda text: F.when(text != "", F.concat(F.coalesce(F.concat(F.repeat(F.lit("#"), level), F.lit(" ")), F.lit("")), text)))

    return F.array_join(F.array_compact(F.transform(blocks, written)), "\n\n")


def joined_text(fragment: Column) -> Column:
    """Stripped text nodes joined by nothing."""
    return strip(markup_references(F.regexp_replace(fragment, rf"(?U)\s*(?:{_TAG})\s*", "")))


def heading_html(bare: Column) -> Column:
    """Inner HTML of the first ``h1``; null without one."""
    return F.when(
        bare.rlike(r"(?i)<h1(?=[\s/>])"), F.regexp_extract(bare, r"(?is)<h1(?=[\s/>])[^>]*>(.*?)</h1\s*>", 1)
    )


def page_title(bare: Column, h1: Column, suffix: str) -> Column:
    """First ``h1``; without one the ``title`` minus the site's suffix.  An empty ``h1`` is untitled."""
    title = joined_text(F.regexp_extract(bare, r"(?is)<title(?=[\s/>])[^>]*>(.*?)</title\s*>", 1))
    if suffix:
        title = F.replace(title, F.lit(suffix), F.lit(""))
    chosen = F.when(h1.isNotNull(), joined_text(h1)).otherwise(title)
    return or_untitled(chosen)


def or_untitled(title: Column) -> Column:
    return let(title, lambda text: F.when(text != "", text).otherwise(F.lit(UNTITLED)))


def pre_bodies(region: Column) -> Column:
    return F.regexp_extract_all(region, F.lit(r"(?is)<pre(?=[\s/>])[^>]*>(.*?)</pre\s*>"), F.lit(1))


def _block_language(pre: Column) -> Column:
    tag = F.regexp_extract(pre, r"(?is)<code(?=[\s/>])[^>]*>", 0)
    classes = F.concat(
        F.regexp_extract(tag, r"(?is)\bclass\s*=\s*\"([^\"]*)\"", 1),
        F.regexp_extract(tag, r"(?is)\bclass\s*=\s*'([^']*)'", 1),
        F.regexp_extract(tag, r"(?is)\bclass\s*=\s*([^\s\"'>]+)", 1),
    )
    marked = F.filter(F.split(classes, r"\s+"), lambda name: name.startswith("language-"))
    return F.replace(F.get(marked, F.lit(0)), F.lit("language-"), F.lit(""))


def code_blocks(pres: Column) -> Column:
    """``array<struct<code,language>>`` of the non-empty ``pre`` elements."""
    blocks = F.transform(
        pres,
        lambda pre: F.struct(joined_text(pre).alias("code"), _block_language(pre).alias("language")),
    )
    return F.filter(blocks, lambda block: block["code"] != "")


def needs_tree(bare: Column, kind: Column, region: Column, spaced: Column, h1: Column, pres: Column) -> Column:
    """Pages the regexes cannot take apart exactly."""
    nested = F.when(kind == "main", region.rlike(r"(?i)<main(?=[\s/>])")).when(
        kind == "article", region.rlike(r"(?i)<article(?=[\s/>])")
    )
    return (
        kind.isin("div", "none")
        | (region == "")
        | F.coalesce(nested, F.lit(False))
        | bare.rlike(_LEFTOVER)
        | spaced.rlike(_RARE_REFERENCE)
        | F.coalesce((h1 == "") | h1.rlike(_RARE_REFERENCE + r"|(?i)<h1(?=[\s/>])"), F.lit(False))
        | (h1.isNull() & F.regexp_extract(bare, r"(?is)<title(?=[\s/>])[^>]*>(.*?)</title", 1).rlike(_RARE_REFERENCE))
        | F.exists(pres, lambda pre: pre.rlike(r"(?i)<pre(?=[\s/>])"))
    )
