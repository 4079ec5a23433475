"""Text column expressions; all stay inside the JVM."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise import config

TOKEN_SEPARATOR = r"[^\p{L}\p{N}]+"

# Personal-data classes and the mask that replaces each, applied in this order.
PII_PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "[EMAIL]"),
    ("ip", r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b", "[IP]"),
    ("ssn", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", "[SSN]"),
    ("card", r"\b(?:[0-9]{4}[ -]?){3}[0-9]{4}\b", "[CARD]"),
    ("phone", r"(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)|\b[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}\b", "[PHONE]"),
    ("secret", r"\b[A-Fa-f0-9]{32,}\b", "[SECRET]"),
)

# Every match of a pattern above holds a digit, an at sign or a long run of hex letters.
PII_HINT = r"[0-9@]|[A-Fa-f]{32}"

# A named, decimal or hexadecimal HTML entity.
HTML_ENTITY = r"&(?:[A-Za-z][A-Za-z0-9]*|#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6});"

# Characters of the named entities of HTML 4; a non-breaking space becomes a plain one.
HTML_NAMED = {**{name: chr(code) for name, code in name2codepoint.items()}, "apos": "'", "nbsp": " "}


def normalize_whitespace(col: Column) -> Column:
    """Every run of (Unicode) whitespace becomes one space; ends are trimmed."""
    return F.trim(F.regexp_replace(col, r"(?U)[\s\x1c-\x1f]+", " "))


def strip_control(col: Column) -> Column:
    """Remove control characters other than tab and newlines."""
    return F.regexp_replace(col, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "")


def tokens(col: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(col), TOKEN_SEPARATOR), "")


def token_count(col: Column) -> Column:
    """size(tokens(col)) without building the array."""
    return F.regexp_count(col, F.lit(r"[\p{L}\p{N}]+"))


def ngrams(token_array: Column, n: int) -> Column:
    """Contiguous n-token phrases, repeats kept."""
    if n == 1:
        return token_array
    last = F.size(token_array) - n + 1
    starts = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(token_array, i, n), " "))


def token_estimate(col: Column) -> Column:
    """Estimated model tokens: one per four characters, rounded up."""
    return F.ceil(F.coalesce(F.length(col), F.lit(0)) / F.lit(4)).cast("bigint")


def html_to_text(html: Column) -> Column:
    """Visible text of a page: scripts, styles and comments dropped, tags blanked, entities decoded."""
    text = F.regexp_replace(html, r"(?is)<script.*?</script>", " ")
    text = F.regexp_replace(text, r"(?is)<style.*?</style>", " ")
    text = F.regexp_replace(text, r"(?s)<!--.*?-->", " ")
    text = F.regexp_replace(text, r"(?s)<[^>]*>", " ")
    return decode_entities(text)


def decode_entities(text: Column) -> Column:
    """HTML entities as characters, each decoded once; unknown names stay, numbers that are no character become U+FFFD."""
    pattern = F.lit(HTML_ENTITY)
    between, found = F.split(text, HTML_ENTITY, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    decoded = F.array_join(F.zip_with(between, found, lambda part, entity: F.concat(part, F.coalesce(_entity(entity), entity, F.lit("")))), "")
    return F.when(F.contains(text, F.lit("&")), decoded).otherwise(text)


def _entity(entity: Column) -> Column:
    name = F.substring(entity, F.lit(2), F.length(entity) - 2)
    names = F.create_map(*[F.lit(x) for pair in HTML_NAMED.items() for x in pair])
    number = F.when(F.lower(F.substring(name, 2, 1)) == "x", F.conv(F.substring(name, F.lit(3), F.length(name)), 16, 10))
    code = F.coalesce(number, F.substring(name, F.lit(2), F.length(name))).try_cast("bigint")
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return F.when(F.startswith(name, F.lit("#")), F.when(valid, char).otherwise("\ufffd")).otherwise(F.try_element_at(names, name))


def preview(*candidates: Column, width: int = 80) -> Column:
    """First non-null candidate cut to `width` characters, followed by an ellipsis."""
    return F.concat(F.substring(F.coalesce(*candidates, F.lit("N/A")), 1, width), F.lit("..."))


def fill_template(template: str, **fields: Column) -> Column:
    """Substitute named columns into a fixed template."""
    parts: list[Column] = []
    rest = template
    while rest:
        places = [(rest.find("{" + name + "}"), name) for name in fields]
        places = [p for p in places if p[0] >= 0]
        if not places:
            parts.append(F.lit(rest))
            break
        at, name = min(places)
        if at:
            parts.append(F.lit(rest[:at]))
        parts.append(fields[name])
        rest = rest[at + len(name) + 2 :]
    return F.concat(*parts)


def rag_prompt(context: Column, question: Column, organization: str = config.ORGANIZATION) -> Column:
    template = config.RAG_TEMPLATE.replace("{organization}", organization)
    return fill_template(template, context=context, question=question)


def hash_int(*cols: Column, seed: str = "42") -> Column:
    """Integer of the first eight hex digits of md5(seed | key), the same in any engine."""
    key = F.concat_ws("|", F.lit(seed), *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
