"""Text expressions: cleaning, label and value extraction, JSON in free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import numbers

#: Entities that statements contain. Fixed values.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&"))


def clean_label(x: Column) -> Column:
    """Lower case, white space collapsed and trimmed."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), r"\s+", " "))


def html_unescape(x: Column) -> Column:
    """The usual entities as characters; the ampersand last, so that nothing is unescaped twice."""
    for entity, char in ENTITIES:
        x = F.replace(x, F.lit(entity), F.lit(char))
    return x


def strip_tags(x: Column) -> Column:
    """Text of an HTML fragment, without scripts and styles."""
    x = F.regexp_replace(x, r"(?is)<(script|style)\b.*?</\1>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(x, r"(?s)<[^>]*>", " "), r"\s+", " "))


def bodies(table_text: Column, page_text: Column) -> Column:
    """A page's texts in the order in which they are searched: table engine, page engine, both together."""
    whole = F.concat_ws("\n\n", page_text, table_text)
    made = F.array(F.struct(F.lit(0).alias("body_ord"), table_text.alias("body")), F.struct(F.lit(1).alias("body_ord"), page_text.alias("body")), F.struct(F.lit(2).alias("body_ord"), whole.alias("body")))
    return F.filter(made, lambda b: b["body"].isNotNull() & (F.trim(b["body"]) != ""))


def pair_after_label(text: Column, pattern: str, least: float = 1_000.0) -> Column:
    """struct(closing, opening): the first two amounts after a label, statements giving the closing first.

    An amount counts if it has a comma or reaches ``least``."""
    tail = F.regexp_extract(F.coalesce(text, F.lit("")), f"(?is){pattern}([^\\n]*)", 1)
    tokens = F.filter(numbers.line_tokens(tail), lambda t: F.contains(t, F.lit(",")) | (F.coalesce(t.try_cast("double"), F.lit(0.0)) >= least))
    values = F.transform(tokens, numbers.clean_number)
    return F.struct(F.coalesce(F.get(values, F.lit(0)), F.lit(0.0)).alias("closing"), F.coalesce(F.get(values, F.lit(1)), F.lit(0.0)).alias("opening"))


def lakhs_pair(text: Column, pattern: str) -> Column:
    """struct(opening, closing) in rupees of a pattern's two groups (closing, then opening), in lakhs."""
    return numbers.let(one_line(text), lambda flat: pair_in(flat, pattern))


def one_line(text: Column) -> Column:
    """A text with spaces for line feeds; null is empty."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("\n"), F.lit(" "))


def pair_in(flat: Column, pattern: str) -> Column:
    """As ``lakhs_pair``, of a text without line feeds; one that lacks the pattern is searched once."""
    at = lambda k: numbers.lakhs_to_rupees(F.regexp_extract(flat, f"(?i){pattern}", k))
    pair = lambda o, c: F.struct(o.alias("opening"), c.alias("closing"))
    return F.when(F.regexp_extract(flat, f"(?i){pattern}", 0) != "", pair(at(2), at(1))).otherwise(pair(F.lit(0.0), F.lit(0.0)))


def json_block(text: Column) -> Column:
    """The JSON object of a free text: all of it, else a fenced block, else from the first to the last brace."""
    t = F.trim(F.coalesce(text, F.lit("")))
    fenced = F.regexp_extract(t, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1)
    braces = F.regexp_extract(t, r"(?s)(\{.*\})", 1)
    valid = lambda x: F.when(F.startswith(F.trim(x), F.lit("{")) & F.try_parse_json(x).isNotNull(), x)
    return F.coalesce(valid(t), valid(fenced), valid(braces))


def json_rows(text: Column, schema: str) -> Column:
    """The outermost JSON array of a free text as an array of ``schema``; null if there is none."""
    return F.from_json(F.nullif(F.regexp_extract(F.coalesce(text, F.lit("")), r"(?s)(\[.*\])", 1), F.lit("")), f"array<{schema}>")
