"""Page extraction as Column expressions.

HTML is handled with regular expressions that stay inside the JVM and
whole-stage codegen; no per-row parser runs in Python.  The expressions
follow what a lenient HTML parser reports for ordinary pages: comments,
the doctype, ``<style>`` and ``<script>`` elements carry no text, every
other text run between tags is one segment.  Comments and these elements are
found in one pass from left to right, so whichever opens first decides: a
``<!--`` inside a script is script text, a ``<script>`` inside a comment is
comment.  Known gaps of a regex reading (implicit tag closing, CDATA
sections) are listed in the README.
"""

from __future__ import annotations

import html as _html
import json as _json
from html import entities as _entities

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftweb.functions.urls import _let

# Named character references decoded in text, as
# (entity, character).  ``&amp;`` must stay last so that ``&amp;lt;`` turns
# into the literal text ``&lt;``.
ENTITIES = [
    ("&nbsp;", "\u00a0"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&apos;", "'"),
    ("&#39;", "'"),
    ("&copy;", "\u00a9"),
    ("&reg;", "\u00ae"),
    ("&middot;", "\u00b7"),
    ("&ndash;", "\u2013"),
    ("&mdash;", "\u2014"),
    ("&hellip;", "\u2026"),
    ("&laquo;", "\u00ab"),
    ("&raquo;", "\u00bb"),
    ("&euro;", "\u20ac"),
    ("&lsquo;", "\u2018"),
    ("&rsquo;", "\u2019"),
    ("&ldquo;", "\u201c"),
    ("&rdquo;", "\u201d"),
    ("&bull;", "\u2022"),
    ("&eacute;", "\u00e9"),
    ("&egrave;", "\u00e8"),
    ("&agrave;", "\u00e0"),
    ("&ccedil;", "\u00e7"),
    ("&auml;", "\u00e4"),
    ("&ouml;", "\u00f6"),
    ("&uuml;", "\u00fc"),
    ("&Auml;", "\u00c4"),
    ("&Ouml;", "\u00d6"),
    ("&Uuml;", "\u00dc"),
    ("&szlig;", "\u00df"),
    ("&amp;", "&"),
]

# Characters Python's str.strip() removes (str.isspace), as a regex class
# both Java regex and RE2 read the same way.
WS_CLASS = (
    "[\\t\\n\\x0B\\f\\r\\x1C-\\x1F \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
    "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
)
#: The same characters as a string.
WHITESPACE = ("\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B)))
              + "\u2028\u2029\u202f\u205f\u3000")

# A tag as the HTML tokenizer sees it: '<' followed by a letter, '/', '!'
# or '?', up to the first '>' outside a quoted attribute value.  A bare '<'
# followed by a space is text.  The outer loop is possessive ('*+'), so an
# unclosed tag fails in linear time (no backtracking into the runs).
TAG_RE = "<[!/?a-zA-Z](?:[^>\"']+|\"[^\"]*\"|'[^']*')*+>"
_COMMENT = "!--.*?(?:-->|\\z)"
_STYLE = "style(?=[\\s>/])[^>]*>.*?(?:</style\\s*>|\\z)"
_SCRIPT = "script(?=[\\s>/])[^>]*>(.*?)(?:</script\\s*>|\\z)"
#: What carries no text; group 1 is the text of a script.  '<' stands in front
#: once, so that most characters of a page are passed by one comparison.
DROPPED_RE = f"(?is)<(?:{_SCRIPT}|{_STYLE}|{_COMMENT})"
TITLE_RE = "(?is)<title(?=[\\s>/])[^>]*>(.*?)</title\\s*>"
LANG_RE = "(?is)<[a-z][^\\s>]*\\s(?:[^>]*\\s)?lang\\s*=\\s*[\"']?([^\"'\\s>]*)"
A_TAG_RE = "(?is)<a\\s(?:[^>\"']+|\"[^\"]*\"|'[^']*')*+>"
HREF_RE = "(?is)\\shref\\s*=\\s*(\"[^\"]*|'[^']*|[^\\s>]*)"
HREF_PRESENT_RE = "(?is)\\shref\\s*=\\s*"

# Fixed value: the link pattern applied to script text.  It needs two or
# more characters between "<a" and "href", two or more in the value and one
# between the closing quote and ">" (so '<a href="xyz">' never matches).
SCRIPT_LINK_RE = "<a(?:.[^<>]+)href\\s*=\\s*['\"](.[^'\"]+)['\"](?:.[^<>]*)>"
# Lenient variant used when strict_script_links=False.
SCRIPT_LINK_LENIENT_RE = "<a\\s[^<>]*?href\\s*=\\s*['\"]([^'\"]*)['\"][^<>]*>"


# An '&' that does not start one of the ENTITIES.
_OTHER_AMP_RE = "&(?!(?:" + "|".join(e[1:] for e, _ in ENTITIES) + "))"


def decode_common_entities(c: Column) -> Column:
    """Decode only the named references in ENTITIES (a replace chain)."""
    out = c
    for ent, ch in ENTITIES:
        out = F.replace(out, F.lit(ent), F.lit(ch))
    return F.when(c.contains("&"), out).otherwise(c)


# Character references as HTML defines them (the rule ``html.unescape``
# follows): named references from the HTML5 table, with or without ';'
# (longest known prefix wins when the ';' is missing), decimal and hex
# numeric references.  The tables come from Python's standard library.
CHARREF_RE = "&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\\t\\n\\f <&#;]{1,32};?)"
CHARREF_SPLIT_RE = "&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\\t\\n\\f <&#;]{1,32};?)"


def _from_code_point(n: Column) -> Column:
    """The character of code point n (not a surrogate, <= 0x10FFFF)."""
    bmp = F.decode(F.unhex(F.lpad(F.hex(n), 4, "0")), "UTF-16BE")
    m = n - F.lit(0x10000)
    hi = F.lit(0xD800) + F.shiftright(m, 10)
    lo = F.lit(0xDC00) + F.bitwise_not(F.bitwise_not(m).bitwiseOR(F.lit(-1024)))
    sup = F.decode(F.unhex(F.concat(F.hex(hi), F.hex(lo))), "UTF-16BE")
    return F.when(n < 0x10000, bmp).otherwise(sup)


# What ``html.unescape`` makes of the numbers that do not stand for their own
# character: replaced (0, 0x80-0x9F and a few more) or dropped.
_NUMBERS = [n for n in [*range(0xA0), *range(0xFDD0, 0xFDF0),
                        *(p << 16 | e for p in range(17) for e in (0xFFFE, 0xFFFF))]]
_REPLACED = {str(n): c for n in _NUMBERS if (c := _html.unescape(f"&#{n};")) not in ("", chr(n))}
_DROPPED = [n for n in _NUMBERS if not _html.unescape(f"&#{n};")]


def _numeric_ref(ref: Column) -> Column:
    """'#65;' / '#x41' -> the character, with HTML's replacement rules."""
    hexa = ref.substr(2, 1).isin("x", "X")
    digits = F.regexp_replace(F.regexp_replace(ref, ";$", ""), "^#[xX]?", "")
    digits = F.regexp_replace(digits, "^0+(?=.)", "")
    too_long = F.length(digits) > F.when(hexa, F.lit(6)).otherwise(F.lit(7))
    num = F.when(too_long, F.lit(0x110000)).otherwise(
        F.when(hexa, F.conv(digits, 16, 10)).otherwise(digits).cast("int"))
    invalid = F.from_json(F.lit(_json.dumps(_REPLACED)), "map<string,string>")
    dropped = F.from_json(F.lit(_json.dumps(_DROPPED)), "array<int>")
    return (
        F.when(F.map_contains_key(invalid, num.cast("string")),
               F.try_element_at(invalid, num.cast("string")))
        .when(((num >= 0xD800) & (num <= 0xDFFF)) | (num > 0x10FFFF), F.lit("\uFFFD"))
        .when(F.array_contains(dropped, num), F.lit(""))
        .otherwise(_from_code_point(num))
    )


def _named_ref(ref: Column, table: Column) -> Column:
    """'amp;' -> '&'; 'ampx' -> '&x' (longest known prefix); else kept."""
    exact = F.try_element_at(table, ref)
    lens = F.sequence(F.length(ref) - 1, F.lit(2), F.lit(-1))
    hits = F.filter(F.transform(lens, lambda k: F.struct(
        k.alias("k"), F.try_element_at(table, F.substring(ref, 1, k)).alias("v"))),
        lambda h: h["v"].isNotNull())
    first = F.element_at(hits, 1)
    prefix = F.when(F.length(ref) > 2, F.when(F.size(hits) > 0, F.concat(
        first["v"], F.substring(ref, first["k"] + 1, 1 << 20))))
    return F.coalesce(exact, prefix, F.concat(F.lit("&"), ref))


def _entity_table() -> Column:
    """The HTML5 name table as one map constant (a JSON literal the
    optimizer folds once), not thousands of literal expressions."""
    return F.from_json(F.lit(_json.dumps(_entities.html5)), "map<string,string>")


def decode_entities(c: Column) -> Column:
    """P10: decode every character reference (text without '&' is returned
    as is; the general path splits around the references, replaces each,
    and joins the pieces back)."""
    table = _entity_table()
    pieces = F.split(c, CHARREF_SPLIT_RE, -1)
    refs = F.regexp_extract_all(c, F.lit(CHARREF_RE), 1)
    repl = F.transform(refs, lambda r: F.when(r.startswith("#"), _numeric_ref(r))
                       .otherwise(_named_ref(r, table)))
    joined = F.array_join(F.flatten(F.transform(
        F.arrays_zip(pieces.alias("p"), repl.alias("r")),
        lambda x: F.array(x["p"], F.coalesce(x["r"], F.lit(""))))), "")
    common_only = ~c.rlike(_OTHER_AMP_RE)
    return (F.when(~c.contains("&"), c)
            .when(common_only, decode_common_entities(c))
            .when(F.size(refs) > 0, joined)
            .otherwise(c))


def strip_ws(c: Column) -> Column:
    """Cut Unicode whitespace at both ends (``trim`` alone cuts only spaces)."""
    return F.btrim(c, F.lit(WHITESPACE))


def clean_html(html: Column) -> Column:
    """Drop comments, <style> and <script> elements.

    Each removed element leaves an empty tag marker so that the text runs
    on either side stay separate segments.
    """
    return F.regexp_replace(html, DROPPED_RE, "<!>")


def is_valid_html(clean: Column) -> Column:
    """The cleaned page has an <html> element and a <body>."""
    return clean.isNotNull() & clean.rlike("(?i)<html[\\s>/]") & clean.rlike("(?i)<body[\\s>/]")


def title(clean: Column) -> Column:
    """Text of the first <title>, entities decoded, '' if none."""
    return _let(F.regexp_extract(clean, TITLE_RE, 1), decode_entities)


START_TAG_RE = "<[a-zA-Z](?:[^>\"']+|\"[^\"]*\"|'[^']*')*+>"


def _attribute(tag: Column, name: str) -> Column:
    """Last value of attribute ``name`` in one start tag ('' when bare),
    null when the tag has no such attribute.  Values are decoded with the
    common named references only (a language code holds no others; this
    keeps the plan small)."""
    body = F.regexp_replace(tag, "^<[^\\s>/]*|/?>$", "")
    return _let(_last_value(body, name), decode_common_entities)


def _last_value(body: Column, name: str) -> Column:
    """Last unquoted value of an attribute in the inside of a tag; null if it has none."""
    pairs = _let(body, lambda b: F.filter(
        F.arrays_zip(F.regexp_extract_all(b, F.lit(ATTR_RE), 1).alias("n"), F.regexp_extract_all(b, F.lit(ATTR_RE), 2).alias("v")),
        lambda a: F.lower(a["n"]) == name))
    return _let(F.try_element_at(pairs, F.lit(-1))["v"], _unquote)


def language(clean: Column) -> Column:
    """Value of the ``lang`` attribute of the first tag that has one,
    '' if none.  Only tags whose text mentions 'lang' are tokenized."""
    tags = F.filter(F.regexp_extract_all(clean, F.lit(START_TAG_RE), 0),
                    lambda t: F.lower(t).contains("lang"))
    vals = F.filter(F.transform(tags, lambda t: _attribute(t, "lang")), lambda v: v.isNotNull())
    return F.coalesce(F.get(vals, F.lit(0)), F.lit(""))


def segments(clean: Column) -> Column:
    """The text segments in document order.

    Split on tags, decode entities, cut whitespace at both ends, drop
    empties.  A page with no text at all gives ``['']``.
    """
    parts = F.split(clean, TAG_RE, -1)
    parts = F.filter(
        F.transform(parts, lambda s: strip_ws(decode_entities(s))),
        lambda s: s != "",
    )
    return _let(parts, lambda found: F.when(F.size(found) == 0, F.array(F.lit(""))).otherwise(found))


# One attribute: name, then optionally '=' and a quoted or bare value.
# Scanning a tag with this left to right consumes quoted values whole.
ATTR_RE = "\\s([^\\s\"'>/=]+)(?:\\s*=\\s*(\"[^\"]*\"|'[^']*'|[^\\s>]+))?"


def _unquote(v: Column) -> Column:
    q = F.substring(v, 1, 1)
    return F.when(q.isin('"', "'") & (F.length(v) >= 2),
                  F.substring(v, F.lit(2), F.length(v) - 2)).otherwise(v)


def anchor_hrefs(clean: Column) -> Column:
    """Href of every <a> tag in document order.

    Attributes are read left to right; a repeated href keeps the last value,
    a bare ``href`` gives '', a tag without href is dropped.  Values are
    entity-decoded.
    """
    tags = F.regexp_extract_all(clean, F.lit(A_TAG_RE), 0)

    def href_of(t: Column) -> Column:
        body = F.substring(t, F.lit(3), F.length(t) - 3)          # inside "<a" ... ">"
        return _let(_last_value(body, "href"), decode_entities)

    return F.filter(F.transform(tags, href_of), lambda h: h.isNotNull())


def script_hrefs(html: Column, strict: bool = True) -> Column:
    """Links found in the text of <script> elements, in order."""
    bodies = F.regexp_extract_all(html, F.lit(DROPPED_RE), 1)
    pat = SCRIPT_LINK_RE if strict else SCRIPT_LINK_LENIENT_RE
    return F.flatten(F.transform(bodies, lambda b: F.regexp_extract_all(b, F.lit(pat), 1)))


def raw_links(html: Column, clean: Column, strict_script_links: bool = True) -> Column:
    """P7 then P8: anchor links followed by the links inside scripts."""
    return F.concat(anchor_hrefs(clean), script_hrefs(html, strict_script_links))


def content_hash(content: Column) -> Column:
    """Fingerprint of the segments joined with no separator."""
    return F.sha2(F.array_join(content, ""), 256)
