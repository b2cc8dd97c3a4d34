"""Raw page bytes to text, as Column expressions.

The encoding of a page is found as HTML parsers do it, in this order:

1. a byte order mark (UTF-8, UTF-16 either way);
2. the charset of the HTTP header, where the caller has one;
3. an XML declaration's ``encoding`` at the start of the bytes;
4. ``<meta charset=...>`` or ``<meta ... content="...; charset=...">`` within the
   first ``LOOK`` bytes, comments left out;
5. UTF-8, if the bytes are valid UTF-8;
6. the fallback, windows-1252.

The first of 2 to 4 that names a charset of ``CHARSETS`` counts; unknown names
are passed over.  A declared UTF-16 without a mark is read as UTF-8, as the
declaration itself was readable as ASCII; a declared UTF-8 that the bytes are
not is passed over, so that mislabelled pages fall back to 6.

Everything runs in the JVM: the head of the page is read as Latin-1 for the
search.  Charsets of several bytes a character other than UTF are not among
``CHARSETS``, for Spark decodes none of them; their pages fall to 5 or 6.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes in which declarations are looked for.
LOOK = 4096
FALLBACK = "windows-1252"

# The charset labels of pages, and the charset that each means.
# (The ASCII family means windows-1252 on the web, latin5 windows-1254.)
CHARSETS = {
    "utf-8": "UTF-8", "utf8": "UTF-8", "unicode-1-1-utf-8": "UTF-8",
    "utf-16": "UTF-8", "utf-16le": "UTF-8", "utf-16be": "UTF-8",
    "ascii": "windows-1252", "us-ascii": "windows-1252", "iso-8859-1": "windows-1252", "iso8859-1": "windows-1252",
    "latin1": "windows-1252", "latin-1": "windows-1252", "l1": "windows-1252", "windows-1252": "windows-1252",
    "cp1252": "windows-1252",
    "iso-8859-2": "iso-8859-2", "latin2": "iso-8859-2", "windows-1250": "windows-1250", "cp1250": "windows-1250",
    "iso-8859-5": "iso-8859-5", "windows-1251": "windows-1251", "cp1251": "windows-1251", "koi8-r": "koi8-r",
    "iso-8859-7": "iso-8859-7", "windows-1253": "windows-1253",
    "iso-8859-9": "windows-1254", "latin5": "windows-1254", "windows-1254": "windows-1254",
    "iso-8859-15": "iso-8859-15", "latin9": "iso-8859-15",
}

_XML = r"^\s*<\?xml[^>]*?\sencoding\s*=\s*[\"']\s*([A-Za-z0-9_.:\-]+)\s*[\"']"
_META = r"(?is)<meta\s[^>]*?charset\s*=\s*[\"']?\s*([a-z0-9_.:\-]+)"
_COMMENT = r"(?s)<!--.*?(?:-->|\z)"
_HEADER = r"(?i)charset\s*=\s*[\"']?\s*([a-z0-9_.:\-]+)"


def _known(label: Column, utf8: Column) -> Column:
    """The charset of a label; null for unknown ones, and for a UTF-8 that is none."""
    names = F.create_map(*[F.lit(x) for pair in CHARSETS.items() for x in pair])
    name = F.try_element_at(names, F.lower(label))
    return F.when((name != "UTF-8") | utf8, name)


def _mark(content: Column) -> Column:
    head = F.hex(F.substring(content, 1, 3))
    return (F.when(head == "EFBBBF", F.lit("UTF-8"))
            .when(head.startswith("FEFF"), F.lit("UTF-16BE"))
            .when(head.startswith("FFFE"), F.lit("UTF-16LE")))


def charset(content: Column, content_type: Column | None = None) -> Column:
    """The charset of the bytes: a value of CHARSETS, or UTF-16LE or UTF-16BE by its
    mark; null for null bytes."""
    utf8 = F.is_valid_utf8(content.cast("string"))
    head = F.decode(F.substring(content, 1, LOOK), "ISO-8859-1")
    header = _known(F.regexp_extract(content_type, _HEADER, 1), utf8) if content_type is not None else F.lit(None).cast("string")
    meta = F.regexp_extract(F.regexp_replace(head, _COMMENT, ""), _META, 1)
    return F.when(content.isNotNull(), F.coalesce(
        _mark(content), header, _known(F.regexp_extract(head, _XML, 1), utf8), _known(meta, utf8),
        F.when(utf8, F.lit("UTF-8")), F.lit(FALLBACK)))


def _upper_half(name: str) -> str:
    """The characters of bytes 0x80 to 0xFF; those that the charset leaves open
    keep their number, as browsers have it."""
    def char(b: int) -> str:
        try:
            return bytes([b]).decode(name)
        except UnicodeDecodeError:
            return chr(b)
    return "".join(char(b) for b in range(0x80, 0x100))


def decoded(content: Column, name: Column) -> Column:
    """The bytes as text in the charset ``name`` (see ``charset``); a byte order
    mark is left out, and bytes that are no UTF become U+FFFD.

    Charsets of one byte a character are read as Latin-1, and the upper half's
    characters are replaced by the charset's own."""
    mark = _mark(content)
    wide = F.when(name == "UTF-16LE", _wide(content, False)).when(name == "UTF-16BE", _wide(content, True))
    utf8 = F.make_valid_utf8(F.when(mark == "UTF-8", F.substring(content, 4, 1 << 30)).otherwise(content).cast("string"))
    names = sorted({*CHARSETS.values()} - {"UTF-8"})
    halves = F.create_map(*[F.lit(x) for n in names for x in (n, _upper_half(n))])
    latin = F.call_function("translate", F.decode(content, "ISO-8859-1"), F.lit(_LATIN_HALF), F.try_element_at(halves, name))
    return F.when(name == "UTF-8", utf8).when(name.startswith("UTF-16"), wide).otherwise(latin)


_LATIN_HALF = "".join(map(chr, range(0x80, 0x100)))


def _wide(content: Column, big: bool) -> Column:
    """UTF-16 behind its mark; an odd last byte is left out, and surrogates without
    a partner (on which ``decode`` would fail) become U+FFFD."""
    size = F.length(content)
    units = F.decode(F.substring(content, F.lit(3), size - 2 - size % 2), "ISO-8859-1")
    high, low, other = (("[\xD8-\xDB].", "[\xDC-\xDF].", "\xFF\xFD") if big
                        else (".[\xD8-\xDB]", ".[\xDC-\xDF]", "\xFD\xFF"))
    end = "\u0100"  # no byte; closes each unit, so that patterns keep in step
    cut = F.regexp_replace(units, "(?s)(..)", f"$1{end}")
    alone = f"(?s)(?<=^|{end}){high}{end}(?!{low}{end})|(?<=^|{end})(?<!(?:^|{end}){high}{end}){low}{end}"
    mended = F.replace(F.regexp_replace(cut, alone, other + end), F.lit(end), F.lit(""))
    whole = F.when(units.rlike("[\xD8-\xDF]"), mended).otherwise(units)
    return F.decode(F.encode(whole, "ISO-8859-1"), "UTF-16BE" if big else "UTF-16LE")


def text_of(content: Column, content_type: Column | None = None) -> Column:
    """Raw bytes as text, by the charset found in them."""
    return decoded(content, charset(content, content_type))
