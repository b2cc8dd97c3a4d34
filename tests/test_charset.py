"""Raw bytes to text: marks, declarations, validity, fallback."""

import random

from pyspark.sql import functions as F

from siftweb.functions import charset as C
from siftweb.sources.pages import decode_pages, read_html_files
from siftweb.session import scratch_path

PAGES = [  # bytes, charset, text
    ("<html><meta charset=utf-8>é€漢".encode(), "UTF-8", "<html><meta charset=utf-8>é€漢"),
    ("<meta charset='iso-8859-1'>é ä".encode("latin-1"), "windows-1252", "<meta charset='iso-8859-1'>é ä"),
    ("<META http-equiv=x content='text/html; Charset=WINDOWS-1251'>привет".encode("cp1251"), "windows-1251",
     "<META http-equiv=x content='text/html; Charset=WINDOWS-1251'>привет"),
    (b"\xef\xbb\xbf<meta charset=latin1>" + "é".encode(), "UTF-8", "<meta charset=latin1>é"),
    ("﻿hé\U0001f642".encode("utf-16-le"), "UTF-16LE", "hé\U0001f642"),
    ("﻿hé\U0001f642".encode("utf-16-be"), "UTF-16BE", "hé\U0001f642"),
    (b"\xff\xfeh\x00\x3d\xd8a\x00\x42\xdeb\x00c", "UTF-16LE", "h�a�b"),  # surrogates alone, an odd byte
    (b"\xfe\xff\xd8\x3d\xd8\x3d\xde\x42", "UTF-16BE", "�\U0001f642"),
    (b"\xff\xfe", "UTF-16LE", ""),
    ("plain é".encode(), "UTF-8", "plain é"),
    ("plain é \x80\x81".encode("latin-1"), "windows-1252", "plain é €\x81"),
    (b"", "UTF-8", ""),
    (None, None, None),
    ("<?xml version='1.0' encoding='ISO-8859-2'?>ł".encode("iso-8859-2"), "iso-8859-2", "<?xml version='1.0' encoding='ISO-8859-2'?>ł"),
    ("<!-- <meta charset=koi8-r> --><meta charset=iso-8859-7>αβ".encode("iso-8859-7"), "iso-8859-7",
     "<!-- <meta charset=koi8-r> --><meta charset=iso-8859-7>αβ"),
    (b"<meta charset=utf-8>\xe9", "windows-1252", "<meta charset=utf-8>é"),      # declared, but it is none
    (b"<meta charset=nope>\xe9", "windows-1252", "<meta charset=nope>é"),
    (b"<meta charset=utf-16>" + "é".encode(), "UTF-8", "<meta charset=utf-16>é"),
    (b" " * 5000 + b"<meta charset=koi8-r>\xc1", "windows-1252", " " * 5000 + "<meta charset=koi8-r>Á"),
]


def test_charsets(spark):
    df = spark.createDataFrame([(i, b) for i, (b, _, _) in enumerate(PAGES)], "i int, b binary")
    got = df.select("i", C.charset(F.col("b")).alias("c"), C.text_of(F.col("b")).alias("t")).collect()
    for r in got:
        assert (r.c, r.t) == PAGES[r.i][1:], r.i


def test_every_byte_of_every_charset(spark):
    names = sorted({*C.CHARSETS.values()} - {"UTF-8"})
    df = spark.createDataFrame([(n, bytes(range(256))) for n in names], "n string, b binary")
    for r in df.select("n", C.decoded(F.col("b"), F.col("n")).alias("t")).collect():
        for b, ch in enumerate(r.t):
            try:
                assert ch == bytes([b]).decode(r.n)
            except UnicodeDecodeError:
                assert ch == chr(b)


def test_broken_bytes_never_fail(spark):
    rng = random.Random(1)
    rows = [(bytes(rng.choice([b"\xef\xbb\xbf", b"\xfe\xff", b"\xff\xfe", b"<meta charset=utf-8>", b""]))
             + bytes(rng.choice((rng.randrange(256), 0xD8, 0xDC)) for _ in range(rng.randrange(60))),) for _ in range(400)]
    got = spark.createDataFrame(rows, "b binary").select("b", C.text_of(F.col("b")).alias("t")).collect()
    assert len(got) == 400 and all(r.t is not None for r in got)
    for r in got:
        if r.b[:2] in (b"\xff\xfe", b"\xfe\xff"):
            kind = "utf-16-le" if r.b[:2] == b"\xff\xfe" else "utf-16-be"
            even = r.b[2: len(r.b) - len(r.b) % 2]
            assert r.t == even.decode(kind, "replace") or "�" in r.t


def test_header_and_folder(spark):
    raw = spark.createDataFrame([(1, "u", "é".encode("cp1251", "ignore") + b"\xe8", "text/html; charset=windows-1251"),
                                 (2, "u", b"\xe8", "text/html"), (3, "u", b"\xe8", None)],
                                "page_id long, url string, content binary, kind string")
    assert [r.html for r in decode_pages(raw, "kind").orderBy("page_id").collect()] == ["и", "è", "è"]
    path = scratch_path(spark, "html").removeprefix("file:")
    import os
    os.makedirs(path)
    for i, (b, _, _) in enumerate(PAGES):
        if b is not None:
            with open(f"{path}/{i:02d}.html", "wb") as f:
                f.write(b)
    got = {r.url.rsplit("/", 1)[1]: r.html for r in read_html_files(spark, path).collect()}
    # Spark's file sources pass over files without a byte
    assert got == {f"{i:02d}.html": t for i, (b, _, t) in enumerate(PAGES) if b}
